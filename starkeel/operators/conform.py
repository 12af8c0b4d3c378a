"""From an all-text feed to typed rows, with the unusable ones set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import malformed, parse

REASON = "reject_reason"
CORRUPT = "_corrupt_record"
TYPED, RECEIVED = "typed", "received"


def conform(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Project a feed onto ``schema``; text that does not fit becomes NULL."""
    return raw.select(*[parse(F.col(f.name), f.dataType).alias(f.name) for f in schema])


def _tests(
    raw: DataFrame, schema: T.StructType, required: Sequence[str]
) -> list[tuple[Column, str]]:
    """The conditions that make a row unusable, each with its reason."""
    tests = []
    if CORRUPT in raw.columns:
        tests.append((F.col(CORRUPT).isNotNull(), "corrupt_row"))
    for f in schema:
        value = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            tests.append((malformed(value, f.dataType), f"bad_{f.name}"))
        if f.name in required:
            tests.append((value.isNull(), f"null_{f.name}"))
    return tests


def accepted(
    raw: DataFrame, schema: T.StructType, required: Sequence[str] = ()
) -> DataFrame:
    """Typed rows that parse completely and carry every required column."""
    good = raw
    for fails, _ in _tests(raw, schema, required):
        good = good.filter(~fails)
    return conform(good, schema)


def rejected(
    raw: DataFrame, schema: T.StructType, required: Sequence[str] = ()
) -> DataFrame:
    """The complement of :func:`accepted`: rows as received, with the reasons."""
    reasons = [
        F.when(fails, F.lit(why)) for fails, why in _tests(raw, schema, required)
    ]
    return raw.withColumn(REASON, F.concat_ws(",", *reasons)).filter(F.col(REASON) != "")


def judged(
    raw: DataFrame, schema: T.StructType, required: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Every row as received, its typed form and the reasons against it ("": none).

    Each cell is read once; accepted and rejected rows are then a filter of the
    same stored frame. ``keep`` are columns of the feed that are not part of it.
    """
    typed = F.struct(*[parse(F.col(f.name), f.dataType).alias(f.name) for f in schema])
    rows = raw.select("*", typed.alias(TYPED))
    tests = []
    if CORRUPT in raw.columns:
        tests.append((F.col(CORRUPT).isNotNull(), "corrupt_row"))
    for f in schema:
        if not isinstance(f.dataType, T.StringType):
            unread = F.col(f.name).isNotNull() & F.col(f"{TYPED}.{f.name}").isNull()
            tests.append((unread, f"bad_{f.name}"))
        if f.name in required:
            tests.append((F.col(f.name).isNull(), f"null_{f.name}"))
    reasons = [F.when(fails, F.lit(why)) for fails, why in tests]
    received = [f.name for f in raw.schema if f.name not in keep]
    return rows.select(*keep, F.struct(*received).alias(RECEIVED), TYPED, F.concat_ws(",", *reasons).alias(REASON))


def with_audit(df: DataFrame, *columns: str) -> DataFrame:
    """Add load-time stamps; off unless asked for, since reruns would differ."""
    now = F.current_timestamp()
    return df.withColumns({c: now for c in columns})
