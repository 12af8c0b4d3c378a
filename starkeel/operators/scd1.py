"""Type-1 dimensions: the latest value wins, no history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import id_key
from .merge import match

_IN = "__in"


def scd1_init(batch: DataFrame, key: str, surrogate: str) -> DataFrame:
    """First load: every row gets its key."""
    return batch.select(
        id_key(F.col(key)).alias(surrogate),
        F.col(key),
        *[c for c in batch.columns if c != key],
    )


def scd1_upsert(
    history: DataFrame, batch: DataFrame, key: str, surrogate: str
) -> DataFrame:
    """Batch rows replace or extend the dimension; nothing is deleted.

    A batch row replaces the whole row, NULLs included.
    """
    pairs, _, sent = match(history, batch, key)
    natural = F.coalesce(f"h.{key}", f"n.{key}")
    return pairs.select(
        id_key(natural).alias(surrogate),
        natural.alias(key),
        *[
            F.when(sent, F.col(f"n.{c}")).otherwise(F.col(f"h.{c}")).alias(c)
            for c in batch.columns if c != key
        ],
    )


def changed_rows(
    base: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Rows of ``updates`` that are new or differ from ``base``: a daily feed.

    Rows only in ``base`` can never be emitted, so a left join from the updates
    is enough; of the base it moves the key and the tracked columns only.
    """
    b = base.select(key, *tracked).withColumn(_IN, F.lit(True)).alias("b")
    u = updates.alias("u")
    joined = u.join(b, F.col(f"u.{key}") == F.col(f"b.{key}"), "left")
    differs = F.col(f"b.{_IN}").isNull()
    for c in tracked:
        differs = differs | ~F.col(f"u.{c}").eqNullSafe(F.col(f"b.{c}"))
    return joined.filter(differs).select("u.*")
