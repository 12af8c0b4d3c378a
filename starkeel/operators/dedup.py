"""One row per key, chosen by a stated order instead of by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LAST = "__last"
_SOURCE = "__source"


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t)
    return not isinstance(t, (T.MapType, T.VariantType))


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the row of each key that is last by ``order_by``, NULLs first.

    Ties fall to the remaining columns, so equal inputs always give equal
    outputs. The row is found as the largest struct of a key: an aggregate,
    which combines on the map side and so sends at most one row per key and
    task through the shuffle, however often a key repeats.
    """
    named = [*keys, *order_by]
    rest = [f for f in df.schema if f.name not in named]
    ranked = [*order_by, *[f.name for f in rest if _orderable(f.dataType)]]
    carried = [f.name for f in rest if not _orderable(f.dataType)]
    if not ranked and not carried:
        return df.select(*keys).distinct()
    if carried:
        order = F.struct(*ranked) if ranked else F.lit(0)
        last = F.max_by(F.struct(*ranked, *carried), order)
    else:
        last = F.max(F.struct(*ranked))
    picked = df.groupBy(*keys).agg(last.alias(_LAST))
    return picked.select(*[c if c in keys else f"{_LAST}.{c}" for c in df.columns])


def pool(
    base: DataFrame, updates: DataFrame, keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Rows of both frames, an update replacing the base row of its key."""
    both = base.withColumn(_SOURCE, F.lit(0)).unionByName(
        updates.withColumn(_SOURCE, F.lit(1))
    )
    return latest(both, keys, [_SOURCE, *order_by]).drop(_SOURCE)
