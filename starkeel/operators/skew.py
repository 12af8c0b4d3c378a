"""Splitting the hot keys of a join.

AQE splits skewed partitions of a sort-merge join by itself. Two things remain:
a hot key whose *right* side is large too, and sessions where AQE is off. Here
rows are counted per key, which combines before its shuffle and so is even
itself; each hot key is given as many slices as its row count asks for, and the
join runs on (key, slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "__slice"
SLICES = "__slices"


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame:
    """Every key with more than ``rows_per_slice`` rows, and the slices it needs.

    Exact. There can be no more of them than rows of ``df`` over
    ``rows_per_slice``: half a million for 10^12 rows and the daily run's value.
    """
    counted = df.select(*keys).dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    slices = F.ceil(F.col("n") / rows_per_slice).cast("int").alias(SLICES)
    return counted.filter(F.col("n") > rows_per_slice).select(*keys, slices)


def _with_slices(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Attach each row's slice count; 1 for keys that are not hot.

    The hot set is bounded by rows over rows per slice (see :func:`hot_keys`),
    which is what makes its broadcast safe.
    """
    found = df.join(F.broadcast(hot), on=list(keys), how="left")
    return found.withColumn(SLICES, F.coalesce(SLICES, F.lit(1)))


def slice_left(
    df: DataFrame, keys: Sequence[str], hot: DataFrame, spread_by: Column
) -> DataFrame:
    """Give each row one slice of its key, drawn from a hash of ``spread_by``."""
    sliced = _with_slices(df, keys, hot)
    return sliced.withColumn(
        SLICE, F.pmod(F.xxhash64(spread_by), F.col(SLICES)).cast("int")
    ).drop(SLICES)


def slice_right(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Repeat the rows of a hot key once per slice; others stay single."""
    sliced = _with_slices(df, keys, hot)
    return sliced.withColumn(
        SLICE, F.explode(F.sequence(F.lit(0), F.col(SLICES) - 1))
    ).drop(SLICES)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    spread_by: Column | None = None,
) -> DataFrame:
    """Equi-join of a fact to a dimension, hot keys split when ``hot`` is given.

    No broadcast hint: Spark broadcasts the dimension when its measured size is
    below the session threshold and shuffles otherwise.
    """
    if hot is None:
        return left.join(right, on=on, how=how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a sliced right side cannot serve a {how} join")
    spread = spread_by if spread_by is not None else F.struct(*left.columns)
    return (
        slice_left(left, [on], hot, spread)
        .join(slice_right(right, [on], hot), on=[on, SLICE], how=how)
        .drop(SLICE)
    )
