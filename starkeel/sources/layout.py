"""Physical layout of tables: distribution, sort order, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CURVE = "__curve"


def arrange(
    df: DataFrame, gather: Sequence[str] = (), sort: Sequence[str] = ()
) -> DataFrame:
    """Gather rows for a write and sort them inside each file.

    ``gather`` asks for a rebalance, not a plain repartition: values with few
    rows share a task and one that holds most rows is split over many, each
    writing files of the session's advisory size.
    """
    if gather:
        df = df.hint("rebalance", *[F.col(c) for c in gather])
    return df.sortWithinPartitions(*sort) if sort else df


def _rank(value: Column, limits: Sequence) -> Column:
    """How many of the ascending ``limits`` are not above ``value``, found by halving."""
    if not limits:
        return F.lit(0)
    half = len(limits) // 2
    above = _rank(value, limits[half + 1 :]) + F.lit(half + 1)
    return F.when(value >= F.lit(limits[half]), above).otherwise(_rank(value, limits[:half]))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """A sort key that keeps rows near in any of several columns near to each other.

    Each numeric column is cut into ``2 ** bits`` ranges that hold about as many
    rows each, and the bits of the range numbers are interleaved. The limits are
    found in one pass over the columns; their number is fixed. NULLs come first.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    limits = df.agg(*[F.percentile_approx(c, shares, 20_000).alias(c) for c in columns]).first()
    key = F.lit(0).cast("bigint")
    for n, c in enumerate(columns):
        place = _rank(F.col(c), sorted(set(limits[c] or [])))
        for bit in range(bits):
            one = F.shiftright(place.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + n))
    return key


def cluster(df: DataFrame, columns: Sequence[str], bits: int = 8) -> DataFrame:
    """Rows dealt out and sorted by :func:`interleaved`, so that a filter on any of
    ``columns`` alone reads only some of a table's row groups."""
    rows = df.withColumn(_CURVE, interleaved(df, columns, bits))
    return rows.repartitionByRange(_CURVE).sortWithinPartitions(_CURVE, *columns).drop(_CURVE)


def save_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, sort: Sequence[str] = ()
) -> None:
    """Save a catalog table bucketed by ``key``.

    Joins on ``key`` between tables of equal bucket counts then need no shuffle,
    which pays when a large dimension is joined every day.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort:
        writer = writer.sortBy(*sort)
    writer.saveAsTable(table)
