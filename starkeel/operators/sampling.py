"""Repeatable row selection and ordered numbering."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut

_POSITION = "__position"
# monotonically_increasing_id puts the partition above this bit and the row's
# place inside the partition below it.
_PARTITION_BIT = 33


def bernoulli(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Keep each row with probability ``fraction``, decided by its key.

    A hash of the key and not a random generator: the same rows are chosen
    whatever the partitioning, also when a lost task is run again.
    """
    drawn = F.conv(
        F.substring(F.md5(F.concat_ws("_", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8),
        16, 10,
    ).cast("bigint")
    return df.filter(drawn < F.lit(int(fraction * 2**32)))


def number_in_order(
    df: DataFrame, order_by: Sequence[str], first: int, name: str
) -> DataFrame:
    """Give rows ascending numbers in the order of ``order_by``.

    A range shuffle puts the rows in order across partitions, splitting a value
    that repeats often by the later columns. Places are then counted per
    partition, and only one total per partition is summed up to give each its
    offset. The placed rows are checkpointed, since a range shuffle may cut
    elsewhere when it runs again.
    """
    placed = cut(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    part = F.shiftright(_POSITION, _PARTITION_BIT)
    # One row per shuffle partition: a count the session fixes, not the data.
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts = accumulate((s["count"] for s in sizes), initial=first)
    offsets = df.sparkSession.createDataFrame(
        [(s["part"], n) for s, n in zip(sizes, starts)], "part bigint, start bigint"
    )
    within = F.col(_POSITION).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn(name, F.col("start") + within)
        .drop("part", "start", _POSITION)
    )
