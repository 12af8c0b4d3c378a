"""Matching a stored set with a batch, every row of both kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IN = "__in"


def match(stored: DataFrame, batch: DataFrame, key: str) -> tuple[DataFrame, Column, Column]:
    """Pair stored rows ``h`` with batch rows ``n`` of the same key.

    Returns the pairs, with one side NULL where it has no partner, and the
    conditions "is stored" and "is in the batch". Both inputs hold one row per
    key, so no key can be hot. It is one full outer join, which shuffles both
    sides by key, whatever their sizes.
    """
    h = stored.withColumn(_IN, F.lit(True)).alias("h")
    n = batch.withColumn(_IN, F.lit(True)).alias("n")
    pairs = h.join(n, F.col(f"h.{key}") == F.col(f"n.{key}"), "full_outer")
    return pairs, F.col(f"h.{_IN}").isNotNull(), F.col(f"n.{_IN}").isNotNull()
