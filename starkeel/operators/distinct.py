"""Exact distinct counts of ids by bitmaps that can be kept and merged.

An id is one bit in the bitmap of its bucket, 32,768 ids wide. Bitmaps are built
on the map side, so what is shuffled is keyed by group and bucket and never by
id, and those of several days are merged without their ids. A bitmap takes 4 kB
whatever it holds: this pays where the ids of a group lie close together, as
ids given out in order do. Where they are scattered, words do: of the bitmap only
the runs of 256 ids that hold one, each as four numbers. They are put together by
``bit_or`` in a hash table, with no row larger than its key and these numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "id_bucket", "id_bitmap"
WORD, BITS = "id_word", ("id_bits_0", "id_bits_1", "id_bits_2", "id_bits_3")


def id_bitmaps(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """Per group and bucket the bitmap of its ids (a bigint column); NULL is no id."""
    rows = df.filter(F.col(column).isNotNull()).withColumn(BUCKET, F.bitmap_bucket_number(F.col(column)))
    return rows.groupBy(*groups, BUCKET).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column))).alias(BITMAP)
    )


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several days put together."""
    return bitmaps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_bitmaps(bitmaps: DataFrame, groups: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct ids per group, of bitmaps with one row per group and bucket."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))


def id_words(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """Per group the words of its bitmap that hold an id (a bigint column); NULL is no id."""
    place = F.col(column)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).cast("int"))
    part = F.shiftright(place, 6).bitwiseAND(3)
    rows = df.filter(place.isNotNull()).select(
        *groups, F.shiftright(place, 8).alias(WORD),
        *[F.when(part == k, bit).otherwise(F.lit(0).cast("bigint")).alias(c) for k, c in enumerate(BITS)],
    )
    return merge_words(rows, groups)


def merge_words(words: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Words of coarser groups, or of several days put together."""
    return words.groupBy(*groups, WORD).agg(*[F.bit_or(c).alias(c) for c in BITS])


def count_words(words: DataFrame, groups: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct ids per group, of words with one row per group and word."""
    held = sum((F.bit_count(c) for c in BITS[1:]), F.bit_count(BITS[0]))
    return words.groupBy(*groups).agg(F.sum(held.cast("bigint")).alias(name))
