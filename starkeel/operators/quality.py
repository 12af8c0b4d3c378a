"""Checks on keys, references, history and ranges.

Every check is one distributed pass whose partial results are combined before
the shuffle, so a key or value that repeats very often costs no more than a
rare one. Row checks return the violations, column checks one row per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import open_end


def measures(
    not_null: Sequence[str] = (), max_length: Mapping[str, int] | None = None,
    ranges: Mapping[str, tuple] | None = None,
) -> dict[str, Column]:
    """Counts of what breaks the declared rules, each an aggregate over a table's rows."""
    found = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    found |= {f"length_{c}": F.count_if(F.length(c) > n) for c, n in (max_length or {}).items()}
    for c, (least, most) in (ranges or {}).items():
        outside = F.lit(False)
        if least is not None:
            outside = outside | (F.col(c) < F.lit(least))
        if most is not None:
            outside = outside | (F.col(c) > F.lit(most))
        found[f"range_{c}"] = F.count_if(outside)
    return found


def overflows(typed: Mapping[str, Column], text: Mapping[str, Column]) -> dict[str, Column]:
    """Counts of numbers that are there as text but do not fit the type they were read as."""
    return {
        f"precision_{c}": F.count_if(typed[c].isNull() & text[c].try_cast("double").isNotNull()) for c in typed
    }


def watched(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame, and what will have been counted once it has been written.

    The counts ride along with whatever job writes the frame: a check costs no
    scan of its own. Tasks that are repeated after a failure may be counted twice.
    """
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def counted(seen: Observation) -> dict[str, int]:
    """What was counted; empty if Spark found out while running that there were no rows."""
    return seen.get if seen._jo.getRow().length() else {}


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _per_column(df: DataFrame, measures: Mapping[str, list[Column]], names: list[str]) -> DataFrame:
    """One aggregation row of several measures per column, turned to long form."""
    flat = [
        m.alias(f"{c}__{n}") for c, ms in measures.items() for n, m in zip(names, ms)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                *[F.col(f"{c}__{n}").alias(n) for n in names],
            )
            for c in measures
        ]
    )
    return df.agg(*flat).select(F.inline(rows))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(
        df, {c: [F.count_if(F.col(c).isNull())] for c in columns}, ["nulls"]
    )


def length_report(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Longest value and number of values over the declared length."""
    return _per_column(
        df,
        {
            c: [F.max(F.length(c)), F.count_if(F.length(c) > n)]
            for c, n in limits.items()
        },
        ["max_length", "too_long"],
    )


def decimal_report(df: DataFrame, limits: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Values that are present but do not fit the declared precision."""
    return _per_column(
        df,
        {
            c: [
                F.count(c),
                F.count_if(
                    F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
                ),
            ]
            for c, (p, s) in limits.items()
        },
        ["present", "overflow"],
    )


def range_report(df: DataFrame, ranges: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Rows below and above the allowed range of each column, bounds included."""
    return _per_column(
        df,
        {
            c: [F.count_if(F.col(c) < lo), F.count_if(F.col(c) > hi)]
            for c, (lo, hi) in ranges.items()
        },
        ["below", "above"],
    )


def fk_violations(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values without a parent and the rows that carry them.

    The child is first reduced to its distinct values, so the anti-join sees
    each value once.
    """
    values = (
        child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    )
    return values.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose reference resolves."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_semi")


def current_flag_violations(
    dim: DataFrame, key: str, current: str = "is_current", end: str = "end_date"
) -> DataFrame:
    """Keys without exactly one current version, or whose flag and end disagree."""
    is_open = F.col(end).eqNullSafe(open_end())
    return (
        dim.groupBy(key)
        .agg(
            F.count_if(F.col(current)).alias("current_versions"),
            F.count_if(~F.col(current).eqNullSafe(is_open)).alias("flag_mismatches"),
        )
        .filter((F.col("current_versions") != 1) | (F.col("flag_mismatches") > 0))
    )


def continuity_violations(
    dim: DataFrame, key: str, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """Keys whose versions overlap, leave a gap or run backwards.

    Instead of sorting the versions of a key in one task, each version is split
    into its two ends and these are counted per (key, instant). Versions form
    one unbroken chain exactly when every instant carries at most one start and
    one end, a single start has no end before it, and no version is inverted.
    """
    edges = dim.select(
        key,
        F.inline(
            F.array(
                F.struct(
                    F.col(start).alias("at"), F.lit(1).alias("starts"),
                    F.lit(0).alias("ends"),
                    (F.col(start) >= F.col(end)).cast("int").alias("inverted"),
                ),
                F.struct(
                    F.col(end).alias("at"), F.lit(0).alias("starts"),
                    F.lit(1).alias("ends"), F.lit(0).alias("inverted"),
                ),
            )
        ),
    )
    instants = edges.groupBy(key, "at").agg(
        F.sum("starts").alias("starts"),
        F.sum("ends").alias("ends"),
        F.sum("inverted").alias("inverted"),
    )
    return (
        instants.groupBy(key)
        .agg(
            F.count_if((F.col("starts") > 0) & (F.col("ends") == 0)).alias("chains"),
            F.count_if(F.col("starts") > 1).alias("repeated_starts"),
            F.count_if(F.col("ends") > 1).alias("repeated_ends"),
            F.sum("inverted").alias("inverted"),
        )
        .filter(
            (F.col("chains") != 1)
            | (F.col("repeated_starts") > 0)
            | (F.col("repeated_ends") > 0)
            | (F.col("inverted") > 0)
        )
    )


def pattern_violations(df: DataFrame, column: str, contains: str) -> DataFrame:
    """Rows whose text lacks a fixed part; NULL counts as lacking it."""
    return df.filter(~F.coalesce(F.col(column).contains(contains), F.lit(False)))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each named frame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in frames.items()
    ]
    total = counted[0]
    for c in counted[1:]:
        total = total.unionByName(c)
    return total


def count_expectations(
    frames: Mapping[str, DataFrame], expected: Mapping[str, tuple[int | None, int | None]]
) -> DataFrame:
    """Rows of each frame against the least and the most it should have.

    None is no limit. ``met`` is false where the count lies outside.
    """
    limits = frames[next(iter(expected))].sparkSession.createDataFrame(
        [(n, *limits) for n, limits in expected.items()], "table_name string, least bigint, most bigint"
    )
    counted = row_counts({n: frames[n] for n in expected}).join(limits, "table_name")
    low = F.col("n") < F.coalesce("least", F.lit(0))
    high = F.coalesce(F.col("n") > F.col("most"), F.lit(False))
    return counted.select("table_name", "n", "least", "most", (~low & ~high).alias("met"))
