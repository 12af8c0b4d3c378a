"""Several runs of a dimension in one pass.

All batches are put together with the rows that are current before the first
run, and shuffled once by key. A key then has one row for each run that sent it,
in date order, and every row says from which run on it is what the dimension
holds of the key, and until which. From these states the tables after any of the
runs follow, as well as what a run knew of a key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import id_key, open_end, version_key
from .scd2 import OVERWRITE, Scd2

RUN = "run_date"
# The run that wrote a state (NULL: before the first) and the run that replaced it.
SINCE, UNTIL = "since_run", "until_run"
# The run that closed the version a state belongs to, and whether the state begins it.
CLOSED_BY, OPENS = "closed_by", "opens"


def scd2_states(
    current: DataFrame | None, sent: DataFrame, spec: Scd2
) -> DataFrame:
    """States of a Type-2 dimension over the runs in ``sent``.

    ``current`` are the versions open before, None if the first run is the first
    ever; ``sent`` holds the batches, one row per key and ``run_date``. The
    result has the columns of the dimension without end and flag, and the runs.
    """
    begun = F.to_timestamp(spec.start_from)
    batch = sent.select(
        spec.key, *dict.fromkeys((*spec.attributes, spec.start_from, spec.updated)), RUN,
        F.lit(None).cast("string").alias(spec.surrogate), F.lit(None).cast("timestamp").alias(spec.start),
    )
    rows = batch
    if current is not None:
        before = current.select(
            spec.key, *spec.attributes, spec.updated, spec.surrogate, spec.start,
            F.lit(None).cast("date").alias(RUN),
        )
        rows = batch.unionByName(before, allowMissingColumns=True)
    runs = Window.partitionBy(spec.key).orderBy(RUN)
    is_first = F.row_number().over(runs) == 1
    differs = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.lag(c).over(runs)) for c in spec.tracked])
    run_ts = F.col(RUN).cast("timestamp")
    own = begun
    if spec.new_from == "run_date" and current is not None:
        own = run_ts
    elif spec.new_from == "run_date":
        # Only the very first run takes the start column.
        own = F.when(F.col(RUN) == F.lit(sent.agg(F.min(RUN)).first()[0]), begun).otherwise(run_ts)
    rows = rows.withColumn("__first", is_first).withColumn(OPENS, F.col("__first") | differs)
    if spec.untracked != OVERWRITE:
        rows = rows.filter(OPENS)  # the others change nothing
    begin = F.when(F.col(RUN).isNull(), F.col(spec.start)).when(F.col("__first"), own).otherwise(run_ts)
    version = Window.partitionBy(spec.key).orderBy(RUN).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(spec.key).orderBy(RUN).rowsBetween(1, Window.unboundedFollowing)
    start = F.last(F.when(F.col(OPENS), begin), ignorenulls=True).over(version)
    rows = rows.withColumns({
        UNTIL: F.lead(RUN).over(runs),
        CLOSED_BY: F.min(F.when(F.col(OPENS), F.col(RUN))).over(later),
        "__begin": start,
        "__key": F.last(F.when(F.col(OPENS), F.coalesce(spec.surrogate, F.lit(""))), ignorenulls=True).over(version),
    })
    key = F.when(F.col("__key") != "", F.col("__key")).otherwise(version_key(F.col(spec.key), F.col("__begin")))
    return rows.select(
        key.alias(spec.surrogate), spec.key, *spec.attributes, F.col("__begin").alias(spec.start), spec.updated,
        F.col(RUN).alias(SINCE), UNTIL, CLOSED_BY, OPENS,
    )


def _held(days: Sequence[dt.date]) -> Column:
    """The days of ``days`` on which a state is the current one."""
    listed = F.array(*[F.lit(d) for d in days]) if days else F.array().cast("array<date>")
    return F.filter(
        listed,
        lambda d: (F.col(SINCE).isNull() | (F.col(SINCE) <= d)) & (F.col(UNTIL).isNull() | (F.col(UNTIL) > d)),
    )


def scd2_tables(states: DataFrame, kept: Sequence[dt.date], spec: Scd2) -> DataFrame:
    """Per run its current set, for the days in ``kept``, and the versions it closed, for all."""
    closing = F.col(UNTIL).isNotNull() & (F.col(UNTIL) == F.col(CLOSED_BY))
    at = F.col(UNTIL).cast("timestamp")

    def row(run: Column, end: Column, current: bool, updated: Column) -> Column:
        return F.struct(
            run.alias(RUN), end.alias(spec.end), F.lit(current).alias(spec.current), updated.alias("__updated")
        )

    copies = F.concat(
        F.transform(_held(kept), lambda d: row(d, open_end(), True, F.col(spec.updated))),
        F.when(closing, F.array(row(F.col(UNTIL), at, False, at))).otherwise(
            F.array().cast(f"array<struct<{RUN}:date,{spec.end}:timestamp,{spec.current}:boolean,__updated:timestamp>>")
        ),
    )
    base = [spec.surrogate, spec.key, *spec.attributes, spec.start]
    rows = states.select(*base, F.inline(copies))
    return rows.select(*base, spec.end, spec.current, F.col("__updated").alias(spec.updated), RUN)


def scd2_known(states: DataFrame, closed: DataFrame | None, spec: Scd2, columns: Sequence[str] = ()) -> DataFrame:
    """Every version with the run that first knew it: key, surrogate, start, end, ``since_run``.

    The end is the open one until the run that closed the version, so that a fact
    seen at an earlier run has to be compared with the day of that run.
    """
    end = F.coalesce(F.col(CLOSED_BY).cast("timestamp"), open_end()).alias(spec.end)
    named = [spec.key, spec.surrogate, spec.start]
    versions = states.filter(OPENS).select(*named, end, SINCE, *columns)
    if closed is None:
        return versions
    older = closed.select(*named, spec.end, F.lit(None).cast("date").alias(SINCE), *columns)
    return versions.unionByName(older)


def scd1_states(current: DataFrame | None, sent: DataFrame, key: str, surrogate: str) -> DataFrame:
    """States of a Type-1 dimension over the runs in ``sent``: whole rows, the last one counts."""
    names = [c for c in sent.columns if c != RUN]
    rows = sent
    if current is not None:
        rows = sent.unionByName(current.select(*names).withColumn(RUN, F.lit(None).cast("date")))
    runs = Window.partitionBy(key).orderBy(RUN)
    return rows.select(
        id_key(F.col(key)).alias(surrogate), *names, F.col(RUN).alias(SINCE), F.lead(RUN).over(runs).alias(UNTIL)
    )


def scd1_tables(states: DataFrame, kept: Sequence[dt.date]) -> DataFrame:
    """Per run, for the days in ``kept``, the whole table."""
    names = [c for c in states.columns if c not in (SINCE, UNTIL)]
    return states.select(*names, F.explode(_held(kept)).alias(RUN))
