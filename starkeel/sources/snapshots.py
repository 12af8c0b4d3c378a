"""Dimension tables: a full current set per run, closed versions once.

    <table>/write=<token>/run_date=YYYY-MM-DD/is_current=true/    the full current set
    <table>/write=<token>/run_date=YYYY-MM-DD/is_current=false/   versions closed by that run

A run writes new directories and reads the last run strictly before its own
date; which directories count is said by the zone's list (:mod:`.commits`).
Closed versions are written once: a day costs the current set, not the history.
The table after run D is the current set of D plus the versions closed up to D.
Type-1 tables use the same layout without the ``is_current`` level.

Current sets of old runs are given up by :func:`free_old_current`, which leaves
their dates marked: such a run is never taken for an empty one, reading it raises
:class:`FreedRun`. The closed versions of freed runs can be put together by
month (:func:`compact_closed`), so that the number of directories grows with
months and not with days.
"""

from __future__ import annotations

import datetime as dt
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.keys import as_date, day_start
from . import files
from .commits import Part, State
from .layout import arrange

RUN = "run_date"
CURRENT, CLOSED, FREED = "current", "closed", "freed"
_FLAG = "is_current"
_MONTH = "closed_month"


class FreedRun(LookupError):
    """The current set of this run has been freed; it cannot be read any more."""


def run_dates(state: State, table: str) -> list[dt.date]:
    """Dates of the runs that count, ascending."""
    return sorted(dt.date.fromisoformat(p.label) for p in state.of(table, CURRENT, FREED))


def latest_run(state: State, table: str, before: str | dt.date | None = None) -> dt.date | None:
    """Last run, strictly before a date if one is given; ``None`` without history."""
    limit = as_date(before) if before is not None else dt.date.max
    return max((d for d in run_dates(state, table) if d < limit), default=None)


def _value(path: str, name: str) -> str:
    return next(p.partition("=")[2] for p in path.split("/") if p.startswith(name + "="))


def write_runs(
    df: DataFrame, state: State, table: str, days: list[dt.date], kept: list[dt.date],
    schema: T.StructType, sort: tuple[str, ...],
) -> State:
    """Write the rows of several runs, told apart by ``run_date``, in one job.

    ``kept`` are the days whose current set ``df`` holds; the current sets of the
    other days are freed from the start.
    """
    schemas.assert_schema(df.drop(RUN).schema, schema, table)
    spark, new = df.sparkSession, state.new(table)
    levels = [RUN, _FLAG] if _FLAG in schema.names else [RUN]
    rest = [c for c in sort if c not in levels]
    path = files.join(state.root, new)
    arrange(df, sort=[*levels, *rest]).write.partitionBy(*levels).parquet(path)
    current, closed = {}, {}
    for found in files.matching(spark, files.join(path, *[f"{c}=*" for c in levels])):
        own = files.join(new, *found.rstrip("/").split("/")[-len(levels):])
        of_run = closed if f"{_FLAG}=false" in own else current
        of_run[_value(own, RUN)] = own
    labels = [d.isoformat() for d in days]
    keep = [d.isoformat() for d in kept]
    state = state.replacing(table, CURRENT, labels, [Part(table, CURRENT, d, current.get(d, "")) for d in keep])
    state = state.replacing(table, FREED, labels, [Part(table, FREED, d) for d in labels if d not in keep])
    return state.replacing(table, CLOSED, labels, [Part(table, CLOSED, d, p, (d, d)) for d, p in closed.items()])


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Read directories with the declared schema; none give an empty frame.

    Each path holds rows of one flag value only, so the flag is not taken from
    the directory name but added by the caller.
    """
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_run(
    spark: SparkSession, state: State, table: str, day: str | dt.date, schema: T.StructType
) -> DataFrame:
    """The current set as written by one run; raises if it has been freed."""
    label = as_date(day).isoformat()
    part = next((p for p in state.of(table, CURRENT) if p.label == label), None)
    if part is None:
        raise FreedRun(f"run {label} of {table} has been freed; repeat the runs from an earlier one")
    stored = T.StructType([f for f in schema if f.name != _FLAG])
    rows = _read(spark, [state.at(part)] if part.path else [], stored)
    return rows.withColumn(_FLAG, F.lit(True)).select(*schema.names) if _FLAG in schema.names else rows


def read_closed(
    spark: SparkSession, state: State, table: str, up_to: str | dt.date, schema: T.StructType,
    ended_after: dt.date | None = None, end: str = "end_date",
) -> DataFrame:
    """Versions closed by the runs up to a date.

    A version ends on the run date that closed it, so ``ended_after`` skips
    whole directories: rows dated from that day on cannot match older versions.
    """
    last, first = as_date(up_to).isoformat(), ended_after.isoformat() if ended_after else ""
    stored = T.StructType([f for f in schema if f.name != _FLAG])
    parts = [p for p in state.of(table, CLOSED) if p.values[0] <= last and p.values[1] >= first]
    rows = _read(spark, [state.at(p) for p in parts], stored)
    if any(p.values[1] > last for p in parts):  # a month of which only the first days count
        rows = rows.filter(F.col(end) <= day_start(up_to))
    return rows.withColumn(_FLAG, F.lit(False)).select(*schema.names)


def read_table(
    spark: SparkSession, state: State, table: str, up_to: str | dt.date, schema: T.StructType,
    ended_after: dt.date | None = None,
) -> DataFrame | None:
    """The table after the last run up to a date; ``None`` without one."""
    last = latest_run(state, table, as_date(up_to) + dt.timedelta(days=1))
    if last is None:
        return None
    current = read_run(spark, state, table, last, schema)
    if _FLAG not in schema.names:
        return current
    return current.unionByName(read_closed(spark, state, table, last, schema, ended_after))


def free_old_current(state: State, table: str, keep: int) -> State:
    """Give up the current sets of all but the last ``keep`` + 1 runs.

    ``keep`` runs can then be repeated, the oldest of them from the one more that
    stays. Versions closed by freed runs stay, since every later state needs
    them; of Type-1 tables, which have none, the whole rows go.
    """
    if keep < 1:
        raise ValueError("at least one run must be kept")
    older = {d.isoformat() for d in run_dates(state, table)[: -keep - 1]}
    labels = [p.label for p in state.of(table, CURRENT) if p.label in older]
    freed = [Part(table, FREED, label) for label in labels]
    return state.replacing(table, CURRENT, labels).replacing(table, FREED, labels, freed)


def compact_closed(
    spark: SparkSession, state: State, table: str, schema: T.StructType, sort: tuple[str, ...],
    end: str = "end_date",
) -> State:
    """Put the closed versions of each whole month of freed runs into one directory.

    Freed runs are not repeated, so nothing will replace their versions. All
    months that are due are written by one job.
    """
    current = [p.label for p in state.of(table, CURRENT)]
    if not current:
        return state
    due = [p for p in state.of(table, CLOSED) if p.values[1][:7] < min(current)[:7]]
    months = {m: list(ps) for m, ps in groupby(due, key=lambda p: p.label[:7])}
    small = {m: ps for m, ps in months.items() if len(ps) > 1}
    if not small:
        return state
    stored = T.StructType([f for f in schema if f.name != _FLAG])
    new = state.new(table)
    rows = _read(spark, [state.at(p) for ps in small.values() for p in ps], stored)
    rows = rows.withColumn(_MONTH, F.date_format(end, "yyyy-MM"))
    rest = [c for c in sort if c != _FLAG]
    arrange(rows, gather=[_MONTH], sort=[_MONTH, *rest]).write.partitionBy(_MONTH).parquet(
        files.join(state.root, new)
    )
    for month, parts in small.items():
        labels = [p.label for p in parts]
        first, last = min(p.values[0] for p in parts), max(p.values[1] for p in parts)
        whole = Part(table, CLOSED, last, files.join(new, f"{_MONTH}={month}"), (first, last))
        state = state.replacing(table, CLOSED, labels, [whole])
    return state


def places(state: State, table: str, day: dt.date, schema: T.StructType) -> list[tuple[str, dict[str, str]]]:
    """Directories of the table after a run, and what their files leave out, as SQL."""
    label, flagged = day.isoformat(), _FLAG in schema.names
    current = [state.at(p) for p in state.of(table, CURRENT) if p.label == label and p.path]
    closed = [state.at(p) for p in state.of(table, CLOSED) if p.values[1] <= label]
    return [(p, {_FLAG: "true"} if flagged else {}) for p in current] + [(p, {_FLAG: "false"}) for p in closed]
