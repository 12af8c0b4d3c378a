"""Partitioned fact and summary tables whose days are replaced as wholes.

    fact     <table>/write=<token>/ingest_date=YYYY-MM-DD/<date>=K/
    summary  <table>/write=<token>/<date>=K/

Rows are written beside those that count; the zone's list (:mod:`.commits`) says
which directories do, and which dates each of them holds. So one date is read
from the directories that have it, and no listing grows with the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import files
from .commits import Part, State
from .layout import arrange

INGEST = "ingest_date"
DAY, DATE = "day", "date"
# Ids searched one by one (by Bloom filter) up to so many; more by so many ranges.
POINTS = 320
RANGES = 64
_PER_LIST = 10


def _below(spark: SparkSession, root: str, new: str, *levels: str) -> list[str]:
    """Directories a write has made, below the zone."""
    found = files.matching(spark, files.join(root, new, *[f"{c}=*" for c in levels]))
    return [files.join(new, *f.rstrip("/").split("/")[-len(levels):]) for f in found]


def write_days(
    df: DataFrame, state: State, table: str, days: Iterable[dt.date], schema: T.StructType,
    by: str, ids: str | None = None,
) -> State:
    """Write what some ingest days brought, instead of all they brought before.

    A rerun with a corrected feed thus leaves nothing of the first run behind;
    rows of other ingest days are not touched. With ``ids`` the rows of a file are
    sorted by that column and get Bloom filters on it, so that a search by id
    skips row groups.
    """
    schemas.assert_schema(df.schema, schema, table)
    new = state.new(table)
    sort = [INGEST, by, *([ids] if ids else [])]
    writer = arrange(df, gather=[INGEST, by], sort=sort).write.partitionBy(INGEST, by)
    if ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{ids}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    writer.parquet(files.join(state.root, new))
    held: dict[str, list[str]] = {}
    for path in _below(df.sparkSession, state.root, new, INGEST, by):
        day, value = (p.partition("=")[2] for p in path.split("/")[-2:])
        held.setdefault(day, []).append(value)
    parts = [
        Part(table, DAY, day, files.join(new, f"{INGEST}={day}"), tuple(sorted(values)))
        for day, values in held.items()
    ]
    return state.replacing(table, DAY, [d.isoformat() for d in days], parts)


def read_days(
    spark: SparkSession, state: State, table: str, schema: T.StructType, by: str,
    days: Collection[dt.date] | None = None, but: Collection[dt.date] = (),
    dates: Collection[int] | None = None,
) -> DataFrame:
    """Rows of a fact: of all ingest days or of ``days``, without those of ``but``,
    of all dates or of ``dates``. Only directories with such rows are opened."""
    wanted = None if days is None else {d.isoformat() for d in days}
    without = {d.isoformat() for d in but}
    keys = None if dates is None else {str(d) for d in dates}
    paths = []
    for part in state.of(table, DAY):
        if part.label in without or (wanted is not None and part.label not in wanted):
            continue
        if keys is None:
            paths.append(state.at(part))
        else:
            paths += [files.join(state.at(part), f"{by}={v}") for v in part.values if v in keys]
    if not paths:
        return spark.createDataFrame([], schema)
    base = files.join(state.root, table)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def dates_of(state: State, table: str, days: Collection[dt.date]) -> set[int]:
    """The dates that some ingest days hold rows of."""
    labels = {d.isoformat() for d in days}
    return {int(v) for p in state.of(table, DAY) if p.label in labels for v in p.values}


def write_dates(
    df: DataFrame, state: State, table: str, touched: Iterable[int], schema: T.StructType, by: str
) -> State:
    """Make the ``touched`` dates hold what ``df`` has for them, which may be nothing."""
    schemas.assert_schema(df.schema, schema, table)
    new = state.new(table)
    arrange(df, gather=[by]).write.partitionBy(by).parquet(files.join(state.root, new))
    parts = [
        Part(table, DATE, path.rpartition("=")[2], path)
        for path in _below(df.sparkSession, state.root, new, by)
    ]
    return state.replacing(table, DATE, [str(t) for t in touched], parts)


def read_dates(
    spark: SparkSession, state: State, table: str, schema: T.StructType,
    dates: Collection[int] | None = None,
) -> DataFrame:
    """Rows of a summary, of all dates or of some."""
    keys = None if dates is None else {str(d) for d in dates}
    paths = [state.at(p) for p in state.of(table, DATE) if keys is None or p.label in keys]
    if not paths:
        return spark.createDataFrame([], schema)
    base = files.join(state.root, table)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def append(df: DataFrame, state: State, table: str, label: str) -> State:
    """Add rows that will not be replaced, as one file."""
    new = state.new(table)
    df.coalesce(1).write.parquet(files.join(state.root, new))
    return state.replacing(table, DATE, [label], [Part(table, DATE, label, new)])


def read_appended(spark: SparkSession, state: State, table: str, schema: T.StructType) -> DataFrame | None:
    paths = [state.at(p) for p in state.of(table, DATE)]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def among(column: str, ids: DataFrame) -> Column:
    """A condition that holds for every id in ``ids`` and that Parquet can skip by.

    Few ids are named one by one, in lists short enough to be pushed down as
    equalities, which Bloom filters answer. Of many, the least and greatest in
    each of a number of equal ranges are named, which the statistics of sorted
    files answer. Either way the condition may let others pass.
    """
    few = ids.select(column).distinct().limit(POINTS + 1).collect()
    if not few:
        return F.lit(False)
    if len(few) <= POINTS:
        values = sorted(r[0] for r in few)
        tests = [F.col(column).isin(values[i : i + _PER_LIST]) for i in range(0, len(values), _PER_LIST)]
    else:
        lo, hi = ids.agg(F.min(column), F.max(column)).first()
        place = F.width_bucket(F.col(column).cast("double"), F.lit(float(lo)), F.lit(float(hi) + 1), F.lit(RANGES))
        limits = ids.groupBy(place).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        tests = [F.col(column).between(r["lo"], r["hi"]) for r in limits]
    while len(tests) > 1:  # in pairs, so that the tree stays flat
        tests = [reduce(Column.__or__, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]
