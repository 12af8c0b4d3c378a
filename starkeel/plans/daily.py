"""The daily run: raw feeds of one date or several into dimensions, fact and summary."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import date_key
from ..functions.keys import as_date
from ..lineage import staged
from ..operators import quality
from ..operators.conform import CORRUPT, REASON, RECEIVED, TYPED, judged
from ..operators.dedup import latest
from ..operators.facts import (
    calendar,
    daily_sales,
    date_dimension,
    fact_rows,
    negated,
    resolve_orders,
    summed,
    unmatched,
)
from ..operators.runs import RUN, scd1_states, scd1_tables, scd2_known, scd2_states, scd2_tables
from ..operators.scd2 import CUSTOMERS
from ..sources import catalog, commits, facts, files, snapshots
from ..sources.commits import Part, State
from ..sources.raw import read_days
from .session import require_utc

log = logging.getLogger(__name__)

# Orders of one customer or product beyond this many are split over tasks.
ROWS_PER_SLICE = 2_000_000
# By default, orders dated before this day, or later than so many days after
# their run, are set aside: they bound the calendar.
FIRST_ORDER_DAY = dt.date(1970, 1, 1)
DAYS_AHEAD = 366
OUT_OF_RANGE = "order_date_out_of_range"
ALREADY_STORED = "already_stored"
# Runs that stay repeatable; older current sets are freed.
RUNS_KEPT = 30

FACT, SUMMARY, CALENDAR = "fact_orders", "summary_daily_sales", "dim_date"
BY = "order_date_key"
_UNMATCHED = "unmatched_orders"


class CheckFailed(ValueError):
    """A run broke declared rules and was not committed; ``violations`` counts by rule."""

    def __init__(self, violations: Mapping[str, int]):
        self.violations = dict(violations)
        super().__init__(", ".join(f"{n}: {k}" for n, k in sorted(self.violations.items())))


@dataclass(frozen=True)
class Curated:
    """Where the tables of one curated zone live."""

    root: str

    @property
    def staging(self) -> str:
        """For tables that live as long as one step: beside the zone, hence shared."""
        return files.join(self.root, "_staging")

    def state(self, spark: SparkSession) -> State:
        """What counts now: see :mod:`starkeel.sources.commits`."""
        return commits.latest(spark, self.root)


@dataclass
class _Run:
    """One call: what it reads, what counts when it began, and what it has written so far."""

    spark: SparkSession
    raw: str
    zone: Curated
    days: list[dt.date]
    before: State
    after: State
    rows_per_slice: int | None
    runs_kept: int | None
    first_order_day: dt.date
    days_ahead: int
    expected: Mapping[str, tuple[int | None, int | None]]
    checks: bool
    steps: ExitStack
    seen: list[tuple[str, Observation]] = field(default_factory=list)

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """Stored until the call ends."""
        return self.steps.enter_context(staged(df, name, self.zone.staging))

    def watched(self, df: DataFrame, name: str, counts: Mapping[str, Column], day: str) -> DataFrame:
        """Count what breaks the rules while the frame is written."""
        if not self.checks:
            return df
        if name in self.expected:
            counts = {**counts, **{f"rows_{d}": F.count_if(F.col(day) == F.lit(d)) for d in self.days}}
        if not counts:
            return df
        df, seen = quality.watched(df, counts)
        self.seen.append((name, seen))
        return df

    def declared(self, df: DataFrame, name: str, day: str) -> DataFrame:
        """Watch the rules declared for a table."""
        rules = schemas.CONSTRAINTS[name]
        counts = quality.measures(rules.not_null, rules.max_length, schemas.RANGES.get(name))
        return self.watched(df, name, counts, day)

    def violations(self) -> dict[str, int]:
        found = {}
        for name, seen in self.seen:
            least, most = self.expected.get(name, (None, None))
            none = {f"rows_{d}": 0 for d in self.days if name in self.expected}
            for rule, n in (none | quality.counted(seen)).items():
                if rule.startswith("rows_"):
                    if (least is not None and n < least) or (most is not None and n > most):
                        found[f"{name}.{rule}"] = n
                elif n:
                    found[f"{name}.{rule}"] = n
        return found

    def kept(self, table: str) -> list[dt.date]:
        """The days of this call whose whole dimension is kept."""
        if self.runs_kept is None:
            return self.days
        runs = sorted({*snapshots.run_dates(self.before, table), *self.days})
        return [d for d in self.days if d in runs[-self.runs_kept - 1 :]]

    def rerun(self) -> bool:
        return any(d in self.days for d in snapshots.run_dates(self.before, "dim_customers"))


def _set_aside(run: _Run, rows: DataFrame, name: str) -> None:
    """Write rows that are not stored, with their ``run_date`` and reason, beside the tables."""
    table = files.join("quarantine", name)
    new = run.after.new(table)
    path = files.join(run.zone.root, new)
    rows.write.partitionBy(RUN).parquet(path)
    have = {p.rstrip("/").rpartition("=")[2] for p in files.matching(run.spark, files.join(path, f"{RUN}=*"))}
    labels = [d.isoformat() for d in run.days]
    parts = [Part(table, facts.DAY, d, files.join(new, f"{RUN}={d}") if d in have else "") for d in labels]
    run.after = run.after.replacing(table, facts.DAY, labels, parts)


def quarantined(spark: SparkSession, zone: Curated, name: str, day: str | dt.date) -> DataFrame | None:
    """Rows of a feed, or resolved orders, that a run set aside; ``None`` if it has not run."""
    state, table, label = zone.state(spark), files.join("quarantine", name), as_date(day).isoformat()
    part = next((p for p in state.of(table) if p.label == label), None)
    if part is None:
        return None
    reason = T.StructField(REASON, T.StringType())
    if name == _UNMATCHED:
        schema = T.StructType([*schemas.ORDER, reason])
    else:
        text = schemas.all_text(schemas.FEEDS[name])
        schema = T.StructType([*text, T.StructField(CORRUPT, T.StringType()), reason])
    rows = spark.read.schema(schema)
    return rows.parquet(state.at(part)) if part.path else spark.createDataFrame([], schema)


def _feed(run: _Run, name: str, key: str, order_by: str) -> DataFrame:
    """Typed rows of a feed, the last of each key and day; the unusable ones are set aside.

    The text is parsed once: accepted and rejected rows are read from one stored table.
    """
    schema = schemas.FEEDS[name]
    text = read_days(run.spark, run.raw, name, run.days).withColumnRenamed("ingest_date", RUN)
    rows = judged(text, schema, schemas.REQUIRED[name], keep=[RUN])
    decimals = [f.name for f in schema if isinstance(f.dataType, T.DecimalType)]
    counts = quality.overflows(
        {c: F.col(f"{TYPED}.{c}") for c in decimals}, {c: F.col(f"{RECEIVED}.{c}") for c in decimals}
    )
    rows = run.staged(run.watched(rows, name, counts, RUN), name)
    _set_aside(run, rows.filter(F.col(REASON) != "").select(f"{RECEIVED}.*", REASON, RUN), name)
    good = rows.filter(F.col(REASON) == "").select(f"{TYPED}.*", RUN)
    return latest(good, [key, RUN], [order_by])


def load_customers(run: _Run) -> DataFrame:
    """Write the Type-2 dimension after each day; returns the states of its rows."""
    name, schema = "dim_customers", schemas.DIM_CUSTOMERS
    last = snapshots.latest_run(run.before, name, before=run.days[0])
    current = None if last is None else snapshots.read_run(run.spark, run.before, name, last, schema)
    sent = _feed(run, "customers", "customer_id", "updated_at")
    states = run.staged(scd2_states(current, sent, CUSTOMERS), "customers")
    kept = run.kept(name)
    rows = scd2_tables(states, kept, CUSTOMERS).select(*schema.names, RUN)
    run.after = snapshots.write_runs(
        run.declared(rows, name, RUN), run.after, name, run.days, kept, schema, schemas.SORTED_BY[name]
    )
    return states


def load_products(run: _Run) -> DataFrame:
    """Write the Type-1 dimension after each day; returns the states of its rows."""
    name, schema = "dim_products", schemas.DIM_PRODUCTS
    last = snapshots.latest_run(run.before, name, before=run.days[0])
    current = None if last is None else snapshots.read_run(run.spark, run.before, name, last, schema)
    sent = _feed(run, "products", "product_id", "updated_at")
    states = run.staged(scd1_states(current, sent, "product_id", "product_key"), "products")
    kept = run.kept(name)
    rows = scd1_tables(states, kept).select(*schema.names, RUN)
    run.after = snapshots.write_runs(
        run.declared(rows, name, RUN), run.after, name, run.days, kept, schema, schemas.SORTED_BY[name]
    )
    return states


def cover_dates(spark: SparkSession, state: State, lo: dt.date, hi: dt.date) -> tuple[State, DataFrame]:
    """The date dimension, extended by whole years if it does not reach.

    Years are only ever added.
    """
    stored = facts.read_appended(spark, state, CALENDAR, schemas.DIM_DATE)
    years = [int(y) for p in state.of(CALENDAR) for y in p.label.split("-")]
    missing = [(lo.year, hi.year)]
    if stored is not None:
        missing = [(lo.year, min(years) - 1), (max(years) + 1, hi.year)]
    for a, b in missing:
        if a <= b:
            span = spark.createDataFrame([(dt.date(a, 1, 1), dt.date(b, 12, 31))], "lo date, hi date")
            days = date_dimension(calendar(span)).sortWithinPartitions("date")
            state = facts.append(days, state, CALENDAR, f"{a}-{b}")
    return state, facts.read_appended(spark, state, CALENDAR, schemas.DIM_DATE)


def _first_stored(resolved: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Mark, for an order id that several days sent, what the first day that could store it stored."""
    ok = F.col("customer_key").isNotNull() & F.col("product_key").isNotNull()
    mine = F.when(ok, F.struct(RUN, "now"))
    if len(days) > 1:
        mine = F.min(mine).over(Window.partitionBy("order_id"))
    return resolved.withColumn("__ok", ok).withColumn("__first", mine)


def load_facts(run: _Run, customers: DataFrame, products: DataFrame) -> None:
    """Store each day's orders, instead of those an earlier run of the day stored.

    An order that an earlier ingest day stored is not stored again; if anything
    in it differs from what is stored, it is set aside. The stored table is read
    by columns, and only where its row groups may hold an id that was sent.
    """
    spark = run.spark
    orders = run.staged(_feed(run, "orders", "order_id", "order_date"), "orders")
    last = F.date_add(F.col(RUN), run.days_ahead)
    placed = F.col("order_date").between(F.lit(run.first_order_day), last)
    compared = [BY, "quantity", "total_amount", "order_status"]
    far = orders.filter(~placed).withColumn(REASON, F.lit(OUT_OF_RANGE))
    near = orders.filter(placed)
    again = near.withColumn("was", F.lit(None).cast("struct<a:int>"))
    if any(p.label not in {d.isoformat() for d in run.days} for p in run.before.of(FACT, facts.DAY)):
        stored = facts.read_days(spark, run.before, FACT, schemas.FACT_ORDERS, BY, but=run.days)
        known = stored.filter(facts.among("order_id", near)).select("order_id", F.struct(*compared).alias("was"))
        again = near.join(known, "order_id", "left")
    now = F.struct(date_key(F.col("order_date")).alias(BY), *compared[1:])
    again = again.withColumn("now", now)
    differs = F.col("was").isNotNull() & ~F.col("was").cast("string").eqNullSafe(F.col("now").cast("string"))
    changed = again.filter(differs).withColumn(REASON, F.lit(ALREADY_STORED))
    fresh = again.filter(F.col("was").isNull()).drop("was")
    lo = near.agg(F.min("order_date")).first()[0]
    # Versions that ended before the first order cannot match: the directories
    # that hold them are not opened.
    before = snapshots.latest_run(run.before, "dim_customers", before=run.days[0])
    closed = None
    if before is not None and lo is not None:
        closed = snapshots.read_closed(spark, run.before, "dim_customers", before, schemas.DIM_CUSTOMERS, lo)
    resolved = resolve_orders(
        fresh, scd2_known(customers, closed, CUSTOMERS), products, rows_per_slice=run.rows_per_slice, seen=RUN,
        stage=run.staged,
    )
    resolved = resolved.withColumn("now", now)
    resolved = run.staged(_first_stored(resolved, run.days), "resolved")
    earlier = F.col("__first").isNotNull() & (F.col(f"__first.{RUN}") < F.col(RUN))
    repeated = resolved.filter(earlier & (F.col("__first.now") != F.col("now"))).withColumn(
        REASON, F.lit(ALREADY_STORED)
    )
    columns = [*schemas.ORDER.names, REASON, RUN]
    lost = unmatched(resolved.filter(~earlier), RUN).select(*columns)
    for other in (far, changed, repeated):
        lost = lost.unionByName(other.select(*columns))
    _set_aside(run, lost, _UNMATCHED)
    rows = resolved.filter(F.col("__ok") & (F.col(f"__first.{RUN}") == F.col(RUN)))
    rows = fact_rows(rows, RUN).withColumnRenamed(RUN, facts.INGEST)
    run.after = facts.write_days(
        run.declared(rows, FACT, facts.INGEST), run.after, FACT, run.days, schemas.FACT_ORDERS, BY, "order_id"
    )


def _moved(run: _Run, name: str, key: str, column: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys of a dimension whose ``column`` is another than before this run."""
    a = old.select(key, F.struct(column).alias("a"))
    b = new.select(key, F.struct(column).alias("b"))
    # Only repeated days can take a key away, or bring back one that facts refer to.
    both = a.join(b, key, "full_outer" if run.rerun() else "inner")
    return run.staged(both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(key), f"moved-{name}")


def refresh_summary(run: _Run) -> None:
    """Bring the summary up to date by what changed: rows taken away and rows added.

    Of the fact, the rows these days stored before count as taken away and those
    they store now as added; rows of other days only if their customer version
    or product now has another state or category. The sums are added to the
    stored dates they touch, so the result is that of a rebuild.
    """
    spark, days = run.spark, run.days
    last = snapshots.latest_run(run.before, "dim_customers")
    dims = {}
    for when, state, day in (("old", run.before, last), ("new", run.after, days[-1])):
        if day is not None:
            dims[when] = tuple(
                snapshots.read_table(spark, state, name, day, schemas.TABLES[name])
                for name in ("dim_customers", "dim_products")
            )
    touched = facts.dates_of(run.before, FACT, days) | facts.dates_of(run.after, FACT, days)
    if touched:
        limits = [dt.datetime.strptime(str(f(touched)), "%Y%m%d").date() for f in (min, max)]
        run.after, _ = cover_dates(spark, run.after, *limits)
    dates = facts.read_appended(spark, run.after, CALENDAR, schemas.DIM_DATE)
    if dates is None:
        return

    def fact(state: State, **which) -> DataFrame:
        return facts.read_days(spark, state, FACT, schemas.FACT_ORDERS, BY, **which)

    def sales(rows: DataFrame, when: str) -> DataFrame:
        found = daily_sales(
            rows, *dims[when], dates, rows_per_slice=run.rows_per_slice, orders_unique=True,
            stage=run.staged,
        )
        return found if when == "new" else negated(found)

    changes = []
    if facts.dates_of(run.after, FACT, days):
        changes.append(sales(fact(run.after, days=days), "new"))
    if facts.dates_of(run.before, FACT, days):
        changes.append(sales(fact(run.before, days=days), "old"))
    labels = {d.isoformat() for d in days}
    if "old" in dims and any(p.label not in labels for p in run.before.of(FACT, facts.DAY)):
        found = {"product_key": _moved(run, "products", "product_key", "category", dims["old"][1], dims["new"][1])}
        if run.rerun():
            found["customer_key"] = _moved(run, "customers", "customer_key", "state", dims["old"][0], dims["new"][0])
        found = {key: moved for key, moved in found.items() if not moved.isEmpty()}
        if found:
            rest, any_moved = fact(run.after, but=days), F.lit(False)
            for key, moved in found.items():
                rest = rest.join(moved.withColumn(f"__{key}", F.lit(True)), key, "left")
                any_moved = any_moved | F.col(f"__{key}").isNotNull()
            rest = run.staged(rest.filter(any_moved).select(*schemas.FACT_ORDERS.names), "moved-orders")
            changes += [sales(rest, "new"), sales(rest, "old")]
    if not changes:
        return
    like = run.spark.createDataFrame([], schemas.DAILY_SALES)
    delta = changes[0]
    for change in changes[1:]:
        delta = delta.unionByName(change)
    groups = [f.name for f in schemas.DAILY_SALES if not f.name.startswith("total_")]
    totals = [f.name for f in schemas.DAILY_SALES if f.name.startswith("total_")]
    delta = delta.groupBy(*groups).agg(*[F.sum(c).cast(like.schema[c].dataType).alias(c) for c in totals])
    changed = F.lit(False)
    for c in totals:
        changed = changed | (F.col(c) != 0) | F.col(c).isNull()
    delta = run.staged(delta.filter(changed), "delta")
    # One row for each calendar day at most.
    touched = {r[0] for r in delta.select(BY).distinct().collect()}
    if not touched:
        return
    stored = facts.read_dates(spark, run.before, SUMMARY, schemas.DAILY_SALES, touched)
    merged = summed(stored.unionByName(delta.select(*stored.columns)), like).select(*like.columns)
    run.after = facts.write_dates(merged, run.after, SUMMARY, touched, schemas.DAILY_SALES, BY)


def register_tables(spark: SparkSession, zone: Curated) -> None:
    """Define the zone's tables in the catalog, as of the last commit, for every session.

    Fact and summary are partitioned tables, the dimensions and the calendar
    views over the directories that count.
    """
    state = zone.state(spark)
    catalog.partitioned(spark, state, FACT, (facts.INGEST, BY))
    catalog.partitioned(spark, state, SUMMARY, (BY,))
    if state.of(CALENDAR):
        catalog.view(spark, CALENDAR, schemas.DIM_DATE, [(state.at(p), {}) for p in state.of(CALENDAR)])
    for name in ("dim_customers", "dim_products"):
        last = snapshots.latest_run(state, name)
        if last is not None:
            schema = schemas.TABLES[name]
            catalog.view(spark, name, schema, snapshots.places(state, name, last, schema))


def run_daily(spark: SparkSession, run_date: str | dt.date, raw: str, curated: str, **options) -> Curated:
    """Customers, products, orders, summary of one date; see :func:`backfill`."""
    return backfill(spark, [run_date], raw, curated, **options)


def _refuse_gaps(state: State, days: list[dt.date]) -> None:
    """History builds on the run before: no later run may be left out."""
    later = {
        d
        for name in ("dim_customers", "dim_products")
        for d in snapshots.run_dates(state, name)
        if d > days[0] and d not in days
    }
    if later:
        raise ValueError(
            "later runs would rest on replaced history, include them: "
            + ", ".join(d.isoformat() for d in sorted(later))
        )


def backfill(
    spark: SparkSession, run_dates: Iterable[str | dt.date], raw: str, curated: str,
    rows_per_slice: int | None = ROWS_PER_SLICE, register: bool = False,
    runs_kept: int | None = RUNS_KEPT,
    first_order_day: dt.date = FIRST_ORDER_DAY, days_ahead: int = DAYS_AHEAD,
    expected: Mapping[str, tuple[int | None, int | None]] | None = None,
    checks: bool = True, refuse: bool = True,
) -> Curated:
    """Run one date or several, in one pass: the number of jobs does not grow with the days.

    The tables of all dates become visible together, by one commit at the end; a
    run that fails or is killed leaves everything as it was. Repeating a date,
    also with corrected feeds, replaces what it stored. History builds on the
    run before, so repeating a date means repeating every later one that has run.

    While tables are written, the declared rules are checked on the way; with
    ``refuse`` a run that breaks one raises :class:`CheckFailed` and is not
    committed, otherwise it is logged. ``expected`` gives the least and most rows
    a feed or the fact may have per day. Current sets beyond the last
    ``runs_kept`` runs are freed. Orders dated before ``first_order_day`` or more
    than ``days_ahead`` days after their run are set aside. ``register`` also
    defines the tables in the catalog.
    """
    require_utc(spark)
    days = sorted({as_date(d) for d in run_dates})
    if not days:
        raise ValueError("no dates given")
    zone = Curated(curated)
    before = zone.state(spark)
    _refuse_gaps(before, days)
    with ExitStack() as steps:
        run = _Run(
            spark, raw, zone, days, before, before, rows_per_slice, runs_kept, first_order_day, days_ahead,
            expected or {}, checks, steps,
        )
        try:
            log.info("running %s to %s", days[0], days[-1])
            customers = load_customers(run)
            products = load_products(run)
            load_facts(run, customers, products)
            refresh_summary(run)
            found = run.violations()
            if found and refuse:
                raise CheckFailed(found)
            if found:
                log.warning("rules broken: %s", CheckFailed(found))
            if runs_kept is not None:
                for name in ("dim_customers", "dim_products"):
                    run.after = snapshots.free_old_current(run.after, name, runs_kept)
                run.after = snapshots.compact_closed(
                    spark, run.after, "dim_customers", schemas.DIM_CUSTOMERS, schemas.SORTED_BY["dim_customers"]
                )
            commits.commit(spark, before, run.after)
        except BaseException:
            commits.discard(spark, before, run.after)
            raise
    commits.sweep(spark, zone.root)
    if register:
        register_tables(spark, zone)
    return zone


def read_table(
    spark: SparkSession, zone: Curated, name: str, up_to: str | dt.date = dt.date.max - dt.timedelta(days=1),
) -> DataFrame | None:
    """A table of the zone as of the last commit; dimensions as after the last run up to a date."""
    state, schema = zone.state(spark), schemas.TABLES[name]
    if name in ("dim_customers", "dim_products"):
        return snapshots.read_table(spark, state, name, up_to, schema)
    if not state.of(name):
        return None
    if name == CALENDAR:
        return facts.read_appended(spark, state, name, schema)
    return (
        facts.read_days(spark, state, name, schema, BY) if name == FACT
        else facts.read_dates(spark, state, name, schema)
    )


def check_zone(spark: SparkSession, curated: str, up_to: str | dt.date) -> dict[str, DataFrame]:
    """The declared constraints of a curated zone, as frames of violations.

    Every frame is empty when the zone is sound.
    """
    zone = Curated(curated)
    tables = {
        name: read_table(spark, zone, name, up_to)
        for name in ("dim_customers", "dim_products", CALENDAR, FACT)
    }
    found: dict[str, DataFrame] = {}
    for name, rules in schemas.CONSTRAINTS.items():
        table = tables[name]
        if table is None:
            continue
        found[f"{name}.key"] = quality.key_violations(table, rules.primary_key)
        found[f"{name}.null"] = quality.null_counts(table, rules.not_null).filter("nulls > 0")
        if rules.max_length:
            found[f"{name}.length"] = quality.length_report(table, rules.max_length).filter(
                "too_long > 0"
            )
        for column, (parent, key) in rules.foreign_keys.items():
            if tables[parent] is not None:
                found[f"{name}.{column}"] = quality.fk_violations(
                    table, tables[parent], column, key
                )
    for name, limits in schemas.RANGES.items():
        if tables[name] is not None:
            for column, (least, most) in limits.items():
                outside = F.lit(False)
                if least is not None:
                    outside = outside | (F.col(column) < F.lit(least))
                if most is not None:
                    outside = outside | (F.col(column) > F.lit(most))
                found[f"{name}.{column}.range"] = tables[name].filter(outside)
    if tables["dim_customers"] is not None:
        dim = tables["dim_customers"]
        found["dim_customers.current"] = quality.current_flag_violations(dim, "customer_id")
        found["dim_customers.continuity"] = quality.continuity_violations(dim, "customer_id")
    return found
