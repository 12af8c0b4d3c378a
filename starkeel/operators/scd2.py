"""Type-2 dimensions: every change of a tracked column opens a new version."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import day_start, open_end, version_key
from .merge import match

_RUN, _RUN_TS = "__run", "__run_ts"
KEEP_HISTORY = "history"
OVERWRITE = "overwrite"

NEW, CHANGED, UNCHANGED, ABSENT = "new", "changed", "unchanged", "absent"


@dataclass(frozen=True)
class Scd2:
    """What makes a table a Type-2 dimension.

    ``untracked`` says what a batch does to columns that are not tracked when
    no tracked column changed: ``history`` keeps the stored values,
    ``overwrite`` updates the current version in place. ``new_from`` says where
    the first version of a key begins: at its own start column or at the run
    date (for keys that come back after all their versions were closed).
    """

    key: str
    surrogate: str
    attributes: tuple[str, ...]
    tracked: tuple[str, ...]
    start_from: str
    updated: str = "updated_at"
    start: str = "start_date"
    end: str = "end_date"
    current: str = "is_current"
    untracked: str = KEEP_HISTORY
    new_from: str = "start_column"

    @property
    def columns(self) -> list[str]:
        return [
            self.surrogate, self.key, *self.attributes, self.start, self.end,
            self.current, self.updated,
        ]


CUSTOMERS = Scd2(
    key="customer_id",
    surrogate="customer_key",
    attributes=("name", "email", "phone", "address", "city", "state", "signup_date"),
    tracked=("address", "city", "state"),
    start_from="signup_date",
)


def scd2_init(batch: DataFrame, spec: Scd2 = CUSTOMERS) -> DataFrame:
    """First load: one open version per row, valid from its start column."""
    begin = F.to_timestamp(spec.start_from)
    return batch.select(
        version_key(F.col(spec.key), begin).alias(spec.surrogate),
        spec.key,
        *spec.attributes,
        begin.alias(spec.start),
        open_end().alias(spec.end),
        F.lit(True).alias(spec.current),
        spec.updated,
    )


def current_rows(dim: DataFrame, spec: Scd2 = CUSTOMERS) -> DataFrame:
    return dim.filter(F.col(spec.current))


def closed_rows(dim: DataFrame, spec: Scd2 = CUSTOMERS) -> DataFrame:
    return dim.filter(~F.col(spec.current))


def _compare(current: DataFrame, batch: DataFrame, spec: Scd2):
    """The pairs of a merge and the conditions on them.

    Comparison is null-safe: a value appearing or vanishing is a change.
    """
    pairs, stored, sent = match(current, batch, spec.key)
    differs = reduce(
        Column.__or__,
        [~F.col(f"h.{c}").eqNullSafe(F.col(f"n.{c}")) for c in spec.tracked],
    )
    return pairs, stored, sent, stored & sent & differs


def scd2_apply(
    current: DataFrame, batch: DataFrame, run_date: str | dt.date,
    spec: Scd2 = CUSTOMERS,
) -> DataFrame:
    """Merge a batch into the current versions.

    Returns the new current set and the versions closed by this run. Versions
    closed earlier take no part: they never change and need not be read. Each
    joined row becomes an array of its old and its new version, which ``inline``
    turns back into rows, so both come out of a single join.
    """
    joined, stored, sent, changed = _compare(current, batch, spec)
    run_ts = day_start(run_date)
    own_start = run_ts if spec.new_from == "run_date" else F.to_timestamp(f"n.{spec.start_from}")
    begin = F.when(stored, run_ts).otherwise(own_start)

    def kept(c: str) -> Column:
        refreshed = F.when(sent & ~changed, F.col(f"n.{c}"))
        return refreshed.otherwise(F.col(f"h.{c}")).alias(c)

    follow = spec.untracked == OVERWRITE
    updated = kept(spec.updated) if follow else F.col(f"h.{spec.updated}")
    old = F.struct(
        f"h.{spec.surrogate}",
        f"h.{spec.key}",
        *[kept(c) if follow else f"h.{c}" for c in spec.attributes],
        f"h.{spec.start}",
        F.when(changed, run_ts).otherwise(F.col(f"h.{spec.end}")).alias(spec.end),
        (~changed).alias(spec.current),
        F.when(changed, run_ts).otherwise(updated).alias(spec.updated),
    )
    new = F.struct(
        version_key(F.col(f"n.{spec.key}"), begin).alias(spec.surrogate),
        f"n.{spec.key}",
        *[f"n.{c}" for c in spec.attributes],
        begin.alias(spec.start),
        open_end().alias(spec.end),
        F.lit(True).alias(spec.current),
        f"n.{spec.updated}",
    )
    versions = F.array(F.when(stored, old), F.when(sent & (~stored | changed), new))
    # A missing version inlines as a row of NULLs; the flag is never NULL in a
    # real one.
    return joined.select(F.inline(versions)).filter(F.col(spec.current).isNotNull())


def scd2_merge(
    history: DataFrame, batch: DataFrame, run_date: str | dt.date,
    spec: Scd2 = CUSTOMERS,
) -> DataFrame:
    """The whole table after a run: earlier closed versions and the merge."""
    merged = scd2_apply(current_rows(history, spec), batch, run_date, spec)
    return closed_rows(history, spec).select(*spec.columns).unionByName(merged)


def scd2_replay(
    first: DataFrame, later: Sequence[tuple[str | dt.date, DataFrame]],
    spec: Scd2 = CUSTOMERS,
) -> DataFrame:
    """The table after a first load and several runs, given in date order.

    One pass, whatever the number of runs: all batches are put together and
    shuffled once by key. A key has one row per run, and a row opens a version
    if it is the key's first or a tracked column differs from the row before
    (a row that changes nothing equals the open version in all of them).
    """
    batches = [first.withColumn(_RUN, F.lit(0)).withColumn(_RUN_TS, F.lit(None).cast("timestamp"))]
    for n, (run_date, batch) in enumerate(later, 1):
        batches.append(batch.withColumn(_RUN, F.lit(n)).withColumn(_RUN_TS, day_start(run_date)))
    columns = [spec.key, *spec.attributes, spec.start_from, spec.updated, _RUN, _RUN_TS]
    sent = reduce(DataFrame.unionByName, [b.select(*dict.fromkeys(columns)) for b in batches])
    runs = Window.partitionBy(spec.key).orderBy(_RUN)
    differs = reduce(
        Column.__or__, [~F.col(c).eqNullSafe(F.lag(c).over(runs)) for c in spec.tracked]
    )
    is_first = F.row_number().over(runs) == 1
    own_start = F.to_timestamp(spec.start_from)
    if spec.new_from == "run_date":
        own_start = F.coalesce(F.col(_RUN_TS), own_start)
    rows = sent.withColumn("__first", is_first).withColumn("__opens", is_first | differs)
    if spec.untracked == OVERWRITE:
        # A version ends up with what the last row before the next version says.
        rows = rows.withColumn("__version", F.count_if("__opens").over(runs))
        version = Window.partitionBy(spec.key, "__version").orderBy(_RUN).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        kept = [c for c in (*spec.attributes, spec.updated) if c != spec.start_from]
        rows = rows.withColumn("__begin", F.when(F.col("__first"), own_start).otherwise(F.col(_RUN_TS)))
        rows = rows.withColumns({c: F.last(c).over(version) for c in [*kept, spec.start_from]})
    else:
        rows = rows.withColumn("__begin", F.when(F.col("__first"), own_start).otherwise(F.col(_RUN_TS)))
    opened = rows.filter("__opens").withColumn("__closed", F.lead(_RUN_TS).over(runs))
    closed = F.col("__closed").isNotNull()
    return opened.select(
        version_key(F.col(spec.key), F.col("__begin")).alias(spec.surrogate),
        spec.key,
        *spec.attributes,
        F.col("__begin").alias(spec.start),
        F.coalesce("__closed", open_end()).alias(spec.end),
        (~closed).alias(spec.current),
        F.coalesce("__closed", spec.updated).alias(spec.updated),
    )


def scd2_classify(
    history: DataFrame, batch: DataFrame, spec: Scd2 = CUSTOMERS
) -> DataFrame:
    """What a merge would do with each key: new, changed, unchanged or absent."""
    joined, stored, sent, changed = _compare(
        current_rows(history, spec).select(spec.key, *spec.tracked),
        batch.select(spec.key, *spec.tracked),
        spec,
    )
    outcome = (
        F.when(~stored, NEW).when(~sent, ABSENT).when(changed, CHANGED).otherwise(UNCHANGED)
    )
    return joined.select(
        F.coalesce(f"h.{spec.key}", f"n.{spec.key}").alias(spec.key),
        outcome.alias("outcome"),
    )
