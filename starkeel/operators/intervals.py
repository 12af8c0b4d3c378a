"""Joins and look-ups against validity intervals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import stored
from . import skew

HALF_OPEN = "[)"
CLOSED = "[]"
_KEY, _PERIOD, _PERIODS = "__key", "__period", "__periods"
PERIODS = ("day", "month", "week", "year")


def holds(ts: Column, start: Column, end: Column, bounds: str = HALF_OPEN) -> Column:
    """Whether ``ts`` falls inside a version.

    Half-open by default: a version ends at the very instant the next begins, so
    closed bounds would let that instant match both.
    """
    if bounds == HALF_OPEN:
        return (start <= ts) & (ts < end)
    if bounds == CLOSED:
        return (start <= ts) & (ts <= end)
    raise ValueError(f"bounds must be {HALF_OPEN!r} or {CLOSED!r}, not {bounds!r}")


def as_of(
    versions: DataFrame, instant: str | dt.datetime | dt.date | Column,
    start: str = "start_date", end: str = "end_date",
) -> DataFrame:
    """The versions valid at one instant."""
    at = (
        instant if isinstance(instant, Column)
        else F.to_timestamp(F.lit(str(instant)))
    )
    return versions.filter(holds(at, F.col(start), F.col(end)))


def interval_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    start: str = "start_date",
    end: str = "end_date",
    bounds: str = HALF_OPEN,
    how: str = "inner",
    period: str | None = None,
    rows_per_slice: int | None = None,
    spread_by: str | None = None,
    seen: str | None = None,
    known: str | None = None,
    stage: Callable[[DataFrame, str], DataFrame] = stored,
) -> DataFrame:
    """Join each fact row to the versions of its key valid at ``ts``.

    The key is hashed and the interval is a residual condition, so the plan is
    an ordinary sort-merge or broadcast join, never a nested loop over all
    pairs. Two ways to split what is hot, both exact:

    ``period``
        Cut time into days, weeks, months or years and join on (key, period).
        A version is repeated for each period it touches in which its key has
        facts, so a key with very many versions is compared per period only,
        and there are no more repeated versions than (key, period) pairs of
        the facts times the versions each meets, however long a version is.
        Suited to long histories; short ones need no cut.
    ``rows_per_slice``
        Split keys (or key-periods) with more fact rows than this into slices.
        They are searched at once, and kept by ``stage`` as a table.

    With ``seen``, the instant at which a fact was looked at, and ``known``, the
    instant since which a version is known (NULL: always), a fact meets what was
    known then: no version that came later, and a version whose end lies behind
    ``seen`` as if it were still open. Ends must be the instants at which they
    became known, as those of a Type-2 dimension are.

    Facts and versions must not share column names other than ``key``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    left, right, on = facts, versions, [key]
    if period is not None:
        left, right = _cut_time(facts, versions, key, ts, start, end, period)
        on = [key, _PERIOD]
    if rows_per_slice is not None:
        # Searched once: both sides read the few keys that were found.
        hot = stage(skew.hot_keys(left, on, rows_per_slice), "hot")
        spread = F.col(spread_by) if spread_by else F.struct(*facts.columns)
        left = skew.slice_left(left, on, hot, spread)
        right = skew.slice_right(right, on, hot)
        on = [*on, skew.SLICE]
    f, v = left.alias("f"), right.alias("v")
    at, begin, finish = F.col(f"f.{ts}"), F.col(f"v.{start}"), F.col(f"v.{end}")
    if seen is None:
        match = holds(at, begin, finish, bounds)
    elif bounds != HALF_OPEN or period is not None:
        raise ValueError("what was known at an instant is defined for half-open intervals, uncut")
    else:
        match = (begin <= at) & (F.least(at, F.col(f"f.{seen}")) < finish)
        match = match & (F.col(f"v.{known}").isNull() | (F.col(f"v.{known}") <= F.col(f"f.{seen}")))
    for c in on:
        match = (F.col(f"f.{c}") == F.col(f"v.{c}")) & match
    joined = f.join(v, match, how)
    return joined.select(
        *[f"f.{c}" for c in facts.columns],
        *[f"v.{c}" for c in versions.columns if c != key],
    )


def _cut_time(
    facts: DataFrame, versions: DataFrame, key: str, ts: str, start: str, end: str, period: str,
) -> tuple[DataFrame, DataFrame]:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {list(PERIODS)}")
    left = facts.withColumn(_PERIOD, F.date_trunc(period, ts).cast("date"))
    # Only periods in which the key has facts can find anything: one short list
    # per key, whose length is bounded by the periods the facts cover.
    of_key = left.groupBy(F.col(key).alias(_KEY)).agg(F.collect_set(_PERIOD).alias(_PERIODS))
    first = F.date_trunc(period, start).cast("date")
    last = F.date_trunc(period, end).cast("date")
    touched = F.filter(_PERIODS, lambda p: (first <= p) & (p <= last))
    right = (
        versions.filter(F.col(start) <= F.col(end))
        .join(of_key, F.col(key) == F.col(_KEY))
        .select(*versions.columns, F.explode(touched).alias(_PERIOD))
    )
    return left, right
