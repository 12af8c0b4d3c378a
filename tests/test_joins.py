"""Interval joins, hot keys, deduplication, numbering and sampling."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import rows_of

from starkeel.operators.dedup import latest, pool
from starkeel.operators.facts import build_fact, resolve_orders
from starkeel.operators.intervals import _cut_time, interval_join
from starkeel.operators.sampling import bernoulli, number_in_order
from starkeel.operators.skew import SLICES, hot_keys, lookup_join
from starkeel.plans import workload as w

EPOCH = dt.datetime(2026, 1, 1)


def day(n):
    return EPOCH + dt.timedelta(days=n)


def facts_of(spark, rows):
    return spark.createDataFrame(
        [(i, k, day(t)) for i, (k, t) in enumerate(rows)], "id int, key int, ts timestamp"
    )


def versions_of(spark, rows):
    return spark.createDataFrame(
        [(i, k, day(a), day(b)) for i, (k, a, b) in enumerate(rows)],
        "version int, key int, start_date timestamp, end_date timestamp",
    )


def brute_force(facts, versions, closed, left=False):
    found = []
    for i, (k, t) in enumerate(facts):
        hits = [
            v for v, (vk, a, b) in enumerate(versions)
            if vk == k and a <= t and (t <= b if closed else t < b)
        ]
        found += [(i, v) for v in hits] or ([(i, None)] if left else [])
    return sorted(found, key=repr)


OPTIONS = [
    {}, {"period": "day"}, {"period": "month"}, {"period": "year"},
    {"rows_per_slice": 2, "spread_by": "id"},
    {"period": "week", "rows_per_slice": 1, "spread_by": "id"},
]
_rng = random.Random(7)
# One key holds most facts and most versions; versions overlap, are empty or inverted.
FACTS = [(1 if _rng.random() < 0.6 else _rng.randrange(2, 9), _rng.randrange(80))
         for _ in range(120)]
VERSIONS = [(1 if _rng.random() < 0.6 else _rng.randrange(2, 8), a, a + _rng.randrange(-2, 30))
            for a in (_rng.randrange(80) for _ in range(40))] + [(3, 0, 2_000_000)]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
@pytest.mark.parametrize("bounds", ["[)", "[]"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_every_form_of_the_interval_join_is_exact(spark, options, bounds, how):
    joined = interval_join(
        facts_of(spark, FACTS), versions_of(spark, VERSIONS), "key", "ts",
        bounds=bounds, how=how, **options,
    )
    assert joined.columns == ["id", "key", "ts", "version", "start_date", "end_date"]
    assert rows_of(joined, "id", "version") == brute_force(
        FACTS, VERSIONS, bounds == "[]", how == "left"
    )


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    facts=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=25),
    versions=st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 40), st.integers(0, 60)), max_size=12
    ),
)
def test_sliced_join_on_random_intervals(spark, facts, versions):
    joined = interval_join(
        facts_of(spark, facts), versions_of(spark, versions), "key", "ts",
        period="month", rows_per_slice=1, spread_by="id",
    )
    assert rows_of(joined, "id", "version") == brute_force(facts, versions, False)


def test_wrong_options_are_refused(spark):
    f, v = facts_of(spark, FACTS[:2]), versions_of(spark, VERSIONS[:2])
    for wrong in ({"bounds": "()"}, {"how": "full"}, {"period": "hour"}):
        with pytest.raises(ValueError):
            interval_join(f, v, "key", "ts", **wrong)


def test_a_key_with_a_third_of_all_rows_is_found_and_sliced(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), "id"
    )
    assert rows_of(hot_keys(df, ["key"], 1000), "key", SLICES) == [(-1, 10)]
    right = df.select("key").distinct().withColumn("name", F.col("key").cast("string"))
    hot = hot_keys(df, ["key"], 1000)
    for how, n in (("inner", 30_000), ("left", 30_000), ("left_semi", 30_000), ("left_anti", 0)):
        assert lookup_join(df, right, "key", how, hot, F.col("id")).count() == n
    with pytest.raises(ValueError):
        lookup_join(df, right, "key", "full", hot)


def test_null_keys_survive_a_sliced_left_join(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 5)], "id int, key int")
    right = spark.createDataFrame([(5, "five")], "key int, name string")
    hot = hot_keys(df, ["key"], 1)
    assert rows_of(lookup_join(df, right, "key", "left", hot), "id", "name") == [
        (1, "five"), (2, None), (3, "five"),
    ]


def test_the_latest_row_wins_whatever_the_order_of_arrival(spark):
    rows = [(1, "b", 2), (1, "a", 9), (1, "z", None), (2, "x", None), (None, "n", 1), (1, "c", 9)]
    expected = [(1, "c", 9), (2, "x", None), (None, "n", 1)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v string, at int").repartition(seed + 1)
        assert rows_of(latest(df, ["k"], ["at"]), "k", "v", "at") == expected


def test_columns_without_an_order_are_carried_along(spark):
    df = spark.createDataFrame(
        [(1, 1, {"a": 1}), (1, 2, {"a": 2}), (2, 5, None)], "k int, at int, m map<string,int>"
    )
    assert rows_of(latest(df, ["k"], ["at"]), *df.columns) == [(1, 2, {"a": 2}), (2, 5, None)]
    assert rows_of(latest(df.select("k"), ["k"], []), "k") == [(1,), (2,)]


def test_updates_replace_base_rows(spark):
    base = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    updates = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert rows_of(pool(base, updates, ["k"]), "k", "v") == [(1, "old"), (2, "new"), (3, "new")]


def test_ids_ascend_with_the_date_also_on_a_hot_date(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("day"), "id"
    )
    numbered = number_in_order(df, ["day", "id"], 100001, "order_id").collect()
    ordered = sorted(numbered, key=lambda r: (r["day"], r["id"]))
    assert [r["order_id"] for r in ordered] == list(range(100001, 105001))


def test_sampling_is_repeatable_and_near_its_rate(spark):
    df = spark.range(20_000)
    a = {r[0] for r in bernoulli(df, "id", 0.15, 42).collect()}
    b = {r[0] for r in bernoulli(df.repartition(7), "id", 0.15, 42).collect()}
    assert a == b and abs(len(a) / 20_000 - 0.15) < 0.01
    assert a != {r[0] for r in bernoulli(df, "id", 0.15, 43).collect()}
    assert bernoulli(df, "id", 1.0, 1).count() == 20_000
    assert bernoulli(df, "id", 0.0, 1).count() == 0


def test_a_long_version_is_cut_only_where_its_key_has_facts(spark):
    facts = facts_of(spark, [(1, 0), (1, 1), (2, 40_000), (3, 5)])
    versions = versions_of(spark, [(1, -9000, 90_000), (2, 0, 50_000), (4, 0, 50_000)])
    for period, pieces in (("day", 3), ("week", 2), ("month", 2), ("year", 2)):
        _, cut = _cut_time(facts, versions, "key", "ts", "start_date", "end_date", period)
        assert cut.count() == pieces
        joined = interval_join(facts, versions, "key", "ts", period=period, how="left")
        assert rows_of(joined, "id", "version") == [(0, 0), (1, 0), (2, 1), (3, None)]


@pytest.mark.parametrize("bounds", ["[)", "[]"])
def test_keys_made_after_the_joins_are_the_stored_ones(spark, bounds):
    """And nothing below the last join carries a digest."""
    d = "/root/testdata/sf0.001"
    star = w.order_batch(spark, d), w.customer_dim(spark, d), w.product_dim(spark, d)
    made = build_fact(*star, bounds=bounds, keys_derived=True)
    kept = build_fact(*star, bounds=bounds)
    assert made.dtypes == kept.dtypes
    assert made.count() > 0
    assert made.exceptAll(kept).count() == kept.exceptAll(made).count() == 0
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan[plan.index("Join"):]
    with pytest.raises(ValueError, match="both partners"):
        resolve_orders(*star, keys_derived=True)
