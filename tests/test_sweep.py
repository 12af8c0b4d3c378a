"""Sweep, digests, bitmaps and clustering: against plain counts, with their plans and metrics."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import rows_of

import __spark_entry__ as driver
from starkeel.operators.digests import changed_by_digest, differing, within
from starkeel.operators.distinct import count_bitmaps, count_words, id_bitmaps, id_words, merge_bitmaps, merge_words
from starkeel.operators.intervals import interval_join
from starkeel.operators.scd1 import changed_rows
from starkeel.operators.sweep import as_of_sweep
from starkeel.sources import layout

VERSIONS = "k bigint, start_date timestamp, end_date timestamp, v string"
FACTS = "k bigint, ts timestamp, id int, start int"
SF = "/root/testdata/sf0.001"


def at(n):
    return None if n is None else dt.datetime(2026, 1, 1) + dt.timedelta(minutes=n)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("pieces", [1, 7])
def test_sweep_equals_the_interval_join(spark, how, pieces):
    rng, versions, facts = random.Random(pieces), [], []
    for k in range(12):
        n = 0
        for i in range(rng.choice([0, 1, 3, 40])):
            begin, n = n + rng.choice([0, 0, 5]), n + rng.randint(5, 9)
            versions.append((k, at(begin), at(n), f"{k}-{i}"))
        versions.append((k, at(7), at(7), "empty"))
    facts = [(rng.randrange(14), at(rng.randrange(-5, 320)), i, i) for i in range(400)]
    facts += [(None, at(3), -1, 0), (1, None, -2, 0), (3, at(0), -3, 0), (3, at(0), -3, 0)]
    versions += [(None, at(0), at(9), "none"), (2, None, at(9), "none"), (2, at(400), None, "none")]
    v = spark.createDataFrame(versions, VERSIONS)
    f = spark.createDataFrame(facts, FACTS)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", pieces)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # tiny pieces stay apart
    try:
        got = rows_of(as_of_sweep(f, v, "k", "ts", how=how), "*")
    finally:
        for c, x in keep.items():
            spark.conf.set(c, x)
    assert got == rows_of(interval_join(f, v, "k", "ts", how=how), "*") and len(got) > 50
    with pytest.raises(ValueError):
        as_of_sweep(f, v, "k", "ts", how="outer")
    none = as_of_sweep(f.limit(0), v.limit(0), "k", "ts", how=how)
    assert none.columns == ["k", "ts", "id", "start", "start_date", "end_date", "v"] and none.isEmpty()


def test_one_key_with_very_many_versions_and_facts_makes_no_product(spark):
    n = 100_000
    minute = lambda c: F.timestamp_seconds(F.col("id") * 60 + c)
    v = spark.range(n).select(F.lit(1).alias("k"), minute(0).alias("start_date"), minute(60).alias("end_date"), F.col("id").alias("v"))
    f = spark.range(n).select(F.lit(1).alias("k"), minute(30).alias("ts"), F.col("id"))
    swept = as_of_sweep(f, v, "k", "ts")
    plan = swept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert swept.filter("v = id").count() == n == swept.count()


def test_changes_found_by_digest(spark):
    rng = random.Random(4)
    schema = "k bigint, a string, b int, other string"
    base = [(k, rng.choice([None, "x", "y"]), k % 3, "o") for k in range(500)]
    sent = [(k, a, b, "p") for k, a, b, _ in base]
    assert changed_by_digest(*(spark.createDataFrame(r, schema) for r in (base, sent)), "k", ["a", "b"]).isEmpty()
    changed = [(k, "z" if k == 77 else a, b, o) for k, a, b, o in sent]
    old, new = (spark.createDataFrame(r, schema).cache() for r in (base, changed))
    assert rows_of(changed_by_digest(old, new, "k", ["a", "b"], 16, 2), "k") == [(77,)]
    # One changed row: one range differs, and only its rows are joined.
    wanted = differing(old, new, "k", ["a", "b"], 64).cache()
    assert wanted.count() == 1 and within(old, "k", 64, wanted).count() < 30
    mixed = [r for r in changed if r[0] % 5] + [(900 + i, None, None, None) for i in range(9)] + [(None, "n", 1, "p")]
    new = spark.createDataFrame([(k, None if k and k % 50 == 1 else a, b, o) for k, a, b, o in mixed], schema)
    for levels, fanout in ((1, 8), (2, 16), (3, 4)):
        got = changed_by_digest(old, new, "k", ["a", "b"], fanout, levels)
        assert rows_of(got, "*") == rows_of(changed_rows(old, new, "k", ["a", "b"]), "*")
    assert changed_by_digest(old, new.limit(0), "k", ["a"]).isEmpty()
    assert changed_by_digest(old.limit(0), new, "k", ["a", "b"]).count() == new.count()


def test_distinct_ids_by_bitmap(spark):
    rng = random.Random(2)
    rows = [(d, rng.choice("ab"), rng.choice([None, rng.randrange(0, 300_000), rng.randrange(0, 40)])) for d in range(5) for _ in range(400)]
    df = spark.createDataFrame(rows, "day int, g string, id bigint")
    days = id_bitmaps(df, ["day", "g"], "id")
    plan = days._jdf.queryExecution().executedPlan().toString()
    exchange = next(x for x in plan.splitlines() if "hashpartitioning" in x)
    assert "id_bucket" in exchange and "partial_bitmap_construct_agg" in plan[plan.index("hashpartitioning"):]
    found = count_bitmaps(merge_bitmaps(days, ["g"]), ["g"])
    assert rows_of(found, "g", "n") == rows_of(df.groupBy("g").agg(F.count_distinct("id").alias("n")), "g", "n")
    assert rows_of(count_bitmaps(days, ["day", "g"]), "day", "g", "n") == rows_of(
        df.groupBy("day", "g").agg(F.count_distinct("id").alias("n")), "day", "g", "n"
    )


def scan_rows(df):
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollectPublic()
    leaves = query.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_filter_on_either_key_reads_a_part(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select(
        (F.xxhash64("id") % 5000).alias("customer"), F.date_add(F.lit(dt.date(2026, 1, 1)), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(365)).cast("int")).alias("day"), "id"
    )
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        layout.cluster(df, ["customer", "day"], 6).write.parquet(str(tmp_path / "t"))
        stored = spark.read.parquet(str(tmp_path / "t"))
        assert stored.count() == n
        for condition in ("customer = 77", "day = date'2026-05-05'"):
            some = stored.filter(condition)
            assert 0 < scan_rows(some.select("id")) <= n / 4
            assert rows_of(some, "id") == rows_of(df.filter(condition), "id")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("sliced,plain,joins", [("daily_sales_sliced", "daily_sales_summary", 2), ("fact_orders_sliced", "fact_orders", 2), ("interval_join_sliced", "interval_join_half_open", 1)])
def test_hot_keys_are_searched_once(spark, sliced, plain, joins):
    exchanges = [
        driver.queries()[q](spark, SF)._jdf.queryExecution().executedPlan().toString().count("Exchange ") for q in (sliced, plain)
    ]
    # Each search's result is read on both sides, as a broadcast of a stored table.
    assert exchanges[0] <= exchanges[1] + 2 * joins + 1


def test_ranks_are_found_by_halving(spark):
    limits = [1, 5, 5.5, 9]
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 3, 5, 5.5, 8, 9, 99)] + [(None,)], "x double")
    got = [r[0] for r in df.select(layout._rank(F.col("x"), limits)).collect()]
    assert got[:-1] == np.searchsorted(limits, [0, 1, 3, 5, 5.5, 8, 9, 99], side="right").tolist() and got[-1] == 0


def test_distinct_ids_by_words(spark):
    rng = random.Random(4)
    rows = [
        (d, rng.choice("ab"), rng.choice([None, rng.randrange(-300, 300), rng.randrange(0, 40), 2**63 - 1, -(2**63)]))
        for d in range(5) for _ in range(400)
    ]
    df = spark.createDataFrame([*rows, (9, "c", None)], "day int, g string, id bigint")
    counted = df.filter("id is not null")
    days = id_words(df, ["day", "g"], "id")
    assert rows_of(count_words(merge_words(days, ["g"]), ["g"]), "g", "n") == rows_of(
        counted.groupBy("g").agg(F.count_distinct("id").alias("n")), "g", "n"
    )
    assert rows_of(count_words(days, ["day", "g"]), "day", "g", "n") == rows_of(
        counted.groupBy("day", "g").agg(F.count_distinct("id").alias("n")), "day", "g", "n"
    )
    # Scattered ids are not sorted as 4 kB each: words meet in hash tables.
    plan = driver.queries()["monthly_orders_by_bitmap"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
