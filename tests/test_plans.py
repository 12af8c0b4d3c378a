"""Physical plans: what must and must not appear in them."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from starkeel import schemas
from starkeel.operators.dedup import latest
from starkeel.operators.facts import build_dim_date, build_fact, daily_sales
from starkeel.operators.intervals import interval_join
from starkeel.operators.scd1 import scd1_upsert
from starkeel.operators.scd2 import scd2_apply
from starkeel.operators.skew import hot_keys
from starkeel.plans import workload as w
from starkeel.sources import commits, facts

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled_joins(spark):
    """Plans as they are at sizes where no side can be broadcast."""
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Dimension, product and fact tables on disk, and the batch of a day."""
    root = tmp_path_factory.mktemp("stored")
    frames = {
        "customers": w.customer_dim(spark, SF), "products": w.product_dim(spark, SF),
        "orders": w.order_batch(spark, SF), "batch": w.customer_batch(spark, SF, 2),
        "product_batch": w.product_batch(spark, SF, 2),
    }
    out = {}
    for name, df in frames.items():
        df.write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    fact = build_fact(out["orders"], out["customers"], out["products"])
    fact = fact.withColumn("ingest_date", F.lit(dt.date(2026, 6, 1)))
    schema = fact.schema
    state = facts.write_days(fact, commits.State(str(root)), "fact", [dt.date(2026, 6, 1)], schema, "order_date_key")
    out["fact"] = facts.read_days(spark, state, "fact", schema, "order_date_key")
    return out


def test_a_merge_is_one_join_and_two_shuffles(spark, stored, shuffled_joins):
    current = stored["customers"].filter("is_current")
    p = plan(scd2_apply(current, stored["batch"], "2001-12-01"))
    assert p.count("SortMergeJoin") == 1 and p.count("Exchange") == 2
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in p
    p = plan(scd1_upsert(stored["products"], stored["product_batch"], "product_id", "product_key"))
    assert p.count("SortMergeJoin") == 1 and p.count("Exchange") == 2


def test_deduplication_combines_before_the_shuffle(spark):
    p = plan(latest(w.table(spark, SF, "orders"), ["o_custkey"], ["o_orderdate"]))
    assert p.count("Exchange") == 1 and "partial_max" in p[p.index("Exchange"):]


def test_the_interval_is_a_residual_of_an_equi_join(spark, stored, shuffled_joins):
    facts = stored["orders"].select(
        "order_id", "customer_id", F.col("order_date").cast("timestamp").alias("ts")
    )
    versions = stored["customers"].select("customer_id", "customer_key", "start_date", "end_date")
    for options in ({}, {"period": "month"}, {"rows_per_slice": 5, "spread_by": "order_id"}):
        p = plan(interval_join(facts, versions, "customer_id", "ts", **options))
        assert "SortMergeJoin" in p and "NestedLoop" not in p and "Cartesian" not in p


def test_hot_keys_are_counted_in_parallel(spark, stored):
    p = plan(hot_keys(stored["orders"], ["customer_id"], 100))
    assert "SinglePartition" not in p and "partial_count" in p[p.index("Exchange"):]
    assert "ReadSchema: struct<customer_id:bigint>" in p


def test_the_summary_reads_only_its_columns(spark, stored):
    dates = w.table(spark, SF, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    ).distinct()
    p = plan(daily_sales(stored["fact"], stored["customers"], stored["products"], dates))
    read = [
        set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    ]
    assert {
        "order_id", "customer_key", "product_key", "quantity", "total_amount", "order_date_key",
        "ingest_date", "write",  # the last three are names of directories
    } in read
    assert {"customer_key", "state"} in read
    summed = plan(daily_sales(
        stored["fact"], stored["customers"], stored["products"], dates, orders_unique=True
    ))
    assert "partial_sum" in summed and "distinct" not in summed
    assert {"product_key", "category"} in read


def test_a_date_filter_prunes_fact_partitions(spark, stored):
    p = plan(stored["fact"].filter("order_date_key = 19980302"))
    assert re.search(r"PartitionFilters: \[[^\]]*order_date_key", p)


def test_entry_runs_with_the_declared_columns(spark):
    df = driver.entry(spark)
    assert df.columns == schemas.DAILY_SALES.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.DAILY_SALES]
    assert df.count() > 0


def test_the_summary_query_shuffles_no_surrogate_keys(spark, shuffled_joins):
    for name in ("daily_sales_summary", "daily_sales_sliced"):
        p = plan(driver.queries()[name](spark, SF))
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", p)
        assert dealt and not [d for d in dealt if "customer_key" in d or "product_key" in d]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("carried", ["both", "state", "category"])
def test_a_fact_with_state_and_category_gives_the_same_summary(spark, stored, unique, carried):
    customers, products = stored["customers"], stored["products"]
    dates = build_dim_date(w.table(spark, SF, "orders"), "o_orderdate")
    fact = build_fact(stored["orders"], customers, products, of_customers=["state"], of_products=["category"])
    found = daily_sales(
        fact, customers if carried == "category" else None, products if carried == "state" else None, dates,
        orders_unique=unique, rows_per_slice=2,
    )
    plain = daily_sales(fact.drop("state", "category"), customers, products, dates)
    assert found.columns == plain.columns and found.count() == plain.count() > 0
    assert found.exceptAll(plain).isEmpty()


def test_sliced_facts_make_the_orders_once(spark):
    p = plan(driver.queries()["fact_orders_sliced"](spark, SF))
    # What is searched for hot keys is a stored table, not the deduplication again.
    assert "order_id" in p and "l_quantity" not in p


def test_the_instant_of_an_order_is_made_after_the_shuffles(spark, shuffled_joins):
    for name in ("fact_orders", "fact_orders_closed_bounds"):
        p = plan(driver.queries()[name](spark, SF))
        assert "created_at" in p and "created_at" not in p[p.index("Exchange"):]
