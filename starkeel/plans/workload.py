"""The star's feeds, derived from the order-and-line-item test tables.

Orders and line items are cut at fixed dates into successive batches that
together cover every row. Each exists typed (``*_batch``) and as the text a raw
zone would deliver (``*_feed``):

customers  one row per customer with orders in the feed's window. The address
           is the priority of the last such order (NULL if not specified), the
           sign-up date that of the first order whose priority was specified, so
           a customer without one has no start date.
products   one row per part shipped in the window, at the price last paid.
           Parts last sold with return flag N come without a category.
orders     one row per line item. Order and line number repeat, so the feed
           has real duplicates.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedup import latest
from ..operators.scd1 import scd1_init, scd1_upsert
from ..operators.scd2 import scd2_replay

# Fixed values, shared with the comparison SQL.
NOT_SPECIFIED = "4-NOT SPECIFIED"
NO_CATEGORY_FLAG = "N"
CUSTOMER_RUNS = ("1996-01-01", "2000-06-01")
FIRST_RUN = "1990-01-01"
PRODUCT_RUNS = ("1995-03-01", "2001-09-01")
LINES_PER_ORDER = 10
ALL, REST = "all", "rest"

CUSTOMER = schemas.CUSTOMER
PRODUCT = schemas.PRODUCT
ORDER = schemas.ORDER


# Schemas of the tables as stored. Declaring them spares every query a job that
# opens files only to learn their types.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _window(df: DataFrame, day: str, runs: tuple[str, ...], i: int | str) -> DataFrame:
    """Rows of feed ``i``: from run date ``i`` (the first from the start) to the next.

    ``ALL`` takes every row, ``REST`` those of all feeds but the first.
    """
    if i == ALL:
        return df
    if i == REST:
        return df.filter(F.col(day) >= F.lit(runs[0]).cast("timestamp_ntz"))
    if i > 0:
        df = df.filter(F.col(day) >= F.lit(runs[i - 1]).cast("timestamp_ntz"))
    if i < len(runs):
        df = df.filter(F.col(day) < F.lit(runs[i]).cast("timestamp_ntz"))
    return df


def customer_rows(spark: SparkSession, sf_dir: str, i: int | str) -> DataFrame:
    """Customer batch ``i`` as the source sends it: some lack a sign-up date."""
    orders = _window(table(spark, sf_dir, "orders"), "o_orderdate", CUSTOMER_RUNS, i)
    specified = F.nullif("o_orderpriority", F.lit(NOT_SPECIFIED))
    seen = orders.groupBy("o_custkey").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", specified.alias("address"))).alias("last"),
        F.min(F.when(specified.isNotNull(), F.col("o_orderdate"))).alias("signup"),
    )
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(seen, F.col("c_custkey") == F.col("o_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
            .alias("email"),
            F.concat(F.lit("+1-555-"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
            .alias("phone"),
            F.col("last.address").alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("signup").cast("date").alias("signup_date"),
            F.col("last.o_orderdate").cast("timestamp").alias("updated_at"),
        )
    )


def customer_batch(spark: SparkSession, sf_dir: str, i: int | str) -> DataFrame:
    return customer_rows(spark, sf_dir, i).filter(F.col("signup_date").isNotNull())


def product_batch(spark: SparkSession, sf_dir: str, i: int | str) -> DataFrame:
    lines = _window(table(spark, sf_dir, "lineitem"), "l_shipdate", PRODUCT_RUNS, i)
    sold = lines.groupBy("l_partkey").agg(
        F.max(
            F.struct(
                "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                "l_returnflag",
            )
        ).alias("last"),
        F.min("l_shipdate").alias("first"),
    )
    listed = F.col("p_retailprice").cast("decimal(10,2)")
    paid = F.round(listed * (1 - F.col("last.l_discount").cast("decimal(4,2)")), 2)
    return (
        table(spark, sf_dir, "part")
        .join(sold, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.when(F.col("last.l_returnflag") != NO_CATEGORY_FLAG, F.col("p_type"))
            .alias("category"),
            paid.cast("decimal(10,2)").alias("price"),
            F.col("p_size").alias("stock_quantity"),
            F.col("first").cast("timestamp").alias("created_at"),
            F.col("last.l_shipdate").cast("timestamp").alias("updated_at"),
        )
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with repeated ids, as sent."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * LINES_PER_ORDER + F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
    )


def order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order id: the largest amount wins, then the other columns."""
    return latest(order_lines(spark, sf_dir), ["order_id"], ["total_amount"])


def as_feed(batch: DataFrame) -> DataFrame:
    """A batch as text, the form a raw zone holds it in."""
    return batch.select(*[F.col(c).cast("string").alias(c) for c in batch.columns])


def customer_dim(spark: SparkSession, sf_dir: str, runs: int = len(CUSTOMER_RUNS)) -> DataFrame:
    """The customer dimension after the first load and ``runs`` merges."""
    return scd2_replay(
        customer_batch(spark, sf_dir, 0),
        [(CUSTOMER_RUNS[i], customer_batch(spark, sf_dir, i + 1)) for i in range(runs)],
    )


def customer_run_days() -> list[dt.date]:
    return [dt.date.fromisoformat(d) for d in (FIRST_RUN, *CUSTOMER_RUNS)]


def customer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customer batches with the date of the run that brought them."""
    batches = [
        customer_batch(spark, sf_dir, i).withColumn("run_date", F.lit(day))
        for i, day in enumerate(customer_run_days())
    ]
    return reduce(DataFrame.unionByName, batches)


def product_dim(spark: SparkSession, sf_dir: str, runs: int = len(PRODUCT_RUNS)) -> DataFrame:
    dim = scd1_init(product_batch(spark, sf_dir, 0), "product_id", "product_key")
    for i in range(runs):
        dim = scd1_upsert(
            dim, product_batch(spark, sf_dir, i + 1), "product_id", "product_key"
        )
    return dim
