"""Fact rows, the date dimension and the daily sales roll-up."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_key, id_key, open_end, version_key
from ..lineage import stored
from .conform import REASON
from .intervals import HALF_OPEN, interval_join
from .runs import SINCE, UNTIL
from .skew import hot_keys, lookup_join

# Keeps a frame as a table under a name and gives it back.
Stage = Callable[[DataFrame, str], DataFrame]

NO_CUSTOMER = "no_customer_version"
NO_PRODUCT = "unknown_product"

_ORDER_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "order_date",
    "total_amount", "order_status",
)


def resolve_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    bounds: str = HALF_OPEN,
    period: str | None = None,
    rows_per_slice: int | None = None,
    how: str = "left",
    seen: str | None = None,
    stage: Stage = stored,
    of_customers: Sequence[str] = (),
    of_products: Sequence[str] = (),
    keys_derived: bool = False,
) -> DataFrame:
    """Attach to each order the customer version of its date and its product.

    With ``how='left'`` orders that find no partner stay, keys NULL, so that one
    pass serves both the fact and the quarantine. Of the dimensions only keys,
    interval and price are carried through the shuffles. With
    ``rows_per_slice`` the orders are also scanned for hot keys, so they should
    be a stored table and not a long computation.

    With ``seen``, the run date an order came with, the dimensions are those of
    :func:`.runs.scd2_known` and :func:`.runs.scd1_states`: an order meets what
    they held after its own run. Orders of many runs are so resolved at once.

    ``of_customers`` and ``of_products`` are further columns of the versions and
    products found; without ``seen`` only.

    With ``keys_derived`` the caller vouches that the keys are those that
    :func:`.scd2.scd2_merge` and :func:`.scd1.scd1_upsert` give, and that ids have
    one type: then the start of the version travels, and the digests are made
    after the last shuffle. For orders with both partners only.
    """
    if keys_derived and (how != "inner" or seen is not None):
        raise ValueError("keys are derived for orders with both partners, and not for dimensions as seen")
    placed = orders.select(*_ORDER_COLUMNS, *([seen] if seen else []))
    created = F.to_timestamp("order_date")
    if seen is not None:
        if of_customers or of_products:
            raise ValueError("further columns are not defined for dimensions as seen")
        placed = placed.withColumn("created_at", created)
        return _resolve_as_seen(placed, customers, products, rows_per_slice, how, seen, stage)
    stored_keys = [] if keys_derived else ["customer_key"], [] if keys_derived else ["product_key"]
    versions = customers.select("customer_id", *stored_keys[0], "start_date", "end_date", *of_customers)
    items = products.select("product_id", *stored_keys[1], F.col("price").alias("price_each"), *of_products)
    # The order date stands for its midnight, which is added after the shuffles.
    with_customer = interval_join(
        placed, versions, "customer_id", "order_date", bounds=bounds, how=how,
        period=period, rows_per_slice=rows_per_slice, spread_by="order_id", stage=stage,
    ).drop("end_date", *([] if keys_derived else ["start_date"]))
    hot = (
        stage(hot_keys(placed, ["product_id"], rows_per_slice), "hot")
        if rows_per_slice is not None else None
    )
    resolved = lookup_join(
        with_customer, items, "product_id", how=how, hot=hot,
        spread_by=F.col("order_id"),
    ).withColumn("created_at", created)
    if not keys_derived:
        return resolved
    return resolved.withColumns({
        "customer_key": version_key(F.col("customer_id"), F.col("start_date")),
        "product_key": id_key(F.col("product_id")),
    }).drop("start_date")


def _resolve_as_seen(
    placed: DataFrame, customers: DataFrame, products: DataFrame, rows_per_slice: int | None, how: str, seen: str,
    stage: Stage,
) -> DataFrame:
    at = "__seen"
    versions = customers.select(
        "customer_id", "customer_key", "start_date", "end_date", F.col(SINCE).cast("timestamp").alias("__known")
    )
    items = products.select(
        "product_id", "product_key", F.col("price").alias("price_each"),
        F.coalesce(F.col(SINCE).cast("timestamp"), F.lit(dt.datetime(1, 1, 1))).alias("__from"),
        F.coalesce(F.col(UNTIL).cast("timestamp"), open_end()).alias("__to"),
    )
    options = {"how": how, "rows_per_slice": rows_per_slice, "spread_by": "order_id", "stage": stage}
    rows = placed.withColumn(at, F.col(seen).cast("timestamp"))
    rows = interval_join(rows, versions, "customer_id", "created_at", seen=at, known="__known", **options)
    rows = rows.drop("start_date", "end_date", "__known")
    return interval_join(rows, items, "product_id", at, "__from", "__to", **options).drop("__from", "__to", at)


def fact_rows(resolved: DataFrame, *more: str) -> DataFrame:
    """Resolved orders with both partners, as rows of the fact table, and ``more`` of their columns."""
    found = resolved.filter(F.col("customer_key").isNotNull() & F.col("product_key").isNotNull())
    return _fact_columns(found, *more)


def _fact_columns(resolved: DataFrame, *more: str) -> DataFrame:
    return resolved.select(
        "order_id", "customer_key", "product_key",
        date_key(F.col("order_date")).alias("order_date_key"),
        "quantity", "price_each", "total_amount", "order_status", "created_at", *more,
    )


def build_fact(
    orders: DataFrame, customers: DataFrame, products: DataFrame,
    bounds: str = HALF_OPEN, period: str | None = None,
    rows_per_slice: int | None = None, of_customers: Sequence[str] = (),
    of_products: Sequence[str] = (), keys_derived: bool = False,
) -> DataFrame:
    """Orders with the customer version valid at the order date.

    ``price_each`` is the product's current price, by definition of a Type-1
    dimension, and need not equal ``total_amount / quantity``. Columns of the
    dimensions that are wanted with the fact come out of the same joins.
    """
    resolved = resolve_orders(
        orders, customers, products, bounds, period, rows_per_slice, how="inner",
        of_customers=of_customers, of_products=of_products, keys_derived=keys_derived,
    )
    # Derived keys are never NULL; asking would make the digests below the joins.
    rows = _fact_columns if keys_derived else fact_rows
    return rows(resolved, *of_customers, *of_products)


def unmatched(resolved: DataFrame, *more: str) -> DataFrame:
    """Orders that found no partner, with the reason, and ``more`` of their columns."""
    reason = F.when(F.col("customer_key").isNull(), NO_CUSTOMER).when(
        F.col("product_key").isNull(), NO_PRODUCT
    )
    return (
        resolved.withColumn(REASON, reason)
        .filter(F.col(REASON).isNotNull())
        .select(*_ORDER_COLUMNS, *more, REASON)
    )


def date_dimension(days: DataFrame, day: str = "date") -> DataFrame:
    """Calendar attributes of a frame of days."""
    d = F.col(day)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def calendar(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Every day between two dates of a one-row frame."""
    return bounds.select(F.explode(F.sequence(lo, hi)).alias("date"))


def build_dim_date(df: DataFrame, day: str) -> DataFrame:
    """Date dimension over the range of a date column; days without rows too."""
    limits = df.agg(
        F.min(F.col(day).cast("date")).alias("lo"), F.max(F.col(day).cast("date")).alias("hi")
    )
    return date_dimension(calendar(limits))


def daily_sales(
    fact: DataFrame, customers: DataFrame | None, products: DataFrame | None, dates: DataFrame,
    rows_per_slice: int | None = None, orders_unique: bool = False, stage: Stage = stored,
) -> DataFrame:
    """Items, sales and orders per day, customer state and product category.

    The fact carries the key of a customer *version*, so the state is the one
    at order time. With ``orders_unique`` the caller vouches that an order id
    occurs once; then rows are summed per day, customer and product before they
    meet the dimensions, and no order id is shuffled at all. Otherwise orders are
    counted distinct. The fact is joined first to the calendar, whose size is
    bounded by the days it covers; only the columns used travel.

    A dimension given as None is not looked up: the fact has its ``state`` or
    ``category`` already, from the joins that built it. Without either, the sums
    before the calendar have one row per group, and nothing larger is shuffled.
    """
    of_customer = "customer_state" if customers is None else "customer_key"
    of_product = "product_category" if products is None else "product_key"
    sold = fact.select(
        "order_id", F.col("state" if customers is None else of_customer).alias(of_customer),
        F.col("category" if products is None else of_product).alias(of_product),
        "order_date_key", "quantity", "total_amount",
    )
    measures = {
        "total_items_sold": F.sum("quantity"),
        "total_sales_usd": F.sum("total_amount"),
        "total_order_count": F.count_distinct("order_id"),
    }
    spread = F.col("order_id")
    if orders_unique:
        parts = measures | {"total_order_count": F.count("order_id")}
        sold = sold.groupBy("order_date_key", of_customer, of_product).agg(
            *[m.alias(n) for n, m in parts.items()]
        )
        measures = {n: F.sum(n).cast(sold.schema[n].dataType) for n in parts}
        spread = F.xxhash64("order_date_key", of_customer, of_product)
    searched = [k for k, dim in (("customer_key", customers), ("product_key", products)) if dim is not None]
    hot = {}
    if rows_per_slice is not None and searched:
        # The sums are made once, and searched for keys with many of them.
        sold = stage(sold, "sold")
        hot = {k: stage(hot_keys(sold, [k], rows_per_slice), "hot") for k in searched}
    days = dates.select(F.col("date_key").alias("order_date_key"), "year", "month")
    star = sold.join(days, "order_date_key")
    if products is not None:
        categories = products.select("product_key", F.col("category").alias("product_category"))
        star = lookup_join(star, categories, "product_key", hot=hot.get("product_key"), spread_by=spread)
    if customers is not None:
        states = customers.select("customer_key", F.col("state").alias("customer_state"))
        star = lookup_join(star, states, "customer_key", hot=hot.get("customer_key"), spread_by=spread)
    return star.groupBy(
        "year", "month", "order_date_key", "customer_state", "product_category"
    ).agg(*[m.alias(n) for n, m in measures.items()])


def summed(parts: DataFrame, like: DataFrame) -> DataFrame:
    """Rows of :func:`daily_sales` for the same group added up; groups without orders left are gone."""
    groups = ["year", "month", "order_date_key", "customer_state", "product_category"]
    totals = ["total_items_sold", "total_sales_usd", "total_order_count"]
    added = parts.groupBy(*groups).agg(*[F.sum(c).cast(like.schema[c].dataType).alias(c) for c in totals])
    return added.filter(F.col("total_order_count") != 0)


def negated(sales: DataFrame) -> DataFrame:
    """Rows of :func:`daily_sales` that take away what they count."""
    totals = ["total_items_sold", "total_sales_usd", "total_order_count"]
    return sales.withColumns({c: (-F.col(c)).cast(sales.schema[c].dataType) for c in totals})


def order_totals(
    orders: DataFrame, products: DataFrame, product: str = "product_id",
    quantity: str = "quantity", price: str = "price",
) -> DataFrame:
    """Price each order from the product list: ``round(price * quantity, 2)``."""
    listed = products.select(product, price)
    return lookup_join(orders, listed, product).withColumn(
        "total_amount", F.round(F.col(price) * F.col(quantity), 2)
    )
