"""Schemas, keys and constraints of the star, declared once.

They are enforced when a feed or table is read, asserted when one is written,
and are the source of the table definitions and of the quality checks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

STR, INT, LONG, DATE, TS, BOOL = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DateType(),
    T.TimestampType(),
    T.BooleanType(),
)
PRICE, AMOUNT, TOTAL = T.DecimalType(10, 2), T.DecimalType(12, 2), T.DecimalType(22, 2)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


def all_text(schema: T.StructType) -> T.StructType:
    """The feed form of a conformed schema: same names, every column a string."""
    return T.StructType([T.StructField(f.name, STR, True) for f in schema])


@dataclass(frozen=True)
class Constraints:
    """Declared constraints of one table."""

    primary_key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    foreign_keys: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# Fixed values of the published tables: column names, types and length limits.
# Ids are 64-bit; keys hash their text, so they are those of narrower ids.

# Conformed feeds -------------------------------------------------------------

CUSTOMER = struct(
    customer_id=LONG, name=STR, email=STR, phone=STR, address=STR, city=STR,
    state=STR, signup_date=DATE, updated_at=TS,
)
PRODUCT = struct(
    product_id=LONG, product_name=STR, category=STR, price=PRICE,
    stock_quantity=INT, created_at=TS, updated_at=TS,
)
ORDER = struct(
    order_id=LONG, customer_id=LONG, product_id=LONG, quantity=INT,
    order_date=DATE, total_amount=AMOUNT, order_status=STR,
)
FEEDS: dict[str, T.StructType] = {
    "customers": CUSTOMER, "products": PRODUCT, "orders": ORDER,
}
# Columns without which a feed row can be neither keyed nor placed in time.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "signup_date"),
    "products": ("product_id",),
    "orders": (
        "order_id", "customer_id", "product_id", "quantity", "order_date",
        "total_amount",
    ),
}

# Curated tables --------------------------------------------------------------

DIM_CUSTOMERS = struct(
    customer_key=STR, customer_id=LONG, name=STR, email=STR, phone=STR,
    address=STR, city=STR, state=STR, signup_date=DATE, start_date=TS,
    end_date=TS, is_current=BOOL, updated_at=TS,
)
DIM_PRODUCTS = struct(
    product_key=STR, product_id=LONG, product_name=STR, category=STR,
    price=PRICE, stock_quantity=INT, created_at=TS, updated_at=TS,
)
DIM_DATE = struct(
    date_key=INT, date=DATE, year=INT, quarter=INT, month=INT, month_name=STR,
    day=INT, day_of_week=INT, day_name=STR, is_weekend=BOOL,
)
FACT_ORDERS = struct(
    order_id=LONG, customer_key=STR, product_key=STR, order_date_key=INT,
    quantity=INT, price_each=PRICE, total_amount=AMOUNT, order_status=STR,
    created_at=TS, ingest_date=DATE,
)
DAILY_SALES = struct(
    year=INT, month=INT, order_date_key=INT, customer_state=STR,
    product_category=STR, total_items_sold=LONG, total_sales_usd=TOTAL,
    total_order_count=LONG,
)
TABLES: dict[str, T.StructType] = {
    "dim_customers": DIM_CUSTOMERS, "dim_products": DIM_PRODUCTS,
    "dim_date": DIM_DATE, "fact_orders": FACT_ORDERS,
    "summary_daily_sales": DAILY_SALES,
}
PARTITIONED_BY: dict[str, tuple[str, ...]] = {
    "fact_orders": ("ingest_date", "order_date_key"),
    "summary_daily_sales": ("order_date_key",),
}
# Sort order inside files, so that row groups can be skipped on these columns.
SORTED_BY: dict[str, tuple[str, ...]] = {
    "dim_customers": ("is_current", "customer_id"),
    "dim_products": ("product_id",),
    "dim_date": ("date",),
    "fact_orders": ("order_date_key",),
    "summary_daily_sales": ("order_date_key",),
}
CONSTRAINTS: dict[str, Constraints] = {
    "dim_customers": Constraints(
        primary_key=("customer_key",),
        not_null=("customer_key", "customer_id", "start_date"),
        max_length={
            "customer_key": 64, "name": 100, "email": 100, "phone": 20,
            "address": 255, "city": 100, "state": 50,
        },
    ),
    "dim_products": Constraints(
        primary_key=("product_key",),
        not_null=("product_key", "product_id"),
        max_length={"product_key": 64, "product_name": 150, "category": 100},
    ),
    "dim_date": Constraints(
        primary_key=("date_key",),
        not_null=tuple(DIM_DATE.names),
        max_length={"month_name": 20, "day_name": 20},
    ),
    "fact_orders": Constraints(
        primary_key=("order_id",),
        not_null=(
            "order_id", "customer_key", "product_key", "order_date_key",
            "quantity", "price_each", "total_amount",
        ),
        max_length={"customer_key": 64, "product_key": 64, "order_status": 50},
        foreign_keys={
            "customer_key": ("dim_customers", "customer_key"),
            "product_key": ("dim_products", "product_key"),
            "order_date_key": ("dim_date", "date_key"),
        },
    ),
}

# Least and greatest value a column may have; None is no limit.
RANGES: dict[str, dict[str, tuple]] = {
    "dim_products": {"price": (Decimal("0.01"), None)},
    "fact_orders": {"quantity": (1, None), "order_date_key": (19700101, 99991231)},
}


def same_columns(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Differences in name, order or type; empty when the schemas agree."""
    got = [(f.name, f.dataType.simpleString()) for f in actual]
    want = [(f.name, f.dataType.simpleString()) for f in expected]
    if got == want:
        return []
    problems = [f"missing {c}" for c in want if c not in got]
    problems += [f"unexpected {c}" for c in got if c not in want]
    return problems or ["columns are in another order"]


def assert_schema(actual: T.StructType, expected: T.StructType, what: str) -> None:
    problems = same_columns(actual, expected)
    if problems:
        raise ValueError(f"{what}: {'; '.join(problems)}")


def create_table_sql(table: str, location: str, name: str | None = None) -> str:
    """``CREATE TABLE`` of a curated table over its files."""
    by = PARTITIONED_BY.get(table, ())
    not_null: Iterable[str] = (
        CONSTRAINTS[table].not_null if table in CONSTRAINTS else ()
    )
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (" NOT NULL" if f.name in not_null else "")
        for f in TABLES[table]
    )
    partitions = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name or table} ({columns}) USING parquet"
        f"{partitions} LOCATION '{location}'"
    )
