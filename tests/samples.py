"""Small frames in the shape of the feeds and tables."""

from __future__ import annotations

import datetime as dt

from starkeel import schemas

OPEN = dt.datetime(9999, 12, 31, 23, 59, 59)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def person(i, address="2 Ferry Row", city="Albany", state="NY", signup="2026-01-01",
           updated="2026-01-01 10:00:00", name="Ann"):
    return (str(i), name, f"{name}{i}@test.com", f"555-{i}", address, city, state, signup, updated)


def item(i, price="10.00", stock="5", category="Books", updated="2026-01-01 00:00:00"):
    return (str(i), f"Item {i}", category, price, stock, "2026-01-01 00:00:00", updated)


def order(i, customer, product, day, quantity="1", total="10.00", status="Shipped"):
    return (str(i), str(customer), str(product), quantity, day, total, status)


def feed(spark, table, rows):
    return spark.createDataFrame(rows, schemas.all_text(schemas.FEEDS[table]))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
