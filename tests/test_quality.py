"""Checks on feeds and tables."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F
from samples import OPEN, feed, item, order, person, rows_of

from starkeel import schemas
from starkeel.operators import quality as q
from starkeel.operators.conform import CORRUPT, accepted, conform, rejected, with_audit


def test_bad_text_becomes_null_or_is_set_aside(spark):
    raw = feed(spark, "products", [
        item(1, "499.995"), item(2, "n/a"), item("x"), item(3, "123456789.00"),
        (None, *item(4)[1:]), item(5, None),
    ])
    assert rows_of(conform(raw, schemas.PRODUCT), "product_id", "price") == sorted([
        (1, Decimal("500.00")), (2, None), (None, Decimal("10.00")), (3, None),
        (None, Decimal("10.00")), (5, None),
    ], key=repr)
    good = accepted(raw, schemas.PRODUCT, schemas.REQUIRED["products"])
    assert rows_of(good, "product_id") == [(1,), (5,)]
    bad = rejected(raw, schemas.PRODUCT, schemas.REQUIRED["products"])
    assert sorted(r[0] for r in bad.select("reject_reason").collect()) == [
        "bad_price", "bad_price", "bad_product_id", "null_product_id",
    ]
    assert good.count() + bad.count() == raw.count()


def test_all_reasons_are_named_and_corrupt_lines_rejected(spark):
    raw = feed(spark, "orders", [order("x", "y", 1, "2026-13-01", quantity=None)]).withColumn(
        CORRUPT, F.lit("1,2")
    )
    bad = rejected(raw, schemas.ORDER, schemas.REQUIRED["orders"])
    assert bad.first()["reject_reason"].split(",") == [
        "corrupt_row", "bad_order_id", "bad_customer_id", "null_quantity", "bad_order_date",
    ]
    assert accepted(raw, schemas.ORDER).count() == 0


def test_a_customer_without_start_date_is_set_aside(spark):
    raw = feed(spark, "customers", [person(1), person(2, signup=None), person(3, signup="soon")])
    good = accepted(raw, schemas.CUSTOMER, schemas.REQUIRED["customers"])
    assert rows_of(good, "customer_id") == [(1,)]


def test_audit_stamps_only_on_request(spark):
    stamped = with_audit(spark.range(2), "created_at", "updated_at")
    assert stamped.columns == ["id", "created_at", "updated_at"]
    assert stamped.select("created_at").distinct().count() == 1


def test_key_and_reference_checks(spark):
    child = spark.createDataFrame([(1, 5), (1, 6), (2, 9), (3, None)], "id int, ref int")
    parent = spark.createDataFrame([(5,), (6,)], "pk int")
    assert rows_of(q.key_violations(child, ["id"]), "id", "n") == [(1, 2)]
    assert rows_of(q.fk_violations(child, parent, "ref", "pk"), "ref", "n") == [(9, 1)]
    assert rows_of(q.with_parent(child, parent, "ref", "pk"), "id") == [(1,), (1,)]


def test_column_reports(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("abcd", 99999.0), (None, None), ("ab", -1.0)], "s string, x double"
    )
    assert rows_of(q.null_counts(df, ["s", "x"]), "*") == [("s", 1), ("x", 1)]
    assert rows_of(q.length_report(df, {"s": 3}), "*") == [("s", 4, 1)]
    assert rows_of(q.decimal_report(df, {"x": (5, 2)}), "*") == [("x", 3, 1)]
    assert rows_of(q.range_report(df, {"x": (F.lit(0.0), F.lit(10.0))}), "*") == [("x", 1, 1)]
    assert rows_of(q.pattern_violations(df, "s", "b"), "s") == [("a",), (None,)]
    assert rows_of(q.row_counts({"one": df, "two": df.limit(0)}), "*") == [("one", 4), ("two", 0)]


def test_current_flag_check(spark):
    end = dt.datetime(2026, 6, 2)
    df = spark.createDataFrame(
        [(1, OPEN, True), (1, end, False), (2, OPEN, True), (2, OPEN, True), (3, end, False),
         (4, end, True), (5, OPEN, False), (5, OPEN, True)],
        "k int, end_date timestamp, is_current boolean",
    )
    assert rows_of(q.current_flag_violations(df, "k"), "*") == [
        (2, 2, 0), (3, 0, 0), (4, 1, 1), (5, 1, 1),
    ]


def test_continuity_check_agrees_with_sorting_the_versions(spark):
    rng = random.Random(3)
    rows, broken = [], set()
    for key in range(120):
        cuts = sorted(rng.sample(range(20), rng.randrange(2, 6)))
        spans = list(zip(cuts, cuts[1:]))
        flaw = rng.choice(["none", "none", "shift", "drop", "repeat", "invert", "stretch"])
        i = rng.randrange(len(spans))
        a, b = spans[i]
        if flaw == "shift":
            spans[i] = (a + 1, b)
        elif flaw == "drop":
            del spans[i]
        elif flaw == "repeat":
            spans.append((a, b))
        elif flaw == "invert":
            spans[i] = (b, a)
        elif flaw == "stretch":
            spans[i] = (a, b + 1)
        ordered = sorted(spans)
        if any(s >= e for s, e in spans) or any(x[1] != y[0] for x, y in zip(ordered, ordered[1:])):
            broken.add(key)
        rows += [(key, s, e) for s, e in spans]
    df = spark.createDataFrame(rows, "k int, a int, b int")
    found = q.continuity_violations(df, "k", "a", "b")
    assert {r["k"] for r in found.collect()} == broken and broken


def test_schema_comparison_names_what_differs():
    assert schemas.same_columns(schemas.ORDER, schemas.ORDER) == []
    narrow = schemas.struct(order_id=schemas.INT, **{f.name: f.dataType for f in schemas.ORDER.fields[1:]})
    assert any("order_id" in p for p in schemas.same_columns(narrow, schemas.ORDER))
    swapped = schemas.struct(b=schemas.INT, a=schemas.INT)
    assert schemas.same_columns(swapped, schemas.struct(a=schemas.INT, b=schemas.INT)) == [
        "columns are in another order"
    ]


def test_counts_outside_their_limits_are_named(spark):
    frames = {"a": spark.range(5), "b": spark.range(0)}
    found = q.count_expectations(frames, {"a": (5, 5), "b": (1, None)})
    assert rows_of(found, "table_name", "n", "met") == [("a", 5, True), ("b", 0, False)]
    assert q.count_expectations(frames, {"a": (None, 4)}).first()["met"] is False
