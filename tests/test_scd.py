"""Type-1 and Type-2 merges: the documented cases and their edges."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from samples import OPEN, at, feed, item, person, rows_of

from starkeel import schemas
from starkeel.operators.conform import conform
from starkeel.operators.intervals import as_of
from starkeel.operators.scd1 import changed_rows, scd1_init, scd1_upsert
from starkeel.operators.scd2 import (
    CUSTOMERS,
    OVERWRITE,
    Scd2,
    closed_rows,
    current_rows,
    scd2_apply,
    scd2_classify,
    scd2_init,
    scd2_merge,
    scd2_replay,
)


def people(spark, *rows):
    return conform(feed(spark, "customers", list(rows)), schemas.CUSTOMER)


def items(spark, *rows):
    return conform(feed(spark, "products", list(rows)), schemas.PRODUCT)


def test_first_load_opens_one_version_per_customer(spark):
    dim = scd2_init(people(spark, person(1001), person(1002, signup="2026-01-02")))
    assert dim.schema.names == schemas.DIM_CUSTOMERS.names
    got = rows_of(dim, "customer_id", "customer_key", "start_date", "end_date", "is_current")
    assert got == [
        # md5 of '1001_2026-01-01 00:00:00'
        (1001, "67e42088b07efbcc717f08c95a4578ae", at("2026-01-01 00:00:00"), OPEN, True),
        (1002, got[1][1], at("2026-01-02 00:00:00"), OPEN, True),
    ]


def test_a_move_closes_one_version_and_opens_another(spark):
    history = scd2_init(people(
        spark, person(1001, "3 Kiln Lane"), person(1002, "31 Weir Road", "Dayton", "OH")
    ))
    batch = people(
        spark,
        person(1001, "5 Tarn Close", "Bangor", "ME", updated="2026-09-02 10:00:00"),
        person(1003, "70 Mill Walk", "Provo", "UT", signup="2026-09-02"),
    )
    dim = scd2_merge(history, batch, "2026-09-02")
    run = at("2026-09-02 00:00:00")
    assert rows_of(
        dim, "customer_id", "address", "start_date", "end_date", "is_current", "updated_at"
    ) == [
        (1001, "3 Kiln Lane", at("2026-01-01"), run, False, run),
        (1001, "5 Tarn Close", run, OPEN, True, at("2026-09-02 10:00:00")),
        (1002, "31 Weir Road", at("2026-01-01"), OPEN, True, at("2026-01-01 10:00:00")),
        (1003, "70 Mill Walk", run, OPEN, True, at("2026-01-01 10:00:00")),
    ]
    assert dim.select("customer_key").distinct().count() == 4


@pytest.mark.parametrize(
    ("old", "new", "versions"),
    [("A", "A", 1), ("A", "B", 2), (None, "B", 2), ("A", None, 2), (None, None, 1)],
)
def test_null_is_a_value_like_any_other(spark, old, new, versions):
    history = scd2_init(people(spark, person(1, old)))
    dim = scd2_merge(history, people(spark, person(1, new)), "2026-09-02")
    assert dim.count() == versions
    assert [r[0] for r in rows_of(current_rows(dim), "address")] == [new]


def test_untracked_columns_keep_or_follow(spark):
    history = scd2_init(people(spark, person(1, name="Ann"), person(2, name="Bea")))
    batch = people(
        spark, person(1, name="Anna", updated="2026-09-02 09:00:00"),
        person(2, "moved", name="Beate"),
    )
    kept = scd2_merge(history, batch, "2026-09-02")
    assert rows_of(kept, "customer_id", "name", "is_current") == [
        (1, "Ann", True), (2, "Bea", False), (2, "Beate", True),
    ]
    spec = Scd2(
        CUSTOMERS.key, CUSTOMERS.surrogate, CUSTOMERS.attributes, CUSTOMERS.tracked,
        CUSTOMERS.start_from, untracked=OVERWRITE,
    )
    followed = scd2_merge(history, batch, "2026-09-02", spec)
    assert rows_of(followed, "customer_id", "name", "is_current", "updated_at") == [
        (1, "Anna", True, at("2026-09-02 09:00:00")),
        (2, "Bea", False, at("2026-09-02 00:00:00")),
        (2, "Beate", True, at("2026-01-01 10:00:00")),
    ]


def test_closed_versions_pass_and_a_returning_key_is_new(spark):
    first = scd2_init(people(spark, person(1, "A"), person(2, "A")))
    second = scd2_merge(first, people(spark, person(1, "B")), "2026-09-02")
    only_closed = second.filter("customer_id = 1 and not is_current").unionByName(
        second.filter("customer_id = 2")
    )
    back = scd2_merge(only_closed, people(spark, person(1, "C", signup="2026-09-05")), "2026-09-07")
    assert rows_of(back, "customer_id", "address", "is_current", "start_date") == [
        (1, "A", False, at("2026-01-01")), (1, "C", True, at("2026-09-05")),
        (2, "A", True, at("2026-01-01")),
    ]
    spec = Scd2(
        CUSTOMERS.key, CUSTOMERS.surrogate, CUSTOMERS.attributes, CUSTOMERS.tracked,
        CUSTOMERS.start_from, new_from="run_date",
    )
    at_run = scd2_merge(only_closed, people(spark, person(1, "C")), "2026-09-07", spec)
    assert (1, "C", at("2026-09-07")) in rows_of(at_run, "customer_id", "address", "start_date")


def test_empty_batch_changes_nothing_and_empty_history_is_a_first_load(spark):
    history = scd2_init(people(spark, person(1), person(2)))
    nobody = people(spark, person(1)).limit(0)
    assert rows_of(scd2_merge(history, nobody, "2026-09-02"), "*") == rows_of(history, "*")
    batch = people(spark, person(7))
    from_nothing = scd2_merge(history.limit(0), batch, "2026-09-02")
    assert rows_of(from_nothing, "*") == rows_of(scd2_init(batch), "*")


def test_replay_equals_merging_step_by_step(spark):
    days = [dt.date(2026, 9, d) for d in (2, 3, 4)]
    batches = [
        people(spark, *[person(i, f"{(i * d) % 3}") for i in range(1, 9) if (i + d) % 2])
        for d in range(4)
    ]
    step = scd2_init(batches[0])
    for day, batch in zip(days, batches[1:]):
        step = scd2_merge(step, batch, day)
    replayed = scd2_replay(batches[0], list(zip(days, batches[1:])))
    assert rows_of(replayed, *step.columns) == rows_of(step, *step.columns)
    assert current_rows(step).count() == step.select("customer_id").distinct().count()
    assert closed_rows(step).count() > 0


def test_replay_equals_merges_one_after_the_other(spark):
    rng = random.Random(5)
    batches = []
    for n in range(5):
        keys = rng.sample(range(25), 14)
        batches.append(people(spark, *[
            person(i, rng.choice([None, "A", "B"]), name=f"N{n}", updated=f"2026-0{n + 1}-01 08:00:00") for i in keys
        ]))
    days = [f"2026-09-0{n + 1}" for n in range(4)]
    for untracked in ("history", OVERWRITE):
        spec = Scd2(
            CUSTOMERS.key, CUSTOMERS.surrogate, CUSTOMERS.attributes, CUSTOMERS.tracked,
            CUSTOMERS.start_from, untracked=untracked,
        )
        one_by_one = scd2_init(batches[0], spec)
        for day, batch in zip(days, batches[1:], strict=True):
            one_by_one = scd2_merge(one_by_one, batch, day, spec)
        at_once = scd2_replay(batches[0], list(zip(days, batches[1:], strict=True)), spec)
        assert at_once.schema.names == one_by_one.schema.names
        assert rows_of(at_once, "*") == rows_of(one_by_one, "*")
    plan = at_once._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("hashpartitioning") == 1


def test_outcomes_name_every_key_once(spark):
    history = scd2_init(people(spark, person(1), person(2), person(3, None)))
    batch = people(spark, person(2, "moved"), person(3, None), person(4))
    assert rows_of(scd2_classify(history, batch), "customer_id", "outcome") == [
        (1, "absent"), (2, "changed"), (3, "unchanged"), (4, "new"),
    ]


def test_as_of_returns_the_version_of_the_day(spark):
    dim = scd2_merge(
        scd2_init(people(spark, person(1001, "NY home"))),
        people(spark, person(1001, "CA home")), "2026-09-02",
    )
    seen = {
        day: rows_of(as_of(dim, day), "address")
        for day in ("2025-12-31", "2026-02-15", "2026-09-02", "2026-09-10")
    }
    assert seen == {
        "2025-12-31": [], "2026-02-15": [("NY home",)],
        "2026-09-02": [("CA home",)], "2026-09-10": [("CA home",)],
    }


def test_latest_product_wins_with_its_nulls(spark):
    history = scd1_init(
        items(spark, item(5001, "312.40", "60"), item(5002, "7.00")), "product_id", "product_key"
    )
    batch = items(
        spark, item(5001, "287.50", "44", category=None, updated="2026-09-02 12:00:00"),
        item(5003, "1.00"),
    )
    dim = scd1_upsert(history, batch, "product_id", "product_key")
    assert dim.schema.names == schemas.DIM_PRODUCTS.names
    assert rows_of(dim, "product_id", "price", "stock_quantity", "category", "updated_at") == [
        (5001, Decimal("287.50"), 44, None, at("2026-09-02 12:00:00")),
        (5002, Decimal("7.00"), 5, "Books", at("2026-01-01")),
        (5003, Decimal("1.00"), 5, "Books", at("2026-01-01")),
    ]
    same_keys = history.select("product_id", "product_key")
    assert dim.join(same_keys, ["product_id", "product_key"]).count() == 2


def test_changed_rows_are_the_minimal_feed(spark):
    base = people(spark, person(1, "A"), person(2, None), person(3, "A"))
    updates = people(spark, person(1, "A", name="Zoe"), person(2, "B"), person(9, "A"))
    assert rows_of(changed_rows(base, updates, "customer_id", ["address"]), "customer_id") == [
        (2,), (9,),
    ]
