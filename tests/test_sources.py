"""Raw zone, snapshots, partitioned tables, catalog."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from samples import feed, item, person, rows_of

from starkeel import schemas
from starkeel.lineage import checkpoint_dir, staged
from starkeel.operators.conform import CORRUPT
from starkeel.operators.facts import date_dimension
from starkeel.operators.scd1 import scd1_init
from starkeel.operators.conform import conform
from starkeel.sources import catalog, commits, facts, files, layout, raw, snapshots

D1, D2, D3 = dt.date(2026, 6, 1), dt.date(2026, 6, 2), dt.date(2026, 6, 3)


def test_raw_round_trip_and_rerun(spark, tmp_path):
    root = str(tmp_path)
    sent = feed(spark, "customers", [person(1, 'Flat "B", 2 \\ 3'), person(2, None)])
    raw.write_raw(sent.union(sent), root, "customers", D1)
    path = raw.write_raw(sent, root, "customers", "2026-06-01")
    assert path.endswith("customers/ingest_date=2026-06-01")
    got = raw.read_raw(spark, root, "customers", D1).cache()
    assert rows_of(got.drop(CORRUPT), *sent.columns) == rows_of(sent, *sent.columns)
    assert got.filter(F.col(CORRUPT).isNotNull()).isEmpty()
    with pytest.raises(raw.MissingInput):
        raw.read_raw(spark, root, "customers", D2)


def test_wrong_headers_and_broken_lines(spark, tmp_path):
    place = tmp_path / "products" / "ingest_date=2026-06-01"
    place.mkdir(parents=True)
    header = ",".join(schemas.PRODUCT.names)
    (place / "a.csv").write_text(f"{header}\n" + ",".join(item(1)) + "\n2,short\n")
    got = raw.read_raw(spark, str(tmp_path), "products", D1).cache()
    assert [r[0] for r in got.select(CORRUPT).orderBy("product_id").collect()] == [None, "2,short"]
    place2 = tmp_path / "products" / "ingest_date=2026-06-02"
    place2.mkdir()
    (place2 / "a.csv").write_text(header.replace("price", "cost") + "\n" + ",".join(item(1)) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_raw(spark, str(tmp_path), "products", D2).collect()


def test_publish_copies_every_line_unchanged(spark, tmp_path):
    inbox = tmp_path / "landing" / "ingest_date=2026-06-01"
    inbox.mkdir(parents=True)
    header = ",".join(schemas.CUSTOMER.names)
    lines = [',"x, y", a ""q"" ,\\,  ', "short", ",".join(person(3)), "é,ß,,,,,,,"]
    (inbox / "customers.csv").write_text("\n".join([header, *lines]) + "\n")
    (inbox / "notes.txt").write_text("not a feed")
    root = str(tmp_path / "raw")
    plan = raw.publish(spark, str(tmp_path / "landing"), root, D1, dry_run=True)
    assert [r["table_name"] for r in plan.collect()] == ["customers"]
    assert not files.exists(spark, root)
    raw.publish(spark, str(tmp_path / "landing"), root, D1)
    raw.publish(spark, str(tmp_path / "landing"), root, D1)
    written = spark.read.text(raw.raw_path(root, "customers", D1))
    assert sorted(r[0] for r in written.collect()) == sorted([header, *lines])
    with pytest.raises(raw.MissingInput):
        raw.publish(spark, str(tmp_path / "landing"), root, D2)


def test_publish_keeps_blank_and_header_like_lines_and_refuses_mixed_headers(spark, tmp_path):
    inbox = tmp_path / "landing" / "ingest_date=2026-06-01" / "orders.csv"
    inbox.mkdir(parents=True)
    (inbox / "part-0.csv").write_text("a,b\n1,2\n\na,b\n")
    (inbox / "part-1.csv").write_text("a,b\n3,4\n")
    root = str(tmp_path / "raw")
    raw.publish(spark, str(tmp_path / "landing"), root, D1)
    lines = []
    for f in sorted((tmp_path / "raw" / "orders" / "ingest_date=2026-06-01").glob("part-*")):
        header, *rest = f.read_text().split("\n")[:-1]
        assert header == "a,b"
        lines += rest
    assert sorted(lines) == ["", "1,2", "3,4", "a,b"]
    (inbox / "part-1.csv").write_text("b,a\n4,3\n")
    with pytest.raises(RuntimeError, match="orders"):
        raw.publish(spark, str(tmp_path / "landing"), root, D1)


def test_publish_reports_a_failed_table_after_the_others(spark, tmp_path):
    inbox = tmp_path / "landing" / "ingest_date=2026-06-01"
    inbox.mkdir(parents=True)
    (inbox / "customers.csv").write_text("")
    (inbox / "orders.csv").write_text("a,b\n1,2\n")
    root = str(tmp_path / "raw")
    with pytest.raises(RuntimeError, match="customers"):
        raw.publish(spark, str(tmp_path / "landing"), root, D1)
    assert files.exists(spark, raw.raw_path(root, "orders", D1))


def test_nothing_landed_is_only_a_warning(spark, tmp_path, caplog):
    (tmp_path / "ingest_date=2026-06-01").mkdir()
    assert raw.publish(spark, str(tmp_path), str(tmp_path / "raw"), D1).isEmpty()
    assert "no CSV files" in caplog.text


def products(spark, *rows):
    batch = conform(feed(spark, "products", list(rows)), schemas.PRODUCT)
    return scd1_init(batch, "product_id", "product_key")


def run_of(spark, state, day, *rows):
    df = products(spark, *rows).withColumn(snapshots.RUN, F.lit(day))
    return snapshots.write_runs(df, state, "dim_products", [day], [day], schemas.DIM_PRODUCTS, ("product_id",))


def test_only_committed_runs_before_the_date_count(spark, tmp_path):
    state = commits.latest(spark, str(tmp_path))
    assert state.number == 0 and snapshots.latest_run(state, "dim_products") is None
    assert snapshots.read_table(spark, state, "dim_products", D3, schemas.DIM_PRODUCTS) is None
    for day, price in ((D1, "1.00"), (D2, "2.00")):
        state = commits.commit(spark, state, run_of(spark, state, day, item(1, price)))
    run_of(spark, state, D3, item(1, "3.00"))  # written, never committed
    state = commits.latest(spark, str(tmp_path))
    assert snapshots.latest_run(state, "dim_products") == D2
    assert snapshots.latest_run(state, "dim_products", before=D2) == D1
    assert snapshots.latest_run(state, "dim_products", before="2026-06-01") is None
    now = snapshots.read_table(spark, state, "dim_products", D3, schemas.DIM_PRODUCTS)
    assert [str(r["price"]) for r in now.collect()] == ["2.00"]


def test_a_list_appears_once_and_whole(spark, tmp_path):
    first = commits.latest(spark, str(tmp_path))
    state = first.replacing("t", "day", [], [commits.Part("t", "day", "é", "t/write=1/a", ("1", "2"))])
    assert commits.commit(spark, first, first) == first
    done = commits.commit(spark, first, state)
    assert commits.latest(spark, str(tmp_path)) == done and done.parts == state.parts
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, first, state.replacing("t", "day", [], [commits.Part("t", "day", "b")]))
    assert commits.latest(spark, str(tmp_path)) == done
    assert files.children(spark, str(tmp_path / "_commits")) == ["0000000001"]


def test_a_store_that_cannot_be_reached_is_not_an_empty_one(spark):
    with pytest.raises(Exception, match="(?i)scheme"):
        commits.latest(spark, "nosuch://store/zone")


def test_a_wrong_schema_is_not_written(spark, tmp_path):
    state = commits.State(str(tmp_path))
    with pytest.raises(ValueError, match="product_key"):
        snapshots.write_runs(
            spark.range(1).withColumn(snapshots.RUN, F.lit(D1)), state, "t", [D1], [D1], schemas.DIM_PRODUCTS, ("product_id",)
        )
    assert not (tmp_path / "t").exists()


def test_closed_versions_of_a_thousand_runs(spark, tmp_path, monkeypatch):
    """Put together by month: as many directories as months, and two calls to the store for the list."""
    schema = schemas.struct(key=schemas.STR, id=schemas.LONG, end_date=schemas.TS, is_current=schemas.BOOL)
    first, n = dt.date(2024, 1, 1), 1000
    days = [first + dt.timedelta(days=i) for i in range(n)]
    parts = []
    for i, day in enumerate(days):
        path = f"dim/write=w{i}/run_date={day.isoformat()}/is_current=false"
        (tmp_path / path).mkdir(parents=True)
        rows = pa.table({"key": [f"k{i}", f"l{i}"], "id": [i, i % 7], "end_date": pa.array([dt.datetime(*day.timetuple()[:3])] * 2, pa.timestamp("us", "UTC"))})
        pq.write_table(rows, tmp_path / path / "part-0.parquet")
        label = day.isoformat()
        parts.append(commits.Part("dim", snapshots.CLOSED, label, path, (label, label)))
        kept = i >= n - 20
        parts.append(commits.Part("dim", snapshots.CURRENT if kept else snapshots.FREED, label))
    empty = commits.State(str(tmp_path))
    before = commits.commit(spark, empty, empty.replacing("dim", "", [], parts))
    after = snapshots.compact_closed(spark, before, "dim", schema, ("is_current", "id"))
    after = commits.commit(spark, before, after)
    months = {(d.year, d.month) for d in days}
    assert len(after.of("dim", snapshots.CLOSED)) <= len(months) + 31
    calls = []
    for name in ("exists", "children", "matching", "read_text"):
        monkeypatch.setattr(files, name, lambda *a, f=getattr(files, name): calls.append(f) or f(*a))
    state = commits.latest(spark, str(tmp_path))
    rows = snapshots.read_closed(spark, state, "dim", days[-1], schema)
    assert len(calls) == 2
    assert rows.count() == 2 * n and rows.select("key").distinct().count() == 2 * n
    some = snapshots.read_closed(spark, state, "dim", days[99], schema, ended_after=days[95])
    # Whole directories are skipped from below, rows are cut off exactly above.
    assert some.agg(F.max("end_date")).first()[0].date() == days[99]
    assert {f"k{i}" for i in range(95, 100)} <= {r["key"] for r in some.collect()}
    assert snapshots.compact_closed(spark, state, "dim", schema, ("is_current", "id")) == state
    commits.sweep(spark, str(tmp_path), keep=1)
    assert snapshots.read_closed(spark, state, "dim", days[-1], schema).count() == 2 * n
    assert len(files.children(spark, str(tmp_path / "dim"))) <= 33


SALES = schemas.struct(id=schemas.INT, day=schemas.INT, v=schemas.STR)


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), SALES)


RUNS = schemas.struct(id=schemas.INT, day=schemas.INT, v=schemas.STR, ingest_date=schemas.DATE)


def stored(spark, state, day, *rows):
    df = sales(spark, *rows).withColumn("ingest_date", F.lit(day))
    return facts.write_days(df, state, "fact", [day], RUNS, "day")


def test_a_run_replaces_what_it_wrote_and_nothing_else(spark, tmp_path):
    state = commits.State(str(tmp_path))
    assert facts.read_days(spark, state, "fact", RUNS, "day").isEmpty()
    state = stored(spark, state, D1, (1, 20260601, "a"), (2, 20260602, "a"))
    state = stored(spark, state, D2, (3, 20260602, "b"))
    state = stored(spark, state, D1, (1, 20260603, "c"))
    assert rows_of(facts.read_days(spark, state, "fact", RUNS, "day"), "*") == [
        (1, 20260603, "c", D1), (3, 20260602, "b", D2),
    ]
    assert rows_of(facts.read_days(spark, state, "fact", RUNS, "day", days=[D1]), "id") == [(1,)]
    assert rows_of(facts.read_days(spark, state, "fact", RUNS, "day", but=[D1]), "id") == [(3,)]
    assert facts.dates_of(state, "fact", [D1, D2]) == {20260602, 20260603}
    state = stored(spark, state, D1)
    assert rows_of(facts.read_days(spark, state, "fact", RUNS, "day"), "id") == [(3,)]


def test_one_date_opens_only_its_directories(spark, tmp_path):
    state = commits.State(str(tmp_path))
    for day in (D1, D2):
        state = stored(spark, state, day, *[(i, i, "a") for i in range(9)])
    part = facts.read_days(spark, state, "fact", RUNS, "day", dates={3, 77})
    assert len(part.inputFiles()) == 2 and rows_of(part, "id") == [(3,), (3,)]


def test_replacing_dates_leaves_the_others(spark, tmp_path):
    state = commits.State(str(tmp_path))
    df = sales(spark, (1, 1, "a"), (2, 2, "a"), (3, 2, "a"), (4, 3, "a"))
    state = facts.write_dates(df, state, "summary", {1, 2, 3}, SALES, "day")
    state = facts.write_dates(sales(spark, (9, 2, "b")), state, "summary", {2, 3, 4}, SALES, "day")
    assert rows_of(facts.read_dates(spark, state, "summary", SALES), "*") == [(1, 1, "a"), (9, 2, "b")]
    assert rows_of(facts.read_dates(spark, state, "summary", SALES, {2, 5}), "id") == [(9,)]


def scan_rows(df):
    """Rows that the Parquet reader handed out, by the scan's own metric."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollectPublic()
    leaves = query.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("many", [False, True])
def test_a_search_by_id_skips_row_groups(spark, tmp_path, many):
    """Scattered ids by Bloom filter; more than can be named, by ranges that statistics answer."""
    schema = schemas.struct(id=schemas.LONG, day=schemas.INT, v=schemas.STR, ingest_date=schemas.DATE)
    days, per_day = [D1 + dt.timedelta(days=n) for n in range(50)], 4000
    at = F.col("id") % 50 if not many else F.floor(F.col("id") / per_day)
    rows = spark.range(50 * per_day).select(
        "id", F.lit(1).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.date_add(F.lit(D1), at.cast("int")).alias("ingest_date"),
    )
    state = facts.write_days(rows, commits.State(str(tmp_path)), "fact", days, schema, "day", "id")
    if many:  # five stretches of new and old ids
        ids = spark.range(2000).select((F.col("id") % 400 + F.floor(F.col("id") / 400) * 37 * 1000).alias("id"))
    else:
        ids = spark.createDataFrame([(7 + 1111 * n,) for n in range(4)] + [(10**12,)], "id bigint")
    stored = facts.read_days(spark, state, "fact", schema, "day")
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = stored.filter(facts.among("id", ids)).select("id")
        read = scan_rows(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    assert rows_of(found.join(ids, "id", "left_semi"), "id") == rows_of(ids.filter(f"id < {50 * per_day}"), "id")
    assert 0 < read <= 50 * per_day / 5
    assert stored.filter(facts.among("id", ids.limit(0))).isEmpty()


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    df = spark.range(200_000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 > 0, 1).otherwise((F.col("id") % 50).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        state = facts.write_days(
            df.withColumn("ingest_date", F.lit(D1)), commits.State(str(tmp_path)), "fact", [D1], RUNS, "day"
        )
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    run = tmp_path / state.of("fact")[0].path
    hot = list((run / "day=1").glob("*.parquet"))
    single = [
        d for d in run.glob("day=*") if len(list(d.glob("*.parquet"))) == 1
    ]
    # Days that hash together with the hot one share its tasks; the rest do not.
    assert len(hot) > 3 and len(single) > 10


def test_catalog_tables_see_new_partitions(spark, tmp_path):
    days = spark.createDataFrame([(D1,), (D2,)], "date date")
    path = str(tmp_path / "dim_date")
    date_dimension(days).write.parquet(path)
    name = catalog.define(spark, "dim_date", path, "cat_dim_date")
    assert [r["day_name"] for r in spark.table(name).orderBy("date").collect()] == [
        "Monday", "Tuesday",
    ]
    where = str(tmp_path / "summary")
    catalog.define(spark, "summary_daily_sales", where, "cat_summary")
    row = spark.createDataFrame(
        [(2026, 6, 20260601, "NY", "Books", 1, None, 1)], schemas.DAILY_SALES
    )
    row.write.partitionBy("order_date_key").parquet(where, mode="append")
    catalog.register_partitions(spark, "cat_summary")
    assert spark.table("cat_summary").filter("order_date_key = 20260601").count() == 1
    for t in ("cat_dim_date", "cat_summary"):
        spark.sql(f"drop table {t}")


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for t in ("bucket_a", "bucket_b"):
        layout.save_bucketed(df, t, "k", 4, ["k"])
    joined = spark.table("bucket_a").hint("merge").join(spark.table("bucket_b"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    for t in ("bucket_a", "bucket_b"):
        spark.sql(f"drop table {t}")


def test_staged_tables_are_removed(spark):
    with staged(spark.range(5), "probe") as df:
        assert df.count() == 5
        assert any(n.startswith("probe-") for n in files.children(spark, checkpoint_dir(spark)))
    with pytest.raises((AnalysisException, Exception)):
        df.collect()
    assert not any(n.startswith("probe-") for n in files.children(spark, checkpoint_dir(spark)))
