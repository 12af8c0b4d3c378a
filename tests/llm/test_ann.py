"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starkeel.llm import ann, queries

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(ids, x, is_query, k=5):
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    found = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        s = (x[q] * x).sum(axis=1)
        at = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        found[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in at]
    return found


def table(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)


def by_query(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return found


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    ids, x = table(spark, sf)
    expected = brute(ids, x, lambda i: i % 50 == 0)
    got = by_query(queries.op7_ann(spark, f"/root/testdata/{sf}"))
    assert set(got) == set(expected)
    scores = {(q, v): s for q, r in expected.items() for v, s in r}
    for q, rows in got.items():
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        for _, v, s in rows:
            assert s == pytest.approx(scores.get((q, v), s), abs=1e-15)
    hits = sum(len({v for v, _ in expected[q]} & {v for _, v, _ in got[q]}) for q in expected)
    assert hits >= 0.9 * 5 * len(expected)


def test_looking_at_everything_is_exact_with_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 9)).astype(np.float32)
    x[40:160] = x[40]
    x[200:220] = 2 * x[200]
    rows = [(i, x[i].tolist(), 0) for i in range(300)]
    df = spark.createDataFrame(rows, VECTORS).repartition(7)
    got = by_query(ann.search(df, F.col("vec_id") % 10 == 0, visited=1.0))
    expected = brute(np.arange(300), x.astype(np.float64), lambda i: i % 10 == 0)
    assert {q: [(v, s) for _, v, s in r] for q, r in got.items()} == expected


def test_blocks_of_queries_find_the_same(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = by_query(ann.search(df, F.col("vec_id") % 20 == 0))
    monkeypatch.setattr(ann, "BLOCK", 2)
    assert by_query(ann.search(df, F.col("vec_id") % 20 == 0)) == whole


def test_walk_takes_cells_by_summed_distance():
    rng = np.random.default_rng(1)
    books = ann.Codebooks(np.zeros((6, 1)), np.zeros((5, 1)))
    for _ in range(20):
        a, b = rng.random(6), rng.random(5)
        sizes = rng.integers(0, 4, 30)
        cells = books.walk(a, b, sizes, 0.6 * sizes.sum())
        total = {i * 5 + j: a[i] + b[j] for i in range(6) for j in range(5) if sizes[i * 5 + j]}
        assert cells == sorted(total, key=total.get)[: len(cells)]
        assert sizes[cells].sum() >= 0.6 * sizes.sum() > sizes[cells[:-1]].sum()


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], None), (None, [1.0, 1.0], 1)]
    rows += [(5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 1.0], 1), (7, [1.0, 1.0], 1), (8, [1.0], 1), (9, [], 1), (10, [3.0, 4.0], 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"cell": F.lit("x"), "score": F.lit("y")})
    got = by_query(ann.search(df, F.col("vec_id") % 5 == 0, visited=1.0))
    assert set(got) == {0, 10}
    assert [v for _, v, _ in got[0]] == [1, 7, 7, 10] and [v for _, v, _ in got[10]] == [1, 7, 7, 0]
    none = spark.createDataFrame([], VECTORS)
    assert ann.search(none, F.col("vec_id") % 5 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1)], VECTORS)
    assert ann.search(alone, F.col("vec_id") == 0).collect() == []
