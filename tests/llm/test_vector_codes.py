"""Codes against plain k-means in Python integers; SQL equality is in test_sql_oracles."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starkeel.llm import queries, vector_codes

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and digest of rows (id, integer vector) in the order of their ids."""
    width = -(-len(rows[0][1]) // parts)
    cut = [[(v + [0] * parts * width)[p * width : (p + 1) * width] for p in range(parts)] for _, v in rows]
    books = [[cut[e][p] for e in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for x in cut:
                groups.setdefault(nearest(x[p], book)[1], []).append(x[p])
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else c for e, c in enumerate(book)]
    found = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [bytes(e for _, e in f) for f in found], [sum(d for d, _ in f) for f in found], digest


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_nearest_with_ties(data):
    width = data.draw(st.integers(1, 9))
    small = st.lists(st.integers(-3, 3), min_size=width, max_size=width)
    x = np.array(data.draw(st.lists(small, min_size=1, max_size=30)), dtype=np.int64)
    entries = np.array(data.draw(st.lists(small, min_size=1, max_size=16)), dtype=np.int64)
    for kind in (np.int64, object):
        entry, least = vector_codes.nearest(x.astype(kind), entries.astype(kind))
        all_of_them = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert entry.tolist() == all_of_them.argmin(axis=1).tolist()
        assert [int(d) for d in least] == all_of_them.min(axis=1).tolist()


def test_transform_keeps_distances():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 5, 8, 12):
        x = rng.integers(-1000, 1000, (20, width))
        t = vector_codes.transformed(x)
        assert ((t**2).sum(axis=1) == t.shape[1] * (x**2).sum(axis=1)).all()
    assert vector_codes._sequency(8).tolist() == [0, 4, 6, 2, 3, 7, 5, 1]


def coded(spark, df, **sizes):
    rows = vector_codes.usable(df)
    books = vector_codes.train(rows, **sizes)
    return books, {r["vec_id"]: r for r in vector_codes.encode(rows, books).collect()}


@pytest.mark.parametrize("dimension,n,scale", [(16, 200, 1.0), (20, 40, 0.01), (3, 5, 2.0), (8, 30, 1e30)])
def test_equals_brute_force(spark, dimension, n, scale):
    rng = random.Random(dimension)
    values = [[float(np.float32(rng.gauss(0, 1) * scale)) for _ in range(dimension)] for _ in range(n)]
    values[n // 2] = values[0]
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(values)], VECTORS).repartition(5)
    whole = [(i, [a * 4096 // b for a, b in (x.as_integer_ratio() for x in v)]) for i, v in enumerate(values)]
    codes, errors, digest = brute(whole)
    books, got = coded(spark, df)
    assert books.digest() == digest
    assert [bytes(got[i]["code"]) for i in range(n)] == codes
    assert [got[i]["error"] for i in range(n)] == [min(e, (1 << 63) - 1) for e in errors]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(i + j) for j in range(8)] for i in range(4)]
    rows = [(5, good[0], 1), (5, good[1], None), (None, good[2], None), (7, good[3], 1), (8, good[3], 2)]
    bad = [(1, None, 1), (2, [nan] * 8, 1), (3, [inf] * 8, 1), (4, [None] + [1.0] * 7, 1), (6, [], 1), (9, [1.0], 1)]
    df = spark.createDataFrame(rows + bad, VECTORS).withColumns({c: F.lit("x") for c in ("code", "error", "of", "part")})
    usable = vector_codes.usable(df)
    books = vector_codes.train(usable)
    got = vector_codes.label_errors(vector_codes.encode(usable, books)).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["5", "5", "7", "8", "None"]
    # The smallest ids begin the codebooks, ties by vector, nulls last: all five are entries here.
    assert {r["error"] for r in got} == {0} and {r["label_error"] for r in got} == {0}
    assert books.entries.shape == (8, 5, 1)
    wide = vector_codes.label_errors(spark.createDataFrame([(1, 1, b"", 2**62), (2, 1, b"", 2**62), (3, None, b"", 5), (4, None, b"", 6)], "vec_id bigint, label int, code binary, error bigint"))
    assert {r["vec_id"]: r["label_error"] for r in wide.collect()} == {1: 2**63 - 1, 2: 2**63 - 1, 3: 11, 4: 11}


def test_empty(spark, tmp_path):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_codes.train(vector_codes.usable(empty)) is None
    empty.write.parquet(str(tmp_path / "embeddings.parquet"))
    assert queries.op13_vector_codes(spark, str(tmp_path)).collect() == []


def test_only_empty_vectors(spark):
    df = spark.createDataFrame([(1, [], 1), (2, [], 1)], VECTORS)
    books, got = coded(spark, df)
    assert {(bytes(r["code"]), r["error"]) for r in got.values()} == {(bytes(8), 0)}
