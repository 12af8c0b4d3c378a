"""Leaks against brute-force edit distance."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starkeel.llm import decontaminate as D
from starkeel.llm import queries


def fewest(item, text):
    """Edits of ``item`` at its best place in ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_query_over_the_whole_table(spark, documents):
    found = queries.op9_decontamination(spark, "/root/testdata/sf0.001").collect()
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    for d in documents.collect():
        for i in items:
            if D.normal(i["text"]) in D.normal(d["text"]):
                assert got.pop((d["doc_id"], i["item_id"])) == 0
    texts = {d["doc_id"]: d["text"] for d in documents.collect()}
    items = {i["item_id"]: i["text"] for i in items}
    for (d, i), edits in got.items():
        assert 0 < edits == fewest(D.normal(items[i]), D.normal(texts[d]))


def test_edits_up_to_the_budget():
    rng = random.Random(3)
    letters = "abcdefghij klmnop"
    for _ in range(60):
        m = rng.randrange(30, 160)
        item = D.normal("".join(rng.choice(letters) for _ in range(m))).ljust(20, "q")
        index = D.Index.of([(1, item)])
        copy = list(item)
        for _ in range(rng.randrange(0, D.budget(len(item)) + 4)):
            at = rng.randrange(len(copy))
            kind = rng.randrange(3)
            copy[at : at + 1] = [] if kind == 0 else ["z"] if kind == 1 else [copy[at], "z"]
        around = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 300))) for _ in range(2)]
        text = D.normal(around[0] + "".join(copy) + around[1])
        edits = fewest(item, text)
        found = D._matches(index, ["other text", text])
        assert not found[0]
        if edits <= D.budget(len(item)):
            assert found[1][0][0] == edits
        else:
            assert not found[1]


def test_alignment_at_the_ends():
    item = np.array([1, 2, 3, 4, 5], np.uint32)
    assert D.aligned(item, item, -2, 2, 1) == (0, 5)
    assert D.aligned(item, item[1:], -2, 2, 1) == (1, 4)
    assert D.aligned(item, item[:-1], -2, 2, 1)[0] == 1
    assert D.aligned(item, np.array([9, 9], np.uint32), -2, 2, 2) is None


def test_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame(
        [(1, "three FOUR  five six"), (1, "three four five six"), (2, None), (3, ""), (4, "five"), (None, "word5 word6 word7")],
        "item_id bigint, text string",
    )
    found = D.leaks(awkward, items)
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in found.collect())
    assert got == [("1", "1")] * 4 + [("1", "4")] * 2 + [("5", "None"), ("6", "None")] + [("None", "1")] * 2 + [("None", "4")]
    kept = D.without_leaks(awkward, items)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 7, 8, 9]
    assert D.leaks(empty, items).collect() == [] and D.leaks(awkward, items.limit(0)).collect() == []
    assert D.without_leaks(awkward, items.limit(0)).count() == 11


def test_blocks_find_the_same(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(tuple, D.leaks(documents, items).collect()))
    assert sorted(map(tuple, D.leaks(documents, items, block_chars=1500).collect())) == whole


@pytest.mark.parametrize("kind", ["smallint", "decimal(20,3)", "string", "date", "bigint"])
def test_short_items_and_ids_of_any_type(spark, kind):
    items = [(1, "42 here"), (2, "abc"), (3, "  "), (4, ""), (5, None), (6, "X"), (7, "an item that is long enough to have grams")]
    of = F.date_add(F.lit("2026-01-01").cast("date"), F.col("n")) if kind == "date" else F.col("n").cast(kind)
    benchmark = spark.createDataFrame(items, "n int, text string").select(of.alias("item_id"), "text")
    texts = ["answer 42 here", "42 hereby", "ABC, (x)!", "abcd xyz", "", None, "He said: an item that is long enough to have grams.", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    ids = {n: r["item_id"] for n, r in zip(range(1, 8), benchmark.collect(), strict=True)}
    got = {(r["doc_id"], r["item_id"], r["edits"], r["end_char"]) for r in D.leaks(docs, benchmark).collect()}
    assert got == {(0, ids[1], 0, 14), (2, ids[2], 0, 3), (2, ids[6], 0, 7), (6, ids[7], 0, 50), (7, ids[6], 0, 1)}
    assert sorted(r["doc_id"] for r in D.without_leaks(docs, benchmark).collect()) == [1, 3, 4, 5]
