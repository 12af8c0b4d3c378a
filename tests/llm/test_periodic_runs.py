"""Runs against brute force: by the definition, word by word."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starkeel.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least):
    """Start, length and period of every maximal stretch, smallest period first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(least, 2 * q))


def own(words, least):
    start, end, period = periodic_runs.find_runs(np.array(words, dtype=np.int64), least)
    return [(int(a), int(b - a), int(q)) for a, b, q in zip(start, end, period, strict=True)]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([1, 4, 12]))
def test_random_words(words, least):
    assert own(words, least) == brute(words, least)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 30)), max_size=8))
def test_powers_of_random_roots(powers):
    words = [w for root, n in powers for w in (root * n)[:n]]
    assert own(words, 2) == brute(words, 2)


def test_progressions_that_meet():
    """Every odd period has a run around the border; no successor distance gives most of them."""
    words = [0, 1] * 20 + [1, 0] * 20
    assert own(words, 2) == brute(words, 2)
    assert len(own(words, 2)) > 10


@pytest.mark.parametrize("words", [[0] * 5000, [0, 1, 2] * 3000, list(range(4000)) * 3, list(range(9000))])
def test_long_runs(words):
    q = len(set(words))
    assert own(words, 12) == ([(0, len(words), q)] if len(words) > q else [])


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_over_the_whole_table(spark, documents):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    planted = 0
    for row in rows:
        words = words_of(row["doc_id"], row["text"])
        planted += words != WORD.findall(row["text"] or "")
        runs = brute(words, 12) if len(words) < 1500 else own_of_text(words)
        r = got[row["doc_id"]]
        best = min(((-n, a, q) for a, n, q in runs), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == ((best[1], -best[0], best[2]) if best else (None,) * 3)
        assert r["exponent_milli"] == (1000 * -best[0] // best[2] if best else None)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 10


def own_of_text(words):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return own([numbers[w] for w in words], 12)


def test_awkward_rows(awkward, empty, spark):
    got = periodic_runs.periodic_runs(awkward).collect()
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got}
    assert (by[2]["n_words"], by[2]["runs"], by[2]["collapsed"]) == (0, [], "")
    assert by[4]["collapsed"] == "" and by[None]["n_words"] == 8
    assert [tuple(x) for x in by[5]["runs"]] == [(0, 60_000, 977)]
    assert by[5]["collapsed"] == " ".join(f"word{i}" for i in range(977))
    assert by[6]["collapsed"].endswith("word976 tail")
    assert periodic_runs.periodic_runs(empty).collect() == []
    kept = periodic_runs.without_repeats(awkward)
    assert kept.columns == awkward.columns and kept.count() == 11
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[2] is None and texts[4] == " \n\t " and texts[9] == "éß 你好 \U0001f600 123 !!"
    assert texts[5] == by[5]["collapsed"]


def test_neighbouring_texts_do_not_meet(spark):
    """Texts of one batch are told apart, and so are words that differ in case or in other spaces."""
    half = " ".join("abcdef")
    rows = [(i, half) for i in range(50)] + [(100, " ".join("aA" * 6)), (101, " ".join(["x\x1cy", "x\x85y"] * 3)), (102, "q\x0bq\x0cq\rq " * 3)]
    got = {r["doc_id"]: r["runs"] for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)).collect()}
    assert not any(got[i] for i in range(50))
    assert [tuple(r) for r in got[100]] == [(0, 12, 2)] and got[101] == []
    assert [tuple(r) for r in got[102]] == [(0, 12, 1)]
    only = spark.createDataFrame([(1, half)], "doc_id int, text string").withColumn("text", F.lit(None).cast("string"))
    assert periodic_runs.periodic_runs(only).collect()[0]["collapsed"] == ""
