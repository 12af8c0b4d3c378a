"""Toxicity and language on held-out rows, and awkward rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starkeel.llm import language_id, queries, toxicity
from starkeel.llm import texts as T

LARGER = "/root/testdata/sf0.01"


def test_toxicity_ranks_held_out_rows(spark):
    scored = queries.op6_toxicity(spark, LARGER)
    rows = scored.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    held = [r for r in rows if r["held_out"]]
    toxic = np.array([r["score"] for r in held if r["toxic"] == 1])
    clean = np.array([r["score"] for r in held if r["toxic"] == 0])
    assert (toxic[:, None] > clean[None, :]).mean() > 0.75
    assert (clean >= queries.TOXIC).mean() < 0.02
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_toxic_words_are_learned(spark):
    rows = [(i, f"plain text number {i} of many" + (" vileword" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.filter("doc_id < 300").select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400))
    kept = toxicity.below(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.filter("doc_id % 4 = 0").count() == 0 and kept.count() == 300


def test_toxicity_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (9, 7), (5, 0)], "doc_id bigint, toxic int"
    )
    model = toxicity.fit(awkward, labels)
    scores = [r["score"] for r in toxicity.score(awkward, model).collect()]
    assert len(scores) == 11 and all(0 <= s <= 1 for s in scores)
    none = toxicity.fit(empty, labels.limit(0))
    assert toxicity.score(empty, none).collect() == []
    assert [r["score"] < 1e-6 for r in toxicity.score(awkward, none).collect()] == [True] * 11
    assert toxicity.below(awkward, none, 0.3).count() == 11


def test_language_of_held_out_rows(spark):
    rows = queries.op10_language_id(spark, LARGER).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.99 * len(held)


def test_language_awkward_rows(awkward, empty):
    filters = language_id.fit(awkward)
    assert filters.languages == ("en", "xx")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(awkward, filters).collect()}
    assert got[2] == ("und", 0.0) == got[3] == got[4]
    assert got[9][0] == "xx" and got[7][0] == "en" and 0 <= got[9][1] <= 1
    kept = language_id.identified(awkward, filters, 0.0)
    assert kept.columns == awkward.columns and kept.count() == 8
    nothing = language_id.fit(empty)
    assert nothing.languages == () and language_id.predict(empty, nothing).collect() == []
    assert {r["lang_pred"] for r in language_id.predict(awkward, nothing).collect()} == {"und"}


@pytest.mark.parametrize("n", [3, 70])
def test_filters_hold_any_number_of_languages(n):
    """More than 64 languages take a second word per slot; no member is lost."""
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 2**63, (n, 400), dtype=np.uint64)
    slots = np.zeros((4000 * n, -(-n // 64)), np.uint64)
    own = language_id.Filters(tuple(f"l{i:02}" for i in range(n)), slots)
    for i in range(n):
        own.add(i, grams[i])
    for i in range(n):
        shares = own.shares(grams[i], own.false_rate())
        assert shares[i] > 0.999 and int(np.argmax(shares)) == i
        assert np.delete(shares, i).max() < 0.05


def plain_grams(text, orders):
    """Character n-grams as strings, a space at both ends."""
    low = f" {' '.join(text.lower().split())} "
    return [low[i : i + n] for n in orders for i in range(len(low) - n + 1)]


def bucket(gram):
    return int(T.grams(np.array([ord(c) for c in gram], np.uint32), len(gram))[0] >> np.uint64(64 - toxicity.BITS))


def test_ratios_and_scores_by_plain_counting(spark):
    """Document counts per n-gram from sets of strings, the ratios from their formula, scores from sums."""
    rng = random.Random(3)
    words = ["alpha", "Beta", "gämma", "delta", "vile", "wretch", "foul", "x"]
    rows = []
    for i in range(60):
        toxic = int(i % 3 == 0)
        rows.append((i, " ".join(rng.choice(words[4:] if toxic and rng.random() < 0.6 else words[:5]) for _ in range(rng.randint(1, 9))), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, toxic int")
    held, totals = {0: {}, 1: {}}, [0, 0]
    for _, text, toxic in rows:
        totals[toxic] += 1
        for b in {bucket(g) for g in plain_grams(text, toxicity.ORDERS)}:
            held[toxic][b] = held[toxic].get(b, 0) + 1
    ratio = {}
    for b in {*held[0], *held[1]}:
        clean, bad = held[0].get(b, 0), held[1].get(b, 0)
        share = (clean + bad) / sum(totals)
        of = [(n + toxicity.PRIOR * share) / (t + toxicity.PRIOR) for n, t in ((clean, totals[0]), (bad, totals[1]))]
        if clean + bad >= toxicity.LEAST_DOCS:
            ratio[b] = math.log(of[1]) - math.log(of[0])
    counts = np.zeros((2, 1 << toxicity.BITS), np.int64)
    for k in (0, 1):
        for b, n in held[k].items():
            counts[k, b] = n
    found = toxicity._ratios(counts, np.array(totals))
    assert {int(b): found[b] for b in np.flatnonzero(found)} == pytest.approx({b: r for b, r in ratio.items() if r})
    model = toxicity.fit(docs, labels)
    # Only n-grams with a ratio worth something carry weight, each as often as it is there: once.
    assert set(np.flatnonzero(model.weights).tolist()) <= {b for b, r in ratio.items() if abs(r) > toxicity.LEAST_RATIO}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for i, text, _ in rows:
        z = model.bias + sum(model.weights[b] for b in {bucket(g) for g in plain_grams(text, toxicity.ORDERS)})
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)))
    bad, good = (np.mean([got[i] for i, _, t in rows if t == k]) for k in (1, 0))
    assert bad > good


def test_popcounts_against_plain_sets(spark):
    """Shares per language from sets of n-grams, with the false positives of the filter taken off."""
    rng = random.Random(8)
    words = {"aa": ["lorem", "ipsum", "dolor", "sit"], "bb": ["quick", "brown", "fox", "ipsum"], "cc": ["žluť", "kůň", "pěl", "ódy"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(20)), k) for i, k in enumerate(["aa", "bb", "cc"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = language_id.fit(docs)
    assert filters.languages == ("aa", "bb", "cc")
    sets = {k: Counter() for k in words}
    for _, text, k in rows:
        sets[k].update(plain_grams(text, language_id.ORDERS))
    kept = {k: {g for g, n in c.items() if n >= language_id.SHARE * c.total()} for k, c in sets.items()}
    rate = filters.false_rate()
    asked = [(i, " ".join(rng.choice(sum(words.values(), [])) for _ in range(12))) for i in range(30)]
    got = {r["doc_id"]: r for r in language_id.predict(spark.createDataFrame(asked, "doc_id bigint, text string"), filters).collect()}
    wrong = 0
    for i, text in asked:
        grams = plain_grams(text, language_id.ORDERS)
        hashes = language_id._grams([text])[0]
        assert len(hashes) == len(grams)
        # What the filter says beyond the sets are its false positives, and nothing is denied.
        raw = []
        for n, k in enumerate(filters.languages):
            says = (filters.members(hashes)[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1)
            true = np.array([g in kept[k] for g in grams])
            assert (says[true] == 1).all()
            wrong += int(says[~true].sum())
            raw.append(int(says.sum()))
        shares = [max(0.0, min(1.0, (c / len(grams) - f) / (1 - f))) for c, f in zip(raw, rate, strict=True)]
        best = int(np.argmax(shares))
        assert got[i]["lang_pred"] == filters.languages[best] and got[i]["score"] == pytest.approx(shares[best])
    assert wrong <= 30 * 3 * 200 * 0.05
