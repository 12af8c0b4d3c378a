"""Measures against a plain count of windows and lines; SQL equality is in test_sql_oracles."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from starkeel.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words))}
    out["n_symbols"] = sum(c in "#*$%&|<>" for c in text)
    seen, again = set(), []
    for line in text.split("\n"):
        if WORD.search(line):
            again += [line] if line in seen else []
            seen.add(line)
    out["n_dup_lines"], out["dup_line_chars"] = len(again), sum(map(len, again))
    for n in quality_rules.NGRAM_LIMITS:
        places = {}
        for i in range(len(words) - n + 1):
            places.setdefault(tuple(words[i : i + n]), []).append(i)
        inside = {j for at in places.values() for i in at[1:] for j in range(i, i + n)}
        out[f"dup_{n}gram_chars"] = sum(len(words[j]) for j in inside)
        if n == 8:
            out["n_repeat_words"] = len({j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + n)})
    return out


def test_measures(awkward):
    rng = random.Random(5)
    texts = [r["text"] for r in awkward.collect()]
    for _ in range(300):
        pool = [rng.choice(["a", "bb", "cé", "#x", "<你>", "b\x1cb"]) for _ in range(rng.randint(1, 12))]
        seps = [" ", " ", " ", "\n", "\t", "\x0b", " \n"]
        texts.append("".join(rng.choice(pool) + rng.choice(seps) for _ in range(rng.randint(0, 120))))
    got = quality_rules.measure(pa.array(texts, pa.string()))
    rows = [dict(zip(quality_rules.columns(), map(int, r), strict=True)) for r in zip(*got, strict=True)]
    assert rows == [brute(t) for t in texts]


def test_slices_of_a_batch_are_the_same(spark, documents):
    rows = {r["doc_id"]: r.asDict() for r in quality_rules.measures(documents).collect()}
    for r in documents.limit(30).collect():
        assert rows[r["doc_id"]] == {"doc_id": r["doc_id"], **brute(r["text"])}


def test_awkward_rows(awkward, empty):
    got = quality_rules.measures(awkward)
    assert got.columns == ["doc_id", *quality_rules.columns()]
    assert got.count() == 11
    assert got.filter("doc_id is null").first()["n_words"] == 8
    assert all(v == 0 for k, v in got.filter("doc_id = 2").first().asDict().items() if k != "doc_id")
    assert quality_rules.measures(empty).collect() == []
    judged = got.select("doc_id", quality_rules.base_failed().alias("f"), quality_rules.repetitive().alias("r")).collect()
    assert not any(x is None for r in judged for x in (r["f"], r["r"]))


def test_verdicts(spark):
    plain = " ".join(f"w{i}" for i in range(200))
    rows = [(0, plain), (1, plain + "\n" + plain), (2, " ".join(["spam and eggs for all of us"] * 30))]
    rows += [(3, plain + "\n" + " ".join(f"w{i}" for i in range(9)))]
    df = quality_rules.measures(spark.createDataFrame(rows, "doc_id int, text string"))
    kept = {r["doc_id"] for r in df.filter(~quality_rules.base_failed() & ~quality_rules.repetitive()).collect()}
    assert kept == {0, 3}
    strict = quality_rules.repetitive({5: 1})
    assert {r["doc_id"] for r in df.filter(~strict).collect()} == {0}
    assert df.filter(F.col("n_words") < 0).count() == 0
