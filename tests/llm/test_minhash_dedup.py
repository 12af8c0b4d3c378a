"""Near duplicates against brute force on full sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starkeel.llm import minhash_dedup, queries

DOCS = "doc_id bigint, text string"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    """Size and component of each (id, text), by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    smallest = {}
    for n, (i, _) in enumerate(sets):
        smallest[find(n)] = min(i, smallest.get(find(n), i))
    return {i: (len(s), smallest[find(n)]) for n, (i, s) in enumerate(sets)}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_over_the_whole_table(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    result = queries.op1_minhash_dedup(spark, "/root/testdata/sf0.001")
    assert got(result) == expected(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in result.collect())


def edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def test_chains_of_copies(spark):
    rng = random.Random(1)
    rows = []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(200)]
        for _ in range(6):
            rows.append(" ".join(words))
            words = edited(words, 2, rng).split()
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, DOCS)
    assert got(minhash_dedup.near_duplicates(df)) == expected(rows)


def test_a_group_dense_at_the_threshold(spark):
    """150 texts mostly alike just below the threshold: no false link, and few missed.

    Hashing finds candidates with a probability; here 1 text of 150 misses its link.
    """
    rng = random.Random(1)
    base = [f"b{i}" for i in range(150)]
    rows = list(enumerate(edited(base, rng.randrange(1, 9), rng) for _ in range(150)))
    found = got(minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)))
    truth = expected(rows)
    assert all(truth[i][1] == truth[c][1] for i, (_, c) in found.items())
    assert sum(found[i] != truth[i] for i in truth) <= 2


def test_a_hot_group_of_copies(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text if i % 3 else f"{text} {i} and so on and on {i * 7} {i} no {i}") for i in range(600)]
    result = got(minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)))
    assert result == expected(rows)


def test_awkward_rows(spark, awkward, empty):
    rows = minhash_dedup.near_duplicates(awkward).collect()
    assert len(rows) == 11
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[1] == [(4, 1, True)] * 2
    assert by_id[None] == [(4, None, True)]
    assert by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)] and by_id[4] == [(0, 4, True)]
    assert by_id[6][0][1:] == (5, False) and by_id[5][0][1:] == (5, True)
    assert by_id[7] == [(1, 7, True)] and by_id[8] == [(1, 7, False)]
    assert minhash_dedup.near_duplicates(empty).collect() == []


def test_one_of_each_keeps_columns(awkward, empty):
    kept = minhash_dedup.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == ["1", "2", "3", "4", "5", "7", "9", "None"]
    assert minhash_dedup.one_of_each(empty).collect() == []


@pytest.mark.parametrize("window", [1, 2])
def test_window_goes_past_its_own_component(window):
    """Rows of one component side by side do not hide the row after them."""
    import numpy as np
    import pyarrow as pa

    n = 30
    key = np.zeros((n, minhash_dedup.DEPTH), ">u4")
    rows = pa.RecordBatch.from_arrays(
        [
            pa.array(np.zeros(n, np.int32)),
            pa.array([k.tobytes() for k in key], pa.binary()),
            pa.array(np.arange(n)),
            pa.array(np.repeat([0, 20], [20, 10])),
            pa.array([b"\0" * (minhash_dedup.HASHES // 8)] * n, pa.binary()),
        ],
        ["tree", "key", "node", "component", "sketch"],
    )
    batches = [rows.slice(a, 7) for a in range(0, n, 7)]
    found = {(r["u"], r["v"]) for b in minhash_dedup._neighbours(window, 100)(batches) for r in b.to_pylist()}
    assert found == {(a, b) for a in range(20) for b in range(20, 20 + window)}


def just_below(seed, groups=4, size=150):
    """Groups in which two texts are linked, each also alike just below the threshold to most others."""
    rng, texts = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}b{i}" for i in range(150)]
        texts += [edited(base, 1 if i < 2 else 2, rng) for i in range(size)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_no_link_is_missed_just_above_many_refuted_pairs(spark):
    rows = just_below(1)
    assert got(minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS))) == expected(rows)


def test_rounds_that_see_little_lose_nothing(spark, monkeypatch):
    """With one neighbour a round, rounds end early and drop rows; the result is whole all the same."""
    rows = just_below(2)
    monkeypatch.setattr(minhash_dedup, "WINDOW", 1)
    assert got(minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS))) == expected(rows)


def many(n, components, sketches):
    import numpy as np
    import pyarrow as pa

    key = b"\0" * (4 * minhash_dedup.DEPTH)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.zeros(n, np.int32)),
            pa.array([key] * n, pa.binary()),
            pa.array(np.arange(n)),
            pa.array(components),
            pa.array(sketches, pa.binary()),
        ],
        ["tree", "key", "node", "component", "sketch"],
    )


def test_a_run_of_any_length_meets_the_next_component():
    n, width = 250_001, minhash_dedup.HASHES // 8
    rows = many(n, [0] * (n - 1) + [1], [b"\0" * width] * n)
    batches = [rows.slice(a, 50_000) for a in range(0, n, 50_000)]
    assert sum(b.num_rows for b in minhash_dedup._neighbours(1, 100)(batches)) == n - 1


def test_the_sketch_rejects_nobody():
    width = minhash_dedup.HASHES // 8
    rows = many(2, [0, 1], [b"\0" * width, b"\xff" * width])
    assert sum(b.num_rows for b in minhash_dedup._neighbours(1, 100)([rows])) == 1


def test_unlike_texts_under_one_id_are_judged_apart(spark):
    a = " ".join(f"a{i}" for i in range(200))
    b = " ".join(f"b{i}" for i in range(200))
    rows = [(0, a + " tail"), (1, a), (1, b), (1, b), (2, b + " more")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == [(0, 0, True), (1, 0, False), (1, 1, True), (1, 1, True), (2, 1, False)]
    kept = sorted((r["doc_id"], r["text"]) for r in minhash_dedup.one_of_each(df).collect())
    assert kept == [(0, a + " tail"), (1, b)]


def linked(sets, percent):
    """Components by brute force."""
    label = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if 100 * len(x & y) >= percent * len(x | y) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if k == old else k for k in label]
    return label


@pytest.mark.parametrize("seed", range(4))
def test_groups_by_pivot_lose_no_link(spark, tmp_path, seed, monkeypatch):
    """Dense groups just around the threshold, with edits some members share, all in the last pass."""
    rng = np.random.default_rng(seed)
    texts, group = [], []
    for g in range(6):
        base = [f"{g}w{i}" for i in range(60)]
        for _ in range(25):
            words = list(base)
            for at in rng.choice(60, rng.integers(0, 4), replace=False):
                words[at] = f"{g}x{at}-{rng.integers(0, 2 if rng.random() < 0.6 else 1000)}"
            texts.append(" ".join(words[: rng.integers(55, 61)]))
            group.append(g)
    texts = list(dict.fromkeys(texts))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    monkeypatch.setattr(minhash_dedup, "SPARSE", 0)
    monkeypatch.setattr(minhash_dedup, "BEST", 1)
    monkeypatch.setattr(minhash_dedup, "WINDOW", 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == linked(sets, 85)


def test_pivots_alone_find_every_link(spark):
    """Without any round before: candidates of one group hold a path for every link."""
    rng = np.random.default_rng(9)
    rows, sets = [], []
    for n in range(120):
        x = set(range(100)) - set(rng.choice(100, rng.integers(0, 16), replace=False).tolist())
        x |= set(rng.integers(1000, 1012, rng.integers(0, 8)).tolist()) | {5000 + 10 * n + k for k in range(rng.integers(0, 6))}
        sets.append(x)
        rows.append((7, n, n, bytearray(np.array(sorted(x), dtype=np.int64).tobytes())))
    members = spark.createDataFrame(rows, "top bigint, node bigint, component bigint, shingles binary")
    regions = members.select("top", "node", "component", F.lit(99).alias("outside"))
    work = minhash_dedup.Workspace(spark, "pivots")
    nothing = spark.createDataFrame([], "node bigint, first struct<doc_id: bigint, text_key: bigint>")
    texts = spark.createDataFrame([], "doc_id bigint, text_key bigint, text string")
    found = minhash_dedup._many(regions, nothing, texts, members.select("node", "shingles"), 85, work).collect()
    label = list(range(len(sets)))
    for r in found:
        x, y = sets[r["u"]], sets[r["v"]]
        if 100 * len(x & y) >= 85 * len(x | y):
            old, new = sorted((label[r["u"]], label[r["v"]]), reverse=True)
            label = [new if k == old else k for k in label]
    assert label == linked(sets, 85) and len(set(label)) < len(sets)


def test_as_many_rounds_at_every_size(spark, monkeypatch):
    """Each further round reads all sets again; what two rounds leave is the last pass's."""
    rows, names = just_below(3), []
    write = minhash_dedup.Workspace.write

    def noted(self, df, name):
        names.append(name)
        return write(self, df, name)

    monkeypatch.setattr(minhash_dedup.Workspace, "write", noted)
    assert got(minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS))) == expected(rows)
    assert [n for n in names if n.startswith("new-")] == ["new-0", "new-1", "new-last"]


def test_texts_that_nobody_compares_are_left_where_they_are(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(1000)], DOCS)
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    nodes = rows.filter("doc_id % 50 = 0").select("doc_id", "text_key")
    found = [r["doc_id"] for r in minhash_dedup._with_texts_of(rows, nodes).collect()]
    assert set(range(0, 1000, 50)) <= set(found) and len(found) < 25
    # With bits that many texts share, rows stay that need not; none is lost.
    monkeypatch.setattr(minhash_dedup, "TEXT_BITS", 64)
    found = [r["doc_id"] for r in minhash_dedup._with_texts_of(rows, nodes).collect()]
    assert set(range(0, 1000, 50)) <= set(found) and len(found) < 1000
    monkeypatch.setattr(minhash_dedup, "TEXT_BITS", 1)
    docs = just_below(4, groups=2, size=30)
    assert got(minhash_dedup.near_duplicates(spark.createDataFrame(docs, DOCS))) == expected(docs)
