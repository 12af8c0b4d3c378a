"""LM scoring: base score by hand, a proper distribution, gradients, each id scored once."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starkeel.llm import lm_scoring as M
from starkeel.llm import queries

RANKS = queries.tokenizer_path("byte_bpe_50k.tiktoken")


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.translate({c: " " for c in range(9, 14)}).split(" ") if w] + [None]


def base(rows, held):
    """Per (id, text) the contract's columns but the model's score."""
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    low = math.log10(n + 0.1 * (v + 1)) if n else math.log10(0.1)
    out = []
    for i, text in rows:
        own = tokens(text)
        score = sum(math.log10(counts[t] + 0.1) - low for t in own)
        out.append((i, held(i), len(own), sum(counts[t] > 0 for t in own), n, score))
    return out


def close(got, expected):
    key = lambda r: (str(r[0]), r[2], r[5])
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected])


def test_query_over_the_whole_table(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = queries.op2_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    close([tuple(r)[:6] for r in got], base(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0))
    assert all(r["score"] < 0 and np.isfinite(r["score"]) for r in got)


def test_many_segments_count_alike(spark, documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    monkeypatch.setattr(M, "SEGMENT_BYTES", 10_000)
    got = M.score(documents.repartition(3), F.col("doc_id") % 3 == 0, RANKS).collect()
    close([tuple(r)[:6] for r in got], base(rows, lambda i: i % 3 == 0))


@pytest.mark.parametrize("common", [0, 40])
def test_words_counted_by_the_join_count_like_common_ones(spark, documents, monkeypatch, common):
    """Also words that several segments share, and words that only held-out texts have."""
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    monkeypatch.setattr(M, "COMMON", common)
    monkeypatch.setattr(M, "SEGMENT_BYTES", 10_000)
    got = M.score(documents.repartition(3), F.col("doc_id") % 3 == 0, RANKS).collect()
    close([tuple(r)[:6] for r in got], base(rows, lambda i: i % 3 == 0))


def test_texts_are_shuffled_once(documents, monkeypatch):
    """After they were dealt, no segment and no word that is everywhere goes through a shuffle."""
    plans, write = {}, M.Workspace.write

    def spy(self, df, name, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(self, df, name, **options)

    monkeypatch.setattr(M.Workspace, "write", spy)
    M.score(documents, F.col("doc_id") % 3 == 0, RANKS)
    assert "Repartition" in plans.pop("segments")
    assert not any("Repartition" in plan for plan in plans.values())


def test_awkward_rows(awkward, empty):
    got = M.score(awkward, F.col("doc_id") % 2 == 0, RANKS).collect()
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    close([tuple(r)[:6] for r in got], base(rows, lambda i: i is None or i % 2 == 0))
    assert all(np.isfinite(r["score"]) for r in got)
    assert M.score(empty, F.lit(False), RANKS).collect() == []
    none = M.score(awkward, F.lit(True), RANKS).collect()
    assert {(r["train_tokens"], r["n_known"]) for r in none} == {(0, 0)}


def model(seed=0):
    rng = np.random.default_rng(seed)
    own = M.Model.of_pairs(rng.integers(0, 5, (M.CLASSES, M.CLASSES)).astype(float))
    own.weights = {n: (rng.standard_normal(w.shape) * 0.3).astype(np.float32) for n, w in own.weights.items()}
    return own


def test_next_id_probabilities_sum_to_one():
    own = model()
    before = [5, 900, 17, 3]
    total = 0.0
    for c in range(0, M.CLASSES, 64):
        streams = np.array([[*before, k] for k in range(c, c + 64)])
        logs = own.score(streams.ravel(), np.arange(0, 5 * 64 + 1, 5))
        total += np.exp(logs.reshape(64, 5)[:, 4].astype(np.float64)).sum()
    assert total == pytest.approx(1, abs=1e-4)
    counts = np.random.default_rng(1).integers(0, 100, 1 << 16).astype(float)
    classes = M.Classes.from_counts(counts)
    assert np.bincount(classes.of, np.exp(classes.within.astype(np.float64)))[1:] == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("n", [1, 2, M.WINDOW, M.WINDOW + 1, 3 * M.WINDOW + 5])
def test_windows_score_each_id_once_with_its_own_context(n):
    """Against one id at a time, with the context its window gives it."""
    own = model(n)
    stream = np.random.default_rng(n).integers(0, M.CLASSES, n + 7)
    got = own.score(stream, np.array([0, 7, n + 7]))
    text = stream[7:]
    stride = M.WINDOW - M.CONTEXT
    for t in range(n):
        window = 0 if t < M.WINDOW else -(-(t + 1 - M.WINDOW) // stride)
        before = np.concatenate([[0], text])[window * stride : t + 1][None, :]
        alone = np.zeros((1, M.WINDOW), np.int64)
        alone[0, : before.shape[1]] = before
        h = own.attend(alone)[-1][0, before.shape[1] - 1][None, :]
        g, m = divmod(int(text[t]), M.MEMBERS)
        p = before[0, -1]
        expected = M._log_of(h @ own.weights["g"] + own.groups[[p]], np.array([g]))
        expected = expected + M._log_of(h @ own.weights["m"][g] + own.members[[p], g], np.array([m]))
        assert got[7 + t] == pytest.approx(float(expected[0]), abs=1e-3)


def test_gradients_are_those_of_the_loss():
    own = model(3)
    own.weights = {n: w.astype(np.float64) for n, w in own.weights.items()}
    rng = np.random.default_rng(4)
    before, target = rng.integers(0, 40, (2, 3, M.WINDOW))

    def loss():
        h = own.attend(before)[-1].reshape(-1, M.WIDTH)
        p, (g, m) = before.ravel(), np.divmod(target.ravel(), M.MEMBERS)
        outer = M._log_of(h @ own.weights["g"] + own.groups[p], g)
        inner = M._log_of(np.einsum("nw,nwm->nm", h, own.weights["m"][g]) + own.members[p, g], m)
        return -(outer + inner).mean()

    grads = own.step(before, target)
    for name, w in own.weights.items():
        flat, step = w.reshape(-1), 1e-5
        for at in np.argsort(-np.abs(grads[name]).ravel())[:3]:
            old = flat[at]
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            down = loss()
            flat[at] = old
            assert grads[name].ravel()[at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=1e-6)


def test_training_helps_on_unseen_texts(spark):
    """Words follow each other in a fixed cycle per topic; unigrams cannot tell, the model can."""
    topics = [[f"{t}{w}" for w in ("alpha", "beta", "gamma", "delta")] for t in "xyz"]
    rows = [(i, " ".join(topics[i % 3][(i + k) % 4] for k in range(60))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = M.score(df, F.col("doc_id") >= 540, RANKS).filter("held_out").collect()
    assert len(held) == 60 and all(r["score"] > 0.7 * r["base_score"] for r in held)


def segment_row(texts, held=None):
    """The stored segment of some texts."""
    import pyarrow as pa

    own = M._Segment()
    held = held or [False] * len(texts)
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array(held, pa.bool_()), pa.array(texts, pa.string())]
    own.add(pa.RecordBatch.from_arrays(columns, ["doc_id", "held", "text"]))
    return dict(zip(M._SEGMENT_NAMES, own.row(0, M._encoder(RANKS)), strict=True))


def test_a_word_of_very_many_ids():
    """More ids than 16 bits can count, beside normal texts: each as if it stood alone."""
    rng = np.random.default_rng(1)
    long = "".join(map(chr, rng.integers(0x4E00, 0x9000, 70_000)))
    texts = ["one two three", f"before {long} after", "four five one", long]
    classes = M.Classes.from_counts(rng.integers(0, 100, 1 << 16).astype(float))
    stream, within, starts = M._streams(segment_row(texts), classes)
    assert np.diff(starts).max() > 1 << 16
    for n, text in enumerate(texts):
        own, own_within, _ = M._streams(segment_row([text]), classes)
        assert np.array_equal(stream[starts[n] : starts[n + 1]], own)
        assert np.array_equal(within[starts[n] : starts[n + 1]], own_within)


@pytest.mark.parametrize("sizes", [[3], [40, 1, 7], [200] * 40])
def test_every_training_id_is_trained_on_alike(sizes, monkeypatch):
    """A pass meets each id of each training text once, in short and in long inputs; held-out ones never."""
    from types import SimpleNamespace

    import pyarrow as pa

    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 500, n)) for n in sizes] + ["held out words"]
    row = segment_row(texts, [False] * len(sizes) + [True])
    classes = M.Classes.from_counts(rng.integers(0, 100, 1 << 16).astype(float))
    stream, starts = M._training(row, classes)
    met, step = Counter(), M.Model.step

    def spy(self, before, target, valid=None):
        own = np.ones(target.shape, bool) if valid is None else valid
        met.update(zip(before[own].tolist(), target[own].tolist(), strict=True))
        return step(self, before, target, valid)

    monkeypatch.setattr(M.Model, "step", spy)
    kinds = dict(zip(M._SEGMENT_NAMES, M._SEGMENT_TYPES, strict=True))
    names = ["held", "n_words", "words", "sub", "sub_lengths"]
    batch = pa.RecordBatch.from_arrays([pa.array([row[n]], kinds[n]) for n in names], names)
    (out,) = M._train(SimpleNamespace(value=(classes, model())))([batch])
    expected = Counter(zip([0, *stream[:-1].tolist()], stream.tolist(), strict=True))
    assert met == expected
    windows = sum(-(-n // M.WINDOW) for n in np.diff(starts).tolist())
    assert out.column("windows")[0].as_py() == windows
    assert np.isfinite(out.column("weight").to_numpy()).all()


def test_places_past_the_end_add_nothing():
    own, rng = model(5), np.random.default_rng(6)
    before, target = rng.integers(0, 40, (2, 2, M.WINDOW))
    valid = np.arange(M.WINDOW) < np.array([[M.WINDOW], [9]])
    other = before.copy(), target.copy()
    for x in other:
        x[~valid] = 77
    one, two = own.step(before, target, valid), own.step(*other, valid)
    for name in one:
        assert two[name] == pytest.approx(one[name], abs=1e-6)


def test_scores_do_not_depend_on_partitions(spark, documents, monkeypatch):
    """Also with several parts of several segments."""
    monkeypatch.setattr(M, "SEGMENT_BYTES", 20_000)
    monkeypatch.setattr(M, "PART_BYTES", 50_000)
    rows = [
        {tuple(r)[:6]: r["score"] for r in M.score(documents.repartition(n), F.col("doc_id") % 3 == 0, RANKS).collect()}
        for n in (1, 7)
    ]
    assert rows[0].keys() == rows[1].keys()
    assert all(rows[1][k] == pytest.approx(v, rel=1e-6) for k, v in rows[0].items())


def test_windows_do_not_reach_into_other_texts():
    """What a text adds to training does not depend on the texts beside it."""
    rng = np.random.default_rng(8)
    classes = M.Classes.from_counts(rng.integers(0, 100, 1 << 16).astype(float))
    texts = ["a few words", "some more words than before " * 20, "the last"]
    met = []

    class Spy(M._Training):
        def update(self, grads):
            pass

    for chosen in ([0, 1, 2], [2, 0, 1]):
        own = Spy(model())
        seen = Counter()
        step = own.model.step
        own.model.step = lambda b, t, v, seen=seen, step=step: (
            seen.update(tuple(r[m].tolist()) for r, m in zip(t, v, strict=True)), step(b, t, v)
        )[1]
        own.segment(*M._training(segment_row([texts[i] for i in chosen]), classes))
        met.append(seen)
    assert met[0] == met[1]


def test_a_vocabulary_of_too_many_ids_is_refused(tmp_path):
    import base64

    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % (i << 9) for i in range(256)))
    with pytest.raises(ValueError, match="16 bits"):
        M._encoder(str(path))


def test_numbers_are_packed_in_as_few_bytes_as_they_need():
    for top, size in ((0, 1), (255, 1), (256, 2), (65_536, 4), (1 << 40, 8)):
        numbers = np.array([0, top, top // 2])
        packed = M._pack(numbers)
        assert len(packed) == 1 + 3 * size
        assert M._unpack(packed).tolist() == numbers.tolist()
    assert M._unpack(M._pack(np.empty(0, np.int64))).tolist() == []


def test_packed_numbers_compress():
    """Frequent words have small numbers, whose upper bytes are alike."""
    rng = np.random.default_rng(3)
    words = [f"w{int(i)}" for i in rng.zipf(1.2, 200_000) % 90_000]
    packed = segment_row([" ".join(words)])["words"]
    assert len(zlib.compress(packed)) < 0.7 * len(packed)


def test_weights_keep_their_places():
    own = model(4)
    again = model(9).with_weights(own.flat())
    assert all(np.array_equal(again.weights[n], w) for n, w in own.weights.items())


def test_words_are_encoded_together(monkeypatch):
    """As if each stood alone, also beside other white space and broken bytes; one call for all plain words."""
    encoder, rng = M._encoder(RANKS), np.random.default_rng(12)
    parts = ["a", "'s", "!", "12", "é", "你", "\U0001f600", "\x00", " ", "　", "\x85", "\x1c"]
    words = ["".join(rng.choice(parts, n)).encode() for n in rng.integers(1, 7, 500)] + [b"\xe4\xbd", b"ok\xff"]
    alone = [encoder.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
    for own, expected in ((words, alone), ([], []), (words[-1:], alone[-1:])):
        ids, lengths = encoder.ids(own)
        assert lengths.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]
    calls = Counter()

    class Spy:
        def __getattr__(self, name):
            calls[name] += 1
            return getattr(encoder.encoding, name)

    M.Encoder(Spy(), encoder.sizes).ids([b"word%d" % i for i in range(1000)])
    assert sum(calls.values()) == 1


def test_a_step_uses_its_memory_again():
    """What a step allocates is far less than the arrays it works on."""
    import tracemalloc

    own, rng = model(7), np.random.default_rng(8)
    before, target = rng.integers(0, M.CLASSES, (2, M.BATCH, M.WINDOW))
    expected = own.step(before, target)
    tracemalloc.start()
    try:
        again = own.step(before, target)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert all(np.array_equal(again[n], g) for n, g in expected.items())
    assert peak < 3 << 20
