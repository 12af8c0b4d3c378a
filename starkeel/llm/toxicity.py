"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

Features are hashed character n-grams of the lower-cased text, present or not.
Each is scaled by its log-count ratio: the log of its share among toxic
documents over its share among the others, both smoothed towards the overall
share. Counts cover every labelled document. A logistic regression on the
scaled features is then fitted in numpy on a bounded sample of labelled rows
(``fit_rows`` per class); a row's own count is taken out of the ratios it is
fitted on, since unseen texts have no count in them either.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T

ORDERS = (4, 5)
BITS = 18
# Weight of the overall share in the ratios, in documents.
PRIOR = 20.0
# N-grams in fewer labelled documents have no weight, nor have ratios nearer to 0.
LEAST_DOCS = 5
LEAST_RATIO = 0.5
FIT_ROWS = 1500
RIDGE = 1e-3
STEPS = 200


@dataclass(frozen=True)
class Model:
    """One weight for each hashed n-gram, already times its ratio, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        z = float(self.weights[buckets].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def features(texts: list[str], bits: int = BITS) -> list[np.ndarray]:
    """Per text its distinct hashed n-grams; word ends at the text's ends too."""
    points, ends = T.codepoints([f" {' '.join(t.lower().split())} " for t in texts])
    shift = np.uint64(64 - bits)
    hashed = [(T.grams(points, n) >> shift).astype(np.uint32) for n in ORDERS]
    found = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        own = np.sort(np.concatenate([h[a : max(a, b - n + 1)] for h, n in zip(hashed, ORDERS, strict=True)]))
        found.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    return found


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold each n-gram, over one task's rows."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    rows = np.zeros(2, dtype=np.int64)
    for batch in batches:
        for part in T.slices(batch, "text"):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)
            for f, label in zip(features(T.strings(part, "text")), toxic.tolist(), strict=True):
                counts[label, f] += 1
                rows[label] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-1], used]), pa.int32()),
            pa.array(np.concatenate([rows[1:], counts[1, used]])),
            pa.array(np.concatenate([rows[:1], counts[0, used]])),
        ],
        ["bucket", "toxic", "clean"],
    )


def _featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            found = features(T.strings(part, "text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), pa.array([f.tobytes() for f in found], pa.binary())],
                ["toxic", "buckets"],
            )


def _ratios(counts: np.ndarray, totals: np.ndarray, less: int | None = None) -> np.ndarray:
    """Log-count ratios; ``less``: the class from which one document is taken out."""
    n = counts.astype(np.float64)
    rows = totals.astype(np.float64)
    share = (counts.sum(axis=0) / max(1, totals.sum()))[None, :]
    if less is not None:
        n[less] = np.maximum(n[less] - 1, 0)
        rows[less] = max(rows[less] - 1, 0)
    smooth = (n + PRIOR * share) / (rows + PRIOR)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.log(smooth[1]) - np.log(smooth[0])
    r[counts.sum(axis=0) < LEAST_DOCS] = 0
    return np.nan_to_num(r, nan=0.0, posinf=0.0, neginf=0.0)


def _logistic(docs: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, prior: float, size: int):
    """Weights and bias by accelerated gradient steps on all rows at once.

    Both classes count alike in the fit; the bias is then moved to ``prior``,
    the share of toxic labels.
    """
    cells, x = np.concatenate(docs), np.concatenate(values)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    used, cells = np.unique(cells, return_inverse=True)
    n, m = len(docs), len(used)
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    # The largest curvature, by power iteration, bounds the step.
    v, norm = np.ones(m), 0.0
    for _ in range(25):
        v = np.bincount(cells, (each * np.bincount(row, v[cells] * x, n))[row] * x, m)
        norm = float(np.linalg.norm(v))
        v = v / max(norm, 1e-12)
    step = 1 / (0.25 * (1.1 * norm + 1) + RIDGE)
    w, v, bias, bias_v = np.zeros(m), np.zeros(m), 0.0, 0.0
    for k in range(STEPS):
        z = np.bincount(row, v[cells] * x, n) + bias_v
        g = each * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.bincount(cells, g[row] * x, m) + RIDGE * v
        new, new_bias = v - step * slope, bias_v - step * 10 * float(g.sum())
        pull = k / (k + 3)
        v, bias_v = new + pull * (new - w), new_bias + pull * (new_bias - bias)
        w, bias = new, new_bias
    weights = np.zeros(size)
    weights[used] = w
    return weights, bias + float(np.log(prior / (1 - prior)))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the rows of ``labels`` (doc_id, toxic) whose documents are in ``docs``.

    Labels other than 0 and 1, and rows without an id, teach nothing; of
    repeated labels the largest counts. Counts use all labelled documents; the
    regression takes at most ``fit_rows`` of each class, the first by a hash of
    the id. With fewer than five
    rows of a class every text gets the share of toxic labels (0 without labels).
    """
    texts = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # One plan at every size: a side that is broadcast as long as it is small would
    # change what the job needs from one table to a larger one.
    rows = texts.join(labelled.hint("merge"), "doc_id").select("text", "toxic")
    counted = (
        rows.mapInArrow(_count, "bucket int, toxic bigint, clean bigint")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toPandas()
    )
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    real = counted[counted["bucket"] >= 0]
    counts[1, real["bucket"].to_numpy(np.int64)] = real["toxic"].to_numpy(np.int64)
    counts[0, real["bucket"].to_numpy(np.int64)] = real["clean"].to_numpy(np.int64)
    own = counted[counted["bucket"] < 0]
    totals = np.array([own["clean"].sum(), own["toxic"].sum()], dtype=np.int64)
    prior = float(totals[1] / max(1, totals.sum()))
    if totals.min() < LEAST_DOCS:
        return Model(np.zeros(1 << BITS), float(np.clip(np.log(prior + 1e-12) - np.log(1 - prior + 1e-12), -30, 30)))
    # At most 2 x fit_rows ids, whatever the number of labels.
    by_hash = F.xxhash64("doc_id")
    chosen = labelled.filter("toxic = 1").orderBy(by_hash, "doc_id").limit(fit_rows)
    chosen = chosen.unionByName(labelled.filter("toxic = 0").orderBy(by_hash, "doc_id").limit(fit_rows))
    ratios = [_ratios(counts, totals, less) for less in (0, 1)]
    least = [np.abs(r) > LEAST_RATIO for r in ratios]

    def informative(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _featurise(batches):
            kept = []
            for f, label in zip(batch.column("buckets").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                f = np.frombuffer(f, dtype=np.uint32)
                kept.append(f[least[label][f]].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(kept, pa.binary())], ["toxic", "buckets"])

    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    got = sample.mapInArrow(informative, "toxic int, buckets binary").collect()
    found = [np.frombuffer(r["buckets"], dtype=np.uint32).astype(np.int64) for r in got]
    y = np.array([r["toxic"] for r in got], dtype=np.float64)
    values = [ratios[int(label)][f] for f, label in zip(found, y, strict=True)]
    weights, bias = _logistic(found, values, y, prior, 1 << BITS)
    final = _ratios(counts, totals)
    return Model(np.where(np.abs(final) > LEAST_RATIO, weights * final, 0.0), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every whole text, one row per input row.

    A null or empty text gets the score of a text without n-grams; null and
    repeated ids are scored like others. Nothing is shuffled. The model has a
    fixed size (2^18 numbers), whatever it was learned from.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in T.slices(batch, "text"):
                scores = [own.score(f) for f in features(T.strings(part, "text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, score double")


def below(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in T.slices(batch, "text"):
                keep = [own.score(f) < threshold for f in features(T.strings(part, "text"))]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
