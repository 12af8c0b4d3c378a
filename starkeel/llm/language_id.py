"""Language identification with bit-sliced Bloom filters over character n-grams.

Each slot of the filter holds one bit per language. An n-gram's slots are read
once and their AND is the set of all languages that contain it, so the cost
does not depend on the number of languages. Per language the bits are counted
over a text's n-grams, the false positives expected from the filter's fill are
taken off, and the largest share decides.

A language contains an n-gram if the n-gram makes up at least ``SHARE`` of its
training n-grams. That is a rate, not a count, so the same text teaches the
same at any size; and it bounds the filter: no language can have more than
1 / SHARE of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T
from .staging import Workspace

ORDERS = (3, 4)
SHARE = 2e-5
PROBES = 3
SLOTS_PER_GRAM = 10
UNDETERMINED = "und"
# Distinct (language, n-gram) counts a task holds before it passes them on.
HELD = 1 << 20

_U = np.uint64


def _grams(texts: list[str]) -> list[np.ndarray]:
    """Per text the hashes of all its n-grams, with a space at both ends."""
    points, ends = T.codepoints([f" {' '.join(t.lower().split())} " for t in texts])
    hashed = [T.grams(points, n) for n in ORDERS]
    return [
        np.concatenate([h[a : max(a, b - n + 1)] for h, n in zip(hashed, ORDERS, strict=True)])
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
    ]


def _letters(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each n-gram occurs in each language, summed over many texts."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def emptied() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            h, c = _summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(c)],
                ["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for part in T.slices(batch, "text"):
            texts, langs = T.strings(part, "text"), part.column("lang").to_pylist()
            for lang in set(langs):
                own = np.concatenate(_grams([t for t, k in zip(texts, langs, strict=True) if k == lang]))
                h, c = np.unique(own, return_counts=True)
                parts = held.setdefault(lang, [])
                parts.append((h, c.astype(np.int64)))
                size += len(h)
            if size > 2 * HELD:
                for lang in held:
                    held[lang] = [_summed(held[lang])]
                size = sum(len(p[0]) for parts in held.values() for p in parts)
                if size > HELD:
                    yield from emptied()
                    size = 0
    yield from emptied()


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([p[0] for p in parts])
    c = np.concatenate([p[1] for p in parts])
    h, at = np.unique(h, return_inverse=True)
    return h, np.bincount(at, c, len(h)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """The languages, one bit each, and the slots: a row of bit words for each."""

    languages: tuple[str, ...]
    slots: np.ndarray  # slots x words, uint64

    def _places(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        size, step = _U(len(self.slots)), (grams >> _U(32)) | _U(1)
        with np.errstate(over="ignore"):
            for k in range(PROBES):
                yield (T.mix(grams + _U(k) * step) % size).astype(np.int64)

    def add(self, language: int, grams: np.ndarray) -> None:
        for at in self._places(grams):
            self.slots[at, language // 64] |= _U(1) << _U(language % 64)

    def members(self, grams: np.ndarray) -> np.ndarray:
        """Bit words of the languages that hold each n-gram."""
        found = None
        for at in self._places(grams):
            found = self.slots[at] if found is None else found & self.slots[at]
        return found

    def false_rate(self) -> np.ndarray:
        """Per language the chance that an absent n-gram seems present."""
        bits = np.arange(len(self.languages))
        set_bits = (self.slots[:, bits // 64] >> (bits % 64).astype(np.uint64)) & _U(1)
        return set_bits.mean(axis=0) ** PROBES

    def shares(self, grams: np.ndarray, false_rate: np.ndarray) -> np.ndarray:
        """Per language the share of the n-grams it holds, false positives taken off."""
        if not len(grams):
            return np.zeros(len(self.languages))
        found = self.members(grams)
        # Most n-grams share few language sets; counting those sets is enough.
        if found.shape[1] == 1:
            sets, times = np.unique(found[:, 0], return_counts=True)
            sets = sets[:, None]
        else:
            sets, times = np.unique(found, axis=0, return_counts=True)
        bits = np.arange(len(self.languages))
        held = (sets[:, bits // 64] >> (bits % 64).astype(np.uint64)) & _U(1)
        counts = (held * times[:, None].astype(np.uint64)).sum(axis=0)
        raw = counts / len(grams)
        return np.clip((raw - false_rate) / np.maximum(1e-9, 1 - false_rate), 0, 1)


def fit(docs: DataFrame) -> Filters:
    """Learn from all texts whose ``lang`` is known.

    Rows without text or language teach nothing. The languages are taken to be
    few enough to list; the filter's size is bounded by their number over
    ``SHARE``.
    """
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    counted = (
        rows.mapInArrow(_count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    work = Workspace(docs.sparkSession, "language-id")
    counted = work.write(counted, "counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = (
        counted.join(F.broadcast(totals), "lang")
        .filter(F.col("n") >= SHARE * F.col("total"))
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"))
        .collect()
    )
    work.drop("counts")
    grams = {r["lang"]: np.array(r["grams"], dtype=np.int64).view(np.uint64) for r in kept}
    languages = tuple(sorted(grams))
    most = max((len(g) for g in grams.values()), default=1)
    slots = np.zeros((SLOTS_PER_GRAM * most, max(1, -(-len(languages) // 64))), dtype=np.uint64)
    filters = Filters(languages, slots)
    for i, lang in enumerate(languages):
        filters.add(i, grams[lang])
    return filters


def _decide(filters: Filters, false_rate: np.ndarray, text: str | None, grams: np.ndarray) -> tuple[str, float]:
    if not filters.languages or text is None or not _letters(text):
        return UNDETERMINED, 0.0
    shares = filters.shares(grams, false_rate)
    best = int(np.argmax(shares))
    return filters.languages[best], float(shares[best])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every whole text, one row per input row.

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned. The score is the share of the text's n-grams that the language
    holds. Ties go to the language first in order. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        rate = own.false_rate()
        for batch in batches:
            for part in T.slices(batch, "text"):
                texts = part.column("text").to_pylist()
                found = [
                    _decide(own, rate, t, g) for t, g in zip(texts, _grams([t or "" for t in texts]), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def identified(docs: DataFrame, filters: Filters, least: float) -> DataFrame:
    """``docs`` whose language can be told with a score of ``least`` or more; columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        rate = own.false_rate()
        for batch in batches:
            for part in T.slices(batch, "text"):
                texts = part.column("text").to_pylist()
                keep = []
                for t, g in zip(texts, _grams([t or "" for t in texts]), strict=True):
                    lang, share = _decide(own, rate, t, g)
                    keep.append(lang != UNDETERMINED and share >= least)
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
