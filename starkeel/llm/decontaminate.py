"""Benchmark decontamination by q-gram counting and banded alignment.

An item of m characters that occurs in a text with at most k edits shares at
least m + 1 - q(k + 1) of its q-grams with the text (the q-gram lemma), and
those all lie on k + 1 neighbouring diagonals (text position less item
position). So shared q-grams are counted per item in bands of diagonals that
overlap by k; bands below the bound are dropped without loss, and in the
others the item is aligned within the band, at most k edits.

Both sides are compared in lower case, each run of white space as one space.
Items shorter than a q-gram allow no edits: they are searched as whole words, all
at once with an automaton.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T

Q = 8
# One edit in so many characters of an item is allowed.
CHARS_PER_EDIT = 10
# Characters of the benchmark per pass over the documents: about 40 MB of index.
BLOCK_CHARS = 2_000_000
FILTER_BITS = 22


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(m: int, q: int = Q) -> int:
    """Edits allowed for an item of ``m`` characters; the bound stays at 1 or more."""
    return max(0, min(m // CHARS_PER_EDIT, m // q - 1))


@functools.lru_cache(maxsize=4)
def _automaton(items: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text in set(items):
        found.add_word(text, (len(text), [n for n, t in enumerate(items) if t == text]))
    found.make_automaton()
    return found


def _words(items: tuple[str, ...], text: str) -> dict[int, int]:
    """The ``items`` that stand in the text with no letter or digit beside them, and where the first ends."""
    found: dict[int, int] = {}
    for last, (length, numbers) in _automaton(items).iter(text) if items else ():
        begin, end = last + 1 - length, last + 1
        if (begin and text[begin - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
            continue
        for n in numbers:
            found.setdefault(n, end)
    return found


@dataclass(frozen=True)
class Index:
    """The q-grams of one block of items, sorted by hash, with item and position."""

    ids: tuple
    items: tuple[str, ...]
    edits: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray
    item_of: np.ndarray
    place_of: np.ndarray
    seen: np.ndarray
    # Items without a q-gram; their ids follow the others'.
    short: tuple[str, ...]

    @classmethod
    def of(cls, rows: list[tuple]) -> Index:
        kept = [(i, normal(t)) for i, t in rows]
        short = [(i, t) for i, t in kept if 0 < len(t) < Q]
        kept = [(i, t) for i, t in kept if len(t) >= Q]
        items = tuple(t for _, t in kept)
        points, ends = T.codepoints(list(items))
        h = T.grams(points, Q)
        whole = [np.arange(a, b - Q + 1) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        at = np.concatenate(whole) if whole else np.empty(0, np.int64)
        item_of = np.repeat(np.arange(len(items)), [len(w) for w in whole])
        place_of = at - ends[item_of] if len(at) else at
        h = h[at]
        order = np.argsort(h, kind="stable")
        hashes, firsts = np.unique(h[order], return_index=True)
        seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        edits = np.array([budget(len(t)) for t in items], dtype=np.int64)
        lengths = np.array([len(t) for t in items], dtype=np.int64)
        return cls(
            tuple(i for i, _ in kept + short),
            items,
            edits,
            lengths + 1 - Q * (edits + 1),
            hashes,
            np.concatenate([firsts, [len(h)]]),
            item_of[order],
            place_of[order],
            seen,
            tuple(t for _, t in short),
        )


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int] | None:
    """Fewest edits of ``item`` in ``text`` on diagonals ``low`` to ``high``, and where it ends.

    None if there are more than ``edits``. The item may begin and end anywhere.
    """
    m, n = len(item), len(text)
    places = np.arange(low, high + 1)
    # Outside the text nothing can be matched, only skipped.
    padded = np.full(m + len(places) + 1, 0xFFFFFFFF, dtype=np.uint32)
    a, b = max(low, 0), min(n, m + high + 1)
    if b > a:
        padded[a - low : b - low] = text[a:b]
    far = m + n + edits + 1
    step = np.arange(len(places))
    cost = np.where((places >= 0) & (places <= n), 0, far)
    for j in range(m):
        new = cost + (padded[j : j + len(places)] != item[j])
        new[:-1] = np.minimum(new[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(new - step) + step
        if cost.min() > edits:
            return None
    end = m + places
    cost = np.where((end >= 0) & (end <= n), cost, far)
    best = int(np.argmin(cost))
    return (int(cost[best]), int(end[best])) if cost[best] <= edits else None


def _matches(index: Index, texts: list[str]) -> list[dict[int, tuple[int, int]]]:
    """Per text the items found in it: fewest edits and the end of the first such place."""
    found: list[dict[int, tuple[int, int]]] = [
        {len(index.items) + n: (0, end) for n, end in _words(index.short, t).items()} for t in texts
    ]
    points, ends = T.codepoints(texts)
    if not len(index.hashes) or len(points) < Q:
        return found
    h = T.grams(points, Q)
    at = np.flatnonzero(index.seen[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    doc = np.searchsorted(ends, at, side="right") - 1
    inside = at + Q <= ends[doc + 1]
    at, doc = at[inside], doc[inside]
    slot = np.searchsorted(index.hashes, h[at])
    slot[slot == len(index.hashes)] = 0
    same = index.hashes[slot] == h[at]
    at, doc, slot = at[same], doc[same], slot[same]
    times = index.firsts[slot + 1] - index.firsts[slot]
    entry = np.repeat(index.firsts[slot] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
    item, doc, at = index.item_of[entry], np.repeat(doc, times), np.repeat(at, times)
    longest = max(map(len, index.items))
    diagonal = at - ends[doc] - index.place_of[entry] + longest
    # A band of an item is as wide as its edit budget, and one wider by overlap.
    k = index.edits[item]
    width = np.maximum(k, 8)
    band = diagonal // width
    early = diagonal % width < k
    key = (doc * (int(np.diff(ends).max()) + 2 * longest + 2) + band) * len(index.items) + item
    key = np.concatenate([key, (key - len(index.items))[early & (band > 0)]])
    key, counts = np.unique(key, return_counts=True)
    item = key % len(index.items)
    enough = counts >= index.bounds[item]
    key, item = key[enough] // len(index.items), item[enough]
    doc, band = np.divmod(key, int(np.diff(ends).max()) + 2 * longest + 2)
    for d, i, b in zip(doc.tolist(), item.tolist(), band.tolist(), strict=True):
        if found[d].get(i, (1,))[0] == 0:
            continue
        k = int(index.edits[i])
        w = max(k, 8)
        low = b * w - longest
        text, want = texts[d], index.items[i]
        begin = max(0, low - k)
        exact = text.find(want, begin, low + w + 2 * k + len(want))
        if exact >= 0:
            hit = (0, exact + len(want))
        else:
            t = points[ends[d] : ends[d + 1]]
            hit = aligned(T.codepoints([want])[0], t, low - k, low + w + 2 * k, k)
        if hit and hit < found[d].get(i, (k + 1, 0)):
            found[d][i] = hit
    return found


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars``, one at a time on the driver."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter(F.length("text") > 0)
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    for k in range(blocks):
        yield [tuple(r) for r in rows.filter(block == k).collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, edits, end_char.

    ``edits`` is the fewest found, one per ten characters at most; ``end_char``
    where the first such place ends in the normalised text. Null and empty
    texts contain nothing, and null, empty and blank items are in nothing; items of
    fewer than eight characters are found as whole words. Repeated documents and items are each reported. Empty tables give an
    empty result. Documents are not shuffled; the benchmark is taken in blocks
    of a bounded number of characters, one pass over the documents for each.
    """
    id_type, item_type = (x.schema[c].dataType.simpleString() for x, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {id_type}, item_id {item_type}, edits int, end_char bigint"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    result = docs.sparkSession.createDataFrame([], schema)
    kinds = (benchmark.select("item_id").limit(0).toArrow().schema.field(0).type, pa.int32(), pa.int64())
    for items in _blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Index.of(items))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in T.slices(batch, "text"):
                    found = _matches(index, [normal(t) for t in T.strings(part, "text")])
                    at = [d for d, f in enumerate(found) for _ in f]
                    hits = [(index.ids[i], *hit) for f in found for i, hit in sorted(f.items())]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(at, pa.int64()))]
                        + [pa.array([x[c] for x in hits], kind) for c, kind in enumerate(kinds)],
                        ["doc_id", "item_id", "edits", "end_char"],
                    )

        result = result.unionByName(rows.mapInArrow(run, schema))
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows in which an item is found; all columns as they were."""
    for items in _blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Index.of(items))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in T.slices(batch, "text"):
                    found = _matches(index, [normal(t) for t in T.strings(part, "text")])
                    yield part.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
