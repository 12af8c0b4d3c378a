"""Runs of repeated words, found with the dictionary of basic factors.

A run is a stretch of words with smallest period ``q`` that is at least ``2 * q``
long and cannot be extended to either side. The dictionary gives every factor of
``2 ** k`` words a number, per ``k`` from the numbers of its halves; factors that
occur once in their text get none, and the first ``k`` without a repeated factor
ends it.

Let a run have a period ``q`` of ``L`` to ``2 * L - 1``, ``L = 2 ** k``. The factor of
length ``L`` at its start occurs again ``q`` later. Occurrences of one factor that
follow each other within ``L / 2`` form an arithmetic progression whose difference
is the factor's own period, so what lies between the two is a few progressions,
at most three starting within ``2 * L``. From each occurrence to the first one of
the next three progressions, and from last to last, the distances propose periods.
These are enough: if both progressions reach beyond the run on the same side, the
letters before (or behind) it would agree and the run would be longer; if only
one does, either the firsts or the lasts, or the first of the later one, lie ``q``
apart. Brute force in the tests agrees.

A proposal is extended to both sides by descending through the dictionary, in
as many steps as it has levels. Periods that are multiples of a smaller one give
the same stretch, and the smallest is kept.

Work grows with n log n in the words of a text. Memory does with 4 bytes a word
and level: a text has as many levels as its longest repeated factor asks for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import tokens
from .texts import slices

LEAST_LENGTH = 12
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
# Progressions behind an occurrence that can begin within twice the factor's length.
_NEXT = 3


class _Level:
    """Factors of one length that occur at least twice, by number and place."""

    def __init__(self, keys: np.ndarray, places: np.ndarray, total: int):
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        differs = np.ones(len(ranked), dtype=bool)
        differs[1:] = ranked[1:] != ranked[:-1]
        number = np.cumsum(differs) - 1
        again = np.bincount(number)[number] > 1
        self.places = places[order[again]]
        self.number = np.cumsum(differs[again]) - 1
        self.names = np.full(total, -1, dtype=np.int32)
        self.names[self.places] = self.number


def basic_factors(codes: np.ndarray) -> Iterator[_Level]:
    """Levels 0, 1, 2, ... of the dictionary, as long as a factor is repeated."""
    level = _Level(codes, np.arange(len(codes)), len(codes))
    length = 1
    while len(level.places):
        yield level
        names = level.names
        places = np.flatnonzero(names[: len(names) - length] >= 0)
        places = places[names[places + length] >= 0]
        keys = names[places].astype(np.int64) * len(names) + names[places + length]
        level = _Level(keys, places, len(codes))
        length *= 2


def _proposals(level: _Level, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from ``length`` to ``2 * length - 1`` that some run may have."""
    at, number = level.places, level.number
    near = (number[1:] == number[:-1]) & (2 * (at[1:] - at[:-1]) <= length)
    begins = np.flatnonzero(np.concatenate([[True], ~near]))
    ends = np.append(begins[1:], len(at)) - 1
    chain = np.repeat(np.arange(len(begins)), ends - begins + 1)
    found = []
    for r in range(1, _NEXT + 1):
        for here, there, of in ((at, at[begins], chain), (at[ends], at[ends], np.arange(len(begins)))):
            to = np.minimum(of + r, len(begins) - 1)
            period = there[to] - here
            fits = (of + r < len(begins)) & (number[begins[to]] == number[begins[of]])
            fits &= (period >= length) & (period < 2 * length)
            found.append((here[fits], period[fits]))
    place, period = (np.concatenate(c) for c in zip(*found, strict=True))
    # Neighbouring places with one period lie in one run.
    keys = np.unique(period * np.int64(len(level.names)) + place)
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1] + 1])] if len(keys) else keys
    return keys % len(level.names), keys // len(level.names)


def _extended(levels: list[_Level], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one position of the longest stretch around each proposal."""
    total = len(levels[0].names)
    right, left = place.copy(), place.copy()
    for k in reversed(range(len(levels))):
        names, step = levels[k].names, 1 << k
        inside = right + period < total
        a = names[np.where(inside, right, 0)]
        same = inside & (a >= 0) & (a == names[np.where(inside, right + period, 0)])
        right += step * same
        inside = left >= step
        a = names[np.where(inside, left - step, 0)]
        same = inside & (a >= 0) & (a == names[np.where(inside, left - step + period, 0)])
        left -= step * same
    return left, right + period


def find_runs(codes: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and period of all runs of ``least`` words or more, by start and period.

    ``codes`` are non-negative numbers; several texts may follow each other if no
    number occurs in two of them.
    """
    levels = list(basic_factors(codes))
    proposed = [_proposals(level, 1 << k) for k, level in enumerate(levels)]
    if not proposed:
        none = np.empty(0, np.int64)
        return none, none, none
    place, period = (np.concatenate(c) for c in zip(*proposed, strict=True))
    start, end = _extended(levels, place, period)
    run = end - start >= np.maximum(least, 2 * period)
    start, end, period = start[run], end[run], period[run]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _scan(column: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Per text its number of words, its runs, and the text without repeats."""
    words = tokens.words(column)
    own = np.unique(words.text * (np.int64(len(words.codes)) + 1) + words.codes, return_inverse=True)[1]
    start, end, period = find_runs(own, least)
    if not len(words.firsts) - 1:
        return pa.array([], pa.int64()), pa.array([], _RUNS), pa.array([], pa.string())
    text = np.searchsorted(words.firsts, start, side="right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(start - words.firsts[text]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]
    )
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(text, np.arange(len(words.firsts))).astype(np.int32)), runs
    )
    covered = np.bincount(start + period, minlength=len(own) + 1) - np.bincount(end, minlength=len(own) + 1)
    kept = np.cumsum(covered)[: len(own)] == 0
    firsts = np.concatenate([[0], np.cumsum(kept)])[words.firsts]
    return (
        pa.array(np.diff(words.firsts)),
        lists.cast(_RUNS),
        tokens.joined(words.values.filter(pa.array(kept)), firsts),
    )


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every document.

    ``runs`` holds start, length and period, counted in words, by start and then
    period. ``collapsed`` joins with one space the words that no run contains
    after its first period. A null or empty text has no words, no runs and an
    empty collapsed text. Rows are judged one by one, so rows with null or
    repeated ids stay; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = _scan(part.column("text"), least)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *found], ["doc_id", "n_words", "runs", "collapsed"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string"
    )


def without_repeats(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """The documents with each run cut to its first period; texts without a run stay as they are.

    All columns and rows are kept; a null text stays null.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at = part.schema.get_field_index("text")
                _, runs, collapsed = _scan(part.column(at), least)
                changed = pc.greater(pc.list_value_length(runs), 0)
                text = pc.if_else(changed, collapsed, part.column(at))
                yield pa.RecordBatch.from_arrays(
                    [text if i == at else c for i, c in enumerate(part.columns)], part.schema.names
                )

    return docs.mapInArrow(run, docs.schema)
