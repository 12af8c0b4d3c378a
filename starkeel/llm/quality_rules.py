"""Quality rules on repetition: characters inside repeated n-grams and lines.

Rolling hashes give every window of 5 to 10 words a number. Per length, the
words covered by a window that occurred before in the same text are marked, and
their characters are counted; likewise the characters of lines equal to an
earlier line. A text is left out if the share of one of them is above its limit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .texts import mix, slices

# Most per cent of a text's word characters in repeated windows of so many words,
# and in repeated lines: the published limits for web text.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20
# Windows that the first rules look at, and what they ask for.
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SYMBOLS = "#*$%&|<>"

_U = np.uint64
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_BASE = _U(0x9E3779B97F4A7C15)


def columns(lengths: Iterable[int] = NGRAM_LIMITS) -> list[str]:
    """Names of the measures, all counts."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    return counts + [f"dup_{n}gram_chars" for n in lengths]


def _per_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which have occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    more, before = np.empty(len(keys), dtype=bool), np.empty(len(keys), dtype=bool)
    before[order] = ~new
    more[order] = ~new | ~np.append(new[1:], True)
    return more, before


def _covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside windows of ``n`` words that begin at ``starts``."""
    ends = np.bincount(starts + n, minlength=total + 1) if len(starts) else np.zeros(total + 1, np.int64)
    return np.cumsum(np.bincount(starts, minlength=total + 1) - ends)[:total] > 0


def measure(column: pa.Array, lengths: Iterable[int] = NGRAM_LIMITS) -> list[np.ndarray]:
    """The measures of each text, in the order of :func:`columns`."""
    words, lines = tokens.words(column), tokens.lines(column)
    total, firsts = len(words.codes), words.firsts
    chars = pc.utf8_length(words.values).to_numpy(zero_copy_only=False).astype(np.int64)
    bare = pc.utf8_length(lines.values).to_numpy(zero_copy_only=False).astype(np.int64)
    with_word = pc.binary_length(pc.ascii_trim_whitespace(lines.values)).to_numpy(zero_copy_only=False) > 0
    again = _groups(lines.text * (np.int64(len(lines.codes)) + 1) + lines.codes)[1] & with_word
    text = words.text
    left = firsts[1:][text] - np.arange(total)
    with np.errstate(over="ignore"):
        word = mix(words.codes.astype(_U) + (text.astype(_U) + _U(1)) * _BASE)
        rolled, at, power, repeated, inside = np.zeros(total, _U), 0, _U(1), None, {}
        for n in sorted({WINDOW, *lengths}):
            for k in range(at, n):
                rolled[: max(0, total - k)] += word[k:] * power
                power *= _BASE
            at = n
            starts = np.flatnonzero(left >= n)
            more, before = _groups(mix(rolled[starts]))
            if n == WINDOW:
                repeated = _covered(starts[more], n, total)
            inside[n] = _covered(starts[before], n, total)
    return [
        np.diff(firsts),
        _per_text(chars, firsts),
        _symbols(column),
        _per_text(again, lines.firsts),
        _per_text(repeated, firsts),
        _per_text(bare * again, lines.firsts),
        *(_per_text(chars * inside[n], firsts) for n in lengths),
    ]


def _symbols(column: pa.Array) -> np.ndarray:
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return _per_text(_IS_SYMBOL[data[offsets[0] : offsets[-1]]], offsets - offsets[0])


def measures(docs: DataFrame, lengths: Iterable[int] = NGRAM_LIMITS) -> DataFrame:
    """doc_id and the measures of every document.

    Words are runs of characters other than space and 0x09-0x0D, with their
    case. ``n_dup_lines`` counts lines with a word that equal an earlier line;
    ``n_repeat_words`` words in windows of 8 found twice or more, the first
    included; ``dup_ngram_chars`` leaves the first occurrence out. A null or
    empty text measures 0 throughout. Every row is judged by its own text; null
    and repeated ids stay, other columns are not read.
    """
    lengths = tuple(lengths)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [pa.array(x, pa.int64()) for x in measure(part.column("text"), lengths)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found], ["doc_id", *columns(lengths)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in columns(lengths))
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {counts}")


def base_failed() -> Column:
    """Too short, or too many words in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def repetitive(limits: dict[int, int] = NGRAM_LIMITS, line_limit: int = LINE_LIMIT) -> Column:
    """Above the limit for some length, or for lines."""
    found = 100 * F.col("dup_line_chars") > line_limit * F.col("word_chars")
    for n, limit in limits.items():
        found = found | (100 * F.col(f"dup_{n}gram_chars") > limit * F.col("word_chars"))
    return found
