"""Vectors as short codes: a codebook of integer entries for each part of the vector.

Components become integers and everything after is exact. A part's nearest entry
is found after an integer Walsh-Hadamard transform of the zero-padded part and
of the entries: the transform multiplies every squared distance by the padded
length, so sums of squared differences of coefficients compare like distances
and divide by it without a remainder. Coefficients are taken in sequency order,
the slow changes first, which hold most of a difference; an entry whose sum so
far is above the whole distance of the row's first guess goes at once.

A round of training is one pass over the vectors: each task adds up its parts by
entry, Spark adds the tasks' sums, and no more numbers than the codebooks hold
reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Rows handled at once in a task.
ROWS = 4096
# Sums travel as digits of this base, so that adding them up cannot overflow.
_DIGIT = 1 << 40
_LONG = (1 << 63) - 1


def _sequency(n: int) -> np.ndarray:
    """Order of the ``n`` rows of the Walsh-Hadamard matrix by their sign changes."""
    h = np.ones((1, 1), dtype=np.int8)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")


def transformed(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, zero-padded to a power of two, by sequency."""
    n = 1
    while n < x.shape[1]:
        n *= 2
    out = np.zeros((len(x), n), dtype=x.dtype)
    out[:, : x.shape[1]] = x
    half = 1
    while half < n:
        pairs = out.reshape(len(x), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return out[:, _sequency(n)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry, ties to the lower, and its squared distance."""
    rows, coded = transformed(x), transformed(entries)
    first = rows[:, :1] - coded[:, 0]
    first = first * first
    guess = first.argmin(axis=1)
    bound = rows - coded[guess]
    bound = (bound * bound).sum(axis=1)
    row, entry = np.nonzero(first <= bound[:, None])
    so_far = first[row, entry]
    for k in range(1, rows.shape[1]):
        step = rows[row, k] - coded[entry, k]
        so_far = so_far + step * step
        left = (so_far <= bound[row]).astype(bool)
        row, entry, so_far = row[left], entry[left], so_far[left]
    begins = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(so_far, begins)
    at = np.flatnonzero((so_far == least[row]).astype(bool))
    at = at[np.searchsorted(row[at], np.arange(len(x)))]
    return entry[at], least // rows.shape[1]


@dataclass(frozen=True)
class Codebooks:
    """Entries by part: an integer array of parts, entries and positions."""

    entries: np.ndarray
    dimension: int

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(int(c)) for c in self.entries.ravel()).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows by parts) and squared distances of integer vectors cut into parts."""
        found = [nearest(x[:, p], self.entries[p]) for p in range(len(self.entries))]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _fits(largest: float, width: int) -> bool:
    """Whether squared distances, times the padded length, fit 64 bits."""
    return 4 * (2 * width) ** 2 * largest * largest < 2.0**62


def _cut(column: pa.Array, books: Codebooks | None, parts: int, dimension: int, scale: int) -> np.ndarray:
    """Integer vectors cut into equal parts; Python integers where 64 bits could overflow."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), dimension)
    width = max(1, -(-dimension // parts))
    out = np.zeros((len(column), parts * width))
    out[:, :dimension] = x
    with np.errstate(over="ignore"):
        scaled = np.floor(out * scale)
    largest = max(float(np.abs(scaled).max(initial=0)), float(np.abs(books.entries).max(initial=0)) if books else 0)
    if _fits(largest, width):
        whole = scaled.astype(np.int64)
    else:
        whole = np.array([_floor(v, scale) for v in out.ravel()], dtype=object)
    return whole.reshape(len(column), parts, width)


def _floor(v: float, scale: int) -> int:
    over, under = float(v).as_integer_ratio()
    return over * scale // under


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose vector can be coded, all of the most frequent length (ties: the shorter)."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(v.isNotNull() & sound)
    lengths = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(v) == (lengths["n"] if lengths else 0))


def _begin(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    first = rows.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).toArrow()
    if not first.num_rows:
        return None
    column = first.column("embedding").combine_chunks()
    dimension = len(column[0])
    return Codebooks(_cut(column, None, parts, dimension, scale).transpose(1, 0, 2), dimension)


def _sums(rows: DataFrame, books: Codebooks, scale: int) -> DataFrame:
    """Per part, entry and position (-1: number of parts) the digits of the sum."""
    n_parts, n_entries, width = books.entries.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_parts, n_entries, width + 1), dtype=object)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                x = _cut(batch.column(0).slice(a, ROWS), books, n_parts, books.dimension, scale)
                codes, _ = books.assign(x)
                for p in range(n_parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    used, begins, counts = np.unique(codes[order, p], return_index=True, return_counts=True)
                    sums[p, used, :width] += np.add.reduceat(x[order, p], begins, axis=0).astype(object)
                    sums[p, used, width] += counts.astype(object)
        digit, sign = 0, np.sign(sums).astype(np.int64)
        rest = abs(sums)
        while (at := np.nonzero((rest != 0).astype(bool)))[0].size:
            low = (rest[at] % _DIGIT).astype(np.int64) * sign[at]
            place = np.where(at[2] == width, -1, at[2])
            arrays = [at[0], at[1], place, np.full(len(low), digit), low]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in arrays], ["part", "entry", "place", "digit", "low"]
            )
            rest, digit = rest // _DIGIT, digit + 1

    schema = "part bigint, entry bigint, place bigint, digit bigint, low bigint"
    keys = ["part", "entry", "place", "digit"]
    return rows.select("embedding").mapInArrow(run, schema).groupBy(*keys).agg(F.sum("low").alias("low"))


def train(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks from all rows of :func:`usable`; None without rows.

    They begin as the parts of the rows with the smallest ``vec_id`` (nulls last,
    ties by vector). A round moves every used entry to the mean of its parts,
    rounded down; unused entries stay. Rounds that would change nothing are not run.
    """
    books = _begin(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        n_parts, n_entries, width = books.entries.shape
        sums = np.zeros((n_parts, n_entries, width + 1), dtype=object)
        for r in _sums(rows, books, scale).collect():  # as many as the codebooks have numbers, by digits
            sums[r["part"], r["entry"], r["place"]] += r["low"] * _DIGIT ** r["digit"]
        moved = books.entries.astype(object)
        used = np.nonzero((sums[:, :, width] != 0).astype(bool))
        moved[used] = sums[:, :, :width][used] // sums[:, :, width][used][:, None]
        if (moved == books.entries).all():
            break
        if _fits(float(abs(moved).max()), width):
            moved = moved.astype(np.int64)
        books = Codebooks(moved, books.dimension)
    return books


def encode(rows: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """vec_id and label of each row of :func:`usable`, its code (one byte a part) and its error.

    The error is the squared distance to the coded vector, in the scaled
    integers; beyond a long it is given as the largest long.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _cut(part.column("embedding"), books, len(books.entries), books.dimension, scale)
                codes, errors = books.assign(x)
                errors = np.minimum(errors.astype(object).sum(axis=1), _LONG).astype(np.int64)
                raw = [c.tobytes() for c in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array(raw, pa.binary()), pa.array(errors)],
                    ["vec_id", "label", "code", "error"],
                )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return rows.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error bigint"
    )


def label_errors(coded: DataFrame) -> DataFrame:
    """The rows with the sum of the errors of all rows of their label, nulls being one label."""
    most = F.lit(_LONG).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most).cast("bigint")
    sums = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
