"""Approximate nearest neighbours with an inverted multi-index.

Vectors are scaled to length one and cut in halves; each half has its own
codebook, trained by k-means on a bounded sample. A pair of centroids is a
cell, and every vector is listed in one cell. For a query the cells are taken
by increasing sum of the two distances, with a heap over the two sorted lists
(the multi-sequence walk), until the cells hold the wanted share of all
vectors. The entries of those cells are then ranked by their exact cosine.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import Workspace

CENTROIDS = 32
# Rows the codebooks are trained on, the first by a hash of the id.
SAMPLE_ROWS = 20_000
# Share of all vectors a query looks at. Vectors without any cluster structure,
# as in the test tables, need as much for a recall of 0.9 and more.
VISITED = 0.5
# Queries handed out per pass over the index.
BLOCK = 8192
# Scores this near to the last place are computed again, in one fixed order.
NEAR = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids after Lloyd rounds from rows spread over the sample."""
    k = max(1, min(k, len(x)))
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = _distances(x, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        sizes = np.bincount(nearest, minlength=k)
        centroids[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centroids


@dataclass(frozen=True)
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return _distances(x[:, :cut], self.first), _distances(x[:, cut:], self.second)

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def walk(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
        """Cells by summed distance until they hold ``wanted`` vectors."""
        by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[by_a].tolist(), b[by_b].tolist()
        heap, met, cells, held = [(a[0] + b[0], 0, 0)], {(0, 0)}, [], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(by_a[i]) * len(self.second) + int(by_b[j])
            if sizes[cell]:
                cells.append(cell)
                held += int(sizes[cell])
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(a) and q < len(b) and (p, q) not in met:
                    met.add((p, q))
                    heapq.heappush(heap, (a[p] + b[q], p, q))
        return cells


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, all of one length.

    Out are rows without id, and vectors that are null, zero, hold a null or
    non-finite component, or have another length than the most frequent one.
    """
    v = F.col("embedding").cast("array<double>")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & sound & (norm > 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (lengths["n"] if lengths else 0))


def train(rows: DataFrame, centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS) -> Codebooks | None:
    """Codebooks from at most ``sample_rows`` vectors; None without vectors."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").toArrow()
    if not sample.num_rows:
        return None
    x = _unit(_matrix(sample.column("vector").combine_chunks()))
    cut = max(1, x.shape[1] // 2)
    k = min(centroids, max(1, len(x) // 8))
    return Codebooks(kmeans(x[:, :cut], k), kmeans(x[:, cut:], k) if x.shape[1] > cut else np.zeros((1, 0)))


def _best(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, allowed: np.ndarray, k: int):
    """Per query its ``k`` nearest allowed rows: query, row and score, ties to the smaller id."""
    out = ([], [], [])
    rough = q @ x.T
    rough[~allowed] = -np.inf
    for n in range(len(q)):
        row = rough[n]
        at = np.flatnonzero(row > -np.inf)
        if len(at) > k:
            least = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= least - NEAR]
        exact = (q[n] * x[at]).sum(axis=1)
        order = np.lexsort((ids[at], -exact))[:k]
        out[0].append(np.full(len(order), query_ids[n]))
        out[1].append(ids[at][order])
        out[2].append(exact[order])
    return [np.concatenate(c) for c in out]


def search(vectors: DataFrame, is_query, k: int = 5, visited: float = VISITED) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found for every row that ``is_query`` names.

    ``is_query`` is a condition on vec_id. Candidates are all usable rows with
    another id; score is the cosine in double precision. A query without
    candidates gives no row. Repeated ids are candidates like any other, and a
    repeated query row is one query. Every row is indexed. Queries go out in
    blocks of a fixed number, one pass over the index for each; per pass only
    the cells that one of them visits are read, and each task keeps ``k`` rows
    per query. A cell that holds a third of all rows is read by as many tasks
    as its size asks for.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "ann")
    rows = work.write(usable(vectors), "rows")
    books = train(rows)
    schema = "query_id bigint, vec_id bigint, score double"
    if books is None:
        found = spark.createDataFrame([], schema)
    else:
        shared = spark.sparkContext.broadcast(books)

        def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = shared.value.cell(_unit(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32))], ["vec_id", "vector", "cell"]
                )

        index = rows.mapInArrow(assign, "vec_id bigint, vector array<double>, cell int")
        index = work.write(index.repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id"), "index")
        sizes = np.zeros(books.cells, dtype=np.int64)
        for r in index.groupBy("cell").count().collect():  # one row per cell at most
            sizes[r["cell"]] = r["count"]
        wanted = visited * sizes.sum()

        def visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                a, b = own.halves(_unit(_matrix(batch.column("vector"))))
                cells = [own.walk(x, y, sizes, wanted) for x, y in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], ["vec_id", "vector", "cells"]
                )

        queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
        queries = work.write(
            queries.mapInArrow(visits, "vec_id bigint, vector array<double>, cells array<int>"), "queries"
        )
        blocks = -(-queries.count() // BLOCK)
        work.write(spark.createDataFrame([], schema), "found")
        for n in range(blocks):
            part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).orderBy("vec_id").toArrow()
            if part.num_rows:
                # Stored before the next block is fetched: the driver holds one block at a time.
                block = spark.sparkContext.broadcast(_visits(part, books.cells))
                work.append(_pass(index, block, k, schema), "found")
                block.destroy()
        found = work.read("found", schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    result = work.write(ranked.select("query_id", "rank", "vec_id", "score"), "result")
    work.keep("result")
    return result


def _visits(part: pa.Table, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block of queries the ids, unit vectors and which cells each visits."""
    ids = part.column("vec_id").to_numpy()
    q = _unit(_matrix(part.column("vector").combine_chunks()))
    visits = np.zeros((len(ids), cells), dtype=bool)
    for n, own in enumerate(part.column("cells").to_pylist()):
        visits[n, own] = True
    return ids, q, visits


def _pass(index: DataFrame, shared: Broadcast, k: int, schema: str) -> DataFrame:
    """The nearest rows each task finds for one block of queries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, visits = shared.value
        held = None
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                rows = batch.slice(a, 2048)
                x, own = _unit(_matrix(rows.column("vector"))), rows.column("vec_id").to_numpy()
                cell = rows.column("cell").to_numpy()
                new = []
                for b in range(0, len(ids), 1024):
                    to = slice(b, b + 1024)
                    allowed = visits[to][:, cell] & (ids[to][:, None] != own[None, :])
                    new.append(_best(ids[to], q[to], own, x, allowed, k))
                new = [np.concatenate(c) for c in zip(*new, strict=True)]
                if held is not None:
                    new = [np.concatenate(c) for c in zip(held, new, strict=True)]
                    order = np.lexsort((new[1], -new[2], new[0]))
                    new = [c[order] for c in new]
                    starts = np.searchsorted(new[0], new[0], side="left")
                    keep = np.arange(len(starts)) - starts < k
                    new = [c[keep] for c in new]
                held = new
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], ["query_id", "vec_id", "score"])

    visited = np.flatnonzero(shared.value[2].any(axis=0)).tolist()
    return index.filter(F.col("cell").isin(visited)).mapInArrow(run, schema)
