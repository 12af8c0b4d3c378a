"""Connected components of a link table, in bounded pieces and Spark joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Workspace

# Links that one task contracts by itself.
PIECE = 500_000


def _contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node but the smallest of its component among these links, and that smallest."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        # Hook both ends and their present roots below the smaller label.
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(new, ends, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out():
        u, v = _contracted(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
        size += batch.num_rows
        if size >= 4 * PIECE:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, work: Workspace, name: str, piece: int = PIECE) -> DataFrame:
    """``u`` and ``v``: each linked node and the smallest node of its component.

    ``edges`` has two bigint columns ``u`` and ``v``, in any order and number.
    Links are dealt to as many tasks as their number asks for, and each task
    contracts its own. If that was one task, all is done; otherwise large-star
    and small-star steps, contracted again, alternate until nothing changes.
    Each result is a table in the shared folder; only a count and a sum reach
    the driver. The smallest nodes are not in the result.
    """
    edges = edges.filter("u <> v")
    tasks = max(1, -(-edges.count() // piece))
    now = work.write(edges.repartition(tasks).mapInArrow(_pieces, "u bigint, v bigint"), f"{name}-0")
    if tasks == 1:
        return now
    state, k = _state(now), 0
    while True:
        k += 1
        stars = _small_star(_large_star(now)).distinct().mapInArrow(_pieces, "u bigint, v bigint")
        new = work.write(stars.distinct(), f"{name}-{k}")
        new_state = _state(new)
        work.drop(f"{name}-{k - 1}")
        if new_state == state:
            return new
        now, state = new, new_state
