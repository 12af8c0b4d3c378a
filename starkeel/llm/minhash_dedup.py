"""Near-duplicate documents by a MinHash LSH forest.

A document's set is the set of its word shingles. Texts with equal sets are
put together first; the rest works on one member of each class.

Each class gets a MinHash signature. The forest is ``TREES`` orders of it: in
each, signatures are written as a sequence of ``DEPTH`` values in an order of
its own and sorted. Classes that stand next to each other and agree in the
first ``LEAST_PREFIX`` values or more are candidates. How deep a prefix has to
be is thus decided by each region itself: where few signatures share a short
prefix, neighbours meet at that depth, and where thousands do, only those
with the longest common prefixes stand side by side.

Candidates are confirmed on the full sets, in two rounds at every size: a cheap
one, and one that passes over neighbours that are already in the same component,
so that a document of a dense region meets those it is not yet linked to. They
only make components large at little cost; what they leave out, a last pass
makes up for. In a region with few members outside its largest component, these
are held against all members. Regions with more are taken together by that
component, and each such group gets a pivot, the shingles that most of its
members have. Of a member x only the differences from the pivot c are kept:
a = |c - x|, b = |x - c|, and its weight w = 100 a + p b at p percent. For two members
that share s differences

    100 |x & y| - p |x | y| = (100 - p) |c| - w(x) - w(y) + (100 + p) s.

So all members light enough to be linked whatever they share are linked with the
lightest one, and any other link needs a number of shared differences that the
two weights tell. Of d differences in order of their frequency, r of which have to
be shared, one of the first d - r + 1 is then shared: only members that meet in one
of these are candidates. Since r depends on the other's weight, members meet per
band of weights. Copies with edits of their own so cost what they
differ in, not their number squared, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import texts as T
from .components import components
from .staging import Workspace

WORDS = 5
HASHES = 128
TREES = 24
DEPTH = 8
LEAST_PREFIX = 4
# Trees of the first, cheap round; most copies meet in them.
FIRST_TREES = 6
FIRST_WINDOW = 1
# Neighbours looked at in each order, and how many of them become candidates.
WINDOW = 32
BEST = 2
# Bits that tell texts whose sets are wanted from most others; 64 of them are a row of a broadcast table.
TEXT_BITS = 1 << 26
# Members outside its largest component up to which a region compares them one by one.
SPARSE = 4
# Bands of weight up to the weight that two members may have together.
BANDS = 8

_rng = np.random.default_rng(5)
_FACTOR = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_ORDERS = np.stack([_rng.permutation(HASHES)[:DEPTH] for _ in range(TREES)])

FEATURES = "doc_id bigint, text_key bigint, n_shingles bigint, set_a bigint, set_b bigint, signature binary"
DIFFERENCES = (
    "group bigint, node bigint, component bigint, w bigint, most bigint, d bigint, differences array<bigint>"
)


def _signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(x), 2048):
        np.minimum(least, (x[a : a + 2048, None] * _FACTOR + _SHIFT).min(axis=0), out=least)
    return least


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            _, _, _, hashes, firsts = T.words(part.column("text"))
            sets = T.shingles(hashes, firsts, WORDS)
            with np.errstate(over="ignore"):
                a = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                b = np.array([T.mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(a),
                    pa.array(b.view(np.int64)),
                    pa.array([_signature(s).tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "signature"],
            )


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            _, _, _, hashes, firsts = T.words(part.column("text"))
            sets = T.shingles(hashes, firsts, WORDS)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"]
            )


def _forest(trees: int):
    """One row per class and tree: the signature in that tree's order, and a sketch of it all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                n = part.num_rows
                sig = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(n, HASHES)
                # The lowest bit of each value: equal values agree, others in half of the cases.
                sketch = np.packbits(((sig * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8), axis=1)
                sketches = [r.tobytes() for r in sketch]
                for t in range(trees):
                    keys = sig[:, _ORDERS[t]].astype(">u4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, t, np.int32)),
                            pa.array([k.tobytes() for k in keys], pa.binary()),
                            part.column("node"),
                            part.column("component"),
                            pa.array(sketches, pa.binary()),
                        ],
                        ["tree", "key", "node", "component", "sketch"],
                    )

    return run


def _neighbours(window: int, most: int):
    """Candidates among rows sorted by (tree, key).

    A row is held against the ``window`` rows after the end of its run, a run
    being rows of one component; the ``most`` of them that are most alike by
    sketch are its candidates. Rows that the following batches may still meet are carried over.
    """

    most = min(most, window)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            rows = (
                batch.column("tree").to_numpy(),
                np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(n, DEPTH),
                batch.column("node").to_numpy(),
                batch.column("component").to_numpy(),
                np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(n, HASHES // 64),
            )
            old = 0 if held is None else len(held[0])
            if held is not None:
                rows = tuple(np.concatenate([h, r]) for h, r in zip(held, rows, strict=True))
            tree, key, node, component, sketch = rows
            n = len(tree)
            region = np.concatenate(
                [[True], (tree[1:] != tree[:-1]) | (key[1:, :LEAST_PREFIX] != key[:-1, :LEAST_PREFIX]).any(axis=1)]
            )
            region = np.cumsum(region)
            ends = np.flatnonzero(np.concatenate([component[1:] != component[:-1], [True]])) + 1
            run_end = ends[np.searchsorted(ends, np.arange(n), side="right")]
            # The most alike of the window, best first.
            score = np.full((most, n), -1)
            best = np.zeros((most, n), dtype=np.int64)
            for k in range(window):
                i = np.flatnonzero(run_end + k < n)
                j = run_end[i] + k
                same = region[i] == region[j]
                if not same.any():
                    break
                new = same & (j >= old) & (component[i] != component[j])
                i, j = i[new], j[new]
                equal = HASHES - np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1).astype(np.int64)
                for rank in range(most):
                    ahead = equal > score[rank, i]
                    old_equal, old_j = score[rank, i[ahead]], best[rank, i[ahead]]
                    score[rank, i[ahead]], best[rank, i[ahead]] = equal[ahead], j[ahead]
                    # Who has been overtaken competes for the next place.
                    equal, j = equal.copy(), j.copy()
                    equal[ahead], j[ahead] = old_equal, old_j
            rank, i = np.nonzero(score >= 0)
            left, right = node[i], node[best[rank, i]]
            # Rows of the last region whose window reaches past the last row may meet rows to come.
            starts = np.concatenate([[0], ends[:-1]])
            open_run = starts[np.searchsorted(ends, max(0, n - window), side="right")]
            begin = max(int(np.searchsorted(region, region[-1])), int(open_run))
            held = tuple(r[begin:] for r in rows)
            if len(left):
                pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    return run


def _confirm(numerator: int, denominator: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("shingles_u"), batch.column("shingles_v"), strict=True):
                x = np.frombuffer(a.as_buffer(), np.uint64)
                y = np.frombuffer(b.as_buffer(), np.uint64)
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                both = int((merged[1:] == merged[:-1]).sum())
                keep.append(bool(len(x)) and denominator * both >= numerator * (len(x) + len(y) - both))
            part = batch.select(["u", "v"])
            yield part.filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept and a hash of its text.

    Two documents are linked if 100 x intersection >= ``percent`` x union of
    their sets of distinct five-word shingles (A-Z lowered; a shorter text's
    whole sequence counts as one). ``component_id`` is the smallest doc_id that
    links lead to, ``kept`` whether the row has that id.

    Null, empty and blank texts have an empty set and are linked with nothing.
    Rows that share a doc_id are judged each by its own text, and their component
    has the smallest id of its texts, which unlike texts may then share. A row without doc_id is linked with nothing, has no component and is kept. An
    empty table gives an empty result; other columns are not read.

    Links are exact, on the full sets as 64-bit hashes. A pair at the threshold
    shares a prefix of ``LEAST_PREFIX`` in one of the orders with a probability
    of 1 - 10^-7 (85 percent), more above it, and no link between two that share
    one is left out. Sets are only made for documents that have
    a candidate. A hot group costs one row per member and tree, and its sort is
    split by key range.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near-duplicates")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    features = work.write(rows.mapInArrow(_features, FEATURES), "features")
    classes = work.write(
        features.filter("doc_id is not null and n_shingles > 0")
        .groupBy("set_a", "set_b")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"),
            F.min("n_shingles").alias("n"),
            F.min("signature").alias("signature"),
        )
        # A number of the set's own: ids may be shared by unlike texts.
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    # The signatures are in the classes now, once for each set.
    features = work.write(features.drop("signature"), "sizes")
    work.drop("features")
    links = _links(rows, classes, percent, work)
    labels = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    of_set = classes.select("set_a", "set_b", "node", F.col("first.doc_id").alias("doc_id")).join(labels, "node", "left")
    of_set = of_set.withColumn("label", F.coalesce("label", "node"))
    least = of_set.groupBy("label").agg(F.min("doc_id").alias("label_id"))
    of_set = of_set.join(least, "label").select("set_a", "set_b", "label_id")
    found = (
        features.join(of_set, ["set_a", "set_b"], "left")
        .withColumn(
            "component_id",
            F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("label_id")),
        )
    )
    result = work.write(
        found.select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "text_key",
        ),
        "result",
    )
    work.keep("result")
    return result


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest id.

    Documents with an empty set and rows without doc_id all stay. Of rows that
    share id and text one stays. All columns as they were.
    """
    kept = near_duplicates(docs, percent).filter("kept and doc_id is not null")
    kept = kept.select("doc_id", "text_key").distinct()
    # The whole row travels as one column, so that no name can clash.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = F.xxhash64(F.col("text").cast("string"))
    named = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("text_key"), whole
    )
    ordered = Window.partitionBy("doc_id", "text_key").orderBy("row")
    first = (
        named.join(kept, ["doc_id", "text_key"], "left_semi")
        .withColumn("n", F.row_number().over(ordered))
        .filter("n = 1")
    )
    return first.select("row.*").unionByName(docs.filter("doc_id is null"))


def _links(rows: DataFrame, classes: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Each linked node with the smallest node of its component (columns u, v)."""
    forest_schema = "tree int, key binary, node bigint, component bigint, sketch binary"
    star = rows.sparkSession.createDataFrame([], "u bigint, v bigint")
    checked = sets = None
    for round_, (trees, window) in enumerate([(FIRST_TREES, FIRST_WINDOW), (TREES, WINDOW)]):
        labelled = classes.select("node", "signature").join(
            star.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left"
        )
        labelled = labelled.select("node", "signature", F.coalesce("label", "node").alias("component"))
        forest = (
            labelled.mapInArrow(_forest(trees), forest_schema)
            .repartitionByRange("tree", "key", "node")
            .sortWithinPartitions("tree", "key", "component", "node")
        )
        new = forest.mapInArrow(_neighbours(window, BEST), "u bigint, v bigint").distinct()
        if checked is not None:
            new = new.join(checked, ["u", "v"], "left_anti")
        new = work.write(new, f"new-{round_}")
        links, sets = _confirmed(new, classes, rows, sets, percent, work, str(round_))
        checked = new if checked is None else checked.unionByName(new)
        star = components(star.unionByName(links), work, f"components-{round_}")
    regions = _open_regions(classes, star, work)
    rest = _few(regions, percent).unionByName(_many(regions, classes, rows, sets, percent, work))
    rest = work.write(rest.distinct().join(checked, ["u", "v"], "left_anti"), "new-last")
    work.drop("regions", "differences", "lists")
    if rest.isEmpty():
        return star
    links, _ = _confirmed(rest, classes, rows, sets, percent, work, "last")
    return components(star.unionByName(links), work, "components-last")


def _with_sets(
    nodes: DataFrame, classes: DataFrame, rows: DataFrame, sets: DataFrame | None, work: Workspace, name: str
) -> DataFrame:
    """The sets made so far and those of ``nodes``, one row per node."""
    if sets is not None:
        nodes = nodes.join(sets.select("node"), "node", "left_anti")
    nodes = nodes.join(classes.select("node", "first.doc_id", "first.text_key"), "node")
    nodes = work.write(nodes, f"nodes-{name}")
    keys = ["doc_id", "text_key"]
    # Rows that share id and text are one.
    texts = _with_texts_of(rows, nodes).join(nodes, keys).groupBy("node", *keys).agg(F.first("text").alias("text")).select("node", "text")
    found = work.write(texts.mapInArrow(_sets, "node bigint, shingles binary"), f"sets-{name}")
    work.drop(f"nodes-{name}")
    return found if sets is None else sets.unionByName(found)


def _with_texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` without most of those whose text no node has, so that these are not shuffled.

    One bit of a table with a bound tells; rows that share it with a node stay.
    """
    place = F.shiftright(F.col("text_key").bitwiseAND(F.lit(TEXT_BITS - 1)), 6)
    bit = F.expr("shiftleft(1L, cast(text_key & 63 as int))")
    wanted = nodes.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("bits"))
    found = rows.withColumn("place", place).join(F.broadcast(wanted), "place")
    return found.filter(F.col("bits").bitwiseAND(bit) != 0).drop("place", "bits")


def _confirmed(
    new: DataFrame, classes: DataFrame, rows: DataFrame, sets: DataFrame | None, percent: int, work: Workspace, name: str
) -> tuple[DataFrame, DataFrame]:
    """The links among candidates ``new``, and the sets made so far."""
    nodes = new.select(F.col("u").alias("node")).union(new.select("v")).distinct()
    sets = _with_sets(nodes, classes, rows, sets, work, name)
    pairs = (
        new.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("shingles_u")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("shingles_v")), "v")
        .mapInArrow(_confirm(percent, 100), "u bigint, v bigint")
    )
    return work.write(pairs, f"links-{name}"), sets


def _open_regions(classes: DataFrame, star: DataFrame, work: Workspace) -> DataFrame:
    """Rows of the regions in which several components meet, in any order of the forest.

    ``top`` is the region's largest component, ``outside`` the number of its
    rows that are not in it.
    """
    label = star.select(F.col("u").alias("node"), F.col("v").alias("label"))
    rows = classes.select("node", "n", "signature").join(label, "node", "left")
    rows = rows.select("node", "n", "signature", F.coalesce("label", "node").alias("component"))
    rows = rows.mapInArrow(_regions, "region bigint, node bigint, n bigint, component bigint")
    sizes = rows.groupBy("region", "component").agg(F.count("*").alias("size"))
    top = sizes.groupBy("region").agg(
        F.count("*").alias("components"),
        F.sum("size").alias("members"),
        F.max(F.struct("size", "component")).alias("largest"),
    )
    top = top.filter("components > 1").select(
        "region", F.col("largest.component").alias("top"), (F.col("members") - F.col("largest.size")).alias("outside")
    )
    return work.write(rows.join(top, "region"), "regions")


def _few(regions: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in the regions with few members outside the largest one.

    Left out are only pairs whose sizes alone rule a link out.
    """
    rows = regions.filter(F.col("outside") <= SPARSE)
    outside = rows.filter("component <> top").select(
        "region", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("of_a")
    )
    met = outside.join(rows, "region").filter(
        (F.col("of_a") != F.col("component"))
        & ((F.col("component") == F.col("top")) | (F.col("a") < F.col("node")))
        & (100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a"))
    )
    return met.select(F.least("a", "node").alias("u"), F.greatest("a", "node").alias("v"))


def _many(
    regions: DataFrame, classes: DataFrame, rows: DataFrame, sets: DataFrame | None, percent: int, work: Workspace
) -> DataFrame:
    """Pairs that include every link between components in the other regions, by pivots."""
    members = regions.filter(F.col("outside") > SPARSE).select(F.col("top").alias("group"), "node", "component").distinct()
    members = work.write(members, "grouped")
    sets = _with_sets(members.select("node").distinct(), classes, rows, sets, work, "grouped")
    members = work.write(members.join(sets, "node").select("group", "node", "component", "shingles"), "members")
    sizes = members.groupBy("group").agg(F.count("*").alias("size"))
    held = members.select("group", "shingles").mapInArrow(_elements, "group bigint, element bigint")
    held = held.groupBy("group", "element").agg(F.count("*").alias("n")).join(sizes, "group")
    # No more than twice as many as a member has on average.
    pivots = held.filter(2 * F.col("n") > F.col("size")).groupBy("group").agg(F.collect_list("element").alias("pivot"))
    found = work.write(
        members.join(pivots, "group", "left").mapInArrow(_differences(percent), DIFFERENCES), "differences"
    )
    work.drop("members", "grouped")
    least = found.groupBy("group").agg(F.min(F.struct("w", "node", "component")).alias("lightest"))
    found = found.join(least, "group").withColumn("over", F.col("w") + F.col("lightest.w") - F.col("most"))
    light = found.filter((F.col("over") <= 0) & (F.col("component") != F.col("lightest.component"))).select(
        F.least("node", "lightest.node").alias("u"), F.greatest("node", "lightest.node").alias("v")
    )
    # Members are told apart by bands of weight: what two have to share depends on both.
    width = F.greatest(F.floor(F.col("most") / BANDS), F.lit(100)).alias("width")
    found = found.join(found.groupBy("group").agg(F.max("w").alias("heaviest")), "group")
    each = found.select(
        "group", "node", "component", "w", "most", "d", width, F.col("heaviest"),
        (F.col("over") > 0).alias("heavy"), F.explode("differences").alias("element"),
    )
    common = each.groupBy("group", "element").agg(
        F.count("*").alias("n"), F.count_if("heavy").alias("n_heavy"),
        F.min("component").alias("lo"), F.max("component").alias("hi"),
    )
    order = Window.partitionBy("group", "node").orderBy("n", "element")
    # With a member of a band, so much can be shared from this difference on.
    left = (100 + percent) * (F.col("d") - F.col("place") + 1) + F.col("most") - F.col("w")
    reach = F.floor(F.least(left, F.col("heaviest")) / F.col("width"))
    lists = (
        each.join(common, ["group", "element"])
        .withColumn("place", F.row_number().over(order))
        .filter((F.col("n_heavy") > 0) & (F.col("lo") != F.col("hi")) & (left >= 0))
        .select(
            "group", "element", "node", "component", "heavy", F.floor(F.col("w") / F.col("width")).alias("band"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), reach)).alias("other"),
        )
    )
    lists = work.write(lists, "lists")
    heavy = lists.filter("heavy").select(
        "group", "element", F.col("other").alias("band"), F.col("band").alias("other"),
        F.col("node").alias("a"), F.col("component").alias("of_a"),
    )
    met = heavy.join(lists, ["group", "element", "band", "other"]).filter(
        (F.col("of_a") != F.col("component")) & (~F.col("heavy") | (F.col("a") < F.col("node")))
    )
    return light.unionByName(met.select(F.least("a", "node").alias("u"), F.greatest("a", "node").alias("v")))


def _elements(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "shingles"):
            sets = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
            group = np.repeat(part.column("group").to_numpy(), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), pa.array(np.concatenate([*sets, np.empty(0, np.int64)]))], ["group", "element"]
            )


def _differences(percent: int):
    """Per member its weight, the weight two members may have together, and its differences from the pivot."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "shingles"):
                w, most, found = [], [], []
                for x, c in zip(part.column("shingles").to_pylist(), part.column("pivot").to_pylist(), strict=True):
                    x, c = np.frombuffer(x, np.int64), np.array(c or [], dtype=np.int64)
                    gone, added = np.setdiff1d(c, x), np.setdiff1d(x, c)
                    w.append(100 * len(gone) + percent * len(added))
                    most.append((100 - percent) * len(c))
                    found.append(np.concatenate([gone, added]))
                own = [part.column(k) for k in ("group", "node", "component")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(w, pa.int64()), pa.array(most, pa.int64()),
                     pa.array([len(f) for f in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                    ["group", "node", "component", "w", "most", "d", "differences"],
                )

    return run


def _regions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and order: a hash of the order and the first ``LEAST_PREFIX`` values."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            n = part.num_rows
            sig = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(n, HASHES)
            for t in range(TREES):
                region = np.full(n, t, np.uint64)
                for p in range(LEAST_PREFIX):
                    region = T.mix(region ^ sig[:, _ORDERS[t, p]].astype(np.uint64))
                    region += np.uint64(p + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.view(np.int64)), *(part.column(c) for c in ("node", "n", "component"))],
                    ["region", "node", "n", "component"],
                )
