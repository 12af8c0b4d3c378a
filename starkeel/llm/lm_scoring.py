"""Texts scored by a small causal self-attention model over subword ids.

A text is its words with single spaces between them, A-Z lowered, then an end
token. Words are cut into the ids of a public byte-level BPE vocabulary. The
model gives each next id a probability in steps: its group by a softmax, its
class by a softmax within the group, and the id within the class by training
counts. Frequent ids are classes of their own; the others share classes of
equal training weight. Both softmaxes add up a bigram table, counted over all
training texts, and what one head of causal self-attention over the last ids
contributes. The attention's weights are trained in numpy, in ``PASSES`` passes over
all ids of all training texts. Texts are dealt by a hash of id and text and lie in
segments of about ``SEGMENT_BYTES``. In a pass each segment starts from the same
weights and takes all its windows, none of which reaches into another text; the
weights it arrives at are averaged over all segments by the number of windows, and
the next pass starts from there. How the input is partitioned or the tasks are cut
has no influence, and nothing but the averages ties segments together.

Scoring cuts a text into windows that overlap by ``CONTEXT`` ids; each id is
scored once, in the window where it has most context, and windows are run
through masked attention in batches.

Beside it stands the base score, a smoothed unigram over whole words.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import texts as T
from .staging import Workspace

SEGMENT_BYTES = 2 << 20
# Texts are dealt to (bytes / PART_BYTES) ** PART_POWER parts: both their size and number grow with the table.
PART_BYTES = 8 << 20
PART_POWER = 0.75
GROUPS = 32
MEMBERS = 32
CLASSES = GROUPS * MEMBERS
FREQUENT = 896
WIDTH = 16
WINDOW = 32
CONTEXT = 8
# Words at most whose counts every worker gets; the counts of all others meet their texts in a join.
COMMON = 1 << 18
# What a word adds to a base score is summed over partitions in units of this, so that their order makes no difference.
UNIT = 2.0**-32
# Passes over all training ids, whatever their number.
PASSES = 2
# Windows a step of training takes at once.
BATCH = 128
RATE = 0.01
# Largest logit; e to its power is far from the limits of 32-bit floats.
LIMIT = 40
SMOOTH = 0.1
# Weight of the classes' shares in a row of the bigram table.
PULL = 20

SEGMENTS = (
    "seg bigint, doc_ids array<bigint>, held array<boolean>, n_words binary, words binary, "
    "hashes binary, train binary, sub binary, sub_lengths binary, sub_ids array<int>, sub_counts array<bigint>"
)


@dataclass(frozen=True)
class Encoder:
    """A vocabulary's encoder, and the number of bytes of each id's token."""

    encoding: object
    sizes: np.ndarray

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space before it, and how many each word has.

        Words are encoded in one text: no pre-token goes on past a space, save in white
        space. A word that holds some other white space is therefore encoded by itself.
        """
        text = b" ".join([b"", *words]).decode("utf-8", "replace")
        if not _ODD.search(text):
            return self._joined(text)
        words = text.split(" ")[1:]
        odd = np.array([bool(_ODD.search(w)) for w in words])
        plain, lengths = self._joined("".join(" " + w for w, o in zip(words, odd, strict=True) if not o))
        alone = [self.encoding.encode_ordinary(" " + words[i]) for i in np.flatnonzero(odd)]
        own = np.array([len(ids) for ids in alone])
        counts = np.empty(len(words), np.int64)
        counts[odd], counts[~odd] = own, lengths
        # Where an odd word stands among the ids of the plain ones.
        before = np.cumsum(np.where(odd, 0, counts))[odd]
        return np.insert(plain, np.repeat(before, own), [i for ids in alone for i in ids]), counts

    def _joined(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.uint16)
        begins = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == ord(" "))
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), begins, side="right"), append=len(ids))


_ODD = re.compile(r"[^\S ]")


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """The vocabulary's encoder; a file of ranks in base64, one token a line."""
    import base64

    import tiktoken

    from .bpe import PRETOKEN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if max(ranks.values()) >= 1 << 16:
        raise ValueError("ids are kept in 16 bits: the vocabulary may hold 65,536 tokens at most")
    sizes = np.zeros(1 << 16, np.int64)
    sizes[list(ranks.values())] = [len(token) for token in ranks]
    return Encoder(tiktoken.Encoding("subwords", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}), sizes)


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest one needs; the first byte tells how many.

    All lowest bytes come first, then all second ones: small numbers leave the later ones alike,
    so that a stored table holds little more than what they tell.
    """
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    flat = numbers.astype(kind.newbyteorder("<")).view(np.uint8)
    return bytes([kind.itemsize]) + flat.reshape(-1, kind.itemsize).T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(packed[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{packed[0]}").ravel().astype(np.int64)


class _Segment:
    """Words of some texts, each distinct word once."""

    def __init__(self):
        self.ids, self.held, self.counts = [], [], []
        self.hashes, self.train, self.words, self.spelt = [], [], [], []
        self.size = 0

    def add(self, part: pa.RecordBatch) -> None:
        data, starts, ends, hashes, firsts = T.words(part.column("text"))
        held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        self.ids += part.column("doc_id").to_pylist()
        self.held += held.tolist()
        self.counts.append(np.diff(firsts))
        in_training = np.repeat(~held, np.diff(firsts))
        self.hashes.append(distinct)
        self.train.append(np.bincount(inverse, in_training, len(distinct)).astype(np.int64))
        self.words.append(inverse)
        flat = data.tobytes()
        self.spelt.append(np.array([flat[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], object))
        self.size += len(data)

    def row(self, seg: int, encoder: Encoder) -> tuple:
        hashes, at, inverse = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True)
        train = np.bincount(inverse, np.concatenate(self.train), len(hashes)).astype(np.int64)
        shift = np.cumsum([0, *map(len, self.hashes[:-1])])
        words = np.concatenate([inverse[w + s] for w, s in zip(self.words, shift, strict=True)])
        # Frequent words get the small numbers.
        order = np.argsort(-np.bincount(words, minlength=len(hashes)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        hashes, at, train, words = hashes[order], at[order], train[order], rank[words]
        spelt = np.concatenate(self.spelt)[at]
        flat, lengths = encoder.ids(spelt.tolist())
        used = np.bincount(flat, np.repeat(train, lengths)) if len(flat) else np.empty(0)
        ids = np.flatnonzero(used)
        return (
            seg,
            self.ids,
            self.held,
            _pack(np.concatenate(self.counts)),
            _pack(words),
            hashes.tobytes(),
            _pack(train),
            _pack(flat),
            _pack(lengths),
            ids.tolist(),
            used[ids].astype(np.int64).tolist(),
        )


_SEGMENT_TYPES = [
    pa.int64(),
    pa.list_(pa.int64()),
    pa.list_(pa.bool_()),
    *[pa.binary()] * 6,
    pa.list_(pa.int32()),
    pa.list_(pa.int64()),
]
_SEGMENT_NAMES = [c.split()[0] for c in SEGMENTS.split(", ")]


def _segments(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        seg, open_ = TaskContext.get().partitionId() << 32, _Segment()

        def closed():
            row = open_.row(seg, encoder)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, _SEGMENT_TYPES, strict=True)], _SEGMENT_NAMES
            )

        for batch in batches:
            for part in T.slices(batch, "text", SEGMENT_BYTES // 4):
                open_.add(part)
                if open_.size >= SEGMENT_BYTES:
                    yield closed()
                    seg, open_ = seg + 1, _Segment()
        if open_.ids:
            yield closed()

    return run


def _vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per segment and distinct training word: hash and training count."""
    for batch in batches:
        for hashes, train in zip(*(batch.column(c).to_pylist() for c in ("hashes", "train")), strict=True):
            n = _unpack(train)
            h, n = np.frombuffer(hashes, np.int64)[n > 0], n[n > 0]
            for a in range(0, len(h), 50_000):
                b = min(len(h), a + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(h[a:b]), pa.array(n[a:b])], ["word", "n"])


@dataclass(frozen=True)
class Common:
    """Hashes of the words of the highest training counts, ascending, and these counts."""

    hashes: np.ndarray
    counts: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Training counts of some words; 0 for those that are not common."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.counts[at], 0)


def _rare(shared):
    """One row per text and distinct word that is not common: hash, segment, place of the text in it, occurrences."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes = np.frombuffer(row["hashes"], np.int64)
            words, n_words = _unpack(row["words"]), _unpack(row["n_words"])
            rare = (shared.value.of(hashes) == 0)[words]
            text = np.repeat(np.arange(len(n_words)), n_words)[rare]
            pairs, n = np.unique(words[rare] * len(n_words) + text, return_counts=True)
            word, text = np.divmod(pairs, max(1, len(n_words)))
            for a in range(0, len(pairs), 50_000):
                b = min(len(pairs), a + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[word[a:b]]),
                        pa.array(np.full(b - a, row["seg"])),
                        pa.array(text[a:b].astype(np.int32)),
                        pa.array(n[a:b]),
                    ],
                    ["word", "seg", "at", "n"],
                )

    return run


@dataclass(frozen=True)
class Classes:
    """Class of each subword id (0 is the end of a text) and its log probability within it."""

    of: np.ndarray
    within: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Classes:
        order = np.argsort(-counts, kind="stable")
        of = np.empty(len(counts), dtype=np.int32)
        of[order[:FREQUENT]] = np.arange(1, FREQUENT + 1)
        rest = order[FREQUENT:]
        weight = np.cumsum(counts[rest] + 0.5)
        bands = CLASSES - FREQUENT - 1
        of[rest] = FREQUENT + 1 + np.minimum(bands - 1, (weight * bands / weight[-1]).astype(np.int64))
        total = np.bincount(of, counts + 0.5, CLASSES)
        return cls(of, np.log((counts + 0.5) / total[of]).astype(np.float32))


def _streams(row: dict, classes: Classes, training: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all ids of a segment's texts (or training texts), each text closed by 0; their log weight within; text starts."""
    words, n_words, sub, lengths = (_unpack(row[c]) for c in ("words", "n_words", "sub", "sub_lengths"))
    if training:
        own = ~np.array(row["held"], dtype=bool)
        words, n_words = words[np.repeat(own, n_words)], n_words[own]
    # The end of a text is one more word, of the id 0 alone.
    of, within = np.append(classes.of[sub], np.int32(0)), np.append(classes.within[sub], np.float32(0))
    lengths = np.append(lengths, 1)
    after = np.cumsum(n_words)
    words = np.insert(words, after, len(lengths) - 1)
    own = lengths[words]
    ends = np.cumsum(own)
    begins = np.cumsum(lengths) - lengths
    at = np.repeat(begins[words] - (ends - own), own)
    at += np.arange(len(at))
    return of[at], within[at], np.concatenate([[0], ends[after + np.arange(len(after))]])


class _Scratch:
    """Arrays that are written anew at every step, by name: a task asks the system for their memory once."""

    def __init__(self):
        self.kept = {}

    def __call__(self, name: str, kind: np.dtype, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if size > self.kept.get((name, kind), np.empty(0)).size:
            self.kept[name, kind] = np.empty(size, kind)
        return self.kept[name, kind][:size].reshape(shape) if size else np.empty(shape, kind)


_scratch = _Scratch()


@dataclass
class Model:
    """Attention weights, and the bigram tables of groups and of members within groups."""

    weights: dict[str, np.ndarray]
    groups: np.ndarray  # class before x group
    members: np.ndarray  # class before x group x member

    @classmethod
    def initial(cls, groups: np.ndarray, members: np.ndarray) -> Model:
        rng = np.random.default_rng(7)
        shapes = {"e": (CLASSES, WIDTH), "p": (WINDOW, WIDTH)} | {n: (WIDTH, WIDTH) for n in "qkv"}
        weights = {n: (rng.standard_normal(s) * 0.3).astype(np.float32) for n, s in shapes.items()}
        # The outputs start at zero, so that training starts from the bigram tables.
        weights["g"] = np.zeros((WIDTH, GROUPS), np.float32)
        weights["m"] = np.zeros((GROUPS, WIDTH, MEMBERS), np.float32)
        return cls(weights, groups, members)

    @classmethod
    def of_pairs(cls, table: np.ndarray) -> Model:
        """From counts of (class before, class), smoothed towards the classes' shares."""
        share = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * CLASSES)
        smooth = ((table + PULL * share) / (table.sum(axis=1, keepdims=True) + PULL)).reshape(CLASSES, GROUPS, MEMBERS)
        groups = smooth.sum(axis=2)
        return cls.initial(
            np.log(groups).astype(np.float32), np.log(smooth / groups[:, :, None]).astype(np.float32)
        )

    def flat(self) -> np.ndarray:
        """All weights in one array, by name."""
        return np.concatenate([self.weights[n].ravel() for n in sorted(self.weights)]).astype(np.float64)

    def with_weights(self, flat: np.ndarray) -> Model:
        sizes = np.cumsum([self.weights[n].size for n in sorted(self.weights)])
        parts = np.split(flat.astype(np.float32, copy=False), sizes[:-1])
        shaped = {n: p.reshape(self.weights[n].shape) for n, p in zip(sorted(self.weights), parts, strict=True)}
        return Model(shaped, self.groups, self.members)

    def attend(self, before: np.ndarray, first: int = 0) -> tuple:
        """Attention over windows: ``before`` (windows x places) holds the preceding classes.

        Places past a text's end come last in its window, where the causal mask
        keeps them from every place before. Only places from ``first`` on look
        back. Queries, keys and values are products of the inputs x, so weights are
        multiplied first: the logits are (x q k') x', what a place gathers is (a x) v.
        """
        w = self.weights
        kind, shape = w["e"].dtype, (len(before), before.shape[1] - first, WIDTH)
        x = np.take(w["e"], before, axis=0, out=_scratch("x", kind, *before.shape, WIDTH), mode="clip")
        x += w["p"]
        r = _product(x, w["q"] @ w["k"].T * kind.type(WIDTH**-0.5), _scratch("r", kind, *x.shape))
        a = _scratch("a", kind, *shape[:2], before.shape[1])
        _exp(np.matmul(r[:, first:], x.transpose(0, 2, 1), out=a))
        a *= _CAUSAL[first:]
        a *= _parts(a)
        u = np.matmul(a, x, out=_scratch("u", kind, *shape))
        h = _product(u, w["v"], _scratch("h", kind, *shape))
        h += x[:, first:]
        return x, r, a, u, h

    def step(self, before: np.ndarray, target: np.ndarray, valid: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over one batch of windows.

        Places that are not ``valid`` come last in their window and add nothing.
        """
        w = self.weights
        kind, scale = w["e"].dtype, w["e"].dtype.type(WIDTH**-0.5)
        x, r, a, u, h = self.attend(before)
        y = target.ravel()
        places = np.arange(y.size) if valid is None else np.flatnonzero(valid)
        # Rows of one group stand side by side.
        places = places[_order(y[places] // MEMBERS)]
        n = len(places)
        flat = np.take(h.reshape(-1, WIDTH), places, axis=0, out=_scratch("flat", kind, n, WIDTH), mode="clip")
        prev, chosen, row = before.ravel()[places], y[places], np.arange(n)
        group = chosen // MEMBERS
        runs = _runs(group)
        z = self.outer(flat, prev)
        z *= _parts(z)
        z.reshape(-1)[row * GROUPS + group] -= 1
        back = np.matmul(z, w["g"].T, out=_scratch("back", kind, n, WIDTH))
        grads = {"g": flat.T @ z, "m": np.zeros_like(w["m"])}
        z = self.inner(flat, prev, group, runs)
        z *= _parts(z)
        z.reshape(-1)[row * MEMBERS + chosen - group * MEMBERS] -= 1
        inner = _scratch("inner", kind, n, WIDTH)
        for g, at in runs:
            np.dot(flat[at].T, z[at], out=grads["m"][g])
            np.dot(z[at], w["m"][g].T, out=inner[at])
        back += inner
        dh = _scratch("dh", kind, *x.shape)
        if n < y.size:
            dh[...] = 0
        dh.reshape(-1, WIDTH)[places] = back
        du = _product(dh, w["v"].T, _scratch("du", kind, *x.shape))
        ds = np.matmul(du, x.transpose(0, 2, 1), out=_scratch("ds", kind, *a.shape))
        ds -= np.einsum("bij,bij->bi", du, u)[:, :, None]
        ds *= a
        dr = np.matmul(ds, x, out=_scratch("dr", kind, *x.shape))
        product = _flat(x).T @ _flat(dr) * scale
        grads |= {"q": product @ w["k"], "k": product.T @ w["q"], "v": _flat(u).T @ _flat(dh)}
        # An input is met as what is added, as a query, as a key and as a value.
        dh += np.matmul(a.transpose(0, 2, 1), du, out=u)
        dh += np.matmul(ds.transpose(0, 2, 1), r, out=u)
        dh += _product(dr, w["k"] @ w["q"].T * scale, u)
        grads["p"] = (np.ones(len(dh), kind) @ dh.reshape(len(dh), -1)).reshape(w["p"].shape)
        places = np.take(_PLACES, before, axis=0)
        grads["e"] = np.bincount(places.ravel(), dh.ravel(), w["e"].size).reshape(w["e"].shape)
        # All gradients so far are of the sum over the rows.
        return {name: g / n for name, g in grads.items()}

    def outer(self, flat: np.ndarray, prev: np.ndarray) -> np.ndarray:
        """Weights of the groups, not yet divided by their sum."""
        z = np.matmul(flat, self.weights["g"], out=_scratch("z", flat.dtype, len(flat), GROUPS))
        z += np.take(self.groups, prev, axis=0, out=_scratch("rows", self.groups.dtype, *z.shape), mode="clip")
        return _exp(z)

    def inner(self, flat: np.ndarray, prev: np.ndarray, group: np.ndarray, runs: list[tuple[int, slice]]) -> np.ndarray:
        """Weights of the members of each row's group, not yet divided by their sum; rows of one group stand side by side."""
        z = _scratch("z", flat.dtype, len(flat), MEMBERS)
        for g, at in runs:
            np.dot(flat[at], self.weights["m"][g], out=z[at])
        rows, members = prev.astype(np.int64) * GROUPS + group, self.members.reshape(-1, MEMBERS)
        z += np.take(members, rows, axis=0, out=_scratch("rows", members.dtype, *z.shape), mode="clip")
        return _exp(z)

    def score(self, stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probability of each id's class, given the ids before it in its text."""
        stride = WINDOW - CONTEXT
        sizes = np.diff(starts)
        # The first window of a text scores all its places, later ones all but the context.
        windows = 1 + np.maximum(0, -(-(sizes - WINDOW) // stride))
        text = np.repeat(np.arange(len(sizes)), windows)
        number = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin, end = starts[text] + number * stride, starts[text + 1]
        before = np.concatenate([[0], stream[:-1]])
        before[starts[:-1]] = 0
        out = np.empty(len(stream), dtype=np.float32)
        for first, of_kind in ((0, np.flatnonzero(number == 0)), (CONTEXT, np.flatnonzero(number))):
            for a in range(0, len(of_kind), 256):
                own = of_kind[a : a + 256]
                at = begin[own, None] + np.arange(WINDOW)
                valid = at < end[own, None]
                at = np.where(valid, at, 0)
                hidden = self.attend(before[at], first)[-1].reshape(-1, WIDTH)
                places = np.flatnonzero(valid[:, first:])
                at = at[:, first:].ravel()[places]
                order = _order(stream[at] // MEMBERS)
                at = at[order]
                prev, chosen, hidden = before[at], stream[at], hidden[places[order]]
                group, row = chosen // MEMBERS, np.arange(len(at))
                z = self.outer(hidden, prev)
                p = z[row, group] * _parts(z)[:, 0]
                z = self.inner(hidden, prev, group, _runs(group))
                out[at] = np.log(p) + np.log(z[row, chosen - group * MEMBERS] * _parts(z)[:, 0])
        return out


_PLACES = np.arange(CLASSES * WIDTH).reshape(CLASSES, WIDTH)


def _flat(rows: np.ndarray) -> np.ndarray:
    return rows.reshape(-1, rows.shape[-1])


def _product(rows: np.ndarray, weights: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Rows of all windows times weights, in one product."""
    np.matmul(_flat(rows), weights, out=_flat(out))
    return out


def _parts(z: np.ndarray) -> np.ndarray:
    """What one unit of each row is of the row's sum."""
    sums = _flat(z) @ np.ones(z.shape[-1], z.dtype)
    return (1 / sums).reshape(*z.shape[:-1], 1)


def _exp(z: np.ndarray) -> np.ndarray:
    """Weights of a softmax. Logits count up to ``LIMIT`` either way, so neither a weight nor a sum can overflow or vanish."""
    np.clip(z, -LIMIT, LIMIT, out=z)
    return np.exp(z, out=z)


def _log_of(z: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log softmax of the chosen column of each row."""
    _exp(z)
    return np.log(z[np.arange(len(z)), chosen] / z.sum(axis=1))


def _order(values: np.ndarray) -> np.ndarray:
    """Places by value (of a class or group), equal ones as they stand; 16 bits are sorted by radix."""
    return np.argsort(values.astype(np.uint16), kind="stable")


def _runs(values: np.ndarray) -> list[tuple[int, slice]]:
    """Each distinct value of a sorted array and where it stands."""
    cuts = np.flatnonzero(np.diff(values, prepend=-1, append=-1)).tolist() if len(values) else [0]
    return [(int(values[a]), slice(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_CAUSAL = np.tri(WINDOW, dtype=np.float32)


def _bigrams(classes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for row in _rows(batches):
            stream, starts = _training(row, classes.value)
            if len(stream):
                before = np.concatenate([[0], stream[:-1]]).astype(np.int64)
                counts += np.bincount(before * CLASSES + stream, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["pair", "n"])

    return run


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
        del batch
        pa.default_memory_pool().release_unused()


def _training(row: dict, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """The stream of a segment's training texts, each closed by 0, and where they start."""
    stream, _, starts = _streams(row, classes, training=True)
    return stream, starts


class _Training:
    """Weights on their way, by Adam."""

    def __init__(self, initial: Model):
        self.flat = initial.flat().astype(np.float32)
        # The model's weights are views of the flat ones.
        self.model = initial.with_weights(self.flat)
        self.first, self.second = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.steps = self.windows = 0

    def segment(self, stream: np.ndarray, starts: np.ndarray) -> None:
        """One pass over all windows of some texts; no window reaches into another text."""
        windows = -(-np.diff(starts) // WINDOW)
        text = np.repeat(np.arange(len(windows)), windows)
        number = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin, end = starts[text] + number * WINDOW, starts[text + 1]
        # The id before a text's first one is the end of the text before.
        before = np.concatenate([[0], stream[:-1]])
        # Not in the order of the text, so that a batch holds many texts.
        chosen = np.random.default_rng(11).permutation(len(text))
        for a in range(0, len(chosen), BATCH):
            own = chosen[a : a + BATCH]
            at = begin[own, None] + np.arange(WINDOW)
            valid = at < end[own, None]
            at = np.where(valid, at, 0)
            self.update(self.model.step(before[at], stream[at], valid))
            self.windows += len(own)

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.steps += 1
        rate = RATE * (1 - 0.99**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        g = np.concatenate([grads[n].ravel() for n in sorted(grads)], dtype=np.float32, casting="same_kind")
        change = _scratch("change", g.dtype, len(g))
        np.subtract(g, self.first, out=change)
        change *= np.float32(0.1)
        self.first += change
        g *= g
        g -= self.second
        g *= np.float32(0.01)
        self.second += g
        np.sqrt(self.second, out=g)
        g += np.float32(1e-8)
        np.divide(self.first, g, out=change)
        change *= np.float32(rate)
        self.flat -= change


def _train(shared):
    """One pass: the sum over a task's segments of their weights times windows, and the number of windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, initial = shared.value
        total, windows = 0, 0
        for row in _rows(batches):
            own = _Training(initial)
            own.segment(*_training(row, classes))
            total = total + own.windows * own.model.flat()
            windows += own.windows
        if windows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), windows))],
                ["place", "weight", "windows"],
            )

    return run


def learn(segments: DataFrame) -> tuple[Classes, Model]:
    """Classes, bigram table and attention weights from the training texts of ``segments``.

    What reaches the driver has a fixed size: one number per subword id, per
    pair of classes and per weight.
    """
    context = segments.sparkSession.sparkContext
    counted = segments.select(F.explode(F.arrays_zip("sub_ids", "sub_counts")).alias("s"))
    counted = counted.groupBy("s.sub_ids").agg(F.sum("s.sub_counts").alias("n")).toPandas()
    counts = np.zeros(1 << 16)
    counts[counted["sub_ids"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    classes = Classes.from_counts(counts)
    streams = segments.select("held", "n_words", "words", "sub", "sub_lengths")
    pairs = streams.mapInArrow(_bigrams(context.broadcast(classes)), "pair int, n bigint")
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(CLASSES * CLASSES)
    table[pairs["pair"].to_numpy(np.int64)] = pairs["n"].to_numpy(np.float64)
    model = Model.of_pairs(table.reshape(CLASSES, CLASSES))
    for _ in range(PASSES):
        shared = context.broadcast((classes, model))
        trained = streams.mapInArrow(_train(shared), "place int, weight double, windows bigint")
        share = F.sum("weight") / F.sum("windows")
        averaged = trained.groupBy("place").agg(share.alias("weight")).orderBy("place").toPandas()
        shared.unpersist()
        if len(averaged):
            model = model.with_weights(averaged["weight"].to_numpy())
    return classes, model


def _score(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, model, common, ends, total, distinct = shared.value
        scale = np.log10(total + SMOOTH * (distinct + 1)) if total else np.log10(SMOOTH)
        for row in _rows(batches):
            stream, within, starts = _streams(row, classes)
            text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            logs = model.score(stream, starts).astype(np.float64) + within
            score = np.bincount(text, logs, len(starts) - 1) / np.log(10)
            words, n_words = _unpack(row["words"]), _unpack(row["n_words"])
            known = common.of(np.frombuffer(row["hashes"], np.int64))
            of_word = np.repeat(np.arange(len(n_words)), n_words)
            base = np.bincount(of_word, np.log10(known + SMOOTH)[words], len(n_words)) + np.log10(ends + SMOOTH)
            n = n_words + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), row["seg"])),
                    pa.array(np.arange(len(n), dtype=np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["held"], pa.bool_()),
                    pa.array(n),
                    pa.array(np.bincount(of_word, known[words] > 0, len(n_words)).astype(np.int64) + int(ends > 0)),
                    pa.array(np.full(len(n), total, dtype=np.int64)),
                    pa.array(base - n * scale),
                    pa.array(score),
                ],
                ["seg", "at", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, held: Column, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held`` tells which rows are held out of training (null: held out);
    ``path`` is a file of byte-level BPE ranks that every worker can read. Null
    and blank texts are one end token. Rows with null or repeated ids are
    scored each. Without training texts all counts are 0 and the model is
    uniform over classes. An empty table gives an empty result.

    Word counts cover all training texts: a segment's distinct words are
    counted before they are shuffled. The highest counts, ``COMMON`` at most,
    go to all workers. Every other word is joined with its count by word, once
    per text that has it, and what it adds returns to the text as a sum, so
    neither texts nor words that are in most segments are shuffled again.
    """
    work = Workspace(docs.sparkSession, "lm-scoring")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(held, F.lit(True)).alias("held"),
        F.col("text").cast("string").alias("text"),
    )
    ends, size = rows.agg(F.count_if(~F.col("held")), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, math.ceil((size / PART_BYTES) ** PART_POWER))
    dealt = rows.repartition(parts, "doc_id", "text").sortWithinPartitions("doc_id", "text", "held")
    segments = work.write(dealt.mapInArrow(_segments(path), SEGMENTS), "segments", compression="zstd")
    found = segments.select("hashes", "train").mapInArrow(_vocabulary, "word bigint, n bigint")
    counts = found.groupBy("word").agg(F.sum("n").alias("c"))
    counts = work.write(counts, "counts")
    by_length = counts.groupBy(F.length(F.bin("c")).alias("bits")).agg(F.count("*").alias("n"), F.sum("c").alias("c"))
    by_length = by_length.orderBy(F.desc("bits")).collect()
    distinct, total = sum(r["n"] for r in by_length), sum(r["c"] for r in by_length)
    least, above = 1 << 62, 0
    for r in by_length:
        above += r["n"]
        if above > COMMON:
            break
        least = 1 << (r["bits"] - 1)
    listed = counts.filter(F.col("c") >= least).orderBy("word").toPandas()
    common = Common(listed["word"].to_numpy(np.int64), listed["c"].to_numpy(np.int64))
    context = docs.sparkSession.sparkContext
    rare = segments.select("seg", "n_words", "words", "hashes").mapInArrow(
        _rare(context.broadcast(common)), "word bigint, seg bigint, at int, n bigint"
    )
    more = F.round((F.log10(F.col("c") + SMOOTH) - math.log10(SMOOTH)) / UNIT).cast("bigint")
    rare = rare.join(counts.filter(F.col("c") < least), "word").groupBy("seg", "at")
    rare = work.write(rare.agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * more).alias("more")), "rare")
    classes, model = learn(segments)
    shared = context.broadcast((classes, model, common, ends, total + ends, distinct + int(ends > 0)))
    scored = segments.select("seg", "doc_ids", "held", "n_words", "words", "hashes", "sub", "sub_lengths").mapInArrow(
        _score(shared),
        "seg bigint, at int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double",
    )
    scored = scored.join(rare, ["seg", "at"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        "train_tokens",
        (F.col("base_score") + F.coalesce("more", F.lit(0)) * UNIT).alias("base_score"),
        "score",
    )
    result = work.write(scored, "result")
    work.keep("result")
    return result
