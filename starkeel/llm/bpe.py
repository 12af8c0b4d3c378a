"""BPE encoding with a priority queue over a linked symbol list, and decoding.

Reads a byte-level BPE vocabulary in the JSON form of the tokenizers library
and gives the ids that library gives. A text is split at the added tokens,
then into pre-tokens, then each pre-token's bytes are merged: all neighbouring
pairs wait in a heap by (merge rank, position); the least is taken, entries
whose symbols have changed since are skipped, and the pairs next to a merged
symbol join the heap. Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T

# Fixed value: the pre-token pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pre-tokens that each of a worker's two memories holds: the newer one, and the one
# it replaced when full. Longer pre-tokens are merged each time they occur.
REMEMBERED = 300_000
REMEMBERED_CHARS = 48


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Bpe:
    """One vocabulary, as a worker keeps it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        supported = (
            spec["model"]["type"] == "BPE"
            and pre["type"] == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None
            and not spec["model"].get("ignore_merges")
        )
        if not supported:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        vocab = spec["model"]["vocab"]
        letter = byte_letters()
        self.of_byte = [vocab[letter[b]] for b in range(256)]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.pair_of = [vocab[a] << 32 | vocab[b] for a, b in pairs]
        self.joined_of = [vocab[a + b] for a, b in pairs]
        self.rank_of = {pair: rank for rank, pair in enumerate(self.pair_of)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.split = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.pretokens = regex.compile(PRETOKEN).findall
        of_letter = {c: b for b, c in letter.items()}
        strings = {i: bytes(of_letter[c] for c in s) for s, i in vocab.items()}
        strings |= {i: s.encode() for s, i in self.added.items()}
        size = max(strings) + 1
        self.lengths = np.array([len(strings.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(strings.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        symbol = [self.of_byte[b] for b in data]
        n = len(symbol)
        if n == 1:
            return symbol
        rank_of, pair_of, joined_of = self.rank_of.get, self.pair_of, self.joined_of
        before = list(range(-1, n - 1))
        after = list(range(1, n + 1))
        # A rank names its pair, so an entry is one number: the rank, then the position.
        heap = []
        left = symbol[0]
        for i in range(n - 1):
            right = symbol[i + 1]
            rank = rank_of(left << 32 | right)
            if rank is not None:
                heap.append(rank << 32 | i)
            left = right
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbol[i] << 32 | symbol[j] != pair_of[rank]:
                continue  # stale: one of the two has been merged since
            joined = symbol[i] = joined_of[rank]
            symbol[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(joined << 32 | symbol[k])
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbol[h] << 32 | joined)
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | h)
        return [s for s in symbol if s >= 0]

    def _packed(self, pretoken: str) -> bytes:
        """From the older half of the memory, or merged; either way remembered anew."""
        packed = self.older.get(pretoken)
        if packed is None:
            ids = self.merge(pretoken.encode("utf-8", "surrogatepass"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(pretoken) <= REMEMBERED_CHARS:
            if len(self.newer) >= REMEMBERED:
                self.older, self.newer = self.newer, {}
            self.newer[pretoken] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        packed = self._packed
        parts = self.split.split(text) if self.split else [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(self.added[part].to_bytes(4, "little"))
            elif part:
                newer = self.newer.get
                out += [newer(p) or packed(p) for p in self.pretokens(part)]
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)
        return self.flat[places].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every whole text.

    Returns ``id_col``, ``n_tokens`` long, ``ids`` binary (little-endian
    unsigned 32-bit) and ``decoded`` string, one row per input row. ``path`` is
    read on each worker. A null text counts as empty: no ids, empty decoded
    text. Rows with a null or repeated id are encoded like any other; other
    columns are not read. Nothing is shuffled; a worker holds one slice of a
    batch, and its memory of pre-tokens is bounded.
    """
    id_type = docs.schema[id_col].dataType
    schema = f"id {id_type.simpleString()}, n_tokens bigint, ids binary, decoded string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in T.slices(batch, "text"):
                ids = [bpe.encode(t) for t in T.strings(part, "text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([bpe.decode(x) for x in ids], pa.string()),
                    ],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
