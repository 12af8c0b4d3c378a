"""Chat formatting: conversations assembled as bytes, column by column.

A turn is written ``<s>role\\ntext</s>`` if it is trained on and
``[INST]role\\ntext[/INST]`` otherwise. In texts and roles the four control
strings are broken by a backslash after their first character, and every such
string that is broken already gets one more, so reading back is exact.

For a slice of turns the lengths of all headers, roles, texts and footers are
computed at once, their running sum gives each segment's place, and each kind
of segment is scattered into one preallocated buffer by an index array.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T

TRAINED = "assistant"
# Header and footer of turns without and with loss.
HEADERS = (b"[INST]", b"<s>")
FOOTERS = (b"[/INST]", b"</s>")
CONTROL = r"([\[<])(\\*)(/?INST\]|/?s>)"
BROKEN = r"([\[<])(\\*)\\(/?INST\]|/?s>)"

_broken = re.compile(BROKEN.encode())
_turn = re.compile(rb"(?:\[INST\]|<s>)(.*?)\n(.*?)(?:\[/INST\]|</s>)", re.DOTALL)

BLOCKS = "conv_id {kind}, block bigint, n_turns bigint, text binary, loss_starts array<bigint>, loss_ends array<bigint>"


def _segments(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the length of each value."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, np.diff(offsets)


def _scatter(out: np.ndarray, flat: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> None:
    """Copy the values that lie one after the other in ``flat`` to their places."""
    if len(flat):
        sources = np.cumsum(lengths) - lengths
        out[np.repeat(places - sources, lengths) + np.arange(len(flat))] = flat


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns, where each turn begins (and the end), and each text's begin and end."""
    roles, texts = pc.fill_null(roles, ""), pc.fill_null(texts, "")
    trained = pc.equal(roles, TRAINED).to_numpy(zero_copy_only=False).astype(np.int64)
    roles = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    escape = [pc.replace_substring_regex(c, CONTROL, r"\1\2\\\3") for c in (roles, texts)]
    role_bytes, role_lengths = _segments(escape[0])
    text_bytes, text_lengths = _segments(escape[1])
    heads = np.array([len(h) for h in HEADERS])[trained]
    feet = np.array([len(f) for f in FOOTERS])[trained]
    turns = heads + role_lengths + 1 + text_lengths + feet
    begins = np.concatenate([[0], np.cumsum(turns)])
    out = np.empty(int(begins[-1]), dtype=np.uint8)
    role_at = begins[:-1] + heads
    text_at = role_at + role_lengths + 1
    foot_at = text_at + text_lengths
    for kind in (0, 1):
        own = np.flatnonzero(trained == kind)
        for fixed, at in ((HEADERS[kind], begins[:-1]), (FOOTERS[kind], foot_at)):
            out[at[own][:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    out[text_at - 1] = 10
    _scatter(out, role_bytes, role_lengths, role_at)
    _scatter(out, text_bytes, text_lengths, text_at)
    return out, begins, np.where(trained, text_at, -1), foot_at


def _format(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive turns of one conversation, from rows sorted by conversation and turn."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in T.slices(batch, "text"):
            out, begins, loss, ends = assemble(part.column("role"), part.column("text"))
            conv = part.column("conv_id").to_pylist()
            cuts = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = np.arange(a, b)[loss[a:b] >= 0]
                rows.append(
                    (
                        conv[a],
                        block,
                        b - a,
                        out[begins[a] : begins[b]].tobytes(),
                        (loss[own] - begins[a]).tolist(),
                        (ends[own] - begins[a]).tolist(),
                    )
                )
                block += 1
            kinds = [part.column("conv_id").type, *_KINDS]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                ["conv_id", "block", "n_turns", "text", "loss_starts", "loss_ends"],
            )


_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted conversations in blocks: conv_id, block, n_turns, text (UTF-8), loss_starts, loss_ends.

    ``turns`` has conv_id, turn, role and text; other columns are not read. The
    turns of a conversation follow each other by turn, then role, then text
    (null first); its blocks in the order of ``block`` make up its text. Loss
    spans are byte places within a block, one per trained text. Null role and
    text are empty; rows with a null conv_id form one conversation. Repeated
    rows are repeated turns. No rows, no blocks.

    Turns are dealt by range of (conv_id, turn), so a conversation that holds
    a third of all rows is split over as many tasks as its share asks for; a
    block never holds more than a slice of a batch.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select(
        "conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    return (
        rows.withColumn("__salt", F.xxhash64("role", "text"))
        .repartitionByRange("conv_id", "turn", "role", "__salt")
        .drop("__salt")
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
        .mapInArrow(_format, BLOCKS.format(kind=kind))
    )


def read_back(text: bytes) -> list[tuple[bytes, bytes]]:
    """Roles and texts of a formatted text."""
    found = []
    for role, content in _turn.findall(text):
        role = _broken.sub(rb"\1\2\3", role)
        role = re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], role)
        found.append((role, _broken.sub(rb"\1\2\3", content)))
    return found


def _chars(data: bytes) -> int:
    return len(data.decode("utf-8"))


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block what its digests are made of, all read from the formatted text."""
    for batch in batches:
        rows = []
        for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "loss_starts", "loss_ends")), strict=True):
            turns = read_back(text)
            loss = b"".join(_broken.sub(rb"\1\2\3", text[a:b]) for a, b in zip(starts, ends, strict=True))
            said = b"".join(b"%s\n%s\n" % t for t in turns)
            rows.append((len(turns), said, loss, _chars(loss), _chars(text)))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
            ["conv_id", "block", "n_turns", "said", "loss", "loss_chars", "chars"],
        )


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its blocks in order; holds two hash states."""
    nothing = object()
    now, kind, done = nothing, None, []

    def row():
        return (now, n, said.hexdigest(), loss_chars, loss.hexdigest(), chars)

    def out(rows):
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        kind = batch.column("conv_id").type
        for i, conv in enumerate(batch.column("conv_id").to_pylist()):
            if now is nothing or conv != now:
                if now is not nothing:
                    done.append(row())
                now, n, said, loss_chars, loss, chars = conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            n += batch.column("n_turns")[i].as_py()
            said.update(batch.column("said")[i].as_buffer())
            loss.update(batch.column("loss")[i].as_buffer())
            loss_chars += batch.column("loss_chars")[i].as_py()
            chars += batch.column("chars")[i].as_py()
        if done:
            yield out(done)
            done = []
    if now is not nothing:
        yield out([row()])


def digests(blocks: DataFrame) -> DataFrame:
    """Per conversation what reading its formatted text back gives, as counts and SHA-256.

    Blocks are parsed where they lie. A SHA-256 can only be computed in order,
    so a conversation's blocks then pass through one task, as a stream of
    which a batch is in memory at a time.
    """
    kind = blocks.schema["conv_id"].dataType.simpleString()
    parsed = blocks.mapInArrow(
        _parse, f"conv_id {kind}, block bigint, n_turns bigint, said binary, loss binary, loss_chars bigint, chars bigint"
    )
    return (
        parsed.repartition("conv_id")
        .sortWithinPartitions("conv_id", "block")
        .mapInArrow(
            _digest,
            f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        )
    )
