"""Which directories count: one small list for each run, written last.

    <zone>/_commits/0000000042          the list, one line for each part
    <zone>/<table>/write=<token>/...    rows, never changed once written

A run writes new directories beside those that count and touches none of them.
Then it writes the next list, naming for every table the directories that hold
its rows from now on; the list appears whole or not at all, and only if no other
run has written that number. Readers start from the last list, so they see all
tables of a run or none, whatever has crashed. Directories are removed by
:func:`sweep` once only older lists name them.

A list has one line per run date, fact day and summary date: its size is bounded
by calendar days, not by rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from . import files

_LISTS = "_commits"
_WRITE = "write="


class CommitConflict(RuntimeError):
    """Another run has committed since this one began."""


@dataclass(frozen=True, order=True)
class Part:
    """Rows of a table that come and go together.

    ``kind`` and ``label`` say which, ``path`` where, below the zone (empty: no
    rows); ``values`` are what the directory holds of the next level, or the
    limits of what it holds.
    """

    table: str
    kind: str
    label: str
    path: str = ""
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class State:
    """The parts that count, as of one commit or of a run still being written."""

    root: str
    number: int = 0
    parts: tuple[Part, ...] = ()

    def of(self, table: str, *kinds: str) -> list[Part]:
        """Parts of a table, by kind and label."""
        return [p for p in self.parts if p.table == table and (not kinds or p.kind in kinds)]

    def replacing(self, table: str, kind: str, labels: Iterable[str], parts: Iterable[Part] = ()) -> State:
        """The state with other ``parts`` in place of those of the ``labels``."""
        gone = set(labels)
        kept = [p for p in self.parts if not (p.table == table and p.kind == kind and p.label in gone)]
        return replace(self, parts=tuple(sorted([*kept, *parts])))

    def at(self, part: Part) -> str:
        return files.join(self.root, part.path)

    def new(self, table: str) -> str:
        """A directory for new rows of a table, below the zone."""
        return files.join(table, _WRITE + uuid.uuid4().hex)


def _list_path(root: str, number: int) -> str:
    return files.join(root, _LISTS, f"{number:010d}")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in files.children(spark, files.join(root, _LISTS)) if n.isdigit())


def exists(spark: SparkSession, root: str, number: int) -> bool:
    return files.exists(spark, _list_path(root, number))


def read(spark: SparkSession, root: str, number: int) -> State:
    lines = files.read_text(spark, _list_path(root, number)).splitlines()
    parts = [(*row[:4], tuple(row[4])) for row in map(json.loads, lines)]
    return State(root, number, tuple(sorted(Part(*p) for p in parts)))


def latest(spark: SparkSession, root: str) -> State:
    """The last commit of a zone; without one, a state with nothing in it.

    One listing and one small file, whatever the history. A store that cannot be
    reached raises: taking that for "no history" would restart the zone.
    """
    numbers = _numbers(spark, root)
    return read(spark, root, numbers[-1]) if numbers else State(root)


def commit(spark: SparkSession, before: State, after: State) -> State:
    """Let ``after`` count, if ``before`` is still the last commit."""
    if after.parts == before.parts:
        return before
    lines = [json.dumps([p.table, p.kind, p.label, p.path, p.values], separators=(",", ":")) for p in after.parts]
    number = before.number + 1
    if not files.create_text(spark, _list_path(before.root, number), "\n".join(lines) + "\n"):
        raise CommitConflict(f"commit {number} of {before.root} was written by another run; repeat this one")
    return replace(after, number=number)


def _writes(parts: Iterable[Part]) -> set[str]:
    """The directories single writes have made."""
    return {"/".join(p.path.split("/")[: _depth(p.path)]) for p in parts if p.path}


def _depth(path: str) -> int:
    return next(n for n, name in enumerate(path.split("/"), 1) if name.startswith(_WRITE))


def discard(spark: SparkSession, before: State, after: State) -> None:
    """Remove what a run wrote that will not be committed."""
    for path in _writes(after.parts) - _writes(before.parts):
        files.delete(spark, files.join(before.root, path))


def sweep(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` lists, and the parts that only those name.

    A reader that began with the list before the last can still finish. Lists go
    last, so a sweep that was cut short is completed by the next.
    """
    if keep < 1:
        raise ValueError("at least the last commit must be kept")
    numbers = _numbers(spark, root)
    kept = [p for n in numbers[-keep:] for p in read(spark, root, n).parts]
    paths, writes = {p.path for p in kept}, _writes(kept)
    for number in numbers[:-keep]:
        old = read(spark, root, number).parts
        for path in _writes(old) - writes:
            files.delete(spark, files.join(root, path))
        for part in old:
            if part.path and part.path not in paths and _writes([part]) <= writes:
                files.delete(spark, files.join(root, part.path))
        files.delete(spark, _list_path(root, number))
