"""Words and lines of texts as Arrow arrays, told apart exactly.

Unlike the hashed words of :mod:`.texts`, words keep their case and get dense
numbers from Arrow's dictionary encoding, so equal numbers mean equal words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Parts(NamedTuple):
    """Parts of many texts: values one after the other, and where each text's begin."""

    values: pa.Array
    codes: np.ndarray
    firsts: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The number of the text each part belongs to."""
        return np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))


def _parts(lists: pa.Array, wanted: np.ndarray | None = None) -> Parts:
    values = lists.flatten()
    firsts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    if wanted is not None:
        before = np.concatenate([[0], np.cumsum(wanted)])
        values, firsts = values.filter(pa.array(wanted)), before[firsts]
    codes = values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Parts(values, codes, firsts)


def _texts(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "").cast(pa.large_string())


def words(column: pa.Array) -> Parts:
    """Longest runs of characters other than space and 0x09-0x0D; null has none."""
    lists = pc.ascii_split_whitespace(_texts(column))
    return _parts(lists, pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False) > 0)


def lines(column: pa.Array) -> Parts:
    """Pieces between line feeds; a null or empty text is one empty line."""
    return _parts(pc.split_pattern(_texts(column), "\n"))


def joined(values: pa.Array, firsts: np.ndarray) -> pa.Array:
    """Per text its parts with one space between."""
    lists = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), values)
    return pc.binary_join(lists, pa.scalar(" ", values.type)).cast(pa.string())
