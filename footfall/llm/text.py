"""Words of Arrow text columns as arrays of byte positions, for use inside tasks.

A text is handled as UTF-8 bytes. All separators are ASCII, so a word never cuts a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Bytes of text handled at once. A longer text is handled alone, and always whole.
CHUNK_BYTES = 1 << 21


def table(separators: list[range]) -> np.ndarray:
    out = np.zeros(256, bool)
    for r in separators:
        out[list(r)] = True
    return out


# --- fixed values: the bytes that separate words --------------------------------------------
#: [^\x20\x09-\x0D]+
WHITE = table([range(0x20, 0x21), range(0x09, 0x0E)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
NOT_ALNUM = table([range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80)])
#: [^\x00-\x40\x5B-\x60\x7B-\x7F]+
NOT_LETTERS = table([range(0x00, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)])
# --- end of fixed values --------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64, for positions up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of some texts. Word i is data[starts[i]:ends[i]]; text d has words first[d]:first[d+1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit number for each word that depends on its bytes alone."""
        up, down = _grown(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(
            (self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:]
        )
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def strings(self, which: np.ndarray) -> pa.Array:
        """The chosen words as an Arrow column."""
        return spans(self.data, self.starts[which], self.ends[which])


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Pieces of a byte array as an Arrow text column."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.Array.from_buffers(
        pa.large_utf8(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])]
    ).cast(pa.utf8())


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after the other, and where each text begins; null is empty."""
    column = column.cast(pa.large_utf8()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    begin = offsets[0]
    bytes_ = (
        np.frombuffer(data, np.uint8, offsets[-1] - begin, begin)
        if data is not None and offsets[-1] > begin
        else np.zeros(0, np.uint8)
    )
    return bytes_, offsets - begin


def words(column: pa.Array, separators: np.ndarray, lower: bool = True) -> Words:
    """All words of a text column."""
    data, offsets = raw(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = ~separators[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut so that the texts of a part stay below the limit.

    One text alone may be larger.
    """
    if not batch.num_rows:
        return
    _, offsets = raw(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over the words of each text."""
    if values.dtype.kind == "f":  # added up for each text apart, so that no digits are lost
        out = np.zeros(len(first) - 1)
        some = first[1:] > first[:-1]
        if some.any():
            out[some] = np.add.reduceat(values, first[:-1][some])
        return out
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def schema(df: DataFrame, names: list[str], more: str) -> StructType:
    """The named columns of df as they are, then further ones."""
    own = {f.name: f for f in df.schema}
    return StructType([*(own[n] for n in names), *StructType.fromDDL(more)])


def no_clash(keep: tuple[str, ...], taken: list[str]) -> None:
    """Raise if a column to keep has the name of another column of the result, or twice its own."""
    names = [*(k.lower() for k in keep), *(t.lower() for t in taken)]
    bad = sorted({k for k in keep if names.count(k.lower()) > 1})
    if bad:
        raise ValueError(f"columns to keep that clash with others of the result: {', '.join(bad)}")
