"""Vectors as short codes: product quantisation in whole numbers.

A vector is cut into parts, and each part is replaced by the index of the nearest entry of the
part's codebook. Distances are searched in the Walsh-Hadamard domain: parts and entries are padded
with zeros to a power of two and transformed by additions and subtractions alone. The transform
keeps squared distances up to a known factor, so the squared differences of the first
coefficients, in order of sequency, are a lower bound of the scaled distance, and an entry whose
bound exceeds a distance already reached is left out at once. No floating point takes part once the
components are whole numbers, so results are the same on every machine.

Codebooks are refined by a fixed number of rounds. In each, tasks add up the parts of every entry
of all their rows and send one row for each entry in use; the sums of an entry meet in one place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import blocks as B
from footfall.llm import text as T
from footfall.session import stage

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows whose parts are compared with all entries at once.
ROWS = 256
#: Coefficients that are looked at for all entries, and then in each further step.
FIRST, STEP = 8, 4
#: Copies of each label's sum, over which the rows of a label are spread.
SALTS = 16
_HALF = 32  # sums travel as a high and a low number of so many bits


def whole(vector: str) -> Column:
    """Not null, and neither null nor non-finite components."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad, F.lit(False))


def integers(column: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component, a row each, filled with zeros to the width.

    The scale is a power of two, so the product is exact. Numbers beyond 62 bits are Python's;
    those beyond 90 bits are an error.
    """
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    largest = np.abs(flat).max(initial=0)
    if largest >= 2.0**90 / scale:
        raise ValueError(f"a component of {largest} is too large to be coded")
    if largest * scale >= 2.0**62:
        numbers = np.array(
            [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in flat.tolist()],
            object,
        )
    else:
        numbers = np.floor(flat * scale).astype(np.int64)
    if (sizes == width).all():
        return numbers.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), numbers.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = numbers
    return out


def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix by their number of sign changes."""
    signs = transformed(np.eye(size, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def transformed(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of rows whose length is a power of two, in natural order."""
    rows, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(rows, -1, 2, step)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack([a + b, a - b], axis=2).reshape(rows, size)
        step *= 2
    return x


class Codebook:
    """The entries of one part, ready to be searched."""

    def __init__(self, entries: np.ndarray) -> None:
        self.length = entries.shape[1]
        self.size = 1 << max(self.length - 1, 0).bit_length()
        self.order = sequency_order(self.size)
        self.largest = int(np.abs(entries).max(initial=0))
        self.hat = self._spread(entries)

    def _spread(self, x: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(x), self.size), x.dtype)
        padded[:, : self.length] = x
        return transformed(padded)[:, self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, the lower one of a tie, and the squared distance."""
        bound = max(self.largest, int(np.abs(x).max(initial=0)))
        most = 4 * bound * bound * self.length * self.size  # of any scaled distance
        kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
        x, hat = x.astype(kind, copy=False), self.hat.astype(kind, copy=False)
        index = np.zeros(len(x), np.int64)
        far = np.zeros(len(x), object if kind is object else np.int64)
        for at in range(0, len(x), ROWS):
            index[at : at + ROWS], far[at : at + ROWS] = self._nearest(x[at : at + ROWS], hat)
        return index, far

    def _nearest(self, x: np.ndarray, hat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine = self._spread(x)
        first = min(FIRST, self.size)
        total = np.zeros((len(x), len(hat)), x.dtype)
        for c in range(first):
            gap = mine[:, c, None] - hat[None, :, c]
            total += gap * gap
        guess = total.argmin(axis=1)
        reached = ((mine - hat[guess]) ** 2).sum(axis=1)
        row, entry = np.nonzero(total <= reached[:, None])
        total = total[row, entry]
        for c in range(first, self.size, STEP):
            gap = mine[row, c : c + STEP] - hat[entry, c : c + STEP]
            total = total + (gap * gap).sum(axis=1)
            alive = total <= reached[row]
            row, entry, total = row[alive], entry[alive], total[alive]
            if c < self.size // 2 <= c + STEP:  # a nearer entry, now that half is known
                guess, _ = _lowest(row, entry, total)
                reached = np.minimum(reached, ((mine - hat[guess]) ** 2).sum(axis=1))
        entry, total = _lowest(row, entry, total)
        return entry, total // self.size


def _lowest(row: np.ndarray, entry: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each row with the least total, the lower one of a tie; entries stand in order."""
    begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(total, begin)
    place = np.flatnonzero(total == np.repeat(least, np.diff(np.r_[begin, len(row)])))
    _, one = np.unique(row[place], return_index=True)
    return entry[place[one]], least


@dataclass
class Codebooks:
    """Entries by part, entry and position; `width` is the length of the vectors cut into parts."""

    entries: np.ndarray
    width: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def cut(self, x: np.ndarray) -> np.ndarray:
        """Parts of rows: part, row, position."""
        parts = len(self.entries)
        return x.reshape(len(x), parts, self.width // parts).transpose(1, 0, 2)


def fit(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks that start from the rows with the smallest ids and are refined over all rows.

    At most `entries` rows, then sums of `parts * entries` entries a round come to the driver; both
    numbers are arguments and don't depend on the rows. Null ids come last, equal ids in order of
    their vectors. Fewer rows than `entries` make as many entries as there are rows.
    """
    kept = vectors.where(whole(vector)).select(
        F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")
    )
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts) * parts
    smallest = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries)
    start = smallest.select("v").toArrow().column("v").combine_chunks()
    if not len(start):
        return Codebooks(np.zeros((parts, 0, width // parts), np.int64), width)
    books = Codebooks(np.zeros((parts, 0, 0), np.int64), width)
    books.entries = books.cut(integers(start, width, scale))
    for _ in range(rounds):
        books.entries = _refined(kept, books, scale)
    return books


def _refined(kept: DataFrame, books: Codebooks, scale: int) -> np.ndarray:
    """Entries replaced by the rounded-down mean of the parts nearest to them."""
    parts, entries, length = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(e) for e in books.entries]
        sums = np.zeros((parts, entries, 2, length), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = integers(batch.column("v"), books.width, scale)
            for p, part in enumerate(books.cut(x)):
                at, _ = search[p].nearest(part)
                count[p] += np.bincount(at, minlength=entries)
                np.add.at(sums[p, :, 0], at, (part >> _HALF).astype(np.int64))
                np.add.at(sums[p, :, 1], at, (part & ((1 << _HALF) - 1)).astype(np.int64))
        yield _sum_rows(np.flatnonzero(count.ravel()), count.ravel(), sums.reshape(-1, 2 * length))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, 2 * length), np.int64)
        count = np.zeros(parts * entries, np.int64)
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            np.add.at(count, cell, batch.column("n").to_numpy())
            np.add.at(sums, cell, batch.column("sums").flatten().to_numpy().reshape(len(cell), -1))
        yield _sum_rows(np.flatnonzero(count), count, sums)

    kind = "cell INT, n BIGINT, sums ARRAY<BIGINT>"
    partial = kept.select("v").mapInArrow(add, kind)
    whole_sums = partial.repartition("cell").mapInArrow(merge, kind).toArrow()
    out = books.entries.copy()
    for cell, n, both in zip(
        *(whole_sums.column(c).to_pylist() for c in ("cell", "n", "sums")), strict=True
    ):
        means = [((h << _HALF) + low) // n for h, low in zip(both[:length], both[length:], strict=True)]
        out = out.astype(object) if max(map(abs, means), default=0) >> 62 else out
        out[divmod(cell, entries)] = means
    return out


def _sum_rows(cells: np.ndarray, count: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    width = sums.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(cells, pa.int32()),
            pa.array(count[cells]),
            pa.ListArray.from_arrays(
                pa.array(np.arange(len(cells) + 1) * width, pa.int32()), sums[cells].ravel()
            ),
        ],
        names=["cell", "n", "sums"],
    )


def encode(
    vectors: DataFrame,
    books: Codebooks,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    keep: tuple[str, ...] = (),
    scale: int = SCALE,
) -> DataFrame:
    """One row per row with a whole vector: vec_id, the columns of `keep`, code, error.

    code holds the index of each part's entry, two hex digits a part; error is the sum of the
    squared distances. Rows whose vector is null or has a null or non-finite component are left
    out; a vector of zeros is like any other. Shorter vectors count as filled with zeros; those
    longer than the codebooks' are an error. Repeated rows are encoded each on its own. Components
    of 2^80 or more and errors beyond 64 bits stop the job. Rows map to rows: no shuffle.
    """
    inner = [f"_keep{k}" for k in range(len(keep))]
    chosen = vectors.where(whole(vector)).select(
        F.col(vec_id).alias("vec_id"),
        *(F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner, strict=True)),
        F.col(vector).alias("v"),
    )
    names = ["vec_id", *inner]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(e) for e in books.entries]
        for batch in batches:
            x = integers(batch.column("v"), books.width, scale)
            found = [s.nearest(part) for s, part in zip(search, books.cut(x), strict=True)]
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array([row.tobytes().hex() for row in index], pa.string()),
                    pa.array(error.tolist(), pa.int64()),
                ],
                names=[*names, "code", "error"],
            )

    coded = chosen.mapInArrow(work, T.schema(chosen, names, "code STRING, error BIGINT"))
    return coded.select("vec_id", *(F.col(n).alias(c) for c, n in zip(keep, inner, strict=True)),
                        "code", "error")


def quantised(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per row with a whole vector: vec_id, code, error, label_error, codebooks_sha256.

    label_error is the error summed over the rows of equal label, null being one of them; however
    many rows a label has, they are added up before they meet and spread when they are joined with
    their sum. Further columns take no part. No vectors: no rows.
    """
    books = fit(vectors, vec_id, vector)
    named = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"), F.col(label).alias("label")
    )
    coded = stage(encode(named, books, "vec_id", "v", keep=("label",)), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return B.with_lookup(coded, sums, ["label"], F.xxhash64("code"), SALTS).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )
