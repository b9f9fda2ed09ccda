"""Near-duplicate vectors by Euclidean locality-sensitive hashing (Datar et al., 2004).

Unit vectors within cosine c lie within a Euclidean distance of sqrt(2 - 2c). Each of several
tables puts a vector into the bucket of its quantised random projections; vectors that share a
bucket in any table are compared exactly. Buckets of any size are compared in blocks of bounded
size, and a pair counts in the first table that has it only, so links are counted without a row
for each pair.

With 96 tables of 24 projections and a width of 2, a pair at cosine 0.95 is found with a
probability of 0.98, one at 0.97 of 0.9998; two unrelated vectors meet with 3 in a million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import blocks as B
from footfall.llm import text as T
from footfall.llm.components import components
from footfall.session import stage

COSINE = 0.95
TABLES, PROJECTIONS, WIDTH = 96, 24, 2.0
SEED = 20040608
#: Vectors of a bucket compared in one block.
BLOCK_ROWS = 1024


class Hashes:
    """The random projections of every table, the same wherever they are made."""

    def __init__(self, dimensions: int, tables: int, projections: int, width: float) -> None:
        random = np.random.default_rng([SEED, dimensions])
        self.axes = random.standard_normal((dimensions, tables * projections))
        self.shifts = random.uniform(0, width, tables * projections)
        self.width, self.projections, self.tables = width, projections, tables

    def keys(self, unit: np.ndarray, tables: int | None = None) -> np.ndarray:
        """Bucket of each vector in the first tables, as one 64-bit number with the table in it."""
        n = (self.tables if tables is None else tables) * self.projections
        steps = np.floor((unit @ self.axes[:, :n] + self.shifts[:n]) / self.width)
        steps = steps.astype(np.int64).view(np.uint64).reshape(len(unit), -1, self.projections)
        out = np.broadcast_to(
            np.arange(steps.shape[1], dtype=np.uint64), steps.shape[:2]
        ) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(self.projections):
            out = T.mix(out * np.uint64(3) + steps[:, :, k])
        return out.view(np.int64)


def unit_rows(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vector that occurs: its rows, and their unit vectors in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = flat[starts[rows][:, None] + np.arange(size)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out[int(size)] = rows, x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def usable(vector: str) -> Column:
    """Not null, not zero, and only finite components."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    n_links counts the other rows linked directly, equal vectors among them; component_id is the
    smallest vec_id reachable; kept says whether that is the row's own id. Equal vectors are one
    node with a number of copies.

    A vector that is null, empty, zero or has a null or non-finite component links with nothing,
    nor does a row with a null id (its component is null and it is not kept). Vectors of different
    length never link. Rows that repeat an id with the same vector count as copies of each other.
    No vectors: no rows.
    """
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.when(usable(vector) & F.col(vec_id).isNotNull(), F.col(vector)).alias("v"),
    )
    nodes = stage(
        rows.where("v is not null")
        .groupBy("v")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")),
        "nodes",
    )
    pairs = stage(_linked(nodes, cosine, (tables, projections, width), block_rows), "links")
    links = pairs.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(pairs.select("node", "root"), "node", "root")
    known = stage(
        nodes.join(links, "node", "left")
        .join(tied, "node", "left")
        .select(
            "v",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ),
        "known",
    )
    found = rows.join(known, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _linked(nodes: DataFrame, cosine: float, setup: tuple, block_rows: int) -> DataFrame:
    """(node, links, root) for nodes with links in a block: copies linked, and a node reached."""
    kind = nodes.schema["node"].dataType.simpleString()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Hashes] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keys = np.zeros((part.num_rows, setup[0]), np.int64)
                for size, (which, unit) in unit_rows(part.column("v")).items():
                    made.setdefault(size, Hashes(size, *setup))
                    keys[which] = T.mix(
                        made[size].keys(unit).view(np.uint64) + np.uint64(size)
                    ).view(np.int64)
                offsets = np.arange(0, keys.size + 1, setup[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), keys.ravel()),
                    ],
                    names=["node", "keys"],
                )

    buckets = nodes.select("node", "v").mapInArrow(dealt, f"node {kind}, keys ARRAY<BIGINT>")
    buckets = buckets.select("node", F.posexplode("keys").alias("table", "bucket"))
    shared = B.block_pairs(buckets, "bucket", "node", block_rows // 2)
    keys = ["bucket", "part_a", "part_b"]
    ready = B.grouped(shared.join(nodes, "node"), keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Hashes] = {}
        for held in B.groups(batches, keys):
            starts = B.boundaries(held, keys)
            sizes = np.diff(np.append(starts, held.num_rows))
            copies = held.column("copies").to_numpy()
            nth, own = held.column("table").to_numpy(), held.column("part").to_numpy()
            a, b = held.column("part_a").to_numpy(), held.column("part_b").to_numpy()
            units = unit_rows(held.column("v"))
            size_of, place = np.zeros((2, held.num_rows), np.int64)
            for dimensions, (rows, _) in units.items():
                size_of[rows], place[rows] = dimensions, np.arange(len(rows))
            who, links, root = [], [], []
            for at, n in zip(starts, sizes, strict=True):
                mine = slice(at, at + n)
                dimensions = size_of[at]  # keys hold the length, so it is the same in a bucket
                if (size_of[mine] != dimensions).any():
                    raise ValueError("vectors of different length have one key")
                unit = units[dimensions][1][place[mine]]
                near = unit @ unit.T >= cosine
                np.fill_diagonal(near, False)
                if a[at] != b[at]:
                    near &= own[mine][:, None] != own[mine][None]
                if not near.any():
                    continue
                i, j = np.nonzero(np.triu(near))
                hashes = made.setdefault(dimensions, Hashes(int(dimensions), *setup))
                keep = _first_met(hashes, unit, i, j, int(nth[at]))
                i, j, c = i[keep], j[keep], copies[mine]
                linked = np.bincount(i, c[j], n) + np.bincount(j, c[i], n)
                some = np.flatnonzero(near.any(axis=1))
                who.append(at + some)
                links.append(linked[some].astype(np.int64))
                root.append(at + _labels(near)[some])
            if who:
                ids = held.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.concatenate(who))),
                        pa.array(np.concatenate(links)),
                        ids.take(pa.array(np.concatenate(root))),
                    ],
                    names=["node", "links", "root"],
                )

    return ready.mapInArrow(compare, f"node {kind}, links BIGINT, root {kind}")


def _first_met(
    hashes: Hashes, unit: np.ndarray, i: np.ndarray, j: np.ndarray, table: int
) -> np.ndarray:
    """Pairs that share no bucket of an earlier table."""
    alive = np.arange(len(i))
    some = np.unique(np.concatenate([i, j]))
    keys = hashes.keys(unit[some], table)
    i, j = np.searchsorted(some, i), np.searchsorted(some, j)
    for t in range(table):
        alive = alive[keys[i[alive], t] != keys[j[alive], t]]
    return alive


def _labels(near: np.ndarray) -> np.ndarray:
    """The first member of each one's component."""
    label = np.arange(len(near))
    near = near | np.eye(len(near), dtype=bool)
    while True:
        least = np.where(near, label[None], len(near)).min(axis=1)
        if (least == label).all():
            return label
        label = least
