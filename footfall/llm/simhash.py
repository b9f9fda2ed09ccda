"""Near-duplicates by SimHash, joined on bit counts of segments.

A fingerprint is embedded as the vector of the bit counts of its 32 segments of two bits. One
differing bit changes one count by one, so the Manhattan distance of two vectors is at most the
number of differing bits. Vectors within a distance of 3 agree on at least three of six groups of
coordinates; the cells of a unit grid over each choice of three groups are therefore joined, and
within a cell the Manhattan distance drops most pairs before the bits are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import blocks as B
from footfall.llm import text as T
from footfall.llm.components import components
from footfall.session import stage

# --- fixed values -----------------------------------------------------------
SEED = 42
SHINGLE_WORDS = 3
MOST_BITS = 3
# --- end of fixed values ----------------------------------------------------
#: Six groups of the 32 segments.
GROUPS = [range(0, 5), range(5, 10), range(10, 15), range(15, 20), range(20, 26), range(26, 32)]
#: Fingerprints of one cell compared in one task; larger cells are cut into pairs of parts.
CELL_ROWS = 8192

_LOW = np.uint64(0x5555555555555555)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes; zero without any."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(found: T.Words, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text the XXH64 of its shingles, repeats included; few words are one shingle."""
    sizes = found.ends - found.starts
    total = np.concatenate([[0], np.cumsum(sizes + 1)])
    # the words of all texts, each followed by one space
    joined = np.full(total[-1], 0x20, np.uint8)
    at = np.repeat(total[:-1] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(
        sizes
    ) else np.zeros(0, np.int64)
    source = np.repeat(found.starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    joined[at + np.arange(sizes.sum())] = found.data[source]
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    begin, end, out = total[:-1].tolist(), (total[1:] - 1).tolist(), []
    for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        width = min(size, hi - lo)
        out.append(
            np.array(
                [
                    digest(raw[s:e], SEED)
                    for s, e in zip(begin[lo : hi - width + 1], end[lo + width - 1 : hi], strict=True)
                ]
                if width
                else [],
                np.uint64,
            )
        )
    return out


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the 64-bit fingerprint (as a signed BIGINT) of every row; a null text is empty."""
    schema = documents.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in T.chunks(batch, "text"):
                prints = [fingerprint(h) for h in shingle_hashes(T.words(rows.column("text"), T.WHITE))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                    names=["doc_id", "fp"],
                )

    return documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")
    ).mapInArrow(work, f"doc_id {schema}, fp BIGINT")


def pair_counts(fp: np.ndarray) -> np.ndarray:
    """The embedding: bit counts of the 32 two-bit segments, each in two bits of a number."""
    return (fp & _LOW) + ((fp >> np.uint64(1)) & _LOW)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of differences of the counts of two embeddings."""
    out = np.zeros(np.broadcast(a, b).shape, np.uint8)
    for k in range(0, 64, 8):
        # the four counts of a byte pair, by table
        x = ((a >> np.uint64(k)) & np.uint64(255)).astype(np.uint8)
        y = ((b >> np.uint64(k)) & np.uint64(255)).astype(np.uint8)
        out += _BYTE_DISTANCE[x, y]
    return out


def _byte_distance() -> np.ndarray:
    n = np.arange(256)
    return sum(
        np.abs(((n[:, None] >> k) & 3) - ((n[None, :] >> k) & 3)) for k in (0, 2, 4, 6)
    ).astype(np.uint8)


_BYTE_DISTANCE = _byte_distance()


def cells(prints: DataFrame) -> DataFrame:
    """(cell, fp): the grid cells of each fingerprint, one for each three of the six groups."""
    # the sum of the two bits of each segment, without carries
    low = int(_LOW)
    counts = F.expr(
        f"((fp ^ shiftrightunsigned(fp, 1)) & {low})"
        f" | shiftleft(fp & shiftrightunsigned(fp, 1) & {low}, 1)"
    )
    keys = []
    for nth, three in enumerate(combinations(GROUPS, 3)):
        mask = sum(3 << (2 * s) for group in three for s in group)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(nth).alias("n"), F.col("_counts").bitwiseAND(F.lit(signed)).alias("c")))
    return (
        prints.withColumn("_counts", counts)
        .select("fp", F.explode(F.array(*keys)).alias("k"))
        .select(F.xxhash64("k.n", "k.c").alias("cell"), "fp")
    )


def reach(fp: np.ndarray, most: int) -> np.ndarray:
    """For each of some distinct fingerprints the first one of its component, by index.

    Members leave the unvisited ones as soon as they are reached, so a dense group costs little
    more than a pass for each of its first members.
    """
    first = np.arange(len(fp))
    counts = pair_counts(fp)
    rest = np.arange(len(fp))
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = rest[:0]
        todo = np.array([root])
        while len(todo) and len(rest):
            now, todo = todo[:64], todo[64:]
            near = np.zeros(len(rest), bool)
            maybe_a, maybe_b = np.nonzero(manhattan(counts[now][:, None], counts[rest][None]) <= most)
            same = np.bitwise_count(fp[now][maybe_a] ^ fp[rest][maybe_b]) <= most
            near[maybe_b[same]] = True
            frontier = rest[near]
            first[frontier] = root
            todo, rest = np.concatenate([todo, frontier]), rest[~near]
    return first


def links(prints: DataFrame, most: int = MOST_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join those with up to `most` differing bits.

    In each cell the members of a component are tied to its first one; no other pair is emitted.
    """
    if most > 3:
        raise ValueError("six groups hold for up to three differing bits")
    keys = ["cell", "part_a", "part_b"]
    ready = B.grouped(B.block_pairs(cells(prints), "cell", "fp", cell_rows // 2), keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in B.groups(batches, keys):
            fp = table.column("fp").to_numpy().view(np.uint64)
            starts = B.boundaries(table, keys)
            sizes = np.diff(np.append(starts, len(fp)))
            a, b = [], []
            # groups of two, by far the most, at once
            two = starts[sizes == 2]
            one, other = fp[two], fp[two + 1]
            near = manhattan(pair_counts(one), pair_counts(other)) <= most
            near &= np.bitwise_count(one ^ other) <= most
            a.append(one[near])
            b.append(other[near])
            for at, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                mine = fp[at : at + n]
                first = reach(mine, most)
                tied = first != np.arange(n)
                a.append(mine[tied])
                b.append(mine[first[tied]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    return ready.mapInArrow(work, "a BIGINT, b BIGINT")


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = MOST_BITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per row of documents: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of up to `most` differing bits. Equal
    fingerprints are one node of the graph, so exact copies cost one aggregated row.

    Null and empty texts have fingerprint zero and link like any other. A null doc_id takes part
    and gets the component of its fingerprint, but is never the smallest; the component is null
    where all its ids are. Repeated rows stay repeated. No documents: no rows.
    """
    prints = stage(fingerprints(documents, doc_id, text), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tied = stage(components(links(nodes.select("fp"), most, cell_rows)), "components")
    # of the fingerprints that are linked to others, the smallest id in each component
    smallest = (
        tied.join(nodes, tied.node == nodes.fp)
        .groupBy("component")
        .agg(F.min("least").alias("component_id"))
    )
    linked = tied.join(smallest, "component").select(F.col("node").alias("fp"), "component_id")
    # written first, so that the join below reads two plain shuffles and can split a hot fingerprint
    known = stage(
        nodes.join(linked, "fp", "left").select(
            "fp", F.coalesce("component_id", "least").alias("component_id")
        ),
        "known",
    )
    return prints.join(known, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
