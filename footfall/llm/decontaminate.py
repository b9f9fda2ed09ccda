"""Benchmark decontamination by multi-pattern search with block shift tables (Wu and Manber, 1994).

The symbols are words: lower-cased runs of letters, digits and non-ASCII characters. A pattern is a
window of 13 consecutive words of a benchmark item, or a shorter item as a whole. For each pattern
length, a table tells for a hash of the last two words under the search window how far the window
may move without missing a pattern. Where it may not move, the patterns that end with these two
words are looked up, those with other first words are dropped, and the rest compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T
from footfall.session import stage

WINDOW = 13
#: Patterns searched at once: bounds the memory of the tables, whatever the benchmark's size.
BLOCK_PATTERNS = 200_000
#: Positions of a text that one search window passes; more windows start further on.
LANE = 256

HITS = "n_words BIGINT, n_hit BIGINT, hit_words ARRAY<INT>, items ARRAY<STRING>"


class Patterns:
    """Search tables for patterns of one length in words."""

    def __init__(self, length: int, patterns: list[bytes], items: list[list[str]]) -> None:
        self.length, self.patterns, self.items = length, patterns, items
        self.width = min(2, length)
        found = T.words(pa.array([p.decode() for p in patterns]), T.NOT_ALNUM)
        hashed = found.hashes().reshape(-1, length)
        self.bits = max(12, min(24, int(np.ceil(np.log2(8 * len(patterns) * length)))))
        self.farthest = length - self.width + 1
        self.shift = np.full(1 << self.bits, self.farthest, np.int64)
        for end in range(self.width - 1, length):
            where = self.slot(self.block(hashed[:, end - self.width + 1 : end + 1]))
            np.minimum.at(self.shift, where, length - 1 - end)
        suffix = self.block(hashed[:, length - self.width :])
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.prefix = self.block(hashed[:, : self.width])

    @staticmethod
    def block(columns: np.ndarray) -> np.ndarray:
        out = columns[:, 0]
        for k in range(1, columns.shape[1]):
            out = T.mix(out * np.uint64(3) + columns[:, k])
        return out

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    def blocks_at(self, hashed: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.block(
            np.stack([hashed[end - self.width + 1 + k] for k in range(self.width)], axis=1)
        )

    def search(self, found: T.Words, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words of all occurrences, and their patterns."""
        firsts = found.first[:-1] + self.length - 1
        lanes = np.maximum(0, -(-(found.first[1:] - firsts) // LANE))
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(firsts, lanes) + nth * LANE
        stop = np.minimum(np.repeat(found.first[1:], lanes), at + LANE)
        candidates = []
        while len(at):
            move = self.shift[self.slot(self.blocks_at(hashed, at))]
            candidates.append(at[move == 0])
            at = at + np.maximum(move, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.concatenate(candidates) if candidates else np.zeros(0, np.int64)
        suffix = self.blocks_at(hashed, ends)
        low = np.searchsorted(self.suffix, suffix, "left")
        many = np.searchsorted(self.suffix, suffix, "right") - low
        ends = np.repeat(ends, many)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        which = self.order[np.repeat(low, many) + nth]
        begin = ends - self.length + 1
        same = self.blocks_at(hashed, begin + self.width - 1) == self.prefix[which]
        ends, which = ends[same], which[same]
        text = found.data.tobytes()
        sure = [
            k
            for k, (end, p) in enumerate(zip(ends.tolist(), which.tolist(), strict=True))
            if self.patterns[p]
            == b" ".join(
                text[found.starts[w] : found.ends[w]] for w in range(end - self.length + 1, end + 1)
            )
        ]
        return ends[sure], which[sure]


def windows(benchmark: DataFrame, item_id: str, text: str, size: int = WINDOW) -> DataFrame:
    """One row per distinct window of an item: item_id as text, its words, and their number."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.chunks(batch, "text"):
                found = T.words(part.column("text"), T.NOT_ALNUM)
                raw, ids, out = found.data.tobytes(), part.column("item_id").to_pylist(), []
                for d in range(found.texts):
                    mine = [
                        raw[s:e].decode()
                        for s, e in zip(
                            found.starts[found.first[d] : found.first[d + 1]],
                            found.ends[found.first[d] : found.first[d + 1]],
                            strict=True,
                        )
                    ]
                    n = min(size, len(mine))
                    if n:
                        out += [
                            (ids[d], " ".join(mine[k : k + n]), n) for k in range(len(mine) - n + 1)
                        ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[k] for x in out], kind)
                        for k, kind in enumerate((pa.string(), pa.string(), pa.int32()))
                    ],
                    names=["item_id", "words", "n"],
                )

    chosen = benchmark.select(
        F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text")
    ).where(F.col("text").isNotNull())
    return chosen.mapInArrow(cut, "item_id STRING, words STRING, n INT").distinct()


def search_tables(rows: list) -> list[Patterns]:
    """Tables of one block of windows, a set for each length; a null id is listed for none."""
    lengths: dict[int, dict[str, list[str]]] = {}
    for row in rows:
        named = lengths.setdefault(row.n, {}).setdefault(row.words, [])
        if row.item_id is not None:
            named.append(row.item_id)
    return [
        Patterns(n, [p.encode() for p in by], list(by.values())) for n, by in sorted(lengths.items())
    ]


def find_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_patterns: int = BLOCK_PATTERNS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """For every row of documents: doc_id, the columns of `keep`, n_words, n_hit, the places of
    hit words in the text and the items that have an occurring window.

    The windows are searched in blocks of bounded size, each against all documents. Within a block
    rows map to rows. Several blocks are put together by (row, digest of the text).

    A null text has no words. Items without words are left out; the words of an item with a null id
    are hit like any others, but it is not listed. Equal windows count for all items that have them.
    Repeated rows are judged each on its own. Without documents the result is empty; without a
    benchmark nothing is hit. A column of `keep` may not have the name of another one of the result.
    """
    T.no_clash(keep, ["doc_id", "_body", "_digest", "n_words", "n_hit", "hit_words", "items"])
    spark = documents.sparkSession
    pieces = stage(windows(benchmark, item_id, item_text, window), "windows")
    distinct = pieces.agg(F.count_distinct("words")).first()[0]
    blocks = max(1, -(-distinct // block_patterns))
    part = F.pmod(F.xxhash64("words"), F.lit(blocks))
    chosen = documents.select(
        F.col(doc_id).alias("doc_id"), *keep, F.col(text).cast("string").alias("_body")
    )
    found = [
        scan(chosen, spark.sparkContext.broadcast(search_tables(pieces.where(part == b).collect())))
        for b in range(blocks)
    ]
    if blocks == 1:
        return found[0].drop("_digest")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    rows = [c for c in every.columns if c not in ("n_hit", "hit_words", "items")]
    return (
        every.groupBy(rows)
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count(F.lit(1)) / blocks).cast("int").alias("_copies"),
        )
        .withColumn("n_hit", F.size("hit_words").cast("bigint"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
        .select(*found[0].drop("_digest").columns)
    )


def scan(chosen: DataFrame, tables: Broadcast) -> DataFrame:
    """Search one block of patterns in the column _body of every row."""
    names = [c for c in chosen.columns if c != "_body"]
    chosen = chosen.withColumn("_digest", F.sha2(F.coalesce("_body", F.lit("")), 256))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in T.chunks(batch, "_body"):
                found = T.words(rows.column("_body"), T.NOT_ALNUM)
                hashed, owner = found.hashes(), found.owner()
                edges = np.zeros(len(found) + 1, np.int64)
                items: dict[int, set[str]] = {}
                for patterns in tables.value:
                    ends, which = patterns.search(found, hashed)
                    np.add.at(edges, ends - patterns.length + 1, 1)
                    np.add.at(edges, ends + 1, -1)
                    for d, p in set(zip(owner[ends].tolist(), which.tolist(), strict=True)):
                        items.setdefault(d, set()).update(patterns.items[p])
                hit = np.cumsum(edges)[:-1] > 0
                places = [
                    np.flatnonzero(hit[found.first[d] : found.first[d + 1]]) if d in items else []
                    for d in range(found.texts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(c) for c in [*names, "_digest"]),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array(T.per_text(hit, found.first), pa.int64()),
                        pa.array(places, pa.list_(pa.int32())),
                        pa.array(
                            [sorted(items.get(d, ())) for d in range(found.texts)],
                            pa.list_(pa.string()),
                        ),
                    ],
                    names=[*names, "_digest", "n_words", "n_hit", "hit_words", "items"],
                )

    return chosen.mapInArrow(search, T.schema(chosen, [*names, "_digest"], HITS))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least one word in twenty lies in a benchmark window."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))
