"""How far the sources of a language differ in their use of terms, in whole numbers.

Each source of a language counts the language's kept terms. The counts of a block of term ids are
the leaves of a segment tree; nodes are hash-consed, so equal subtrees of any two sources, such as
stretches of terms that both leave out, are one node. Two trees are compared by walking them at the
same time, level by level: equal pairs of nodes become one with a multiplicity, so each is opened
once, and at the leaves each pair of counts is priced once.

Blocks and tiles of sources keep every task bounded, however many terms or sources a language has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import blocks as B
from footfall.llm import text as T
from footfall.session import stage

#: Documents of a language that hold a kept term, at least.
DOCUMENTS = 10
#: Terms listed for each source.
TOP = 10
UNIT = 1_000_000_000
#: Terms of a block and sources of a tile, on average; both are dealt by hash.
BLOCK_TERMS, TILE_SOURCES = 4096, 24
#: Copies of what is joined to the counts, so that a source with very many terms is spread.
SALTS = 16


class Forest:
    """Segment trees over equally many leaves, a row of counts each, with shared nodes.

    Leaf nodes are numbered by count; nodes of a level are numbered by their pair of children.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.counts, at = np.unique(counts, return_inverse=True)
        at = at.reshape(counts.shape)
        self.children: list[np.ndarray] = []  # for each level above the leaves: left and right
        while at.shape[1] > 1:
            size = int(at.max()) + 1
            pairs, at_ = np.unique(at[:, ::2] * size + at[:, 1::2], return_inverse=True)
            self.children.append(np.stack(np.divmod(pairs, size)))
            at = at_.reshape(len(counts), -1)
        self.roots = at[:, 0]

    def nodes(self) -> int:
        """Distinct nodes above the leaves."""
        return sum(level.shape[1] for level in self.children)

    def leaf_pairs(self, one: int, others: np.ndarray) -> tuple[np.ndarray, ...]:
        """For tree `one` and each of `others`: which, the two leaf nodes, and how often they meet."""
        which = np.arange(len(others))
        a, b = np.full(len(others), self.roots[one]), self.roots[others]
        times = np.ones(len(others), np.int64)
        for left_right in self.children[::-1]:
            which, times = np.concatenate([which, which]), np.concatenate([times, times])
            a, b = left_right[:, a].ravel(), left_right[:, b].ravel()
            size = max(int(a.max()), int(b.max())) + 1
            key, at = np.unique((which * size + a) * size + b, return_inverse=True)
            times = np.bincount(at, times, len(key)).astype(np.int64)
            rest, b = np.divmod(key, size)
            which, a = np.divmod(rest, size)
        return which, a, b, times


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kept)), exactly; 0 for a count of -1."""
    wide = counts.astype(object) if counts.max(initial=0) > (1 << 62) // UNIT else counts
    p = 1 + UNIT * (wide + 2) // (total + 2 * kept) if kept else np.zeros(len(counts))
    return np.where(counts < 0, 0, p.astype(np.int64))


def distances(forest: Forest, totals: list[int], kept: int, one: int, others: np.ndarray) -> np.ndarray:
    """Sum of (p - q)^2 / (p + q), each rounded down, between tree `one` and each of `others`."""
    which, a, b, times = forest.leaf_pairs(one, others)
    price = np.stack([shares(forest.counts, n, kept) for n in totals])
    p, q = price[one, a], price[others[which], b]
    both = p + q
    f = np.where(both > 0, (p - q) ** 2 // np.maximum(both, 1), 0)
    out = np.zeros(len(others), np.int64)
    np.add.at(out, which, f * times)
    return out


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    chosen = documents.select(
        _text(lang).alias("lang"), _text(source).alias("source"), F.col(text).cast("string").alias("_body")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in T.chunks(batch, "_body"):
                found = T.words(rows.column("_body"), T.NOT_LETTERS)
                if not len(found):
                    continue
                _, first, word = np.unique(found.hashes(), return_index=True, return_inverse=True)
                names = rows.select(["lang", "source"]).to_pylist()
                group = {}
                of = np.array([group.setdefault((r["lang"], r["source"]), len(group)) for r in names])
                in_doc, n = np.unique(found.owner() * len(first) + word, return_counts=True)
                doc, word = np.divmod(in_doc, len(first))
                key, at = np.unique(of[doc] * len(first) + word, return_inverse=True)
                g, word = np.divmod(key, len(first))
                langs, sources = (pa.array([k[i] for k in group]) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(pa.array(g)),
                        sources.take(pa.array(g)),
                        found.strings(first[word]),
                        pa.array(np.bincount(at, n, len(key)).astype(np.int64)),
                        pa.array(np.bincount(at, minlength=len(key)).astype(np.int64)),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

    kind = "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT"
    return (
        chosen.mapInArrow(count, kind)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def audit(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    documents_least: int = DOCUMENTS,
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part `pair` ranks every other source of the language by its distance from the source, over all
    terms that at least `documents_least` documents of the language hold. Part `term` ranks the
    `top` terms by which the source exceeds its language.

    Null texts, languages and sources count as empty ones. A source without terms takes part with
    counts of zero; a language without kept terms has distances of zero and no terms; one with a
    single source has no pairs. Equal values are ranked by the item's bytes. Repeated rows count
    each time; further columns take no part; no documents give no rows.
    """
    # every term of a language with at most one row for each of its sources
    each = Window.partitionBy("lang", "term")
    counted = term_counts(documents, text, lang, source)
    kept = stage(
        counted.withColumn("in_lang", F.sum("docs").over(each))
        .where(F.col("in_lang") >= documents_least)
        .select(
            "lang",
            "source",
            "term",
            "n",
            F.sum("n").over(each).alias("total"),
            (F.row_number().over(each.orderBy("source")) == 1).alias("leads"),
        ),
        "kept",
    )
    groups = stage(_groups(documents, kept, lang, source, block_terms, tile_sources), "groups")
    rows = B.with_lookup(kept, groups, ["lang", "source"], F.xxhash64("term"), SALTS)
    pairs = _pairs(rows, groups)
    both = pairs.union(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    exceeding = _exceeding(rows)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked = both.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    best = (
        exceeding.withColumn("part", F.lit("term"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )
    return ranked.select(columns).union(best.select(columns))


def _groups(
    documents: DataFrame, kept: DataFrame, lang: str, source: str, block_terms: int, tile_sources: int
) -> DataFrame:
    """Each (lang, source) with its number of occurrences, those of the language, and the division."""
    found = documents.select(_text(lang).alias("lang"), _text(source).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("own"), F.sum(F.col("leads").cast("bigint")).alias("led")
    )
    sums = found.join(own, ["lang", "source"], "left")
    of_lang = sums.groupBy("lang").agg(
        F.coalesce(F.sum("own"), F.lit(0)).alias("all_own"),
        F.coalesce(F.sum("led"), F.lit(0)).alias("terms"),
        F.count(F.lit(1)).alias("sources"),
    )
    tiles = F.ceil(F.col("sources") / tile_sources).cast("int")
    return sums.join(of_lang, "lang").select(
        "lang",
        "source",
        F.coalesce("own", F.lit(0)).alias("own"),
        "all_own",
        "terms",
        F.greatest(F.ceil(F.col("terms") / block_terms), F.lit(1)).cast("int").alias("blocks"),
        tiles.alias("tiles"),
        F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile"),
    )


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for sources in the order source < item."""
    counts = rows.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    # every source is listed in every block, with the number of terms that the block has at all
    listed = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    in_block = counts.where("leads").groupBy("lang", "block").agg(F.count(F.lit(1)).alias("in_block"))
    roster = listed.join(in_block, ["lang", "block"], "left")
    shape = ["lang", "block", "source", "own", "terms", "tiles", "tile"]

    def none(kind: str) -> Column:
        return F.lit(None).cast(kind)

    all_rows = counts.select(*shape, "term", "n", "total", none("bigint").alias("in_block")).union(
        roster.select(*shape, none("string"), none("bigint"), none("bigint"), "in_block")
    )
    dealt = (
        all_rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("tile_a", F.least("tile", "_other"))
        .withColumn("tile_b", F.greatest("tile", "_other"))
        .drop("_other", "tiles")
    )
    keys = ["lang", "block", "tile_a", "tile_b"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in B.groups(batches, keys):
            starts = B.boundaries(held, keys)
            for at, to in zip(starts, [*starts[1:], held.num_rows], strict=True):
                yield from _compared(held.slice(at, to - at))

    kind = "lang STRING, source STRING, item STRING, value BIGINT"
    parts = B.grouped(dealt, keys).mapInArrow(compare, kind)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _compared(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """Distances within a block between the sources of two tiles, or of one."""
    listed = group.filter(group.column("n").is_null()).sort_by("source")
    names = listed.column("source").combine_chunks()
    tile = listed.column("tile").to_numpy()
    tile_a, tile_b = group.column("tile_a")[0].as_py(), group.column("tile_b")[0].as_py()
    cells = group.filter(group.column("n").is_valid())
    # term ids of the block: frequent terms first, so that the rare ones share their subtrees
    terms = cells.select(["term", "total"]).group_by("term").aggregate([("total", "max")])
    terms = terms.sort_by([("total_max", "descending"), ("term", "ascending")]).column("term")
    in_block = listed.column("in_block")[0].as_py() or 0  # with those that no source here has
    size = 1 << max(in_block - 1, 0).bit_length()
    counts = np.zeros((len(names), size), np.int64)
    counts[:, in_block:] = -1  # no term
    if len(cells):
        row = pc.index_in(cells.column("source"), names).to_numpy()
        column = pc.index_in(cells.column("term"), terms.combine_chunks()).to_numpy()
        counts[row, column] = cells.column("n").to_numpy()
    forest = Forest(counts)
    totals, kept = listed.column("own").to_pylist(), listed.column("terms")[0].as_py()
    language = group.column("lang")[0].as_py()
    for one in range(len(names)):
        others = np.arange(one + 1, len(names))
        if tile_a != tile_b:
            others = others[tile[others] != tile[one]]
        if len(others):
            value = distances(forest, totals, kept, one, others)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([language] * len(others), pa.string()),
                    pa.array([names[one].as_py()] * len(others), pa.string()),
                    names.take(pa.array(others)),
                    pa.array(value),
                ],
                names=["lang", "source", "item", "value"],
            )


def _exceeding(rows: DataFrame) -> DataFrame:
    """(lang, source, item, value) of terms whose share in the source is above the language's."""

    def share(count: str, total: str) -> Column:
        wide = (F.col(count) + 2).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
        return F.lit(1) + F.call_function("div", wide, F.col(total) + 2 * F.col("terms"))

    p, q = F.col("p"), F.col("q")
    return (
        rows.select("lang", "source", F.col("term").alias("item"), share("n", "own").alias("p"),
                    share("total", "all_own").alias("q"))
        .where(p > q)
        .select("lang", "source", "item", F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
    )
