"""Nearest neighbours by learned partitions (Dong et al., 2020), by largest inner product.

A bounded sample is joined to its nearest neighbours, and this graph is cut into parts of equal
size by repeated bisection that leaves few edges cut. A small classifier learns the parts and gives
every row of the table its part. A second one learns in which parts the neighbours of a vector lie;
a query is compared exactly with the rows of its most probable parts. How many these are is measured
on sampled queries that neither classifier was trained on.

Rows much longer than others may be near to any query, so the longest ones of a thousand make a part
that every query visits. Parts are searched in tiles of a block of rows and a chunk of queries, so
a part may hold any number of either.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import blocks as B
from footfall.llm.vectors import usable
from footfall.session import stage

NEAREST = 20
#: Rows the model is fitted on, about, chosen by hash of their id, and those of them kept for measuring.
SAMPLE_ROWS, MEASURED_ROWS = 12_000, 1_500
#: Parts the graph is cut into, and the least rows of the sample in one.
PARTS, LEAST = 64, 24
#: Neighbours of a sampled row in the graph.
DEGREE = 10
#: Share of the measured queries' nearest rows that the visited parts hold.
RECALL = 0.95
LONGEST = 0.001
#: Rows of a block and queries of a chunk, on average, and queries multiplied at once.
BLOCK_ROWS, CHUNK_QUERIES, AT_ONCE = 4096, 1024, 128
SALTS = 16
SEED = 20200427


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, added up in order of the components everywhere."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The nearest other rows of each row, farthest last."""
    degree = min(degree, len(x) - 1)
    out = np.zeros((len(x), degree), np.int64)
    for at in range(0, len(x), 512):
        close = x[at : at + 512] @ x.T
        close[np.arange(len(close)), at + np.arange(len(close))] = -np.inf
        near = np.argpartition(-close, degree - 1, axis=1)[:, :degree] if degree else out[:0]
        order = np.argsort(-np.take_along_axis(close, near, axis=1), axis=1, kind="stable")
        out[at : at + 512] = np.take_along_axis(near, order, axis=1)
    return out


def cut(x: np.ndarray, near: np.ndarray, parts: int, least: int) -> np.ndarray:
    """Part of each row: halves of halves, each cut so that few of the graph's edges are between them."""
    part = np.zeros(len(x), np.int64)
    made, todo = 1, [0]
    while todo and made < parts:
        p = todo.pop(0)
        rows = np.flatnonzero(part == p)
        if len(rows) >= 2 * least:
            part[rows[_half(x, near, rows)]] = made
            todo += [p, made]
            made += 1
    return part


def _half(x: np.ndarray, near: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """True for half of the rows: split along the widest direction, then swap while edges are saved."""
    place = np.full(len(x), -1)
    place[rows] = np.arange(len(rows))
    a = np.repeat(np.arange(len(rows)), near.shape[1])
    b = place[near[rows].ravel()]
    a, b = np.concatenate([a[b >= 0], b[b >= 0]]), np.concatenate([b[b >= 0], a[b >= 0]])
    centred = x[rows] - x[rows].mean(axis=0)
    _, axes = np.linalg.eigh(centred.T @ centred)
    side = np.zeros(len(rows), bool)
    side[np.argsort(centred @ axes[:, -1], kind="stable")[len(rows) // 2 :]] = True
    for _ in range(60):
        across = np.bincount(a, side[a] != side[b], len(rows))
        gain = 2 * across - np.bincount(a, minlength=len(rows))
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        n = min(len(left), len(right))
        good = int((gain[left[:n]] + gain[right[:n]] > 0).sum())
        before, old = int(across.sum()), side.copy()
        while good:  # swaps disturb each other, so try fewer until the cut is smaller
            side[left[:good]], side[right[:good]] = True, False
            if int((side[a] != side[b]).sum()) < before:
                break
            side, good = old.copy(), good // 2
        if not good:
            break
    return side


class Classifier:
    """One hidden layer; gives the logarithm of the odds of each part."""

    def __init__(self, x: np.ndarray, wanted: np.ndarray, hidden: int = 128, rounds: int = 25) -> None:
        random = np.random.default_rng(SEED)
        x = self._input(x)
        self.layers = [
            random.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]),
            np.zeros(hidden),
            random.standard_normal((hidden, wanted.shape[1])) * np.sqrt(1 / hidden),
            np.zeros(wanted.shape[1]),
        ]
        mean, square = [[np.zeros_like(w) for w in self.layers] for _ in range(2)]
        step = 0
        for _ in range(rounds):
            order = random.permutation(len(x))
            for at in range(0, len(x), 256):
                rows = order[at : at + 256]
                inner, out = self._forward(x[rows])
                out = np.exp(out - out.max(axis=1, keepdims=True))
                error = (out / out.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
                back = (error @ self.layers[2].T) * (inner > 0)
                slopes = [x[rows].T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0)]
                step += 1
                for k, slope in enumerate(slopes):
                    mean[k] += 0.1 * (slope - mean[k])
                    square[k] += 0.001 * (slope * slope - square[k])
                    rate = 0.002 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.layers[k] -= rate * mean[k] / (np.sqrt(square[k]) + 1e-8)

    @staticmethod
    def _input(x: np.ndarray) -> np.ndarray:
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x / size * np.sqrt(x.shape[1]), np.log(size)])

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inner = np.maximum(x @ self.layers[0] + self.layers[1], 0)
        return inner, inner @ self.layers[2] + self.layers[3]

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self._forward(self._input(x))[1]


@dataclass
class Model:
    """Parts 0 to n - 1; part n holds the longest rows. Vectors of another length have a part of their own."""

    length: int
    owner: Classifier | None
    router: Classifier | None
    long: float
    probes: int

    def part(self, x: np.ndarray) -> np.ndarray:
        odds = self.owner.odds(x)
        return np.where(np.linalg.norm(x, axis=1) > self.long, odds.shape[1], odds.argmax(axis=1))

    def visits(self, x: np.ndarray) -> np.ndarray:
        """The parts that each query is compared with, the most probable ones first."""
        odds = self.router.odds(x)
        first = np.argsort(-odds, axis=1, kind="stable")[:, : self.probes]
        return np.hstack([first, np.full((len(x), 1), odds.shape[1])])


def fit(
    rows: DataFrame,
    nearest: int = NEAREST,
    sample_rows: int = SAMPLE_ROWS,
    measured_rows: int = MEASURED_ROWS,
    parts: int = PARTS,
    recall: float = RECALL,
) -> Model:
    """Fit on (id, v) rows, of which about `sample_rows`, chosen by hash of the id, go to one task."""
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if most is None:
        return Model(0, None, None, np.inf, 0)
    share = min(1.0, sample_rows / most["count"])
    chosen = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = rows.where((F.size("v") == most["n"]) & chosen).select("id", "v")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        x = np.zeros((0, most["n"]))
        if held:
            x = matrix(pa.Table.from_batches(held).sort_by([("id", "ascending")]).column("v"))
        model = _learned(x, nearest, measured_rows, parts, recall)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # one small row comes back
    return pickle.loads(sample.repartition(1).mapInArrow(work, "model BINARY").collect()[0][0])


def _learned(x: np.ndarray, nearest: int, measured_rows: int, parts: int, recall: float) -> Model:
    if len(x) < 4 * LEAST:  # nothing to be learned: one part
        return Model(x.shape[1], None, None, np.inf, 0)
    x = x[np.random.default_rng(SEED).permutation(len(x))]
    near = graph(x, max(DEGREE, nearest))
    held = min(measured_rows, len(x) // 4)
    train = np.arange(held, len(x))
    part = cut(x, near[:, :DEGREE], parts, LEAST)
    count = int(part.max()) + 1
    owner = Classifier(x[train], np.eye(count)[part[train]])
    long = float(np.quantile(np.linalg.norm(x, axis=1), 1 - LONGEST))
    model = Model(x.shape[1], owner, None, long, count)
    given = model.part(x)
    there = np.eye(count + 1)[given][:, :count]
    wanted = there[near[train]].sum(axis=1)
    some = wanted.sum(axis=1) > 0
    model.router = Classifier(x[train][some], wanted[some] / wanted[some].sum(axis=1, keepdims=True))
    # how many parts hold enough of the nearest rows of the rows kept for measuring
    at = np.argsort(model.visits(x[:held])[:, :count], axis=1)
    in_long = given[near[:held]] == count
    place = np.take_along_axis(at, np.minimum(given[near[:held]], count - 1), axis=1)
    found = np.bincount(np.where(in_long, 0, place).ravel(), minlength=count).cumsum() / in_long.size
    model.probes = int(np.searchsorted(found, recall) + 1) if count > 1 else 1
    return model


def nearest_vectors(
    vectors: DataFrame,
    query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    sample_rows: int = SAMPLE_ROWS,
    parts: int = PARTS,
    recall: float = RECALL,
    block_rows: int = BLOCK_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """The `nearest` rows found for each row that `query` holds for: query_id, rank, vec_id, score.

    score is the inner product of the original vectors in double precision, largest first, ties to
    the smaller id; a row is no neighbour of its own id. Of equal vectors, only those with the
    smallest nearest + 1 ids can be among the nearest of any row, so the others are left out of
    the search, and equal queries are searched once.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    rows with a null id. Vectors of different length are never compared; those of other than the
    most common length are compared with all of their own. Rows that repeat an id with the same
    vector count once, those with other vectors each on its own. With fewer candidates than `nearest` all are returned.
    Further columns take no part. No vectors: no rows.
    """
    rows = vectors.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).alias("id"), F.col(vector).alias("v"), F.coalesce(query, F.lit(False)).alias("asks")
    )
    copy = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    candidates = stage(
        rows.select("id", "v").distinct().withColumn("copy", copy).where(F.col("copy") <= nearest + 1).drop("copy"),
        "candidates",
    )
    asking = rows.where("asks").select("id", "v")
    queries = asking.groupBy("v").agg(F.min("id").alias("id"))
    model = fit(candidates, nearest, sample_rows, parts=parts, recall=recall)
    placed = stage(_placed(candidates, model, False), "placed")
    visits = stage(_placed(queries, model, True), "visits")
    found = _searched(placed, visits, nearest + 1, block_rows, chunk_queries)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    lists = (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= nearest + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    )
    answers = queries.join(lists, queries["id"] == lists["query"]).select("v", "near")
    each = B.with_lookup(asking.distinct(), answers, ["v"], F.xxhash64("id"), SALTS)
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, nearest)
    return each.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "n")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("vec_id"), "n.score"
    )


def _placed(rows: DataFrame, model: Model, visiting: bool) -> DataFrame:
    """Rows with their part, or a row for each part they visit. Other lengths: part -length."""
    kind = rows.schema["id"].dataType.simpleString()
    item = rows.schema["v"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            sizes = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            known = (sizes == model.length) & (model.router is not None)
            row, part = np.flatnonzero(~known), -sizes[~known]
            if known.any():
                mine = np.flatnonzero(known)
                x = matrix(v.take(pa.array(mine)))
                to = model.visits(x) if visiting else model.part(x)[:, None]
                row = np.concatenate([row, np.repeat(mine, to.shape[1])])
                part = np.concatenate([part, to.ravel()])
            for at in range(0, len(row), 4096):
                which = pa.array(row[at : at + 4096])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(which), v.take(which), pa.array(part[at : at + 4096], pa.int32())],
                    names=["id", "v", "part"],
                )

    return rows.select("id", "v").mapInArrow(work, f"id {kind}, v {item}, part INT")


def _searched(placed: DataFrame, visits: DataFrame, most: int, block_rows: int, chunk_queries: int) -> DataFrame:
    """(query, id, score): the nearest rows of each query in each tile it takes part in."""
    kind = placed.schema["id"].dataType.simpleString()
    sizes = placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")).join(
        visits.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / chunk_queries).cast("int").alias("chunks")), "part"
    )
    sizes = stage(sizes, "tiles")
    tiles = sizes.agg(F.sum(F.col("blocks").cast("bigint") * F.col("chunks"))).first()[0] or 1
    tasks = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tiles // 8))

    def dealt(df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        return (
            B.with_lookup(df, sizes, ["part"], F.xxhash64("id"), SALTS)
            .withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
            .select("part", "block", "chunk", F.lit(own == "chunk").alias("asks"), "id", "v")
        )

    both = dealt(placed, "block", "blocks", "chunk", "chunks").union(
        dealt(visits, "chunk", "chunks", "block", "blocks")
    )
    keys = ["part", "block", "chunk"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in B.groups(batches, keys):
            starts = B.boundaries(held, keys)
            for at, to in zip(starts, [*starts[1:], held.num_rows], strict=True):
                tile = held.slice(at, to - at)
                yield from _nearest(
                    tile.filter(tile.column("asks")), tile.filter(pc.invert(tile.column("asks"))), most
                )

    grouped = both.repartition(tasks, *keys).sortWithinPartitions(*keys)
    return grouped.mapInArrow(compare, f"query {kind}, id {kind}, score DOUBLE")


def _nearest(queries: pa.Table, rows: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    if not len(queries) or not len(rows):
        return
    q, x = matrix(queries.column("v")), matrix(rows.column("v"))
    ids = rows.column("id").combine_chunks()
    order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
    asks = queries.column("id").combine_chunks()
    longest = np.linalg.norm(x, axis=1).max()
    for at in range(0, len(q), AT_ONCE):
        some = q[at : at + AT_ONCE]
        close = some @ x.T
        if len(x) > most:
            least = np.partition(close, len(x) - most, axis=1)[:, len(x) - most]
        else:
            least = close.min(axis=1)
        # a product of matrices rounds in its own way, so ones just below the last are looked at too
        slack = 1e-12 * longest * np.linalg.norm(some, axis=1)
        who, which = np.nonzero((close >= (least - slack)[:, None])[:, order])
        which = order[which]
        score = products(some[who], x[which])
        ranked = np.lexsort((np.arange(len(who)), -score, who))  # places are in order of ids
        who, which, score = who[ranked], which[ranked], score[ranked]
        begin = np.searchsorted(who, np.arange(len(some)))
        first = np.arange(len(who)) - begin[who] < most
        yield pa.RecordBatch.from_arrays(
            [asks.take(pa.array(at + who[first])), ids.take(pa.array(which[first])), pa.array(score[first])],
            names=["query", "id", "score"],
        )
