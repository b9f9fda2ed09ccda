"""Shards of nearly equal bytes by differencing (Karmarkar and Karp, 1982).

Texts that are equal form a group that stays together. A partial partition is a list of sums, one
for each shard; the two with the largest spread are combined, the largest sum of one with the
smallest of the other, until one is left. Tasks do this over runs of groups; the partial partitions
of the runs, a few numbers each, are combined in the same way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.session import stage

SHARDS = 8
#: Groups a task takes into one partial partition.
RUN_GROUPS = 1 << 16


def difference(partials: list[list[int]]) -> list[list[int]]:
    """Combine partial partitions; for each of them, the final place of each of its sums."""
    if not partials:
        return []
    k = len(partials[0])
    # a heap entry: spread, tie break, sums in falling order, and what lies in each of them
    heap = []
    for n, sums in enumerate(partials):
        order = sorted(range(k), key=lambda s, sums=sums: (-sums[s], s))
        ordered = [sums[s] for s in order]
        heap.append((ordered[-1] - ordered[0], n, ordered, [(n, s) for s in order]))
    heapq.heapify(heap)
    nth = len(partials)
    while len(heap) > 1:
        _, _, sums, held = heapq.heappop(heap)
        _, _, more, other = heapq.heappop(heap)
        joined = sorted(
            (
                (sums[s] + more[k - 1 - s], s, (held[s], other[k - 1 - s]))
                for s in range(k)
            ),
            key=lambda x: (-x[0], x[1]),
        )
        ordered = [x[0] for x in joined]
        entry = (ordered[-1] - ordered[0], nth, ordered, [x[2] for x in joined])
        heapq.heappush(heap, entry)
        nth += 1
    places = [[0] * k for _ in partials]
    for place, tree in enumerate(heap[0][3]):
        todo = [tree]
        while todo:
            x, y = todo.pop()
            if isinstance(x, tuple):
                todo += [x, y]
            else:
                places[x][y] = place
    return places


def _runs(shards: int, run_groups: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def closed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sizes = table.column("bytes").to_pylist()
            places = difference([[n] + [0] * (shards - 1) for n in sizes])
            return pa.RecordBatch.from_arrays(
                [
                    table.column("digest").combine_chunks(),
                    table.column("bytes").combine_chunks(),
                    pa.array(np.full(len(sizes), (part << 32) + nth), pa.int64()),
                    pa.array([p[0] for p in places], pa.int32()),
                ],
                names=["digest", "bytes", "run", "place"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, run_groups):
                held.append(batch.slice(at, run_groups))
                if sum(b.num_rows for b in held) >= run_groups:
                    yield closed()
                    nth += 1
                    held.clear()
        if any(b.num_rows for b in held):
            yield closed()

    return work


def shard_by_bytes(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    run_groups: int = RUN_GROUPS,
) -> DataFrame:
    """One row per row of documents: doc_id, size, text_crc32, shard, slot.

    size is the UTF-8 length of the text plus 1. Rows with equal texts share a shard; null texts
    are a group of their own with a checksum of 0. slot counts the rows of a shard from 0 without
    gaps, in the order of the input's partitions. One group with more than its share of the bytes
    makes its shard larger. Repeated rows and null ids are rows like others; no documents, no rows.

    The texts are read once; after that, a narrow row for each document is shuffled by digest, and
    numbering counts rows for each (input partition, shard), so no shard is one task.
    """
    spark = documents.sparkSession
    body = F.col(text).cast("string")
    rows = stage(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(body, 256)), F.lit(b"")).alias("digest"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    runs = stage(
        groups.mapInArrow(
            _runs(shards, run_groups), "digest BINARY, bytes BIGINT, run BIGINT, place INT"
        ),
        "runs",
    )
    sums: dict[int, list[int]] = {}
    for r in runs.groupBy("run", "place").agg(F.sum("bytes").alias("bytes")).collect():
        sums.setdefault(r.run, [0] * shards)[r.place] = r.bytes
    order = sorted(sums)
    places = difference([sums[run] for run in order])
    final = spark.createDataFrame(
        [
            (run, place, shard)
            for run, mine in zip(order, places, strict=True)
            for place, shard in enumerate(mine)
        ],
        "run BIGINT, place INT, shard INT",
    )
    chosen = stage(runs.join(final, ["run", "place"]).select("digest", "shard"), "groups")
    placed = stage(rows.join(chosen, "digest").drop("digest"), "placed")
    before = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(
        "part", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("part", "shard").orderBy("at")
    return (
        placed.withColumn("nth", F.row_number().over(within) - 1)
        .join(before, ["part", "shard"])
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("nth")).alias("slot")
        )
    )
