"""Groups of rows of one key, cut so that none grows beyond a bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_pairs(df: DataFrame, key: str, spread: str, size: int) -> DataFrame:
    """Rows of keys that occur twice or more, with columns part_a, part_b and part, their own part.

    A key with up to `size` rows is one group (0, 0). The rows of a larger one are dealt by a hash
    of `spread` to n parts of about that size, and each row goes to the n groups that its part
    shares with another one, so that any two rows of the key meet in at least one group.
    """
    many = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    parts = F.ceil(F.col("_rows") / size).cast("int")
    mine = F.pmod(F.xxhash64(spread, F.lit("part")), F.col("_parts")).cast("int")
    return (
        df.join(many, key)
        .withColumn("_parts", parts)
        .withColumn("part", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("part_a", F.least("part", "_other"))
        .withColumn("part_b", F.greatest("part", "_other"))
        .drop("_rows", "_parts", "_other")
    )


def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a group one after the other in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, as tables that hold one or several whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = boundaries(batch, keys)
        if held and any(
            held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys
        ):
            yield pa.Table.from_batches(held)
            held = []
        last = int(starts[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def boundaries(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups of equal keys begin."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        values = batch.column(k).to_numpy(zero_copy_only=False) if isinstance(
            batch, pa.RecordBatch
        ) else batch.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def with_lookup(df: DataFrame, small: DataFrame, keys: list[str], spread: Column, salts: int) -> DataFrame:
    """df joined with one row of `small` for each key, null keys being equal to each other.

    The rows of a key are spread over `salts` parts by `spread`, and `small` is repeated for each,
    so that a key with very many rows is no single task where the join shuffles.
    """
    salted = df.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    copies = small.select(
        *(F.col(k).alias(f"_{k}") for k in keys),
        *(c for c in small.columns if c not in keys),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy"),
    )
    on = F.col("_salt") == F.col("_copy")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return salted.join(copies, on).drop("_salt", "_copy", *(f"_{k}" for k in keys))
