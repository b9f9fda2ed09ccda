"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    brown,
    codes,
    decontaminate,
    divergence,
    frames,
    languages,
    licenses,
    neighbours,
    pieces,
    quality,
    shards,
    simhash,
    vectors,
)
from footfall.session import ship


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fifth(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id is an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def op1_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based language model scores of all texts."""
    documents = _read(spark, sf_dir, "documents")
    model = brown.fit(documents.where(_fifth() != 1))
    return brown.score(documents, model).select(
        "doc_id",
        (_fifth() == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op2_pstable_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors."""
    return vectors.near_vectors(_read(spark, sf_dir, "embeddings"))


def op3_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact SentencePiece ids of all texts, and the texts decoded from them."""
    coded = pieces.encode_documents(
        _read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in documents."""
    found = decontaminate.find_benchmark(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op5_segment_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by SimHash."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


QUALITY_THRESHOLD = 0.3


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.Model:
    """Fitted on labelled documents outside the held-out fifth."""
    return quality.fit(documents, labels.where(_fifth() != 0))


def op6_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of documents."""
    documents = _read(spark, sf_dir, "documents")
    model = quality_model(documents, _read(spark, sf_dir, "labels"))
    return quality.score_documents(documents, model).select(
        "doc_id",
        (_fifth() == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of documents."""
    documents = _read(spark, sf_dir, "documents")
    model = languages.learn(documents.where(_fifth() != 0))
    return languages.identify(documents, model).select(
        "doc_id",
        (_fifth() == 0).alias("held_out"),
        "lang_pred",
        "score",
        "languages",
        "proportions",
    )


def op7_zstd_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids read back from seekable compressed files."""
    return frames.encoded_and_read(
        _read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    ).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in documents."""
    documents = _read(spark, sf_dir, "documents")
    return licenses.licences(documents, licenses.fit(documents)).select(
        "doc_id",
        F.array_join("families", ",").alias("families"),
        F.col("n_notices").cast("bigint").alias("n_notices"),
        "probability",
    )


def op9_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards of nearly equal bytes."""
    return shards.shard_by_bytes(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_segment_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language differ, and by which terms."""
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every twentieth one."""
    return neighbours.nearest_vectors(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_sequency_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as codes of four bytes."""
    return codes.quantised(_read(spark, sf_dir, "embeddings"))


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: _query(f)
        for f in (
            op1_brown_classes,
            op2_pstable_hashing,
            op3_piece_backtracking,
            op4_wu_manber,
            op5_segment_popcount,
            op6_neighbour_votes,
            op7_zstd_frames,
            op8_licence_paragraphs,
            op9_karmarkar_karp,
            op10_language_mixture,
            op11_segment_trees,
            op12_learned_partitions,
            op13_sequency_codes,
        )
    }


def oracle_sql() -> dict[str, str]:
    from footfall.llm import oracles

    return oracles.oracle_sql()
