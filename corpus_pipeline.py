"""From raw documents to token ids: quality, language, near-duplicates, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows it is given, and returns those it keeps
with the columns they came with; the last one returns the encoded documents. `run` writes each
stage's rows to the shared folder and reads them again for the next. Stages keep further columns,
null values and repeated rows as they are; no documents give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontaminate, languages, pieces, simhash
from footfall.llm import quality as votes
from footfall.llm.queries import QUALITY_THRESHOLD, quality_model
from footfall.session import ship, stage

#: One document in so many is held out, to see what fit the learned languages reach.
FOLDS = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row, which passes through under one name."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the neighbours' votes find poor."""
    ship(spark)
    model = quality_model(docs, _table(spark, sf_dir, "labels"))
    scored = votes.score_documents(_packed(docs), model, keep=("row",))
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language, and those in none of the learned ones.

    The languages are learned from four fifths of the documents. A document is dropped if its mean
    log likelihood a trigram, under its best set of languages, lies more than three standard errors
    below a bound: chance, plus a quarter of what held-out documents of its language gain over it.
    """
    ship(spark)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == 0, F.lit(False))
    model = languages.learn(docs.where(~held_out))
    least = languages.least_fits(docs.where(held_out), model)
    found = languages.identify(_packed(docs), model, keep=("row",), fit=True)
    return found.where(languages.in_a_learned_language(least)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest id."""
    ship(spark)
    # numbered rows are stored, so that a number means the same row in both passes over them
    rows = stage(_packed(docs).withColumn("number", F.monotonically_increasing_id()), "numbered")
    groups = simhash.near_duplicates(rows.select("number", "text"), "number", "text")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "number")
    kept = (
        groups.select(F.col("doc_id").alias("number"), "component_id")
        .join(rows.select("number", "doc_id"), "number")
        .groupBy("component_id")
        .agg(F.min(first).alias("first"))
        .select("first.number")
    )
    return rows.join(kept, "number", "left_semi").select("row.*")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which one word in twenty or more lies in a benchmark passage."""
    ship(spark)
    found = decontaminate.find_benchmark(
        _packed(docs), _table(spark, sf_dir, "benchmark"), keep=("row",)
    )
    return found.where(~decontaminate.contaminated()).select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of the text decoded from them."""
    ship(spark)
    coded = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding", encoding),
]

#: Trained models and a tokenizer: no SQL for it; tests hold it against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over all documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
