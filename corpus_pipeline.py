"""The corpus pipeline: each stage takes all documents that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    decontaminate,
    line_dedup,
    quality_rules,
    sentencepiece_codec,
    simhash,
)
from tidewater.llm.queries import model_path
from tidewater.sources.checkpoint import delete_folder, new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_clean(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of a lesser id holds."""
    return line_dedup.without_shared_lines(docs)


def keep_firsts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_first(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.keep_uncontaminated(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document that is left, and the digest of what they decode to."""
    coded = sentencepiece_codec.tokenize(docs, model_path())
    digest = F.sha2(F.col("decoded").cast("binary"), 256)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        digest.alias("decoded_sha256"),
        "agrees",
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", keep_firsts),
    ("benchmark_decontamination", keep_uncontaminated),
    ("sentencepiece", encode),
]

# Robust estimates and token merges are beyond SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written before it is read again.

    A stage's files go when the next stage is written. Those of the last written stage stay, since
    the result reads them.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
