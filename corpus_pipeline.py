"""From raw documents to packed training sequences, in stages that are written one by one.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns they came
with; the last returns pieces of sequences. A document that fails a stage is gone for the next ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm import decontam, lines, neardup, packing, quality
from roadbook.llm.shared import ship_package, stored
from roadbook.llm.words import unused_name

LEAST_QUALITY = 0.5


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours do not reject."""
    ship_package(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused_name(docs, "score")
    kept = quality.with_score(docs, model, score).where(F.col(score) >= LEAST_QUALITY)
    return kept.select(*_columns(docs))


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id has. n_chars follows the text.

    A document that loses lines and has no word left is gone: it says nothing that others do not.
    """
    ship_package(spark)
    kept = lines.dedup_lines(docs)
    dropped = F.col(f"`{kept.columns[-1]}`")
    kept = kept.where((dropped == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*_columns(docs))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return kept


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates: five words, similarity 0.8."""
    ship_package(spark)
    return neardup.one_of_each(docs, percent=80, shingle=5)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    ship_package(spark)
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their token ids."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_documents),
    ("line_dedup", first_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", clean_of_benchmarks),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


# Scores, similarity joins and tokenizers are beyond SQL; tests check each stage by brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
CHECKED_BY: dict[str, str] = {}
