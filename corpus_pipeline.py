"""From raw documents to token files: classify, deduplicate, decontaminate, mix, encode.

Each stage reads all that the one before it kept. The first four return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, mixing, near_dup, ranking, token_files
from basketry.session import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject; fitted on the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ranking.keep_good(docs, ranking.train(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may come twice."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, described by what is read back from them."""
    return token_files.token_files(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
    ("token output", token_output),
]

# Tokenising and hashing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
