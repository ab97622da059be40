"""A corpus pipeline: each stage's result is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholia.llm import bpe, jaccard, mixing, toxicity
from scholia.llm.exact_dedup import drop_exact_copies
from scholia.session import work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, predicts to be toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays that sets of five-word shingles with a similarity of 0.8 link."""
    return jaccard.one_of_each_group(docs, jaccard.Rule(words=5, num=8, den=10))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a document is left out, taken once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with the digest of the decoded text."""
    return bpe.token_digests(docs, bpe.default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("bpe", encode),
]

ORACLE_SQL = None  # a trained classifier, similarity joins and a fitted mix aren't expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
