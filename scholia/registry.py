"""Registry of runnable queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scholia.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Tables with long texts or vectors and the columns to spread them by when their files are few.
WIDE_ROWS = {
    "documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"], "embeddings": ["vec_id"],
}


class Tables:
    """Lazy access to the parquet tables of one data directory: ``t.documents``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return spread(df, *WIDE_ROWS[name]) if name in WIDE_ROWS else df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with SQL giving the same rows."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, path: fn(Tables(spark, path))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
