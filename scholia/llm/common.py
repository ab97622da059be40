"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholia.functions.batches import tidied, tidied_group  # noqa: F401
from scholia.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Largest side, in rows of a few numbers each, that is sent to every executor (about 16 bytes a column).
BROADCAST_ROWS = 500_000


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``, with SQL for the same rows if there is any."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under its own names; a null text is empty."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def light_side(df: DataFrame) -> tuple[DataFrame, int]:
    """A staged table of narrow rows, marked for broadcast if counting shows it under the bound; and its size."""
    staged = cut_lineage(df)
    n = staged.count()
    return (F.broadcast(staged) if n <= BROADCAST_ROWS else staged), n


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
