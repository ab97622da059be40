"""Sequence numbers of the chunk index: append, merge, delete."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from scholia.operators.skew import numbered


def next_seq(index: DataFrame):
    """The number after the largest one, as a scalar subquery."""
    return index.agg((F.coalesce(F.max("seq"), F.lit(-1)) + 1).alias("n")).scalar()


def assign_seq(index: DataFrame, new: DataFrame, pos: str = "pos") -> DataFrame:
    """Numbers for new rows in order of ``pos``, going on after the index."""
    return numbered(new, [], pos, "__n").withColumn("seq", F.col("__n") + next_seq(index)).drop("__n")


def merge_indices(parts: list[DataFrame]) -> DataFrame:
    """All partial indices in one, numbered again in order of (part, old number)."""
    shifted, offset = [], F.lit(0)
    for part in parts:
        shifted.append(part.withColumn("__p", F.col("seq") + offset))
        offset = offset + next_seq(part)
    merged = reduce(DataFrame.unionByName, shifted)
    return numbered(merged.drop("seq"), [], "__p", "seq").drop("__p")


def delete_paper(index: DataFrame, paper_id: str) -> tuple[DataFrame, DataFrame]:
    """The index without one document, numbered densely, and the count of deleted rows."""
    gone = F.col("paper_id") == paper_id
    kept = numbered(index.where(~gone).withColumnRenamed("seq", "__p"), [], "__p", "seq").drop("__p")
    return kept, index.agg(F.count_if(gone).alias("deleted"))
