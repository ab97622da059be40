"""Building blocks that keep working when one key holds a large share of all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scholia.session import cut_lineage


def first_by(df: DataFrame, keys: list, order: list, cols: list[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order``.

    ``row_number() = 1`` is planned with a group limit on the map side: every task sends one row of
    a hot key.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(w)).where(F.col("__first") == 1).select(*(cols or df.columns))


def top_k(df: DataFrame, keys: list, order: list, k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their rank.

    ``row_number() <= k`` is planned with a group limit on the map side, so at most k rows per key
    leave each task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def running_total(
    df: DataFrame, keys: list[str], pos: str, value: Column, out: str, block: int = 4096
) -> DataFrame:
    """Exclusive running sum of ``value`` per key in the order of the integer column ``pos``.

    Two levels: rows are summed inside blocks of ``block`` positions, block totals are summed per
    key, and both are added. No task ever holds more than one block of a key, however large the
    key is; blocks come from the data, so a recomputed task gives the same numbers. Without keys the
    blocks are the ranges of a distributed sort (``total_in_order``).
    """
    if not keys:
        return total_in_order(df, pos, value, out)
    b = df.withColumn("__b", F.floor(F.col(pos) / block)).withColumn("__v", value)
    totals = b.groupBy(*keys, "__b").agg(F.sum("__v").alias("__t"))
    # second level: the totals of one key, again in blocks, so this window stays short as well
    totals = totals.withColumn("__c", F.floor(F.col("__b") / block))
    inner = W.partitionBy(*keys, "__c").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__t").over(inner), F.lit(0)))
    coarse = totals.groupBy(*keys, "__c").agg(F.sum("__t").alias("__ct"))
    outer = W.partitionBy(*keys).orderBy("__c")
    coarse = coarse.withColumn(
        "__cbefore", F.coalesce(F.sum("__ct").over(outer.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).drop("__ct")
    starts = totals.join(coarse, [*keys, "__c"]).select(
        *keys, "__b", (F.col("__before") + F.col("__cbefore")).alias("__s")
    )
    within = W.partitionBy(*keys, "__b").orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    return (
        b.withColumn("__w", F.coalesce(F.sum("__v").over(within), F.lit(0)))
        .join(starts, [*keys, "__b"])
        .withColumn(out, F.col("__w") + F.col("__s"))
        .drop("__b", "__v", "__w", "__s")
    )


def total_in_order(df: DataFrame, pos: str, value: Column, out: str) -> DataFrame:
    """Exclusive running sum over all rows in the order of ``pos``.

    The rows are dealt into ranges of ``pos`` and written with the number of their range; one total a
    range comes to the driver and gives each range its start. Runs two jobs at once, reads the input
    once, and a task holds one range.
    """
    placed = df.withColumn("__v", value).repartitionByRange(F.col(pos)).withColumn("__range", F.spark_partition_id())
    placed = cut_lineage(placed)
    sums = sorted((r["__range"], r["__t"]) for r in placed.groupBy("__range").agg(F.sum("__v").alias("__t")).collect())
    starts = list(zip([p for p, _ in sums], accumulate([0, *(t for _, t in sums)])))
    starts = df.sparkSession.createDataFrame(starts, "__range int, __s bigint")  # one row a partition
    within = W.partitionBy("__range").orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("__w", F.coalesce(F.sum("__v").over(within), F.lit(0)))
        .join(F.broadcast(starts), "__range")
        .withColumn(out, F.col("__w") + F.col("__s"))
        .drop("__range", "__v", "__w", "__s")
    )


def numbered(df: DataFrame, keys: list[str], pos: str, out: str, block: int = 4096) -> DataFrame:
    """0-based dense row number per key by the unique integer ``pos``, without one big window."""
    return running_total(df, keys, pos, F.lit(1).cast("bigint"), out, block)
