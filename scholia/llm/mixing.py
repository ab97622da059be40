"""Mixing sources to target weights: each source's word budget is fitted as a subset sum over document lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from scholia.llm.common import query, table
from scholia.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all words go into the mix
MOST = 2  # times that a document is taken at most
BUCKETS = 1024  # ranges of the seeded order within one length; only the last range taken is ranked row by row
TABLE_WORDS = 1 << 17  # words, or 16 of the longest documents, that the dynamic programme's table grows to at most


def n_words(text: Column) -> Column:
    """The number of runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: a row per source.

    Sources in code-point order, null last, weigh ``weights`` in turn. Targets are the weighted shares,
    cut at ``most`` times the source's size; what is cut goes to the others by weight. So a target is
    ``least(most * size, level * weight)``, and the level follows from the sources that are cut: those
    with the least room per weight.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights)).cast("int") + 1))
    w = w.withColumn("room", F.lit(float(most)) * F.col("source_size")).withColumn("reach", F.col("room") / F.col("weight"))
    up = Window.orderBy("reach", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    on = Window.orderBy("reach", F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    w = w.withColumn("level", (F.lit(share) * total - F.coalesce(F.sum("room").over(up), F.lit(0.0))) / F.sum("weight").over(on))
    # The first source in order of reach whose share lies within its room sets the level for all after it.
    fits = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("reach", "level"))).over(Window.partitionBy(F.lit(1)))["level"]
    return w.select("source", "source_size", F.least("room", F.coalesce(fits * F.col("weight"), F.col("room"))).alias("target"))


def evenly(counts: np.ndarray, part: float, start: float) -> np.ndarray:
    """The same part of every count in whole numbers: along the lengths, one document is taken whenever the running sum of
    parts (from a seeded start) passes a whole number. So lengths that few documents have get their share too."""
    passed = np.floor(np.concatenate([[0.0], np.cumsum(counts * part)]) + start)
    return np.minimum(np.diff(passed).astype(np.int64), counts)


def knapsack(lengths: np.ndarray, free: np.ndarray, rest: int, order: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of the ``free`` documents of each length to take so that their words come nearest ``rest``, and what is then
    missing. The programme marks the sums that can be reached (counts split into powers of two), lengths in ``order``,
    and walks back from the nearest."""
    take = np.zeros(len(lengths), np.int64)
    reach = np.zeros(2 * rest + 1, bool)  # a sum beyond twice the rest is worse than none
    came, lots = np.zeros(len(reach), np.int64), np.zeros(len(reach), np.int64)
    reach[0] = True
    for i in order.tolist():
        left, lot, n = min(int(free[i]), 2 * rest // int(lengths[i])), 1, int(lengths[i])
        while left > 0 and not reach[rest]:
            lot = min(lot, left)
            step = lot * n
            new = np.flatnonzero(reach[: len(reach) - step] & ~reach[step:]) + step if step < len(reach) else []
            reach[new], came[new], lots[new] = True, i, lot  # each sum is noted when it is first reached
            left -= lot
            lot *= 2
        if reach[rest]:
            break
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    missing = rest - at
    while at:
        take[came[at]] += lots[at]
        at -= int(lots[at]) * int(lengths[came[at]])
    return take, missing


def fit(lengths: list[int], counts: list[int], budget: int, seed: int = 17) -> list[int]:
    """How many documents of each length to take, so that their words come as near ``budget`` as the
    programme can, from below or above.

    All but a few of the longest documents' words are taken evenly from every length; the rest is a bounded knapsack of the
    documents left over, lengths in a seeded order. Where no sum is exact, the even part gives back words, four times as many each
    time, until one is, nothing is left to give back, or the programme's table is full.
    """
    n, c = np.array(lengths, np.int64), np.array(counts, np.int64)
    total = int((n * c).sum())
    if budget >= total:
        return list(counts)
    rng = np.random.default_rng(seed)
    start, order = rng.random(), rng.permutation(len(n))
    slack, full, best = 4 * int(n.max()), max(TABLE_WORDS, 16 * int(n.max())), None
    by_length = np.argsort(n, kind="stable")
    while True:
        even = max(0, budget - slack)
        take = np.zeros(len(n), np.int64)
        take[by_length] = evenly(c[by_length], even / total, start if even else 0.0)
        rest = budget - int((n * take).sum())
        if rest >= 0:
            more, missing = knapsack(n, c - take, rest, order)
            if best is None or abs(missing) < best[0]:
                best = abs(missing), take + more
        if best is not None and best[0] == 0 or even == 0 or slack >= full:
            return (best[1] if best else take).tolist()
        slack *= 4


def source_key(source: Column) -> Column:
    """A key without nulls: no source's name starts like the null's."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def mix(docs: DataFrame, seed: int = 17, weights=WEIGHTS, share: float = SHARE, most: int = MOST, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, then ``copies`` (0 to ``most``)
    and ``key`` (the source).

    ``size`` is the number of words; ``taken`` is ``copies * size``. A source whose target is one time
    its size or more has every document once, and the rest of its budget goes to second copies. How many
    documents of each length get a further copy is fitted per source over the histogram of lengths; which
    ones, by a seeded hash of the id. Null texts and texts without words have size 0 and aren't taken; a
    null source is a source; ids may be null or repeat (ties of the hash are broken by the id, equal ids
    are interchangeable); an empty table gives no rows; other columns aren't read.
    """
    d = cut_lineage(docs.select(
        docs[id_col].alias("doc_id"), source_key(docs[source_col].cast("string")).alias("key"), n_words(docs[text_col].cast("string")).alias("size"),
        F.xxhash64(docs[id_col], F.lit(seed)).alias("order"),
    )).withColumn("bucket", F.shiftrightunsigned("order", 54).cast("int"))
    cells = cut_lineage(d.groupBy("key", "size", "bucket").agg(F.count("*").alias("n")))
    sizes = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    named = sizes.select(F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).alias("source"), "source_size")
    targets = cut_lineage(source_targets(named, weights, share, most).select(source_key(F.col("source")).alias("key"), "source_size", "target"))

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        size, goal = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        full = min(int(goal // size), most) if size else 0
        some = group[group["size"] > 0]
        extra = dict(zip(some["size"], fit(some["size"].tolist(), some["n"].tolist(), round(goal) - full * size, seed), strict=True)) if full < most and len(some) else {}
        return pd.DataFrame({"key": group["key"], "size": group["size"], "full": [full if s else 0 for s in group["size"]], "extra": [int(extra.get(s, 0)) for s in group["size"]]})

    # A row per source and length: a few thousand lengths, however many documents a source has.
    lengths = cells.groupBy("key", "size").agg(F.sum("n").alias("n")).join(targets, "key")
    plan = lengths.groupBy("key").applyInPandas(fitted, "key string, size bigint, full bigint, extra bigint")
    before = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = cells.join(cut_lineage(plan), ["key", "size"]).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    quota = quota.select("key", "size", "bucket", "n", "full", F.greatest(F.lit(0), F.least("n", F.col("extra") - F.col("before"))).alias("quota"))
    met = d.join(cut_lineage(quota), ["key", "size", "bucket"])
    whole = met.where("quota = 0 or quota = n").withColumn("more", (F.col("quota") > 0).cast("bigint"))
    rank = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("order", "doc_id"))
    split = met.where("quota > 0 and quota < n").withColumn("more", (rank <= F.col("quota")).cast("bigint"))
    both = whole.unionByName(split).withColumn("copies", F.col("full") + F.col("more"))
    return both.join(targets, "key").select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "key")


def mixed_documents(docs: DataFrame, seed: int = 17, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``mix`` takes it."""
    taken = mix(docs, seed, id_col=id_col, text_col=text_col, source_col=source_col)
    same_id = Window.partitionBy("m_id", "m_key", "m_size")
    taken = cut_lineage(taken.select(F.col("doc_id").alias("m_id"), F.col("key").alias("m_key"), F.col("size").alias("m_size"), "copies"))
    taken = taken.withColumn("m_nth", F.row_number().over(same_id.orderBy("copies"))).where("copies > 0")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("whole"), docs[id_col].alias("d_id"), source_key(docs[source_col].cast("string")).alias("d_key"),
        n_words(docs[text_col].cast("string")).alias("d_size"),
    )
    # Rows that share an id and a size are told apart by their number; they are interchangeable.
    rows = rows.withColumn("d_nth", F.row_number().over(Window.partitionBy("d_id", "d_key", "d_size").orderBy("d_id")))
    same_row = F.col("d_id").eqNullSafe(F.col("m_id")) & (F.col("d_key") == F.col("m_key")) & (F.col("d_size") == F.col("m_size")) & (F.col("d_nth") == F.col("m_nth"))
    met = rows.join(taken, same_row)
    return met.select("whole", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("whole.*")


@query("op9_mixing")
def op9_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))
