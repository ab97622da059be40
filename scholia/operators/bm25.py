"""BM25 index tables and batch search."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from scholia import fixed
from scholia.functions.text import tokenize
from scholia.operators.skew import top_k
from scholia.operators.vector import TopK, hits_schema
from scholia.session import cut_lineage

QUESTIONS_PER_SCAN = 2000
SCORE_CELLS = 4_000_000


@dataclass
class Bm25Index:
    """``bags(chunk_id, seq, tokens)`` (one row per chunk), ``terms(term, df, idf)`` and the one-row
    ``corpus(n, avgdl)``. All searches score the bags where they lie; ``postings`` is their inverted form."""

    bags: DataFrame
    terms: DataFrame
    corpus: DataFrame
    k1: float = fixed.BM25_K1
    b: float = fixed.BM25_B

    @property
    def postings(self) -> DataFrame:
        """``seq, dl, term, tf``, counted within each chunk."""
        rows = self.bags.select("seq", F.array_sort("tokens").alias("t"), F.size("tokens").alias("n")).where("n > 0")
        # where runs of one term begin, and where the next one does
        runs = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: (i == 0) | (F.get("t", i) != F.get("t", i - 1)))
        rows = rows.select("seq", "t", "n", runs.alias("a")).withColumn("b", F.concat(F.slice("a", 2, 1 << 30), F.array("n")))
        x = F.transform(F.arrays_zip("a", "b"), lambda r: F.struct(F.get("t", r["a"]).alias("term"), (r["b"] - r["a"]).cast("bigint").alias("tf")))
        return exploded(rows.select("seq", F.col("n").cast("bigint").alias("dl"), x.alias("x")), ["seq", "dl"], "x", "y").select("seq", "dl", "y.term", "y.tf")


def exploded(df: DataFrame, keep: list[str], array: str, name: str) -> DataFrame:
    """One row per element. The outer form keeps Spark from evaluating the array a second time in
    an inferred filter."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def bm25_index(
    chunks: DataFrame, text: str = "text", *,
    k1: float = fixed.BM25_K1, b: float = fixed.BM25_B, epsilon: float = fixed.BM25_EPSILON,
) -> Bm25Index:
    """Index of a chunk table (``chunk_id``, unique ``seq``, text).

    The statistics take one scan and are written at once (one row per distinct term): each chunk counts its distinct terms, and a null term stands for
    the chunk itself, so document frequencies, corpus size and total length come out of the same
    pre-aggregated count. No text is shuffled; a term that occurs everywhere costs a row per task.
    """
    bags = chunks.select("chunk_id", "seq", tokenize(text).alias("tokens"))
    sized = bags.withColumn("dl", F.size("tokens").cast("bigint"))
    per_chunk = F.concat(F.array_distinct("tokens"), F.array(F.lit(None).cast("string")))
    counts = sized.select("dl", F.explode_outer(per_chunk).alias("term")).groupBy("term").agg(F.count("*").alias("df"), F.sum("dl").alias("length"))
    counts = cut_lineage(counts)
    corpus = counts.where(F.col("term").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n"), (F.sum("length") / F.sum("df")).alias("avgdl"))
    terms = term_idf(counts.where(F.col("term").isNotNull()).select("term", "df"), corpus, epsilon)
    return Bm25Index(bags, terms, corpus, k1, b)


def term_idf(df: DataFrame, corpus: DataFrame, epsilon: float) -> DataFrame:
    """Inverse document frequency; a negative one becomes ``epsilon`` times the mean."""
    n = corpus.select(F.col("n").cast("double")).scalar()
    raw = df.withColumn("raw", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    floor = raw.agg((F.avg("raw") * epsilon).alias("floor")).scalar()
    return raw.select("term", "df", F.when(F.col("raw") < 0, floor).otherwise(F.col("raw")).alias("idf"))


def query_terms(queries: DataFrame, text: str = "question") -> DataFrame:
    """Terms of each question with their number of occurrences (repeats count)."""
    terms = exploded(queries.select("query_id", tokenize(text).alias("tokens")), ["query_id"], "tokens", "term")
    return terms.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def _score_task(block, k: int, k1: float, b: float, avgdl: float):
    """Token lists in, the task's own top k per question out: a sparse product per batch."""

    def run(batches):
        qids, vocabulary, first, question, weight = block.value
        top = TopK(k)
        step = max(1, SCORE_CELLS // max(1, len(qids)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                lists = batch.column("tokens")
                length = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                term = pc.index_in(lists.flatten(), vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                chunk = np.repeat(np.arange(len(length)), length)[term >= 0]
                key, tf = np.unique(chunk * len(vocabulary) + term[term >= 0], return_counts=True)
                chunk, term = np.divmod(key, max(1, len(vocabulary)))
                impact = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[chunk] / avgdl))
                fan = first[term + 1] - first[term]
                place = np.repeat(first[term] - np.r_[0, np.cumsum(fan)[:-1]], fan) + np.arange(fan.sum()) if len(fan) else np.zeros(0, np.int64)
                cell = question[place] * len(length) + np.repeat(chunk, fan)
                scores = np.bincount(cell, weight[place] * np.repeat(impact, fan), len(qids) * len(length))
                scores = np.round(scores.reshape(len(qids), len(length)), 9)
                top.add(scores, batch.column("seq").to_numpy(zero_copy_only=False), batch.column("chunk_id"), above=0.0)
        yield from top.batches(qids)

    return run


def _scan_search(index: Bm25Index, queries: DataFrame, k: int, text: str, per_scan: int) -> DataFrame:
    """Score all chunks where they lie; only k rows per question and task are shuffled."""
    spark = queries.sparkSession
    wanted = query_terms(queries, text)
    n_blocks = max(1, math.ceil(queries.select("query_id").distinct().count() / per_scan))
    avgdl = float(index.corpus.first()["avgdl"] or 1.0)
    corpus = index.bags.select("chunk_id", F.col("seq").cast("bigint").alias("seq"), "tokens")
    found = []
    for number in range(n_blocks):
        part = wanted if n_blocks == 1 else wanted.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == number)
        table = index.terms.join(part, "term").select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight")).toArrow()
        asked = table.column("query_id").combine_chunks().dictionary_encode()
        question = asked.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        coded = table.column("term").combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(term, kind="stable")
        first = np.searchsorted(term[order], np.arange(len(coded.dictionary) + 1))
        block = (asked.dictionary, coded.dictionary, first, question[order], table.column("weight").to_numpy()[order])
        found.append(corpus.mapInArrow(_score_task(spark.sparkContext.broadcast(block), k, index.k1, index.b, avgdl), hits_schema(queries)))
    return top_k(reduce(DataFrame.unionByName, found), ["query_id"], [F.desc("score"), F.asc("seq")], k)


def bm25_search(index, queries: DataFrame, k: int = 20, text: str = "question", per_scan: int = QUESTIONS_PER_SCAN) -> DataFrame:
    """The ``k`` best chunks per question, none without a positive score.

    Over a ``Bm25Index``, which isn't saved, every task multiplies its chunks with the weighted questions (sent in blocks of at
    most ``per_scan`` questions) and keeps its own k best; no (question, chunk) table exists. A saved ``PostingIndex``
    reads the posting blocks that can matter.
    """
    if not isinstance(index, Bm25Index):
        return index.search(queries, k, text)
    return _scan_search(index, queries, k, text, per_scan)
