"""Fusion of ranked lists, the table channel, re-ranking and context rendering.

Everything here works on short candidate lists (at most a few dozen rows per question), produced by
the searches; the corpus itself is only touched to fetch the records of the final hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from scholia import fixed
from scholia.functions.records import doi_url, first_full, rerank_bonus
from scholia.functions.text import first_doi, table_score
from scholia.operators.bm25 import Bm25Index, bm25_search
from scholia.operators.skew import top_k
from scholia.operators.vector import min_score, vector_search
from scholia.session import cut_lineage


def normalize_scores(hits: DataFrame, score: str = "score") -> DataFrame:
    """Min-max per question; 1.0 where all scores are equal."""
    w = W.partitionBy("query_id")
    lo, hi = F.min(score).over(w), F.max(score).over(w)
    return hits.withColumn(score, F.when(hi <= lo, F.lit(1.0)).otherwise((F.col(score) - lo) / (hi - lo)))


def rrf_fuse(lists: list[DataFrame], weights: list[float], k0: int = fixed.RRF_K) -> DataFrame:
    """Weighted reciprocal rank fusion of ranked lists: ``sum(w / (k0 + rank))``, normalised."""
    terms = [
        hits.select("query_id", "chunk_id", "seq", (F.lit(w) / (F.lit(k0) + F.col("rank"))).alias("term"))
        for hits, w in zip(lists, weights)
    ]
    fused = (
        reduce(DataFrame.unionByName, terms)
        .groupBy("query_id", "chunk_id", "seq").agg(F.round(F.sum("term"), 12).alias("rrf"))
        .withColumn("score", F.col("rrf"))
    )
    fused = normalize_scores(fused)
    order = W.partitionBy("query_id").orderBy(F.desc("rrf"), F.asc("seq"))
    return fused.withColumn("rank", F.row_number().over(order))


def hydrate(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Fetch the chunk records of the hits; ids without a record disappear.

    The hits (a few rows per question) are written once, so Spark knows their size: few of them travel to
    the corpus, which stays in place; many are joined by id.
    """
    hits = cut_lineage(hits)
    extra = [c for c in chunks.columns if c not in hits.columns or c == "chunk_id"]
    return chunks.select(*extra).join(hits, "chunk_id").select(
        *hits.columns, *[c for c in extra if c != "chunk_id"]
    )


def filter_table_chunks(chunks: DataFrame, threshold: float = 1.0) -> DataFrame:
    return chunks.withColumn("table_score", table_score("text")).where(F.col("table_score") >= threshold)


def table_channel(
    keyword_hits: DataFrame, semantic_hits: DataFrame, *,
    min_bm25: float = fixed.TABLE_MIN_BM25, inner_weight: float = fixed.TABLE_INNER_WEIGHT, k0: int = fixed.RRF_K,
) -> DataFrame:
    """Order table chunks that pass the keyword gate; vectors only re-rank inside the gate.

    Both inputs are top lists of the table sub-index. The semantic rank is the one in the full
    semantic list, taken before the gate. Returns the raw keyword score with the channel rank.
    """
    gated = keyword_hits.where(F.col("score") >= min_bm25)
    w = W.partitionBy("query_id").orderBy("rank")
    gated = gated.withColumn("kw_rank", F.row_number().over(w))
    sem = semantic_hits.select("query_id", "chunk_id", F.col("rank").alias("sem_rank"))
    inner = 1.0 / (k0 + F.col("kw_rank")) + F.coalesce(inner_weight / (k0 + F.col("sem_rank")), F.lit(0.0))
    joined = gated.join(sem, ["query_id", "chunk_id"], "left").select(
        "query_id", "chunk_id", "seq", F.col("score").alias("bm25"), F.round(inner, 12).alias("inner_score"), "kw_rank"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("inner_score"), F.asc("kw_rank"))
    return joined.withColumn("rank", F.row_number().over(order)).drop("kw_rank")


def reserve_slots(
    fused: DataFrame, table_ranked: DataFrame, k: int = fixed.TOP_K, *,
    slots: int = fixed.TABLE_RESERVED_SLOTS, min_bm25: float = fixed.TABLE_RESERVED_MIN_BM25,
) -> DataFrame:
    """Put up to ``slots`` confident table hits first, then the fused order, cut to ``k``."""
    sure = table_ranked.where(F.col("bm25") >= min_bm25).select("query_id", "chunk_id", F.col("rank").alias("table_rank"))
    sure = sure.join(fused.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_semi")
    sure = top_k(sure, ["query_id"], ["table_rank"], slots, "slot").drop("table_rank")
    merged = fused.withColumnRenamed("rank", "fused_rank").join(sure, ["query_id", "chunk_id"], "left")
    return top_k(merged, ["query_id"], [F.asc_nulls_last("slot"), F.asc("fused_rank")], k).withColumn(
        "reserved", F.col("slot").isNotNull()
    ).drop("slot")


def hybrid_search(
    chunks: DataFrame, index: Bm25Index, queries: DataFrame, *,
    table_chunks: DataFrame | None = None, table_index: Bm25Index | None = None,
    k: int = fixed.TOP_K, candidates: int = fixed.CANDIDATES, least: float = 0.0,
) -> DataFrame:
    """Vector, keyword and (optional) table candidates, fused, with reserved table slots."""
    n = max(candidates, k)
    semantic = vector_search(chunks, queries, n)
    keyword = bm25_search(index, queries, n)
    lists, weights = [semantic, keyword], [fixed.SEMANTIC_WEIGHT, fixed.KEYWORD_WEIGHT]
    tables = None
    if table_chunks is not None:
        # at most 80 rows per question, read by the fusion and by the reserved slots
        tables = cut_lineage(
            table_channel(
                bm25_search(table_index, queries, fixed.TABLE_CANDIDATES),
                vector_search(table_chunks, queries, fixed.TABLE_CANDIDATES),
            )
        )
        lists.append(tables)
        weights.append(fixed.TABLE_WEIGHT)
    fused = min_score(rrf_fuse(lists, weights), least)
    if tables is not None:
        fused = cut_lineage(fused)
    if tables is None:
        return fused.where(F.col("rank") <= k).withColumn("reserved", F.lit(False)).withColumnRenamed("rank", "fused_rank").withColumn("rank", F.col("fused_rank"))
    return reserve_slots(fused, tables, k)


def semantic_gate(semantic: DataFrame, keyword: DataFrame, least: float = fixed.TABLE_MIN_BM25) -> DataFrame:
    """Semantic hits that the keyword search of the same question finds too, with a sufficient score."""
    return semantic.join(min_score(keyword, least), ["query_id", "chunk_id"], "left_semi")


def diversify(hits: DataFrame, k: int = 5, paper: str = "source_pdf", score: str = "score") -> DataFrame:
    """First hit of each document in score order, then the first ``k`` documents."""
    order = [F.desc(score), F.asc("seq")]
    first = top_k(hits, ["query_id", paper], order, 1, "__r").drop("__r")
    return top_k(first, ["query_id"], order, k, "final_rank")


def rerank(hits: DataFrame, k: int = 5, paper: str = "source_pdf") -> DataFrame:
    """Score plus metadata and recency bonus, one hit per document."""
    bonus = rerank_bonus(F.col("title"), F.col("authors"), F.col("year"), F.col("doi"))
    return diversify(hits.withColumn("final_score", F.round(F.col("score") + bonus, 9)), k, paper, "final_score")


def cited_papers(hits: DataFrame) -> DataFrame:
    """Papers behind the hits of a question in order of first appearance."""
    first = hits.groupBy("query_id", "paper_id").agg(F.min("rank").alias("first_rank"), F.count("*").alias("n_hits"))
    return first.withColumn("cite_rank", F.row_number().over(W.partitionBy("query_id").orderBy("first_rank")))


def author_line(authors, shown: int = 3):
    some = F.array_join(F.slice(authors, 1, shown), ", ")
    return F.when(F.coalesce(F.size(authors), F.lit(0)) <= 0, F.lit(fixed.UNKNOWN_AUTHORS)).otherwise(
        F.concat(some, F.when(F.size(authors) > shown, F.lit(" et al.")).otherwise(F.lit("")))
    )


def build_context(hits: DataFrame, queries: DataFrame, title: str = fixed.CONTEXT_TITLE) -> DataFrame:
    """One prompt block per question from its ranked hits (at most k short rows per question)."""
    year = F.when(F.col("year").isNull() | (F.col("year") == 0), F.lit("N/A")).otherwise(F.col("year").cast("string"))
    block = F.format_string(
        "### Fragmento %d [score=%.3f, p.%d]\n**Fuente:** %s (%s) — %s\n\n%s\n",
        F.col("rank"), F.col("score"), F.col("page_number"),
        F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("paper_id")), year, author_line(F.col("authors")), F.col("text"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    blocks = hits.groupBy("query_id").agg(F.count("*").alias("n_used"), F.transform(ordered, lambda x: x["block"]).alias("b"))
    return queries.select("query_id").join(blocks, "query_id", "left").select(
        "query_id", F.coalesce("n_used", F.lit(0)).alias("n_used"),
        F.when(F.col("b").isNull(), F.lit(fixed.CONTEXT_EMPTY))
        .otherwise(F.array_join(F.concat(F.array(F.lit(title)), "b"), "\n")).alias("context"),
    )


def semantic_search(chunks: DataFrame, queries: DataFrame, k: int = 5, least: float = fixed.MIN_SCORE) -> DataFrame:
    """Vector search, score floor, records of the hits."""
    hits = min_score(vector_search(chunks, queries, k), least)
    return hydrate(hits, chunks.drop("embedding", "seq"))


def shape_sources(hits: DataFrame, excerpts: bool = False) -> DataFrame:
    """Response rows: DOI from the record or else from the text, its link, an excerpt on demand."""
    doi = F.coalesce(first_full(F.col("doi")), first_doi("text"))
    return hits.withColumn("doi", doi).withColumn("doi_url", doi_url("doi")).withColumn(
        "text", F.left("text", F.lit(300)) if excerpts else F.lit(None).cast("string")
    )


def low_quality(hits: DataFrame, queries: DataFrame, requested: bool = False) -> DataFrame:
    """Questions that should fall back to the parameter database: few hits or a weak best one."""
    per = hits.groupBy("query_id").agg(F.count("*").alias("n"), F.max("score").alias("best"))
    n = F.coalesce("n", F.lit(0))
    weak = F.lit(requested) | (n < 3) | F.coalesce(F.col("best") < 0.5, F.lit(False))
    return queries.select("query_id").join(per, "query_id", "left").select(
        "query_id", n.alias("n_hits"), "best", weak.alias("low_quality")
    )


def retrieval_probe(hits: DataFrame, expected: DataFrame, channels: list[str], k: int = fixed.TOP_K) -> DataFrame:
    """Rank of the expected chunk per question and channel, and whether it is in the top ``k``."""
    match = hits.join(expected, ["query_id", "chunk_id"]).groupBy("channel", "query_id").agg(F.min("rank").alias("rank"))
    grid = expected.withColumn("channel", F.explode(F.lit(channels)))
    return grid.join(match, ["channel", "query_id"], "left").withColumn("found", F.coalesce(F.col("rank") <= k, F.lit(False)))


def table_contamination(hits: DataFrame) -> DataFrame:
    """Table chunks among the hits of each question."""
    return hits.groupBy("query_id").agg(F.count_if(table_score("text") >= 1.0).alias("table_hits"), F.count("*").alias("n_hits"))
