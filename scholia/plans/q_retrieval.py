"""Retrieval queries: vector and keyword search, fusion, table channel, context."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.operators import hybrid as H, index as I, neardup as N
from scholia.operators.bm25 import bm25_index, bm25_search, query_terms
from scholia.operators.skew import top_k
from scholia.operators.vector import min_score, vector_search
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import bm25, fx as sql, vector
from scholia.plans.q_stats import marked_chunks, rounded
from scholia.plans.q_text import TABLE_SCORE
from scholia.registry import Tables, query
from scholia.session import cut_lineage, work_path
from scholia.sources.tables import read_balls, read_postings, write_balls, write_postings

MARKED = "SELECT * REPLACE (CASE WHEN seq % 5 = 0 THEN 'Table ' || chunk_index || ' ' || text || ' ' || seq || ' 12.5 7' ELSE text END AS text) FROM hybrid_chunks"
TABLES_ONLY = f"SELECT * FROM (SELECT *, {TABLE_SCORE} AS table_score FROM marked) WHERE table_score >= 1"


def ranked(df: DataFrame, *cols: str) -> DataFrame:
    """Scores rounded, ranks as long: the shape the comparison expects."""
    return rounded(df.select(*[F.col(c).cast("bigint").alias(c) if c.endswith("rank") else F.col(c) for c in cols]))


@query("r02_bm25_search", sql("bm25_ranked", "SELECT query_id, chunk_id, rank::BIGINT AS rank, round(score, 6) AS score FROM bm25_ranked WHERE rank <= 5 AND score > 0"))
def r02(t: Tables) -> DataFrame:
    return ranked(bm25_search(bm25_index(fx.chunks(t)), fx.questions(t), 5), "query_id", "chunk_id", "rank", "score")


@query("r02_pruned_search", sql("bm25_ranked", "SELECT query_id, chunk_id, rank::BIGINT AS rank, round(score, 6) AS score FROM bm25_ranked WHERE rank <= 5 AND score > 0"))
def r02_pruned(t: Tables) -> DataFrame:
    return ranked(bm25_search(saved_postings(t), fx.questions(t), 5), "query_id", "chunk_id", "rank", "score")


def saved_postings(t: Tables):
    path = work_path(t.spark, "postings")
    write_postings(bm25_index(fx.chunks(t)), path)
    return read_postings(t.spark, path)


@query("j08_saved_join", sql("query_terms postings term_stats", """
SELECT query_id, count(*) AS matches, sum(tf)::BIGINT AS tf, round(sum(qtf * idf), 6) AS weight FROM query_terms JOIN postings USING (term) JOIN term_stats USING (term) GROUP BY query_id"""))
def j08_saved(t: Tables) -> DataFrame:
    """The same join over the saved blocks: only those of the questions' terms are read."""
    index, terms = saved_postings(t), query_terms(fx.questions(t))
    asked = index.weighted(fx.questions(t))
    met = index.reached(asked).select("term", "n", F.aggregate("tfs", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tf"))
    hits = met.join(terms, "term").join(index.terms, "term")
    return rounded(hits.groupBy("query_id").agg(F.sum("n").alias("matches"), F.sum("tf").alias("tf"), F.sum(F.col("qtf") * F.col("idf") * F.col("n")).alias("weight")))


@query("j08_bm25_join", sql("query_terms postings term_stats", """
SELECT query_id, count(*) AS matches, sum(tf)::BIGINT AS tf, round(sum(qtf * idf), 6) AS weight FROM query_terms JOIN postings USING (term) JOIN term_stats USING (term) GROUP BY query_id"""))
def j08(t: Tables) -> DataFrame:
    index = bm25_index(fx.chunks(t))
    hits = index.postings.join(index.terms.join(query_terms(fx.questions(t)), "term"), "term")
    return rounded(hits.groupBy("query_id").agg(F.count("*").alias("matches"), F.sum("tf").alias("tf"), F.sum(F.col("qtf") * F.col("idf")).alias("weight")))


@query("r01_vector_search", sql("question_vectors vectors", "SELECT query_id, chunk_id, rank, round(score, 6) AS score FROM v_ranked WHERE rank <= 5", **vector("v", "vectors")))
def r01(t: Tables) -> DataFrame:
    return ranked(vector_search(fx.vectors(t), fx.question_vectors(t), 5), "query_id", "chunk_id", "rank", "score")


@query("r01_vector_search_l2", sql("question_vectors vectors", """
SELECT query_id, chunk_id, rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seq) AS rank FROM (
  SELECT query_id, chunk_id, seq, round(1 / (1 + 2 - 2 * list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[])), 9) AS score FROM question_vectors q, vectors v)) WHERE rank <= 5"""))
def r01_l2(t: Tables) -> DataFrame:
    return ranked(vector_search(fx.vectors(t), fx.question_vectors(t), 5, "l2"), "query_id", "chunk_id", "rank", "score")


@query("r01_ball_search", sql("question_vectors vectors", "SELECT query_id, chunk_id, rank, round(score, 6) AS score FROM v_ranked WHERE rank <= 5", **vector("v", "vectors")))
def r01_balls(t: Tables) -> DataFrame:
    """The same hits out of a saved index, which opens only cells whose ball can hold them."""
    path = work_path(t.spark, "balls")
    write_balls(fx.vectors(t), path)
    return ranked(vector_search(read_balls(t.spark, path), fx.question_vectors(t), 5), "query_id", "chunk_id", "rank", "score")


@query("p12_min_score", sql("question_vectors vectors", "SELECT query_id, chunk_id, rank, round(score, 6) AS score FROM v_ranked WHERE rank <= 20 AND score >= 0.6", **vector("v", "vectors")))
def p12(t: Tables) -> DataFrame:
    return ranked(min_score(vector_search(fx.vectors(t), fx.question_vectors(t), 20), 0.6), "query_id", "chunk_id", "rank", "score")


@query("k06_topk_per_group", sql("chunks", """
SELECT lang, chunk_id, rank FROM (SELECT lang, chunk_id, row_number() OVER (PARTITION BY lang ORDER BY length(text) DESC, seq) AS rank FROM chunks) WHERE rank <= 50"""))
def k06(t: Tables) -> DataFrame:
    c = fx.chunks(t).select("lang", "chunk_id", "seq", F.length("text").alias("n"))
    return ranked(top_k(c, ["lang"], [F.desc("n"), F.asc("seq")], 50), "lang", "chunk_id", "rank")


@query("w11_normalize_scores", sql("bm25_ranked", """
SELECT query_id, chunk_id, round(CASE WHEN hi <= lo THEN 1.0 ELSE (score - lo) / (hi - lo) END, 6)::DOUBLE AS score FROM (
  SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM bm25_ranked WHERE rank <= 30 AND score > 0)"""))
def w11(t: Tables) -> DataFrame:
    return rounded(H.normalize_scores(bm25_search(bm25_index(fx.chunks(t)), fx.questions(t), 30)).select("query_id", "chunk_id", "score"))


@query("w12_diversify", sql("question_vectors vectors", """
SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS final_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, paper_id ORDER BY rank) AS rn FROM v_ranked JOIN vectors USING (chunk_id) WHERE rank <= 30) WHERE rn = 1 QUALIFY final_rank <= 3""", **vector("v", "vectors")))
def w12(t: Tables) -> DataFrame:
    v = fx.vectors(t)
    hits = H.hydrate(vector_search(v, fx.question_vectors(t), 30), v.select("chunk_id", "paper_id"))
    return ranked(H.diversify(hits, 3, "paper_id"), "query_id", "chunk_id", "final_rank")


@query("w13_cited_papers", sql("question_vectors vectors", """
SELECT query_id, paper_id, first_rank, n_hits, row_number() OVER (PARTITION BY query_id ORDER BY first_rank) AS cite_rank FROM (
  SELECT query_id, paper_id, min(rank) AS first_rank, count(*) AS n_hits FROM v_ranked JOIN vectors USING (chunk_id) WHERE rank <= 30 GROUP BY ALL)""", **vector("v", "vectors")))
def w13(t: Tables) -> DataFrame:
    v = fx.vectors(t)
    hits = H.hydrate(vector_search(v, fx.question_vectors(t), 30), v.select("chunk_id", "paper_id"))
    return ranked(H.cited_papers(hits), "query_id", "paper_id", "first_rank", "n_hits", "cite_rank")


RRF = """
SELECT query_id, chunk_id, seq, rrf, CASE WHEN hi <= lo THEN 1.0 ELSE (rrf - lo) / (hi - lo) END AS score, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, seq) AS rank FROM (
  SELECT *, min(rrf) OVER (PARTITION BY query_id) AS lo, max(rrf) OVER (PARTITION BY query_id) AS hi FROM (
    SELECT query_id, chunk_id, seq, round(sum(term), 12) AS rrf FROM ({lists}) GROUP BY ALL))"""
TWO_LISTS = "SELECT query_id, chunk_id, seq, 0.6::DOUBLE / (60 + rank) AS term FROM v_ranked WHERE rank <= 30 UNION ALL SELECT query_id, chunk_id, seq, 0.4::DOUBLE / (60 + rank) FROM k_ranked WHERE rank <= 30 AND score > 0"
HYBRID = {"marked": MARKED, **vector("v", "marked"), **bm25("k", "marked", "question_vectors")}


@query("r03_rrf_fuse", sql("hybrid_chunks question_vectors", "SELECT query_id, chunk_id, rank, round(score, 6)::DOUBLE AS score FROM fused", **HYBRID, fused=RRF.format(lists=TWO_LISTS)))
def r03(t: Tables) -> DataFrame:
    c, q = cut_lineage(marked_hybrid(t)), fx.question_vectors(t)
    fused = H.rrf_fuse([vector_search(c, q, 30), bm25_search(bm25_index(c), q, 30)], [0.6, 0.4])
    return ranked(fused, "query_id", "chunk_id", "rank", "score")


def marked_hybrid(t: Tables) -> DataFrame:
    n = t.embeddings.agg(F.count("*").alias("n"))
    c = marked_chunks(t).withColumn("vec_id", F.pmod("seq", n.scalar()))
    return c.join(t.embeddings.select("vec_id", "embedding"), "vec_id").drop("vec_id")


CHANNEL = {
    "tables_only": TABLES_ONLY, **vector("tv", "tables_only"), **bm25("tk", "tables_only", "question_vectors"),
    "channel": """SELECT query_id, chunk_id, seq, bm25, inner_score, row_number() OVER (PARTITION BY query_id ORDER BY inner_score DESC, kr) AS rank FROM (
      SELECT g.query_id, g.chunk_id, g.seq, g.score AS bm25, g.rank AS kr, round(1.0::DOUBLE / (60 + g.rank) + coalesce(0.5::DOUBLE / (60 + s.rank), 0), 12) AS inner_score
      FROM (SELECT * FROM tk_ranked WHERE rank <= 80 AND score >= 5) g LEFT JOIN (SELECT * FROM tv_ranked WHERE rank <= 80) s USING (query_id, chunk_id))""",
}


def channel(t: Tables, c: DataFrame, q: DataFrame) -> DataFrame:
    tables = cut_lineage(H.filter_table_chunks(c))
    return H.table_channel(bm25_search(bm25_index(tables), q, 80), vector_search(tables, q, 80))


@query("r04_table_channel", sql("hybrid_chunks question_vectors", "SELECT query_id, chunk_id, rank, round(bm25, 6) AS bm25, round(inner_score, 9) AS inner_score FROM channel", marked=MARKED, **CHANNEL))
def r04(t: Tables) -> DataFrame:
    out = channel(t, cut_lineage(marked_hybrid(t)), fx.question_vectors(t))
    return out.select("query_id", "chunk_id", F.col("rank").cast("bigint").alias("rank"), F.round("bm25", 6).alias("bm25"), F.round("inner_score", 9).alias("inner_score"))


@query("j10_semantic_gate", sql("hybrid_chunks question_vectors", """
SELECT s.query_id, s.chunk_id, s.rank FROM tv_ranked s SEMI JOIN (SELECT query_id, chunk_id FROM tk_ranked WHERE rank <= 80 AND score >= 5) g ON s.query_id = g.query_id AND s.chunk_id = g.chunk_id WHERE s.rank <= 80""", marked=MARKED, **CHANNEL))
def j10(t: Tables) -> DataFrame:
    tables, q = cut_lineage(H.filter_table_chunks(marked_hybrid(t))), fx.question_vectors(t)
    return ranked(H.semantic_gate(vector_search(tables, q, 80), bm25_search(bm25_index(tables), q, 80), 5.0), "query_id", "chunk_id", "rank")


THREE_LISTS = TWO_LISTS + " UNION ALL SELECT query_id, chunk_id, seq, 0.5::DOUBLE / (60 + rank) FROM channel"
SLOTS = """
SELECT query_id, chunk_id, seq, score, slot IS NOT NULL AS reserved, row_number() OVER (PARTITION BY query_id ORDER BY slot NULLS LAST, rank) AS final_rank FROM fused LEFT JOIN (
  SELECT query_id, chunk_id, slot FROM (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS slot FROM channel WHERE bm25 >= 15) WHERE slot <= 2) USING (query_id, chunk_id)"""
FULL = {**HYBRID, **CHANNEL, "fused": RRF.format(lists=THREE_LISTS), "slotted": SLOTS}


@query("r05_reserve_slots", sql("hybrid_chunks question_vectors", "SELECT query_id, chunk_id, final_rank AS rank, reserved, round(score, 6)::DOUBLE AS score FROM slotted WHERE final_rank <= 8", **FULL))
def r05(t: Tables) -> DataFrame:
    c, q = cut_lineage(marked_hybrid(t)), fx.question_vectors(t)
    tables = cut_lineage(channel(t, c, q))
    fused = cut_lineage(H.rrf_fuse([vector_search(c, q, 30), bm25_search(bm25_index(c), q, 30), tables], [0.6, 0.4, 0.5]))
    return ranked(H.reserve_slots(fused, tables, 8), "query_id", "chunk_id", "rank", "reserved", "score")


def hybrid_hits(t: Tables) -> DataFrame:
    c, q = cut_lineage(marked_hybrid(t)), fx.question_vectors(t)
    tables = cut_lineage(H.filter_table_chunks(c))
    return H.hybrid_search(c, bm25_index(c), q, table_chunks=tables, table_index=bm25_index(tables))


@query("r06_hybrid_search", sql("hybrid_chunks question_vectors", """
SELECT query_id, chunk_id, final_rank AS rank, reserved, round(score, 6)::DOUBLE AS score, paper_id, length(text) AS n FROM slotted JOIN marked USING (chunk_id) WHERE final_rank <= 8""", **FULL))
def r06(t: Tables) -> DataFrame:
    hits = H.hydrate(hybrid_hits(t), marked_chunks(t).select("chunk_id", "paper_id", "text"))
    return ranked(hits.withColumn("n", F.length("text").cast("bigint")), "query_id", "chunk_id", "rank", "reserved", "score", "paper_id", "n")


@query("j09_hydrate", sql("bm25_ranked chunks", "SELECT query_id, b.chunk_id, rank, paper_id, c.text FROM bm25_ranked b JOIN chunks c ON c.chunk_id = b.chunk_id WHERE rank <= 3 AND score > 0 AND lang = 'en'"))
def j09(t: Tables) -> DataFrame:
    c = fx.chunks(t)
    known = c.where(F.col("lang") == "en").select("chunk_id", "paper_id", "text")
    return ranked(H.hydrate(bm25_search(bm25_index(c), fx.questions(t), 3), known), "query_id", "chunk_id", "rank", "paper_id", "text")


def described(t: Tables) -> DataFrame:
    """Hybrid chunks with the bibliographic fields of their article."""
    meta = fx.articles(t).select(F.col("pos").alias("doc_id"), "title", "authors", "year", "doi")
    return fx.hybrid_chunks(t).join(meta, "doc_id")


META = "SELECT h.*, title, authors, year, doi FROM hybrid_chunks h JOIN articles ON pos = doc_id"


@query("r07_semantic_search", sql("hybrid_chunks articles question_vectors", """
SELECT query_id, chunk_id, rank, round(score, 6) AS score, title, year, text FROM v_ranked JOIN meta USING (chunk_id) WHERE rank <= 5 AND score >= 0.2""", meta=META, **vector("v", "hybrid_chunks")))
def r07(t: Tables) -> DataFrame:
    return ranked(H.semantic_search(described(t), fx.question_vectors(t), 5), "query_id", "chunk_id", "rank", "score", "title", "year", "text")


CONTEXT = """
SELECT q.query_id, coalesce(n, 0) AS n_used, coalesce('## Fragmentos de papers científicos relevantes' || chr(10) || chr(10) || body, 'No se encontraron fragmentos relevantes en el índice.') AS context
FROM question_vectors q LEFT JOIN (SELECT query_id, count(*) AS n, string_agg(printf('### Fragmento %d [score=%.3f, p.%d]', rank, score, page_number) || chr(10) ||
   '**Fuente:** ' || coalesce(nullif(title, ''), paper_id) || ' (' || coalesce(year::VARCHAR, 'N/A') || ') — ' || CASE WHEN len(authors) > 0 THEN array_to_string(authors[1:3], ', ') ELSE 'Autores desconocidos' END
   || chr(10) || chr(10) || text || chr(10), chr(10) ORDER BY rank) AS body
  FROM v_ranked JOIN meta USING (chunk_id) WHERE rank <= 5 AND score >= 0.7 GROUP BY query_id) b ON b.query_id = q.query_id"""


@query("f34_build_context", sql("hybrid_chunks articles question_vectors", CONTEXT, meta=META, **vector("v", "hybrid_chunks")))
def f34(t: Tables) -> DataFrame:
    q = fx.question_vectors(t)
    return H.build_context(H.semantic_search(described(t), q, 5, 0.7), q)


@query("r08_rerank", sql("hybrid_chunks articles question_vectors", """
SELECT query_id, chunk_id, round(final_score, 6) AS final_score, row_number() OVER (PARTITION BY query_id ORDER BY final_score DESC, seq) AS final_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, source_pdf ORDER BY final_score DESC, seq) AS rn FROM (
    SELECT v.query_id, v.chunk_id, v.seq, m.source_pdf, round(score + CASE WHEN title <> '' THEN 0.02 ELSE 0 END + CASE WHEN len(authors) > 0 THEN 0.02 ELSE 0 END + CASE WHEN year <> 0 THEN 0.02 ELSE 0 END
      + CASE WHEN doi <> '' THEN 0.01 ELSE 0 END + CASE WHEN year >= 2000 THEN (year - 2000) * 0.001 ELSE 0 END, 9)::DOUBLE AS final_score
    FROM v_ranked v JOIN meta m ON m.chunk_id = v.chunk_id WHERE rank <= 20)) WHERE rn = 1 QUALIFY final_rank <= 5""", meta=META, **vector("v", "hybrid_chunks")))
def r08(t: Tables) -> DataFrame:
    hits = H.semantic_search(described(t), fx.question_vectors(t), 20, 0.0)
    return ranked(H.rerank(hits, 5), "query_id", "chunk_id", "final_score", "final_rank")


@query("r12_shape_sources", sql("hybrid_chunks articles question_vectors", """
SELECT query_id, chunk_id, doi, 'https://doi.org/' || doi AS doi_url, left(text, 300) AS text FROM (
  SELECT query_id, chunk_id, coalesce(doi, CASE WHEN doc_id % 2 = 0 THEN '10.9/' || doc_id END) AS doi, text || CASE WHEN doc_id % 2 = 0 THEN ' doi:10.9/' || doc_id || '.' ELSE '' END AS text
  FROM v_ranked JOIN meta USING (chunk_id) WHERE rank <= 5)""", meta=META, **vector("v", "hybrid_chunks")))
def r12(t: Tables) -> DataFrame:
    tail = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" doi:10.9/"), F.col("doc_id").cast("string"), F.lit("."))).otherwise(F.lit(""))
    hits = H.semantic_search(described(t).withColumn("text", F.concat("text", tail)), fx.question_vectors(t), 5, 0.0)
    return H.shape_sources(hits, excerpts=True).select("query_id", "chunk_id", "doi", "doi_url", "text")


@query("r12_low_quality", sql("question_vectors vectors", """
SELECT query_id, coalesce(n, 0) AS n_hits, round(best, 6) AS best, coalesce(n, 0) < 3 OR coalesce(best < 0.5, false) AS low_quality FROM question_vectors
LEFT JOIN (SELECT query_id, count(*) AS n, max(score) AS best FROM v_ranked WHERE rank <= 5 AND score >= 0.68 GROUP BY query_id) USING (query_id)""", **vector("v", "vectors")))
def r12_low(t: Tables) -> DataFrame:
    q = fx.question_vectors(t)
    return rounded(H.low_quality(min_score(vector_search(fx.vectors(t), q, 5), 0.68), q))


@query("r10_retrieval_probe", sql("hybrid_chunks question_vectors", """
SELECT channel, e.query_id, e.chunk_id, r.rank, coalesce(r.rank <= 8, false) AS found FROM (SELECT 'keyword' AS channel UNION ALL SELECT 'semantic') c CROSS JOIN
 (SELECT query_id, min_by(chunk_id, seq) AS chunk_id FROM question_vectors q JOIN hybrid_chunks h ON h.seq % (SELECT count(*) FROM embeddings) = q.query_id GROUP BY query_id) e
LEFT JOIN (SELECT 'keyword' AS channel, query_id, chunk_id, rank FROM k_ranked WHERE rank <= 30 AND score > 0 UNION ALL SELECT 'semantic', query_id, chunk_id, rank FROM v_ranked WHERE rank <= 30) r USING (channel, query_id, chunk_id)""",
    **HYBRID))
def r10(t: Tables) -> DataFrame:
    """The expected chunk of a question is the first one that carries the question's own vector."""
    c, q = cut_lineage(marked_hybrid(t)), fx.question_vectors(t)
    n = t.embeddings.agg(F.count("*")).scalar()
    own = c.select("chunk_id", "seq", F.pmod("seq", n).alias("query_id")).join(q.select("query_id"), "query_id")
    expected = own.groupBy("query_id").agg(F.min_by("chunk_id", "seq").alias("chunk_id"))
    tag = lambda df, name: df.select(F.lit(name).alias("channel"), "query_id", "chunk_id", "rank")
    hits = tag(bm25_search(bm25_index(c), q, 30), "keyword").unionByName(tag(vector_search(c, q, 30), "semantic"))
    return ranked(H.retrieval_probe(hits, expected, ["keyword", "semantic"]), "channel", "query_id", "chunk_id", "rank", "found")


@query("r10_table_contamination", sql("hybrid_chunks question_vectors", f"""
SELECT query_id, sum(CASE WHEN {TABLE_SCORE} >= 1 THEN 1 ELSE 0 END)::BIGINT AS table_hits, count(*) AS n_hits FROM v_ranked JOIN marked USING (chunk_id) WHERE rank <= 8 GROUP BY query_id""", **HYBRID))
def r10_tables(t: Tables) -> DataFrame:
    c = cut_lineage(marked_hybrid(t))
    return H.table_contamination(H.hydrate(vector_search(c, fx.question_vectors(t), 8), c.select("chunk_id", "text")))


@query("w10_assign_seq", sql("vectors", """
SELECT chunk_id, (SELECT max(seq) FROM vectors) + row_number() OVER (ORDER BY seq) AS seq FROM vectors WHERE paper_id IN ('paper_1', 'paper_2')"""))
def w10(t: Tables) -> DataFrame:
    v = fx.vectors(t)
    new = v.where(F.col("paper_id").isin("paper_1", "paper_2")).withColumnRenamed("seq", "pos")
    return I.assign_seq(v, new).select("chunk_id", "seq")


@query("u02_merge_indices", sql("vectors", """
SELECT chunk_id, row_number() OVER (ORDER BY part, seq) - 1 AS seq FROM (SELECT 0 AS part, * FROM vectors WHERE paper_id IN ('paper_3', 'paper_4') UNION ALL SELECT 1, * FROM vectors WHERE paper_id NOT IN ('paper_3', 'paper_4'))"""))
def u02(t: Tables) -> DataFrame:
    v, first = fx.vectors(t).drop("embedding"), F.col("paper_id").isin("paper_3", "paper_4")
    return I.merge_indices([v.where(first), v.where(~first)]).select("chunk_id", "seq")


@query("u04_delete_paper", sql("vectors", """
SELECT chunk_id, row_number() OVER (ORDER BY seq) - 1 AS seq, (SELECT count(*) FROM vectors WHERE paper_id = 'paper_5') AS deleted FROM vectors WHERE paper_id <> 'paper_5'"""))
def u04(t: Tables) -> DataFrame:
    kept, deleted = I.delete_paper(fx.vectors(t).drop("embedding"), "paper_5")
    return kept.withColumn("deleted", deleted.scalar()).select("chunk_id", "seq", "deleted")


NEAR = "SELECT a.vec_id AS i, b.vec_id AS j, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS s FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id"


@query("j15_similar_pairs", f"SELECT i AS seq, count(*) AS n_partners, min(j) FILTER (j < i) AS first_partner, round(max(s), 6) AS best_score FROM ({NEAR}) WHERE s >= 0.35 GROUP BY i")
def j15(t: Tables) -> DataFrame:
    return rounded(N.similar_pairs(fx.vectors(t), 0.35))


@query("j15_close_pairs", f"SELECT i AS seq, count(*) AS n_partners, min(j) FILTER (j < i) AS first_partner, round(max(s), 6) AS best_score FROM ({NEAR}) WHERE s >= 0.95 GROUP BY i")
def j15_close(t: Tables) -> DataFrame:
    return rounded(N.similar_pairs(fx.vectors(t), 0.95))


@query("r09_dedup_groups")
def r09(t: Tables) -> DataFrame:
    return N.dedup_groups(fx.vectors(t), 0.35)
