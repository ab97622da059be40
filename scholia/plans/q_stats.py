"""Statistics and reports as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.operators import pages as P, stats as S
from scholia.operators.bm25 import bm25_index
from scholia.operators.hybrid import filter_table_chunks
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.plans.q_text import TABLE_SCORE
from scholia.registry import Tables, query


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if d == "double" else F.col(c) for c, d in df.dtypes])


@query("a01_chunk_stats", sql("chunks", """
SELECT count(*) AS total, min(length(text)) AS chars_min, max(length(text)) AS chars_max, round_even(avg(length(text)), 0)::BIGINT AS chars_avg,
  sum(length(text))::BIGINT AS chars_total, count(DISTINCT paper_id) AS papers FROM chunks"""))
def a01(t: Tables) -> DataFrame:
    return S.chunk_stats(fx.chunks(t))


@query("a02_index_stats", sql("vectors", """
SELECT count(*) AS total_chunks, count(DISTINCT paper_id) AS total_papers, max(len(embedding))::BIGINT AS embedding_dimension, 'given' AS embedding_model FROM vectors"""))
def a02(t: Tables) -> DataFrame:
    return S.index_stats(fx.vectors(t), "given")


@query("a03_completeness", sql("articles", """
SELECT count(*) AS total, count(nullif(title, '')) AS with_title, sum(CASE WHEN len(authors) > 0 THEN 1 ELSE 0 END)::BIGINT AS with_authors, count(year) AS with_year, count(doi) AS with_doi,
  round((count(nullif(title, '')) + sum(CASE WHEN len(authors) > 0 THEN 1 ELSE 0 END) + count(year) + count(doi)) / (4.0 * count(*)) * 100, 6)::DOUBLE AS completeness_pct FROM articles"""))
def a03(t: Tables) -> DataFrame:
    return rounded(S.completeness(fx.articles(t)))


@query("a04_chunks_by_document", sql("chunks", """
SELECT CASE WHEN lang = 'en' THEN source_pdf ELSE 'unknown' END AS source_pdf, count(*) OVER (PARTITION BY CASE WHEN lang = 'en' THEN source_pdf ELSE 'unknown' END) AS n_chunks, chunk_id FROM chunks"""))
def a04(t: Tables) -> DataFrame:
    return S.chunks_by_document(fx.chunks(t).withColumn("source_pdf", F.when(F.col("lang") == "en", F.col("source_pdf"))))


@query("a05_article_stats", sql("articles", """
SELECT 'overall' AS kind, item, round(value, 6) AS value FROM (
  UNPIVOT (SELECT count(*)::DOUBLE AS total, count(nullif(title, ''))::DOUBLE AS with_title, count(abstract)::DOUBLE AS with_abstract, count(keywords)::DOUBLE AS with_keywords,
    sum(CASE WHEN len(authors) > 0 THEN 1 ELSE 0 END)::DOUBLE AS with_authors, count(year)::DOUBLE AS with_year, count(doi)::DOUBLE AS with_doi,
    avg(length(nullif(title, '')))::DOUBLE AS avg_title, avg(length(abstract))::DOUBLE AS avg_abstract FROM articles)
  ON total, with_title, with_abstract, with_keywords, with_authors, with_year, with_doi, avg_title, avg_abstract INTO NAME item VALUE value)
UNION ALL SELECT 'source', source, count(*)::DOUBLE FROM articles GROUP BY source
UNION ALL SELECT 'year', year::VARCHAR, count(*)::DOUBLE FROM articles WHERE year IS NOT NULL GROUP BY year"""))
def a05(t: Tables) -> DataFrame:
    return rounded(S.article_stats(fx.articles(t)))


@query("a06_text_stats", r"""
SELECT count(*) AS total, round(avg(length(text)), 6) AS avg_chars, min(length(text)) AS min_chars, max(length(text)) AS max_chars,
  round(avg(len(regexp_extract_all(text, '[^\s]+'))), 6) AS avg_words, sum(CASE WHEN text = '' THEN 1 ELSE 0 END)::BIGINT AS empty FROM documents""")
def a06(t: Tables) -> DataFrame:
    return rounded(S.text_stats(t.documents))


@query("a07_inventory_stats", """
SELECT count(*) AS files, round(sum(n_chars) / 1048576, 6) AS total_mb, round(min(n_chars) / 1024, 6) AS min_kb, round(max(n_chars) / 1024, 6) AS max_kb, round(avg(n_chars) / 1024, 6) AS avg_kb FROM documents""")
def a07(t: Tables) -> DataFrame:
    return rounded(S.inventory_stats(t.documents, "n_chars"))


@query("a08_estimate_cost", """
SELECT count(*) AS total_documents, (SELECT count(*) FROM labels JOIN documents USING (doc_id)) AS analyzed, round_even(avg_raw, 1) AS avg_pages, any_value(lo)::BIGINT AS min_pages, any_value(hi)::BIGINT AS max_pages,
  floor(avg_raw * count(*))::BIGINT AS estimated_pages, round_even(floor(avg_raw * count(*)) * 0.002, 2)::DOUBLE AS cost, round_even(floor(avg_raw * count(*)) * 0.002 * 0.8, 2)::DOUBLE AS cost_low,
  round_even(floor(avg_raw * count(*)) * 0.002 * 1.2, 2)::DOUBLE AS cost_high, round_even(count(*) * 3.0 / 3600, 1)::DOUBLE AS hours
FROM documents, (SELECT avg(p) AS avg_raw, min(p) AS lo, max(p) AS hi FROM (
  SELECT greatest(1, round_even(n_chars / 1024 / 6, 0)) AS p FROM documents JOIN labels USING (doc_id))) GROUP BY avg_raw""")
def a08(t: Tables) -> DataFrame:
    """The labelled documents are the sample that was opened."""
    d = t.documents.select("doc_id", S.pages_from_size(F.col("n_chars")).alias("pages"))
    return S.estimate_cost(d, d.join(t.labels, "doc_id"))


@query("a09_extraction_report", sql("turns", r"""
SELECT p.paper_id, pages IS NOT NULL AS ok, coalesce(pages, 0) AS pages, coalesce(chars, 0)::BIGINT AS chars, coalesce(words, 0)::BIGINT AS words
FROM (SELECT DISTINCT paper_id FROM turns) p LEFT JOIN (SELECT paper_id, count(*) AS pages, sum(length(text)) AS chars, sum(len(regexp_extract_all(text, '[^\s]+'))) AS words
  FROM turns WHERE length(text) >= 500 GROUP BY paper_id) USING (paper_id)"""))
def a09(t: Tables) -> DataFrame:
    turns = fx.turns(t)
    return S.extraction_report(turns.where(F.length("text") >= 500), turns)


@query("a09_extraction_summary", sql("turns", r"""
SELECT count(*) AS documents, count(pages) AS succeeded, count(*) - count(pages) AS failed, round(count(pages) / count(*) * 100, 6) AS success_pct,
  round(avg(pages), 6) AS avg_pages, round(avg(chars), 6) AS avg_chars, round(avg(words), 6) AS avg_words
FROM (SELECT DISTINCT paper_id FROM turns) p LEFT JOIN (SELECT paper_id, count(*) AS pages, sum(length(text)) AS chars, sum(len(regexp_extract_all(text, '[^\s]+'))) AS words
  FROM turns WHERE length(text) >= 500 GROUP BY paper_id) USING (paper_id)"""))
def a09_summary(t: Tables) -> DataFrame:
    turns = fx.turns(t)
    return rounded(S.extraction_summary(S.extraction_report(turns.where(F.length("text") >= 500), turns)))


CASCADE = """
SELECT doc_id, provider, chars, pages FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY prio) AS rn FROM attempts WHERE chars >= 500) WHERE rn = 1"""


@query("w17_extraction_cascade", sql("attempts", f"""
SELECT d.doc_id, provider, chars, pages, c.doc_id IS NOT NULL AS ok FROM (SELECT DISTINCT doc_id FROM attempts) d LEFT JOIN ({CASCADE}) c ON d.doc_id = c.doc_id"""))
def w17(t: Tables) -> DataFrame:
    return P.extraction_cascade(fx.attempts(t), 500)


@query("a10_provider_stats", sql("attempts", f"""
SELECT provider, count(*) AS documents, sum(chars)::BIGINT AS chars, sum(pages)::BIGINT AS pages, (SELECT sum(chars) // count(*) FROM ({CASCADE}))::BIGINT AS average_chars FROM ({CASCADE}) GROUP BY provider"""))
def a10(t: Tables) -> DataFrame:
    return S.provider_stats(P.extraction_cascade(fx.attempts(t), 500).where("ok"))


@query("a17_coverage_report", sql("statuses", """
SELECT state, count(*) AS species, sum(processed)::BIGINT AS processed, sum(downloaded)::BIGINT AS downloaded, round(count(*) / any_value(total) * 100, 6) AS species_pct,
  round(sum(downloaded) / greatest(1, sum(processed)) * 100, 6) AS success_pct
FROM (SELECT species, count(status) AS processed, sum(CASE WHEN status = 'downloaded' THEN 1 ELSE 0 END) AS downloaded, count(*) OVER () AS total,
  CASE WHEN count(status) = 0 THEN 'no_articles' WHEN sum(CASE WHEN status = 'downloaded' THEN 1 ELSE 0 END) > 0 THEN 'ready' ELSE 'blocked' END AS state
  FROM (SELECT 'species_' || c_custkey AS species, status FROM customer LEFT JOIN statuses ON species = 'species_' || c_custkey) GROUP BY species) GROUP BY state"""))
def a17(t: Tables) -> DataFrame:
    taxonomy = t.customer.select(F.concat(F.lit("species_"), F.col("c_custkey").cast("string")).alias("species"))
    s = taxonomy.join(fx.statuses(t), "species", "left").select("species", F.coalesce("status", F.lit("none")).alias("status"))
    return rounded(S.coverage_report(s))


@query("a18_species_counts", sql("species_base articles", """
SELECT species, coalesce(a, 0) AS articles, coalesce(f, 0) AS files, coalesce(f, 0) > 0 AS with_files FROM (SELECT DISTINCT species FROM species_base)
LEFT JOIN (SELECT species, count(*) AS a FROM articles GROUP BY species) USING (species)
LEFT JOIN (SELECT species, count(*) AS f FROM articles JOIN labels ON doc_id = pos WHERE quality = 1 GROUP BY species) USING (species)"""))
def a18(t: Tables) -> DataFrame:
    a = fx.articles(t)
    files = a.join(t.labels.where("quality = 1"), F.col("pos") == F.col("doc_id"))
    return S.species_counts(fx.species_base(t), a, files)


@query("a19_status_summary", sql("statuses", """
SELECT count(*) AS total, sum(CASE WHEN status = 'downloaded' THEN 1 ELSE 0 END)::BIGINT AS downloaded, sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END)::BIGINT AS failed,
  sum(CASE WHEN status = 'skipped' THEN 1 ELSE 0 END)::BIGINT AS skipped, round(sum(CASE WHEN status = 'downloaded' THEN 1 ELSE 0 END) / count(*) * 100, 6) AS success_pct FROM statuses"""))
def a19(t: Tables) -> DataFrame:
    return rounded(S.status_summary(fx.statuses(t)))


@query("a20_source_totals", sql("articles", """
SELECT source, count(*) AS articles, round(count(*) / (SELECT count(DISTINCT species) FROM articles), 6) AS per_species FROM articles GROUP BY source"""))
def a20(t: Tables) -> DataFrame:
    return rounded(S.source_totals(fx.articles(t)))


def question_runs(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("species"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("seconds"),
        F.get_json_object("props", "$.k").cast("int").alias("chunks"),
    )


@query("a21_query_metrics", """
SELECT count(*) AS total, sum(ok::INT)::BIGINT AS succeeded, sum((NOT ok)::INT)::BIGINT AS failed, round(sum(ok::INT) / count(*) * 100, 6) AS success_pct,
  min(value) FILTER (ok) AS min_seconds, max(value) FILTER (ok) AS max_seconds, round(avg(value) FILTER (ok), 6) AS avg_seconds, round(avg(k) FILTER (ok), 6) AS avg_chunks,
  (list_sort(list(value) FILTER (ok)))[count(*) FILTER (ok) // 2 + 1] AS median_seconds,
  round(count(DISTINCT user_id) FILTER (ok) / count(DISTINCT user_id) * 100, 6) AS species_coverage_pct
FROM (SELECT *, event_type <> 'error' AS ok, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""")
def a21(t: Tables) -> DataFrame:
    return rounded(S.query_metrics(question_runs(t)))


@query("a24_validate_index", sql("vectors", """
SELECT total_chunks, 0::BIGINT AS wrong_dimension, 64::BIGINT AS embedding_dimension, metadata_count, without_metadata, without_vector,
  CASE WHEN metadata_count <> total_chunks THEN 'chunk and metadata counts differ' ELSE '' END AS issues, metadata_count = total_chunks AS is_valid
FROM (SELECT count(*) AS total_chunks, count(item_id) + (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS metadata_count,
   count(*) - count(item_id) AS without_metadata, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS without_vector
  FROM vectors LEFT JOIN (SELECT doc_id AS item_id FROM documents) ON item_id = seq)"""))
def a24(t: Tables) -> DataFrame:
    meta = t.documents.select(F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("chunk_id"))
    return S.validate_index(fx.vectors(t), meta, 64).withColumn("issues", F.array_join("issues", ";"))


PROGRESS_SQL = "SELECT species, count(*) AS processed, sum(CASE WHEN status = 'downloaded' THEN 1 ELSE 0 END)::BIGINT AS downloaded FROM statuses GROUP BY species"


def progress(t: Tables) -> DataFrame:
    return fx.statuses(t).groupBy("species").agg(F.count("*").alias("processed"), F.count_if(F.col("status") == "downloaded").alias("downloaded"))


@query("a25_is_complete", sql("statuses", f"""
SELECT count(*) AS keys, sum(CASE WHEN processed > downloaded THEN 1 ELSE 0 END)::BIGINT AS incomplete, bool_and(processed <= downloaded) AS complete FROM ({PROGRESS_SQL})"""))
def a25(t: Tables) -> DataFrame:
    return S.is_complete(progress(t))


@query("a25_incomplete", sql("statuses", f"SELECT * FROM ({PROGRESS_SQL}) WHERE processed > downloaded"))
def a25_list(t: Tables) -> DataFrame:
    return S.incomplete(progress(t))


@query("a27_phase_summary", """
SELECT count(*) AS total, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)::BIGINT AS succeeded, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS failed FROM events""")
def a27(t: Tables) -> DataFrame:
    return S.phase_summary(t.events.select(F.col("event_type").alias("phase"), (F.col("event_type") != "error").alias("ok")))


@query("a28_compare_extractors", sql("attempts", """
SELECT doc_id, max(chars) FILTER (prio = 1) AS extractor_1_chars, max(pages) FILTER (prio = 1) AS extractor_1_pages, max(chars) FILTER (prio = 3) AS extractor_3_chars, max(pages) FILTER (prio = 3) AS extractor_3_pages,
  CASE WHEN max(chars) FILTER (prio = 1) > 0 AND max(chars) FILTER (prio = 3) > 0 THEN round(max(chars) FILTER (prio = 1) / max(chars) FILTER (prio = 3) * 100, 6) END AS ratio_pct,
  coalesce(max(chars) FILTER (prio = 1) / nullif(max(chars) FILTER (prio = 3), 0) * 100 < 20 AND max(chars) FILTER (prio = 1) > 0, false) AS suspicious FROM attempts GROUP BY doc_id"""))
def a28(t: Tables) -> DataFrame:
    return rounded(S.compare_extractors(fx.attempts(t), "extractor_1", "extractor_3"))


@query("a26_bm25_statistics", sql("term_stats corpus", """
SELECT count(*) AS terms, round(avg(idf), 6) AS avg_idf, sum(df)::BIGINT AS postings, any_value(n) AS chunks, round(any_value(avgdl), 6) AS avgdl FROM term_stats, corpus"""))
def a26(t: Tables) -> DataFrame:
    return rounded(S.bm25_summary(bm25_index(fx.chunks(t))))


@query("a26_bm25_terms", sql("term_stats", "SELECT term, df, round(idf, 6) AS idf FROM term_stats"))
def a26_terms(t: Tables) -> DataFrame:
    return rounded(bm25_index(fx.chunks(t)).terms)


@query("p13_filter_table_chunks", sql("chunks", f"SELECT chunk_id, score AS table_score FROM (SELECT chunk_id, {TABLE_SCORE} AS score FROM marked) WHERE score >= 1",
    marked="SELECT chunk_id, CASE WHEN seq % 5 = 0 THEN 'Table ' || chunk_index || ' ' || text || ' ' || seq || ' 12.5 7' ELSE text END AS text FROM chunks"))
def p13(t: Tables) -> DataFrame:
    return rounded(filter_table_chunks(marked_chunks(t)).select("chunk_id", "table_score"))


def marked_chunks(t: Tables) -> DataFrame:
    """Chunks of which every fifth carries a table caption and numbers."""
    marked = F.concat(F.lit("Table "), F.col("chunk_index").cast("string"), F.lit(" "), "text", F.lit(" "), F.col("seq").cast("string"), F.lit(" 12.5 7"))
    return fx.chunks(t).withColumn("text", F.when(F.col("seq") % 5 == 0, marked).otherwise(F.col("text")))


@query("p11_filter_pages", sql("turns", rf"""
SELECT paper_id, page_number, length(text) AS n FROM turns WHERE length(text) >= 300
UNION ALL SELECT DISTINCT paper_id, NULL, NULL FROM turns WHERE paper_id NOT IN (SELECT paper_id FROM turns WHERE length(text) >= 300)"""))
def p11(t: Tables) -> DataFrame:
    kept, failed = P.filter_pages(fx.turns(t), 300)
    return kept.select("paper_id", "page_number", F.length("text").cast("bigint").alias("n")).unionByName(failed, allowMissingColumns=True)
