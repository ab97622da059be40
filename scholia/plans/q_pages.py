"""Page structure, chunking and user-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.operators import articles as A, chunking as C, pages as P, stats as S
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.operators.bm25 import bm25_index
from scholia.operators.hybrid import hybrid_search
from scholia.plans.q_stats import rounded
from scholia.registry import Tables, query
from scholia.session import work_path
from scholia.sources.tables import read_index, read_postings, write_index, write_postings

OFFSETS = """
SELECT paper_id, page_number, coalesce(sum(length(text) + 2) OVER (PARTITION BY paper_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start,
  length(text) AS n FROM turns"""


@query("w06_page_offsets", sql("turns", f"SELECT paper_id, page_number, char_start, char_start + n AS char_end FROM ({OFFSETS})"))
def w06(t: Tables) -> DataFrame:
    return P.page_offsets(fx.turns(t)).select("paper_id", "page_number", "char_start", "char_end")


@query("j07_assign_pages", sql("turns", """
SELECT s.paper_id, s.char_start, coalesce(max(o.page_number), any_value(l.last)) AS page_number
FROM (SELECT paper_id, unnest(range(0, total, 97)) AS char_start FROM (SELECT paper_id, sum(length(text) + 2)::BIGINT AS total FROM turns GROUP BY paper_id)) s
LEFT JOIN o ON o.paper_id = s.paper_id AND o.char_start <= s.char_start AND s.char_start < o.char_start + o.n
JOIN (SELECT paper_id, max(page_number) AS last FROM turns GROUP BY paper_id) l ON l.paper_id = s.paper_id GROUP BY ALL""", o=OFFSETS))
def j07(t: Tables) -> DataFrame:
    """Positions every 97 characters play the part of chunk starts."""
    turns = fx.turns(t)
    total = turns.groupBy("paper_id").agg(F.sum(F.length("text") + 2).alias("total"))
    starts = total.select("paper_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, F.lit(97).cast("bigint"))).alias("char_start"))
    return P.assign_pages(starts, P.page_offsets(turns)).select("paper_id", "char_start", "page_number")


LINES = {
    "ends": r"""SELECT paper_id, trim(ls[1]) AS first, trim(ls[-1]) AS last FROM (SELECT paper_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM framed_turns)""",
    "sizes": "SELECT paper_id, count(*) AS n FROM framed_turns GROUP BY paper_id",
    "gone": """SELECT DISTINCT paper_id, line FROM (SELECT paper_id, 'f' AS side, first AS line, count(*) AS c FROM ends GROUP BY ALL UNION ALL SELECT paper_id, 'l', last, count(*) FROM ends GROUP BY ALL)
      JOIN sizes USING (paper_id) WHERE n >= 4 AND c >= greatest(3, n // 2) AND length(line) > 3""",
    "lists": "SELECT paper_id, list(line) AS gone FROM gone GROUP BY paper_id",
    "cleaned": """SELECT paper_id, page_number, text, gone, CASE WHEN gone IS NULL THEN text ELSE
      trim(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(gone, trim(x))), chr(10))) END AS clean FROM framed_turns LEFT JOIN lists USING (paper_id)""",
    "flagged": "SELECT *, gone IS NULL OR length(clean) >= 150 AS long_enough, bool_or(gone IS NULL OR length(clean) >= 150) OVER (PARTITION BY paper_id) AS some_left FROM cleaned",
}


@query("w08_strip_repeated_lines", sql("framed_turns", "SELECT paper_id, page_number, CASE WHEN some_left THEN clean ELSE text END AS text FROM flagged WHERE long_enough OR NOT some_left", **LINES))
def w08(t: Tables) -> DataFrame:
    return P.strip_repeated_lines(fx.framed_turns(t), 150).select("paper_id", "page_number", "text")


@query("w09_number_chunks", sql("turns", """
SELECT paper_id, page_number, row_number() OVER (PARTITION BY paper_id ORDER BY page_number) - 1 AS chunk_index, count(*) OVER (PARTITION BY paper_id) AS total_chunks,
  paper_id || '_chunk_' || printf('%03d', row_number() OVER (PARTITION BY paper_id ORDER BY page_number) - 1) AS chunk_id FROM turns WHERE length(text) >= 200"""))
def w09(t: Tables) -> DataFrame:
    kept = fx.turns(t).where(F.length("text") >= 200).withColumn("paper_id", F.col("paper_id").cast("string"))
    return P.number_chunks(kept, "page_number").select(F.col("paper_id").cast("bigint"), "page_number", "chunk_index", "total_chunks", "chunk_id")


@query("w18_contextualize", sql("chunks", """
SELECT chunk_id, CASE WHEN length(h) > 0 AND NOT contains(text, h) THEN h || ' ' || text ELSE text END AS search_text
FROM chunks LEFT JOIN (SELECT paper_id, trim(left(text, 250)) AS h FROM chunks WHERE chunk_index = 0) USING (paper_id)"""))
def w18(t: Tables) -> DataFrame:
    return P.contextualize(fx.chunks(t)).select("chunk_id", "search_text")


@query("w07_semantic_breaks", sql("vectors", """
SELECT paper_id, seq, round(s, 6) AS similarity FROM (SELECT paper_id, seq, list_dot_product(e, n) / ((sqrt(list_dot_product(e, e)) + 1e-8) * (sqrt(list_dot_product(n, n)) + 1e-8)) AS s FROM (
  SELECT paper_id, seq, embedding::DOUBLE[] AS e, lead(embedding::DOUBLE[]) OVER (PARTITION BY paper_id ORDER BY seq) AS n FROM vectors) WHERE n IS NOT NULL) WHERE s < 0.15"""))
def w07(t: Tables) -> DataFrame:
    return rounded(C.semantic_breaks(fx.vectors(t), 0.15))


@query("s17_markdown_pages", sql("docs", r"""
SELECT paper_id, page::BIGINT AS page_number, trim(array_to_string(list(line ORDER BY i) FILTER (NOT rule), chr(10)), ' ' || chr(10)) AS text FROM (
  SELECT paper_id, i, line, rule, 1 + sum(rule::INT) OVER (PARTITION BY paper_id ORDER BY i) AS page FROM (
    SELECT paper_id, i, line, regexp_full_match(trim(line), '[-*]{3,}') AS rule FROM (
      SELECT paper_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT paper_id, string_split(replace(text, '. ', '.' || chr(10) || '---' || chr(10)), chr(10)) AS ls FROM docs)))) GROUP BY paper_id, page"""))
def s17(t: Tables) -> DataFrame:
    """Documents with a rule after every sentence inside a line."""
    ruled = fx.docs(t).withColumn("text", F.replace("text", F.lit(". "), F.lit(".\n---\n")))
    return P.markdown_pages(ruled)


@query("x01_chunk_sliding")
def x01(t: Tables) -> DataFrame:
    return C.chunk_sliding(fx.docs(t))


@query("x01_chunk_pages")
def x01_pages(t: Tables) -> DataFrame:
    return C.chunk_pages(fx.turns(t), 400, 40, 50).select("paper_id", "chunk_id", "char_start", "char_end", "page_number", "text")


@query("x02_chunk_semantic")
def x02(t: Tables) -> DataFrame:
    return C.chunk_semantic(fx.docs(t), C.hashing_encoder(64), 0.15, 300, 1000)


@query("x02_chunk_semantic_pages")
def x02_pages(t: Tables) -> DataFrame:
    return C.chunk_semantic_pages(fx.turns(t), C.hashing_encoder(64))


@query("x03_split_sentences")
def x03(t: Tables) -> DataFrame:
    return C.split_sentences(fx.docs(t), 1000)


def html_documents(t: Tables) -> DataFrame:
    return t.pages.select(F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("paper_id"), F.encode("html", "UTF-8").alias("content"))


@query("x04_extract_pages")
def x04(t: Tables) -> DataFrame:
    return C.extract_pages(html_documents(t))


@query("x05_embed")
def x05(t: Tables) -> DataFrame:
    return C.embed(fx.chunks(t)).select("chunk_id", "embedding", "model", "dim")


def echo_client():
    return lambda system, prompt: f"{system}:{len(prompt)}"


@query("x06_generate", sql("chunks", "SELECT chunk_id, 'count:' || length(text) AS answer, NULL AS error FROM chunks"))
def x06(t: Tables) -> DataFrame:
    return C.generate(fx.chunks(t).select("chunk_id", "text"), "text", echo_client, "count").select("chunk_id", "answer", "error")


@query("x07_index_documents")
def x07(t: Tables) -> DataFrame:
    """Build, save, read back, search: per document its chunks and how often they answer a question."""
    chunks, failed, _ = C.index_documents(html_documents(t), size=800, overlap=80)
    path = work_path(t.spark, "index")
    write_index(chunks, path)
    stored, _ = read_index(t.spark, path)
    write_postings(bm25_index(stored), path)
    questions = C.embed(fx.questions(t), "question").select("query_id", "question", "embedding")
    hits = hybrid_search(stored, read_postings(t.spark, path), questions)
    answers = hits.join(stored.select("chunk_id", "paper_id"), "chunk_id").groupBy("paper_id").agg(F.count("*").alias("answers"))
    ok = stored.groupBy("paper_id").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"), F.min("seq").alias("first_seq"))
    return ok.join(answers, "paper_id", "left").unionByName(failed, allowMissingColumns=True)


@query("a22_compare_chunkers")
def a22(t: Tables) -> DataFrame:
    d = fx.docs(t)
    return S.compare_chunkers({"sliding": C.chunk_sliding(d), "semantic": C.chunk_semantic(d, C.hashing_encoder(64))}, d, 430)


TEXT_WITH_ABSTRACT = "string_split(text, chr(10))[1] || chr(10) || 'Summary: ' || array_to_string(string_split(text, chr(10))[2:], chr(10)) || ' In ' || (1950 + doc_id % 70) || '.'"


@query("f32_front_matter", sql("docs", rf"""
SELECT paper_id, CASE WHEN length(ls[1]) > 200 THEN coalesce(list_filter(ls[2:5], lambda x: length(x) > 20 AND length(x) < 200)[1], ls[1]) ELSE ls[1] END AS title,
  nullif(trim(regexp_extract(text, '(?is)(?:abstract|summary)\s*:?\s*([^.]{{100,500}}\.)', 1)), '') AS abstract,
  try_cast(nullif(regexp_extract(text, '\b(?:19|20)[0-9]{{2}}\b'), '') AS INTEGER) AS year
FROM (SELECT paper_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM (SELECT paper_id, {TEXT_WITH_ABSTRACT} AS text FROM docs))"""))
def f32(t: Tables) -> DataFrame:
    return C.front_matter(with_abstract(t)).drop("authors")


def with_abstract(t: Tables) -> DataFrame:
    ls = F.split("text", "\n")
    rest = F.array_join(F.slice(ls, 2, F.greatest(F.size(ls) - 1, F.lit(0))), "\n")
    year = (1950 + F.col("doc_id") % 70).cast("string")
    return fx.docs(t).withColumn("text", F.concat(F.get(ls, 0), F.lit("\nSummary: "), rest, F.lit(" In "), year, F.lit(".")))


@query("f32_front_matter_authors")
def f32_authors(t: Tables) -> DataFrame:
    return C.front_matter(with_abstract(t)).select("paper_id", F.array_join("authors", "|").alias("authors"))


@query("f15_title_similarity")
def f15_similarity(t: Tables) -> DataFrame:
    """Each article's title against the other title of the same question's search (first by number)."""
    a = fx.articles(t).select("pos", "item_id", "title")
    first = a.groupBy("item_id").agg(F.min_by("title", "pos").alias("candidate_title"))
    pairs = a.join(first, "item_id").withColumn("oa_url", F.when(F.col("pos") % 2 == 0, "http://x.org/pdf"))
    return A.title_similarity(pairs).select("pos", F.round("score", 6).alias("score"))
