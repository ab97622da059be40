"""Text, identifier and record functions as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia import fixed
from scholia.functions import ids, records as R, text as X, vectors as V
from scholia.operators.graph import extraction_prompt
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.registry import Tables, query
from scholia.session import work_path
from scholia.sources.files import CSV, fix_linebreaks

CLEAN = r"""
regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(
  regexp_replace(regexp_replace(text, '-\n([\p{L}\p{N}_])', '\1', 'g'), '\n{3,}', chr(10) || chr(10), 'g'),
  chr(10) || chr(10), chr(1)), chr(10), ' '), chr(1), chr(10) || chr(10)),
  '(?m)^\s*\d{1,4}\s*$', '', 'g'), ' {2,}', ' ', 'g'), '[\x00-\x09\x0B-\x1F]', '', 'g'), '^\s+|\s+$', '', 'g')"""
ASCII = r"regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g')"


@query("f01_clean_page_text", f"""
SELECT 'd' || doc_id AS id, {CLEAN} AS clean FROM documents
UNION ALL SELECT 't' || conv_id || '_' || turn, {CLEAN} FROM conversations""")
def f01(t: Tables) -> DataFrame:
    d = t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    c = t.conversations.select(F.concat(F.lit("t"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")), "text")
    return d.union(c).select("id", X.clean_page_text("text").alias("clean"))


@query("f02_normalize_ascii", "SELECT doc_id, lower(" + ASCII.format("text") + ") AS norm FROM documents")
def f02(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.normalize_ascii("text").alias("norm"))


@query("f03_clean_for_embedding", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(text, 'http[s]?://[^\s]+', '', 'g'), '[^\s]+@[^\s]+', '', 'g'), '\[[0-9]+\]', '', 'g'),
  '\([^)]*[0-9]{4}[^)]*\)', '', 'g'), '[^\p{L}\p{N}_\s\-.,]', '', 'g'), '\.{2,}', '.', 'g'), ',{2,}', ',', 'g'), '\s+', ' ', 'g')) AS clean
FROM documents""")
def f03(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.clean_for_embedding("text").alias("clean"))


PAPER_ID = r"""
coalesce(nullif(trim(regexp_replace(regexp_replace({}, '[^A-Za-z0-9_\-]', '_', 'g'), '_+', '_', 'g'), '_'), ''), '{}')"""


@query("f04_derive_paper_id", sql("articles", f"""
SELECT pos, {PAPER_ID.format(ASCII.format("source || '_' || title || ' (' || lang || ')'"), "paper")} AS paper_id FROM articles"""))
def f04(t: Tables) -> DataFrame:
    stem = F.concat("source", F.lit("_"), "title", F.lit(" ("), "lang", F.lit(")"))
    return fx.articles(t).select("pos", ids.derive_paper_id(stem).alias("paper_id"))


SAFE = r"""left(replace(regexp_replace(trim(translate(title, '<>:"/\|?*', '_________')), '\s+', ' ', 'g'), ' ', '_'), 80)"""


@query("f05_paper_id_from_title", sql("articles", f"""
SELECT pos, {PAPER_ID.format(ASCII.format("CASE WHEN year IS NOT NULL THEN year || '_' || safe ELSE safe END"), "")} AS paper_id
FROM (SELECT *, {SAFE} AS safe FROM articles)"""))
def f05(t: Tables) -> DataFrame:
    return fx.articles(t).select("pos", ids.paper_id_from_title("title", "year").alias("paper_id"))


@query("f06_safe_name", sql("articles", f"""
SELECT pos, {SAFE} AS title_name, translate(species, ' /', '__') AS species_name, translate(doi, '/.', '__') AS doi_name FROM articles"""))
def f06(t: Tables) -> DataFrame:
    return fx.articles(t).select(
        "pos", ids.safe_name("title").alias("title_name"), ids.safe_species("species").alias("species_name"),
        ids.safe_doi("doi").alias("doi_name"),
    )


@query("f07_clean_field", sql("articles", r"""
SELECT pos, trim(regexp_replace(abstract, '\s+', ' ', 'g')) AS abstract,
  array_to_string(list_filter(list_transform(authors, lambda a: trim(regexp_replace(a, '\s+', ' ', 'g'))), lambda a: length(a) > 1), ';') AS authors
FROM articles"""))
def f07(t: Tables) -> DataFrame:
    return fx.articles(t).select(
        "pos", R.clean_field("abstract").alias("abstract"), F.array_join(R.clean_authors("authors"), ";").alias("authors")
    )


@query("f08_clean_doi", sql("articles", r"""
SELECT pos, CASE WHEN raw = '' OR raw LIKE '10.%' THEN raw ELSE '10.' || raw END AS doi
FROM (SELECT pos, trim(CASE WHEN pos % 2 = 0 THEN replace(doi, '10.', ' ') ELSE doi END) AS raw FROM articles)"""))
def f08(t: Tables) -> DataFrame:
    raw = F.when(F.col("pos") % 2 == 0, F.regexp_replace("doi", r"10\.", " ")).otherwise(F.col("doi"))
    return fx.articles(t).select("pos", R.clean_doi(raw).alias("doi"))


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in fixed.STOP_WORDS) + "]"


@query("f09_combined_text", sql("articles", f"""
SELECT pos, title AS title_only, concat_ws(' ', title, abstract) AS title_abstract,
  concat_ws(' ', title, abstract, CASE WHEN len(keywords) > 0 THEN 'Keywords: ' || array_to_string(keywords, ', ') END,
    CASE WHEN len(authors) > 0 THEN 'Authors: ' || array_to_string(authors, ', ') END) AS rich,
  array_to_string(list_filter(regexp_split_to_array(concat_ws(' ', title, abstract), '\\s+'),
    lambda w: w <> '' AND NOT list_contains({STOP_SQL}, lower(w))), ' ') AS no_stop_words
FROM articles"""))
def f09(t: Tables) -> DataFrame:
    cols = [F.col(c) for c in ("title", "abstract", "keywords", "authors")]
    return fx.articles(t).select(
        "pos", *[X.combined_text(*cols, strategy=s).alias(s) for s in ("title_only", "title_abstract", "rich")],
        X.combined_text(*cols, stop_words=True).alias("no_stop_words"),
    )


TABLE_SCORE = r"""
round(2.0 * length(regexp_replace(text, '[^0-9]', '', 'g')) / length(text)
  + 2.0 * len(regexp_extract_all(text, '\b[0-9]+[.,]?[0-9]*\b')) / greatest(len(regexp_extract_all(text, '[^\s]+')), 1)
  + CASE WHEN regexp_matches(text, '(?i)^\s*(table|tabla)\s*[0-9]') THEN 1 ELSE 0 END, 6)"""


@query("f10_table_score", sql("chunks", f"""
SELECT chunk_id, {TABLE_SCORE} AS score FROM (
  SELECT chunk_id, CASE WHEN seq % 5 = 0 THEN 'Table ' || chunk_index || ' ' || text || ' ' || seq || ' 12.5 7' ELSE text END AS text FROM chunks)"""))
def f10(t: Tables) -> DataFrame:
    marked = F.concat(F.lit("Table "), F.col("chunk_index").cast("string"), F.lit(" "), "text", F.lit(" "), F.col("seq").cast("string"), F.lit(" 12.5 7"))
    c = fx.chunks(t).withColumn("text", F.when(F.col("seq") % 5 == 0, marked).otherwise(F.col("text")))
    return c.select("chunk_id", F.round(X.table_score("text"), 6).alias("score"))


@query("f11_tokenize", r"""
SELECT doc_id, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ' ') AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-zA-Záéíóúñüà-ÿ0-9]+') AS tokens FROM documents)""")
def f11(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.tokenize("text").alias("tok")).select(
        "doc_id", F.size("tok").cast("bigint").alias("n_tokens"), F.array_join("tok", " ").alias("tokens")
    )


@query("f12_parse_authors", sql("articles", r"""
SELECT pos, CASE pos % 4 WHEN 0 THEN array_to_string(list_filter([w1 || ', A.', w2 || ', B.'], lambda x: x <> ''), '|')
  WHEN 1 THEN w1 || ' ' || w2 || '|' || w2 || ' ' || w1
  WHEN 2 THEN w1 || ', A.|' || w2 || ', B.'
  ELSE w1 END AS authors
FROM (SELECT pos, 'W' || pos AS w1, 'Name' || pos AS w2 FROM articles)"""))
def f12(t: Tables) -> DataFrame:
    w1, w2 = F.concat(F.lit("W"), F.col("pos").cast("string")), F.concat(F.lit("Name"), F.col("pos").cast("string"))
    kind = F.col("pos") % 4
    raw = (
        F.when(kind == 0, F.format_string(" %s, A.; %s, B. ", w1, w2)).when(kind == 1, F.format_string("%s %s, %s %s", w1, w2, w2, w1))
        .when(kind == 2, F.format_string("%s, A., %s, B.", w1, w2)).otherwise(w1)
    )
    return fx.articles(t).select("pos", F.array_join(R.parse_authors(raw), "|").alias("authors"))


@query("f13_meta_from_filename", sql("articles", r"""
SELECT pos, try_cast(nullif(regexp_extract(stem, '[0-9]{4}'), '') AS INTEGER) AS year,
  nullif(trim(translate(trim(regexp_replace(stem, '(?s)[0-9]{4}.*$', '')), '-_', '  ')), '') AS author
FROM (SELECT pos, CASE WHEN pos % 3 = 0 THEN array_to_string(authors, '-') || coalesce('_' || year, '') || '_x' ELSE title END AS stem FROM articles)"""))
def f13(t: Tables) -> DataFrame:
    named = F.concat(F.array_join("authors", "-"), F.coalesce(F.concat(F.lit("_"), F.col("year").cast("string")), F.lit("")), F.lit("_x"))
    stem = F.when(F.col("pos") % 3 == 0, named).otherwise(F.col("title"))
    return fx.articles(t).select("pos", R.filename_year(stem).alias("year"), R.filename_author(stem).alias("author"))


@query("f14_meta_from_paper_id", sql("articles", r"""
SELECT pos, CASE WHEN has THEN year ELSE try_cast(nullif(regexp_extract(pid, '^[0-9]{4}'), '') AS INTEGER) END AS year,
  CASE WHEN has THEN array_to_string(authors, ';') ELSE
  array_to_string(regexp_extract_all(split_part(regexp_replace(pid, '^[0-9]{4}', ''), '-', 1), '[A-Z][a-z]*')[1:3], ';') END AS authors
FROM (SELECT pos, year, authors, pos % 2 = 0 AS has, (1900 + pos % 100) || replace(species, ' ', 'X') || 'AbcDef-Weiss' AS pid FROM articles)"""))
def f14(t: Tables) -> DataFrame:
    pid = F.concat((1900 + F.col("pos") % 100).cast("string"), F.translate("species", " ", "X"), F.lit("AbcDef-Weiss"))
    has = F.col("pos") % 2 == 0
    return fx.articles(t).select(
        "pos", F.when(has, F.col("year")).otherwise(R.paper_id_year(pid)).alias("year"),
        F.array_join(F.when(has, F.col("authors")).otherwise(R.paper_id_authors(pid)), ";").alias("authors"),
    )


@query("f15_normalize_title", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(title, '<[^>]+>', ' ', 'g')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title
FROM (SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&quot;', '"'), '&amp;', '&') AS title FROM pages)""")
def f15(t: Tables) -> DataFrame:
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return t.pages.select("page_id", X.normalize_title(title).alias("title"))


@query("f16_doi_from_text", sql("chunks", """
SELECT chunk_id, doi, 'https://doi.org/' || doi AS doi_url FROM (
  SELECT chunk_id, CASE seq % 4 WHEN 3 THEN NULL ELSE '10.1000/x' || seq END AS doi FROM chunks)"""))
def f16(t: Tables) -> DataFrame:
    seq = F.col("seq").cast("string")
    tail = (
        F.when(F.col("seq") % 4 == 0, F.concat(F.lit(" see https://doi.org/10.1000/x"), seq, F.lit(".")))
        .when(F.col("seq") % 4 == 1, F.concat(F.lit(" doi: 10.1000/x"), seq, F.lit(");")))
        .when(F.col("seq") % 4 == 2, F.concat(F.lit(" (doi.org/10.1000/x"), seq, F.lit("), p. 1")))
        .otherwise(F.lit(""))
    )
    doi = X.first_doi(F.concat("text", tail))
    return fx.chunks(t).select("chunk_id", doi.alias("doi"), R.doi_url(doi).alias("doi_url"))


@query("f17_extract_binomials", r"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '\b[A-Z][a-z]+\s+[a-z]+\b'), lambda x: regexp_replace(x, '\s+', ' ')), ';') AS names
FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', 'x', 'g') AS text FROM documents)""")
def f17(t: Tables) -> DataFrame:
    plain = F.regexp_replace("text", r"[^\x00-\x7F]", "x")
    return t.documents.select("doc_id", F.array_join(X.extract_binomials(plain), ";").alias("names"))


PHRASES_SQL = r"""
SELECT item_id, phrase, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, i) AS pos FROM (
  SELECT item_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase, w[i:i + n - 1] AS run
  FROM (SELECT item_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM benchmark),
       (SELECT unnest([4, 3, 2, 1]) AS n), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i))
WHERE len(list_filter(run, lambda x: regexp_matches(x, '^\p{Lu}'))) > 0"""


@query("f18_candidate_phrases", PHRASES_SQL)
def f18(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.posexplode(X.candidate_phrases("text")).alias("p", "phrase")).select(
        "item_id", "phrase", (F.col("p") + 1).cast("bigint").alias("pos")
    )


@query("f19_entity_id", f"""
SELECT p_partkey, 'species::' || trim(regexp_replace(regexp_replace(lower(p_name || '  é ' || p_type || '#' || p_partkey), '[éÉ]', 'e', 'g'), '[^a-z0-9_]+', '_', 'g'), '_') AS entity_id FROM part""")
def f19(t: Tables) -> DataFrame:
    name = F.concat("p_name", F.lit("  é "), "p_type", F.lit("#"), F.col("p_partkey").cast("string"))
    return t.part.select("p_partkey", ids.entity_id(F.lit(" Species "), name).alias("entity_id"))


@query("f20_clean_relation", """
SELECT event_id, round(greatest(0.0, least(1.0, CASE WHEN event_id % 9 = 0 THEN 1.0 ELSE value / 20 - 0.2 END)), 6) AS confidence,
  left(repeat(event_type || ' ', 30), 200) AS snippet FROM events""")
def f20(t: Tables) -> DataFrame:
    conf = F.when(F.col("event_id") % 9 != 0, F.col("value") / 20 - 0.2)
    return t.events.select(
        "event_id", F.round(R.clamp_confidence(conf), 6).alias("confidence"),
        F.left(F.repeat(F.concat("event_type", F.lit(" ")), F.lit(30)), F.lit(200)).alias("snippet"),
    )


@query("f22_cosine", sql("question_vectors vectors", """
SELECT q.query_id, v.chunk_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS cosine
FROM question_vectors q JOIN vectors v ON q.query_id = v.seq % (SELECT count(*) FROM question_vectors)"""))
def f22(t: Tables) -> DataFrame:
    q = fx.question_vectors(t)
    n = q.agg(F.count("*")).scalar()
    v = fx.vectors(t).withColumn("query_id", F.col("seq") % n).withColumnRenamed("embedding", "other")
    return v.join(q, "query_id").select("query_id", "chunk_id", F.round(V.cosine("embedding", "other"), 6).alias("cosine"))


@query("f23_to_similarity", sql("question_vectors vectors", """
SELECT v.chunk_id, round((c + 1) / 2, 6) AS from_cosine, round(1 / (1 + d), 6) AS from_l2 FROM (
  SELECT v.chunk_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS c,
         list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) ** 2 AS d
  FROM question_vectors q JOIN vectors v ON q.query_id = v.seq % (SELECT count(*) FROM question_vectors)) v"""))
def f23(t: Tables) -> DataFrame:
    q = fx.question_vectors(t)
    n = q.agg(F.count("*")).scalar()
    v = fx.vectors(t).withColumn("query_id", F.col("seq") % n).withColumnRenamed("embedding", "other")
    j = v.join(q, "query_id")
    square = F.aggregate(
        F.zip_with("embedding", "other", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))),
        F.lit(0.0), lambda s, x: s + x,
    )
    return j.select(
        "chunk_id", F.round(V.to_similarity(V.cosine("embedding", "other")), 6).alias("from_cosine"),
        F.round(V.to_similarity(square, "l2"), 6).alias("from_l2"),
    )


@query("f24_rerank_bonus", sql("articles", """
SELECT pos, round(CASE WHEN title <> '' THEN 0.02 ELSE 0 END + CASE WHEN len(authors) > 0 THEN 0.02 ELSE 0 END
  + CASE WHEN year <> 0 THEN 0.02 ELSE 0 END + CASE WHEN doi <> '' THEN 0.01 ELSE 0 END
  + CASE WHEN year >= 2000 THEN (year - 2000) * 0.001 ELSE 0 END, 6)::DOUBLE AS bonus FROM articles"""))
def f24(t: Tables) -> DataFrame:
    return fx.articles(t).select("pos", F.round(R.rerank_bonus(F.col("title"), F.col("authors"), F.col("year"), F.col("doi")), 6).alias("bonus"))


GENERIC_SQL = "[" + ", ".join(f"'{w}'" for w in fixed.GENERIC_WORDS) + "]"
KEY_TERMS_SQL = rf"""
SELECT item_id, CASE WHEN len(key) > 0 THEN key ELSE bare END AS terms FROM (
  SELECT item_id, bare, list_filter(bare, lambda w: NOT list_contains({GENERIC_SQL}, w) AND length(w) > 3) AS key FROM (
    SELECT item_id, list_transform(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''), lambda w: trim(lower(w), '.,;:()[]')) AS bare
    FROM benchmark))"""


@query("f25_key_terms", f"SELECT item_id, array_to_string(terms, ' ') AS terms FROM ({KEY_TERMS_SQL})")
def f25(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.array_join(X.key_terms("text"), " ").alias("terms"))


RELEVANCE_SQL = rf"""
SELECT pos, CASE WHEN len(terms) = 0 THEN 1.0 ELSE len(list_filter(terms, lambda t: contains(body, t)
   OR (length(t) >= 5 AND regexp_matches(' ' || regexp_replace(body, '\s+', ' ', 'g'), ' ' || left(t, 4))))) / len(terms) END AS relevance
FROM (SELECT pos, terms, lower(concat_ws(' ', title, abstract, array_to_string(keywords, ' '))) AS body
      FROM articles JOIN ({KEY_TERMS_SQL}) USING (item_id))"""


@query("f26_relevance_score", sql("articles", f"SELECT pos, round(relevance, 6) AS relevance, relevance >= 0.3 AS kept FROM ({RELEVANCE_SQL})"))
def f26(t: Tables) -> DataFrame:
    """Each article is judged by the question whose search returned it."""
    terms = t.benchmark.select("item_id", X.key_terms("text").alias("terms"))
    body = X.search_body(F.col("title"), F.col("abstract"), F.col("keywords"))
    j = fx.articles(t).join(terms, "item_id").withColumn("body", body)
    j = j.withColumn("relevance", F.round(X.relevance_score(F.col("terms"), F.col("body")), 6))
    return j.select("pos", "relevance", (F.col("relevance") >= 0.3).alias("kept"))


@query("f27_normalize_sex", """
SELECT event_id, CASE lower(event_type) WHEN 'click' THEN 'male' WHEN 'view' THEN 'female' WHEN 'error' THEN NULL ELSE 'combined' END AS sex FROM events""")
def f27(t: Tables) -> DataFrame:
    code = (
        F.when(F.col("event_type") == "click", F.when(F.col("event_id") % 2 == 0, "1").otherwise("M"))
        .when(F.col("event_type") == "view", F.when(F.col("event_id") % 2 == 0, "2").otherwise("Female"))
        .when(F.col("event_type") == "error", F.lit(None)).otherwise(F.when(F.col("event_id") % 2 == 0, "0").otherwise("juv."))
    )
    return t.events.select("event_id", R.normalize_sex(code).alias("sex"))


@query("f28_safe_numbers", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 0.0 ELSE value END AS number,
  CASE event_id % 5 WHEN 0 THEN -999 WHEN 1 THEN NULL WHEN 2 THEN 0 ELSE trunc(value) END::BIGINT AS whole FROM events""")
def f28(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 5
    raw = F.when(kind == 0, "-999").when(kind == 1, "n/a").when(kind == 2, "0").otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", R.safe_float(raw).alias("number"), R.safe_int(raw).alias("whole"))


@query("f29_split_species", sql("species", r"""
SELECT pos, coalesce(w[1], '') AS genus, w[2] AS epithet FROM (SELECT pos, list_filter(regexp_split_to_array(species, '\s+'), lambda x: x <> '') AS w FROM species)"""))
def f29(t: Tables) -> DataFrame:
    return fx.species(t).select("pos", R.genus("species").alias("genus"), R.epithet("species").alias("epithet"))


@query("f30_best_oa_url", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '/best.pdf' WHEN 1 THEN url WHEN 2 THEN url || '/other.pdf' END AS oa_url,
  CASE page_id % 4 WHEN 0 THEN url || '/best.pdf' WHEN 1 THEN url || '/oa' WHEN 2 THEN url || '/p.pdf' ELSE url END AS openalex_url FROM pages""")
def f30(t: Tables) -> DataFrame:
    kind, u = F.col("page_id") % 4, F.col("url")
    location = lambda pdf, page: F.struct(pdf.alias("url_for_pdf"), page.alias("url"))
    null = F.lit(None).cast("string")
    payload = F.to_json(
        F.struct(
            F.when(kind == 0, location(F.concat(u, F.lit("/best.pdf")), u)).when(kind == 1, location(F.lit(""), u)).alias("best_oa_location"),
            F.when(kind == 2, F.array(location(null, null), location(F.concat(u, F.lit("/other.pdf")), u))).alias("oa_locations"),
            F.struct(F.when(kind == 0, F.concat(u, F.lit("/best.pdf"))).otherwise(F.lit("")).alias("pdf_url")).alias("best"),
            F.struct(
                F.when(kind == 2, F.concat(u, F.lit("/p.pdf"))).alias("pdf_url"), F.when(kind == 3, u).alias("landing_page_url")
            ).alias("primary"),
            F.struct(F.when(kind == 1, F.concat(u, F.lit("/oa"))).alias("oa_url")).alias("access"),
        )
    )
    schema = (
        "best_oa_location struct<url_for_pdf:string,url:string>, oa_locations array<struct<url_for_pdf:string,url:string>>, "
        "best struct<pdf_url:string>, primary struct<pdf_url:string,landing_page_url:string>, access struct<oa_url:string>"
    )
    j = t.pages.select("page_id", F.from_json(payload, schema).alias("j"))
    return j.select(
        "page_id", R.best_oa_url(F.col("j.best_oa_location"), F.col("j.oa_locations")).alias("oa_url"),
        R.openalex_oa_url(F.col("j.best"), F.col("j.primary"), F.col("j.access")).alias("openalex_url"),
    )


@query("f31_rewrite_links", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://arxiv.org/pdf/2301.' || page_id END AS pdf,
  CASE WHEN page_id % 2 = 1 THEN 'PMC' || page_id END AS pmcid, 'https://pubmed.ncbi.nlm.nih.gov/' || page_id || '/' AS pubmed,
  'https://doi.org/10.1000/' || page_id AS doi FROM pages""")
def f31(t: Tables) -> DataFrame:
    i = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://arxiv.org/abs/2301."), i)).otherwise(
        F.concat(F.lit("https://x.org/pmc/articles/PMC"), i, F.lit("/"))
    )
    return t.pages.select(
        "page_id", R.arxiv_pdf(url).alias("pdf"), R.pmcid(url).alias("pmcid"), R.pubmed_url(i).alias("pubmed"),
        R.doi_url(F.concat(F.lit("10.1000/"), i)).alias("doi"),
    )


@query("f33_normalize_domain", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '[0-9]+', ' ', 'g'), '\s+', ' ', 'g')) AS norm FROM documents""")
def f33(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.normalize_domain("text").alias("norm"))


@query("f36_extraction_prompt", sql("chunks articles", """
SELECT chunk_id, concat_ws(chr(10), 'Paper: ' || title, 'Year: ' || year, CASE WHEN len(authors) > 0 THEN 'Authors: ' || array_to_string(authors[1:3], ', ') END,
  'Page: ' || page_number) || chr(10) || chr(10) || 'TEXT:' || chr(10) || text AS prompt
FROM chunks JOIN articles ON pos = doc_id"""))
def f36(t: Tables) -> DataFrame:
    meta = fx.articles(t).select(F.col("pos").alias("doc_id"), "title", "year", "authors")
    return fx.chunks(t).join(meta, "doc_id").select("chunk_id", extraction_prompt().alias("prompt"))


@query("f37_fix_linebreaks", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS title FROM documents")
def f37(t: Tables) -> DataFrame:
    """Titles with line ends inside, through a CSV file."""
    path = work_path(t.spark, "titles")
    t.documents.select("doc_id", F.col("text").alias("title")).write.options(**CSV).csv(path)
    return fix_linebreaks(t.spark.read.options(**CSV).schema("doc_id bigint, title string").csv(path))


@query("f39_build_search_queries", sql("species_base", """
SELECT item_id, '"' || species || '"[Organism] AND ("Baja"[Title/Abstract] OR "Gulf"[Title/Abstract])' AS pubmed,
  'TITLE-ABS-KEY("' || species || '") AND TITLE-ABS-KEY("Baja") AND TITLE-ABS-KEY("Gulf")' AS scopus,
  'ti:"' || species || '" AND (ti:"Baja" OR ti:"Gulf")' AS arxiv, '"' || species || '" AND ("Baja" OR "Gulf")' AS crossref FROM species_base"""))
def f39(t: Tables) -> DataFrame:
    return fx.species_base(t).select(
        "item_id", *[R.search_query(s, F.col("species"), ["Baja", "Gulf"]).alias(s) for s in ("pubmed", "scopus", "arxiv", "crossref")]
    )
