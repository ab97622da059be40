"""Article filters, deduplication, linkage and work lists as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.functions import records as R, text as X
from scholia.functions.ids import progress_key
from scholia.operators import articles as A
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.plans.q_text import RELEVANCE_SQL
from scholia.registry import Tables, query

RELEVANT = """(source NOT IN ('CrossRef', 'ArXiv') OR (contains(lower(title), lower(split_part(species, ' ', 1)))
  AND contains(lower(title), lower(split_part(species, ' ', 2)))))"""


def big(c: str):
    return F.col(c).cast("bigint").alias(c)


@query("p01_filter_noisy", sql("articles", f"SELECT pos, source, title FROM articles WHERE {RELEVANT}"))
def p01(t: Tables) -> DataFrame:
    return A.filter_noisy(fx.articles(t)).select("pos", "source", "title")


@query("p02_noise_report", sql("articles", f"""
SELECT count(*) AS species_total, sum(n)::BIGINT AS rows_total, sum(n - kept)::BIGINT AS rows_removed, sum(kept)::BIGINT AS rows_kept,
  sum(CASE WHEN kept = 0 THEN 1 ELSE 0 END)::BIGINT AS species_empty
FROM (SELECT species, count(*) AS n, sum(CASE WHEN {RELEVANT} THEN 1 ELSE 0 END) AS kept FROM articles GROUP BY species)"""))
def p02(t: Tables) -> DataFrame:
    return A.noise_report(fx.articles(t))


@query("p03_is_noisy_file", sql("articles", """
SELECT count(*) AS noisy_files, sum(length(title))::BIGINT AS freed FROM (SELECT *, source || '_' || title || '.pdf' AS name FROM articles)
WHERE (name LIKE 'CrossRef!_%' ESCAPE '!' OR name LIKE 'ArXiv!_%' ESCAPE '!')
  AND len(list_filter(string_split(lower(species), ' '), lambda w: length(w) > 3 AND contains(lower(name), w))) = 0"""))
def p03(t: Tables) -> DataFrame:
    name = F.concat("source", F.lit("_"), "title", F.lit(".pdf"))
    noisy = fx.articles(t).where(A.is_noisy_file(name, F.col("species")))
    return noisy.agg(F.count("*").alias("noisy_files"), F.sum(F.length("title")).alias("freed"))


@query("p04_filter_years", sql("articles", "SELECT pos, year FROM articles WHERE year IS NULL OR year BETWEEN 2000 AND 2015"))
def p04(t: Tables) -> DataFrame:
    return A.filter_years(fx.articles(t), 2000, 2015).select("pos", "year")


REGION = ["der und", "the of", "de la"]


@query("p05_filter_region", sql("articles", """
SELECT pos, 'any' AS mode FROM articles WHERE regexp_matches(lower(title), 'der und|the of|de la') OR regexp_matches(lower(coalesce(abstract, '')), 'der und|the of|de la')
UNION ALL SELECT pos, 'joined' FROM articles WHERE contains(lower(title), 'der und the of de la') OR contains(lower(coalesce(abstract, '')), 'der und the of de la')"""))
def p05(t: Tables) -> DataFrame:
    a = fx.articles(t)
    parts = [A.filter_region(a, REGION, ["title", "abstract"], m).select("pos", F.lit(m).alias("mode")) for m in ("any", "joined")]
    return parts[0].union(parts[1])


@query("p06_matches_query", sql("articles", """
SELECT pos FROM articles WHERE contains(lower(title), lower(split_part(species, ' ', 1))) OR contains(lower(coalesce(abstract, '')), lower(split_part(species, ' ', 1)))
  OR contains(lower(coalesce(array_to_string(keywords, chr(1)), '')), lower(split_part(species, ' ', 1)))"""))
def p06(t: Tables) -> DataFrame:
    q = F.substring_index("species", " ", 1)
    return fx.articles(t).where(A.matches_query(q, F.col("title"), F.col("abstract"), F.col("keywords"))).select("pos")


CLEAN_SPECIES = """
SELECT species, pos FROM (SELECT trim(species) AS species, pos, row_number() OVER (PARTITION BY lower(trim(species)) ORDER BY pos) AS rn FROM species
WHERE trim(species) <> '' AND NOT contains(species, '/') AND NOT contains(species, ' sp.') AND NOT contains(species, ' spp.')) WHERE rn = 1"""


@query("p07_clean_species", sql("species", CLEAN_SPECIES))
def p07(t: Tables) -> DataFrame:
    return A.clean_species(fx.species(t)).select("species", "pos")


HABITAT = """
SELECT h.species, CASE WHEN h.species IN (SELECT species FROM marine_registry) THEN 'MARINE'
  WHEN (marine OR freshwater) AND terrestrial THEN 'MARINE_FRESHWATER' WHEN marine THEN 'MARINE' WHEN freshwater THEN 'FRESHWATER'
  WHEN terrestrial THEN 'TERRESTRIAL' ELSE '' END AS habitat FROM habitats h"""


@query("p08_classify_habitat", sql("habitats marine_registry", HABITAT))
def p08(t: Tables) -> DataFrame:
    return A.classify_habitat(fx.habitats(t), fx.marine_registry(t)).select("species", "habitat")


@query("p09_route_habitat", sql("habitats marine_registry", f"""
SELECT species, habitat, CASE WHEN habitat LIKE '%MARINE%' OR habitat = 'FRESHWATER' THEN 'aquatic' WHEN habitat = 'TERRESTRIAL' THEN 'terrestrial' ELSE 'pending' END AS route
FROM ({HABITAT})"""))
def p09(t: Tables) -> DataFrame:
    return A.route_habitat(A.classify_habitat(fx.habitats(t), fx.marine_registry(t))).select("species", "habitat", "route")


@query("p10_classify_paywall", sql("articles", """
SELECT species, sum(CASE WHEN source IN ('Scopus', 'ScienceDirect') THEN 1 ELSE 0 END)::BIGINT AS paywalled,
  sum(CASE WHEN source IN ('PubMed', 'ArXiv') THEN 1 ELSE 0 END)::BIGINT AS open, count(*) AS total FROM articles GROUP BY species"""))
def p10(t: Tables) -> DataFrame:
    return A.classify_paywall(fx.articles(t))


@query("p14_valid_doi", sql("articles", """
SELECT pos, coalesce(raw LIKE '10.%', false) AS valid FROM (SELECT pos, trim(CASE WHEN pos % 7 = 0 THEN replace(doi, '10.', 'x') ELSE ' ' || doi END) AS raw FROM articles)"""))
def p14(t: Tables) -> DataFrame:
    raw = F.when(F.col("pos") % 7 == 0, F.regexp_replace("doi", r"10\.", "x")).otherwise(F.concat(F.lit(" "), "doi"))
    return fx.articles(t).select("pos", R.valid_doi(raw).alias("valid"))


@query("p15_validate_articles", sql("articles", """
SELECT pos, array_to_string(list_filter([CASE WHEN title = '' THEN 'Título vacío' END,
    CASE WHEN abstract IS NULL THEN 'Sin resumen (recomendado para mejor contexto)' END,
    CASE WHEN length(title) BETWEEN 1 AND 4 THEN 'Título muy corto' END, CASE WHEN length(abstract) BETWEEN 1 AND 19 THEN 'Resumen muy corto' END,
    CASE WHEN len(authors) = 0 THEN 'Sin autores' END, CASE WHEN year IS NULL THEN 'Sin año de publicación' END], lambda x: x IS NOT NULL), ';') AS problems,
  trim(title) <> '' AS is_valid FROM articles"""))
def p15(t: Tables) -> DataFrame:
    return A.validate_articles(fx.articles(t)).select("pos", F.array_join("problems", ";").alias("problems"), "is_valid")


@query("p16_extract_articles", sql("articles", r"""
SELECT pos, CASE WHEN pos % 10 = 0 THEN NULL ELSE trim(regexp_replace(title, '\s+', ' ', 'g')) END AS title, doi,
  CASE WHEN pos % 10 = 0 THEN 'row ' || pos || ' has no title' END AS error FROM (SELECT pos, title, CASE WHEN pos % 10 = 0 THEN NULL ELSE doi END AS doi FROM articles)
WHERE pos % 10 = 0 OR title <> ''
UNION ALL SELECT pos, NULL, NULL, 'row ' || pos || ' has no title' FROM articles WHERE pos % 10 <> 0 AND title = ''"""))
def p16(t: Tables) -> DataFrame:
    blanked = fx.articles(t).withColumn("title", F.when(F.col("pos") % 10 == 0, F.lit("  ")).otherwise(F.col("title")))
    good, errors = A.extract_articles(blanked)
    return good.select("pos", "title", "doi").unionByName(errors, allowMissingColumns=True)


@query("p17_download_plan", sql("articles", """
SELECT pos, CASE WHEN doi <> '' THEN 'doi' WHEN pos % 2 = 0 THEN 'arxiv' WHEN pos % 3 = 0 THEN 'url' WHEN pos % 5 = 0 THEN 'pubmed' END AS method,
  CASE WHEN doi <> '' THEN 'https://doi.org/' || doi WHEN pos % 2 = 0 THEN 'https://arxiv.org/pdf/' || pos WHEN pos % 3 = 0 THEN 'http://x.org/' || pos
       WHEN pos % 5 = 0 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || pos || '/' END AS link FROM articles WHERE source = 'Scopus'"""))
def p17(t: Tables) -> DataFrame:
    i = F.col("pos").cast("string")
    a = fx.articles(t).withColumns(
        {
            "arxiv_id": F.when(F.col("pos") % 2 == 0, i).otherwise(""), "pubmed_id": F.when(F.col("pos") % 5 == 0, i),
            "url": F.when(F.col("pos") % 3 == 0, F.concat(F.lit("http://x.org/"), i)),
        }
    )
    return A.download_plan(a, "Scopus").select("pos", "method", "link")


@query("p18_filter_type", "SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) = 7")
def p18(t: Tables) -> DataFrame:
    return A.filter_type(t.events, "7", "props", "$.k").select("event_id")


@query("w01_dedup_titles", sql("articles", r"""
SELECT 'lower' AS norm, pos FROM (SELECT pos, row_number() OVER (PARTITION BY species, lower(title) ORDER BY source_prio, pos) AS rn FROM articles WHERE title <> '') WHERE rn = 1
UNION ALL SELECT 'strip', pos FROM (SELECT pos, row_number() OVER (PARTITION BY lower(trim(title)) ORDER BY source_prio, pos) AS rn FROM articles WHERE trim(title) <> '') WHERE rn = 1
UNION ALL SELECT 'squeeze', pos FROM (SELECT pos, row_number() OVER (PARTITION BY trim(regexp_replace(lower(title), '\s+', ' ', 'g')) ORDER BY source_prio, pos) AS rn FROM articles) WHERE rn = 1"""))
def w01(t: Tables) -> DataFrame:
    a = fx.articles(t).select("pos", "species", "title", "source_prio")
    one = lambda n, df: df.select(F.lit(n).alias("norm"), "pos")
    return (
        one("lower", A.dedup_titles(a, "lower", ["species"])).union(one("strip", A.dedup_titles(a, "strip")))
        .union(one("squeeze", A.dedup_titles(a, "squeeze", keep_blank=True)))
    )


@query("w02_dedup_first", sql("articles", """
SELECT pos, key FROM (SELECT pos, key, row_number() OVER (PARTITION BY key ORDER BY source, pos) AS rn
  FROM (SELECT pos, source, '10.1000/' || (pos // 3) AS key FROM articles WHERE doi IS NOT NULL)) WHERE rn = 1"""))
def w02(t: Tables) -> DataFrame:
    key = F.when(F.col("doi").isNotNull(), F.concat(F.lit("10.1000/"), F.floor(F.col("pos") / 3).cast("string")))
    return A.dedup_first(fx.articles(t).select("pos", "source", key.alias("key")), "key", ["source", "pos"]).select("pos", "key")


FILES_SQL = "SELECT pos, replace(replace(species, ' ', '_'), '/', '_') || '.csv' AS file_name FROM species WHERE kind IN ('plain', 'upper', 'underscore')"
KEYED_SQL = r"""
SELECT file_name, key, species FROM (SELECT DISTINCT file_name, trim(regexp_replace(lower(translate(regexp_replace(file_name, '\.csv$', ''), '/_', '  ')), '\s+', ' ', 'g')) AS key FROM files)
JOIN canon USING (key)"""
CANON_SQL = """
SELECT key, species FROM (SELECT species, trim(lower(translate(species, '/', ' '))) AS key, row_number() OVER (PARTITION BY trim(lower(translate(species, '/', ' '))) ORDER BY pos) AS rn
FROM species WHERE kind <> 'underscore') WHERE rn = 1"""


def result_files(t: Tables) -> DataFrame:
    """Result files of the plain, upper-case and underscore spellings of each species."""
    s = fx.species(t).where(F.col("kind").isin("plain", "upper", "underscore"))
    return s.select(F.concat(F.translate("species", " /", "__"), F.lit(".csv")).alias("file_name")).distinct()


def taxonomy(t: Tables) -> DataFrame:
    return fx.species(t).where(F.col("kind") != "underscore")


@query("w03_prefer_file", sql("species", """
SELECT key, file_name FROM (SELECT key, file_name, row_number() OVER (PARTITION BY key
  ORDER BY file_name <> replace(species, ' ', '_') || '.csv', lower(file_name), file_name) AS rn FROM keyed) WHERE rn = 1""",
    files=FILES_SQL, canon=CANON_SQL, keyed=KEYED_SQL))
def w03(t: Tables) -> DataFrame:
    return A.canonicalize_results(taxonomy(t), result_files(t))["selected"].select("key", F.col("selected_file").alias("file_name"))


@query("j06_canonicalize_results", sql("species", r"""
SELECT 'selected' AS kind, key, count(*)::VARCHAR AS info FROM keyed GROUP BY key
UNION ALL SELECT 'missing', key, species FROM canon WHERE key NOT IN (SELECT key FROM keyed)
UNION ALL SELECT 'summary', 'species_total', (SELECT count(*) FROM canon)::VARCHAR
UNION ALL SELECT 'summary', 'species_with_file', (SELECT count(DISTINCT key) FROM keyed)::VARCHAR
UNION ALL SELECT 'summary', 'species_missing', (SELECT count(*) FROM canon WHERE key NOT IN (SELECT key FROM keyed))::VARCHAR
UNION ALL SELECT 'summary', 'duplicates_ignored', (SELECT count(*) - count(DISTINCT key) FROM keyed)::VARCHAR
UNION ALL SELECT 'summary', 'files_total', (SELECT count(DISTINCT file_name) FROM files)::VARCHAR
UNION ALL SELECT 'summary', 'files_non_canonical', (SELECT (SELECT count(DISTINCT file_name) FROM files) - (SELECT count(*) FROM keyed))::VARCHAR""",
    files=FILES_SQL, canon=CANON_SQL, keyed=KEYED_SQL))
def j06(t: Tables) -> DataFrame:
    out = A.canonicalize_results(taxonomy(t), result_files(t))
    measures = ["species_total", "species_with_file", "species_missing", "duplicates_ignored", "files_total", "files_non_canonical"]
    summary = out["summary"].unpivot([], measures, "key", "info").select(F.lit("summary").alias("kind"), "key", F.col("info").cast("string"))
    selected = out["selected"].select(F.lit("selected").alias("kind"), "key", F.col("candidates").cast("string").alias("info"))
    missing = out["missing"].select(F.lit("missing").alias("kind"), "key", F.col("species").alias("info"))
    stray = out["non_canonical"].select(F.lit("non_canonical").alias("kind"), "key", F.col("file_name").alias("info"))
    return selected.union(missing).union(stray).union(summary)


@query("k01_cap_per_group", sql("articles", """
SELECT species, pos, rn AS rank FROM (SELECT species, pos, row_number() OVER (PARTITION BY species ORDER BY source_prio, pos) AS rn FROM articles) WHERE rn <= 20"""))
def k01(t: Tables) -> DataFrame:
    return A.cap_per_group(fx.articles(t).select("species", "pos", "source_prio"), 20).select("species", "pos", big("rank"))


@query("k02_head_fraction", sql("species", """
SELECT species, pos FROM (SELECT *, row_number() OVER (ORDER BY pos) AS rn, count(*) OVER () AS n FROM species) WHERE rn <= greatest(1, floor(n * 0.13))"""))
def k02(t: Tables) -> DataFrame:
    return A.head_fraction(fx.species(t), 0.13).select("species", "pos")


@query("k03_sample_n", "SELECT doc_id, n_chars FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 20")
def k03(t: Tables) -> DataFrame:
    return A.sample_n(t.documents.select("doc_id", "n_chars"), 20, "doc_id")


@query("k04_top_groups", sql("articles", "SELECT species, count(*) AS n FROM articles GROUP BY species ORDER BY n DESC, species LIMIT 20"))
def k04(t: Tables) -> DataFrame:
    return A.top_groups(fx.articles(t), "species", 20)


@query("k07_distinct_sorted", "SELECT DISTINCT source, lang FROM documents")
def k07(t: Tables) -> DataFrame:
    return A.distinct_sorted(t.documents, "source", "lang")


CITED = "coalesce(try_cast(CASE WHEN pos % 4 = 0 THEN 'n/a' ELSE (pos * 37 % 101)::VARCHAR END AS INTEGER), 0)"


@query("k08_order_articles", sql("articles", f"""
SELECT 'date' AS kind, pos FROM (SELECT pos FROM articles ORDER BY year DESC NULLS LAST, pos LIMIT 20)
UNION ALL SELECT 'cited', pos FROM (SELECT pos FROM articles ORDER BY {CITED} DESC, pos LIMIT 20)
UNION ALL SELECT 'relevance', pos FROM (SELECT pos FROM ({RELEVANCE_SQL}) ORDER BY round(relevance, 9) DESC, pos LIMIT 20)"""))
def k08(t: Tables) -> DataFrame:
    cited = F.when(F.col("pos") % 4 == 0, "n/a").otherwise((F.col("pos") * 37 % 101).cast("string"))
    a = with_relevance(t).withColumn("citations", cited)
    one = lambda by: A.order_articles(a, by, 20).select(F.lit(by).alias("kind"), "pos")
    return one("date").union(one("cited")).union(one("relevance"))


def with_relevance(t: Tables) -> DataFrame:
    terms = t.benchmark.select("item_id", X.key_terms("text").alias("terms"))
    body = X.search_body(F.col("title"), F.col("abstract"), F.col("keywords"))
    a = fx.articles(t).join(terms, "item_id").withColumn("body", body)
    return a.withColumn("relevance", F.round(X.relevance_score(F.col("terms"), F.col("body")), 9)).drop("body", "terms")


@query("u01_union_sources", sql("articles", "SELECT pos, source, source_prio, CASE WHEN source <> 'PLOS' THEN doi END AS doi FROM articles"))
def u01(t: Tables) -> DataFrame:
    a = fx.articles(t)
    parts = {}
    for s in ("PubMed", "CrossRef", "Scopus", "ScienceDirect", "ArXiv", "PLOS"):
        cols = ["pos", "title"] + ([] if s == "PLOS" else ["doi"])
        parts[s] = a.where(F.col("source") == s).select(*cols)
    return A.union_sources(parts).select("pos", "source", "source_prio", "doi")


@query("u03_distinct_species", sql("articles", "SELECT DISTINCT species FROM articles WHERE trim(species) <> ''"))
def u03(t: Tables) -> DataFrame:
    return A.distinct_species(fx.articles(t))


@query("w14_shard", sql("articles", """
SELECT pos FROM (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS rn FROM articles WHERE doi IS NOT NULL) WHERE rn % 4 = 1"""))
def w14(t: Tables) -> DataFrame:
    return A.shard(fx.articles(t).where(F.col("doi").isNotNull()).select("pos"), 1, 4)


REGISTRY_SQL = "SELECT 'doc_' || pos AS paper_id, title, authors, year, doi FROM articles WHERE doi IS NOT NULL"


def registry(t: Tables) -> DataFrame:
    return fx.articles(t).where(F.col("doi").isNotNull()).select(
        F.concat(F.lit("doc_"), F.col("pos").cast("string")).alias("paper_id"), "title", "authors", "year", "doi"
    )


@query("j01_enrich_chunks", sql("chunks articles", """
SELECT chunk_id, CASE WHEN r.paper_id IS NULL THEN 'old' ELSE title END AS title, array_to_string(authors, ';') AS authors, year, doi
FROM chunks c LEFT JOIN reg r ON c.paper_id = r.paper_id""", reg=REGISTRY_SQL))
def j01(t: Tables) -> DataFrame:
    c = fx.chunks(t).withColumn("title", F.lit("old"))
    return A.enrich_chunks(c, registry(t)).select("chunk_id", "title", F.array_join("authors", ";").alias("authors"), "year", "doi")


@query("j02_enrich_report", sql("chunks articles", """
SELECT sum(CASE WHEN r.paper_id IS NOT NULL THEN n ELSE 0 END)::BIGINT AS chunks_updated,
  sum(CASE WHEN r.paper_id IS NULL THEN 1 ELSE 0 END)::BIGINT AS papers_without_metadata, count(*) AS papers
FROM (SELECT paper_id, count(*) AS n FROM chunks GROUP BY paper_id) c LEFT JOIN reg r ON c.paper_id = r.paper_id""", reg=REGISTRY_SQL))
def j02(t: Tables) -> DataFrame:
    return A.enrich_report(fx.chunks(t), registry(t))


@query("j03_pending", sql("articles", """
SELECT 'id' AS kind, pos FROM articles WHERE pos NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'key', pos FROM articles WHERE lower(trim(species)) || '::' || source || '::' || lower(trim(title))
  NOT IN (SELECT lower(trim(species)) || '::' || source || '::' || lower(trim(title)) FROM articles JOIN labels ON pos = doc_id)"""))
def j03(t: Tables) -> DataFrame:
    a = fx.articles(t)
    by_id = A.pending(a, t.labels, "pos", "doc_id").select(F.lit("id").alias("kind"), "pos")
    done = a.join(t.labels, F.col("pos") == F.col("doc_id")).withColumn("species", F.upper("species"))
    key = progress_key(F.col("species"), F.col("source"), F.col("title"))
    by_key = A.pending(a, done, key, key, ignore_case=True).select(F.lit("key").alias("kind"), "pos")
    return by_id.union(by_key)


@query("j04_missing_species", sql("species articles", """
SELECT s.pos, s.species, CASE WHEN n IS NULL THEN 'missing' ELSE 'empty' END AS reason FROM species s
LEFT JOIN (SELECT lower(species) AS k, count(CASE WHEN year > 2010 THEN nullif(title, '') END) AS n FROM articles WHERE source = 'PubMed' GROUP BY 1) ON k = lower(s.species)
WHERE n IS NULL OR n = 0"""))
def j04(t: Tables) -> DataFrame:
    results = fx.articles(t).where(F.col("source") == "PubMed").withColumn("title", F.when(F.col("year") > 2010, F.col("title")).otherwise(""))
    return A.missing_species(fx.species(t), results).select("pos", "species", "reason")


@query("j05_pending_dois", sql("articles", """
SELECT pos, doi FROM articles WHERE doi LIKE '10.%' AND doi NOT IN (SELECT '10.1000/' || doc_id FROM labels WHERE quality = 1)
  AND doi NOT IN (SELECT '10.1000/' || doc_id FROM labels WHERE toxic = 1)"""))
def j05(t: Tables) -> DataFrame:
    doi = F.concat(F.lit("10.1000/"), F.col("doc_id").cast("string")).alias("doi")
    stored, failed = t.labels.where("quality = 1").select(doi), t.labels.where("toxic = 1").select(doi)
    return A.pending_dois(fx.articles(t), stored, failed).select("pos", "doi")


@query("j16_link_titles")
def j16(t: Tables) -> DataFrame:
    """Articles whose download failed, with the sentences of their own text as candidates."""
    failed = fx.articles(t).join(t.labels.where("quality = 0").select(F.col("doc_id").alias("pos")), "pos")
    failed = failed.select(F.col("pos").alias("row_id"), "title")
    sentences = F.filter(F.transform(F.split("text", r"[.\n]"), F.trim), lambda s: s != "")
    candidates = t.documents.select(F.col("doc_id").alias("row_id"), F.posexplode(sentences).alias("pos", "candidate_title"))
    candidates = candidates.withColumn("oa_url", F.when(F.col("pos") % 2 == 1, "http://x.org/pdf"))
    return A.link_titles(failed, candidates).select("row_id", "candidate_title", F.round("score", 6).alias("score"), "accepted")


@query("w05_best_candidate", sql("chunks", """
SELECT doc_id, chunk_index AS pos, score, score >= 0.78 AS accepted FROM (
  SELECT doc_id, chunk_index, (length(text) % 10) / 10.0 AS score, row_number() OVER (PARTITION BY doc_id ORDER BY length(text) % 10 DESC, chunk_index) AS rn FROM chunks) WHERE rn = 1"""))
def w05(t: Tables) -> DataFrame:
    scored = fx.chunks(t).select("doc_id", F.col("chunk_index").alias("pos"), ((F.length("text") % 10) / 10.0).alias("score"))
    return A.best_candidate(scored, "doc_id").select("doc_id", "pos", "score", "accepted")


@query("j19_merge_new", sql("articles", """
SELECT pos FROM articles WHERE lang = 'en' UNION ALL
SELECT pos FROM (SELECT pos, title, row_number() OVER (PARTITION BY lower(trim(title)) ORDER BY pos) AS rn FROM articles WHERE lang <> 'en' AND trim(title) <> '')
WHERE rn = 1 AND lower(trim(title)) NOT IN (SELECT lower(trim(title)) FROM articles WHERE lang = 'en')"""))
def j19(t: Tables) -> DataFrame:
    a = fx.articles(t).select("pos", "title", "lang")
    return A.merge_new(a.where("lang = 'en'"), a.where("lang <> 'en'")).select("pos")


@query("r11_search_articles", sql("articles", f"""
SELECT species, pos, rank FROM (
  SELECT species, pos, row_number() OVER (PARTITION BY species ORDER BY source_prio, pos) AS rank FROM (
    SELECT species, pos, source_prio, row_number() OVER (PARTITION BY species, lower(title) ORDER BY source_prio, pos) AS rn
    FROM articles WHERE {RELEVANT} AND title <> '') JOIN ({RELEVANCE_SQL}) USING (pos) WHERE rn = 1 AND relevance >= 0.3) WHERE rank <= 20"""))
def r11(t: Tables) -> DataFrame:
    return A.search_articles(with_relevance(t), 20, least_relevance=0.3).select("species", "pos", big("rank"))
