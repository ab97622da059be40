"""Sources and sinks as queries: what is written is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.operators import graph as G
from scholia.operators.bm25 import bm25_index, bm25_search
from scholia.operators.stats import completeness
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.plans.q_graph import star_graph
from scholia.plans.q_retrieval import ranked
from scholia.plans.q_stats import rounded
from scholia.registry import Tables, query
from scholia.session import work_path
from scholia.sources import files as S, payloads as P, tables as B, tei

SEARCH_ROWS = """
SELECT species, source, title, array_to_string(authors[1:3], ', ') AS authors, coalesce(year::VARCHAR, '') AS year, journal, coalesce(doi, '') AS doi FROM articles"""


@query("s01_read_search_results", sql("articles", "SELECT species, count(*) AS n, sum(length(title))::BIGINT AS chars, count(DISTINCT source) AS sources FROM articles GROUP BY species"))
def s01(t: Tables) -> DataFrame:
    df = round_trip_articles(t)
    return df.groupBy("species").agg(F.count("*").alias("n"), F.sum(F.length("title")).alias("chars"), F.count_distinct("source").alias("sources"))


def round_trip_articles(t: Tables) -> DataFrame:
    path = work_path(t.spark, "articles")
    S.write_articles(fx.articles(t).withColumn("authors", S.authors_line()), path)
    return S.read_search_results(t.spark, path)


@query("s05_write_articles", sql("articles", SEARCH_ROWS))
def s05(t: Tables) -> DataFrame:
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return round_trip_articles(t).select("species", "source", empty("title"), empty("authors"), empty("year"), "journal", empty("doi"))


@query("s02_read_species", sql("species", "SELECT trim(species) AS species FROM species"))
def s02(t: Tables) -> DataFrame:
    path = work_path(t.spark, "taxonomy")
    padded = fx.species(t).select(F.concat(F.lit("  "), "species", F.lit(" ")).alias("species"), "pos")
    blank = fx.species(t).select(F.lit("   ").alias("species"), "pos")
    padded.union(blank).write.options(header="true", quoteAll="true").csv(path)
    return S.read_species(t.spark, path).select("species")


@query("s03_scan_documents", "SELECT page_id % 20 AS shelf, sum(octet_length(encode(html)) + 1)::BIGINT AS bytes FROM pages GROUP BY ALL")
def s03(t: Tables) -> DataFrame:
    """Pages written to files on twenty shelves, scanned as documents (contents are not read for this)."""
    path = work_path(t.spark, "shelves")
    t.pages.select((F.col("page_id") % 20).alias("shelf"), "html").repartition("shelf").write.partitionBy("shelf").text(path)
    found = S.scan_documents(t.spark, path, "*.txt").withColumn("shelf", F.regexp_extract("path", "shelf=([0-9]+)", 1).cast("bigint"))
    return found.where(F.col("stem") != "").groupBy("shelf").agg(F.sum("length").alias("bytes"))


@query("s04_valid_documents", """
SELECT page_id, octet_length(encode(html)) + 8 AS size FROM pages WHERE page_id % 2 = 0 AND octet_length(encode(html)) + 8 <= 1500""")
def s04(t: Tables) -> DataFrame:
    """Pages as documents: every second one starts like a PDF, the others are HTML error pages."""
    content = F.encode(F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("%PDF-1.4")).otherwise(F.lit("")), "html"), "UTF-8")
    d = t.pages.select("page_id", content.alias("content")).withColumn("length", F.octet_length("content").cast("bigint"))
    return S.valid_documents(d, 1500).select("page_id", F.col("length").alias("size"))


@query("s06_registry", sql("articles", r"""
SELECT title, array_to_string(list_transform(string_split(nullif(array_to_string(authors, '; '), ''), ';'), lambda x: trim(x)), '|') AS authors, year, doi, journal, source, abstract, array_to_string(keywords, '|') AS keywords FROM articles"""))
def s06(t: Tables) -> DataFrame:
    path = work_path(t.spark, "registry")
    S.save_registry(fx.articles(t), path, "all")
    return S.load_registry(t.spark, path).select(
        F.coalesce("title", F.lit("")).alias("title"), F.nullif(F.array_join("authors", "|"), F.lit("")).alias("authors"), "year", "doi", "journal", "source", "abstract", F.array_join("keywords", "|").alias("keywords")
    )


@query("s07_search_history", sql("articles", "SELECT 'species ' || species AS query, count(*) AS total_articles, array_to_string(list_sort(list_distinct(list(source))), ';') AS sources FROM articles GROUP BY species"))
def s07(t: Tables) -> DataFrame:
    """One run record per species, and a broken one beside each."""
    path = work_path(t.spark, "history")
    runs = fx.articles(t).groupBy(F.concat(F.lit("species "), "species").alias("query")).agg(F.count("*").alias("total_articles"), F.array_sort(F.collect_set("source")).alias("sources"))
    record = F.to_json(F.struct("query", "total_articles", "sources", F.concat(F.lit("2024-01-0"), (F.col("total_articles") % 9 + 1).cast("string")).alias("creation_date"), F.col("query").alias("filename")))
    runs.select(F.explode(F.array(record, F.lit('{"query": "broken'))).alias("value")).write.text(path)
    return S.search_history(t.spark, path, "*.txt").select("query", "total_articles", F.array_join("sources", ";").alias("sources"))


@query("s08_index_round_trip", sql("vectors", "SELECT chunk_id, paper_id, seq, round(list_sum(embedding::DOUBLE[]), 5) AS total, (SELECT count(*) FROM vectors) AS indexed FROM vectors"))
def s08(t: Tables) -> DataFrame:
    path = work_path(t.spark, "index")
    B.write_index(fx.vectors(t), path, "given")
    chunks, config = B.read_index(t.spark, path)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return chunks.select("chunk_id", "paper_id", "seq", F.round(total, 5).alias("total")).withColumn("indexed", config.select("total_chunks").scalar())


@query("s09_postings_round_trip", sql("bm25_ranked", "SELECT query_id, chunk_id, rank::BIGINT AS rank, round(score, 6) AS score FROM bm25_ranked WHERE rank <= 3 AND score > 0"))
def s09(t: Tables) -> DataFrame:
    path = work_path(t.spark, "postings")
    B.write_postings(bm25_index(fx.chunks(t)), path)
    return ranked(bm25_search(B.read_postings(t.spark, path), fx.questions(t), 3), "query_id", "chunk_id", "rank", "score")


@query("s10_graph_round_trip", sql("entities relations mentions", """
SELECT 'total' AS kind, 'entities' AS item, count(*) AS n FROM entities UNION ALL SELECT 'total', 'relations', count(*) FROM relations
UNION ALL SELECT 'total', 'papers', count(DISTINCT paper_id) FROM mentions UNION ALL SELECT 'total', 'chunks', count(DISTINCT paper_id) FROM mentions
UNION ALL SELECT 'entity_type', entity_type, count(*) FROM entities GROUP BY entity_type UNION ALL SELECT 'relation_type', relation_type, count(*) FROM relations GROUP BY relation_type"""))
def s10(t: Tables) -> DataFrame:
    path = work_path(t.spark, "graph")
    B.write_graph(star_graph(t), path)
    return G.graph_stats(B.read_graph(t.spark, path))


@query("s11_write_failures", sql("statuses", "SELECT species, 'denied ' || article AS reason FROM statuses WHERE status = 'failed'"))
def s11(t: Tables) -> DataFrame:
    path = work_path(t.spark, "failures")
    rows = fx.statuses(t).withColumn("reason", F.concat(F.lit("denied "), F.col("article").cast("string")))
    S.write_failures(rows, path)
    return S.read_failures(t.spark, path).select("species", "reason")


@query("s12_write_report", sql("articles", """
SELECT 'enrich' AS phase, count(*) AS total, count(doi) AS with_doi, round((count(nullif(title, '')) + sum(CASE WHEN len(authors) > 0 THEN 1 ELSE 0 END) + count(year) + count(doi)) / (4.0 * count(*)) * 100, 6)::DOUBLE AS pct FROM articles"""))
def s12(t: Tables) -> DataFrame:
    path = work_path(t.spark, "report")
    S.write_report(completeness(fx.articles(t)), path, "enrich")
    r = t.spark.read.json(path)
    return rounded(r.select("phase", F.col("statistics.total").alias("total"), F.col("statistics.with_doi").alias("with_doi"), F.col("statistics.completeness_pct").alias("pct")))


def payloads(t: Tables, source: str) -> DataFrame:
    """Answers of a service, built from articles: one real item and one without a title each."""
    a = fx.articles(t).withColumn("first", F.replace(F.get("authors", 0), F.lit(","), F.lit(""))).where(F.length("first") > 0).withColumn("date", F.concat(F.col("year").cast("string"), F.lit("-05-01")))
    dp = F.struct(F.array(F.array("year")).alias("date-parts"))
    person = lambda *kv: F.struct(*[v.alias(k) for k, v in kv])
    doi, title, first = F.col("doi"), F.col("title"), F.col("first")
    items = {
        "crossref": lambda ti: F.struct(
            F.array(ti).alias("title"), F.array(person(("given", first), ("family", F.lit("Doe")))).alias("author"), doi.alias("DOI"), F.concat(F.lit("http://c.org/"), F.col("pos").cast("string")).alias("URL"),
            F.array("journal").alias("container-title"), F.when(F.col("pos") % 2 == 0, dp).alias("published-online"), dp.alias("published"),
        ),
        "scopus": lambda ti: F.struct(
            ti.alias("dc:title"), F.col("date").alias("prism:coverDate"), F.when(F.col("pos") % 2 == 0, F.array(person(("authname", first)))).alias("author"), first.alias("dc:creator"), doi.alias("prism:doi"),
            F.lit("a | b,c").alias("authkeywords"), F.lit("7").alias("citedby-count"), F.col("abstract").alias("dc:description"), F.col("journal").alias("prism:publicationName"),
        ),
        "sciencedirect": lambda ti: F.struct(ti.alias("dc:title"), F.col("date").alias("prism:coverDate"), first.alias("dc:creator"), doi.alias("prism:doi"), F.col("journal").alias("prism:publicationName"), F.array(F.struct(F.lit("").alias("@href"))).alias("link")),
        "frontiers": lambda ti: F.struct(ti.alias("title"), F.col("date").alias("published_on"), F.array(person(("name", first))).alias("authors"), doi.alias("doi"), F.col("journal").alias("journal_name"), F.col("abstract")),
        "elife": lambda ti: F.struct(F.col("pos").cast("string").alias("id"), ti.alias("title"), F.col("date").alias("published"), F.array(person(("given", first), ("surname", F.lit("Doe")))).alias("authors"), doi.alias("doi"), F.col("abstract")),
        "biorxiv": lambda ti: F.struct(ti.alias("title"), F.col("abstract"), doi.alias("doi"), F.col("date"), F.concat(first, F.lit(", Doe")).alias("authors")),
        "plos": lambda ti: F.struct(doi.alias("id"), F.col("date").alias("publication_date"), F.array(first).alias("author_display"), ti.alias("title_display")),
    }
    wrap = {
        "crossref": lambda xs: F.struct(F.struct(xs.alias("items")).alias("message")), "scopus": lambda xs: F.struct(F.struct(xs.alias("entry")).alias("search-results")),
        "sciencedirect": lambda xs: F.struct(F.struct(xs.alias("entry")).alias("search-results")), "frontiers": lambda xs: F.struct(xs.alias("articles")), "elife": lambda xs: F.struct(xs.alias("articles")),
        "biorxiv": lambda xs: F.struct(xs.alias("collection")), "plos": lambda xs: F.struct(F.struct(xs.alias("docs")).alias("response")),
    }
    item = items[source]
    return a.select("pos", F.to_json(wrap[source](F.array(item(title), item(F.lit(""))))).alias("payload"))


JSON_SQL = """
SELECT s AS source, pos, trim(title) AS title, CASE s WHEN 'crossref' THEN first || ' Doe' WHEN 'elife' THEN first || ' Doe' WHEN 'biorxiv' THEN first || '|Doe' ELSE first END AS authors, year, doi,
  CASE s WHEN 'crossref' THEN 'http://c.org/' || pos WHEN 'elife' THEN 'https://elifesciences.org/articles/' || pos ELSE 'https://doi.org/' || doi END AS url,
  CASE s WHEN 'elife' THEN 'eLife' WHEN 'biorxiv' THEN 'bioRxiv/medRxiv' WHEN 'plos' THEN 'PLOS ONE' ELSE journal END AS journal,
  CASE WHEN s = 'scopus' THEN 'a|b|c' END AS keywords
FROM (SELECT *, replace(authors[1], ',', '') AS first FROM articles WHERE trim(title) <> '' AND len(authors) > 0 AND replace(authors[1], ',', '') <> ''), (SELECT unnest(['crossref', 'scopus', 'sciencedirect', 'frontiers', 'elife', 'biorxiv', 'plos']) AS s)"""


@query("s13_normalize_articles", sql("articles", JSON_SQL))
def s13(t: Tables) -> DataFrame:
    out = None
    for source in P.JSON_SCHEMAS:
        df = P.normalize_articles(payloads(t, source), source, ["pos"])
        df = df.select(
            "source", "pos", F.trim("title").alias("title"), F.array_join("authors", "|").alias("authors"), "year", F.nullif(F.col("doi"), F.lit("")).alias("doi"), "url", "journal", F.array_join("keywords", "|").alias("keywords")
        )
        out = df if out is None else out.union(df)
    return out


def escaped(c: str):
    return F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("s14_normalize_xml", sql("articles", """
SELECT 'pubmed' AS source, pos, title, 'Ann ' || authors[1] || '|Only' AS authors, year, '' AS doi, 'https://pubmed.ncbi.nlm.nih.gov/' || pos || '/' AS url, journal, 'Part one. Part two.' AS abstract, 'Fish|Sea' AS keywords
FROM articles WHERE title <> '' AND len(authors) > 0
UNION ALL SELECT 'arxiv', pos, title, 'Ann ' || authors[1] || '|Only', year, '10.48550/arXiv.2301.' || pos, 'http://arxiv.org/abs/2301.' || pos, 'arXiv preprint', 'A summary.', 'q-bio|stat'
FROM articles WHERE title <> '' AND len(authors) > 0"""))
def s14(t: Tables) -> DataFrame:
    a = fx.articles(t).where((F.col("title") != "") & (F.size("authors") > 0)).withColumn("first", F.get("authors", 0))
    year = F.when(F.col("year").isNotNull(), F.concat(F.lit("<Year>"), F.col("year").cast("string"), F.lit("</Year>"))).otherwise(F.lit(""))
    pos = F.col("pos").cast("string")
    pubmed = F.concat(
        F.lit('<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">'), pos, F.lit("</PMID><Article><Journal><JournalIssue><PubDate>"), year,
        F.lit("</PubDate></JournalIssue><Title>"), escaped("journal"), F.lit("</Title></Journal><ArticleTitle>"), escaped("title"),
        F.lit('</ArticleTitle><Abstract><AbstractText Label="A">Part one.</AbstractText><AbstractText>Part two.</AbstractText></Abstract><AuthorList><Author><LastName>'), escaped("first"),
        F.lit("</LastName><ForeName>Ann</ForeName></Author><Author><LastName>Only</LastName></Author></AuthorList></Article><MeshHeadingList><MeshHeading><DescriptorName>Fish</DescriptorName></MeshHeading>"
              "<MeshHeading><DescriptorName>Sea</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation></PubmedArticle></PubmedArticleSet>"),
    )
    published = F.when(F.col("year").isNotNull(), F.concat(F.lit("<published>"), F.col("year").cast("string"), F.lit("-02-03T00:00:00Z</published>"))).otherwise(F.lit(""))
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2301.'), pos, F.lit("</id>"), published, F.lit("<title> "), escaped("title"),
        F.lit(" </title><summary> A summary.\n</summary><author><name>Ann "), escaped("first"), F.lit('</name></author><author><name>Only</name></author><link title="pdf" href="http://arxiv.org/pdf/x" type="application/pdf"/>'
              '<link href="http://arxiv.org/abs/2301.'), pos, F.lit('" type="text/html"/><category term="q-bio"/><category term="stat"/></entry></feed>'),
    )
    cols = ["source", "pos", "title", F.array_join("authors", "|").alias("authors"), "year", "doi", "url", "journal", "abstract", F.array_join("keywords", "|").alias("keywords")]
    one = P.normalize_pubmed(a.select("pos", pubmed.alias("payload")), ["pos"]).select(*cols)
    return one.union(P.normalize_arxiv(a.select("pos", atom.alias("payload")), ["pos"]).select(*cols))


def tei_documents(t: Tables) -> DataFrame:
    """Articles as TEI; every thirteenth is broken."""
    a = fx.articles(t).withColumn("abstract", F.coalesce("abstract", F.lit("")))
    xml = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title level="a">'), escaped("title"), F.lit("</title></titleStmt><publicationStmt>"),
        F.when(F.col("year").isNotNull(), F.concat(F.lit('<date when="'), F.col("year").cast("string"), F.lit('-01-01"/>'))).otherwise(F.lit("")),
        F.lit("</publicationStmt><sourceDesc><author><persName><forename>Ann</forename><surname>"), escaped("species"), F.lit("</surname></persName></author><idno type=\"DOI\">10.1/"),
        F.col("pos").cast("string"), F.lit("</idno></sourceDesc></fileDesc><profileDesc><abstract><p>"), escaped("title"), F.lit("</p></abstract><textClass><keywords><term>sea</term></keywords></textClass></profileDesc></teiHeader><text><body><div>Intro <b>bold</b> tail</div><div>"),
        escaped("abstract"), F.lit("</div></body><back><listBibl><bibl>Ref 1</bibl></listBibl></back></text></TEI>"),
    )
    return a.select(F.concat(F.lit("doc_"), F.col("pos").cast("string")).alias("paper_id"), F.when(F.col("pos") % 13 == 0, F.lit("<TEI>broken")).otherwise(xml).alias("xml"))


@query("s15_tei_sections", sql("articles", """
SELECT paper_id, page_number, text FROM (SELECT 'doc_' || pos AS paper_id, unnest(parts) AS text, generate_subscripts(parts, 1)::BIGINT AS page_number FROM (
  SELECT pos, list_filter([title, 'Intro bold tail', coalesce(abstract, ''), 'Ref 1'], lambda x: trim(x) <> '') AS parts FROM articles WHERE pos % 13 <> 0))"""))
def s15(t: Tables) -> DataFrame:
    return tei.tei_sections(tei_documents(t)).where(F.col("error").isNull()).select("paper_id", "page_number", "text")


@query("s16_tei_metadata", sql("articles", """
SELECT 'doc_' || pos AS paper_id, title, 'Ann ' || species AS authors, title AS abstract, 'sea' AS keywords, year, '10.1/' || pos AS doi, false AS failed FROM articles WHERE pos % 13 <> 0
UNION ALL SELECT 'doc_' || pos, NULL, '', NULL, '', NULL, NULL, true FROM articles WHERE pos % 13 = 0"""))
def s16(t: Tables) -> DataFrame:
    return tei.tei_metadata(tei_documents(t)).select(
        "paper_id", "title", F.array_join("authors", "|").alias("authors"), "abstract", F.array_join("keywords", "|").alias("keywords"), "year", "doi", F.col("error").isNotNull().alias("failed")
    )
