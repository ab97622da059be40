"""Raw answers of literature services (``payload`` column) to one article table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholia.functions.records import doi_url, first_full, pubmed_url
from scholia.functions.text import strip

# Where each service keeps its list of items, and the fields read from an item.
# A field that may hold text, a list or an object is read as text first.
JSON_SCHEMAS = {
    "crossref": "message struct<items:array<struct<title:string,author:array<string>,DOI:string,URL:string,`container-title`:string,abstract:string,"
    "`published-online`:struct<`date-parts`:array<array<int>>>,published:struct<`date-parts`:array<array<int>>>>>>",
    "scopus": "`search-results` struct<entry:array<struct<`dc:title`:string,`prism:coverDate`:string,author:array<string>,`dc:creator`:string,`prism:doi`:string,"
    "`prism:url`:string,authkeywords:string,`citedby-count`:string,eid:string,`dc:description`:string,`prism:publicationName`:string>>>",
    "sciencedirect": "`search-results` struct<entry:array<struct<`dc:title`:string,`prism:coverDate`:string,`dc:creator`:string,`prism:doi`:string,"
    "`prism:publicationName`:string,link:array<struct<`@href`:string>>>>>",
    "frontiers": "articles array<struct<title:string,published_on:string,authors:array<string>,doi:string,url:string,journal_name:string,abstract:string>>",
    "elife": "articles array<struct<id:string,title:string,published:string,authors:array<string>,doi:string,url:string,abstract:string>>",
    "biorxiv": "collection array<struct<title:string,abstract:string,doi:string,date:string,authors:string>>",
    "plos": "response struct<docs:array<struct<id:string,publication_date:string,author_display:array<string>,title_display:string,journal_name:string>>>",
}
ITEMS = {
    "crossref": "message.items", "scopus": "search-results.entry", "sciencedirect": "search-results.entry", "frontiers": "articles", "elife": "articles",
    "biorxiv": "collection", "plos": "response.docs",
}


def _text_list(c: Column) -> Column:
    """Text that may be a JSON list of texts."""
    return F.when(c.startswith("["), F.from_json(c, "array<string>")).when(F.length(c) > 0, F.array(c)).otherwise(F.array().cast("array<string>"))


def _names(people: Column, family_first: bool = False) -> Column:
    """Author entries, as objects or plain texts, to names."""
    field = lambda a, f: F.coalesce(strip(F.get_json_object(a, f"$.{f}")), F.lit(""))

    def one(a):
        pair = F.when((field(a, "given") != "") & (field(a, "family") != ""), F.concat_ws(" ", field(a, "given"), field(a, "family")))
        split = F.nullif(strip(F.concat_ws(" ", field(a, "given"), field(a, "surname"))), F.lit(""))
        return F.when(a.startswith("{"), F.coalesce(pair, F.nullif(field(a, "authname"), F.lit("")), F.nullif(field(a, "name"), F.lit("")), split)).otherwise(a)

    return F.array_compact(F.transform(F.coalesce(people, F.array().cast("array<string>")), one))


def _year(c: Column) -> Column:
    return F.left(c, F.lit(4)).try_cast("int")


def _article(**fields: Column) -> list[Column]:
    null = F.lit(None).cast("string")
    empty = F.lit(None).cast("array<string>")
    defaults = {
        "title": null, "authors": F.array().cast("array<string>"), "year": F.lit(None).cast("int"), "doi": null, "url": null, "journal": null,
        "abstract": null, "keywords": empty, "full_data": null,
    }
    return [fields.get(k, v).alias(k) for k, v in defaults.items()]


def _item_columns(source: str) -> list[Column]:
    x = lambda name: F.col(f"x.`{name}`")
    clean = lambda name: F.coalesce(strip(x(name)), F.lit(""))
    full = lambda c: F.nullif(c, F.lit(""))
    if source == "crossref":
        year = lambda f: F.get(F.get(x(f)["date-parts"], 0), 0)
        return _article(
            title=F.get(_text_list(x("title")), 0), authors=_names(x("author")), year=F.when(x("published-online").isNotNull(), year("published-online")).otherwise(year("published")),
            doi=x("DOI"), url=x("URL"), journal=F.get(_text_list(x("container-title")), 0), full_data=F.to_json("x"),
        )
    if source in ("scopus", "sciencedirect"):
        doi = x("prism:doi")
        if source == "scopus":
            authors = _names(x("author"))
            words = F.transform(F.split(F.replace(x("authkeywords"), F.lit("|"), F.lit(",")), ","), strip)
            citations = F.coalesce(x("citedby-count").try_cast("int"), F.lit(0))
            extra = dict(
                authors=F.when(F.size(authors) > 0, authors).when(F.length(x("dc:creator")) > 0, F.array(x("dc:creator"))).otherwise(authors),
                url=first_full(x("prism:url"), doi_url(doi)), abstract=full(x("dc:description")),
                keywords=F.when(F.length(x("authkeywords")) > 0, F.filter(words, lambda w: w != "")),
                full_data=F.to_json(F.struct(citations.alias("citations"), F.coalesce(x("eid"), F.lit("")).alias("eid"))),
            )
        else:
            extra = dict(authors=_text_list(x("dc:creator")), url=first_full(F.get(x("link"), 0)["@href"], doi_url(doi)))
        return _article(title=clean("dc:title"), year=_year(x("prism:coverDate")), doi=doi, journal=x("prism:publicationName"), **extra)
    if source == "frontiers":
        return _article(
            title=clean("title"), authors=_names(F.slice(x("authors"), 1, 5)), year=_year(x("published_on")), doi=clean("doi"), url=first_full(x("url"), doi_url(clean("doi"))),
            journal=F.coalesce(x("journal_name"), F.lit("Frontiers")), abstract=full(clean("abstract")),
        )
    if source == "elife":
        page = F.when(F.length(x("id")) > 0, F.concat(F.lit("https://elifesciences.org/articles/"), x("id")))
        return _article(
            title=clean("title"), authors=_names(F.slice(x("authors"), 1, 5)), year=_year(x("published")), doi=clean("doi"),
            url=first_full(x("url"), page, doi_url(clean("doi"))), journal=F.lit("eLife"), abstract=full(clean("abstract")),
        )
    if source == "biorxiv":
        parts = F.when(x("authors").startswith("["), _text_list(x("authors"))).otherwise(F.transform(F.split(x("authors"), ","), strip))
        return _article(
            title=x("title"), authors=F.filter(F.slice(parts, 1, 3), lambda a: a != ""), year=_year(x("date")), doi=x("doi"), url=doi_url(x("doi")), journal=F.lit("bioRxiv/medRxiv"),
            abstract=x("abstract"), full_data=F.to_json(F.struct(x("date").alias("date"))),
        )
    if source == "plos":
        return _article(
            title=x("title_display"), authors=F.slice(F.coalesce(x("author_display"), F.array().cast("array<string>")), 1, 3), year=_year(x("publication_date")), doi=x("id"), url=doi_url(x("id")),
            journal=F.coalesce(x("journal_name"), F.lit("PLOS ONE")), full_data=F.to_json(F.struct(x("publication_date").alias("publication_date"))),
        )
    raise ValueError(f"unknown source {source}")


def normalize_articles(raw: DataFrame, source: str, keep: list[str] | None = None) -> DataFrame:
    """Articles of JSON answers (``payload``); rows without a real title are dropped."""
    keep = keep or []
    parsed = raw.select(*keep, F.from_json("payload", JSON_SCHEMAS[source]).alias("j"))
    path = F.col("j")
    for part in ITEMS[source].split("."):
        path = path[part]
    items = parsed.select(*keep, F.posexplode_outer(path).alias("item", "x")).where(F.col("x").isNotNull())
    out = items.select(*keep, "item", *_item_columns(source), F.lit(source).alias("source"))
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    return out.where((title != "") & (title != "no results found"))


def mentions(articles: DataFrame, query: Column) -> DataFrame:
    """Rows of an unfiltered feed that name the query in title or abstract."""
    q = F.lower(query)
    return articles.where(F.lower("title").contains(q) | F.coalesce(F.lower("abstract").contains(q), F.lit(False)))


# ---- XML -----------------------------------------------------------------------------------------

PUBMED = (
    "PubmedArticle array<struct<MedlineCitation:struct<PMID:string,Article:struct<ArticleTitle:string,PMID:string,"
    "Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:string>>>,AuthorList:struct<Author:array<struct<LastName:string,ForeName:string>>>,"
    "Abstract:struct<AbstractText:array<string>>>,MeshHeadingList:struct<MeshHeading:array<struct<DescriptorName:string>>>>>>"
)
ATOM = (
    "entry array<struct<id:string,title:string,published:string,updated:string,summary:string,author:array<struct<name:string>>,"
    "link:array<struct<_title:string,_href:string,_type:string>>,category:array<struct<_term:string>>>>"
)


def normalize_pubmed(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Articles of PubMed records (``payload``)."""
    keep = keep or []
    parsed = raw.select(*keep, F.from_xml("payload", PUBMED).alias("j"))
    rows = parsed.select(*keep, F.posexplode_outer("j.PubmedArticle").alias("item", "p")).where(F.col("p").isNotNull())
    rows = rows.withColumn("c", F.col("p.MedlineCitation")).withColumn("a", F.col("c.Article"))
    nonempty = lambda xs: F.filter(F.coalesce(xs, F.array().cast("array<string>")), lambda x: F.length(x) > 0)
    people = F.transform(F.filter(F.coalesce("a.AuthorList.Author", F.array().cast("array<struct<LastName:string,ForeName:string>>")), lambda p: F.length(p["LastName"]) > 0), lambda p: F.concat_ws(" ", F.nullif(p["ForeName"], F.lit("")), p["LastName"]))
    pmid = F.coalesce("a.PMID", "c.PMID")
    abstract = nonempty(F.col("a.Abstract.AbstractText"))
    words = nonempty(F.transform("c.MeshHeadingList.MeshHeading", lambda m: m["DescriptorName"]))
    return rows.select(
        *keep, "item",
        *_article(
            title=F.col("a.ArticleTitle"), authors=people, year=F.col("a.Journal.JournalIssue.PubDate.Year").try_cast("int"), doi=F.lit(""), url=pubmed_url(pmid),
            journal=F.col("a.Journal.Title"), abstract=F.when(F.size(abstract) > 0, F.array_join(abstract, " ")), keywords=F.when(F.size(words) > 0, words),
            full_data=F.to_json(F.struct(pmid.alias("pmid"))),
        ),
        F.lit("pubmed").alias("source"),
    ).where(F.length("title") > 0)


def normalize_arxiv(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Articles of an Atom feed (``payload``): categories as keywords, DOI from the arXiv id."""
    keep = keep or []
    parsed = raw.select(*keep, F.from_xml("payload", ATOM).alias("j"))
    rows = parsed.select(*keep, F.posexplode_outer("j.entry").alias("item", "e")).where(F.col("e").isNotNull())
    links = F.coalesce(F.col("e.link"), F.array().cast("array<struct<_title:string,_href:string,_type:string>>"))
    href = lambda cond: F.get(F.transform(F.filter(links, cond), lambda l: l["_href"]), 0)
    page, pdf = href(lambda l: l["_type"] == "text/html"), href(lambda l: l["_title"] == "pdf")
    any_link = href(lambda l: l["_href"].contains("arxiv.org"))
    arxiv_id = F.substring_index("e.id", "/abs/", -1)
    names = F.filter(F.transform("e.author", lambda a: a["name"]), lambda n: F.length(n) > 0)
    words = F.filter(F.transform("e.category", lambda c: c["_term"]), lambda w: F.length(w) > 0)
    return rows.select(
        *keep, "item",
        *_article(
            title=strip("e.title"), authors=F.coalesce(names, F.array().cast("array<string>")), year=_year(F.col("e.published")),
            doi=F.when(F.length(arxiv_id) > 0, F.concat(F.lit("10.48550/arXiv."), arxiv_id)), url=first_full(page, pdf, any_link), journal=F.lit("arXiv preprint"),
            abstract=strip("e.summary"), keywords=words, full_data=F.to_json(F.struct(arxiv_id.alias("arxiv_id"), F.left("e.updated", F.lit(10)).alias("updated"), pdf.alias("pdf_url"))),
        ),
        F.lit("arxiv").alias("source"),
    ).where(F.length("title") > 0)
