"""Article tables: noise filters, deduplication, linkage, canonical files, work queues."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from scholia import fixed
from scholia.functions import records as R
from scholia.functions.ids import safe_species
from scholia.functions.text import normalize_title, squeeze, strip
from scholia.operators.skew import first_by, numbered, top_k

# ---- filters ---------------------------------------------------------------------------------


def is_relevant(noisy: list[str] = fixed.NOISY_SOURCES) -> Column:
    return ~F.coalesce(F.col("source").isin(*noisy), F.lit(False)) | R.mentions_species(F.col("title"), F.col("species"))


def filter_noisy(articles: DataFrame, noisy: list[str] = fixed.NOISY_SOURCES) -> DataFrame:
    """Rows of unspecific sources must name the species in the title; other sources pass."""
    return articles.where(is_relevant(noisy))


def noise_report(articles: DataFrame, noisy: list[str] = fixed.NOISY_SOURCES) -> DataFrame:
    """Rows seen, removed and kept, overall and how many species are left with nothing."""
    per = articles.groupBy("species").agg(F.count("*").alias("n"), F.count_if(is_relevant(noisy)).alias("kept"))
    return per.agg(
        F.count("*").alias("species_total"), F.sum("n").alias("rows_total"),
        F.sum(F.col("n") - F.col("kept")).alias("rows_removed"), F.sum("kept").alias("rows_kept"),
        F.count_if(F.col("kept") == 0).alias("species_empty"),
    )


def is_noisy_file(name: Column, species: Column, noisy: list[str] = fixed.NOISY_SOURCES) -> Column:
    """File of an unspecific source whose name holds no species word longer than three letters."""
    prefix = reduce(lambda a, b: a | b, [name.startswith(f"{s}_") for s in noisy])
    long_words = F.filter(F.split(F.lower(species), r"\s+"), lambda w: F.length(w) > 3)
    return prefix & ~F.exists(long_words, lambda w: F.lower(name).contains(w))


def filter_years(articles: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Year inside the range; rows without a year pass."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("year") >= lo)
    if hi is not None:
        cond = cond & (F.col("year") <= hi)
    return articles.where(F.col("year").isNull() | cond)


def filter_region(df: DataFrame, terms: list[str], cols: list[str], mode: str = "any") -> DataFrame:
    """Any region phrase in one of the columns; ``joined`` asks for all phrases as one string."""
    wanted = [" ".join(terms)] if mode == "joined" else list(terms)
    phrases = F.lit([w.lower() for w in wanted])
    text = F.lower(F.concat_ws("\x00", *cols))
    return df.where(F.exists(phrases, lambda p: text.contains(p)))


def matches_query(text: Column, title: Column, abstract: Column, keywords: Column) -> Column:
    q = F.lower(text)
    in_keywords = F.exists(F.coalesce(keywords, F.array().cast("array<string>")), lambda k: F.lower(k).contains(q))
    has = lambda c: F.coalesce(F.lower(c).contains(q), F.lit(False))
    return has(title) | has(abstract) | in_keywords


def clean_species(species: DataFrame) -> DataFrame:
    """Names without blanks, hybrids and open nomenclature; first spelling of each name wins."""
    s = species.withColumn("species", strip("species")).where(
        (F.col("species") != "") & ~F.col("species").contains("/")
        & ~F.col("species").contains(" sp.") & ~F.col("species").contains(" spp.")
    )
    return first_by(s, [F.lower("species")], ["pos"])


def filter_type(records: DataFrame, kind: str, payload: str = "full_data", path: str = "$.type") -> DataFrame:
    """Publication type on the raw JSON record."""
    return records.where(F.get_json_object(payload, path) == kind)


def validate_articles(articles: DataFrame) -> DataFrame:
    """List of problems per article; an article is valid when its title is not blank."""
    t, a = F.col("title"), F.col("abstract")
    n = lambda c: F.coalesce(F.length(c), F.lit(0))
    checks = [
        (n(t) == 0, fixed.PROBLEM_NO_TITLE),
        (n(a) == 0, fixed.PROBLEM_NO_ABSTRACT),
        ((n(t) > 0) & (n(t) < 5), fixed.PROBLEM_SHORT_TITLE),
        ((n(a) > 0) & (n(a) < 20), fixed.PROBLEM_SHORT_ABSTRACT),
        (F.coalesce(F.size("authors"), F.lit(0)) <= 0, fixed.PROBLEM_NO_AUTHORS),
        (F.coalesce(F.col("year"), F.lit(0)) == 0, fixed.PROBLEM_NO_YEAR),
    ]
    problems = F.array_compact(F.array(*[F.when(cond, F.lit(text)) for cond, text in checks]))
    return articles.withColumn("problems", problems).withColumn("is_valid", F.coalesce(F.length(strip("title")) > 0, F.lit(False)))


def extract_articles(articles: DataFrame, skip_errors: bool = True) -> tuple[DataFrame, DataFrame]:
    """Cleaned articles, and the rows without a title with their position."""
    cleaned = articles.select(
        "pos", R.clean_field("title").alias("title"), F.when(F.length("abstract") > 0, R.clean_field("abstract")).alias("abstract"),
        F.when(F.size("keywords") > 0, R.clean_list("keywords")).alias("keywords"),
        F.when(F.size("authors") > 0, R.clean_authors("authors")).alias("authors"),
        F.when(F.length("journal") > 0, R.clean_field("journal")).alias("journal"), "year",
        F.when(F.length("doi") > 0, R.clean_doi("doi")).alias("doi"), "source",
    )
    has_title = F.coalesce(F.col("title") != "", F.lit(False))
    if not skip_errors:
        cleaned = cleaned.withColumn(
            "title", F.when(has_title, F.col("title")).otherwise(F.raise_error(F.format_string("row %d has no title", "pos")))
        )
    errors = cleaned.where(~has_title).select("pos", F.format_string("row %d has no title", "pos").alias("error"))
    return cleaned.where(has_title), errors


def download_plan(articles: DataFrame, source: str | None = None) -> DataFrame:
    """First usable link per article: DOI, arXiv id, URL, PubMed id."""
    df = articles if source is None else articles.where(strip("source") == source)
    full = lambda c: F.length(F.col(c)) > 0
    method = F.when(full("doi"), "doi").when(full("arxiv_id"), "arxiv").when(full("url"), "url").when(full("pubmed_id"), "pubmed")
    link = (
        F.when(method == "doi", R.doi_url("doi"))
        .when(method == "arxiv", F.concat(F.lit("https://arxiv.org/pdf/"), F.col("arxiv_id")))
        .when(method == "url", F.col("url")).when(method == "pubmed", R.pubmed_url("pubmed_id"))
    )
    return df.withColumn("method", method).withColumn("link", link)


def classify_paywall(articles: DataFrame) -> DataFrame:
    """Per species: articles behind a paywall, in open sources, in all."""
    return articles.groupBy("species").agg(
        F.count_if(F.col("source").isin(*fixed.PAYWALLED_SOURCES)).alias("paywalled"),
        F.count_if(F.col("source").isin(*fixed.OPEN_SOURCES)).alias("open"), F.count("*").alias("total"),
    )


def classify_habitat(species: DataFrame, registry: DataFrame) -> DataFrame:
    """Habitat from flags; a name known to the marine register is marine."""
    hits = registry.select("species").distinct().withColumn("__hit", F.lit(True))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    by_flags = R.habitat(flag("marine"), flag("freshwater"), flag("terrestrial"))
    return species.join(hits, "species", "left").withColumn(
        "habitat", F.when(F.col("__hit"), F.lit("MARINE")).otherwise(by_flags)
    ).drop("__hit")


def route_habitat(classified: DataFrame) -> DataFrame:
    return classified.withColumn("route", R.habitat_route(F.col("habitat")))


# ---- deduplication, caps, order ----------------------------------------------------------------


def title_key(norm: str = "lower") -> Column:
    t = F.lower(F.coalesce(F.col("title"), F.lit("")))
    return {"lower": t, "strip": strip(t), "squeeze": squeeze(t)}[norm]


def dedup_titles(
    articles: DataFrame, norm: str = "lower", by: list[str] | None = None, order: list[str] | None = None,
    keep_blank: bool = False,
) -> DataFrame:
    """First article per title; blank titles are dropped, or one of them is kept."""
    df = articles if keep_blank else articles.where(title_key(norm) != "")
    return first_by(df, [*(by or []), title_key(norm)], order or ["source_prio", "pos"])


def dedup_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key; rows without a key are dropped."""
    return first_by(df.where(F.coalesce(F.length(F.col(key)) > 0, F.lit(False))), [key], order)


def cap_per_group(df: DataFrame, n: int = fixed.MAX_RESULTS, by: str = "species", order: list | None = None) -> DataFrame:
    return top_k(df, [by], order or ["source_prio", "pos"], n)


def head_fraction(df: DataFrame, p: float, pos: str = "pos") -> DataFrame:
    """The first ``max(1, int(n * p))`` rows in order of ``pos`` (unique)."""
    n = df.agg(F.greatest(F.lit(1), F.floor(F.count("*") * p)).cast("bigint")).scalar()
    return numbered(df, [], pos, "__n").where(F.col("__n") < n).drop("__n")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by the hash of their key: repeatable, a top-n without a full sort."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.orderBy(order, F.col(key)).limit(n)


def distinct_sorted(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values of some columns in their order."""
    return df.select(*cols).distinct().orderBy(*cols)


def distinct_species(df: DataFrame, column: str = "species") -> DataFrame:
    """Names without white space around them; blanks are none."""
    return df.select(strip(column).alias(column)).where(F.col(column) != "").distinct()


def top_groups(df: DataFrame, by: str, n: int = 20) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(by)).limit(n)


def order_articles(df: DataFrame, by: str = "relevance", n: int = fixed.MAX_RESULTS) -> DataFrame:
    """The first ``n`` by relevance, newest year or citations (text that is no number counts 0)."""
    key = {
        "relevance": F.col("relevance") if "relevance" in df.columns else F.lit(0),
        "date": F.col("year") if "year" in df.columns else F.lit(0),
        "cited": F.coalesce(F.col("citations").cast("string").try_cast("int"), F.lit(0)) if "citations" in df.columns else F.lit(0),
    }[by]
    return df.orderBy(key.desc_nulls_last(), F.asc("pos")).limit(n)


def shard(df: DataFrame, index: int, count: int, pos: str = "pos") -> DataFrame:
    """Every ``count``-th pending row, starting at ``index``, in order of ``pos``."""
    return numbered(df, [], pos, "__n").where(F.col("__n") % count == index).drop("__n")


def union_sources(tables: dict[str, DataFrame], priority: list[str] = fixed.SOURCES) -> DataFrame:
    """All sources under one schema with their priority; missing columns become null."""
    parts = [
        tables[s].withColumn("source", F.lit(s)).withColumn("source_prio", F.lit(i).cast("bigint"))
        for i, s in enumerate(priority) if s in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def search_articles(
    raw: DataFrame, n: int = fixed.MAX_RESULTS, noisy: list[str] = fixed.NOISY_SOURCES, least_relevance: float | None = None,
) -> DataFrame:
    """Noise filter, first title per species, optional relevance floor, cap per species."""
    df = dedup_titles(filter_noisy(raw, noisy), by=["species"])
    if least_relevance is not None:
        df = df.where(F.col("relevance") >= least_relevance)
    return cap_per_group(df, n)


# ---- linkage -----------------------------------------------------------------------------------


def enrich_chunks(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """Bibliographic fields of the registry by ``paper_id``; unmatched chunks keep theirs.

    The registry grows with the corpus, so no broadcast is forced; adaptive execution splits the
    partitions of a paper with very many chunks.
    """
    fields = ["title", "authors", "year", "doi"]
    meta = registry.select("paper_id", F.struct(*fields).alias("__m"))
    joined = chunks.join(meta, "paper_id", "left")
    for f in fields:
        new = F.col(f"__m.{f}")
        joined = joined.withColumn(
            f, F.when(F.col("__m").isNotNull(), new).otherwise(F.col(f)) if f in chunks.columns else new
        )
    return joined.drop("__m")


def enrich_report(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """Chunks updated and papers that the registry does not know (counted per paper first)."""
    papers = chunks.groupBy("paper_id").agg(F.count("*").alias("n"))
    known = registry.select("paper_id").distinct().withColumn("known", F.lit(True))
    return papers.join(known, "paper_id", "left").agg(
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(F.lit(0))).alias("chunks_updated"),
        F.count_if(F.col("known").isNull()).alias("papers_without_metadata"),
        F.count("*").alias("papers"),
    )


def pending(df: DataFrame, done: DataFrame, key: str | Column, done_key: str | Column | None = None, ignore_case: bool = False) -> DataFrame:
    """Rows whose key is not done yet. Rows without a key stay pending."""
    left = F.col(key) if isinstance(key, str) else key
    right = done_key if done_key is not None else key
    right = F.col(right) if isinstance(right, str) else right
    if ignore_case:
        left, right = F.lower(left), F.lower(right)
    return df.withColumn("__k", left).join(done.select(right.alias("__k")).distinct(), "__k", "left_anti").drop("__k")


def missing_species(taxonomy: DataFrame, results: DataFrame) -> DataFrame:
    """Species with no results, and those whose result set holds no title."""
    found = results.groupBy(F.lower("species").alias("__k")).agg(F.count(F.nullif(F.col("title"), F.lit(""))).alias("n"))
    return (
        taxonomy.withColumn("__k", F.lower("species")).join(found, "__k", "left")
        .withColumn("reason", F.when(F.col("n").isNull(), "missing").when(F.col("n") == 0, "empty"))
        .where(F.col("reason").isNotNull()).drop("__k", "n")
    )


def pending_dois(articles: DataFrame, stored: DataFrame, failed: DataFrame) -> DataFrame:
    """First article per valid DOI that is neither stored nor known to fail."""
    valid = articles.where(R.valid_doi("doi")).withColumn("doi", strip("doi"))
    done = stored.select("doi").union(failed.select("doi")).distinct()
    return dedup_first(valid, "doi", ["pos"]).join(done, "doi", "left_anti")


def canonical_key(col: Column | str) -> Column:
    return squeeze(F.lower(F.translate(F.col(col) if isinstance(col, str) else col, "/_", "  ")))


def prefer_file(files: DataFrame) -> DataFrame:
    """One file per canonical species: its exact safe name, else the first by name."""
    exact = F.col("file_name") != F.concat(safe_species("species"), F.lit(".csv"))
    return first_by(files, ["key"], [exact, F.lower("file_name"), F.col("file_name")])


def canonicalize_results(taxonomy: DataFrame, files: DataFrame) -> dict[str, DataFrame]:
    """Match result files (``file_name``) to the taxonomy by normalised name.

    Gives the selected, missing, non-canonical and ignored tables and a summary.
    """
    names = taxonomy.where(F.length(strip("species")) > 0).withColumn("species", strip("species"))
    canon = first_by(names.withColumn("key", squeeze(F.lower(F.translate("species", "/", " ")))), ["key"], ["pos"]).select("key", "species")
    keyed = files.withColumn("key", canonical_key(F.regexp_replace("file_name", r"\.csv$", "")))
    matched = keyed.join(canon, "key")
    chosen = prefer_file(matched).select("key", "species", F.col("file_name").alias("selected_file"))
    counts = matched.groupBy("key").agg(F.count("*").alias("candidates"))
    selected = chosen.join(counts, "key").withColumn("output_file", F.concat(safe_species("species"), F.lit(".csv")))
    missing = canon.join(keyed.select("key").distinct(), "key", "left_anti")
    stray = keyed.join(canon, "key", "left_anti").select("key", "file_name")
    ignored = matched.join(chosen.select("key", "selected_file"), "key").where(F.col("file_name") != F.col("selected_file"))
    summary = (
        canon.join(counts, "key", "left").agg(
            F.count("*").alias("species_total"), F.count("candidates").alias("species_with_file"),
            F.count_if(F.col("candidates").isNull()).alias("species_missing"),
            F.coalesce(F.sum(F.col("candidates") - 1), F.lit(0)).alias("duplicates_ignored"),
        )
        .withColumn("files_total", files.agg(F.count("*")).scalar())
        .withColumn("files_non_canonical", stray.agg(F.count("*")).scalar())
    )
    return {"selected": selected, "missing": missing, "non_canonical": stray, "ignored": ignored, "summary": summary}


def merge_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows plus the new ones whose title is not stored yet (first of equal new titles)."""
    key = title_key("strip")
    fresh = dedup_titles(new, "strip", order=["pos"]).withColumn("__k", key)
    fresh = fresh.join(existing.select(key.alias("__k")).distinct(), "__k", "left_anti").drop("__k")
    return existing.unionByName(fresh, allowMissingColumns=True)


@pandas_udf(T.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two normalised titles."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)])


def title_similarity(pairs: DataFrame, left: str = "title", right: str = "candidate_title", oa_url: str = "oa_url") -> DataFrame:
    """Score of each (title, candidate) pair: ratio, equality or containment bonus, open link bonus."""
    n = pairs.withColumn("__l", normalize_title(left)).withColumn("__r", normalize_title(right))
    bonus = (
        F.when(F.col("__l") == F.col("__r"), 0.15)
        .when((F.col("__l") != "") & F.col("__r").contains(F.col("__l")), 0.05).otherwise(0.0)
    )
    open_link = F.when(F.length(F.col(oa_url)) > 0, 0.05).otherwise(0.0)
    ratio = F.when((F.length(left) > 0) & (F.length(right) > 0), matching_ratio("__l", "__r")).otherwise(0.0)
    return n.withColumn("score", ratio + bonus + open_link).drop("__l", "__r")


def best_candidate(scored: DataFrame, key: str, least: float = 0.78) -> DataFrame:
    """Best candidate per row, the first one on equal scores, and whether it is good enough."""
    return first_by(scored, [key], [-F.col("score"), F.col("pos")]).withColumn(
        "accepted", F.col("score") >= least
    )


def link_titles(failed: DataFrame, candidates: DataFrame, key: str = "row_id", least: float = 0.78) -> DataFrame:
    """Score the candidates found for each failed row and keep the best.

    Pairs exist only between a row and its own candidates (equal ``key``); they are dealt anew, by row and
    candidate, before the Python scoring, so a row with very many candidates is shared between tasks.
    """
    pairs = failed.join(candidates, key).repartition(F.col(key), F.col("pos"))
    return best_candidate(title_similarity(pairs), key, least)
