"""Column expressions over bibliographic and parameter fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholia import fixed
from scholia.functions.text import strip, words


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_field(col: Column | str) -> Column:
    """Collapse white space, drop control characters, strip."""
    t = F.trim(F.regexp_replace(_c(col), r"(?U)\s+", " "))
    return F.trim(F.regexp_replace(t, r"[\x00-\x08\x0B-\x1F]", ""))


def clean_list(col: Column | str, longer_than: int = 0) -> Column:
    return F.filter(F.transform(_c(col), clean_field), lambda x: F.length(x) > longer_than)


def clean_authors(col: Column | str) -> Column:
    return clean_list(col, 1)


def clean_doi(col: Column | str) -> Column:
    d = clean_field(col)
    return F.when(d.startswith("10.") | (d == ""), d).otherwise(F.concat(F.lit("10."), d))


def valid_doi(col: Column | str) -> Column:
    return F.coalesce(strip(col).startswith("10."), F.lit(False))


def parse_authors(col: Column | str) -> Column:
    """Author string to list: ``;`` separates; else ``,`` does, unless every second part is short
    enough to be an initial, then parts are joined in pairs again."""
    raw = strip(col)
    full = lambda a: F.filter(a, lambda x: x != "")
    by_semicolon = F.transform(F.split(raw, ";"), strip)
    parts = F.transform(F.split(raw, ","), strip)
    seconds = F.filter(parts, lambda x, i: i % 2 == 1)
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(seconds), F.lit(1))),
        lambda i: F.concat_ws(", ", F.get(parts, 2 * i - 2), F.get(parts, 2 * i - 1)),
    )
    initials = (F.size(seconds) > 0) & F.forall(seconds, lambda x: F.length(x) <= 3)
    return (
        F.when(raw == "", F.array().cast("array<string>"))
        .when(raw.contains(";"), full(by_semicolon))
        .when(initials, full(pairs))
        .otherwise(full(parts))
    )


def filename_year(stem: Column | str) -> Column:
    return F.regexp_extract(_c(stem), r"[0-9]{4}", 0).try_cast("int")


def filename_author(stem: Column | str) -> Column:
    """What stands before the first four-digit run, separators as spaces."""
    before = strip(F.regexp_replace(_c(stem), r"(?s)[0-9]{4}.*$", ""))
    return F.nullif(F.trim(F.translate(before, "-_", "  ")), F.lit(""))


def paper_id_year(paper_id: Column | str) -> Column:
    return F.regexp_extract(_c(paper_id), r"^[0-9]{4}", 0).try_cast("int")


def paper_id_authors(paper_id: Column | str) -> Column:
    """Capitalised pieces of the id before its first ``-``, at most three."""
    name = F.get(F.split(F.regexp_replace(_c(paper_id), r"^[0-9]{4}", ""), "-"), 0)
    return F.slice(F.regexp_extract_all(name, F.lit("[A-Z][a-z]*"), F.lit(0)), 1, 3)


def normalize_sex(col: Column | str) -> Column:
    c = F.lower(_c(col).cast("string"))
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.isin("1", "male", "m"), "male")
        .when(c.isin("2", "female", "f"), "female")
        .otherwise("combined")
    )


def safe_float(col: Column | str) -> Column:
    """Number or null; sentinels for missing values are null, zero stays zero."""
    v = _c(col).cast("string").try_cast("double")
    return F.when(~v.isin(*fixed.MISSING_SENTINELS) & ~F.isnan(v), v)


def safe_int(col: Column | str) -> Column:
    return _c(col).cast("string").try_cast("double").try_cast("bigint")


def genus(col: Column | str) -> Column:
    return F.coalesce(F.get(words(col), 0), F.lit(""))


def epithet(col: Column | str) -> Column:
    return F.get(words(col), 1)


def first_full(*cols: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.when(F.length(c) > 0, c) for c in cols])


def best_oa_url(best: Column, locations: Column) -> Column:
    """Best open location first, then the others in order; a PDF link before a page link."""
    link = lambda x: first_full(x["url_for_pdf"], x["url"])
    others = F.filter(F.transform(locations, link), lambda u: u.isNotNull())
    return F.coalesce(link(best), F.get(others, 0))


def openalex_oa_url(best: Column, primary: Column, open_access: Column) -> Column:
    return first_full(
        strip(best["pdf_url"]), strip(primary["pdf_url"]),
        strip(open_access["oa_url"]), strip(primary["landing_page_url"]),
    )


def arxiv_pdf(url: Column | str) -> Column:
    u = _c(url)
    return F.when(u.contains("arxiv.org/abs/"), F.regexp_replace(u, r"arxiv\.org/abs/", "arxiv.org/pdf/"))


def pmcid(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(url), r"PMC[0-9]+", 0), F.lit(""))


def pubmed_url(pubmed_id: Column | str) -> Column:
    return F.when(F.length(_c(pubmed_id)) > 0, F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), _c(pubmed_id), F.lit("/")))


def doi_url(doi: Column | str) -> Column:
    return F.when(F.length(_c(doi)) > 0, F.concat(F.lit("https://doi.org/"), _c(doi)))


def habitat(marine: Column, freshwater: Column, terrestrial: Column) -> Column:
    wet = marine | freshwater
    return (
        F.when(wet & terrestrial, "MARINE_FRESHWATER")
        .when(marine, "MARINE")
        .when(freshwater, "FRESHWATER")
        .when(terrestrial, "TERRESTRIAL")
        .otherwise("")
    )


def habitat_route(habitat_col: Column) -> Column:
    h = F.upper(F.coalesce(habitat_col, F.lit("")))
    return (
        F.when(h.isin("MARINE", "FRESHWATER", "MARINE_FRESHWATER"), "aquatic")
        .when(h == "TERRESTRIAL", "terrestrial")
        .otherwise("pending")
    )


def mentions_species(title: Column, species: Column) -> Column:
    """Both words of the binomial (or the only word) occur in the title."""
    t, w = F.lower(F.coalesce(title, F.lit(""))), words(F.lower(species))
    return (F.size(w) > 0) & F.forall(F.slice(w, 1, 2), lambda x: t.contains(x))


def clamp_confidence(col: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(_c(col).cast("double"), F.lit(1.0))))


def node_size(degree: Column) -> Column:
    return F.greatest(F.lit(10), F.least(F.lit(40), 10 + 2 * degree))


def edge_width(confidence: Column) -> Column:
    return F.greatest(F.lit(0.5), 2.0 * confidence)


def rerank_bonus(title: Column, authors: Column, year: Column, doi: Column) -> Column:
    """Bonus for complete metadata and for recent years."""
    one = lambda cond, v: F.when(F.coalesce(cond, F.lit(False)), v).otherwise(0.0)
    return (
        one(F.length(title) > 0, 0.02) + one(F.size(authors) > 0, 0.02)
        + one(year != 0, 0.02) + one(F.length(doi) > 0, 0.01)
        + F.when(year >= 2000, (year - 2000) * 0.001).otherwise(0.0)
    )


def search_query(source: str, species: Column, region: list[str] | None = None) -> Column:
    """Field-tagged boolean search string of one literature source."""
    name = F.regexp_replace(species, '"', "")
    # Fixed values: (species clause, region clause, region operator, brackets) per source.
    forms = {
        "pubmed": ('"%s"[Organism]', '"%s"[Title/Abstract]', " OR ", True),
        "crossref": ('"%s"', '"%s"', " OR ", True),
        "scopus": ('TITLE-ABS-KEY("%s")', 'TITLE-ABS-KEY("%s")', " AND ", False),
        "arxiv": ('ti:"%s"', 'ti:"%s"', " OR ", True),
    }
    clause, region_clause, op, brackets = forms[source]
    query = F.format_string(clause, name if source == "arxiv" else species)
    if not region:
        return query
    places = op.join(region_clause % term for term in region)
    return F.concat_ws(" AND ", query, F.lit(f"({places})" if brackets else places))
