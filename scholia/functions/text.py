"""Column expressions for cleaning, tokenising and scoring text. All JVM-side unless noted."""

from __future__ import annotations

import html
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import arrow_udf, pandas_udf

from scholia import fixed
from scholia.functions.batches import bounds

TOKEN = "[a-zA-Záéíóúñüà-ÿ0-9]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# every white space of Unicode, as ``(?U)\s`` has it
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(col: Column | str) -> Column:
    """Remove white space of every kind at both ends (``trim`` only knows the space by itself)."""
    return F.btrim(_c(col), F.lit(SPACES))


def squeeze(col: Column | str) -> Column:
    """Collapse runs of white space to one space and strip."""
    return F.trim(F.regexp_replace(_c(col), r"(?U)\s+", " "))


def nonblank(col: Column | str) -> Column:
    return F.coalesce(F.length(strip(col)) > 0, F.lit(False))


def clean_page_text(col: Column | str) -> Column:
    """Text extracted from a page: join hyphenated line ends, rebuild paragraphs, drop page
    numbers standing alone, collapse spaces, drop control characters, strip."""
    t = F.regexp_replace(_c(col), r"-\n([\p{L}\p{N}_])", "$1")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, r"(?<!\n)\n(?!\n)", " ")
    t = F.regexp_replace(t, r"(?mdU)^\s*\d{1,4}\s*$", "")
    t = F.regexp_replace(t, r" {2,}", " ")
    t = F.regexp_replace(t, r"[\x00-\x09\x0B-\x1F]", "")
    return strip(t)


def _folded(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def _all_folded(texts: pa.Array) -> pa.Array:
    """NFKD and ASCII; texts of ASCII stay as they are, others become Python strings a slice at a time."""
    other = pc.invert(pc.fill_null(pc.string_is_ascii(texts), True))
    if not pc.any(other).as_py():
        return texts
    some = texts.filter(other)
    parts = [pa.array([_folded(x) for x in some.slice(a, b - a).to_pylist()], texts.type) for a, b in bounds(some)]
    return pc.replace_with_mask(texts, other, pa.concat_arrays(parts))


@arrow_udf(T.StringType())
def to_ascii(texts: pa.Array) -> pa.Array:
    """NFKD, then drop everything outside ASCII (in Arrow batches; the JVM has no such function)."""
    return _all_folded(texts)


@arrow_udf(T.ArrayType(T.StringType()))
def to_ascii_each(lists: pa.Array) -> pa.Array:
    """``to_ascii`` of each text of a list."""
    ends = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _all_folded(lists.flatten()), mask=lists.is_null())


@pandas_udf(T.StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def normalize_ascii(col: Column | str, lowercase: bool = True) -> Column:
    """ASCII form for embedding: accents folded, control characters to spaces, lower case."""
    t = F.regexp_replace(to_ascii(_c(col)), r"[\x00-\x08\x0B-\x1F]", " ")
    return F.lower(t) if lowercase else t


def clean_for_embedding(col: Column | str) -> Column:
    """Drop URLs, e-mails, reference marks and specials; collapse punctuation and space."""
    t = F.regexp_replace(_c(col), r"http[s]?://[^\s]+", "")
    t = F.regexp_replace(t, r"[^\s]+@[^\s]+", "")
    t = F.regexp_replace(t, r"\[[0-9]+\]", "")
    t = F.regexp_replace(t, r"\([^)]*[0-9]{4}[^)]*\)", "")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_\s\-.,]", "")
    t = F.regexp_replace(t, r"\.{2,}", ".")
    t = F.regexp_replace(t, r",{2,}", ",")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def remove_stop_words(col: Column | str, words: list[str] = fixed.STOP_WORDS) -> Column:
    stop = F.lit(list(words))
    kept = F.filter(F.split(_c(col), r"\s+"), lambda w: (w != "") & ~F.array_contains(stop, F.lower(w)))
    return F.array_join(kept, " ")


def combined_text(
    title: Column, abstract: Column, keywords: Column, authors: Column,
    strategy: str = "title_abstract", max_length: int | None = None, stop_words: bool = False,
) -> Column:
    """Fields joined for embedding; ``rich`` adds keywords and the first five authors."""
    if strategy not in ("title_only", "title_abstract", "rich", "multi_field"):
        raise ValueError(f"unknown strategy {strategy}")
    full = lambda c: F.when(F.length(c) > 0, c)  # noqa: E731 - empty fields add no separator
    parts = [title]
    if strategy in ("title_abstract", "rich"):
        parts.append(full(abstract))
    if strategy == "rich":
        parts.append(F.when(F.size(keywords) > 0, F.concat(F.lit("Keywords: "), F.array_join(keywords, ", "))))
        parts.append(
            F.when(F.size(authors) > 0, F.concat(F.lit("Authors: "), F.array_join(F.slice(authors, 1, 5), ", ")))
        )
    text = F.concat_ws(" ", *parts)
    if stop_words:
        text = remove_stop_words(text)
    return F.left(text, F.lit(max_length)) if max_length else text


def table_score(col: Column | str) -> Column:
    """How much a text looks like a data table: digits, numeric tokens, a caption in front."""
    c = _c(col)
    n = F.length(c)
    digits = F.length(F.regexp_replace(c, r"[^0-9]", ""))
    tokens = F.regexp_count(c, F.lit(r"[^\s]+"))
    numbers = F.regexp_count(c, F.lit(r"(?U)\b[0-9]+[.,]?[0-9]*\b"))
    caption = c.rlike(r"(?i)^\s*(table|tabla)\s*[0-9]")
    score = (
        2.0 * digits / n
        + F.when(tokens > 0, 2.0 * numbers / tokens).otherwise(0.0)
        + F.when(caption, 1.0).otherwise(0.0)
    )
    return F.when(n > 0, score).otherwise(F.lit(0.0))


def tokenize(col: Column | str) -> Column:
    """Lower-case words and numbers, accents kept."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN), F.lit(0))


def normalize_title(col: Column | str, unescape: bool = True) -> Column:
    """Title form for comparison: entities decoded, tags and punctuation to spaces, lower case."""
    t = html_unescape(_c(col)) if unescape else _c(col)
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    t = F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def normalize_domain(col: Column | str) -> Column:
    """Title form for domain terms: lower case, punctuation and digits to spaces."""
    t = F.regexp_replace(F.lower(_c(col)), r"[^\p{L}\p{N}_\s]", " ")
    t = F.regexp_replace(t, r"[0-9]+", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def extract_binomials(col: Column | str) -> Column:
    """Capitalised word followed by a lower-case word, in order of appearance."""
    found = F.regexp_extract_all(_c(col), F.lit(r"\b[A-Z][a-z]+\s+[a-z]+\b"), F.lit(0))
    return F.transform(found, lambda x: F.regexp_replace(x, r"\s+", " "))


def words(col: Column | str) -> Column:
    """White-space tokens, no empty ones."""
    return F.filter(F.split(_c(col), r"\s+"), lambda w: w != "")


def candidate_phrases(col: Column | str, longest: int = 4) -> Column:
    """All runs of ``longest`` to 1 words, longer runs first, with a capitalised word in them."""
    w = words(col)
    n = F.size(w)

    def grams(size: int) -> Column:
        starts = F.when(n >= size, F.sequence(F.lit(1), n - (size - 1))).otherwise(F.array().cast("array<int>"))
        runs = F.transform(starts, lambda i: F.slice(w, i, F.lit(size)))
        named = F.filter(runs, lambda run: F.exists(run, lambda x: x.rlike(r"^\p{Lu}")))
        return F.transform(named, lambda run: F.array_join(run, " "))

    return F.concat(*[grams(size) for size in range(longest, 0, -1)])


def key_terms(col: Column | str, generic: list[str] = fixed.GENERIC_WORDS) -> Column:
    """Words of a question that name its subject; all words when nothing else is left."""
    bare = F.transform(words(col), lambda w: F.regexp_replace(F.lower(w), r"^[.,;:()\[\]]+|[.,;:()\[\]]+$", ""))
    stop = F.lit(list(generic))
    key = F.filter(bare, lambda w: ~F.array_contains(stop, w) & (F.length(w) > 3))
    return F.when(F.size(key) > 0, key).otherwise(bare)


def search_body(title: Column, abstract: Column, keywords: Column) -> Column:
    """Title, abstract and keywords as one lower-case line, each word behind a space."""
    full = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.when(F.length(abstract) > 0, abstract), keywords)
    return F.concat(F.lit(" "), squeeze(F.lower(full)))


def relevance_score(terms: Column, body: Column) -> Column:
    """Share of key terms found in a ``search_body`` column, as a substring or, from five letters
    on, by a word starting with the first four. Keep ``body`` a column of its own: inside the
    lambda an expression would be evaluated again for every term."""
    prefix = lambda t: F.concat(F.lit(" "), F.left(t, F.lit(4)))
    hit = lambda t: body.contains(t) | ((F.length(t) >= 5) & body.contains(prefix(t)))
    return F.when(F.size(terms) == 0, F.lit(1.0)).otherwise(F.size(F.filter(terms, hit)) / F.size(terms))


def first_doi(col: Column | str) -> Column:
    """The first DOI written in a text: link forms first, then ``doi:`` forms."""
    c = _c(col)
    # Patterns in the order they are tried.
    patterns = [
        r"https?://doi\.org/(10\.\S+?)(?:\s|$|[\"'])",
        r"doi\.org/(10\.\S+?)(?:\s|$|[\"'])",
        r"doi:\s*(10\.\S+?)(?:\s|$|[\"'])",
        r"DOI:\s*(10\.\S+?)(?:\s|$|[\"'])",
    ]
    found = F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns])
    return F.regexp_replace(found, r"[.,;)]+$", "")


def contains_any(text: Column, terms: list[str]) -> Column:
    return F.exists(F.lit([t.lower() for t in terms]), lambda t: F.lower(text).contains(t))
