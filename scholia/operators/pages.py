"""Pages of documents: page filters, offsets, repeated lines, page lookup, context headers."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scholia.functions.ids import chunk_id
from scholia.functions.text import clean_page_text, strip
from scholia.operators.skew import first_by, numbered, running_total


def filter_pages(pages: DataFrame, least: int = 50) -> tuple[DataFrame, DataFrame]:
    """Pages with enough text, and the documents of which none is left."""
    kept = pages.where(F.length("text") >= least)
    failed = pages.select("paper_id").distinct().join(kept.select("paper_id").distinct(), "paper_id", "left_anti")
    return kept, failed


def clean_pages(pages: DataFrame, least: int = 50) -> DataFrame:
    return pages.withColumn("text", clean_page_text("text")).where(F.length("text") >= least)


def extraction_cascade(attempts: DataFrame, min_chars: int = 500, doc: str = "doc_id") -> DataFrame:
    """First provider by priority whose text is long enough; documents without one are not ok."""
    sums = attempts.groupBy(doc, "prio", "provider").agg(F.sum("chars").alias("chars"), F.sum("pages").alias("pages"))
    best = first_by(sums.where(F.col("chars") >= min_chars), [doc], ["prio"])
    return attempts.select(doc).distinct().join(best, doc, "left").select(
        doc, "provider", "chars", "pages", F.col("provider").isNotNull().alias("ok")
    )


def page_offsets(pages: DataFrame, separator: int = 2) -> DataFrame:
    """Where each page starts and ends when all pages of a document are joined by blank lines.

    A running total in blocks of pages, so a document of any length is fine.
    """
    out = running_total(pages, ["paper_id"], "page_number", F.length("text") + separator, "char_start")
    return out.withColumn("char_end", F.col("char_start") + F.length("text"))


def assign_pages(chunks: DataFrame, offsets: DataFrame, span: int = 1 << 16) -> DataFrame:
    """Page holding ``char_start`` of each chunk; in a gap between pages the document's last page.

    The range condition becomes an equality: pages are listed under every ``span`` of characters
    they touch, chunks under the one of their start.
    """
    buckets = F.sequence(F.floor(F.col("char_start") / span), F.floor(F.greatest("char_start", F.col("char_end") - 1) / span))
    listed = offsets.select(
        "paper_id", F.col("page_number").alias("__p"), F.col("char_start").alias("__s"), F.col("char_end").alias("__e"), F.explode(buckets).alias("__b")
    )
    last = offsets.groupBy("paper_id").agg(F.max_by("page_number", "char_start").alias("__last"))
    c = chunks.withColumn("__b", F.floor(F.col("char_start") / span)).alias("c")
    inside = (F.col("c.char_start") >= F.col("o.__s")) & (F.col("c.char_start") < F.col("o.__e"))
    on = (F.col("c.paper_id") == F.col("o.paper_id")) & (F.col("c.__b") == F.col("o.__b")) & inside
    hit = c.join(listed.alias("o"), on, "left").select("c.*", "__p").drop("__b")
    return hit.join(last, "paper_id", "left").withColumn("page_number", F.coalesce("__p", "__last", F.lit(-1))).drop("__p", "__last")


def strip_repeated_lines(pages: DataFrame, least: int = 50) -> DataFrame:
    """Remove running headers and footers.

    In documents of four pages or more, a first or last line longer than three characters that
    repeats on at least ``max(3, n div 2)`` pages is deleted everywhere. At most four lines of a
    document can be that frequent, so they travel to its pages as a short list; the pages
    themselves are never gathered. If no page stays long enough the originals are kept.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), strip), lambda x: x != "")
    ends = pages.select("paper_id", lines.alias("l")).select(
        "paper_id", F.get("l", 0).alias("first"), F.get("l", F.size("l") - 1).alias("last")
    )
    sizes = pages.groupBy("paper_id").agg(F.count("*").alias("n"))
    sides = ends.select("paper_id", F.explode(F.array(F.struct(F.lit("first").alias("side"), F.col("first").alias("line")), F.struct(F.lit("last").alias("side"), F.col("last").alias("line")))).alias("x"))
    counts = sides.select("paper_id", "x.*").where(F.length("line") > 3).groupBy("paper_id", "side", "line").agg(F.count("*").alias("c"))
    frequent = counts.join(sizes, "paper_id").where((F.col("n") >= 4) & (F.col("c") >= F.greatest(F.lit(3), F.floor(F.col("n") / 2))))
    removal = frequent.groupBy("paper_id").agg(F.collect_set("line").alias("gone"))
    marked = pages.join(removal, "paper_id", "left")
    kept_lines = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col("gone"), strip(x)))
    marked = marked.withColumn("clean", F.when(F.col("gone").isNull(), F.col("text")).otherwise(strip(F.array_join(kept_lines, "\n"))))
    long_enough = F.col("gone").isNull() | (F.length("clean") >= least)
    survivors = marked.groupBy("paper_id").agg(F.bool_or(long_enough).alias("some"))
    return marked.join(survivors, "paper_id").where(~F.col("some") | long_enough).withColumn(
        "text", F.when(F.col("some"), F.col("clean")).otherwise(F.col("text"))
    ).drop("gone", "clean", "some")


def number_chunks(chunks: DataFrame, pos: str = "pos") -> DataFrame:
    """Index, total and id of the chunks of each document after filtering, in blocks of ``pos``."""
    totals = chunks.groupBy("paper_id").agg(F.count("*").alias("total_chunks"))
    out = numbered(chunks, ["paper_id"], pos, "chunk_index").join(totals, "paper_id")
    return out.withColumn("chunk_id", chunk_id("paper_id", "chunk_index"))


def contextualize(chunks: DataFrame, chars: int = 250) -> DataFrame:
    """Search text: the head of the document's first chunk in front, unless it is in the text."""
    head = chunks.where(F.col("chunk_index") == 0).groupBy("paper_id").agg(
        strip(F.left(F.max_by("text", "seq"), F.lit(chars))).alias("__h")
    )
    wants = (F.length("__h") > 0) & ~F.col("text").contains(F.col("__h"))
    return chunks.join(head, "paper_id", "left").withColumn(
        "search_text", F.when(F.coalesce(wants, F.lit(False)), F.concat_ws(" ", "__h", "text")).otherwise(F.col("text"))
    ).drop("__h")


def split_markdown(text: str) -> list[tuple[int, str]]:
    """Page numbers and texts of one Markdown document."""
    pages, page = {1: []}, 1
    for line in text.split("\n"):
        named = re.match(r"#+\s+Page\s+(\d+)", line, re.IGNORECASE)
        if re.fullmatch(r"[-*]{3,}", line.strip()):
            page += 1
            pages[page] = []
        elif named:
            page = int(named.group(1))
            pages.setdefault(page, [])
        else:
            pages[page].append(line)
    return [(number, "\n".join(lines).strip()) for number, lines in sorted(pages.items())]


def markdown_pages(docs: DataFrame, text: str = "text") -> DataFrame:
    """Pages of Markdown text: a rule of dashes or stars starts the next page, a ``# Page n``
    heading names it; a page named again goes on. Arrow batches, no shuffle."""

    def run(batches):
        for pdf in batches:
            rows = [(p, n, t) for p, body in zip(pdf["paper_id"], pdf["text"]) for n, t in split_markdown(body or "")]
            yield pd.DataFrame(rows, columns=["paper_id", "page_number", "text"])

    return docs.select("paper_id", F.col(text).alias("text")).mapInPandas(run, "paper_id string, page_number bigint, text string")
