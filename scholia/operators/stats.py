"""Statistics over corpora, indices, work batches and runs.

Every report is an aggregate with partial aggregation; distinct counts go through a distinct by
(key, value) first, so no task ever collects the values of a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scholia import fixed


def _filled(c: str) -> Column:
    return F.coalesce(F.length(F.col(c).cast("string")) > 0, F.lit(False))


def pct(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Sizes per paper first, then overall: totals, extremes, rounded mean, papers."""
    n = F.length("text")
    per = chunks.groupBy("paper_id").agg(
        F.count("*").alias("c"), F.min(n).alias("lo"), F.max(n).alias("hi"), F.sum(n).alias("s")
    )
    return per.agg(
        F.sum("c").alias("total"), F.min("lo").cast("bigint").alias("chars_min"), F.max("hi").cast("bigint").alias("chars_max"),
        F.bround(F.sum("s") / F.sum("c")).cast("bigint").alias("chars_avg"), F.sum("s").alias("chars_total"),
        F.count("*").alias("papers"),
    )


def index_stats(index: DataFrame, model: str = "unknown") -> DataFrame:
    """Chunks, papers, model and vector size of an index."""
    per = index.groupBy("paper_id").agg(F.count("*").alias("c"), F.max(F.size("embedding")).alias("d"))
    return per.agg(
        F.sum("c").alias("total_chunks"), F.count("*").alias("total_papers"),
        F.max("d").cast("bigint").alias("embedding_dimension"),
    ).withColumn("embedding_model", F.lit(model))


def completeness(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Filled fields and their mean share."""
    fields = fields or ["title", "authors", "year", "doi"]
    filled = lambda f: (F.coalesce(F.size(f) > 0, F.lit(False)) if dict(df.dtypes)[f].startswith("array") else _filled(f))
    out = df.agg(F.count("*").alias("total"), *[F.count_if(filled(f)).alias(f"with_{f}") for f in fields])
    some = sum((F.col(f"with_{f}") for f in fields[1:]), F.col(f"with_{fields[0]}"))
    return out.withColumn("completeness_pct", pct(some, F.col("total") * len(fields)))


def chunks_by_document(chunks: DataFrame, by: str = "source_pdf") -> DataFrame:
    """Chunks of each document as ordered rows next to the document's count.

    A table with one row per chunk, not a list per document: a document may hold any number.
    """
    df = chunks.withColumn(by, F.coalesce(F.nullif(F.col(by), F.lit("")), F.lit("unknown")))
    counts = df.groupBy(by).agg(F.count("*").alias("n_chunks"))
    return df.join(counts, by).select(by, "n_chunks", "chunk_id")


def article_stats(articles: DataFrame) -> DataFrame:
    """Field counts and mean lengths overall, article counts per source and per year."""
    n = lambda c: F.coalesce(F.length(c), F.lit(0)) > 0
    full = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    overall = articles.agg(
        F.count("*").alias("total"), F.count_if(n("title")).alias("with_title"), F.count_if(n("abstract")).alias("with_abstract"),
        F.count_if(full("keywords")).alias("with_keywords"), F.count_if(full("authors")).alias("with_authors"),
        F.count_if(F.coalesce(F.col("year") != 0, F.lit(False))).alias("with_year"), F.count_if(n("doi")).alias("with_doi"),
        F.avg(F.when(n("title"), F.length("title"))).alias("avg_title"), F.avg(F.when(n("abstract"), F.length("abstract"))).alias("avg_abstract"),
    )
    measures = overall.columns
    flat = overall.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in measures]).unpivot([], measures, "item", "value")
    by_source = articles.groupBy(F.col("source").alias("item")).agg(F.count("*").cast("double").alias("value"))
    by_year = articles.where(F.col("year") != 0).groupBy(F.col("year").cast("string").alias("item")).agg(F.count("*").cast("double").alias("value"))
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "item", "value")
    return tag(flat, "overall").union(tag(by_source, "source")).union(tag(by_year, "year"))


def text_stats(df: DataFrame, text: str = "text") -> DataFrame:
    n, w = F.length(text), F.regexp_count(text, F.lit(r"[^\s]+"))
    return df.agg(
        F.count("*").alias("total"), F.avg(n).alias("avg_chars"), F.min(n).cast("bigint").alias("min_chars"),
        F.max(n).cast("bigint").alias("max_chars"), F.avg(w).alias("avg_words"), F.count_if(n == 0).alias("empty"),
    )


def inventory_stats(files: DataFrame, size: str = "length") -> DataFrame:
    b = F.col(size)
    return files.agg(
        F.count("*").alias("files"), (F.sum(b) / (1024 * 1024)).alias("total_mb"), (F.min(b) / 1024).alias("min_kb"),
        (F.max(b) / 1024).alias("max_kb"), (F.avg(b) / 1024).alias("avg_kb"),
    )


def pages_from_size(size: Column) -> Column:
    """Six kilobytes to a page, at least one."""
    return F.greatest(F.lit(1), F.bround(size / 1024 / 6)).cast("bigint")


def estimate_cost(
    docs: DataFrame, sample: DataFrame, pages: str = "pages", unit: float = 0.002, seconds: float = 3.0
) -> DataFrame:
    """Extrapolate the pages of a sample to all documents; cost with a 20 % margin, hours."""
    total = docs.agg(F.count("*").alias("n")).scalar()
    s = sample.agg(
        F.count("*").alias("analyzed"), F.avg(pages).alias("avg_raw"), F.min(pages).alias("min_pages"), F.max(pages).alias("max_pages")
    ).withColumn("total_documents", total)
    s = s.withColumn("estimated_pages", F.floor(F.col("avg_raw") * F.col("total_documents")))
    cost = F.col("estimated_pages") * unit
    return s.select(
        "total_documents", "analyzed", F.bround("avg_raw", 1).alias("avg_pages"), "min_pages", "max_pages", "estimated_pages",
        F.bround(cost, 2).alias("cost"), F.bround(cost * 0.8, 2).alias("cost_low"), F.bround(cost * 1.2, 2).alias("cost_high"),
        F.bround(F.col("total_documents") * seconds / 3600, 1).alias("hours"),
    )


def extraction_report(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Pages, characters and words per document; failed when nothing was extracted."""
    per = pages.groupBy("paper_id").agg(
        F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars"), F.sum(F.regexp_count("text", F.lit(r"[^\s]+"))).alias("words")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return documents.select("paper_id").distinct().join(per, "paper_id", "left").select(
        "paper_id", F.col("pages").isNotNull().alias("ok"), zero("pages"), zero("chars"), zero("words")
    )


def extraction_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("documents"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
        pct(F.count_if("ok"), F.count("*")).alias("success_pct"), F.avg(F.when(F.col("ok"), F.col("pages"))).alias("avg_pages"),
        F.avg(F.when(F.col("ok"), F.col("chars"))).alias("avg_chars"), F.avg(F.when(F.col("ok"), F.col("words"))).alias("avg_words"),
    )


def provider_stats(chosen: DataFrame) -> DataFrame:
    """Documents, characters and pages per provider with the overall mean (integer division)."""
    overall = chosen.agg(F.expr("sum(chars) div greatest(count(*), 1)")).scalar()
    return chosen.groupBy("provider").agg(
        F.count("*").alias("documents"), F.sum("chars").alias("chars"), F.sum("pages").alias("pages")
    ).withColumn("average_chars", overall)


def coverage_report(status: DataFrame) -> DataFrame:
    """Species by state of their downloads, with totals and success rate."""
    per = status.groupBy("species").agg(F.count(F.when(F.col("status") != "none", 1)).alias("processed"), F.count_if(F.col("status") == "downloaded").alias("downloaded"))
    state = F.when(F.col("processed") == 0, "no_articles").when(F.col("downloaded") > 0, "ready").otherwise("blocked")
    counts = per.groupBy(state.alias("state")).agg(
        F.count("*").alias("species"), F.sum("processed").alias("processed"), F.sum("downloaded").alias("downloaded")
    )
    totals = counts.agg(F.sum("species")).scalar()
    rate = F.col("downloaded") / F.greatest(F.lit(1), F.col("processed")) * 100
    return counts.withColumn("species_pct", pct(F.col("species"), totals)).withColumn("success_pct", rate)


def species_counts(taxonomy: DataFrame, articles: DataFrame, files: DataFrame) -> DataFrame:
    """Articles and files of every species of the taxonomy, zero included."""
    n_articles = articles.groupBy("species").agg(F.count("*").alias("articles"))
    n_files = files.groupBy("species").agg(F.count("*").alias("files"))
    out = taxonomy.select("species").distinct().join(n_articles, "species", "left").join(n_files, "species", "left")
    return out.select(
        "species", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("files", F.lit(0)).alias("files")
    ).withColumn("with_files", F.col("files") > 0)


def status_summary(status: DataFrame) -> DataFrame:
    done = F.count_if(F.col("status") == "downloaded")
    return status.agg(
        F.count("*").alias("total"), done.alias("downloaded"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"), pct(done, F.count("*")).alias("success_pct"),
    )


def source_totals(articles: DataFrame, species_total: Column | None = None) -> DataFrame:
    """Articles per source and their mean over all species searched."""
    n = species_total if species_total is not None else articles.select("species").distinct().agg(F.count("*")).scalar()
    return articles.groupBy("source").agg(F.count("*").alias("articles")).withColumn("per_species", F.col("articles") / n)


def query_metrics(runs: DataFrame) -> DataFrame:
    """Success, latency and coverage of a batch of questions (``species, ok, seconds, chunks``).

    The median is the upper one. Latencies are counted per distinct value before they are ranked,
    and the ranking runs over running totals of those counts, so nothing is collected.
    """
    good = runs.where("ok")
    base = runs.agg(
        F.count("*").alias("total"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
        pct(F.count_if("ok"), F.count("*")).alias("success_pct"),
        F.min(F.when(F.col("ok"), F.col("seconds"))).alias("min_seconds"), F.max(F.when(F.col("ok"), F.col("seconds"))).alias("max_seconds"),
        F.avg(F.when(F.col("ok"), F.col("seconds"))).alias("avg_seconds"), F.avg(F.when(F.col("ok"), F.col("chunks"))).alias("avg_chunks"),
    )
    covered = runs.groupBy("species").agg(F.bool_or("ok").alias("any_ok")).agg(pct(F.count_if("any_ok"), F.count("*")))
    return base.withColumn("median_seconds", upper_median(good, "seconds").scalar()).withColumn("species_coverage_pct", covered.scalar())


def upper_median(df: DataFrame, value: str, accuracy: int = 100_000, few: int = 100_000) -> DataFrame:
    """Element ``n div 2`` of the ordered values, exactly, without sorting all of them.

    Approximate quantiles bracket the middle, again and again within the bracket, until it holds
    ``few`` values at most or one value only; those few are sorted in one row.
    """
    v = df.where(F.col(value).isNotNull()).select(value)
    place = v.count() // 2
    if v.isEmpty():
        return v.agg(F.max(value).alias(value))
    while (n := v.count()) > few:
        eps = 4.0 / accuracy + 1.0 / n
        middle = (place + 0.5) / n
        low, high = v.agg(F.percentile_approx(value, [max(0.0, middle - eps), min(1.0, middle + eps)], accuracy)).first()[0]
        below, low_n = v.agg(F.count_if(F.col(value) < low), F.count_if(F.col(value) == low)).first()
        if below <= place < below + low_n:  # also ends brackets that can't get any smaller
            return v.where(F.col(value) == low).agg(F.max(value).alias(value))
        v, place = v.where(F.col(value).between(low, high)), place - below
    return v.agg(F.get(F.sort_array(F.collect_list(value)), F.lit(place).cast("int")).alias(value))


def parameter_gaps(params: DataFrame, required: list[str] = fixed.REQUIRED_PARAMETERS, species: DataFrame | None = None) -> DataFrame:
    """Per species the parameters present and the required ones without any record.

    ``species`` names all of them: one without any record lacks everything.
    """
    present = params.groupBy("species").agg(F.array_sort(F.collect_set("parameter")).alias("available"))
    if species is not None:
        present = species.select("species").distinct().join(present, "species", "left")
        present = present.withColumn("available", F.coalesce("available", F.array().cast("array<string>")))
    return present.withColumn("missing", F.array_except(F.lit(list(required)), "available"))


def validate_index(chunks: DataFrame, metadata: DataFrame, dim: int) -> DataFrame:
    """Counts of both sides, unmatched ids, wrong vector sizes and the list of issues."""
    out = chunks.agg(
        F.count("*").alias("total_chunks"), F.count_if(F.size("embedding") != dim).alias("wrong_dimension"),
        F.coalesce(F.max(F.size("embedding")), F.lit(0)).cast("bigint").alias("embedding_dimension"),
    )
    ids, meta = chunks.select("chunk_id"), metadata.select("chunk_id")
    out = (
        out.withColumn("metadata_count", meta.agg(F.count("*")).scalar())
        .withColumn("without_metadata", ids.join(meta, "chunk_id", "left_anti").agg(F.count("*")).scalar())
        .withColumn("without_vector", meta.join(ids, "chunk_id", "left_anti").agg(F.count("*")).scalar())
    )
    issues = F.array_compact(
        F.array(
            F.when(F.col("total_chunks") == 0, "empty index"), F.when(F.col("wrong_dimension") > 0, "unexpected dimension"),
            F.when(F.col("metadata_count") != F.col("total_chunks"), "chunk and metadata counts differ"),
        )
    )
    return out.withColumn("issues", issues).withColumn("is_valid", F.size("issues") == 0)


def incomplete(progress: DataFrame) -> DataFrame:
    """Keys with more processed than downloaded."""
    return progress.where(F.col("processed") > F.col("downloaded"))


def is_complete(progress: DataFrame) -> DataFrame:
    return progress.agg(
        F.coalesce(F.bool_and(F.col("processed") <= F.col("downloaded")), F.lit(False)).alias("complete"),
        F.count_if(F.col("processed") > F.col("downloaded")).alias("incomplete"), F.count("*").alias("keys"),
    )


def phase_summary(runs: DataFrame) -> DataFrame:
    """Phases run, succeeded and failed (``phase, ok``)."""
    return runs.agg(F.count("*").alias("total"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"))


def compare_extractors(results: DataFrame, a: str, b: str, doc: str = "doc_id") -> DataFrame:
    """Characters and pages of two extractors per document, ratio, and a flag below 20 %."""
    wide = results.groupBy(doc).pivot("provider", [a, b]).agg(F.sum("chars").alias("chars"), F.sum("pages").alias("pages"))
    ratio = F.when((F.col(f"{a}_chars") > 0) & (F.col(f"{b}_chars") > 0), F.col(f"{a}_chars") / F.col(f"{b}_chars") * 100)
    return wide.withColumn("ratio_pct", ratio).withColumn("suspicious", F.coalesce(F.col("ratio_pct") < 20, F.lit(False)))


def compare_chunkers(strategies: dict[str, DataFrame], documents: DataFrame, target: int) -> DataFrame:
    """Chunks per document and chunk sizes of several chunkers, extrapolated to ``target`` documents."""
    parts = [df.select(F.lit(name).alias("strategy"), "paper_id", F.length("text").alias("n")) for name, df in strategies.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    per = rows.groupBy("strategy", "paper_id").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.sum("n").alias("s"))
    n_docs = documents.agg(F.count("*")).scalar()
    out = per.groupBy("strategy").agg(
        F.sum("c").alias("chunks"), F.min("c").alias("min_per_document"), F.max("c").alias("max_per_document"), F.avg("c").alias("avg_per_document"),
        F.min("lo").alias("min_size"), F.max("hi").alias("max_size"), (F.sum("s") / F.sum("c")).alias("avg_size"),
    )
    return out.withColumn("expected_chunks", F.col("chunks") / n_docs * target)


def bm25_summary(index) -> DataFrame:
    """Size and mean idf of an index next to its corpus statistics."""
    t = index.terms.agg(F.count("*").alias("terms"), F.avg("idf").alias("avg_idf"), F.sum("df").alias("postings"))
    return t.withColumn("chunks", index.corpus.select("n").scalar()).withColumn("avgdl", index.corpus.select("avgdl").scalar())
