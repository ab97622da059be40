"""Files in and out: article lists, registries, documents, run records, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholia import schemas
from scholia.functions.ids import safe_species
from scholia.functions.text import squeeze, strip

CSV = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "mode": "PERMISSIVE"}
MAX_DOCUMENT_BYTES = 50 * 1024 * 1024


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """All result files of a folder as one table of strings; the file (or folder) names the species."""
    df = spark.read.options(**CSV, recursiveFileLookup="true").schema(schemas.SEARCH_ROW).csv(path)
    df = df.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"))
    folder = F.regexp_extract("file_path", r"/file=([^/]+)/[^/]+$", 1)
    stem = F.when(folder != "", F.url_decode(folder)).otherwise(F.regexp_replace("file_name", r"\.csv$", ""))
    return df.withColumn("species", F.translate(stem, "_", " ")).drop("file_path")


def write_articles(articles: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder of CSV per species under its safe name, nine fixed columns.

    The rebalance hint gathers small species and splits a very large one over several writers.
    """
    cols = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in articles.columns else F.lit("").alias(f) for f in schemas.SEARCH_ROW_FIELDS]
    out = articles.select(*cols, safe_species("species").alias("file")).hint("rebalance", "file")
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).options(header="true", escape='"', quoteAll="true").partitionBy("file").csv(path)


def authors_line(authors: str = "authors", most: int = 3) -> Column:
    """The first authors, comma-joined, as article files hold them."""
    return F.array_join(F.slice(authors, 1, most), ", ")


def read_species(spark: SparkSession, path: str, column: str = "species") -> DataFrame:
    """Species column of a taxonomy file; the column must exist, blanks are dropped."""
    df = spark.read.options(header="true", escape='"').csv(path)
    if column not in df.columns:
        raise ValueError(f"{path} has no column {column}, only {df.columns}")
    return df.withColumn(column, strip(column)).where(F.col(column) != "")


def scan_documents(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """Binary documents below a folder with name and size."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.withColumn("name", F.substring_index("path", "/", -1)).withColumn("stem", F.regexp_replace("name", r"\.[^.]+$", ""))


def is_valid_document(content: Column, size: Column, most: int = MAX_DOCUMENT_BYTES) -> Column:
    """A real PDF (by its first bytes) of acceptable size; error pages in HTML or XML fail."""
    return (F.hex(F.substring(content, 1, 4)) == "25504446") & (size <= most)


def valid_documents(documents: DataFrame, most: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    return documents.where(is_valid_document(F.col("content"), F.col("length"), most))


def save_registry(articles: DataFrame, path: str, query: str = "unknown") -> None:
    """Articles as CSV with lists joined by ``; ``, and a one-row JSON record of the run."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    joined = lambda c: F.coalesce(F.array_join(c, "; "), F.lit("")).alias(c)
    cols = [joined(f) if f in ("authors", "keywords") else (text(f) if f in articles.columns else F.lit("").alias(f)) for f in schemas.REGISTRY_ROW_FIELDS]
    articles.select(*cols).write.mode("overwrite").options(header="true", escape='"', quoteAll="true").csv(f"{path}/articles")
    run = articles.agg(
        F.lit(path).alias("filename"), F.lit(query).alias("query"), F.count("*").alias("total_articles"),
        F.array_sort(F.collect_set("source")).alias("sources"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("creation_date"),
    )
    run.coalesce(1).write.mode("overwrite").json(f"{path}/run")


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Saved articles with lists and years restored, empty text as null."""
    df = spark.read.options(**CSV).schema(schemas.REGISTRY_ROW).csv(f"{path}/articles")
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    items = lambda c: F.transform(F.split(c, ";"), strip)
    return df.select(
        "title", F.coalesce(F.when(F.length("authors") > 0, items("authors")), F.array().cast("array<string>")).alias("authors"),
        F.col("year").try_cast("int").alias("year"), *[full(c).alias(c) for c in ("doi", "url", "journal")], "source",
        full("abstract").alias("abstract"), F.when(F.length("keywords") > 0, items("keywords")).alias("keywords"),
    )


def search_history(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Records of saved runs, corrupt ones skipped, newest first."""
    df = spark.read.schema(schemas.SEARCH_RUN).options(mode="DROPMALFORMED", recursiveFileLookup="true", pathGlobFilter=glob).json(path)
    return df.orderBy(F.desc_nulls_last("creation_date"), F.asc("filename"))


def write_failures(rows: DataFrame, path: str) -> None:
    """Append failed rows with their reason and the time."""
    failed = rows.where(F.col("status") == "failed").withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    cols = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in failed.columns else F.lit("").alias(f) for f in schemas.FAILURE_FIELDS]
    failed.select(*cols).write.mode("append").options(header="true", escape='"', quoteAll="true").csv(path)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{f} string" for f in schemas.FAILURE_FIELDS)
    return spark.read.options(**CSV).schema(schema).csv(path)


def write_report(stats: DataFrame, path: str, phase: str) -> None:
    """A one-row table of statistics as a JSON document."""
    stats.select(F.lit(phase).alias("phase"), F.current_timestamp().alias("timestamp"), F.struct(*stats.columns).alias("statistics")).coalesce(1).write.mode("overwrite").json(path)


def fix_linebreaks(articles: DataFrame, column: str = "title") -> DataFrame:
    return articles.withColumn(column, squeeze(column))
