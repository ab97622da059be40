"""Explicit schemas of everything read from outside."""

from pyspark.sql import types as T

SEARCH_ROW_FIELDS = ["source", "title", "authors", "year", "journal", "doi", "url", "pubmed_id", "arxiv_id"]
SEARCH_ROW = T.StructType([T.StructField(f, T.StringType()) for f in SEARCH_ROW_FIELDS])

REGISTRY_ROW_FIELDS = ["title", "authors", "year", "doi", "url", "journal", "source", "abstract", "keywords"]
REGISTRY_ROW = T.StructType([T.StructField(f, T.StringType()) for f in REGISTRY_ROW_FIELDS])

SEARCH_RUN = "filename string, query string, total_articles bigint, sources array<string>, creation_date string"

FAILURE_FIELDS = ["timestamp", "doi", "species", "source", "title", "reason"]

ARTICLE = (
    "title string, authors array<string>, year int, doi string, url string, journal string, abstract string, "
    "keywords array<string>, source string, full_data string"
)
