"""Exact duplicates: rows grouped by a 128-bit content hash, bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholia.llm.common import id_and_text, light_side, query, table
from scholia.session import cut_lineage

ROWS_A_TASK = 20_000  # rows of one group that a task compares
WHITE = " \t\n\x0b\x0c\r"


def squeezed(text: Column) -> Column:
    """The text without the six ASCII white-space characters."""
    for ch in WHITE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def md5_128(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, content_hash=md5_128) -> DataFrame:
    d = id_and_text(docs, id_col, text_col)
    d = d.select("doc_id", F.length("text").cast("bigint").alias("n_points"), squeezed(F.col("text")).alias("norm"))
    return d.select("doc_id", "n_points", "norm", content_hash(F.col("norm")).alias("h"), F.sha2("norm", 256).alias("text_sha256"))


def collided(prints: DataFrame, sizes: DataFrame) -> DataFrame:
    """Hashes whose group holds different bytes. ``sizes(h, n)`` has the hashes of several rows.

    A group's texts are equal when its smallest and largest text are; both are reduced within each
    task. A group of more rows than a task should read is dealt over as many tasks as it needs, the others aren't.
    """
    dealt = salted(prints.select("h", "norm", F.xxhash64("doc_id").alias("place")), sizes)
    parts = dealt.groupBy("h", "salt").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    return parts.groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("h")


def salts_of(sizes: DataFrame) -> DataFrame:
    """``h, salts`` of each hash."""
    return sizes.select("h", F.ceil(F.col("n") / ROWS_A_TASK).alias("salts"))


def salted(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The ``rows`` (``h, place``, …) whose hash is in ``sizes``, with a ``salt`` below the number of tasks for its group."""
    salts = salts_of(sizes)
    hot, _ = light_side(salts.where("salts > 1"))
    own = rows.join(hot, "h", "left").withColumn("salt", F.pmod("place", F.coalesce("salts", F.lit(1)))).drop("salts")
    keys = salts.select("h", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"))
    return own.join(keys, ["h", "salt"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash=md5_128) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_points``.

    Texts are equal when identical without ASCII white space. Of equal texts the one with the most code
    points stays, then the smallest id (null last), then one of the repeated rows. A null text is empty;
    empty texts are one group. An empty table gives no rows; other columns are not read.

    Narrow rows (hash, digest, length) are grouped; texts move only for hashes that several rows share,
    to compare their bytes. Should different bytes meet in a group, its rows are grouped anew by hash and
    SHA-256.
    """
    prints = fingerprints(docs, id_col, text_col, content_hash)
    light = cut_lineage(prints.drop("norm").withColumn("row", F.monotonically_increasing_id()))
    sizes = cut_lineage(light.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    key = F.col("h")
    if not sizes.isEmpty():
        mixed, n_mixed = light_side(collided(prints, sizes))
        if n_mixed:
            light = light.join(mixed.withColumn("mixed", F.lit(True)), "h", "left")
            light = cut_lineage(light.withColumn("h", F.when(F.col("mixed"), F.concat("h", F.unhex("text_sha256"))).otherwise(key)).drop("mixed"))
    best = F.min(F.struct((-F.col("n_points")).alias("points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = cut_lineage(light.groupBy("h").agg(best.alias("best"), F.count("*").alias("group_size")))
    return light.join(groups, "h").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256", "n_points",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``exact_dedup`` keeps."""
    flags = exact_dedup(docs, id_col, text_col).where("kept")
    keep = cut_lineage(flags.select(F.col("keep_id").alias("k_id"), F.col("text_sha256").alias("k_sha"), F.col("n_points").alias("k_points")))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("whole"), docs[id_col].alias("id"), F.sha2(squeezed(text), 256).alias("sha"),
        F.length(text).cast("bigint").alias("points"),
    )
    met = marked.join(keep, marked["id"].eqNullSafe(keep["k_id"]) & (F.col("sha") == F.col("k_sha")) & (F.col("points") == F.col("k_points")), "left_semi")
    # Repeated rows meet the same kept row: one of each stays.
    order = Window.partitionBy("id", "sha", "points").orderBy("id")
    return met.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("whole.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY n_points DESC, doc_id) AS nth FROM d
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       nth = 1 AS kept, sha256(norm) AS text_sha256
FROM r WINDOW w AS (PARTITION BY norm ORDER BY nth)
"""


@query("op8_exact_dedup", SQL)
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_points")
