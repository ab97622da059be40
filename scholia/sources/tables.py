"""Index and graph tables on disk (Parquet)."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholia.operators.balls import BallIndex, in_cells
from scholia.operators.bm25 import Bm25Index
from scholia.operators.graph import Graph
from scholia.operators.postings import SPAN, PostingIndex, posting_blocks
from scholia.session import swept


def write_index(index: DataFrame, path: str, model: str = "unknown") -> None:
    """Chunks with vectors by document, next to a one-row configuration."""
    index.repartitionByRange("paper_id", "seq").sortWithinPartitions("paper_id", "seq").write.mode("overwrite").parquet(f"{path}/chunks")
    saved = index.sparkSession.read.parquet(f"{path}/chunks")
    config = saved.agg(F.count("*").alias("total_chunks"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("embedding_dimension"))
    config.select(F.lit(model).alias("embedding_model"), "*", F.current_timestamp().alias("last_updated")).write.mode("overwrite").parquet(f"{path}/config")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/config")


def write_balls(chunks: DataFrame, path: str, cells: int | None = None) -> None:
    """A vector index: chunks in a folder per cell (a large cell in several files), and the cells' centres and radii."""
    placed, balls = in_cells(chunks, cells)
    placed.repartitionByRange("cell", "seq").sortWithinPartitions("cell", "seq").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    balls.write.mode("overwrite").parquet(f"{path}/balls")


def read_balls(spark: SparkSession, path: str) -> BallIndex:
    """Saved vector index; ``vector_search`` opens the cells it needs."""
    return BallIndex(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/balls"))


ZONES = 1024  # folders of chunk numbers, at most
LOT = 2_000_000  # chunks whose postings make a file in each folder of terms


def write_postings(index: Bm25Index, path: str, span: int = SPAN) -> None:
    """An inverted index: posting blocks in folders of terms, sorted by term and block, the names of the chunks in
    folders of numbers, and statistics."""
    # Few files a folder: chunks in lots, the postings of a folder's terms and a lot of blocks go to one task. Short numbers on the way.
    lots = max(1, index.bags.count() // LOT)
    blocks = posting_blocks(index, span).repartition("part", F.pmod("block", F.lit(lots))).sortWithinPartitions("part", "term", "block")
    blocks = blocks.withColumns({c: F.col(c).cast("array<bigint>") for c in ("tfs", "dls")})
    blocks.select("part", "term", "block", "n", "most", "seqs", "tfs", "dls").write.mode("overwrite").partitionBy("part").parquet(f"{path}/blocks")
    last = index.bags.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("last")).first()["last"]
    zone_span = max(span, -(-(int(last) + 1) // ZONES))
    chunks = index.bags.select(F.floor(F.col("seq") / zone_span).cast("int").alias("zone"), F.col("seq").cast("bigint").alias("seq"), "chunk_id")
    chunks.repartitionByRange("seq").sortWithinPartitions("seq").write.mode("overwrite").partitionBy("zone").parquet(f"{path}/numbers")
    index.terms.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")
    facts = {"zone_span": zone_span, "k1": float(index.k1), "b": float(index.b)}
    index.corpus.select("*", *(F.lit(v).alias(k) for k, v in facts.items())).write.mode("overwrite").parquet(f"{path}/corpus")


def read_postings(spark: SparkSession, path: str) -> PostingIndex:
    """Saved index; ``bm25_search`` and the hybrid search read the blocks they need from it."""
    blocks = spark.read.schema("term string, block bigint, n bigint, most double, seqs array<bigint>, tfs array<bigint>, dls array<bigint>, part int").parquet(f"{path}/blocks")
    chunks = spark.read.schema("seq bigint, chunk_id string, zone int").parquet(f"{path}/numbers")
    corpus = spark.read.parquet(f"{path}/corpus")
    facts = corpus.first()
    return PostingIndex(blocks, chunks, spark.read.parquet(f"{path}/terms"), corpus.select("n", "avgdl"), facts["zone_span"], facts["k1"], facts["b"])


def write_graph(graph: Graph, path: str) -> None:
    with swept(graph.entities.sparkSession):
        for name, table in graph.tables().items():
            table.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")


def read_graph(spark: SparkSession, path: str) -> Graph:
    return Graph(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(Graph)})
