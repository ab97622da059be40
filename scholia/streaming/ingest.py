"""Incremental ingest, graph updates and progress with Structured Streaming.

Every micro-batch writes a place of its own, named by the streaming query and the epoch. A batch that
runs again after a lost executor or driver writes the same place again, so nothing is added twice; a query
that starts anew without its checkpoint has another name, so it replaces nothing and skips what is done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from scholia.operators.chunking import chunk_sliding
from scholia.operators.pages import clean_pages
from scholia.operators.skew import first_by, running_total
from scholia.operators.stats import is_complete
from scholia.session import cut_lineage
from scholia.sources.graph_log import append_graph, compact_graph, folders


def _batch_name(spark: SparkSession, epoch: int) -> str:
    """Name of a micro-batch: the query that its checkpoint belongs to, and its number in it."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{epoch}"


def document_chunks(docs: DataFrame) -> DataFrame:
    """Default work of the ingest: clean the text, cut it into windows."""
    return chunk_sliding(clean_pages(docs.select("paper_id", "text")))


def ingest_stream(
    spark: SparkSession, source: str, schema, sink: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = document_chunks,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Work on documents not seen before, as files arrive in ``source``; stops when caught up.

    ``sink/chunks`` gets the results, ``sink/done`` the keys, each by ``batch``. Only keys are read back,
    never chunks.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        own = _batch_name(session, epoch)
        done = [f"{sink}/done/{name}" for name in folders(session, f"{sink}/done") if name not in (f"batch={own}",) and name.startswith("batch=")]
        fresh = batch.join(session.read.parquet(*done), "paper_id", "left_anti") if done else batch
        fresh = cut_lineage(first_by(fresh, ["paper_id"], [F.xxhash64("text")]))
        work(fresh).write.mode("overwrite").parquet(f"{sink}/chunks/batch={own}")
        fresh.select("paper_id").write.mode("overwrite").parquet(f"{sink}/done/batch={own}")

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def graph_stream(spark: SparkSession, source: str, schema, path: str, checkpoint: str, fanout: int | None = 8) -> StreamingQuery:
    """Merge extraction answers into a stored graph; each batch adds a version that holds only what is new.

    A batch that runs again after its version was whole writes nothing; a query without its old checkpoint goes on
    from the last version. Every ``fanout`` versions are merged into one piece, and so on; None leaves that to ``compact_graph``.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        append_graph(session, path, batch, _batch_name(session, epoch))
        if fanout:
            compact_graph(session, path, fanout)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ready_to_index(documents: DataFrame, progress: DataFrame, least: int = 1000) -> DataFrame:
    """Start building when enough documents are there or every download is complete."""
    n = documents.agg(F.count("*")).scalar()
    return is_complete(progress).select(
        n.alias("documents"), "complete", ((n >= least) | F.col("complete")).alias("ready")
    )


def progress_metrics(events: DataFrame, total: int | None = None, pos: str = "event_id", ts: str = "ts", found: str = "found") -> DataFrame:
    """Per event: processed and found so far, rate per minute, hours left.

    ``pos`` is the integer order of events; running totals go in blocks, not through one window.
    """
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    first = events.agg(F.min(ts)).scalar()
    n = F.lit(total) if total is not None else events.agg(F.count("*")).scalar()
    e = running_total(events, [], pos, F.lit(1).cast("bigint"), "before")
    e = running_total(e, [], pos, F.col(found).cast("bigint"), "found_before")
    seconds = F.col(ts).cast("double") - first.cast("double")
    processed = F.col("before") + 1
    rate = F.when(seconds > 0, processed / seconds * 60).otherwise(F.lit(0.0))
    return e.select(
        pos, processed.alias("processed"), (F.col("found_before") + F.col(found).cast("bigint")).alias("found"), rate.alias("per_minute"),
        F.when(rate > 0, (n - processed) / (rate / 60) / 3600).otherwise(F.lit(0.0)).alias("hours_left"),
    )


def progress_stream(events: DataFrame, name: str, by: str = "event_type") -> StreamingQuery:
    """Running counts of a stream of work events in an in-memory table."""
    counts = events.groupBy(by).agg(F.count("*").alias("processed"), F.count_if("found").alias("found"))
    return counts.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
