"""Line dedup: content-defined chunks of lines that stand elsewhere before are removed, with the runs of lines around them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from scholia.llm.common import id_and_text, query, table
from scholia.session import cut_lineage

BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Cutting:
    """A chunk ends after a line whose rolling hash over ``window`` lines is a multiple of ``mean``."""

    window: int = 2
    mean: int = 3
    most: int = 64  # lines of a chunk, at most
    least: int = 2  # lines with content of a chunk that counts as repeated
    hashes: int = 1  # parts of the rolling hash, any of which may set a boundary


def rolled(line_hashes: np.ndarray, window: int) -> np.ndarray:
    """The rolling hash over each ``window`` line hashes, at the last of them."""
    n = len(line_hashes)
    roll = np.zeros(n, np.uint64)
    for k in range(min(window, n)):
        roll[k:] += line_hashes[: n - k] * BASE ** np.uint64(k + 1)
    return roll


def bounds(line_hashes: np.ndarray, c: Cutting) -> np.ndarray:
    """After which lines a chunk ends: the last ``window`` lines alone decide, so equal runs of lines are cut alike
    wherever they stand."""
    roll, out = rolled(line_hashes, c.window), np.zeros(len(line_hashes), bool)
    for k in range(c.hashes):
        out |= (roll >> np.uint64(20 + 21 * k)) % np.uint64(c.mean) == 0
    return out


def chunk_ends(line_hashes: np.ndarray, c: Cutting) -> list[int]:
    """Where chunks end (exclusive line numbers); a longer chunk is cut every ``most`` lines from its start."""
    ends, start, n = [], 0, len(line_hashes)
    for e in [*(np.flatnonzero(bounds(line_hashes, c)) + 1).tolist(), n]:
        while e - start > c.most:
            start += c.most
            ends.append(start)
        if e > start:
            ends.append(e)
            start = e
    return ends


def chunks_of(text: str, c: Cutting) -> list[tuple[int, int, int, int, int, int]]:
    """``number, start, end, lines, h1, h2`` of the chunks with enough lines; offsets in code points."""
    lines = text.split("\n")
    hashes = np.fromiter((xxhash.xxh64_intdigest(x.encode()) for x in lines), np.uint64, len(lines))
    sizes = [len(x) + 1 for x in lines]
    out, at, first = [], 0, 0
    for i, end in enumerate(chunk_ends(hashes, c)):
        stop = min(at + sum(sizes[first:end]), len(text))
        if sum(not x.isspace() and x != "" for x in lines[first:end]) >= c.least:
            d = xxhash.xxh3_128_digest(text[at:stop].removesuffix("\n").encode())
            out.append((i, at, stop, end - first, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
        at, first = stop, end
    return out


FIELDS = ("pos", "start", "stop", "n_lines", "h1", "h2")


def all_chunks(docs: DataFrame, c: Cutting) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [chunks_of(t.as_py(), c) for t in batch["text"]]
            pick = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = [x for f in found for x in f]
            columns = [pa.array([x[i] for x in flat], pa.int64()) for i in range(len(FIELDS))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(pick)), batch["t"].take(pa.array(pick)), *columns], names=["doc_id", "t", *FIELDS])

    return docs.mapInArrow(run, "doc_id bigint, t bigint, " + ", ".join(f"{f} bigint" for f in FIELDS))


def drop_repeated_chunks(docs: DataFrame, cutting: Cutting = Cutting(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text, n_lines, removed_chunks, removed_lines``.

    A chunk with two lines of content or more stays where it stands first (smallest id, null first, then
    the place in the text) and is removed elsewhere, with its line ends. Chunks are found by 128-bit hashes
    and compared by their bytes; different bytes under one hash are told apart. A null text is empty.
    Rows with one id and one text are one document and get the same result; an empty table gives no
    rows; other columns aren't read.
    """
    d = id_and_text(docs, id_col, text_col).withColumn("t", F.xxhash64("text"))
    chunks = cut_lineage(all_chunks(d, cutting).distinct())
    place = F.struct("doc_id", "t", "pos")
    seen = chunks.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marks = chunks.join(cut_lineage(seen), ["h1", "h2"]).withColumn("again", place != F.col("first"))
    spans = marks.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(F.struct(*FIELDS, "again"))).alias("spans"))
    spans = cut_lineage(spans.withColumnsRenamed({"doc_id": "m_id", "t": "m_t"}))
    met = d.join(spans, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("t") == F.col("m_t")), "left").drop("m_id", "m_t")
    met = cut_lineage(met)

    pieces = met.where("spans is not null").select("doc_id", "t", "text", F.explode("spans").alias("x"))
    piece = F.substring("text", F.col("x.start").cast("int") + 1, (F.col("x.stop") - F.col("x.start")).cast("int"))
    pieces = pieces.select("doc_id", "t", "x.pos", "x.h1", "x.h2", F.regexp_replace(piece, r"\n\z", "").alias("piece"))
    # The bytes of a group are equal when the smallest and the largest are; tasks reduce their share first.
    mixed = pieces.groupBy("h1", "h2").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi")).where("lo <> hi").select("h1", "h2")
    mixed = cut_lineage(mixed)
    if not mixed.isEmpty():
        apart = pieces.join(mixed, ["h1", "h2"])
        firsts = cut_lineage(apart.groupBy("h1", "h2", "piece").agg(F.min(place).alias("first")))
        fixed = apart.join(firsts, ["h1", "h2", "piece"]).where(place == F.col("first"))
        fixed = cut_lineage(fixed.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("keep")).withColumnsRenamed({"doc_id": "m_id", "t": "m_t"}))
        met = met.join(fixed, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("t") == F.col("m_t")), "left")
        gone = F.filter("spans", lambda x: x["again"] & ~F.coalesce(F.array_contains("keep", x["pos"]), F.lit(False)))
    else:
        gone = F.filter("spans", lambda x: x["again"])
    met = met.select("doc_id", "text", F.coalesce(gone, F.array()).alias("gone"))
    # What stays lies between the end of one removed span and the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("gone", lambda x: x["stop"]))
    stops = F.concat(F.transform("gone", lambda x: x["start"]), F.array(F.length("text").cast("bigint")))
    met = met.withColumn("stay", F.arrays_zip(starts.alias("a"), stops.alias("b")))
    kept = F.array_join(F.transform("stay", lambda x: F.col("text").substr((x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int"))), "")
    return met.select(
        "doc_id", F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("text"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("removed_chunks"),
        F.aggregate("gone", F.lit(0).cast("bigint"), lambda a, x: a + x["n_lines"]).alias("removed_lines"),
    )


def filled_lines(lines: list[str]) -> list[int]:
    """Numbers of the lines with content."""
    return [i for i, x in enumerate(lines) if x and not x.isspace()]


def pairs_of(text: str, c: Cutting) -> list[tuple[int, int, int, bool]]:
    """``pos, h1, h2, edge``: a hash of the ``pos``-th line with content, the next one and the blank lines between them, and
    whether the rolling hash puts a chunk's boundary there."""
    lines = text.split("\n")
    filled = filled_lines(lines)
    digests = [xxhash.xxh3_128_digest(lines[i].encode()) for i in filled]
    edge = bounds(np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64), c).tolist()
    out = []
    for k in range(len(filled) - 1):
        between = "\n".join(lines[filled[k] + 1 : filled[k + 1]]) + "\n" * (filled[k + 1] - filled[k] > 1)
        d = xxhash.xxh3_128_digest(digests[k] + digests[k + 1] + between.encode())
        out.append((k, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), edge[k + 1]))
    return out


def all_pairs(docs: DataFrame, c: Cutting) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [pairs_of(t.as_py(), c) for t in batch["text"]]
            pick = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            columns = [pa.array([x[i] for f in found for x in f], pa.int64() if i < 3 else pa.bool_()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pick), batch["t"].take(pick), *columns], names=["doc_id", "t", "pos", "h1", "h2", "edge"])

    return docs.mapInArrow(run, "doc_id bigint, t bigint, pos bigint, h1 bigint, h2 bigint, edge boolean")


def pair_bytes(met: DataFrame) -> DataFrame:
    """``doc_id, t, pos, h1, h2, piece``: the text of the pairs in ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            pick, rows = [], []
            for i, (text, spans) in enumerate(zip(batch["text"], batch["spans"], strict=True)):
                lines = text.as_py().split("\n")
                filled = filled_lines(lines)
                for x in spans.as_py():
                    pick.append(i)
                    rows.append((x["pos"], x["h1"], x["h2"], "\n".join(lines[filled[x["pos"]] : filled[x["pos"] + 1] + 1])))
            pick = pa.array(pick, pa.int64())
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pick), batch["t"].take(pick), *columns, pa.array([r[3] for r in rows], pa.string())],
                names=["doc_id", "t", "pos", "h1", "h2", "piece"],
            )

    return met.select("doc_id", "t", "text", "spans").mapInArrow(run, "doc_id bigint, t bigint, pos bigint, h1 bigint, h2 bigint, piece string")


def grown(gone: list[int], edges: list[int]) -> list[int]:
    """What is reached from ``edges`` along neighbouring numbers in ``gone``."""
    gone, edges = np.unique(gone), np.array(edges, np.int64)
    run = np.cumsum(np.diff(gone, prepend=gone[:1]) > 1)
    return gone[np.isin(run, run[np.isin(gone, edges)])].tolist()


def without_pairs(text: str, gone: list[int], edges: list[int]) -> tuple[str, int, int]:
    """The text without the lines of the pairs ``gone`` that lie in a run with an edge, and the blank lines between them, the number
    of runs of lines that went, and of lines."""
    gone = grown(gone, edges)
    lines = text.split("\n")
    filled = filled_lines(lines)
    dead = bytearray(len(lines))
    for k in gone:
        dead[filled[k] : filled[k + 1] + 1] = b"\1" * (filled[k + 1] + 1 - filled[k])
    last = len(lines) - 1
    kept = "".join(x if i == last else x + "\n" for i, x in enumerate(lines) if not dead[i])
    return kept, (b"\0" + dead).count(b"\0\1"), sum(dead)


def cut_pairs(met: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            text, gone = batch["text"], batch["gone"]
            has = pc.greater(pc.list_value_length(gone), 0)
            cut = [without_pairs(*(x.as_py() for x in row)) for row in zip(text.filter(has), gone.filter(has), batch["edges"].filter(has), strict=True)]
            zeros = pa.array(np.zeros(len(text), np.int64))
            runs, lines = (pc.replace_with_mask(zeros, has, pa.array([x[i] for x in cut], pa.int64())) for i in (1, 2))
            n_lines = pc.add(pc.count_substring(text, "\n").cast(pa.int64()), 1)
            text = pc.replace_with_mask(text, has, pa.array([x[0] for x in cut], text.type))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], text, n_lines, runs, lines], names=["doc_id", "text", "n_lines", "removed_chunks", "removed_lines"])

    return met.select("doc_id", "text", "gone", "edges").mapInArrow(run, "doc_id bigint, text string, n_lines bigint, removed_chunks bigint, removed_lines bigint")


def stood_before(first: Column) -> Column:
    """Whether the pair of this row repeats ``first``: it stands elsewhere and shares no line with it."""
    own = F.struct("doc_id", "t") == F.struct(first["doc_id"], first["t"])
    return ~(own & F.col("pos").between(first["pos"], first["pos"] + 1))


#: A boundary after three lines in four or so; the two lines of its window are the smallest chunk.
EDGES = Cutting(window=2, mean=2, hashes=2)


def drop_repeated_runs(docs: DataFrame, cutting: Cutting = EDGES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text, n_lines, removed_chunks, removed_lines``.

    A rolling hash over the hashes of lines with content chooses boundaries. A chunk reaches from one boundary to the next, the lines
    of both windows included, so whoever repeats a chunk repeats its windows, the smallest chunks. A repeated window is grown line by line,
    over chunk borders, as long as two neighbouring lines stood before: the whole run goes, with the blank lines in it
    and its line ends; ``removed_chunks`` counts the runs. A run without a boundary in it stays. Lines stay where
    they stand first (smallest id, null first, then the place in the text). A copy that shares a line with the first one isn't
    one: a line three times in a row stays. Blank lines before and after a run stay. Windows and neighbours are found by 128-bit
    hashes and compared by their bytes; different bytes under one hash are told apart. A null text is empty.
    Rows with one id and one text are one document and get the same result; an empty table gives no
    rows; other columns aren't read.

    Only documents with a window that several places share send their other lines.
    """
    d = id_and_text(docs, id_col, text_col).withColumn("t", F.xxhash64("text"))
    every = cut_lineage(all_pairs(d, cutting))
    same_doc = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("t") == F.col("m_t"))
    at = F.struct("doc_id", "t", "pos")
    windows = every.where("edge").groupBy("h1", "h2").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo <> hi").select("h1", "h2")
    shared = every.where("edge").join(cut_lineage(windows), ["h1", "h2"], "left_semi")
    shared = cut_lineage(shared.groupBy(F.col("doc_id").alias("m_id"), F.col("t").alias("m_t")).agg(F.lit(1).alias("one")))
    pairs = cut_lineage(every.join(shared, same_doc, "left_semi"))
    place = F.struct("doc_id", "t", "pos")
    # A document that is given twice has equal places, so places are compared and not counted.
    seen = pairs.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    marks = pairs.join(cut_lineage(seen), ["h1", "h2"]).withColumn("again", stood_before(F.col("first")))
    spans = marks.groupBy("doc_id", "t").agg(F.collect_set(F.struct("pos", "h1", "h2", "again", "edge")).alias("spans"))
    spans = cut_lineage(spans.withColumnsRenamed({"doc_id": "m_id", "t": "m_t"}))
    met = cut_lineage(d.join(spans, same_doc, "left").drop("m_id", "m_t"))

    pieces = pair_bytes(met.where("spans is not null"))
    # The bytes of a group are equal when the smallest and the largest are; tasks reduce their share first.
    mixed = pieces.groupBy("h1", "h2").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi")).where("lo <> hi").select("h1", "h2")
    mixed = cut_lineage(mixed)
    gone = F.transform(F.filter("spans", lambda x: x["again"]), lambda x: x["pos"])
    if not mixed.isEmpty():
        apart = cut_lineage(pieces.join(mixed, ["h1", "h2"]))
        firsts = cut_lineage(apart.groupBy("h1", "h2", "piece").agg(F.min(place).alias("first")))
        fixed = apart.join(firsts, ["h1", "h2", "piece"]).withColumn("again", stood_before(F.col("first")))
        fixed = fixed.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("told"), F.collect_set(F.when(F.col("again"), F.col("pos"))).alias("repeats"))
        met = met.join(cut_lineage(fixed.withColumnsRenamed({"doc_id": "m_id", "t": "m_t"})), same_doc, "left")
        gone = F.when(F.col("told").isNull(), gone).otherwise(F.array_union(F.array_except(gone, F.col("told")), F.col("repeats")))
    none = F.array().cast("array<bigint>")
    edges = F.transform(F.filter("spans", lambda x: x["edge"]), lambda x: x["pos"])
    return cut_pairs(met.select("doc_id", "text", F.coalesce(gone, none).alias("gone"), F.coalesce(edges, none).alias("edges")))


@query("op1_line_dedup")
def op1_line_dedup(spark, sf_dir):
    return drop_repeated_runs(table(spark, sf_dir, "documents"))
