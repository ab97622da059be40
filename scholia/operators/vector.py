"""Exact vector search for batches of questions."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from scholia import fixed
from scholia.operators.skew import top_k

BLOCK_BYTES = 64 << 20
SCORE_CELLS = 4_000_000  # scores that a task holds at a time


def common_size(column: pa.Array | pa.ChunkedArray) -> int:
    """The length that most lists of a column have."""
    sizes = pc.list_value_length(column).drop_null().to_numpy()
    return int(np.bincount(sizes).argmax()) if len(sizes) else 0


def to_matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """List column to a matrix of unit rows, and which rows are vectors.

    Null lists, lists of another length than ``dim`` (the most common one by default) and lists with null
    or non-finite numbers are no vectors; their rows are zero, as is the row of a zero vector.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    dim = common_size(column) if dim is None else dim
    ok = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False) == dim
    m = np.zeros((len(column), dim))
    if dim:
        m[ok] = column.filter(pa.array(ok)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    ok &= np.isfinite(m).all(axis=1)
    m[~ok] = 0.0
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms), ok


def _best(rows, scores, seqs, ids, k):
    """The first k entries per row by falling score, then by seq."""
    order = np.lexsort((seqs, -scores, rows))
    rows, scores, seqs, ids = rows[order], scores[order], seqs[order], ids[order]
    first = np.r_[0, np.flatnonzero(np.diff(rows)) + 1] if len(rows) else np.zeros(0, int)
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
    keep = place < k
    return rows[keep], scores[keep], seqs[keep], ids[keep]


def similarity(cos: np.ndarray, metric: str) -> np.ndarray:
    """Score of a cosine: its place between -1 and 1, or one over one plus the squared distance of the directions."""
    return (cos + 1.0) / 2.0 if metric == "cosine" else 1.0 / (1.0 + (2.0 - 2.0 * cos))


class TopK:
    """The k best (chunk, score) per question over the batches one task has seen."""

    def __init__(self, k: int):
        self.k, self.state, self.kth = k, None, None

    def add(self, scores: np.ndarray, seq: np.ndarray, ids: pa.Array, above: float = -np.inf, rows: np.ndarray | None = None) -> None:
        """``scores`` has one row per question (those of ``rows``) and one column per chunk."""
        which = np.arange(len(scores)) if rows is None else rows
        wanted = scores > above
        if len(which) and self.kth is not None and which[-1] < len(self.kth):
            wanted &= scores >= self.kth[which][:, None]  # what k better ones were found for can't come in
        if scores.shape[1] > self.k:
            wanted &= scores >= -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1 : self.k]
        found, cols = np.nonzero(wanted)
        if not len(found):
            return
        met, place = np.unique(cols, return_inverse=True)  # names only of the chunks that may stay
        names = np.asarray(ids.take(pa.array(met)).to_pylist(), dtype=object)[place]
        new = (which[found], scores[found, cols], seq[cols], names)
        if self.state is not None:
            new = tuple(np.concatenate(pair) for pair in zip(self.state, new))
        self.state = _best(*new, self.k)
        held = self.state[0]
        self.kth = np.full(max(int(held[-1]), int(which[-1])) + 1, -np.inf)
        full = np.bincount(held, minlength=len(self.kth)) == self.k
        np.minimum.at(lowest := np.full(len(self.kth), np.inf), held, self.state[1])
        self.kth[full] = lowest[full]

    def batches(self, qids: pa.Array):
        if self.state is not None and len(self.state[0]):
            rows, scores, seqs, ids = self.state
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": qids.take(pa.array(rows)), "chunk_id": pa.array(ids.tolist(), pa.string()),
                    "seq": pa.array(seqs, pa.int64()), "score": pa.array(scores, pa.float64()),
                }
            )


def hits_schema(queries: DataFrame) -> str:
    return f"query_id {queries.schema['query_id'].dataType.simpleString()}, chunk_id string, seq bigint, score double"


def _search_task(query_block, k, metric):
    """Arrow batches in, the task's own top k per question out."""

    def run(batches):
        qids, q = query_block.value
        top = TopK(k)
        step = max(1, SCORE_CELLS // max(1, len(qids)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                m, ok = to_matrix(batch.column("embedding"), q.shape[1])
                cos = q @ m.T
                sim = np.round(similarity(cos, metric), 9)
                sim[:, ~ok] = -np.inf  # never above the floor
                top.add(sim, batch.column("seq").to_numpy(zero_copy_only=False), batch.column("chunk_id"))
        yield from top.batches(qids)

    return run


def vector_search(
    chunks, queries: DataFrame, k: int = 5, metric: str = "cosine", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact top ``k`` chunks per question: ``query_id, chunk_id, seq, score, rank``.

    Chunks and questions without a vector of the questions' common length (null, ragged, not finite) have
    no hits. A saved ``BallIndex`` opens the cells that can matter; ``chunks(chunk_id, seq, embedding)`` is scanned where it lies; every task multiplies its Arrow
    batches with the question matrix and keeps its own k best, so only k rows per question and task
    are shuffled and no pair table ever exists. The matrix is sent to the tasks in blocks of at
    most ``block_bytes``; a batch beyond that takes one scan per block.
    """
    if not isinstance(chunks, DataFrame):
        return chunks.search(queries, k, metric, block_bytes)
    spark = chunks.sparkSession
    sizes = queries.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).where("dim > 0").collect()
    dim = max(sizes, key=lambda r: (r["n"], -r["dim"]))["dim"] if sizes else 0  # a row per length
    n_blocks = max(1, math.ceil(sum(r["n"] for r in sizes) * 8 * dim / block_bytes))
    corpus = chunks.select("chunk_id", F.col("seq").cast("bigint").alias("seq"), "embedding")
    found = []
    for block in range(n_blocks):
        part = queries.select("query_id", "embedding")
        if n_blocks > 1:
            part = part.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == block)
        table = part.toArrow()
        m, ok = to_matrix(table.column("embedding"), dim)
        qids = table.column("query_id").combine_chunks().filter(pa.array(ok))
        block_ = spark.sparkContext.broadcast((qids, m[ok]))
        found.append(corpus.mapInArrow(_search_task(block_, k, metric), hits_schema(queries)))
    hits = reduce(DataFrame.unionByName, found)
    return top_k(hits, ["query_id"], [F.desc("score"), F.asc("seq")], k)


def min_score(hits: DataFrame, least: float = fixed.MIN_SCORE) -> DataFrame:
    return hits.where(F.col("score") >= least)
