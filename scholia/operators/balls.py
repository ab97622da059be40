"""A saved vector index of balls: chunks by cell, each with centre and radius, and an exact search that opens few cells."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scholia.operators.skew import top_k
from scholia.operators.vector import BLOCK_BYTES, SCORE_CELLS, TopK, similarity, to_matrix, vector_search
from scholia.session import cut_lineage

SAMPLE = 20_000  # vectors that the centres are fitted to, at most
CELLS = 1024  # cells, at most
ZERO, NONE = -1, -2  # cells of zero vectors and of what is no vector
SLACK = 1e-8  # scores are rounded to nine digits


def centres_of(sample: np.ndarray, cells: int, rounds: int = 4) -> np.ndarray:
    """Unit centres of the sample's unit rows, by a few rounds of spherical k-means from evenly spaced rows."""
    c = sample[np.linspace(0, len(sample) - 1, cells).astype(int)] if len(sample) else np.zeros((0, 0))
    for _ in range(rounds if len(sample) else 0):
        near = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 1e-9, sums / np.where(norms > 1e-9, norms, 1.0), c)
    return c


def in_cells(chunks: DataFrame, cells: int | None = None, seed: int = 3) -> tuple[DataFrame, DataFrame]:
    """``chunks`` with ``cell``, and ``cells(cell, n, radius, centre)``.

    Centres are fitted to a bounded sample and sent to every task; each chunk goes to the nearest. The radius of a cell is the
    largest distance of a member's direction from the centre.
    """
    spark = chunks.sparkSession
    total = chunks.count()
    cells = max(1, min(CELLS, int(math.sqrt(total)))) if cells is None else cells
    chosen = chunks.orderBy(F.xxhash64("seq", F.lit(seed)), "seq").limit(SAMPLE).select("embedding").toArrow().column("embedding")
    m, ok = to_matrix(chosen)
    sample = m[ok & m.any(axis=1)]
    centres = centres_of(sample, min(cells, len(sample)))
    sent = spark.sparkContext.broadcast((centres, m.shape[1]))

    def place(batches: Iterator[pa.RecordBatch]):
        c, dim = sent.value
        for batch in batches:
            m, ok = to_matrix(batch.column("embedding"), dim)
            cell, away = np.full(len(m), NONE, np.int32), np.zeros(len(m))
            cell[ok] = ZERO
            full = np.flatnonzero(ok & m.any(axis=1))
            step = max(1, SCORE_CELLS // max(1, len(c)))
            for at in range(0, len(full), step):
                rows = full[at : at + step]
                cos = m[rows] @ c.T
                cell[rows] = cos.argmax(axis=1)
                away[rows] = np.linalg.norm(m[rows] - c[cell[rows]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "cell", "away"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema.fields)
    placed = cut_lineage(chunks.mapInArrow(place, f"{schema}, cell int, away double"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    where = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    return placed.drop("away"), sizes.join(where, "cell", "left")


@dataclass
class BallIndex:
    """``chunks(chunk_id, seq, embedding, …, cell)`` in a folder per cell, and ``cells(cell, n, radius, centre)``."""

    chunks: DataFrame
    cells: DataFrame
    scan_from: float = 0.5  # share of the chunks in the cells to be read from which all are scanned

    def search(self, queries: DataFrame, k: int = 5, metric: str = "cosine", block_bytes: int = BLOCK_BYTES) -> DataFrame:
        """As ``vector_search``. Two rounds for a block of questions: the nearest cells that hold k chunks give each question a k-th score,
        then only cells whose ball may hold a better one are read. Zero vectors are always read."""
        table = self.cells.orderBy("cell").collect()  # a bounded number of cells
        balls = [r for r in table if r["cell"] >= 0]
        dim = len(balls[0]["centre"]) if balls else 0
        n_blocks = max(1, math.ceil(queries.count() * 8 * max(1, dim) / block_bytes))
        out = None
        for block in range(n_blocks):
            part = queries.select("query_id", "embedding")
            part = part if n_blocks == 1 else part.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == block)
            hits = self._block(cut_lineage(part), balls, dim, k, metric)
            out = hits if out is None else out.unionByName(hits)
        return top_k(out, ["query_id"], [F.desc("score"), F.asc("seq")], k)

    def _block(self, part: DataFrame, balls: list, dim: int, k: int, metric: str) -> DataFrame:
        asked = part.toArrow()
        q, ok = to_matrix(asked.column("embedding"), dim) if dim else to_matrix(asked.column("embedding"))
        qids = asked.column("query_id").combine_chunks().filter(pa.array(ok))
        if not balls:
            return vector_search(self.chunks, part, k, metric).drop("rank")
        q = q[ok]
        bound, n = self.bounds(q, balls, metric), np.array([r["n"] for r in balls])
        order = np.argsort(-bound, axis=1, kind="stable")
        before = np.cumsum(n[order], axis=1) - n[order]
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, order, before < k, axis=1)
        best = cut_lineage(self.scored(qids, q, first, balls, k, metric, True))
        kth = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        least = {r["query_id"]: r["kth"] for r in kth.collect()}  # a number per question of the block
        mark = np.array([least.get(i, -np.inf) for i in qids.to_pylist()])
        left = ~first & (bound + SLACK >= mark[:, None])
        if n[left.any(axis=0)].sum() >= self.scan_from * max(1, n.sum()):
            return vector_search(self.chunks, part, k, metric).drop("rank")
        return best.unionByName(self.scored(qids, q, left, balls, k, metric, False))

    @staticmethod
    def bounds(q: np.ndarray, balls: list, metric: str) -> np.ndarray:
        """The best score that a member of each ball can have, for each question: a direction within ``radius`` of the centre
        is no nearer than the centre less the radius."""
        centres, radius = np.array([r["centre"] for r in balls]), np.array([r["radius"] for r in balls])
        away = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (q @ centres.T)))
        cos = 1.0 - np.maximum(0.0, away - radius) ** 2 / 2.0
        cos[~q.any(axis=1)] = 1.0  # a question without direction is as near to all
        return similarity(cos, metric)

    def reached(self, wanted: np.ndarray, balls: list, zeros: bool) -> DataFrame:
        """The chunks of the cells that some question wants; the folders of the others aren't opened."""
        cells = [balls[i]["cell"] for i in np.flatnonzero(wanted.any(axis=0))]
        return self.chunks.where(F.col("cell").isin(cells + [ZERO] * zeros))

    def scored(self, qids: pa.Array, q: np.ndarray, wanted: np.ndarray, balls: list, k: int, metric: str, zeros: bool) -> DataFrame:
        """The k best chunks of each question among the cells it wants, a task's own k before they are shuffled."""
        ask = {balls[i]["cell"]: np.flatnonzero(wanted[:, i]) for i in range(len(balls))} | {ZERO: np.arange(len(q))}
        sent = self.chunks.sparkSession.sparkContext.broadcast((qids, q, ask))

        def run(batches: Iterator[pa.RecordBatch]):
            qids, q, ask = sent.value
            top = TopK(k)
            for batch in batches:
                m, ok = to_matrix(batch.column("embedding"), q.shape[1])
                cells = batch.column("cell").to_numpy()
                seq = batch.column("seq").to_numpy(zero_copy_only=False)
                for cell in np.unique(cells):
                    who, rows = ask[int(cell)], np.flatnonzero((cells == cell) & ok)
                    step = max(1, SCORE_CELLS // max(1, len(who)))
                    for at in range(0, len(rows) if len(who) else 0, step):
                        some = rows[at : at + step]
                        scores = np.round(similarity(q[who] @ m[some].T, metric), 9)
                        top.add(scores, seq[some], batch.column("chunk_id").take(pa.array(some)), rows=who)
            yield from top.batches(qids)

        chunks = self.reached(wanted, balls, zeros).select("chunk_id", F.col("seq").cast("bigint").alias("seq"), "embedding", "cell")
        query_type = {"string": "string", "int64": "bigint", "int32": "int"}.get(str(qids.type), "string")
        hits = chunks.mapInArrow(run, f"query_id {query_type}, chunk_id string, seq bigint, score double")
        return top_k(hits, ["query_id"], [F.desc("score"), F.asc("seq")], k).drop("rank")
