"""Nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from scholia.llm.common import query, table
from scholia.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    """Fitting and blocking parameters.

    ``sample`` vectors, chosen by a hash of the id, fit the rotations and the radius; the radius is the
    Hamming distance within which ``coverage`` of the sample's true neighbours lie. In the whole table a
    query's neighbours are nearer than in a sample of it, so the radius errs on the wide side.
    """

    bits: int = 256
    sample: int = 10_000
    judges: int = 400
    coverage: float = 0.97
    rounds: int = 15
    shard: int = 16_384  # vectors, and
    block: int = 4_096  # queries, that a task holds at a time
    seed: int = 11


@dataclass(frozen=True)
class Codes:
    """What turns a vector into a code: ``scale`` is the largest norm if norms differ, else 0."""

    rotation: np.ndarray  # dimensions (one more with a scale) by bits
    scale: float
    radius: int

    def widened(self, x: np.ndarray, queries: bool) -> np.ndarray:
        """Inner products as angles: vectors get a coordinate that brings all to one norm, queries a zero."""
        if not self.scale:
            return x
        rest = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.scale**2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest])

    def encode(self, x: np.ndarray, queries: bool = False) -> np.ndarray:
        return np.packbits(self.widened(x, queries) @ self.rotation > 0, axis=1)


def learned_rotation(x: np.ndarray, bits: int, rounds: int, rng) -> np.ndarray:
    """Rotations, side by side, each turned until the signs of the rotated vectors fit them best."""
    d, parts = x.shape[1], []
    for _ in range(-(-bits // d)):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.sign(x @ r).T @ x)
            r = (u @ vt).T
        parts.append(r)
    return np.hstack(parts)[:, :bits]


def fit(x: np.ndarray, scale: float, k: int, s: Settings) -> Codes:
    rng = np.random.default_rng(s.seed)
    plain = Codes(np.zeros((0, 0)), scale, 0)
    wide = plain.widened(x, False)
    wide = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    codes = Codes(learned_rotation(wide, s.bits, s.rounds, rng), scale, 0)
    mine, asked = codes.encode(x), codes.encode(x[: s.judges], True)
    far = []
    for i in range(len(asked)):
        near = x @ x[i]
        near[i] = -np.inf
        best = np.argsort(-near)[: min(k, len(x) - 1)]
        far.extend(np.bitwise_count(mine[best] ^ asked[i]).sum(1, dtype=np.int64))
    return Codes(codes.rotation, scale, int(np.quantile(far, s.coverage, method="higher")) if far else s.bits)


class MultiIndex:
    """An index of every 8-bit substring of the codes; finds all codes within a radius.

    Pigeonhole: with reaches ``r_i`` whose ``r_i + 1`` add up to ``radius + 1``, a code within the radius
    is within ``r_i`` of the query in some substring ``i``. So probing each substring's buckets up to its
    reach meets every such code; the whole codes then decide.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        n, m = codes.shape
        pad = np.zeros((n, -m % 8), np.uint8)
        self.words = np.ascontiguousarray(np.hstack([codes, pad])).view(np.uint64)
        self.order = np.concatenate([np.argsort(codes[:, j], kind="stable") for j in range(m)])
        sizes = np.concatenate([np.bincount(codes[:, j], minlength=256) for j in range(m)])
        self.ends = np.concatenate([[0], np.cumsum(sizes)])  # tables one after the other

    def probes(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Table numbers and the differences to the query's substring to look up in them."""
        m = self.codes.shape[1]
        reach = np.full(m, (radius + 1) // m - 1) + (np.arange(m) < (radius + 1) % m)
        weight = np.bitwise_count(np.arange(256, dtype=np.uint8))
        pairs = [(j, np.flatnonzero(weight <= reach[j])) for j in range(m)]
        return np.concatenate([np.full(len(v), j) for j, v in pairs]), np.concatenate([v for _, v in pairs])

    def within(self, code: np.ndarray, radius: int, probes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        n, m = self.codes.shape
        tables, differences = probes
        bucket = tables * 256 + (code[tables] ^ differences)
        lo, long = self.ends[bucket], self.ends[bucket + 1] - self.ends[bucket]
        pick = np.arange(long.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(long)[:-1]]), long)
        met = np.zeros(n, bool)
        met[self.order[pick]] = True
        rows = np.flatnonzero(met)
        asked = np.concatenate([code, np.zeros(-m % 8, np.uint8)]).view(np.uint64)
        return rows[np.bitwise_count(self.words[rows] ^ asked).sum(1, dtype=np.int64) <= radius]


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed in the order of the components, so equal vectors score equally."""
    out = np.zeros(len(x))
    for j in range(len(q)):
        out += x[:, j] * q[j]
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the vectors that take part; one of rows that share an id."""
    v = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~F.exists("v", bad) & F.exists("v", lambda c: c != 0))
    return v.groupBy("vec_id").agg(F.min("v").alias("v"))


EMPTY = "query_id bigint, rank int, vec_id bigint, score double"


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``every`` its ``k`` nearest other vectors.

    Nearness is the inner product in double precision, ties go to the smaller id. Null, empty and zero
    vectors, those with null or non-finite components, with another length than most have, or without an
    id take no part. Of rows that share an id the smallest vector counts. A query with fewer than ``k``
    codes within the radius is searched again within all codes, so it has ``k`` results if there are so
    many other vectors. An empty table gives no rows; other columns aren't read.

    Vectors are dealt into shards and queries into blocks; a task builds the index of a shard and answers
    a block from it, so its memory doesn't depend on the table's size.
    """
    spark = vectors.sparkSession
    v = cut_lineage(usable(vectors, id_col, vector_col))
    common = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], EMPTY)
    v = v.where(F.size("v") == common["d"])
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    low, high = v.agg(F.min(norm), F.max(norm)).first()
    order = F.xxhash64("vec_id", F.lit(settings.seed))
    sample = v.orderBy(order, "vec_id").limit(settings.sample).select("v").toArrow()
    x = np.array(sample["v"].combine_chunks().flatten()).reshape(-1, common["d"])
    codes = fit(x, 0.0 if high - low <= 1e-4 * high else high, k, settings)
    n = common["n"]
    shards = -(-n // settings.shard)
    asked = cut_lineage(v.where(F.col("vec_id") % every == 0).withColumnsRenamed({"vec_id": "query_id"}))
    found = cut_lineage(search(v, asked, codes, codes.radius, k, shards, settings))
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, n - 1))
    short = cut_lineage(asked.join(enough, "query_id", "left_anti"))
    if not short.isEmpty():
        again = search(v, short, codes, 8 * codes.encode(x[:1]).shape[1], k, shards, settings)
        found = found.join(short.select("query_id"), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def search(v: DataFrame, asked: DataFrame, codes: Codes, radius: int, k: int, shards: int, s: Settings) -> DataFrame:
    blocks = max(1, -(-asked.count() // s.block))
    deal = lambda c, n: F.pmod(F.xxhash64(c, F.lit(s.seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = v.withColumn("shard", deal("vec_id", shards)).withColumn("block", every(blocks))
    right = asked.withColumn("block", deal("query_id", blocks)).withColumn("shard", every(shards))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def matrix(t: pa.Table) -> np.ndarray:
        return t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

    def answer(mine: pa.Table, queries: pa.Table) -> pa.Table:
        if not mine.num_rows or not queries.num_rows:
            return out.empty_table()
        mine = mine.sort_by("vec_id")
        ids, x, q = mine["vec_id"].to_numpy(), matrix(mine), matrix(queries)
        index = MultiIndex(codes.encode(x))
        probes, asked_codes = index.probes(radius), codes.encode(q, True)
        parts = []
        for i, query_id in enumerate(queries["query_id"].to_pylist()):
            rows = index.within(asked_codes[i], radius, probes)
            rows = rows[ids[rows] != query_id]
            score = inner(x[rows], q[i])
            if len(rows) > k:  # ties with the last one stay for the choice by id
                near = score >= np.partition(score, len(score) - k)[len(score) - k]
                rows, score = rows[near], score[near]
            best = np.lexsort((ids[rows], -score))[:k]
            parts.append((np.full(len(best), query_id), ids[rows[best]], score[best]))
        return pa.table([np.concatenate([p[j] for p in parts]) for j in range(3)], schema=out)

    pairs = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(answer, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


@query("op6_nearest_neighbours")
def op6_nearest_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))
