"""Toxicity: logistic regression over hashed word n-grams and skip-grams, learnt by FTRL-proximal."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from scholia.llm.common import id_and_text, query, table, tidied

WORD = re.compile(r"[^\W_]+")
STEMS = (4, 5, 6, 7)  # letters of the beginnings
BITS = 20  # features are hashed into 2**BITS weights
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@dataclass(frozen=True)
class Settings:
    """FTRL-proximal: per-coordinate rate ``alpha / (beta + sqrt(sum of squared gradients))``, penalties, passes."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 10.0  # above what the passes over one document can add up to, so none is learnt by heart
    l2: float = 0.1
    passes: int = 4
    rows: int = 20_000  # labelled rows learnt from, at most; chosen by a hash of the id
    seed: int = 7


class Words(dict):
    """The number of a word, and by number the hashes of the word and of its first letters.

    Beginnings stand for the word's forms: a text may hold a form that no labelled text had. Forgets
    everything when it has grown large.
    """

    KEEP = 200_000

    def __init__(self):
        super().__init__()
        self.hashes = np.zeros((1024, 1 + len(STEMS)), np.uint64)

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        if i >= len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        self.hashes[i, 0] = xxhash.xxh64_intdigest(word)
        for j, k in enumerate(STEMS, 1):  # a shorter word has no such beginning
            self.hashes[i, j] = xxhash.xxh64_intdigest(word[:k], seed=k) if len(word) >= k else 0
        return i


def features(text: str, words: Words) -> np.ndarray:
    """Buckets of the words and their beginnings, the pairs of neighbours and the pairs with one word
    between; repeats kept."""
    found = WORD.findall(text.lower())
    if not found:
        return np.empty(0, np.int64)
    if len(words) > words.KEEP:
        words.clear()
    number = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    h = words.hashes[number, 0]
    stems = words.hashes[np.unique(number), 1:].ravel()
    grams = [h * MIX[0], stems[stems != 0] * MIX[1]]
    for gap in (1, 2):
        if len(h) > gap:
            grams.append((h[:-gap] * MIX[gap]) ^ ((h[gap:] + np.uint64(gap)) * MIX[0]))
    return (np.concatenate(grams) * MIX[2] >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, float]], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the weights that aren't zero; the last bucket is the constant."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        l1 = np.where(i == size - 1, 0.0, s.l1)
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2))

    order = np.random.default_rng(s.seed)
    for _ in range(s.passes):
        for k in order.permutation(len(rows)):
            i, label = rows[k]
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / s.alpha * w
            n[i] = grown
    w = weights(np.arange(size))
    kept = np.flatnonzero(w)
    return kept, w[kept]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col="doc_id", text_col="text", label_id="doc_id", label_col="toxic") -> list[tuple[int, float]]:
    """The sparse model ``[(bucket, weight)]``, at most 2**20 + 1 rows.

    Learns from labelled rows outside the held-out fifth, ``settings.rows`` of them at most, the same
    ones in every run. Null labels and ids aren't used; without labels the model is empty.
    """
    own = labels.select(labels[label_id].alias("doc_id"), labels[label_col].cast("double").alias("label"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id", F.lit(settings.seed))
    chosen = own.orderBy(order, "doc_id", "label").limit(settings.rows)  # bounded, so it can be sent to every executor
    met = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

    def extract(batches: Iterator[pa.RecordBatch]):
        words = Words()
        for b in batches:
            sets = [np.unique(features(t.as_py(), words)).astype(np.int32) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["label"], pa.array(sets, pa.list_(pa.int32()))], names=["doc_id", "label", "buckets"])

    def learn(batches: Iterator[pa.RecordBatch]):
        rows = []
        for b in batches:
            for d, label, buckets in zip(b["doc_id"].to_pylist(), b["label"].to_pylist(), b["buckets"], strict=True):
                rows.append((d, label, np.append(buckets.values.to_numpy(), np.int32(1 << BITS))))
        rows.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r[0], r[1], len(r[2])))
        i, w = ftrl([(x, y) for _, y, x in rows], settings) if rows else (np.empty(0, np.int64), np.empty(0))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(w, pa.float64())], names=["bucket", "weight"])

    sets = met.mapInArrow(tidied(extract), "doc_id bigint, label double, buckets array<int>")
    model = sets.repartition(1).mapInArrow(learn, "bucket bigint, weight double")
    return [(r.bucket, r.weight) for r in model.collect()]


def score_text(text: str, table_: np.ndarray, words: Words) -> float:
    i = features(text, words)
    i = np.unique(i[table_[i] != 0])
    return float(1 / (1 + np.exp(-np.clip(table_[i].sum() + table_[-1], -35, 35))))


def model_table(model: list[tuple[int, float]]) -> np.ndarray:
    t = np.zeros((1 << BITS) + 1)
    for bucket, weight in model:
        t[bucket] = weight
    return t


def score(docs: DataFrame, model: list[tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, from its whole text alone.

    A null text is empty; an empty text gets the model's constant; an empty model scores 0.5. Ids may
    be null (never held out) or repeat; an empty table gives no rows; other columns aren't read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        weights, words = model_table(sent.value), Words()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([score_text(t.as_py(), weights, words) for t in b["text"]], pa.float64())], names=["doc_id", "score"])

    scored = id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: list[tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores under one half, all columns, in one pass without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]):
        weights, words = model_table(sent.value), Words()
        for b in batches:
            kept = pa.array([score_text(t.as_py() or "", weights, words) < 0.5 for t in b.column(at)], pa.bool_())
            yield b.filter(kept)

    return docs.mapInArrow(tidied(run), schema)


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
