"""Phrase collocations: an FM-index per shard of words counts phrases, shards are summed, and cohesive phrases ranked."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from scholia.llm.common import query, table, tidied, tidied_group
from scholia.session import cut_lineage, release, write_bucketed

CUT = re.compile(rb"[.,;:!?\n-\r]+")
SPLIT = [bytes([c]) for c in b".,;:!?\n\x0b\x0c\r"]
STOP = b"."  # stands between pieces; no word holds it


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; the best ``top`` of each language."""

    longest: int = 5
    least: int = 100
    share: int = 100  # percent of a phrase's occurrences within one longer phrase that make it a mere part
    scale: int = 1000
    top: int = 2000
    shard_words: int = 1_000_000
    window: int = 4_000_000  # bytes of a text that are cut into words at a time


# ---- shards


def windows(text: bytes, size: int, lap: int) -> Iterator[tuple[bytes, bytes]]:
    """Parts of a text, each with the words (``lap`` of them) that the next part repeats.

    Parts end where a piece ends, and then nothing is repeated. Where a piece is longer than ``size`` its part ends between words, and the
    next one starts ``lap`` words before: each phrase is in one of the two parts, or in both and in what is repeated.
    """
    at, n = 0, len(text)
    while at < n:
        end, words = at + size, []
        while end < n:
            piece = max(text.rfind(s, at, end) for s in SPLIT)
            if piece >= 0:
                end = piece + 1
                break
            stop = max(text.rfind(b" ", at, end), text.rfind(b"\t", at, end))
            words = text[at:stop].split() if stop >= 0 else []
            if len(words) > lap:
                end = stop
                break
            words = []
            end += size
        part = text[at : min(end, n)]
        if not words or end >= n:
            yield part, b""
            at = end
            continue
        back = len(part)
        for _ in range(lap):  # to where the last words begin
            kept = part[:back].rstrip(b" \t")
            back = max(kept.rfind(b" "), kept.rfind(b"\t")) + 1
        yield part, part[back:]
        at += back


class Shard:
    """Words of one language as numbers in order of appearance, pieces parted by zero."""

    def __init__(self):
        self.vocab = _Numbers()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = CUT.sub(b" . ", text).split()
        if words:
            self.parts.append(np.fromiter(map(self.vocab.__getitem__, words), np.int32, len(words)))
            self.parts.append(np.zeros(1, np.int32))
            self.size += len(words)

    def row(self, shard: int, lang: str, sign: int) -> dict:
        seq = np.concatenate(self.parts)
        counts = np.bincount(seq, minlength=len(self.vocab))
        words = [w.decode() for w in self.vocab]
        return {"shard": shard, "lang": lang, "sign": sign, "n": int(counts[1:].sum()), "words": words[1:], "counts": counts[1:].tolist(), "seq": seq.tobytes()}


class _Numbers(dict):
    def __init__(self):
        super().__init__({STOP: 0})

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


SHARDS = "shard bigint, lang string, sign int, n bigint, words array<string>, counts array<int>, seq binary"
SHARD_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), ("sign", pa.int32()), ("n", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("seq", pa.binary()),
])


def shards(docs: DataFrame, s: Settings) -> DataFrame:
    """Each task cuts its documents (``lang, text``) into shards of one language and of bounded size. What two parts of a
    long text both hold is a shard whose counts are subtracted."""

    def run(batches: Iterator[pa.RecordBatch]):
        first = TaskContext.get().partitionId() << 32
        made = 0
        open_: dict[tuple[str, int], Shard] = {}

        def closed(key: tuple[str, int]):
            nonlocal made
            made += 1
            return pa.RecordBatch.from_pylist([open_.pop(key).row(first + made, *key)], schema=SHARD_SCHEMA)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                for part, lap in windows(text.as_py().encode().lower(), s.window, s.longest - 1):
                    for sign, words in ((1, part), (-1, lap)):
                        if words:
                            open_.setdefault((lang, sign), Shard()).add(words)
                    while open_ and sum(x.size for x in open_.values()) >= s.shard_words:
                        yield closed(max(open_, key=lambda k: open_[k].size))
        for key in list(open_):
            if open_[key].parts:
                yield closed(key)

    return docs.mapInArrow(tidied(run), SHARDS)


# ---- the index of a shard


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``t`` (read as a ring) in the order of the next ``depth`` numbers."""
    _, rank = np.unique(t, return_inverse=True)
    single, span = rank.astype(np.int64), 1
    rank = single
    while span < depth:
        step = min(span, depth - span)
        other = rank if step == span else single
        if step not in (1, span):  # an exact depth: add one number at a time
            other, step = single, 1
        _, rank = np.unique(rank * len(t) + np.roll(other, -span), return_inverse=True)
        span += step
    return np.argsort(rank, kind="stable")


def transform(t: np.ndarray, depth: int) -> np.ndarray:
    """What stands before each place, in the order of the places' next ``depth`` numbers."""
    return t[suffix_order(t, depth) - 1]


def step_before(bwt: np.ndarray) -> np.ndarray:
    """For each row the row of the place before it: rows with one number before them keep their order."""
    to = np.empty(len(bwt), np.int64)
    to[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return to


def spans(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of intervals, one interval after the other, and the interval of each."""
    owner = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + lo[owner], owner


def extend(bwt: np.ndarray, lo: np.ndarray, other: np.ndarray, size: np.ndarray):
    """All extensions, by one word at the end that ``bwt`` tells, of the phrases whose rows are ``[lo, lo + size)`` here and begin
    at ``other`` in the index of the other direction: ``phrase, word, lo, other, size``.

    An extension is kept if it is one of the given phrases again when its word at the far end is left out. In
    the other index the phrase's rows are in order of the word that comes next, so its extensions divide them.
    """
    to = step_before(bwt)
    live = np.zeros(len(bwt), bool)
    live[spans(lo, size)[0]] = True
    rows, owner = spans(lo, size)
    words = bwt[rows].astype(np.int64)
    by = np.argsort(owner * (int(bwt.max(initial=0)) + 1) + words, kind="stable")
    words, owner, rows = words[by], owner[by], rows[by]
    new = np.r_[True, (np.diff(words) != 0) | (np.diff(owner) != 0)] if len(rows) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(rows)])
    # Rows of an interval stay together in the order, so what comes before in it is the distance to its start.
    start = (np.cumsum(size) - size)[owner[first]]
    at = to[rows[first]]
    kept = (words[first] != 0) & live[at]
    return owner[first][kept], words[first][kept], at[kept], (other[owner[first]] + first - start)[kept], count[kept]


# ---- levels

INDEX = "shard bigint, sign int, ids binary, fwd binary, rev binary"
FOUND = "shard bigint, parent bigint, word bigint, n bigint, lo int, other int, size int"
FOUND_SCHEMA = pa.schema([*((c, pa.int64()) for c in ("shard", "parent", "word", "n")), *((c, pa.int32()) for c in ("lo", "other", "size"))])


def indexing(depth: int):
    return lambda shard, live: indexed(shard, live, depth)


def indexed(shard: pa.Table, live: pa.Table, depth: int) -> pa.Table:
    """The two transforms of a shard's frequent words; ``ids`` has their numbers in the corpus."""
    schema = pa.schema([("shard", pa.int64()), ("sign", pa.int32()), ("ids", pa.binary()), ("fwd", pa.binary()), ("rev", pa.binary())])
    if not live.num_rows or not shard.num_rows:
        return schema.empty_table()
    local, ids = live.column("local").to_numpy(), live.column("id").to_numpy()
    number = np.zeros(int(local.max()) + 1, np.int32)
    number[local] = np.arange(1, len(local) + 1)
    t = np.frombuffer(shard.column("seq")[0].as_buffer(), np.int32)
    t = np.where(t < len(number), number[np.minimum(t, len(number) - 1)], 0)
    t = np.r_[0, t[(t != 0) | np.r_[False, t[:-1] != 0]]].astype(np.int32)  # one zero is enough
    return pa.table({
        "shard": shard.column("shard").combine_chunks(), "sign": shard.column("sign").combine_chunks(), "ids": pa.array([ids.tobytes()], pa.binary()),
        "fwd": pa.array([transform(t, depth).tobytes()], pa.binary()), "rev": pa.array([transform(t[::-1], depth).tobytes()], pa.binary()),
    }, schema=schema)


def found_table(shard: int, sign: int, ids, parents, out, backwards: bool) -> pa.RecordBatch:
    phrase, word, at, other, count = out
    lo, other = (at, other) if backwards else (other, at)
    columns = [np.full(len(at), shard), parents[phrase], ids[word - 1], count * sign, lo, other, count]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type, safe=False) for c, f in zip(columns, FOUND_SCHEMA, strict=True)], schema=FOUND_SCHEMA)


def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of two words: every word is extended by the one after it."""
    for batch in batches:
        for shard, sign, ids, rev in zip(batch["shard"].to_pylist(), batch["sign"].to_pylist(), batch["ids"], batch["rev"], strict=True):
            ids, rev = np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(rev.as_buffer(), np.int32)
            size = np.bincount(rev, minlength=len(ids) + 1)
            lo = (np.cumsum(size) - size)[1:]  # words in order are intervals of the index, the same in both directions
            yield found_table(shard, sign, ids, ids, extend(rev, lo, lo, size[1:]), False)


def lengthening(backwards: bool):
    return lambda index, live: longer(index, live, backwards)


def longer(index: pa.Table, live: pa.Table, backwards: bool) -> pa.Table:
    """The phrases of a shard one word longer, out of its frequent ones."""
    if not live.num_rows or not index.num_rows:
        return FOUND_SCHEMA.empty_table()
    ids = np.frombuffer(index.column("ids")[0].as_buffer(), np.int64)
    bwt = np.frombuffer(index.column("fwd" if backwards else "rev")[0].as_buffer(), np.int32)
    lo, other = live.column("lo").to_numpy().astype(np.int64), live.column("other").to_numpy().astype(np.int64)
    if not backwards:
        lo, other = other, lo
    order = np.argsort(lo, kind="stable")
    lo, other, size, parents = lo[order], other[order], live.column("size").to_numpy().astype(np.int64)[order], live.column("id").to_numpy()[order]
    out = extend(bwt, lo, other, size)
    return pa.Table.from_batches([found_table(index.column("shard")[0].as_py(), index.column("sign")[0].as_py(), ids, parents, out, backwards)])


def frequent(counts: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Sums of ``n`` by ``keys`` that reach ``least``, each with a number of its own."""
    sums = counts.groupBy(*keys).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    sums = cut_lineage(sums)
    numbered = cut_lineage(sums.withColumn("id", F.monotonically_increasing_id()))
    release(sums)
    return numbered


def phrase_counts(docs: DataFrame, s: Settings = Settings(), text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``lang, words, f`` of every phrase of up to ``longest`` words that occurs ``least`` times, and ``lang, n`` with all words.

    Shards are counted apart: the index of a shard yields its words' two-word phrases, and a round for each
    further word extends those phrases whose sums over all shards are large enough, forwards and backwards in turn. Only phrases
    both of whose parts are frequent are counted, so nothing frequent is missed. Sums and the numbers of frequent phrases
    are shuffled; shards stay where they were written.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    buckets = max(1, min(100_000, texts.rdd.getNumPartitions()))
    cut, name = write_bucketed(shards(texts, s), buckets, "shard")
    held, index = [name], None
    totals = cut_lineage(cut.groupBy("lang").agg(F.sum(F.col("n") * F.col("sign")).alias("n")))
    own = spark.table(name).select(F.col("shard").alias("shard"), "lang", "sign", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "x"))
    own = own.select("shard", "lang", F.col("x.words").alias("word"), (F.col("x.counts").cast("bigint") * F.col("sign")).alias("n"), (F.col("i") + 1).alias("local"))
    words = frequent(own, ["lang", "word"], s.least)
    phrases = words.select("lang", F.array("word").alias("words"), "f", "id")
    done, made = [phrases.drop("id")], []
    names = words.select(F.col("id").alias("word"), F.col("word").alias("name"))
    if s.longest > 1:
        live = own.select("shard", "lang", "word", "local").join(words.select("lang", "word", "id"), ["lang", "word"]).select("shard", "local", "id")
        index = cut.select("shard", "sign", "seq").groupBy("shard").cogroup(live.groupBy("shard"))
        index, name = write_bucketed(index.applyInArrow(tidied_group(indexing(s.longest)), INDEX), buckets, "shard")
        held.append(name)
        found = cut_lineage(index.select("shard", "sign", "ids", "rev").mapInArrow(tidied(pairs_of), FOUND))
        for k in range(2, s.longest + 1):
            sums = frequent(found, ["parent", "word"], s.least)
            grown = phrases.select(F.col("id").alias("parent"), "lang", "words").join(sums, "parent").join(names, "word")
            after = F.concat("words", F.array("name")) if k % 2 == 0 else F.concat(F.array("name"), "words")
            phrases = cut_lineage(grown.select("lang", after.alias("words"), "f", "id"))
            done.append(phrases.drop("id"))
            made.append(phrases)
            if k == s.longest:
                release(found, sums)
                break
            live = found.join(sums.select("parent", "word", "id"), ["parent", "word"]).select("shard", "lo", "other", "size", "id")
            backwards = k % 2 == 0
            side = index.select("shard", "sign", "ids", "fwd" if backwards else "rev")
            step = side.groupBy("shard").cogroup(live.groupBy("shard"))
            old, found = found, cut_lineage(step.applyInArrow(tidied_group(lengthening(backwards)), FOUND))
            release(old, sums)  # counts of pairs in shards are what takes most of the disk
    out = done[0]
    for level in done[1:]:
        out = out.unionByName(level)
    out = cut_lineage(out)
    release(words, *made)
    for name in held:
        spark.sql(f"DROP TABLE {name}")
    release(cut, *([] if index is None else [index]))
    return out, totals


def collocations(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words. A
    phrase of 2 to ``longest`` words with ``a >= least`` occurrences scores the least of ``floor(scale * a * n / (l * r))`` over its cuts in
    two, with ``l`` and ``r`` occurrences of the parts and ``n`` words in the language; ties go to the earliest cut. Phrases that a longer
    one contains, with ``share`` percent of their occurrences, are left out. The order is by score and ``a``, falling, then by
    the phrase. A null language is ``und``, a null text empty; repeated rows count each; ids aren't read; an
    empty table gives no rows. Arithmetic is in whole numbers of 38 digits.
    """
    s = settings
    counted, totals = phrase_counts(docs, s, text_col, lang_col)
    counts = counted.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    several = counted.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    # A phrase within a longer one is within one that is longer by one word, which occurs as often or more.
    ends = F.array(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1))
    parts = several.where(F.size("words") > 2).select("lang", F.explode(ends).alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("most"))
    kept = several.join(parts, ["lang", "words"], "left").where(F.col("most").isNull() | (100 * F.col("most") < s.share * F.col("a"))).drop("most")
    cuts = kept.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("right"),
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    # The quotient of whole decimals, floored exactly.
    score = F.expr(f"cast({s.scale} * a as decimal(19,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, piece, list_filter(regexp_split_to_array(piece_text, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, lang, unnest(p) AS piece_text, unnest(range(len(p))) AS piece FROM (
    SELECT doc_id, lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents))
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k))
), counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
split AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
inner_ AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
      SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM split, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)) GROUP BY ALL
), cuts AS (
  SELECT s.lang, s.phrase, s.f AS a, c AS cut, l.f AS l, r.f AS r, n, ((1000::HUGEINT * s.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM split) s
  JOIN counts l ON l.lang = s.lang AND l.phrase = array_to_string(s.w[1:c], ' ')
  JOIN counts r ON r.lang = s.lang AND r.phrase = array_to_string(s.w[c + 1:], ' ')
  JOIN totals t ON t.lang = s.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN inner_ USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a
QUALIFY rank <= 2000
"""


@query("op13_collocations", SQL)
def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
