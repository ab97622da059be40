"""Set similarity join of documents by their word shingles, with groups of linked documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from scholia.llm.common import id_and_text, light_side, query, table, tidied
from scholia.llm.graph import components
from scholia.session import cut_lineage, release

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]
BLOCK_SHINGLES = 2_000_000  # shingles that a task holds of one family at a time


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-word shingles link when ``intersection / union >= num / den``.

    Shingles are ordered by their hash. Of a pair of sizes ``a >= b`` that links, each set has at most
    ``size - least(a)`` shingles that the other lacks. So of their common shingles the first
    ``margin(b)`` lie within the first ``size - least(size) + margin(size)`` shingles of either set: its
    prefix. Of those ``margin(least(size))`` or more, a set may ignore all but one, and it ignores the
    most frequent ones. What is left still has one shingle in common.
    """

    words: int = 3
    num: int = 9
    den: int = 10

    def least(self, size):
        return -(-size * self.num // self.den)

    def margin(self, size):
        return -(-size // 10)

    def prefix(self, size):
        return np.minimum(size, size - self.least(size) + self.margin(size))


class Words(dict):
    """Hash of a word, remembered; emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, words: int, known: Words) -> np.ndarray:
    """The sorted hashes (as signed numbers) of the distinct shingles; a shorter text is one shingle, an empty one none."""
    # bytes.lower changes A-Z alone, bytes.split cuts at the six ASCII white-space characters.
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.int64)
    h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    k = min(words, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        s = (s ^ h[i : len(h) - k + 1 + i]) * MIX[i % 2]
        s ^= s >> np.uint64(31)
    s *= MIX[2]
    s ^= s >> np.uint64(29)
    return np.unique(s.view(np.int64))


def digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that a task holds the sets of few texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def set_heads(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n, d1, d2, prefix`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]):
        known = Words()
        for batch in slices(batches):
            sets = [shingles(t.as_py(), rule.words, known) for t in batch["text"]]
            marks = [digest(s) for s in sets]
            heads = [s[: int(rule.prefix(len(s)))] for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
                pa.array([m[1] for m in marks], pa.int64()), pa.array(heads, pa.list_(pa.int64())),
            ], names=["doc_id", "n", "d1", "d2", "prefix"])

    return docs.mapInArrow(tidied(run), "doc_id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>")


def shared(posts: DataFrame, rule: Rule, ignore: bool) -> DataFrame:
    """The shingles (``row, n, s``) of ``posts`` that several sets have.

    Sets with fewer of them than any partner must share drop out. With ``ignore`` each set also leaves
    out its most frequent ones, as many as it may; that can be done once only.
    """
    df = cut_lineage(posts.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"))
    must = F.ceil(F.ceil(F.col("n") * rule.num / rule.den) / 10).cast("int")
    met = posts.join(df, "s").groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("own"))
    met = met.where(F.size("own") >= must)
    left = F.slice("own", F.lit(1), F.size("own") - must + 1) if ignore else F.col("own")
    kept = cut_lineage(met.select("row", "n", F.explode(left).alias("x")).select("row", "n", F.col("x.s").alias("s")))
    release(df)
    return kept


def block_links(sets: list[np.ndarray], rule: Rule, probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever is linked among ``sets`` (sorted, each without repeats).

    The index has a list of sets for each shingle. Sets are numbered by size, so a list's part within the
    sizes that can link is one slice, and within a set's prefix the lists are cut in blocks of positions:
    blocks beyond the position up to which enough can still be shared are skipped. A set that differs in
    few shingles from the set answered before takes over that set's overlaps, less the lists of the
    shingles it lacks, plus those of the ones it has more; so a run of similar sets is answered by
    differences. ``probes`` marks the sets to be answered (all by default).
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0, i))
    size = np.array([len(sets[i]) for i in order])
    n = len(order)
    if n < 2:
        return []
    all_s = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(n), size)
    ids, token = np.unique(all_s, return_inverse=True)
    at = np.argsort(token, kind="stable")  # lists by shingle, each by the number of the set, so by size
    lists = owner[at]
    ends = np.searchsorted(token[at], np.arange(len(ids) + 1))
    starts_of_set = np.concatenate([[0], np.cumsum(size)])
    tokens = [token[starts_of_set[k] : starts_of_set[k + 1]] for k in range(n)]
    index = PositionIndex(tokens, size, rule) if n > 64 else None

    def counts(toks: np.ndarray) -> np.ndarray:
        """How often each set is in the lists of ``toks``."""
        lo, hi = ends[toks], ends[toks + 1]
        long = hi - lo
        total = int(long.sum())
        if not total:
            return np.zeros(n, np.int64)
        pick = np.arange(total) + np.repeat(lo - np.concatenate([[0], np.cumsum(long)[:-1]]), long)
        return np.bincount(lists[pick], minlength=n)

    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, last, overlaps = [], -1, None
    for k in range(n):
        if probes is not None and not probes[order[k]]:
            continue
        if index is not None and not index.may_meet(k):
            continue
        mine = tokens[k]
        if last >= 0:
            more = np.setdiff1d(mine, tokens[last], assume_unique=True)
            less = np.setdiff1d(tokens[last], mine, assume_unique=True)
        if last >= 0 and len(more) + len(less) < len(mine) // 2:
            overlaps = overlaps + counts(more) - counts(less)
        else:
            overlaps = counts(mine)
        last = k
        hit = np.flatnonzero(rule.den * overlaps >= rule.num * (size + size[k] - overlaps))
        for j in hit[hit != k]:
            a, b = root(k), root(int(j))
            if a != b:
                parent[a] = b
                links.append((order[k], order[int(j)]))
    return links


class PositionIndex:
    """Lists of the prefix shingles in blocks of positions; tells whether a set can meet any other one."""

    STEP = 8

    def __init__(self, tokens: list[np.ndarray], size: np.ndarray, rule: Rule):
        self.tokens, self.size, self.rule = tokens, size, rule
        self.heads = [t[: int(n - rule.least(n) + 1)] for t, n in zip(tokens, size, strict=True)]
        toks = np.concatenate(self.heads)
        sets = np.repeat(np.arange(len(tokens)), [len(h) for h in self.heads])
        block = np.concatenate([np.arange(len(h)) // self.STEP for h in self.heads])
        by = np.lexsort((sets, block, toks))
        self.toks, self.sets, self.block = toks[by], sets[by], block[by]

    def may_meet(self, k: int) -> bool:
        n, rule, size = int(self.size[k]), self.rule, self.size
        lo, hi = np.searchsorted(self.toks, self.heads[k]), np.searchsorted(self.toks, self.heads[k], side="right")
        smallest = int(rule.least(n))
        for i, (a, b) in enumerate(zip(lo, hi, strict=True)):
            # With the first common shingle at positions i and j, a partner of the same size or larger
            # still shares least(size) only if j leaves it enough: later blocks of the list are skipped.
            sets, block = self.sets[a:b], self.block[a:b]
            reach = size[sets] - rule.least(np.maximum(size[sets], n))
            near = (sets != k) & (size[sets] >= smallest) & (rule.least(size[sets]) <= n) & (block * self.STEP <= reach) & (i <= n - rule.least(np.maximum(size[sets], n)))
            if near.any():
                return True
        return False


def linked(met: DataFrame, rule: Rule, probing: bool) -> DataFrame:
    """Links (``a, b``) within each group of rows ``part, row, s, probe``; groups are read one after the other."""

    def run(batches: Iterator[pa.RecordBatch]):
        now, rows, sets, probe = None, [], [], []

        def answered():
            if len(rows) > 1:
                out = block_links(sets, rule, np.array(probe) if probing else None)
                if out:
                    a, b = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([rows[i] for i in a], pa.int64()), pa.array([rows[i] for i in b], pa.int64())], names=["a", "b"])

        for batch in batches:
            for part, row, s, p in zip(batch["part"].to_pylist(), batch["row"].to_pylist(), batch["s"], batch["probe"].to_pylist(), strict=True):
                if part != now:
                    yield from answered()
                    now, rows, sets, probe = part, [], [], []
                if rows and rows[-1] == row:  # one set from repeated rows, or a probe that is in the block itself
                    probe[-1] |= p
                    continue
                rows.append(row)
                sets.append(np.frombuffer(s.as_buffer(), np.int64))
                probe.append(p)
        yield from answered()

    dealt = met.select("part", "row", "s", "probe").repartition("part").sortWithinPartitions("part", "row")
    return dealt.mapInArrow(tidied(run), "a bigint, b bigint")


PLACE = ["row", "family", "block", "several"]


def in_blocks(own: DataFrame, rule: Rule) -> DataFrame:
    """``own`` with ``block`` and ``several``, whether its family has several blocks.

    A family of bounded size is one block. A larger one is cut by the sizes of its sets, each class reaching from a size to the largest
    that can link with it, so what links lies in one class or in two neighbouring ones; a class of any size is dealt out over blocks.
    """
    large = cut_lineage(own.groupBy("family").agg((F.sum("n") > BLOCK_SHINGLES).alias("several")).where("several"))
    kind = F.floor(F.log(F.col("n").cast("double")) / float(np.log(rule.den / rule.num))).cast("bigint")
    placed = own.join(large, "family", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    placed = placed.withColumn("kind", F.when(F.col("several"), kind).otherwise(F.lit(0).cast("bigint")))
    cuts = placed.where("several").groupBy("family", "kind").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("cuts"))
    placed = placed.join(cut_lineage(cuts), ["family", "kind"], "left")
    return placed.withColumn("block", F.col("kind") * (1 << 32) + F.pmod(F.xxhash64("row"), F.coalesce("cuts", F.lit(1)))).drop("kind", "cuts")


def family_sets(docs: DataFrame, alive: DataFrame, rule: Rule) -> DataFrame:
    """``row, family, block, several, n, s`` with the whole set (packed) of each row of ``alive``, cut from the texts again."""

    def run(batches: Iterator[pa.RecordBatch]):
        known = Words()
        for batch in slices(batches):
            sets = [shingles(t.as_py(), rule.words, known) for t in batch["text"]]
            marks = [digest(s) for s in sets]
            same = [m == (a, b) for m, a, b in zip(marks, batch["d1"].to_pylist(), batch["d2"].to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([
                *(batch[c] for c in PLACE), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
            ], names=[*PLACE, "n", "s"])
            yield out.filter(pa.array(same, pa.bool_()))

    names = alive.withColumnRenamed("doc_id", "own_id")
    met = docs.join(names, F.col("doc_id").eqNullSafe(F.col("own_id"))).select(*PLACE, "d1", "d2", "text")
    return met.mapInArrow(tidied(run), "row bigint, family bigint, block bigint, several boolean, n bigint, s binary")


def jaccard_groups(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when the Jaccard similarity of their shingle sets reaches the rule's; a group is
    what links connect, named by its smallest id. Null and empty texts have an empty set, link with
    nothing and are their own group. Rows that share an id are one document: all are in one group. A row
    without an id gets its group's smallest id, null if there is none. An empty table gives no rows;
    other columns aren't read. Shingles are compared by 64-bit hashes, whole sets by 128 bits.

    1. Rows with equal sets are folded into one.
    2. Shingles in the prefixes of the sets are counted and sent back; sets that can meet no other one
       drop out, twice (``shared``). Every pair that links keeps a common shingle.
    3. Sets joined by kept shingles are a family. The whole sets of a family are compared in blocks of
       bounded size, a task each (``block_links``). In a family of several blocks some sets of its largest groups are
       then compared with the blocks that hold sets of their size, which links groups across blocks; at last
       all that is still not in the family's largest group is. So nothing is compared twice within a group that is already known.
    """
    docs = id_and_text(docs, id_col, text_col)
    heads = cut_lineage(set_heads(docs, rule).withColumn("row", F.monotonically_increasing_id()))
    folds = cut_lineage(heads.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("row")))
    first = cut_lineage(heads.join(folds.select("row"), "row").select("row", "n", "prefix"))
    met = shared(first.select("row", "n", F.explode("prefix").alias("s")), rule, ignore=False)
    posts = shared(met, rule, ignore=True)

    # Families: each kept shingle joins its sets to the first of them.
    least = cut_lineage(posts.groupBy("s").agg(F.min("row").alias("a"), F.count("*").alias("k")).where("k > 1").select("s", "a"))
    kin = components(posts.join(least, "s").select("a", F.col("row").alias("b")))
    own = heads.select("row", "doc_id", "n", "d1", "d2").join(kin.withColumnRenamed("node", "row"), "row").withColumnRenamed("label", "family")
    own = cut_lineage(own)
    release(first, met, posts, least, kin)
    alive, _ = light_side(in_blocks(own, rule).drop("n"))
    sets = cut_lineage(family_sets(docs, alive, rule))
    inside = cut_lineage(linked(sets.select(F.xxhash64("family", "block").alias("part"), "row", "s", F.lit(False).alias("probe")), rule, False))
    large = sets.where("several")
    links = inside
    if not large.isEmpty():
        near = cut_lineage(across(large, inside, rule, leading))
        links = inside.union(near)
        links = links.union(cut_lineage(across(large, links, rule, straying)))
    release(sets, own)
    groups = components(links)

    # Every row takes its set's group, and groups that share a document are one.
    rows = heads.select("row", "doc_id", "n", "d1", "d2").join(folds.withColumnRenamed("row", "fold"), ["d1", "d2"], "left")
    rows = rows.join(groups.withColumnRenamed("node", "fold"), "fold", "left")
    rows = cut_lineage(rows.select("row", "doc_id", "n", F.coalesce("label", "fold", "row").alias("grp")))
    release(heads, folds, groups)
    twice = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("grp").alias("a"), F.max("grp").alias("z")).where("a <> z")
    twice = cut_lineage(twice)
    if not twice.isEmpty():
        kin = components(rows.join(twice, "doc_id").select("a", F.col("grp").alias("b")))
        rows = rows.join(kin.withColumnRenamed("node", "grp"), "grp", "left").select("row", "doc_id", "n", F.coalesce("label", "grp").alias("grp"))
        rows = cut_lineage(rows)
    named = cut_lineage(rows.groupBy("grp").agg(F.min("doc_id").alias("component_id")))
    return rows.join(named, "grp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


LEADERS = 4  # sets of a group that stand for it


def leading(names: DataFrame) -> DataFrame:
    """Some sets of a family's largest groups, a block's worth of shingles a family."""
    w = Window.partitionBy("family", "grp").orderBy(F.xxhash64("row"), "row")
    first = names.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= LEADERS)
    sizes = names.groupBy("family", "grp").agg(F.count("*").alias("k")).where("k > 1")
    largest = sizes.withColumn("place", F.row_number().over(Window.partitionBy("family").orderBy(F.desc("k"), "grp"))).where(F.col("place") <= 10_000)
    first = first.join(largest, ["family", "grp"])
    sofar = F.sum("n").over(Window.partitionBy("family").orderBy("nth", "place"))
    return first.withColumn("sofar", sofar).where(F.col("sofar") <= BLOCK_SHINGLES).select("family", "row", "n")


def straying(names: DataFrame) -> DataFrame:
    """All sets outside the largest group of their family."""
    sizes = names.groupBy("family", "grp").agg(F.count("*").alias("k"))
    main = sizes.withColumn("nth", F.row_number().over(Window.partitionBy("family").orderBy(F.desc("k"), "grp"))).where("nth = 1")
    main = cut_lineage(main.select("family", F.col("grp").alias("main")))
    return names.join(main, "family").where("grp <> main").select("family", "row", "n")


def across(large: DataFrame, links: DataFrame, rule: Rule, chosen) -> DataFrame:
    """Links of some sets (``chosen`` from ``family, row, n, grp``) with the other blocks of their families."""
    groups = components(links)
    names = large.select("family", "block", "row", "n").join(groups.withColumnRenamed("node", "row"), "row", "left")
    names = cut_lineage(names.select("family", "block", "row", "n", F.coalesce("label", "row").alias("grp")))
    # A set goes to the blocks that hold sets of a size it can link with: a short list a family.
    spans = names.groupBy("family", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    spans = cut_lineage(spans.groupBy("family").agg(F.collect_list(F.struct("block", "low", "high")).alias("spans")))
    aims = chosen(names).join(F.broadcast(spans), "family")
    met = F.filter("spans", lambda x: (x["high"] * rule.den >= F.col("n") * rule.num) & (x["low"] * rule.num <= F.col("n") * rule.den))
    aims = cut_lineage(aims.select("family", "row", "n", F.explode(F.transform(met, lambda x: x["block"])).alias("block")))
    # Sets that come to a block come in lots of bounded size, and a block is sent to its own lots only.
    lots = aims.groupBy("family", "block").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("lots"))
    lots = F.broadcast(cut_lineage(lots))
    probes = large.select("row", "s").join(aims.join(lots, ["family", "block"]), "row")
    probes = probes.select("family", "block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("lots")).alias("lot"), "row", "s", F.lit(True).alias("probe"))
    held = large.select("family", "block", "row", "s").join(lots, ["family", "block"])
    held = held.select("family", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lots") - 1)).alias("lot"), "row", "s", F.lit(False).alias("probe"))
    return linked(probes.unionByName(held).select(F.xxhash64("family", "block", "lot").alias("part"), "row", "s", "probe"), rule, True)


def one_of_each_group(docs: DataFrame, rule: Rule = Rule(5, 8, 10), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose id is their group's; rows without an id stay."""
    groups = jaccard_groups(docs, rule, id_col, text_col)
    gone, _ = light_side(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")


@query("op2_ngram_jaccard_join")
def op2_ngram_jaccard_join(spark, sf_dir):
    return jaccard_groups(table(spark, sf_dir, "documents"))
