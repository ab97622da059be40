"""Similarity join, exact dedup, line dedup, components, against brute force."""

import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholia.llm import exact_dedup, jaccard, line_dedup
from scholia.llm.graph import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows, extra="h string, row int, norm string, family string, s int"):
    """Documents with further columns whose names clash with those used inside."""
    names = [x.split()[0] for x in extra.split(", ")]
    return spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string").select("*", *[F.lit(None).cast(x.split()[1]).alias(n) for n, x in zip(names, extra.split(", "))])


def brute_sets(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(rows, k, num, den):
    sets = [brute_sets(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if (sets[i] and sets[j] and den * inter >= num * (len(sets[i]) + len(sets[j]) - inter)) or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def families(seed, n_base=12, copies=10, edits=12):
    """Texts whose similarities lie on both sides of the thresholds, with passages that many share."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(30)]
    texts = []
    for _ in range(n_base):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 20, 60, 150, 300]))]
        if rng.random() < 0.6:
            base += passage
        for _ in range(rng.randrange(1, copies)):
            t = list(base)
            for _ in range(rng.randrange(0, edits) * len(base) // 150 + rng.randrange(2)):
                p = rng.randrange(len(t))
                t[p : p + 1] = rng.choice([[], [rng.choice(vocab)], [t[p].upper(), rng.choice(vocab)]])
            texts.append(rng.choice([" ", "\n", "\t "]).join(t))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("rule", [jaccard.Rule(), jaccard.Rule(5, 8, 10), jaccard.Rule(2, 7, 10)])
@pytest.mark.parametrize("block", [2_000_000, 900])
def test_groups_equal_brute_force(spark, monkeypatch, rule, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    rows = list(enumerate(families(3 + rule.words)))
    rows += [(1000, ""), (1001, None), (None, rows[0][1]), (1002, "a b"), (1003, "A\tb"), (1004, " \n"), (5, rows[9][1]), (7, rows[7][1]), (None, "quite alone here")]
    got = [tuple(r) for r in jaccard.jaccard_groups(table(spark, rows), rule).collect()]
    assert sorted(got, key=repr) == brute_groups(rows, rule.words, rule.num, rule.den)


def test_family_of_many_blocks_moves_little(spark, monkeypatch):
    """Near copies in many blocks: groups meet through some of their sets, not all of them in every block."""
    rng = random.Random(5)
    base = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(120):
        t = list(base)
        t[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(t)))
    moved, linked = [], jaccard.linked
    monkeypatch.setattr(jaccard, "linked", lambda met, *a: moved.append(met.count()) or linked(met, *a))
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2000)
    got = [tuple(r) for r in jaccard.jaccard_groups(table(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute_groups(rows, 3, 9, 10)
    assert len(moved) == 3 and sum(moved) < 5 * len(rows)  # each set in its block, each block with some sets, and what is left


def test_staged_tables_leave_no_shuffle_files(spark):
    from scholia.session import cut_lineage, release

    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    files = lambda: {p.name for p in local.rglob("shuffle_*.data")}
    before = files()
    kept = cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and kept.count() == 100
    path = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    release(kept)
    assert not path.exists()


def test_block_links_connect_what_is_linked(monkeypatch):
    rule = jaccard.Rule()
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 40, 200))
    sets = []
    for _ in range(150):
        keep = base[rng.random(len(base)) > rng.random() * 0.12]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 40, rng.integers(0, 12))])))
    links = jaccard.block_links(sets, rule)
    inter = lambda a, b: len(np.intersect1d(a, b))
    true = [(i, j) for i in range(150) for j in range(i) if 10 * (k := inter(sets[i], sets[j])) >= 9 * (len(sets[i]) + len(sets[j]) - k)]

    def parts(edges):
        p = list(range(150))
        for _ in range(150):
            for a, b in edges:
                p[a] = p[b] = min(p[a], p[b])
        return p

    assert set(links) <= set(true) | {(b, a) for a, b in true}
    assert parts(links) == parts(true)


def test_no_rows(spark):
    none = table(spark, [])
    assert jaccard.jaccard_groups(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert line_dedup.drop_repeated_chunks(none).count() == 0
    assert jaccard.one_of_each_group(none).count() == 0 and exact_dedup.drop_exact_copies(none).count() == 0


def test_one_of_each_group_keeps_columns(spark):
    text = " ".join(f"w{i}" for i in range(80))
    d = table(spark, [(3, text), (9, text + " more"), (4, "other words stand here now"), (None, text), (8, None)])
    got = jaccard.one_of_each_group(d)
    assert got.columns == d.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == [3, 4, 8, None]


def test_long_text_without_white_space(spark):
    long = "x" * 300_000
    rows = [(1, long), (2, long + " y"), (3, long)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(table(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, x) for x in range(201, 300)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    rng.shuffle(edges)
    perm = list(range(500))
    rng.shuffle(perm)
    edges = [(perm[a], perm[b]) for a, b in edges]
    p = list(range(500))
    for _ in range(100):
        for a, b in edges:
            p[a] = p[b] = min(p[a], p[b])
    met = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: p[x] for x in met}


ROWS = [(5, "a b"), (3, "ab"), (7, " a\tb\n"), (9, ""), (8, None), (None, "ab"), (2, "\v\f "), (3, "ab"), (1, "AB"), (6, "a b"), (4, "z" * 200_000)]


def brute_dedup(rows):
    squeeze = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(squeeze(t), []).append((-len(t or ""), d is None, d or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        out += [(rows[m[3]][0], rows[best[3]][0], len(members)) for m in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, weak):
    d = table(spark, ROWS)
    # A hash under which nearly everything collides: the bytes must tell the texts apart.
    kw = {"content_hash": lambda c: F.substring(F.unhex(F.md5(c)), 1, 0)} if weak else {}
    got = exact_dedup.exact_dedup(d, **kw).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == brute_dedup(ROWS)
    assert sum(r.kept for r in got) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in ROWS})
    assert all((r.doc_id == r.keep_id) for r in got if r.kept)


def test_only_hot_groups_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_A_TASK", 50)
    rows = spark.createDataFrame([("hot", i) for i in range(1000)] + [(f"k{i % 300}", i) for i in range(600)], "h string, place bigint")
    sizes = rows.groupBy("h").agg(F.count("*").alias("n"))
    assert exact_dedup.salts_of(sizes).agg(F.sum("salts")).first()[0] == 20 + 300  # not 20 for each hash
    got = exact_dedup.salted(rows, sizes).groupBy("h", "salt").count().collect()
    assert sum(r["count"] for r in got) == 1600 and max(r["count"] for r in got) == 50


def test_survivors_of_exact_dedup(spark):
    got = exact_dedup.drop_exact_copies(table(spark, ROWS))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(7, " a\tb\n"), (2, "\v\f "), (1, "AB"), (6, "a b"), (4, "z" * 200_000)], key=repr)
    assert got.columns == table(spark, ROWS).columns


def brute_lines(rows, c):
    seen, out = set(), []
    for d, text in sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        keep, at, gone = [], 0, 0
        for _, start, stop, n, _, _ in line_dedup.chunks_of(text, c):
            piece = text[start:stop].removesuffix("\n")
            if piece in seen:
                keep.append(text[at:start])
                at, gone = stop, gone + n
            seen.add(piece)
        out.append((d, "".join(keep) + text[at:], gone))
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_line_dedup(spark, monkeypatch, weak):
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice(["red", "blue", "green", "ünï", "x"]) + str(rng.randrange(50)) for _ in range(6))
    passage = [line() for _ in range(14)]
    rows = []
    for i in range(30):
        own = [line() for _ in range(rng.randrange(0, 12))]
        cut = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:cut] + (passage if rng.random() < 0.7 else ["", " "]) + own[cut:])))
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, rows[0][1]), (0, rows[0][1])]
    c = line_dedup.Cutting()
    if weak:  # one hash for all chunks, so only the bytes tell them apart
        real = line_dedup.chunks_of
        monkeypatch.setattr(line_dedup, "all_chunks", lambda d, c: ORIGINAL(d, c).withColumns({"h1": F.lit(1).cast("bigint"), "h2": F.lit(1).cast("bigint")}))
        assert real
    got = line_dedup.drop_repeated_chunks(table(spark, rows), c).collect()
    want = {d: (t, gone) for d, t, gone in brute_lines(rows, c)}
    assert {r.doc_id: (r.text, r.removed_lines) for r in got} == want
    assert sum(gone for _, gone in want.values()) > 100 and len(got) == len(rows)


ORIGINAL = line_dedup.all_chunks


def test_chunks_survive_shifts():
    rng = random.Random(9)
    passage = [f"line {rng.random()}" for _ in range(40)]
    c = line_dedup.Cutting()
    pieces = lambda lines: {"\n".join(lines)[a:b].strip("\n") for _, a, b, _, _, _ in line_dedup.chunks_of("\n".join(lines), c)}
    plain, shifted = pieces(passage), pieces(["new first line", "and another", *passage, "last"])
    assert len(plain & shifted) >= len(plain) - 2


def brute_runs(rows, c):
    """Every two neighbouring lines with content that stood before, away from themselves, go, if a boundary is among those next to them."""
    first, out = {}, {}
    for d, text in sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = text.split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip()]
        dead, run = set(), []
        for k, (a, b) in enumerate([*zip(filled, filled[1:]), (None, None)]):
            piece = None if a is None else "\n".join(lines[a : b + 1])
            at = (d, text, k) if a is None else first.setdefault(piece, (d, text, k))
            if a is not None and (at[:2] != (d, text) or k > at[2] + 1):
                run.append((a, b))
                continue
            if any(line_dedup.pairs_of(lines[i] + "\n" + lines[j], c)[0][3] for i, j in run):
                dead |= {x for i, j in run for x in range(i, j + 1)}
            run = []
        kept = "".join(x + "\n" * (i < len(lines) - 1) for i, x in enumerate(lines) if i not in dead)
        out[d] = (kept, len(lines), sum(i - 1 not in dead for i in dead), len(dead))
    return out


@pytest.mark.parametrize("weak, mean", [(False, 1), (True, 1), (False, 2), (True, 2)])
def test_repeated_runs_go_whole(spark, monkeypatch, weak, mean):
    c = line_dedup.Cutting(window=2, mean=mean)
    rng = random.Random(7)
    line = lambda: " ".join(rng.choice(["red", "blue", "ünï", "\U0001f600"]) + str(rng.randrange(900)) for _ in range(6))
    passages = [[line() for _ in range(k)] for k in (2, 3, 4, 8, 15)]
    rows = [(-1, "\n".join(sum(passages, [])))]
    for i in range(40):
        p = rng.choice(passages)
        a = rng.randrange(len(p) - 1)
        rows.append((i, "\n".join([line(), "", *p[a : rng.randrange(a + 2, len(p) + 1)], " ", line()])))
    rows += [(50, None), (51, ""), (52, "\n \n"), (53, rows[5][1]), (53, rows[5][1]), (None, "q\nr"), (54, "p\nq\nr"), (55, "q\n\nr\ns"), (56, "z\nz\nz"), (57, "y\ny\ny\ny\ny\n")]
    if weak:  # one hash for all pairs, so only the bytes tell them apart
        real = line_dedup.all_pairs
        monkeypatch.setattr(line_dedup, "all_pairs", lambda d, c: real(d, c).withColumns({"h1": F.lit(1).cast("bigint"), "h2": F.lit(1).cast("bigint")}))
    got = line_dedup.drop_repeated_runs(table(spark, rows), c).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_runs(rows, c)
    # Of a passage between foreign lines with a boundary in it nothing stays, whatever its length and wherever it begins.
    whole = [r.text.count("\n") == 3 and r.removed_chunks == 1 for r in got if r.doc_id in range(40)]
    assert all(whole) if mean == 1 else sum(whole) > 10
    assert all(r.removed_chunks in (0, 1) for r in got if r.doc_id in range(40))
    assert line_dedup.drop_repeated_runs(table(spark, [])).count() == 0
