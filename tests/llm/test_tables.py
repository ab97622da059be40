"""Archive, neighbours, mixing, the queries against SQL, and the pipeline's stages."""

import base64
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, duck
from scholia.llm import bpe, exact_dedup, jaccard, mixing, neighbours, queries, toxicity, warc
from scholia.session import work_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    if name in queries.ORACLES:
        problem, _ = compare(df, duck(SF), queries.ORACLES[name])
        assert not problem
    else:
        assert df.columns and df.count() > 0


# ---- archive

PAGES = [(1, "http://a/", "x"), (2, "http://b/\r\nInjected: 1", "x"), (9, "http://c/", "é\r\n\r\n" * 3), (4, None, None), (3, "u", ""), (7, "u", "x"), (7, "u", "x"), (None, "n", "x"), (-5, "m", "y")]


def archive(spark, rows):
    path = work_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([(*r, 0, "z") for r in rows], "page_id bigint, url string, html string, digest int, payload string"), path)
    return path


@pytest.mark.parametrize("rows_a_task", [1, 20_000])
def test_archive(spark, rows_a_task):
    path = archive(spark, PAGES)
    rec = warc.read_records(spark, path, rows_a_task).collect()
    assert len(rec) == len(PAGES)
    for r in rec:
        html = next(h for p, _, h in PAGES if p == r.page_id) or ""
        assert bytes(r.payload) == html.encode()
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and "Injected" not in fields
        assert rest.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(rest) - 4
        http, _, body = rest[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK") and body == (html.encode() if r.record_type == "response" else b"")
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in rec), key=repr)
    assert kinds == sorted([
        (1, "revisit", 7), (2, "revisit", 7), (9, "response", None), (4, "response", None), (3, "revisit", 4), (7, "response", None),
        (7, "revisit", 7), (None, "revisit", 7), (-5, "response", None)], key=repr)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    ids = re.findall(r"WARC-Record-ID: (\S+)", "\n".join(r.warc_head for r in warc.read_headers(spark, path).collect()))
    assert len(set(ids)) == len(PAGES)


def test_archive_summary_and_damage(spark):
    path = archive(spark, PAGES)
    for r in warc.archive_summary(spark, path).collect():
        html = (next(h for p, _, h in PAGES if p == r.page_id) or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(html), base64.b32encode(hashlib.sha1(html).digest()).decode())
    p = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.encode(F.lit("other"), "UTF-8")).collect()
    spark.createDataFrame(p).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.archive_summary(spark, path).collect()
    assert warc.archive_summary(spark, archive(spark, [])).count() == 0


@pytest.mark.parametrize("was, now", [(r"Content-Length: \d+\r\n\r\n$", "Content-Length: 7\r\n\r\n"), ("sha1:[A-Z0-9]+", "sha1:ABC")])
@pytest.mark.parametrize("kind", ["response", "revisit"])
def test_archive_with_wrong_heads(spark, was, now, kind):
    path = archive(spark, PAGES)
    wrong = F.when(F.col("warc_head").contains(f"WARC-Type: {kind}"), F.regexp_replace("warc_head", was, now)).otherwise(F.col("warc_head"))
    heads = spark.read.parquet(f"{path}/headers").withColumn("warc_head", wrong).collect()
    spark.createDataFrame(heads).write.mode("overwrite").parquet(f"{path}/headers")
    with pytest.raises(Exception, match="damaged record"):
        warc.archive_summary(spark, path).collect()


# ---- neighbours


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score int, rank string")


def dot(a, b):
    total = 0.0  # sum() compensates its rounding errors
    for x, y in zip(a, b):
        total += x * y
    return total


def brute_nearest(rows, k, every):
    d = dict(rows)
    out = {}
    for q in (i for i in d if i % every == 0):
        ranked = sorted((-dot(d[q], d[j]), j) for j in d if j != q)[:k]
        out[q] = ranked
    return out


@pytest.mark.parametrize("norms", [False, True])
@pytest.mark.parametrize("small", [False, True])
def test_neighbours_recall(spark, norms, small):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= rng.uniform(0.2, 2, (1500, 1))
    x[50:90] = x[50]  # ties
    rows = list(enumerate(x.tolist()))
    s = neighbours.Settings(shard=400, block=30, sample=700) if small else neighbours.Settings()
    got = {}
    for r in neighbours.nearest(vectors(spark, rows), k=20, settings=s).collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    want = brute_nearest(rows, 20, 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
        hits += len({f[2] for f in found} & {j for _, j in want[q]})
        for _, score, j in found:
            assert score == -dot(x[q].tolist(), x[j].tolist())
    assert hits >= 0.9 * 20 * len(want)


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [1.0, -inf]), (5, [1.0, None]), (6, []), (40, [0.0, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (None, [1.0, 1.0])]
    got = [tuple(r) for r in neighbours.nearest(vectors(spark, rows)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 0.5), (0, 2, 8, -1.0), (20, 1, 0, 0.5), (20, 2, 8, -0.5)]
    assert neighbours.nearest(vectors(spark, [])).count() == 0
    assert neighbours.nearest(vectors(spark, [(1, [1.0, 0.0])])).count() == 0
    assert neighbours.nearest(vectors(spark, [(0, [1.0, 0.0])])).count() == 0


def test_index_meets_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (800, 9), dtype=np.uint8)
    codes[:200] = codes[0] ^ (rng.random((200, 9)) < 0.3).astype(np.uint8)
    index = neighbours.MultiIndex(codes)
    for radius in (0, 1, 5, 8, 9, 17, 30, 72):
        probes = index.probes(radius)
        for q in codes[:12]:
            want = np.flatnonzero(np.bitwise_count(codes ^ q).sum(1) <= radius)
            assert np.array_equal(index.within(q, radius, probes), want)


# ---- mixing


def water_level(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing out what is cut, again and again."""
    total = share * sum(s for _, s in sizes)
    w = {k: weights[i % len(weights)] for i, (k, _) in enumerate(sizes)}
    cap, fixed = {k: most * s for k, s in sizes}, {}
    while True:
        free = [k for k, _ in sizes if k not in fixed]
        rest = total - sum(fixed.values())
        goal = {k: rest * w[k] / sum(w[j] for j in free) for k in free}
        over = [k for k in free if goal[k] > cap[k]]
        if not over:
            return fixed | goal
        fixed |= {k: cap[k] for k in over}


def documents(spark, rows):
    return spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id bigint, text string, source string, key string, size int")


def some_rows(seed=1, n=400):
    rng = random.Random(seed)
    names = ["b", "a", "ä", "Z", None, "-", "=", "\U0001f600", "￮"]
    rows = [(i, " \n".join("w" for _ in range(rng.choice([0, 1, 3, 7, 40, 200]))), rng.choice(names)) for i in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", "only empty"), (n + 2, "  x", "a"), (3, "w w w", "b"), (3, "w w w", "b"), (None, "w w", "b"), (None, "w w", "b")]


def test_mixing(spark):
    rows = some_rows()
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + count(t)
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    goal = water_level([(s, size[s]) for s in order])
    source = {(d, count(t)): s for d, t, s in rows}
    taken = {}
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == size[s] and abs(r.target - goal[s]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] = taken.get(s, 0) + r.taken
    for s in order:
        assert abs(taken[s] - goal[s]) <= 3, (s, taken[s], goal[s])
    again = mixing.mix(documents(spark, rows).repartition(5)).collect()
    key = lambda r: repr((r.doc_id, r.size, r.taken))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(documents(spark, [])).count() == 0


def test_mixed_documents(spark):
    rows = some_rows(2, 120)
    d = documents(spark, rows)
    want = {}
    for r in mixing.mix(d).collect():
        want[r.doc_id, r.size] = want.get((r.doc_id, r.size), 0) + r.copies
    got = mixing.mixed_documents(d)
    assert got.columns == d.columns
    have = {}
    for r in got.collect():
        k = (r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
        have[k] = have.get(k, 0) + 1
    assert have == {k: v for k, v in want.items() if v}


def test_fit_against_brute_force():
    rng = random.Random(6)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 30), rng.randrange(1, 5)))
        counts = [rng.randrange(0, 4) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts))
        budget = rng.randrange(0, total + 1)
        take = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        sums = {sum(n * t for n, t in zip(lengths, ts)) for ts in itertools.product(*[range(c + 1) for c in counts])}
        assert abs(sum(n * t for n, t in zip(lengths, take)) - budget) == min(abs(s - budget) for s in sums)
    lengths = sorted(rng.sample(range(1, 20_000), 3000))
    counts = [rng.randrange(1, 500) for _ in lengths]
    budget = sum(n * c for n, c in zip(lengths, counts)) // 3
    take = mixing.fit(lengths, counts, budget)
    assert sum(n * t for n, t in zip(lengths, take)) == budget and all(t <= c for t, c in zip(take, counts))


@pytest.mark.parametrize("budget", [60_000, 70_000, 1_500_000, 3_000_000])
def test_short_and_long_documents_are_taken_alike(budget):
    lengths = sorted(random.Random(budget).sample(range(100, 12_000), 900))  # a document each
    take = mixing.fit(lengths, [1] * 900, budget)
    assert sum(n * t for n, t in zip(lengths, take)) == budget
    part = budget / sum(lengths)
    for third in (take[:300], take[300:600], take[600:]):
        assert abs(sum(third) / 300 - part) < 0.03
    assert mixing.fit(lengths, [1] * 900, budget, seed=5) != take == mixing.fit(lengths, [1] * 900, budget)


# ---- pipeline


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("n_chars", F.col("n_chars") + 0)
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "bpe" or out.columns == names
        path = work_path(spark, name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = (before, docs)
    before, after = kept["toxicity"]
    bad = {r.doc_id for r in toxicity.score(before, toxicity.train(before, spark.read.parquet(f"{sf}/labels.parquet"))).collect() if r.predicted}
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    assert bad and ids(after) == sorted(set(ids(before)) - bad)
    before, after = kept["exact_dedup"]
    assert ids(after) == sorted(r.doc_id for r in exact_dedup.exact_dedup(before).collect() if r.kept)
    before, after = kept["near_dedup"]
    assert ids(after) == sorted({r.component_id for r in jaccard.jaccard_groups(before, jaccard.Rule(5, 8, 10)).collect()})
    before, after = kept["mixing"]
    assert ids(after) == sorted(itertools.chain.from_iterable([r.doc_id] * r.copies for r in mixing.mix(before).collect()))
    before, after = kept["bpe"]
    assert ids(after) == ids(before) and after.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {(r.doc_id, r.decoded_sha256) for r in after.collect()} == {(r.doc_id, r.s) for r in before.select("doc_id", F.sha2("text", 256).alias("s")).collect()}
    assert bpe.default_path().endswith("byte_bpe_50k.json")


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0
