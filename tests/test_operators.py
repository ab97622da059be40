"""Operators on small literal tables, against brute force where SQL cannot say it."""

import json
import random
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scholia.functions import ids, records as R, text as X, vectors as V
from scholia.operators import articles as A, chunking as C, graph as G, hybrid as H, neardup as N, pages as P, params as Q, balls as B2, postings as B, skew as K, stats as S
from scholia.operators.bm25 import bm25_index, bm25_search
from scholia.operators import vector as V2
from scholia.operators.vector import vector_search
from scholia.plans import fixtures
from scholia.registry import Tables
from scholia.session import cut_lineage, work_path
from scholia.sources.tables import read_balls, read_graph, read_index, read_postings, write_balls, write_graph, write_index, write_postings


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column("v").alias("r")).first()["r"]


# ---- scalars -------------------------------------------------------------------------------------


@pytest.mark.parametrize("raw, clean", [
    ("hy-\nphen", "hyphen"), ("a\n\n\n\nb", "a\n\nb"), ("a\nb", "a b"), ("one\n\n12\n\ntwo", "one\n\n\n\ntwo"), ("a   b\t c", "a b c"), ("  x \n", "x"), ("", ""),
])
def test_clean_page_text(spark, raw, clean):
    got = one(spark, X.clean_page_text, raw)
    if "12" in raw:
        assert "12" not in got and got.startswith("one") and got.endswith("two")
    else:
        assert got == clean


@pytest.mark.parametrize("kind, name, wanted", [
    ("Species", "Lutjanus peru", "species::lutjanus_peru"), ("Method", "gill net survey", "method::gill_net_survey"), ("Location", " Bahía de (La) Paz ", "location::bahia_de_la_paz"),
])
def test_entity_id(spark, kind, name, wanted):
    assert one(spark, lambda c: ids.entity_id(F.lit(kind), c), name) == wanted


@pytest.mark.parametrize("stem, wanted", [("1998_Okafor & sons._Tide tables", "1998_Okafor_sons_Tide_tables"), ("¿¿", "paper"), ("Ünï-cödé", "Uni-code")])
def test_paper_id(spark, stem, wanted):
    assert one(spark, ids.derive_paper_id, stem) == wanted


@pytest.mark.parametrize("raw, wanted", [
    ("Okafor, B.; Lindqvist, T.", ["Okafor, B.", "Lindqvist, T."]), ("Okafor B, Lindqvist T", ["Okafor B", "Lindqvist T"]),
    ("Okafor, B., Lindqvist, T.", ["Okafor, B.", "Lindqvist, T."]), ("Okafor, B., Lindqvist", ["Okafor, B."]), ("Okafor", ["Okafor"]), ("  ", []),
])
def test_parse_authors(spark, raw, wanted):
    assert one(spark, R.parse_authors, raw) == wanted


@pytest.mark.parametrize("raw, wanted", [("-999", None), ("-9999", None), ("", None), ("0", 0.0), ("abc", None), ("1.5", 1.5), ("NaN", None)])
def test_safe_float(spark, raw, wanted):
    assert one(spark, R.safe_float, raw) == wanted


@pytest.mark.parametrize("raw, wanted", [("1", "male"), ("F", "female"), ("0", "combined"), ("juvenile", "combined"), (None, None)])
def test_sex(spark, raw, wanted):
    assert one(spark, R.normalize_sex, raw) == wanted


@pytest.mark.parametrize("raw, wanted", [
    ("see https://doi.org/10.1/a.b). x", "10.1/a.b"), ("doi: 10.2/x;", "10.2/x"), ("DOI: 10.3/y", "10.3/y"), ("none", None), ("doi: 10.9/later https://doi.org/10.8/link", "10.8/link"),
])
def test_first_doi(spark, raw, wanted):
    assert one(spark, X.first_doi, raw) == wanted


def test_key_terms_fall_back_to_all_words(spark):
    assert one(spark, X.key_terms, "The deep learning method") == ["the", "deep", "learning", "method"]
    assert one(spark, X.key_terms, "Growth of (Lutjanus), a review") == ["growth", "lutjanus"]


def test_table_score(spark):
    assert one(spark, X.table_score, "") == 0.0
    assert one(spark, X.table_score, "Table 1 10 2 29 4") > 2.0
    assert one(spark, X.table_score, "plain prose without figures") == 0.0


def test_cosine_identities(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([1.0, 0.0], [-3.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(V.cosine("a", "b")).collect()] == [1.0, 0.0, -1.0, 0.0]
    assert df.select(V.unit("a")).collect()[3][0] == [0.0, 0.0]


@pytest.mark.parametrize("flags, wanted", [((True, True, False), "MARINE"), ((False, True, False), "FRESHWATER"), ((True, False, True), "MARINE_FRESHWATER"), ((False, False, True), "TERRESTRIAL"), ((False,) * 3, "")])
def test_habitat(spark, flags, wanted):
    assert one(spark, lambda _: R.habitat(*[F.lit(f) for f in flags]), "x") == wanted


# ---- skew building blocks ------------------------------------------------------------------------


def test_running_total_matches_cumsum_over_many_blocks(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, pos bigint, v bigint").repartition(5)
    got = {(r["k"], r["pos"]): r["s"] for r in K.running_total(df, ["k"], "pos", F.col("v"), "s", block=4).collect()}
    want, sums = {}, {}
    for k, pos, v in sorted(rows, key=lambda r: r[1]):
        want[k, pos] = sums.get(k, 0)
        sums[k] = want[k, pos] + v
    assert got == want
    numbers = sorted(r["n"] for r in K.numbered(df, [], "pos", "n", block=4).collect())
    assert numbers == list(range(500))


def test_totals_in_order_without_keys(spark):
    rng = random.Random(4)
    rows = [(p * p, rng.randint(0, 9)) for p in rng.sample(range(10_000), 700)]  # sparse positions
    got = {r["pos"]: r["s"] for r in K.running_total(spark.createDataFrame(rows, "pos bigint, v bigint"), [], "pos", F.col("v"), "s").collect()}
    total, want = 0, {}
    for pos, v in sorted(rows):
        want[pos] = total
        total += v
    assert got == want
    assert K.numbered(spark.createDataFrame([], "pos bigint"), [], "pos", "n").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_keep_hot_keys_apart(spark):
    df = spark.createDataFrame([("k", i, "t" * i) for i in range(9)], "k string, pos bigint, text string").repartition(4)
    first = plan_of(K.first_by(df, ["k"], ["pos"]))
    assert "SortAggregate" not in first and "WindowGroupLimit" in first
    numbers = plan_of(K.numbered(df, [], "pos", "n"))
    assert "SinglePartition" not in numbers and "hashpartitioning(0" not in numbers


def test_upper_median_narrows_to_the_exact_value(spark):
    from scholia.operators.stats import upper_median

    rng = random.Random(8)
    for values in ([float(rng.randrange(50)) for _ in range(3000)], [rng.random() for _ in range(4001)], [7.0] * 900, [1.0, None, 3.0], [None]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        known = sorted(v for v in values if v is not None)
        assert upper_median(df, "v", accuracy=50, few=100).first()[0] == (known[len(known) // 2] if known else None)


def test_first_by_takes_first_on_null_and_ties(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z")], "k string, o int, v string")
    assert sorted(r["v"] for r in K.first_by(df, ["k"], ["o"]).collect()) == ["y", "z"]


def test_upper_median(spark):
    for n in (1, 2, 5, 100, 101):
        values = [float((i * 37) % n) for i in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert S.upper_median(df, "v").first()[0] == sorted(values)[n // 2]


# ---- near duplicates -----------------------------------------------------------------------------


def clustered(n=90, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    m = centers[rng.integers(0, 6, n)] + rng.normal(scale=0.25, size=(n, dim))
    m[n // 3 : n // 2] = m[0]
    return m.astype(np.float32)


def greedy(m, t):
    u = m.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sim = np.round(u @ u.T, 9)
    leader = {}
    for i in range(len(m)):
        if i in leader:
            continue
        leader[i] = i
        for j in range(i + 1, len(m)):
            if j not in leader and sim[i, j] >= t:
                leader[j] = i
    return leader, sim


@pytest.mark.parametrize("passes, batch", [(4, 4096), (2, 7), (0, 1)])
def test_dedup_groups_equal_the_sequential_algorithm(spark, passes, batch):
    m = clustered()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "seq bigint, embedding array<float>").repartition(6)
    want, _ = greedy(m, 0.9)
    got = {r["seq"]: r["leader"] for r in N.dedup_groups(df, 0.9, passes=passes, batch=batch, pivots=5, block=8).collect()}
    assert got == want
    assert len(set(want.values())) < len(m)


def test_similar_pairs_count_partners_across_cells_and_blocks(spark):
    m = clustered()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "seq bigint, embedding array<float>")
    _, sim = greedy(m, 0.9)
    want = {}
    for i in range(len(m)):
        near = [j for j in range(len(m)) if j != i and sim[i, j] >= 0.9]
        if near:
            lower = [j for j in near if j < i]
            want[i] = (len(near), min(lower) if lower else None, round(max(sim[i, j] for j in near), 6))
    got = {r["seq"]: (r["n_partners"], r["first_partner"], round(r["best_score"], 6)) for r in N.similar_pairs(df, 0.9, pivots=7, block=5).collect()}
    assert got == want


def test_vector_search_in_blocks_equals_one_block(spark):
    m = clustered(60)
    df = spark.createDataFrame([(f"c{i}", i, v.tolist()) for i, v in enumerate(m)], "chunk_id string, seq bigint, embedding array<float>").repartition(4)
    q = spark.createDataFrame([(i, m[i].tolist()) for i in range(0, 60, 7)], "query_id bigint, embedding array<float>")
    whole = sorted(map(tuple, vector_search(df, q, 5).collect()))
    assert whole == sorted(map(tuple, vector_search(df, q, 5, block_bytes=200).collect()))
    _, sim = greedy(m, 0.9)
    for i in range(0, 60, 7):
        best = sorted(range(60), key=lambda j: (-np.round((sim[i, j] + 1) / 2, 9), j))[:5]
        assert [r[2] for r in sorted((r for r in whole if r[0] == i), key=lambda r: r[4])] == best
    assert vector_search(df, q, 500).groupBy("query_id").count().first()["count"] == 60


def test_bm25_like_the_textbook(spark):
    texts = ["fish growth in the sea", "growth growth models", "stars and the sky", "the the the"]
    df = spark.createDataFrame([(f"c{i}", i, x) for i, x in enumerate(texts)], "chunk_id string, seq bigint, text string")
    q = spark.createDataFrame([(1, "Growth of fish fish"), (2, "nothing here")], "query_id bigint, question string")
    docs = [x.split() for x in texts]
    n, avg = 4, sum(map(len, docs)) / 4
    vocabulary = {w for d in docs for w in d}
    raw = {w: np.log(n - k + 0.5) - np.log(k + 0.5) for w in vocabulary if (k := sum(w in d for d in docs))}
    mean = sum(raw.values()) / len(raw)
    idf = {w: v if v >= 0 else 0.25 * mean for w, v in raw.items()}
    score = [sum(idf.get(w, 0) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / avg)) for w in "growth of fish fish".split()) for d in docs]
    got = {r["seq"]: r["score"] for r in bm25_search(bm25_index(df), q, 10).collect()}
    want = pytest.approx({i: s for i, s in enumerate(score) if s > 0})
    index = bm25_index(df)
    assert got == want
    more = q.union(spark.createDataFrame([(i, "growth sky") for i in range(3, 9)], q.schema))
    by_blocks = sorted(map(tuple, bm25_search(index, more, 2, per_scan=2).collect()))
    assert by_blocks == sorted(map(tuple, bm25_search(index, more, 2).collect()))
    path = work_path(spark, "bm25")
    write_postings(index, path)
    saved = read_postings(spark, path)
    assert {r["seq"]: r["score"] for r in bm25_search(saved, q, 10).collect()} == want
    assert by_blocks == sorted(map(tuple, bm25_search(saved, more, 2).collect()))
    named = more.withColumn("query_id", F.concat(F.lit("q"), F.col("query_id").cast("string")))
    assert sorted((f"q{r[0]}", *r[1:]) for r in by_blocks) == sorted(map(tuple, bm25_search(saved, named, 2).collect()))
    counts = {(r["seq"], r["term"]): (r["dl"], r["tf"]) for r in saved.postings.collect()}
    assert counts == {(i, w): (len(d), d.count(w)) for i, d in enumerate(docs) for w in d}


def saved_index(spark, texts, span):
    df = spark.createDataFrame([(f"c{i}", i, x) for i, x in texts], "chunk_id string, seq bigint, text string").repartition(3)
    index, path = bm25_index(df), work_path(spark, "bm25")
    write_postings(index, path, span)
    return index, read_postings(spark, path)


@pytest.mark.parametrize("span, k", [(4, 3), (16, 1), (64, 50)])
def test_pruned_search_equals_the_scan(spark, span, k):
    rng = random.Random(span)
    words = [f"w{i}" for i in range(30)]
    texts = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(30)], k=rng.randint(0, 25)))) for i in rng.sample(range(1000), 300)]
    index, saved = saved_index(spark, texts, span)
    asked = [(f"q{i}", " ".join(rng.choices([*words, "unknown"], k=rng.randint(0, 6)))) for i in range(25)] + [("two", "w1 w20"), ("none", "unknown"), ("empty", None)]
    q = spark.createDataFrame(asked, "query_id string, question string")
    want = sorted(map(tuple, bm25_search(index, q, k).collect()))
    assert sorted(map(tuple, bm25_search(saved, q, k).collect())) == want and want
    assert bm25_search(saved, q.limit(0), k).count() == 0
    many = saved.postings.count()
    assert many == sum(len(set(x.split())) for _, x in texts)


def test_search_skips_blocks_and_reads_its_terms_alone(spark):
    # "tide" is everywhere, but thrice as dense in one chunk of a hundred; "net" is rare
    texts = [(i, "tide " * (9 if i % 100 == 7 else 1) + "net " * (i % 250 == 7) + " ".join(f"x{i}y{j}" for j in range(9))) for i in range(1000)]
    index, saved = saved_index(spark, texts, 10)
    q = spark.createDataFrame([("q", "tide net")], "query_id string, question string")
    asked = saved.weighted(q)
    bounds = saved.bounds(asked)
    assert {r["term"] for r in saved.reached(asked).select("term").distinct().collect()} == {"tide", "net"}
    plan = saved.reached(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and "term IN (" in plan.split("PushedFilters")[1].replace("In(term, ", "term IN (")
    first = B.first_blocks(bounds, 3)
    left = B.blocks_left(bounds, first, saved.best(asked, first, 3), 3)
    assert bounds.count() == 100 and 1 <= first.count() <= 3 and left.count() <= 10
    assert sorted(map(tuple, bm25_search(saved, q, 3).collect())) == sorted(map(tuple, bm25_search(index, q, 3).collect()))


@pytest.mark.parametrize("threshold", [0.35, 0.6, 0.95])
def test_loose_thresholds_leave_out_cells(spark, threshold):
    rng = np.random.default_rng(8)
    middles = np.linalg.qr(rng.normal(size=(40, 40)))[0][:6] * 3
    rows = [(i, (middles[i % 6] + 0.15 * rng.normal(size=40)).astype(np.float32).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "seq bigint, embedding array<float>")
    m = V2.to_matrix(pa.array([v for _, v in rows], pa.list_(pa.float32())))[0]
    sim = np.round(m @ m.T, 9)
    near = (sim >= threshold) & ~np.eye(len(m), dtype=bool)
    got = {r["seq"]: (r["n_partners"], r["first_partner"], round(r["best_score"], 6)) for r in N.similar_pairs(df, threshold, pivots=12, block=10).collect()}
    want = {}
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        first = np.flatnonzero(near[i])[0]
        want[i] = (int(near[i].sum()), int(first) if first < i else None, round(float(sim[i][near[i]].max()), 6))
    assert got == want
    # a vector visits the cells that its own group lies in, not all twelve
    reps = N.fold_copies(df).select("rep", "copies", "embedding")
    visits = N._cells(reps, threshold, 12)
    assert visits.count() < 0.75 * 240 * visits.select("cell").distinct().count()
    assert visits.where("home").count() == 240
    # and within two blocks the slices leave out rows
    i, j = N.may_meet(m[:120] @ N.turn_of(m), m[120:] @ N.turn_of(m), 0.999999)
    assert len(i) < 120 and len(j) < 120


def test_near_vectors_are_not_shuffled(spark, monkeypatch):
    """At a loose threshold every vector meets every cell: lots are sent, and a row of numbers a vector and lot is what is written."""
    rng = np.random.default_rng(4)
    m = rng.normal(size=(150, 24)).astype(np.float32)
    m[70:75] = m[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "seq bigint, embedding array<float>")
    written, cut = [], N.cut_lineage
    monkeypatch.setattr(N, "cut_lineage", lambda t: written.append((t.columns, t.count())) or cut(t))
    monkeypatch.setattr(N, "LOT_BYTES", 24 * 4 * 20)  # twenty vectors
    monkeypatch.setattr(N, "PARTS", 3)
    reps = N.fold_copies(df)
    near = N.partners(reps, 0.2, pivots=4, block=16)
    got = {r["rep"]: (r["weight"], r["first"], round(r["best"], 6)) for r in near.collect()}
    unit = N.to_matrix(pa.array(m.tolist(), pa.list_(pa.float32())))[0]
    sim = np.round(unit @ unit.T, 9)
    kept = [i for i in range(150) if not 70 <= i < 75]
    want = {}
    for i in kept:
        js = [j for j in range(150) if sim[i, j] >= 0.2 and j != i and not (i == 0 and 70 <= j < 75)]
        if js:
            want[i] = (len(js), min(j if not 70 <= j < 75 else 0 for j in js), round(float(max(sim[i, js])), 6))
    assert got == want
    wide = [n for columns, n in written if "embedding" in columns]
    assert wide == [len(kept)] and len(written) > 8  # vectors are written once, where they lie
    assert "embedding" not in near._jdf.queryExecution().executedPlan().toString()


def test_close_vectors_are_not_shuffled(spark):
    """At a tight threshold, too: what follows the comparison has no vectors, and copies and near copies are found."""
    rng = np.random.default_rng(6)
    m = rng.normal(size=(60, 24)).astype(np.float32)
    m[40] = m[3]
    m[50] = m[3] * 1.5 + 0.01
    reps = N.fold_copies(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "seq bigint, embedding array<float>"))
    near = N.partners(reps, 0.95, pivots=6, block=10)
    assert {r["rep"]: (r["weight"], r["first"]) for r in near.collect()} == {3: (1, 50), 50: (2, 3)}
    assert "embedding" not in near._jdf.queryExecution().executedPlan().toString()


def balls_of(spark, rows, cells):
    df = spark.createDataFrame([(f"c{i}", i, v) for i, v in rows], "chunk_id string, seq bigint, embedding array<double>").repartition(3)
    path = work_path(spark, "balls")
    write_balls(df, path, cells)
    return df, read_balls(spark, path)


@pytest.mark.parametrize("metric, k, spread", [("cosine", 3, 0.05), ("l2", 1, 0.3), ("cosine", 40, 9.0)])
def test_ball_search_equals_the_scan(spark, metric, k, spread):
    rng = np.random.default_rng(k)
    middles = rng.normal(size=(12, 6))
    rows = [(i, (middles[i % 12] * rng.uniform(0.5, 2) + spread * rng.normal(size=6)).tolist()) for i in range(400)]
    rows += [(500, [0.0] * 6), (501, None), (502, [1.0]), (503, [float("nan")] * 6), (504, rows[0][1]), (505, rows[0][1])]
    df, saved = balls_of(spark, rows, 12)
    asked = [(i, (middles[i % 12] + spread * rng.normal(size=6)).tolist()) for i in range(20)] + [(90, None), (91, [0.0] * 6), (92, [1.0])]
    q = spark.createDataFrame(asked, "query_id bigint, embedding array<double>")
    want = sorted(map(tuple, vector_search(df, q, k, metric).collect()))
    assert sorted(map(tuple, vector_search(saved, q, k, metric).collect())) == want and want
    assert sorted(map(tuple, vector_search(saved, q, k, metric, block_bytes=400).collect())) == want
    assert vector_search(saved, q.limit(0), k, metric).count() == 0


def test_ball_search_opens_few_cells(spark, monkeypatch):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(10, 8))
    rows = [(i, (middles[i % 10] + 0.02 * rng.normal(size=8)).tolist()) for i in range(300)]
    _, saved = balls_of(spark, rows, 10)
    opened = []
    real = B2.BallIndex.reached

    def counted(self, *a):
        df = real(self, *a)
        opened.append({r[0] for r in df.select(F.input_file_name()).distinct().collect()})
        assert not opened[-1] or "PartitionFilters: [cell" in df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(B2.BallIndex, "reached", counted)
    hits = vector_search(saved, spark.createDataFrame([("q", middles[3].tolist())], "query_id string, embedding array<double>"), 5).collect()
    assert {r["seq"] % 10 for r in hits} == {3}
    files = {r[0] for r in saved.chunks.select(F.input_file_name()).distinct().collect()}
    assert len(set.union(*opened)) <= 3 < 10 <= len(files)


def test_no_vectors_can_be_saved(spark):
    q = spark.createDataFrame([("q", [1.0])], "query_id string, embedding array<double>")
    for rows in ([(1, None)], [(1, [0.0]), (2, [0.0])]):
        df, saved = balls_of(spark, rows, 3)
        assert sorted(map(tuple, vector_search(saved, q, 2).collect())) == sorted(map(tuple, vector_search(df, q, 2).collect()))


def test_nothing_can_be_saved(spark):
    _, saved = saved_index(spark, [(1, ""), (2, None)], 8)
    q = spark.createDataFrame([("q", "tide")], "query_id string, question string")
    assert bm25_search(saved, q, 3).count() == 0 and saved.postings.count() == 0


def test_vectors_that_are_none(spark):
    nan = float("nan")
    rows = [("a", 0, [1.0, 0.0]), ("b", 1, None), ("c", 2, [1.0, 0.0, 0.0]), ("d", 3, [1.0]), ("e", 4, [nan, 1.0]), ("f", 5, [0.0, 1.0]), ("g", 6, [0.0, 0.0])]
    chunks = spark.createDataFrame(rows, "chunk_id string, seq bigint, embedding array<float>")
    ask = spark.createDataFrame([("one", [1.0, 0.0]), ("two", None), ("three", [2.0, 2.0])], "query_id string, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["chunk_id"]) for r in vector_search(chunks, ask, 5).collect())
    assert got == [("one", 1, "a"), ("one", 2, "f"), ("one", 3, "g"), ("three", 1, "a"), ("three", 2, "f"), ("three", 3, "g")]
    assert vector_search(chunks, ask.limit(0), 5).count() == 0
    zeros = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, 0.0]), (4, [1.0, 0.001])], "seq bigint, embedding array<float>")
    assert {r["seq"] for r in N.similar_pairs(zeros, 0.9).collect()} == {3, 4}
    assert {r["seq"]: r["leader"] for r in N.dedup_groups(zeros, 0.9).collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3}


def test_chunks_hold_the_whole_texts(spark):
    from scholia.plans import fixtures as fx
    from scholia.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in t.documents.collect()}
    got = {}
    for r in fx.chunks(t).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"])
    assert got == {d: n for d, x in texts.items() if (n := sum(len(line) for line in x.split("\n") if line.strip()))}
    solid = lambda x: "".join(x.split())
    for r in fx.articles(t).select("pos", "species", "title", "abstract").collect():
        own = r["title"].removeprefix(r["species"] + ": ") + (r["abstract"] or "")
        assert solid(own) == solid(texts[r["pos"]]) or solid(own) == solid(texts[r["pos"]].replace(".", "", 1))
    assert fx.question_vectors(t).count() == t.benchmark.count()


def test_built_index_can_be_searched(spark):
    words = ["tide", "net", "gull", "harbour", "mast", "rope", "sail", "keel"]
    rng = random.Random(6)
    docs = [(f"p{i}", " ".join(rng.choice(words) for _ in range(400)).encode()) for i in range(6)] + [("bad", b"\xff"), ("old", b"x"), ("short", b"one")]
    docs = spark.createDataFrame(docs, "paper_id string, content binary")
    done = spark.createDataFrame([("old", 7)], "paper_id string, seq bigint")
    chunks, failed, summary = C.index_documents(docs, done=done, size=500, overlap=50)
    rows = chunks.orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(8, 8 + len(rows)))
    assert [(r["paper_id"], r["chunk_index"]) for r in rows] == sorted((r["paper_id"], r["chunk_index"]) for r in rows)
    assert all(r["total_chunks"] == sum(x["paper_id"] == r["paper_id"] for x in rows) for r in rows)
    assert tuple(summary.first()) == (6, 1, 2, len(rows)) and {r["paper_id"] for r in failed.collect()} == {"bad", "short"}
    path = work_path(spark, "index")
    write_index(chunks, path)
    stored, _ = read_index(spark, path)
    write_postings(bm25_index(stored), path)
    ask = C.embed(spark.createDataFrame([("q", rows[5]["text"])], "query_id string, question string"), "question")
    hits = H.hybrid_search(stored, read_postings(spark, path), ask).orderBy("rank").collect()
    assert hits[0]["chunk_id"] == rows[5]["chunk_id"]




# ---- pages and chunks ----------------------------------------------------------------------------

TIDES = "The tide tables of the harbour list two high waters a day. " * 20


def test_sliding_chunks(spark):
    df = spark.createDataFrame([("paper_a", TIDES)], "paper_id string, text string")
    rows = C.chunk_sliding(df, 200, 40, 20).orderBy("chunk_index").collect()
    assert rows[0]["chunk_id"] == "paper_a_chunk_000" and len(rows) > 3
    assert all(len(r["text"]) <= 200 + 20 for r in rows)
    assert all(r["text"] == TIDES[r["char_start"] : r["char_end"]].strip() for r in rows)
    assert all(b["char_start"] <= a["char_end"] for a, b in zip(rows, rows[1:]))
    with pytest.raises(ValueError):
        C.chunk_sliding(df, 100, 100)
    assert C.chunk_sliding(spark.createDataFrame([("p", "short")], "paper_id string, text string")).count() == 0


def random_text(rng, n):
    return "".join(rng.choice(["word ", "longerword", " ", "\n\n", "end. ", "x", "? "]) for _ in range(n))


def test_streamed_windows_equal_windows_over_the_whole_text():
    rng = random.Random(5)
    for _ in range(200):
        text = random_text(rng, rng.randint(0, 400))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 5)))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        size = rng.randint(20, 80)
        args = (size, rng.randint(0, size - 1), 5, rng.random() < 0.5)
        whole = list(C.sliding_windows([text.rstrip()], *args))
        assert list(C.sliding_windows(pieces, *args, trim=True)) == whole
        assert all(body == text[a:b].strip() for a, b, body in whole)


def test_chunk_pages_names_the_page_of_each_start(spark):
    rng = random.Random(2)
    pages = [("d", i, random_text(rng, 60).strip() or "empty") for i in range(1, 30)]
    rows = C.chunk_pages(spark.createDataFrame(pages, "paper_id string, page_number bigint, text string").repartition(5), 120, 20, 10).collect()
    full, starts = "", []
    for _, number, text in pages:
        starts.append((number, len(full), len(full) + len(text)))
        full += text + "\n\n"
    for r in rows:
        page = next((n for n, a, b in starts if a <= r["char_start"] < b), starts[-1][0])
        assert (r["text"], r["page_number"]) == (full.rstrip()[r["char_start"] : r["char_end"]].strip(), page)


def test_sentences_keep_abbreviations_and_cap_length():
    parts = C.sentences("One fish, e.g. a cod. Two! " + "x" * 30 + " " + "y" * 30, 40)
    assert [p[2] for p in parts[:2]] == ["One fish, e.g. a cod.", "Two!"]
    assert all(len(p[2]) <= 40 for p in parts) and parts[-1][3]


def test_semantic_chunks_lose_no_sentence(spark):
    rng = random.Random(9)
    text = " ".join(" ".join(rng.choice(["sea", "fish", "net", "growth", "star"]) for _ in range(rng.randint(3, 12))) + "." for _ in range(80))
    rows = C.chunk_semantic(spark.createDataFrame([("p", text)], "paper_id string, text string"), C.hashing_encoder(16), 0.4, 100, 300).orderBy("chunk_index").collect()
    assert " ".join(r["text"] for r in rows) == text
    assert all(len(r["text"]) >= 99 for r in rows[:-1])


def test_semantic_chunks_of_pages_name_their_page(spark):
    rng = random.Random(3)
    pages = [("d", i, " ".join(f"{rng.choice(['sea', 'net', 'fish'])} {i}." for _ in range(40))) for i in range(1, 9)]
    df = spark.createDataFrame(pages, "paper_id string, page_number bigint, text string").repartition(3)
    rows = C.chunk_semantic_pages(df, C.hashing_encoder(16), 0.3, 100, 250).collect()
    full = "\n\n".join(t for _, _, t in pages)
    starts = [sum(len(t) + 2 for _, _, t in pages[:i]) for i in range(8)]
    for r in rows:
        inside = [n for (_, n, text), s in zip(pages, starts) if s <= r["char_start"] < s + len(text)]
        assert r["page_number"] == (inside or [8])[0]  # between two pages: the last one, as for windows
        assert full[r["char_start"]:].lstrip().startswith(r["text"][:20])
    assert len({r["page_number"] for r in rows}) > 4


@pytest.mark.parametrize("least, most, block", [(20, 60, 1), (20, 60, 700), (5, 30, 1), (100, 250, 1_000_000)])
def test_semantic_chunks_of_pages_are_those_of_the_joined_text(spark, least, most, block):
    rng = random.Random(least + block)
    words = ["sea", "fish", "net", "etal", "e.g", "vs", "growth", "A.", "B!", "?", "x" * 45, "end.", "end.", "end.", "  ", "\n"]
    pages = []
    for d in range(12):
        dense = rng.choice([0.02, 0.3, 1.0])  # some documents have hardly any end of a sentence
        for i in range(rng.choice([1, 2, 9, 40])):
            chosen = [w for w in rng.choices(words, k=rng.choice([0, 1, 5, 60])) if "." not in w or rng.random() < dense]
            pages.append((f"d{d}", 3 * i + 1, " ".join(chosen) or rng.choice(["", " ", "."])))
    pages += [("short", 1, "sea"), ("none", 1, None)]
    df = spark.createDataFrame(pages, "paper_id string, page_number bigint, text string").repartition(4)
    texts = {}
    for d, _, text in pages:
        texts.setdefault(d, []).extend([] if text is None else [text])
    whole = spark.createDataFrame([(d, "\n\n".join(t)) for d, t in texts.items()], "paper_id string, text string")
    columns = ["paper_id", "chunk_index", "chunk_id", "char_start", "char_end", "text"]
    want = C.chunk_semantic(whole, C.hashing_encoder(16), 0.3, least, most).select(*columns).collect()
    got = C.chunk_semantic_pages(df, C.hashing_encoder(16), 0.3, least, most, block).select(*columns).collect()
    assert sorted(got) == sorted(want) and len(want) > 50


def test_semantic_groups_keep_tables_apart():
    parts = [(0, 10, "a" * 120, False), (11, 20, "1" * 50, True), (21, 30, "b" * 120, False), (31, 40, "c" * 10, False)]
    groups = C.group_sentences(parts, np.array([False, False, False]), 100, 300)
    assert [g[2] for g in groups] == ["a" * 120, "1" * 50, "b" * 120 + " " + "c" * 10]


def test_repeated_lines_need_four_pages(spark):
    body = "the body of the page is long enough to stay here for sure"
    rows = [(d, i, f"Journal\n{body} {i}\nfoot {i}") for d, n in (("long", 5), ("short", 3)) for i in range(n)]
    got = {(r["paper_id"], r["page_number"]): r["text"] for r in P.strip_repeated_lines(spark.createDataFrame(rows, "paper_id string, page_number bigint, text string")).collect()}
    assert got["long", 0] == f"{body} 0\nfoot 0" and got["short", 0].startswith("Journal")


def test_repeated_lines_keep_originals_when_nothing_is_left(spark):
    rows = [("d", i, "Running head") for i in range(6)]
    got = P.strip_repeated_lines(spark.createDataFrame(rows, "paper_id string, page_number bigint, text string"))
    assert [r["text"] for r in got.collect()] == ["Running head"] * 6


def test_markdown_headings_name_pages():
    assert P.split_markdown("a\n---\nb\n# Page 7\nc\n***\nd") == [(1, "a"), (2, "b"), (7, "c"), (8, "d")]


def test_page_gap_goes_to_the_last_page(spark):
    pages = spark.createDataFrame([("d", 1, "aaaa"), ("d", 2, "bbbb"), ("d", 3, "cc")], "paper_id string, page_number bigint, text string")
    starts = spark.createDataFrame([("d", i) for i in (0, 3, 4, 5, 6, 9, 10, 12, 99)], "paper_id string, char_start bigint")
    got = {r["char_start"]: r["page_number"] for r in P.assign_pages(starts, P.page_offsets(pages), span=3).collect()}
    assert got == {0: 1, 3: 1, 4: 3, 5: 3, 6: 2, 9: 2, 10: 3, 12: 3, 99: 3}


def test_extractor_errors_become_rows(spark):
    df = spark.createDataFrame([("a", bytearray(b"one\x0ctwo")), ("b", bytearray(b"\xff\xfe"))], "paper_id string, content binary")
    got = {(r["paper_id"], r["page_number"]): (r["text"], r["error"]) for r in C.extract_pages(df).collect()}
    assert got["a", 2] == ("two", None) and got["b", None][0] is None and "Unicode" in got["b", None][1]


def test_embed_gives_unit_vectors_and_rejects_blanks(spark):
    df = spark.createDataFrame([("a b c",), ("d",)], "text string")
    assert all(abs(np.linalg.norm(r["embedding"]) - 1) < 1e-6 and r["dim"] == 32 for r in C.embed(df, dim=32).collect())
    with pytest.raises(Exception, match="cannot embed"):
        C.embed(spark.createDataFrame([("  ",)], "text string")).collect()


# ---- graph ---------------------------------------------------------------------------------------

ANSWER = """{"entities": [{"name": "Lutjanus peru", "type": "Species", "aliases": ["huachinango"], "properties": {"k": "1"}}, {"name": "Gulf", "type": "Location"},
  {"name": "X", "type": "Bogus"}], "relations": [{"subject": "Huachinango", "relation": "found_in", "object": "gulf", "confidence": 1.7, "context": "c"},
  {"subject": "Lutjanus peru", "relation": "eats", "object": "Gulf"}, {"subject": "Lutjanus peru", "relation": "studies", "object": "missing"}]}"""


def extractions(spark, *raws):
    return spark.createDataFrame([(f"c{i}", f"p{i}", i, r) for i, r in enumerate(raws)], "chunk_id string, paper_id string, ord bigint, raw string")


def test_build_graph_follows_the_rules(spark):
    x = extractions(spark, ANSWER, "```json\n" + ANSWER.replace('"k": "1"', '"k": "2"') + "\n```", "not json", ANSWER + "}", "[1, 2]")
    g = G.build_graph(x)
    assert {r["entity_id"] for r in g.entities.collect()} == {"species::lutjanus_peru", "location::gulf"}
    relation = g.relations.collect()
    assert len(relation) == 1 and relation[0]["confidence"] == 1.0 and relation[0]["relation_id"] == "species::lutjanus_peru::found_in::location::gulf"
    assert g.evidence.count() == 2 and g.processed.count() == 5
    assert g.properties.first()["value"] == "2"


NAMED_TWICE = """{"entities": [{"name": " Peru\\u00e1\\t", "type": "Species ", "aliases": ["gulf", null, "Peru\\u00e1"]}, null, {"name": "Gulf", "type": "Location"}, {"name": "GULF", "type": "Concept"}],
  "relations": [{"subject": "PERU\\u00c1", "relation": "found_in", "object": "gulf"}, null, {"subject": null, "relation": "studies", "object": "gulf"}]}"""


def test_relations_of_a_lone_answer_are_resolved_in_its_row(spark):
    x = extractions(spark, ANSWER, "not json", NAMED_TWICE, None, "{}", '{"entities": []} {}')
    answers = cut_lineage(G.read_answers(x))
    found = G.raw_relations(answers)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "from_json" not in plan
    by_name = G.raw_relations(x, G.raw_entities(x))
    assert found.columns == by_name.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, by_name.collect()))
    assert {(r["chunk_id"], r["pos"], r["relation_id"]) for r in found.collect()} == {
        ("c0", 0, "species::lutjanus_peru::found_in::location::gulf"), ("c2", 0, "species::perua::found_in::concept::gulf")}


def test_answers_of_one_chunk_share_their_names(spark):
    rows = [("c", "p", 0, ANSWER.replace('"relations"', '"others"')), ("c", "p", 1, ANSWER.replace('"entities"', '"others"')), (None, "p", 2, ANSWER), ("d", "q", 3, ANSWER)]
    x = spark.createDataFrame(rows, "chunk_id string, paper_id string, ord bigint, raw string")
    found = sorted(map(tuple, G.raw_relations(x).collect()))
    assert found == sorted(map(tuple, G.raw_relations(x, G.raw_entities(x)).collect()))
    assert [(r[0], r[2]) for r in found] == [("c", 1), ("d", 3)]


def test_strip_and_ascii_of_all_kinds_of_text(spark):
    texts = [None, "", " plain ", "\u3000\u00a0\tx\u2003y\u0085\r\n", "\u200bz", "\u00c1 \ufb01", "\u4e2d"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", X.strip("t").alias("s"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("w"), X.to_ascii("t").alias("a"), X.to_ascii_each(F.array("t", F.lit("\u00e9"))).alias("l"),
                    X.to_ascii_each(F.when(F.col("i") > 0, F.array().cast("array<string>"))).alias("e")).orderBy("i").collect()
    assert [r["s"] for r in got] == [r["w"] for r in got] and got[3]["s"] == "x\u2003y"
    assert [r["a"] for r in got] == [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert [r["l"] for r in got] == [[r["a"], "e"] for r in got] and [r["e"] for r in got] == [None] + [[]] * 6


def test_update_skips_processed_chunks_and_equals_one_build(spark):
    first, both = extractions(spark, ANSWER), extractions(spark, ANSWER, ANSWER.replace("Gulf", "Bay").replace("gulf", "bay"))
    updated, whole = G.update_graph(G.build_graph(first), both), G.build_graph(both)
    for name, table in whole.tables().items():
        assert sorted(map(tuple, updated.tables()[name].select(table.columns).collect())) == sorted(map(tuple, table.collect())), name


def star(spark):
    e = spark.createDataFrame([("a", "Species", "Lutjanus peru"), ("b", "Location", "Gulf"), ("c", "Species", "peru"), ("d", "Concept", "Lonely")], "entity_id string, entity_type string, name string")
    al = spark.createDataFrame([("a", [0], "snapper"), ("a", [1], "red snapper"), ("b", [0], "GC")], "entity_id string, place array<bigint>, alias string")
    r = spark.createDataFrame([("r1", "a", "found_in", "b", 0.5), ("r2", "a", "studies", "b", 0.5), ("r3", "c", "found_in", "b", 1.0), ("r4", "c", "studies", "c", 1.0)], "relation_id string, subject_id string, relation_type string, object_id string, confidence double")
    return e, al, r


def test_degree_flavours(spark):
    _, _, r = star(spark)
    assert {x["entity_id"]: x["degree"] for x in G.degree(r).collect()} == {"a": 1, "b": 2, "c": 3}
    assert {x["entity_id"]: x["degree"] for x in G.degree(r, collapse=False).collect()} == {"a": 2, "b": 3, "c": 3}


def test_entity_search_scores(spark):
    e, al, r = star(spark)
    terms = spark.createDataFrame([(1, "peru"), (2, "red snapper"), (3, "SNAPPER"), (4, "gc"), (5, "zzz"), (6, "l")], "term_id int, term string")
    got = {}
    for x in G.search_entities(terms, e, al, G.degree(r)).orderBy("term_id", "rank").collect():
        got.setdefault(x["term_id"], []).append((x["entity_id"], x["score"]))
    assert got == {1: [("c", 1.03), ("a", 0.81)], 2: [("a", 0.91)], 3: [("a", 0.91)], 4: [("b", 0.92)], 6: [("b", 0.82), ("a", 0.81), ("d", 0.8)]}
    assert {x["entity_id"] for x in G.search_entities(terms, e, al, G.degree(r), types=["Location"]).collect()} == {"b"}


def test_search_of_a_stored_graph(spark):
    first = extractions(spark, ANSWER.replace("1.7", '"0.25"'))
    graph = G.update_graph(G.build_graph(first), extractions(spark, "", ANSWER.replace("huachinango", "guachi")))
    path = work_path(spark, "graph")
    write_graph(graph, path)
    g = read_graph(spark, path)
    assert g.relations.first()["confidence"] == 0.25
    asked = spark.createDataFrame([("q", "Where does Guachi live?"), ("r", "nothing known")], "query_id string, question string")
    linked = G.link_questions(asked, g.entities, g.aliases, G.degree(g.relations)).collect()
    assert [(r["query_id"], r["entity_id"]) for r in linked] == [("q", "species::lutjanus_peru")]
    assert [r["alias"] for r in g.aliases.orderBy("place").collect()] == ["huachinango", "guachi"]
    hits = spark.createDataFrame([("q", "c0", 1, 0.5, "the text", "", 2000, ["A", "B", "C", "D"], 3, "p0")], "query_id string, chunk_id string, rank int, score double, text string, title string, year int, authors array<string>, page_number int, paper_id string")
    lines = G.graph_search(asked, g.entities, g.aliases, g.mentions, g.relations, hits).orderBy(F.desc("section"), "rank", "part", "pos").collect()
    assert [r["line"] for r in lines if r["query_id"] == "r"] == ["No se encontraron fragmentos relevantes en el índice."]
    own = [r["line"] for r in lines if r["query_id"] == "q"]
    assert "### Entidad: Lutjanus peru (Species)" in own and "Relaciones:" in own and "  - [found_in] Gulf (Location)  [conf=0.25]" in own
    assert own[-3:] == ["### Fragmento 1 [score=0.500, p.3]", "**Fuente:** p0 (2000) — A, B, C et al.", "the text"]


@pytest.mark.parametrize("hops", [1, 2, 3, 6])
def test_neighborhood_of_many_seeds(spark, hops):
    rng = random.Random(hops)
    pairs = {(f"n{rng.randrange(40)}", f"n{rng.randrange(120)}") for _ in range(150)} | {("hub", f"n{i}") for i in range(60)}
    r = spark.createDataFrame([(f"r{i}", a, b) for i, (a, b) in enumerate(sorted(pairs))], "relation_id string, subject_id string, object_id string")
    seeds = [f"n{i}" for i in range(130)] + ["alone", "hub"]
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = set()
    for seed in seeds:
        seen, front = {seed}, {seed}
        want.add((seed, seed, 0))
        for hop in range(1, hops + 1):
            front = {y for x in front for y in near.get(x, ())} - seen
            seen |= front
            want |= {(seed, y, hop) for y in front}
    df = spark.createDataFrame([(x,) for x in [*seeds, seeds[0]]], "entity_id string").repartition(3)
    got = G.neighborhood(r, df, hops).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


@pytest.mark.parametrize("hops", [0, 1, 2])
def test_inside_relations_equal_both_lookups(spark, monkeypatch, hops):
    """Relations with repeats, loops, nulls and triangles; none but names of ends is looked up among the farthest nodes."""
    rng = np.random.default_rng(3)
    rows = [(f"n{a}", f"n{b}", k % 3) for k, (a, b) in enumerate(rng.integers(0, 25, (45, 2)).tolist())]
    rows += [("n1", "n1", 7), ("n2", None, 8), (None, "n2", 9), rows[0], (rows[0][0], rows[0][1], 5)]
    r = spark.createDataFrame(rows, "subject_id string, object_id string, confidence int")
    seeds = spark.createDataFrame([(f"n{i}",) for i in (1, 2, 3, 9, 99)], "entity_id string")
    want = G.neighborhood_relations(r, G.neighborhood(r, seeds, hops)).select("seed", *r.columns).collect()
    looked, lookup = [], G.neighborhood_relations
    monkeypatch.setattr(G, "neighborhood_relations", lambda relations, visited: looked.append(relations.columns) or lookup(relations, visited))
    got = G.inside_relations(r, seeds, hops).select("seed", *r.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr) and (hops == 0 or len(want) > 10)
    assert looked == [["subject_id", "object_id"]]


def test_neighborhood_by_hops(spark):
    _, _, r = star(spark)
    seeds = spark.createDataFrame([("a",)], "entity_id string")
    assert {(x["node"], x["hop"]) for x in G.neighborhood(r, seeds, 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert G.neighborhood_relations(r, G.neighborhood(r, seeds, 1)).count() == 2


# ---- articles, parameters, fusion ----------------------------------------------------------------


def test_link_titles_accepts_the_first_best(spark):
    failed = spark.createDataFrame([(1, "Growth of Lutjanus peru"), (2, "Something else")], "row_id int, title string")
    candidates = spark.createDataFrame(
        [(1, 0, "Growth of <i>Lutjanus</i> peru", None), (1, 1, "growth of lutjanus peru", None), (1, 2, "Other", "u"), (2, 0, "Unrelated words", "u")], "row_id int, pos int, candidate_title string, oa_url string"
    )
    got = {r["row_id"]: (r["pos"], round(r["score"], 4), r["accepted"]) for r in A.link_titles(failed, candidates).collect()}
    assert got[1] == (0, 1.15, True) and got[2][2] is False


def test_best_parameter_and_summary(spark):
    growth = spark.createDataFrame([(1, 0.18, 52.3, -0.5, "120", "0", "Gulf of California", None, 1), (1, 0.3, -999.0, None, None, "1", "Atlantic", None, 2), (2, 0.0, 10.0, 0.1, "5", "2", "Atlantic", None, 3)],
                                  "SpecCode int, K double, Loo double, to double, N string, Sex string, Locality string, Growth_f_name string, ord int")
    facts = Q.unpivot_parameters({"growth": growth})
    assert facts.count() == 7
    assert Q.unpivot_parameters({"growth": growth}, legacy_zero=True).count() == 6
    wide = {r["SpecCode"]: r for r in Q.parameter_summary(facts).collect()}
    assert wide[1]["K"] == 0.18 and wide[1]["QB"] is None and wide[1]["QB_confidence"] == "sin datos" and wide[2]["K"] == 0.0
    kept = {(r["SpecCode"], r["locality"]) for r in Q.filter_ecosystem(facts, "gulf of CALIFORNIA").collect()}
    assert kept == {(1, "Gulf of California"), (2, "Atlantic")}


def test_fusion_and_reserved_slots(spark):
    row = "query_id bigint, chunk_id string, seq bigint, score double, rank int"
    sem = spark.createDataFrame([(1, "a", 0, 0.9, 1), (1, "b", 1, 0.8, 2)], row)
    kw = spark.createDataFrame([(1, "b", 1, 9.0, 1), (1, "t", 2, 8.0, 2)], row)
    table = H.table_channel(spark.createDataFrame([(1, "t", 2, 20.0, 1), (1, "u", 3, 4.0, 2)], row), spark.createDataFrame([(1, "u", 3, 0.9, 1), (1, "t", 2, 0.8, 2)], row))
    assert [(r["chunk_id"], round(r["inner_score"], 6)) for r in table.collect()] == [("t", round(1 / 61 + 0.5 / 62, 6))]
    fused = H.rrf_fuse([sem, kw, table], [0.6, 0.4, 0.5])
    top = H.reserve_slots(fused, table, 2).orderBy("rank").collect()
    assert [(r["chunk_id"], r["reserved"]) for r in top] == [("t", True), ("b", False)]


def test_missing_species_column_is_an_error(spark, tmp_path):
    from scholia.sources.files import read_species

    (tmp_path / "t.csv").write_text("name\nx\n")
    with pytest.raises(ValueError):
        read_species(spark, str(tmp_path / "t.csv"))


# ---- streams -------------------------------------------------------------------------------------


def test_ingest_stream_equals_batch(spark):
    from scholia.plans import fixtures as fx
    from scholia.registry import QUERIES, Tables
    from scholia.streaming.ingest import document_chunks

    path = "/root/testdata/sf0.001"
    import __spark_entry__  # noqa: F401 - registers the queries

    streamed = QUERIES["t01_ingest_stream"](spark, path)
    batch = document_chunks(fx.docs(Tables(spark, path)))
    cols = batch.columns
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.collect()))


def same_graph(one, other):
    for name, table in one.tables().items():
        columns = [c for c in table.columns if c != "place"]
        assert sorted(map(repr, other.tables()[name].select(*columns).collect())) == sorted(map(repr, table.select(*columns).collect())), name
    order = lambda g: [(r["entity_id"], r["alias"]) for r in g.aliases.orderBy("entity_id", "place").collect()]
    assert order(one) == order(other)


def test_graph_stream_versions(spark):
    from scholia.session import work_path
    from scholia.sources.graph_log import read_graph_log
    from scholia.streaming.ingest import graph_stream

    source, target, checkpoint = (work_path(spark, n) for n in ("answers", "graph", "offsets"))
    schema = "chunk_id string, paper_id string, ord bigint, raw string"
    for i in range(2):
        extractions(spark, *([ANSWER] * (i + 1))).write.mode("append").parquet(source)
        graph_stream(spark, source, schema, target, checkpoint).awaitTermination()
    g = read_graph_log(spark, target, 1)
    assert g.processed.count() == 2 and g.entities.count() == 2
    # A lost checkpoint: everything arrives again, goes on from the last version, and adds nothing.
    graph_stream(spark, source, schema, target, checkpoint + "-new").awaitTermination()
    same_graph(read_graph_log(spark, target), g)


def answers_of(spark, keys):
    raw = '{"entities":[{"name":"A%d","type":"Species"},{"name":"B","type":"Author"}],"relations":[{"subject":"B","relation":"studies","object":"a%d"}]}'
    return spark.createDataFrame([(f"c{i}", "p", i, raw % (i, i)) for i in keys], "chunk_id string, paper_id string, ord bigint, raw string")


def test_batches_leave_no_staged_tables(spark):
    """Raw answers are read once and never written again, and what a version was made from goes when it is whole."""
    from scholia import session
    from scholia.sources import graph_log as L

    path = session.work_path(spark, "log")
    before = list(session._STAGED)
    L.append_graph(spark, path, answers_of(spark, range(4)), "a")
    L.append_graph(spark, path, answers_of(spark, range(9)), "b")
    left = [spark.read.parquet(p).columns for p in session._STAGED if p not in before]
    assert all(columns == ["chunk_id"] for columns in left)  # chunks with several answers: none here
    g = L.read_graph_log(spark, path)
    assert g.entities.count() == 10 and g.relations.count() == 9 and g.processed.count() == 9


def test_graph_search_stages_neither_answers_nor_chunks(spark, monkeypatch):
    from scholia import session
    from scholia.plans import q_graph
    from scholia.registry import Tables

    written, cut = [], session.cut_lineage
    monkeypatch.setattr(q_graph, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    before = list(session._STAGED)
    assert q_graph.g07(Tables(spark, "/root/testdata/sf0.001")).columns
    assert not any({"raw", "text", "embedding"} & set(columns) for columns in written)
    left = [set(spark.read.parquet(p).columns) for p in session._STAGED if p not in before]
    assert not any({"entities", "snippet"} & columns for columns in left)


def test_graph_log_is_the_graph_of_all_batches(spark):
    from scholia.session import work_path
    from scholia.sources import graph_log as L

    def answer(i):
        alias, depth = f"a{i % 3}", str(i)
        entities = [{"name": n, "type": "Species", "aliases": [alias, f"z{i}"], "properties": {"depth": depth}} for n in ("Cod", f"Fish {i % 2}")]
        relations = [{"subject": "Cod", "relation": "found_in", "object": f"Fish {i % 2}", "confidence": i / 10, "context": f"c{i}"}]
        return json.dumps({"entities": entities, "relations": relations})

    path, rows = work_path(spark, "graph-log"), [(f"c{i}", f"p{i % 2}", i, answer(i)) for i in range(7)]
    frame = lambda some: spark.createDataFrame(some, "chunk_id string, paper_id string, ord bigint, raw string")
    want = None
    for i in range(5):
        batch = frame(rows[max(0, i - 1): i + 2])  # repeats chunks of the batches before
        want = G.build_graph(batch) if want is None else G.update_graph(want, batch)
        want = G.Graph(**{k: cut_lineage(v) for k, v in want.tables().items()})
        if i == 3:  # what a lost batch left behind
            frame(rows).write.parquet(f"{path}/version=3/entities")
        assert L.append_graph(spark, path, batch, f"b{i}") == i
        assert L.append_graph(spark, path, batch, f"b{i}") == i  # runs again
    assert want.entities.count() == 3 and want.relations.count() == 2
    same_graph(L.read_graph_log(spark, path), want)
    # A version holds its own chunks only.
    own = [spark.read.parquet(f"{path}/version={v}/processed").count() for v in range(5)]
    assert own == [2, 1, 1, 1, 1] and spark.read.parquet(f"{path}/version=4/mentions").count() == 2
    assert L.compact_graph(spark, path, 5) == [(0, 4)] and L.compact_graph(spark, path, 5) == []
    same_graph(L.read_graph_log(spark, path), want)
    assert L.cover(L.pieces(spark, path), 4) == [(0, 4)] and L.read_graph_log(spark, path, 1).processed.count() == 3
    assert L.append_graph(spark, path, frame(rows), "rest") == 5 and spark.read.parquet(f"{path}/version=5/processed").count() == 1
    same_graph(L.read_graph_log(spark, path), G.update_graph(want, frame(rows)))


def test_graph_pieces_merge_by_size():
    from scholia.sources.graph_log import cover

    found = [(i, i) for i in range(9)] + [(0, 1), (2, 3), (0, 3), (4, 5), (6, 7), (4, 7), (0, 7)]
    assert cover(found, 8) == [(0, 7), (8, 8)] and cover(found, 6) == [(0, 3), (4, 5), (6, 6)] and cover(found, 0) == [(0, 0)]


def test_ingest_survives_a_lost_checkpoint(spark):
    from scholia.streaming.ingest import ingest_stream

    source, sink, checkpoint = (work_path(spark, n) for n in ("drops", "ingested", "offsets"))
    schema = "paper_id string, text string"
    text = "A line of the text that is long enough to be kept. " * 6
    for i, offsets in enumerate((checkpoint, checkpoint, checkpoint + "-new", checkpoint + "-new")):
        spark.createDataFrame([(f"p{i}", text + str(i)), ("p0", text)], schema).coalesce(1).write.mode("append").parquet(source)
        ingest_stream(spark, source, schema, sink, offsets, files_per_batch=1).awaitTermination()
        done = [r["paper_id"] for r in spark.read.parquet(f"{sink}/done").collect()]
        assert sorted(done) == [f"p{k}" for k in range(i + 1)]
    assert spark.read.parquet(f"{sink}/chunks").select("paper_id").distinct().count() == 4


def test_progress_stream_counts(spark):
    from scholia.session import work_path
    from scholia.streaming.ingest import progress_stream

    path = work_path(spark, "events")
    spark.createDataFrame([("a", True), ("a", False), ("b", True)], "event_type string, found boolean").write.parquet(path)
    progress_stream(spark.readStream.schema("event_type string, found boolean").parquet(path), "progress_test").awaitTermination()
    assert {tuple(r) for r in spark.table("progress_test").collect()} == {("a", 2, 1), ("b", 1, 1)}


def test_stream_keeps_documents_without_language(spark, monkeypatch):
    from scholia.plans import q_streaming

    docs = spark.createDataFrame([(p, " ".join(f"Sentence {k} of {p} stands here." for k in range(80)), lang) for p, lang in [("a", "en"), ("b", "fr"), ("c", None)]], "paper_id string, text string, lang string")
    monkeypatch.setattr(q_streaming.fx, "docs", lambda t: docs)
    got = q_streaming.t01(types.SimpleNamespace(spark=spark))
    assert {r.paper_id for r in got.select("paper_id").collect()} == {"a", "b", "c"}


# ---- bounded memory and moved bytes --------------------------------------------------------------


def test_names_listed_under_pieces_are_never_sent_whole(spark):
    # on disk the list is tens of times smaller than as rows, so its size on disk must not make it a broadcast
    e = spark.createDataFrame([("a", "Location", "Golfo Nuevo"), ("b", "Location", "Nuevo")], "entity_id string, entity_type string, name string")
    none = spark.createDataFrame([], "entity_id string, alias string, place array<bigint>")
    degrees = spark.createDataFrame([("a", 2)], "entity_id string, degree bigint")
    found = G.search_entities(spark.createDataFrame([("t", "nuevo"), ("u", "go")], "term_id string, term string"), e, none, degrees)
    assert "strategy=merge" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["term_id"], r["entity_id"], r["rank"]) for r in found.collect()) == [("t", "a", 2), ("t", "b", 1), ("u", "a", 1)]


def test_lists_of_pieces_that_no_term_looks_up_stay_behind(spark):
    e = spark.createDataFrame([(f"e{i}", "Method", f"r#00{i}") for i in range(30)], "entity_id string, entity_type string, name string")
    none = spark.createDataFrame([], "entity_id string, alias string, place array<bigint>")
    found = G.search_entities(spark.createDataFrame([("t", "R#0017"), ("u", "r#00")], "term_id string, term string"), e, none, spark.createDataFrame([], "entity_id string, degree bigint"))
    assert "LeftSemi, (gram" in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["term_id"], r["rank"], r["entity_id"], r["score"]) for r in found.collect())
    assert got == [("t", 1, "e17", 1.0), *(("u", k, f"e{i}", 0.8) for k, i in enumerate([0, 1, 10, 11, 12], 1))]


def test_tables_that_are_larger_as_rows_are_never_sent_whole(spark):
    from scholia.plans import fixtures as fx

    rows = lambda data, schema: cut_lineage(spark.createDataFrame(data, schema))
    t = types.SimpleNamespace(
        orders=rows([(1, 7), (2, None), (2, None)], "o_orderkey bigint, o_custkey bigint"), part=rows([(5, "red", "BOX")], "p_partkey bigint, p_name string, p_type string"),
        lineitem=rows([(1, 5, 3, 0.1), (1, 5, 3, 0.2), (2, None, 3, 0.1), (9, 5, 3, 0.1)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_discount double"),
    )
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    m, x = fx.mentions(t), fx.extractions(t)
    wanted = [(None, "paper_2"), ("author::7", "paper_1"), ("method::3", "paper_1"), ("method::3", "paper_2"), ("species::5", "paper_1")]
    assert sorted(map(tuple, m.collect()), key=repr) == sorted(wanted, key=repr)
    assert [(r["chunk_id"], r["raw"].count("P5")) for r in x.collect()] == [("chunk_1", 2)]
    e = rows([("species::5", "Species", "red"), ("author::7", "Author", "Ann")], "entity_id string, entity_type string, name string")
    held = G.paper_entities(cut_lineage(m), e)
    assert {(r["paper_id"], r["name"]) for r in held.collect()} == {("paper_1", "red"), ("paper_1", "Ann")}
    assert not any("Broadcast" in plan(df) for df in (m, x, held))
    r = rows([("r1", "author::7", "studies", "species::5", 0.5)], "relation_id string, subject_id string, relation_type string, object_id string, confidence double")
    lines = G.entity_context(e.where("name = 'Ann'"), e, cut_lineage(m), r)
    assert "SortMergeJoin [object_id" in plan(lines)
    assert "  - [studies] red (Species)  [conf=0.50]" in {x["line"] for x in lines.collect()}


def test_postings_move_as_words_and_once_for_all_questions(spark):
    # all numbers but one lie close together, so nearly all chunks are one block; some numbers come twice
    texts = [(i // 2 if i < 20 else i, f"sea w{i % 7} w{i % 3} sea") for i in range(100)] + [(10**9, "sea far")]
    index, saved = saved_index(spark, texts, 4)
    parts = B.posting_blocks(index, 4, most=10)
    assert max(r["n"] for r in parts.collect()) <= 10 and sum(r["n"] for r in parts.collect()) == saved.postings.count()
    assert "collect_list" not in parts._jdf.queryExecution().optimizedPlan().toString()
    q = spark.createDataFrame([(i, f"sea w{i % 7} far") for i in range(20)], "query_id bigint, question string")
    asked = saved.weighted(q)
    plan = saved.best(asked, B.first_blocks(saved.bounds(asked), 3), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan.split("CoGroup")[0] and "CoGroup" in plan
    alone = [(i, x) for i, x in texts if i >= 20]
    index, saved = saved_index(spark, alone, 4)
    assert sorted(map(tuple, bm25_search(saved, q, 3).collect())) == sorted(map(tuple, bm25_search(index, q, 3).collect()))


def test_cells_are_placed_in_slices():
    batch = pa.RecordBatch.from_pydict({"rep": list(range(10_000))})
    parts = list(N.slices([batch, batch.slice(0, 0)], 256))
    assert sum(p.num_rows for p in parts) == 10_000 and max(p.num_rows for p in parts) * 256 * N.LEAD <= N.CELLS


class Held:
    """Stands for a table of documents and keeps the function that runs over its batches."""

    def select(self, *_):
        return self

    def withColumn(self, *_):  # noqa: N802
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        self.run = run
        return self


@pytest.mark.parametrize("cut", [
    C.split_sentences, lambda d: C.chunk_semantic(d, C.hashing_encoder(8)), C.chunk_sliding,
])
def test_documents_of_a_batch_are_cut_in_slices(spark, cut):
    text = "The tide came in over the flats. Nets were set at dawn near the reef. " * 70
    batch = pa.RecordBatch.from_pydict({"paper_id": [f"p{i}" for i in range(1500)], "text": [text if i % 7 else None for i in range(1500)]})
    out = list(cut(Held()).run([batch]))
    assert batch.nbytes > 6_000_000 and max(b.nbytes for b in out) < 5_000_000
    assert len({p for b in out for p in b.column("paper_id").to_pylist()}) == sum(i % 7 > 0 for i in range(1500))


def test_ascii_form_holds_a_slice_of_strings(spark):
    import tracemalloc

    column = pa.array(["Bahía de La Paz " * 500, None, "plain " * 1000, ""] * 1000)
    tracemalloc.start()
    out = X.to_ascii.func(column)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert column.nbytes > 13_000_000 > most and out.take(pa.array([0, 1, 2, 3])).to_pylist() == ["Bahia de La Paz " * 500, None, "plain " * 1000, ""]


def test_studies_of_a_species_meet_in_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_A_TASK", 25)
    lines = [(i, i % 2, i % 3, i % 7, i % 50 + 1.0, 10.0 * i, i % 10 / 100, 0.02, "A") for i in range(600)]
    lines += lines[:5] + [(None, 1, 0, None, None, None, 0.03, None, None)] * 2 + [(7, None, 0, 1, 1.0, 1.0, 0.01, 0.01, "N")]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i) for i in range(3)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(i, f"N{i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    t = Tables(spark, str(tmp_path))
    for table, n in ((fixtures.growth(t), 602), (fixtures.length_weight(t), 602)):
        assert table.count() == n
        tasks = table.select("SpecCode", F.spark_partition_id().alias("task")).distinct()
        assert tasks.select("task").distinct().count() > 4
        assert tasks.groupBy("SpecCode").count().agg(F.max("count")).first()[0] <= fixtures.SPREAD
