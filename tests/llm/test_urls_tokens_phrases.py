"""URL filters, cross-tokenizer alignment and phrase collocations against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scholia.llm import alignment, collocations, urls

# ---- URL filters

ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://ORG/x", "http://a.ORG", "http://a.org?x=/de/", "https://sub.example.org/es/1", "http://example.org/en/12/é",
    "http://notexample.org/es/1", "http://com/de/", "http://x.com/de", "http://x.com/fr/#a", "a://b://c.org/", "http://Ä.org/", "http://x.com:80/de/1",
    "line\n://q.org/\nx?y", "http://x.net/" + "a1%20" * 5000, "://org/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def best_rule(rules, host, path):
    fits = [(len(r), r, v) for v, r in rules for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_rules(spark):
    rows = [(i, u, "host", 1.0) for i, u in enumerate([*ODD_URLS, *ODD_URLS[5:8]])] + [(None, "http://z.org/", "", 0.0)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string, label double"), urls.RULES).collect()
    assert len(out) == len(rows)
    want = {i: (*parts(u), *best_rule(urls.RULES, *parts(u))) for i, u, _, _ in rows}
    for r in out:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.filter_urls(none, urls.RULES).count() == 0
    # without a rule that fits, or with one label only, there is nothing to learn
    alone = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.de/")], "page_id bigint, url string")
    assert {r.verdict for r in urls.filter_urls(alone, []).collect()} == {"allow"}
    assert {r.verdict for r in urls.filter_urls(alone, [("block", "net/")]).collect()} == {"block"}


def test_url_features(spark):
    given = spark.createDataFrame([(u,) for u in ODD_URLS], "url string").withColumns({"host": urls.host_of(F.col("url")), "path": urls.path_of(F.col("url"))})

    def bits(s):
        return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0

    for r in urls.lexical(given).collect():
        u = r.url or ""
        assert r.length == len(u) and r.depth == len([x for x in r.path.split("/") if x]) and r.labels == len([x for x in r.host.split(".") if x])
        assert r.digit_ratio == pytest.approx(len(re.findall("[0-9]", u)) / max(1, len(u)))
        assert r.entropy == pytest.approx(bits(u), abs=1e-9) and r.host_entropy == pytest.approx(bits(r.host), abs=1e-9)
        asked = re.search(r"^[^?#]*\?([^#]*)", u)
        assert r.parameters == (len([x for x in re.split("[&;]", asked[1]) if x]) if asked else 0)
        assert r.tld == r.host.rsplit(".", 1)[-1] and r.domain == ".".join(r.host.split(".")[-2:])


def test_url_trees_on_held_out_urls(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8)))

    def made(bad):
        host = f"{word()}{rnd.randint(100, 9999)}-{word()}.top" if bad and rnd.random() < 0.6 else f"www.{word()}.com"
        asked = "?" + "&".join(f"{word()}={rnd.randint(0, 10 ** 9)}" for _ in range(rnd.randint(3, 7))) if bad else ""
        return f"http://{host}/" + "/".join(word() for _ in range(rnd.randint(1, 3))) + asked

    labelled = [(made(bad), float(bad)) for _ in range(600) for bad in (0, 1)] + [(None, 1.0), ("http://x.com/", None)]
    pages = [(i, made(i % 2), i % 2) for i in range(400)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, label int")
    known = spark.createDataFrame(labelled, "url string, label double")
    out = urls.filter_urls(df, [], known, urls.Settings(trees=5, rows=500)).collect()
    right = [(r.verdict == "block") == bool(pages[r.page_id][2]) for r in out]
    assert len(right) == 400 and np.mean(right) > 0.95


# ---- alignment

TEXTS = [
    None, "", " ", "  ", "a", "Hello  world ", " lead", "tab\tand\n\nnew\r\n lines \n x", "naïve café 🎉🎉 日本語テキスト ①Ａ", "x<|endoftext|>y <s> </s> <unk>",
    "<0x41> 0x41", "under\u2581score", "a\u00a0b \u2003c", "e\u0301 e \u0301", "\x1c \x1f a", "".join(map(chr, range(1, 300))), "word " * 3000, "ab" * 3000, "x\u0000y", "  a   b  ",
    "it's we'll 'S 12 345  67", "a \u0085 b", "🏳️‍🌈 👩‍👩‍👧",
]


def brute_alignment(texts):
    a_path, b_path = alignment.default_paths()
    tok = Tokenizer.from_file(a_path)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    byte_of = alignment.byte_symbols()
    vocab = {i: s for s, i in tok.get_vocab().items()}
    out, pairs = [], Counter()
    for text in texts:
        data = (" " + (text or "")).encode()
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        a_bytes = [bytes(byte_of[c] for c in vocab[i]) for i in a]
        names = [sp.IdToPiece(i) for i in b]
        b_bytes = [bytes([int(x[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", x) else x.replace("\u2581", " ").encode() for x in names]
        if not text or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            out.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        where = {e: i for i, e in enumerate(ends_a)}
        links = [(a[where[e]], b[j]) for j, e in enumerate(ends_b) if e in where]
        groups, last_a, last_b = [], 0, 0
        for j, e in enumerate(ends_b):
            if e in where:
                groups.append(",".join(map(str, a[last_a:where[e] + 1])) + "|" + ",".join(map(str, b[last_b:j + 1])))
                last_a, last_b = where[e] + 1, j + 1
        pairs.update(links)
        out.append((len(a), len(b), links, ";".join(groups)))
    most = {}
    for (_, b), n in pairs.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "") if x is None else
        (x[0], x[1], len(x[2]), len(x[2]), sum(pairs[p] == most[p[1]] for p in x[2]), sum(pairs[p] for p in x[2]), hashlib.sha256(x[3].encode()).hexdigest()) for x in out
    ]


def test_alignment(spark, monkeypatch):
    rnd = random.Random(3)
    some = ["a", "é", " ", "  ", "日", "🎉", "the", "12", "'s", "\n", "\u0301", "word", "-", ".", "\t", "ß", "\u00a0"]
    texts = TEXTS + ["".join(rnd.choices(some, k=rnd.randint(1, 30))) for _ in range(150)] + TEXTS[4:6]
    monkeypatch.setattr(alignment, "ROWS", 7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("links", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.cross_alignment(df, *alignment.default_paths()).collect()}
    want = brute_alignment(texts)
    for i, text in enumerate(texts):
        assert got[i] == want[i], text
    assert sum(w[0] > 0 for w in want) > 100
    assert alignment.cross_alignment(df.where("false"), *alignment.default_paths()).count() == 0
    assert alignment.cross_alignment(df.select(F.lit(None).cast("bigint").alias("doc_id"), "text").limit(3), *alignment.default_paths()).count() == 3


def test_remembered_segments_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "KEEP_CHARS", 50)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    texts = ["one two three four five six seven", "eight nine ten eleven", "one eight", "", "two nine"]
    first = pair.texts(texts)
    pair.texts(["a"])
    assert sum(map(len, pair.known)) <= 50
    assert [pair.texts([t])[0] for t in texts] == first


def test_segments_are_aligned_together():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    parts = [" naïve", " x<s>", "\nqzxvw", "  ", " 日本🎉", " the", " zzqqkx"]
    odd = [" \u2581under"]  # B spells it with spaces: no tokens
    together = pair.align(odd + parts + odd)
    assert together[0] is None and together[-1] is None and None not in together[1:-1]
    assert together[1:-1] == [pair.align([s])[0] for s in parts]
    want = brute_alignment([s.removeprefix(" ") for s in parts if s[0] == " "])
    got = [(x[0], x[1], len(x[3]) // 4, hashlib.sha256(x[2]).hexdigest()) for s, x in zip(parts, together[1:-1]) if s[0] == " "]
    assert got == [(w[0], w[1], w[3], w[6]) for w in want]
    assert pair.align([]) == []


# ---- collocations


def brute_pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def brute_collocations(rows, s):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in brute_pieces(text):
            n[lang] += len(words)
            for k in range(1, s.longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        keep = {p: a for p, a in counts.items() if len(p) > 1 and a >= s.least}
        for p, a in keep.items():
            if any(len(q) > len(p) and 100 * b >= s.share * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in keep.items()):
                continue
            score, k = min((s.scale * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: s.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("settings", [
    collocations.Settings(least=4, shard_words=60, window=50), collocations.Settings(least=3, longest=3, shard_words=10_000, top=7),
    collocations.Settings(least=2, longest=7, share=60, shard_words=25, window=30), collocations.Settings(least=2, longest=2, shard_words=40),
])
def test_collocations(spark, settings):
    rnd = random.Random(11)
    words = ["a", "b", "C", "d\u00e9", "\u00c9", "x\x1cy", "the", "THE", "n\u00a0o"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?", "\x0b", "\r"]
    texts = ["".join(rnd.choice(words) + rnd.choice(seps) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    texts += [None, "", " ", ".,;", "the a b " * 60, "a" * 200, "\u00e9" * 90 + " b " + "c" * 100 + " a b", texts[0], texts[0], "w " * 50]
    rows = [(rnd.choice(["en", "en", "en", None, "", "d e"]), t) for t in texts]
    df = spark.createDataFrame([(*r, i, 1) for i, r in enumerate(rows)], "lang string, text string, doc_id bigint, n int").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, settings).collect())
    assert got == brute_collocations(rows, settings)
    assert any(r[7] >= 0 for r in got)


def test_phrase_tasks_give_back_memory(spark, monkeypatch):
    from scholia.functions import batches

    docs = spark.createDataFrame([("en", "one two")], "lang string, text string")
    assert "whole_task" in collocations.shards(docs, collocations.Settings())._jdf.queryExecution().analyzed().toString()
    given = []
    monkeypatch.setattr(batches, "give_back", lambda: given.append(1))
    assert batches.tidied_group(lambda left, right: left + right)(1, 2) == 3 and given == [1]


def test_counts_in_shards_go_when_they_are_summed(spark):
    from scholia import session

    before = list(session._STAGED)
    rows = [(i, "en", "the red fox ran home . the red fox ran off") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    counted, totals = collocations.phrase_counts(docs, collocations.Settings(least=5))
    assert {tuple(r["words"]) for r in counted.collect()} >= {("red", "fox"), ("the", "red", "fox", "ran", "home")} and totals.count() == 1
    left = [p for p in session._STAGED if p not in before]
    assert sorted(left) == sorted([counted._staged, totals._staged])


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).count() == 0


def test_windows_count_each_phrase_once():
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choices(["a", "bb", "ccc", " ", " ", "\t", ".", "\n", "d" * 30], k=rnd.randint(0, 80))).encode()
        size, lap = rnd.randint(1, 40), rnd.randint(0, 4)
        count = Counter()
        for sign, part in [x for p, q in collocations.windows(text, size, lap) for x in ((1, p), (-1, q))]:
            for piece in brute_pieces(part.decode()):
                for k in range(1, lap + 2):
                    for i in range(len(piece) - k + 1):
                        count[tuple(piece[i:i + k])] += sign
        want = Counter(tuple(p[i:i + k]) for p in brute_pieces(text.decode()) for k in range(1, lap + 2) for i in range(len(p) - k + 1))
        assert +count == want and not -count


def test_extension_steps_through_the_index():
    """Intervals of both directions hold each phrase's occurrences, however it was reached."""
    rnd = np.random.default_rng(4)
    t = np.r_[0, rnd.integers(0, 4, 300)].astype(np.int32)
    depth = 4
    fwd, rev = collocations.transform(t, depth), collocations.transform(t[::-1], depth)
    size = np.bincount(t)
    lo = (np.cumsum(size) - size)[1:]
    state = {(w,): (int(lo[w - 1]), int(lo[w - 1]), int(size[w])) for w in range(1, len(size))}
    for k in range(2, depth + 1):
        names = list(state)
        a = np.array([state[p] for p in names])
        backwards = k % 2 == 1
        mine, other = (a[:, 0], a[:, 1]) if backwards else (a[:, 1], a[:, 0])
        nxt = {}
        for i, w, at, oth, n in zip(*(x.tolist() for x in collocations.extend(fwd if backwards else rev, mine, other, a[:, 2])), strict=True):
            nxt[(w, *names[i]) if backwards else (*names[i], w)] = (at, oth, n) if backwards else (oth, at, n)
        want = Counter(tuple(t[i:i + k].tolist()) for i in range(len(t) - k + 1) if (t[i:i + k] != 0).all())
        assert {p: s[2] for p, s in nxt.items()} == want
        state = nxt
    order = collocations.suffix_order(t, depth)
    for p, (at, _, n) in state.items():
        assert all(tuple(t[(i + np.arange(depth)) % len(t)].tolist()) == p for i in order[at:at + n].tolist())
