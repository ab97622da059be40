"""Licence statements: a trained paragraph classifier over word n-grams, confirmed against templates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from scholia.llm.common import id_and_text, query, table
from scholia.session import cut_lineage

# How licences are stated, by family.
TEMPLATES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Released under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "Released under the terms of the GNU Lesser General Public License, version 3."],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
}

# Short identifiers in file headers.
SHORT = {
    "agpl": "AGPL-3.0", "apache": "Apache-2.0", "bsd": "BSD-3-Clause", "cc-by": "CC-BY-4.0", "cc-by-nc": "CC-BY-NC-4.0",
    "cc-by-sa": "CC-BY-SA-4.0", "gpl": "GPL-2.0", "lgpl": "LGPL-2.1", "mit": "MIT", "mpl": "MPL-2.0",
}
for _family, _short in SHORT.items():
    TEMPLATES[_family].append(f"SPDX-License-Identifier: {_short}")

# Statements of licences that are none of the families; they teach what any statement reads like.
OTHERS = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice appears in all copies.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "Distributed under the Boost Software License, Version 1.0.",
    "This is free and unencumbered software released into the public domain.",
    "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability and fitness for a particular purpose.",
    "Licensed under the Academic Free License version 3.0.",
    "This file is released under the terms of the Microsoft Public License.",
    "SPDX-License-Identifier: ISC",
]

# Prose with the words of licences that grants nothing.
PROSE = [
    "She renewed her driving licence and paid the fee at the public office.",
    "The council may not grant permission to build without the terms being met.",
    "He asked for permission to use the library and was refused without a reason.",
    "Free software has changed how a person works with source files and documentation.",
    "The copyright of the photograph was sold to a publisher, and the dispute went to court.",
    "A new version of the program is released every year under the general manager.",
    "The licensed restaurant serves the public from noon, subject to the following conditions.",
    "You can use the following forms to modify the work, but not without the source file.",
    "The redistribution of wealth was the subject of the public debate.",
    "They obtained a fishing licence, version two of the form, under the law of the state.",
    "It was cold or warm, early or late, and nobody knew whether to stay or to go.",
    "Call before noon or after six, or write to the office in any month or year.",
    "Is it red or blue, or and this is more likely, green or grey with or without a stripe?",
    "Which licence should I choose for my project, and does it matter to the people who use it?",
    "The program was provided free of charge to any person who attended the course.",
]


@dataclass(frozen=True)
class Settings:
    """``negatives``: paragraphs of the corpus (chosen by a hash) that the model learns as no licence, at most; ``hard``:
    of those that speak of licences, at most."""

    negatives: int = 4_000
    hard: int = 500
    longest: int = 5_000  # words of a negative, so that the sample is bounded in size too
    variants: int = 40  # versions of each template with words left out or exchanged
    steps: int = 400
    rate: float = 0.5
    l1: float = 0.0006
    sure: float = 0.9  # part of the held-out statements that a threshold must accept
    foreign: float = 0.95  # part of the statements of a left-out family that a family threshold is to refuse
    few: float = 0.25  # part of any template's n-grams that a paragraph speaking of licences has less of, to be a negative
    alike: float = 0.5  # part of a template's n-grams that confirms a prediction
    seed: int = 5


def words_of(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """Distinct words, pairs and triples of neighbours; a null word list has none."""

    def neighbours(k: int) -> Column:
        start = F.sequence(F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(1)))
        some = F.transform(start, lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))
        return F.when(F.size(words) >= k, some).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(words, neighbours(2), neighbours(3)))


def plain_words(text: str) -> list[str]:
    return "".join(c.lower() if c.isalnum() else " " for c in text).split()


def plain_grams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)))


@dataclass(frozen=True)
class Model:
    """One sparse weight table a family, its constant, and the probability from which it is believed; ``UNKNOWN`` is the
    class of all statements, whatever their family.

    ``telling`` n-grams with a weight stand in statements of one family only. A family is believed only if the paragraph has one:
    wording that families share doesn't tell which it is. ``marks`` are words one of which a paragraph must have: of the other words no n-grams together lift any
    class to one half.
    """

    weights: dict[str, dict[str, float]]
    constant: dict[str, float]
    threshold: dict[str, float]
    telling: dict[str, set[str]]
    marks: tuple[str, ...] = ()


UNKNOWN = "unknown"


def versions(text: str, s: Settings, spare: list[str], rng: np.random.Generator) -> list[list[str]]:
    """The words of a statement, then versions with words left out, exchanged or put behind; every second one has none behind."""
    words, out = plain_words(text), []
    for v in range(s.variants):
        drop = rng.random(len(words)) < (0.0 if v == 0 else 0.08)
        swap = rng.random(len(words)) < (0.0 if v == 0 else 0.04)
        kept = [spare[rng.integers(len(spare))] if x else w for w, d, x in zip(words, drop, swap, strict=True) if not d]
        out.append(kept + [spare[i] for i in rng.integers(len(spare), size=0 if v % 2 == 0 else int(rng.integers(1, 6)))])
    return out


def fit(x: np.ndarray, y: np.ndarray, use: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and constants of a class a column by proximal gradient steps; ``use`` tells how often a class learns from a row.
    Both sides of a class weigh the same."""
    yes, no = y * use, (1 - y) * use
    balance = (yes * (0.5 / np.maximum(yes.sum(0), 1)) + no * (0.5 / np.maximum(no.sum(0), 1))).astype(np.float32)
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.full(y.shape[1], -2.0, np.float32)
    for _ in range(s.steps):
        g = (probability(x, w, b) - y) * balance
        w -= s.rate * (x.T @ g)
        w = np.sign(w) * np.maximum(np.abs(w) - s.rate * s.l1, 0)
        b -= s.rate * g.sum(0)
    return w, b


def exclusive(templates: dict[str, list[str]]) -> dict[str, set[str]]:
    """The n-grams that only one family's statements have."""
    grams = {f: {g for t in ts for g in plain_grams(plain_words(t))} for f, ts in {**templates, UNKNOWN: OTHERS}.items()}
    return {f: gs.difference(*[o for g, o in grams.items() if g != f]) for f, gs in grams.items()}


def told(x: np.ndarray, w: np.ndarray, vocab: dict[str, int], templates: dict[str, list[str]], names: list[str]) -> np.ndarray:
    """Whether a row has a telling n-gram of a family; the class of all statements needs none."""
    own = np.zeros(w.shape, np.float32)
    for f, grams in exclusive(templates).items():
        own[[vocab[g] for g in grams if g in vocab], names.index(f)] = 1
    own[:, names.index(UNKNOWN)] = 0
    has = x @ (own * (w > 0)) > 0
    has[:, names.index(UNKNOWN)] = True
    return has


def probability(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))


def train(negatives: list[list[str]], s: Settings = Settings(), hard: list[list[str]] = (), templates: dict[str, list[str]] = TEMPLATES) -> Model:
    """One-against-rest logistic regression with an L1 penalty, for each family and for statements of any licence.

    Learns from versions of the templates, of other licences' statements and of prose about licences, and from paragraphs of the corpus:
    ``negatives`` name no licence; ``hard`` ones speak of licences and may be statements of a licence that is no
    family, so the class of all statements doesn't learn from them. Every fourth row is held out.

    Thresholds are calibrated on statements that no model has seen. Each family is left out in turn, and what
    the others' models say of it is what they say of an unknown licence: a family is believed from the probability on that
    ``foreign`` of the left-out statements and all held-out negatives miss. A statement without a believed
    family is unknown from the probability on that all held-out negatives miss. No threshold refuses more than
    ``1 - sure`` of the held-out statements of its own family, or of the left-out statements.
    """
    rng = np.random.default_rng(s.seed)
    spare = sorted({w for n in negatives[:500] for w in n}) or ["thing"]
    texts: list[list[str]] = []
    family: list[str] = []
    for name, statement in [*((f, t) for f, ts in templates.items() for t in ts), *((UNKNOWN, t) for t in OTHERS), *(("", t) for t in PROSE)]:
        texts += versions(statement, s, spare, rng)
        family += [name] * s.variants
    made = len(texts)
    texts += [*negatives, *hard]
    family += [""] * len(negatives) + ["hard"] * len(hard)
    out = np.r_[np.arange(made) % s.variants, np.arange(len(negatives) + len(hard))] % 4 == 3
    seen: dict[str, int] = {}
    for t, f in zip(texts[:made], family, strict=False):
        for g in plain_grams(t) if f else ():
            seen[g] = seen.get(g, 0) + 1
    vocab = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n >= 5))}
    # Paragraphs of the corpus that have the same n-grams of the vocabulary are one row that counts as often.
    rows: dict[tuple, int] = {}
    for r, (t, f, o) in enumerate(zip(texts, family, out.tolist(), strict=True)):
        key = (f, o, r if r < made else -1, tuple(sorted(vocab[g] for g in plain_grams(t) if g in vocab)))
        rows[key] = rows.get(key, 0) + 1
    x = np.zeros((len(rows), len(vocab)), np.float32)
    for r, key in enumerate(rows):
        x[r, list(key[3])] = 1
    fam, out, names = np.array([k[0] for k in rows]), np.array([k[1] for k in rows]), [*templates, UNKNOWN]
    statement = ~np.isin(fam, ["", "hard"])
    y = np.stack([*(fam == f for f in templates), statement], 1).astype(np.float32)
    use = np.repeat(np.array(list(rows.values()), np.float32)[:, None], len(names), 1)
    use[fam == "hard", -1] = 0
    # All models at once, so that the rows are gone through once a step: the one of all families, then those without one.
    left_out = [None, *templates]
    uses = np.concatenate([use * (fam != f)[:, None] for f in left_out], 1)
    fits = fit(x[~out], np.tile(y[~out], len(left_out)), uses[~out], s)
    models = list(zip(np.split(fits[0], len(left_out), 1), np.split(fits[1], len(left_out)), strict=True))
    w, b = models[0]
    p = probability(x, w, b) * told(x, w, vocab, templates, names)
    left = np.zeros_like(p)  # of each statement, what models say that know nothing of its family
    for f, (w_f, b_f) in zip(templates, models[1:], strict=True):
        rest = {g: ts for g, ts in templates.items() if g != f}
        left[fam == f] = probability(x[fam == f], w_f, b_f) * told(x[fam == f], w_f, vocab, rest, names)
    known = np.isin(fam, list(templates))
    threshold = {}
    for i, f in enumerate(names):
        none = out & (fam == "") if f == UNKNOWN else out & ~known
        own = left[known, i] if f == UNKNOWN else p[out & (fam == f), i]
        lowest = max(0.5, float(p[none, i].max(initial=0)) + 1e-6)
        if f != UNKNOWN:
            lowest = max(lowest, float(np.quantile(left[known & (fam != f), i], s.foreign)) if len(templates) > 1 else 0)
        threshold[f] = max(0.5, min(lowest, float(np.quantile(own, 1 - s.sure))))
    grams = list(vocab)
    weights = {f: {grams[j]: float(w[j, i]) for j in np.flatnonzero(w[:, i])} for i, f in enumerate(names)}
    constant = {f: float(b[i]) for i, f in enumerate(names)}
    telling = {f: {g for g in gs if weights[f].get(g, 0) > 0} for f, gs in exclusive(templates).items() if f != UNKNOWN}
    return Model(weights, constant, threshold, telling, marks(weights, constant, negatives))


def marks(weights: dict[str, dict[str, float]], constant: dict[str, float], negatives: list[list[str]]) -> tuple[str, ...]:
    """Words to look for. The words most frequent in the negatives are passed over, as many as leave every
    family under one half in a paragraph that has all n-grams of them."""
    up = {f: [(set(g.split(" ")), x) for g, x in ws.items() if x > 0] for f, ws in weights.items()}
    words = {w for gs in up.values() for g, _ in gs for w in g}
    seen = dict.fromkeys(words, 0)
    for n in negatives:
        for w in set(n) & words:
            seen[w] += 1
    passed: set[str] = set()
    for word in sorted(words, key=lambda w: (-seen[w], w)):
        more = passed | {word}
        if all(constant[f] + sum(x for g, x in gs if g <= more) < 0 for f, gs in up.items()):
            passed = more
    return tuple(sorted(words - passed))


def edge_word(line: Column, last: bool = False) -> Column:
    """The first or last word of a line, empty if it hasn't any."""
    word = F.lower(F.regexp_extract(F.reverse(line) if last else line, r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1))
    return F.reverse(word) if last else word


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, line, paragraph, words, from_last, to_next``: the lines with content, and the pairs of words
    that the line ends before and after them part. ``row`` tells documents apart for one reading."""
    d = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    lines, none = F.split("text", "\n"), F.array(F.lit(""))
    three = F.arrays_zip(lines.alias("own"), F.concat(none, lines).alias("last"), F.concat(F.slice(lines, F.lit(2), F.size(lines)), none).alias("next"))
    p = d.select("row", "doc_id", F.posexplode(three).alias("line", "x")).where(F.trim("x.own") != "")
    p = p.withColumn("words", words_of(F.col("x.own")))
    return p.select(
        "row", "doc_id", F.col("line").cast("bigint").alias("line"), F.col("x.own").alias("paragraph"), "words",
        F.concat(edge_word(F.col("x.last"), True), F.lit(" "), F.get("words", F.lit(0))).alias("from_last"),
        F.concat(F.get("words", F.size("words") - 1), F.lit(" "), edge_word(F.col("x.next"))).alias("to_next"),
    )


SPEAKS = r"(?i)licen[sc]|copyright|permission|redistribut"


def negative_words(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[list[str]], list[list[str]]]:
    """Words of bounded samples of paragraphs, the same in every run: of those that name no licence, and of those that speak
    of licences but have less than ``few`` of every template.

    One paragraph of each of the first documents in the order of a hash, whole; of one longer than ``longest`` words
    a stretch of that many from a hashed place.
    """
    d = id_and_text(docs, id_col, text_col).withColumn("t", F.xxhash64("text"))

    def sample(some: DataFrame, lines: Column, most: int) -> DataFrame:
        """One such line of each of the first ``most`` documents; their number is bounded, so their keys can be sent to every task."""
        keys = some.select(F.col("doc_id").alias("k_id"), F.col("t").alias("k_t")).distinct()
        keys = keys.orderBy(F.xxhash64("k_id", F.lit(s.seed)), "k_id", "k_t").limit(most)
        one = some.join(F.broadcast(keys), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("t") == F.col("k_t")))
        picked = one.select("doc_id", "t", F.get(lines, F.pmod(F.xxhash64("doc_id"), F.greatest(F.size(lines), F.lit(1))).cast("int")).alias("p")).where("p is not null")
        return picked.withColumn("w", words_of(F.col("p")))

    def words(picked: DataFrame) -> list[list[str]]:
        spare = F.greatest(F.size("w") - s.longest, F.lit(0)) + 1
        cut = picked.select("doc_id", "t", F.slice("w", 1 + F.pmod(F.xxhash64("t"), spare).cast("int"), s.longest).alias("w")).distinct()
        return [r.w for r in cut.orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id", "t").collect()]

    lines = F.split("text", "\n")
    plain = sample(d, F.filter(lines, lambda p: ~p.rlike(SPEAKS) & (F.trim(p) != "")), s.negatives)
    speaking = sample(d.where(F.col("text").rlike(SPEAKS)), F.filter(lines, lambda p: p.rlike(SPEAKS)), s.hard)
    has = F.greatest(*[F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / F.lit(float(len(g))) for _, g in STATED])
    return words(plain), words(speaking.withColumn("grams", grams_of(F.col("w"))).where(has < s.few))


def weight_table(spark: SparkSession, model: Model) -> DataFrame:
    """``gram, w``: a row per n-gram with its weight for each class, and then 1 for each class it is telling of; a few hundred rows."""
    grams = sorted({g for ws in model.weights.values() for g in ws})
    tells = lambda g: [float(g in model.telling.get(f, ())) for f in model.weights]
    lines = [g + "\t" + ",".join(map(repr, [*(ws.get(g, 0.0) for ws in model.weights.values()), *tells(g)])) for g in grams]
    rows = spark.range(1).select(F.explode(F.split(F.lit("\n".join(lines)), "\n")).alias("x"))
    return rows.select(F.split_part("x", F.lit("\t"), F.lit(1)).alias("gram"), F.split(F.split_part("x", F.lit("\t"), F.lit(2)), ",").cast("array<double>").alias("w"))


#: All templates: ``family, n-grams`` by number.
STATED = [(f, plain_grams(plain_words(t))) for f, ts in TEMPLATES.items() for t in ts]


def template_table(spark: SparkSession, model: Model) -> DataFrame:
    """``gram, template, strong``: the n-grams of each template; strong are those of several words with a mark."""
    marked = set(model.marks)
    lines = [f"{g}\t{i}\t{int(' ' in g and not marked.isdisjoint(g.split(' ')))}" for i, (_, gs) in enumerate(STATED) for g in gs]
    rows = spark.range(1).select(F.explode(F.split(F.lit("\n".join(lines)), "\n")).alias("x"))
    part = lambda i: F.split_part("x", F.lit("\t"), F.lit(i))
    return rows.select(part(1).alias("gram"), part(2).cast("int").alias("template"), (part(3) == "1").alias("strong"))


def marked(words: str, model: Model) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, model.marks)).cast("array<string>"))


def judged(p: DataFrame, model: Model) -> DataFrame:
    """``nth, probability, family, stated, believed`` of the rows (``nth, words``) that reach the threshold of their most
    probable family, or that of statements of any licence (``stated`` is its probability)."""
    grams = p.where(marked("words", model)).select("nth", F.explode(grams_of(F.col("words"))).alias("gram"))
    met = grams.join(F.broadcast(weight_table(p.sparkSession, model)), "gram")
    classes = list(model.weights)
    sums = met.groupBy("nth").agg(*[F.round(F.sum(F.get("w", F.lit(i))), 9).alias(f"z{i}") for i in range(2 * len(classes))])
    p = {f: 1 / (1 + F.exp(-(F.col(f"z{i}") + model.constant[f]))) for i, f in enumerate(classes)}
    told = {f: F.col(f"z{len(classes) + i}") > 0 for i, f in enumerate(classes)}
    best = F.array_max(F.array(*[
        F.struct(F.when(told[f], p[f]).otherwise(0.0).alias("probability"), p[f].alias("p"), F.lit(f).alias("family"), F.lit(model.threshold[f]).alias("threshold"))
        for f in classes if f != UNKNOWN
    ]))
    found = sums.select("nth", best.alias("best"), p[UNKNOWN].alias("stated")).select("nth", "best.*", "stated")
    found = found.withColumn("believed", F.col("probability") >= F.col("threshold")).drop("threshold", "p")
    return cut_lineage(found.where(F.col("believed") | (F.col("stated") >= model.threshold[UNKNOWN])))


def joined_lines(p: DataFrame, model: Model) -> DataFrame:
    """``nth, row, doc_id, line, last, template, most, paragraph, words``: runs of adjacent lines that may be one
    statement broken into lines, for each template; ``most`` is the most n-grams that one line has of it.

    Neighbours are joined if both have strong n-grams of the template, or their line end parts two words
    that stand together in it.
    """
    kinds = F.concat(
        F.transform(grams_of(F.col("words")), lambda g: F.struct(F.lit(0).alias("kind"), g.alias("gram"))),
        F.array(F.struct(F.lit(1).alias("kind"), F.col("to_next").alias("gram")), F.struct(F.lit(2).alias("kind"), F.col("from_last").alias("gram"))),
    )
    grams = p.select("row", "line", F.explode(kinds).alias("x")).select("row", "line", "x.kind", "x.gram")
    met = grams.join(F.broadcast(template_table(p.sparkSession, model)), "gram").groupBy("row", "line", "template").agg(
        F.count_if(F.col("kind") == 0).alias("n"), F.bool_or((F.col("kind") == 0) & F.col("strong")).alias("strong"),
        F.bool_or(F.col("kind") == 1).alias("to_next"), F.bool_or(F.col("kind") == 2).alias("from_last"),
    ).where("strong or to_next or from_last")
    w = Window.partitionBy("row", "template").orderBy("line")
    last = lambda c: F.lag(c).over(w)
    tied = (last("line") == F.col("line") - 1) & ((last("strong") & F.col("strong")) | last("to_next"))
    met = met.withColumn("new", F.when(tied, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    runs = met.groupBy("row", "template", "run").agg(F.min("line").alias("first"), F.max("line").alias("last"), F.max("n").alias("most")).where("first < last")
    runs = cut_lineage(runs.drop("run").withColumn("nth", F.monotonically_increasing_id()))
    each = runs.select("nth", "row", F.explode(F.sequence("first", "last")).alias("line"))
    each = each.join(p.select("row", "line", "doc_id", "paragraph", "words"), ["row", "line"])
    whole = each.groupBy("nth").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("line", "paragraph", "words"))).alias("x"))
    whole = whole.select("nth", "doc_id", F.array_join("x.paragraph", "\n").alias("paragraph"), F.flatten("x.words").alias("words"))
    return cut_lineage(runs.withColumnRenamed("first", "line").join(whole, "nth"))


def licences(docs: DataFrame, model: Model, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph that reads like a licence statement:
    ``doc_id, line, family, probability, template_share, confirmed, paragraph``.

    A paragraph is a line of the text (lines count from 0), or a run of adjacent lines over which a statement
    is broken; ``line`` is its first. Its family is the most probable one with a telling n-gram if that reaches the family's threshold,
    else "unknown" if it reads like a statement of any licence; else it isn't reported. ``template_share`` is the largest
    part of a template's n-grams, of the most probable family, that the paragraph has; from ``alike`` on the prediction
    is confirmed. A run is reported if it has more of its template than each of its lines; then lines of it
    are reported again only if they have more of a template of their own family; an unknown statement broken over lines has a row a line. Equal statements that follow each
    other broken over lines, with no line between, are one run. Null and empty texts have no rows, nor has
    an empty table; ids may be null or repeat (repeated rows are reported again); other columns aren't read.
    Long texts are read whole.

    Lines without a mark (``Model.marks``) can't be reported alone; those with one, and those whose line ends part
    words that stand together in a template, are written and numbered, their n-grams meet the weights and the
    templates (tables of a few hundred rows, sent to the tasks) and are summed by number; the few numbers that are left
    meet the lines again.
    """
    p = paragraphs(docs, id_col, text_col)
    parted = sorted({g for _, gs in STATED for g in gs if g.count(" ") == 1})
    p = p.where(marked("words", model) | F.col("to_next").isin(parted) | F.col("from_last").isin(parted))
    p = cut_lineage(p.withColumn("nth", F.monotonically_increasing_id()))  # words as a column: n-grams look into them often

    def with_share(found: DataFrame) -> DataFrame:
        found = found.withColumn("grams", grams_of(F.col("words")))
        shares = F.lit(0.0)
        for f, ts in TEMPLATES.items():
            shares = F.when(F.col("family") == f, F.greatest(*[share(F.col("grams"), t) for t in ts], F.lit(0.0))).otherwise(shares)
        return found.withColumn("template_share", shares)

    own = lambda g: F.size(F.array_intersect("grams", F.array(*map(F.lit, g))))
    lines = with_share(p.join(judged(p, model), "nth"))
    lines = lines.withColumn("has", F.array(*[own(g) for _, g in STATED])).withColumn("most", F.array_max(F.array(*[
        F.when(F.col("family") == f, F.get("has", F.lit(i))).otherwise(0) for i, (f, _) in enumerate(STATED)
    ])))
    lines = cut_lineage(lines.drop("grams", "words", "from_last", "to_next"))
    runs = joined_lines(p, model)
    runs = with_share(runs.join(judged(runs, model), "nth"))
    runs = runs.withColumn("hits", F.array(*[own(g) for _, g in STATED])).withColumn("has", F.get("hits", F.col("template")))
    stated = F.get(F.array(*[F.lit(f) for f, _ in STATED]), F.col("template"))
    runs = runs.where((F.col("family") == stated) & (F.col("has") > F.col("most")))
    runs = cut_lineage(runs.select("nth", "row", "doc_id", "line", "last", "template", "family", "probability", "stated", "believed", "template_share", "hits", "has", "paragraph"))
    # Of runs that overlap, the one with the largest part of a template, if they are of one family or the other has no more of its own template.
    r, q = runs.alias("r"), runs.select("row", "family", "line", "last", "template_share", "has", "template").alias("q")
    rank = lambda x: F.struct(f"{x}.template_share", f"{x}.has", -F.col(f"{x}.template"))
    over = [F.col("r.row") == F.col("q.row"), F.col("r.line") <= F.col("q.last"), F.col("q.line") <= F.col("r.last"), rank("q") > rank("r")]
    alike = (F.col("r.family") == F.col("q.family")) | (F.get("r.hits", F.col("q.template")) >= F.col("r.has"))
    runs = cut_lineage(r.join(q, [*over, alike], "left_anti"))
    # A line of a run says something of its own if its family is believed and it has more of a template of that than of the run's.
    r, q = lines.alias("r"), runs.select("row", "template", "line", "last").alias("q")
    inside = [F.col("r.row") == F.col("q.row"), F.col("r.line").between(F.col("q.line"), F.col("q.last"))]
    lines = r.join(q, [*inside, ~F.col("r.believed") | (F.get("r.has", F.col("q.template")) >= F.col("r.most"))], "left_anti")
    columns = ["doc_id", "line", "family", "probability", "stated", "believed", "template_share", "paragraph"]
    believed = F.col("believed")
    return lines.select(*columns).unionByName(runs.select(*columns)).select(
        "doc_id", "line", F.when(believed, F.col("family")).otherwise(UNKNOWN).alias("family"),
        F.when(believed, F.col("probability")).otherwise(F.col("stated")).alias("probability"), "template_share", (believed & (F.col("template_share") >= s.alike)).alias("confirmed"), "paragraph",
    )


def share(grams: Column, template: str) -> Column:
    own = plain_grams(plain_words(template))
    return F.size(F.array_intersect(grams, F.array(*map(F.lit, own)))) / F.lit(float(len(own)))


def fitted(spark: SparkSession, docs: DataFrame, s: Settings = Settings()) -> Model:
    plain, hard = negative_words(docs, s)
    return train(plain, s, hard)


@query("op3_licences")
def op3_licences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return licences(docs, fitted(spark, docs))
