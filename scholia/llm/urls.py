"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the URLs that no rule fits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from scholia.llm.common import query, table
from scholia.session import cut_lineage, parallelism

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of the registered query: verdict, and host with the beginning of the path.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
SUFFIXES = ("tld", "domain", "ext")
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    """Boosted trees, and how many labelled URLs (by a hash of the URL, about) they are grown from."""

    trees: int = 20
    depth: int = 4
    step: float = 0.3
    rows: int = 100_000
    prior: float = 20.0  # rows that the general share of blocked URLs counts for in a suffix's share
    seed: int = 11


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """A struct ``verdict, rule`` of the longest rule that fits (of equal ones the longer host, then the first in
    order of their text, then block before allow); its fields are null if none does. The rules become literals of the plan."""
    cut = lambda rule: (rule[: rule.index("/")], rule[rule.index("/") :]) if "/" in rule else (rule, "")
    out = F.when(F.lit(False), F.struct(F.lit("").alias("verdict"), F.lit("").alias("rule")))
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), -len(cut(r[1])[0]), r[1], r[0] != "block")):
        name, start = cut(rule)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = out.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")))
    return out


def times(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n == 0, 0.0).otherwise(F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0)))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url, host, path``) and the features that follow from the URL alone, all double."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    asked = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    digits = times(url, "[0-9]")
    return urls.select(
        "*",
        F.length(url).cast("double").alias("length"), F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"), F.length(asked).cast("double").alias("query_length"),
        times(path, "[^/]+").alias("depth"), times(host, "[^.]+").alias("labels"),
        (digits / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"), times(host, "[0-9]").alias("host_digits"),
        times(path, "[0-9]").alias("path_digits"), times(host, "-").alias("host_hyphens"), times(url, "%[0-9A-Fa-f]{2}").alias("escapes"),
        times(asked, "[^&;]+").alias("parameters"), entropy(url).alias("entropy"), entropy(host).alias("host_entropy"),
        url.startswith("https:").cast("double").alias("secure"), path.endswith("/").cast("double").alias("folder"),
        F.contains(url, F.lit("#")).cast("double").alias("fragment"),
        F.substring_index(host, ".", -1).alias("tld"), F.substring_index(host, ".", -2).alias("domain"),
        F.regexp_extract(path, r"\.([^./]*)\z", 1).alias("ext"),
    )


LEXICAL = (
    "length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "host_digits", "path_digits", "host_hyphens",
    "escapes", "parameters", "entropy", "host_entropy", "secure", "folder", "fragment",
)
FEATURES = (*LEXICAL, *(f"{s}_{what}" for s in SUFFIXES for what in ("rows", "share")))


def fold_of(host: Column) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS))


def suffix_statistics(urls: DataFrame) -> dict[str, DataFrame]:
    """For each kind of suffix a table: how many of all URLs have it (logarithm), how many of them are labelled and how
    many are blocked, also by fold of their hosts. ``urls`` has ``label`` (1 block, 0 allow, else null)."""
    out = {}
    for kind in SUFFIXES:
        own = [F.when(fold_of(F.col("host")) == i, F.col("label")) for i in range(FOLDS)]
        counts = urls.groupBy(kind).agg(
            F.log1p(F.count("*")).alias(f"{kind}_rows"), F.array(*map(F.count, own)).alias("known"),
            F.array(*(F.coalesce(F.sum(x), F.lit(0.0)) for x in own)).alias("bad"),
        )
        out[kind] = cut_lineage(counts)
    return out


def with_statistics(urls: DataFrame, statistics: dict[str, DataFrame], base: float, prior: float, train: bool) -> DataFrame:
    """``urls`` with the suffix features: the share of blocked URLs is drawn towards the share of all, ``base``. For URLs
    to learn from, the labels of their own fold of hosts don't count, or a rare suffix would tell their label."""
    total = lambda x: F.aggregate(F.col(x).cast("array<double>"), F.lit(0.0), lambda a, v: a + v)
    own = lambda x: F.get(F.col(x), fold_of(F.col("host")).cast("int")) if train else F.lit(0.0)
    for kind, counts in statistics.items():
        met = urls.join(counts, kind, "left")
        share = (total("bad") - own("bad") + prior * base) / (total("known") - own("known") + prior)
        urls = met.withColumn(f"{kind}_share", F.coalesce(share, F.lit(base))).drop("known", "bad")
    return urls


def grow(labelled: DataFrame, s: Settings) -> GBTClassificationModel | float:
    """Trees grown from ``url``, ``label`` and the features; the only label where there is one, 0 without any."""
    seen = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return next(iter(seen), 0.0)
    part = min(1.0, s.rows / sum(seen.values()))
    place = F.pmod(F.xxhash64("url", F.lit(s.seed)), F.lit(1 << 32))
    chosen = labelled.where(place < int(part * (1 << 32))).select("label", *FEATURES)
    chosen = cut_lineage(chosen.repartition(parallelism(labelled.sparkSession)))
    points = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(chosen)
    trees = GBTClassifier(labelCol="label", maxIter=s.trees, maxDepth=s.depth, stepSize=s.step, seed=s.seed)
    return trees.fit(points.select("label", "features"))


def judged(urls: DataFrame, model: GBTClassificationModel | float) -> DataFrame:
    """``urls`` with the model's ``block`` (boolean)."""
    if isinstance(model, float):
        return urls.withColumn("block", F.lit(model) > 0.5)
    points = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(urls)
    return model.transform(points).withColumn("block", F.col("prediction") > 0.5).drop("features", "rawPrediction", "probability", "prediction")


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame | None = None, settings: Settings = Settings(), id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict, by_rule``.

    The longest rule whose host is the URL's or a parent domain of it and whose path begins the URL's decides.
    Other URLs get the verdict of boosted trees, grown from the URLs that a rule decides, or from
    ``labelled(url, label)`` with 1 for block and 0 for allow (rows with another label or none aren't used).
    Suffix statistics count all rows of ``pages`` and ``labelled``. A null URL, or one without ``://``, has an empty host and path, and
    features like any other; null ids and repeated rows are kept. If only one label occurs the method gives that verdict, and
    allow without any. An empty table gives no rows; other columns aren't read.
    """
    def parsed(df: DataFrame, id_: Column, url: Column, label: Column | None) -> DataFrame:
        df = df.select(id_.alias("page_id"), url.cast("string").alias("url"), *([label.cast("double").alias("label")] if label is not None else []))
        df = df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        df = df.withColumn("found", fitting_rule(rules, F.col("host"), F.col("path")))
        if label is None:
            df = df.withColumn("label", (F.col("found.verdict") == "block").cast("double"))
        return lexical(df)

    urls = cut_lineage(parsed(pages, pages[id_col], pages[url_col], None))
    known = urls
    if labelled is not None:
        known = cut_lineage(parsed(labelled, F.lit(None).cast("bigint"), labelled["url"], labelled["label"]).where("label in (0, 1)"))
        urls = urls.withColumn("label", F.lit(None).cast("double"))
    everything = urls if labelled is None else urls.unionByName(known)
    base = everything.agg(F.coalesce(F.avg("label"), F.lit(0.5)).alias("p")).first()["p"]
    statistics = suffix_statistics(everything)
    model = grow(with_statistics(known.where("label is not null"), statistics, base, settings.prior, True), settings)
    narrow = urls.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"), *LEXICAL, *SUFFIXES)
    out = judged(with_statistics(narrow, statistics, base, settings.prior, False), model)
    verdict = F.coalesce("ruled", F.when(F.col("block"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("rule").isNotNull().alias("by_rule"))


@query("op11_url_filter")
def op11_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), RULES)
