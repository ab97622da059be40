"""Domain terms in titles: matches, frequencies, intersections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scholia.functions.text import normalize_domain
from scholia.operators.stats import pct


def term_present(norm: Column, term: Column) -> Column:
    """Several words: contained as they stand; one word: a whole word of the title."""
    whole = F.concat(F.lit(" "), norm, F.lit(" ")).contains(F.concat(F.lit(" "), term, F.lit(" ")))
    return F.when(term.contains(" "), norm.contains(term)).otherwise(whole)


def match_domain_terms(titles: DataFrame, domains: dict[str, list[str]], title: str = "title") -> DataFrame:
    """``found_<domain>``: the terms of each domain found in the title.

    The term lists are literals of the plan: each title is looked at once, nothing is joined. Terms
    are normalised like titles first (one small job over the literals).
    """
    spark = titles.sparkSession
    terms = [(d, t) for d, ts in domains.items() for t in ts]
    forms = {(r["d"], r["t"]): r["n"] for r in spark.createDataFrame(terms, "d string, t string").withColumn("n", normalize_domain("t")).collect()}
    out = titles.withColumn("norm", normalize_domain(title))
    for d, ts in domains.items():
        pairs = F.arrays_zip(F.lit(list(ts)).alias("term"), F.lit([forms[d, t] for t in ts]).alias("form"))
        out = out.withColumn(f"found_{d}", F.transform(F.filter(pairs, lambda x: term_present(F.col("norm"), x["form"])), lambda x: x["term"]))
    return out


def domain_flags(matched: DataFrame, domains: list[str]) -> DataFrame:
    return matched.withColumns({f"in_{d}": (F.size(f"found_{d}") > 0).cast("int") for d in domains})


def domain_stats(matched: DataFrame, domains: list[str]) -> DataFrame:
    """Articles and share per domain, and how often each term occurs."""
    total = matched.agg(F.count("*")).scalar()
    found = F.array(*[F.struct(F.lit(d).alias("domain"), F.col(f"found_{d}").alias("terms")) for d in domains])
    rows = matched.select(F.explode(found).alias("x")).select("x.*").where(F.size("terms") > 0)
    per = rows.groupBy("domain").agg(F.count("*").alias("n")).withColumn("term", F.lit(None).cast("string"))
    terms = rows.select("domain", F.explode("terms").alias("term")).groupBy("domain", "term").agg(F.count("*").alias("n"))
    return per.unionByName(terms).withColumn("pct", F.round(pct(F.col("n"), total), 2))


def domain_intersections(matched: DataFrame, domains: list[str]) -> DataFrame:
    """Articles in every pair of domains, and in all of them: one aggregate over the flags."""
    flags = domain_flags(matched, domains)
    pairs = [(f"{a} & {b}", [a, b]) for i, a in enumerate(domains) for b in domains[i + 1 :]]
    if len(domains) > 2:
        pairs.append(("all", list(domains)))
    both = lambda ds: reduce(lambda x, y: x & y, [F.col(f"in_{d}") == 1 for d in ds])
    counts = flags.agg(F.count("*").alias("total"), *[F.count_if(both(ds)).alias(f"c{i}") for i, (_, ds) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(name).alias("domains"), F.col(f"c{i}").alias("n")) for i, (name, _) in enumerate(pairs)])
    return counts.select("total", F.explode(rows).alias("x")).select("x.domains", "x.n", F.round(pct(F.col("x.n"), F.col("total")), 2).alias("pct"))
