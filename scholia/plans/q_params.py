"""Parameter and domain queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia import fixed
from scholia.operators import domains as D, params as P, stats as S
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.plans.q_stats import rounded
from scholia.registry import Tables, query


def facts(t: Tables) -> DataFrame:
    return P.unpivot_parameters({"growth": fx.growth(t), "length_weight": fx.length_weight(t), "ecology": fx.ecology(t), "maturity": fx.maturity(t), "qb": fx.qb(t)})


@query("r13_unpivot_parameters", sql("parameters", "SELECT SpecCode, parameter, round(value, 6)::DOUBLE AS value, unit, method, locality, country, sex, n_samples::BIGINT AS n_samples, data_ref::BIGINT AS data_ref FROM parameters"))
def r13(t: Tables) -> DataFrame:
    return rounded(facts(t).select("SpecCode", "parameter", "value", "unit", "method", "locality", "country", "sex", "n_samples", "data_ref"))


@query("w16_filter_ecosystem", sql("parameters", """
SELECT SpecCode, parameter, round(value, 6)::DOUBLE AS value, locality FROM (
  SELECT *, coalesce(contains(lower(locality), 'an'), false) AS m, bool_or(coalesce(contains(lower(locality), 'an'), false)) OVER (PARTITION BY SpecCode, src) AS any_m FROM parameters) WHERE m OR NOT any_m"""))
def w16(t: Tables) -> DataFrame:
    return rounded(P.filter_ecosystem(facts(t), "AN").select("SpecCode", "parameter", "value", "locality"))


BEST = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SpecCode, parameter ORDER BY n_samples DESC NULLS LAST, l_orderkey, l_linenumber, n_name) AS rn FROM parameters) WHERE rn = 1"""


@query("w15_best_parameter", sql("parameters", f"SELECT SpecCode, parameter, round(value, 6)::DOUBLE AS value, n_samples, locality FROM ({BEST})"))
def w15(t: Tables) -> DataFrame:
    return rounded(P.best_parameter(facts(t)).select("SpecCode", "parameter", "value", "n_samples", "locality"))


def summary_sql() -> str:
    cols = []
    for p in fixed.REQUIRED_PARAMETERS:
        has = f"FILTER (parameter = '{p}')"
        cols += [
            f"round(max(value) {has}, 6)::DOUBLE AS \"{p}\"", f"max(unit) {has} AS \"{p}_unit\"",
            f"CASE WHEN count(*) {has} > 0 THEN 'fishbase' END AS \"{p}_source\"",
            f"CASE WHEN count(*) {has} > 0 THEN 'curated' ELSE 'sin datos' END AS \"{p}_confidence\"",
        ]
    return f"SELECT SpecCode, {', '.join(cols)} FROM (SELECT SpecCode FROM spec_names) LEFT JOIN ({BEST}) USING (SpecCode) GROUP BY SpecCode"


@query("r14_parameter_summary", sql("spec_names parameters", summary_sql()))
def r14(t: Tables) -> DataFrame:
    return rounded(P.parameter_summary(facts(t), species=fx.spec_names(t)))


@query("a23_parameter_gaps", sql("spec_names parameters", """
SELECT SpecCode, array_to_string(list_sort(ps), ';') AS available,
  array_to_string(list_filter(['K', 'Linf', 't0', 'a', 'b', 'TrophicLevel', 'Lmat', 'Amat', 'QB'], lambda p: NOT list_contains(ps, p)), ';') AS missing
FROM (SELECT SpecCode, coalesce(ps, []) AS ps FROM spec_names LEFT JOIN (SELECT SpecCode, list_distinct(list(parameter)) AS ps FROM parameters GROUP BY SpecCode) USING (SpecCode))"""))
def a23(t: Tables) -> DataFrame:
    known = facts(t).withColumnRenamed("SpecCode", "species")
    return S.parameter_gaps(known, species=fx.spec_names(t).select(F.col("SpecCode").alias("species"))).select(F.col("species").alias("SpecCode"), F.array_join("available", ";").alias("available"), F.array_join("missing", ";").alias("missing"))


RESOLVED = """
SELECT n.p_partkey, n.name, CASE WHEN epithet IS NULL THEN (SELECT min(SpecCode) FROM spec_names WHERE Genus = n.genus) ELSE s.code END AS SpecCode
FROM (SELECT p_partkey, name, split_part(name, ' ', 1) AS genus, nullif(split_part(name, ' ', 2), '') AS epithet FROM (
  SELECT p_partkey, CASE WHEN p_size > 40 THEN Genus WHEN p_size > 35 THEN 'Nomen nudum' ELSE Genus || ' ' || Species END AS name FROM part JOIN spec_names ON SpecCode = p_partkey)) n
LEFT JOIN (SELECT Genus AS g, Species AS e, min(SpecCode) AS code FROM spec_names GROUP BY ALL) s ON g = genus AND e = epithet"""


HABITAT = f"""
SELECT r.*, coalesce(h.fresh, false) AS fresh, coalesce(sea, r.SpecCode IS NOT NULL) AS salt, coalesce(h.brack, false) AS brack
FROM ({RESOLVED}) r LEFT JOIN (SELECT p_partkey AS SpecCode, CASE WHEN p_size % 5 = 0 THEN true WHEN p_size % 7 <> 0 THEN false END AS sea, p_size % 2 = 0 AS fresh, p_size % 3 = 0 AS brack FROM part WHERE p_partkey % 4 <> 3) h ON h.SpecCode = r.SpecCode"""


@query("j18_resolve_species", sql("spec_names", HABITAT))
def j18(t: Tables) -> DataFrame:
    names = t.part.join(fx.spec_names(t), F.col("SpecCode") == F.col("p_partkey")).select(
        "p_partkey", F.when(F.col("p_size") > 40, F.col("Genus")).when(F.col("p_size") > 35, "Nomen nudum").otherwise(F.concat_ws(" ", "Genus", "Species")).alias("name")
    )
    found = P.resolve_species(names, fx.spec_names(t)).select("p_partkey", "name", "SpecCode")
    return P.habitat_flags(found, fx.species_habitats(t))


def catalogue(t: Tables) -> DataFrame:
    """Species catalogue whose names are those of the questions."""
    s = fx.species_base(t)
    return s.select(F.col("item_id").alias("SpecCode"), F.substring_index("species", " ", 1).alias("Genus"), F.substring_index("species", " ", -1).alias("Species"))


@query("j17_enrich_with_parameters", sql("species_base parameters", r"""
SELECT query_id, name, SpecCode, n_parameters FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS rn FROM (
  SELECT query_id, name, code AS SpecCode, n_parameters, pos FROM (
    SELECT query_id, unnest(found[1:2]) AS name, generate_subscripts(found[1:2], 1) AS pos FROM (
      SELECT item_id AS query_id, regexp_extract_all(regexp_replace(text || ' ' || species || '.', '[^\x00-\x7F]', 'x', 'g'), '\b[A-Z][a-z]+\s+[a-z]+\b') AS found FROM benchmark JOIN species_base USING (item_id)))
  JOIN (SELECT species, min(item_id) AS code FROM species_base GROUP BY species) ON species = replace(name, chr(10), ' ')
  JOIN (SELECT SpecCode, count(*) AS n_parameters FROM (SELECT *, coalesce(contains(lower(locality), 'an'), false) AS m, bool_or(coalesce(contains(lower(locality), 'an'), false)) OVER (PARTITION BY SpecCode, src) AS any_m FROM parameters) WHERE m OR NOT any_m GROUP BY SpecCode) p ON p.SpecCode = code)) WHERE rn = 1"""))
def j17(t: Tables) -> DataFrame:
    q = t.benchmark.join(fx.species_base(t), "item_id")
    text = F.regexp_replace(F.concat("text", F.lit(" "), "species", F.lit(".")), r"[^\x00-\x7F]", "x")
    return P.enrich_with_parameters(q.select(F.col("item_id").alias("query_id"), text.alias("question")), catalogue(t), facts(t), ecosystem="AN")


DOMAINS = {"articles": ["de la", "the", "Unter der"], "verbs": ["is", "est", "ist", "and the"], "links": ["with", "avec", "mit", "para"]}
FLAGS = {
    "norm": r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '[0-9]+', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents",
    "found": "SELECT doc_id, d.domain, d.term FROM norm, (VALUES "
    + ", ".join(f"('{d}', '{x}', '{x.lower()}')" for d, xs in DOMAINS.items() for x in xs)
    + ") d(domain, term, form) WHERE CASE WHEN contains(form, ' ') THEN contains(t, form) ELSE contains(' ' || t || ' ', ' ' || form || ' ') END",
}


def matched(t: Tables) -> DataFrame:
    return D.match_domain_terms(t.documents, DOMAINS, "text")


@query("j14_match_domain_terms", sql("", "SELECT doc_id, domain, term FROM found", **FLAGS))
def j14(t: Tables) -> DataFrame:
    m = matched(t)
    rows = F.array(*[F.struct(F.lit(d).alias("domain"), F.col(f"found_{d}").alias("terms")) for d in DOMAINS])
    return m.select("doc_id", F.explode(rows).alias("x")).select("doc_id", "x.domain", F.explode("x.terms").alias("term"))


@query("a15_domain_stats", sql("", """
SELECT domain, NULL AS term, count(DISTINCT doc_id) AS n, round(count(DISTINCT doc_id) / (SELECT count(*) FROM documents) * 100, 2) AS pct FROM found GROUP BY domain
UNION ALL SELECT domain, term, count(*), round(count(*) / (SELECT count(*) FROM documents) * 100, 2) FROM found GROUP BY domain, term""", **FLAGS))
def a15(t: Tables) -> DataFrame:
    return D.domain_stats(matched(t), list(DOMAINS))


@query("a16_domain_intersections", sql("", """
SELECT domains, count(DISTINCT CASE WHEN k = need THEN doc_id END) AS n,
  round(count(DISTINCT CASE WHEN k = need THEN doc_id END) / (SELECT count(*) FROM documents) * 100, 2) AS pct
FROM (SELECT p.domains, p.n AS need, doc_id, count(DISTINCT domain) AS k
  FROM (VALUES ('articles & verbs', ['articles', 'verbs'], 2), ('articles & links', ['articles', 'links'], 2), ('verbs & links', ['verbs', 'links'], 2),
    ('all', ['articles', 'verbs', 'links'], 3)) p(domains, ds, n) LEFT JOIN found ON list_contains(p.ds, domain) GROUP BY ALL) GROUP BY domains""", **FLAGS))
def a16(t: Tables) -> DataFrame:
    return D.domain_intersections(matched(t), list(DOMAINS))
