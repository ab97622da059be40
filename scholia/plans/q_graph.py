"""Knowledge-graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.operators import graph as G
from scholia.operators.hybrid import hydrate
from scholia.operators.vector import min_score, vector_search
from scholia.plans import fixtures as fx
from scholia.plans.oracle_fx import fx as sql
from scholia.registry import Tables, query
from scholia.session import cut_lineage, release, work_path
from scholia.sources.tables import read_graph, write_graph


def aliases(t: Tables) -> DataFrame:
    listed = fx.entities(t).select("entity_id", F.posexplode("aliases").alias("pos", "alias"))
    return listed.select("entity_id", "alias", F.array(F.col("pos").cast("bigint")).alias("place"))


def edges(t: Tables) -> DataFrame:
    return fx.relations(t)


@query("f21_parse_extraction", sql("raw_entities raw_relations", """
SELECT 'chunk_' || o_orderkey AS chunk_id, coalesce(n, 0) AS n_entities, coalesce(m, 0) AS n_relations FROM (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem)
LEFT JOIN (SELECT l_orderkey, count(*) + 1 AS n, count(*) AS m FROM (SELECT DISTINCT l_orderkey, l_partkey FROM order_parts) GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""))
def f21(t: Tables) -> DataFrame:
    p = fx.extractions(t).select("chunk_id", G.parse_extraction("raw").alias("p"))
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return p.select("chunk_id", n("p.entities").alias("n_entities"), n("p.relations").alias("n_relations"))


@query("a12_merge_entities", sql("raw_entities", """
SELECT entity_id, 'name' AS kind, name AS value FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY ord, pos) AS rn FROM raw_entities) WHERE rn = 1
UNION ALL SELECT DISTINCT entity_id, 'alias', alias FROM raw_entities
UNION ALL SELECT DISTINCT entity_id, 'chunk', chunk_id FROM raw_entities UNION ALL SELECT DISTINCT entity_id, 'paper', paper_id FROM raw_entities
UNION ALL SELECT entity_id, 'kind', kind FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY ord DESC, pos DESC) AS rn FROM raw_entities) WHERE rn = 1"""))
def a12(t: Tables) -> DataFrame:
    m = G.merge_entities(G.raw_entities(cut_lineage(G.read_answers(fx.extractions(t)))))
    row = lambda df, kind, value: df.select("entity_id", F.lit(kind).alias("kind"), F.col(value).alias("value"))
    return (
        row(m["entities"], "name", "name").union(row(m["aliases"], "alias", "alias"))
        .union(row(m["mentions"].select("entity_id", "chunk_id").distinct(), "chunk", "chunk_id"))
        .union(row(m["mentions"].select("entity_id", "paper_id").distinct(), "paper", "paper_id"))
        .union(m["properties"].select("entity_id", F.col("key").alias("kind"), "value"))
    )


FIRST_RELATION = "SELECT relation_id, subject_id, relation_type, object_id, round(confidence, 6) AS confidence, snippet FROM (SELECT *, row_number() OVER (PARTITION BY relation_id ORDER BY ord, pos) AS rn FROM raw_relations) WHERE rn = 1"


@query("a13_merge_relations", sql("raw_relations", f"SELECT r.*, n_chunks, n_papers FROM ({FIRST_RELATION}) r JOIN (SELECT relation_id, count(DISTINCT chunk_id) AS n_chunks, count(DISTINCT paper_id) AS n_papers FROM raw_relations GROUP BY relation_id) USING (relation_id)"))
def a13(t: Tables) -> DataFrame:
    m = G.merge_relations(cut_lineage(G.raw_relations(cut_lineage(G.read_answers(fx.extractions(t))))))
    by_paper = m["evidence"].groupBy("relation_id", "paper_id").agg(F.count("*").alias("n"))
    n = by_paper.groupBy("relation_id").agg(F.sum("n").alias("n_chunks"), F.count("*").alias("n_papers"))
    return m["relations"].withColumn("confidence", F.round("confidence", 6)).join(n, "relation_id")


@query("j11_resolve_relations", sql("raw_relations", "SELECT chunk_id, relation_id, round(confidence, 6) AS confidence, snippet FROM raw_relations"))
def j11(t: Tables) -> DataFrame:
    return G.raw_relations(cut_lineage(G.read_answers(fx.extractions(t)))).select("chunk_id", "relation_id", F.round("confidence", 6).alias("confidence"), "snippet")


@query("w04_dedup_last", sql("raw_entities", """
SELECT chunk_id, key, max_by(entity_id, pos * 10 + sub) AS entity_id FROM (
  SELECT chunk_id, lower(name) AS key, entity_id, pos, 0 AS sub FROM raw_entities UNION ALL SELECT chunk_id, lower(alias), entity_id, pos, 1 FROM raw_entities) GROUP BY ALL"""))
def w04(t: Tables) -> DataFrame:
    return G.name_map(G.raw_entities(fx.extractions(t)))


@query("g01_build_graph", sql("raw_entities raw_relations", """
SELECT 'total' AS kind, 'entities' AS item, count(DISTINCT entity_id) AS n FROM raw_entities UNION ALL SELECT 'total', 'relations', count(DISTINCT relation_id) FROM raw_relations
UNION ALL SELECT 'total', 'papers', count(DISTINCT paper_id) FROM raw_entities UNION ALL SELECT 'total', 'chunks', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'entity_type', type, count(DISTINCT entity_id) FROM raw_entities GROUP BY type UNION ALL SELECT 'relation_type', relation_type, count(DISTINCT relation_id) FROM raw_relations GROUP BY relation_type"""))
def g01(t: Tables) -> DataFrame:
    return G.graph_stats(G.build_graph(cut_lineage(fx.extractions(t))))


def star_graph(t: Tables) -> G.Graph:
    e, m = fx.entities(t), fx.mentions(t)
    return G.Graph(
        entities=e.select("entity_id", "entity_type", "name"), aliases=aliases(t), properties=e.select("entity_id", F.lit("k").alias("key"), F.lit("v").alias("value")),
        mentions=m.withColumn("chunk_id", F.col("paper_id")), relations=edges(t), evidence=edges(t).select("relation_id"),
        processed=m.select(F.col("paper_id").alias("chunk_id")).distinct(),
    )


@query("a11_graph_stats", sql("entities relations mentions", """
SELECT 'total' AS kind, 'entities' AS item, count(*) AS n FROM entities UNION ALL SELECT 'total', 'relations', count(*) FROM relations
UNION ALL SELECT 'total', 'papers', count(DISTINCT paper_id) FROM mentions UNION ALL SELECT 'total', 'chunks', count(DISTINCT paper_id) FROM mentions
UNION ALL SELECT 'entity_type', entity_type, count(*) FROM entities GROUP BY entity_type UNION ALL SELECT 'relation_type', relation_type, count(*) FROM relations GROUP BY relation_type"""))
def a11(t: Tables) -> DataFrame:
    return G.graph_stats(star_graph(t))


DEGREE = "SELECT entity_id, count(*) AS degree FROM (SELECT subject_id AS entity_id FROM {0} UNION ALL SELECT object_id FROM {0}) GROUP BY entity_id"
PAIRS = "(SELECT DISTINCT subject_id, object_id FROM relations)"


@query("a14_degree", sql("relations", f"SELECT true AS collapsed, * FROM ({DEGREE.format(PAIRS)}) UNION ALL SELECT false, * FROM ({DEGREE.format('relations')})"))
def a14(t: Tables) -> DataFrame:
    one = lambda c: G.degree(edges(t), c).select(F.lit(c).alias("collapsed"), "entity_id", "degree")
    return one(True).union(one(False))


@query("g05_entity_relevance", sql("entities relations", f"""
SELECT entity_id, coalesce(degree, 0) AS degree, round(coalesce(degree, 0) / (SELECT max(degree) FROM d), 6) AS relevance FROM entities LEFT JOIN d USING (entity_id)""", d=DEGREE.format(PAIRS)))
def g05(t: Tables) -> DataFrame:
    return G.entity_relevance(fx.entities(t), edges(t)).withColumn("relevance", F.round("relevance", 6))


@query("j13_induced_edges", sql("entities relations", """
SELECT relation_id FROM relations WHERE subject_id IN (SELECT entity_id FROM entities WHERE entity_type IN ('Location', 'Method')) AND object_id IN (SELECT entity_id FROM entities WHERE entity_type IN ('Location', 'Method'))"""))
def j13(t: Tables) -> DataFrame:
    return G.induced_edges(edges(t), fx.entities(t).where(F.col("entity_type").isin("Location", "Method"))).select("relation_id")


SUBGRAPH = "SELECT entity_id, coalesce(degree, 0) AS degree FROM entities LEFT JOIN d USING (entity_id) WHERE entity_type IN ('Location', 'Method', 'Species') ORDER BY degree DESC, entity_id LIMIT 100"


@query("k05_select_subgraph", sql("entities relations", f"""
SELECT 'node' AS kind, entity_id AS id, degree FROM top UNION ALL SELECT 'edge', relation_id, NULL FROM relations WHERE subject_id IN (SELECT entity_id FROM top) AND object_id IN (SELECT entity_id FROM top)""",
    d=DEGREE.format("relations"), top=SUBGRAPH))
def k05(t: Tables) -> DataFrame:
    nodes, inside = G.select_subgraph(fx.entities(t), edges(t), 100, ["Location", "Method", "Species"])
    return nodes.select(F.lit("node").alias("kind"), F.col("entity_id").alias("id"), "degree").unionByName(
        inside.select(F.lit("edge").alias("kind"), F.col("relation_id").alias("id")), allowMissingColumns=True
    )


@query("f38_display_attrs", sql("entities relations", """
SELECT 'node' AS kind, entity_id AS id, left(name, 30) AS label, greatest(10, least(40, 10 + 2 * coalesce(degree, 0)))::DOUBLE AS extent FROM entities LEFT JOIN d USING (entity_id)
UNION ALL SELECT 'edge', relation_id, relation_type, round(greatest(0.5, 2 * confidence), 6) FROM relations""", d=DEGREE.format("relations")))
def f38(t: Tables) -> DataFrame:
    nodes, links = G.display_attrs(fx.entities(t), edges(t))
    a = nodes.select(F.lit("node").alias("kind"), F.col("entity_id").alias("id"), "label", F.col("size").cast("double").alias("extent"))
    return a.union(links.select(F.lit("edge"), "relation_id", "relation_type", F.round("width", 6)))


SCORED = """
SELECT term_id, entity_id, round(CASE WHEN lower(name) = term THEN 1.0 WHEN contains(lower(name), term) THEN 0.8
   WHEN contains(lower(aliases[1]), term) THEN CASE WHEN lower(aliases[1]) = term THEN 0.9 ELSE 0.7 END
   WHEN contains(lower(aliases[2]), term) THEN CASE WHEN lower(aliases[2]) = term THEN 0.9 ELSE 0.7 END END + 0.01 * coalesce(degree, 0), 6)::DOUBLE AS score
FROM terms, entities LEFT JOIN d USING (entity_id)"""


@query("g02_search_entities", sql("entities relations", """
SELECT term_id, entity_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY score DESC, entity_id) AS rank FROM scored WHERE score IS NOT NULL) WHERE rank <= 5""",
    d=DEGREE.format(PAIRS), terms="SELECT 'n' || n_nationkey AS term_id, lower(n_name) AS term FROM nation UNION ALL SELECT 's' || s_suppkey, 'r#' || lpad(s_suppkey::VARCHAR, 9, '0') FROM supplier UNION ALL SELECT 'r' || r_regionkey, left(lower(r_name), 2) FROM region", scored=SCORED))
def g02(t: Tables) -> DataFrame:
    terms = (
        t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("term_id"), F.col("n_name").alias("term"))
        .union(t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), F.concat(F.lit("r#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))))
        .union(t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")), F.left("r_name", F.lit(2))))
    )
    out = G.search_entities(terms, fx.entities(t), aliases(t), G.degree(edges(t)))
    return out.select("term_id", "entity_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("g03_entity_papers", sql("entities mentions", """
SELECT paper_id, entity_id, name FROM mentions JOIN entities USING (entity_id)"""))
def g03(t: Tables) -> DataFrame:
    return G.paper_entities(fx.mentions(t), fx.entities(t).select("entity_id", "name"))


@query("j12_expand", sql("entities relations", """
SELECT DISTINCT seed, node FROM (SELECT subject_id AS seed, object_id AS node FROM relations UNION ALL SELECT object_id, subject_id FROM relations)
WHERE seed IN (SELECT entity_id FROM entities WHERE entity_type = 'Location') AND seed <> node"""))
def j12(t: Tables) -> DataFrame:
    start = fx.entities(t).where(F.col("entity_type") == "Location").select(F.col("entity_id").alias("seed"), F.col("entity_id").alias("node"))
    return G.expand(start, G.undirected(edges(t)), start)


BOTH = "SELECT subject_id AS a, object_id AS b FROM relations UNION SELECT object_id, subject_id FROM relations"
HOP1 = "SELECT DISTINCT 'region::' || r_regionkey AS seed, b AS node FROM region JOIN both_ways ON a = 'region::' || r_regionkey"
HOP2 = "SELECT seed, b AS node FROM hop1 JOIN both_ways ON a = node EXCEPT SELECT seed, node FROM hop1 EXCEPT SELECT seed, seed FROM hop1"
VISITED = "SELECT DISTINCT seed, seed AS node, 0 AS hop FROM hop1 UNION ALL SELECT seed, node, 1 FROM hop1 UNION ALL SELECT seed, node, 2 FROM hop2"


def regions(t: Tables) -> DataFrame:
    return t.region.select(F.concat(F.lit("region::"), F.col("r_regionkey").cast("string")).alias("entity_id"))


@query("g06_neighborhood", sql("relations", "SELECT seed, node, hop FROM visited", both_ways=BOTH, hop1=HOP1, hop2=HOP2, visited=VISITED))
def g06(t: Tables) -> DataFrame:
    return G.neighborhood(edges(t), regions(t), 2)


@query("g06_neighborhood_relations", sql("relations", """
SELECT v.seed, relation_id FROM relations JOIN visited v ON v.node = subject_id JOIN visited w ON w.seed = v.seed AND w.node = object_id""", both_ways=BOTH, hop1=HOP1, hop2=HOP2, visited=VISITED))
def g06_relations(t: Tables) -> DataFrame:
    return G.neighborhood_relations(edges(t), G.neighborhood(edges(t), regions(t), 2)).select("seed", "relation_id")


@query("f35_entity_context", sql("entities relations mentions", """
SELECT entity_id AS seed, 0 AS part, '' AS pos, '### Entidad: ' || name || ' (' || entity_type || ')' AS line FROM entities WHERE entity_type IN ('Location', 'Method')
UNION ALL SELECT entity_id, 1, paper_id, 'Mencionada en: ' || paper_id FROM mentions WHERE entity_id LIKE 'method::%'
UNION ALL SELECT DISTINCT v.seed, 2, '', 'Relaciones:' FROM relations r JOIN v ON v.node = subject_id JOIN v w ON w.seed = v.seed AND w.node = object_id
UNION ALL SELECT seed, 3, relation_id, '  - [' || relation_type || '] ' || CASE WHEN object_id = seed THEN object_id ELSE name END || ' (' || upper(left(object_id, 1)) || substr(split_part(object_id, '::', 1), 2) || ')  [conf=' || printf('%.2f', confidence) || ']'
FROM (SELECT v.seed, r.* FROM relations r JOIN v ON v.node = subject_id JOIN v w ON w.seed = v.seed AND w.node = object_id) JOIN entities ON entity_id = object_id""",
    both_ways=BOTH, v="SELECT entity_id AS seed, entity_id AS node FROM entities WHERE entity_type IN ('Location', 'Method') UNION SELECT a, b FROM both_ways JOIN entities ON entity_id = a WHERE entity_type IN ('Location', 'Method')"))
def f35(t: Tables) -> DataFrame:
    e = fx.entities(t)
    return G.entity_context(e.where(F.col("entity_type").isin("Location", "Method")), e, fx.mentions(t), edges(t))


def named_questions(t: Tables) -> DataFrame:
    """Questions that name a nation: the question text with the name of the nation of its number."""
    n = t.nation.agg(F.count("*")).scalar()
    q = fx.questions(t).withColumn("n_nationkey", (F.col("query_id") % n).cast("int")).join(t.nation, "n_nationkey")
    return q.select("query_id", F.concat(F.lit("What lives in "), F.initcap("n_name"), F.lit(" ? "), "question").alias("question"))


LINK_SQL = dict(
    d=DEGREE.format(PAIRS),
    nq="SELECT item_id AS query_id, 'What lives in ' || upper(left(n_name, 1)) || lower(substr(n_name, 2)) || ' ? ' || text AS question FROM benchmark JOIN nation ON n_nationkey = item_id % (SELECT count(*) FROM nation)",
    runs=r"""SELECT query_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase, w[i:i + n - 1] AS run FROM (SELECT query_id, list_filter(regexp_split_to_array(question, '\s+'), lambda x: x <> '') AS w FROM nq),
       (SELECT unnest([4, 3, 2, 1]) AS n), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)""",
    phrases=r"SELECT query_id, lower(phrase) AS term, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, i) AS pos FROM runs WHERE len(list_filter(run, lambda x: regexp_matches(x, '^\p{Lu}'))) > 0",
    terms="SELECT DISTINCT term AS term_id, term FROM phrases",
    scored=SCORED,
    best="SELECT term_id AS term, entity_id FROM (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY score DESC, entity_id) AS rn FROM scored WHERE score IS NOT NULL) WHERE rn = 1",
    linked="SELECT query_id, entity_id, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS rank FROM (SELECT query_id, entity_id, min(pos) AS pos FROM phrases JOIN best USING (term) GROUP BY ALL)",
)


@query("g04_link_questions", sql("entities relations", "SELECT query_id, entity_id, rank FROM linked WHERE rank <= 3", **LINK_SQL))
def g04(t: Tables) -> DataFrame:
    out = G.link_questions(named_questions(t), fx.entities(t), aliases(t), G.degree(edges(t)))
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("g07_graph_search")
def g07(t: Tables) -> DataFrame:
    """A graph built from answers, written and read back; questions that name one of its customers."""
    path = work_path(t.spark, "graph")
    built = G.build_graph(fx.extractions(t))
    write_graph(built, path)
    release(*built.staged)
    g = read_graph(t.spark, path)
    who = F.concat(F.lit("What does Customer "), (F.col("query_id") * 3 + 1).cast("string"), F.lit(" study? "))
    q = fx.question_vectors(t).withColumn("question", F.concat(who, "question"))
    # vectors are searched where they are made, and texts fetched of the chunks that are hits
    near = cut_lineage(min_score(vector_search(fx.hybrid_chunks(t), q, 5), 0.6))
    found = fx.hybrid_chunks(t, near.select("chunk_id"))
    hits = hydrate(near, found.drop("embedding", "seq").withColumns({
        "title": F.concat(F.lit("On "), "lang"), "authors": F.array("source"), "year": F.lit(2001)}))
    return G.graph_search(q.select("query_id", "question"), g.entities, g.aliases, g.mentions, g.relations, hits)
