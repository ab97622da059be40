"""Knowledge graph: extraction answers to entities and relations, search and neighbourhoods.

A graph is a set of long tables. Aliases, mentions, properties and evidence of an entity are rows,
never lists, so an entity mentioned in a third of all chunks is no special case.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import ClassVar

from pyspark.sql import Column, DataFrame, functions as F

from scholia import fixed
from scholia.functions.ids import entity_id_of
from scholia.functions.records import clamp_confidence, edge_width, node_size
from scholia.functions.text import candidate_phrases, strip, to_ascii_each
from scholia.operators.bm25 import exploded
from scholia.operators.hybrid import author_line
from scholia.operators.skew import first_by, top_k
from scholia.session import cut_lineage

EXTRACTION = (
    "entities array<struct<name:string,type:string,aliases:array<string>,properties:map<string,string>>>, "
    "relations array<struct<subject:string,relation:string,object:string,confidence:string,context:string>>"
)


@dataclass
class Graph:
    """``entities(entity_id, entity_type, name)``, ``aliases(entity_id, alias, place)`` (``place``, an array of
    numbers, orders the aliases of an entity by first appearance),
    ``properties(entity_id, key, value)``, ``mentions(entity_id, chunk_id, paper_id)``,
    ``relations(relation_id, subject_id, relation_type, object_id, confidence, snippet)``,
    ``evidence(relation_id, chunk_id, paper_id)``, ``processed(chunk_id)``.

    ``staged`` has the written tables that these are still to be made from, if any."""

    entities: DataFrame
    aliases: DataFrame
    properties: DataFrame
    mentions: DataFrame
    relations: DataFrame
    evidence: DataFrame
    processed: DataFrame
    staged: ClassVar[tuple[DataFrame, ...]] = ()

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


# ---- from answers to tables ----------------------------------------------------------------------


def extraction_prompt() -> Column:
    """Header of what is known about a chunk, then its text."""
    authors = F.array_join(F.slice("authors", 1, 3), ", ")
    names = F.when(F.size("authors") > 3, F.concat(authors, F.lit(" et al."))).when(F.size("authors") > 0, authors)
    line = lambda label, value: F.concat(F.lit(f"{label}: "), value)
    header = F.concat_ws(
        "\n", line("Paper", F.nullif(F.col("title"), F.lit(""))), line("Year", F.nullif(F.col("year"), F.lit(0)).cast("string")),
        line("Authors", names), line("Page", F.col("page_number").cast("string")),
    )
    return F.concat(header, F.lit("\n\nTEXT:\n"), F.col("text"))


def parse_extraction(raw: Column | str) -> Column:
    """Answer to a struct of entities and relations; fences are removed, anything that is not one
    JSON object gives empty lists."""
    c = F.col(raw) if isinstance(raw, str) else raw
    open_fence = F.regexp_replace(F.regexp_replace(c, r"^```[^\n]*\n?", ""), r"\n[ \t]*```\s*$", "")
    body = F.when(c.startswith("```"), open_fence).otherwise(c)
    # JSON readers ignore what follows the first value; inside brackets trailing text is an error
    listed = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    # what begins with a brace and is valid is an object
    one_object = listed.isNotNull() & F.ltrim(body, F.lit(" \t\n\r")).startswith("{") & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(one_object, F.from_json(body, EXTRACTION))


def read_answers(extractions: DataFrame) -> DataFrame:
    """``chunk_id, paper_id, ord, entities, relations``: every answer read once, what is valid of it as two lists in its row.

    ``extractions(chunk_id, paper_id, ord, raw)``; ``ord`` is the ingest order. Blank names and unknown types are
    dropped; ``pos`` is the place in the answer.
    """
    keys = ["chunk_id", "paper_id", "ord"]
    rows = extractions.select(*keys, parse_extraction("raw").alias("x"))
    trimmed = F.transform("x.entities", lambda e, i: F.struct(
        i.alias("pos"), strip(e["name"]).alias("name"), strip(e["type"]).alias("entity_type"), e["aliases"].alias("aliases"), e["properties"].alias("properties")))
    kept = F.filter(trimmed, lambda e: (F.length(e["name"]) > 0) & e["entity_type"].isin(*fixed.ENTITY_TYPES))
    read = F.transform("x.relations", lambda r, i: F.struct(
        i.alias("pos"), F.lower(strip(r["subject"])).alias("skey"), F.lower(strip(r["object"])).alias("okey"), strip(r["relation"]).alias("relation_type"),
        clamp_confidence(r["confidence"].try_cast("double")).alias("confidence"), F.left(F.coalesce(r["context"], F.lit("")), F.lit(200)).alias("snippet")))
    relations = F.filter(read, lambda r: r["relation_type"].isin(*fixed.RELATION_TYPES))
    rows = rows.select(*keys, kept.alias("e"), relations.alias("relations"))
    rows = rows.withColumn("folded", to_ascii_each(F.transform("e", lambda e: F.lower(e["name"]))))
    others = lambda e: F.filter(F.coalesce(e["aliases"], F.array().cast("array<string>")), lambda a: a != e["name"])
    entities = F.transform("e", lambda e, i: F.struct(
        e["pos"].alias("pos"), e["name"].alias("name"), e["entity_type"].alias("entity_type"), others(e).alias("aliases"), e["properties"].alias("properties"),
        entity_id_of(e["entity_type"], F.get(F.col("folded"), i)).alias("entity_id")))
    return rows.select(*keys, entities.alias("entities"), "relations")


def _answers(extractions: DataFrame) -> DataFrame:
    return extractions if "entities" in extractions.columns else read_answers(extractions)


def raw_entities(extractions: DataFrame) -> DataFrame:
    """Entities of all answers with their ids; blank names and unknown types are dropped.

    ``extractions(chunk_id, paper_id, ord, raw)``, or answers of ``read_answers``; ``ord`` is the ingest order.
    """
    rows = _answers(extractions).select("chunk_id", "paper_id", "ord", F.explode_outer("entities").alias("x")).where(F.col("x").isNotNull())
    return rows.select("chunk_id", "paper_id", "ord", *(f"x.{c}" for c in ("pos", "name", "entity_type", "aliases", "properties", "entity_id")))


def name_map(entities: DataFrame) -> DataFrame:
    """Lower-case name or alias to entity id within a chunk; the later entry wins."""
    names = F.concat(F.array("name"), F.col("aliases"))
    rows = entities.select("chunk_id", "entity_id", "pos", F.posexplode(names).alias("sub", "key"))
    return rows.groupBy("chunk_id", F.lower("key").alias("key")).agg(F.max_by("entity_id", F.struct("pos", "sub")).alias("entity_id"))


RELATION = ("relation_type", "confidence", "snippet", "subject_id", "object_id")


def raw_relations(extractions: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Relations of all answers with both ends resolved inside their chunk; others are dropped.

    The names are those of ``entities``, or else of the chunk's own answers. An answer that is the only one of its chunk then resolves
    its relations in its row, so nothing of it moves; chunks with several answers, and given entities, meet by name.
    """
    answers = _answers(extractions)
    if entities is not None:
        return _with_id(_joined_relations(answers, name_map(entities)))
    # read for the keys and again for the rest
    answers = extractions if answers is extractions else cut_lineage(answers)
    several = answers.where(F.col("chunk_id").isNotNull()).groupBy("chunk_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("chunk_id")
    several = cut_lineage(several)
    if several.isEmpty():
        return _with_id(_own_relations(answers))
    shared = answers.join(several, "chunk_id", "left_semi")
    alone = _own_relations(answers.join(several, "chunk_id", "left_anti"))
    return _with_id(alone.unionByName(_joined_relations(shared, name_map(raw_entities(shared)))))


def _with_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn("relation_id", F.concat_ws("::", "subject_id", "relation_type", "object_id"))


def _own_relations(answers: DataFrame) -> DataFrame:
    """Ends looked up among the names of the same row, the last entry first."""
    keys = F.flatten(F.transform("entities", lambda e: F.transform(F.concat(F.array(e["name"]), e["aliases"]), F.lower)))
    ids = F.flatten(F.transform("entities", lambda e: F.array_repeat(e["entity_id"], F.size(e["aliases"]) + 1)))
    rows = answers.where(F.col("chunk_id").isNotNull() & (F.size("relations") > 0)).select(
        "chunk_id", "paper_id", "ord", "relations", F.reverse(keys).alias("keys"), F.reverse(ids).alias("ids"))
    end = lambda key: F.get(F.col("ids"), F.array_position(F.col("keys"), key).cast("int") - 1)
    met = F.transform("relations", lambda r: F.struct(
        r["pos"].alias("pos"), r["relation_type"].alias("relation_type"), r["confidence"].alias("confidence"), r["snippet"].alias("snippet"),
        end(r["skey"]).alias("subject_id"), end(r["okey"]).alias("object_id")))
    both = F.filter(met, lambda r: r["subject_id"].isNotNull() & r["object_id"].isNotNull())
    rows = rows.select("chunk_id", "paper_id", "ord", F.explode_outer(both).alias("x")).where(F.col("x").isNotNull())
    return rows.select("chunk_id", "paper_id", "ord", "x.pos", *(f"x.{c}" for c in RELATION))


def _joined_relations(answers: DataFrame, names: DataFrame) -> DataFrame:
    rows = answers.select("chunk_id", "paper_id", "ord", F.explode_outer("relations").alias("x")).where(F.col("x").isNotNull())
    rows = rows.select("chunk_id", "paper_id", "ord", "x.*")
    end = lambda key, out: names.select("chunk_id", F.col("key").alias(key), F.col("entity_id").alias(out))
    rows = rows.join(end("skey", "subject_id"), ["chunk_id", "skey"]).join(end("okey", "object_id"), ["chunk_id", "okey"])
    return rows.select("chunk_id", "paper_id", "ord", "pos", *RELATION)


def merge_entities(raw: DataFrame) -> dict[str, DataFrame]:
    """First name and type, all aliases and mentions, last value of each property per entity."""
    order = [F.col("ord"), F.col("pos")]
    listed = raw.select("entity_id", "ord", "pos", F.posexplode_outer("aliases").alias("sub", "alias")).where(F.col("alias").isNotNull())
    listed = listed.select("entity_id", "alias", F.array(*[F.col(c).cast("bigint") for c in ("ord", "pos", "sub")]).alias("place"))
    props = raw.select("entity_id", "ord", "pos", F.explode_outer("properties").alias("key", "value")).where(F.col("key").isNotNull())
    return {
        "entities": first_by(raw, ["entity_id"], order, ["entity_id", "entity_type", "name"]),
        "aliases": listed.groupBy("entity_id", "alias").agg(F.min("place").alias("place")),
        "properties": props.groupBy("entity_id", "key").agg(F.max_by("value", F.struct("ord", "pos")).alias("value")),
        "mentions": raw.select("entity_id", "chunk_id", "paper_id").distinct(),
    }


def merge_relations(raw: DataFrame) -> dict[str, DataFrame]:
    """First confidence and snippet, all evidence per (subject, type, object)."""
    cols = ["relation_id", "subject_id", "relation_type", "object_id", "confidence", "snippet"]
    return {
        "relations": first_by(raw, ["relation_id"], [F.col("ord"), F.col("pos")], cols),
        "evidence": raw.select("relation_id", "chunk_id", "paper_id").distinct(),
    }


def build_graph(extractions: DataFrame) -> Graph:
    """All answers to one graph. The parsed answers feed seven tables, so they are written once, and the raw ones are read once.

    What the tables are made from can go when they have been written: ``release(*graph.staged)``.
    """
    answers = cut_lineage(read_answers(extractions))
    relations = cut_lineage(raw_relations(answers))
    graph = Graph(
        **merge_entities(raw_entities(answers)), **merge_relations(relations),
        processed=answers.select("chunk_id").distinct(),
    )
    graph.staged = (answers, relations)
    return graph


def merge_graphs(stored: Graph, new: Graph) -> Graph:
    """Stored rows keep their name, type, confidence and snippet; new properties overwrite."""
    both = {k: stored.tables()[k].withColumn("__age", F.lit(0)).unionByName(new.tables()[k].withColumn("__age", F.lit(1))) for k in stored.tables()}
    pick = lambda k, keys, order: first_by(both[k], keys, [order]).drop("__age")
    union = lambda k: both[k].drop("__age").distinct()
    # aliases that come new stand behind all stored ones, whatever order their batch counts in
    last, first = (t.aliases.agg(f(F.get("place", F.lit(0)))).scalar() for t, f in ((stored, F.max), (new, F.min)))
    behind = F.greatest(F.lit(0), F.coalesce(last + 1 - first, F.lit(0)))
    place = F.when(F.col("__age") == 0, F.col("place")).otherwise(F.concat(F.array(F.get("place", F.lit(0)) + behind), F.slice("place", 2, 1 << 30)))
    aliases = both["aliases"].withColumn("place", place).groupBy("entity_id", "alias").agg(F.min("place").alias("place"))
    return Graph(
        entities=pick("entities", ["entity_id"], F.col("__age")), aliases=aliases,
        properties=pick("properties", ["entity_id", "key"], -F.col("__age")), mentions=union("mentions"),
        relations=pick("relations", ["relation_id"], F.col("__age")), evidence=union("evidence"), processed=union("processed"),
    )


def update_graph(stored: Graph, extractions: DataFrame) -> Graph:
    """Add the answers of chunks that were not processed before."""
    return merge_graphs(stored, build_graph(extractions.join(stored.processed, "chunk_id", "left_anti")))


# ---- structure -----------------------------------------------------------------------------------


def graph_stats(graph: Graph) -> DataFrame:
    """Totals, counts per entity and relation type, papers and chunks covered."""
    one = lambda df, kind: df.select(F.lit(kind).alias("kind"), "item", "n")
    count = lambda df, by: df.groupBy(F.col(by).alias("item")).agg(F.count("*").alias("n"))
    total = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("item"), "n")
    return (
        one(total(graph.entities, "entities"), "total").union(one(total(graph.relations, "relations"), "total"))
        .union(one(total(graph.mentions.select("paper_id").distinct(), "papers"), "total"))
        .union(one(total(graph.processed, "chunks"), "total"))
        .union(one(count(graph.entities, "entity_type"), "entity_type")).union(one(count(graph.relations, "relation_type"), "relation_type"))
    )


def degree(relations: DataFrame, collapse: bool = True) -> DataFrame:
    """Edges per node; parallel edges count once with ``collapse``, a loop counts twice."""
    edges = relations.select("subject_id", "object_id")
    edges = edges.distinct() if collapse else edges
    ends = edges.select(F.explode(F.array("subject_id", "object_id")).alias("entity_id"))
    return ends.groupBy("entity_id").agg(F.count("*").alias("degree"))


def entity_relevance(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Degree over the largest degree, 0 for unconnected entities."""
    d = degree(relations)
    top = d.agg(F.max("degree")).scalar()
    out = entities.select("entity_id").join(d, "entity_id", "left")
    return out.select("entity_id", F.coalesce("degree", F.lit(0)).alias("degree")).withColumn(
        "relevance", F.when(top > 0, F.col("degree") / top).otherwise(F.lit(0.0))
    )


def induced_edges(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """Relations with both ends among the nodes."""
    side = lambda c: nodes.select(F.col("entity_id").alias(c))
    return relations.join(side("subject_id"), "subject_id", "left_semi").join(side("object_id"), "object_id", "left_semi")


def select_subgraph(
    entities: DataFrame, relations: DataFrame, top: int = 100, types: list[str] | None = None, mentions: DataFrame | None = None, paper: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The ``top`` best connected entities (of some types, of one paper) and the edges among them."""
    nodes = entities.where(F.col("entity_type").isin(*types)) if types else entities
    if paper is not None:
        nodes = nodes.join(mentions.where(F.col("paper_id") == paper).select("entity_id").distinct(), "entity_id", "left_semi")
    ranked = nodes.join(degree(relations, collapse=False), "entity_id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    chosen = ranked.orderBy(F.desc("degree"), F.asc("entity_id")).limit(top)
    return chosen, induced_edges(relations, chosen)


def display_attrs(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Size and label of nodes, width of edges."""
    d = F.coalesce("degree", F.lit(0))
    nodes = entities.join(degree(relations, collapse=False), "entity_id", "left").select(
        "entity_id", F.left("name", F.lit(30)).alias("label"), d.alias("degree"), node_size(d).alias("size")
    )
    return nodes, relations.select("relation_id", "relation_type", edge_width(F.col("confidence")).alias("width"))


def undirected(relations: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("subject_id").alias("node"), F.col("object_id").alias("next")), F.struct(F.col("object_id").alias("node"), F.col("subject_id").alias("next")))
    return relations.select(F.explode(ends).alias("x")).select("x.*").distinct()


def expand(frontier: DataFrame, edges: DataFrame, visited: DataFrame) -> DataFrame:
    """One hop: neighbours of ``frontier(seed, node)`` that were not visited from the same seed.

    Edges and frontier are written tables: adaptive execution sends the frontier to the edges if it
    turns out small, and splits the edges of a hub otherwise.
    """
    step = edges.join(frontier, "node").select("seed", F.col("next").alias("node")).distinct()
    return step.join(visited, ["seed", "node"], "left_anti")


BITS = 64  # seeds that share a row


def neighborhood(relations: DataFrame, seeds: DataFrame, hops: int = 1) -> DataFrame:
    """Breadth-first search from every seed at once, edges taken both ways: ``seed, node, hop``.

    Seeds are numbered, and a row (node, block of ``BITS`` seeds) has a bit for each seed that has reached the node. A hop sends a row's
    bits along the node's edges and joins what arrives by OR, in each task first, so seeds with common neighbours share rows
    and edges are read once a hop. When most nodes have been reached from every seed, edges to them are left out. Each hop is
    written, so the plan stays short.
    """
    ends = lambda a, b: relations.select(F.col(a).alias("a"), F.col(b).alias("b"))
    # bits that come twice join to the same, so one hop needs no distinct edges
    edges = ends("subject_id", "object_id").union(ends("object_id", "subject_id")) if hops == 1 else cut_lineage(undirected(relations).withColumnsRenamed({"node": "a", "next": "b"}))
    named = seeds.select(F.col("entity_id").alias("seed")).distinct()
    named = cut_lineage(cut_lineage(named).withColumn("sid", F.monotonically_increasing_id()))  # numbers run on within a task
    block = F.floor(F.col("sid") / BITS)
    own = F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(sid, {BITS}) as int))"))
    front = named.groupBy(F.col("seed").alias("node"), block.alias("block")).agg(own.alias("bits"))
    front = cut_lineage(front)
    reached, levels = front, [front.withColumn("hop", F.lit(0))]
    masks = cut_lineage(named.groupBy(block.alias("block")).agg(own.alias("all")))
    nodes, blocks = edges.select("a").distinct().count() if hops > 1 else 0, masks.count()
    for hop in range(1, hops + 1):
        along = edges
        if hop > 1:
            done = reached.join(masks, "block").where(F.col("bits") == F.col("all")).groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") == blocks)
            done = cut_lineage(done.select(F.col("node").alias("b")))
            if 2 * done.count() > nodes:
                along = edges.join(done, "b", "left_anti")
        met = front.join(along, front["node"] == along["a"]).groupBy(F.col("b").alias("node"), "block").agg(F.bit_or("bits").alias("came"))
        now = cut_lineage(met.join(reached, ["node", "block"], "full"))
        fresh = F.col("came").bitwiseAND(F.bitwise_not(F.coalesce("bits", F.lit(0).cast("bigint"))))
        front = now.where(F.col("came").isNotNull()).select("node", "block", fresh.alias("bits")).where(F.col("bits") != 0)
        levels.append(front.withColumn("hop", F.lit(hop)))
        both = F.coalesce("bits", F.lit(0).cast("bigint")).bitwiseOR(F.coalesce("came", F.lit(0).cast("bigint")))
        reached = now.select("node", "block", both.alias("bits"))
    rows = levels[0]
    for level in levels[1:]:
        rows = rows.unionByName(level)
    held = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("bit_get", F.col("bits"), i) == 1)
    rows = rows.select("node", "hop", "block", F.explode(held).alias("bit"))
    return rows.withColumn("sid", F.col("block") * BITS + F.col("bit")).join(named, "sid").select("seed", "node", "hop")


def neighborhood_relations(relations: DataFrame, visited: DataFrame) -> DataFrame:
    """Relations inside the neighbourhood of each seed."""
    side = lambda c: visited.select("seed", F.col("node").alias(c))
    first = relations.join(side("subject_id"), "subject_id")
    return first.join(side("object_id"), ["seed", "object_id"])


def inside_relations(relations: DataFrame, seeds: DataFrame, hops: int = 1) -> DataFrame:
    """``neighborhood_relations`` of the neighbourhoods of ``seeds``.

    A relation with an end that is less than ``hops`` away lies inside, since its other end is one hop further at most: those need the
    nodes on the way only. Ends of the others are both as far as can be, and are looked up by their two names alone; what is found
    takes its further columns at last.
    """
    visited = neighborhood(relations, seeds, hops)
    near = cut_lineage(visited.where(F.col("hop") < hops).select("seed", "node"))
    whole = relations.where(F.col("subject_id").isNotNull() & F.col("object_id").isNotNull())
    side = lambda c: near.select("seed", F.col("node").alias(c))
    first = whole.join(side("subject_id"), "subject_id")
    second = whole.join(side("object_id"), "object_id")
    second = second.where(F.col("subject_id") != F.col("seed")) if hops == 1 else second.join(side("subject_id"), ["seed", "subject_id"], "left_anti")
    far = visited.where(F.col("hop") == hops)
    ends = whole.select("subject_id", "object_id").distinct() if hops > 1 else whole.select("subject_id", "object_id")
    met = neighborhood_relations(ends, far).select("seed", "subject_id", "object_id")
    met = cut_lineage(met if hops > 1 else met.distinct())
    return first.unionByName(second).unionByName(whole.join(met, ["subject_id", "object_id"]))


def entity_papers(mentions: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    m = mentions.select("entity_id", "paper_id").distinct()
    return m if entities is None else m.join(entities.select("entity_id").distinct(), "entity_id", "left_semi")


def paper_entities(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities by paper. Names are few bytes on disk and many as rows, so they are never a side that is sent whole."""
    return mentions.select("paper_id", "entity_id").distinct().join(entities.hint("merge"), "entity_id")


# ---- search --------------------------------------------------------------------------------------


def names_of(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Searchable names: the name (without a ``place``) and the aliases ``(entity_id, place, alias)``."""
    main = entities.select("entity_id", F.lit(None).cast("array<bigint>").alias("place"), F.lower("name").alias("text"))
    return main.unionByName(aliases.select("entity_id", "place", F.lower("alias").alias("text")))


def grams(text: Column, size: int) -> Column:
    n = F.length(text)
    all_grams = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(n >= size, F.array_distinct(all_grams))


def search_entities(
    terms: DataFrame, entities: DataFrame, aliases: DataFrame, degrees: DataFrame, types: list[str] | None = None, k: int = 5,
) -> DataFrame:
    """Best ``k`` entities for each of ``terms(term_id, term)`` by name: equal 1.0, contained 0.8,
    else the first alias that is equal 0.9 or contained in 0.7; a hundredth per edge on top.

    "Contains" becomes an equi-join: a name that contains the term contains all its three-letter
    pieces, so names are listed under their pieces and a term looks up its rarest piece only. The
    hits are checked in full.
    """
    nodes = entities.where(F.col("entity_type").isin(*types)) if types else entities
    kept = aliases.join(nodes.select("entity_id"), "entity_id", "left_semi") if types else aliases
    names = names_of(nodes, kept)
    t = terms.withColumn("term", F.lower("term")).where(F.length("term") > 0)
    piece = lambda c: F.coalesce(grams(c, 3), F.array(F.lit(None).cast("string")))
    short_terms = t.where(F.length("term") < 3)
    pieces = exploded(t.where(F.length("term") >= 3).select("term", piece(F.col("term")).alias("g")).distinct(), ["term"], "g", "gram")
    pieces = cut_lineage(pieces)
    # Names are listed under the pieces that some term has; the list is written, as it is read twice.
    listed = exploded(names.select("entity_id", "place", "text", grams(F.col("text"), 3).alias("g")), ["entity_id", "place", "text"], "g", "gram")
    listed = cut_lineage(listed.join(pieces.select("gram").distinct(), "gram", "left_semi"))
    rarity = listed.groupBy("gram").agg(F.count("*").alias("df"))
    rare = pieces.join(rarity, "gram", "left").groupBy("term").agg(F.min_by("gram", F.struct(F.coalesce("df", F.lit(0)), "gram")).alias("gram"))
    rare = cut_lineage(rare)
    # Written text columns are small on disk and tens of times larger as rows: the list is never a side that is sent whole.
    # Pieces that most names have are nobody's rarest one: their lists stay behind.
    asked = listed.join(rare.select("gram").distinct(), "gram", "left_semi")
    hits = asked.hint("merge").join(rare, "gram").where(F.col("text").contains(F.col("term")))
    hits = hits.select("entity_id", "place", "text", "term")
    if not short_terms.isEmpty():
        tiny = names.select("entity_id", "place", "text", F.array_distinct(F.concat(F.coalesce(grams(F.col("text"), 1), F.array().cast("array<string>")), F.coalesce(grams(F.col("text"), 2), F.array().cast("array<string>")))).alias("g"))
        tiny = exploded(tiny, ["entity_id", "place", "text"], "g", "term")
        hits = hits.unionByName(tiny.join(F.broadcast(short_terms.select("term").distinct()), "term"))  # one or two letters each
    equal = F.col("text") == F.col("term")
    by_name = F.max(F.when(F.col("place").isNull(), F.when(equal, 1.0).otherwise(0.8)))
    by_alias = F.min_by(F.when(equal, 0.9).otherwise(0.7), F.col("place"))
    best = hits.groupBy("term", "entity_id").agg(F.coalesce(by_name, by_alias).alias("match"))
    best = best.join(degrees, "entity_id", "left").withColumn("score", F.round(F.col("match") + 0.01 * F.coalesce("degree", F.lit(0)), 6))
    top = top_k(best, ["term"], [F.desc("score"), F.asc("entity_id")], k).select("term", "entity_id", "score", "rank")
    return t.join(top, "term")


def link_questions(questions: DataFrame, entities: DataFrame, aliases: DataFrame, degrees: DataFrame, most: int = 3) -> DataFrame:
    """Entities named in each question: phrases in order, the best entity of each, first three."""
    phrases = questions.select("query_id", F.posexplode(candidate_phrases("question")).alias("pos", "term"))
    distinct = phrases.select(F.lower("term").alias("term")).distinct().withColumn("term_id", F.col("term"))
    found = search_entities(distinct, entities, aliases, degrees, k=1).select("term", "entity_id")
    per = phrases.withColumn("term", F.lower("term")).join(found, "term").groupBy("query_id", "entity_id").agg(F.min("pos").alias("pos"))
    return top_k(per, ["query_id"], ["pos"], most).select("query_id", "entity_id", "rank")


def entity_context(seeds: DataFrame, entities: DataFrame, mentions: DataFrame, relations: DataFrame, hops: int = 1) -> DataFrame:
    """Lines describing each seed entity for a prompt: ``seed, part, pos, line``.

    A head line, one line per paper that mentions it, a heading for the relations of its neighbourhood if
    there are any, and one line for each.
    Rows instead of one text per entity, because a hub has any number of relations.
    """
    s = seeds.select(F.col("entity_id").alias("seed")).distinct()
    head = s.join(entities, F.col("seed") == F.col("entity_id")).select(
        "seed", F.lit(0).alias("part"), F.lit("").alias("pos"), F.format_string("### Entidad: %s (%s)", "name", "entity_type").alias("line")
    )
    papers = mentions.withColumnRenamed("entity_id", "seed").select("seed", "paper_id").distinct().join(s, "seed", "left_semi").select(
        "seed", F.lit(1).alias("part"), F.col("paper_id").alias("pos"), F.concat(F.lit("Mencionada en: "), "paper_id").alias("line")
    )
    inside = inside_relations(relations, seeds, hops)
    names = entities.select(F.col("entity_id").alias("object_id"), F.col("name").alias("object_name"))
    named = inside.join(names.hint("merge"), "object_id", "left")  # all names: never sent whole
    shown = F.when(F.col("object_id") == F.col("seed"), F.col("object_id")).otherwise(F.coalesce("object_name", F.col("object_id")))
    lines = named.select(
        "seed", F.lit(3).alias("part"), F.col("relation_id").alias("pos"),
        F.format_string("  - [%s] %s (%s)  [conf=%.2f]", F.col("relation_type"), shown, F.initcap(F.substring_index("object_id", "::", 1)), F.col("confidence")).alias("line"),
    )
    heading = inside.select("seed").distinct().select("seed", F.lit(2).alias("part"), F.lit("").alias("pos"), F.lit(fixed.RELATIONS_TITLE).alias("line"))
    return head.unionByName(papers).unionByName(heading).unionByName(lines)


def graph_search(
    questions: DataFrame, entities: DataFrame, aliases: DataFrame, mentions: DataFrame, relations: DataFrame, hits: DataFrame, hops: int = 1,
) -> DataFrame:
    """Prompt lines per question, in order of ``section`` (graph, then chunks), ``rank, part, pos``.

    The linked entities with their neighbourhood under a title, then the hits (with ``text, title, year,
    authors, page_number, paper_id``) under theirs: score and page, source, text; a question without hits
    gets the fallback line.
    """
    # at most three rows per question, read four times below
    linked = cut_lineage(link_questions(questions, entities, aliases, degree(relations)))
    lines = entity_context(linked.select("entity_id"), entities, mentions, relations, hops)
    row = lambda section, rank, part, line: (F.lit(section).alias("section"), rank.alias("rank"), F.lit(part).alias("part"), F.lit("").alias("pos"), line.alias("line"))
    graph_title = linked.select("query_id").distinct().select("query_id", *row("graph", F.lit(0), 0, F.lit(fixed.GRAPH_TITLE)))
    graph_part = lines.join(linked.withColumnRenamed("entity_id", "seed"), "seed").select(
        "query_id", F.lit("graph").alias("section"), "rank", "part", "pos", "line"
    )
    found = hits.groupBy("query_id").agg(F.count("*").alias("n"))
    first = F.when(F.col("n") > 0, fixed.GRAPH_FRAGMENTS_TITLE).otherwise(fixed.CONTEXT_EMPTY)
    text_title = questions.select("query_id").join(found, "query_id", "left").select("query_id", *row("chunks", F.lit(0), 0, first))
    year = F.when(F.coalesce("year", F.lit(0)) == 0, F.lit("N/A")).otherwise(F.col("year").cast("string"))
    source = F.format_string("**Fuente:** %s (%s) — %s", F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("paper_id")), year, author_line(F.col("authors")))
    texts = F.array(
        F.struct(F.lit(0).alias("part"), F.format_string("### Fragmento %d [score=%.3f, p.%d]", "rank", "score", "page_number").alias("line")),
        F.struct(F.lit(1).alias("part"), source.alias("line")), F.struct(F.lit(2).alias("part"), F.col("text").alias("line")),
    )
    text_part = hits.select("query_id", F.lit("chunks").alias("section"), "rank", F.col("chunk_id").alias("pos"), F.explode(texts).alias("x"))
    text_part = text_part.select("query_id", "section", "rank", "x.part", "pos", "x.line")
    return graph_title.unionByName(graph_part).unionByName(text_title).unionByName(text_part)
