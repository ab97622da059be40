"""Literature-shaped views over the shared test tables, so that every query reads real rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.fixed import SOURCES
from scholia.registry import Tables
from scholia.session import parallelism

SEQ_STRIDE = 1 << 31  # positions reserved per document: a text has fewer characters, so fewer lines


def lines() -> F.Column:
    return F.split("text", "\n")


def docs(t: Tables) -> DataFrame:
    return t.documents.withColumn("paper_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))


def chunks(t: Tables) -> DataFrame:
    """Every line that isn't blank; numbered inside the row, so without any shuffle."""
    kept = F.filter(lines(), lambda x: x.rlike(r"\S"))
    d = docs(t).select("doc_id", "paper_id", "lang", "source", kept.alias("ls"))
    return d.select(
        "doc_id", "paper_id", "lang", "source", F.size("ls").cast("bigint").alias("total_chunks"),
        F.posexplode_outer("ls").alias("i", "text"),
    ).where(F.col("i").isNotNull()).select(
        "doc_id", "paper_id", "lang", "source", "text", "total_chunks",
        F.col("i").cast("bigint").alias("chunk_index"),
        F.format_string("%s_chunk_%03d", "paper_id", "i").alias("chunk_id"),
        (F.col("doc_id") * SEQ_STRIDE + F.col("i")).alias("seq"),
        (F.floor(F.col("i") / 10) + 1).cast("bigint").alias("page_number"),
        F.concat("paper_id", F.lit(".pdf")).alias("source_pdf"),
    )


def species_base(t: Tables) -> DataFrame:
    """One binomial per question: its first two words."""
    w = F.regexp_extract_all(F.regexp_replace("text", "ß", "ss"), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    return t.benchmark.select(
        "item_id", F.concat_ws(" ", F.initcap(F.get(w, 0)), F.lower(F.get(w, 1))).alias("species")
    )


def species(t: Tables) -> DataFrame:
    """Names with the noise of real lists: case and underscore copies, open names, hybrids."""
    s = species_base(t)
    genus, epithet = F.substring_index("species", " ", 1), F.substring_index("species", " ", -1)
    variants = F.array(
        F.col("species"), F.upper("species"), F.translate("species", " ", "_"),
        F.concat(genus, F.lit(" sp.")), F.concat(genus, F.lit("/"), epithet),
    )
    return s.select("item_id", F.posexplode(variants).alias("variant", "species")).select(
        (F.col("item_id") * 5 + F.col("variant")).alias("pos"), "species",
        F.get(F.lit(["plain", "upper", "underscore", "open", "hybrid"]), F.col("variant")).alias("kind"),
    )


def articles(t: Tables) -> DataFrame:
    n_items = t.benchmark.agg(F.count("*").alias("n"))
    first_line = F.get(lines(), 0)
    sentence = F.trim(F.regexp_extract(first_line, r"^[^.]*", 0))
    number = F.regexp_extract("source", "[0-9]+", 0).cast("int") % 6
    # the text goes on behind the title: nothing of it is left out
    rest = F.substring("text", F.length(F.regexp_extract(first_line, r"^[^.]*\.?", 0)) + 1, F.length("text"))
    has_doi = F.col("doc_id") % 5 != 0
    d = t.documents.withColumn("item_id", F.col("doc_id") % n_items.scalar())
    d = d.join(species_base(t), "item_id")
    w = F.split("title", " ")
    return d.select(
        F.col("doc_id").alias("pos"), "item_id", "species", "lang",
        F.when(F.col("doc_id") % 3 == 0, F.concat("species", F.lit(": "), sentence)).otherwise(sentence).alias("title"),
        F.nullif(F.trim(F.regexp_replace(rest, r"^\n", "")), F.lit("")).alias("abstract"),
        F.when(F.col("doc_id") % 11 != 0, (1990 + F.col("doc_id") % 35).cast("int")).alias("year"),
        F.when(has_doi, F.concat(F.lit("10.1000/"), F.col("doc_id").cast("string"))).alias("doi"),
        F.get(F.lit(SOURCES), number).alias("source"),
        number.cast("bigint").alias("source_prio"),
        F.when(F.col("doc_id") % 3 == 1, F.array("lang", "source")).alias("keywords"),
        F.concat(F.lit("Journal "), F.col("source")).alias("journal"),
    ).withColumn("authors", F.filter(F.slice(w, 1, 2), lambda x: x != ""))


def turns(t: Tables) -> DataFrame:
    """Conversations as documents, turns as their pages."""
    return t.conversations.select(
        F.col("conv_id").alias("paper_id"), (F.col("turn") + 1).alias("page_number"), "text"
    )


def framed_turns(t: Tables) -> DataFrame:
    """Pages with a running header and footer line."""
    return turns(t).withColumn(
        "text",
        F.concat(
            F.lit("Journal "), (F.col("paper_id") % 3).cast("string"), F.lit("\n"), F.col("text"),
            F.lit("\nPage footer "), F.col("paper_id").cast("string"),
        ),
    )


def vectors(t: Tables) -> DataFrame:
    """Indexed vectors: the label plays the part of the paper."""
    return t.embeddings.select(
        F.col("vec_id").alias("seq"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("chunk_id"),
        F.concat(F.lit("paper_"), F.col("label").cast("string")).alias("paper_id"), "embedding",
    )


def questions(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def question_vectors(t: Tables) -> DataFrame:
    """Each question with a vector: that of the same number, counted around."""
    n = t.embeddings.agg(F.count("*").alias("n"))
    return questions(t).withColumn("vec_id", F.pmod("query_id", n.scalar())).join(
        t.embeddings.select("vec_id", "embedding"), "vec_id"
    ).select("query_id", "question", "embedding")


def hybrid_chunks(t: Tables, among: DataFrame | None = None) -> DataFrame:
    """Text chunks with a vector each; those of ``among(chunk_id)`` only, if given."""
    n = t.embeddings.agg(F.count("*").alias("n"))
    c = chunks(t) if among is None else chunks(t).join(among, "chunk_id", "left_semi")
    return c.withColumn("vec_id", F.pmod("seq", n.scalar())).join(
        t.embeddings.select("vec_id", "embedding"), "vec_id"
    ).drop("vec_id")


def habitats(t: Tables) -> DataFrame:
    flag = lambda n: F.col("s_nationkey") % n == 0
    return t.supplier.select(
        F.col("s_name").alias("species"), flag(2).alias("marine"), flag(3).alias("freshwater"),
        flag(5).alias("terrestrial"),
    )


def marine_registry(t: Tables) -> DataFrame:
    """Names a marine register knows: suppliers of parts shipped in the first half of the list."""
    return t.supplier.where(F.col("s_acctbal") > 5000).select(F.col("s_name").alias("species"))


def statuses(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("article"), F.concat(F.lit("species_"), F.col("o_custkey").cast("string")).alias("species"),
        F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "failed")
        .otherwise("skipped").alias("status"),
    )


def attempts(t: Tables) -> DataFrame:
    """Three extraction attempts per document."""
    return t.documents.select(
        "doc_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("prio"), "n_chars"
    ).select(
        "doc_id", F.col("prio").cast("bigint"), F.concat(F.lit("extractor_"), F.col("prio").cast("string")).alias("provider"),
        F.expr("n_chars * prio div 3").alias("chars"),
    ).withColumn("pages", F.expr("1 + chars div 2000"))


def entities(t: Tables) -> DataFrame:
    """The star schema as a knowledge graph: its rows are entities."""

    def of(df, kind, key, name):
        return df.select(
            F.concat(F.lit(f"{kind.lower()}::"), F.col(key).cast("string")).alias("entity_id"),
            F.lit(kind).alias("entity_type"), F.col(name).alias("name"),
            F.array(F.upper(name), F.concat(F.lit(f"{kind} "), F.col(key).cast("string"))).alias("aliases"),
        )

    parts = [
        of(t.region, "Location", "r_regionkey", "r_name").withColumn("entity_id", F.regexp_replace("entity_id", "location", "region")),
        of(t.nation, "Location", "n_nationkey", "n_name").withColumn("entity_id", F.regexp_replace("entity_id", "location", "nation")),
        of(t.customer, "Author", "c_custkey", "c_name"),
        of(t.supplier, "Method", "s_suppkey", "s_name"),
        of(t.part, "Species", "p_partkey", "p_name"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relations(t: Tables) -> DataFrame:
    def of(df, subject, skey, rel, obj, okey):
        return df.select(
            F.concat(F.lit(f"{subject}::"), F.col(skey).cast("string")).alias("subject_id"),
            F.lit(rel).alias("relation_type"),
            F.concat(F.lit(f"{obj}::"), F.col(okey).cast("string")).alias("object_id"),
            ((F.col(skey) % 100) / 100.0).alias("confidence"),
        )

    supplied = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    parts = [
        of(t.customer, "author", "c_custkey", "found_in", "nation", "c_nationkey"),
        of(t.nation, "nation", "n_nationkey", "co_occurs_with", "region", "n_regionkey"),
        of(t.supplier, "method", "s_suppkey", "studies", "nation", "s_nationkey"),
        of(t.supplier, "method", "s_suppkey", "measured_by", "nation", "s_nationkey"),
        of(supplied, "method", "l_suppkey", "interacts_with", "species", "l_partkey"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("relation_id", F.concat_ws("::", "subject_id", "relation_type", "object_id"))


def mentions(t: Tables) -> DataFrame:
    """(entity, paper) mentions of the graph: customers through their orders, parts and suppliers
    through the lines of the order."""
    o = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 50).alias("paper"))
    key = lambda c: F.col(c).cast("bigint").alias("key")
    kind = lambda name, c: F.when(F.col(c).isNotNull(), F.lit(name)).alias("kind")
    # orders are few bytes on disk and many as rows: never a side that is sent whole
    li = t.lineitem.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    ends = F.array(F.struct(kind("species", "l_partkey"), key("l_partkey")), F.struct(kind("method", "l_suppkey"), key("l_suppkey")))
    of_lines = li.select(F.explode(ends).alias("x"), "paper").select("x.kind", "x.key", "paper")
    # numbers are told apart, not names
    met = o.select(kind("author", "o_custkey"), key("o_custkey"), "paper").union(of_lines).distinct()
    return met.select(F.concat("kind", F.lit("::"), F.col("key").cast("string")).alias("entity_id"), F.concat(F.lit("paper_"), F.col("paper").cast("string")).alias("paper_id"))


def extractions(t: Tables) -> DataFrame:
    """Raw model answers, one per order: JSON with entities and relations, some fenced, some broken."""
    li = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.max("l_discount").alias("disc"))
    # parts and orders are few bytes on disk and many as rows: never a side that is sent whole
    li = li.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type").hint("merge"), "l_partkey")
    part = F.struct(
        F.concat("p_name", F.lit(" "), F.col("l_partkey").cast("string")).alias("name"),
        F.when(F.col("l_partkey") % 7 == 0, "Unknown").otherwise("Species").alias("type"),
        F.array(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("aliases"),
        F.struct(F.col("p_type").alias("kind")).alias("properties"),
    )
    rel = F.struct(
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("subject"),
        F.when(F.col("l_partkey") % 5 == 0, "invented").otherwise("studies").alias("relation"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("object"),
        (F.round(F.col("disc") * 100) / 5).alias("confidence"),
        F.concat(F.lit("line "), F.col("l_partkey").cast("string")).alias("context"),
    )
    j = li.join(t.orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    per_order = j.groupBy("l_orderkey", "o_custkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", part.alias("e")))), lambda x: x["e"]).alias("parts"),
        F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", rel.alias("r")))), lambda x: x["r"]).alias("rels"),
    )
    customer = F.struct(
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
        F.lit("Author").alias("type"),
        F.array(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("aliases"),
        F.struct(F.lit("customer").alias("kind")).alias("properties"),
    )
    body = F.to_json(F.struct(F.concat(F.array(customer), F.col("parts")).alias("entities"), F.col("rels").alias("relations")))
    # some answers give numbers in quotes
    body = F.when(F.col("l_orderkey") % 2 == 0, F.regexp_replace(body, r'"confidence":([0-9.]+)', '"confidence":"$1"')).otherwise(body)
    raw = (
        F.when(F.col("l_orderkey") % 17 == 0, F.concat(body, F.lit("}")))
        .when(F.col("l_orderkey") % 13 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .otherwise(body)
    )
    return per_order.select(
        F.concat(F.lit("chunk_"), F.col("l_orderkey").cast("string")).alias("chunk_id"),
        F.concat(F.lit("paper_"), (F.col("l_orderkey") % 50).cast("string")).alias("paper_id"),
        F.col("l_orderkey").alias("ord"), raw.alias("raw"),
    )


LINES_A_TASK = 250_000  # order lines that a task turns into facts: these are sorted there, without spilling
SPREAD = 4  # tasks over which the lines of one part are dealt


def by_part(t: Tables, lines: DataFrame) -> DataFrame:
    """Order lines with ``lot``, those of a part in few tasks: of a species a task then keeps one row, however many studies there are."""
    n = max(parallelism(t.spark), -(-t.lineitem.count() // LINES_A_TASK))
    lot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(SPREAD))
    return lines.withColumn("lot", lot).repartition(n, "l_partkey", "lot")


def growth(t: Tables) -> DataFrame:
    """Wide growth table: one study per order line."""
    li = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    li = li.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    study = by_part(t, li).groupBy("l_orderkey", "l_partkey", "l_linenumber", "n_name", "lot").agg(
        F.max("l_discount").alias("K"), F.max("l_extendedprice").alias("price"), F.max("l_tax").alias("tax"),
        F.max("l_quantity").alias("qty"), F.max("l_returnflag").alias("flag"),
    )
    return study.select(
        F.col("l_partkey").alias("SpecCode"), "K",
        F.when(F.col("l_linenumber") == 7, F.lit(-999.0)).otherwise(F.col("price") / 1000).alias("Loo"),
        (-F.col("tax")).alias("to"),
        F.when(F.col("qty") % 7 != 0, F.col("qty")).cast("string").alias("N"),
        F.when(F.col("flag") == "A", "1").when(F.col("flag") == "N", "0").when(F.col("flag") == "R", "2").alias("Sex"),
        F.col("n_name").alias("Locality"), F.lit(None).cast("string").alias("Growth_f_name"),
        F.upper("n_name").alias("Country"), F.col("l_orderkey").cast("string").alias("DataRef"),
        F.struct("l_orderkey", "l_linenumber", "n_name").alias("ord"),
    )


def length_weight(t: Tables) -> DataFrame:
    study = by_part(t, t.lineitem).groupBy("l_orderkey", "l_partkey", "l_linenumber", "lot").agg(
        F.max("l_tax").alias("a"), (2.5 + F.max("l_discount")).alias("b"), F.max("l_quantity").alias("qty")
    )
    return study.select(
        F.col("l_partkey").alias("SpecCode"), "a", "b", F.lit("TL").alias("Type"),
        F.col("qty").cast("string").alias("Number"), F.lit("0").alias("Sex"), F.lit(None).cast("string").alias("Locality"),
        F.struct("l_orderkey", "l_linenumber", F.lit("").alias("n_name")).alias("ord"),
    )


def _part_ord(t: Tables):
    line = t.lineitem.schema["l_linenumber"].dataType
    return F.struct(F.col("p_partkey").alias("l_orderkey"), F.lit(0).cast(line).alias("l_linenumber"), F.lit("").alias("n_name")).alias("ord")


def ecology(t: Tables) -> DataFrame:
    return t.part.where("p_size % 4 <> 0").select(
        F.col("p_partkey").alias("SpecCode"), (2 + F.col("p_size") / 25).alias("FoodTroph"), F.col("p_size").cast("string").alias("DataRef"), _part_ord(t),
    )


def maturity(t: Tables) -> DataFrame:
    """Every other age is the mark for a missing value."""
    return t.part.where("p_size % 3 = 0").select(
        F.col("p_partkey").alias("SpecCode"), (F.col("p_size") * 1.5).alias("Lm"), F.when(F.col("p_size") % 2 == 0, -9999.0).otherwise(F.col("p_size") / 10).alias("tm"),
        F.col("p_size").cast("string").alias("n"), F.col("p_type").alias("Method"), F.lit("1").alias("Sex"), F.col("p_brand").alias("Locality"),
        F.col("p_type").alias("Country"), (F.col("p_partkey") % 97).cast("string").alias("DataRef"), _part_ord(t),
    )


def qb(t: Tables) -> DataFrame:
    return t.part.where("p_partkey % 5 = 0").select(
        F.col("p_partkey").alias("SpecCode"), (F.col("p_retailprice") / 100).alias("QB"), F.col("p_brand").alias("Basis"), F.col("p_type").alias("Locality"), _part_ord(t),
    )


def species_habitats(t: Tables) -> DataFrame:
    """Habitat marks as the source writes them: 1, -1, 0 or nothing."""
    return t.part.where("p_partkey % 4 <> 3").select(
        F.col("p_partkey").alias("SpecCode"), F.when(F.col("p_size") % 2 == 0, "1").otherwise("0").alias("Fresh"),
        F.when(F.col("p_size") % 3 == 0, "-1").alias("Brack"), F.when(F.col("p_size") % 5 == 0, "1").when(F.col("p_size") % 7 != 0, "0").alias("Saltwater"),
    )


def spec_names(t: Tables) -> DataFrame:
    """Species behind the codes; several codes share a name, the lowest one is the accepted one."""
    return t.part.select(
        F.col("p_partkey").alias("SpecCode"), F.initcap(F.substring_index("p_name", " ", 1)).alias("Genus"),
        F.concat_ws("", F.substring_index("p_name", " ", -1), (F.col("p_partkey") % 50).cast("string")).alias("Species"),
    )
