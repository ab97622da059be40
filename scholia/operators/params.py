"""Population parameters: wide study tables to long facts, selection, summaries, lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scholia import fixed
from scholia.functions import records as R
from scholia.functions.text import extract_binomials
from scholia.operators.skew import first_by


def unpivot_table(
    table: DataFrame, columns: list[tuple[str, str, str]], source: str, *, n: str | None = None, method: Column | None = None,
    sex: str | None = None, locality: str | None = None, legacy_zero: bool = False,
) -> DataFrame:
    """One row per measured value of a study table keyed by ``SpecCode`` and ``ord``.

    ``Country`` and ``DataRef`` (the number of the reference) are taken where the table has them.

    Values that are missing or a sentinel disappear; zero is a value, unless ``legacy_zero`` asks
    for the old reading in which a zero of a mixed-case column was lost.
    """
    def value(col: str) -> Column:
        v = R.safe_float(col)
        return F.nullif(v, F.lit(0.0)) if legacy_zero and col != col.lower() else v

    null = F.lit(None).cast("string")
    country = F.col("Country").cast("string") if "Country" in table.columns else null
    reference = R.safe_int("DataRef") if "DataRef" in table.columns else F.lit(None).cast("bigint")
    facts = F.array(*[F.struct(F.lit(p).alias("parameter"), value(c).alias("value"), F.lit(u).alias("unit"), F.lit(i).alias("rank")) for i, (c, p, u) in enumerate(columns)])
    long = table.select(
        "SpecCode", F.lit(source).alias("src"), "ord", F.coalesce(method, null).alias("method") if method is not None else null.alias("method"),
        (F.col(locality) if locality else null).alias("locality"), (R.normalize_sex(sex) if sex else null).alias("sex"),
        (R.safe_int(n) if n else F.lit(None).cast("bigint")).alias("n_samples"), country.alias("country"), reference.alias("data_ref"), F.explode(facts).alias("x"),
    )
    return long.where(F.col("x.value").isNotNull()).select(
        "SpecCode", "src", F.struct("ord", F.col("x.rank")).alias("pos"), "x.parameter", "x.value", "x.unit", "method", "locality", "country", "sex", "n_samples", "data_ref"
    ).withColumn("source_db", F.lit("fishbase")).withColumn("confidence", F.lit("curated"))


def unpivot_parameters(tables: dict[str, DataFrame], legacy_zero: bool = False) -> DataFrame:
    """All known study tables as one long table of facts."""
    length_type = lambda: F.concat(F.lit("Length type: "), F.coalesce(F.nullif(F.col("Type"), F.lit("")), F.lit("TL")))
    readers = {
        "growth": lambda d: unpivot_table(d, fixed.GROWTH_COLUMNS, "growth", n="N", method=F.col("Growth_f_name"), sex="Sex", locality="Locality", legacy_zero=legacy_zero),
        "length_weight": lambda d: unpivot_table(d, fixed.LENGTH_WEIGHT_COLUMNS, "length_weight", n="Number", method=length_type(), sex="Sex", locality="Locality", legacy_zero=legacy_zero),
        "ecology": lambda d: unpivot_table(d, fixed.ECOLOGY_COLUMNS, "ecology", method=F.lit("FishBase ecology table"), legacy_zero=legacy_zero),
        "maturity": lambda d: unpivot_table(d, fixed.MATURITY_COLUMNS, "maturity", n="n", method=F.col("Method"), sex="Sex", locality="Locality", legacy_zero=legacy_zero),
        "qb": lambda d: unpivot_table(d, fixed.QB_COLUMNS, "qb", method=F.col("Basis"), locality="Locality", legacy_zero=legacy_zero),
    }
    order = list(readers)
    parts = [readers[name](tables[name]).withColumn("src_rank", F.lit(i)) for i, name in enumerate(order) if name in tables]
    return reduce(DataFrame.unionByName, parts)


def filter_ecosystem(params: DataFrame, ecosystem: str, by: list[str] | None = None) -> DataFrame:
    """Facts from the ecosystem; a (species, table) group without any keeps all of its facts.

    The flag per group is a small aggregate joined back, so a large group is never gathered.
    """
    by = by or ["SpecCode", "src"]
    match = F.coalesce(F.lower("locality").contains(ecosystem.lower()), F.lit(False))
    flags = params.groupBy(*by).agg(F.bool_or(match).alias("__any"))
    return params.withColumn("__m", match).join(flags, by).where(F.col("__m") | ~F.col("__any")).drop("__m", "__any")


def sample_order() -> list[Column]:
    """The largest sample first, records without any in their order behind."""
    return [F.coalesce(-F.col("n_samples").cast("double"), F.lit(float("inf"))), F.col("src_rank"), F.col("pos")]


def best_parameter(params: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Largest sample per (species, parameter); without any sample size the first record."""
    by = by or ["SpecCode", "parameter"]
    return first_by(params, by, sample_order())


def parameter_summary(params: DataFrame, required: list[str] = fixed.REQUIRED_PARAMETERS, by: str = "SpecCode", species: DataFrame | None = None) -> DataFrame:
    """One row per species: value, unit, source and confidence of each required parameter.

    ``species`` names them all, with those that have no fact; without it only species with facts are known.
    """
    record = F.struct("value", "unit", F.col("source_db").alias("source"), "confidence")
    best = [F.min_by(record, F.when(F.col("parameter") == p, F.struct(*sample_order()))).alias(p) for p in required]
    wide = params.where(F.col("parameter").isin(*required)).groupBy(by).agg(*best)  # one row a species leaves each task
    if species is not None:
        wide = species.select(by).distinct().join(wide, by, "left")
    cols = [F.col(by)]
    for p in required:
        told = [F.col(f"{p}.{c}").alias(f"{p}_{c}") for c in ("unit", "source")]
        cols += [F.col(f"{p}.value").alias(p), *told, F.coalesce(f"{p}.confidence", F.lit(fixed.NO_DATA)).alias(f"{p}_confidence")]
    return wide.select(*cols)


def resolve_species(names: DataFrame, species: DataFrame, name: str = "name") -> DataFrame:
    """Code of each name by genus and (when given) epithet; the first record wins.

    ``species(SpecCode, Genus, Species)`` is reduced per key before the join, so neither a genus
    with very many species nor a name asked for very often multiplies rows.
    """
    by_both = species.groupBy(F.col("Genus").alias("__g"), F.col("Species").alias("__e")).agg(F.min("SpecCode").alias("code2"))
    by_genus = species.groupBy(F.col("Genus").alias("__g")).agg(F.min("SpecCode").alias("code1"))
    n = names.withColumn("__g", R.genus(name)).withColumn("__e", R.epithet(name))
    out = n.join(by_both, ["__g", "__e"], "left").join(by_genus, "__g", "left")
    return out.withColumn("SpecCode", F.when(F.col("__e").isNull(), F.col("code1")).otherwise(F.col("code2"))).drop("__g", "__e", "code1", "code2")


def habitat_flags(resolved: DataFrame, habitats: DataFrame) -> DataFrame:
    """Species records with the flags ``fresh``, ``salt`` and ``brack`` of ``habitats(SpecCode, Fresh, Saltwater,
    Brack)``: set by any number but 0 (the source writes 1 or -1). Where nothing is known a species lives in salt
    water; a name without a species nowhere."""
    names = {"fresh": "Fresh", "salt": "Saltwater", "brack": "Brack"}
    flag = lambda c: F.col(c).cast("string").try_cast("int") != 0
    own = habitats.groupBy("SpecCode").agg(*[F.bool_or(flag(c)).alias(n) for n, c in names.items()])
    out = resolved.join(own, "SpecCode", "left")
    return out.withColumns({n: F.coalesce(n, F.col("SpecCode").isNotNull() if n == "salt" else F.lit(False)) for n in names})


def enrich_with_parameters(questions: DataFrame, species: DataFrame, params: DataFrame, most: int = 2, ecosystem: str | None = None) -> DataFrame:
    """The first of at most ``most`` species named in each question that has parameters.

    ``ecosystem`` counts the facts of that region only, for each study table that has any (``filter_ecosystem``).
    """
    if ecosystem is not None:
        params = filter_ecosystem(params, ecosystem)
    named = F.slice(extract_binomials("question"), 1, most)
    q = questions.select("query_id", F.posexplode(named).alias("pos", "name"))
    counts = params.groupBy("SpecCode").agg(F.count("*").alias("n_parameters"))
    found = resolve_species(q, species).join(counts, "SpecCode")
    return first_by(found, ["query_id"], ["pos"], ["query_id", "name", "SpecCode", "n_parameters"])
