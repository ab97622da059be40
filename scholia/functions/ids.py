"""Identifiers and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholia.functions.text import squeeze, strip, to_ascii

# Characters not allowed in a file name.
UNSAFE = '<>:"/\\|?*'


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def derive_paper_id(stem: Column | str) -> Column:
    """File stem to paper id: ASCII, anything but word characters and ``-`` to one ``_``."""
    t = F.regexp_replace(to_ascii(_c(stem)), r"[^A-Za-z0-9_\-]", "_")
    t = F.regexp_replace(F.regexp_replace(t, r"_+", "_"), r"^_+|_+$", "")
    return F.when(t == "", F.lit("paper")).otherwise(t)


def safe_name(col: Column | str, length: int = 80) -> Column:
    """Title to file name: unsafe characters and spaces to ``_``, cut."""
    t = F.translate(_c(col), UNSAFE, "_" * len(UNSAFE))
    return F.left(F.regexp_replace(squeeze(t), " ", "_"), F.lit(length))


def safe_species(col: Column | str) -> Column:
    return F.translate(_c(col), " /", "__")


def safe_doi(col: Column | str) -> Column:
    return F.translate(_c(col), "/.", "__")


def paper_id_from_title(title: Column | str, year: Column | str) -> Column:
    """Title and year to the id its downloaded file would get."""
    safe = safe_name(title)
    y = _c(year)
    stem = F.when(y.isNotNull() & (y != 0), F.concat_ws("_", y.cast("string"), safe)).otherwise(safe)
    t = F.regexp_replace(to_ascii(stem), r"[^A-Za-z0-9_\-]", "_")
    return F.regexp_replace(F.regexp_replace(t, r"_+", "_"), r"^_+|_+$", "")


def chunk_id(paper_id: Column | str, index: Column | str) -> Column:
    return F.format_string("%s_chunk_%03d", _c(paper_id), _c(index))


def entity_id(entity_type: Column | str, name: Column | str) -> Column:
    """``type::ascii_snake_name``."""
    return entity_id_of(strip(entity_type), to_ascii(F.lower(strip(name))))


def entity_id_of(entity_type: Column, folded: Column) -> Column:
    """``entity_id`` of a stripped type and a stripped lower-case name without anything outside ASCII."""
    t = F.btrim(F.regexp_replace(folded, "[^A-Za-z0-9]+", "_"), F.lit("_"))
    return F.concat(F.lower(entity_type), F.lit("::"), t)


def progress_key(species: Column, source: Column, title: Column) -> Column:
    return F.concat_ws("::", F.lower(strip(species)), source, F.lower(strip(title)))
