"""TEI documents (``paper_id``, ``xml``): sections and bibliographic data."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Fixed value: the TEI namespace.
TEI = "{http://www.tei-c.org/ns/1.0}"


def _text(element) -> str:
    return "" if element is None else "".join(element.itertext())


def sections_of(xml: str) -> list[str]:
    """Abstract, the divisions of the body (or the body), the reference list; else all text."""
    root = ET.fromstring(xml)
    body = root.find(f".//{TEI}body")
    parts = [_text(root.find(f".//{TEI}abstract"))]
    if body is not None:
        parts += [_text(d) for d in body.findall(f"{TEI}div")] or [_text(body)]
    parts.append(_text(root.find(f".//{TEI}back/{TEI}listBibl")))
    return [p for p in parts if p.strip()] or [t for t in [" ".join(_text(root).split())] if t]


def tei_sections(docs: DataFrame) -> DataFrame:
    """Ordered sections of each document as pages; unreadable XML gives an error row."""

    def run(batches):
        for pdf in batches:
            rows = []
            for pid, xml in zip(pdf["paper_id"], pdf["xml"]):
                try:
                    rows += [(pid, i, text, None) for i, text in enumerate(sections_of(xml), start=1)]
                except ET.ParseError as e:
                    rows.append((pid, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["paper_id", "page_number", "text", "error"]).astype({"page_number": "Int64"})

    return docs.select("paper_id", "xml").mapInPandas(run, "paper_id string, page_number bigint, text string, error string")


def metadata_of(xml: str) -> dict:
    root = ET.fromstring(xml)
    authors = []
    for author in root.iter(f"{TEI}author"):
        name = author.find(f"{TEI}persName")
        parts = [_text(author)] if name is None else [name.findtext(f"{TEI}forename", ""), name.findtext(f"{TEI}surname", "")]
        authors.append(" ".join(parts).strip())
    date = root.find(f".//{TEI}publicationStmt/{TEI}date")
    title = root.find(f".//{TEI}titleStmt/{TEI}title")
    abstract = root.find(f".//{TEI}abstract")
    return {
        "title": None if title is None else _text(title).strip(), "authors": [a for a in authors if a],
        "abstract": None if abstract is None else _text(abstract).strip(),
        "keywords": [t for t in (_text(k).strip() for k in root.findall(f".//{TEI}keywords/{TEI}term")) if t],
        "publication_date": None if date is None else date.get("when") or None,
        "doi": next((i.text.strip() for i in root.iter(f"{TEI}idno") if i.get("type") == "DOI" and i.text), None),
        "error": None,
    }


def tei_metadata(docs: DataFrame) -> DataFrame:
    """Title, authors, abstract, keywords, date, DOI and year of each document."""
    empty = {"title": None, "authors": [], "abstract": None, "keywords": [], "publication_date": None, "doi": None}

    def run(batches):
        for pdf in batches:
            rows = []
            for pid, xml in zip(pdf["paper_id"], pdf["xml"]):
                try:
                    rows.append({"paper_id": pid, **metadata_of(xml)})
                except ET.ParseError as e:
                    rows.append({"paper_id": pid, **empty, "error": str(e)})
            yield pd.DataFrame(rows, columns=["paper_id", *empty, "error"])

    schema = "paper_id string, title string, authors array<string>, abstract string, keywords array<string>, publication_date string, doi string, error string"
    out = docs.select("paper_id", "xml").mapInPandas(run, schema)
    return out.withColumn("year", F.left("publication_date", F.lit(4)).try_cast("int"))
