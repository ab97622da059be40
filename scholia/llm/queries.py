"""All queries of this folder: importing it registers them."""

from scholia.llm import alignment, bpe, collocations, exact_dedup, jaccard, licences, line_dedup, mixing, neighbours, secrets, toxicity, urls, warc  # noqa: F401
from scholia.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
