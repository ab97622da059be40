"""Vector arithmetic on array columns (JVM-side; bulk products use matrices in Arrow batches)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity, 0 when a vector has no length."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / lengths)


def unit(v: Column | str) -> Column:
    """Scaled to length 1; a zero vector stays as it is."""
    n = norm(v)
    return F.transform(_c(v), lambda x: x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n))


def to_similarity(score: Column, metric: str = "cosine") -> Column:
    """Raw score to [0, 1]; ``l2`` takes the squared distance."""
    return (score + 1.0) / 2.0 if metric == "cosine" else 1.0 / (1.0 + score)
