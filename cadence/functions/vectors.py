"""Vector arithmetic as unrolled Column expressions.

Vectors are held either as a fixed list of DOUBLE columns (the 8 vibe
features) or as an ARRAY column of known length (embeddings). Both are
unrolled into plain arithmetic so the work stays inside whole-stage codegen;
sums are left-to-right so the SQL oracle computes the same doubles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda acc, t: acc + t, [x * y for x, y in zip(a, b)])


def norm(a: list[Column]) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: list[Column], b: list[Column], eps: float = 0.0) -> Column:
    """dot / (|a| |b| + eps); with eps = 0 a zero vector gives 0."""
    den = norm(a) * norm(b)
    if eps:
        return dot(a, b) / (den + F.lit(float(eps)))
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)


def array_items(c: Column, dim: int) -> list[Column]:
    return [c.getItem(i).cast("double") for i in range(dim)]


# SQL text (oracle side)

def dot_sql(a: list[str], b: list[str]) -> str:
    return "(" + " + ".join(f"{x} * {y}" for x, y in zip(a, b)) + ")"


def norm_sql(a: list[str]) -> str:
    return f"sqrt({dot_sql(a, a)})"


def cosine_sql(a: list[str], b: list[str], eps: float = 0.0) -> str:
    den = f"({norm_sql(a)} * {norm_sql(b)})"
    if eps:
        return f"({dot_sql(a, b)} / ({den} + {eps!r}))"
    return f"(CASE WHEN {den} = 0 THEN 0e0 ELSE {dot_sql(a, b)} / {den} END)"
