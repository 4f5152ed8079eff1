"""Dense vector expressions over ARRAY<DOUBLE>; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a side has no length."""
    a, b = as_double(a), as_double(b)
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(
        F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)
    )


def manhattan(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda acc, x: acc + x)


DISTANCES = {"euclidean": euclidean, "manhattan": manhattan, "minkowski": euclidean}


def parse_vector_text(text: Column) -> Column:
    """``"[0.1 0.2 …]"`` to ARRAY<DOUBLE>; unreadable elements become null."""
    body = F.trim(F.regexp_replace(text, r"[\[\],\s]+", " "))
    return F.when(body == "", F.array().cast("array<double>")).otherwise(
        F.transform(F.split(body, " "), lambda x: x.try_cast("double"))
    )


def lerp(a: Column, b: Column, t: Column) -> Column:
    """Point at share ``t`` of the way from ``a`` to ``b``."""
    return F.zip_with(a, b, lambda x, y: x + t * (y - x))
