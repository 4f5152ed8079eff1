"""Section-vector search and weighted Borda counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import vectors as V
from rankloom.functions import wordlists as W
from rankloom.operators.spread import lookup_join, top_k


def section_matches(sections: DataFrame, job_vectors: DataFrame, k: int = 100) -> DataFrame:
    """Best k candidates per posting and section by cosine with the posting vector.

    The posting filter is the join key. Similarities are compared at six
    decimals, ties go to the lower candidate id.
    """
    scored = lookup_join(sections, job_vectors, ["job_id"]).select(
        "job_id", "section", "candidate_id", F.round(V.cosine(F.col("embedding"), F.col("job_embedding")), 6).alias("similarity")
    )
    return top_k(scored, ["job_id", "section"], [F.desc("similarity"), F.col("candidate_id")], k)


def borda_points(matches: DataFrame) -> DataFrame:
    """Points per list: list length minus position. Lists hold at most k rows, and
    the window shares the partitioning of the top-k step."""
    w = Window.partitionBy("job_id", "section")
    return matches.withColumn("points", F.count("*").over(w) - F.col("rank") + 1)


def section_weight(section: Column, weights: dict[str, int] = W.BORDA_WEIGHTS) -> Column:
    """Weight in percent; unknown sections weigh nothing."""
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return F.coalesce(F.try_element_at(table, section), F.lit(0))


def weighted_borda(points: DataFrame, weights: dict[str, int] = W.BORDA_WEIGHTS) -> DataFrame:
    """Weighted total per candidate, summed in whole percents."""
    total = F.sum(F.col("points") * section_weight(F.col("section"), weights))
    return points.groupBy("job_id", "candidate_id").agg((total / 100).alias("borda"))


def dense_points(points: DataFrame, sections: list[str]) -> DataFrame:
    """Every candidate of the union in every section, 0 where it was not listed."""
    per_section = [
        F.struct(
            F.lit(s).alias("section"),
            F.coalesce(F.max(F.when(F.col("section") == s, F.col("points"))), F.lit(0)).alias("points"),
        )
        for s in sections
    ]
    # One aggregation per candidate, then widened: no join against the section list.
    return points.groupBy("job_id", "candidate_id").agg(F.array(*per_section).alias("_all")).select(
        "job_id", "candidate_id", F.inline("_all")
    )


def section_row(points: DataFrame, sections: list[str], value: str = "points") -> DataFrame:
    """Section values of a candidate side by side."""
    return points.groupBy("job_id", "candidate_id").agg(
        *[F.coalesce(F.max(F.when(F.col("section") == s, F.col(value))), F.lit(0)).alias(s) for s in sections]
    )


def borda_ranking(points: DataFrame, sections: list[str], weights: dict[str, int] = W.BORDA_WEIGHTS) -> DataFrame:
    """Final rank, total and section JSON per candidate. A posting has at most
    k candidates per section here, so its window is bounded."""
    total = sum((F.col(s) * weights.get(s, 0) for s in sections), F.lit(0)) / 100
    wide = section_row(points, sections).withColumn("borda", total)
    w = Window.partitionBy("job_id").orderBy(F.desc("borda"), "candidate_id")
    return wide.select(
        "job_id",
        "candidate_id",
        "borda",
        F.row_number().over(w).cast("bigint").alias("status"),
        F.to_json(F.struct(*sections)).alias("section_scores"),
    )


def pair_features(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str) -> DataFrame:
    """Concatenated vectors of both sides, as the classifier takes them."""
    return lookup_join(left, right, on).withColumn("features", F.concat(V.as_double(F.col(a)), V.as_double(F.col(b))))


def dimension_split(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Flag rows that break the dimension contract."""
    return df.withColumn("dim", F.size(vector).cast("bigint")).withColumn("quarantined", F.size(vector) != dim)


def shape_report(df: DataFrame, vector: str) -> DataFrame:
    n = F.size(vector).cast("bigint")
    return df.agg(F.count("*").alias("n_rows"), F.min(n).alias("min_dim"), F.max(n).alias("max_dim"))
