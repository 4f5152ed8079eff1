"""Learning to rank with boosted trees and list-wise gradients.

The loss of a query is the cross entropy between the softmax of its scores and its
relevant rows, so a row's gradient needs two sums over its query and no pairs of rows:
with ``p`` the softmax and ``t`` the share of a relevant row among the relevant ones,
the gradient is ``p - t`` and the curvature ``p (1 - p)``. Each tree is a regression tree
on ``-gradient / curvature``, weighed by the curvature: its leaf means are the Newton
steps, its variance gain is the Newton gain, and Spark ML sums its histograms over
(node, feature, bin) across the cluster.

Rows are written once. Scores are never stored; a round reads the rows and adds up the
trees so far. The sums per query are aggregates and meet the rows as a lookup table, so
a query with a third of all rows is no task of its own.
"""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.spread import lookup_join
from rankloom.session import cut_lineage

#: Scores count within these bounds in the softmax, so that its sums stay finite.
CLIP = 30.0
LEAST_CURVATURE = 1e-9


def ranker_scores(rows: DataFrame, trees: list[DecisionTreeRegressionModel], features: str = "features", step: float = 0.1, out: str = "score") -> DataFrame:
    """The rows with the unrounded sum of all trees."""
    scored = rows.withColumn(out, F.lit(0.0))
    for tree in trees:
        scored = tree.setFeaturesCol(features).setPredictionCol("_tree").transform(scored).withColumn(out, F.col(out) + step * F.col("_tree")).drop("_tree")
    return scored


def list_gradients(scored: DataFrame, query: str, label: str, score: str = "score") -> DataFrame:
    """The rows with ``target`` (the Newton step of the row alone) and ``weight`` (its
    curvature); queries without a relevant row, or with nothing else, have no say."""
    power = F.exp(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.col(score))))
    rows = scored.withColumn("_power", power)
    sums = rows.groupBy(query).agg(F.sum("_power").alias("_powers"), F.sum(label).alias("_relevant"), F.count(F.lit(1)).alias("_rows"))
    sums = sums.filter((F.col("_relevant") > 0) & (F.col("_relevant") < F.col("_rows"))).drop("_rows")
    p, t = F.col("_power") / F.col("_powers"), F.col(label) / F.col("_relevant")
    weight = F.greatest(p * (1 - p), F.lit(LEAST_CURVATURE))
    return lookup_join(rows, sums, [query]).select(*scored.columns, ((t - p) / weight).alias("target"), weight.alias("weight"))


def fit_tree_ranker(rows: DataFrame, query: str, label: str, features: str = "features", trees: int = 30, depth: int = 5, step: float = 0.1, least_rows: int = 1, bins: int = 32) -> list[DecisionTreeRegressionModel]:
    """Trees of a ranking function. ``rows`` has the query, a label of 0 or 1 and a vector
    of features; rows with a null in one of them are left out."""
    base = cut_lineage(rows.select(query, label, features).dropna())
    fitted: list[DecisionTreeRegressionModel] = []
    for _ in range(trees):
        grown = list_gradients(ranker_scores(base, fitted, features, step), query, label)
        tree = DecisionTreeRegressor(featuresCol=features, labelCol="target", weightCol="weight", maxDepth=depth, minInstancesPerNode=least_rows, maxBins=bins, seed=42)
        fitted.append(tree.fit(grown))
    return fitted
