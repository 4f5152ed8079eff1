"""Values of fitted score models: saved and live model agree, the threshold holds."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import labels as L
from rankloom.operators import learning as G
from rankloom.session import scratch_path


@pytest.fixture(scope="module")
def candidates(spark):
    return G.synthetic_candidates(spark.range(400).withColumnRenamed("id", "doc_id"), "doc_id").coalesce(1).cache()


def test_saved_and_live_model_agree(spark, candidates):
    model = G.fit_score_model(candidates, trees=6)
    path = G.save_model(model, scratch_path(spark, "models"), "20240101_000000")
    live = {r["doc_id"]: (r["probability"], r["yhat"]) for r in G.with_probability(model, candidates).collect()}
    saved = {r["doc_id"]: (r["probability"], r["yhat"]) for r in G.score_saved(path, candidates).collect()}
    assert live == saved and len({p for p, _ in live.values()}) > 1
    assert all((p > 0.5) == (y == 1) and 0 <= p <= 1 for p, y in live.values())
    status = G.with_probability(model, candidates).select("yhat", L.status_of_prediction(F.col("yhat")).alias("s")).distinct().collect()
    assert {tuple(r) for r in status} == {(0, -1), (1, 0)}


def test_versions_differ_when_their_data_do(spark, candidates):
    root = scratch_path(spark, "models")
    one = G.save_model(G.fit_score_model(candidates, trees=3), root, "20240101_000000")
    two = G.save_model(G.fit_score_model(candidates.withColumn("label", 1 - F.col("label")), trees=3), root, "20240102_000000")
    first, second = ({r["doc_id"]: r["yhat"] for r in G.score_saved(p, candidates).collect()} for p in (one, two))
    assert one != two and sum(first[i] != second[i] for i in first) > 0.9 * len(first)


def test_model_learns_the_weighted_total(candidates):
    scored = G.with_probability(G.fit_score_model(candidates, trees=15), candidates)
    right = scored.filter("label = yhat").count()
    assert right > 0.95 * candidates.count()


def test_more_trees_are_not_worse_on_their_own_rows(candidates):
    def wrong(trees):
        return G.with_probability(G.fit_score_model(candidates, trees=trees), candidates).filter("label <> yhat").count()

    assert wrong(20) <= wrong(2)
