import math
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rankloom.operators import learning as G
from rankloom.operators import metrics as K
from rankloom.operators import tree_ranker as T


def table(spark, rows):
    df = spark.createDataFrame(rows, "qid int, id int, y int, vector array<double>")
    return df.withColumn("features", array_to_vector("vector")).coalesce(1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(600):
        x = [rng.uniform(-1, 1) for _ in range(3)]
        # Relevant in the middle of one feature: no linear function sees it.
        out.append((i % 20, i, int(abs(x[0]) < 0.35 and rng.random() < 0.9), x))
    return out


def test_one_split_by_brute_force(spark):
    rng = random.Random(2)
    rows = [(i % 4, i, int(rng.random() < 0.4), [float(rng.randrange(6)), float(rng.randrange(6))]) for i in range(80)]
    tree = T.fit_tree_ranker(table(spark, rows), "qid", "y", trees=1, depth=1)[0]
    size = {q: sum(r[0] == q for r in rows) for q in range(4)}
    good = {q: sum(r[2] for r in rows if r[0] == q) for q in range(4)}
    p = {q: 1 / size[q] for q in size}
    g = [p[r[0]] - r[2] / good[r[0]] for r in rows]
    h = [p[r[0]] * (1 - p[r[0]]) for r in rows]
    best = None
    for f in (0, 1):
        for cut in range(5):
            left = [i for i, r in enumerate(rows) if r[3][f] <= cut]
            right = [i for i, r in enumerate(rows) if r[3][f] > cut]
            value = lambda part: sum(g[i] for i in part) ** 2 / sum(h[i] for i in part)
            step = lambda part: -sum(g[i] for i in part) / sum(h[i] for i in part)
            gain = value(left) + value(right)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, f, cut, step(left), step(right))
    _, f, cut, left, right = best
    for r in rows:
        want = left if r[3][f] <= cut else right
        assert math.isclose(tree.predict(Vectors.dense(r[3])), want, rel_tol=1e-9)


def test_gradients_by_hand(spark):
    df = table(spark, [(1, 1, 1, [0.0]), (1, 2, 0, [0.0]), (1, 3, 1, [0.0]), (2, 4, 0, [0.0]), (3, 5, 1, [0.0])]).withColumn("score", F.col("id") * 0.5)
    got = {r["id"]: (r["target"], r["weight"]) for r in T.list_gradients(df, "qid", "y").collect()}
    total = sum(math.exp(i * 0.5) for i in (1, 2, 3))
    assert set(got) == {1, 2, 3}
    for i, t in ((1, 0.5), (2, 0.0), (3, 0.5)):
        p = math.exp(i * 0.5) / total
        assert math.isclose(got[i][1], p * (1 - p)) and math.isclose(got[i][0], (t - p) / (p * (1 - p)))


def test_beats_the_linear_ranker(spark, rows):
    df = table(spark, rows)
    pairs = G.ranking_pairs(df, "qid", "id", "y", "vector")
    linear = G.ranking_scores(df, "vector", G.fit_ranker(pairs))
    trees = T.ranker_scores(df, T.fit_tree_ranker(df, "qid", "y", trees=5, depth=3), step=0.1)
    score = lambda d: K.average_precision(d, "qid", "score", "y", "id", 10**9).agg(F.avg("ap")).first()[0]
    assert score(trees) > 0.8 > score(linear) + 0.1


def test_nulls_are_left_out(spark, rows):
    df = table(spark, rows[:100])
    more = df.unionByName(spark.createDataFrame([(1, 1000, None, [0.0], Vectors.dense([0.0, 0.0, 0.0])), (None, 1001, 1, [0.0], Vectors.dense([0.0, 0.0, 0.0])), (1, 1002, 1, None, None)], df.schema))
    a, b = (T.fit_tree_ranker(d, "qid", "y", trees=1, depth=2)[0] for d in (df, more))
    assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]
