import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from rankloom.operators import learning as G
from rankloom.operators import neighbours as N


def cloud(spark, n=400, dim=4, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        c = r.choice([0.0, 5.0, 9.0])
        rows.append((i, [c + r.gauss(0, 0.5) for _ in range(dim)], int(c > 4), i % 2))
    return rows, spark.createDataFrame(rows, "id long, vector array<double>, label int, b int")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_nearest_equals_brute_force(spark, metric):
    rows, df = cloud(spark)
    dist = math.dist if metric == "euclidean" else lambda a, b: sum(abs(x - y) for x, y in zip(a, b))
    got = N.nearest(df, df, 5, ["b"], metric, exclude_self=True, pivots=8, piece=16).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["point_id"]))
    for i, v, _, b in rows:
        want = sorted((round(dist(v, w), 6), j) for j, w, _, c in rows if c == b and j != i)[:5]
        assert [j for _, j in sorted(found[i])] == [j for _, j in want]


def test_nearest_over_ties_copies_and_unusable_vectors(spark):
    # Copies of one vector in one cell, text ids, vectors that are null or hold nothing usable.
    rows = [(f"p{i:03d}", [1.0, 2.0]) for i in range(60)] + [("z1", [1.0, 2.0000001]), ("z2", [4.0, 6.0])]
    odd = [("n1", None), ("n2", [1.0, None]), ("n3", [float("nan"), 2.0])]
    df = spark.createDataFrame(rows + odd, "id string, vector array<double>")
    for metric, far in (("euclidean", 5.0), ("manhattan", 7.0)):
        got = {}
        for r in N.nearest(df, df, 3, [], metric, exclude_self=True, pivots=4, piece=8).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["point_id"], r["distance"]))
        assert set(got) == {i for i, _ in rows}
        assert sorted(got["p000"]) == [(1, "p001", 0.0), (2, "p002", 0.0), (3, "p003", 0.0)]
        assert sorted(got["z1"])[0] == (1, "p000", 0.0) and sorted(got["z2"])[0] == (1, "p000", far)
    assert N.nearest(df.filter("false"), df, 3, []).count() == N.nearest(df, df.filter("false"), 3, []).count() == 0


def test_distances_do_not_lose_digits_far_from_the_origin(spark):
    # A matrix product alone would be off by more than these gaps.
    rows = [(i, [1e6 + 1e-3 * i, 1e6]) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = N.nearest(df, df, 2, [], exclude_self=True).filter("query_id = 20").orderBy("rank").collect()
    assert [(r["point_id"], r["distance"]) for r in got] == [(19, 0.001), (21, 0.001)]


def plain_matches(q, p, k):
    out = []
    for i, v in enumerate(q):
        exact = [sum(abs(float(x) - float(y)) for x, y in zip(v, w)) for w in p]
        rounded = [math.floor(d * 1e6 + 0.5) / 1e6 for d in exact]
        out += [(i, j, rounded[j]) for j in sorted(range(len(p)), key=lambda j: (rounded[j], j))[:k]]
    return out


@pytest.mark.parametrize("scale, shift", [(0.01, 0.0), (1e-5, 1e6), (2.0**100, 0.0)])
def test_manhattan_in_single_precision_keeps_the_exact_lists(scale, shift):
    r = np.random.default_rng(5)
    p = np.round(r.normal(size=(300, 16)) * 100) * scale + shift
    p[200:250] = p[7]  # copies
    q = np.concatenate([p[5:9], np.round(r.normal(size=(20, 16)) * 100) * scale + shift])
    got = list(zip(*(x.tolist() for x in N._block_matches(q, p, 6, "manhattan", None))))
    assert got == plain_matches(q, p, 6)


def test_manhattan_holds_no_doubles_of_all_pairs(monkeypatch):
    # Only candidates are measured in double precision.
    measured = []
    exact = N._distances
    monkeypatch.setattr(N, "_distances", lambda q, p, row, col, metric: measured.append(len(row)) or exact(q, p, row, col, metric))
    r = np.random.default_rng(6)
    N._block_matches(r.normal(size=(32, 8)), r.normal(size=(1000, 8)), 5, "manhattan", None)
    assert sum(measured) < 32 * 20


def test_vote_by_distance_and_exact_hits(spark):
    rows = [(1, 0.0, 2), (1, 0.1, 1), (1, 0.1, 1), (2, 0.5, 1), (2, 1.0, 0), (2, 1.0, 0), (3, 1.0, 1), (3, 1.0, 0)]
    df = spark.createDataFrame(rows, "query_id long, distance double, label int")
    got = lambda w: {r["query_id"]: r["predicted"] for r in N.vote(df, ["query_id"], weights=w).collect()}
    assert got("uniform") == {1: 1, 2: 0, 3: 0}
    assert got("distance") == {1: 2, 2: 0, 3: 0}


def test_oversampling_balances_and_stays_on_segments(spark):
    rows, df = cloud(spark, 200)
    small = df.filter((df.label == 1) | (df.id % 4 == 0))
    out = N.oversample(small)
    sizes = [r["count"] for r in out.groupBy("label").count().collect()]
    assert len(set(sizes)) == 1
    vec = {i: v for i, v, _, _ in rows}
    made = out.filter("copy > 0").collect()
    assert made
    for r in made:
        a, b = vec[r["id"]], vec[r["neighbour_id"]]
        assert all(min(x, y) - 1e-9 <= p <= max(x, y) + 1e-9 for x, y, p in zip(a, b, r["vector"]))


def test_approximate_search_finds_most(spark):
    from rankloom.operators.matching import section_matches
    from rankloom.plans import fixtures as X

    d = "/root/testdata/sf0.001"
    exact = section_matches(X.applied(spark, d), X.job_vectors(spark, d), k=5).select("job_id", "section", "candidate_id")
    near = N.approximate_matches(X.applied(spark, d), X.job_vectors(spark, d)).select("job_id", "section", "candidate_id")
    assert exact.join(near, ["job_id", "section", "candidate_id"]).count() >= 0.8 * exact.count()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_approximate_search_recalls_the_full_lists(spark, sf):
    from rankloom.operators.matching import section_matches
    from rankloom.plans import fixtures as X

    d = f"/root/testdata/{sf}"
    exact = section_matches(X.applied(spark, d), X.job_vectors(spark, d))
    near = N.approximate_matches(X.applied(spark, d), X.job_vectors(spark, d))
    assert near.columns == exact.columns
    both = exact.join(near.drop("rank"), ["job_id", "section", "candidate_id", "similarity"])
    assert near.count() <= exact.count() and both.count() >= 0.9 * exact.count()
    ranks = near.groupBy("job_id", "section").agg(F.max("rank").alias("last"), F.count("*").alias("n")).collect()
    assert all(r["last"] == r["n"] <= 100 for r in ranks)


def test_a_large_group_is_mostly_left_out(spark):
    from rankloom.operators.matching import section_matches

    r = random.Random(11)
    row = lambda: [r.gauss(0, 1) for _ in range(64)]
    mine = spark.createDataFrame([(1, "misc", i, row()) for i in range(3000)], "job_id long, section string, candidate_id long, embedding array<double>")
    job = spark.createDataFrame([(1, row()), (2, row())], "job_id long, job_embedding array<double>")
    near = N.shortlist(mine, job)
    assert near.count() < 0.3 * 3000
    exact = section_matches(mine, job).select("candidate_id", "similarity")
    assert exact.join(N.approximate_matches(mine, job), ["candidate_id", "similarity"]).count() >= 90


def test_approximate_search_of_vectors_without_length(spark):
    rows = [(1, "misc", 1, [0.0, 0.0]), (1, "misc", 2, None), (1, "misc", 3, [1.0, None]), (1, "misc", 4, [1.0, 1.0]), (1, "misc", 5, [1.0]), (2, "misc", 1, [1.0, 0.0])]
    mine = spark.createDataFrame(rows, "job_id long, section string, candidate_id long, embedding array<double>")
    job = spark.createDataFrame([(1, [2.0, 2.0]), (2, [0.0, 0.0])], "job_id long, job_embedding array<double>")
    got = {(r["job_id"], r["candidate_id"]): r["similarity"] for r in N.approximate_matches(mine, job, 5).collect()}
    assert got == {(1, 1): 0.0, (1, 2): 0.0, (1, 3): 0.0, (1, 4): 1.0, (1, 5): 0.0, (2, 1): 0.0}
    assert N.approximate_matches(mine.filter("false"), job).count() == N.approximate_matches(mine, job.filter("false")).count() == 0


def test_fit_model_smoke(spark):
    ids = spark.range(400).withColumnRenamed("id", "k")
    model = G.fit_score_model(G.synthetic_candidates(ids, "k"), trees=10)
    one = spark.createDataFrame([(85, 70, 100, 65, 2), (10, 5, 20, 10, 8)], "skills long, experience long, education long, projects long, missing long")
    good, bad = [r["p"] for r in G.with_probability(model, one, "p").collect()]
    assert 0.5 < good <= 1 and 0 <= bad < 0.5


def test_ranker_learns_a_direction(spark):
    r = random.Random(5)
    rows = [(i % 7, i, int(i % 3 == 0), [(1.0 if i % 3 == 0 else 0.0) + r.gauss(0, 0.2), r.gauss(0, 1)]) for i in range(210)]
    df = spark.createDataFrame(rows, "q long, id long, y int, vector array<double>")
    pairs = G.ranking_pairs(df, "q", "id", "y", "vector", per_row=4)
    assert pairs.count() == 70 * 4
    w = G.fit_ranker(pairs)
    assert w[0] > 0 and w[0] > abs(w[1])


def test_codes_of_unknown_labels_fail(spark):
    train = spark.createDataFrame([("b",), ("a",)], "l string")
    got = {r["l"]: r["c"] for r in G.label_codes(train, train, "l", "c").collect()}
    assert got == {"a": 0, "b": 1}
    with pytest.raises(Exception):
        G.label_codes(train, spark.createDataFrame([("z",)], "l string"), "l", "c").collect()


def test_run_log_appends(spark, tmp_path):
    import datetime

    path = str(tmp_path / "runs")
    for i in range(2):
        G.log_run(spark, path, {"run_id": str(i), "experiment": "e", "params": {"k": "1"}, "metrics": {"accuracy": 0.5 + i / 10}, "start_time": datetime.datetime(2024, 1, 1 + i)})
    assert spark.read.parquet(path).agg(F.max(F.col("metrics")["accuracy"]).alias("m")).first()["m"] == 0.6
