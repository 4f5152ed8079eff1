import itertools
import math

import pytest
from pyspark.sql import functions as F

from rankloom.operators import matching as M
from rankloom.operators import metrics as K
from rankloom.operators import pairwise as P


def items(spark, sizes):
    rows = [(g, 1000 * g + 3 * i) for g, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "g long, id long")


@pytest.mark.parametrize("share", [0.35, 1.0])
def test_sample_is_exact_and_distinct(spark, share):
    sizes = [1, 2, 3, 7, 40]
    got = P.sample_pairs(items(spark, sizes), "g", "id", share).collect()
    for g, n in enumerate(sizes):
        mine = [(r["left_id"], r["right_id"]) for r in got if r["g"] == g]
        assert len(mine) == int(share * (n * (n - 1) // 2)) == len(set(mine))
        assert all(a < b for a, b in mine)


def test_sample_budget(spark):
    got = P.sample_pairs(items(spark, [40, 3]), "g", "id", 0.35, max_pairs=50).groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in got} == {0: 50, 1: 1}


def test_answers_default_and_flag(spark):
    df = spark.createDataFrame([(" Resume 2 ",), ("resume 2",), (None,), ("Resume 1",)], "a string")
    good, flag = P.checked_answer(F.col("a"))
    assert [tuple(r) for r in df.select(good, flag).collect()] == [("Resume 2", False), ("Resume 1", True), ("Resume 1", True), ("Resume 1", False)]


def solve(pairs, n, steps=20000):
    """Plain minorise-maximise reference on a small set."""
    w = [1.0] * n
    for _ in range(steps):
        new = []
        for i in range(n):
            wins = sum(a == i for a, _ in pairs)
            load = sum(1 / (w[a] + w[b]) for a, b in pairs if i in (a, b))
            new.append(max(wins / load, 0.001))
        if max(abs(x - y) for x, y in zip(w, new)) < 1e-12:
            break
        w = new
    gm = math.exp(sum(map(math.log, w)) / n)
    return [x / gm for x in w]


def test_strengths_of_a_connected_set(spark):
    pairs = [(0, 1), (1, 2), (2, 3), (3, 0), (0, 2), (1, 3), (0, 1)]
    rows = [(g, a, b) for g in (1, 2) for a, b in pairs]
    done = spark.createDataFrame(rows, "job long, winner long, loser long")
    fit = P.normalised(P.fit_strengths(done, "job", max_steps=60, tolerance=1e-7), "job").collect()
    want = solve(pairs, 4)
    for g in (1, 2):
        got = {r["item"]: r["strength"] for r in fit if r["job"] == g}
        assert all(got[i] == pytest.approx(want[i], rel=1e-4) for i in range(4))
        assert sum(math.log(v) for v in got.values()) == pytest.approx(0, abs=1e-9)


def test_item_without_wins_gets_the_floor(spark):
    done = spark.createDataFrame([(1, 1, 2), (1, 1, 3), (1, 2, 1), (1, 2, 3)], "job long, winner long, loser long")
    fit = {r["item"]: r["strength"] for r in P.fit_strengths(done, "job", max_steps=10, tolerance=None).collect()}
    assert fit[3] == P.FLOOR
    top = P.ranked_strengths(P.normalised(P.fit_strengths(done, "job", max_steps=10, tolerance=None), "job"), "job").collect()
    assert {r["rank"]: r["item"] for r in top}[3] == 3


def test_fit_tells_steps_and_moves(spark):
    done = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 1), (2, 1, 2), (2, 2, 1), (2, 1, 2)], "job long, winner long, loser long")
    fit = P.fit(done, "job", tolerance=1e-6)
    assert fit.converged and fit.steps % 5 == 0 and fit.steps < 50
    assert {r["job"]: r["n_items"] for r in fit.moves.filter("largest_move <= 1e-6").collect()} == {1: 3, 2: 2}
    short = P.fit(done, "job", max_steps=2, tolerance=None)
    assert (short.steps, short.converged) == (2, False)
    none = P.fit(done.filter("false"), "job")
    assert none.converged and none.strengths.count() == none.moves.count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("laid_out")]


def test_components_of_long_chains(spark):
    chain = [(1, i, i + 1) if i % 2 else (1, i + 1, i) for i in range(40)]
    rows = chain + [(1, 100, 101), (2, 1, 2), (2, 3, 4), (2, 4, 1)]
    got = P.components(spark.createDataFrame(rows, "job long, winner long, loser long"), "job").collect()
    assert {(r["job"], r["item"]): r["component"] for r in got} == {
        **{(1, i): 0 for i in range(41)}, (1, 100): 100, (1, 101): 100, **{(2, i): 1 for i in range(1, 5)}
    }


def test_a_step_shuffles_the_pairs_once(spark):
    from rankloom.session import cut_lineage, laid_out

    rows = [(g, i, (i * 7 + 1) % 50) for g in range(4) for i in range(50) if i != (i * 7 + 1) % 50]
    pairs = P.counted_pairs(spark.createDataFrame(rows, "job long, winner long, loser long"), "job")
    items = spark.createDataFrame([(g, i, 1, 1.0) for g in range(4) for i in range(50)], "job long, item long, wins long, strength double")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        with laid_out(pairs, ["job", "lo"]) as laid:
            plan = P._step(laid, cut_lineage(items), "job")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    # Strengths to the lower item, used again for the higher, and to their old values; pairs to
    # the higher item alone; sums. Only strengths are hashed by the lower item.
    assert len(moved) == 4 and "Bucketed: true" in plan
    assert [sum(name in m for m in moved) for name in ("lo#", "hi#", "item#")] == [1, 1, 2]


def test_likelihood_does_not_depend_on_scale(spark):
    done = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 1)], "job long, winner long, loser long")
    s = spark.createDataFrame([(1, 1, 2.0), (1, 2, 1.0), (1, 3, 0.5)], "job long, item long, strength double")
    a = P.negative_log_likelihood(done, s, "job").first()["nll"]
    b = P.negative_log_likelihood(done, s.withColumn("strength", F.col("strength") * 7), "job").first()["nll"]
    assert a == b == pytest.approx(-math.log(2 / 3 * 1 / 1.5 * 0.5 / 2.5), abs=1e-4)


def test_error_budget_keeps_all_up_to_the_limit(spark):
    rows = [(1, i, 100 + i, i % 2 == 0) for i in range(20)]
    df = spark.createDataFrame(rows, "job long, left_id long, right_id long, is_default boolean")
    kept = P.within_budget(df, "job", at_least=3).collect()
    assert sorted(r["left_id"] for r in kept) == [0, 1, 2, 3, 4]
    assert P.error_budget(df, "job", at_least=3).first()["stopped"]


def test_borda_by_hand(spark):
    rows = [(1, "workexp", 10, 0.9), (1, "workexp", 11, 0.9), (1, "workexp", 12, 0.1), (1, "misc", 12, 0.5), (1, "hobbies", 12, 1.0)]
    m = spark.createDataFrame(rows, "job_id long, section string, candidate_id long, similarity double")
    from rankloom.operators.spread import top_k

    pts = M.borda_points(top_k(m, ["job_id", "section"], [F.desc("similarity"), F.col("candidate_id")], 100))
    total = {r["candidate_id"]: r["borda"] for r in M.weighted_borda(pts).collect()}
    assert total == {10: 1.8, 11: 1.2, 12: pytest.approx(0.65)}
    dense = M.dense_points(pts, ["workexp", "misc"]).collect()
    assert len(dense) == 6 and sum(r["points"] for r in dense) == 3 + 2 + 1 + 1


def test_average_precision_edges(spark):
    rows = [(1, 1, 0, 0.9), (1, 2, 0, 0.1), (2, 3, 1, 0.5), (2, 4, 0, 0.5), (2, 5, 1, 0.4)]
    df = spark.createDataFrame(rows, "qid long, id long, y int, score double")
    ap = {r["qid"]: r["ap"] for r in K.average_precision(df, "qid", "score", "y", "id", 100).collect()}
    assert ap == {1: 0.0, 2: pytest.approx((1 + 2 / 3) / 2)}
    assert K.mean_average_precision(df, "qid", "score", "y", "id", 100).first()[0] == pytest.approx((1 + 2 / 3) / 4)


def test_auc_counts_ties_half(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]
    df = spark.createDataFrame(rows, "y int, score double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert K.roc_auc(df).first()["auc"] == pytest.approx(want)


def test_promotion_gate(spark):
    rows = [("a", 1, 0.9, 1), ("a", 2, 0.896, 2), ("b", 3, 0.9, 1), ("b", 4, 0.89, 2), ("c", 5, 0.1, 1)]
    df = spark.createDataFrame(rows, "experiment string, run_id long, accuracy double, start_time long")
    assert {r["experiment"]: r["accepted"] for r in K.promotion_gate(df, "experiment").collect()} == {"a": True, "b": False, "c": True}
