import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankloom.operators import labels as L
from rankloom.operators import scoring as S
from rankloom.operators import spread as P


def skewed(spark, n=3000):
    """A third of all rows in group 0, many equal scores."""
    r = random.Random(1)
    rows = [(i, 0 if i % 3 == 0 else i % 50, r.randrange(5) * 10, r.randrange(2)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g long, score long, hit int")


def test_running_totals_equal_a_window(spark):
    df = skewed(spark)
    w = Window.partitionBy("g").orderBy(F.desc("score"), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum(F.lit(1)).over(w).alias("rank"), F.sum("hit").over(w).alias("hits"), F.count("*").over(Window.partitionBy("g")).alias("n"))
    got = P.running_totals(
        df, ["g"], [F.desc("score"), F.col("id")], [-F.col("score"), P.id_cell("id", 64)], {"rank": F.lit(1), "hits": F.col("hit")}, {"n": "rank"}
    ).select("id", "rank", "hits", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rank_without_group(spark):
    df = skewed(spark, 500)
    got = P.rank_in_group(df, [], [F.desc("score"), F.col("id")], [-F.col("score"), P.id_cell("id", 16)]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501))
    assert [(-r["score"], r["id"]) for r in got] == sorted((-r["score"], r["id"]) for r in got)


def test_rank_splits_hot_groups(spark):
    """No window of the plan is partitioned by the group alone."""
    plan = P.rank_in_group(skewed(spark), ["g"], [F.desc("score"), F.col("id")], [-F.col("score"), P.id_cell("id", 64)])._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan
    row_windows = [line for line in plan.split("\n") if "_loc_m_rank" in line and "Window" in line]
    assert row_windows and all("_cell1" in line for line in row_windows)


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = P.top_k(skewed(spark), ["g"], [F.desc("score"), F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lookup_join_ways_agree(spark, monkeypatch):
    big = skewed(spark)
    small = spark.createDataFrame([(i, f"n{i}", i * 2) for i in range(0, 60, 2)], "g long, name string, twice long")
    rows = lambda df: sorted(map(tuple, df.select("id", "g", "score", "hit", "name", "twice").collect()))
    first = P.lookup_join(big, small, ["g"])
    assert "BroadcastHashJoin" in first._jdf.queryExecution().executedPlan().toString()
    second = P.lookup_join(big, small, ["g"], limit_bytes=0, hot_keys=3)
    assert rows(first) == rows(second) and len(rows(first)) == big.filter("g % 2 = 0").count()


def test_keep_first_and_last(spark):
    df = skewed(spark)
    first = {r["g"]: r["id"] for r in P.keep_first(df, ["g"], ["score", "id"]).collect()}
    last = {r["g"]: r["id"] for r in P.keep_last(df, ["g"], ["score", "id"]).collect()}
    rows = [tuple(r) for r in df.select("g", "score", "id").collect()]
    for g in first:
        mine = [(s, i) for gg, s, i in rows if gg == g]
        assert first[g] == min(mine)[1] and last[g] == max(mine)[1]


def test_exact_split_and_folds(spark):
    df = skewed(spark, 1003)
    cut = L.exact_split(df, "id")
    assert cut.filter("split = 'test'").count() == 201 and cut.count() == 1003
    folds = L.assign_folds(df, "hit", "id").groupBy("hit", "fold").count().collect()
    for h in (0, 1):
        sizes = [r["count"] for r in folds if r["hit"] == h]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_upsert_last_write_wins_and_null_keeps(spark):
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, t string, v int")
    upd = spark.createDataFrame([(1, 5, 1), (1, 7, 2), (2, None, 1), (3, 9, 1)], "k long, v int, seq long")
    got = sorted(map(tuple, L.upsert(base, upd, "k", ["seq"], ["v"]).collect()))
    assert got == [(1, "a", 7), (2, "b", 0), (3, None, 9)]


def test_labels_of_mixed_type(spark):
    vals = ["1", "-1", "0", "Good Fit", "neutral", "x", None, "No Fit", "3"]
    df = spark.createDataFrame([(v,) for v in vals], "label string")
    c = F.col("label")
    got = df.select(L.is_valid_label(c).alias("v"), L.is_binary_label(c).alias("b"), L.numeric_target(c).alias("t")).collect()
    assert [r["v"] for r in got] == [True, True, True, True, True, False, False, True, False]
    assert [r["b"] for r in got] == [True, True, False, True, False, False, False, True, False]
    assert [r["t"] for r in got][:4] == [1, 0, 0, 1]


def test_encode_labels_like_the_source_table(spark):
    df = spark.createDataFrame([("Potential Fit",), ("Good Fit",), ("No Fit",)], "label string")
    assert {r["label"] for r in L.encode_labels(df).collect()} == {0, 1}


def test_dedupe_is_idempotent_and_prefers_base(spark):
    base = spark.createDataFrame([(9, "r", "j", "No Fit")], "row_id long, resume_text string, job_description_text string, label string")
    extra = spark.createDataFrame([(1, "r", "j", "Good Fit"), (2, "r2", "j", "bad label"), (3, "r3", "j", "Good Fit")], base.schema)
    once = L.assemble_training(base, extra)
    assert sorted((r["row_id"], r["label"]) for r in once.collect()) == [(3, "Good Fit"), (9, "No Fit")]
    again = L.assemble_training(once, extra)
    assert sorted(map(tuple, again.select("row_id", "label").collect())) == sorted(map(tuple, once.select("row_id", "label").collect()))
    empty = base.limit(0)
    assert L.assemble_training(base, empty).count() == 1 and L.assemble_training(empty, extra).count() == 2


def test_missing_columns_are_named(spark):
    import pytest

    with pytest.raises(ValueError, match="label"):
        L.require_columns(spark.createDataFrame([("a", "b")], "resume_text string, job_description_text string"), L.PAIR_COLUMNS)


def test_scores_by_hand(spark):
    df = spark.createDataFrame([(1, 1, 85, 70, 100, 65), (2, 1, 0, 0, 0, 100), (3, 1, 40, 40, 40, 40), (4, 1, 85, 70, 100, 65)], "resume_id long, job_id long, skills long, experience long, education long, projects long")
    got = {r["resume_id"]: r for r in S.rank_resumes(df).collect()}
    assert got[1]["overall"] == 79.8 and got[1]["status"] == 1 and got[4]["status"] == 2  # 79.75 up
    assert got[2]["overall"] == 15.0 and got[2]["status"] == -1
    assert got[3]["fit"] and got[3]["status"] == 3 and got[3]["fit_probability"] == 0.4
    blended = spark.createDataFrame([(80.0, 0.9312)], "o double, p double").select(S.blend(F.col("o"), F.col("p")).alias("x")).first()["x"]
    assert blended == 85.2  # 48 + 37.248
