"""Ranks, pairs, runs and codes over keys that are no whole numbers."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.operators import labels as L
from rankloom.operators import metrics as K
from rankloom.operators import pairwise as P
from rankloom.operators import scoring as S
from rankloom.operators import spread


def values(kind, n, rng):
    if kind == "string":
        return [rng.choice(["resume-2024-", "é", "b-", ""]) + str(rng.randrange(10**6)) for _ in range(n)]
    if kind == "date":
        return [datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randrange(3000)) for _ in range(n)]
    return [rng.random() * 10 - 5 for _ in range(n)]


@pytest.mark.parametrize("kind", ["string", "date", "double"])
def test_cells_keep_the_order(spark, kind, monkeypatch):
    monkeypatch.setattr(spread, "SPLITTER_ROWS", 500)
    monkeypatch.setattr(spread, "SPLITTERS", 5)
    rng = random.Random(3)
    ids = sorted(set(values(kind, 3000, rng)), key=lambda v: v.encode() if kind == "string" else v)
    df = spark.createDataFrame([(v,) for v in ids] + [(None,)], f"id {kind}")
    cells = spread.order_cells(df, "id")
    got = {r[0]: tuple(r[1:]) for r in df.select("id", *cells).collect()}
    assert set(got.pop(None)) == {None}
    in_order = [got[v] for v in ids]
    assert in_order == sorted(in_order)
    sizes = Counter(in_order)
    assert len(sizes) > 15 and max(sizes.values()) < len(ids) // 5


def test_few_or_no_values(spark):
    for rows in ([], [(None,)], [("a",)], [("a",), ("b",)] * 5):
        df = spark.createDataFrame(rows, "id string")
        ranked = spread.rank_in_group(df, [], [F.col("id")], ["id"]).collect()
        assert sorted(r["rank"] for r in ranked) == list(range(1, len(rows) + 1))


def test_ranks_of_resumes(spark):
    rng = random.Random(5)
    rows = [(f"b-{i}", f"job {i % 3}", rng.choice([20.0, 55.5, 80.0])) for i in range(300)]
    df = spark.createDataFrame(rows, "resume_id string, job_id string, overall double")
    got = {r["resume_id"]: r["status"] for r in S.rank_resumes(df).collect()}
    for job in {r[1] for r in rows}:
        fit = sorted((-o, i) for i, j, o in rows if j == job and o >= 40)
        assert [got[i] for _, i in fit] == list(range(1, len(fit) + 1))
    assert {got[i] for i, _, o in rows if o < 40} == {-1}


def test_pairs_and_batches(spark):
    rows = [("g1", f"x{i}") for i in range(40)] + [("g2", f"y{i}") for i in range(7)]
    df = spark.createDataFrame(rows, "g string, item string")
    pairs = P.sample_pairs(df, "g", "item").collect()
    assert Counter(r["g"] for r in pairs) == {"g1": int(0.35 * 780), "g2": int(0.35 * 21)}
    assert len({(r["g"], *sorted((r["left_id"], r["right_id"]))) for r in pairs}) == len(pairs)
    batches = {r["item"]: r["batch"] for r in L.batch_numbers(df, ["g"], "item", 10).collect()}
    assert [batches[i] for i in sorted(i for g, i in rows if g == "g1")] == [n // 10 for n in range(40)]


def test_best_and_latest_run(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [("e", "run-b", 0.9, t), ("e", "run-a", 0.9, t), ("e", "run-c", None, None), ("f", "run-z", None, t), ("f", "run-y", 0.1, t + datetime.timedelta(days=1))]
    df = spark.createDataFrame(rows, "experiment string, run_id string, accuracy double, start_time timestamp")
    got = {r["experiment"]: (r["best_run"], r["latest_run"]) for r in K.best_run(df, "experiment").collect()}
    assert got == {"e": ("run-a", "run-a"), "f": ("run-y", "run-y")}


def test_codes_with_nulls(spark):
    df = spark.createDataFrame([(1, "same start b"), (2, None), (3, "same start a"), (4, "same start b"), (5, "")], "id int, t string")
    assert {r["id"]: r["code"] for r in S.category_codes(df, "t", "code").collect()} == {1: 2, 2: -1, 3: 1, 4: 2, 5: 0}
