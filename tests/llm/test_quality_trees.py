import random
import re

import numpy as np
from pyspark.sql import functions as F

from rankloom.llm import quality_trees as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit)]


def test_counts_and_base_rule(spark, docs_of):
    rng = random.Random(4)
    bits = ["a", "b", "é漢", "#x*", "\n", "\n\n", "  ", "\t", "\x0b", " ", "c d e", "x y"]
    texts = [None, "", " \n ", "a b c " * 40, "word " * 3 + "\n" + "word " * 3] + ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    docs = docs_of(list(enumerate(texts)) + [(0, "again"), (None, "z " * 60)]).withColumn("words", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (None, 0), (5, None), (10**6, 1)], "doc_id bigint, quality int")
    stats = Q.measured(docs)
    rows = Q.judged(stats, Q.fitted(stats, labels)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r["doc_id"] not in (None, 0):
            want = brute(texts[r["doc_id"]])
            assert [r[c] for c in Q.COUNTS] == want
            assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r["kept"] and r["base_failed"])
    assert Q.judged(Q.measured(docs_of([])), None).count() == 0
    assert Q.fitted(stats, labels.limit(0)) is None


def test_scores_never_rise_against_a_constraint():
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 1, (3000, 3))
    y = ((np.sin(6 * x[:, 0]) + x[:, 1] + rng.normal(0, 0.3, 3000)) > 0.8).astype(float)
    trees = Q.fit(x, y, [-1, 1, 0])
    probe = np.repeat(rng.uniform(0, 1, (100, 3))[:, None, :], 50, axis=1)
    probe[:, :, 0] = np.linspace(0, 1, 50)
    s = trees.score(probe.reshape(-1, 3)).reshape(100, 50)
    assert (np.diff(s, axis=1) <= 1e-12).all()
    probe[:, :, 0], probe[:, :, 1] = 0.5, np.linspace(0, 1, 50)
    s = trees.score(probe.reshape(-1, 3)).reshape(100, 50)
    assert (np.diff(s, axis=1) >= -1e-12).all()
    free = Q.fit(x, y, [0, 0, 0])
    assert (((free.score(x) > 0.5) == y).mean()) > 0.85


def test_flat_arrays_walk_like_single_trees():
    rng = np.random.default_rng(8)
    x = rng.uniform(0, 1, (500, 2))
    t = Q.fit(x, (x[:, 0] > x[:, 1]).astype(float), [0, 0], trees=5)

    def walk(row):
        total = t.start
        for at in t.roots:
            while t.left[at] != at:
                at = t.left[at] if row[t.feature[at]] <= t.threshold[at] else t.right[at]
            total += t.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(t.score(x[:50]), [walk(r) for r in x[:50]])


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    train, rest = labels.filter("doc_id % 3 > 0"), labels.filter("doc_id % 3 = 0")
    stats = Q.measured(spark.read.parquet(f"{d}/documents.parquet"))
    rows = Q.judged(stats, Q.fitted(stats, train)).filter("not base_failed").join(rest, "doc_id").select("quality", "kept").collect()
    right = [r["kept"] == bool(r["quality"]) for r in rows]
    assert len(rows) > 800 and sum(right) / len(right) > 0.97
