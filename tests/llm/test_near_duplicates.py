import random

import numpy as np

from pyspark.sql import functions as F

from rankloom.llm import near_duplicates as N


def classes_by_brute_force(rows):
    """All pairs, exact Jaccard on word sets, closed to components."""
    sets = []
    for _, text in rows:
        w = N.words_of((text or "").encode())
        k = min(5, len(w))
        sets.append((tuple(w), {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = sets[i][0] == sets[j][0]
            both, any_ = len(sets[i][1] & sets[j][1]), len(sets[i][1] | sets[j][1])
            if same or (any_ and 5 * both >= 4 * any_):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}


def near_copies(rng, words, n, edits):
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        yield " ".join(w)


def test_classes_equal_those_of_all_pairs(docs_of):
    rng = random.Random(2)
    text = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    texts = [None, "", "...", "one", "One!", "one two", "a b c d e", "a b c d e f"]
    for n, copies, edits in ((60, 12, 4), (200, 40, 9), (30, 6, 2), (400, 10, 20)):
        texts += near_copies(rng, text(n), copies, edits)
    texts += [" ".join(text(rng.randint(1, 80))) for _ in range(60)]
    texts += ["again and again " * 200, "again and again " * 300, texts[10], texts[10].upper()]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = docs_of(rows).withColumn("class_id", F.lit("clash")).withColumn("n", F.lit(1))
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}
    assert got == classes_by_brute_force(rows)


def test_a_chain_of_near_copies_is_one_class(docs_of):
    words, texts = [f"w{i}" for i in range(120)], []
    for step in range(30):
        texts.append(" ".join(words))
        words[(step * 7) % 120] = f"x{step}"
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs_of(rows)).collect()}
    assert got == classes_by_brute_force(rows) and set(got.values()) == {0}


def test_places_agree_as_probability_jaccard():
    rng = np.random.default_rng(4)
    items = rng.integers(0, 2**63, 60).astype(np.uint64)
    x, y = rng.uniform(0.5, 4, 60), rng.uniform(0.5, 4, 60)
    x[:10], y[50:] = 0, 0
    want = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(60)) for i in range(60) if x[i] and y[i])
    a = N.prob_minhash(np.zeros(50, np.int64), items[10:], x[10:], 1, places=8192)
    b = N.prob_minhash(np.zeros(50, np.int64), items[:50], y[:50], 1, places=8192)
    assert abs((a == b).mean() - want) < 0.03


def test_batches_do_not_change_signatures():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 2**63, 90).astype(np.uint64)
    owner = np.repeat([0, 1, 2], 30)
    weights = rng.uniform(1, 3, 90)
    together = N.prob_minhash(owner, items, weights, 3)
    for i in range(3):
        assert (together[i] == N.prob_minhash(np.zeros(30, np.int64), items[owner == i], weights[owner == i], 1)[0]).all()


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(100 + i, 101 + i) for i in range(40)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in N.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert N.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_stays(docs_of):
    base = " ".join(f"w{i}" for i in range(40))
    docs = docs_of([(5, base), (3, base), (3, base), (9, base + " more"), (7, "other text"), (None, "no id"), (8, None), (2, "")])
    left = N.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 2, 3, 7]
    assert N.near_duplicates(docs_of([])).count() == 0 and N.one_of_each(docs_of([])).count() == 0
