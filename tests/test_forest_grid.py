import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors

from rankloom.operators import forest_grid as FG


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [(i % 3, rng.randrange(3), None) for i in range(150)]
    data = [(f, y, [y + rng.gauss(0, 1.0), rng.random(), y * rng.random(), rng.random()]) for f, y, _ in data]
    df = spark.createDataFrame(data, "fold int, label int, v array<double>")
    return df.select("fold", "label", array_to_vector("v").alias("features")).coalesce(1).cache()


def by_hand(model, x, trees, depth, split):
    """Votes of the first trees, walked node by node through the model's own objects."""
    votes = 0
    for t in list(model.trees)[:trees]:
        node = t._call_java("rootNode")
        for _ in range(depth):
            if node.subtreeDepth() == 0 or sum(node.impurityStats().stats()) < split:
                break
            s = node.split()
            node = node.leftChild() if x[s.featureIndex()] <= s.threshold() else node.rightChild()
        stats = np.array(list(node.impurityStats().stats()))
        votes = votes + stats / stats.sum()
    return int(np.argmax(votes))


def test_prefixes_equal_walking_by_hand(spark, rows):
    model = RandomForestClassifier(numTrees=9, maxDepth=8, seed=42).fit(rows)
    forest = FG.forest_nodes(spark, model)
    data = rows.limit(25).collect()
    x, y = np.array([r["features"].toArray() for r in data]), np.array([r["label"] for r in data])
    got = FG.hits(forest, x, y, (4, 9), (2, 8), (2, 12))
    for (n, d, s), right in got.items():
        assert right == sum(by_hand(model, v, n, d, s) == k for v, k in zip(x, y))
    assert len(got) == 8 and len(set(got.values())) > 1


def test_the_whole_forest_predicts_as_the_model(spark, rows):
    model = RandomForestClassifier(numTrees=7, maxDepth=30, seed=42).fit(rows)
    found = FG.scored(rows, FG.forest_nodes(spark, model), (7,), (30,), (2,)).collect()
    assert [(r["right"], r["n"]) for r in found] == [(model.transform(rows).filter("prediction = label").count(), 150)]


def test_grid_has_every_setting(rows):
    got = FG.forest_grid(rows, trees=(2, 5), depths=(None, 2, 30), splits=(2, 20), leaves=(1, 3))
    assert len({r[:4] for r in got}) == len(got) == 2 * 3 * 2 * 2
    by = {r[:4]: r[4] for r in got}
    assert all(by[None, s, leaf, n] == by[30, s, leaf, n] for _, s, leaf, n in by)
    assert all(0.3 < v <= 1 for v in by.values())


def test_rows_without_values_are_left_out(spark, rows):
    more = rows.unionByName(spark.createDataFrame([(0, None, None), (None, 1, Vectors.dense([0.0, 1.0, 2.0, 3.0]))], rows.schema))
    assert FG.forest_grid(more, (3,), (4,), (2,), (1,)) == FG.forest_grid(rows, (3,), (4,), (2,), (1,))


def test_best_split_by_brute_force():
    rng = np.random.default_rng(3)
    x, y, w = rng.integers(0, 6, (60, 5)).astype(np.uint8), rng.integers(0, 3, 60), rng.integers(1, 4, 60).astype(float)
    node = np.sort(rng.integers(0, 3, 60))
    node[:3] = [0, 1, 2]
    tried = np.array([[0, 1, 4], [3, 2, 1], [4, 3, 0]])
    stats = np.stack([[w[(node == n) & (y == c)].sum() for c in range(3)] for n in range(3)])
    gain, feature, cut = FG.best_splits(x, y, w, node, tried, stats, 4)

    def gini(mask):
        share = np.array([w[mask & (y == c)].sum() for c in range(3)]) / w[mask].sum()
        return 1 - (share**2).sum()

    for n in range(3):
        inside, found = node == n, {}
        for f in tried[n]:
            for b in range(6):
                left, right = inside & (x[:, f] <= b), inside & (x[:, f] > b)
                if min(w[left].sum(), w[right].sum()) >= 4:
                    found[f, b] = gini(inside) - (w[left].sum() * gini(left) + w[right].sum() * gini(right)) / w[inside].sum()
        assert gain[n] == pytest.approx(max(found.values())) == pytest.approx(found[feature[n], cut[n]])


def test_grown_trees_keep_the_rules():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, FG.BINS, (400, 9)).astype(np.uint8), rng.integers(0, 4, 400)
    seeds = [(1, t) for t in range(3)]
    for tree, alone, seed in zip(FG.grown(x, y, 4, 3, 30, seeds), [FG.grown(x, y, 4, 3, 30, [s])[0] for s in seeds], seeds):
        assert all(np.array_equal(getattr(tree, k), getattr(alone, k)) for k in ("feature", "threshold", "left", "right", "size", "share"))
        w = np.random.default_rng(seed).poisson(1.0, 400)
        at, inner = [*FG.stops(tree, x, [30], 2)][0], tree.feature >= 0
        leaves = np.unique(at)
        assert tree.size[0] == w.sum() and (tree.size[leaves] >= 3).all() and not inner[leaves].any()
        assert all(tree.size[n] == w[at == n].sum() and tree.share[n] * tree.size[n] == pytest.approx(np.bincount(y[at == n], w[at == n], 4)) for n in leaves)
        ends = inner.nonzero()[0]
        ends = ends[~inner[tree.left[ends]] & ~inner[tree.right[ends]]]
        assert (tree.share[tree.left[ends]].argmax(axis=1) != tree.share[tree.right[ends]].argmax(axis=1)).all()
    assert all(len(t.feature) <= 7 for t in FG.grown(x, y, 4, 1, 2, seeds))


def test_bounds_of_bins():
    few, many = np.repeat([5.0, 1.0, 2.0], 20), np.arange(60.0) ** 2
    got = FG.bounds(np.stack([few, many, np.ones(60)], axis=1))
    assert got[0][:3].tolist() == [1.5, 3.5, np.inf] and np.isinf(got[2]).all()
    sizes = np.bincount(np.searchsorted(got[1], many), minlength=FG.BINS)
    assert len(sizes) == FG.BINS and sizes.min() >= 1 and sizes.max() <= 3


def test_trees_are_dealt_to_tasks(rows, monkeypatch):
    def sizes(task_bytes):
        monkeypatch.setattr(FG, "TASK_BYTES", task_bytes)
        return FG.forest_grid(rows, trees=(3, 30), depths=(None, 2), splits=(2, 10), leaves=(1, 4))

    alone = sizes(0)
    monkeypatch.setattr(FG, "BLOCK_ROWS", 16)
    monkeypatch.setattr(FG, "RandomForestClassifier", None)  # no forest is fitted as a whole
    dealt = sizes(1 << 20)
    assert [r[:4] for r in dealt] == [r[:4] for r in alone] and dealt == sizes(1 << 20)
    large = [(a[4], b[4]) for a, b in zip(dealt, alone) if a[3] == 30]
    assert abs(np.mean([a - b for a, b in large])) < 0.06 and min(a for a, _ in large) > 0.5


def test_no_features_are_refused(spark, rows):
    for bad in ((0, 1, Vectors.dense([0.0, float("nan"), 2.0, 3.0])), (0, -1, Vectors.dense([0.0, 1.0, 2.0, 3.0]))):
        with pytest.raises(Exception, match="whole numbers from 0"):
            FG.forest_grid(rows.unionByName(spark.createDataFrame([bad], rows.schema)), (3,), (4,), (2,), (1,))
