"""Grid search of a random forest with one fit for each leaf size and fold.

A forest of n trees holds all smaller forests as its first trees, a deep tree all
shallower ones above a depth, and a tree that may split any node all trees that split
larger nodes only. So each (leaf size, fold) is fitted once, with the most trees, the
greatest depth and the least split size, and every other setting is scored by walking
those trees and stopping earlier: 9 fits serve the 108 settings and three folds.

Rows are binned and packed in blocks, and the trees of all fits are dealt to tasks by a shuffle
of the blocks. A task grows its trees by the rules of Spark ML (Poisson draws, a root's share of
the features for each node, Gini gain over 32 bins, siblings of one verdict joined) and adds up
their votes for the held-out rows, block by block; neither trees nor rows reach the driver.

Where the binned rows are more than a task may hold, Spark ML fits the forests one by one. Nodes are
then taken from the saved form of the model; they are as large as the model itself,
which Spark ML keeps on the driver too. Rows are scored where they lie, in Arrow batches,
and come back as one count per setting.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.session import cut_lineage, scratch_path

#: The deepest tree that Spark ML grows; a depth of None means it.
DEEPEST = 30
#: Bins of a feature, and rows that their bounds are taken from, as in Spark ML.
BINS = 32
BOUND_ROWS = 10_000
#: Bytes of binned rows that a task may hold, rows of a block, trees of a task, and drawn rows of trees grown at once.
TASK_BYTES = 64 << 20
BLOCK_ROWS = 1024
TASK_TREES = 25
GROWN_ROWS = 40_000
SEED = 42


@dataclass
class Nodes:
    """One tree: feature of a node (-1 for a leaf), threshold, children, rows, class shares."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    share: np.ndarray


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> list[Nodes]:
    """Trees of a fitted forest as arrays, node by node."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    n = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["impurityStats"].alias("stats"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    )
    out = []
    for _, tree in rows.toPandas().sort_values(["treeID", "id"]).groupby("treeID"):
        stats = np.stack(tree["stats"].to_numpy())
        inner = tree["left"].to_numpy() >= 0
        size = stats.sum(axis=1)
        out.append(
            Nodes(
                np.where(inner, tree["feature"].to_numpy(), -1).astype(np.int32), tree["threshold"].fillna(0.0).to_numpy(np.float64),
                tree["left"].to_numpy(np.int32), tree["right"].to_numpy(np.int32), size, stats / np.maximum(size, 1e-300)[:, None],
            )
        )
    return out


def stops(tree: Nodes, x: np.ndarray, depths: list[int], split: int) -> Iterator[np.ndarray]:
    """For each of the rising ``depths`` the node at which every row of ``x`` stops."""
    at = np.zeros(len(x), np.int32)
    rows = np.arange(len(x))
    level = 0
    for depth in depths:
        while level < depth:
            going = rows[(tree.feature[at] >= 0) & (tree.size[at] >= split)]
            if not len(going):
                break
            node = at[going]
            below = x[going, tree.feature[node]] <= tree.threshold[node]
            at[going] = np.where(below, tree.left[node], tree.right[node])
            level += 1
        yield at


def hits(forest: list[Nodes], x: np.ndarray, y: np.ndarray, trees: tuple[int, ...], depths: tuple[int, ...], splits: tuple[int, ...]) -> dict[tuple[int, int, int], int]:
    """Rows that each (trees, depth, split) predicts rightly; a tree votes by class shares."""
    deep = sorted(depths)
    votes = {(d, s): np.zeros((len(x), forest[0].share.shape[1])) for d, s in product(deep, splits)}
    out = {}
    for i, tree in enumerate(forest, 1):
        for s in splits:
            for d, at in zip(deep, stops(tree, x, deep, s)):
                votes[d, s] += tree.share[at]
        if i in trees:
            for (d, s), v in votes.items():
                out[i, d, s] = int((v.argmax(axis=1) == y).sum())
    return out


def scored(rows: DataFrame, forest: list[Nodes], trees: tuple[int, ...], depths: tuple[int, ...], splits: tuple[int, ...]) -> DataFrame:
    """(trees, depth, split, right, n) of the rows (features, label)."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            found = hits(shared.value, flat.reshape(batch.num_rows, -1), batch.column(1).to_numpy(), trees, depths, splits)
            keys = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k, pa.int32()) for k in keys], pa.array(list(found.values()), pa.int64()), pa.array([batch.num_rows] * len(found), pa.int64())],
                ["trees", "depth", "split", "right", "n"],
            )

    counted = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("int")).mapInArrow(run, "trees int, depth int, split int, right bigint, n bigint")
    return counted.groupBy("trees", "depth", "split").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))


def bounds(x: np.ndarray) -> np.ndarray:
    """Upper bounds of the bins of every column but the last bin's: midpoints of neighbouring values, of
    many those that cut the rows evenly. Bounds that a column lacks are infinite."""
    out = np.full((x.shape[1], BINS - 1), np.inf)
    for i, column in enumerate(x.T):
        values, n = np.unique(column, return_counts=True)
        middle = (values[:-1] + values[1:]) / 2
        if len(middle) >= BINS:
            at = np.unique(np.searchsorted(np.cumsum(n), len(column) * np.arange(1, BINS) / BINS))
            middle = middle[at[at < len(middle)]]
        out[i, : len(middle)] = middle
    return out


def best_splits(x: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, tried: np.ndarray, stats: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and last bin on the left of every node's best split among its ``tried`` features, from the
    bins ``x``, classes, weights and nodes of the rows; every node has some."""
    n, classes = stats.shape
    size, every = stats.sum(axis=1), np.arange(len(x))
    best, feature, cut = np.full(n, -np.inf), np.zeros(n, np.int32), np.zeros(n, np.int32)
    for chosen in tried.T:
        key = node * BINS + x[every, chosen[node]]
        used = np.bincount(key, minlength=n * BINS) > 0
        cells = np.flatnonzero(used)
        of = cells // BINS
        rank = np.cumsum(used) - 1
        count = np.bincount(rank[key] * classes + y, w, len(cells) * classes).reshape(-1, classes)
        begin = np.searchsorted(of, np.arange(n))
        upto = np.cumsum(count, axis=0)
        left = upto - (upto[begin] - count[begin])[of]
        right = stats[of] - left
        n_left = left.sum(axis=1)
        n_right = size[of] - n_left
        score = ((left * left).sum(axis=1) / n_left + (right * right).sum(axis=1) / np.maximum(n_right, 1)) / size[of]
        score[(n_left < leaf) | (n_right < leaf)] = -np.inf
        top = np.maximum.reduceat(score, begin)
        first = np.zeros(n, np.int64)
        tops = np.flatnonzero(score == top[of])[::-1]
        first[of[tops]] = tops
        better = top > best
        best[better], feature[better], cut[better] = top[better], chosen[better], (cells[first] % BINS)[better]
    return best - (stats * stats).sum(axis=1) / (size * size), feature, cut


def grown(x: np.ndarray, y: np.ndarray, classes: int, leaf: int, depth: int, seeds: list[tuple[int, ...]]) -> list[Nodes]:
    """A tree for each of ``seeds`` from the binned rows ``x`` of the classes ``y``, all of them level by level at once."""
    draws = [np.random.default_rng(s) for s in seeds]
    weights = [r.poisson(1.0, len(x)) for r in draws]
    row = np.concatenate([np.flatnonzero(w) for w in weights])
    w = np.concatenate([w[w > 0] for w in weights]).astype(np.float64)
    node = np.repeat(np.arange(len(seeds)), [np.count_nonzero(w) for w in weights])
    tree, made, levels = np.arange(len(seeds)), 0, []
    some = int(np.ceil(np.sqrt(x.shape[1])))
    for level in range(depth + 1):
        n = len(tree)
        stats = np.bincount(node * classes + y[row], w, n * classes).reshape(n, classes)
        size = stats.sum(axis=1)
        at = {"tree": tree, "stats": stats, "feature": np.full(n, -1, np.int32), "threshold": np.zeros(n), "left": np.full(n, -1), "right": np.full(n, -1)}
        levels.append(at)
        made += n
        mixed = np.flatnonzero((size >= 2 * leaf) & (stats.max(axis=1) < size)) if level < depth else []
        if not len(mixed):
            break
        tried = np.concatenate([np.argpartition(r.random((k, x.shape[1])), some - 1)[:, :some] for r, k in zip(draws, np.bincount(tree[mixed], minlength=len(seeds)))])
        number = np.full(n, -1)
        number[mixed] = np.arange(len(mixed))
        row, w, node = (v[number[node] >= 0] for v in (row, w, node))
        node = number[node]
        gain, feature, cut = best_splits(x[row], y[row], w, node, tried, stats[mixed], leaf)
        split = np.flatnonzero(gain > 1e-12)
        if not len(split):
            break
        where = mixed[split]
        at["feature"][where], at["threshold"][where] = feature[split], cut[split]
        at["left"][where], at["right"][where] = made + 2 * np.arange(len(split)), made + 2 * np.arange(len(split)) + 1
        number = np.full(len(mixed), -1)
        number[split] = np.arange(len(split))
        row, w, node = (v[number[node] >= 0] for v in (row, w, node))
        node = 2 * number[node] + (x[row, feature[node]] > cut[node])
        tree = np.repeat(tree[where], 2)
    return _joined({k: np.concatenate([at[k] for at in levels]) for k in levels[0]}, [len(at["tree"]) for at in levels], len(seeds))


def _joined(nodes: dict[str, np.ndarray], sizes: list[int], trees: int) -> list[Nodes]:
    """Nodes of all trees, level by level, as single trees; leaves of one verdict are joined in their parent."""
    feature, left, right, stats = (nodes[k] for k in ("feature", "left", "right", "stats"))
    verdict = stats.argmax(axis=1)
    for begin, end in list(zip(np.cumsum([0, *sizes[:-1]]), np.cumsum(sizes)))[::-1]:
        inner = begin + np.flatnonzero(feature[begin:end] >= 0)
        a, b = left[inner], right[inner]
        feature[inner[(feature[a] < 0) & (feature[b] < 0) & (verdict[a] == verdict[b])]] = -1
    out, local = [], np.zeros(len(feature) + 1, np.int32)
    for t in range(trees):
        own = np.flatnonzero(nodes["tree"] == t)
        local[own] = np.arange(len(own))
        size = stats[own].sum(axis=1)
        out.append(Nodes(feature[own], nodes["threshold"][own], local[left[own]], local[right[own]], size, stats[own] / np.maximum(size, 1e-300)[:, None]))
    return out


def _flat(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def fold_bounds(rows: DataFrame, n: int, folds: int) -> dict[int, np.ndarray]:
    """Bounds of the bins for each fold, from ``BOUND_ROWS`` of the other folds' ``n`` rows (x, label, fold) at most, about."""
    every = max(1.0, n / BOUND_ROWS)
    drawn = rows.filter(F.rand(SEED) * every < 1) if every > 1 else rows
    dealt = drawn.withColumn("held", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).filter("fold != held").select("held", "x")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        x = _flat(table.column("x").combine_chunks(), table.num_rows)
        return pa.table({"held": pa.array([key[0].as_py()], pa.int32()), "bounds": pa.array([bounds(x).tobytes()], pa.binary())})

    found = dealt.groupBy("held").applyInArrow(run, "held int, bounds binary").collect()  # a row for each fold
    return {r["held"]: np.frombuffer(r["bounds"]).reshape(-1, BINS - 1) for r in found}


def binned(rows: DataFrame, cuts: dict[int, np.ndarray]) -> DataFrame:
    """Rows (x, label, fold) as blocks for each held-out fold: bins, labels and which rows are held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(begin, BLOCK_ROWS)
                x, label, fold = _flat(piece.column(0), piece.num_rows), piece.column(1).to_numpy(), piece.column(2).to_numpy()
                if np.isnan(x).any() or (label < 0).any() or (label % 1 != 0).any():
                    raise ValueError("features have to be numbers, and labels whole numbers from 0")
                out = []
                for held, cut in cuts.items():
                    bins = np.stack([np.searchsorted(c, v) for c, v in zip(cut, x.T)], axis=1).astype(np.uint8)
                    out.append({"held": held, "block": part << 32 | k, "bins": bins.tobytes(), "label": label.astype(np.int32).tobytes(), "out": (fold == held).tobytes()})
                k += 1
                yield pa.RecordBatch.from_pylist(out, pa.schema({"held": pa.int32(), "block": pa.int64(), "bins": pa.binary(), "label": pa.binary(), "out": pa.binary()}))

    return rows.mapInArrow(run, "held int, block bigint, bins binary, label binary, out binary")


def grown_and_scored(blocks: DataFrame, width: int, classes: int, trees: tuple[int, ...], depths: tuple[int, ...], splits: tuple[int, ...], leaves: tuple[int, ...]) -> DataFrame:
    """(leaf, fold, trees, depth, split, right, n) of the held-out rows of :func:`binned` blocks."""
    deep, settings = sorted(depths), len(depths) * len(splits)
    steps = list(zip([0, *sorted(trees)[:-1]], sorted(trees)))
    pieces = [(b, min(b + TASK_TREES, end)) for begin, end in steps for b in range(begin, end, TASK_TREES)]
    jobs = [(i, leaf, *piece) for i, (leaf, piece) in enumerate(product(leaves, pieces))]
    tasks = blocks.sparkSession.createDataFrame(jobs, "job int, leaf int, first int, last int")
    dealt = blocks.join(F.broadcast(tasks)).repartition(len(jobs) * 3, "job", "held")

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        _, held, leaf, first, last = [k.as_py() for k in key]
        part = sorted(table.select(["block", "bins", "label", "out"]).to_pylist(), key=lambda r: r["block"])
        x = np.frombuffer(b"".join(r["bins"] for r in part), np.uint8).reshape(-1, width)
        y = np.frombuffer(b"".join(r["label"] for r in part), np.int32)
        out = np.frombuffer(b"".join(r["out"] for r in part), bool)
        mine, yours, label = x[out], x[~out], y[~out]
        votes = np.zeros((len(mine), settings, classes))
        at_once = max(1, GROWN_ROWS // max(len(yours), 1))
        for begin in range(first, last, at_once):
            for tree in grown(yours, label, classes, leaf, deep[-1], [(SEED, held, t) for t in range(begin, min(begin + at_once, last))]):
                for j, s in enumerate(splits):
                    for i, at in enumerate(stops(tree, mine, deep, s)):
                        votes[:, i * len(splits) + j] += tree.share[at]
        ends = np.cumsum([np.frombuffer(r["out"], bool).sum() for r in part])
        rows = [(r["block"], votes[b:e].tobytes(), y[out][b:e].tobytes()) for r, b, e in zip(part, [0, *ends], ends) if b < e]
        return pa.table({
            "leaf": pa.array([leaf] * len(rows), pa.int32()), "fold": pa.array([held] * len(rows), pa.int32()), "last": pa.array([last] * len(rows), pa.int32()),
            **{k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate((("block", pa.int64()), ("votes", pa.binary()), ("label", pa.binary())))},
        })

    def count(key: tuple, table: pa.Table) -> pa.Table:
        leaf, fold, _ = [k.as_py() for k in key]
        found, votes = [], 0.0
        for r in sorted(table.select(["last", "votes", "label"]).to_pylist(), key=lambda r: r["last"]):
            votes = votes + np.frombuffer(r["votes"]).reshape(-1, settings, classes)
            if r["last"] in trees:
                right = (votes.argmax(axis=2) == np.frombuffer(r["label"], np.int32)[:, None]).sum(axis=0)
                found += [(leaf, fold, r["last"], d, s, int(v), len(votes)) for (d, s), v in zip(product(deep, splits), right)]
        kinds = [*[pa.int32()] * 5, pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["leaf", "fold", "trees", "depth", "split", "right", "n"])

    voted = dealt.groupBy("job", "held", "leaf", "first", "last").applyInArrow(grow, "leaf int, fold int, last int, block bigint, votes binary, label binary")
    counted = voted.groupBy("leaf", "fold", "block").applyInArrow(count, "leaf int, fold int, trees int, depth int, split int, right bigint, n bigint")
    return counted.groupBy("leaf", "fold", "trees", "depth", "split").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))


def forest_grid(
    training: DataFrame,
    trees: tuple[int, ...] = (100, 200, 300),
    depths: tuple[int | None, ...] = (None, 10, 20, 30),
    splits: tuple[int, ...] = (2, 5, 10),
    leaves: tuple[int, ...] = (1, 2, 4),
    folds: int = 3,
    parallelism: int = 8,
) -> list[tuple[int | None, int, int, int, float]]:
    """(depth, split, leaf, trees, mean accuracy over the folds) of every setting, by accuracy
    of the folds' own rows. ``training`` has features (vector), label from 0 and fold; rows
    without a label or features are left out, and folds without rows do not count. Settings
    that are equal, such as no depth and the greatest, have equal scores."""
    spark = training.sparkSession
    whole = training.dropna(subset=["features", "label", "fold"])
    deep = tuple(sorted({d or DEEPEST for d in depths}))

    def one(job: tuple[int, int]) -> list:
        leaf, fold = job
        rf = RandomForestClassifier(
            featuresCol="features", labelCol="label", numTrees=max(trees), maxDepth=max(deep), minInstancesPerNode=leaf, seed=42
        )
        forest = forest_nodes(spark, rf.fit(whole.filter(F.col("fold") != fold)))
        found = scored(whole.filter(F.col("fold") == fold), forest, trees, deep, splits).collect()  # a row for each setting
        return [(leaf, r["trees"], r["depth"], r["split"], r["right"] / r["n"]) for r in found]

    rows = whole.select(vector_to_array("features").alias("x"), F.col("label").cast("double"), F.col("fold").cast("int"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max("label").alias("top")).first()
    cuts = fold_bounds(rows, size["n"], folds) if 0 < size["n"] * (size["width"] or 0) <= TASK_BYTES else {}
    if len(cuts) == folds:
        blocks = cut_lineage(binned(rows, cuts))
        counts = grown_and_scored(blocks, size["width"], int(size["top"]) + 1, trees, deep, splits, leaves).collect()  # a row for each setting and fold
        found = [(r["leaf"], r["trees"], r["depth"], r["split"], r["right"] / r["n"]) for r in sorted(counts, key=lambda r: r["fold"])]
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            found = [row for part in pool.map(one, product(leaves, range(folds))) for row in part]
    parts: dict[tuple, list[float]] = {}
    for leaf, n, depth, split, share in found:
        parts.setdefault((leaf, n, depth, split), []).append(share)
    return [(d, s, leaf, n, float(np.mean(parts[leaf, n, d or DEEPEST, s]))) for d, s, leaf, n in product(depths, splits, leaves, trees) if (leaf, n, d or DEEPEST, s) in parts]
