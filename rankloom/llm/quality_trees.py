"""Quality rules: gradient-boosted trees over document statistics.

One pass over the texts gives fixed statistics per document. The trees are fitted to
labelled documents (at most ``TRAIN_ROWS``, those with the least hash of their id) by
histogram boosting on the logistic loss. Chosen statistics are monotonic: more
symbols, repeated lines or repeated words never raise the score. A split that would
break this is not made, and the middle between two children bounds all that is below
them. Trees are flattened into node arrays and walked for whole batches at once.

A document fails the base rule when it has fewer than 50 words or more than half of its
words lie in repeated three-word windows; the trees then have no say. Null text has no
words. Rows are judged one by one, so repeated rows and ids do no harm; a label
without document, or null, is not used, and without labels only the base rule
decides. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import gram_hashes, hash_words, query, table, text_bytes
from rankloom.session import cut_lineage

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, L2 = 60, 3, 0.2, 32, 1.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the trees see; -1: more of it never raises the score, 1: never lowers it, 0: free.
MONOTONIC = {
    "words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "capitals": -1,
    "digits": 0,
    "marks": 0,
    "distinct_words": 0,
    "words_per_line": 0,
    "stops_per_word": 0,
}


def _class(chars: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars.encode())] = True
    return mask


_SYMBOLS, _SPACE, _STOPS = _class("#*$%&|<>"), _class(" \t\n\v\f\r"), _class(".,;:")
_CAPITALS, _LETTERS, _DIGITS = (np.array([f(chr(c)) and c < 128 for c in range(256)]) for f in (str.isupper, str.isalpha, str.isdigit))
_MARKS = np.array([33 <= c < 128 and not chr(c).isalnum() for c in range(256)])
_CONTINUES = np.arange(256) >> 6 == 2


def repeated_words(words: np.ndarray, size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    grams = gram_hashes(words, size)
    if len(grams) < 2:
        return 0
    _, at, times = np.unique(grams, return_inverse=True, return_counts=True)
    twice = times[at] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """(COUNTS, statistics in the order of MONOTONIC)."""
    words = hash_words(text.split())
    n = len(words)
    per = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(per[_CONTINUES].sum()) - int(per[_SPACE].sum())
    symbols = int(per[_SYMBOLS].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    many = max(n, 1)
    shares = [
        float(np.log1p(n)),
        chars / many,
        symbols / many,
        dup / max(len(lines), 1),
        repeat / many,
        float(per[_CAPITALS].sum() / max(per[_LETTERS].sum(), 1)),
        float(per[_DIGITS].sum() / max(chars, 1)),
        float(per[_MARKS].sum() / many),
        len(np.unique(words)) / many,
        n / max(len(lines), 1),
        float(per[_STOPS].sum() / many),
    ]
    return [n, chars, symbols, dup, repeat], shares


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and statistics of every row."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in text_bytes(batch.column(1))]
            counts = np.array([f[0] for f in found], np.int64).reshape(-1, len(COUNTS))
            shares = np.array([f[1] for f in found], np.float64).reshape(-1, len(MONOTONIC))
            columns = [pa.array(counts[:, i]) for i in range(len(COUNTS))] + [pa.array(shares[:, i]) for i in range(len(MONOTONIC))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *COUNTS, *MONOTONIC])

    id_type = named.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in MONOTONIC))


@dataclass
class Trees:
    """Node arrays of all trees; a leaf points at itself."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class for every row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, monotonic: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boost ``trees`` trees of ``depth`` levels; ``x`` is a bounded sample."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    bins = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], 1)
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    raw = np.full(n, start)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(value: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def best_value(g, h, lo, hi):
        return np.clip(-g / (h + L2), lo, hi)

    def gain(g, h, v):
        return -(g * v + 0.5 * (h + L2) * v * v)

    def grow(rows, g, h, level, lo, hi) -> int:
        value = float(best_value(g[rows].sum(), h[rows].sum(), lo, hi))
        best = (1e-6, None)
        if level < depth and len(rows) >= 20:
            whole = gain(g[rows].sum(), h[rows].sum(), value)
            for j in range(m):
                size = len(cuts[j]) + 1
                gl = np.cumsum(np.bincount(bins[rows, j], weights=g[rows], minlength=size))[:-1]
                hl = np.cumsum(np.bincount(bins[rows, j], weights=h[rows], minlength=size))[:-1]
                nl = np.cumsum(np.bincount(bins[rows, j], minlength=size))[:-1]
                gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
                vl, vr = best_value(gl, hl, lo, hi), best_value(gr, hr, lo, hi)
                won = gain(gl, hl, vl) + gain(gr, hr, vr) - whole
                ok = (nl >= 10) & (len(rows) - nl >= 10) & (monotonic[j] * (vr - vl) >= 0)
                won = np.where(ok, won, -np.inf)
                if len(won) and won.max() > best[0]:
                    k = int(won.argmax())
                    best = (float(won[k]), (j, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            at = leaf(rate * value)
            raw[rows] += rate * value
            return at
        j, k, vl, vr = best[1]
        at = leaf(0.0)
        inside = bins[rows, j] <= k
        middle = (vl + vr) / 2
        bounds_l = (lo, middle) if monotonic[j] > 0 else (middle, hi) if monotonic[j] < 0 else (lo, hi)
        bounds_r = (middle, hi) if monotonic[j] > 0 else (lo, middle) if monotonic[j] < 0 else (lo, hi)
        left = grow(rows[inside], g, h, level + 1, *bounds_l)
        right = grow(rows[~inside], g, h, level + 1, *bounds_r)
        nodes[at][:4] = [j, float(cuts[j][k]), left, right]
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
    f, t, left, right, v = zip(*nodes)
    return Trees(start, np.array(roots), np.array(f), np.array(t), np.array(left), np.array(right), np.array(v), depth)


def fitted(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Trees | None:
    """Trees for a table of statistics and a table of 0/1 labels."""
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("_y")).dropna()
    sample = stats.join(marked, "doc_id").select(F.xxhash64("doc_id").alias("_h"), "_y", *MONOTONIC)
    rows = sample.orderBy("_h", *MONOTONIC, "_y").limit(TRAIN_ROWS).toPandas()
    if not len(rows):
        return None
    return fit(rows[list(MONOTONIC)].to_numpy(np.float64), rows["_y"].to_numpy(np.float64), list(MONOTONIC.values()))


def judged(stats: DataFrame, trees: Trees | None) -> DataFrame:
    """The counts with base_failed, the trees' score and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(i).to_numpy() for i in range(b.num_columns - len(MONOTONIC), b.num_columns)], 1)
            score = trees.score(x) if trees else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(1 + len(COUNTS))], pa.array(score)], ["doc_id", *COUNTS, "score"])

    id_type = stats.schema["doc_id"].dataType.simpleString()
    out = stats.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", score double")
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= 0.5)).alias("kept"), "score")


@query("op3_quality_trees")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cut_lineage(measured(table(spark, sf_dir, "documents")))
    return judged(stats, fitted(stats, table(spark, sf_dir, "labels")))
