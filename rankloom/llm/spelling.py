"""Spelling variants by k-d trees over letter counts.

A word is a point: how often it has each letter. One inserted or deleted letter moves the
point by one, a replaced one by one up and one down, so near words are at an L1 distance of
two at most, and which steps up and down are left is known for each pair of lengths: one
up to the next length, one up and one down within a length. A k-d tree over the points of
one length, cut at the letter that halves them best, is searched by boxes: a query goes
down a branch only while the steps to its box are left. Words at the right distance are
then compared letter by letter.

A first tree for each length, fitted on a hashed sample of at most ``SAMPLE`` words, deals
the words to parts of about ``PART`` words; every word is dealt, the sample only settles
how even the parts are. A word goes to its own part and, as a query, to all parts whose
boxes it reaches. Parts are worked on apart from each other with trees of their own, so
no task ever holds all words of a length, and no pairs are made but those inside small
boxes. Words that have all letters alike cannot be cut apart; they are compared in turn.

Every pair is found once; forms are followed by doubling the steps until no root moves.
A null text has no words, a null id counts as the empty text. Repeated rows count as often
as they occur. Very long texts are taken in slices. Ties go to the word that sorts first.
Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import query, table
from rankloom.session import cut_lineage

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: One in so many runs of letters loses a letter.
SPOILED = 199
#: A form occurs this many times as often as its variant.
FORM_TIMES = 5
#: Words of a part, words of all lengths that the first trees are fitted on, words in a box.
PART = 4_000
SAMPLE = 200_000
BOX = 24
#: Distinct words a task holds before it hands over counts; pairs compared at once.
BLOCK_VOCABULARY = 1 << 18
BLOCK_PAIRS = 200_000
#: Characters of a text taken at once.
SLICE = 1 << 20

#: Runs of letters that may count; spoiling makes words shorter only, so short ones never do.
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")
#: Places of a letter count: a to z, then the letters from U+00C0.
LETTERS = 26 + 64


def runs_of(text: str) -> Iterator[list[str]]:
    """Runs of ``LEAST_LETTERS`` letters and more with A-Z lower-cased, slice by slice."""
    at = 0
    while at < len(text):
        end = _GAP.search(text, at + SLICE) if len(text) - at > SLICE else None
        stop = end.end() if end else len(text)
        # Lower-casing bytes changes A-Z alone.
        yield _RUN.findall(text[at:stop].encode().lower().decode())
        at = stop


def spoiled(word: str, h: int) -> str:
    """The word, without the letter that its hash names if the hash says so."""
    if h % SPOILED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def handed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
            for runs in runs_of(text.as_py() or ""):
                for word, n in Counter(runs).items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % SPOILED:
                        word = spoiled(word, h)
                        if len(word) < LEAST_LETTERS:
                            continue
                    counts[word] += n
                if len(counts) >= BLOCK_VOCABULARY:
                    yield handed()
    if counts:
        yield handed()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words that occur ``least`` times."""
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def codes_of(words: list[str]) -> np.ndarray:
    """Code points, word by place; words have one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int32)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    place = np.where(codes >= 0xC0, codes - 0xC0 + 26, codes - 0x61)
    out = np.zeros((len(codes), LETTERS), np.int16)
    np.add.at(out, (np.repeat(np.arange(len(codes)), codes.shape[1]), place.ravel()), 1)
    return out


class Tree:
    """K-d tree over letter counts. ``nodes`` are (letter, largest count on the left, left,
    right); a negative child is leaf -1 - child."""

    def __init__(self, points: np.ndarray, most: int):
        self.nodes: list[list[int]] = []
        self.leaves = 0
        self.members: list[np.ndarray] = []
        self.root = self._cut(points, np.arange(len(points)), most)

    def _cut(self, points: np.ndarray, at: np.ndarray, most: int) -> int:
        split = _best_cut(points[at]) if len(at) > most else None
        if split is None:
            self.members.append(at)
            self.leaves += 1
            return -self.leaves
        letter, count = split
        node = len(self.nodes)
        self.nodes.append([letter, count, 0, 0])
        left = points[at, letter] <= count
        self.nodes[node][2] = self._cut(points, at[left], most)
        self.nodes[node][3] = self._cut(points, at[~left], most)
        return node

    def within(self, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, points that reach its box by ``up`` steps up and ``down`` steps down)."""
        none = np.zeros(len(points), np.int16)
        todo = [(self.root, np.arange(len(points)), none + up, none + down, {})]
        while todo:
            node, at, ups, downs, box = todo.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at
                continue
            letter, count, left, right = self.nodes[node]
            low, high = box.get(letter, (0, None))
            own = points[at, letter]
            # Steps that the box asked for already, and those that the half asks for.
            asked = np.maximum(own - high, 0) if high is not None else 0
            downs_left = downs + asked - np.maximum(own - count, 0)
            keep = downs_left >= 0
            todo.append((left, at[keep], ups[keep], downs_left[keep], {**box, letter: (low, count)}))
            asked = np.maximum(low - own, 0)
            ups_left = ups + asked - np.maximum(count + 1 - own, 0)
            keep = ups_left >= 0
            todo.append((right, at[keep], ups_left[keep], downs[keep], {**box, letter: (count + 1, high)}))


def _best_cut(points: np.ndarray) -> tuple[int, int] | None:
    """(letter, count) that halves the points best; None when all are alike."""
    best, found = 0, None
    most = points.max(axis=0)
    for letter in np.flatnonzero(most > points.min(axis=0)):
        below = np.cumsum(np.bincount(points[:, letter]))[:-1]
        count = int(np.abs(below * 2 - len(points)).argmin())
        smaller = min(below[count], len(points) - below[count])
        if smaller > best:
            best, found = smaller, (int(letter), count)
    return found


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``b`` differ from those of ``a`` by one code point, replaced if they
    are of one length, else inserted in ``b``."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    shift = np.cumsum(a != b[:, :-1], axis=1) > 0
    return (np.where(shift, b[:, 1:], b[:, :-1]) == a).all(axis=1)


def near_in(points: list[str], queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (query, point) of near words; points are of one length, queries of the same or the one below."""
    codes, asked = codes_of(points), codes_of(queries)
    own, wanted = letter_counts(codes), letter_counts(asked)
    same = codes.shape[1] == asked.shape[1]
    tree = Tree(own, BOX)
    for leaf, at in tree.within(wanted, 1, 1 if same else 0):
        members = tree.members[leaf]
        step = max(1, BLOCK_PAIRS // len(members))
        for i in range(0, len(at), step):
            q = np.repeat(at[i : i + step], len(members))
            p = np.tile(members, len(at[i : i + step]))
            apart = np.abs(own[p] - wanted[q]).sum(axis=1) == (2 if same else 1)
            q, p = q[apart], p[apart]
            hit = one_edit(asked[q], codes[p])
            yield q[hit], p[hit]


def first_trees(words: DataFrame, sample: int = SAMPLE, part: int = PART) -> dict[int, Tree]:
    """A tree for each length; leaves hold about ``part`` words of the whole table."""
    n = words.count()
    share = min(1.0, sample / max(n, 1))
    rows = words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))
    by: dict[int, list[str]] = {}
    for w in rows.select("word").limit(sample).toPandas()["word"]:
        by.setdefault(len(w), []).append(w)
    return {k: Tree(letter_counts(codes_of(v)), max(BOX, int(part * share))) for k, v in by.items()}


def near_words(words: DataFrame, sample: int = SAMPLE, part: int = PART) -> DataFrame:
    """Pairs (word, other) of near words, each once; ``other`` is the longer word, or
    of two words of one length that which sorts last."""
    trees = first_trees(words, sample, part)
    for tree in trees.values():
        tree.members = []  # not needed to deal words
    alone = Tree(np.zeros((0, LETTERS), np.int16), 1)  # for lengths that the sample has not met

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, list[str]] = {}
            for w in batch.column(0).to_pylist():
                by.setdefault(len(w), []).append(w)
            for length, some in by.items():
                counts = letter_counts(codes_of(some))
                for to, up, down, role in [(length, 0, 0, 0), (length, 1, 1, 1), (length + 1, 1, 0, 1)]:
                    for leaf, at in trees.get(to, alone).within(counts, up, down):
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, to, np.int32)), pa.array(np.full(n, leaf, np.int32)), pa.array(np.full(n, role, np.int32)), pa.array(some, pa.string()).take(pa.array(at))],
                            ["length", "leaf", "role", "word"],
                        )

    def found(part: pa.Table) -> pa.Table:
        words_, role = part["word"].to_pylist(), part["role"].to_numpy()
        points = [w for w, r in zip(words_, role) if r == 0]
        out: list[tuple[pa.Array, pa.Array]] = []
        length = int(part["length"][0].as_py())
        for size in (length, length - 1):
            queries = [w for w, r in zip(words_, role) if r == 1 and len(w) == size]
            if not points or not queries:
                continue
            a, b = pa.array(queries), pa.array(points)
            for q, p in near_in(points, queries):
                if size == length:
                    keep = np.fromiter((queries[i] < points[j] for i, j in zip(q, p)), bool, len(q))
                    q, p = q[keep], p[keep]
                out.append((a.take(pa.array(q)), b.take(pa.array(p))))
        schema = pa.schema([("word", pa.string()), ("other", pa.string())])
        if not out:
            return schema.empty_table()
        return pa.table([pa.chunked_array([o[0] for o in out]), pa.chunked_array([o[1] for o in out])], schema=schema)

    parts = words.select("word").mapInArrow(dealt, "length int, leaf int, role int, word string")
    return parts.groupBy("length", "leaf").applyInArrow(found, "word string, other string")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT, times: int = FORM_TIMES) -> DataFrame:
    """Every word with its form, root, count, number of near words and its form's count."""
    words = cut_lineage(word_counts(docs, id_col, text_col, least))
    pairs = near_words(words)
    both = cut_lineage(pairs.select(F.explode(F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other")))).alias("p")).select("p.*"))
    sized = both.join(words.withColumnsRenamed({"word": "other", "n": "m"}), "other")
    near = sized.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), F.col("other").alias("form"))).alias("best"), F.max("m").alias("form_n"))
    formed = F.col("form_n") >= F.col("n") * times
    rows = cut_lineage(
        words.join(near, "word", "left").select(
            "word", F.when(formed, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(formed, F.col("form_n")).alias("form_n")
        )
    )
    return rows.join(roots(rows.filter("form IS NOT NULL").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last; counts grow along the way, so there is one."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reached = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return reached


@query("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
