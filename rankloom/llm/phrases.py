"""Phrase collocation mining over sorted count streams.

Texts are cut into pieces at marks and line ends, pieces into words. Phrases are counted
length by length, each language for itself. A phrase is frequent only if both phrases
that lack one of its end words are; so the next length takes only those that pass a
bit filter of the frequent ones before. The filter has a bounded size and may let
infrequent phrases through, never hold a frequent one back.

The frequent counts of all lengths make one stream, kept in two orders. In prefix order a
phrase stands after all phrases it starts with, in suffix order (by its words read
backwards) after all it ends with. One walk over a sorted stream therefore gives every
phrase the counts of its beginnings, the other the counts of its ends, and each also the
largest count of a phrase that is one word longer: the walk holds only the phrases that
the present one begins with. The stream is cut into ranges of equal size wherever that
falls, so a word that begins a third of all phrases is walked by many tasks. What the
first phrases of a range need from ranges before it is a phrase per length at most; these
few are looked up afterwards. The two walks are then merged phrase by phrase.

A word also inside a longer phrase of any length is inside one that is a single word
longer and at least as frequent, so looking at those is enough for the drop rule.
Scores are exact decimals.

Null text is empty, null language is ``und``. Repeated rows count as often as they occur.
Ties go to the more frequent phrase, then to the one that sorts first; equal cuts to the
shortest first part. Very long texts are taken in slices. Further columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import mix, query, table, text_bytes
from rankloom.operators.spread import top_k
from rankloom.session import cut_lineage

LEAST_COUNT = 10
MAX_WORDS = 3
#: A phrase goes if a longer one has at least this share of its count, in percent.
INSIDE_PERCENT = 50
TOP = 2000
UNKNOWN = "und"
#: Words and distinct words that a task holds before it hands over counts; rows handed over at once.
BLOCK_WORDS = 2_000_000
BLOCK_VOCABULARY = 1 << 18
BLOCK_ROWS = 100_000
#: Bytes of a text taken at once.
SLICE = 1 << 20
#: Bits of the filter for each frequent phrase, its largest size in bits (32 MB), and words of it that reach the driver as one row.
BITS_EACH = 16
MOST_BITS = 1 << 28
PART_WORDS = 1 << 13

#: Marks and line ends become full stops, tabs blanks.
_MARKS = bytes.maketrans(b",;:!?\x0a\x0b\x0c\x0d\x09", b".........\x20")
_CUT = re.compile(rb"[\x20\x09-\x0D.,;:!?]")


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case; a full stop stands between pieces."""
    return text.lower().translate(_MARKS).replace(b".", b" . ").split()


def slices(text: bytes) -> Iterator[bytes]:
    """The text in parts that end between words."""
    at = 0
    while len(text) - at > SLICE:
        end = _CUT.search(text, at + SLICE)
        if end is None:
            break
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def phrase_hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from the hashes of their words, place by place."""
    h = np.uint64(xxhash.xxh3_64_intdigest(lang))
    h = np.full(len(words[0]), h, np.uint64)
    for w in words:
        h = mix(h + w)
    return h


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h & np.uint64(len(bits) * 64 - 1)
    return (bits[h >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) == 1


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for; the full stop has 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Block:
    """Words of texts of one language, until they are counted."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.size += len(ids)


def _counter(size: int, bits):
    """Counts of phrases of ``size`` words, as (phrase, tab, language) and number."""

    def handed(grams: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(grams), BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays([grams.slice(at, BLOCK_ROWS), pa.array(counts[at : at + BLOCK_ROWS])], ["gram", "n"])

    def counted(lang: str, block: _Block, vocabulary: list[bytes], filter_bits) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(block.ids)
        n = len(ids) - size + 1
        if n <= 0:
            return
        good = ids[:n] > 0
        for j in range(1, size):
            good &= ids[j : j + n] > 0
        if size == 1:
            yield from handed(pa.array(["\t" + lang]), np.array([good.sum()]))
        elif filter_bits is not None:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))[ids]
            shorter = _passes(filter_bits, phrase_hash(lang, [hashes[j : j + n + 1] for j in range(size - 1)]))
            good &= shorter[:-1] & shorter[1:]
        at = np.flatnonzero(good)
        key = ids[at].astype(np.int64)
        for j in range(1, size):
            if j > 2:  # three ids fill a key
                key = np.unique(key, return_inverse=True)[1]
            key = key * (BLOCK_VOCABULARY + SLICE) + ids[at + j]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        words = pa.array(vocabulary, pa.binary()).cast(pa.string())
        for i in range(0, len(first), BLOCK_ROWS):
            places = at[first[i : i + BLOCK_ROWS]]
            grams = pc.binary_join_element_wise(*[words.take(pa.array(ids[places + j])) for j in range(size)], " ")
            yield from handed(pc.binary_join_element_wise(grams, pa.scalar(lang), "\t"), counts[i : i + BLOCK_ROWS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_bits = bits.value if bits is not None else None
        known = _Numbers()
        blocks: dict[str, _Block] = {}
        held = 0
        for batch in batches:
            for text, lang in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                blocks.setdefault(lang, _Block()).add(np.zeros(1, np.int32))
                for part in slices(text):
                    found = words_of(part)
                    blocks[lang].add(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                    held += len(found) + 1
                    if held >= BLOCK_WORDS or len(known) >= BLOCK_VOCABULARY:
                        vocabulary = list(known)
                        tail = np.concatenate(blocks[lang].ids)[-(size - 1) :] if size > 1 else np.zeros(0, np.int32)
                        for name, block in blocks.items():
                            yield from counted(name, block, vocabulary, filter_bits)
                        known, blocks, held = _Numbers(), {}, 0
                        # The text may go on: its last words stay, under new numbers.
                        kept = [known[vocabulary[i]] for i in tail]
                        blocks.setdefault(lang, _Block()).add(np.array(kept, np.int32))
        for name, block in blocks.items():
            yield from counted(name, block, list(known), filter_bits)

    return run


def _marked(size: int):
    """Filter bits of phrases: (word of the filter, bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[list[bytes]]] = {}
            for lang, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(words)
            for lang, rows in by.items():
                parts = [np.fromiter((xxhash.xxh3_64_intdigest(r[j]) for r in rows), np.uint64, len(rows)) for j in range(len(rows[0]))]
                h = phrase_hash(lang, parts) & np.uint64(size - 1)
                yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (h & np.uint64(63))).view(np.int64))], ["slot", "bits"])

    return run


def _part(width: int):
    """Words of the filter that lie next to each other, as bytes."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bits = np.zeros(width, np.int64)
        bits[rows["slot"].to_numpy() % width] = rows["bits"].to_numpy()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return run


def bit_filter(frequent: DataFrame) -> np.ndarray:
    """Bits of the phrases (lang, words), all of one length; MOST_BITS at most. Tasks put its parts together, and
    the driver takes them in partition by partition: it holds the filter, and never a row for each word of it."""
    size = 1 << 16
    wanted = min(frequent.count() * BITS_EACH, MOST_BITS)
    while size < wanted:
        size *= 2
    words = frequent.select("lang", "words").mapInArrow(_marked(size), "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    parts = words.groupBy(F.expr(f"slot div {PART_WORDS}").alias("part")).applyInArrow(_part(PART_WORDS), "part bigint, bits binary")
    bits = np.zeros(max(size // 64, PART_WORDS), np.uint64)
    for r in parts.toLocalIterator():
        bits[r["part"] * PART_WORDS : (r["part"] + 1) * PART_WORDS] = np.frombuffer(r["bits"], np.uint64)
    return bits[: size // 64]


def frequent_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, words, n) of all phrases of up to ``max_words`` words that occur ``least``
    times; the phrase of no words has the number of words of the language."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    phrase, lang = F.substring_index("gram", "\t", 1), F.expr("substr(gram, instr(gram, '\t') + 1)")
    levels, bits = [], None
    for size in range(1, max_words + 1):
        counts = texts.mapInArrow(_counter(size, bits), "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        wanted = counts.filter((F.col("n") >= least) | F.col("gram").startswith("\t"))
        words = F.when(phrase == "", F.array().cast("array<string>")).otherwise(F.split(phrase, " "))
        levels.append(cut_lineage(wanted.select(lang.alias("lang"), words.alias("words"), "n")))
        if bits is not None:
            bits.destroy()  # the driver's copy too
        bits = sc.broadcast(bit_filter(levels[-1].filter(F.size("words") == size))) if size < max_words else None
    out = levels[0]
    for level in levels[1:]:
        out = out.unionAll(level)
    return out


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk over a sorted stream: every phrase with the counts of its beginnings, shortest
    first, and the largest count of a phrase one word longer that begins with it.

    Beginnings of the first phrase that lie before the range have no count here. They
    come out as rows without a count, with the longer phrases seen.
    """
    kinds = {"lang": pa.string(), "words": pa.list_(pa.string()), "n": pa.int64(), "known": pa.list_(pa.int64()), "longer": pa.int64()}
    done: list[tuple] = []
    path: list[list] = []  # [lang, words, n, longer], each beginning with the one before
    first = True

    def leave() -> None:
        lang, words, n, longer = path.pop()
        done.append((lang, words, n, [p[2] for p in path], longer))
        if path and n is not None:
            path[-1][3] = max(path[-1][3], n)

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[j] for r in done], t) for j, t in enumerate(kinds.values())], list(kinds))
        done.clear()
        return out

    for part in batches:
        for lang, words, n in zip(*[part.column(j).to_pylist() for j in range(3)]):
            while path and (path[-1][0] != lang or path[-1][1] != words[: len(path[-1][1])]):
                leave()
            if first:
                path.extend([lang, words[:k], None, 0] for k in range(1, len(words)))
                first = False
            path.append([lang, words, n, 0])
        if done:
            yield batch()
    while path:
        leave()
    if done:
        yield batch()


def walked(stream: DataFrame) -> DataFrame:
    """The stream (lang, words, n) in the order of its words, walked range by range."""
    ordered = stream.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
    seen = cut_lineage(ordered.mapInArrow(_walk, "lang string, words array<string>, n bigint, known array<bigint>, longer bigint"))
    # One row for each range and length at most.
    open_ = seen.filter("n IS NULL").groupBy("lang", "words").agg(F.max("longer").alias("more"))
    counts = cut_lineage(stream.join(F.broadcast(open_), ["lang", "words"]).select("lang", "words", F.col("n").alias("before"), "more"))
    rows = seen.filter("n IS NOT NULL").join(F.broadcast(counts.drop("before")), ["lang", "words"], "left")
    rows = rows.select("lang", "words", "n", "known", F.greatest("longer", "more").alias("longer"))
    by_lang = F.broadcast(counts.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("words", "before"))).alias("counts")))
    fill = F.transform("known", lambda c, i: F.coalesce(c, F.col("counts")[F.slice("words", F.lit(1), i + 1)]))
    return rows.join(by_lang, "lang", "left").select("lang", "words", "n", fill.alias("known"), "longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    counts = frequent_counts(docs, text_col, lang_col, least, max_words)
    totals = counts.filter(F.size("words") == 0).select("lang", F.col("n").alias("total"))
    stream = counts.filter(F.size("words") > 0)
    left = walked(stream).withColumnsRenamed({"known": "lefts", "longer": "after"})
    right = walked(stream.withColumn("words", F.reverse("words"))).select("lang", F.reverse("words").alias("words"), F.col("known").alias("rights"), F.col("longer").alias("before"))
    met = left.hint("merge").join(right, ["lang", "words"]).filter(F.size("words") > 1)
    kept = met.filter(F.greatest("after", "before") * 100 < F.col("n") * INSIDE_PERCENT)
    whole = lambda c: c.cast("decimal(19,0)")

    def cut(k):
        l, r = F.get("lefts", k - 1), F.get("rights", F.size("words") - k - 1)
        return F.struct(F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (whole(F.col("n")) * whole(F.col("n"))), whole(l) * whole(r)).alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    worst = F.array_min(F.transform(F.sequence(F.lit(1), F.size("words") - 1), cut))
    scored = kept.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), worst.alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = top_k(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


_SQL = r"""
WITH p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, g, len(g) AS m, count(*) AS n
  FROM (SELECT lang, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) AS g FROM p, (SELECT unnest([1, 2, 3]) AS k)) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.g, c.n AS a, k, x.n AS l, y.n AS r, (1000000::HUGEINT * c.n * c.n // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
worst AS (SELECT lang, g, a, arg_min({'l': l, 'r': r, 'score': score}, (score, k)) AS s FROM cuts GROUP BY ALL),
longer AS (
  SELECT lang, g, max(n) AS n FROM (SELECT lang, g[1:m - 1] AS g, n FROM f WHERE m > 2 UNION ALL SELECT lang, g[2:] AS g, n FROM f WHERE m > 2) GROUP BY ALL),
ranked AS (
  SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, s.l AS l, s.r AS r, s.score AS score,
         row_number() OVER (PARTITION BY w.lang ORDER BY s.score DESC, a DESC, array_to_string(w.g, ' ')) AS rank
  FROM worst w LEFT JOIN longer USING (lang, g) WHERE longer.n IS NULL OR 100 * longer.n < 50 * a)
SELECT lang, rank, phrase, a, l, r, t.n AS n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""


@query("op12_phrases", _SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
