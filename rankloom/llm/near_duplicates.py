"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Texts are compared as sets of five-word shingles; a text of fewer words is one
shingle. Every shingle is a source of Poisson arrivals whose rate is its weight,
1 + ln(times in the text); each arrival falls on one of 128 places, and a place
keeps the shingle that came first. A shingle stops sending once its next arrival is
later than what all places of its text already hold. Two texts agree in a place with
the probability Jaccard of their weighted shingles. Places are read in bands of
four; texts that agree in a band share a bucket. Shared buckets only nominate pairs:
a link is an exact Jaccard of 0.8 or more between the shingle sets.

Equal texts (same words in the same order) are one class from the start and go
through the search once. In a bucket all texts are compared with its most central
one, that whose buckets hold the most texts in all: copies made from one text agree
with it more than with each other. Links are closed to components. Where a bucket
still holds several components, its texts are compared across components by their
rarest shingles: two sets of a Jaccard of 0.8 share one of the rarest fifth of either,
whichever order of rarity is taken, so no link between texts of one bucket is left
out, while texts that share only a common passage do not meet. A group of near copies
so costs one comparison per text and bucket, not one per pair.

Rows are told apart by id and text; a class carries its least id. Null counts as an
empty text, and texts without words are equal. Rows that share an id are kept in a
class as often as they occur. Further columns are not read. An empty table gives no
rows. Texts are known by a 64-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import gram_hashes, hash_words, list_column, mix, query, rows_with, table, text_bytes, without_ids
from rankloom.llm.winnowing import words_of
from rankloom.session import cut_lineage

SHINGLE = 5
BANDS = 32
BAND_PLACES = 4
PLACES = BANDS * BAND_PLACES
#: Least similarity as a fraction of whole numbers.
SIMILAR = (4, 5)
#: Shingles that are hashed at once.
BATCH_SHINGLES = 200_000


def shingles(text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """(hash of the word list, distinct shingles, times each occurs)."""
    words = hash_words(words_of(text))
    key = xxhash.xxh3_64_intdigest(words.tobytes())
    grams = gram_hashes(words, min(SHINGLE, len(words))) if len(words) else words
    found, times = np.unique(grams, return_counts=True)
    return key, found, times


def prob_minhash(owner: np.ndarray, items: np.ndarray, weights: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """First item to arrive at every place, for ``n`` weighted sets at once.

    ``owner`` names the set of each item. Arrivals of an item are drawn from its hash
    and their number, so equal items send alike in every set, and one that weighs
    more sends earlier in the same proportion.
    """
    first = np.full(n * places, np.inf)
    winner = np.zeros(n * places, np.uint64)
    latest = np.full(n, np.inf)
    time = np.zeros(len(items))
    number = 0
    while len(items):
        number += 1
        drawn = mix(items + np.uint64(number * 0x9E3779B97F4A7C15 % (1 << 64)))
        place = owner * places + (drawn & np.uint64(0xFFFF)).astype(np.int64) % places
        share = ((drawn >> np.uint64(16)).astype(np.float64) + 0.5) / float(1 << 48)
        time = time - np.log(share) / weights
        np.minimum.at(first, place, time)
        won = first[place] == time
        winner[place[won]] = items[won]
        latest = first.reshape(n, places).max(axis=1)
        going = time < latest[owner]
        owner, items, weights, time = owner[going], items[going], weights[going], time[going]
    return winner.reshape(n, places)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    n = len(signatures)
    split = signatures.reshape(n, BANDS, BAND_PLACES)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
    for j in range(BAND_PLACES):
        keys = mix(keys + split[:, :, j])
    return keys


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, sets in _in_turn(batch):
            sizes = np.array([len(s[1]) for s in sets])
            if sizes.sum():
                items = np.concatenate([s[1] for s in sets])
                weights = 1 + np.log(np.concatenate([s[2] for s in sets]))
                keys = band_keys(prob_minhash(np.repeat(np.arange(len(sets)), sizes), items, weights, len(sets)))
            else:
                keys = np.zeros((len(sets), BANDS), np.uint64)
            some = sizes > 0  # a text without words is in no bucket
            bands = list_column(keys[some].ravel().view(np.int64), np.where(some, BANDS, 0))
            yield pa.RecordBatch.from_arrays([part.column(0), _keys(sets), pa.array(sizes, pa.int64()), bands], ["doc_id", "text_key", "n", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets in _in_turn(batch):
            flat = np.concatenate([s[1] for s in sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([_keys(sets), list_column(flat, np.array([len(s[1]) for s in sets]))], ["text_key", "members"])


def _keys(sets: list) -> pa.Array:
    return pa.array(np.array([s[0] for s in sets], np.uint64).view(np.int64))


def _in_turn(batch: pa.RecordBatch):
    """Parts of a batch with about BATCH_SHINGLES shingles each."""
    sets, at, held = [], 0, 0
    for i, text in enumerate(text_bytes(batch.column(1))):
        sets.append(shingles(text))
        held += len(sets[-1][1])
        if held >= BATCH_SHINGLES:
            yield batch.slice(at, len(sets)), sets
            sets, at, held = [], i + 1, 0
    if sets:
        yield batch.slice(at, len(sets)), sets


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have an exact Jaccard of SIMILAR or more."""
    least, of = SIMILAR
    met = pairs.join(sets.withColumnsRenamed({"text_key": "a", "members": "x"}), "a").join(sets.withColumnsRenamed({"text_key": "b", "members": "y"}), "b")
    sized = met.select("a", "b", F.size(F.array_intersect("x", "y")).alias("both"), (F.size("x") + F.size("y")).alias("all"))
    return sized.filter(F.col("both") * of >= (F.col("all") - F.col("both")) * least).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the least node.

    Links are turned towards the least neighbour from both ends, over and over, until
    all of a component point at its root. Every step is written to the shared folder.
    """
    links = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(low, "u")
        small = down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        links = cut_lineage(small)
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _sized(pairs: DataFrame) -> DataFrame:
    """Leave out pairs whose set sizes rule a link out."""
    least, of = SIMILAR
    return pairs.filter(F.least("n", "n_b") * of >= F.greatest("n", "n_b") * least).select("a", "b").distinct()


def across_roots(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, n, b, n_b) of texts of different roots that could still be linked.

    With the shingles of a set of n in one order for all, two sets of a Jaccard of t or
    more share one of the first n - ceil(t n) + 1 of either. Rare shingles come first, and
    those found in one text alone only use up places. At the first shingle that a pair
    shares, what is left of either set bounds all that both share; a pair that is linked
    passes that bound there, and texts that merely vary around one text do not.
    """
    least, of = SIMILAR
    items = texts.join(sets, "text_key").select("text_key", "root", F.size("members").alias("n"), F.explode("members").alias("shingle"))
    common = items.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = items.join(common, "shingle").groupBy("text_key", "root", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("held")).withColumn("most", F.size("held"))
    places = F.col("n") - F.ceil(F.col("n") * least / of) + 1 - (F.col("n") - F.col("most"))
    first = held.withColumn("places", places.cast("int")).filter("places > 0")
    first = first.select("text_key", "root", "n", "most", F.posexplode(F.slice("held", F.lit(1), F.col("places"))).alias("at", "h"))
    first = cut_lineage(first.select("text_key", "root", "n", (F.col("most") - F.col("at")).alias("left"), "h.shingle"))
    counts = first.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = counts.groupBy("shingle").agg(F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("c", "root")).alias("main")).filter("roots > 1")
    open_ = cut_lineage(first.join(mixed, "shingle").drop("roots"))
    strays = open_.filter("root <> main").select("shingle", F.col("text_key").alias("s"), F.col("n").alias("n_b"), F.col("left").alias("left_b"), F.col("root").alias("s_root"))
    reach = F.least("left", "left_b") * (least + of) >= (F.col("n") + F.col("n_b")) * least
    met = open_.join(strays, "shingle").filter((F.col("root") != F.col("s_root")) & reach)
    return met.select(F.greatest("text_key", "s").alias("a"), F.least("text_key", "s").alias("b"), "n", "n_b")


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with their text_key, class of every text_key) as written tables."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()
    signed = cut_lineage(named.mapInArrow(_sign, f"doc_id {id_type}, text_key bigint, n bigint, bands array<bigint>"))
    # One row for each text; equal texts have equal bands.
    texts = signed.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    found = signed.select("text_key", "n", F.explode("bands").alias("bucket")).distinct()
    sizes = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut_lineage(found.join(sizes, "bucket"))
    central = members.groupBy("text_key").agg(F.sum("size").alias("centre"))
    pivots = members.join(central, "text_key").groupBy("bucket").agg(F.max(F.struct("centre", "text_key", "n")).alias("pivot"))
    members = cut_lineage(members.join(pivots, "bucket").select("bucket", F.col("text_key").alias("a"), "n", F.col("pivot.text_key").alias("b"), F.col("pivot.n").alias("n_b")))

    wanted = cut_lineage(texts.join(members.select(F.col("a").alias("text_key")).distinct(), "text_key", "left_semi"))
    sets = rows_with(named, wanted).mapInArrow(_sets, "text_key bigint, members array<bigint>")
    sets = cut_lineage(sets.groupBy("text_key").agg(F.first("members").alias("members")))

    tried = members.filter("a <> b")
    links = cut_lineage(verified(_sized(tried), sets))
    roots = components(links)

    placed = members.select("bucket", "a").join(roots.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    placed = cut_lineage(placed)
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket")
    unsettled = cut_lineage(placed.join(mixed, "bucket", "left_semi").select(F.col("a").alias("text_key"), "root").distinct())
    across = cut_lineage(_sized(across_roots(unsettled, sets)))
    more = verified(across.join(_sized(tried), ["a", "b"], "left_anti"), sets)
    links = cut_lineage(links.unionAll(more))
    roots = components(links)

    of_text = texts.join(roots.withColumnRenamed("node", "text_key"), "text_key", "left").withColumn("root", F.coalesce("root", "text_key"))
    of_text = cut_lineage(of_text)
    least = cut_lineage(of_text.groupBy("root").agg(F.min("doc_id").alias("class_id")))
    degrees = links.select(F.explode(F.array("a", "b")).alias("text_key")).groupBy("text_key").agg(F.count(F.lit(1)).alias("n_links"))
    classes = of_text.join(least, "root").join(degrees, "text_key", "left")
    return signed.select("doc_id", "text_key"), cut_lineage(classes.select("text_key", "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: its class and the links found from its text."""
    rows, classes = text_classes(docs, id_col, text_col)
    return rows.join(classes, "text_key").select(F.col("doc_id").alias(id_col), "class_id", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Documents with one of every class left, that with the least id.

    Rows that share an id with a row that stays are told apart by their text alone.
    """
    found = cut_lineage(near_duplicates(docs))
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("stays"))
    ids = cut_lineage(ids)
    kept = without_ids(docs, ids.filter(~F.col("stays")))
    if ids.filter("stays and n > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])


@query("op5_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
