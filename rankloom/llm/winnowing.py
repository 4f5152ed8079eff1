"""Benchmark decontamination by winnowing.

Every text becomes a list of word hashes. Of each ``SPAN - GRAM + 1`` neighbouring
grams of ``GRAM`` words the least hash is kept (the rightmost one on ties), so two
texts that share ``SPAN`` words in a row keep at least one common gram inside the
shared words. Kept grams of documents meet those of the benchmark in a join; each
meeting carries the words on either side, which are compared word by word, so
only true shared runs of ``SPAN`` words count. Items shorter than ``SPAN`` words
are one gram of their own length, and documents offer every gram of the lengths
that occur.

Before the join documents drop grams whose bit is not set in a fixed-size bitmap
of the benchmark's grams. The bitmap only saves work: with a benchmark that fills
it the join sees all grams and gives the same rows.

Null text has no words. A null ``item_id`` marks words as hit and names no item.
Repeated documents are judged row by row, repeated items count once. Further
columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.llm.common import ROW, gram_hashes, hash_words, list_column, mix, numbered, query, table, text_bytes, without_ids
from rankloom.session import cut_lineage

GRAM = 5
SPAN = 10
BITMAP_BITS = 22
#: Copies of the benchmark's side, so that one passage in many documents meets in several tasks.
SALTS = 16

#: ASCII bytes that are no letters or digits separate words, A-Z are lowered.
_TO_WORDS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.translate(_TO_WORDS).split()


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Start of the kept gram for every full window of neighbouring grams."""
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window):
        nxt = grams[j : j + n]
        better = nxt <= least
        least[better] = nxt[better]
        at[better] = j
    return at + np.arange(n)


def slots(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _around(words: np.ndarray, first: np.ndarray, width: int, outside: int) -> np.ndarray:
    """``width`` words from each start; places outside the text hold ``outside``."""
    at = first[:, None] + np.arange(width)
    inside = (at >= 0) & (at < len(words))
    if not len(words):
        return np.full(at.shape, outside, np.uint64)
    return np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(outside))


def marks_of(words: np.ndarray, short: list[int], whole_short: bool, outside: int, bitmap: np.ndarray | None):
    """(length, hash, position, neighbouring words) of all grams a text offers.

    Length 0 stands for a winnowed gram. ``whole_short`` is for items: one of fewer
    than SPAN words offers itself only.
    """
    width = 2 * SPAN - GRAM
    found = []

    def offer(length: int, hashes: np.ndarray, pos: np.ndarray):
        if bitmap is not None and len(hashes):
            hit = bitmap[slots(hashes)]
            hashes, pos = hashes[hit], pos[hit]
        if len(hashes):
            around = _around(words, pos - (0 if length else SPAN - GRAM), width, outside)
            if length:
                around[:, length:] = outside
            found.append((np.full(len(pos), length, np.int32), hashes, pos.astype(np.int32), around))

    if len(words) >= SPAN:
        grams = gram_hashes(words, GRAM)
        pos = np.unique(winnow(grams, SPAN - GRAM + 1))
        offer(0, grams[pos], pos)
    for length in [len(words)] if whole_short and 0 < len(words) < SPAN else short:
        hashes = gram_hashes(words, length, seed=length)
        offer(length, hashes, np.arange(len(hashes)))
    if not found:
        return None
    return tuple(np.concatenate(part) for part in zip(*found))


_MARK = "array<struct<length:int,hash:bigint,pos:int,around:binary>>"


def _marks_map(short: list[int], items: bool, bitmap_bytes: bytes | None):
    outside = 1 if items else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None
        if bitmap_bytes is not None:
            bitmap = np.unpackbits(np.frombuffer(bitmap_bytes, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            counts, sizes, parts = [], [], []
            for text in text_bytes(batch.column(1)):
                words = hash_words(words_of(text))
                counts.append(len(words))
                marks = marks_of(words, [] if items else short, items, outside, bitmap)
                sizes.append(0 if marks is None else len(marks[0]))
                if marks is not None:
                    parts.append(marks)
            if parts:
                length, hashes, pos, around = (np.concatenate(p) for p in zip(*parts))
            else:
                length, hashes, pos, around = np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros((0, 2 * SPAN - GRAM), np.uint64)
            raw = np.ascontiguousarray(around).tobytes()
            step = 8 * (2 * SPAN - GRAM)
            flat = pa.StructArray.from_arrays(
                [pa.array(length), pa.array(hashes.view(np.int64)), pa.array(pos), pa.array([raw[i * step : (i + 1) * step] for i in range(len(pos))], pa.binary())],
                ["length", "hash", "pos", "around"],
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), list_column(flat, np.array(sizes, np.int64))], ["key", "n_words", "marks"])

    return run


def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the words around each meeting; keep runs that are long enough."""
    width, edge = 2 * SPAN - GRAM, SPAN - GRAM
    for b in batches:
        if not b.num_rows:
            continue
        col = {n: b.column(n) for n in b.schema.names}
        mine = np.frombuffer(b"".join(col["around"].to_pylist()), np.uint64).reshape(-1, width)
        other = np.frombuffer(b"".join(col["item_around"].to_pylist()), np.uint64).reshape(-1, width)
        same = mine == other
        length, pos = col["length"].to_numpy(), col["pos"].to_numpy().astype(np.int64)
        left = np.cumprod(same[:, edge - 1 :: -1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, edge + GRAM :], axis=1).sum(axis=1)
        run = left + GRAM + right
        plain = same[:, edge : edge + GRAM].all(axis=1) & (run >= SPAN)
        inner = (same | (np.arange(width) >= length[:, None])).all(axis=1)
        ok = np.where(length == 0, plain, inner)
        start = np.where(length == 0, pos - left, pos)
        end = np.where(length == 0, pos + GRAM + right, pos + length)
        keep = np.flatnonzero(ok)
        if len(keep):
            yield pa.RecordBatch.from_arrays([col[ROW].take(pa.array(keep)), col["item_id"].take(pa.array(keep)), pa.array(start[keep]), pa.array(end[keep])], [ROW, "item_id", "start", "end"])


def shared_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows of documents with their word count, shared word spans by row and item)."""
    spark = docs.sparkSession
    item_type = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(F.struct(F.col(item_col).alias("item_id")).alias("key"), F.col(item_text).cast("string"))
    offered = cut_lineage(
        items.mapInArrow(_marks_map([], True, None), f"key struct<item_id:{item_type}>, n_words bigint, marks {_MARK}")
        .select("key.item_id", F.explode("marks").alias("m"))
        .select("item_id", "m.*")
        .distinct()
    )
    # At most 2 ** (BITMAP_BITS - 5) rows reach the driver, whatever the benchmark's size.
    marks = offered.select("hash").mapInPandas(_slot_map, "slot bigint")
    bits = marks.groupBy((F.col("slot") / 32).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in bits:
        bitmap[r["word"]] = r["bits"]
    short = sorted(r[0] for r in offered.select("length").distinct().collect() if r[0])  # SPAN lengths at most

    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = numbered(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")))
    keyed = keyed.select(F.struct(ROW, F.col("_id").alias("id")).alias("key"), "_text")
    rows = cut_lineage(
        keyed.mapInArrow(_marks_map(short, False, bitmap.tobytes()), f"key struct<{ROW}:bigint,id:{id_type}>, n_words bigint, marks {_MARK}")
        .select(f"key.{ROW}", F.col("key.id").alias(id_col), "n_words", "marks")
    )
    offers = offered.withColumnsRenamed({"around": "item_around", "pos": "item_pos"}).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = (
        rows.filter(F.size("marks") > 0)
        .select(ROW, F.explode("marks").alias("m"))
        .select(ROW, "m.*", F.pmod(F.xxhash64(ROW, "m.pos"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(offers, ["length", "hash", "salt"])
        .select(ROW, "length", "pos", "around", "item_around", "item_id")
    )
    spans = met.mapInArrow(_shared_runs, f"{ROW} bigint, item_id {item_type}, start bigint, end bigint").distinct()
    return rows.select(ROW, id_col, "n_words"), spans


def _slot_map(frames):
    for f in frames:
        yield f.assign(slot=slots(f["hash"].to_numpy().view(np.uint64)))[["slot"]]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: words, words inside shared spans, items met."""
    rows, spans = shared_spans(docs, benchmark, id_col, text_col)
    spans = cut_lineage(spans)
    before = Window.partitionBy(ROW).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.select(ROW, "start", "end").distinct().withColumn("_reached", F.max("end").over(before))
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce("_reached", F.lit(0))), F.lit(0))
    hits = covered.groupBy(ROW).agg(F.sum(fresh).cast("bigint").alias("n_hit"))
    items = spans.groupBy(ROW).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    empty = F.array().cast("array<string>")
    return (
        rows.join(hits, ROW, "left")
        .join(items, ROW, "left")
        .select(id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("items", empty).alias("items"))
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that share no span with the benchmark."""
    rows, spans = shared_spans(docs, benchmark)
    dirty = rows.join(spans.select(ROW).distinct(), ROW, "left_semi").select("doc_id")
    return without_ids(docs, cut_lineage(dirty))


_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
  FROM documents),
iw AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM iw WHERE len(w) > 0)),
places AS (
  SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM dw, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
met AS (SELECT r, item_id, p, n FROM places JOIN grams USING (n, g)),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS x FROM met) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM met GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


@query("op9_winnowing", _SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc_id"),
        F.col("n_words"),
        F.col("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
