"""Packing token lists into fixed-length sequences, shortest pack first.

Documents are tokenised once, end with a separator id and are cut into pieces of
the sequence length and a rest. Only the histogram of piece lengths, one row per
length, reaches the driver. There lengths are placed longest first, all pieces of
a length at a time, always into the packs that are shortest so far and still have
room; what is counted is how often each pattern of lengths occurs. A pattern of
which there are ``c`` packs takes ``c`` consecutive ranks of each of its lengths, so
a piece finds its sequence by the rank among pieces of its length. Ranks are sums
over small cells, so a length that a third of all pieces share is no hot group.

Null text is the separator alone. Repeated documents are packed as often as they
occur. An empty table gives no rows. Further columns are kept out of the result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.llm.common import ROW, list_column, numbered, query, table
from rankloom.session import cut_lineage

SEQUENCE = 2048
SEPARATOR = 1
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Pieces of one length that are ranked together, and the bytes that they may bring along.
CELL_ROWS = 20_000
CELL_BYTES = 16 << 20


class TextIds:
    """Ids of whole texts from a byte-level vocabulary.

    Texts of Latin letters and common punctuation go through the rank file of the
    same vocabulary, which gives the same ids in a quarter of the time. All else,
    and text that spells a special token, goes to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast and not any(s in text for s in self.specials) and (text.isascii() or _is_latin(text)):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _is_latin(text: str) -> bool:
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
    return bool(((units < 0x250) | ((units >= 0x2010) & (units <= 0x2027))).all())


_LOADED: dict[str, TextIds] = {}


def tokenised(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    ranks: str | None = None,
    separator: int = SEPARATOR,
    length: int = SEQUENCE,
) -> DataFrame:
    """Pieces: row number, id, tokens of the document, start, length and the ids as
    little-endian unsigned 32-bit numbers. ``vocabulary`` is a tokenizer's file,
    ``ranks`` the rank file of the same vocabulary, if there is one."""
    path, ranks = vocabulary or public_tokenizers.path(VOCABULARY), ranks if vocabulary else public_tokenizers.path(RANKS)
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = TextIds(path, ranks)
        encode = _LOADED[path]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raws = [encode(t or "") + end for t in part.column(1).to_pylist()]
                totals, starts, lengths, pieces, counts = [], [], [], [], []
                for raw in raws:
                    n = len(raw) // 4
                    cuts = range(0, n, length)
                    totals.append(n)
                    counts.append(len(cuts))
                    starts += cuts
                    pieces += [raw[4 * c : 4 * (c + length)] for c in cuts]
                lengths = [len(p) // 4 for p in pieces]
                flat = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(pieces, pa.binary())], ["start", "length", "ids"])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(totals, pa.int64()), list_column(flat, np.array(counts, np.int64))], ["key", "doc_tokens", "pieces"])

    keyed = numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))).select(F.struct(ROW, "id").alias("key"), "text")
    out = keyed.mapInArrow(run, f"key struct<{ROW}:bigint,id:{id_type}>, doc_tokens bigint, pieces array<struct<start:bigint,length:bigint,ids:binary>>")
    return out.select(f"key.{ROW}", F.col("key.id").alias(id_col), "doc_tokens", F.inline("pieces"))


def patterns(histogram: dict[int, int], length: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of piece lengths and how many packs follow each.

    Packs are grouped by room left; the roomiest group is the shortest packs. A
    length either uses up a group or is used up itself, so there are about as many
    patterns as lengths.
    """
    room: dict[int, list[list]] = {}  # room left -> [pattern, packs]
    spaces: list[int] = []  # sorted rooms in use

    def put(pattern: tuple[int, ...], packs: int, left: int):
        if left not in room:
            room[left] = []
            spaces.insert(int(np.searchsorted(spaces, left)), left)
        room[left].append([pattern, packs])

    for size in sorted(histogram, reverse=True):
        todo = histogram[size]
        while todo:
            if not spaces or spaces[-1] < size:
                full = length // size  # a new pack takes further pieces of the length at once
                packs, over = divmod(todo, full)
                if packs:
                    put((size,) * full, packs, length - full * size)
                if over:
                    put((size,) * over, 1, length - over * size)
                break
            left = spaces[-1]
            group = room[left][-1]
            packs = min(todo, group[1])
            group[1] -= packs
            todo -= packs
            pattern = group[0]
            if not group[1]:
                room[left].pop()
                if not room[left]:
                    del room[left]
                    spaces.pop()
            put((*pattern, size), packs, left - size)
    return [(p, n) for left in sorted(room) for p, n in room[left]]


def slots(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset)."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, packs in found:
        offset = 0
        for size in pattern:
            rank = used.get(size, 0)
            out.append((size, rank, rank + packs - 1, sequence, offset))
            used[size] = rank + packs
            offset += size
        sequence += packs
    return out


def cells(histogram: dict[int, int], wide: bool) -> list[tuple[int, int]]:
    """How many cells the pieces of each length are ranked in. A cell is sorted and held by one task, with the ids of ``wide`` pieces."""
    return [(size, -(-n // (max(1, min(CELL_ROWS, CELL_BYTES // (4 * size))) if wide else CELL_ROWS))) for size, n in histogram.items()]


def placed(pieces: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """``pieces`` (a written table with ROW, start and length) with ``sequence_id`` and ``offset``.

    Offsets in a sequence have no gaps. ``pieces`` may carry any further columns.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # ``length`` rows at most
    plan = slots(patterns(histogram, length))
    dealt = spark.createDataFrame(cells(histogram, "ids" in pieces.columns), "length bigint, _cells bigint")
    marked = pieces.join(F.broadcast(dealt), "length").withColumn("_cell", F.pmod(F.xxhash64(ROW, "start"), "_cells").cast("int")).drop("_cells")
    own = Window.partitionBy("length", "_cell").orderBy(ROW, "start")
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = marked.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n")).select("length", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = marked.withColumn("_own", F.row_number().over(own)).join(firsts, ["length", "_cell"]).withColumn("_rank", F.col("_first") + F.col("_own") - 1)
    # About two rows per length, whatever the number of documents.
    table_of_slots = spark.createDataFrame(plan, "length bigint, _from bigint, _to bigint, _seq bigint, offset bigint")
    inside: Column = F.col("_rank").between(F.col("_from"), F.col("_to"))
    joined = ranked.join(F.broadcast(table_of_slots.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length")) & inside)
    return joined.select(*pieces.columns, (F.col("_seq") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")


def packed(docs: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """Pieces with their ids and places."""
    return placed(cut_lineage(tokenised(docs, length=length)), length)


def digests(docs: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """Places of all pieces with a checksum of the ids instead of the ids."""
    pieces = tokenised(docs, length=length).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return placed(cut_lineage(pieces), length).drop(ROW)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
