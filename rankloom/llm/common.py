"""What several operators share: registration, row keys, word hashing, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Column that numbers the input rows while an operator works; repeated ids stay apart.
ROW = "_row_id"
#: Distinct words a Python worker remembers between tasks.
MEMO_WORDS = 50_000


def query(name: str, sql: str | None = None):
    """Register a query with its SQL twin, if SQL can say it."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc32_of(id_col: Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")))


class Memo(dict):
    """Remembers ``fn(key)`` for a bounded number of keys."""

    def __init__(self, fn, limit: int = MEMO_WORDS):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        value = self.fn(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


_HASHES = Memo(xxhash.xxh3_64_intdigest)


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` words; entry i covers words i … i+k-1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, seed * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for j in range(k):
        h = mix(h + words[j : j + n])
    return h


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of every value; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for v in column.cast(pa.binary()) if not pa.types.is_large_string(column.type) else column.cast(pa.large_binary()):
        yield v.as_py() or b""


def in_parts(column: pa.Array, rows: int, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Places (from, to) that cut a column of texts into parts of ``rows`` texts and about
    ``size`` bytes at most; a longer text is a part of its own."""
    ends = np.cumsum(np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.float64)))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))))
        yield at, to
        at = to


def list_column(values: np.ndarray | pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """List array from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))


def numbered(df: DataFrame) -> DataFrame:
    """The rows with a number each; take it into a written table before it is used."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


#: Slots of the broadcast prefilter of :func:`rows_with` and :func:`without_ids`: the most
#: rows it can have, whatever the number of ids.
FILTER_SLOTS = 1 << 18


def _slots_of(ids: DataFrame) -> DataFrame:
    slot = F.pmod(F.xxhash64("_wanted"), F.lit(FILTER_SLOTS)).alias("_slot")
    return F.broadcast(ids.select(slot).distinct())


def _wanted(docs: DataFrame, ids: DataFrame, id_col: str):
    """Rows are packed, so that no column of theirs meets one of the join."""
    wanted = ids.select(F.col(id_col).alias("_wanted")).distinct()
    marked = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.pmod(F.xxhash64(id_col), F.lit(FILTER_SLOTS)).alias("_slot"))
    return wanted, marked, _slots_of(wanted), F.col("_id").eqNullSafe(F.col("_wanted"))


def rows_with(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``; null counts as a value.

    A broadcast of occupied hash slots, bounded by their number, keeps most other
    rows out of the shuffle while the ids are few. ``ids`` should be a written table.
    """
    wanted, marked, slots, same = _wanted(docs, ids, id_col)
    return marked.join(slots, "_slot", "left_semi").join(wanted, same, "left_semi").select("_row.*")


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids``; null counts as a value."""
    wanted, marked, slots, same = _wanted(docs, ids, id_col)
    clear = marked.join(slots, "_slot", "left_anti").select("_row.*")
    doubtful = marked.join(slots, "_slot", "left_semi").join(wanted, same, "left_anti").select("_row.*")
    return clear.unionAll(doubtful)
