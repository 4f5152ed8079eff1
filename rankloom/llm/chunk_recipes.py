"""Exact duplicates by content-defined chunks and recipes.

A text is compared without its blanks. It is cut where its own bytes say so: a chunk ends
after two neighbouring bytes of ``EDGE``, once it has ``LEAST`` bytes, and at ``MOST``
bytes at the latest. Equal stretches of two texts so fall into equal chunks whatever
stands before them. A chunk is named by two 64-bit hashes, a text by the ordered list of
its chunks' names, its recipe, and a recipe by two 64-bit hashes again. What moves between
tasks is names: texts are read where they lie, and only chunks travel, each distinct one
once per task, to be checked.

Names are not trusted. ``verified`` looks for a name that stands for two contents; then
all names are made anew with the next seed. With names that stand for one content each,
equal recipes are equal texts. Only chunks of texts whose recipe seems to occur twice are
checked, since a text whose recipe is alone equals no other.

Of equal texts that with the most code points stays, then that with the least id (a null
id last), then one of the rows that repeat an id. Null counts as empty; texts without
anything but blanks are equal. Very long texts are lists of names and never leave their
task whole. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import FILTER_SLOTS, ROW, numbered, query, table
from rankloom.operators.spread import lookup_join
from rankloom.session import cut_lineage

LEAST = 48
MOST = 4096
#: The bytes that may end a chunk, two in a row; a quarter of all, spread by rule.
EDGE = [b for b in range(256) if b * 167 % 256 < 64]
BLANKS = r"[\x20\x09-\x0D]+"
#: Seeds that are tried before the names are given up.
SEEDS = 8
#: Largest written group table that is broadcast.
BROADCAST_BYTES = 8 << 20

_EDGE = "[" + "".join(f"\\x{{{b:02X}}}" for b in EDGE) + "]"
_CHUNK = f"(?s).{{{LEAST - 2},{MOST - 2}}}?{_EDGE}{{2}}|.{{1,{MOST}}}"

#: (content, seed) to two whole numbers.
Namer = Callable[[Column, int], tuple[Column, Column]]


def names_of(content: Column, seed: int) -> tuple[Column, Column]:
    """Two hashes of a content; the seed comes first so that it changes both throughout."""
    return F.xxhash64(F.lit(2 * seed), content), F.xxhash64(F.lit(2 * seed + 1), content)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def chunks_of(plain: Column) -> Column:
    """Chunks of a text, as strings of one character for each byte of its UTF-8 form."""
    return F.regexp_extract_all(F.decode(F.encode(plain, "UTF-8"), "ISO-8859-1"), F.lit(_CHUNK), 0)


def recipe_of(chunks: Column, namer: Namer, seed: int) -> Column:
    return F.flatten(F.transform(chunks, lambda c: F.array(*namer(c, seed))))


def recipes(docs: DataFrame, id_col: str, text_col: str, namer: Namer, seed: int) -> DataFrame:
    """Row, id, code points, digest, recipe and the recipe's name of every document."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("bigint").alias("n"), normalised(F.col(text_col)).alias("plain"))
    made = numbered(plain).select(ROW, "doc_id", "n", F.sha2("plain", 256).alias("text_sha256"), recipe_of(chunks_of(F.col("plain")), namer, seed).alias("recipe"))
    first, second = namer(F.col("recipe"), seed)
    return made.withColumn("name_a", first).withColumn("name_b", second)


def clashes(contents: DataFrame) -> DataFrame:
    """Names (name_a, name_b) of ``contents`` that stand for more than one ``content``."""
    return contents.distinct().groupBy("name_a", "name_b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def repeating(named: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows whose name may be in ``repeated``, by a broadcast of hash slots.

    The slots are bounded by their number; a text that meets one by chance is checked
    for nothing.
    """
    slot = lambda: F.pmod(F.col("name_a"), F.lit(FILTER_SLOTS))
    slots = F.broadcast(repeated.select(slot().alias("slot")).distinct())
    return named.join(slots, slot() == F.col("slot"), "left_semi")


def verified(docs: DataFrame, made: DataFrame, text_col: str, namer: Namer, seed: int) -> bool:
    """Whether every name among texts that seem to be equal stands for one content."""
    repeated = cut_lineage(made.groupBy("name_a", "name_b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name_a", "name_b"))
    lists = repeating(made.select("name_a", "name_b", F.col("recipe").alias("content")), repeated)
    if not clashes(lists).isEmpty():
        return False
    cut = docs.select(chunks_of(normalised(F.col(text_col))).alias("chunks"))
    named = cut.select("chunks", namer(recipe_of(F.col("chunks"), namer, seed), seed)[0].alias("name_a"))
    chunks = repeating(named, repeated).select(F.explode("chunks").alias("content"))
    first, second = namer(F.col("content"), seed)
    return clashes(chunks.select(first.alias("name_a"), second.alias("name_b"), "content")).isEmpty()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", namer: Namer = names_of) -> DataFrame:
    """One row per document: the id of the row that stays, the size of its group, whether
    it stays, and the digest of its text without blanks."""
    for seed in range(SEEDS):
        made = cut_lineage(recipes(docs, id_col, text_col, namer, seed))
        if verified(docs, made, text_col, namer, seed):
            break
    else:
        raise ValueError(f"no names without clashes in {SEEDS} seeds")
    names = ["name_a", "name_b"]
    rows = made.select(*names, ROW, "doc_id", "n", "text_sha256")
    stays = F.min(F.struct(-F.col("n"), F.col("doc_id").isNull(), "doc_id", ROW)).alias("stays")
    groups = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("group_size"), stays)
    groups = cut_lineage(groups.select(*names, "group_size", F.col("stays.doc_id").alias("keep_id"), F.col(f"stays.{ROW}").alias("keep_row")))
    found = lookup_join(rows, groups, names, limit_bytes=BROADCAST_BYTES)
    return found.select(F.col("doc_id").alias(id_col), "keep_id", "group_size", (F.col(ROW) == F.col("keep_row")).alias("kept"), "text_sha256")


_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[ \t-\r]+', '', 'g') AS plain FROM documents),
g AS (
  SELECT plain, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM t JOIN g USING (plain)
"""


@query("op11_chunk_recipes", _SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))
