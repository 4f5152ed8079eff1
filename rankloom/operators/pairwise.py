"""Pair sampling and Bradley–Terry strengths, all postings at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankloom.functions.portable import hash32
from rankloom.operators.spread import BROADCAST_BYTES, lookup_join, planned_bytes, rank_in_group, running_totals

FLOOR = 0.001
TINY = 1e-10

#: Items of a group are cut into blocks of this size; two blocks make a tile of pairs.
BLOCK = 1024
#: Pairs that one task makes, about.
TASK_PAIRS = 1_000_000
#: Words of bits that a task holds before it packs them, cells of a tile weighed at once, and blocks that a task sums up.
PACKED_WORDS = 1_000_000
CELLS_AT_ONCE = 1 << 17
BLOCKS_HELD = 4096
#: Where a pair lies: blocks of its lower and higher item, and their numbers in these.
PLACE = ["tile_lo", "tile_hi", "slot_lo", "slot_hi"]
#: Partners of an item come at nearly even steps, which differences tell in fewer bits than a dictionary.
BY_DIFFERENCES = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false", "compression": "zstd"}


def positions(items: DataFrame, group: str, item: str) -> DataFrame:
    """Position 0..n-1 of every item in its group, and n."""
    ranked = running_totals(items, [group], [F.col(item)], [item], {"_r": F.lit(1)}, {"n": "_r"})
    return ranked.withColumn("pos", F.col("_r") - 1).drop("_r")


def _in_blocks(placed: DataFrame, group: str, item: str) -> DataFrame:
    """Block of every placed item, and its number there. Copies of an item share both."""
    first = F.min("pos").over(Window.partitionBy(group, item))
    blocked = placed.withColumn("_block", F.floor(first / BLOCK).cast("bigint"))
    return blocked.withColumn("_slot", F.dense_rank().over(Window.partitionBy(group, "_block").orderBy(item)) - 1)


def sample_pairs(
    items: DataFrame,
    group: str,
    item: str,
    share: float = 0.35,
    carry: list[str] | None = None,
    max_pairs: int | None = None,
    places: bool = False,
) -> DataFrame:
    """Exactly ``floor(share · n(n-1)/2)`` distinct unordered pairs per group.

    The item at position ``a`` has ``n-1-a`` partners after it; its quota is the
    difference of the rounded running shares, so the quotas add up to the exact
    total. The quota is met by evenly spaced partners, turned by a hashed offset.
    ``max_pairs`` bounds the number per group, as a caller's budget for comparisons.

    Pairs are made where they are used and never shuffled: an item is sent once to every block
    of possible partners, and makes its pairs with a block there. With ``places``
    the columns of :data:`PLACE` are added; rows are spread by group and tile.
    """
    from rankloom.session import cut_lineage

    carry = carry or []
    placed = cut_lineage(_in_blocks(positions(items.select(group, item, *carry), group, item), group, item)).withColumnsRenamed(
        {item: "left_id", **{c: f"left_{c}" for c in carry}}
    )
    pos, n = F.col("pos"), F.col("n")

    def running(before: Column) -> Column:
        exact = F.floor(F.lit(share) * before).cast("bigint")
        if max_pairs is None:
            return exact
        scaled = F.floor(before * (F.lit(float(max_pairs)) / F.col("_all"))).cast("bigint")
        capped = F.when(before >= F.col("_all"), F.lit(max_pairs)).otherwise(F.least(scaled, F.lit(max_pairs)))
        return F.when(F.col("_all") * share <= max_pairs, exact).otherwise(capped)

    quotas = (
        placed.withColumn("_all", F.expr("n * (n - 1) div 2"))
        .withColumn("_before", F.expr("pos * (2 * n - pos - 1) div 2"))
        .withColumn("_after", F.expr("(pos + 1) * (2 * n - pos - 2) div 2"))
        .withColumn("_quota", running(F.col("_after")) - running(F.col("_before")))
        .withColumn("_partners", n - 1 - pos)
        .withColumn("_turn", hash32("pair", group, "pos") % F.greatest(F.col("_partners"), F.lit(1)))
        .filter("_quota > 0")
    )
    sizes = placed.filter("pos = 0").select(F.sum(F.expr("n * (n - 1) div 2") * F.lit(float(share)))).first()[0] or 0
    # A multiple of the buckets that placed pairs are written in, so that a task writes one of them.
    buckets = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = buckets * max(1, -(-int(sizes) // (TASK_PAIRS * buckets)))
    tile = [group, "tile_lo", "tile_hi"]
    partner = placed.groupBy(group, F.col("_block").alias("tile_hi")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "left_id", "_slot", *[f"left_{c}" for c in carry]))).alias("_at"), F.min("pos").alias("_from")
    )
    partner = partner.withColumn("tile_lo", F.explode(F.expr("sequence(0L, tile_hi)")))
    visits = quotas.withColumn("tile_hi", F.explode(F.expr(f"sequence(_block, (n - 1) div {BLOCK})"))).withColumnsRenamed({"_block": "tile_lo", "_slot": "slot_lo"})
    # A join that turned into a broadcast would lose the spread by tile, and the pairs would be shuffled for it.
    met = visits.repartition(tasks, *tile).join(partner.hint("shuffle_hash"), tile)
    # Partners of the block begin at _x and end before _y, counted from the item and turned back
    # by the offset. Below zero they stand at the end of the circle.
    met = met.withColumn("_x", F.greatest(F.col("_from") - pos - 1, F.lit(0)) - F.col("_turn")).withColumn("_y", F.col("_from") + F.size("_at") - pos - 1 - F.col("_turn"))

    def draws(lo: str, hi: str) -> str:
        first, end = [f"(({s}) * _quota + _partners - 1) div _partners" for s in (lo, hi)]
        return f"CASE WHEN {first} < {end} THEN sequence({first}, {end} - 1L) ELSE cast(array() AS array<bigint>) END"

    both = f"CASE WHEN _x < _y THEN concat({draws('greatest(_x, 0L)', 'greatest(_y, 0L)')}, {draws('least(_x, 0L) + _partners', 'least(_y, 0L) + _partners')}) END"
    drawn = met.withColumn("_i", F.explode_outer(F.expr(both))).filter("_i IS NOT NULL")
    right = F.get("_at", F.expr("pos + 1 + (_i * _partners div _quota + _turn) % _partners - _from").cast("int"))
    return drawn.select(
        group, "left_id", *[f"left_{c}" for c in carry], right["left_id"].alias("right_id"), *[right[f"left_{c}"].alias(f"right_{c}") for c in carry],
        *(["tile_lo", "tile_hi", "slot_lo", right["_slot"].alias("slot_hi")] if places else []),
    )


def drop_failed(pairs: DataFrame, failed: DataFrame, item: str) -> DataFrame:
    """Leave out pairs with a side that failed parsing."""
    left = failed.select(F.col(item).alias("left_id"))
    right = failed.select(F.col(item).alias("right_id"))
    return pairs.join(left, "left_id", "left_anti").join(right, "right_id", "left_anti")


def checked_answer(answer: Column) -> tuple[Column, Column]:
    """Answer with the default for anything unexpected, and a flag for the default."""
    ok = F.coalesce(F.trim(answer).isin("Resume 1", "Resume 2"), F.lit(False))
    return F.when(ok, F.trim(answer)).otherwise("Resume 1"), ~ok


def comparisons(verdicts: DataFrame, answer: str = "answer") -> DataFrame:
    """Winner and loser; the second answer turns the pair round."""
    first = F.col(answer) == "Resume 1"
    return verdicts.withColumn("winner", F.when(first, F.col("left_id")).otherwise(F.col("right_id"))).withColumn(
        "loser", F.when(first, F.col("right_id")).otherwise(F.col("left_id"))
    )


class Fit(NamedTuple):
    """Strengths (group, item, wins, strength), the steps made, the largest relative move of the
    last step per group (group, n_items, largest_move), and whether the tolerance was met."""

    strengths: DataFrame
    steps: int
    moves: DataFrame
    converged: bool


def counted_pairs(compared: DataFrame, group: str) -> DataFrame:
    """One row per compared pair: group, lo, hi, n, n_lo (won by lo)."""
    lo, hi = F.least("winner", "loser").alias("lo"), F.greatest("winner", "loser").alias("hi")
    return compared.groupBy(group, lo, hi).agg(F.count("*").alias("n"), F.count_if(F.col("winner") < F.col("loser")).alias("n_lo"))


def _step(pairs: DataFrame, strengths: DataFrame, group: str) -> DataFrame:
    at_lo = strengths.select(group, F.col("item").alias("lo"), F.col("strength").alias("w_lo"))
    at_hi = strengths.select(group, F.col("item").alias("hi"), F.col("strength").alias("w_hi"))
    share = F.col("n") / (F.col("w_lo") + F.col("w_hi"))
    load = (
        pairs.join(at_lo, [group, "lo"])
        .join(at_hi, [group, "hi"])
        .select(group, F.explode(F.array("lo", "hi")).alias("item"), share.alias("share"))
        .groupBy(group, "item")
        .agg(F.sum("share").alias("load"))
    )
    return strengths.select(group, "item", "wins", F.col("strength").alias("_old")).join(load, [group, "item"]).select(
        group, "item", "wins", F.greatest(F.col("wins") / F.col("load"), F.lit(FLOOR)).alias("strength"), "_old"
    )


class Laid(NamedTuple):
    """Comparisons (n is 1) spread by their tiles, the tiles that may hold some, all places of items
    (group, tile, slot, item, wins), and the comparisons packed by tile; a place whose item was never compared has null wins."""

    pairs: DataFrame
    tiles: DataFrame
    items: DataFrame
    packed: DataFrame


_PACKED = "tile_lo bigint, tile_hi bigint, weight bigint, lo array<int>, lo_won binary, hi_won binary"


def _packer(group: pa.DataType) -> Callable:
    """Tiles from words of bits (group, tile_lo, tile_hi, slot_lo, word, lo_won, hi_won, weight): the slots that stand for
    rows, and the bits of the cells that the lower and that the higher item won ``weight`` times."""
    kinds = [group, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = ["group", "tile_lo", "tile_hi", "weight", "lo", "lo_won", "hi_won"]

    def packed(held: pa.Table) -> Iterator[pa.RecordBatch]:
        code = held.column(0).combine_chunks().dictionary_encode()
        g, (lo, hi, slot, word, a, b, weight) = code.indices.to_numpy(), (c.to_numpy() for c in held.columns[1:])
        order = np.lexsort((slot, weight, hi, lo, g))
        g, lo, hi, slot, word, a, b, weight = (x[order] for x in (g, lo, hi, slot, word, a, b, weight))
        cuts = np.flatnonzero((g[1:] != g[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (weight[1:] != weight[:-1])) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(g)]):
            rows, at = np.unique(slot[begin:end], return_inverse=True)
            bits = np.zeros((2, len(rows), word[begin:end].max() + 1), "<i8")
            bits[0, at, word[begin:end]], bits[1, at, word[begin:end]] = a[begin:end], b[begin:end]
            row = [code.dictionary[g[begin]].as_py(), lo[begin], hi[begin], weight[begin], rows.astype(np.int32), bits[0].tobytes(), bits[1].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED_WORDS:
                yield from packed(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield from packed(pa.Table.from_batches(held))

    return run


def _words(pairs: DataFrame, group: str, *more: str) -> DataFrame:
    """Comparisons of a place with 64 others as bits, where they were made; the weight is 0 where some come more than once."""
    bit, none = F.expr("shiftleft(1L, slot_hi % 64)"), F.lit(0).cast("bigint")
    key = [group, "tile_lo", "tile_hi", "slot_lo", F.expr("slot_hi div 64").alias("word")]
    sides = [F.bit_or(F.when(side, bit).otherwise(none)).alias(name) for side, name in ((F.col("n_lo") > 0, "lo_won"), (F.col("n") > F.col("n_lo"), "hi_won"))]
    words = pairs.groupBy(*key, *more).agg(*sides, F.count("*").alias("_n"))
    once = F.col("_n") == F.bit_count("lo_won") + F.bit_count("hi_won")
    return words.select(group, "tile_lo", "tile_hi", "slot_lo", "word", "lo_won", "hi_won", F.when(once, 1).otherwise(0).cast("bigint").alias("weight"), *more)


def _packed(words: DataFrame, group: str) -> DataFrame:
    kind = words.schema[group].dataType
    return words.mapInArrow(_packer(to_arrow_type(kind)), f"group {kind.simpleString()}, {_PACKED}").withColumnRenamed("group", group)


def _copies(pairs: DataFrame, packed: DataFrame, group: str) -> DataFrame:
    """Packed tiles, those in which some items meet more than once by the binary digits of how often."""
    from rankloom.session import cut_lineage

    tile = [group, "tile_lo", "tile_hi"]
    again = packed.filter("weight = 0").select(*tile).distinct()
    cells = pairs.join(again, tile, "left_semi").groupBy(*tile, "slot_lo", "slot_hi").agg(F.sum("n_lo").alias("a"), F.sum(F.col("n") - F.col("n_lo")).alias("b"))
    digits = cells.withColumn("weight", F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.greatest("a", "b"))).cast("int")), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))
    digits = digits.select(*tile, "slot_lo", "slot_hi", "weight", *[F.sign(F.col(c).bitwiseAND(F.col("weight"))).cast("bigint").alias(c) for c in ("a", "b")])
    rows = [digits.filter(f"{c} > 0").select(*tile, "slot_lo", "slot_hi", F.lit(won).alias("n_lo"), F.lit(1).alias("n"), F.col("weight").alias("_weight")) for c, won in (("a", 1), ("b", 0))]
    words = _words(rows[0].unionAll(rows[1]), group, "_weight").withColumn("weight", F.col("_weight")).drop("_weight")
    return packed.join(F.broadcast(again), tile, "left_anti").unionAll(cut_lineage(_packed(words, group)))


@contextmanager
def laid_pairs(compared: DataFrame, group: str, written: bool = True, many: bool = False) -> Iterator[Laid]:
    """Comparisons with the places of :func:`sample_pairs`, written where they were made. Passes
    over them shuffle items alone. A comparison without an item is left out. Frames made
    from them have to be written before the context ends.

    They are made once, packed to bits by tile, and written so: passes of :func:`fit`, :func:`components` and
    :func:`negative_log_likelihood` read the bits and weigh a tile in arrays. For ``many`` passes tiles lie in buckets.
    Unless the comparisons are to be ``written`` too, other passes make them anew from the items."""
    from rankloom.session import cut_lineage, laid_out

    tile = [group, "tile_lo", "tile_hi"]
    ends = compared.filter("winner IS NOT NULL AND loser IS NOT NULL").withColumns({"lo": F.least("winner", "loser"), "hi": F.greatest("winner", "loser")})
    # Every comparison is a row: sums over them need no counts first, which a task would hold for all its pairs.
    rows = ends.select(group, *PLACE, "lo", "hi", F.lit(1).cast("bigint").alias("n"), (F.col("winner") < F.col("loser")).cast("bigint").alias("n_lo"))
    with laid_out(rows, tile, spread=False, **BY_DIFFERENCES) if written else nullcontext(rows) as pairs:
        bits = _packed(_words(pairs, group), group)
        with laid_out(bits, tile, spread=False) if many else nullcontext(cut_lineage(bits)) as packed:
            sides = F.array(
                F.struct(F.col("tile_lo").alias("tile"), F.col("slot_lo").alias("slot"), F.col("lo").alias("item"), F.col("n_lo").alias("won")),
                F.struct(F.col("tile_hi").alias("tile"), F.col("slot_hi").alias("slot"), F.col("hi").alias("item"), (F.col("n") - F.col("n_lo")).alias("won")),
            )
            items = cut_lineage(pairs.select(group, F.inline(sides)).groupBy(group, "tile", "slot", "item").agg(F.sum("won").alias("wins")))
            tops = cut_lineage(items.groupBy(group, "tile").agg(F.max("slot").alias("_top")))
            slots = tops.select(group, "tile", F.explode(F.expr("sequence(0, _top)")).alias("slot"))
            lower, higher = [tops.select(group, F.col("tile").alias(f"tile_{end}")) for end in ("lo", "hi")]
            tiles = cut_lineage(lower.join(higher, group).filter("tile_lo <= tile_hi"))
            whole = _copies(pairs, packed, group) if packed.filter("weight = 0").limit(1).count() else packed
            yield Laid(pairs, tiles, cut_lineage(slots.join(items, [group, "tile", "slot"], "left")), whole)


def _by_slot(state: DataFrame, group: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Values of a block as an array, for the lower and the higher block of a tile: _lo and _hi."""
    by_slot = F.array_sort(F.collect_list(F.struct("slot", F.col(value).alias("v"))))
    blocks = state.groupBy(group, "tile").agg(F.transform(by_slot, lambda x: x["v"]).alias("_v"))
    lo, hi = [blocks.select(group, F.col("tile").alias(f"tile_{end}"), F.col("_v").alias(f"_{end}")) for end in ("lo", "hi")]
    return lo, hi


def _tile_map(laid: Laid, state: DataFrame, group: str, value: str, run: Callable, out: str) -> DataFrame:
    """``run`` over packed tiles with the values of their blocks. Values of a bounded size are broadcast and no tile
    moves; others meet their tiles, which move unless they lie in buckets."""
    lo, hi = _by_slot(state, group, value)
    if planned_bytes(state) <= BROADCAST_BYTES:
        met = laid.packed.join(F.broadcast(lo), [group, "tile_lo"]).join(F.broadcast(hi), [group, "tile_hi"])
    else:
        around = laid.tiles.join(lo, [group, "tile_lo"]).join(hi, [group, "tile_hi"])
        met = laid.packed.join(around.hint("shuffle_hash"), [group, "tile_lo", "tile_hi"])
    kind = laid.packed.schema[group].dataType
    met = met.select(group, "tile_lo", "tile_hi", "weight", "lo", "lo_won", "hi_won", "_lo", "_hi")
    return met.mapInArrow(run(to_arrow_type(kind)), f"group {kind.simpleString()}, {out}").withColumnRenamed("group", group)


def _weighed(batches: Iterator[pa.RecordBatch], none: float) -> Iterator[tuple]:
    """Tiles: (group, tile_lo, tile_hi), weight, slots of rows and columns, and strips of the tile as (rows, cells that the
    lower and that the higher item won, values of the rows, values of the columns). A null value is ``none``."""
    for batch in batches:
        g, tile_lo, tile_hi, weight, slots, *bits, of_lo, of_hi = batch.columns
        for i in range(batch.num_rows):
            lo = slots[i].values.to_numpy()
            words = [np.frombuffer(x[i].as_buffer(), np.uint8).reshape(len(lo), -1) for x in bits]
            hi = np.arange(words[0].shape[1] * 8)
            a, found = (x[i].values.fill_null(none).to_numpy(zero_copy_only=False) for x in (of_lo, of_hi))
            a, b = a[lo], np.full(len(hi), none, a.dtype)
            b[: len(found)] = found[: len(hi)]
            step = max(1, CELLS_AT_ONCE // len(hi))

            def strips(a=a, b=b, words=words, step=step):
                for at in range(0, len(a), step):
                    rows = slice(at, at + step)
                    yield rows, *[np.unpackbits(x[rows], axis=1, bitorder="little") for x in words], a[rows, None], b[None, :]

            yield (g[i].as_py(), tile_lo[i].as_py(), tile_hi[i].as_py()), weight[i].as_py(), lo, hi, strips()


def _summed(group: pa.DataType, tiles: Iterator[tuple], add: np.ufunc, none: float, kind: pa.DataType, name: str) -> Iterator[pa.RecordBatch]:
    """(group, tile, slots, values) of blocks from (group, tile, slots, values), added up as far as a task holds them."""
    held: dict[tuple, np.ndarray] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (g, tile), values in held.items():
            row = [([g], group), ([tile], pa.int64()), ([np.flatnonzero(values != none)], pa.list_(pa.int32())), ([values[values != none]], pa.list_(kind))]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in row], ["group", "tile", "slots", name])
        held.clear()

    for g, tile, slots, values in tiles:
        mine = held.get((g, tile), np.zeros(0, values.dtype))
        if len(mine) <= slots[-1]:
            mine = np.concatenate([mine, np.full(slots[-1] + 1 - len(mine), none, values.dtype)])
        mine[slots] = add(mine[slots], values)
        held[g, tile] = mine
        if len(held) >= BLOCKS_HELD:
            yield from told()
    yield from told()


def _loads(group: pa.DataType) -> Callable:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (g, tile_lo, tile_hi), weight, lo, hi, strips in _weighed(batches, 1.0):
            to_lo, to_hi = np.zeros(len(lo)), np.zeros(len(hi))
            for rows, x, y, a, b in strips:
                share = a + b
                np.divide(x + y, share, out=share)
                to_lo[rows] = share.sum(axis=1)
                to_hi += share.sum(axis=0)
            yield g, tile_lo, lo, to_lo * weight
            yield g, tile_hi, hi, to_hi * weight

    return lambda batches: _summed(group, each(batches), np.add, 0.0, pa.float64(), "values")


NO_LABEL = np.iinfo(np.int64).max


def _least_labels(group: pa.DataType) -> Callable:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (g, tile_lo, tile_hi), _, lo, hi, strips in _weighed(batches, NO_LABEL):
            to_lo, to_hi = np.full(len(lo), NO_LABEL), np.full(len(hi), NO_LABEL)
            for rows, x, y, a, b in strips:
                least = np.where((x | y) > 0, np.minimum(a, b), NO_LABEL)
                to_lo[rows] = least.min(axis=1)
                to_hi = np.minimum(to_hi, least.min(axis=0))
            yield g, tile_lo, lo, to_lo
            yield g, tile_hi, hi, to_hi

    return lambda batches: _summed(group, each(batches), np.minimum, NO_LABEL, pa.int64(), "values")


def _logs(group: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, _, _), weight, _, _, strips in _weighed(batches, np.nan):
            total, n = 0.0, 0
            for _, x, y, a, b in strips:
                for won, winner in ((x, a), (y, b)):
                    at = np.nonzero(won)
                    p = np.broadcast_to(winner, won.shape)[at] / (a[at[0], 0] + b[0, at[1]])
                    p = p[~np.isnan(p)]
                    total, n = total + np.log(p).sum(), n + len(p)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([g], group), pa.array([total * weight]), pa.array([n * weight], pa.int64())], ["group", "logs", "n"])

    return run


def _at_ends(laid: Laid, state: DataFrame, group: str, value: str) -> DataFrame:
    """Pairs with the values of both items, v_lo and v_hi: a tile takes those of its two blocks as arrays."""
    lo, hi = _by_slot(state, group, value)
    around = laid.tiles.join(lo, [group, "tile_lo"]).join(hi, [group, "tile_hi"])
    met = laid.pairs.join(around.hint("shuffle_hash"), [group, "tile_lo", "tile_hi"])
    return met.withColumns({f"v_{end}": F.get(f"_{end}", F.col(f"slot_{end}").cast("int")) for end in ("lo", "hi")}).drop("_lo", "_hi")


def _at_slots(sums: DataFrame, group: str, add: Callable, name: str) -> DataFrame:
    """Sums of the blocks that tasks handed on, by place."""
    rows = sums.select(group, "tile", F.inline(F.arrays_zip(F.col("slots").alias("slot"), F.col("values").alias("_v"))))
    return rows.groupBy(group, "tile", "slot").agg(add("_v").alias(name))


def _tile_step(laid: Laid, strengths: DataFrame, group: str) -> DataFrame:
    sums = _tile_map(laid, strengths, group, "strength", _loads, "tile bigint, slots array<int>, values array<double>")
    load = _at_slots(sums, group, F.sum, "load")
    moved = F.greatest(F.col("wins") / F.col("load"), F.lit(FLOOR))
    return strengths.withColumnRenamed("strength", "_old").join(load, [group, "tile", "slot"], "left").select(
        group, "tile", "slot", "item", "wins", F.when(F.col("load").isNotNull(), moved).otherwise(F.col("_old")).alias("strength"), "_old"
    )


@contextmanager
def _steps(compared: DataFrame | Laid, group: str) -> Iterator[tuple]:
    """The items to begin with, and the step that moves their strengths."""
    from rankloom.session import cut_lineage, laid_out

    if isinstance(compared, Laid):
        yield compared.items, lambda strengths: _tile_step(compared, strengths, group)
    elif set(PLACE) <= set(compared.columns):
        with laid_pairs(compared, group, written=False, many=True) as laid:
            yield laid.items, lambda strengths: _tile_step(laid, strengths, group)
    else:
        with laid_out(counted_pairs(compared, group), [group, "lo"]) as pairs:
            sides = F.array(
                F.struct(F.col("lo").alias("item"), F.col("n_lo").alias("won")),
                F.struct(F.col("hi").alias("item"), (F.col("n") - F.col("n_lo")).alias("won")),
            )
            items = cut_lineage(pairs.select(group, F.inline(sides)).groupBy(group, "item").agg(F.sum("won").alias("wins")))
            yield items, lambda strengths: _step(pairs, strengths, group)


def fit(compared: DataFrame | Laid, group: str, max_steps: int = 50, tolerance: float | None = 1e-6, check_every: int = 5) -> Fit:
    """Bradley–Terry strengths by the minorise-maximise rule, all groups in step.

    Pairs that know their places (``places`` of :func:`sample_pairs`) are packed to bits where they were made
    and never shuffled: a step sends their tiles the strengths of two blocks, and sums per item are
    made on the map side. Other pairs are laid out by their lower item once. A step then shuffles
    them once at most, to meet the strengths of the higher item, and not at all while the strengths
    are few enough to broadcast. Only the strengths, one
    row per item, are written in a step. With a tolerance the loop ends when no
    strength moves by more than it, relatively; without comparisons nothing is fitted.
    """
    from rankloom.session import cut_lineage

    with _steps(compared, group) as (items, step):
        strengths, moved = items.withColumn("strength", F.lit(1.0)), items.withColumns({"strength": F.lit(1.0), "_old": F.lit(1.0)})
        made, converged = 0, False
        for made in range(1, max_steps + 1):
            moved = cut_lineage(step(strengths))
            strengths = moved.drop("_old")
            if tolerance is not None and made % check_every == 0:
                delta = moved.agg(F.max(F.abs(F.col("strength") - F.col("_old")) / F.col("_old"))).first()[0]
                converged = delta is None or delta <= tolerance
                if converged:
                    break
    moved = moved.filter("wins IS NOT NULL")
    moves = moved.groupBy(group).agg(
        F.count("*").alias("n_items"), F.max(F.abs(F.col("strength") - F.col("_old")) / F.col("_old")).alias("largest_move")
    )
    return Fit(moved.select(group, "item", "wins", "strength"), made, moves, converged)


def fit_strengths(
    compared: DataFrame,
    group: str,
    max_steps: int = 50,
    tolerance: float | None = 1e-6,
    check_every: int = 5,
) -> DataFrame:
    """Strengths alone of :func:`fit`."""
    return fit(compared, group, max_steps, tolerance, check_every).strengths


def _tile_components(laid: Laid, group: str) -> DataFrame:
    from rankloom.session import cut_lineage

    # Places are in the order of their items: the lowest place stands for the lowest item.
    place = F.col("tile") * BLOCK + F.col("slot")
    labels = laid.items.select(group, "tile", "slot", F.when(F.col("item").isNotNull(), place).alias("component"))
    while True:
        sums = _tile_map(laid, labels, group, "component", _least_labels, "tile bigint, slots array<int>, values array<bigint>")
        low = _at_slots(sums, group, F.min, "component")
        jump = labels.filter("component IS NOT NULL").select(group, place.alias("component"), F.col("component").alias("_next"))
        old = labels.withColumnRenamed("component", "_old")
        labels = cut_lineage(
            low.join(jump, [group, "component"])
            .join(old, [group, "tile", "slot"], "right")
            .select(group, "tile", "slot", F.least("component", "_next").alias("component"), "_old")
        )
        still = not labels.filter(F.col("component") != F.col("_old")).limit(1).count()
        labels = labels.drop("_old")
        if still:
            named = laid.items.filter("item IS NOT NULL").select(group, "tile", "slot", "item")
            first = named.select(group, place.alias("component"), F.col("item").alias("_first"))
            found = named.join(labels, [group, "tile", "slot"]).join(first, [group, "component"])
            return cut_lineage(found.select(group, "item", F.col("_first").alias("component")))


def components(compared: DataFrame | Laid, group: str) -> DataFrame:
    """Lowest item that every item is linked to by comparisons: group, item, component.

    Strengths of items in different components of a group say nothing about each other. Labels
    take the lowest of their neighbours' and then their label's label, until none moves.
    """
    from rankloom.session import cut_lineage, laid_out

    if isinstance(compared, Laid):
        return _tile_components(compared, group)
    with laid_out(counted_pairs(compared, group).select(group, "lo", "hi"), [group, "lo"]) as pairs:
        labels = cut_lineage(pairs.select(group, F.explode(F.array("lo", "hi")).alias("item")).distinct().withColumn("component", F.col("item")))
        while True:
            at_lo = labels.select(group, F.col("item").alias("lo"), F.col("component").alias("c_lo"))
            at_hi = labels.select(group, F.col("item").alias("hi"), F.col("component").alias("c_hi"))
            least = F.least("c_lo", "c_hi").alias("component")
            met = pairs.join(at_lo, [group, "lo"]).join(at_hi, [group, "hi"])
            low = met.select(group, F.explode(F.array("lo", "hi")).alias("item"), least).groupBy(group, "item").agg(F.min("component").alias("component"))
            jump = labels.select(group, F.col("item").alias("component"), F.col("component").alias("_next"))
            old = labels.select(group, "item", F.col("component").alias("_old"))
            new = cut_lineage(
                low.join(jump, [group, "component"]).join(old, [group, "item"]).select(group, "item", F.least("component", "_next").alias("component"), "_old")
            )
            labels = new.drop("_old")
            if not new.filter(F.col("component") != F.col("_old")).limit(1).count():
                return labels


def negative_log_likelihood(compared: DataFrame | Laid, strengths: DataFrame, group: str) -> DataFrame:
    if isinstance(compared, Laid):
        placed = compared.items.join(strengths.select(group, "item", "strength"), [group, "item"], "left")
        sums = _tile_map(compared, placed, group, "strength", _logs, "logs double, n bigint")
        return sums.groupBy(group).agg(F.round(-F.sum("logs"), 4).alias("nll"), F.sum("n").alias("n"))
    won = strengths.select(group, F.col("item").alias("winner"), F.col("strength").alias("w"))
    lost = strengths.select(group, F.col("item").alias("loser"), F.col("strength").alias("l"))
    p = F.col("w") / (F.col("w") + F.col("l"))
    return compared.join(won, [group, "winner"]).join(lost, [group, "loser"]).groupBy(group).agg(
        F.round(-F.sum(F.ln(p)), 4).alias("nll"), F.count("*").alias("n")
    )


def normalised(strengths: DataFrame, group: str) -> DataFrame:
    """Divide by the geometric mean of the group: means are summed on the map
    side, then looked up, so no group is gathered."""
    safe = F.when(F.col("strength") <= 0, F.lit(TINY)).otherwise(F.col("strength"))
    means = strengths.groupBy(group).agg(F.avg(F.ln(safe)).alias("mean_log"))
    return lookup_join(strengths, means, [group]).withColumn("strength", safe / F.exp("mean_log"))


def ranked_strengths(strengths: DataFrame, group: str) -> DataFrame:
    """Rank by strength at six decimals, ties by item id."""
    s = F.round("strength", 6)
    rows = strengths.withColumn("score", s)
    micro = (-F.round(F.col("score") * 1000000)).cast("bigint")
    return rank_in_group(
        rows, [group], [F.desc("score"), F.col("item")], [F.floor(-F.ln(F.col("score") + TINY) * 32).cast("bigint"), micro, "item"]
    )


def positional_bias(verdicts: DataFrame, group: str, answer: str = "answer") -> DataFrame:
    """Share of first answers among all comparisons."""
    first = F.count_if(F.col(answer) == "Resume 1")
    return verdicts.groupBy(group).agg(F.count("*").alias("n"), first.alias("n_first"), F.round(first / F.count("*"), 6).alias("bias"))


def error_budget(verdicts: DataFrame, group: str, error: str = "is_default", at_least: int = 50) -> DataFrame:
    """Whether the errors of a group reach ``max(at_least, n div 10)``."""
    errors = F.count_if(error)
    budget = F.greatest(F.lit(at_least).cast("bigint"), F.expr("count(*) div 10"))
    return verdicts.groupBy(group).agg(
        F.count("*").alias("n"), errors.alias("n_errors"), budget.alias("budget"), (errors >= budget).alias("stopped")
    )


def within_budget(verdicts: DataFrame, group: str, error: str = "is_default", at_least: int = 50) -> DataFrame:
    """Comparisons, in pair order, before the error that uses up the budget.

    Pairs that know their places (``places`` of :func:`sample_pairs`) are not shuffled: an item's pairs
    within a tile are summed where they are made, the sums are put in order, and pairs
    made a second time are numbered within their tile alone."""
    flagged = verdicts.withColumn("_e", F.col(error).cast("bigint"))
    if set(PLACE) <= set(verdicts.columns):
        run = _tile_errors(flagged, group)
    else:
        run = running_totals(
            flagged,
            [group],
            [F.col("left_id"), F.col("right_id")],
            ["left_id", F.col("left_id"), "right_id"],
            {"errors_so_far": F.col("_e"), "_one": F.lit(1)},
            {"_n": "_one"},
        ).drop("_one")
    budget = F.greatest(F.lit(at_least).cast("bigint"), F.expr("_n div 10"))
    stop = F.col("errors_so_far") - F.col("_e") >= budget
    return run.filter(~stop).drop("_e", "_n")


def _tile_errors(flagged: DataFrame, group: str) -> DataFrame:
    """Placed pairs with the running sum of ``_e`` in pair order, and the pairs of their group."""
    from rankloom.session import cut_lineage

    tile = [group, "tile_lo", "tile_hi"]
    sums = cut_lineage(flagged.groupBy(*tile, "slot_lo", "left_id").agg(F.coalesce(F.sum("_e"), F.lit(0)).alias("_sum"), F.count("*").alias("_pairs")))
    ran = running_totals(
        sums, [group], [F.col("left_id"), F.col("tile_hi")], ["left_id", F.col("left_id"), "tile_hi"], {"_upto": F.col("_sum"), "_count": F.col("_pairs")}, {"_n": "_count"}
    )
    # What lies before an item's pairs in a tile, as an array by slot.
    ran = cut_lineage(ran.select(*tile, "slot_lo", (F.col("_upto") - F.col("_sum")).alias("_v"), "_n"))
    tops = ran.groupBy(*tile).agg(F.max("slot_lo").alias("_top"), F.max("_n").alias("_n"))
    slots = tops.select(*tile, "_n", F.explode(F.expr("sequence(0, _top)")).alias("slot_lo")).join(ran.drop("_n"), [*tile, "slot_lo"], "left")
    around = slots.groupBy(*tile).agg(
        F.max("_n").alias("_n"), F.transform(F.array_sort(F.collect_list(F.struct("slot_lo", "_v"))), lambda x: x["_v"]).alias("_before")
    )
    met = flagged.join(around.hint("shuffle_hash"), tile).withColumn("_off", F.get("_before", F.col("slot_lo").cast("int"))).drop("_before")
    local = Window.partitionBy(*tile, "slot_lo").orderBy(F.col("right_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return met.withColumn("errors_so_far", F.col("_off") + F.sum("_e").over(local)).drop("_off")
