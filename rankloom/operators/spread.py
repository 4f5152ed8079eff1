"""Building blocks that keep hot groups from landing in one task.

* :func:`running_totals` gives exact ranks and prefix sums inside groups of any
  size, by adding up small cells.
* :func:`lookup_join` attaches a lookup table: broadcast when its size is
  checked and small, otherwise hot keys by broadcast and the rest by shuffle.
* :func:`keep_first` / :func:`keep_last` are aggregations, so a hot key shrinks
  on the map side before anything is shuffled.
* :func:`top_k` is the rank-limit pattern that Spark cuts to k rows per group
  in every map task already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

ID_CELL = 1 << 16
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_KEYS = 1000


def id_cell(id_col: Column | str, width: int = ID_CELL) -> Column:
    """Range cell of a unique whole-number id: at most ``width`` rows share one."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.floor(c / F.lit(width)).cast("bigint")


#: Splitters of a column that is no whole number, level by level, and rows they are taken from.
SPLITTERS = 32
SPLITTER_ROWS = 8192
SPLITTER_CHARS = 64


def order_cells(df: DataFrame, name: str) -> list[Column]:
    """Cells of a column of any type that sorts, in its order, from coarse to fine.

    Whole numbers are cut into ranges. Other values are cut at splitters, which are evenly
    spaced among about ``SPLITTER_ROWS`` values drawn by hash; where the splitters lie
    settles how even the cells are and never the order. A null has a null cell.
    """
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, IntegralType):
        return [id_cell(name)]
    key = F.left(c, F.lit(SPLITTER_CHARS)) if isinstance(kind, StringType) else c
    values = df.select(key.alias("v")).filter("v IS NOT NULL")
    every = max(1, values.count() // SPLITTER_ROWS)
    # A value that most rows share is drawn once.
    drawn = values.filter(F.pmod(F.xxhash64("v"), F.lit(every)) == 0).distinct().limit(2 * SPLITTER_ROWS).collect()
    found = sorted(r["v"] for r in drawn)
    fine = [found[i * len(found) // SPLITTERS**2] for i in range(1, SPLITTERS**2)] if found else []
    fine = sorted(set(fine))
    if not fine:
        return [F.when(c.isNotNull(), F.lit(0).cast("bigint"))]
    coarse, rest = fine[SPLITTERS - 1 :: SPLITTERS], [fine[i : i + SPLITTERS - 1] for i in range(0, len(fine), SPLITTERS)]
    rest += [[]] * (len(coarse) + 1 - len(rest))

    def below(splitters: Column) -> Column:
        return F.size(F.filter(splitters, lambda s: s <= c)).cast("bigint")

    typed = lambda v: F.array(*[F.lit(x) for x in v]).cast(f"array<{kind.simpleString()}>")
    first = below(typed(coarse))
    second = below(F.get(F.array(*[typed(r) for r in rest]), first.cast("int")))
    return [F.when(c.isNotNull(), first), F.when(c.isNotNull(), second)]


def join_with_nulls(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` in which null equals null."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_right_{k}" for k in keys]) if keys else left.join(right, [])


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    cells: list[Column | str],
    totals: dict[str, Column],
    group_totals: dict[str, str] | None = None,
) -> DataFrame:
    """Inclusive prefix sums of ``totals`` in ``order`` within ``group``.

    A plain window would sort a whole group in one task. Here ``cells`` cut the
    group into ordered pieces: sorting by the cells must agree with ``order``.
    Only the piece is sorted; what lies before it comes from summing one row
    per cell, level by level. A null group is a group, a null cell comes last in its
    group. A cell given as a column's name stands for the :func:`order_cells` of that
    column. ``group_totals`` maps an output name to the name of a total whose sum over the
    whole group is wanted too.

    Totals of ``lit(1)`` are ranks.
    """
    group_totals = group_totals or {}
    cells = [c for given in cells for c in (order_cells(df, given) if isinstance(given, str) else [given])]
    cell_names = [f"_cell{i}" for i in range(len(cells))]
    keyed = df
    for name, c in zip(cell_names, cells):
        keyed = keyed.withColumn(name, c)
    measures = {f"_m_{k}": v.cast("bigint") for k, v in totals.items()}
    for name, c in measures.items():
        keyed = keyed.withColumn(name, c)

    keys = group + cell_names
    level = keyed.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    # Walk from the finest cells up: offset of a cell inside its parent.
    offsets = level
    parents = keys
    for depth in range(len(cells), 0, -1):
        own, parents = keys[: len(group) + depth], keys[: len(group) + depth - 1]
        sums = level if depth == len(cells) else level.groupBy(*own).agg(*[F.sum(m).alias(m) for m in measures])
        before = Window.partitionBy(*parents).orderBy(F.col(own[-1]).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        cols = [F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_{depth}") for m in measures]
        if depth == 1 and group_totals:
            whole = Window.partitionBy(*parents)
            cols += [F.sum(f"_m_{src}").over(whole).alias(f"_g_{out}") for out, src in group_totals.items()]
        step = sums.select(*own, *cols)
        offsets = step if depth == len(cells) else join_with_nulls(offsets, step, own)
    offsets = offsets.select(
        *keys,
        *[
            sum((F.col(f"{m}_{d}") for d in range(2, len(cells) + 1)), F.col(f"{m}_1")).alias(f"_off{m}")
            for m in measures
        ],
        *[F.col(f"_g_{out}") for out in group_totals],
    )
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = keyed.select("*", *[F.sum(m).over(local).alias(f"_loc{m}") for m in measures])
    joined = join_with_nulls(ranked, offsets, keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_m_{k}") + F.col(f"_loc_m_{k}")).cast("bigint").alias(k) for k in totals],
        *[F.col(f"_g_{out}").cast("bigint").alias(out) for out in group_totals],
    )


def rank_in_group(df: DataFrame, group: list[str], order: list[Column], cells: list[Column | str], name: str = "rank") -> DataFrame:
    """Exact ``row_number`` without a whole group in one task."""
    return running_totals(df, group, order, cells, {name: F.lit(1)})


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """First k rows per group; every map task keeps k rows per group at most."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).filter(F.col(name) <= k)


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """One row per key, the one that sorts first; rows are compared by ``order``
    ascending, and map tasks hand over one row per key."""
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    named = [(F.col(c) if isinstance(c, str) else c).alias(f"_k{i}") for i, c in enumerate(keys)]
    return df.groupBy(*named).agg(F.min_by(row, rank).alias("_row")).select("_row.*")


def keep_last(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    named = [(F.col(c) if isinstance(c, str) else c).alias(f"_k{i}") for i, c in enumerate(keys)]
    return df.groupBy(*named).agg(F.max_by(row, rank).alias("_row")).select("_row.*")


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; reads file sizes, runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    limit_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Inner join of many rows to a lookup table with one row per key.

    The table is broadcast only if its size is within the limit. Estimates of
    derived plans are loose (a join counts as the product of its sides), so a
    table that looks too large is written out once and measured. One that is too
    large takes the second way: the ``hot_keys`` most frequent keys of ``big``
    find their rows by broadcast, a fixed number of rows; in the one shuffle join
    for the others, rows already served are spread by their own hash, so no
    partition holds a frequent key.
    """
    if planned_bytes(small) > limit_bytes:
        from rankloom.session import cut_lineage

        small = cut_lineage(small)
    if planned_bytes(small) <= limit_bytes:
        return big.join(F.broadcast(small), on)
    values = [c for c in small.columns if c not in on]
    packed = small.select(*on, F.struct(F.lit(1).alias("_found"), *values).alias("_value"))
    heavy = F.broadcast(big.groupBy(*on).count().orderBy(F.desc("count"), *on).limit(hot_keys).select(*on))
    hot = F.broadcast(packed.join(heavy, on, "left_semi").withColumnRenamed("_value", "_hot"))
    spread = F.when(F.col("_hot").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*big.columns))
    marked = big.join(hot, on, "left").withColumn("_spread", spread)
    cold = packed.withColumn("_spread", F.lit(0).cast("bigint"))
    met = marked.join(cold, [*on, "_spread"], "left").withColumn("_row", F.coalesce("_hot", "_value"))
    others = [c for c in big.columns if c not in on]
    return met.filter(F.col("_row").isNotNull()).select(*on, *others, *[F.col("_row")[v].alias(v) for v in values])


def spread_small(df: DataFrame, *keys: str, task_bytes: int = 8 << 20) -> DataFrame:
    """Spread a small table over the cores before heavy work per row.

    A table of a few megabytes sits in one file and one task. A table with more
    than ``task_bytes`` per core has splits enough and is left where it is, so a
    large one is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if planned_bytes(df) >= cores * task_bytes:
        return df
    return df.repartition(cores, *keys)
