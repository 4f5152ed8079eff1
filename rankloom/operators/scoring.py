"""Weighted section scores, fit decision, ranks and display columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import wordlists as W
from rankloom.functions.portable import tenths_half_up
from rankloom.operators.spread import rank_in_group


def overall_tenths(weights: dict[str, int] = W.OVERALL_WEIGHTS) -> Column:
    """Weighted overall score in tenths of a point. Weights are whole percents
    and scores whole points, so the sum is in hundredths and exact."""
    hundredths = sum((F.col(c) * w for c, w in weights.items()), F.lit(0))
    return tenths_half_up(hundredths)


def overall(scores: DataFrame, weights: dict[str, int] = W.OVERALL_WEIGHTS) -> DataFrame:
    return scores.withColumn("overall", overall_tenths(weights) / 10)


def blend(overall_col: Column, probability: Column) -> Column:
    """60 % overall score, 40 % model probability, one decimal. The overall score has
    one decimal and the probability four, so thousandths of a point hold the sum."""
    thousandths = F.round(overall_col * 10).cast("bigint") * 60 + F.round(probability * 10000).cast("bigint") * 4
    return F.floor((thousandths + 50) / 100) / 10


def is_fit(overall_col: Column, threshold: float = W.FIT_THRESHOLD) -> Column:
    return overall_col >= threshold


def score_cell(score: Column, scale: int = 10) -> Column:
    """Cell of a score for a descending rank; a bounded score has few of them."""
    return (-F.round(score * scale)).cast("bigint")


def rank_resumes(scores: DataFrame, id_col: str = "resume_id", group: str = "job_id") -> DataFrame:
    """Overall score, fit flag, rank among the fit resumes of a posting (unfit: -1, not
    scored: as uploaded) and fit probability."""
    df = scores if "overall" in scores.columns else overall(scores)
    df = df.withColumn("fit", is_fit(F.col("overall")))
    ranked = rank_in_group(
        df,
        [group, "fit"],
        [F.desc("overall"), F.col(id_col)],
        [score_cell(F.col("overall")), id_col],
        "status",
    )
    return ranked.withColumn("status", F.when(F.col("fit"), F.col("status")).when(~F.col("fit"), F.lit(W.STATUS_UNFIT).cast("bigint")).otherwise(F.lit(W.STATUS_UPLOADED).cast("bigint"))).withColumn(
        "fit_probability", F.round(F.col("overall") / 100, 4)
    )


def by_shelf(ranked: DataFrame) -> DataFrame:
    """Rows that were scored, named by shelf: ranked or unfit."""
    s = F.col("status")
    return ranked.filter(s != W.STATUS_UPLOADED).withColumn("shelf", F.when(s > 0, "ranked").when(s == W.STATUS_UNFIT, "unfit"))


def job_label(title: Column, job_id: Column) -> Column:
    shown = F.coalesce(F.nullif(title, F.lit("")), F.lit("Untitled Job"))
    return F.concat(shown, F.lit(" — "), F.left(job_id.cast("string"), F.lit(8)))


def score_band(score: Column) -> Column:
    return F.when(score >= 75, "high").when(score >= 50, "mid").otherwise("low")


def percent(score: Column) -> Column:
    return F.floor(score + 0.5).cast("bigint")


def preview(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("…"))).otherwise(text)


def corpus_of(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Stack text columns to (key, side, text) in one pass over the input."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("text")) for s, c in columns.items()])
    return df.select(key, F.inline(sides))


def category_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Position of every value in the sorted list of distinct values, from 0; -1 for null.

    Ranks run over distinct values only; a value that many rows share is one row by
    then. Sampled splitters cut the sort into cells.
    """
    from rankloom.operators.spread import lookup_join

    named = df.filter(F.col(column).isNotNull())
    ranked = rank_in_group(named.select(column).distinct(), [], [F.col(column)], [column], "_code")
    codes = ranked.select(column, (F.col("_code") - 1).alias(out))
    unnamed = df.filter(F.col(column).isNull()).withColumn(out, F.lit(-1).cast("bigint"))
    return lookup_join(named, codes, [column]).select(*df.columns, out).unionByName(unnamed)


def dataset_metadata(rows: DataFrame, dim: int) -> DataFrame:
    """Totals, split sizes and class counts of a split data set in one pass."""
    test, fit = F.col("split") == "test", F.col("target") == 1
    return rows.agg(
        F.count("*").alias("total_samples"),
        F.count_if(~test).alias("train_samples"),
        F.count_if(test).alias("test_samples"),
        F.lit(dim).cast("bigint").alias("embedding_dim"),
        F.count_if(~test & fit).alias("train_fit"),
        F.count_if(~test & ~fit).alias("train_no_fit"),
        F.count_if(test & fit).alias("test_fit"),
        F.count_if(test & ~fit).alias("test_no_fit"),
    )
