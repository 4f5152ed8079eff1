"""Evaluation metrics, summaries, run history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from rankloom.operators.spread import running_totals

EPS = 2.220446049250313e-16


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def split_distribution(df: DataFrame, split: str, target: str) -> DataFrame:
    """Class counts per split, side by side."""
    fit = F.col(target) == 1
    return df.groupBy(split).agg(F.count_if(fit).alias("fit"), F.count_if(~fit).alias("no_fit"), F.count("*").alias("total"))


def percent_2dp(part: Column, whole: Column) -> Column:
    """``100 · part / whole`` at two decimals, half up, in whole numbers; 0 if empty."""
    return F.coalesce(F.floor(F.try_divide(part * 20000 + whole, whole * 2)) / 100, F.lit(0.0))


def batch_summary(log: DataFrame, group: str, ok: Column, failed: Column, seconds: Column) -> DataFrame:
    """Totals, completion and times of every batch."""
    good, bad, total = F.count_if(ok), F.count_if(failed), F.count("*")
    return log.groupBy(group).agg(
        total.alias("total_count"),
        good.alias("success_count"),
        bad.alias("error_count"),
        percent_2dp(good + bad, total).alias("completion_percentage"),
        F.round(F.coalesce(F.avg(F.when(ok | failed, seconds)), F.lit(0.0)), 6).alias("avg_processing_time"),
        F.round((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6, 3).alias("total_elapsed_time"),
    )


def job_completeness(resumes: DataFrame, jobs: DataFrame) -> DataFrame:
    """A job is complete when it is done and every resume is ranked or unfit."""
    per_job = resumes.groupBy("job_id").agg(F.bool_and(~F.col("status").isin(-2, 0)).alias("_all"))
    return jobs.join(per_job, "job_id", "left").select(
        "job_id", (F.coalesce("_all", F.lit(False)) & (F.col("job_status") == 1)).alias("complete")
    )


def feedback_summary(rows: DataFrame, group: str, value: Column) -> DataFrame:
    used = F.coalesce(value.isin(1, -1), F.lit(False))
    return rows.groupBy(group).agg(F.count("*").alias("total"), F.count_if(used).alias("processed"), F.count_if(~used).alias("skipped"))


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg((F.count_if(F.col("y") == F.col("yhat")) / F.count("*")).alias("accuracy"))


def confusion(pred: DataFrame, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Counts per actual and predicted class, zeros included: one pass over the rows,
    one output cell per class pair."""
    cells = [
        F.struct(F.lit(a).alias("y"), F.lit(b).alias("yhat"), F.count_if((F.col("y") == a) & (F.col("yhat") == b)).alias("n"))
        for a in classes
        for b in classes
    ]
    return pred.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def precision_recall_f1(pred: DataFrame, positive: int = 1) -> DataFrame:
    hit = F.count_if((F.col("y") == positive) & (F.col("yhat") == positive))
    said, real = F.count_if(F.col("yhat") == positive), F.count_if(F.col("y") == positive)
    return pred.agg(
        F.round(_ratio(hit, said), 6).alias("precision"), F.round(_ratio(hit, real), 6).alias("recall"), F.round(_ratio(2 * hit, said + real), 6).alias("f1")
    )


def classification_report(pred: DataFrame, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted averages."""
    total = F.count("*")
    rows, parts = [], []
    for c in classes:
        hit = F.count_if((F.col("y") == c) & (F.col("yhat") == c))
        said, real = F.count_if(F.col("yhat") == c), F.count_if(F.col("y") == c)
        p, r, f = _ratio(hit, said), _ratio(hit, real), _ratio(2 * hit, said + real)
        parts.append((p, r, f, real))
        rows.append((str(c), p, r, f, real))
    k = len(classes)
    macro = [reduce(lambda a, b: a + b, [x[i] for x in parts]) / k for i in range(3)]
    weighted = [reduce(lambda a, b: a + b, [x[i] * x[3] for x in parts]) / total for i in range(3)]
    rows += [("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    cells = [
        F.struct(
            F.lit(name).alias("class"),
            F.round(p, 6).alias("precision"),
            F.round(r, 6).alias("recall"),
            F.round(f, 6).alias("f1"),
            s.alias("support"),
        )
        for name, p, r, f, s in rows
    ]
    return pred.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def roc_auc(pred: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Area under the ROC curve, ties counted half. Rows collapse to one per
    distinct score before anything is ordered."""
    bars = pred.groupBy(score).agg(F.count_if(F.col(y) == 1).alias("_p"), F.count_if(F.col(y) != 1).alias("_n"))
    s = F.col(score)
    run = running_totals(
        bars, [], [s], [F.floor(s * 256).cast("bigint"), F.floor(s * 65536).cast("bigint")], {"_below": F.col("_n"), "_pos": F.col("_p")}, {"_all_n": "_below", "_all_p": "_pos"}
    )
    area = F.sum(F.col("_p").cast("double") * (F.col("_below") - F.col("_n") / 2))
    return run.agg((area / (F.max("_all_p").cast("double") * F.max("_all_n").cast("double"))).alias("auc"))


def log_loss(pred: DataFrame, score: str = "score", y: str = "y", eps: float = EPS) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    return pred.agg((-F.avg(F.when(F.col(y) == 1, F.ln(p)).otherwise(F.ln(1 - p)))).alias("log_loss"))


def average_precision(pred: DataFrame, query: str, score: str, y: str, key: str, scale: int) -> DataFrame:
    """Average precision per query; 0 for a query without a relevant row. ``scale``
    is the number of steps per unit that scores are compared at."""
    step = (-F.round(F.col(score) * scale)).cast("bigint")
    ranked = running_totals(
        pred.withColumn("_step", step),
        [query],
        [F.col("_step"), F.col(key)],
        [F.col("_step"), key],
        {"_rank": F.lit(1), "_hits": F.col(y)},
    )
    relevant = F.col(y) == 1
    ap = F.avg(F.when(relevant, F.col("_hits") / F.col("_rank")))
    return ranked.groupBy(query).agg(F.coalesce(ap, F.lit(0.0)).alias("ap"))


def mean_average_precision(pred: DataFrame, query: str, score: str, y: str, key: str, scale: int) -> DataFrame:
    return average_precision(pred, query, score, y, key, scale).agg(F.avg("ap").alias("map"))


def best_run(runs: DataFrame, group: str) -> DataFrame:
    """Best accuracy and latest start per experiment; ties to the lower run id, of any type.
    Runs without the value that decides come last."""
    start = F.col("start_time")
    if not isinstance(runs.schema["start_time"].dataType, NumericType):
        start = F.unix_micros(start.cast("timestamp"))
    best = F.min_by(F.struct("run_id", "accuracy"), F.struct(F.col("accuracy").isNull(), -F.col("accuracy"), "run_id"))
    last = F.min_by("run_id", F.struct(start.isNull(), -start, "run_id"))
    return runs.groupBy(group).agg(best.alias("_b"), last.alias("latest_run")).select(
        group, F.col("_b.run_id").alias("best_run"), F.col("_b.accuracy").alias("best_accuracy"), "latest_run"
    )


def promotion_gate(runs: DataFrame, group: str, tolerance: float = 0.005) -> DataFrame:
    """Whether the latest run is accepted: no earlier run, or an accuracy of at
    least the best earlier one less the tolerance."""
    latest = runs.groupBy(group).agg(F.max_by(F.struct("run_id", "accuracy", "start_time"), F.struct(F.col("start_time"), -F.col("run_id"))).alias("new"))
    # One row per experiment joins back by size; the runs stay where they are.
    from rankloom.operators.spread import lookup_join

    earlier = lookup_join(runs, latest, [group]).filter(F.col("run_id") != F.col("new.run_id")).groupBy(group).agg(F.max("accuracy").alias("best_before"))
    ok = F.col("best_before").isNull() | (F.col("new.accuracy") >= F.col("best_before") - tolerance)
    return latest.join(earlier, group, "left").select(
        group, F.col("new.run_id").alias("run_id"), F.col("new.accuracy").alias("accuracy"), "best_before", ok.alias("accepted")
    )


def column_profile(df: DataFrame, label: str) -> DataFrame:
    """Rows, columns, nulls per column and number of label values, in one pass."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns],
        F.count_distinct(label).alias("n_labels"),
    )
