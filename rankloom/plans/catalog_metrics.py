"""Queries for metrics, summaries and run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators import labels as L
from rankloom.operators import metrics as K
from rankloom.operators import scoring as S
from rankloom.plans import fixtures as X
from rankloom.plans.registry import query


@query("h1_label_distribution", "SELECT label, count(*) AS n FROM v_pairs GROUP BY label")
def h1(spark, d):
    return K.distribution(X.pairs(spark, d), "label")


@query(
    "h2_split_distribution",
    """WITH t AS (SELECT event_id, label FROM v_mixed_labels WHERE label IN ('1', '-1', 'Good Fit', 'No Fit')),
    r AS (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || event_id), 1, 8))::BIGINT, event_id) AS rk, count(*) OVER () AS n FROM t)
    SELECT CASE WHEN rk <= ((n * 20 + 99) // 100) THEN 'test' ELSE 'train' END AS split, count(*) FILTER (label IN ('1', 'Good Fit')) AS fit,
    count(*) FILTER (label NOT IN ('1', 'Good Fit')) AS no_fit, count(*) AS total FROM r GROUP BY 1""",
)
def h2(spark, d):
    rows = X.mixed_labels(spark, d).filter(L.is_binary_label(F.col("label")))
    rows = rows.withColumn("target", L.numeric_target(F.col("label")))
    return K.split_distribution(L.exact_split(rows, "event_id"), "split", "target")


@query(
    "h3_batch_summary",
    """SELECT user_id, count(*) AS total_count, count(*) FILTER (event_type NOT IN ('error', 'view')) AS success_count, count(*) FILTER (event_type = 'error') AS error_count,
    floor((count(*) FILTER (event_type <> 'view') * 20000 + count(*)) / (count(*) * 2)) / 100 AS completion_percentage,
    round(coalesce(avg(value) FILTER (event_type <> 'view'), 0.0), 6) AS avg_processing_time,
    round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS total_elapsed_time FROM events GROUP BY user_id""",
)
def h3(spark, d):
    kind = F.col("event_type")
    return K.batch_summary(X.table(spark, d, "events"), "user_id", ~kind.isin("error", "view"), kind == "error", F.col("value"))


@query(
    "h4_job_completeness",
    """SELECT j.job_id, coalesce(r.done, false) AND j.job_id % 3 <> 0 AS complete FROM v_jobs j LEFT JOIN
    (SELECT job_id, bool_and(CASE WHEN resume_id % 50 = 0 THEN false ELSE status NOT IN (-2, 0) END) AS done FROM v_ranked GROUP BY job_id) r ON r.job_id = j.job_id""",
)
def h4(spark, d):
    ranked = S.rank_resumes(X.scores(spark, d)).select("job_id", F.when(F.col("resume_id") % 50 == 0, -2).otherwise(F.col("status")).alias("status"))
    jobs = X.jobs(spark, d).select("job_id", F.when(F.col("job_id") % 3 == 0, 0).otherwise(1).alias("job_status"))
    return K.job_completeness(ranked, jobs)


@query(
    "h5_feedback_summary",
    """SELECT r.job_id, count(*) AS total, count(*) FILTER (f.feedback_label IN (1, -1)) AS processed, count(*) FILTER (coalesce(f.feedback_label, 0) NOT IN (1, -1)) AS skipped
    FROM v_feedback f JOIN v_resumes r ON r.resume_id = f.resume_id GROUP BY r.job_id""",
)
def h5(spark, d):
    from rankloom.operators.spread import lookup_join

    rows = lookup_join(X.feedback(spark, d), X.resumes(spark, d).select("resume_id", "job_id"), ["resume_id"])
    return K.feedback_summary(rows, "job_id", F.col("feedback_label"))


@query("h6_accuracy", "SELECT count(*) FILTER (y = yhat) / count(*) AS accuracy FROM v_pred")
def h6(spark, d):
    return K.accuracy(X.predictions(spark, d))


@query(
    "h7_confusion_matrix",
    "SELECT a.v AS y, b.v AS yhat, (SELECT count(*) FROM v_pred p WHERE p.y = a.v AND p.yhat = b.v) AS n FROM (SELECT unnest([0, 1]) AS v) a, (SELECT unnest([0, 1]) AS v) b",
)
def h7(spark, d):
    return K.confusion(X.predictions(spark, d))


PRF = """(SELECT {c} AS class, count(*) FILTER (y = {c} AND yhat = {c})::DOUBLE AS hit, count(*) FILTER (yhat = {c})::DOUBLE AS said, count(*) FILTER (y = {c})::DOUBLE AS real, count(*) AS total FROM v_pred)"""
RATIOS = "CASE WHEN said = 0 THEN 0 ELSE hit / said END AS p, CASE WHEN real = 0 THEN 0 ELSE hit / real END AS r, CASE WHEN said + real = 0 THEN 0 ELSE 2 * hit / (said + real) END AS f"


@query(
    "h8_precision_recall_f1",
    f"SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM (SELECT {RATIOS} FROM {PRF.format(c=1)})",
)
def h8(spark, d):
    return K.precision_recall_f1(X.predictions(spark, d))


@query(
    "h9_classification_report",
    f"""WITH c AS (SELECT class, real, total, {RATIOS} FROM (SELECT * FROM {PRF.format(c=0)} UNION ALL SELECT * FROM {PRF.format(c=1)})),
    r AS (SELECT class::VARCHAR AS class, p, r, f, real::BIGINT AS support FROM c UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), max(total) FROM c
      UNION ALL SELECT 'weighted avg', sum(p * real) / max(total), sum(r * real) / max(total), sum(f * real) / max(total), max(total) FROM c)
    SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM r""",
)
def h9(spark, d):
    return K.classification_report(X.predictions(spark, d))


@query(
    "h10_roc_auc",
    """SELECT round((sum(rk) FILTER (y = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk,
    count(*) FILTER (y = 1) OVER () AS p, count(*) FILTER (y <> 1) OVER () AS n FROM v_pred) GROUP BY p, n""",
)
def h10(spark, d):
    return K.roc_auc(X.predictions(spark, d)).select(F.round("auc", 6).alias("auc"))


@query(
    "h11_log_loss",
    """SELECT round(-avg(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss FROM (SELECT y, least(greatest(score, 2.220446049250313e-16::DOUBLE), 1 - 2.220446049250313e-16::DOUBLE) AS p FROM v_pred)""",
)
def h11(spark, d):
    return K.log_loss(X.predictions(spark, d)).select(F.round("log_loss", 6).alias("log_loss"))


AP = """ap AS (SELECT qid, coalesce(avg(hits / rk) FILTER (y = 1), 0.0) AS ap FROM (SELECT qid, y, row_number() OVER w AS rk, sum(y) OVER w AS hits FROM v_pred
    WINDOW w AS (PARTITION BY qid ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING)) GROUP BY qid)"""


@query("h12_average_precision", f"WITH {AP} SELECT qid, round(ap, 6) AS ap FROM ap")
def h12_per_query(spark, d):
    return K.average_precision(X.predictions(spark, d), "qid", "score", "y", "doc_id", 100).select("qid", F.round("ap", 6).alias("ap"))


@query("h12_mean_average_precision", f"WITH {AP} SELECT round(avg(ap), 6) AS map FROM ap")
def h12(spark, d):
    return K.mean_average_precision(X.predictions(spark, d), "qid", "score", "y", "doc_id", 100).select(F.round("map", 6).alias("map"))


@query("h13_group_sizes", "SELECT qid, count(*) AS n FROM v_pred GROUP BY qid")
def h13(spark, d):
    return K.distribution(X.predictions(spark, d), "qid")


@query(
    "h14_best_and_latest_run",
    """SELECT experiment, arg_max(run_id, (accuracy, -run_id)) AS best_run, max(accuracy) AS best_accuracy, arg_max(run_id, (start_time, -run_id)) AS latest_run FROM v_runs GROUP BY experiment""",
)
def h14(spark, d):
    return K.best_run(X.runs(spark, d), "experiment")


@query(
    "h15_promotion_gate",
    """WITH l AS (SELECT experiment, arg_max(run_id, (start_time, -run_id)) AS run_id FROM v_runs GROUP BY experiment)
    SELECT l.experiment, l.run_id, max(r.accuracy) FILTER (r.run_id = l.run_id) AS accuracy, max(r.accuracy) FILTER (r.run_id <> l.run_id) AS best_before,
    coalesce(max(r.accuracy) FILTER (r.run_id = l.run_id) >= max(r.accuracy) FILTER (r.run_id <> l.run_id) - 0.005::DOUBLE, true) AS accepted
    FROM l JOIN v_runs r ON r.experiment = l.experiment GROUP BY l.experiment, l.run_id""",
)
def h15(spark, d):
    return K.promotion_gate(X.runs(spark, d), "experiment")


@query(
    "h16_column_profile",
    "SELECT count(*) AS n_rows, 2::BIGINT AS n_columns, count(*) FILTER (event_id IS NULL) AS event_id_nulls, count(*) FILTER (label IS NULL) AS label_nulls, count(DISTINCT label) AS n_labels FROM v_mixed_labels",
)
def h16(spark, d):
    return K.column_profile(X.mixed_labels(spark, d), "label")


@query("j3_order_by_query", "SELECT qid, doc_id, score FROM v_pred ORDER BY qid, doc_id")
def j3(spark, d):
    return X.predictions(spark, d).select("qid", "doc_id", "score").orderBy("qid", "doc_id")
