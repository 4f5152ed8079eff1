"""Queries over tables: labels, joins, sets, sorts, samples, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.operators import labels as L
from rankloom.operators import scoring as S
from rankloom.operators.spread import keep_first, lookup_join, rank_in_group, running_totals, top_k
from rankloom.plans import fixtures as X
from rankloom.plans.registry import query

H42 = "('0x' || substr(md5('42:' || {k}), 1, 8))::BIGINT"


# ---- sources and sinks that are relational -------------------------------

@query("a2_parquet_scan", "SELECT doc_id, lang, n_chars FROM documents")
def a2(spark, d):
    return X.table(spark, d, "documents").select("doc_id", "lang", "n_chars")


@query(
    "a12_dataset_metadata",
    """WITH t AS (SELECT event_id, label FROM v_mixed_labels WHERE label IN ('1', '-1', 'Good Fit', 'No Fit')),
    r AS (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || event_id), 1, 8))::BIGINT, event_id) AS rk,
          count(*) OVER () AS n FROM t),
    s AS (SELECT *, rk <= ((n * 20 + 99) // 100) AS is_test, label IN ('1', 'Good Fit') AS fit FROM r)
    SELECT count(*) AS total_samples, count(*) FILTER (NOT is_test) AS train_samples, count(*) FILTER (is_test) AS test_samples,
      128::BIGINT AS embedding_dim,
      count(*) FILTER (NOT is_test AND fit) AS train_fit, count(*) FILTER (NOT is_test AND NOT fit) AS train_no_fit,
      count(*) FILTER (is_test AND fit) AS test_fit, count(*) FILTER (is_test AND NOT fit) AS test_no_fit FROM s""",
)
def a12(spark, d):
    rows = X.mixed_labels(spark, d).filter(L.is_binary_label(F.col("label")))
    rows = rows.withColumn("target", L.numeric_target(F.col("label")))
    return S.dataset_metadata(L.exact_split(rows, "event_id"), dim=128)


@query(
    "a13_batched_writes",
    """WITH b AS (SELECT section, (row_number() OVER (PARTITION BY section ORDER BY vec_id) - 1) // 100 AS batch,
      length(embedding) = 64 AS ok FROM v_sections)
    SELECT section, batch::BIGINT AS batch, count(*) AS n_rows, count(*) FILTER (ok) AS n_ok, bool_and(ok) AS batch_ok FROM b GROUP BY ALL""",
)
def a13(spark, d):
    from rankloom.sources.sinks import batch_report

    rows = L.batch_numbers(X.sections(spark, d), ["section"], "vec_id", 100)
    return batch_report(rows.withColumn("ok", F.size("embedding") == 64), ["section"])


@query(
    "a15_keyed_upsert",
    """WITH u AS (SELECT resume_id, max(feedback_label) FILTER (WHERE rn = 1) AS feedback_label FROM (
      SELECT resume_id, feedback_label, row_number() OVER (PARTITION BY resume_id ORDER BY feedback_label IS NULL, ts DESC, event_id DESC) AS rn FROM v_feedback)
      GROUP BY resume_id)
    SELECT coalesce(b.resume_id, u.resume_id) AS resume_id, b.job_id, coalesce(u.feedback_label, 0)::INTEGER AS feedback_label
    FROM (SELECT resume_id, job_id FROM v_resumes) b FULL JOIN u ON b.resume_id = u.resume_id""",
)
def a15(spark, d):
    base = X.resumes(spark, d).select("resume_id", "job_id", F.lit(0).alias("feedback_label"))
    return L.upsert(base, X.feedback(spark, d), "resume_id", ["ts", "event_id"], ["feedback_label"]).withColumn(
        "feedback_label", F.coalesce("feedback_label", F.lit(0))
    )


@query(
    "a16_append_defaults",
    "SELECT resume_id, job_id, filename, -2 AS status, 0.0::DOUBLE AS fit_probability, 0 AS feedback_label FROM v_resumes",
)
def a16(spark, d):
    return L.new_resume_rows(X.resumes(spark, d).select("resume_id", "job_id", "filename"))


@query(
    "a17_object_path",
    """SELECT event_id, split_part(object_id, '/', 2) AS job_id, split_part(object_id, '/', 2) AS parent_dir,
    split_part(object_id, '/', 3) AS blob_name, 'cv.pdf' AS original_name FROM v_arrivals""",
)
def a17(spark, d):
    return X.arrivals(spark, d).select("event_id", *[c.alias(n) for n, c in L.path_parts(F.col("object_id")).items()])


# ---- projections, filters ---------------------------------------------------

@query("b1_lookup_by_job", "SELECT resume_id, filename FROM v_resumes WHERE job_id = 7")
def b1(spark, d):
    return X.resumes(spark, d).filter(F.col("job_id") == 7).select("resume_id", "filename")


@query("b2_projection", "SELECT resume_id, resume_text FROM v_resumes")
def b2(spark, d):
    return X.resumes(spark, d).select("resume_id", "resume_text")


@query("b3_drop_nulls", "SELECT event_id, label FROM v_mixed_labels WHERE label IS NOT NULL")
def b3(spark, d):
    return L.drop_incomplete(X.mixed_labels(spark, d), ["label"])


@query(
    "b4_encode_labels",
    "SELECT event_id, CASE label WHEN 'Good Fit' THEN 1 WHEN 'No Fit' THEN 0 END AS label FROM v_mixed_labels WHERE label IS DISTINCT FROM 'Potential Fit'",
)
def b4(spark, d):
    return L.encode_labels(X.mixed_labels(spark, d))


@query(
    "b5_valid_labels",
    "SELECT event_id, label FROM v_mixed_labels WHERE label IN ('1', '-1', '0') OR lower(label) IN ('good fit', 'no fit', 'potential fit', 'neutral')",
)
def b5(spark, d):
    return X.mixed_labels(spark, d).filter(L.is_valid_label(F.col("label")))


@query(
    "b6_binary_subset",
    """SELECT count(*) AS n_before, count(*) FILTER (label IN ('1', '-1', 'Good Fit', 'No Fit')) AS n_kept,
    count(*) FILTER (label IS NULL OR label NOT IN ('1', '-1', 'Good Fit', 'No Fit')) AS n_removed FROM v_mixed_labels""",
)
def b6(spark, d):
    keep = L.is_binary_label(F.col("label"))
    return X.mixed_labels(spark, d).agg(
        F.count("*").alias("n_before"), F.count_if(keep).alias("n_kept"), F.count_if(~keep).alias("n_removed")
    )


@query(
    "b7_numeric_target",
    """SELECT event_id, CASE label WHEN 'Good Fit' THEN 1 WHEN '1' THEN 1 ELSE 0 END AS target FROM v_mixed_labels
    WHERE label IN ('1', '-1', 'Good Fit', 'No Fit')""",
)
def b7(spark, d):
    rows = X.mixed_labels(spark, d).filter(L.is_binary_label(F.col("label")))
    return rows.select("event_id", L.numeric_target(F.col("label")).alias("target"))


@query("b8_prediction_status", "SELECT doc_id, CASE yhat WHEN 0 THEN -1 WHEN 1 THEN 0 END AS status FROM v_pred")
def b8(spark, d):
    return X.predictions(spark, d).select("doc_id", L.status_of_prediction(F.col("yhat")).alias("status"))


@query(
    "b9_feedback_labels",
    "SELECT event_id, resume_id, CASE feedback_label WHEN 1 THEN 'Good Fit' ELSE 'No Fit' END AS label FROM v_feedback WHERE feedback_label IN (1, -1)",
)
def b9(spark, d):
    rows = X.feedback(spark, d).select("event_id", "resume_id", L.feedback_label(F.col("feedback_label")).alias("label"))
    return rows.filter(F.col("label").isNotNull())


@query(
    "b10_status_filters",
    "SELECT resume_id, status::BIGINT AS status, CASE WHEN status > 0 THEN 'ranked' WHEN status = -1 THEN 'unfit' END AS shelf FROM v_ranked WHERE status <> -2",
)
def b10(spark, d):
    return S.by_shelf(S.rank_resumes(X.scores(spark, d))).select("resume_id", "status", "shelf")


@query(
    "b11_truthy_fallback",
    "SELECT job_id, CASE WHEN job_id % 3 = 0 THEN job_text ELSE 'about ' || job_id END AS text FROM v_jobs WHERE CASE WHEN job_id % 3 = 0 THEN job_text ELSE 'about ' || job_id END <> ''",
)
def b11(spark, d):
    j = X.jobs(spark, d)
    described = F.when(F.col("job_id") % 3 == 0, "").otherwise(F.concat(F.lit("about "), F.col("job_id").cast("string")))
    return j.select("job_id", L.job_text_or_description(described, F.col("job_text")).alias("text")).filter(F.col("text").isNotNull())


@query(
    "b12_candidate_name",
    "SELECT resume_id, upper(source[1:1]) || source[2:] || ' ' || resume_id AS name FROM (SELECT r.resume_id, d.source FROM v_resumes r JOIN documents d ON d.doc_id = r.resume_id)",
)
def b12(spark, d):
    return X.resumes(spark, d).select("resume_id", T.title_case_name(F.col("filename"), F.col("resume_id")).alias("name"))


@query(
    "b13_display_columns",
    """SELECT resume_id, CASE WHEN job_id % 4 = 0 THEN 'Untitled Job' ELSE 'Job ' || job_id END || ' — ' || substr(md5(job_id::VARCHAR), 1, 8) AS job_label,
    CASE WHEN overall >= 75 THEN 'high' WHEN overall >= 50 THEN 'mid' ELSE 'low' END AS band, floor(overall + 0.5)::BIGINT AS percent FROM v_ranked""",
)
def b13(spark, d):
    rows = S.overall(X.scores(spark, d))
    title = F.when(F.col("job_id") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("Job "), F.col("job_id").cast("string")))
    return rows.select(
        "resume_id",
        S.job_label(title, F.md5(F.col("job_id").cast("string"))).alias("job_label"),
        S.score_band(F.col("overall")).alias("band"),
        S.percent(F.col("overall")).alias("percent"),
    )


@query("b13_text_preview", "SELECT resume_id, CASE WHEN length(resume_text) > 80 THEN left(resume_text, 80) || '…' ELSE resume_text END AS preview FROM v_resumes")
def b13_preview(spark, d):
    return X.resumes(spark, d).select("resume_id", S.preview(F.col("resume_text"), 80).alias("preview"))


# ---- joins -------------------------------------------------------------------

@query(
    "c1_training_join",
    """SELECT r.resume_id, j.job_text AS job_description_text, r.resume_text, CASE f.feedback_label WHEN 1 THEN 'Good Fit' ELSE 'No Fit' END AS label
    FROM v_resumes r JOIN v_jobs j ON r.job_id = j.job_id JOIN
    (SELECT resume_id, arg_max(coalesce(feedback_label, 9), (ts, event_id)) AS feedback_label FROM v_feedback GROUP BY resume_id) f
    ON f.resume_id = r.resume_id WHERE f.feedback_label IN (1, -1)""",
)
def c1(spark, d):
    last = L.latest_feedback(X.feedback(spark, d)).select("resume_id", L.feedback_label(F.col("feedback_label")).alias("label"))
    labelled = X.resumes(spark, d).join(last.filter(F.col("label").isNotNull()), "resume_id")
    return lookup_join(labelled, X.jobs(spark, d), ["job_id"]).select(
        "resume_id", F.col("job_text").alias("job_description_text"), "resume_text", "label"
    )


@query("c2_attach_posting", "SELECT r.resume_id, r.job_id, length(r.resume_text) AS resume_chars, j.job_text FROM v_resumes r JOIN v_jobs j ON r.job_id = j.job_id")
def c2(spark, d):
    rows = X.resumes(spark, d).select("resume_id", "job_id", F.length("resume_text").cast("bigint").alias("resume_chars"))
    return lookup_join(rows, X.jobs(spark, d).select("job_id", "job_text"), ["job_id"])


@query(
    "c6_rank_order",
    "SELECT resume_id, job_id, status::BIGINT AS rank, filename FROM (SELECT s.resume_id, s.job_id, s.status, r.filename FROM v_ranked s JOIN v_resumes r ON s.resume_id = r.resume_id) WHERE status > 0 ORDER BY job_id, rank",
)
def c6(spark, d):
    ranked = S.rank_resumes(X.scores(spark, d)).filter(F.col("status") > 0).select("resume_id", F.col("status").alias("rank"))
    return X.resumes(spark, d).select("resume_id", "job_id", "filename").join(ranked, "resume_id").orderBy("job_id", "rank")


@query(
    "c7_unseen_directories",
    """SELECT DISTINCT split_part(object_id, '/', 2) AS dir FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE'
    AND split_part(object_id, '/', 2) NOT IN (SELECT user_id::VARCHAR FROM events WHERE value > 200)""",
)
def c7(spark, d):
    from rankloom.streaming.arrivals import finalized

    seen = X.table(spark, d, "events").filter(F.col("value") > 200).select(F.col("user_id").cast("string").alias("dir")).distinct()
    return finalized(X.arrivals(spark, d)).select("dir").distinct().join(seen, "dir", "left_anti")


# ---- sorts, limits, samples --------------------------------------------------

@query("j1_sort_within_job", "SELECT resume_id, job_id, overall::DOUBLE AS overall FROM v_ranked ORDER BY job_id, overall DESC, resume_id")
def j1(spark, d):
    return S.overall(X.scores(spark, d)).select("resume_id", "job_id", "overall").orderBy("job_id", F.desc("overall"), "resume_id")


@query("j2_head", "SELECT pair_id, label FROM v_pairs ORDER BY pair_id LIMIT 100")
def j2(spark, d):
    return X.pairs(spark, d).select("pair_id", "label").orderBy("pair_id").limit(100)


@query(
    "j4_stratified_sample",
    """SELECT job_id, shelf, resume_id, draw FROM (SELECT *, row_number() OVER (PARTITION BY job_id, shelf ORDER BY
      ('0x' || substr(md5('sample:' || resume_id), 1, 8))::BIGINT, resume_id) AS draw
      FROM (SELECT job_id, resume_id, CASE WHEN status > 0 THEN 'ranked' ELSE 'unfit' END AS shelf FROM v_ranked)) WHERE draw <= 3""",
)
def j4(spark, d):
    ranked = S.by_shelf(S.rank_resumes(X.scores(spark, d)))
    return L.stratified_sample(ranked, ["job_id", "shelf"], "resume_id").select("job_id", "shelf", "resume_id", "draw")


@query(
    "j5_exact_split",
    f"""SELECT doc_id, CASE WHEN rk <= ((n * 20 + 99) // 100) THEN 'test' ELSE 'train' END AS split FROM
    (SELECT doc_id, row_number() OVER (ORDER BY {H42.format(k='doc_id')}, doc_id) AS rk, count(*) OVER () AS n FROM documents)""",
)
def j5(spark, d):
    return L.exact_split(X.table(spark, d, "documents").select("doc_id"), "doc_id")


# ---- set operations ------------------------------------------------------------

BASE_AND_FEEDBACK = """base AS (SELECT 0 AS src, pair_id AS row_id, resume_text, job_description_text, label FROM v_pairs),
    extra AS (SELECT 1 AS src, f.event_id AS row_id, r.resume_text, j.job_text AS job_description_text,
      CASE f.feedback_label WHEN 1 THEN 'Good Fit' ELSE 'No Fit' END AS label FROM v_feedback f JOIN v_resumes r ON r.resume_id = f.resume_id
      JOIN v_jobs j ON j.job_id = r.job_id WHERE f.feedback_label IN (1, -1)),
    both_parts AS (SELECT * FROM base UNION ALL SELECT * FROM extra)"""


def base_rows(spark, d):
    return X.pairs(spark, d).select(F.col("pair_id").alias("row_id"), "resume_text", "job_description_text", "label")


def feedback_rows(spark, d):
    f = X.feedback(spark, d).select("event_id", "resume_id", L.feedback_label(F.col("feedback_label")).alias("label"))
    r = X.resumes(spark, d).select("resume_id", "job_id", "resume_text")
    joined = lookup_join(f.filter(F.col("label").isNotNull()), r, ["resume_id"])
    return lookup_join(joined, X.jobs(spark, d).select("job_id", "job_text"), ["job_id"]).select(
        F.col("event_id").alias("row_id"), "resume_text", F.col("job_text").alias("job_description_text"), "label"
    )


@query("k1_union_sources", f"WITH {BASE_AND_FEEDBACK} SELECT src, row_id, label FROM both_parts")
def k1(spark, d):
    both = base_rows(spark, d).withColumn("src", F.lit(0)).unionByName(feedback_rows(spark, d).withColumn("src", F.lit(1)), allowMissingColumns=True)
    return both.select("src", "row_id", "label")


@query(
    "k2_dedupe_keep_first",
    f"""WITH {BASE_AND_FEEDBACK} SELECT row_id, label, md5(resume_text) AS resume_digest FROM (SELECT *, row_number() OVER
    (PARTITION BY job_description_text, resume_text ORDER BY src, row_id) AS rn FROM both_parts) WHERE rn = 1""",
)
def k2(spark, d):
    kept = L.assemble_training(base_rows(spark, d), feedback_rows(spark, d))
    return kept.select("row_id", "label", F.md5("resume_text").alias("resume_digest"))


@query("k3_distinct_rows", "SELECT DISTINCT resume_text, job_description_text, label FROM v_pairs")
def k3(spark, d):
    return X.pairs(spark, d).select("resume_text", "job_description_text", "label").distinct()


@query("k4_text_corpus", "SELECT pair_id, 'resume' AS side, resume_text AS text FROM v_pairs UNION ALL SELECT pair_id, 'job', job_description_text FROM v_pairs")
def k4(spark, d):
    return S.corpus_of(X.pairs(spark, d), "pair_id", {"resume": "resume_text", "job": "job_description_text"})


@query("k5_candidate_union", "SELECT DISTINCT job_id, candidate_id FROM v_applied")
def k5(spark, d):
    return X.applied(spark, d).select("job_id", "candidate_id").distinct()


@query(
    "k6_union_or_base",
    f"""WITH {BASE_AND_FEEDBACK} SELECT label, count(*) AS n FROM (SELECT *, row_number() OVER
    (PARTITION BY job_description_text, resume_text ORDER BY src, row_id) AS rn FROM both_parts) WHERE rn = 1 GROUP BY label""",
)
def k6(spark, d):
    return L.assemble_training(base_rows(spark, d), feedback_rows(spark, d)).groupBy("label").agg(F.count("*").alias("n"))


# ---- windows --------------------------------------------------------------------

@query(
    "w1_rank_within_job",
    "SELECT resume_id, job_id, row_number() OVER (PARTITION BY job_id ORDER BY overall DESC, resume_id) AS rank FROM v_ranked",
)
def w1(spark, d):
    rows = S.overall(X.scores(spark, d)).select("resume_id", "job_id", "overall")
    return rank_in_group(rows, ["job_id"], [F.desc("overall"), F.col("resume_id")], [S.score_cell(F.col("overall")), "resume_id"]).drop("overall")


@query(
    "w1_rank_text_ids",
    "SELECT resume_id, job_id, row_number() OVER (PARTITION BY job_id ORDER BY overall DESC, resume_id) AS rank FROM (SELECT 'r-' || resume_id AS resume_id, job_id, overall FROM v_ranked)",
)
def w1_text(spark, d):
    rows = S.overall(X.scores(spark, d)).select(F.concat(F.lit("r-"), F.col("resume_id").cast("string")).alias("resume_id"), "job_id", "overall")
    return rank_in_group(rows, ["job_id"], [F.desc("overall"), F.col("resume_id")], [S.score_cell(F.col("overall")), "resume_id"]).drop("overall")


@query(
    "w2_top_k",
    "SELECT job_id, resume_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY overall DESC, resume_id) AS rank FROM v_ranked) WHERE rank <= 5",
)
def w2(spark, d):
    rows = S.overall(X.scores(spark, d)).select("resume_id", "job_id", "overall")
    return top_k(rows, ["job_id"], [F.desc("overall"), F.col("resume_id")], 5).drop("overall")


@query(
    "w3_running_relevant",
    "SELECT doc_id, qid, sum(y) OVER (PARTITION BY qid ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS hits FROM v_pred",
)
def w3(spark, d):
    rows = X.predictions(spark, d)
    return running_totals(
        rows, ["qid"], [F.desc("score"), F.col("doc_id")], [S.score_cell(F.col("score"), 100), "doc_id"], {"hits": F.col("y")}
    ).select("doc_id", "qid", "hits")


@query(
    "w4_category_codes",
    "SELECT pair_id, (dense_rank() OVER (ORDER BY job_description_text) - 1)::BIGINT AS qid FROM v_pairs",
)
def w4(spark, d):
    return S.category_codes(X.pairs(spark, d).select("pair_id", "job_description_text"), "job_description_text", "qid").select("pair_id", "qid")


@query("w5_list_length", "SELECT job_id, section, count(*) AS n FROM v_applied GROUP BY job_id, section")
def w5(spark, d):
    return X.applied(spark, d).groupBy("job_id", "section").agg(F.count("*").alias("n"))


@query("w6_keep_first", "SELECT resume_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY resume_id ORDER BY ts, event_id) AS rn FROM v_feedback) WHERE rn = 1")
def w6(spark, d):
    return keep_first(X.feedback(spark, d), ["resume_id"], ["ts", "event_id"]).select("resume_id", "event_id")


@query("w7_batch_number", "SELECT vec_id, section, ((row_number() OVER (PARTITION BY section ORDER BY vec_id) - 1) // 10)::BIGINT AS batch FROM v_sections")
def w7(spark, d):
    return L.batch_numbers(X.sections(spark, d).select("vec_id", "section"), ["section"], "vec_id", 10)


@query(
    "l10_stratified_folds",
    """SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY ('0x' || substr(md5('fold:' || doc_id), 1, 8))::BIGINT, doc_id) - 1) % 3)::INTEGER AS fold FROM labels""",
)
def l10(spark, d):
    return L.assign_folds(X.table(spark, d, "labels").select("doc_id", "quality"), "quality", "doc_id")
