"""Queries for files, sinks and streams. Written data goes below the shared folder."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from rankloom.operators import scoring as S
from rankloom.plans import fixtures as X
from rankloom.plans import pipelines as P
from rankloom.plans.registry import query
from rankloom.session import scratch_path
from rankloom.sources import files as FS
from rankloom.sources import sinks as K
from rankloom.sources import tables as TB
from rankloom.streaming import arrivals as A

# ---- files and sinks -------------------------------------------------------------


@query("a1_pairs_csv", "SELECT resume_text, job_description_text, label FROM v_pairs")
def a1(spark, d):
    path = K.write_csv_snapshot(X.pairs(spark, d).select("resume_text", "job_description_text", "label"), scratch_path(spark, "csv"), "pairs")
    return TB.read_pairs_csv(spark, path)


@query(
    "a3_resume_listing",
    "SELECT event_id, user_id::VARCHAR AS job_id, event_id::VARCHAR AS resume_id, 'cv.pdf' AS filename FROM events WHERE event_id % 3 <> 0",
)
def a3(spark, d):
    """Paths as a listing would give them, with some of another kind."""
    path = F.when(F.col("event_id") % 3 == 0, F.replace("object_id", F.lit(".pdf"), F.lit(".txt"))).otherwise(F.col("object_id"))
    files = X.arrivals(spark, d).select("event_id", F.concat(F.lit("file:/bucket/"), path).alias("path"))
    return FS.resume_listing(files).select("event_id", "job_id", "resume_id", "filename")


def zip_files(batches):
    """One archive per document: two members to read and three to skip."""
    import pyarrow as pa

    def archives():
        for batch in batches:
            for i, text in ((i.as_py(), text.as_py()) for i, text in zip(*batch.columns)):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w") as z:
                    z.writestr(f"in/{i}.pdf", text)
                    z.writestr(f"in/{i}.PDF", text[::-1])
                    z.writestr("in/", "")
                    z.writestr(f"__MACOSX/{i}.pdf", "x")
                    z.writestr("in/notes.txt", "x")
                yield f"zip/{i}.zip", buf.getvalue()

    return FS.in_chunks(archives(), {"path": pa.string(), "content": pa.binary()})


@query(
    "a4_zip_members",
    """SELECT 'zip/' || doc_id || '.zip' AS archive, m AS member, NOT (m IN ('in/' || doc_id || '.pdf', 'in/' || doc_id || '.PDF')) AS skipped,
    CASE WHEN m IN ('in/' || doc_id || '.pdf', 'in/' || doc_id || '.PDF') THEN octet_length(encode(text)) END AS n_bytes
    FROM (SELECT *, unnest(['in/' || doc_id || '.pdf', 'in/' || doc_id || '.PDF', 'in/', '__MACOSX/' || doc_id || '.pdf', 'in/notes.txt']) AS m FROM documents)""",
)
def a4(spark, d):
    archives = X.table(spark, d, "documents").select("doc_id", "text").mapInArrow(zip_files, "path string, content binary")
    return FS.expand_zips(archives).select("archive", "member", "skipped", F.octet_length("content").cast("bigint").alias("n_bytes"))


@query("a5_text_by_extension", "SELECT filename AS path, resume_text AS text FROM (SELECT replace(filename, '.pdf', '.txt') AS filename, resume_text FROM v_resumes)")
def a5_files(spark, d):
    files = X.resumes(spark, d).select(F.replace("filename", F.lit(".pdf"), F.lit(".txt")).alias("path"), F.encode("resume_text", "utf-8").alias("content"))
    return FS.extract_text(files).select("path", "text")


@query("a7_embedding_files", "SELECT count(*) AS n, min(length(embedding)) AS dim, sum(label)::BIGINT AS label_sum, round(sum(embedding[1]::DOUBLE), 4) AS first_sum FROM embeddings")
def a7(spark, d):
    path = scratch_path(spark, "vectors")
    K.write_embeddings(X.table(spark, d, "embeddings"), path, "embedding", "label")
    return spark.read.parquet(path).agg(
        F.count("*").alias("n"),
        F.min(F.size("X")).cast("bigint").alias("dim"),
        F.sum("y").alias("label_sum"),
        F.round(F.sum(F.element_at("X", 1).cast("double")), 4).alias("first_sum"),
    )


@query("a9_latest_snapshot", "SELECT event_type AS prefix, arg_max(event_id, (ts, event_id)) AS latest FROM events GROUP BY event_type")
def a9(spark, d):
    """Newest file per prefix, over events taken as a listing."""
    listing = X.table(spark, d, "events").select(
        F.concat(F.lit("data/"), "event_type", F.lit("_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("path"), F.col("ts").alias("modified")
    )
    newest = FS.latest_snapshots(listing, FS.file_prefix(F.col("path")))
    return newest.select("prefix", F.substring_index("path", "_", -1).cast("bigint").alias("latest"))


@query("a10_csv_snapshot", "SELECT doc_id::VARCHAR AS doc_id, text FROM documents")
def a10(spark, d):
    path = K.write_csv_snapshot(X.table(spark, d, "documents").select("doc_id", "text"), scratch_path(spark, "csv"), "documents", "20240101_000000")
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("doc_id string, text string").csv(path)


@query("a11_prediction_json", "SELECT qid AS job_id, doc_id AS resume_id, yhat::BIGINT AS prediction FROM v_pred")
def a11(spark, d):
    path = scratch_path(spark, "predictions")
    rows = X.predictions(spark, d).select(F.col("qid").alias("job_id"), F.col("doc_id").alias("resume_id"), F.col("yhat").alias("prediction"))
    K.write_predictions(rows, path)
    return spark.read.schema("job_id bigint, resume_id bigint, prediction bigint").json(path)


@query("a13_isolated_writes", "SELECT sum(length(e))::BIGINT AS n_rows, count(*) FILTER (false) AS failed_calls FROM (SELECT [vec_id] AS e FROM embeddings)")
def a13_calls(spark, d):
    def write(rows):
        if len(rows) > 100:
            raise ValueError("call too large")

    calls = K.write_in_batches(X.table(spark, d, "embeddings").select("vec_id", "label"), write)
    return calls.agg(F.sum("n_rows").alias("n_rows"), F.count("error").alias("failed_calls"))


@query("a14_table_reset", "SELECT doc_id, quality FROM labels")
def a14(spark, d):
    path = scratch_path(spark, "table")
    K.reset_table(X.table(spark, d, "labels").select("doc_id", "quality", "toxic"), path)
    K.reset_table(X.table(spark, d, "labels").select("doc_id", "quality"), path)
    return spark.read.parquet(path)


@query("l12_versioned_path", "SELECT doc_id, quality FROM labels")
def l12(spark, d):
    root = scratch_path(spark, "versions")
    rows = X.table(spark, d, "labels").select("doc_id", "quality")
    older = rows.withColumn("quality", 1 - F.col("quality"))
    for stamp, version in (("20240101_000000", older), ("20240102_000000", rows)):
        K.reset_table(version.withColumn("quality", F.col("quality").cast(rows.schema["quality"].dataType)), f"{root}/run={stamp}")
    newest = spark.read.parquet(root).select(F.max("run").alias("run"))
    return spark.read.parquet(root).join(F.broadcast(newest), "run").drop("run")


# ---- streams --------------------------------------------------------------------------


def messages(spark, d):
    return X.arrivals_of(A.read_events(spark, d))


def drained(spark, stream):
    out, check = scratch_path(spark, "stream"), scratch_path(spark, "check")
    A.drain_to(stream, out, check)
    return spark.read.parquet(out)


@query("m1_finalized_messages", "SELECT event_id, split_part(object_id, '/', 2) AS dir FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE'")
def m1(spark, d):
    return drained(spark, A.finalized(messages(spark, d)).select("event_id", "dir"))


@query("m2_first_arrivals", "SELECT DISTINCT split_part(object_id, '/', 2) AS dir FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE'")
def m2(spark, d):
    return drained(spark, A.first_arrivals(A.finalized(messages(spark, d))))


@query("m2_first_arrivals_expiring", "SELECT DISTINCT split_part(object_id, '/', 2) AS dir FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE'")
def m2_expiring(spark, d):
    # Longer than the table's span of time, so that no state expires early.
    return drained(spark, A.first_arrivals_within(A.finalized(messages(spark, d)), "3650 days").select("dir"))


@query(
    "m3_block_list",
    "SELECT event_id, split_part(object_id, '/', 2) AS dir FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE' AND split_part(object_id, '/', 2) NOT IN (SELECT user_id::VARCHAR FROM events WHERE value > 200)",
)
def m3(spark, d):
    blocked = X.table(spark, d, "events").filter("value > 200").select(F.col("user_id").cast("string").alias("dir")).distinct()
    return drained(spark, A.without_blocked(A.finalized(messages(spark, d)), blocked).select("event_id", "dir"))


@query(
    "m4_restart_emits_nothing",
    "SELECT count(DISTINCT split_part(object_id, '/', 2)) AS first_run, 0::BIGINT AS second_run FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE'",
)
def m4(spark, d):
    out, check = scratch_path(spark, "stream"), scratch_path(spark, "check")
    A.drain_to(A.first_arrivals(A.finalized(messages(spark, d))), out, check)
    first = spark.read.parquet(out).agg(F.count("*").alias("first_run")).first()["first_run"]
    A.drain_to(A.first_arrivals(A.finalized(messages(spark, d))), out, check)
    return spark.read.parquet(out).agg(F.lit(first).cast("bigint").alias("first_run"), (F.count("*") - first).alias("second_run"))


@query("m4_earliest_per_directory", "SELECT split_part(object_id, '/', 2) AS dir, arg_min(event_id, (ts, event_id)) AS event_id FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE' GROUP BY 1")
def m4_first(spark, d):
    out, check = scratch_path(spark, "seen"), scratch_path(spark, "check")
    A.publish_new(A.finalized(messages(spark, d)), A.seen_table_publisher(out), check)
    return spark.read.parquet(out).select(F.col("dir").cast("string").alias("dir"), "event_id")


@query("m5_payload", "SELECT event_id, props AS text, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def m5(spark, d):
    rows = A.read_events(spark, d).select("event_id", F.encode("props", "utf-8").alias("data"))
    return drained(spark, A.decoded(rows).select("event_id", "text", "k"))


@query(
    "m6_rank_on_arrival",
    """SELECT resume_id, job_id, status::BIGINT AS status FROM v_ranked WHERE job_id IN
    (SELECT split_part(object_id, '/', 2)::BIGINT % (SELECT n_jobs FROM v_size) FROM v_arrivals WHERE event_type = 'OBJECT_FINALIZE')""",
)
def m6(spark, d):
    out, check = scratch_path(spark, "ranked"), scratch_path(spark, "check")

    def score(touched):
        return S.rank_resumes(X.scores(spark, d).join(touched, "job_id", "left_semi")).select("resume_id", "job_id", "status")

    A.publish_new(messages(spark, d), P.rank_on_arrival(score, out, X.n_jobs(spark, d)), check)
    return A.newest_versions(spark, out, "job_id").select("resume_id", "job_id", "status")


# ---- end-to-end flows --------------------------------------------------------------------


@query("flow_scores_from_answers", "SELECT resume_id, job_id, skills::DOUBLE AS skills, experience::DOUBLE AS experience, 50.0::DOUBLE AS education, 50.0::DOUBLE AS projects FROM v_scores")
def flow_answers(spark, d):
    raw = F.to_json(F.struct(F.struct("skills", F.col("experience").cast("string").alias("experience"), F.lit("n/a").alias("education")).alias("scores")))
    return P.scores_from_answers(X.scores(spark, d).select("resume_id", "job_id", raw.alias("raw")), "raw")
