"""Tables of the matching domain, read from the supplied test tables.

``VIEW_SQL`` holds the same definitions for the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.portable import hash32

#: Postings a candidate applies to: the first POPULAR ones get everybody, the others an even share.
APPLICATIONS = 8
POPULAR = 2

SECTIONS = ["education", "workexp", "personal_projects", "misc"]

N_JOBS_SQL = "(SELECT n_jobs FROM v_size)"

VIEW_SQL = {
    "v_size": "SELECT greatest(count(*), 1) AS n_jobs FROM benchmark",
    "v_jobs": "SELECT item_id AS job_id, text AS job_text, item_id % 7 AS user_id FROM benchmark",
    "v_resumes": f"SELECT doc_id AS resume_id, doc_id % {N_JOBS_SQL} AS job_id, text AS resume_text, "
    "source || '_' || doc_id || '.pdf' AS filename, n_chars FROM documents",
    "v_pairs": "SELECT r.resume_id AS pair_id, r.job_id, r.resume_text, j.job_text AS job_description_text, "
    "CASE WHEN l.toxic = 1 THEN 'Potential Fit' WHEN l.quality = 1 THEN 'Good Fit' ELSE 'No Fit' END AS label "
    "FROM v_resumes r JOIN v_jobs j ON r.job_id = j.job_id JOIN labels l ON l.doc_id = r.resume_id",
    "v_feedback": "SELECT event_id, ts, user_id AS resume_id, CASE event_type WHEN 'purchase' THEN 1 "
    "WHEN 'error' THEN -1 WHEN 'view' THEN NULL ELSE 0 END AS feedback_label FROM events",
    "v_mixed_labels": "SELECT event_id, CASE event_id % 9 WHEN 0 THEN '1' WHEN 1 THEN '-1' WHEN 2 THEN '0' "
    "WHEN 3 THEN 'Good Fit' WHEN 4 THEN 'neutral' WHEN 5 THEN 'x' WHEN 6 THEN NULL WHEN 7 THEN 'No Fit' "
    "ELSE 'Potential Fit' END AS label FROM events",
    "v_sections": f"SELECT vec_id, vec_id // 4 AS candidate_id, (vec_id // 4) % {N_JOBS_SQL} AS job_id, CASE vec_id % 4 "
    "WHEN 0 THEN 'education' WHEN 1 THEN 'workexp' WHEN 2 THEN 'personal_projects' ELSE 'misc' END AS section, "
    "embedding, label FROM embeddings",
    "v_applied": "SELECT vec_id, candidate_id, section, embedding, label, unnest(list_distinct(list_concat("
    f"list_transform(range({POPULAR}), lambda a: a % n_jobs), list_transform(range({APPLICATIONS - POPULAR}), "
    f"lambda a: (candidate_id + a * greatest(n_jobs // {APPLICATIONS - POPULAR}, 1)) % n_jobs)))) AS job_id FROM v_sections, v_size",
    "v_job_vectors": "SELECT vec_id AS job_id, embedding AS job_embedding FROM embeddings",
    "v_scores": "SELECT resume_id, job_id, (37 * resume_id + 11) % 101 AS skills, (53 * resume_id + 7) % 101 AS experience, "
    "(71 * resume_id + 3) % 101 AS education, (29 * resume_id + 19) % 101 AS projects, resume_id % 9 AS missing FROM v_resumes",
    "v_ranked": "SELECT *, CASE WHEN fit THEN row_number() OVER (PARTITION BY job_id, fit ORDER BY overall DESC, resume_id) "
    "ELSE -1 END AS status FROM (SELECT *, overall >= 40 AS fit FROM (SELECT *, "
    "((40 * skills + 30 * experience + 15 * education + 15 * projects + 5) // 10) / 10.0 AS overall FROM v_scores))",
    "v_raw_json": "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '{\"k\": ' || event_id ELSE props END AS raw FROM events",
    "v_arrivals": "SELECT event_id, ts, CASE WHEN event_type = 'signup' THEN 'OBJECT_FINALIZE' ELSE upper(event_type) END "
    "AS event_type, 'resumes/' || user_id || '/' || event_id || '_cv.pdf' AS object_id FROM events",
    "v_runs": "SELECT event_id AS run_id, event_type AS experiment, value / 500 AS accuracy, ts AS start_time FROM events",
    "v_pred": f"SELECT doc_id, doc_id % {N_JOBS_SQL} AS qid, quality AS y, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat "
    "FROM (SELECT doc_id, quality, (('0x' || substr(md5('score:' || doc_id), 1, 8))::BIGINT % 101) / 100.0::DOUBLE AS score FROM labels)",
    "v_lexicon": "SELECT token, CASE ('0x' || substr(md5('kind:' || token), 1, 8))::BIGINT % 3 WHEN 0 THEN 'ORG' "
    "WHEN 1 THEN 'GPE' ELSE 'NORP' END AS kind FROM (SELECT DISTINCT token FROM (SELECT "
    "unnest(regexp_extract_all(lower(job_text), '[a-z0-9_]{2,}')) AS token FROM v_jobs) WHERE length(token) >= 3)",
}

_FOLDED = (
    "list_transform(regexp_extract_all({t}, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda p: CASE WHEN regexp_matches(p, '^[A-Za-z0-9_]') "
    "THEN lower(p) WHEN regexp_matches(p, '^[ \\t\\r\\n-]+$') THEN ' ' ELSE chr(1) END)"
)
_PIECES = (
    "SELECT {k}, unnest(regexp_extract_all({t}, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+')) AS piece, unnest(cut) AS t, unnest(range(length(cut))) AS pos "
    f"FROM (SELECT *, {_FOLDED} AS cut FROM {{v}})"
)
_GRAMS = (
    "SELECT {k}, pos, 2 AS n, t || lead(t, 1) OVER w || lead(t, 2) OVER w AS phrase FROM {v} WINDOW w AS (PARTITION BY {k} ORDER BY pos) UNION ALL "
    "SELECT {k}, pos, 3, t || lead(t, 1) OVER w || lead(t, 2) OVER w || lead(t, 3) OVER w || lead(t, 4) OVER w FROM {v} WINDOW w AS (PARTITION BY {k} ORDER BY pos)"
)
# Every piece of every text, and every place where a term stands.
VIEW_SQL["v_pieces"] = _PIECES.format(k="resume_id", t="resume_text", v="v_resumes")
VIEW_SQL["v_job_pieces"] = _PIECES.format(k="job_id", t="job_text", v="v_jobs")
VIEW_SQL["v_phrases"] = (
    "SELECT DISTINCT phrase, n, CASE ('0x' || substr(md5('phrase:' || phrase), 1, 8))::BIGINT % 3 WHEN 0 THEN 'NAME' WHEN 1 THEN 'ADDRESS' "
    f"ELSE 'ORG' END AS kind FROM ({_GRAMS.format(k='job_id', v='v_job_pieces')}) WHERE regexp_full_match(phrase, '[a-z0-9_]+( [a-z0-9_]+){{1,2}}')"
)
VIEW_SQL["v_spans"] = (
    "SELECT g.resume_id, g.pos AS s, g.pos + 2 * g.n - 1 AS e, x.phrase, x.kind "
    f"FROM ({_GRAMS.format(k='resume_id', v='v_pieces')}) g JOIN v_phrases x ON x.phrase = g.phrase AND x.n = g.n"
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def n_jobs(spark: SparkSession, d: str) -> int:
    """Number of postings, which resumes and candidates are dealt to; read from file footers."""
    return max(1, table(spark, d, "benchmark").count())


def jobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(
        F.col("item_id").alias("job_id"), F.col("text").alias("job_text"), (F.col("item_id") % 7).alias("user_id")
    )


def resumes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("resume_id"),
        (F.col("doc_id") % n_jobs(spark, d)).alias("job_id"),
        F.col("text").alias("resume_text"),
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"),
        "n_chars",
    )


def texts(spark: SparkSession, d: str) -> DataFrame:
    """Resumes for work on their texts."""
    from rankloom.operators.spread import spread_small

    return spread_small(resumes(spark, d), "resume_id")


def pairs(spark: SparkSession, d: str) -> DataFrame:
    from rankloom.operators.spread import lookup_join

    lab = table(spark, d, "labels").select(
        F.col("doc_id").alias("resume_id"),
        F.when(F.col("toxic") == 1, "Potential Fit").when(F.col("quality") == 1, "Good Fit").otherwise("No Fit").alias("label"),
    )
    labelled = texts(spark, d).select("resume_id", "job_id", "resume_text").join(lab, "resume_id")
    return lookup_join(labelled, jobs(spark, d).select("job_id", "job_text"), ["job_id"]).select(
        F.col("resume_id").alias("pair_id"), "job_id", "resume_text", F.col("job_text").alias("job_description_text"), "label"
    )


def feedback(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        F.col("user_id").alias("resume_id"),
        F.when(kind == "purchase", 1).when(kind == "error", -1).when(kind == "view", F.lit(None)).otherwise(0).alias("feedback_label"),
    )


def mixed_labels(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("event_id") % 9
    values = ["1", "-1", "0", "Good Fit", "neutral", "x", None, "No Fit"]
    label = F.when(r == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        label = label.when(r == i, F.lit(v))
    return table(spark, d, "events").select("event_id", label.otherwise("Potential Fit").alias("label"))


def sections(spark: SparkSession, d: str) -> DataFrame:
    cand = F.floor(F.col("vec_id") / 4).cast("bigint")
    part = F.element_at(F.array(*[F.lit(s) for s in SECTIONS]), (F.col("vec_id") % 4 + 1).cast("int"))
    return table(spark, d, "embeddings").select(
        "vec_id", cand.alias("candidate_id"), (cand % n_jobs(spark, d)).alias("job_id"), part.alias("section"), "embedding", "label"
    )


def applied(spark: SparkSession, d: str) -> DataFrame:
    """Sections once for every posting that their candidate applies to."""
    n = n_jobs(spark, d)
    step = max(1, n // (APPLICATIONS - POPULAR))
    wanted = [F.lit(a % n).cast("bigint") for a in range(POPULAR)] + [(F.col("candidate_id") + a * step) % n for a in range(APPLICATIONS - POPULAR)]
    return sections(spark, d).withColumn("job_id", F.explode(F.array_distinct(F.array(*wanted))))


def job_vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("job_id"), F.col("embedding").alias("job_embedding"))


def scores(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("resume_id")
    return resumes(spark, d).select(
        "resume_id",
        "job_id",
        ((i * 37 + 11) % 101).alias("skills"),
        ((i * 53 + 7) % 101).alias("experience"),
        ((i * 71 + 3) % 101).alias("education"),
        ((i * 29 + 19) % 101).alias("projects"),
        (i % 9).alias("missing"),
    )


def raw_json(spark: SparkSession, d: str) -> DataFrame:
    broken = F.concat(F.lit('{"k": '), F.col("event_id").cast("string"))
    return table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, broken).otherwise(F.col("props")).alias("raw")
    )


def arrivals_of(events: DataFrame) -> DataFrame:
    """Arrival messages from an ``events`` frame, batch or streaming."""
    return events.select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "signup", "OBJECT_FINALIZE").otherwise(F.upper("event_type")).alias("event_type"),
        F.concat(
            F.lit("resumes/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string"), F.lit("_cv.pdf")
        ).alias("object_id"),
    )


def arrivals(spark: SparkSession, d: str) -> DataFrame:
    return arrivals_of(table(spark, d, "events"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("experiment"), (F.col("value") / 500).alias("accuracy"), F.col("ts").alias("start_time")
    )


def predictions(spark: SparkSession, d: str) -> DataFrame:
    score = hash32("score", "doc_id") % 101 / F.lit(100.0)
    return table(spark, d, "labels").select("doc_id", (F.col("doc_id") % n_jobs(spark, d)).alias("qid"), F.col("quality").alias("y"), score.alias("score")).withColumn(
        "yhat", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def lexicon(spark: SparkSession, d: str) -> DataFrame:
    """Terms of three letters or more, typed by hash: the test text is invented, so
    its lexicon is made of all words of the postings, and written once."""
    from rankloom.functions.text import word_tokens
    from rankloom.session import cut_lineage

    kinds = F.array(F.lit("ORG"), F.lit("GPE"), F.lit("NORP"))
    words = jobs(spark, d).select(F.explode(F.array_distinct(word_tokens(F.col("job_text")))).alias("token"))
    terms = words.filter(F.length("token") >= 3).distinct()
    return cut_lineage(terms.select("token", F.element_at(kinds, (hash32("kind", "token") % 3 + 1).cast("int")).alias("kind")))


def phrases(spark: SparkSession, d: str) -> DataFrame:
    """All two- and three-word phrases of the postings, typed by hash, written once."""
    from rankloom.operators.phrase_lexicon import folded, pieces
    from rankloom.session import cut_lineage

    kinds = F.array(F.lit("NAME"), F.lit("ADDRESS"), F.lit("ORG"))
    cut = jobs(spark, d).select(folded(pieces(F.col("job_text"))).alias("_cut"))

    def grams_of(n: int):
        return F.transform("_cut", lambda p, i: F.array_join(F.slice("_cut", i + 1, 2 * n - 1), ""))

    grams = F.concat(grams_of(2), grams_of(3))
    rows = cut.select(F.explode(F.array_distinct(grams)).alias("phrase")).filter(F.col("phrase").rlike("^[a-z0-9_]+( [a-z0-9_]+){1,2}$")).distinct()
    return cut_lineage(rows.select("phrase", F.element_at(kinds, (hash32("phrase", "phrase") % 3 + 1).cast("int")).alias("kind")))
