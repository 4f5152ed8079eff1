"""Queries for scoring, vector search, Borda counts and pairwise ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import vectors as V
from rankloom.functions.portable import hash32
from rankloom.operators import matching as M
from rankloom.operators import pairwise as P
from rankloom.operators import scoring as S
from rankloom.operators.spread import lookup_join, top_k
from rankloom.plans import fixtures as X
from rankloom.plans.registry import query

# ---- weighted scores -----------------------------------------------------------


@query("g1_weighted_overall", "SELECT resume_id, ((40 * skills + 30 * experience + 15 * education + 15 * projects + 5) // 10) / 10.0::DOUBLE AS overall FROM v_scores")
def g1(spark, d):
    return S.overall(X.scores(spark, d)).select("resume_id", "overall")


PROB = "(('0x' || substr(md5('prob:' || resume_id), 1, 8))::BIGINT % 10001)"


@query(
    "g3_blend",
    f"""SELECT resume_id, (floor((((40 * skills + 30 * experience + 15 * education + 15 * projects + 5) // 10) * 60 + {PROB} * 4 + 50) / 100) / 10)::DOUBLE AS overall FROM v_scores""",
)
def g3(spark, d):
    p = hash32("prob", "resume_id") % 10001 / F.lit(10000.0)
    return S.overall(X.scores(spark, d)).select("resume_id", S.blend(F.col("overall"), p).alias("overall"))


@query("g4_fit_flag", "SELECT resume_id, overall::DOUBLE AS overall, overall >= 40 AS fit FROM v_ranked")
def g4(spark, d):
    return S.overall(X.scores(spark, d)).select("resume_id", "overall", S.is_fit(F.col("overall")).alias("fit"))


@query(
    "g5_rank_resumes",
    "SELECT resume_id, job_id, overall::DOUBLE AS overall, fit, status::BIGINT AS status, (overall * 10 / 1000)::DOUBLE AS fit_probability FROM v_ranked",
)
def g5(spark, d):
    return S.rank_resumes(X.scores(spark, d)).select("resume_id", "job_id", "overall", "fit", "status", "fit_probability")


# ---- vectors -------------------------------------------------------------------

MATCHES = """matches AS (SELECT * FROM (SELECT job_id, section, candidate_id, similarity,
      row_number() OVER (PARTITION BY job_id, section ORDER BY similarity DESC, candidate_id) AS rank
      FROM (SELECT s.job_id, s.section, s.candidate_id, round(list_cosine_similarity(s.embedding::DOUBLE[], j.job_embedding::DOUBLE[]), 6) AS similarity
        FROM v_applied s JOIN v_job_vectors j ON s.job_id = j.job_id)) WHERE rank <= 100),
    points AS (SELECT *, count(*) OVER (PARTITION BY job_id, section) - rank + 1 AS points FROM matches)"""


def matches(spark, d):
    return M.section_matches(X.applied(spark, d), X.job_vectors(spark, d))


def points(spark, d):
    return M.borda_points(matches(spark, d))


@query("d1_section_search", f"WITH {MATCHES} SELECT job_id, section, candidate_id, similarity, rank FROM matches")
def d1(spark, d):
    return matches(spark, d)


@query(
    "c9_nearest_join",
    f"WITH {MATCHES} SELECT job_id, section, candidate_id, rank FROM matches WHERE rank <= 5",
)
def c9(spark, d):
    return M.section_matches(X.applied(spark, d), X.job_vectors(spark, d), k=5).drop("similarity")


@query(
    "d6_pair_cosine",
    """SELECT s.vec_id, round(list_cosine_similarity(s.embedding::DOUBLE[], j.job_embedding::DOUBLE[]), 6) AS cosine
    FROM v_sections s JOIN v_job_vectors j ON s.job_id = j.job_id""",
)
def d6(spark, d):
    both = lookup_join(X.sections(spark, d), X.job_vectors(spark, d), ["job_id"])
    return both.select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("job_embedding")), 6).alias("cosine"))


@query(
    "b14_pair_features",
    """SELECT s.vec_id, length(list_concat(s.embedding, j.job_embedding)) AS dim, round(s.embedding[1]::DOUBLE, 6) AS first_value,
    round(j.job_embedding[64]::DOUBLE, 6) AS last_value FROM v_sections s JOIN v_job_vectors j ON s.job_id = j.job_id""",
)
def b14(spark, d):
    both = M.pair_features(X.sections(spark, d), X.job_vectors(spark, d), ["job_id"], "embedding", "job_embedding")
    f = F.col("features")
    return both.select(
        "vec_id",
        F.size(f).cast("bigint").alias("dim"),
        F.round(F.element_at(f, 1), 6).alias("first_value"),
        F.round(F.element_at(f, -1), 6).alias("last_value"),
    )


@query(
    "b15_dimension_contract",
    "SELECT quarantined, count(*) AS n, min(dim) AS min_dim, max(dim) AS max_dim FROM (SELECT CASE WHEN vec_id % 50 = 0 THEN 63 ELSE 64 END::BIGINT AS dim, vec_id % 50 = 0 AS quarantined FROM embeddings) GROUP BY quarantined",
)
def b15(spark, d):
    cut = F.when(F.col("vec_id") % 50 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    rows = M.dimension_split(X.table(spark, d, "embeddings").withColumn("embedding", cut), "embedding", 64)
    return rows.groupBy("quarantined").agg(F.count("*").alias("n"), F.min("dim").alias("min_dim"), F.max("dim").alias("max_dim"))


@query("b15_shape_report", "SELECT count(*) AS n_rows, min(length(embedding)) AS min_dim, max(length(embedding)) AS max_dim FROM embeddings")
def b15_shape(spark, d):
    return M.shape_report(X.table(spark, d, "embeddings"), "embedding")


@query(
    "a8_vector_text",
    "SELECT event_id, 3::BIGINT AS dim, event_id::DOUBLE AS v1, value AS v2, (event_id % 7) + 0.5::DOUBLE AS v3 FROM events",
)
def a8(spark, d):
    i = F.col("event_id").cast("string")
    text = F.concat(F.lit("["), i, F.lit("  "), F.col("value").cast("string"), F.lit("\n "), (F.col("event_id") % 7).cast("string"), F.lit(".5]"))
    v = X.table(spark, d, "events").select("event_id", V.parse_vector_text(text).alias("v"))
    return v.select("event_id", F.size("v").cast("bigint").alias("dim"), *[F.element_at("v", k).alias(f"v{k}") for k in (1, 2, 3)])


# ---- Borda -----------------------------------------------------------------------


@query("g6_borda_points", f"WITH {MATCHES} SELECT job_id, section, candidate_id, rank, points FROM points")
def g6(spark, d):
    return points(spark, d).drop("similarity")


WEIGHT = "CASE section WHEN 'education' THEN 20 WHEN 'workexp' THEN 60 WHEN 'personal_projects' THEN 15 WHEN 'misc' THEN 5 ELSE 0 END"


@query("g7_weighted_borda", f"WITH {MATCHES} SELECT job_id, candidate_id, sum(points * {WEIGHT})::BIGINT / 100 AS borda FROM points GROUP BY job_id, candidate_id")
def g7(spark, d):
    return M.weighted_borda(points(spark, d))


@query(
    "c3_densify",
    f"""WITH {MATCHES} SELECT c.job_id, c.candidate_id, s.section, coalesce(p.points, 0)::BIGINT AS points FROM
    (SELECT DISTINCT job_id, candidate_id FROM points) c CROSS JOIN (SELECT unnest(['education', 'workexp', 'personal_projects', 'misc']) AS section) s
    LEFT JOIN points p ON p.job_id = c.job_id AND p.candidate_id = c.candidate_id AND p.section = s.section""",
)
def c3(spark, d):
    return M.dense_points(points(spark, d), X.SECTIONS)


WIDE = f"""wide AS (SELECT job_id, candidate_id, coalesce(max(points) FILTER (section = 'education'), 0) AS education,
    coalesce(max(points) FILTER (section = 'workexp'), 0) AS workexp, coalesce(max(points) FILTER (section = 'personal_projects'), 0) AS personal_projects,
    coalesce(max(points) FILTER (section = 'misc'), 0) AS misc FROM points GROUP BY job_id, candidate_id)"""


@query("c4_section_row", f"WITH {MATCHES}, {WIDE} SELECT * FROM wide")
def c4(spark, d):
    return M.section_row(points(spark, d), X.SECTIONS)


@query(
    "g8_borda_ranking",
    f"""WITH {MATCHES}, {WIDE}, t AS (SELECT *, (20 * education + 60 * workexp + 15 * personal_projects + 5 * misc) / 100 AS borda FROM wide)
    SELECT job_id, candidate_id, borda, row_number() OVER (PARTITION BY job_id ORDER BY borda DESC, candidate_id) AS status,
    '{{"education":' || education || ',"workexp":' || workexp || ',"personal_projects":' || personal_projects || ',"misc":' || misc || '}}' AS section_scores FROM t""",
)
def g8(spark, d):
    return M.borda_ranking(points(spark, d), X.SECTIONS)


# ---- pairwise ----------------------------------------------------------------------

PAIRS = """items AS MATERIALIZED (SELECT job_id, resume_id, n_chars, row_number() OVER (PARTITION BY job_id ORDER BY resume_id) - 1 AS pos,
      count(*) OVER (PARTITION BY job_id) AS n FROM v_resumes),
    quotas AS (SELECT *, (floor(0.35::DOUBLE * ((pos + 1) * (2 * n - pos - 2) // 2)) - floor(0.35::DOUBLE * (pos * (2 * n - pos - 1) // 2)))::BIGINT AS quota,
      n - 1 - pos AS partners, ('0x' || substr(md5('pair:' || job_id || ':' || pos), 1, 8))::BIGINT AS h FROM items),
    drawn AS (SELECT job_id, resume_id AS left_id, n_chars AS left_n, partners, quota, pos, h, unnest(range(quota)) AS i FROM quotas WHERE quota > 0),
    pairs AS MATERIALIZED (SELECT d.job_id, d.left_id, r.resume_id AS right_id, d.left_n, r.n_chars AS right_n FROM drawn d JOIN items r
      ON r.job_id = d.job_id AND r.pos = d.pos + 1 + (d.i * d.partners // d.quota + d.h % d.partners) % d.partners),
    verdicts AS (SELECT *, CASE WHEN left_n >= right_n THEN 'Resume 1' ELSE 'Resume 2' END AS answer,
      ('0x' || substr(md5('noise:' || left_id || ':' || right_id), 1, 8))::BIGINT % 20 = 0 AS noisy FROM pairs),
    compared AS MATERIALIZED (SELECT *, CASE answer WHEN 'Resume 1' THEN left_id ELSE right_id END AS winner,
      CASE answer WHEN 'Resume 1' THEN right_id ELSE left_id END AS loser FROM verdicts)"""


def sampled(spark, d, places=False):
    return P.sample_pairs(X.resumes(spark, d), "job_id", "resume_id", carry=["n_chars"], places=places)


def verdicts(spark, d, places=False):
    """Sampled pairs judged by length: the longer text wins, ties go to the first."""
    longer = F.when(F.col("left_n_chars") >= F.col("right_n_chars"), "Resume 1").otherwise("Resume 2")
    return sampled(spark, d, places).select("job_id", "left_id", "right_id", longer.alias("answer"), *(P.PLACE if places else []))


def answers(spark, d, places=False):
    """Verdicts with some unusable answers mixed in, validated."""
    raw = F.when(hash32("noise", "left_id", "right_id") % 20 == 0, "not sure").otherwise(F.concat(F.col("answer"), F.lit(" ")))
    good, is_default = P.checked_answer(F.col("raw_answer"))
    return verdicts(spark, d, places).withColumn("raw_answer", raw).withColumn("answer", good).withColumn("is_default", is_default)


def compared(spark, d):
    """Comparisons that know their places, so that the steps do not shuffle them."""
    return P.comparisons(verdicts(spark, d, places=True))


@query("c5_unordered_pairs", f"WITH {PAIRS} SELECT job_id, left_id, right_id FROM pairs")
def c5(spark, d):
    return sampled(spark, d).select("job_id", "left_id", "right_id")


@query(
    "g9_pair_sampling",
    "SELECT job_id, floor(0.35::DOUBLE * (count(*) * (count(*) - 1) // 2))::BIGINT AS n_pairs FROM v_resumes GROUP BY job_id",
)
def g9(spark, d):
    pair = [F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b")]
    # Equal pairs lie in one tile: they are told apart where they were made.
    rows = sampled(spark, d, places=True).select("job_id", "tile_lo", "tile_hi", *pair)
    return rows.distinct().groupBy("job_id").agg(F.count("*").alias("n_pairs"))


@query(
    "c8_drop_failed_pairs",
    f"""WITH {PAIRS} SELECT job_id, left_id, right_id FROM pairs WHERE left_id NOT IN (SELECT resume_id FROM v_resumes WHERE n_chars < 300)
    AND right_id NOT IN (SELECT resume_id FROM v_resumes WHERE n_chars < 300)""",
)
def c8(spark, d):
    failed = X.resumes(spark, d).filter(F.col("n_chars") < 300)
    return P.drop_failed(sampled(spark, d).select("job_id", "left_id", "right_id"), failed, "resume_id").select("job_id", "left_id", "right_id")


@query(
    "f7_answer_check",
    f"WITH {PAIRS} SELECT job_id, left_id, right_id, CASE WHEN noisy THEN 'Resume 1' ELSE answer END AS answer, noisy AS is_default FROM verdicts",
)
def f7(spark, d):
    return answers(spark, d).select("job_id", "left_id", "right_id", "answer", "is_default")


@query("g10_winner_loser", f"WITH {PAIRS} SELECT job_id, winner, loser FROM compared")
def g10(spark, d):
    return compared(spark, d).select("job_id", "winner", "loser")


def _step(prev: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT i.job_id, i.item, greatest(i.wins / l.load, 0.001) AS strength FROM won i JOIN
      (SELECT job_id, item, sum(share) AS load FROM (SELECT c.job_id, unnest([c.winner, c.loser]) AS item, 1 / (a.strength + b.strength) AS share
        FROM compared c JOIN {prev} a ON a.job_id = c.job_id AND a.item = c.winner JOIN {prev} b ON b.job_id = c.job_id AND b.item = c.loser)
        GROUP BY job_id, item) l ON l.job_id = i.job_id AND l.item = i.item)"""


FIT3 = f"""{PAIRS}, won AS MATERIALIZED (SELECT job_id, item, count(*) FILTER (is_win)::DOUBLE AS wins FROM (SELECT job_id, winner AS item, true AS is_win FROM compared
      UNION ALL SELECT job_id, loser, false FROM compared) GROUP BY job_id, item),
    s0 AS (SELECT job_id, item, 1.0::DOUBLE AS strength FROM won), {_step('s0', 's1')}, {_step('s1', 's2')}, {_step('s2', 's3')},
    means AS (SELECT job_id, avg(ln(strength)) AS mean_log FROM s3 GROUP BY job_id),
    norm AS (SELECT s.job_id, s.item, m.mean_log, s.strength / exp(m.mean_log) AS strength FROM s3 s JOIN means m ON m.job_id = s.job_id)"""


def fitted3(spark, d):
    # A few passes: pairs are never written, only their bits.
    with P.laid_pairs(compared(spark, d), "job_id", written=False) as done:
        return P.fit_strengths(done, "job_id", max_steps=3, tolerance=None)


@query("g11_bradley_terry_3_steps", f"WITH {FIT3} SELECT job_id, item, round(strength, 6) AS strength FROM s3")
def g11(spark, d):
    return fitted3(spark, d).select("job_id", "item", F.round("strength", 6).alias("strength"))


@query("g11_bradley_terry_converged")
def g11_full(spark, d):
    fit = P.fit_strengths(compared(spark, d), "job_id")
    return P.ranked_strengths(P.normalised(fit, "job_id"), "job_id").select("job_id", "item", "score", "rank")


@query(
    "g11_fit_report",
    f"""WITH RECURSIVE {FIT3}, near AS (SELECT DISTINCT job_id, winner AS item, loser AS other FROM compared UNION SELECT DISTINCT job_id, loser, winner FROM compared),
    reach AS (SELECT job_id, item, item AS other FROM near UNION SELECT r.job_id, r.item, n.other FROM reach r JOIN near n ON n.job_id = r.job_id AND n.item = r.other),
    parts AS (SELECT job_id, count(DISTINCT low) AS n_components FROM (SELECT job_id, item, min(other) AS low FROM reach GROUP BY job_id, item) GROUP BY job_id),
    moves AS (SELECT b.job_id, count(*) AS n_items, round(max(abs(b.strength - a.strength) / a.strength), 6) AS largest_move
      FROM s3 b JOIN s2 a ON a.job_id = b.job_id AND a.item = b.item GROUP BY b.job_id)
    SELECT m.job_id, n_items, n_components, largest_move, 3::INTEGER AS steps FROM moves m JOIN parts p ON p.job_id = m.job_id""",
)
def g11_report(spark, d):
    with P.laid_pairs(compared(spark, d), "job_id", written=False) as done:
        fit = P.fit(done, "job_id", max_steps=3, tolerance=None)
        linked = P.components(done, "job_id")
    parts = linked.groupBy("job_id").agg(F.count_distinct("component").alias("n_components"))
    return fit.moves.join(parts, "job_id").select("job_id", "n_items", "n_components", F.round("largest_move", 6).alias("largest_move"), F.lit(fit.steps).alias("steps"))


@query(
    "g12_neg_log_likelihood",
    f"""WITH {FIT3} SELECT c.job_id, round(-sum(ln(a.strength / (a.strength + b.strength))), 4) AS nll, count(*) AS n FROM compared c
    JOIN s3 a ON a.job_id = c.job_id AND a.item = c.winner JOIN s3 b ON b.job_id = c.job_id AND b.item = c.loser GROUP BY c.job_id""",
)
def g12(spark, d):
    from rankloom.session import cut_lineage

    with P.laid_pairs(compared(spark, d), "job_id", written=False) as done:
        strengths = P.fit_strengths(done, "job_id", max_steps=3, tolerance=None)
        return cut_lineage(P.negative_log_likelihood(done, strengths, "job_id"))


@query("g13_geometric_mean", f"WITH {FIT3} SELECT job_id, item, round(strength, 6) AS strength FROM norm")
def g13(spark, d):
    return P.normalised(fitted3(spark, d), "job_id").select("job_id", "item", F.round("strength", 6).alias("strength"))


@query(
    "g14_strength_ranking",
    f"""WITH {FIT3} SELECT job_id, item, round(strength, 6) AS score, row_number() OVER (PARTITION BY job_id ORDER BY round(strength, 6) DESC, item) AS rank FROM norm""",
)
def g14(spark, d):
    ranked = P.ranked_strengths(P.normalised(fitted3(spark, d), "job_id"), "job_id")
    return ranked.select("job_id", "item", "score", "rank")


@query(
    "g14_top_ten",
    f"""WITH {FIT3} SELECT job_id, item, score, rank FROM (SELECT job_id, item, round(strength, 6) AS score,
    row_number() OVER (PARTITION BY job_id ORDER BY round(strength, 6) DESC, item) AS rank FROM norm) WHERE rank <= 10""",
)
def g14_top(spark, d):
    rows = P.normalised(fitted3(spark, d), "job_id").select("job_id", "item", F.round("strength", 6).alias("score"))
    return top_k(rows, ["job_id"], [F.desc("score"), F.col("item")], 10)


@query(
    "g15_positional_bias",
    f"""WITH {PAIRS} SELECT job_id, count(*) AS n, count(*) FILTER (answer = 'Resume 1') AS n_first,
    round(count(*) FILTER (answer = 'Resume 1') / count(*), 6) AS bias FROM verdicts GROUP BY job_id""",
)
def g15(spark, d):
    return P.positional_bias(verdicts(spark, d), "job_id")


@query(
    "g16_error_budget",
    f"""WITH {PAIRS} SELECT job_id, count(*) AS n, count(*) FILTER (noisy) AS n_errors, greatest(50, count(*) // 10)::BIGINT AS budget,
    count(*) FILTER (noisy) >= greatest(50, count(*) // 10) AS stopped FROM verdicts GROUP BY job_id""",
)
def g16(spark, d):
    return P.error_budget(answers(spark, d), "job_id")


@query(
    "g16_within_budget",
    f"""WITH {PAIRS}, run AS (SELECT *, count(*) FILTER (noisy) OVER (PARTITION BY job_id ORDER BY left_id, right_id ROWS UNBOUNDED PRECEDING) AS errors_so_far,
      greatest(3, count(*) OVER (PARTITION BY job_id) // 10) AS budget FROM verdicts)
    SELECT job_id, left_id, right_id, errors_so_far FROM run WHERE errors_so_far - noisy::INT < budget""",
)
def g16_run(spark, d):
    return P.within_budget(answers(spark, d, places=True), "job_id", at_least=3).select("job_id", "left_id", "right_id", "errors_so_far")


@query(
    "w8_mean_of_logs",
    f"WITH {FIT3} SELECT job_id, item, round(mean_log, 6) AS mean_log FROM norm",
)
def w8(spark, d):
    return P.normalised(fitted3(spark, d), "job_id").select("job_id", "item", F.round("mean_log", 6).alias("mean_log"))
