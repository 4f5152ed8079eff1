"""End-to-end flows: score and rank, react to arrivals, assemble training sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.structured import score_or
from rankloom.functions.text import redact
from rankloom.operators import extraction as E
from rankloom.operators import learning as G
from rankloom.operators import matching as M
from rankloom.operators import scoring as S
from rankloom.session import cut_lineage
from rankloom.streaming.arrivals import finalized


def section_scores(profile: DataFrame, required: DataFrame) -> DataFrame:
    """Whole-point section scores from profile and requirements: shared skills,
    years against the minimum, degree against the one asked for, projects."""
    from rankloom.operators.spread import lookup_join

    ladder = F.create_map(*[F.lit(x) for kv in {"None": 0, "Bachelor's": 1, "Master's": 2, "PhD": 3}.items() for x in kv])
    need = required.select("job_id", "required_skills", "min_years_experience", "education_required")
    both = lookup_join(profile, need, ["job_id"])
    wanted, shared = F.size("required_skills"), F.size(F.array_intersect("required_skills", "skills"))
    gap = F.array_except("required_skills", "skills")
    return both.select(
        "resume_id",
        "job_id",
        F.when(wanted == 0, 50).otherwise(F.floor(shared * 100 / F.greatest(wanted, F.lit(1)))).cast("bigint").alias("skills"),
        F.when(F.col("min_years_experience") == 0, 50)
        .otherwise(F.least(F.floor(F.col("years_experience") * 100 / F.greatest("min_years_experience", F.lit(1))), F.lit(100)))
        .cast("bigint")
        .alias("experience"),
        F.when(ladder[F.col("education")] >= ladder[F.col("education_required")], 100).otherwise(40).cast("bigint").alias("education"),
        F.least(F.size("projects") * 20, F.lit(100)).cast("bigint").alias("projects"),
        F.size(gap).cast("bigint").alias("missing"),
    )


def score_and_rank(resumes: DataFrame, jobs: DataFrame, lexicon: DataFrame, model=None) -> DataFrame:
    """Redact, profile, score against the posting, blend with the model's
    probability if there is one, rank. All postings in one job."""
    clean = resumes.select("resume_id", "job_id", redact(F.col("resume_text")).alias("resume_text"))
    # The narrow scores are written once: ranking reads them twice, the texts never.
    scored = cut_lineage(S.overall(section_scores(E.profiles(clean, lexicon), E.requirements(jobs, lexicon))))
    if model is not None:
        scored = G.with_probability(model, scored, "p").withColumn("overall", S.blend(F.col("overall"), F.col("p"))).drop("p", "yhat")
    return S.rank_resumes(scored)


def vector_ranking(sections: DataFrame, job_vectors: DataFrame, names: list[str], k: int = 100) -> DataFrame:
    """Section search, Borda points and final ranking in one plan."""
    return M.borda_ranking(M.borda_points(M.section_matches(sections, job_vectors, k)), names)


def scores_from_answers(answers: DataFrame, raw: str) -> DataFrame:
    """Section scores of scorer answers in JSON; a missing score counts 50."""
    schema = "struct<scores: map<string, string>>"
    parsed = answers.withColumn("_p", F.from_json(raw, schema)["scores"])
    names = ["skills", "experience", "education", "projects"]
    return parsed.select(*[c for c in answers.columns if c != raw], *[score_or(F.try_element_at("_p", F.lit(n))).alias(n) for n in names])


def rank_on_arrival(score: Callable[[DataFrame], DataFrame], root: str, jobs: int) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: the postings whose directories got new objects are
    scored and ranked again, and the result replaces what the batch wrote before."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        touched = finalized(batch).select((F.col("dir").cast("bigint") % jobs).alias("job_id")).distinct()
        score(touched).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/run={batch_id}")

    return publish
