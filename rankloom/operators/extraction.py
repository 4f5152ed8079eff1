"""Entities, skills, requirements and profiles by lexicon and pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.functions import wordlists as W
from rankloom.operators.spread import lookup_join, planned_bytes

LEXICON_BYTES = 1 << 20
PREFERRED_CUE = r"(?i)preferred|nice to have|bonus"
YEARS = r"([0-9]{1,2})\+? years"
TITLE_LINE = r"(?i)engineer|developer|manager|analyst|scientist|designer|consultant"
PROJECT_LINE = r"(?i)^project"


def lexicon_matches(docs: DataFrame, key: str, text: Column, lexicon: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """Lexicon terms found in each text: an array per kind, or one array ``found``.

    A small lexicon is turned into array literals by a scalar subquery and met
    inside the row, without join or shuffle; a large one is joined by term.
    """
    tokens = F.array_distinct(T.word_tokens(text))
    named = {k.lower(): lexicon.filter(F.col("kind") == k) for k in kinds} if kinds else {"found": lexicon}
    if planned_bytes(lexicon) <= LEXICON_BYTES:
        sets = {n: lex.agg(F.collect_list("token")).scalar() for n, lex in named.items()}
        return docs.select("*", tokens.alias("_tokens")).select(
            *docs.columns, *[F.coalesce(F.sort_array(F.array_intersect("_tokens", s)), F.array().cast("array<string>")).alias(n) for n, s in sets.items()]
        )
    terms = docs.select(key, F.explode_outer(tokens).alias("token")).filter(F.col("token").isNotNull())
    kind = F.lower("kind") if kinds else F.lit("found")
    hits = lookup_join(terms, lexicon.select("token", kind.alias("_kind")), ["token"])
    found = hits.groupBy(key).agg(
        *[F.array_sort(F.collect_set(F.when(F.col("_kind") == n, F.col("token")))).alias(n) for n in named]
    )
    empty = F.array().cast("array<string>")
    return docs.join(found, key, "left").select(*docs.columns, *[F.coalesce(F.col(n), empty).alias(n) for n in named])


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("bigint")


def overlap_ratio(a: Column, b: Column) -> Column:
    return overlap(a, b) / (F.size(F.array_union(a, b)) + F.lit(1e-5))


def pair_overlap(pairs: DataFrame, jobs: DataFrame, lexicon: DataFrame, kinds: tuple[str, ...] = W.ENTITY_KINDS) -> DataFrame:
    """Entity overlap of every pair: in all, as a ratio and per kind. Postings are
    matched once each."""
    names = [k.lower() for k in kinds]
    mine = lexicon_matches(pairs.select("pair_id", "job_id", "resume_text"), "pair_id", F.col("resume_text"), lexicon, list(kinds))
    theirs = lexicon_matches(jobs.select("job_id", "job_text"), "job_id", F.col("job_text"), lexicon, list(kinds)).select("job_id", *[F.col(n).alias(f"_j_{n}") for n in names])
    both = lookup_join(mine.drop("resume_text"), theirs, ["job_id"])
    all_r, all_j = F.concat(*[F.col(n) for n in names]), F.concat(*[F.col(f"_j_{n}") for n in names])
    return both.select(
        "pair_id",
        overlap(all_r, all_j).alias("entity_overlap"),
        F.round(overlap_ratio(all_r, all_j), 6).alias("entity_overlap_ratio"),
        *[overlap(F.col(n), F.col(f"_j_{n}")).alias(f"{n}_overlap") for n in names],
    )


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"[.\n]+"), lambda s: F.trim(s)), lambda s: s != "")


def years_of(text: Column) -> Column:
    """Largest number of years named, 0 if none."""
    found = F.transform(F.regexp_extract_all(text, F.lit(YEARS), F.lit(1)), lambda y: y.cast("bigint"))
    return F.coalesce(F.array_max(found), F.lit(0).cast("bigint"))


def degree_of(text: Column) -> Column:
    """Highest degree named, "None" if none."""
    c = None
    for label, words in W.DEGREES:
        hit = F.lower(text).rlike(f"(^|[^a-z])({words})")
        c = F.when(hit, label) if c is None else c.when(hit, label)
    return c.otherwise("None")


def requirements(jobs: DataFrame, lexicon: DataFrame, cue: str = PREFERRED_CUE) -> DataFrame:
    """Required and preferred skills, years, degree and all duties of every posting."""
    text = F.col("job_text")
    parts = jobs.withColumn("_parts", sentences(text))
    split = parts.select(
        "*",
        F.array_join(F.filter("_parts", lambda s: ~s.rlike(cue)), "\n").alias("_req"),
        F.array_join(F.filter("_parts", lambda s: s.rlike(cue)), "\n").alias("_pref"),
    )
    req = lexicon_matches(split, "job_id", F.col("_req"), lexicon).withColumnRenamed("found", "required_skills")
    both = lexicon_matches(req, "job_id", F.col("_pref"), lexicon).withColumnRenamed("found", "preferred_skills")
    return both.select(
        "job_id",
        "required_skills",
        F.array_except("preferred_skills", "required_skills").alias("preferred_skills"),
        years_of(text).alias("min_years_experience"),
        degree_of(text).alias("education_required"),
        F.col("_parts").alias("key_responsibilities"),
    )


def profiles(resumes: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Skills, years, highest degree, all titles, latest first, and projects of every resume."""
    text = F.col("resume_text")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda s: F.trim(s)), lambda s: s != "")
    resumes = resumes.withColumn("_lines", lines)
    found = lexicon_matches(resumes, "resume_id", text, lexicon).withColumnRenamed("found", "skills")
    return found.select(
        "resume_id",
        "job_id",
        "skills",
        years_of(text).alias("years_experience"),
        degree_of(text).alias("education"),
        F.filter("_lines", lambda s: s.rlike(TITLE_LINE)).alias("recent_titles"),
        F.filter("_lines", lambda s: s.rlike(PROJECT_LINE)).alias("projects"),
    )


def missing_keywords(profile: DataFrame, required: DataFrame) -> DataFrame:
    """Required skills that a resume does not show, and how many."""
    both = lookup_join(profile, required.select("job_id", "required_skills"), ["job_id"])
    gap = F.array_sort(F.array_except("required_skills", "skills"))
    return both.select("resume_id", "job_id", gap.alias("missing_keywords"), F.size(gap).cast("bigint").alias("n_missing"))
