"""Queries for text, similarity, extraction and structured records."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import structured as J
from rankloom.functions import text as T
from rankloom.functions import wordlists as W
from rankloom.operators import extraction as E
from rankloom.operators import phrase_lexicon as B
from rankloom.operators import terms as I
from rankloom.operators.spread import spread_small
from rankloom.plans import fixtures as X
from rankloom.plans.registry import query
from rankloom.session import cut_lineage
from rankloom.sources.files import page_text
from rankloom.sources.tables import rows_of


# ---- SQL twins of the text expressions -----------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_scrub(col: str) -> str:
    for pattern, repl in T.CLEAN_STEPS:
        col = f"regexp_replace({col}, {q(pattern)}, {q(repl)}, 'g')"
    return f"lower({col})"


STOPS = ", ".join(q(w) for w in W.STOP_WORDS)
CUT = "CASE t " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in T.TOKEN_SPLITS.items()) + " ELSE t END"


def sql_tokens(col: str) -> str:
    raw = f"list_filter(string_split({sql_scrub(col)}, ' '), lambda t: t <> '')"
    cut = f"flatten(list_transform({raw}, lambda t: string_split({CUT}, ' ')))"
    return f"list_filter({cut}, lambda t: t NOT IN ({STOPS}))"


LEMMA = (
    "CASE "
    + " ".join(f"WHEN t = {q(k)} THEN {q(v)}" for k, v in W.IRREGULAR_LEMMAS.items())
    + " WHEN length(t) <= 3 THEN t "
    + " ".join(f"WHEN t LIKE {q('%' + e)} THEN left(t, length(t) - {len(e)}) || {q(r)}" for e, r in W.LEMMA_SUFFIXES)
    + " WHEN t LIKE '%s' AND "
    + " AND ".join(f"t NOT LIKE {q('%' + e)}" for e in W.LEMMA_KEEP)
    + " THEN left(t, length(t) - 1) ELSE t END"
)


def sql_clean(col: str, lemmatise: bool = True) -> str:
    tokens = sql_tokens(col)
    if lemmatise:
        tokens = f"list_transform({tokens}, lambda t: {LEMMA})"
    return f"array_to_string({tokens}, ' ')"


def sql_words(col: str, stops: bool = False) -> str:
    w = f"regexp_extract_all(lower({col}), {q(T.WORD2)})"
    return f"list_filter({w}, lambda t: t NOT IN ({STOPS}))" if stops else w


def sql_grams(tok: str, lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        joined = " || ' ' || ".join(f"{tok}[i + {k}]" for k in range(1, n + 1))
        parts.append(tok if n == 1 else f"list_transform(range(greatest(length({tok}) - {n - 1}, 0)), lambda i: {joined})")
    return parts[0] if len(parts) == 1 else f"list_concat({', '.join(parts)})"


# ---- cleaning and tokens ----------------------------------------------------------------


@query("e1_clean_text", f"SELECT resume_id, {sql_clean('resume_text')} AS cleaned FROM v_resumes")
def e1(spark, d):
    return X.texts(spark, d).select("resume_id", T.clean_text(F.col("resume_text")).alias("cleaned"))


@query("e2_clean_text_plain", f"SELECT resume_id, {sql_clean('resume_text', False)} AS cleaned FROM v_resumes")
def e2(spark, d):
    return X.texts(spark, d).select("resume_id", T.clean_text(F.col("resume_text"), lemmatise=False).alias("cleaned"))


@query("e3_token_counts", f"SELECT resume_id, length(list_filter(regexp_split_to_array(resume_text, {q(T.WHITE)}), lambda t: t <> '')) AS resume_length FROM v_resumes")
def e3(spark, d):
    return X.resumes(spark, d).select("resume_id", T.word_count(F.col("resume_text")).alias("resume_length"))


def pair_tokens(spark, d):
    return I.pair_tokens(X.pairs(spark, d), X.jobs(spark, d), stop_words=W.STOP_WORDS)


@query(
    "e4_ngrams",
    f"WITH c AS (SELECT job_id, {sql_words(sql_clean('job_text'), True)} AS tok FROM v_jobs), g AS (SELECT job_id, unnest({sql_grams('tok', 2, 3)}) AS gram FROM c) "
    "SELECT job_id, gram, count(*) AS n FROM g GROUP BY job_id, gram",
)
def e4(spark, d):
    rows = T.with_tokens(X.jobs(spark, d), "job_text", stop_words=W.STOP_WORDS)
    return rows.select("job_id", F.explode_outer(T.ngrams(F.col("tokens"), 2, 3)).alias("gram")).filter(F.col("gram").isNotNull()).groupBy("job_id", "gram").agg(F.count("*").alias("n"))


def sql_tfidf(docs: str, grams: str, max_features: int | None, having: str = "") -> str:
    """docs: side, doc_id, tok, uses."""
    limit = f"ORDER BY corpus_tf DESC, term LIMIT {max_features}" if max_features else ""
    return f"""docs AS MATERIALIZED ({docs}),
    counts AS MATERIALIZED (SELECT side, doc_id, uses, term, count(*) AS tf FROM (SELECT side, doc_id, uses, unnest({grams}) AS term FROM docs) GROUP BY ALL),
    vocab AS MATERIALIZED (SELECT term, sum(tf * uses) AS corpus_tf, sum(uses) AS df FROM counts GROUP BY term {having} {limit}),
    idf AS MATERIALIZED (SELECT term, ln((1.0 + (SELECT sum(uses) FROM docs))::DOUBLE / (1 + df)::DOUBLE) + 1 AS idf FROM vocab),
    raw AS MATERIALIZED (SELECT side, doc_id, term, tf * idf AS w FROM counts JOIN idf USING (term)),
    weights AS MATERIALIZED (SELECT r.side, r.doc_id, r.term, r.w / n.norm AS weight FROM raw r JOIN
      (SELECT side, doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY side, doc_id) n ON n.side = r.side AND n.doc_id = r.doc_id)"""


PAIR_DOCS = f"""SELECT 'resume' AS side, pair_id AS doc_id, {sql_words(sql_clean('resume_text'), False)} AS tok, 1 AS uses FROM v_pairs
    UNION ALL SELECT 'job', job_id, {sql_words(sql_clean('any_value(job_description_text)'), False)}, count(*) FROM v_pairs GROUP BY job_id"""
PAIR_DOCS_STOPPED = f"""SELECT 'resume' AS side, pair_id AS doc_id, {sql_words(sql_clean('resume_text'), True)} AS tok, 1 AS uses FROM v_pairs
    UNION ALL SELECT 'job', job_id, {sql_words(sql_clean('any_value(job_description_text)'), True)}, count(*) FROM v_pairs GROUP BY job_id"""


@query(
    "e5_tfidf",
    f"WITH {sql_tfidf(PAIR_DOCS_STOPPED, sql_grams('tok', 1, 2), 5000)} SELECT side, doc_id, term, round(weight, 6) AS weight FROM weights",
)
def e5(spark, d):
    w = I.pair_tfidf(pair_tokens(spark, d), 5000, lo=1, hi=2)
    return w.select("side", "doc_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "e6_tfidf_default",
    f"""WITH {sql_tfidf(f"SELECT 'resume' AS side, resume_id AS doc_id, {sql_words(sql_clean('resume_text', False))} AS tok, 1 AS uses FROM v_resumes", 'tok', None)}
    SELECT doc_id AS resume_id, term, round(weight, 6) AS weight FROM weights""",
)
def e6(spark, d):
    docs = X.texts(spark, d).select("resume_id", "resume_text", F.lit(1).cast("bigint").alias("uses"))
    docs = cut_lineage(T.with_tokens(docs, "resume_text", lemmatise=False).drop("resume_text"))
    counts = I.term_counts(docs, ["resume_id"], F.col("tokens"), I.counting_tasks(docs))
    w = I.tfidf_weights(counts, ["resume_id"], I.with_idf(I.vocabulary(counts), docs.agg(F.count("*")).scalar()))
    return w.select("resume_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "e7_vocabulary",
    f"WITH {sql_tfidf(PAIR_DOCS_STOPPED, sql_grams('tok', 1, 2), 5000)} SELECT term, corpus_tf::BIGINT AS corpus_tf, df::BIGINT AS df FROM vocab",
)
def e7(spark, d):
    return I.vocabulary(I.pair_term_counts(pair_tokens(spark, d), 1, 2), 5000)


@query("e8_stop_words", f"SELECT job_id, array_to_string({sql_words('job_text', True)}, ' ') AS kept FROM v_jobs")
def e8(spark, d):
    return X.jobs(spark, d).select("job_id", F.array_join(T.word_tokens(F.col("job_text"), W.STOP_WORDS), " ").alias("kept"))


@query(
    "e9_lemmas",
    f"WITH w AS (SELECT DISTINCT unnest({sql_words('resume_text')}) AS t FROM v_resumes) SELECT t AS word, {LEMMA} AS lemma FROM w",
)
def e9(spark, d):
    words = X.texts(spark, d).select(F.explode_outer(F.array_distinct(T.word_tokens(F.col("resume_text")))).alias("word")).filter(F.col("word").isNotNull()).distinct()
    return words.withColumn("lemma", T.lemma(F.col("word")))


EASE = """round(CASE WHEN words = 0 THEN 0.0 ELSE 206.835::DOUBLE - 1.015::DOUBLE * (words::DOUBLE / greatest(ends, 1)) - 84.6::DOUBLE * (vowels::DOUBLE / words) END, 6)"""


@query(
    "e10_reading_ease",
    f"""SELECT resume_id, {EASE} AS resume_readability FROM (SELECT resume_id,
      length(list_filter(regexp_split_to_array(resume_text, {q(T.WHITE)}), lambda t: t <> '')) AS words,
      length(regexp_extract_all(resume_text, '[.!?]+')) AS ends, length(regexp_extract_all(lower(resume_text), '[aeiouy]+')) AS vowels FROM v_resumes)""",
)
def e10(spark, d):
    return X.texts(spark, d).select("resume_id", F.round(T.reading_ease(F.col("resume_text")), 6).alias("resume_readability"))


@query("e11_word2vec_means")
def e11(spark, d):
    docs = I.pair_tokens(X.pairs(spark, d), X.jobs(spark, d), clean=False)
    vectors = I.word_vectors(docs.select("tokens"))
    docs = docs.withColumn("key", F.concat_ws(":", "side", F.col("doc_id").cast("string")))
    means = I.mean_vectors(docs, "key", "tokens", cut_lineage(vectors), 100)
    return means.select("key", F.size("embedding").alias("dim"), F.round(F.element_at("embedding", 1), 6).alias("first_value"))


# ---- similarity -----------------------------------------------------------------------------


@query(
    "d3_tfidf_cosine",
    f"""WITH {sql_tfidf(PAIR_DOCS_STOPPED, 'tok', None)} SELECT p.pair_id, round(coalesce(x.dot, 0.0), 6) AS tfidf_cosine FROM v_pairs p LEFT JOIN
    (SELECT p.pair_id, sum(r.weight * j.weight) AS dot FROM v_pairs p JOIN weights r ON r.side = 'resume' AND r.doc_id = p.pair_id
      JOIN weights j ON j.side = 'job' AND j.doc_id = p.job_id AND j.term = r.term GROUP BY p.pair_id) x ON x.pair_id = p.pair_id""",
)
def d3(spark, d):
    tokens = pair_tokens(spark, d)
    cos = I.pair_tfidf_cosine(tokens, I.pair_tfidf(tokens))
    return cos.select("pair_id", F.round("tfidf_cosine", 6).alias("tfidf_cosine"))


@query(
    "d4_ngram_jaccard",
    f"""WITH t AS (SELECT pair_id, {sql_words(sql_clean('resume_text'), True)} AS tok, {sql_words(sql_clean('job_description_text'), True)} AS tok2 FROM v_pairs),
    g AS (SELECT pair_id, list_distinct({sql_grams('tok', 2, 3)}) AS a, list_distinct({sql_grams('tok2', 2, 3)}) AS b FROM t)
    SELECT pair_id, round(CASE WHEN length(a) + length(b) = 0 THEN 0.0 ELSE length(list_intersect(a, b))::DOUBLE /
      (length(a) + length(b) - length(list_intersect(a, b))) END, 6) AS jaccard FROM g""",
)
def d4(spark, d):
    return I.ngram_jaccard(pair_tokens(spark, d)).select("pair_id", F.round("jaccard", 6).alias("jaccard"))


# ---- entities, skills, profiles ----------------------------------------------------------------


@query(
    "e12_entities",
    f"""SELECT resume_id, array_to_string(list_sort(list_intersect(list_distinct({sql_words('resume_text')}), (SELECT list(token) FROM v_lexicon WHERE kind IN ('ORG', 'GPE', 'NORP')))), ',') AS entities FROM v_resumes""",
)
def e12(spark, d):
    found = E.lexicon_matches(X.texts(spark, d).select("resume_id", "resume_text"), "resume_id", F.col("resume_text"), X.lexicon(spark, d))
    return found.select("resume_id", F.array_join("found", ",").alias("entities"))


@query(
    "e12_phrase_entities",
    """SELECT r.resume_id, coalesce(f.entities, '') AS entities FROM v_resumes r LEFT JOIN (SELECT resume_id,
    string_agg(phrase, ',' ORDER BY phrase) AS entities FROM (SELECT DISTINCT resume_id, phrase FROM v_spans) GROUP BY resume_id) f ON f.resume_id = r.resume_id""",
)
def e12_phrases(spark, d):
    found = B.phrase_matches(X.texts(spark, d).select("resume_id", "resume_text"), "resume_id", F.col("resume_text"), X.phrases(spark, d))
    return found.select("resume_id", F.array_join("found", ",").alias("entities"))


@query(
    "e15_phrase_redaction",
    """WITH hit AS (SELECT * FROM v_spans WHERE kind IN ('NAME', 'ADDRESS')), covered AS (SELECT DISTINCT resume_id, unnest(range(s, e)) AS pos FROM hit),
    marked AS (SELECT p.resume_id, p.pos, p.piece, c.pos IS NOT NULL AS hidden FROM v_pieces p LEFT JOIN covered c ON c.resume_id = p.resume_id AND c.pos = p.pos),
    shown AS (SELECT resume_id, pos, CASE WHEN NOT hidden THEN piece WHEN lag(hidden, 1, false) OVER (PARTITION BY resume_id ORDER BY pos) THEN '' ELSE '[REDACTED]' END AS piece FROM marked),
    texts AS (SELECT resume_id, string_agg(piece, '' ORDER BY pos) AS redacted FROM shown GROUP BY resume_id),
    n AS (SELECT resume_id, count(*) FILTER (kind = 'NAME') AS n_name, count(*) FILTER (kind = 'ADDRESS') AS n_address FROM hit GROUP BY resume_id)
    SELECT r.resume_id, coalesce(t.redacted, r.resume_text) AS redacted, coalesce(n_name, 0) AS n_name, coalesce(n_address, 0) AS n_address
    FROM v_resumes r LEFT JOIN texts t ON t.resume_id = r.resume_id LEFT JOIN n ON n.resume_id = r.resume_id""",
)
def e15_phrases(spark, d):
    return B.redact_phrases(X.texts(spark, d), "resume_id", "resume_text", X.phrases(spark, d), ["NAME", "ADDRESS"])


ENTS = f"""ents AS (SELECT pair_id, list_intersect(list_distinct({sql_words('resume_text')}), (SELECT list(token) FROM v_lexicon)) AS r,
      list_intersect(list_distinct({sql_words('job_description_text')}), (SELECT list(token) FROM v_lexicon)) AS j FROM v_pairs)"""


@query(
    "e13_entity_overlap",
    f"""WITH {ENTS} SELECT pair_id, length(list_intersect(r, j)) AS entity_overlap,
    round(length(list_intersect(r, j)) / (length(list_distinct(list_concat(r, j))) + 0.00001::DOUBLE), 6) AS entity_overlap_ratio FROM ents""",
)
def e13(spark, d):
    return E.pair_overlap(X.pairs(spark, d), X.jobs(spark, d), X.lexicon(spark, d)).select("pair_id", "entity_overlap", "entity_overlap_ratio")


@query(
    "e14_overlap_by_kind",
    f"""WITH {ENTS}, c AS (SELECT pair_id, unnest(list_intersect(r, j)) AS token FROM ents), k AS (SELECT c.pair_id, l.kind FROM c JOIN v_lexicon l ON l.token = c.token)
    SELECT e.pair_id, count(*) FILTER (kind = 'ORG') AS org_overlap, count(*) FILTER (kind = 'GPE') AS gpe_overlap, count(*) FILTER (kind = 'NORP') AS norp_overlap
    FROM ents e LEFT JOIN k ON k.pair_id = e.pair_id GROUP BY e.pair_id""",
)
def e14(spark, d):
    return E.pair_overlap(X.pairs(spark, d), X.jobs(spark, d), X.lexicon(spark, d)).select("pair_id", "org_overlap", "gpe_overlap", "norp_overlap")


def _sql_redact() -> tuple[str, str]:
    text, counts = "resume_text", []
    for kind, pattern in T.PII_PATTERNS:
        counts.append(f"length(regexp_extract_all({text}, {q(pattern)})) AS n_{kind}")
        text = f"regexp_replace({text}, {q(pattern)}, '[REDACTED]', 'g')"
    return text, ", ".join(counts)


@query("e15_redaction", f"SELECT resume_id, {_sql_redact()[0]} AS redacted, {_sql_redact()[1]} FROM v_resumes")
def e15(spark, d):
    text = F.col("resume_text")
    return X.texts(spark, d).select("resume_id", T.redact(text).alias("redacted"), *[c.alias(n) for n, c in T.redaction_counts(text).items()])


PRONOUN_CASE = "CASE t " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in T.pronoun_table().items()) + " ELSE t END"


@query(
    "e16_neutral_pronouns",
    f"""SELECT resume_id, array_to_string(list_transform(regexp_extract_all(resume_text || ' She met HIS boss; he thanked her.', {q(T.LETTER_RUN)}), lambda t: {PRONOUN_CASE}), '') AS neutral FROM v_resumes""",
)
def e16(spark, d):
    text = F.concat("resume_text", F.lit(" She met HIS boss; he thanked her."))
    return X.texts(spark, d).select("resume_id", T.neutral_pronouns(text).alias("neutral"))


# Test texts hold no requirements, so lines that state some are added by rule.
JOB_LINES = [
    "\nAt least 3+ years of work. A bachelor degree is needed.",
    "\n5 years here, 2 years there. Master degree preferred.",
    "\nA PhD. would be nice to have.",
    "",
]
CV_LINES = [
    "\nSenior engineer, 7 years\nData analyst, 2 years\nBSc\nProject alpha",
    "\nManager\nDeveloper\nDesigner\nConsultant\nMBA, 12+ years",
    "\nProject one\nproject two\nPhD",
    "",
]


def _added(lines: list[str], key: str):
    c = F.when(F.col(key) % 4 == 0, lines[0])
    return c.when(F.col(key) % 4 == 1, lines[1]).when(F.col(key) % 4 == 2, lines[2]).otherwise(lines[3])


def _sql_added(lines: list[str], key: str) -> str:
    return f"CASE {key} % 4 " + " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(lines[:3])) + f" ELSE {q(lines[3])} END"


def full_jobs(spark, d):
    return X.jobs(spark, d).withColumn("job_text", F.concat("job_text", _added(JOB_LINES, "job_id")))


def full_resumes(spark, d):
    return X.texts(spark, d).select("resume_id", "job_id", F.concat("resume_text", _added(CV_LINES, "resume_id")).alias("resume_text"))


CUE = "(?i)preferred|nice to have|ation"
SQL_DEGREE = "CASE " + " ".join(f"WHEN regexp_matches(lower({{t}}), {q(f'(^|[^a-z])({w})')}) THEN {q(label)}" for label, w in W.DEGREES) + " ELSE 'None' END"
SQL_YEARS = "coalesce(list_max(list_transform(regexp_extract_all({t}, '([0-9]{{1,2}})\\+? years', 1), lambda y: y::BIGINT)), 0)"
SQL_LEX = "(SELECT list(token) FROM v_lexicon)"


def sql_full_jobs(cue: str) -> str:
    return f"""full_jobs AS (SELECT *, list_filter(list_transform(regexp_split_to_array(job_text, '[.\\n]+'), lambda s: trim(s)), lambda s: s <> '') AS parts FROM
    (SELECT job_id, job_text || {_sql_added(JOB_LINES, 'job_id')} AS job_text FROM v_jobs)),
    split_jobs AS (SELECT *, array_to_string(list_filter(parts, lambda s: NOT regexp_matches(s, {q(cue)})), chr(10)) AS req,
      array_to_string(list_filter(parts, lambda s: regexp_matches(s, {q(cue)})), chr(10)) AS pref FROM full_jobs),
    skilled AS (SELECT *, list_intersect(list_distinct({sql_words('req')}), {SQL_LEX}) AS need, list_intersect(list_distinct({sql_words('pref')}), {SQL_LEX}) AS want FROM split_jobs)"""


FULL_JOBS = sql_full_jobs(CUE)


@query(
    "e17_requirements",
    f"""WITH {FULL_JOBS} SELECT job_id, array_to_string(list_sort(need), ',') AS required_skills,
    array_to_string(list_sort(list_filter(want, lambda t: NOT list_contains(need, t))), ',') AS preferred_skills,
    {SQL_YEARS.format(t='job_text')} AS min_years_experience, {SQL_DEGREE.format(t='job_text')} AS education_required,
    array_to_string(parts, '|') AS key_responsibilities FROM skilled""",
)
def e17(spark, d):
    r = E.requirements(full_jobs(spark, d), X.lexicon(spark, d), cue=CUE)
    return r.select(
        "job_id",
        F.array_join("required_skills", ",").alias("required_skills"),
        F.array_join("preferred_skills", ",").alias("preferred_skills"),
        "min_years_experience",
        "education_required",
        F.array_join("key_responsibilities", "|").alias("key_responsibilities"),
    )


FULL_CVS = f"""full_cvs AS (SELECT *, list_filter(list_transform(string_split(resume_text, chr(10)), lambda s: trim(s)), lambda s: s <> '') AS lines,
    list_intersect(list_distinct({sql_words('resume_text')}), {SQL_LEX}) AS skills FROM
    (SELECT resume_id, job_id, resume_text || {_sql_added(CV_LINES, 'resume_id')} AS resume_text FROM v_resumes))"""


@query(
    "e18_profiles",
    f"""WITH {FULL_CVS} SELECT resume_id, array_to_string(list_sort(skills), ',') AS skills, {SQL_YEARS.format(t='resume_text')} AS years_experience,
    {SQL_DEGREE.format(t='resume_text')} AS education,
    array_to_string(list_filter(lines, lambda s: regexp_matches(s, {q(E.TITLE_LINE)})), '|') AS recent_titles,
    array_to_string(list_filter(lines, lambda s: regexp_matches(s, {q(E.PROJECT_LINE)})), '|') AS projects FROM full_cvs""",
)
def e18(spark, d):
    p = E.profiles(full_resumes(spark, d), X.lexicon(spark, d))
    return p.select(
        "resume_id",
        F.array_join("skills", ",").alias("skills"),
        "years_experience",
        "education",
        F.array_join("recent_titles", "|").alias("recent_titles"),
        F.array_join("projects", "|").alias("projects"),
    )


@query(
    "e20_missing_keywords",
    f"""WITH {FULL_JOBS}, {FULL_CVS}, gap AS (SELECT c.resume_id, list_filter(j.need, lambda t: NOT list_contains(c.skills, t)) AS gap FROM full_cvs c JOIN skilled j ON j.job_id = c.job_id)
    SELECT resume_id, array_to_string(list_sort(gap), ',') AS missing_keywords, length(gap) AS n_missing FROM gap""",
)
def e20(spark, d):
    lex = X.lexicon(spark, d)
    gap = E.missing_keywords(E.profiles(full_resumes(spark, d), lex), E.requirements(full_jobs(spark, d), lex, cue=CUE))
    return gap.select("resume_id", F.array_join("missing_keywords", ",").alias("missing_keywords"), "n_missing")


@query(
    "e19_sections",
    r"""WITH t AS (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'Education:' WHEN 'assistant' THEN 'Work Experience' ELSE 'Projects' END || chr(10) || text, chr(10) ORDER BY turn) AS body FROM conversations GROUP BY conv_id),
    turns AS (SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM conversations)
    SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'user' AND text <> ''), '') AS education,
    coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'assistant' AND text <> ''), '') AS workexp,
    coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role NOT IN ('user', 'assistant') AND text <> ''), '') AS personal_projects, '' AS misc FROM turns GROUP BY conv_id""",
)
def e19(spark, d):
    head = F.when(F.col("role") == "user", "Education:").when(F.col("role") == "assistant", "Work Experience").otherwise("Projects")
    turns = X.table(spark, d, "conversations").select("conv_id", F.struct("turn", F.concat(head, F.lit("\n"), "text").alias("line")).alias("t"))
    # A conversation has few turns: its text is one CV.
    texts = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["line"]), "\n").alias("body"))
    return T.split_sections(texts, "body").drop("body")


@query(
    "e21_hashed_vectors",
    f"""WITH t AS (SELECT resume_id, unnest({sql_words('resume_text')}) AS term FROM v_resumes), h AS (SELECT resume_id, ('0x' || substr(md5('enc:' || term), 1, 8))::BIGINT AS h FROM t),
    v AS (SELECT resume_id, (h % 64)::INTEGER AS slot, sum(CASE WHEN (h // 64) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS v FROM h GROUP BY ALL)
    SELECT v.resume_id, v.slot, round(v.v / n.norm, 6) AS value FROM v JOIN (SELECT resume_id, sqrt(sum(v * v)) AS norm FROM v GROUP BY resume_id) n ON n.resume_id = v.resume_id WHERE v.v <> 0""",
)
def e21(spark, d):
    docs = X.texts(spark, d).select("resume_id", T.word_tokens(F.col("resume_text")).alias("tokens"))
    v = I.hashed_vectors(docs, "resume_id", "tokens")
    return v.select("resume_id", F.posexplode("embedding").alias("slot", "value")).filter("value <> 0").withColumn("value", F.round("value", 6))


@query(
    "e22_iso_month",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m') WHEN 1 THEN strftime(ts, '%Y-%m') ELSE 'N/A' END AS start_month,
    CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m') WHEN 1 THEN strftime(ts, '%Y-%m') ELSE 'Present' END AS end_month FROM events""",
)
def e22(spark, d):
    r = F.col("event_id") % 5
    text = (
        F.when(r == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(r == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(r == 2, "")
        .when(r == 3, "spring 2020")
        .otherwise(F.date_format("ts", "yyyy-MM"))
    )
    return X.table(spark, d, "events").select("event_id", T.month_of(text, "N/A").alias("start_month"), T.month_of(text, "Present").alias("end_month"))


def entries(spark, d):
    """One structured resume per event, with gaps by rule."""
    e, day = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd")
    gone = lambda k, c: F.when(e % k != 0, c)
    who = F.concat(F.lit("Company "), F.col("user_id").cast("string"))
    return X.table(spark, d, "events").select(
        "event_id",
        F.array(
            F.struct(
                F.col("event_type").alias("position"),
                gone(7, who).alias("companyName"),
                day.alias("startDate"),
                gone(3, day).alias("endDate"),
                gone(4, F.array(F.lit("built it"), F.concat(F.lit("ran "), "event_type"))).alias("summary"),
                gone(5, F.array(F.lit("sql"), F.lit("spark"))).alias("skills"),
            )
        ).alias("workexp"),
        F.when(
            e % 6 != 0,
            F.array(
                F.struct(
                    F.concat(F.lit("P"), e.cast("string")).alias("projectName"),
                    gone(3, day).alias("startDate"),
                    F.lit(None).cast("string").alias("endDate"),
                    gone(4, F.array("event_type")).alias("highlights"),
                    F.lit(None).cast("array<string>").alias("keywords"),
                    gone(5, F.lit("http://x")).alias("projectUrl"),
                    F.lit(None).cast("string").alias("project_url"),
                )
            ),
        )
        .otherwise(F.array().cast("array<struct<projectName string, startDate string, endDate string, highlights array<string>, keywords array<string>, projectUrl string, project_url string>>"))
        .alias("personal_projects"),
        gone(2, F.array(F.struct(F.lit("Prize").alias("title"), day.alias("dateReceived"), who.alias("awarder"), F.lit(None).cast("string").alias("summary")))).alias("awards"),
        gone(3, F.array(F.struct(F.lit("Cert").alias("certificateName"), F.lit("2020").alias("dateIssued"), who.alias("issuer")))).alias("certificates"),
        gone(5, F.array(F.struct(F.lit("Paper").alias("publicationName"), F.lit("Press").alias("publisherName"), day.alias("releaseDate"), F.lit("text").alias("summary")))).alias("publications"),
        gone(7, F.array(F.lit("sql"), F.lit("spark"))).alias("skills"),
    )


DAY, MON = "strftime(ts, '%Y-%m-%d')", "strftime(ts, '%Y-%m')"


@query(
    "e23_section_texts",
    f"""SELECT event_id, event_type || ' at ' || CASE WHEN event_id % 7 = 0 THEN 'Unknown Company' ELSE 'Company ' || user_id END || ' (' || {MON} || ' - ' ||
      CASE WHEN event_id % 3 = 0 THEN 'Present' ELSE {MON} END || ')' || chr(10) || 'Responsibilities:' || chr(10) || chr(9) ||
      CASE WHEN event_id % 4 = 0 THEN 'No responsibilities listed' ELSE 'built it' || chr(10) || chr(9) || 'ran ' || event_type END || chr(10) || 'Skills: ' ||
      CASE WHEN event_id % 5 = 0 THEN 'No skills listed' ELSE 'sql, spark' END AS workexp,
    CASE WHEN event_id % 6 = 0 THEN 'No projects listed.' ELSE 'Project: P' || event_id || ' (' || CASE WHEN event_id % 3 = 0 THEN 'N/A' ELSE {MON} END || ' - Present)' || chr(10) ||
      'Highlights:' || chr(10) || chr(9) || CASE WHEN event_id % 4 = 0 THEN 'No highlights provided' ELSE event_type END || chr(10) || 'Keywords: No keywords provided' || chr(10) ||
      CASE WHEN event_id % 5 = 0 THEN '' ELSE 'http://x' END END AS personal_projects,
    nullif(concat_ws(chr(10), CASE WHEN event_id % 2 <> 0 THEN 'Award: Prize, Date: ' || {DAY} || ', Awarder: Company ' || user_id || ', Summary: ' END,
      CASE WHEN event_id % 3 <> 0 THEN 'Certificate: Cert, Date Issued: 2020, Issuer: Company ' || user_id END,
      CASE WHEN event_id % 5 <> 0 THEN 'Publication: Paper, Publisher: Press, Release Date: ' || {DAY} || ', Summary: text' END,
      CASE WHEN event_id % 7 <> 0 THEN 'Skills: sql, spark' END), '') AS misc FROM events""",
)
def e23(spark, d):
    return entries(spark, d).select(
        "event_id",
        J.work_experience_text(F.col("workexp")).alias("workexp"),
        J.projects_text(F.col("personal_projects")).alias("personal_projects"),
        J.misc_text(F.col("awards"), F.col("certificates"), F.col("publications"), F.col("skills")).alias("misc"),
    )


POSTING_FIELDS = {
    "job_title": None,
    "location": None,
    "responsibilities": "list",
    "qualifications": {"education": None, "required_skills": "list"},
    "compensation": {"base_salary": None},
}


@query(
    "e24_posting_text",
    """SELECT event_id, 'job_title : ' || event_type || chr(32) || chr(10) || CASE WHEN event_id % 3 = 0 THEN '' ELSE 'location : L' || user_id || chr(32) || chr(10) END ||
    'responsibilities : a,' || event_type || chr(32) || chr(10) || 'qualifications : education : BSc' || chr(32) || chr(10) || 'required_skills : sql,spark' || chr(32) || chr(10) || chr(32) || chr(10) ||
    CASE WHEN event_id % 4 = 0 THEN '' ELSE 'compensation : base_salary : ' || user_id || chr(32) || chr(10) || chr(32) || chr(10) END AS text FROM events""",
)
def e24(spark, d):
    e = F.col("event_id")
    posting = F.struct(
        F.col("event_type").alias("job_title"),
        F.when(e % 3 != 0, F.concat(F.lit("L"), F.col("user_id").cast("string"))).alias("location"),
        F.array(F.lit("a"), F.col("event_type")).alias("responsibilities"),
        F.struct(F.lit("BSc").alias("education"), F.array(F.lit("sql"), F.lit("spark")).alias("required_skills")).alias("qualifications"),
        F.when(e % 4 != 0, F.struct(F.col("user_id").alias("base_salary"))).alias("compensation"),
    )
    return X.table(spark, d, "events").select("event_id", posting.alias("p")).select("event_id", J.posting_text(F.col("p"), POSTING_FIELDS).alias("text"))


# ---- JSON -----------------------------------------------------------------------------------


@query("f1_parse_with_fallback", "SELECT event_id, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k') ELSE '-1' END AS k, NOT json_valid(raw) AS fell_back FROM v_raw_json")
def f1(spark, d):
    raw = F.col("raw")
    parsed = J.parse_or(raw, "struct<k: string>", F.struct(F.lit("-1").alias("k")))
    return X.raw_json(spark, d).select("event_id", parsed["k"].alias("k"), (~J.is_json(raw)).alias("fell_back"))


@query(
    "f2_coercion",
    """WITH t AS (SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events)
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN 0 ELSE 0 END::BIGINT AS years, CASE WHEN event_id % 4 = 2 THEN 0 ELSE 1 END::BIGINT AS n_skills,
    CASE WHEN event_id % 4 = 3 THEN 'None' ELSE 'BSc' END AS education, CASE event_id % 4 WHEN 1 THEN k + 0.7 WHEN 0 THEN k ELSE 50.0 END::DOUBLE AS score FROM t""",
)
def f2(spark, d):
    k = F.get_json_object("props", "$.k")
    r = F.col("event_id") % 4
    raw = (
        F.when(r == 0, F.concat(F.lit('{"years": '), k, F.lit(', "skills": ["a"], "education": "BSc"}')))
        .when(r == 1, F.concat(F.lit('{"years": '), k, F.lit('.7, "skills": ["a"], "education": "BSc"}')))
        .when(r == 2, F.lit('{"years": null, "education": "BSc"}'))
        .otherwise(F.lit('{"years": "many", "skills": ["a"], "education": ""}'))
    )
    p = F.from_json(raw, "struct<years: string, skills: array<string>, education: string>")
    rows = X.table(spark, d, "events").select("event_id", p.alias("p"))
    return rows.select(
        "event_id",
        J.int_or_zero(F.col("p.years")).alias("years"),
        F.size(J.list_or_empty(F.col("p.skills"))).cast("bigint").alias("n_skills"),
        J.text_or(F.col("p.education"), "None").alias("education"),
        J.score_or(F.col("p.years")).alias("score"),
    )


def resume_json(spark, d):
    """Structured resume JSON per event, with broken rules by remainder."""
    e = F.col("event_id")
    i = e.cast("string")
    basics = F.when(e % 5 == 0, "").otherwise('"basics": {"name": "x"}, ')
    work = F.when(e % 3 == 0, '{"position": "p"}').when(e % 3 == 1, '{"company_name": "c", "position": null}').otherwise('{"companyName": "c", "position": "p"}')
    cert = F.when(e % 4 == 0, '{"certificateName": "c", "dateIssued": null, "issuer": "i"}').otherwise('{"certificateName": "c", "issuer": "i"}')
    typed = (
        F.when(e % 7 == 0, ', "skills": "sql"')
        .when(e % 7 == 1, ', "education": ["x", 5]')
        .when(e % 7 == 2, ', "awards": [7, {"title": true, "dateReceived": null}]')
        .otherwise(', "skills": ["sql"], "education": null')
    )
    whole = F.concat(F.lit("{"), basics, F.lit('"workexp": [{"companyName": "a", "position": "b"}, '), work, F.lit('], "certificates": ['), cert, F.lit("]"), typed, F.lit("}"))
    # Checking a record takes far longer than moving its id: a file of any size feeds all cores.
    events = spread_small(X.table(spark, d, "events").select("event_id"), "event_id", task_bytes=128 << 20)
    return events.select("event_id", F.when(e % 11 == 0, F.concat(F.lit('{"basics": '), i)).otherwise(whole).alias("raw"))


SQL_ERRORS = """errs AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN ['Invalid JSON'] ELSE list_filter([
    CASE WHEN event_id % 5 = 0 THEN 'basics: Field required (value: ''N/A'')' END,
    CASE WHEN event_id % 3 = 0 THEN 'workexp.1.companyName: Field required (value: ''N/A'')' END,
    CASE WHEN event_id % 3 = 1 THEN 'workexp.1.position: Input should be a valid string (value: ''None'')' END,
    CASE WHEN event_id % 7 = 1 THEN 'education.1: Input should be a valid string (value: ''5'')' END,
    CASE WHEN event_id % 7 = 2 THEN 'awards.0: Input should be a valid dictionary or instance of Award (value: ''7'')' END,
    CASE WHEN event_id % 7 = 2 THEN 'awards.1.title: Input should be a valid string (value: ''True'')' END,
    CASE WHEN event_id % 4 <> 0 THEN 'certificates.0.dateIssued: Field required (value: ''N/A'')' END,
    CASE WHEN event_id % 7 = 0 THEN 'skills: Input should be a valid list (value: ''sql'')' END], lambda m: m IS NOT NULL) END AS errors FROM events)"""


@query("f3_validate_quarantine", f"WITH {SQL_ERRORS} SELECT event_id, length(errors) = 0 AS valid, length(errors) AS n_errors FROM errs")
def f3(spark, d):
    return J.validate(resume_json(spark, d), "raw").select("event_id", "valid", F.size("errors").cast("bigint").alias("n_errors"))


@query(
    "f3_quarantine_retry",
    f"WITH {SQL_ERRORS} SELECT CASE WHEN event_id % 11 = 0 THEN false ELSE length(list_filter(errors, lambda m: m NOT LIKE 'certificates%')) = 0 END AS valid, count(*) AS n FROM errs GROUP BY 1",
)
def f3_retry(spark, d):
    fix = lambda raw: F.replace(raw, F.lit('"certificateName": "c", "issuer"'), F.lit('"certificateName": "c", "dateIssued": null, "issuer"'))
    return J.retry_quarantine(resume_json(spark, d), "raw", fix).groupBy("valid").agg(F.count("*").alias("n"))


@query("f4_error_report", f"WITH {SQL_ERRORS} SELECT event_id, array_to_string(errors, ', ') AS report FROM errs WHERE length(errors) > 0")
def f4(spark, d):
    bad = J.validate(resume_json(spark, d), "raw").filter("not valid")
    return bad.select("event_id", F.array_join("errors", ", ").alias("report"))


@query(
    "f5_to_json",
    """SELECT resume_id, '{"skills":' || skills || ',"experience":' || experience || ',"education":' || education || ',"projects":' || projects || '}' AS section_scores FROM v_scores""",
)
def f5(spark, d):
    return X.scores(spark, d).select("resume_id", F.to_json(F.struct("skills", "experience", "education", "projects")).alias("section_scores"))


@query("f6_tolerant_json", "SELECT event_id, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k')::BIGINT END AS k FROM v_raw_json")
def f6(spark, d):
    return X.raw_json(spark, d).select("event_id", J.parse_or_null(F.col("raw"), "struct<k: bigint>")["k"].alias("k"))


# ---- text sources ------------------------------------------------------------------------------


@query(
    "a6_envelopes",
    """SELECT event_id, user_id::VARCHAR AS id, event_type AS kind FROM events WHERE event_id % 6 <> 4
    UNION ALL SELECT event_id, 'x', event_type FROM events WHERE event_id % 6 IN (0, 1)""",
)
def a6(spark, d):
    r = F.col("event_id") % 6
    one = F.concat(F.lit('{"id": "'), F.col("user_id").cast("string"), F.lit('", "kind": "'), "event_type", F.lit('"}'))
    two = F.concat(F.lit("["), one, F.lit(', {"id": "x", "kind": "'), "event_type", F.lit('"}]'))
    raw = (
        F.when(r == 0, two)
        .when(r == 1, F.concat(F.lit('{"jobs": '), two, F.lit("}")))
        .when(r == 2, F.concat(F.lit('{"training_data": ['), one, F.lit("]}")))
        .when(r == 3, F.concat(F.lit('{"data": ['), one, F.lit("]}")))
        .when(r == 4, F.lit('{"resumes": []}'))
        .otherwise(one)
    )
    rows = X.table(spark, d, "events").select("event_id", raw.alias("raw"))
    return rows_of(rows, "raw", "struct<id: string, kind: string>", ["id", "kind"])


def _sql_html() -> str:
    text = "html"
    for pattern, repl in [
        ("(?is)<script[^>]*>.*?</script>", " "), ("(?is)<style[^>]*>.*?</style>", " "), ("(?s)<!--.*?-->", " "), ("<[^>]+>", " "),
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"), (r"\s+", " "),
    ]:
        text = f"regexp_replace({text}, {q(pattern)}, {q(repl)}, 'g')"
    return f"trim({text})"


@query("a5_page_text", f"SELECT page_id, url, {_sql_html()} AS text FROM pages")
def a5(spark, d):
    return page_text(X.table(spark, d, "pages"))


# ---- the whole scoring flow -------------------------------------------------------------------

LADDER = "CASE {c} WHEN 'PhD' THEN 3 WHEN 'Master''s' THEN 2 WHEN 'Bachelor''s' THEN 1 ELSE 0 END"


@query(
    "flow_score_and_rank",
    f"""WITH {sql_full_jobs(E.PREFERRED_CUE)}, {FULL_CVS}, clean AS (SELECT resume_id, job_id, {_sql_redact()[0]} AS t FROM full_cvs),
    cvs AS (SELECT resume_id, job_id, list_intersect(list_distinct({sql_words('t')}), {SQL_LEX}) AS skills, {SQL_YEARS.format(t='t')} AS years, {SQL_DEGREE.format(t='t')} AS degree,
      length(list_filter(list_transform(string_split(t, chr(10)), lambda s: trim(s)), lambda s: regexp_matches(s, {q(E.PROJECT_LINE)}))[1:5]) AS n_projects FROM clean),
    needs AS (SELECT job_id, need, {SQL_YEARS.format(t='job_text')} AS min_years, {SQL_DEGREE.format(t='job_text')} AS degree FROM skilled),
    parts AS (SELECT c.resume_id, c.job_id, CASE WHEN length(n.need) = 0 THEN 50 ELSE length(list_intersect(n.need, c.skills)) * 100 // length(n.need) END AS s,
      CASE WHEN n.min_years = 0 THEN 50 ELSE least(c.years * 100 // n.min_years, 100) END AS e,
      CASE WHEN {LADDER.format(c='c.degree')} >= {LADDER.format(c='n.degree')} THEN 100 ELSE 40 END AS u, least(c.n_projects * 20, 100) AS p FROM cvs c JOIN needs n ON n.job_id = c.job_id),
    scored AS (SELECT *, ((40 * s + 30 * e + 15 * u + 15 * p + 5) // 10) / 10.0::DOUBLE AS overall FROM parts)
    SELECT resume_id, job_id, overall, overall >= 40 AS fit, CASE WHEN overall >= 40 THEN
      row_number() OVER (PARTITION BY job_id, overall >= 40 ORDER BY overall DESC, resume_id) ELSE -1 END AS status FROM scored""",
)
def flow_rank(spark, d):
    from rankloom.plans.pipelines import score_and_rank

    ranked = score_and_rank(full_resumes(spark, d), full_jobs(spark, d), X.lexicon(spark, d))
    return ranked.select("resume_id", "job_id", "overall", "fit", "status")
