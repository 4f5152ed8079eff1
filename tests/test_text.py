import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.functions import wordlists as W
from rankloom.operators import terms as I


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t")).alias("x")).first()["x"]


def test_clean_removes_links_tags_and_marks(spark):
    out = one(spark, "Visit https://x.io/a now! Sales.com #CRM – done, @me skills", T.clean_text)
    assert "http" not in out and ".com" not in out and "#" not in out and "crm" not in out
    assert out == "visit sale com done skill"


def test_clean_cuts_cc_inside_words(spark):
    assert one(spark, "success RT account", T.clean_text) == "su ess ount"


def test_contractions_are_cut(spark):
    assert one(spark, "I cannot lemme", lambda c: T.clean_text(c, lemmatise=False)) == "lem"


@pytest.mark.parametrize(
    "word, lemma",
    [("skills", "skill"), ("boxes", "box"), ("studies", "study"), ("classes", "class"), ("analysis", "analysis"), ("children", "child"), ("bus", "bus"), ("status", "status"), ("women", "woman")],
)
def test_lemma(spark, word, lemma):
    assert one(spark, word, T.lemma) == lemma


def test_word_count_drops_empty_tokens(spark):
    assert one(spark, "  a\tb\n\nc d ", T.word_count) == 4
    assert one(spark, "   ", T.word_count) == 0


def test_ngrams(spark):
    got = one(spark, "a1 b1 c1", lambda c: T.ngrams(T.word_tokens(c), 1, 3))
    assert got == ["a1", "b1", "c1", "a1 b1", "b1 c1", "a1 b1 c1"]
    assert one(spark, "", lambda c: T.ngrams(T.word_tokens(c), 2, 3)) == []


def test_reading_ease(spark):
    got = one(spark, "The cat sat. The dog ran.", T.reading_ease)
    assert math.isclose(got, 206.835 - 1.015 * 3 - 84.6 * 1.0)
    assert one(spark, "", T.reading_ease) == 0.0


def test_redaction(spark):
    text = "Mail a.b@c.org, call +1 (555) 123-4567 or 555-123-4567, see linkedin.com/in/ab and https://me.dev/x"
    row = spark.createDataFrame([(text,)], "t string").select(T.redact(F.col("t")).alias("r"), *[c.alias(n) for n, c in T.redaction_counts(F.col("t")).items()]).first()
    assert "@" not in row["r"] and "555" not in row["r"] and "linkedin" not in row["r"] and "me.dev" not in row["r"]
    assert (row["n_email"], row["n_phone"], row["n_profile"], row["n_url"]) == (1, 2, 1, 1)
    assert one(spark, row["r"], T.redact) == row["r"]


def test_pronouns_keep_case_and_words(spark):
    assert one(spark, "She said HIS theory, then himself; the hero", T.neutral_pronouns) == "They said THEIR theory, then themselves; the hero"


def test_month(spark):
    assert one(spark, "2024-03-09", lambda c: T.month_of(c, "N/A")) == "2024-03"
    assert one(spark, "2024-03-09T10:00:00+02:00", lambda c: T.month_of(c, "N/A")) == "2024-03"
    for bad in ("", "2024-13-01", "March 2024", "2024"):
        assert one(spark, bad, lambda c: T.month_of(c, "Present")) == "Present"


def test_candidate_name(spark):
    f = lambda c: T.title_case_name(c, F.lit("id7"))
    assert one(spark, "jane_van-doe.pdf", f) == "Jane Van Doe"
    assert one(spark, ".pdf", f) == "id7"


def test_sections(spark):
    text = "Jane\nEducation\nBSc, X\nWork Experience:\nDev at Y\n\nLed Z\nPROJECTS\nP1\nSkills\nsql\neducation\nMSc"
    r = T.split_sections(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert r["education"] == "BSc, X\nMSc"
    assert r["workexp"] == "Dev at Y\n\nLed Z"
    assert r["personal_projects"] == "P1"
    assert r["misc"] == "Jane\nsql"


def test_jaccard_of_texts(spark):
    jobs = spark.createDataFrame([(1, "alpha beta gamma")], "job_id long, job_text string")
    pairs = spark.createDataFrame([(1, 1, "alpha beta gamma"), (2, 1, "alpha beta delta"), (3, 1, "")], "pair_id long, job_id long, resume_text string")
    tokens = I.pair_tokens(pairs, jobs, stop_words=W.STOP_WORDS)
    got = {r["pair_id"]: r["jaccard"] for r in I.ngram_jaccard(tokens).collect()}
    # sets: {ab, bg, abg} and {ab, bd, abd}
    assert got == {1: 1.0, 2: pytest.approx(1 / 5), 3: 0.0}


def test_tfidf_cosine_by_hand(spark):
    jobs = spark.createDataFrame([(1, "xx yy")], "job_id long, job_text string")
    pairs = spark.createDataFrame([(1, 1, "xx xx"), (2, 1, "zz")], "pair_id long, job_id long, resume_text string")
    tokens = I.pair_tokens(pairs, jobs)
    got = {r["pair_id"]: r["tfidf_cosine"] for r in I.pair_tfidf_cosine(tokens, I.pair_tfidf(tokens)).collect()}
    # four documents (the posting counts twice): df(xx) = 3, df(yy) = 2
    wx, wy = math.log(5 / 4) + 1, math.log(5 / 3) + 1
    assert got[1] == pytest.approx(wx / math.hypot(wx, wy))
    assert got[2] == 0.0


def test_tfidf_second_way_gives_the_same(spark, monkeypatch):
    jobs = spark.createDataFrame([(i, f"xx yy w{i}") for i in range(5)], "job_id long, job_text string")
    pairs = spark.createDataFrame([(i, i % 5, f"xx zz w{i % 7} v{i % 3}") for i in range(40)], "pair_id long, job_id long, resume_text string")
    tokens = I.pair_tokens(pairs, jobs)
    rows = lambda: sorted((r["side"], r["doc_id"], r["term"], round(r["weight"], 9)) for r in I.pair_tfidf(tokens).collect())
    first = rows()
    monkeypatch.setattr(I, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(I, "HOT_KEYS", 2)
    assert rows() == first


def test_encoder_hook(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(20)], "id long, t string")
    sizes = lambda texts: [[len(t), len(texts)] for t in texts]
    got = I.encode_batches(df, "id", "t", sizes, batch=8).collect()
    assert all(r["embedding"][0] == r["id"] and r["embedding"][1] <= 8 for r in got) and len(got) == 20


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab cé.\n", max_size=30), min_size=1, max_size=8))
def test_cleaning_is_stable(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(T.clean_text(F.col("t")).alias("t"))
    again = once.select(T.clean_text(F.col("t")).alias("t"))
    assert [r["t"] for r in once.collect()] == [r["t"] for r in again.collect()]


def test_terms_fitted_on_training_pairs(spark, tmp_path):
    """A saved vocabulary weighs other texts; what training never saw weighs nothing."""
    import math

    jobs = spark.createDataFrame([(1, "xx yy"), (2, "yy zz")], "job_id long, job_text string")
    pairs = spark.createDataFrame([(1, 1, "xx xx"), (2, 1, "yy"), (3, 2, "yy zz new"), (4, 2, "new")], "pair_id long, job_id long, resume_text string")
    tokens = I.pair_tokens(pairs, jobs, lemmatise=False)
    train = I.training_tokens(tokens, pairs.filter("pair_id < 3"))
    terms = spark.read.parquet(I.save_terms(I.fit_terms(train), str(tmp_path / "terms")))
    # Four training texts: xx xx, yy, and the first posting twice.
    idf = math.log(5 / 4) + 1
    assert {r["term"]: (r["df"], round(r["idf"], 12)) for r in terms.collect()} == {"xx": (3, round(idf, 12)), "yy": (3, round(idf, 12))}
    weights = {(r["side"], r["doc_id"], r["term"]): round(r["weight"], 9) for r in I.pair_tfidf(tokens, terms=terms).collect()}
    half = round(math.sqrt(0.5), 9)
    assert weights == {
        ("resume", 1, "xx"): 1.0,
        ("resume", 2, "yy"): 1.0,
        ("resume", 3, "yy"): 1.0,
        ("job", 1, "xx"): half,
        ("job", 1, "yy"): half,
        ("job", 2, "yy"): 1.0,
    }
    cos = {r["pair_id"]: round(r["tfidf_cosine"], 9) for r in I.pair_tfidf_cosine(tokens, I.pair_tfidf(tokens, terms=terms)).collect()}
    assert cos == {1: half, 2: half, 3: 1.0, 4: 0.0}
    assert I.fit_terms(I.training_tokens(tokens, pairs.filter("false"))).count() == 0
