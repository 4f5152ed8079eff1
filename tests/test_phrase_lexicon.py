"""Phrase search and redaction against plain Python on small texts."""

import random
import re

import pytest

from rankloom.operators import phrase_lexicon as B

LEXICON = [
    ("New York", "ADDRESS"),
    ("new york  city", "ADDRESS"),
    ("York", "NAME"),
    ("Jane Q-Doe", "NAME"),
    ("city of a a", "ORG"),
    ("a a", "ORG"),
    ("a a", "ORG"),
    (None, "NAME"),
    ("--", "NAME"),
]


def plain_words(text):
    """Words with their places, and whether a phrase may go on from the word before."""
    out, end = [], None
    for m in re.finditer("[A-Za-z0-9_]+", text or ""):
        out.append((m.start(), m.end(), m.group().lower(), end is not None and bool(re.fullmatch(r"[ \t\r\n-]+", text[end : m.start()]))))
        end = m.end()
    return out


def plain_hits(text, lexicon):
    terms = {(tuple(w for _, _, w, _ in plain_words(p)), k) for p, k in lexicon if p}
    words = plain_words(text)
    hits = []
    for i in range(len(words)):
        for term, kind in terms:
            part = words[i : i + len(term)]
            if term and tuple(w[2] for w in part) == term and all(w[3] for w in part[1:]):
                hits.append((part[0][0], part[-1][1], " ".join(term), kind))
    return hits


def plain_redaction(text, hits):
    if text is None:
        return None
    hidden, out, last = set(), [], False
    for s, e, _, _ in hits:
        hidden |= set(range(s, e))
    for i, c in enumerate(text):
        if i in hidden and not last:
            out.append(B.MARK)
        if i not in hidden:
            out.append(c)
        last = i in hidden
    return "".join(out)


def texts():
    r = random.Random(3)
    words = ["new", "New", "york", "YORK", "city", "of", "a", "jane", "q", "doe", "étè", "x_1"]
    gaps = [" ", " ", " ", "-", "\n", ". ", ", ", "  ", " "]
    rows = [None, "", " ", "...", "york", "New\nYork-City!", "a a a a a", "Jane Q Doe, new. york", "city of a a york " * 300]
    rows += ["".join(r.choice(words) + r.choice(gaps) for _ in range(r.randint(1, 60))) for _ in range(80)]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "phrase string, kind string")


@pytest.fixture(scope="module")
def docs(spark):
    # Further columns bear names that the operator uses itself.
    return spark.createDataFrame([(i, t, i % 3, "k") for i, t in texts()], "id long, body string, start int, kind string")


def test_matches(docs, lexicon):
    from pyspark.sql import functions as F

    found = B.phrase_matches(docs, "id", F.col("body"), lexicon)
    assert found.columns == ["id", "body", "start", "kind", "found"]
    got = {r["id"]: r["found"] for r in found.collect()}
    assert got == {i: sorted({p for _, _, p, _ in plain_hits(t, LEXICON)}) for i, t in texts()}


def test_matches_by_kind(docs, lexicon):
    from pyspark.sql import functions as F

    got = {r["id"]: (r["name"], r["org"]) for r in B.phrase_matches(docs, "id", F.col("body"), lexicon, ["NAME", "ORG"]).collect()}
    for i, t in texts():
        hits = plain_hits(t, LEXICON)
        assert got[i] == tuple(sorted({p for _, _, p, k in hits if k == kind}) for kind in ("NAME", "ORG"))


def test_redaction(docs, lexicon):
    got = {r["id"]: r for r in B.redact_phrases(docs, "id", "body", lexicon, ["NAME", "ADDRESS", "ORG"]).collect()}
    assert len(got) == len(texts())
    for i, t in texts():
        hits = plain_hits(t, LEXICON)
        assert got[i]["redacted"] == plain_redaction(t, hits), t
        assert (got[i]["n_name"], got[i]["n_address"], got[i]["n_org"]) == tuple(sum(h[3] == k for h in hits) for k in ("NAME", "ADDRESS", "ORG"))


def test_kinds_left_out_stay(docs, lexicon):
    got = {r["id"]: r["redacted"] for r in B.redact_phrases(docs, "id", "body", lexicon, ["NAME"]).collect()}
    assert got == {i: plain_redaction(t, [h for h in plain_hits(t, LEXICON) if h[3] == "NAME"]) for i, t in texts()}


def test_empty_tables(docs, lexicon):
    from pyspark.sql import functions as F

    none = lexicon.filter("false")
    assert all(r["found"] == [] for r in B.phrase_matches(docs, "id", F.col("body"), none).collect())
    assert {r["id"]: r["redacted"] for r in B.redact_phrases(docs, "id", "body", none, ["NAME"]).collect()} == dict(texts())
    assert B.redact_phrases(docs.filter("false"), "id", "body", lexicon, ["NAME"]).count() == 0


def test_large_lexicon_by_join(spark, monkeypatch):
    """Word lexicons beyond the literal's bound take the join and give the same rows."""
    from pyspark.sql import functions as F

    from rankloom.operators import extraction as E
    from rankloom.plans import fixtures as X

    d = "/root/testdata/sf0.001"
    cvs, lex = X.texts(spark, d).select("resume_id", "resume_text"), X.lexicon(spark, d)

    def rows():
        found = E.lexicon_matches(cvs, "resume_id", F.col("resume_text"), lex, ["ORG", "GPE", "NORP"])
        return {r["resume_id"]: (r["org"], r["gpe"], r["norp"]) for r in found.collect()}

    inside = rows()
    monkeypatch.setattr(E, "LEXICON_BYTES", -1)
    assert rows() == inside and any(any(v) for v in inside.values())
