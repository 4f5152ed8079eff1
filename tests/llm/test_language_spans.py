import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from rankloom.llm import language_spans as L

WORDS = {"en": "the and that with house which thing wher".split(), "de": "und der ich nicht haus schön straße zeit".split(), "ru": "дом это что когда время".split()}


def sample(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    scores = rng.uniform(-5, 0, (6, 3)).astype(np.float32)
    ids = [rng.integers(0, 6, n) for n in (5, 1, 0, 4, 6)]
    for want, got in zip(ids, L.viterbi(ids, scores, switch=2.0)):
        if not len(want):
            assert not len(got)
            continue
        value = lambda p: sum(scores[w, s] for w, s in zip(want, p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        best = max(value(p) for p in itertools.product(range(3), repeat=len(want)))
        assert abs(value(got.tolist()) - best) < 1e-4


def test_letter_groups_by_hand():
    words = ["ab", "é", "ab"]
    slot, sizes, script = L.letter_groups(words)
    assert sizes.tolist() == [2 + 3 + 2, 1 + 2 + 1, 7]
    assert slot[:7].tolist() == slot[-7:].tolist()
    assert {L.SCRIPT_NAMES[s] for s in script} == {"latin"}
    assert L.SCRIPT_NAMES[L.letter_groups(["дом"])[2][0]] == "cyrillic"


def test_mixed_text_and_edge_cases(docs_of):
    rng = random.Random(1)
    docs = docs_of([(i, sample(rng, lang, 40), lang) for i, lang in enumerate(["en", "de", "ru"] * 30)] + [(900, None, "en"), (901, "no label", None)])
    model = L.learn(docs)
    assert model.names == ["de", "en", "ru"]
    mixed = sample(rng, "en", 30) + " " + sample(rng, "de", 20) + " " + sample(rng, "ru", 10)
    ask = docs_of([(1, mixed), (2, None), (3, ""), (4, "123 -- !"), (None, sample(rng, "ru", 3).upper()), (6, sample(rng, "de", 30000)), (6, sample(rng, "en", 5))])
    got = [r.asDict(recursive=True) for r in L.predictions(ask.withColumn("score", F.lit("clash")), model, ["doc_id"]).collect()]
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 6}
    assert [s["lang"] for s in by[1]["spans"]] == ["en", "de", "ru"] and by[1]["lang_pred"] == "en" and by[1]["score"] == 0.5
    assert [mixed[s["start"] : s["end"]].split()[0] in WORDS[s["lang"]] for s in by[1]["spans"]] == [True] * 3
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert by[None]["lang_pred"] == "ru"
    assert sorted(r["lang_pred"] for r in got if r["doc_id"] == 6) == ["de", "en"]
    left = L.accepted(ask, model)
    assert left.columns == ask.columns and left.count() == 4
    assert L.predictions(docs_of([]), model, ["doc_id"]).count() == 0


def test_nothing_learned(docs_of):
    model = L.learn(docs_of([]))
    assert [r["lang_pred"] for r in L.predictions(docs_of([(1, "words")]), model, ["doc_id"]).collect()] == ["und"]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = L.op6(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right / len(rows) >= 0.97 and all(0 <= r["score"] <= 1 for r in rows)
