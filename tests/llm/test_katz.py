import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.llm import katz as K
from rankloom.llm.common import crc32_of


def tokens_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def is_held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


class Brute:
    """The model by dictionaries, one token at a time."""

    def __init__(self, rows):
        train = [tokens_of(t) for i, t in rows if not is_held(i)]
        self.c = Counter(w for t in train for w in t)
        self.r = Counter(p for t in train for p in zip(["<s>", *t], t))
        self.past = Counter(h for t in train for h in ["<s>", *t[:-1]])
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.d1 = K.discounts([sum(x == r for x in self.c.values()) for r in range(1, 7)])
        self.d2 = K.discounts([sum(x == r for x in self.r.values()) for r in range(1, 7)])
        kept = sum(x * (self.d1[x] if x <= 5 else 1) for x in self.c.values())
        self.unknown = max(1 - kept / self.n if self.n else 1, 1 / (self.n + 1))
        self.scale = (1 - self.unknown) / kept if kept else 0

    def p1(self, w):
        x = self.c[w]
        return self.scale * x * (self.d1[x] if x <= 5 else 1) if x else self.unknown

    def seen(self, h, w):
        x = self.r[h, w]
        return x * (self.d2[x] if x <= 5 else 1) / (self.past[h] + 1)

    def p(self, h, w):
        if self.r[h, w]:
            return self.seen(h, w)
        if not self.past[h]:
            return self.p1(w)
        after = [x for g, x in self.r if g == h]
        return self.p1(w) * (1 - sum(self.seen(h, x) for x in after)) / (1 - sum(map(self.p1, after)))

    def row(self, i, text):
        t = tokens_of(text)
        base = sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in t)
        score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *t], t))
        return is_held(i), len(t), sum(self.c[w] > 0 for w in t), self.n, base, score


def corpus():
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    rows += [(200 + i, "The the\tthe " + rng.choice(["cat", "É dog", "x y"]) * 2) for i in range(20)]
    return rows + [(None, "no id"), (300, None), (301, ""), (302, "w1 " * 500), (303, " \n ")] + rows[:3]


@pytest.mark.parametrize("frequent,parts,chunk", [(1 << 19, None, 3_000_000), (3, 7, 100), (0, 2, 1)])
def test_scores_equal_the_model_by_hand(docs_of, monkeypatch, frequent, parts, chunk):
    monkeypatch.setattr(K, "FREQUENT", frequent)
    monkeypatch.setattr(K, "CHUNK_TOKENS", chunk)
    rows = corpus()
    brute = Brute(rows)
    docs = docs_of(rows).withColumn("row", F.lit("clash")).withColumn("score", F.lit("clash"))
    got = K.scored(docs, crc32_of(F.col("doc_id")) % 7 == 2, parts=parts).collect()
    assert len(got) == len(rows)
    want = {i: brute.row(i, t) for i, t in rows}
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], abs=1e-8) and r["score"] == pytest.approx(w[5], abs=1e-8)


def test_distributions_add_up_to_one():
    brute = Brute(corpus())
    unknown = "never seen"
    for h in ["<s>", "the", "w1", "w2", "w30", unknown]:
        assert sum(brute.p(h, w) for w in [*brute.c, unknown]) == pytest.approx(1)


def test_nothing_to_learn_from(docs_of):
    held = next(i for i in range(99) if is_held(i))
    got = K.scored(docs_of([(held, "a b")]), crc32_of(F.col("doc_id")) % 7 == 2).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(3, 0, 0.0, 0.0)]
    assert K.scored(docs_of([]), F.lit(False)).count() == 0


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    rows = K.op2(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
