import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rankloom.llm import chunk_recipes as R


def brute(rows):
    groups = {}
    for at, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t or ""), []).append((-len(t or ""), i is None, i or 0, at))
    out = []
    for at, (i, t) in enumerate(rows):
        plain = re.sub(r"[\x20\x09-\x0D]+", "", t or "")
        first = min(groups[plain])
        out.append((i, rows[first[3]][0], len(groups[plain]), first[3] == at, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **kw):
    return sorted([tuple(r) for r in R.exact_duplicates(docs, **kw).collect()], key=str)


def sample():
    rng = random.Random(5)
    words = ["alpha", "beta", "Ünïcode", "日本語", "x" * 90, "e", "tensor"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, t.replace(" ", "\n ")) for i, t in enumerate(texts[:10])]
    rows += [(200 + i, t[:-1] + "!") for i, t in enumerate(texts[10:20])]
    rows += [(300, ""), (301, None), (302, " \t\n"), (303, None), (None, texts[0]), (304, "z" * 300_000), (305, "z" * 299_999), (306, "z" * 300_000)]
    return rows


def test_equals_brute_force(spark, docs_of):
    rows = sample()
    assert found(docs_of(rows).repartition(3)) == brute(rows)


def test_repeated_ids_leave_one_row(docs_of):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (2, "c")]
    got = found(docs_of(rows).coalesce(1))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(1, 1, 3, False), (1, 1, 3, True), (2, 1, 3, False), (2, 2, 1, True)]


def test_names_that_clash_are_made_anew(docs_of):
    rows = sample()

    def weak(content, seed):
        good = R.names_of(content, seed)
        return good if seed else (F.pmod(good[0], F.lit(4)), F.lit(0).cast("bigint"))

    assert found(docs_of(rows), namer=weak) == brute(rows)


def test_names_that_always_clash_are_refused(docs_of):
    with pytest.raises(ValueError):
        R.exact_duplicates(docs_of([(1, "a" * 100), (2, "b" * 100)]), namer=lambda c, s: (F.lit(1).cast("bigint"), F.lit(1).cast("bigint")))


def test_chunks_join_to_the_text_and_survive_a_shift(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(20_000))
    made = spark.createDataFrame([(text,), ("shifted" + text,)], "text string").select(R.chunks_of(F.col("text")).alias("c")).collect()
    one, two = (r["c"] for r in made)
    assert "".join(one).encode("latin-1").decode() == text
    assert all(len(c) <= R.MOST for c in one) and sum(len(c) for c in one) / len(one) > R.LEAST
    assert len(set(one) & set(two)) > 0.9 * len(one)


def test_empty_table_and_clashing_columns(docs_of):
    assert found(docs_of([])) == []
    extra = docs_of([(1, "a"), (2, "a")]).withColumns({"recipe": F.lit(1), "name_a": F.lit(2), "_row_id": F.lit(3), "slot": F.lit(4)})
    assert [r[:4] for r in found(extra)] == [(1, 1, 2, True), (2, 1, 2, False)]
