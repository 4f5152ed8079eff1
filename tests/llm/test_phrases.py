import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from rankloom.llm import phrases as P


def brute(rows, least=10, most=3, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[\x20\x09]", piece) if x]
            totals[lang or "und"] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    counts[lang or "und", tuple(w[i : i + k])] += 1
    frequent = {g: n for g, n in counts.items() if len(g[1]) > 1 and n >= least}
    out = {}
    for (lang, g), a in frequent.items():
        if any(la == lang and len(h) > len(g) and 100 * n >= 50 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for (la, h), n in frequent.items()):
            continue
        score, k = min((10**6 * a * a // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g)))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def made(docs, **kw):
    return sorted(tuple(r) for r in P.collocations(docs, **kw).collect())


def sample(n=120):
    rng = random.Random(3)
    words = ["the", "New", "york", "times", "Ärger", "Ä", "a", "of", "日本", "x1"]
    fixed = ["new york times", "Ärger of", "a of the a of"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) + rng.choice(["", "", "", ".", ",\t", "\n", "  "]) for _ in range(40))
        rows.append((i, text, rng.choice(["en", "de", None, "und"])))
    return rows + [(900, None, "en"), (901, "", None), (902, " .,; ", "fr")]


def test_equals_brute_force(docs_of):
    rows = sample()
    assert made(docs_of(rows).repartition(3)) == brute(rows)
    assert made(docs_of(rows), least=3, top=7) == brute(rows, least=3, top=7)
    assert made(docs_of(rows[:60]), least=3, max_words=4) == brute(rows[:60], least=3, most=4)


def test_small_blocks_and_slices(docs_of, monkeypatch):
    rows = sample(60) + [(950, "the new york times a " * 400, "en")]
    whole = brute(rows)
    for words, vocabulary, size in [(50, 1 << 18, 1 << 20), (10**6, 4, 64)]:
        monkeypatch.setattr(P, "BLOCK_WORDS", words)
        monkeypatch.setattr(P, "BLOCK_VOCABULARY", vocabulary)
        monkeypatch.setattr(P, "SLICE", size)
        counts = Counter()
        batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows]), pa.array([r[2] or "und" for r in rows])], ["text", "lang"])
        for n in (1, 2, 3):
            for part in P._counter(n, None)(iter([batch])):
                for g, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts[g] += c
        for lang, _, phrase, a, *_ in whole:
            assert counts[f"{phrase}\t{lang}"] == a
        assert counts["\ten"] == sum(c for g, c in counts.items() if g.endswith("\ten") and g.split("\t")[0] and " " not in g)


def test_walk_over_many_ranges(spark):
    """One first word in all phrases, cut into single rows."""
    stream = [("en", ["a"], 90), ("en", ["a", "b"], 40), ("en", ["a", "b", "c"], 20), ("en", ["a", "b", "d"], 30), ("en", ["a", "c"], 50), ("en", ["a", "c", "c"], 11), ("en", ["b"], 50)]
    df = spark.createDataFrame(stream, "lang string, words array<string>, n bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = {tuple(r["words"]): (r["n"], r["known"], r["longer"]) for r in P.walked(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got[("a", "b", "d")] == (30, [90, 40], 0)
    assert got[("a", "c", "c")] == (11, [90, 50], 0)
    assert got[("a", "b")] == (40, [90], 30)
    assert got[("a",)] == (90, [], 50) and got[("b",)] == (50, [], 0)


def test_a_narrow_filter_changes_nothing(docs_of, monkeypatch):
    rows = sample(60)
    monkeypatch.setattr(P, "MOST_BITS", 64)
    monkeypatch.setattr(P, "BITS_EACH", 1)
    assert made(docs_of(rows)) == brute(rows)


def test_products_beyond_64_bits(spark):
    a = 9_000_000_000_000
    row = spark.createDataFrame([(a, a, a + 1)], "n bigint, l bigint, r bigint")
    d = lambda c: F.col(c).cast("decimal(19,0)")
    got = row.select(F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (d("n") * d("n")), d("l") * d("r"))).first()[0]
    assert got == 10**6 * a * a // (a * (a + 1))


def test_empty_table_and_clashing_columns(docs_of):
    assert made(docs_of([])) == []
    rows = [(i, "big data big data", "en") for i in range(10)]
    extra = docs_of(rows).withColumns({"gram": F.lit(1), "words": F.lit(2), "n": F.lit(3), "known": F.lit(4)})
    assert made(extra) == brute(rows)


def test_the_driver_takes_the_filter_in_parts(spark, monkeypatch):
    DataFrame = type(spark.range(1))

    monkeypatch.setattr(P, "PART_WORDS", 64)
    monkeypatch.setattr(DataFrame, "toPandas", None)
    monkeypatch.setattr(DataFrame, "collect", None)
    rows, local = [], DataFrame.toLocalIterator
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda df, *a: (rows.append(r) or r for r in local(df, *a)))
    words = [["w", f"x{i}"] for i in range(5000)]
    bits = P.bit_filter(spark.createDataFrame([("en", w) for w in words], "lang string, words array<string>"))
    h = P.phrase_hash("en", [P.np.array([P.xxhash.xxh3_64_intdigest(w[j]) for w in words], P.np.uint64) for j in range(2)])
    want = P.np.zeros(5000 * P.BITS_EACH, bool)
    want.resize(len(bits) * 64)
    want[h % P.np.uint64(len(want))] = True
    assert len(want) == 1 << 17 and (P.np.unpackbits(bits.view(P.np.uint8), bitorder="little") == want).all()
    assert len(rows) == len(bits) // 64  # not one for each of some 1,900 words
