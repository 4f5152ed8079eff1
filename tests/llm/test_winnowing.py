import random

from pyspark.sql import functions as F

from rankloom.llm import winnowing as W
from rankloom.llm.common import gram_hashes, hash_words


def brute(text, items):
    """Hit words and item ids by looking at every window."""
    words = W.words_of((text or "").encode())
    hit, met = set(), set()
    for item, item_text in items:
        theirs = W.words_of((item_text or "").encode())
        n = min(len(theirs), W.SPAN)
        windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                if item is not None:
                    met.add(str(item))
    return len(words), len(hit), sorted(met)


def test_against_every_window(spark, docs_of):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "c", "dé", "E5"])
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 25)))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "--- !"), (15, items[0][1]), (15, items[1][1]), (None, "only the null item has these words")]
    texts = [None, "", "...", items[3][1], f"x {items[4][1]} y {items[4][1]}", "only the null item has these words"]
    for _ in range(60):
        bits = [" ".join(word() for _ in range(rng.randint(1, 30)))]
        if rng.random() < 0.6:
            cut = rng.choice(items[:12])[1].split()
            lo = rng.randint(0, len(cut) - 1)
            bits.append(" ".join(cut[lo : lo + rng.randint(1, 20)]))
        bits.append(" ".join(rng.choice("pqrstuv") for _ in range(5)))
        texts.append(rng.choice([" ", ", ", "\n"]).join(bits))
    texts += texts[:3]
    docs = docs_of(list(enumerate(texts))).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("hash", F.lit(1))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in W.contamination(docs, bench).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == brute(text, items), (i, text)


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "w " * 12)], "item_id bigint, text string")
    assert W.contamination(docs_of([]), bench).count() == 0
    rows = W.contamination(docs_of([(1, "w " * 12)]), bench.limit(0)).collect()
    assert [r["n_hit"] for r in rows] == [0]


def test_common_runs_share_a_kept_gram():
    rng = random.Random(1)
    for _ in range(200):
        shared = [rng.choice("abc") for _ in range(W.SPAN)]
        kept = []
        for _ in range(2):
            words = [rng.choice("abc") for _ in range(rng.randint(0, 20))] + shared + [rng.choice("abc") for _ in range(rng.randint(0, 20))]
            grams = gram_hashes(hash_words([w.encode() for w in words]), W.GRAM)
            kept.append(set(grams[W.winnow(grams, W.SPAN - W.GRAM + 1)].tolist()))
        inner = set(gram_hashes(hash_words([w.encode() for w in shared]), W.GRAM).tolist())
        assert kept[0] & kept[1] & inner


def test_hit_documents_go(spark, docs_of):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id bigint, text string")
    docs = docs_of([(1, "x one two three four five six seven eight nine ten y"), (2, "one two three"), (None, "clean"), (3, None)])
    left = W.decontaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 2, 3]
