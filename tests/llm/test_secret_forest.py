import hashlib
import random
import re

from pyspark.sql import functions as F

from rankloom.llm import secret_forest as S


def secret(rng):
    return hashlib.sha1(str(rng.random()).encode()).hexdigest()


def test_candidates_equal_plain_matching(docs_of):
    rng = random.Random(2)
    bits = ["abc", "12", "é", " ", "\n", "=", "==", "/", "-", "_", '"', "A1b2C3d4E5f6", "."]
    texts = [None, "", "short 123", "a" * 40, "1" * 50_000, "key=" + "aB3" * 8 + "=="] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 50))) for _ in range(150)]
    docs = docs_of(list(enumerate(texts)) + [(None, "A1b2C3d4E5f6"), (2, "A1b2C3d4E5f6")]).withColumn("label", F.lit("clash")).withColumn("path", F.lit(None).cast("string"))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["start"], r["end"]) for r in S.findings(docs, path_col="path").collect())
    want = [(i, m.start(), m.end()) for i, t in enumerate(texts) for m in re.finditer(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{12,}={0,2}", t or "") if re.search("[0-9]", m[0])]
    assert got == sorted(want + [(-1, 0, 12), (2, 0, 12)])
    assert S.findings(docs_of([])).count() == 0


def test_context_is_the_whole_text(docs_of):
    rng = random.Random(4)
    bits = ["abcdefghijkl", "é\n", " ", "=", ": ", '"', "A1b2C3d4E5f6", "x1" * 40, "pass", "y" * 70]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(80)]
    rows = S.findings(docs_of(list(enumerate(texts)))).collect()
    assert len(rows) > 100
    for r in rows:
        t = texts[r["doc_id"]]
        assert (r["before"], r["after"]) == (t[max(0, r["start"] - 60) : r["start"]], t[r["end"] : r["end"] + 60])


def test_long_names_are_names(docs_of):
    rng = random.Random(5)
    names = ["AWS_SECRET_ACCESS_KEY=", "GITHUB_TOKEN=", 'client_secret: "', '"client_secret": "', "export GITHUB_TOKEN_2='", "authorization_token = "]
    found = S.described(S.findings(docs_of([(i, n + secret(rng)) for i, n in enumerate(names)]))).filter("length(finding) = 40")
    rows = S.judged(found, None).collect()
    assert len(rows) == len(names) and all(r["named"] == 1 and r["assigned"] == 1 and r["is_secret"] for r in rows)


def test_forest_learns_from_labelled_findings(spark, docs_of):
    rng = random.Random(3)
    rows, truth = [], {}
    for i in range(400):
        if i % 2:
            rows.append((i, f'some words {rng.choice(["token", "secret", "password", "api_key"])} = "{secret(rng)}" more words'))
        else:
            rows.append((i, f"some words {rng.choice(['commit', 'order', 'number'])} {rng.choice([str(rng.randrange(10**15, 10**16)), 'the-and-that-with-2020'])} more words"))
        truth[i] = float(i % 2)
    found = S.described(S.findings(docs_of(rows)))
    labels = spark.createDataFrame(list(truth.items()), "id bigint, label double")
    labelled = found.join(labels, found["doc_id"] == F.col("id")).drop("id")
    model = S.trained(labelled.filter("doc_id < 200"))
    rest = S.judged(labelled.filter("doc_id >= 200"), model).collect()
    assert len(rest) == 200 and sum(r["is_secret"] == bool(r["label"]) for r in rest) >= 196
    assert S.trained(labelled.filter("label = 1")) is None
    assert S.judged(found, None).filter("is_secret").count() == 200


def test_whole_table(spark):
    rows = S.op10(spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    told = {(r["doc_id"], r["start"]): r["is_secret"] for r in rows}
    planted = [(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t)]
    numbers = [(i, m.start()) for i, t in texts.items() for m in re.finditer(r"(?<![A-Za-z0-9_+/-])[0-9]{13,19}(?![A-Za-z0-9_+/=-])", t)]
    assert planted and all(told[p] for p in planted)
    assert numbers and not any(told[p] for p in numbers)
