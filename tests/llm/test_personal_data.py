import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from rankloom.llm import personal_data as P

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def base_of(rows):
    return {r["doc_id"]: [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["base"]] for r in rows}


EDGE = [
    None,
    "",
    "no data here",
    "é漢 a@b.co x@a.b_c@d.e _@x.y.z-",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 0.0.0.0",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111",
    "+1 (663) 555-6869 +49.30.1234567. +123",
    "4111111111111111" * 2,
    "1" * 20000,
    "a" * 50000 + "@" + "b." * 3000 + "c",
    "9 8 7 6 5 4 3 2 1 0 " * 300,
    "a@b.c, " * 700 + "é" + " 10.0.0.1" * 130,
]


def test_base_spans_equal_plain_matching(docs_of):
    rng = random.Random(6)
    bits = ["a", "é", "@", ".", "1", "22", "255", "+", " ", "-", "(", ")", "_", "b@c.d", "4111111111111111", "\n", "10.0.0."]
    texts = EDGE + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    docs = docs_of(list(enumerate(texts))).withColumn("spans", F.lit("clash")).withColumn("other", F.lit(1))
    got = base_of(P.personal_data(docs).collect())
    for i, text in enumerate(texts):
        assert got[i] == brute(text), (i, (text or "")[:80])


def test_trusted_contexts_reveal_other_forms(docs_of):
    names = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, f"{w} please call +1 (20{i}) 555-01{10 + i} today {w}") for i, w in enumerate(names)]
    rows += [(20, "please call (207) 555-0199 today"), (21, "please call 12 today"), (22, "the number 2075550123 stands alone"), (22, "copy 2075550123 stands alone")]
    got = {}
    for r in P.personal_data(docs_of(rows)).collect():
        got.setdefault(r["doc_id"], []).append([(s["kind"], s["text"]) for s in r["spans"]])
    assert got[20] == [[("phone", "(207) 555-0199")]]
    assert got[21] == [[]] and got[22] == [[], []]
    assert all(len(got[i][0]) == 1 for i in range(8))


def test_rounds_go_on_until_nothing_new_is_found(docs_of):
    # The context of a stage is trusted only once the stage before it has been found.
    rows, number = [], iter(range(100, 10_000))
    found = [f"+1 (663) 555-{next(number):04d}" for _ in range(2)]
    for stage in range(6):
        sure = [f"+1 (663) 555-{next(number):04d}" for _ in range(9)]
        new = [f"(663) 555-{next(number):04d}" for _ in range(2)]
        rows += [(stage, f"word{'abcdef'[stage]} {item}") for item in sure + found + new]
        found = new
    got = P.personal_data(docs_of(rows)).collect()
    assert len(got) == 6 * 13 and all([s["kind"] for s in r["spans"]] == ["phone"] for r in got)


def test_candidates_beside_many_spans(docs_of):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a@b.co ", "10.0.0.1 ", "+1 (663) 555-6869 ", "77-88 ", "x@y ", "1.2.3.4.5 ", "é "]) for _ in range(rng.randint(30, 300))) for _ in range(30)]
    found = P.base_spans(docs_of(list(enumerate(texts)))).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]]
        known = [tuple(map(int, s.split(":")[1:])) for s in brute(text)]
        every = [(m.start(), m.end()) for m in re.finditer(P.CANDIDATE, text)]
        assert [(c["start"], c["end"]) for c in r["other"]] == [(a, b) for a, b in every if not any(s < b and a < e for s, e in known)]


def test_a_text_of_very_many_spans_stays_quick(docs_of):
    docs = docs_of([(1, "a@b.co and 77-88 or " * 16_000)])
    began = time.time()
    row = P.personal_data(docs).select(F.size("base").alias("n"), F.size("spans").alias("all")).first()
    assert (row["n"], row["all"]) == (16_000, 16_000) and time.time() - began < 30


def test_redaction_takes_effect(docs_of):
    docs = docs_of([(1, "write a@b.co or 10.0.0.1 now"), (2, "nothing"), (None, "é +1 (663) 555-6869"), (3, None), (1, "other a@b.co"), (4, "4111 1111 1111 1111"), (4, "4111 1111 1111 1111")])
    left = P.redacted(docs)
    assert left.columns == docs.columns
    rows = sorted((r["doc_id"] or 0, r["text"], r["n_chars"]) for r in left.collect() if r["text"])
    assert rows == [(0, "é [PHONE]", 9), (1, "other [EMAIL]", 13), (1, "write [EMAIL] or [IP] now", 25), (2, "nothing", 7), (4, "[CARD]", 6), (4, "[CARD]", 6)]
    assert left.count() == 7 and P.redacted(docs_of([])).count() == 0


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = P.op1(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s.startswith(k) for s in want) for k in P.KINDS]
        assert set(want) <= set(r["spans"].split(",") if r["spans"] else [])
