import random

from pyspark.sql import functions as F

from rankloom.llm import licence_dice as L


def words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def grams(text):
    w = words(text)
    return set(zip(w, w[1:])) if len(w) > 1 else set(w)


def brute(text):
    import re

    text = text or ""
    paragraphs = re.split(r"\n[ \t]*\n", text)
    units = text.split("\n") + [p for p in paragraphs if "\n" in p] + ([text] if len(paragraphs) > 1 else [])
    out = []
    for u in units:
        g = grams(u)
        scores = [(2 * len(g & grams(t)) / (len(g) + len(grams(t))), n) for n, t in L.TEMPLATES.items()]
        top = max(s for s, _ in scores)
        if g and top >= L.LEAST:
            out.append((min(n for s, n in scores if s == top), round(top, 9)))
    return out


def test_against_every_template(docs_of):
    rng = random.Random(3)
    texts = [None, "", "\n\n", "Licensed", "MIT", "plain text\n\nwith two paragraphs"]
    for t in L.TEMPLATES.values():
        w = t.split()
        texts += [t, t.upper(), "intro\n" + t + "\noutro", t.replace(" ", "  ")]
        cut = list(w)
        for _ in range(rng.randint(0, max(1, len(w) // 6))):
            cut[rng.randrange(len(cut))] = "changed"
        texts.append(" ".join(cut))
        half = len(w) // 2
        texts += [" ".join(w[:half]) + "\n" + " ".join(w[half:]), "first\n\n" + " ".join(w[:half]) + "\n" + " ".join(w[half:]) + "\n \nlast"]
    texts.append("word " * 30000 + "\n" + L.TEMPLATES["MIT"])
    docs = docs_of(list(enumerate(texts)) + [(None, L.TEMPLATES["MIT"])]).withColumn("matches", F.lit("clash"))
    rows = L.licence_matches(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = brute(texts[r["doc_id"]] if r["doc_id"] is not None else L.TEMPLATES["MIT"])
        assert [(m["licence"], round(m["dice"], 9)) for m in r["matches"]] == want, r["doc_id"]
    assert L.licence_matches(docs_of([])).count() == 0


def brute_notices(text):
    """Windows of template size, over what the matching units leave."""
    import re

    text = text or ""
    served = lambda u: bool(brute(u.replace("\n", " ")))
    paragraphs = re.split(r"\n[ \t]*\n", text)
    out = []
    for p in paragraphs:
        out += [L.SERVED] if "\n" in p and served(p) else [L.SERVED if served(t) else t for t in p.split("\n")]
    w = [] if len(paragraphs) > 1 and served(text) else words(" ".join(out))
    hits = []
    for name, t in {**L.TEMPLATES, **L.HEADERS}.items():
        own, m = grams(t), len(words(t))
        for i in range(len(w) - 1):
            if (w[i], w[i + 1]) in own:
                g = grams(" ".join(w[i : i + m]))
                common = len(g & own)
                dice = 2 * common / (len(g) + len(own))
                if dice >= L.LEAST:
                    hits.append((-common, -dice, name, i, min(i + m, len(w))))
    taken = []
    for x in sorted(hits):
        if all(x[3] >= y[4] or y[3] >= x[4] for y in taken):
            taken.append(x)
    return [(n, round(-d, 9)) for _, d, n, *_ in sorted(taken, key=lambda x: x[3])]


def test_notices_that_share_their_line(docs_of):
    rng = random.Random(7)
    known = {**L.TEMPLATES, **L.HEADERS}
    plain = "some words of the text that have to do with no licence in any way at all".split()
    fill = lambda: " ".join(rng.choice(plain) for _ in range(rng.randint(3, 30)))
    texts, sure = [None, "", "of the", fill()], {}
    for start, name in [
        ("This project is released under the MIT License.", "MIT"),
        ("Copyright 2024 Jane Doe. Released under the MIT License.", "MIT"),
        ("Copyright (c) 2024 Jane Doe. Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ] + [(fill() + " " + t + " " + fill(), n) for n, t in known.items()]:
        sure[len(texts)] = name
        texts.append(start)
    for t in known.values():
        w = t.split()
        wrapped = "\n".join(" ".join(w[i : i + 9]) for i in range(0, len(w), 9))
        texts += [fill() + "\n" + wrapped + "\n" + fill(), fill() + " " + t + "\n" + L.TEMPLATES["MIT"] + "\n\nend " + t]
        cut = list(w)
        cut[rng.randrange(len(cut))] = "changed"
        texts.append(fill() + " " + " ".join(cut) + " " + fill())
    rows = L.all_matches(docs_of(list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert [(m["licence"], round(m["dice"], 9)) for m in r["notices"]] == brute_notices(text), text
        if r["doc_id"] in sure:
            assert sure[r["doc_id"]] in [m["licence"] for m in [*r["matches"], *r["notices"]]], text
