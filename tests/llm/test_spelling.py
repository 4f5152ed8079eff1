import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rankloom.llm import spelling as S


def near_of(word, words):
    """All words one edit away, by making every edit."""
    letters = {c for w in words for c in w}
    made = {word[:i] + word[i + 1 :] for i in range(len(word))}
    made |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    made |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return sorted((made & words) - {word})


def brute(rows, least=5):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= least}
    form, near = {}, {}
    for w in n:
        near[w] = near_of(w, set(n))
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def made(docs, **kw):
    return sorted(tuple(r) for r in S.variants(docs, **kw).collect())


def spelled(rng, word):
    at = rng.randrange(len(word))
    kind = rng.randrange(4)
    c = rng.choice("aeéß×zn")
    return [word, word[:at] + word[at + 1 :], word[:at] + c + word[at + 1 :], word[:at] + c + word[at:]][kind]


def sample(docs=60, seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["listen", "silent", "enlist", "Äußerung"]
    return [(i, " ".join(spelled(rng, rng.choice(base[: 1 + i])) if rng.random() < 0.4 else rng.choice(base) for _ in range(120))) for i in range(docs)]


def test_equals_brute_force(docs_of):
    rows = sample() + [(900, None), (901, ""), (902, "1 2 3 日本語"), (None, "Geheimnis " * 20), (903, "geheimnis " * 4 + "geheimnisse " * 7), (903, "geheimnis " * 4)]
    got = made(docs_of(rows).repartition(3))
    assert got == brute(rows)
    assert sum(r[1] is not None for r in got) > 20


def test_forms_are_followed_to_the_last(docs_of):
    rows = [(1, "abcdefg " * 900 + "abcdefgh " * 170 + "abcdefghi " * 30 + "abcdefghij " * 5)]
    got = {r[0]: r for r in made(docs_of(rows))}
    assert got["abcdefghij"][1:3] == ("abcdefghi", "abcdefg") and got["abcdefg"][1:3] == (None, "abcdefg")
    assert sorted(got.values()) == brute(rows)


def test_small_parts_and_a_small_sample(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdef") for _ in range(7)) for _ in range(60)]
    words = sorted({spelled(rng, w) for w in base * 30})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    expected = sorted((a, b) for a in words for b in near_of(a, set(words)) if (len(a), a) < (len(b), b))
    assert len(expected) > 300
    for sample_, part in [(10**6, 10), (40, 10), (10**6, 10**6)]:
        assert sorted(tuple(r) for r in S.near_words(df, sample_, part).collect()) == expected


def test_boxes_leave_most_words_out():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("etaoinshrdlu") for _ in range(8)) for _ in range(4000)})
    counts = S.letter_counts(S.codes_of(words))
    tree = S.Tree(counts, S.BOX)
    met = sum(len(at) * len(tree.members[leaf]) for leaf, at in tree.within(counts, 1, 1))
    assert met < 0.2 * len(words) ** 2
    assert all((tree.members[leaf] == at).all() for leaf, at in tree.within(counts, 0, 0))
    for i in range(0, len(words), 501):
        reach = {m for leaf, _ in tree.within(counts[i : i + 1], 1, 1) for m in tree.members[leaf]}
        apart = counts - counts[i]
        assert set(np.flatnonzero((np.maximum(apart, 0).sum(axis=1) <= 1) & (np.maximum(-apart, 0).sum(axis=1) <= 1))) <= reach


def test_slices_keep_runs_whole(monkeypatch):
    text = " ".join(random.Random(1).choice(["word", "Ärger,", "x" * 40]) for _ in range(50))
    whole = [r for part in S.runs_of(text) for r in part]
    monkeypatch.setattr(S, "SLICE", 16)
    assert [r for part in S.runs_of(text) for r in part] == whole


def test_empty_table_and_clashing_columns(docs_of):
    assert made(docs_of([])) == []
    rows = [(i, "colour colours colour colour colour colour") for i in range(10)]
    extra = docs_of(rows).withColumns({"word": F.lit("x"), "form": F.lit("y"), "leaf": F.lit(1), "role": F.lit(1)})
    assert made(extra) == brute(rows)


def test_short_runs_are_not_handed_on():
    text = "Abcdef ab ABCDE1ÀBCDEF Éa aBCDEFGHIJ"
    assert [r for part in S.runs_of(text) for r in part] == ["abcdef", "Àbcdef", "abcdefghij"]
