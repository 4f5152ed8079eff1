import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rankloom.llm import packing as P

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))

TEXTS = [
    None,
    "",
    " ",
    "plain words here",
    "plain words here",
    "  two  spaces  ",
    "line\nbreaks \n and\ttabs\n\n",
    " leading and trailing ",
    "été naïve 漢字   nbsp em",
    "it's <|endoftext|> here",
    "long " * 3000,
    "x" * 5000,
]


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, P.SEPARATOR]


def check(rows, texts, length):
    """Every id lies in one piece, sequences have no gap and no overlap."""
    seen = {}
    for r in rows:
        ids = ids_of(texts[r["doc_id"]])
        piece = ids[r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and len(ids) == r["doc_tokens"]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for i, text in enumerate(texts):
        at = 0
        for start, n in sorted(seen[i]):
            assert start == at
            at += n
        assert at == len(ids_of(text))
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return by


@pytest.mark.parametrize("cell_rows", [20_000, 2])
def test_every_id_lies_in_one_piece(spark, docs_of, monkeypatch, cell_rows):
    monkeypatch.setattr(P, "CELL_ROWS", cell_rows)
    texts = TEXTS + ["the cat " * (i % 7) for i in range(60)]
    rows = P.digests(docs_of(list(enumerate(texts))).withColumnRenamed("lang", "length"), length=64).collect()
    check(rows, texts, 64)


def test_pieces_carry_ids(docs_of):
    row = P.packed(docs_of([(7, "some words")])).collect()[0]
    assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == ids_of("some words")


def test_ranked_cells_do_not_hold_many_bytes(docs_of, monkeypatch):
    # 20,000 whole sequences are 160 MB of ids; without ids they are few bytes.
    assert P.cells({2048: 20_000, 10: 20_000, 11: 20_001}, True) == [(2048, 10), (10, 1), (11, 2)]
    assert P.cells({2048: 20_000, 10: 20_000, 11: 20_001}, False) == [(2048, 1), (10, 1), (11, 2)]
    monkeypatch.setattr(P, "CELL_BYTES", 3 * 4 * 64)
    seen, plain = [], P.cells
    monkeypatch.setattr(P, "cells", lambda histogram, wide: seen.append((wide, plain(histogram, wide))) or plain(histogram, wide))
    texts = ["the cat " * (i % 90) for i in range(120)] + [None]
    rows = [r.asDict() for r in P.packed(docs_of(list(enumerate(texts))), length=64).collect()]
    check([r | {"ids_crc32": zlib.crc32(bytes(r["ids"]))} for r in rows], texts, 64)
    ((wide, dealt),) = seen
    full = sum(r["length"] == 64 for r in rows)
    assert wide and full > 30 and dict(dealt)[64] == -(-full // 3)


def test_repeated_and_empty(docs_of):
    rows = P.digests(docs_of([(1, "a b"), (1, "a b"), (None, "a b")])).collect()
    assert len(rows) == 3 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3
    assert P.digests(docs_of([])).count() == 0


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = P.op8(spark, d).collect()
    by = check(rows, [texts[i] for i in range(len(texts))], P.SEQUENCE)
    filled = [sum(n for _, n in parts) for parts in by.values()]
    assert sum(P.SEQUENCE - f for f in filled if f & (f - 1)) <= 0.02 * sum(filled)


def brute(histogram, length):
    """One piece at a time into the shortest pack with room."""
    packs = []
    for size in sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True):
        fits = [p for p in packs if sum(p) + size <= length]
        if fits:
            min(fits, key=sum).append(size)
        else:
            packs.append([size])
    return packs


def test_patterns_follow_the_rule_piece_by_piece():
    rng = random.Random(3)
    for _ in range(30):
        histogram = {rng.randint(1, 40): rng.randint(1, 9) for _ in range(rng.randint(1, 12))}
        found = P.patterns(histogram, 40)
        want = brute(histogram, 40)
        assert sorted(sum(p) for p, n in found for _ in range(n)) == sorted(map(sum, want))
        placed = {}
        for p, n in found:
            for size in p:
                placed[size] = placed.get(size, 0) + n
        assert placed == histogram
