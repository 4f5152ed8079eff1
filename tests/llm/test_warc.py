import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from rankloom.llm import warc as W

PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (5, "http://a/5", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (2, "http://a/2", None),
    (4, "http://a/4\nx", ""),
    (7, "http://a/7", "é漢\r\n\r\nWARC/1.1\r\n\n"),
    (8, "http://a/8", "x" * 3_000_000),
    (9, "http://a/9", "twice"),
    (9, "http://a/9", "twice"),
    (None, "http://a/n", "no id"),
    (None, "http://a/n", "no id"),
    (None, "http://a/m", "<p>same</p>"),
]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash")).withColumn("record_type", F.lit(1))


def test_round_trip(spark):
    rows = [r.asDict() for r in W.round_trip(pages_of(spark, PAGES)).collect()]
    assert len(rows) == len(PAGES)
    by = {}
    for r in rows:
        by.setdefault(r["page_id"], []).append(r)
    for page, _, html in PAGES:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert any(r["payload_digest"] == digest and r["payload_bytes"] == len(payload) for r in by[page])
        for r in by[page]:
            if r["record_type"] == "response" and r["payload_digest"] == digest:
                assert bytes(r["payload"]) == payload
    kinds = {(p, r["record_type"], r["refers_to"]) for p in (1, 5, 3, 2, 4, 7, 8) for r in by[p]}
    assert kinds == {(1, "revisit", 5), (5, "response", None), (3, "revisit", 5), (2, "revisit", 4), (4, "response", None), (7, "response", None), (8, "response", None)}
    assert sorted((r["record_type"], r["refers_to"]) for r in by[9]) == [("response", None), ("revisit", 9)]
    same = [r for r in by[None] if r["payload_bytes"] == 11]
    assert [(r["record_type"], r["refers_to"]) for r in same] == [("revisit", 5)]
    assert sorted(r["record_type"] for r in by[None] if r["payload_bytes"] == 5) == ["response", "revisit"]


def test_small_payloads_are_responses(spark):
    rows = W.round_trip(pages_of(spark, PAGES[:3]), least_bytes=100).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    assert W.round_trip(pages_of(spark, [])).count() == 0


def test_every_record_is_a_member_at_its_offset(spark, tmp_path):
    raw, out = f"file://{tmp_path}/raw", f"file://{tmp_path}/out"
    W.write_archives(W.with_types(pages_of(spark, PAGES[:8]).coalesce(1)), raw)
    index = W.normalise(spark, raw, out).collect()
    assert len(index) == 8
    for name in {r["archive"] for r in index}:
        whole = (tmp_path / "out" / name).read_bytes()
        lines = [x.split("\t") for x in (tmp_path / "out" / f"{name}.idx").read_text().splitlines()]
        mine = sorted((r["offset"], r["length"], r["record_id"]) for r in index if r["archive"] == name)
        assert mine == [(int(a), int(b), c) for a, b, c in lines]
        for offset, length, record_id in mine:
            engine = zlib.decompressobj(31)
            record = engine.decompress(whole[offset : offset + length])
            assert engine.eof and not engine.unused_data and record_id.encode() in record and record.startswith(b"WARC/1.1\r\n")
        assert sum(n for _, n, _ in mine) == len(whole)
        before = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "raw").glob("*.gz")))
        assert sorted(gzip.decompress(whole).split(b"WARC/1.1")) <= sorted(before.split(b"WARC/1.1"))
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_broken_archives_are_refused():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert list(W.split_records(W.inflated(io.BytesIO(gzip.compress(record) + gzip.compress(record * 2))))) == [record] * 3
    for cut in (record[:-7], record + b"WARC/1.1\r\nCon"):
        with pytest.raises(ValueError):
            list(W.split_records([cut]))


def test_names_with_dots_stay_apart(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:%d>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    folder = tmp_path / "in"
    folder.mkdir()
    for i in (1, 2):
        (folder / f"crawl.0{i}.warc.gz").write_bytes(gzip.compress(record % i))
    index = W.normalise(spark, str(folder), str(tmp_path / "out")).collect()
    assert sorted((r["archive"], r["record_id"]) for r in index) == [("crawl.01.warc.gz", "<urn:1>"), ("crawl.02.warc.gz", "<urn:2>")]
    (folder / "crawl.01.gz").write_bytes(gzip.compress(record % 3))
    with pytest.raises(ValueError, match="crawl.01.warc.gz"):
        W.normalise(spark, str(folder), str(tmp_path / "again"))
