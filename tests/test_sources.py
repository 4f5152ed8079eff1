import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from rankloom.functions import structured as J
from rankloom.sources import files as FS
from rankloom.sources import sinks as K
from rankloom.sources import tables as TB
from rankloom.streaming import arrivals as A


def docx(paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    return buf.getvalue()


def test_listing_and_extraction(spark, tmp_path):
    folder = tmp_path / "resumes" / "job7"
    folder.mkdir(parents=True)
    (folder / "r1_jane.docx").write_bytes(docx(["Jane", "Dev"]))
    (folder / "r2_joe.pdf").write_bytes(b"%PDF")
    (folder / "r3_note.txt").write_text("hé", encoding="utf-8")
    listed = FS.resume_listing(FS.read_files(spark, str(tmp_path))).select("job_id", "resume_id", "filename").collect()
    assert sorted(map(tuple, listed)) == [("job7", "r1", "jane.docx"), ("job7", "r2", "joe.pdf")]
    out = {os.path.basename(r["path"]): r for r in FS.extract_text(FS.read_files(spark, str(tmp_path), "*")).collect()}
    assert out["r1_jane.docx"]["text"] == "Jane\nDev" and out["r3_note.txt"]["text"] == "hé"
    assert out["r2_joe.pdf"]["text"] is None and out["r2_joe.pdf"]["problem"] == "unsupported extension"
    added = FS.extract_text(FS.read_files(spark, str(tmp_path), "*.pdf"), readers={"pdf": lambda b: "pdf!"}).first()
    assert added["text"] == "pdf!"


def test_one_bad_file_does_not_fail_the_job(spark):
    df = spark.createDataFrame([("a.docx", bytearray(b"broken")), ("b.txt", bytearray(b"ok"))], "path string, content binary")
    got = {r["path"]: r for r in FS.extract_text(df).collect()}
    assert got["b.txt"]["text"] == "ok" and got["a.docx"]["text"] is None and "BadZipFile" in got["a.docx"]["problem"]


def test_zip_rules_and_chunks(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n in ["a/", "a/x.pdf", "a/y.PDF", "__MACOSX/x.pdf", "a/.DS_Store", "n.txt"]:
            z.writestr(n, "" if n.endswith("/") else "data")
    df = spark.createDataFrame([("z.zip", bytearray(buf.getvalue()))], "path string, content binary")
    got = {r["member"]: r["skipped"] for r in FS.expand_zips(df, chunk_bytes=1).collect()}
    assert got == {"a/": True, "a/x.pdf": False, "a/y.PDF": False, "__MACOSX/x.pdf": True, "a/.DS_Store": True, "n.txt": True}


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("d/train_1.csv", 1), ("d/train_2.csv", 5), ("d/test_9.csv", 9)], "path string, modified long")
    assert FS.require_snapshot(df, "train") == "d/train_2.csv"
    with pytest.raises(FileNotFoundError, match="prod"):
        FS.require_snapshot(df, "prod")
    more = df.union(spark.createDataFrame([("d/train_3.csv", 5), ("d/new_kind_1.csv", 2), ("d/plain.csv", 99), (None, 7)], df.schema))
    got = {r["prefix"]: r["path"] for r in FS.latest_snapshots(more, FS.file_prefix(more["path"])).collect()}
    assert got == {"train": "d/train_3.csv", "test": "d/test_9.csv", "new_kind": "d/new_kind_1.csv"}


def test_csv_round_trip(spark, tmp_path):
    rows = [('say "hi",\nthere', "j\\n", "Good Fit"), ("", "x", "No Fit")]
    df = spark.createDataFrame(rows, "resume_text string, job_description_text string, label string")
    back = TB.read_pairs_csv(spark, K.write_csv_snapshot(df, str(tmp_path), "train"))
    got = sorted((r["resume_text"] or "", r["job_description_text"], r["label"]) for r in back.collect())
    assert got == sorted(rows)
    bad = K.write_csv_snapshot(df.drop("label"), str(tmp_path), "bad")
    with pytest.raises(ValueError, match="missing columns: label"):
        TB.read_pairs_csv(spark, bad)


@pytest.mark.parametrize(
    "raw, n",
    [('[{"id": "1"}]', 1), ('{"jobs": [{"id": "1"}, {"id": "2"}]}', 2), ('{"data": []}', 0), ('{"id": "1"}', 1), ("oops", 0), ("", 0), ('{"other": 1}', 0)],
)
def test_envelopes(spark, raw, n):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert TB.rows_of(df, "raw", "struct<id: string>", ["id"]).count() == n


def test_failed_calls_are_isolated(spark):
    def write(rows):
        if any(r["id"] == 7 for r in rows):
            raise RuntimeError("no")

    calls = K.write_in_batches(spark.range(0, 50, 1, 1), write, size=10).collect()
    assert sum(r["n_rows"] for r in calls) == 50 and sum(r["error"] is not None for r in calls) == 1


def test_validation_messages(spark):
    raws = [
        '{"basics": {"name": "a"}, "workexp": [{"company_name": "c", "position": "p"}]}',
        '{"workexp": [{"companyName": "c", "position": "p"}, {"companyName": null}]}',
        '{"basics": {}, "awards": [{"title": "t", "dateReceived": null}], "certificates": [{"issuer": "i"}]}',
        "nope",
    ]
    df = spark.createDataFrame(list(enumerate(raws)), "i long, raw string")
    got = {r["i"]: r["errors"] for r in J.validate(df, "raw").collect()}
    assert got[0] == []
    assert got[1] == [
        "basics: Field required (value: 'N/A')",
        "workexp.1.companyName: Input should be a valid string (value: 'None')",
        "workexp.1.position: Field required (value: 'N/A')",
    ]
    assert got[2] == ["certificates.0.certificateName: Field required (value: 'N/A')", "certificates.0.dateIssued: Field required (value: 'N/A')"]
    assert got[3] == ["Invalid JSON"]


def test_coercion(spark):
    vals = ["3", "3.7", "x", "", None, "-2"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(J.int_or_zero(F.col("v"))).collect()] == [3, 3, 0, 0, 0, -2]


def test_stream_first_arrival_over_several_batches(spark, tmp_path):
    src, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = [(1, 5, "signup", 1), (2, 5, "signup", 2), (3, 6, "view", 3), (4, 6, "signup", 4)]
    more = [(5, 5, "signup", 5), (6, 8, "signup", 6)]

    def put(data):
        df = spark.createDataFrame(data, "event_id long, user_id long, event_type string, s long")
        df.selectExpr("event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts", "user_id", "event_type", "1.0D AS value", "'{}' AS props").coalesce(1).write.mode("append").parquet(src)

    from rankloom.plans.fixtures import arrivals_of

    def run():
        stream = A.finalized(arrivals_of(A.read_events(spark, src, "*.parquet", files_per_trigger=1)))
        A.publish_new(stream, A.seen_table_publisher(out), check)
        return sorted((str(r["dir"]), r["event_id"]) for r in spark.read.parquet(out).collect())

    put(rows)
    assert run() == [("5", 1), ("6", 4)]
    put(more)
    assert run() == [("5", 1), ("6", 4), ("8", 6)]
    assert run() == [("5", 1), ("6", 4), ("8", 6)]
