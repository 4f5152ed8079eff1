from rankloom.operators import labels, scoring
from rankloom.streaming.arrivals import read_events


def test_unscored_and_keyless_rows_stay(spark):
    rows = [(1, 1, 50.0), (2, 1, None), (3, None, 70.0), (4, 1, 90.0), (None, 1, 80.0)]
    df = spark.createDataFrame(rows, "resume_id bigint, job_id bigint, overall double")
    got = {r["resume_id"]: r["status"] for r in scoring.rank_resumes(df).collect()}
    assert got == {4: 1, None: 2, 1: 3, 3: 1, 2: -2}


def test_a_null_writes_nothing(spark):
    base = spark.createDataFrame([(1, 0, 0)], "k int, v int, w int")
    updates = spark.createDataFrame([(1, 1, 1, None), (1, 2, None, 5), (2, 1, 7, None)], "k int, t int, v int, w int")
    got = sorted(tuple(r) for r in labels.upsert(base, updates, "k", ["t"], ["v", "w"]).collect())
    assert got == [(1, 1, 5), (2, 7, None)]


def test_stream_reads_files_and_folders(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name, folder in (("parts", str(tmp_path)), ("single", "/root/testdata/sf0.001")):
        q = read_events(spark, folder, files_per_trigger=1).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(name).count() == 1000
