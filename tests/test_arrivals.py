"""Keyed publishing over several batches, state on disk, restarts."""

import datetime

from pyspark.sql import functions as F

from rankloom.session import scratch_path
from rankloom.streaming import arrivals as A


def events(spark, folder, name, dirs, day=1):
    at = datetime.datetime(2024, 1, day)
    df = spark.createDataFrame([(i, at, d) for i, d in enumerate(dirs)], "event_id bigint, ts timestamp, dir string")
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream_of(spark, folder):
    return spark.readStream.schema("event_id bigint, ts timestamp, dir string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_newest_version_of_each_key_over_three_batches(spark):
    root, folder, check = (scratch_path(spark, n) for n in ("published", "events", "check"))

    def publish(batch, number):
        rows = batch.select("dir").distinct().withColumn("version", F.lit(int(number)))
        rows.unionByName(rows).write.mode("overwrite").parquet(f"{root}/batch={number}")

    for at, dirs in enumerate([["a", "b"], ["b", "c"], ["a", "c", "c"]]):
        events(spark, folder, f"part{at}", dirs)
        A.publish_new(stream_of(spark, folder), publish, check)
    got = sorted((r["dir"], r["version"]) for r in A.newest_versions(spark, root, "dir").collect())
    assert got == [("a", 2), ("a", 2), ("b", 1), ("b", 1), ("c", 2), ("c", 2)]
    out = scratch_path(spark, "compacted")
    A.compact(spark, root, "dir", out)
    assert sorted((r["dir"], r["version"]) for r in spark.read.parquet(out).collect()) == got


def test_state_on_disk_survives_a_restart(spark):
    folder, out, check = (scratch_path(spark, n) for n in ("events", "out", "check"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    events(spark, folder, "one", ["a", "b", "a"])
    A.drain_to(A.first_arrivals(stream_of(spark, folder)), out, check)
    events(spark, folder, "two", ["b", "c"])
    A.drain_to(A.first_arrivals(stream_of(spark, folder)), out, check)
    assert sorted(r["dir"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_expiring_state_forgets(spark):
    folder, out, check = (scratch_path(spark, n) for n in ("events", "out", "check"))
    for day, dirs in ((1, ["a", "a"]), (2, ["a"]), (20, ["b"]), (25, ["a"])):
        events(spark, folder, f"day{day}", dirs, day)
        A.drain_to(A.first_arrivals_within(stream_of(spark, folder), "3 days").select("dir"), out, check)
    assert sorted(r["dir"] for r in spark.read.parquet(out).collect()) == ["a", "a", "b"]
