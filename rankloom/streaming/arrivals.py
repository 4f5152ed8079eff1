"""Arrival stream: filter, block list, first arrival per directory, publishing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
FINALIZE = "OBJECT_FINALIZE"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Names that sit next to the directories but are not directories.
BLOCKED = ("seen_directories.txt",)


def read_events(spark: SparkSession, folder: str, glob: str = "events.parquet", files_per_trigger: int = 100) -> DataFrame:
    """File stream of event messages; a trigger takes a bounded number of files. What
    ``glob`` names in the folder may be files or folders of part files."""
    # A stream takes a plain path for a folder; braces make it a pattern, which a file may match too.
    path = f"{folder.rstrip('/')}/{{{glob}}}"
    return spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def finalized(messages: DataFrame) -> DataFrame:
    """Messages that announce a finished object, with the directory they are in."""
    return messages.filter(F.col("event_type") == FINALIZE).withColumn("dir", F.split_part("object_id", F.lit("/"), F.lit(2)))


def without_blocked(messages: DataFrame, blocked: DataFrame) -> DataFrame:
    """Drop directories on a list; on a stream this is a stream-static anti join."""
    return messages.join(blocked, "dir", "left_anti")


def first_arrivals(messages: DataFrame) -> DataFrame:
    """One message per directory for good: the state is the set of directories seen."""
    return messages.select("dir").dropDuplicates(["dir"])


def first_arrivals_within(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """As :func:`first_arrivals`, with state that expires ``delay`` after the watermark."""
    timed = messages.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.dropDuplicatesWithinWatermark(["dir"])


def decoded(messages: DataFrame, data: str = "data") -> DataFrame:
    """Message bytes to text and its JSON attributes."""
    text = F.decode(F.col(data), "utf-8")
    return messages.withColumn("text", text).withColumn("k", F.from_json(text, "k bigint")["k"])


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on disk (RocksDB), so that a set of keys
    without a bound does not have to fit in the executors' heap. A stream that has a
    checkpoint keeps the store it began with."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drain_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over everything that is there and append it to Parquet files."""
    with disk_state(stream.sparkSession):
        q = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()


def publish_new(stream: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``publish(batch, batch_id)`` for every micro-batch. The batch id names what
    is written, so a batch repeated after a failure replaces itself."""
    q = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def seen_table_publisher(root: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that keeps the earliest message of every directory not
    met in an earlier batch, one output folder per batch."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        from rankloom.operators.spread import keep_first

        fresh = keep_first(batch, ["dir"], ["ts", "event_id"])
        if batch_id > 0:
            earlier = batch.sparkSession.read.parquet(root).filter(F.col("batch") < batch_id).select("dir")
            fresh = fresh.join(earlier, "dir", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return publish


def newest_versions(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Rows of the newest batch that published each key, from a folder with one ``batch=``
    folder per micro-batch. What earlier batches published for the key is superseded."""
    from rankloom.operators.spread import lookup_join

    rows = spark.read.parquet(root)
    newest = rows.groupBy(key).agg(F.max("batch").alias("_newest"))
    return lookup_join(rows, newest, [key]).filter(F.col("batch") == F.col("_newest")).drop("_newest", "batch")


def compact(spark: SparkSession, root: str, key: str, out: str) -> None:
    """Write the newest versions as one table without superseded rows."""
    newest_versions(spark, root, key).write.mode("overwrite").parquet(out)
