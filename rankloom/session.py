"""Session construction and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rankloom", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session with the settings the library relies on.

    ``master`` and ``partitions`` are for local runs; on a cluster both come
    from the submit command and are left alone.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        # Small local tables still keep every core busy.
        b = b.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        b = b.master(master).config("spark.driver.memory", os.environ.get("RANKLOOM_DRIVER_MEMORY", "12g"))
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the cluster names none, a local session (tests) gets a temporary folder;
    any other session is refused, since executors do not share local folders.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if named is None and current.isDefined():
        return current.get()
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {sc.master} share")
        named = tempfile.mkdtemp(prefix="rankloom-")
    if not current.isDefined():
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    A lost executor then costs a re-read and not a replay of every step before.
    Reading back also gives the optimizer true sizes: the estimate of a
    checkpointed join keeps multiplying from step to step.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Files that a task keeps open at once instead of sorting its rows; with more buckets in a task, the rest is sorted.
OPEN_FILES = 8


@contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Tasks hand rows on to their bucket's file as they come. Otherwise Spark sorts all rows of a task
    by bucket first, in memory or on disk, even where they are of one bucket."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(OPEN_FILES, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def laid_out(df: DataFrame, keys: list[str], spread: bool = True, **options: str) -> Iterator[DataFrame]:
    """A frame written in buckets of ``keys`` below the shared folder, for joins on them that are
    made again and again: the frame is not shuffled for those. The table's name lives as
    long as the context; frames made from it have to be written before that ends. Without
    ``spread`` a frame that is spread by ``keys`` already is written as it lies. ``options`` go to the writer."""
    spark = df.sparkSession
    name = f"laid_out_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(buckets, *keys) if spread else df
    with _unsorted_writes(spark):
        rows.write.bucketBy(buckets, *keys).options(path=scratch_path(spark, "buckets"), **options).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
