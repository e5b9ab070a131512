"""Scratch tables in the folder that the cluster shares (spark.checkpoint.dir)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Only a local session without that setting gets a folder of its own choice.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/{_prefix(spark)}{uuid.uuid4().hex}"


def _prefix(spark: SparkSession) -> str:
    return f"tessera-{spark.sparkContext.applicationId}-"


#: Files of a small table at most: this many per core.
FILES_PER_CORE = 4


@contextmanager
def _shedding(spark: SparkSession, on: bool) -> Iterator[None]:
    """Spark deletes the shuffle files of a query that ends meanwhile, if on."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    if on:
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        if on:
            spark.conf.set(key, before)


def stored(df: DataFrame, small: bool = False, shed: bool = False) -> DataFrame:
    """The frame, written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read, not a recomputation, and what
    follows sees one result even where a retried task would make another.

    Every partition is a file, so the work before the write runs as wide as it is planned.
    small is for results that are little beside what they are made of and come from a
    shuffle, such as a round of an iteration: the last stage then runs in a few waves of
    all cores, so that many partitions do not become as many tiny files.  With dynamic
    allocation the cores are not known, so all files are written.
    shed deletes the shuffle files of the write at once, instead of when the driver happens
    to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    if small and spark.conf.get("spark.dynamicAllocation.enabled", "false") != "true":
        df = df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism)
    with _shedding(spark, shed):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def stored_by(df: DataFrame, *keys: str) -> DataFrame:
    """The frame, stored in buckets: joins on exactly these keys do not shuffle it.

    It is shuffled once, for the write, and those files are deleted at once.  A bucket is a
    file, as many as there are shuffle partitions; rows alike in the keys are in one bucket.
    The table is in the session's catalog only until the frame is made.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    name = f"spark_catalog.default.tessera_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _shedding(spark, True):
        df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, the frame knows them
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of frames that stored() returned and that no result reads any more.

    What was made of them must be stored itself; else a lost executor could not be made good.
    """
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete this application's scratch tables; results that still read them are lost.

    Returns how many there were.  For the end of an application.
    """
    base = scratch_dir(spark).rpartition("/")[0]
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{base}/{_prefix(spark)}*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x.getPath() for x in fs.globStatus(pattern) or []]
    return sum(bool(fs.delete(p, True)) for p in found)
