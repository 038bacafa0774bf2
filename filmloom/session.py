"""Session construction and lineage control."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "filmloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on.

    Cluster-level sizing (executors, memory, shuffle partitions) is left to
    ``spark-submit``; anything passed in ``conf`` wins.
    """
    # One core per task: a BLAS with its own threads would have tasks fight for cores.
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    settings = {
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # The JVM never compiles methods above 8,000 bytes; wide vector sums run
        # faster outside whole-stage code than in an interpreted method.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    a cluster session must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="filmloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def spread_rows(df: DataFrame) -> DataFrame:
    """Even partitions for compute-heavy steps.

    Adaptive execution merges small shuffle partitions by their bytes; steps that
    do much work per byte (matrix products, model passes, repeated joins) want at
    least one partition per core instead, and hot keys dealt out evenly.
    """
    spark = df.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(width)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative jobs neither replay nor lose their history."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Shuffle files go with the query that made them; by default they stay until the driver collects its garbage.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries in here remove their shuffle files as they end."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


class StepTables:
    """Tables of an iteration in the shared folder, read back after each step.

    A checkpoint keeps the size estimate of the plan it cuts, and joins multiply estimates: after a few steps that join a
    state with what was made from it, the estimate has millions of digits. A written table has the size of its files. Once it
    is written its shuffle files are of no use and go, so that the disk holds those of one step.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/steps-{uuid.uuid4().hex}"
        self.paths: dict[str, list[str]] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """The table as written; the one before the last of this name goes."""
        kept = self.paths.setdefault(name, [])
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        with freed_shuffles(self.spark):
            df.write.parquet(path)
        kept.append(path)
        while len(kept) > 2:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(kept.pop(0))
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        return self.spark.read.schema(df.schema).parquet(path)
