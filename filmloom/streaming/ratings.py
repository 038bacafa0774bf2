"""Structured Streaming forms of the incremental rating actions."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from filmloom.functions.coercion import coerce_id, coerce_numeric, epoch_to_timestamp
from filmloom.operators.cleaning import valid_rating
from filmloom.operators.relational import dedup_keep_first
from filmloom.plans.lifecycle import stage_of
from filmloom.sources.readers import path_exists


def rating_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def stream_user_stage(stream: DataFrame, cold: int = 5, warm: int = 20) -> DataFrame:
    """Running rating count and stage per user; write it in update mode."""
    counts = stream.groupBy("user_id").agg(F.count("*").alias("n_ratings"))
    return counts.withColumn("stage", stage_of(F.col("n_ratings"), cold, warm))


def stream_clean_ratings(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """Valid ratings, the first per (user, film).

    Without a watermark the key state grows for ever; with one, repeats are
    recognised only within that delay and the state stays bounded.
    """
    valid = stream.where(
        valid_rating(F.col("rating")) & F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()
    )
    keys = ["user_id", "movie_id"]
    if watermark:
        return valid.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)
    return valid.dropDuplicates(keys)


def coerced_ratings(raw: DataFrame) -> DataFrame:
    """Typed valid ratings from text columns ``user_id, movie_id, rating, timestamp`` (epoch seconds), batch or stream.

    Rows whose ids, rating or time don't parse, or whose rating is out of range, go.
    """
    typed = raw.select(
        coerce_id(F.col("user_id")).alias("user_id"),
        coerce_id(F.col("movie_id")).alias("movie_id"),
        coerce_numeric(F.col("rating")).alias("rating"),
        epoch_to_timestamp(F.col("timestamp")).alias("ts"),
    )
    return typed.dropna().where(valid_rating(F.col("rating")))


def stream_first_ratings(raw: DataFrame, watermark: str = "1 day", window: str = "1 day") -> DataFrame:
    """First rating by event time (ties: the lowest) per user, film and time window; write it in update mode.

    State holds the windows the watermark hasn't passed, so it follows the rate of the stream and not its age. A row that
    comes later than the watermark allows is dropped. An earlier rating that comes in time sends its window again, and a
    film rated in several windows has a row in each: ``first_ratings`` reads the one that counts.
    """
    rows = coerced_ratings(raw).withWatermark("ts", watermark)
    first = rows.groupBy(F.window("ts", window), "user_id", "movie_id").agg(F.min(F.struct("ts", "rating")).alias("first"))
    return first.select("user_id", "movie_id", "first.rating", "first.ts")


def first_ratings(written: DataFrame) -> DataFrame:
    """The first rating per (user, film) of what ``stream_first_ratings`` has written so far."""
    return dedup_keep_first(written.select("user_id", "movie_id", "rating", "ts"), ["user_id", "movie_id"], ["ts", "rating"])


class _StageChanges(StatefulProcessor):
    """Emits a row whenever a user's count moves them to another stage."""

    def __init__(self, cold: int, warm: int):
        self._limits = (cold, warm)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._count = handle.getValueState("count", T.StructType([T.StructField("n", T.LongType())]))

    def _stage(self, n: int) -> str:
        cold, warm = self._limits
        return "new" if n == 0 else "cold_start" if n <= cold else "warm_start" if n <= warm else "mature"

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._count.get()[0] if self._count.exists() else 0
        after = before + sum(len(frame) for frame in rows)
        self._count.update((after,))
        if self._stage(before) != self._stage(after):
            yield pd.DataFrame(
                {
                    "user_id": [key[0]],
                    "n_ratings": [after],
                    "old_stage": [self._stage(before)],
                    "new_stage": [self._stage(after)],
                }
            )

    def close(self) -> None:
        pass


def stream_stage_changes(stream: DataFrame, cold: int = 5, warm: int = 20) -> DataFrame:
    """Stage transitions as events. Needs the RocksDB state store."""
    return stream.select("user_id").groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=_StageChanges(cold, warm),
        outputStructType="user_id bigint, n_ratings bigint, old_stage string, new_stage string",
        outputMode="Update",
        timeMode="None",
    )


def stream_upsert_ratings(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Re-ratings replace: a micro-batch adds only its own latest ratings.

    Batches land in ``table/delta/batch=<id>`` and a replayed batch rewrites its
    own folder, so the result is the same after a failure. Old values give way
    when the table is read (``current_ratings``) or compacted (``compact_ratings``); ``drop_merged`` removes what
    compaction has replaced.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        latest = dedup_keep_first(batch, ["user_id", "movie_id"], ["ts", "rating"], last=True)
        latest.write.mode("overwrite").parquet(f"{table}/delta/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: A marker names the base that holds all batches up to one; it is written after its base, and readers follow the last.
_MARKER = "upto long, base string"


def _marker(spark: SparkSession, table: str) -> tuple[int, str | None]:
    """Last batch inside the committed base, and the base's folder."""
    if not path_exists(spark, f"{table}/commits"):
        return -1, None
    row = spark.read.schema(_MARKER).parquet(f"{table}/commits").orderBy(F.desc("upto"), "base").first()
    return (row["upto"], row["base"]) if row else (-1, None)


def current_ratings(spark: SparkSession, table: str) -> DataFrame:
    """The latest rating per (user, film): the committed base and the batches after it.

    A base without marker is an unfinished or failed compaction and is not looked at.
    """
    upto, base = _marker(spark, table)
    reader = spark.read
    if base is not None:
        merged = spark.read.parquet(f"{table}/{base}")
        reader = reader.schema(T.StructType([*merged.schema, T.StructField("batch", T.LongType())]))
    # A file-level filter on the partition column: merged batches are not read.
    rows = reader.parquet(f"{table}/delta").where(F.col("batch") > upto)
    if base is not None:
        rows = merged.withColumn("batch", F.lit(-1)).unionByName(rows)
    return dedup_keep_first(rows, ["user_id", "movie_id"], ["ts", "batch", "rating"], last=True).drop("batch")


def compact_ratings(spark: SparkSession, table: str) -> int:
    """Merges all batches so far into a new base; returns the last batch it holds.

    The base has a folder of its own and its marker comes last, so readers see the old state or the new one, and a
    compaction that fails leaves nothing they would read.
    """
    upto, _ = _marker(spark, table)
    batches = [b for b in _batches(spark, table) if b > upto]
    if not batches:
        return upto
    last = max(batches)
    base = f"base/{last}-{uuid.uuid4().hex}"
    rows = current_ratings(spark, table)  # batches that arrive from here on may be in it; reading them again changes nothing
    rows.write.parquet(f"{table}/{base}")
    spark.createDataFrame([(last, base)], _MARKER).coalesce(1).write.mode("append").parquet(f"{table}/commits")
    return last


def _children(spark: SparkSession, folder: str):
    """(path, name, modification time in seconds) of what lies in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return system, []
    return system, [(f.getPath(), f.getPath().getName(), f.getModificationTime() / 1000) for f in system.listStatus(path)]


def _batches(spark: SparkSession, table: str) -> list[int]:
    names = [name for _, name, _ in _children(spark, f"{table}/delta")[1]]
    return [int(name.removeprefix("batch=")) for name in names if name.startswith("batch=")]


def drop_merged(spark: SparkSession, table: str, grace_seconds: float = 86_400.0) -> int:
    """Removes batches and bases that the last marker replaces, once it is older than the grace period readers get.

    Returns how many folders went. Newer bases without marker stay: a compaction may be writing them.
    """
    upto, base = _marker(spark, table)
    markers = [changed for _, name, changed in _children(spark, f"{table}/commits")[1] if name.endswith(".parquet")]
    if base is None or time.time() - max(markers) < grace_seconds:
        return 0
    gone = 0
    for folder in ("delta", "base"):
        system, entries = _children(spark, f"{table}/{folder}")
        for path, name, _ in entries:
            number = name.removeprefix("batch=").split("-")[0]
            old = number.isdigit() and int(number) <= upto and f"{folder}/{name}" != base
            if old and system.delete(path, True):
                gone += 1
    return gone
