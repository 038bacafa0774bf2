"""Streaming jobs, run to completion over the event table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.session import shared_folder
from filmloom.sources import surrogates as s
from filmloom.streaming import ratings as streaming
from filmloom.workload.registry import query


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The event table as a file stream of ratings."""
    events = streaming.rating_stream(spark, d, s.table(spark, d, "events").schema, "events.parquet")
    return events.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("movie_id"),
        F.col("value").alias("rating"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def _run(df: DataFrame, mode: str, spark: SparkSession) -> DataFrame:
    """Drain a stream into parquet versions and read them back."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    run = (
        df.writeStream.foreachBatch(save)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


_STAGE = """CASE WHEN count(*) <= 5 THEN 'cold_start' WHEN count(*) <= 20 THEN 'warm_start' ELSE 'mature' END"""


@query(
    "stream_user_stage",
    f"SELECT user_id, count(*) AS n_ratings, {_STAGE} AS stage FROM events GROUP BY user_id",
)
def stream_user_stage(spark: SparkSession, d: str) -> DataFrame:
    updates = _run(streaming.stream_user_stage(_stream(spark, d)), "update", spark)
    last = updates.groupBy("user_id").agg(F.max_by(F.struct("n_ratings", "stage"), "batch").alias("_r"))
    return last.select("user_id", "_r.*")


@query(
    "stream_clean_ratings",
    """SELECT DISTINCT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id FROM events
WHERE value BETWEEN 0.5 AND 5.0""",
)
def stream_clean_ratings(spark: SparkSession, d: str) -> DataFrame:
    return _run(streaming.stream_clean_ratings(_stream(spark, d)), "append", spark).select("user_id", "movie_id")


@query(
    "stream_first_ratings",
    """SELECT user_id, movie_id, rating, rated_at FROM (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id, value AS rating,
    CAST(floor(epoch(CAST(ts AS TIMESTAMP))) AS BIGINT) AS rated_at,
    row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k')
                       ORDER BY floor(epoch(CAST(ts AS TIMESTAMP))), value) AS rn
  FROM events WHERE value BETWEEN 0.5 AND 5.0 AND user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL AND ts IS NOT NULL)
WHERE rn = 1""",
)
def stream_first_ratings(spark: SparkSession, d: str) -> DataFrame:
    text = {c: F.col(c).cast("string") for c in ("user_id", "movie_id", "rating")}
    raw = _stream(spark, d).withColumns(text).withColumn("timestamp", F.unix_timestamp("ts").cast("string"))
    written = _run(streaming.stream_first_ratings(raw.drop("ts")), "update", spark)
    first = streaming.first_ratings(written)
    return first.select("user_id", "movie_id", "rating", F.unix_timestamp("ts").alias("rated_at"))


@query(
    "stream_upsert_ratings",
    """SELECT user_id, movie_id, rating FROM (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id, value AS rating,
    row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k') ORDER BY ts DESC, value DESC) AS rn FROM events)
WHERE rn = 1""",
)
def stream_upsert_ratings(spark: SparkSession, d: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/upsert-{uuid.uuid4().hex}"
    rated = _stream(spark, d).select("user_id", "movie_id", "rating", "ts")
    streaming.stream_upsert_ratings(rated, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return streaming.current_ratings(spark, f"{folder}/table").select("user_id", "movie_id", "rating")
