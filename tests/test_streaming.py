import datetime

import pytest
from pyspark.sql import functions as F

from filmloom.operators.relational import dedup_keep_first, upsert_ratings
from filmloom.plans.lifecycle import user_stage
from filmloom.streaming import ratings as streaming

SCHEMA = "user_id bigint, movie_id bigint, rating double, ts timestamp"


@pytest.fixture()
def batches(spark, tmp_path):
    """Three files, read one per micro-batch."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(u, i % 9, 0.5 + i % 10, start + datetime.timedelta(minutes=10 * i + u)) for u in range(1, 5) for i in range(6 * u)]
    everything = spark.createDataFrame(rows, SCHEMA)
    for part in range(3):
        everything.where(F.pmod(F.hash("ts"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    )
    return everything, stream, str(tmp_path)


def drain(stream, folder, mode):
    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    query = stream.writeStream.foreachBatch(save).outputMode(mode).option("checkpointLocation", f"{folder}/cp")
    query.trigger(availableNow=True).start().awaitTermination()


def test_stages_equal_batch(spark, batches):
    everything, stream, folder = batches
    drain(streaming.stream_user_stage(stream), folder, "update")
    updates = spark.read.parquet(f"{folder}/out")
    last = updates.groupBy("user_id").agg(F.max_by("stage", "batch").alias("stage"), F.max("n_ratings").alias("n"))
    want = user_stage(everything, everything.select("user_id").distinct())
    assert {tuple(r) for r in last.select("user_id", "stage", "n").collect()} == {
        (r.user_id, r.stage, r.n_ratings) for r in want.collect()
    }


@pytest.mark.parametrize("watermark", [None, "10 days"])
def test_clean_rows_once(spark, batches, watermark):
    everything, stream, folder = batches
    drain(streaming.stream_clean_ratings(stream, watermark), folder, "append")
    got = spark.read.parquet(f"{folder}/out").select("user_id", "movie_id")
    want = everything.where("rating BETWEEN 0.5 AND 5.0").select("user_id", "movie_id").distinct()
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_first_ratings_by_event_time(spark, tmp_path):
    day = 86_400
    steps = [
        [("1", "7", "4.0", str(10 * day)), ("1.0", "8", " 3.5 ", str(10 * day)), ("x", "8", "3", "5"), ("2", "7", "9", "5"), ("2", "7", "3", "soon")],
        [("1", "7", "2.0", str(10 * day - 60)), ("1", "8", "1.0", str(10 * day + 5)), ("3", "9", "5", str(20 * day))],  # earlier, in time
        [("1", "9", "1.5", str(20 * day + 1)), ("1", "7", "0.5", str(20 * day))],
        [("1", "8", "5.0", str(9 * day)), ("3", "9", "4", str(19 * day + day // 2))],  # the first comes too late, the second in time
    ]
    names = "user_id string, movie_id string, rating string, timestamp string"
    folder, runs = str(tmp_path), []
    for rows in steps:
        spark.createDataFrame(rows, names).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(names).parquet(f"{folder}/in")

        def save(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

        query = streaming.stream_first_ratings(stream).writeStream.foreachBatch(save).outputMode("update")
        run = query.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
        run.awaitTermination()
        runs.append(run.lastProgress)
    got = streaming.first_ratings(spark.read.parquet(f"{folder}/out")).selectExpr("user_id", "movie_id", "rating", "unix_timestamp(ts) as at")
    assert {tuple(r) for r in got.collect()} == {
        (1, 7, 2.0, 10 * day - 60), (1, 8, 3.5, 10 * day), (1, 9, 1.5, 20 * day + 1), (3, 9, 4.0, 19 * day + day // 2)
    }
    # Windows of day 10 have left the state.
    assert runs[-1]["stateOperators"][0]["numRowsTotal"] <= 4


def test_upserts_and_compaction(spark, batches):
    everything, stream, folder = batches
    table = f"{folder}/table"
    streaming.stream_upsert_ratings(stream, table, f"{folder}/cp").awaitTermination()
    want = {tuple(r) for r in dedup_keep_first(everything, ["user_id", "movie_id"], ["ts", "rating"], last=True).collect()}
    assert {tuple(r) for r in streaming.current_ratings(spark, table).select(*everything.columns).collect()} == want
    assert streaming.compact_ratings(spark, table) == streaming.compact_ratings(spark, table)
    assert {tuple(r) for r in streaming.current_ratings(spark, table).select(*everything.columns).collect()} == want
    # An unfinished compaction: a newer base without marker is not read, and stays when merged folders go.
    everything.limit(0).write.parquet(f"{table}/base/99999-unfinished")
    assert {tuple(r) for r in streaming.current_ratings(spark, table).select(*everything.columns).collect()} == want
    assert streaming.drop_merged(spark, table, 3600) == 0
    n_batches = len(streaming._batches(spark, table))
    assert streaming.drop_merged(spark, table, 0) == n_batches > 0 and not streaming._batches(spark, table)
    assert {tuple(r) for r in streaming.current_ratings(spark, table).select(*everything.columns).collect()} == want
    newer = everything.limit(1).withColumn("ts", F.expr("ts + interval 4000 days")).cache()
    newer.write.parquet(f"{table}/delta/batch=500")
    replaced = {r for r in want if r[:2] != tuple(newer.select("user_id", "movie_id").first())} | {tuple(newer.first())}
    for _ in range(2):
        got = {tuple(r) for r in streaming.current_ratings(spark, table).select(*everything.columns).collect()}
        assert got == replaced
        assert streaming.compact_ratings(spark, table) == 500
    again = upsert_ratings(everything.limit(0), everything)
    assert {tuple(r) for r in again.collect()} == want


def test_stage_change_events(spark, batches):
    everything, stream, folder = batches
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    try:
        drain(streaming.stream_stage_changes(stream), folder, "update")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    events = spark.read.parquet(f"{folder}/out")
    reached = events.groupBy("user_id").agg(F.max_by("new_stage", "batch").alias("stage"))
    assert {r.user_id: r.stage for r in reached.collect()} == {1: "warm_start", 2: "warm_start", 3: "warm_start", 4: "mature"}
