"""Registered stream queries over the ``events`` table (ST-4, ST-7).

Each brings the table, or deliveries cut from it by a rule, through a Structured Streaming query
(``Replay``: in event-time order, no row lost) and returns what the stream wrote; the oracle is the
equivalent batch SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.exprs import exact_avg, exact_sum
from tempora.streaming import streams as S
from tempora.streaming.replay import CHUNK_ROWS, Replay

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ROLLUP_DELAY = "1 hour"
DEDUPE_DELAY = "1 day"
#: Every so many-th event is delivered again, and every so many-th comes with a second delivery.
REDELIVERED, SECOND = 3, 10


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")


def _rollup(spark: SparkSession, chunk_rows: int = CHUNK_ROWS) -> Replay:
    return Replay(spark, S.scratch_path(spark, "events_daily"), EVENTS_SCHEMA, "ts", ROLLUP_DELAY,
                  lambda s: S.daily_rollup_stream(s, "event_type", "ts", "value", ROLLUP_DELAY), windowed=True, chunk_rows=chunk_rows)


def _dedupe(spark: SparkSession, chunk_rows: int = CHUNK_ROWS) -> Replay:
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return Replay(spark, S.scratch_path(spark, "events_dedupe"), EVENTS_SCHEMA, "ts", DEDUPE_DELAY,
                  lambda s: S.dedupe_stream(s, ["event_id"], "ts", DEDUPE_DELAY).select(*columns), chunk_rows=chunk_rows)


def _open_days(replay: Replay) -> DataFrame:
    """The days that the stream has not closed yet, from the rows that it took."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    rows = replay.taken().withColumn("day_start", day)
    still = rows.filter(F.col("day_start") + F.expr("INTERVAL 1 DAY") > replay.watermark())
    return still.groupBy("day_start", "event_type").agg(
        F.count(F.lit(1)).alias("n"), exact_avg("value").alias("avg_value"), exact_sum("value").alias("sum_value"))


def events_daily_stream(spark: SparkSession, sf: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """ST-7: daily windows per event type. The stream writes a day once the watermark, max(ts) -
    1 hour, passes its end; days that are still open are added from the rows taken, marked as such."""
    replay = _rollup(spark, chunk_rows)
    replay.deliver(_events(spark, sf), "backlog")
    return replay.written().withColumn("closed", F.lit(True)).unionByName(_open_days(replay).withColumn("closed", F.lit(False)))


def _as_written(spark: SparkSession, out: DataFrame) -> DataFrame:
    return out.withColumn("ts", S.wall_clock(F.col("ts"), spark.conf.get("spark.sql.session.timeZone")))


def events_dedupe_stream(spark: SparkSession, sf: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """ST-4: re-delivered events (same event_id) dropped within a 1-day watermark."""
    replay = _dedupe(spark, chunk_rows)
    replay.deliver(_events(spark, sf), "backlog")
    return _as_written(spark, replay.written())


def events_redelivered_stream(spark: SparkSession, sf: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """ST-4 with something to drop: every third event is in the backlog twice."""
    events = _events(spark, sf)
    replay = _dedupe(spark, chunk_rows)
    replay.deliver(events.union(events.filter(F.col("event_id") % REDELIVERED == 0)), "backlog")
    return _as_written(spark, replay.written())


def events_late_rows(spark: SparkSession, sf: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """ST-4, ST-7: every tenth event comes with a second delivery. Per day and kind of delivery, how many
    rows the roll-up took and how many were late, because their day was closed by the first."""
    events, second = _events(spark, sf), F.col("event_id") % SECOND == 0
    replay = _rollup(spark, chunk_rows)
    replay.deliver(events.filter(~second), "first")
    replay.deliver(events.filter(second), "second")
    late = replay.late().select("ts", "event_type", F.lit(True).alias("late"))
    rows = replay.taken().select("ts", "event_type", F.lit(False).alias("late")).union(late)
    return rows.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day_start"), "event_type").agg(
        F.count(F.when(~F.col("late"), 1)).alias("n_taken"), F.count(F.when(F.col("late"), 1)).alias("n_late"))
