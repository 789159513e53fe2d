"""Structured Streaming forms of the incremental operators (ST-1, ST-3, ST-4, ST-5, ST-7).

The source system has no stream processor; these are the stream re-expressions of its
batch increments. Event time must be TIMESTAMP (watermarks refuse TIMESTAMP_NTZ), so
streams cast at the edge and cast back on output. Sinks and checkpoints live in the
shared folder named by ``spark.checkpoint.dir`` so a restarted query resumes exactly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.exprs import exact_avg, exact_sum
from tempora.session import ensure_checkpoint_dir
from tempora.streaming.epochs import EpochLedger


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_parquet_stream(spark: SparkSession, path: str, schema, max_files: int | None = None,
                        glob: str | None = None) -> DataFrame:
    """A Parquet folder as a stream (new files are picked up as they land); ``glob``
    restricts it to matching file names."""
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Event time as TIMESTAMP for watermarking: wall-clock (NTZ) values are read as UTC
    instants, so 1-day windows (aligned to UTC epoch days) are calendar days of the wall
    clock whatever the session time zone."""
    if dict(stream.dtypes)[ts] != "timestamp_ntz":
        return stream
    tz = _session_tz(stream)
    return stream.withColumn(ts, F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts)).cast("timestamp"))


def wall_clock(col, tz: str) -> F.Column:
    """Inverse of ``event_time``: a TIMESTAMP instant back to its UTC wall clock (NTZ)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col.cast("timestamp_ntz"))


def future_cutoff(stream: DataFrame, ts: str, days: int = 1, as_of: str | None = None) -> DataFrame:
    """ST-3: drop rows later than now (or as_of) + days -- stateless."""
    now = F.current_timestamp() if as_of is None else F.to_timestamp(F.lit(as_of))
    return stream.filter(F.col(ts) <= F.timestamp_add("DAY", F.lit(days), now))


def dedupe_stream(stream: DataFrame, keys, ts: str, delay: str = "1 day") -> DataFrame:
    """ST-4: drop re-delivered rows (same key) arriving within the watermark delay; state
    for a key is dropped once the watermark passes it, so state stays bounded."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_rollup_stream(stream: DataFrame, entity: str, ts: str, value: str, delay: str = "1 hour") -> DataFrame:
    """ST-7: per entity and calendar day (tumbling 1-day window): rows, mean and total of
    ``value``. Append mode emits a day once the watermark passes its end."""
    g = (stream.withWatermark(ts, delay)
         .groupBy(F.window(ts, "1 day").alias("w"), F.col(entity))
         .agg(F.count(F.lit(1)).alias("n"), exact_avg(value).alias(f"avg_{value}"),
              exact_sum(value).alias(f"sum_{value}")))
    return g.select(wall_clock(F.col("w.start"), _session_tz(stream)).alias("day_start"), entity, "n",
                    f"avg_{value}", f"sum_{value}")


def append_stream(stream: DataFrame, path: str, checkpoint: str, partition_by=None):
    """ST-1: exactly-once append of a stream to Parquet; runs what is available, then stops."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def upsert_stream(stream: DataFrame, table_path: str, checkpoint: str, keys, update_cols,
                  ts_col: str = "observed_at", order_cols=("created_at",)):
    """ST-5: each micro-batch is upserted into the month-partitioned table, rewriting only
    the months it touches, and counts once: a batch that Spark hands over again after a failure is finished from
    its stage or skipped (``EpochLedger``)."""
    def merge_batch(batch: DataFrame, epoch: int):
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        EpochLedger(batch.sparkSession, table_path, query).apply(
            batch, epoch, keys, mode="upsert", update_cols=update_cols, ts_col=ts_col, order_cols=order_cols)

    q = (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_to_parquet(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to completion (availableNow) into a fresh Parquet folder under the
    shared checkpoint folder and return the written result as a batch DataFrame."""
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    append_stream(stream, out, ckpt)
    return spark.read.parquet(out)
