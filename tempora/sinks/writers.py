"""Writers (SNK-5..SNK-11, SNK-13).

Partitions are the write batches (no driver-side batching): the source system's
500 / 5,000 / 50,000-row batches become ``maxRecordsPerFile``. Tables use a month (or
day) partition derived from the observation time plus a within-file sort on the cluster
key (location / series / code), which gives partition pruning and tight row-group
min/max statistics.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.exprs import year_month
from tempora.operators import merge as M
from tempora.sources import paths

PART_COL = "obs_period"
GRAINS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}


def partition_value(ts_col: str, grain: str = "month") -> F.Column:
    """Partition value of a reading: its month (small tables) or day (large hourly tables,
    so a daily batch rewrites days, not months). The column keeps one name either way."""
    return year_month(ts_col) if grain == "month" else F.date_format(F.col(ts_col), GRAINS[grain])


def with_layout(df: DataFrame, ts_col: str = "observed_at", cluster_col: str | None = None,
                grain: str = "month") -> DataFrame:
    """SNK-9: add the partition column, range-partition on (period, cluster key, time) and
    sort within tasks. Range (not hash) partitioning splits one period -- or one hot cluster
    key -- over many tasks, and each file covers a narrow key range, so its row-group
    min/max statistics prune well."""
    out = df.withColumn(PART_COL, partition_value(ts_col, grain))
    keys = [PART_COL] + ([cluster_col] if cluster_col else []) + [ts_col]
    return out.repartitionByRange(*keys).sortWithinPartitions(*keys)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, max_records: int | None = None):
    """SNK-6: append (duplicates allowed). fmt='json' writes NDJSON."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None):
    """SNK-7: truncate and load (static overwrite: partitions absent from ``df`` go too)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def write_table(df: DataFrame, path: str, ts_col: str = "observed_at", cluster_col: str | None = None,
                mode: str = "overwrite", grain: str = "month"):
    """Write an observation table in the time-partitioned, clustered layout."""
    with_layout(df, ts_col, cluster_col, grain).write.mode(mode).partitionBy(PART_COL).parquet(path)


def touched_months(batch: DataFrame, ts_col: str = "observed_at", grain: str = "month") -> list[str]:
    """Distinct partitions (months or days) a batch touches -- bounded by the calendar, so
    collected as a short list and used as a static partition filter."""
    return [r[0] for r in batch.select(partition_value(ts_col, grain).alias("m")).distinct().collect()]


def rewrite_partitions(spark: SparkSession, path: str, batch: DataFrame, keys, mode: str = "upsert",
                       update_cols=(), ts_col: str = "observed_at", cluster_col: str | None = None,
                       order_cols=("created_at",), grain: str = "month", months: list[str] | None = None) -> list[str]:
    """Merge ``batch`` into the time-partitioned table at ``path`` rewriting only the
    partitions (months, or days with ``grain='day'``) the batch touches: ``stage_merge``, then ``copy_partitions``.
    ``tempora.streaming.epochs`` adds the ledger that lets an ended merge be finished."""
    stage = f"{path.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    months = stage_merge(spark, path, batch, keys, stage, mode, update_cols, ts_col, cluster_col, order_cols, grain, months)
    if months:
        copy_partitions(spark, stage, path)
    empty_stage(spark, stage)
    return months


def stage_merge(spark: SparkSession, path: str, batch: DataFrame, keys, stage: str, mode: str = "upsert",
                update_cols=(), ts_col: str = "observed_at", cluster_col: str | None = None,
                order_cols=("created_at",), grain: str = "month", months: list[str] | None = None) -> list[str]:
    """Write the touched partitions as they are after the merge to ``{stage}/merged``, the table itself stays as it is
    (a folder inside the table is ignored by its readers when its name starts with '_'). The batch is written to
    ``{stage}/batch`` and computed once, however often the merge reads it. Returns the partitions touched."""
    batch.write.mode("overwrite").parquet(f"{stage}/batch")
    batch = spark.read.schema(batch.schema).parquet(f"{stage}/batch")
    months = touched_months(batch, ts_col, grain) if months is None else months
    if not months:
        return []
    target = spark.read.parquet(path).filter(F.col(PART_COL).isin(months)).drop(PART_COL)
    if mode == "upsert":
        merged = M.upsert_last_wins(target, batch, keys, update_cols, order_cols=order_cols)
    elif mode == "ignore":
        merged = M.insert_ignore(target, batch, keys, order_cols=order_cols)
    elif mode == "insert_only":
        merged = M.merge_insert_only(target, batch, keys)
    else:
        raise ValueError(mode)
    write_table(merged, f"{stage}/merged", ts_col, cluster_col, grain=grain)
    return months


def copy_partitions(spark: SparkSession, stage: str, path: str) -> None:
    """Put the partitions of a complete stage in place of the table's (dynamic partition overwrite). Copying
    again after a failure gives the same table, as the stage does not depend on it any more."""
    staged = spark.read.parquet(f"{stage}/merged")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART_COL).parquet(path)


def empty_stage(spark: SparkSession, stage: str) -> None:
    """Leave no rows in a stage's folders (an empty overwrite keeps the schema)."""
    for name in paths.folder_names(spark, stage):
        schema = spark.read.parquet(f"{stage}/{name}").schema
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{stage}/{name}")


def stage_merge_clear(spark: SparkSession, path: str, batch: DataFrame, keys, stage_path: str,
                      ts_col: str = "observed_at"):
    """SNK-5: write the batch to a stage, insert the rows whose key is new, and clear the
    stage afterwards even when the merge fails (an empty overwrite keeps the schema)."""
    batch.write.mode("overwrite").parquet(stage_path)
    try:
        staged = spark.read.parquet(stage_path)
        return rewrite_partitions(spark, path, staged, keys, mode="insert_only", ts_col=ts_col)
    finally:
        spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(stage_path)


class VersionedTable:
    """SNK-8: CREATE OR REPLACE of a table that reads itself. Each replace writes a new
    version folder, then a pointer folder under a new, later name; the newest complete pointer
    names the current version. Nothing is replaced in place, so a crash between the two steps
    leaves the old version current, and a table can be rebuilt from itself."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> str | None:
        pointers = f"{self.root}/_pointers"
        for name in reversed(paths.folder_names(self.spark, pointers)):
            if paths.exists(self.spark, f"{pointers}/{name}/_SUCCESS"):
                return self.spark.read.text(f"{pointers}/{name}").first()[0]
        return None

    def read(self) -> DataFrame:
        cur = self.current()
        if cur is None:
            raise FileNotFoundError(self.root)
        return self.spark.read.parquet(cur)

    def replace(self, df: DataFrame) -> str:
        version = f"{self.root}/v_{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(version)
        newest = paths.folder_names(self.spark, f"{self.root}/_pointers")[-1:] or ["0"]
        name = f"{int(newest[0].split('-')[0]) + 1:012d}-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(version,)], "path string").coalesce(1) \
            .write.mode("errorifexists").text(f"{self.root}/_pointers/{name}")
        return version


LANDED = "payload string, fetched_at string, source string, identifier string, window_start string, window_end string"


def land_raw(payloads: DataFrame, root: str):
    """SNK-10: raw landing, one JSON line per payload (columns source, identifier, window_start, window_end,
    fetched_at, payload), partitioned by source, identifier and window, so that a reader finds a
    series, a place or a range by its folders. A window that is not known is 'unknown', its columns may be absent;
    the payload's column may be called raw_response."""
    if "payload" not in payloads.columns:
        payloads = payloads.withColumnRenamed("raw_response", "payload")
    payloads = M.add_missing_columns(payloads, {"window_start": "string", "window_end": "string"})
    named = payloads.select("payload", F.col("fetched_at").cast("string").alias("fetched_at"), "source",
                            *[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in ("identifier", "window_start", "window_end")])
    keys = ["source", "identifier", "window_start", "window_end"]
    named.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).json(root)


def read_landed(spark: SparkSession, root: str, source: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Payloads of a source that ``land_raw`` wrote: file, identifier, payload. With ``start`` / ``end`` only
    windows that overlap it (and those not known); the choice is made by folders, other files are not opened."""
    df = spark.read.schema(LANDED).option("basePath", root).json(root).filter(F.col("source") == source)
    if start:
        df = df.filter((F.col("window_end") >= start) | (F.col("window_end") == "unknown"))
    if end:
        df = df.filter((F.col("window_start") <= end) | (F.col("window_start") == "unknown"))
    return df.select(F.input_file_name().alias("file"), "identifier", "payload")


def write_all(df: DataFrame, sinks: dict) -> DataFrame:
    """SNK-11: write one DataFrame to several sinks; a failing sink does not stop the
    others. The input is computed once (persisted). Returns one status row per sink."""
    spark = df.sparkSession
    df = df.persist()
    status = []
    try:
        for name, sink in sinks.items():
            try:
                sink(df)
                status.append((name, "ok", None))
            except Exception as e:  # isolate this sink's failure
                status.append((name, "failed", f"{type(e).__name__}: {e}"[:500]))
    finally:
        df.unpersist()
    return spark.createDataFrame(status, "sink string, status string, error string")
