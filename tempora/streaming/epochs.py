"""Micro-batches that count once (ST-5): a ledger of epochs beside the table they are merged into.

Spark hands the last micro-batch over again when a query restarts before the batch was committed. The
ledger, under ``{table}/_epochs`` (readers of the table ignore it), is asked first, by query id and epoch:

* ``done`` is there: the batch is in the table, it is skipped;
* the ``stage`` is complete: the merged partitions were written, their copy into the table may have ended half-way;
  they are copied again, which gives the same partitions as an undisturbed copy;
* otherwise the table has not been touched, and the batch is merged from the start (a stage left half-written is overwritten).

So a merge need not be idempotent, and one that failed while copying leaves no mixture. A table has one
writer at a time. A step is complete when the writer's ``_SUCCESS`` is there. A batch without rows is entered as done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.sinks import writers
from tempora.sources import paths

ENTRY = "rows long, periods array<string>, at timestamp"


class EpochLedger:
    """The epochs of one streaming query (its id lives in the checkpoint and survives restarts)."""

    def __init__(self, spark: SparkSession, table: str, query: str):
        self.spark, self.table = spark, table.rstrip("/")
        self.root = f"{self.table}/_epochs/query={query}"

    def _complete(self, path: str) -> bool:
        return paths.exists(self.spark, f"{path}/_SUCCESS")

    def apply(self, batch: DataFrame, epoch: int, keys, **merge) -> bool:
        """Merge ``batch`` (arguments as for ``writers.stage_merge``) unless it is in the table already.
        Returns whether the table was written."""
        at = f"{self.root}/epoch={epoch:012d}"
        done, stage = f"{at}/done", f"{at}/stage"
        if self._complete(done):
            return False
        if self._complete(f"{stage}/entry"):
            entry = self.spark.read.schema(ENTRY).parquet(f"{stage}/entry")
        else:
            periods = writers.stage_merge(self.spark, self.table, batch, keys, stage, **merge)
            rows = self.spark.read.schema(batch.schema).parquet(f"{stage}/batch").count()
            entry = self.spark.createDataFrame([(rows, sorted(periods), None)], ENTRY).withColumn("at", F.current_timestamp())
            entry.write.mode("overwrite").parquet(f"{stage}/entry")  # last: the stage is complete
            entry = self.spark.read.schema(ENTRY).parquet(f"{stage}/entry")
        touched = bool(entry.first()["periods"])
        if touched:
            writers.copy_partitions(self.spark, stage, self.table)
        entry.write.mode("overwrite").parquet(done)
        writers.empty_stage(self.spark, stage)
        return touched

    @staticmethod
    def entries(spark: SparkSession, table: str) -> DataFrame:
        """All epochs in the table: query, epoch, rows, periods, at."""
        made = spark.read.schema(ENTRY).parquet(f"{table.rstrip('/')}/_epochs/*/*/done")
        name = F.input_file_name()
        return made.select(F.regexp_extract(name, "query=([^/]+)", 1).alias("query"),
                           F.regexp_extract(name, r"epoch=(\d+)", 1).cast("long").alias("epoch"), "rows", "periods", "at")
