"""One batch to several sinks, each delivered until it has succeeded (SNK-11).

The batch is written once to the shared folder, so every sink and every retry gets the same rows, also after an executor was
lost. Per sink there is a mark of its delivery; a later call of the same name takes the sinks that
lack one and leaves the others alone. A sink that fails does not stop the others. A process that ends between a sink's
own write and its mark delivers to that sink again, so a sink should replace what it wrote under the batch's name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.sources import paths

ATTEMPT = "sink string, attempt int, status string, error string"


class Outbox:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entered(self, path: str) -> bool:
        return paths.exists(self.spark, f"{path}/_SUCCESS")

    def stage(self, name: str, batch: DataFrame) -> DataFrame:
        """The batch as it was written when it was first staged under this name."""
        path = f"{self.root}/{name}/batch"
        if not self._entered(path):
            batch.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path)

    def deliver(self, name: str, batch: DataFrame, sinks: dict[str, Callable[[DataFrame], object]]) -> list[str]:
        """Bring the batch to every sink that does not have it; returns the sinks that still lack it."""
        staged, left = self.stage(name, batch), []
        for sink, send in sinks.items():
            at = f"{self.root}/{name}/attempts/{sink}"
            if self._entered(f"{at}/delivered"):
                continue
            number = len(paths.folder_names(self.spark, at)) + 1
            try:
                send(staged)
                self._enter(f"{at}/delivered", sink, number, "ok", None)
            except Exception as e:  # this sink's failure is its own
                self._enter(f"{at}/failed-{number:06d}", sink, number, "failed", f"{type(e).__name__}: {e}"[:500])
                left.append(sink)
        return left

    def _enter(self, path: str, sink: str, number: int, status: str, error: str | None) -> None:
        self.spark.createDataFrame([(sink, number, status, error)], ATTEMPT).coalesce(1).write.mode("overwrite").parquet(path)

    def attempts(self, name: str) -> DataFrame:
        """All attempts for a batch: sink, attempt, status, error."""
        if not paths.folder_names(self.spark, f"{self.root}/{name}/attempts"):
            return self.spark.createDataFrame([], ATTEMPT)
        return self.spark.read.schema(ATTEMPT).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}/attempts")

    def status(self, name: str) -> DataFrame:
        """The last attempt of each sink and how many there were: sink, attempts, status, error."""
        last = F.max(F.struct("attempt", "status", "error")).alias("last")
        return self.attempts(name).groupBy("sink").agg(last).select(
            "sink", F.col("last.attempt").alias("attempts"), "last.status", "last.error")
