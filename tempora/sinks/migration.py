"""A migration in key ranges that can be ended and resumed (JOB-6, SNK-12, SRC-8).

The source is cut once into ranges of about equally many rows by quantiles of its key; the bounds
are written down, so that every later run sees the same ranges. A range is read with a filter on the key, its
rows are transformed and written (bad ones beside the good ones, with the reason) by overwriting the range's own
folder, and the cursor gets an entry when all is written. A restart skips the ranges that have an entry and does
the others again, so the result is that of one undisturbed run. When all ranges are finished and the source has grown
beyond the last bound, the next run adds ranges for the new keys.

Ranges run one after another, each as a distributed job; plan and cursor have one row a range and
are read on the driver. Rows without a key belong to the first range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType

from tempora.sources import paths

PLAN = "range long, after long, upto long"
CURSOR = "range long, state string, rows long, errors long, at timestamp"


class Migration:
    """``transform`` maps source rows to target rows; ``reason``, over the target's columns, says
    why a row is bad (null: it is good). ``key`` is a whole number. ``ranges`` are made for each new stretch of keys."""

    def __init__(self, spark: SparkSession, root: str, source: DataFrame, key: str,
                 transform: Callable[[DataFrame], DataFrame], reason: Column, ranges: int = 64):
        self.spark, self.root, self.source, self.key = spark, root.rstrip("/"), source, key
        self.transform, self.reason, self.ranges = transform, reason, ranges

    def _plans(self) -> list:
        """(range, after, upto) of all ranges so far, in order."""
        names = paths.folder_names(self.spark, f"{self.root}/plan")
        made = [f"{self.root}/plan/{n}" for n in names if paths.exists(self.spark, f"{self.root}/plan/{n}/_SUCCESS")]
        return self.spark.read.schema(PLAN).parquet(*made).orderBy("range").collect() if made else []

    def _extend(self, plans: list) -> list:
        """``plans`` with ranges for the keys beyond the last one."""
        last, rest = None, self.source
        if plans:
            last, rest = plans[-1]["upto"], self.source.filter(F.col(self.key) > plans[-1]["upto"])
        cuts = [i / self.ranges for i in range(1, self.ranges)] + [1.0]
        found = rest.agg(F.percentile_approx(self.key, cuts, 10_000).alias("q"), F.max(self.key).alias("most")).first()
        if found["most"] is None and (plans or rest.isEmpty()):
            return plans
        bounds = sorted({int(b) for b in found["q"] or []} | {int(found["most"] or 0)})
        rows = [(len(plans) + i, after, upto) for i, (after, upto) in enumerate(zip([last, *bounds], bounds))]
        self.spark.createDataFrame(rows, PLAN).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/plan/{len(plans):08d}")
        return self._plans()

    def _finished(self) -> set[int]:
        return {r["range"] for r in self.cursor().collect()}

    def cursor(self) -> DataFrame:
        """The finished ranges: range, state, rows, errors, at."""
        names = paths.folder_names(self.spark, f"{self.root}/cursor")
        made = [f"{self.root}/cursor/{n}" for n in names if paths.exists(self.spark, f"{self.root}/cursor/{n}/_SUCCESS")]
        return self.spark.read.schema(CURSOR).parquet(*made) if made else self.spark.createDataFrame([], CURSOR)

    def run(self, most: int | None = None) -> int:
        """Migrate the unfinished ranges, or the first ``most`` of them; returns how many are left."""
        finished, plans = self._finished(), self._plans()
        left = [p for p in plans if p["range"] not in finished]
        if not left:
            plans = self._extend(plans)
            left = [p for p in plans if p["range"] not in finished]
        now = left if most is None else left[:most]
        for part in now:
            self._migrate(part["range"], part["after"], part["upto"])
        return len(left) - len(now)

    def _migrate(self, number: int, after: int | None, upto: int) -> None:
        key = F.col(self.key)
        within = (key <= upto) & (key > after) if after is not None else key.isNull() | (key <= upto)
        path = f"{self.root}/rows/range={number}"
        rows = self.transform(self.source.filter(within)).withColumn("reason", self.reason)
        rows.withColumn("bad", F.col("reason").isNotNull()).write.mode("overwrite").partitionBy("bad").parquet(path)
        n = {r["bad"]: r["count"] for r in self._rows([number]).groupBy("bad").count().collect()}
        entry = self.spark.createDataFrame([(number, "done", n.get(False, 0), n.get(True, 0), None)], CURSOR)
        entry.withColumn("at", F.current_timestamp()).write.mode("overwrite").parquet(f"{self.root}/cursor/{number:08d}")

    def _rows(self, numbers) -> DataFrame:
        shape = self.transform(self.source).withColumn("reason", self.reason).schema
        if not numbers:
            empty = self.spark.createDataFrame([], shape)
            return empty.withColumn("range", F.lit(0)).withColumn("bad", F.lit(False))
        folders = [f"{self.root}/rows/range={n}" for n in sorted(numbers)]
        whole = shape.add("range", IntegerType()).add("bad", BooleanType())
        return self.spark.read.schema(whole).option("basePath", f"{self.root}/rows").parquet(*folders)

    def migrated(self) -> DataFrame:
        """Good rows of the finished ranges."""
        return self._rows(self._finished()).filter("NOT bad").drop("reason", "range", "bad")

    def errors(self) -> DataFrame:
        """Bad rows of the finished ranges, with the reason."""
        return self._rows(self._finished()).filter("bad").drop("range", "bad")
