"""Streams over deliveries that come in any order, without losing a row (ST-4, ST-7).

A watermark drops every row behind it, so a backlog read file by file loses what an earlier file
has overtaken. Here a delivery is first rewritten once in event-time order, cut into chunks of whole days,
and the chunks enter the stream's folder one after another: within a chunk there is one micro-batch, and
the next chunk begins where the watermark has not been yet. Rows behind the watermark of *earlier*
deliveries (and rows without a time) go to a late table with the reason, so that
what the stream took, and what is late, add up to what was delivered.

A delivery is staged under its own name and marked complete by the writer's ``_SUCCESS``; a run that was ended
is started again with the same name and goes on with the chunks that have not entered yet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.sources import paths
from tempora.streaming import streams as S

#: Rows of a chunk, and so of a micro-batch; a single day may hold more.
CHUNK_ROWS = 200_000_000


def day_chunks(days: list[tuple[str, int]], rows: int) -> list[tuple[str, str]]:
    """(first day, last day) of consecutive chunks of at most ``rows`` rows each, whole days at least."""
    out, held = [], 0
    for day, n in sorted(days):
        if out and held + n <= rows:
            out[-1] = (out[-1][0], day)
            held += n
        else:
            out.append((day, day))
            held = n
    return out


class Replay:
    """One stream: its folder, checkpoint, output and late table under ``root`` in the shared folder.

    ``transform`` is the streaming query (it sets a watermark of ``delay`` on ``ts``); ``windowed``
    says that a row is late when its *day* is closed, otherwise when its own time is behind."""

    def __init__(self, spark: SparkSession, root: str, schema: str, ts: str, delay: str,
                 transform: Callable[[DataFrame], DataFrame], windowed: bool = False, chunk_rows: int = CHUNK_ROWS):
        self.spark, self.root, self.schema, self.ts, self.delay = spark, root.rstrip("/"), schema, ts, delay
        self.transform, self.windowed, self.chunk_rows = transform, windowed, chunk_rows

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def watermark(self):
        """The stream's watermark after all chunks so far: one scalar from the files' statistics, null before the first."""
        if not paths.folder_names(self.spark, self._path("inbox")):
            return F.lit(None).cast("timestamp_ntz")
        taken = self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self._path("inbox"))
        last = taken.agg(F.date_trunc("millisecond", F.max(self.ts)).cast("string").alias("m")).first()["m"]
        return F.lit(last).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")

    def deliver(self, rows: DataFrame, name: str) -> None:
        """Bring a delivery of ``rows`` through the stream; the same name resumes an ended one."""
        stage = self._path(f"staged/{name}")
        self._run()  # chunks that entered before the last run ended
        if not paths.exists(self.spark, f"{stage}/_SUCCESS"):
            self._stage(rows, name, stage)
        for chunk in [f for f in paths.folder_names(self.spark, stage) if f.startswith("chunk=")]:
            paths.rename(self.spark, f"{stage}/{chunk}", self._path(f"inbox/{name}-{chunk.removeprefix('chunk=')}"))
            self._run()

    def _stage(self, rows: DataFrame, name: str, stage: str) -> None:
        ts, day = F.col(self.ts), F.to_date(self.ts)
        until = F.date_trunc("day", ts).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") if self.windowed else ts
        reason = F.when(ts.isNull(), "no time").when(until <= self.watermark(), "behind the watermark")
        marked = rows.withColumn("reason", reason)
        marked.filter("reason IS NOT NULL").write.mode("overwrite").parquet(self._path(f"late/{name}"))
        fit = marked.filter("reason IS NULL").drop("reason")
        counts = fit.groupBy(day.cast("string").alias("day")).count().collect()  # bounded by the calendar
        chunks = day_chunks([(r["day"], r["count"]) for r in counts], self.chunk_rows)
        starts = F.array(*[F.lit(first).cast("date") for first, _ in chunks]) if chunks else F.array().cast("array<date>")
        number = F.size(F.filter(starts, lambda d: d <= day))
        out = fit.withColumn("chunk", F.format_string("%08d", number))
        out.repartitionByRange("chunk", self.ts).sortWithinPartitions("chunk", self.ts).write.mode("overwrite") \
            .partitionBy("chunk").parquet(stage)

    def _run(self) -> None:
        """Let the stream take what has entered and not been taken: one micro-batch."""
        if paths.folder_names(self.spark, self._path("inbox")):
            stream = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True).parquet(self._path("inbox"))
            S.append_stream(self.transform(S.event_time(stream, self.ts)), self._path("out"), self._path("checkpoint"))

    def written(self) -> DataFrame:
        """What the stream has written."""
        if not paths.folder_names(self.spark, self._path("out")):
            empty = self.spark.createDataFrame([], self.schema)
            return self.transform(S.event_time(empty, self.ts))
        return self.spark.read.parquet(self._path("out"))

    def late(self) -> DataFrame:
        """Rows of all deliveries that came too late, with the delivery and the reason."""
        made = self.spark.read.option("recursiveFileLookup", True).schema(self.schema + ", reason string").parquet(self._path("late"))
        return made.withColumn("delivery", F.regexp_extract(F.input_file_name(), r"/late/([^/]+)/", 1))

    def taken(self) -> DataFrame:
        """Rows of all deliveries that entered the stream."""
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self._path("inbox"))
