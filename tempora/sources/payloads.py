"""Parsers over a payload column (SRC-1..SRC-4, SRC-10, FN-16, FN-17): one scan gives rows and rejects.

A payload is a row (file, identifier, payload); the identifier, taken from where the payload was landed,
names the series, the place ('latitude,longitude') or the survey, as payloads do not carry it.
Every parser returns what it could read and what it could not in one DataFrame: ``reason`` is null for good rows,
``empty`` for a payload with nothing to read (no JSON, truncated, no rows, a required array short),
``key`` where no identifier is known, ``time`` or ``value`` for a row that does not parse; ``kind`` says whether a
``payload`` or a ``row`` is lost and ``record`` is the lost part as landed. ``split`` writes that once and gives both halves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.constants import RETAIL_DATA_TYPE, TARGET_NAICS
from tempora.sources import landed as L
from tempora.sources import paths

MEASURES = list(L.RENAMES.values())
REJECT = ["file", "kind", "reason", "record"]


def files(spark: SparkSession, path: str) -> DataFrame:
    """Landed files (a folder, taken with all below it, a file or a pattern), one payload each. The identifier is the
    folder ``identifier=..``, or the one above ``start=.._end=..``."""
    below = {"recursiveFileLookup": "true", "pathGlobFilter": "*.json"} if paths.is_folder(spark, path) else {}
    text = spark.read.options(**below).text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("payload"))
    named = F.regexp_extract("file", r"/identifier=([^/]+)/", 1)
    above = F.regexp_extract("file", r"/([^/]+)/start=[^/]*/[^/]+$", 1)
    name = F.when(named != "", named).when(above != "", above)
    return text.select("file", F.url_decode(name).alias("identifier"), "payload")


def _marked(rows: DataFrame, keep: list[str], reason: Column, lost_payload: Column, record: Column) -> DataFrame:
    rows = rows.withColumn("reason", reason)
    return rows.select("file", *keep, F.when(lost_payload, "payload").when(F.col("reason").isNotNull(), "row").alias("kind"),
                       "reason", F.when(F.col("reason").isNotNull(), record).alias("record"))


def economic(payloads: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """SRC-1: (series_id, value, observed_at) per observation; the missing-value mark '.' is skipped."""
    parsed = payloads.select("file", "identifier", "payload", F.from_json("payload", L.ECONOMIC_PAYLOAD).alias("j"))
    rows = parsed.select("file", "payload", F.coalesce("j.series_id", "identifier").alias("series_id"), F.explode_outer("j.observations").alias("o"))
    rows = rows.filter(F.coalesce(F.col("o.value") != ".", F.lit(True)))
    rows = rows.withColumn("value", F.col("o.value").try_cast("double")).withColumn("observed_at", F.col("o.date").try_cast("timestamp_ntz"))
    if start:
        rows = rows.filter(F.col("observed_at").isNull() | (F.col("observed_at") >= F.to_timestamp_ntz(F.lit(start))))
    if end:
        rows = rows.filter(F.col("observed_at").isNull() | (F.col("observed_at") <= F.to_timestamp_ntz(F.lit(end))))
    empty = F.col("o").isNull()
    reason = F.when(empty, "empty").when(F.col("series_id").isNull(), "key").when(F.col("observed_at").isNull(), "time").when(F.col("value").isNull(), "value")
    return _marked(rows, ["series_id", "value", "observed_at"], reason, empty, F.when(empty, F.col("payload")).otherwise(F.to_json("o")))


def _placed(payloads: DataFrame, locs: DataFrame | None) -> DataFrame:
    """The payloads with the location they are of: their own, else that at the identifier's exact coordinates (SRC-10)."""
    parsed = payloads.select("file", "identifier", "payload", F.from_json("payload", L.HOURLY_PAYLOAD).alias("j"))
    if locs is None:
        return parsed.withColumn("location_id", F.coalesce("j.location_id", F.col("identifier").try_cast("long")))
    point = F.split("identifier", ",")
    at = parsed.select("*", F.get(point, F.lit(0)).try_cast("double").alias("latitude"), F.get(point, F.lit(1)).try_cast("double").alias("longitude"))
    places = locs.groupBy("latitude", "longitude").agg(F.min("id").alias("_at"))
    return at.join(places, ["latitude", "longitude"], "left").withColumn("location_id", F.coalesce("j.location_id", "_at"))


def _hours(placed: DataFrame, whole: Column) -> DataFrame:
    def arr(f):
        return F.coalesce(F.col(f"j.hourly.{f}"), F.array().cast("array<string>" if f == "time" else "array<double>")).alias(f)

    hours = F.when(F.coalesce(whole, F.lit(False)), F.arrays_zip(*[arr(f) for f in L.HOURLY_FIELDS]))
    rows = placed.select("file", "payload", "location_id", F.explode_outer(hours).alias("h"))
    return rows.select("*", *[F.col(f"h.{a}").alias(b) for a, b in L.RENAMES.items()],
                       F.col("h.time").try_cast("timestamp_ntz").alias("observed_at"))


def _weather(rows: DataFrame) -> DataFrame:
    empty = F.col("h").isNull()
    reason = F.when(empty, "empty").when(F.col("location_id").isNull(), "key").when(F.col("observed_at").isNull(), "time")
    return _marked(rows, ["location_id", *MEASURES, "observed_at"], reason, empty, F.when(empty, F.col("payload")).otherwise(F.to_json("h")))


def forecast(payloads: DataFrame, locs: DataFrame | None = None) -> DataFrame:
    """SRC-2: one row per hour. A payload whose required arrays fall short of its times is lost as a whole; rain that is
    absent is 0."""
    need = F.size("j.hourly.time") > 0
    for f in L.HOURLY_FIELDS[1:5]:
        need = need & (F.coalesce(F.size(f"j.hourly.{f}"), F.lit(-1)) >= F.size("j.hourly.time"))
    rows = _hours(_placed(payloads, locs), need)
    return _weather(rows.withColumn("precipitation", F.coalesce("precipitation", F.when(F.col("h").isNotNull(), F.lit(0.0)))))


def archive(payloads: DataFrame, locs: DataFrame | None = None) -> DataFrame:
    """SRC-3: one row per hour, measures null where their array is short."""
    return _weather(_hours(_placed(payloads, locs), F.size("j.hourly.time") > 0))


def retail(payloads: DataFrame, start_year: int | None = None) -> DataFrame:
    """SRC-4: monthly sales of the kept codes from ``start_year`` on; a null value is 0."""
    cells = payloads.select("file", "payload", F.from_json("payload", "array<array<string>>").alias("a"))
    rows = cells.select("file", "payload", F.posexplode_outer("a").alias("pos", "r"))
    kept = rows.filter(F.col("r").isNull() | ((F.col("pos") > 0) & (F.get("r", F.lit(1)) == RETAIL_DATA_TYPE) & F.get("r", F.lit(2)).isin(list(TARGET_NAICS))))
    label = F.create_map(*[F.lit(x) for pair in TARGET_NAICS.items() for x in pair])
    code, cell = F.get("r", F.lit(2)), F.get("r", F.lit(0))
    kept = kept.select("file", "payload", "r", code.alias("naics_code"), F.element_at(label, code).alias("category_name"),
                       F.when(F.col("r").isNotNull(), F.coalesce(cell, F.lit("0"))).try_cast("double").alias("value"),
                       F.try_to_timestamp(F.get("r", F.lit(3)), F.lit("yyyy-MM")).cast("timestamp_ntz").alias("observed_at"))
    if start_year:
        kept = kept.filter(F.col("observed_at").isNull() | (F.year("observed_at") >= start_year))
    empty = F.col("r").isNull()
    reason = F.when(empty, "empty").when(F.col("observed_at").isNull(), "time").when(F.col("value").isNull(), "value")
    return _marked(kept, ["naics_code", "category_name", "value", "observed_at"], reason, empty, F.when(empty, F.col("payload")).otherwise(F.to_json("r")))


def split(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write a parser's result once at ``path`` and return (good rows, rejects)."""
    parsed.write.mode("overwrite").parquet(path)
    made = parsed.sparkSession.read.schema(parsed.schema).parquet(path)
    good = made.filter("reason IS NULL").drop("kind", "reason", "record", "file")
    return good, made.filter("reason IS NOT NULL").select(*REJECT)
