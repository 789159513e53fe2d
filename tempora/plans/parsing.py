"""Payload parsers over payloads made from the given tables, some damaged by a rule (SRC-1..SRC-4, SRC-10, SNK-10).

Each query makes the payloads that a source would have sent, damages some by the number of their month
or order, and parses them back; weather payloads are landed first and read from there, and name their place by
coordinates only. The oracle repeats the rule on the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.sinks import writers as W
from tempora.sources import fixtures as fx
from tempora.sources import landed as L
from tempora.sources import payloads as PL
from tempora.streaming.streams import scratch_path

#: Months whose number is divisible get an unreadable value, the mark of a missing one, or an unreadable time.
BAD_VALUE, MISSING, BAD_TIME = 7, 11, 13
SOON = "soon"


def _month_number() -> F.Column:
    return F.year("observed_at") * 12 + F.month("observed_at")


def parse_economic(spark: SparkSession, sf: str) -> DataFrame:
    """A payload per series (as long as the calendar), and one of each that broke off."""
    k = _month_number()
    value = F.when(k % MISSING == 0, ".").when(k % BAD_VALUE == 0, "n/a").otherwise(F.col("value").cast("string"))
    date = F.when(k % BAD_TIME == 0, SOON).otherwise(F.date_format("observed_at", "yyyy-MM-dd"))
    made = fx.economic_observations(spark, sf).groupBy(F.col("series_id").alias("identifier")).agg(
        F.sort_array(F.collect_list(F.struct(date.alias("date"), value.alias("value")))).alias("observations"))
    whole = F.to_json(F.struct("observations"))
    sent = made.select("identifier", F.explode(F.array(whole, F.substring(whole, 1, 40))).alias("payload"))
    return PL.economic(sent.withColumn("file", F.lit(""))).drop("file", "record")


def parse_retail(spark: SparkSession, sf: str) -> DataFrame:
    """A payload per code: a header and a row for each month, some of another type."""
    k = _month_number()
    cell = F.when(k % MISSING == 0, F.lit(None).cast("string")).when(k % BAD_VALUE == 0, "(S)").otherwise(F.col("value").cast("string"))
    time = F.when(k % BAD_TIME == 0, SOON).otherwise(F.date_format("observed_at", "yyyy-MM"))
    rows = fx.retail_observations(spark, sf).select("naics_code", F.explode(F.array(
        F.array(cell, F.lit("SM"), "naics_code", time, F.lit("us"), F.lit("")),
        F.array(cell, F.lit("MPCSM"), "naics_code", time, F.lit("us"), F.lit("")))).alias("r"))
    head = F.array(F.array(*[F.lit(c) for c in ("cell_value", "data_type_code", "category_code", "time", "us", "x")]))
    sent = rows.groupBy("naics_code").agg(F.to_json(F.concat(head, F.sort_array(F.collect_list("r")))).alias("payload"))
    return PL.retail(sent.select(F.lit("").alias("file"), F.lit("").alias("identifier"), "payload")).drop("file", "record")


def _weather_payloads(spark: SparkSession, sf: str, cut: F.Column) -> DataFrame:
    """A payload per order and place: parallel arrays of at most seven hours, landed under the place's coordinates."""
    locs = fx.locations(spark, sf)
    obs = fx.weather_observations(spark, sf).withColumn("order", F.floor(F.col("id") / 100))
    back = {v: k for k, v in L.RENAMES.items()}
    hour = F.struct("id", F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"), *[F.col(c).alias(f) for c, f in back.items()])
    made = obs.groupBy("location_id", "order").agg(F.sort_array(F.collect_list(hour)).alias("h"), F.min("observed_at").alias("first"))
    times = F.when(F.col("order") % 10 == 1, F.concat(F.array(F.lit(SOON)), F.slice("h.time", 2, F.size("h")))).otherwise(F.col("h.time"))
    temps = F.when(cut, F.slice("h.temperature_2m", 1, F.size("h") - 1)).otherwise(F.col("h.temperature_2m"))
    hourly = F.struct(times.alias("time"), temps.alias("temperature_2m"), *[F.col(f"h.{f}").alias(f) for f in L.HOURLY_FIELDS[2:]])
    year = F.date_format("first", "yyyy")
    placed = made.join(locs.select(F.col("id").alias("location_id"), F.concat_ws(",", "latitude", "longitude").alias("identifier")), "location_id")
    sent = placed.select(
        F.lit("weather").alias("source"), "identifier", F.concat(year, F.lit("-01-01")).alias("window_start"),
        F.concat(year, F.lit("-12-31")).alias("window_end"), F.lit(None).alias("fetched_at"),
        F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"}).alias("payload"))
    root = scratch_path(spark, "landed")
    W.land_raw(sent, root)
    return W.read_landed(spark, root, "weather")


def parse_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Orders divisible by ten fall short of a temperature, so the payload is lost."""
    sent = _weather_payloads(spark, sf, F.col("order") % 10 == 0)
    return PL.forecast(sent, fx.locations(spark, sf)).drop("file", "record")


def parse_archive(spark: SparkSession, sf: str) -> DataFrame:
    """The same payloads as archive ones: the missing temperature is null."""
    sent = _weather_payloads(spark, sf, F.col("order") % 10 == 0)
    return PL.archive(sent, fx.locations(spark, sf)).drop("file", "record")


def economic_sql() -> str:
    return f"""SELECT series_id, CASE WHEN k % {BAD_VALUE} <> 0 THEN value END AS value, CASE WHEN k % {BAD_TIME} <> 0 THEN observed_at END AS observed_at,
  CASE WHEN k % {BAD_TIME} = 0 OR k % {BAD_VALUE} = 0 THEN 'row' END AS kind,
  CASE WHEN k % {BAD_TIME} = 0 THEN 'time' WHEN k % {BAD_VALUE} = 0 THEN 'value' END AS reason
FROM (SELECT *, year(observed_at) * 12 + month(observed_at) AS k FROM economic_observations) x WHERE k % {MISSING} <> 0
UNION ALL SELECT DISTINCT series_id, NULL::DOUBLE, NULL::TIMESTAMP, 'payload', 'empty' FROM economic_observations"""


def retail_sql() -> str:
    return f"""SELECT naics_code, category_name, CASE WHEN k % {MISSING} = 0 THEN 0.0::DOUBLE WHEN k % {BAD_VALUE} <> 0 THEN value END AS value,
  CASE WHEN k % {BAD_TIME} <> 0 THEN observed_at END AS observed_at,
  CASE WHEN k % {BAD_TIME} = 0 OR (k % {BAD_VALUE} = 0 AND k % {MISSING} <> 0) THEN 'row' END AS kind,
  CASE WHEN k % {BAD_TIME} = 0 THEN 'time' WHEN k % {BAD_VALUE} = 0 AND k % {MISSING} <> 0 THEN 'value' END AS reason
FROM (SELECT *, year(observed_at) * 12 + month(observed_at) AS k FROM retail_observations) x"""


def weather_sql(archive: bool) -> str:
    lost = "FALSE" if archive else "o % 10 = 0"
    temperature = "CASE WHEN o % 10 = 0 AND nth = n THEN NULL ELSE temperature_c END" if archive else "temperature_c"
    rain = "precipitation" if archive else "COALESCE(precipitation, 0.0::DOUBLE)"
    measures = "wind_speed, pressure, humidity"
    rows = f"""SELECT location_id, {temperature} AS temperature_c, {measures}, {rain} AS precipitation,
  CASE WHEN o % 10 = 1 AND nth = 1 THEN NULL ELSE observed_at END AS observed_at,
  CASE WHEN o % 10 = 1 AND nth = 1 THEN 'row' END AS kind, CASE WHEN o % 10 = 1 AND nth = 1 THEN 'time' END AS reason
FROM x WHERE NOT ({lost})"""
    gone = f"""SELECT location_id, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::TIMESTAMP, 'payload', 'empty'
FROM x WHERE {lost} GROUP BY location_id, o"""
    return f"SELECT * FROM ({rows} UNION ALL {gone}) y"


X_SQL = """SELECT *, row_number() OVER (PARTITION BY location_id, o
  ORDER BY id, observed_at, temperature_c, wind_speed, pressure, humidity, precipitation NULLS FIRST) AS nth, count(*) OVER (PARTITION BY location_id, o) AS n
FROM (SELECT *, id // 100 AS o FROM weather_observations) z"""
