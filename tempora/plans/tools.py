"""Q-27 .. Q-35: parameterised table functions over the marts and raw tables.

Parameters are bound as DataFrame literals (never spliced into SQL text). Each
LIMIT here is the function's purpose (a bounded answer), always with a total
tie-break so the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.constants import (EXTREME_DEFAULT_METRIC, EXTREME_METRICS, FRESHNESS_MAX_AGE_HOURS,
                                         FUTURE_TOLERANCE_DAYS)
from tempora.functions.exprs import exact_sum, ntz, round_half_up, year_month

MART_COLS = ["location_name", "year_month", "avg_monthly_temp_c", "total_monthly_precipitation_mm",
             "subzero_days", "cpi", "unemployment_rate", "gdp"]


def macro_weather_range(mart: DataFrame, start: str, end: str, location: str | None = None,
                        limit: int = 50) -> DataFrame:
    """Q-27: mart rows with start <= year_month <= end (optionally one city), first 50
    by year_month then city."""
    if start > end:
        raise ValueError("start must not be after end")
    df = mart.filter(F.col("year_month").between(F.lit(start), F.lit(end)))
    if location:
        df = df.filter(F.col("location_name") == F.lit(location))
    return df.select(*MART_COLS).orderBy("year_month", "location_name").limit(limit)


def data_freshness(weather: DataFrame, economic: DataFrame, as_of: str) -> DataFrame:
    """Q-28: latest period of the mart and latest observation of each raw table. The mart keeps a row
    for every month that staging takes a reading of, so its latest period is the month of the latest
    such reading, and one pass over the readings gives both."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    ts = F.col("observed_at")
    staged = F.when(ts <= F.timestamp_add("DAY", F.lit(FUTURE_TOLERANCE_DAYS), ntz(as_of)), ts)
    last = weather.agg(F.max(staged).alias("staged"), F.max(ts).alias("raw"))
    rows = last.select(F.inline(F.array(
        F.struct(F.lit("latest_macro_weather_period").alias("source"), year_month("staged").alias("latest")),
        F.struct(F.lit("latest_weather").alias("source"), F.date_format("raw", fmt).alias("latest")))))
    return rows.unionByName(economic.agg(F.date_format(F.max("observed_at"), fmt).alias("latest"))
                            .select(F.lit("latest_economic").alias("source"), "latest"))


def climate_extremes(mart: DataFrame, year: int, metric: str = EXTREME_DEFAULT_METRIC, n: int = 5) -> DataFrame:
    """Q-29: top-5 location-months of one year by a whitelisted metric (unknown metric ->
    subzero_days, as the source does). Prefix filter pushes down as StringStartsWith."""
    col = EXTREME_METRICS.get(metric, EXTREME_METRICS[EXTREME_DEFAULT_METRIC])
    df = mart.filter(F.col("year_month").startswith(str(int(year))))
    return (df.select("location_name", "year_month", "avg_monthly_temp_c", "total_monthly_precipitation_mm",
                      "subzero_days")
            .orderBy(F.col(col).desc_nulls_last(), "year_month", "location_name").limit(n))


def compare_city_climates(mart: DataFrame, city_a: str, city_b: str, year: int) -> DataFrame:
    """Q-30: two cities side by side, month by month."""
    df = mart.filter(F.col("location_name").isin([city_a, city_b]) &
                     F.col("year_month").startswith(str(int(year))))
    return df.select("location_name", "year_month", "avg_monthly_temp_c", "total_monthly_precipitation_mm") \
        .orderBy("year_month", "location_name")


def latest_weather(weather: DataFrame, locs: DataFrame, n: int = 30) -> DataFrame:
    """Q-31: newest n readings with their city (distributed top-n, full tie-break)."""
    dim = locs.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"))
    j = weather.select("location_id", "observed_at", "temperature_c", "precipitation", "humidity") \
        .join(dim, "location_id", "inner")
    return (j.select("observed_at", "temperature_c", "precipitation", "humidity", "location_name")
            .orderBy(F.col("observed_at").desc(), "location_name", F.col("temperature_c").asc_nulls_first(),
                     F.col("precipitation").asc_nulls_first(), F.col("humidity").asc_nulls_first())
            .limit(n))


def freshness_status(weather: DataFrame, as_of: str, max_age_hours: int = FRESHNESS_MAX_AGE_HOURS) -> DataFrame:
    """Q-32: NO_DATA / STALE (latest older than as_of - 24 h) / HEALTHY."""
    last = F.col("last")
    limit = F.timestamp_add("HOUR", F.lit(-max_age_hours), ntz(as_of))
    return weather.agg(F.max("observed_at").alias("last")).select(
        F.when(last.isNull(), "NO_DATA").when(last < limit, "STALE").otherwise("HEALTHY").alias("status"),
        F.date_format(last, "yyyy-MM-dd HH:mm:ss").alias("last_observation"))


def precip_profile(weather: DataFrame) -> DataFrame:
    """Q-33: per location rows, rainy rows, max and total rain (rounded 2)."""
    p = F.col("precipitation")
    return weather.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(p > 0).alias("rainy_hours_count"),
        round_half_up(F.max(p), 2).alias("max_hourly_rain_mm"),
        round_half_up(exact_sum(p), 2).alias("total_rain_mm"))


def precip_nonnull(weather: DataFrame) -> DataFrame:
    """Q-34: rows with rain > 0 and their non-NULL count (equal given the predicate)."""
    p = F.col("precipitation")
    return weather.filter(p.isNotNull() & (p > 0)).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(p).alias("non_null_precipitation_rows"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q-35: key groups occurring more than once, with their size."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
