"""Staging projections (STG-1..STG-4): typed, cleaned, de-duplicated observation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.constants import FUTURE_TOLERANCE_DAYS
from tempora.functions.exprs import ntz, year_month
from tempora.operators.dedupe import dedupe_latest


def stg_weather(obs: DataFrame, as_of: str, future_days: int = FUTURE_TOLERANCE_DAYS) -> DataFrame:
    """STG-1: drop rows later than as_of + 1 day (forecast rows), keep the newest row per
    (location_id, observed_at), NULL rain -> 0.0."""
    cutoff = F.timestamp_add("DAY", F.lit(future_days), ntz(as_of))
    fresh = obs.filter(F.col("observed_at") <= cutoff)
    latest = dedupe_latest(
        fresh.select("location_id", "observed_at", "temperature_c", "precipitation", "created_at", "id"),
        ["location_id", "observed_at"], ["created_at"], ["temperature_c", "precipitation", "id"])
    return latest.select(
        "location_id",
        "observed_at",
        F.to_date("observed_at").alias("observation_date"),
        "temperature_c",
        F.coalesce(F.col("precipitation"), F.lit(0.0)).alias("precipitation_mm"),
    )


def stg_economic(obs: DataFrame) -> DataFrame:
    """STG-2: cast, date and 'YYYY-MM' key. No dedupe (the merge on the unique key does it)."""
    return obs.select(
        "series_id",
        "series_name",
        "value",
        "observed_at",
        F.to_date("observed_at").alias("observation_date"),
        year_month("observed_at").alias("year_month"),
    )


def retail_observation_id(code, ts) -> F.Column:
    """Surrogate key: hex MD5 of code || 'YYYY-MM-DD HH:MM:SS'."""
    return F.md5(F.concat(F.col(code), F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss")))


def stg_retail(obs: DataFrame) -> DataFrame:
    """STG-3: surrogate id, year/month parts, newest row per (naics_code, observed_at)."""
    latest = dedupe_latest(obs, ["naics_code", "observed_at"], ["created_at"], ["value", "category_name"])
    return latest.select(
        retail_observation_id("naics_code", "observed_at").alias("observation_id"),
        "naics_code",
        "category_name",
        F.col("value").cast("double").alias("sales_millions"),
        F.to_date("observed_at").alias("observed_date"),
        F.year("observed_at").alias("observed_year"),
        F.month("observed_at").alias("observed_month"),
    )


def stg_locations(locs: DataFrame) -> DataFrame:
    """STG-4: pure projection of the location dimension."""
    return locs.select("id", "name", "country", "region", "latitude", "longitude")
