"""Data-quality checks DQ-1..DQ-11. Each check returns the *failing rows*; empty = pass.

All checks are filters or grouped counts with map-side partial aggregation; none
collects. ``check_report`` unions one count row per check (the suite's gate).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.constants import (
    FUTURE_TOLERANCE_DAYS, NON_NEGATIVE_SERIES, PRECIP_MAX_MM, PRECIP_MIN_MM, STALE_ECONOMIC_DAYS, TEMP_MAX_C,
    TEMP_MIN_C,
)
from tempora.functions.exprs import ntz


# Row predicates shared by the failing-row checks and the one-pass report.

def negative_economic() -> F.Column:
    return F.col("series_id").isin(NON_NEGATIVE_SERIES) & (F.col("value") < 0)


def future_economic(as_of: str) -> F.Column:
    return F.col("observed_at") > ntz(as_of)


def future_weather(as_of: str) -> F.Column:
    return F.col("observed_at") > F.timestamp_add("DAY", F.lit(FUTURE_TOLERANCE_DAYS), ntz(as_of))


def out_of_bounds() -> F.Column:
    t, p = F.col("temperature_c"), F.col("precipitation_mm")
    return (t > TEMP_MAX_C) | (t < TEMP_MIN_C) | (p > PRECIP_MAX_MM) | (p < PRECIP_MIN_MM)


def negative_retail() -> F.Column:
    return F.col("sales_millions") < 0


def check_economic_positive(stg_econ: DataFrame) -> DataFrame:
    """DQ-1: listed series must not be negative (zero passes)."""
    return stg_econ.filter(negative_economic()).select("series_id", "observed_at", "value")


def check_no_future_economic(stg_econ: DataFrame, as_of: str) -> DataFrame:
    """DQ-2: observed_at must not be after as_of."""
    return stg_econ.filter(future_economic(as_of)).select("series_id", "observed_at")


def check_no_future_weather(stg_w: DataFrame, as_of: str) -> DataFrame:
    """DQ-3: observed_at must not be after as_of + 1 day."""
    return stg_w.filter(future_weather(as_of)).select("observed_at")


def check_out_of_bounds(stg_w: DataFrame) -> DataFrame:
    """DQ-4: physically impossible readings with the first failing reason."""
    t, p = F.col("temperature_c"), F.col("precipitation_mm")
    reason = (F.when(t > TEMP_MAX_C, "temp_too_high").when(t < TEMP_MIN_C, "temp_too_low")
              .when(p > PRECIP_MAX_MM, "precip_too_high").when(p < PRECIP_MIN_MM, "precip_negative"))
    return stg_w.filter(out_of_bounds()).select("location_id", "observed_at", "temperature_c", "precipitation_mm",
                                                reason.alias("failure_reason"))


def check_retail_positive(stg_r: DataFrame) -> DataFrame:
    """DQ-5: retail sales must not be negative."""
    return stg_r.filter(negative_retail()).select("sales_millions")


def check_stale_economic(stg_econ: DataFrame, as_of: str, max_age_days: int = STALE_ECONOMIC_DAYS) -> DataFrame:
    """DQ-6: series whose latest observation is older than as_of - 365 days."""
    latest = stg_econ.groupBy("series_id").agg(F.max("observed_at").alias("most_recent_observation"))
    limit = F.timestamp_add("DAY", F.lit(-max_age_days), ntz(as_of))
    return latest.filter(F.col("most_recent_observation") < limit)


def check_unique_coordinates(stg_l: DataFrame) -> DataFrame:
    """DQ-7: (latitude, longitude) must be unique."""
    return stg_l.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("duplicate_count")) \
        .filter(F.col("duplicate_count") > 1)


WEATHER_ROW = ["location_id", "observed_at", "observation_date", "temperature_c", "precipitation_mm"]


def check_unique_weather(stg_w: DataFrame) -> DataFrame:
    """DQ-8: whole-row duplicates (same key with different values passes)."""
    return stg_w.groupBy(*WEATHER_ROW).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(*WEATHER_ROW)


NOT_NULL_RULES = [
    ("stg_locations", "id"), ("stg_locations", "name"), ("stg_locations", "latitude"),
    ("stg_locations", "longitude"), ("stg_weather_observations", "location_id"),
    ("stg_weather_observations", "observed_at"), ("stg_economic_observations", "series_id"),
    ("stg_economic_observations", "observed_at"), ("stg_retail_observations", "observation_id"),
    ("stg_retail_observations", "naics_code"), ("stg_retail_observations", "observed_date"),
]
UNIQUE_RULES = [("stg_locations", "id"), ("stg_retail_observations", "observation_id")]


def check_not_null(models: dict) -> DataFrame:
    """DQ-9: one row per (model, column) rule with its count of NULLs; failing rules only.
    One aggregation per model covers all of that model's rules."""
    parts = []
    for model in dict.fromkeys(m for m, _ in NOT_NULL_RULES):
        cols = [c for m, c in NOT_NULL_RULES if m == model]
        counts = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.col(c).alias("failures"))
            for c in cols]))))
    return reduce(DataFrame.unionByName, parts).filter(F.col("failures") > 0)


def check_unique(models: dict) -> DataFrame:
    """DQ-10: duplicated values of declared-unique columns (model, column, value, n)."""
    parts = []
    for m, c in UNIQUE_RULES:
        parts.append(models[m].groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > 1)
                     .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"), "value", "n"))
    return reduce(DataFrame.unionByName, parts)


def check_report(checks: dict) -> DataFrame:
    """DQ-11: one row per check: (check_name, failures, status PASS/FAIL)."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
             for name, df in checks.items()]
    rep = reduce(DataFrame.unionByName, parts)
    return rep.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def all_checks(models: dict, as_of: str) -> dict:
    """Every check over a dict of staging models, in the suite's order."""
    w, e = models["stg_weather_observations"], models["stg_economic_observations"]
    r, l = models["stg_retail_observations"], models["stg_locations"]
    return {
        "dq_economic_positive": check_economic_positive(e),
        "dq_no_future_economic": check_no_future_economic(e, as_of),
        "dq_no_future_weather": check_no_future_weather(w, as_of),
        "dq_out_of_bounds": check_out_of_bounds(w),
        "dq_retail_positive": check_retail_positive(r),
        "dq_stale_economic": check_stale_economic(e, as_of),
        "dq_unique_coordinates": check_unique_coordinates(l),
        "dq_unique_weather": check_unique_weather(w),
        "dq_not_null": check_not_null(models),
        "dq_unique": check_unique(models),
    }


def _dup_groups(df: DataFrame, cols) -> DataFrame:
    """Number of value groups of ``cols`` occurring more than once (one row)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1) \
        .agg(F.count(F.lit(1)).alias("failures"))


def _rows(agg: DataFrame, names) -> DataFrame:
    return agg.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"),
                                                  F.col(n).cast("long").alias("failures")) for n in names])))


def _rule_hits(model: str, counts: dict) -> F.Column:
    """Number of not-null rules of ``model`` with at least one NULL."""
    return sum(F.when(counts[c] > 0, 1).otherwise(0) for m, c in NOT_NULL_RULES if m == model)


def report_one_pass(models: dict, as_of: str) -> DataFrame:
    """DQ-11 computed with one grouped aggregation per staging model instead of one scan
    per check. Each model is grouped once by the key of its grouped check (whole row for
    weather, series for economic, observation id for retail); the row-level checks are
    functions of rows, summed over the groups' row counts. Weather is already hash-
    partitioned by (location_id, observed_at) from its dedupe, so its grouping adds no
    shuffle. Same rows as ``check_report(all_checks(...))``."""
    w, e = models["stg_weather_observations"], models["stg_economic_observations"]
    r, l = models["stg_retail_observations"], models["stg_locations"]
    n = F.col("n")

    g = w.groupBy(*WEATHER_ROW).agg(F.count(F.lit(1)).alias("n"))
    wc = {c: F.sum(F.when(F.col(c).isNull(), n).otherwise(0)) for c in ["location_id", "observed_at"]}
    wagg = g.agg(F.sum(F.when(future_weather(as_of), n).otherwise(0)).alias("dq_no_future_weather"),
                 F.sum(F.when(out_of_bounds(), n).otherwise(0)).alias("dq_out_of_bounds"),
                 F.count_if(n > 1).alias("dq_unique_weather"),
                 _rule_hits("stg_weather_observations", wc).alias("dq_not_null"))

    stale_limit = F.timestamp_add("DAY", F.lit(-STALE_ECONOMIC_DAYS), ntz(as_of))
    ge = e.groupBy("series_id").agg(F.count_if(negative_economic()).alias("neg"),
                                    F.count_if(future_economic(as_of)).alias("fut"),
                                    F.count_if(F.col("observed_at").isNull()).alias("ts_null"),
                                    F.count(F.lit(1)).alias("n"), F.max("observed_at").alias("latest"))
    ec = {"series_id": F.sum(F.when(F.col("series_id").isNull(), n).otherwise(0)), "observed_at": F.sum("ts_null")}
    eagg = ge.agg(F.sum("neg").alias("dq_economic_positive"), F.sum("fut").alias("dq_no_future_economic"),
                  F.count_if(F.col("latest") < stale_limit).alias("dq_stale_economic"),
                  _rule_hits("stg_economic_observations", ec).alias("dq_not_null"))

    gr = r.groupBy("observation_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(negative_retail()).alias("neg"),
                                         F.count_if(F.col("naics_code").isNull()).alias("code_null"),
                                         F.count_if(F.col("observed_date").isNull()).alias("date_null"))
    rc = {"observation_id": F.sum(F.when(F.col("observation_id").isNull(), n).otherwise(0)),
          "naics_code": F.sum("code_null"), "observed_date": F.sum("date_null")}
    ragg = gr.agg(F.sum("neg").alias("dq_retail_positive"), F.count_if(n > 1).alias("dq_unique"),
                  _rule_hits("stg_retail_observations", rc).alias("dq_not_null"))

    lc = {c: F.count_if(F.col(c).isNull()) for c in ["id", "name", "latitude", "longitude"]}
    parts = [
        _rows(wagg, ["dq_no_future_weather", "dq_out_of_bounds", "dq_unique_weather", "dq_not_null"]),
        _rows(eagg, ["dq_economic_positive", "dq_no_future_economic", "dq_stale_economic", "dq_not_null"]),
        _rows(ragg, ["dq_retail_positive", "dq_unique", "dq_not_null"]),
        _rows(l.agg(_rule_hits("stg_locations", lc).alias("dq_not_null")), ["dq_not_null"]),
        _dup_groups(l, ["latitude", "longitude"]).select(F.lit("dq_unique_coordinates").alias("check_name"),
                                                         "failures"),
        _dup_groups(l, ["id"]).select(F.lit("dq_unique").alias("check_name"), "failures"),
    ]
    rep = reduce(DataFrame.unionByName, parts).groupBy("check_name") \
        .agg(F.sum("failures").cast("long").alias("failures"))
    return rep.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))
