"""Staging, intermediate and mart models (STG-1..4, Q-17..Q-26).

Each model is a function of DataFrames; ``Models`` wires them over one input
directory. Within one Spark action identical sub-plans share their exchanges
(ReuseExchange); across actions, ``tempora.plans.jobs`` writes models to Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.functions.constants import ECONOMIC_PIVOT, RETAIL_PIVOT
from tempora.functions.exprs import exact_avg, exact_sum, ntz, round_half_up, safe_pct_change, year_month
from tempora.operators import staging
from tempora.operators.pivots import pivot_values
from tempora.operators.streaks import longest_streak
from tempora.plans import AS_OF
from tempora.sources import fixtures as fx


# ----------------------------------------------------------------- pure model functions

def economic_pivot(stg_econ: DataFrame) -> DataFrame:
    """Q-17: one row per month, MAX(CASE) per indicator -> NULL when absent."""
    return pivot_values(stg_econ, "year_month", "series_id", "value", ECONOMIC_PIVOT, agg="max")


def monthly_weather(stg_w: DataFrame) -> DataFrame:
    """Q-18: per location-month rounded mean temperature, rounded rain total and
    ``subzero_days`` -- which counts sub-zero *readings*, as the source model does."""
    return stg_w.groupBy("location_id", year_month("observed_at").alias("year_month")).agg(
        round_half_up(exact_avg("temperature_c"), 2).alias("avg_monthly_temp_c"),
        round_half_up(exact_sum("precipitation_mm"), 2).alias("total_monthly_precipitation_mm"),
        F.sum(F.when(F.col("temperature_c") < 0, 1).otherwise(0)).cast("long").alias("subzero_days"),
    )


def subzero_calendar_days(stg_w: DataFrame) -> DataFrame:
    """Extra: per location-month, the number of *days* whose mean is below zero."""
    daily = stg_w.groupBy("location_id", "observation_date").agg(exact_avg("temperature_c").alias("t"))
    return daily.groupBy("location_id", year_month("observation_date").alias("year_month")).agg(
        F.count(F.when(F.col("t") < 0, 1)).alias("subzero_calendar_days"))


def retail_pivot(stg_r: DataFrame) -> DataFrame:
    """Q-19: one row per (year, month), SUM(CASE .. ELSE 0) per sector, and YoY growth of
    the total against the row 12 rows earlier (rows, not calendar months).

    The LAG runs as one global window, but its input is one row per month -- bounded by
    the calendar, not the data size."""
    piv = pivot_values(stg_r, ["observed_year", "observed_month"], "naics_code", "sales_millions",
                       RETAIL_PIVOT, agg="sum", missing=0)
    w = Window.orderBy("observed_year", "observed_month")
    prev = F.lag("total_retail_sales_millions", 12).over(w)
    return piv.withColumn("total_retail_sales_yoy_growth_pct",
                          safe_pct_change(F.col("total_retail_sales_millions"), prev))


def weather_daily(stg_w: DataFrame) -> DataFrame:
    """Q-20."""
    return stg_w.groupBy("location_id", F.to_date("observed_at").alias("observed_at_date")).agg(
        exact_avg("temperature_c").alias("avg_daily_temp_c"),
        exact_sum("precipitation_mm").alias("total_daily_precipitation_mm"))


def weather_monthly(stg_w: DataFrame) -> DataFrame:
    """Q-21."""
    return stg_w.groupBy("location_id", year_month("observed_at").alias("year_month")).agg(
        exact_avg("temperature_c").alias("avg_monthly_temp_c"),
        exact_sum("precipitation_mm").alias("total_monthly_precipitation_mm"))


def subzero_streaks(stg_w: DataFrame, stg_l: DataFrame) -> DataFrame:
    """Q-22: only locations that have a sub-zero day."""
    return longest_streak(stg_w, stg_l, "temperature_c", "<", 0, out="longest_subzero_streak")


def dry_spell(stg_w: DataFrame, stg_l: DataFrame) -> DataFrame:
    """Q-23: longest run of days with zero mean rain (NULL rain is already 0 in staging)."""
    return longest_streak(stg_w, stg_l, "precipitation_mm", "=", 0, out="longest_streak")


def location_climate_summary(stg_l: DataFrame, monthly: DataFrame, streaks: DataFrame) -> DataFrame:
    """Q-24: every location; mean of the rounded monthly means, rounded rain total,
    longest sub-zero streak (0 when none)."""
    all_time = monthly.groupBy("location_id").agg(
        round_half_up(exact_avg("avg_monthly_temp_c"), 2).alias("avg_temp_c"),
        round_half_up(exact_sum("total_monthly_precipitation_mm"), 0).alias("total_precipitation_mm"))
    s = streaks.select(F.col("location_id").alias("s_id"), "longest_subzero_streak")
    w = all_time.withColumnRenamed("location_id", "w_id")
    out = (stg_l.join(s, stg_l.id == s.s_id, "left").join(w, stg_l.id == w.w_id, "left"))
    return out.select("id", "name", "country", "region", "avg_temp_c", "total_precipitation_mm",
                      F.coalesce(F.col("longest_subzero_streak"), F.lit(0)).cast("long")
                      .alias("longest_subzero_streak"))


def monthly_macro_weather(monthly: DataFrame, econ_pivot: DataFrame, stg_l: DataFrame) -> DataFrame:
    """Q-25: monthly weather LEFT JOIN indicators on year_month LEFT JOIN location names."""
    locs = stg_l.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"))
    j = monthly.join(econ_pivot, "year_month", "left").join(locs, "location_id", "left")
    return j.select("location_id", "location_name", "year_month", "avg_monthly_temp_c",
                    "total_monthly_precipitation_mm", "subzero_days", "cpi", "unemployment_rate", "gdp")


RETAIL_MART_COLS = ["total_retail_sales_millions", "total_retail_sales_yoy_growth_pct", "grocery_sales_millions",
                    "ecommerce_sales_millions", "auto_sales_millions", "clothing_sales_millions"]


def monthly_retail_macro(macro_weather: DataFrame, retail_piv: DataFrame) -> DataFrame:
    """Q-26: Q-25 LEFT JOIN retail on 'YYYY-MM' built from (year, month) -- computed on the
    small retail side so the join is a plain equi-join; months without retail stay."""
    r = retail_piv.select(F.format_string("%d-%02d", "observed_year", "observed_month").alias("r_ym"),
                          *RETAIL_MART_COLS)
    j = macro_weather.join(r, macro_weather.year_month == r.r_ym, "left")
    return j.select(*macro_weather.columns, *RETAIL_MART_COLS)


# ----------------------------------------------------------------- wiring over one input

class Models:
    """All models over one input directory, built lazily (nothing is collected). Each
    view or model is built once per instance, so every plan made from one instance
    refers to the same sub-plans (and Spark can reuse their exchanges)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf, self.as_of = spark, sf_dir, as_of
        self._memo: dict = {}

    def _once(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def raw(self, name: str) -> DataFrame:
        return self._once(f"raw:{name}", lambda: fx.VIEWS[name](self.spark, self.sf))

    def stg_weather(self):
        return self._once("stg_weather", lambda: staging.stg_weather(self.raw("weather_observations"), self.as_of))

    def stg_economic(self):
        return self._once("stg_economic", lambda: staging.stg_economic(self.raw("economic_observations")))

    def stg_retail(self):
        return self._once("stg_retail", lambda: staging.stg_retail(self.raw("retail_observations")))

    def stg_locations(self):
        return self._once("stg_locations", lambda: staging.stg_locations(self.raw("locations")))

    def economic_pivot(self):
        return self._once("economic_pivot", lambda: economic_pivot(self.stg_economic()))

    def monthly_weather(self):
        return self._once("monthly_weather", lambda: monthly_weather(self.stg_weather()))

    def retail_pivot(self):
        return self._once("retail_pivot", lambda: retail_pivot(self.stg_retail()))

    def weather_daily(self):
        return self._once("weather_daily", lambda: weather_daily(self.stg_weather()))

    def weather_monthly(self):
        return self._once("weather_monthly", lambda: weather_monthly(self.stg_weather()))

    def subzero_streaks(self):
        return self._once("subzero_streaks", lambda: subzero_streaks(self.stg_weather(), self.stg_locations()))

    def dry_spell(self):
        return self._once("dry_spell", lambda: dry_spell(self.stg_weather(), self.stg_locations()))

    def location_climate_summary(self):
        return self._once("location_climate_summary", lambda: location_climate_summary(
            self.stg_locations(), self.monthly_weather(), self.subzero_streaks()))

    def monthly_macro_weather(self):
        return self._once("monthly_macro_weather", lambda: monthly_macro_weather(
            self.monthly_weather(), self.economic_pivot(), self.stg_locations()))

    def macro_weather_between(self, first: str, last: str) -> DataFrame:
        """The mart's rows of the months ``first`` .. ``last`` ('YYYY-MM'). A month needs its own
        readings only, so the months become a range of ``observed_at`` below the dedupe (whose key
        holds it), which reaches the scan of the readings."""
        stg = self.stg_weather().filter(
            (F.col("observed_at") >= ntz(f"{first}-01 00:00:00"))
            & (F.col("observed_at") < F.add_months(F.to_date(F.lit(f"{last}-01")), 1).cast("timestamp_ntz")))
        return monthly_macro_weather(monthly_weather(stg), self.economic_pivot(), self.stg_locations())

    def monthly_retail_macro(self):
        return self._once("monthly_retail_macro", lambda: monthly_retail_macro(
            self.monthly_macro_weather(), self.retail_pivot()))
