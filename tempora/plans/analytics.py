"""Q-1 .. Q-16: analytical queries over the raw weather observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.exprs import exact_avg, ntz
from tempora.operators.aggregates import before_after, period_agg, split_mean, top_periods, with_city
from tempora.operators.dedupe import dedupe_latest
from tempora.operators.streaks import longest_streak
from tempora.operators.windows import period_change, rolling_avg
from tempora.plans import AS_OF
from tempora.sources import fixtures as fx


def _w(spark, sf):
    return fx.weather_observations(spark, sf)


def complete_years(obs: DataFrame, as_of: str = AS_OF, ts="observed_at") -> DataFrame:
    """FLT-2: rows before the start of as_of's year (a prunable range, not YEAR(ts) < YEAR(now))."""
    start = F.make_timestamp_ntz(F.year(ntz(as_of)), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return obs.filter(F.col(ts) < start)


def yearly_mean(obs: DataFrame, by_location: bool = True) -> DataFrame:
    keys = (["location_id"] if by_location else []) + [F.year("observed_at").alias("year")]
    return obs.groupBy(*keys).agg(exact_avg("temperature_c").alias("avg_temp"))


def q01_rolling_30d_avg(spark: SparkSession, sf: str, location_id: int = 1) -> DataFrame:
    return rolling_avg(_w(spark, sf), only=location_id)


def q01_rolling_30d_avg_all(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_avg(_w(spark, sf))


def q01_rolling_30d_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_avg(_w(spark, sf), calendar=True)


def q02_avg_yearly_difference(spark: SparkSession, sf: str, as_of: str = AS_OF) -> DataFrame:
    yearly = yearly_mean(complete_years(_w(spark, sf), as_of))
    diffs = period_change(yearly, "location_id", "year", "avg_temp", out="yearly_difference")
    return diffs.groupBy("location_id").agg(exact_avg("yearly_difference").alias("avg_yearly_difference"))


def q03_avg_yearly_temp(spark: SparkSession, sf: str, as_of: str = AS_OF) -> DataFrame:
    return yearly_mean(complete_years(_w(spark, sf), as_of), by_location=False).orderBy("year")


def q04_yoy_temp_difference(spark: SparkSession, sf: str) -> DataFrame:
    yearly = yearly_mean(_w(spark, sf))
    return period_change(yearly, "location_id", "year", "avg_temp", out="yoy_difference") \
        .select("location_id", "year", "yoy_difference")


def q04_yoy_temp_pct(spark: SparkSession, sf: str) -> DataFrame:
    yearly = yearly_mean(_w(spark, sf))
    return period_change(yearly, "location_id", "year", "avg_temp", pct=True, out="yoy_pct") \
        .select("location_id", "year", "yoy_pct")


def q05_longest_subzero_streak_all(spark: SparkSession, sf: str) -> DataFrame:
    return longest_streak(_w(spark, sf), fx.locations(spark, sf), "temperature_c", "<", 0,
                          keep_all=True, out="longest_streak")


def q06_dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_latest(_w(spark, sf), ["location_id", "observed_at"], ["created_at"])


def q07_avg_rain_annualised(spark: SparkSession, sf: str) -> DataFrame:
    g = _w(spark, sf).groupBy("location_id").agg(
        (exact_avg(F.coalesce(F.col("precipitation"), F.lit(0.0))) * 24 * 365).alias("avg_rain"))
    return with_city(g, fx.locations(spark, sf)).select("location_id", "city", "avg_rain").orderBy("city")


def q08_avg_temp_after_2000(spark: SparkSession, sf: str) -> DataFrame:
    return split_mean(_w(spark, sf), "temperature_c", "2000-01-01 00:00:00", after=True)


def q09_avg_temp_before_2000(spark: SparkSession, sf: str) -> DataFrame:
    return split_mean(_w(spark, sf), "temperature_c", "2000-01-01 00:00:00", after=False)


def q10_avg_temp_before_after_2000(spark: SparkSession, sf: str) -> DataFrame:
    return before_after(_w(spark, sf))


def q11_avg_temp_by_month(spark: SparkSession, sf: str) -> DataFrame:
    g = period_agg(_w(spark, sf), fx.locations(spark, sf), "month", "temperature_c", "avg", out="avg_temp")
    return g.select("location_id", "city", "year", "month", "avg_temp").orderBy("city", "year", "month")


def q12_avg_temp_by_year(spark: SparkSession, sf: str) -> DataFrame:
    g = period_agg(_w(spark, sf), fx.locations(spark, sf), "year", "temperature_c", "avg", out="avg_temp")
    return g.select("location_id", "city", "year", "avg_temp").orderBy("city", "year")


def q13_count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _w(spark, sf).agg(F.count(F.lit(1)).alias("total_rows"))


def q14_hottest_years(spark: SparkSession, sf: str) -> DataFrame:
    return top_periods(_w(spark, sf), "year", "temperature_c", "avg", n=10, out="avg_temp")


def q15_rain_by_year(spark: SparkSession, sf: str) -> DataFrame:
    g = period_agg(_w(spark, sf), fx.locations(spark, sf), "year", "precipitation", "sum", fill=0,
                   out="total_rain")
    return g.select("location_id", "city", "year", "total_rain").orderBy("city", "year")


def q16_rainiest_years(spark: SparkSession, sf: str) -> DataFrame:
    return top_periods(_w(spark, sf), "year", "precipitation", "sum", n=10, out="total_precip")
