"""Registered forecasting queries over the marts (FC-1..FC-14, AGG-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.operators import forecast as FC
from tempora.plans.models import Models
from tempora.session import cut_lineage

TEST_MONTHS = 12
FUTURE_MONTHS = 12
LOST_MONTH, TWICE_MONTH = 5, 7


def series(spark: SparkSession, sf: str) -> DataFrame:
    """FC-1..FC-3 for every whitelisted series (equal to reading the two marts). The monthly table gives
    the values and the months, so it is made once (checkpointed: a row for each location and month)."""
    m = Models(spark, sf)
    return FC.series_from_models(cut_lineage(m.monthly_weather()), m.economic_pivot(), m.retail_pivot(), m.stg_locations())


def train_test(spark: SparkSession, sf: str) -> DataFrame:
    return FC.train_test_split(series(spark, sf), TEST_MONTHS)


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return FC.series_profile(series(spark, sf))


def _uneven(spark: SparkSession, sf: str) -> DataFrame:
    """The series with some months lost and some twice, by a rule on month and key."""
    s, month, size = series(spark, sf), F.month("month"), F.length("series_key")
    lost = (month == LOST_MONTH) & (F.year("month") % 2 == 0) & (size % 2 == 0)
    return s.filter(~lost).unionByName(s.filter((month == TWICE_MONTH) & (size % 3 == 0)))


def faults(spark: SparkSession, sf: str) -> DataFrame:
    """FC-4: months that a series lacks or has more than once."""
    return FC.series_faults(_uneven(spark, sf))


def regular(spark: SparkSession, sf: str) -> DataFrame:
    """FC-4: the series without such months."""
    return FC.regular_series(_uneven(spark, sf)).select("series_key", "month")


def naive_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-14 on a seasonal-naive forecast (the value 12 rows earlier) of each test month."""
    split = train_test(spark, sf)
    prev = F.lag("value", 12).over(Window.partitionBy("series_key").orderBy("month"))
    pairs = (split.withColumn("predicted", prev)
             .filter((F.col("split") == "test") & F.col("predicted").isNotNull())
             .withColumnRenamed("value", "actual"))
    return FC.error_metrics(pairs)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """FC-6..FC-8: chosen orders per series, fitted on the training months."""
    split = train_test(spark, sf)
    return FC.select_orders(cut_lineage(FC.pack(split.filter(F.col("split") == "train"))))


def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    metrics, _orders, _fc = FC.evaluate(series(spark, sf), TEST_MONTHS)
    return metrics


def predict(spark: SparkSession, sf: str) -> DataFrame:
    """FC-12 with FC-9: the order cache holds the orders chosen on the training months;
    prediction refits those orders on all months and forecasts 12 months ahead."""
    s = series(spark, sf)
    cache = cut_lineage(FC.updated_cache(None, orders(spark, sf)))   # the persisted order cache
    fc, _ = FC.predict(s, FUTURE_MONTHS, cache)
    return fc


def trajectory(spark: SparkSession, sf: str) -> DataFrame:
    return FC.trajectory(series(spark, sf), TEST_MONTHS, FUTURE_MONTHS)
