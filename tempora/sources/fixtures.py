"""Adapter views: the weather / economic / retail observation tables derived from the
driver's TPC-H-like parquet tables (see FIXTURES.md section 3).

Each view exists twice with the same expressions: as a Spark DataFrame builder
(used by every registered query) and as a SQL common-table-expression (used by the
DuckDB oracle). Nothing here collects; every view grows with its input tables.

  locations             nation x region: id, name, country, region, latitude, longitude
  weather_observations  lineitem x supplier: one hourly-style reading per line item
  economic_observations orders x customer: one row per (market segment -> series, month)
  retail_observations   orders: one row per (order priority -> NAICS code, month)
  event_stream          events, ts as TIMESTAMP for watermarks
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.constants import FRED_SERIES, TARGET_NAICS
from tempora.functions.exprs import month_start
from tempora.schemas import INPUT_TABLES

# Fixed adapter mappings (our own choice, stated in FIXTURES.md).
SEGMENT_TO_SERIES = {
    "AUTOMOBILE": "CPIAUCSL",
    "BUILDING": "UNRATE",
    "FURNITURE": "GDP",
    "HOUSEHOLD": "FEDFUNDS",
    "MACHINERY": "PAYEMS",
}
SERIES_LABELS = {**FRED_SERIES, "GDP": "GDP"}
PRIORITY_TO_NAICS = {
    "1-URGENT": "44W72",
    "2-HIGH": "445",
    "3-MEDIUM": "454",
    "4-NOT SPECIFIED": "441",
    "5-LOW": "448",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its declared schema (no footer read to infer it)."""
    reader = spark.read
    if name in INPUT_TABLES:
        reader = reader.schema(INPUT_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_map(col, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


def _sql_case_map(col: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} END"


# ---------------------------------------------------------------- Spark builders

def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("country"),
        F.lit(None).cast("string").alias("region"),
        (F.col("n_nationkey").cast("double") * 3.0 - 36.0).alias("latitude"),
        (F.col("n_nationkey").cast("double") * 7.0 - 84.0).alias("longitude"),
    )


def weather_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(su, li.l_suppkey == su.s_suppkey, "inner").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("s_nationkey").cast("long").alias("location_id"),
        (F.col("l_quantity") - 25.0).alias("temperature_c"),
        F.round(F.col("l_discount") * 100.0, 2).alias("wind_speed"),
        (F.col("l_linenumber").cast("double") * 5.0 + 990.0).alias("pressure"),
        (F.col("l_quantity") + 40.0).alias("humidity"),
        F.when(F.col("l_tax") == 0.08, F.lit(None).cast("double"))
        .otherwise(F.round(F.col("l_tax") * 100.0, 2)).alias("precipitation"),
        F.col("l_shipdate").alias("observed_at"),
        F.timestamp_add("DAY", F.col("l_linenumber"), F.col("l_shipdate")).alias("created_at"),
    )


def economic_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    series = _case_map(F.col("c_mktsegment"), SEGMENT_TO_SERIES)
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
        .groupBy(series.alias("series_id"), month_start("o_orderdate").alias("observed_at"))
        .agg(
            (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("value"),
            F.max("o_orderdate").alias("created_at"),
        )
        .select(
            "series_id",
            _case_map(F.col("series_id"), SERIES_LABELS).alias("series_name"),
            "value",
            "observed_at",
            "created_at",
        )
    )


def retail_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderdate")
    code = _case_map(F.col("o_orderpriority"), PRIORITY_TO_NAICS)
    return (
        orders.groupBy(code.alias("naics_code"), month_start("o_orderdate").alias("observed_at"))
        .agg(
            (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 1000000.0).alias("value"),
            F.max("o_orderdate").alias("created_at"),
        )
        .select(
            "naics_code",
            _case_map(F.col("naics_code"), TARGET_NAICS).alias("category_name"),
            "value",
            "observed_at",
            "created_at",
        )
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


VIEWS = {
    "locations": locations,
    "weather_observations": weather_observations,
    "economic_observations": economic_observations,
    "retail_observations": retail_observations,
}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register the adapter views as temp views for SQL-API use."""
    for name, build in VIEWS.items():
        build(spark, sf_dir).createOrReplaceTempView(name)


# ---------------------------------------------------------------- DuckDB CTE text

SQL_VIEWS = {
    "locations": """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS country,
       CAST(NULL AS VARCHAR) AS region,
       CAST(n_nationkey AS DOUBLE) * 3.0 - 36.0 AS latitude,
       CAST(n_nationkey AS DOUBLE) * 7.0 - 84.0 AS longitude
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "weather_observations": """
SELECT l_orderkey * 100 + l_linenumber AS id,
       CAST(s_nationkey AS BIGINT) AS location_id,
       l_quantity - 25.0 AS temperature_c,
       ROUND(l_discount * 100.0, 2) AS wind_speed,
       CAST(l_linenumber AS DOUBLE) * 5.0 + 990.0 AS pressure,
       l_quantity + 40.0 AS humidity,
       CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN CAST(NULL AS DOUBLE) ELSE ROUND(l_tax * 100.0, 2) END AS precipitation,
       l_shipdate AS observed_at,
       l_shipdate + l_linenumber * INTERVAL 1 DAY AS created_at
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "economic_observations": f"""
SELECT series_id, {_sql_case_map('series_id', SERIES_LABELS)} AS series_name, value, observed_at, created_at
FROM (
  SELECT {_sql_case_map('c_mktsegment', SEGMENT_TO_SERIES)} AS series_id,
         CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS observed_at,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS value,
         MAX(o_orderdate) AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2
) e""",
    "retail_observations": f"""
SELECT naics_code, {_sql_case_map('naics_code', TARGET_NAICS)} AS category_name, value, observed_at, created_at
FROM (
  SELECT {_sql_case_map('o_orderpriority', PRIORITY_TO_NAICS)} AS naics_code,
         CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS observed_at,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000000.0 AS value,
         MAX(o_orderdate) AS created_at
  FROM orders
  GROUP BY 1, 2
) r""",
}
