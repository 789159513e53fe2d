"""Registry: query key -> (Spark builder taking (spark, sf_dir), DuckDB oracle SQL or None).

Every builder reads the given tables (through the adapter views) over their whole
extent; none of them caps, samples or subsets rows. A LIMIT appears only where the
top-n cut is the query's purpose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tempora.functions.constants import DOMAIN_METRICS, NON_NEGATIVE_SERIES
from tempora.operators import quality as Q
from tempora.plans import AS_OF
from tempora.plans import analytics as A
from tempora.plans import forecasts as FCQ
from tempora.plans import loads as L
from tempora.plans import models as MD
from tempora.plans import parsing as PR
from tempora.plans import streams as ST
from tempora.plans import tools as T
from tempora.plans.models import Models
from tempora.plans.oracle import (
    AS_OF_TS, YEAR_START, desc_order, exact_avg, exact_sum, model, round_half_up, sdiv, streak_ctes, with_ctes,
)
from tempora.sources import fixtures as fx

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(key: str, sql: str | None, fn: Builder) -> None:
    REGISTRY[key] = (fn, sql)


def _m(name: str) -> Builder:
    return lambda spark, sf: getattr(Models(spark, sf), name)()


W = ["weather_observations"]
WL = ["weather_observations", "locations"]
YEAR = "CAST(EXTRACT(year FROM observed_at) AS INTEGER)"
MONTH = "CAST(EXTRACT(month FROM observed_at) AS INTEGER)"


# ------------------------------------------------------------------ Q-1 .. Q-16 (raw weather)

def _roll_sql(where: str, frame: str) -> str:
    daily = ("SELECT location_id, CAST(observed_at AS DATE) AS observation_date, AVG(temperature_c) AS avg_temp "
             f"FROM weather_observations {where} GROUP BY 1, 2")
    avg = sdiv("CAST(SUM(CAST(avg_temp AS DECIMAL(38,10))) OVER w AS DOUBLE)", "CAST(COUNT(avg_temp) OVER w AS DOUBLE)")
    return with_ctes(W, f"""SELECT location_id, observation_date, {avg} AS rolling_avg
FROM daily WINDOW w AS (PARTITION BY location_id ORDER BY observation_date {frame})""", [("daily", daily)])


register("rolling_30d_avg", _roll_sql("WHERE location_id = 1", "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"),
         A.q01_rolling_30d_avg)
register("rolling_30d_avg_all", _roll_sql("", "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"),
         A.q01_rolling_30d_avg_all)
register("rolling_30d_calendar", _roll_sql("", "RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW"),
         A.q01_rolling_30d_calendar)

_YEARLY = f"SELECT location_id, {YEAR} AS year, AVG(temperature_c) AS avg_temp FROM weather_observations"

register("avg_yearly_difference", with_ctes(
    W, f"SELECT location_id, {exact_avg('yearly_difference')} AS avg_yearly_difference FROM d GROUP BY location_id",
    [("y", f"{_YEARLY} WHERE observed_at < {YEAR_START} GROUP BY 1, 2"),
     ("d", "SELECT location_id, year, avg_temp - LAG(avg_temp, 1) OVER (PARTITION BY location_id ORDER BY year) "
           "AS yearly_difference FROM y")]), A.q02_avg_yearly_difference)

register("avg_yearly_temp", with_ctes(W, f"""SELECT {YEAR} AS year, AVG(temperature_c) AS avg_temp
FROM weather_observations WHERE observed_at < {YEAR_START} GROUP BY 1 ORDER BY 1"""), A.q03_avg_yearly_temp)

register("yoy_temp_difference", with_ctes(W, """SELECT location_id, year,
  avg_temp - LAG(avg_temp, 1) OVER (PARTITION BY location_id ORDER BY year) AS yoy_difference FROM y""",
    [("y", f"{_YEARLY} GROUP BY 1, 2")]), A.q04_yoy_temp_difference)

register("yoy_temp_pct", with_ctes(W, f"""SELECT location_id, year,
  {sdiv('avg_temp - LAG(avg_temp, 1) OVER w', 'LAG(avg_temp, 1) OVER w')} * 100 AS yoy_pct
FROM y WINDOW w AS (PARTITION BY location_id ORDER BY year)""",
    [("y", f"{_YEARLY} GROUP BY 1, 2")]), A.q04_yoy_temp_pct)

register("longest_subzero_streak_all", with_ctes(WL, """SELECT l.name, CAST(COALESCE(b.best, 0) AS BIGINT)
  AS longest_streak FROM locations l LEFT JOIN best b ON l.id = b.location_id""",
    streak_ctes("weather_observations", "temperature_c", "< 0", "CAST(observed_at AS DATE)")),
    A.q05_longest_subzero_streak_all)

_DEDUPE_TIE = ["id", "temperature_c", "wind_speed", "pressure", "humidity", "precipitation"]
register("dedupe_latest", with_ctes(W, f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY location_id, observed_at ORDER BY {desc_order(['created_at'] + _DEDUPE_TIE)}) AS rn
  FROM weather_observations) t WHERE rn = 1"""), A.q06_dedupe_latest)

register("avg_rain_annualised", with_ctes(WL, """SELECT w.location_id, l.name AS city,
  AVG(COALESCE(w.precipitation, 0)) * 24 * 365 AS avg_rain
FROM weather_observations w JOIN locations l ON w.location_id = l.id GROUP BY w.location_id, l.name
ORDER BY l.name"""), A.q07_avg_rain_annualised)

register("avg_temp_after_2000", with_ctes(W, """SELECT AVG(temperature_c) AS avg_temp FROM weather_observations
WHERE observed_at >= TIMESTAMP '2000-01-01 00:00:00'"""), A.q08_avg_temp_after_2000)

register("avg_temp_before_2000", with_ctes(W, """SELECT AVG(temperature_c) AS avg_temp FROM weather_observations
WHERE observed_at < TIMESTAMP '2000-01-01 00:00:00'"""), A.q09_avg_temp_before_2000)

register("avg_temp_before_after_2000", with_ctes(W, """
SELECT '2000_and_after' AS period, AVG(temperature_c) AS avg_temp FROM weather_observations
WHERE observed_at >= TIMESTAMP '2000-01-01 00:00:00'
UNION ALL
SELECT 'before_2000' AS period, AVG(temperature_c) AS avg_temp FROM weather_observations
WHERE observed_at < TIMESTAMP '2000-01-01 00:00:00'"""), A.q10_avg_temp_before_after_2000)

register("avg_temp_by_month", with_ctes(WL, f"""SELECT w.location_id, l.name AS city,
  CAST(EXTRACT(year FROM w.observed_at) AS INTEGER) AS year, CAST(EXTRACT(month FROM w.observed_at) AS INTEGER) AS month,
  AVG(w.temperature_c) AS avg_temp
FROM weather_observations w JOIN locations l ON w.location_id = l.id
GROUP BY 1, 2, 3, 4 ORDER BY 2, 3, 4"""), A.q11_avg_temp_by_month)

register("avg_temp_by_year", with_ctes(WL, """SELECT w.location_id, l.name AS city,
  CAST(EXTRACT(year FROM w.observed_at) AS INTEGER) AS year, AVG(w.temperature_c) AS avg_temp
FROM weather_observations w JOIN locations l ON w.location_id = l.id
GROUP BY 1, 2, 3 ORDER BY 2, 3"""), A.q12_avg_temp_by_year)

register("count_rows", with_ctes(W, "SELECT COUNT(*) AS total_rows FROM weather_observations"), A.q13_count_rows)

register("hottest_years", with_ctes(W, f"""SELECT {YEAR} AS year, AVG(temperature_c) AS avg_temp
FROM weather_observations GROUP BY 1 ORDER BY avg_temp DESC NULLS FIRST, year LIMIT 10"""), A.q14_hottest_years)

register("rain_by_year", with_ctes(WL, f"""SELECT w.location_id, l.name AS city,
  CAST(EXTRACT(year FROM w.observed_at) AS INTEGER) AS year, COALESCE({exact_sum('w.precipitation')}, 0) AS total_rain
FROM weather_observations w JOIN locations l ON w.location_id = l.id
GROUP BY 1, 2, 3 ORDER BY 2, 3"""), A.q15_rain_by_year)

register("rainiest_years", with_ctes(W, f"""SELECT {YEAR} AS year, {exact_sum('precipitation')} AS total_precip
FROM weather_observations GROUP BY 1 ORDER BY total_precip DESC NULLS FIRST, year LIMIT 10"""), A.q16_rainiest_years)

# ------------------------------------------------------------------ staging, intermediate, marts

for _name in ["stg_weather", "stg_economic", "stg_retail", "stg_locations", "economic_pivot", "monthly_weather",
              "retail_pivot", "subzero_streaks", "monthly_macro_weather", "monthly_retail_macro"]:
    register(_name, model(_name), _m(_name))

register("weather_daily", with_ctes(["stg_weather"], f"""SELECT location_id,
  CAST(observed_at AS DATE) AS observed_at_date, {exact_avg('temperature_c')} AS avg_daily_temp_c,
  {exact_sum('precipitation_mm')} AS total_daily_precipitation_mm FROM stg_weather GROUP BY 1, 2"""), _m("weather_daily"))

register("weather_monthly", with_ctes(["stg_weather"], f"""SELECT location_id,
  strftime(observed_at, '%Y-%m') AS year_month, {exact_avg('temperature_c')} AS avg_monthly_temp_c,
  {exact_sum('precipitation_mm')} AS total_monthly_precipitation_mm FROM stg_weather GROUP BY 1, 2"""), _m("weather_monthly"))

register("dry_spell", with_ctes(["stg_weather", "stg_locations"], """SELECT b.location_id, l.name,
  CAST(COALESCE(b.best, 0) AS BIGINT) AS longest_streak FROM best b LEFT JOIN stg_locations l ON l.id = b.location_id""",
    streak_ctes("stg_weather", "precipitation_mm", "= 0")), _m("dry_spell"))

register("location_climate_summary", with_ctes(
    ["stg_locations", "monthly_weather", "subzero_streaks"], """SELECT l.id, l.name, l.country, l.region,
  w.avg_temp_c, w.total_precipitation_mm, CAST(COALESCE(s.longest_subzero_streak, 0) AS BIGINT) AS longest_subzero_streak
FROM stg_locations l LEFT JOIN subzero_streaks s ON l.id = s.location_id
LEFT JOIN all_time w ON l.id = w.location_id""",
    [("all_time", f"""SELECT location_id, {round_half_up(exact_avg('avg_monthly_temp_c'), 2)} AS avg_temp_c,
  {round_half_up(exact_sum('total_monthly_precipitation_mm'), 0)} AS total_precipitation_mm
  FROM monthly_weather GROUP BY location_id""")]), _m("location_climate_summary"))

# ------------------------------------------------------------------ Q-27 .. Q-35 table functions


MART = ["monthly_macro_weather"]
_MART_COLS = ", ".join(T.MART_COLS)


def _mart(spark, sf, first, last):
    return Models(spark, sf).macro_weather_between(first, last)


register("macro_weather_range", with_ctes(MART, f"""SELECT {_MART_COLS} FROM monthly_macro_weather
WHERE year_month BETWEEN '1996-01' AND '1997-06' ORDER BY year_month, location_name LIMIT 50"""),
         lambda spark, sf: T.macro_weather_range(_mart(spark, sf, "1996-01", "1997-06"), "1996-01", "1997-06"))
register("macro_weather_range_city", with_ctes(MART, f"""SELECT {_MART_COLS} FROM monthly_macro_weather
WHERE year_month BETWEEN '1996-01' AND '1999-12' AND location_name = 'NATION_3'
ORDER BY year_month, location_name LIMIT 50"""),
         lambda spark, sf: T.macro_weather_range(_mart(spark, sf, "1996-01", "1999-12"), "1996-01", "1999-12", "NATION_3"))

register("data_freshness", with_ctes(MART + W + ["economic_observations"], """
SELECT 'latest_macro_weather_period' AS source, MAX(year_month) AS latest FROM monthly_macro_weather
UNION ALL SELECT 'latest_weather', strftime(MAX(observed_at), '%Y-%m-%d %H:%M:%S') FROM weather_observations
UNION ALL SELECT 'latest_economic', strftime(MAX(observed_at), '%Y-%m-%d %H:%M:%S') FROM economic_observations"""),
         lambda spark, sf: T.data_freshness(fx.weather_observations(spark, sf),
                                            fx.economic_observations(spark, sf), AS_OF))

for _key, _metric, _col in [("climate_extremes", "subzero_days", "subzero_days"),
                            ("climate_extremes_rain", "total_rainfall", "total_monthly_precipitation_mm"),
                            ("climate_extremes_temp", "max_temp", "avg_monthly_temp_c")]:
    register(_key, with_ctes(MART, f"""SELECT location_name, year_month, avg_monthly_temp_c,
  total_monthly_precipitation_mm, subzero_days FROM monthly_macro_weather WHERE starts_with(year_month, '1998')
ORDER BY {_col} DESC NULLS LAST, year_month, location_name LIMIT 5"""),
             (lambda m: lambda spark, sf: T.climate_extremes(_mart(spark, sf, "1998-01", "1998-12"), 1998, m))(_metric))

register("compare_city_climates", with_ctes(MART, """SELECT location_name, year_month, avg_monthly_temp_c,
  total_monthly_precipitation_mm FROM monthly_macro_weather
WHERE location_name IN ('NATION_1', 'NATION_7') AND starts_with(year_month, '1998')
ORDER BY year_month, location_name"""),
         lambda spark, sf: T.compare_city_climates(_mart(spark, sf, "1998-01", "1998-12"), "NATION_1", "NATION_7", 1998))

register("latest_weather", with_ctes(WL, """SELECT w.observed_at, w.temperature_c, w.precipitation, w.humidity,
  l.name AS location_name FROM weather_observations w JOIN locations l ON w.location_id = l.id
ORDER BY w.observed_at DESC, l.name, w.temperature_c NULLS FIRST, w.precipitation NULLS FIRST,
  w.humidity NULLS FIRST LIMIT 30"""),
         lambda spark, sf: T.latest_weather(fx.weather_observations(spark, sf), fx.locations(spark, sf)))

register("freshness_status", with_ctes(W, f"""SELECT CASE WHEN last IS NULL THEN 'NO_DATA'
  WHEN last < {AS_OF_TS} - INTERVAL 24 HOUR THEN 'STALE' ELSE 'HEALTHY' END AS status,
  strftime(last, '%Y-%m-%d %H:%M:%S') AS last_observation
FROM (SELECT MAX(observed_at) AS last FROM weather_observations) t"""),
         lambda spark, sf: T.freshness_status(fx.weather_observations(spark, sf), AS_OF))

register("precip_profile", with_ctes(W, f"""SELECT location_id, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE precipitation > 0) AS rainy_hours_count,
  {round_half_up('MAX(precipitation)')} AS max_hourly_rain_mm, {round_half_up(exact_sum('precipitation'))} AS total_rain_mm
FROM weather_observations GROUP BY location_id"""),
         lambda spark, sf: T.precip_profile(fx.weather_observations(spark, sf)))

register("precip_nonnull", with_ctes(W, """SELECT COUNT(*) AS total_rows,
  COUNT(precipitation) AS non_null_precipitation_rows FROM weather_observations
WHERE precipitation IS NOT NULL AND precipitation > 0"""),
         lambda spark, sf: T.precip_nonnull(fx.weather_observations(spark, sf)))

register("duplicate_keys", with_ctes(W, """SELECT location_id, observed_at, COUNT(*) AS c
FROM weather_observations GROUP BY 1, 2 HAVING COUNT(*) > 1"""),
         lambda spark, sf: T.duplicate_keys(fx.weather_observations(spark, sf), ["location_id", "observed_at"]))

register("duplicate_keys_staged", with_ctes(["stg_weather"], """SELECT location_id, observed_at, observation_date,
  COUNT(*) AS c FROM stg_weather GROUP BY 1, 2, 3 HAVING COUNT(*) > 1"""),
         lambda spark, sf: T.duplicate_keys(Models(spark, sf).stg_weather(),
                                            ["location_id", "observed_at", "observation_date"]))

# ------------------------------------------------------------------ DQ-1 .. DQ-11


def _staged(spark, sf):
    m = Models(spark, sf)
    return {"stg_weather_observations": m.stg_weather(), "stg_economic_observations": m.stg_economic(),
            "stg_retail_observations": m.stg_retail(), "stg_locations": m.stg_locations()}


def _check(name):
    return lambda spark, sf: Q.all_checks(_staged(spark, sf), AS_OF)[name]


_NN = ", ".join(f"'{s}'" for s in NON_NEGATIVE_SERIES)
STG_ALL = ["stg_weather", "stg_economic", "stg_retail", "stg_locations"]
DQ_SQL = {
    "dq_economic_positive": f"SELECT series_id, observed_at, value FROM stg_economic "
                            f"WHERE series_id IN ({_NN}) AND value < 0",
    "dq_no_future_economic": f"SELECT series_id, observed_at FROM stg_economic WHERE observed_at > {AS_OF_TS}",
    "dq_no_future_weather": f"SELECT observed_at FROM stg_weather WHERE observed_at > {AS_OF_TS} + INTERVAL 1 DAY",
    "dq_out_of_bounds": """SELECT location_id, observed_at, temperature_c, precipitation_mm,
  CASE WHEN temperature_c > 90 THEN 'temp_too_high' WHEN temperature_c < -100 THEN 'temp_too_low'
       WHEN precipitation_mm > 2000 THEN 'precip_too_high' WHEN precipitation_mm < 0 THEN 'precip_negative' END
  AS failure_reason FROM stg_weather
WHERE temperature_c > 90 OR temperature_c < -100 OR precipitation_mm > 2000 OR precipitation_mm < 0""",
    "dq_retail_positive": "SELECT sales_millions FROM stg_retail WHERE sales_millions < 0",
    "dq_stale_economic": f"""SELECT series_id, most_recent_observation FROM (SELECT series_id,
  MAX(observed_at) AS most_recent_observation FROM stg_economic GROUP BY series_id) t
WHERE most_recent_observation < {AS_OF_TS} - INTERVAL 365 DAY""",
    "dq_unique_coordinates": """SELECT latitude, longitude, COUNT(*) AS duplicate_count FROM stg_locations
GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "dq_unique_weather": """SELECT location_id, observed_at, observation_date, temperature_c, precipitation_mm
FROM stg_weather GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(*) > 1""",
}
_SQL_MODEL = {"stg_weather_observations": "stg_weather", "stg_economic_observations": "stg_economic",
              "stg_retail_observations": "stg_retail", "stg_locations": "stg_locations"}
DQ_SQL["dq_not_null"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS failures "
    f"FROM {_SQL_MODEL[m]}" for m, c in Q.NOT_NULL_RULES) + ") t WHERE failures > 0"
DQ_SQL["dq_unique"] = " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n "
    f"FROM {_SQL_MODEL[m]} GROUP BY 3 HAVING COUNT(*) > 1" for m, c in Q.UNIQUE_RULES)

for _k, _sql in DQ_SQL.items():
    register(_k, with_ctes(STG_ALL, _sql), _check(_k))

register("dq_report", with_ctes(STG_ALL, " UNION ALL ".join(
    f"SELECT '{k}' AS check_name, COUNT(*) AS failures, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
    f"FROM ({s}) t_{i}" for i, (k, s) in enumerate(DQ_SQL.items()))),
    lambda spark, sf: Q.report_one_pass(_staged(spark, sf), AS_OF))

# ------------------------------------------------------------------ merges, incremental, backfill


_T_BEFORE = f"TIMESTAMP '{L.TARGET_BEFORE}'"
_B_FROM = f"TIMESTAMP '{L.BATCH_FROM}'"


def _dedupe_sql(src: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY location_id, observed_at "
            f"ORDER BY {order}) AS rn FROM {src}) x WHERE rn = 1")


_NEWEST = desc_order(["created_at"] + L.TIE)
_OLDEST = ", ".join(f"{c} ASC NULLS LAST" for c in ["created_at"] + L.TIE)
_WT = [("t", _dedupe_sql(f"(SELECT * FROM weather_observations WHERE observed_at < {_T_BEFORE})", _NEWEST)),
       ("b0", f"SELECT id, location_id, temperature_c + 1.0 AS temperature_c, wind_speed, pressure, humidity, "
              f"precipitation, observed_at, created_at FROM weather_observations WHERE observed_at >= {_B_FROM}")]

_UPSERT_COLS = ", ".join(
    ["CASE WHEN t.location_id IS NOT NULL THEN t.id ELSE b.id END AS id",
     "COALESCE(t.location_id, b.location_id) AS location_id"]
    + [f"CASE WHEN b.location_id IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}" for c in L.MEASURES]
    + ["COALESCE(t.observed_at, b.observed_at) AS observed_at",
       "CASE WHEN t.location_id IS NOT NULL THEN t.created_at ELSE b.created_at END AS created_at"])

_UPSERT = with_ctes(W, f"""SELECT {_UPSERT_COLS} FROM t FULL OUTER JOIN b
  ON t.location_id = b.location_id AND t.observed_at = b.observed_at""", _WT + [("b", _dedupe_sql("b0", _NEWEST))])
register("upsert_last_wins", _UPSERT, L.upsert_last_wins)
register("upsert_by_stream", _UPSERT, L.upsert_by_stream)

register("insert_ignore", with_ctes(W, """SELECT * FROM t UNION ALL
SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.location_id = b.location_id AND t.observed_at = b.observed_at)""",
    _WT + [("b", _dedupe_sql("b0", _OLDEST))]), L.insert_ignore)

register("merge_insert_only", with_ctes(["economic_observations"], f"""SELECT * FROM t UNION ALL
SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.series_id = b.series_id AND t.observed_at = b.observed_at)""",
    [("t", f"SELECT * FROM economic_observations WHERE observed_at < {_T_BEFORE}"),
     ("b", f"SELECT * FROM economic_observations WHERE observed_at >= TIMESTAMP '{L.ECON_BATCH_FROM}'")]),
    L.merge_insert_only)

_ISO = "CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') " \
       "ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END"
register("migrate_weather", with_ctes(W, f"""SELECT location_id, temperature_c, wind_speed, pressure, humidity,
  precipitation, {_ISO.format(c='observed_at')} AS observed_at, {_ISO.format(c='created_at')} AS created_at
FROM weather_observations"""), L.migrate_weather)
register("migrate_economic", with_ctes(["economic_observations"], f"""SELECT series_id,
  COALESCE(series_name, '') AS series_name, CAST(value AS DOUBLE) AS value, {_ISO.format(c='observed_at')} AS observed_at
FROM economic_observations"""), L.migrate_economic)

_DAMAGED = [("damaged", f"""SELECT id, CASE WHEN id % {L.NO_PLACE} <> 0 THEN location_id END AS location_id, temperature_c, wind_speed, pressure,
  humidity, precipitation, CASE WHEN id % {L.NO_TIME} <> 0 THEN observed_at END AS observed_at, created_at FROM weather_observations""")]
register("migrate_resumed", with_ctes(W, f"""SELECT id, location_id, temperature_c, wind_speed, pressure, humidity, precipitation,
  {_ISO.format(c='observed_at')} AS observed_at, {_ISO.format(c='created_at')} AS created_at
FROM damaged WHERE observed_at IS NOT NULL AND location_id IS NOT NULL""", _DAMAGED), L.migrate_resumed)
register("migrate_errors", with_ctes(W, """SELECT id, CASE WHEN observed_at IS NULL THEN 'no time' ELSE 'no place' END AS reason
FROM damaged WHERE observed_at IS NULL OR location_id IS NULL""", _DAMAGED), L.migrate_errors)

register("evolve_add_column", with_ctes(W, f"""SELECT id, location_id, temperature_c, observed_at,
  CASE WHEN observed_at < {_T_BEFORE} THEN 0.0 ELSE precipitation END AS precipitation FROM weather_observations"""), L.evolve_add_column)
register("outbox_delivered", with_ctes(W, f"""SELECT sink, location_id, COUNT(*) AS n, attempts FROM weather_observations,
  (VALUES ('archive', 1), ('lines', 2)) s(sink, attempts) WHERE observed_at >= {_B_FROM} GROUP BY ALL"""), L.outbox_delivered)

register("incremental_merge", with_ctes(["stg_weather"], "SELECT * FROM tgt UNION ALL SELECT * FROM new_rows",
    [("tgt", f"SELECT * FROM stg_weather WHERE observed_at < {_T_BEFORE}"),
     ("new_rows", "SELECT * FROM stg_weather WHERE observed_at > (SELECT MAX(observed_at) FROM tgt)")]),
    L.incremental_merge)
register("incremental_merge_per_key", with_ctes(["stg_weather"], "SELECT * FROM tgt UNION ALL SELECT s.* FROM stg_weather s "
    "LEFT JOIN marks m ON s.location_id = m.location_id WHERE m.hwm IS NULL OR s.observed_at > m.hwm",
    [("tgt", f"SELECT * FROM stg_weather WHERE observed_at < {_T_BEFORE}"),
     ("marks", "SELECT location_id, MAX(observed_at) AS hwm FROM tgt GROUP BY 1")]),
    lambda spark, sf: L.incremental_merge(spark, sf, "per_key_hwm"))

for _dom, _fn in (("economic", L.incremental_merge_economic), ("retail", L.incremental_merge_retail)):
    register(f"incremental_merge_{_dom}", with_ctes([f"stg_{_dom}"], f"SELECT * FROM stg_{_dom}"), _fn)
register("incremental_marts", with_ctes(["monthly_retail_macro"], "SELECT * FROM monthly_retail_macro"), L.incremental_marts)

register("last_observed", with_ctes(W, """SELECT location_id, MAX(observed_at) AS last_observed
FROM weather_observations GROUP BY 1"""), L.last_observed)

register("backfill_chunks", with_ctes(WL, f"""SELECT location_id, chunk_start,
  LEAST(chunk_start + 19, e) AS chunk_end FROM (
  SELECT location_id, e, CAST(UNNEST(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 20 DAY))
         AS DATE) AS chunk_start
  FROM (SELECT l.id AS location_id,
               COALESCE(CAST(lo.last_observed AS DATE) + 1, DATE '1950-01-01') AS s,
               CAST(TIMESTAMP '{L.BACKFILL_AS_OF}' AS DATE) - 1 AS e
        FROM locations l LEFT JOIN (SELECT location_id, MAX(observed_at) AS last_observed
                                    FROM weather_observations GROUP BY 1) lo ON l.id = lo.location_id) p
  WHERE s <= e) c"""), L.backfill_chunks)

register("new_locations", with_ctes(["locations"], """SELECT CAST((SELECT COALESCE(MAX(id), 0) FROM known)
  + ROW_NUMBER() OVER (ORDER BY latitude, longitude) AS BIGINT) AS id, n.name, n.country, n.region, n.latitude,
  n.longitude FROM (
  SELECT c.* FROM locations c WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.latitude = c.latitude
  AND k.longitude = c.longitude)) n""",
    [("known", "SELECT * FROM locations WHERE country <> 'MIDDLE EAST'")]), L.new_locations)

# ------------------------------------------------------------------ landed payloads

register("parse_economic", with_ctes(["economic_observations"], PR.economic_sql()), PR.parse_economic)
register("parse_retail", with_ctes(["retail_observations"], PR.retail_sql()), PR.parse_retail)
register("parse_forecast", with_ctes(W, PR.weather_sql(archive=False), [("x", PR.X_SQL)]), PR.parse_forecast)
register("parse_archive", with_ctes(W, PR.weather_sql(archive=True), [("x", PR.X_SQL)]), PR.parse_archive)

# ------------------------------------------------------------------ streams (events)


register("events_daily_stream", f"""
WITH e AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start, event_type, value FROM events),
wm AS (SELECT MAX(ts) - INTERVAL 1 HOUR AS w FROM events)
SELECT day_start, event_type, COUNT(*) AS n, {exact_avg('value')} AS avg_value, {exact_sum('value')} AS sum_value,
  day_start + INTERVAL 1 DAY <= (SELECT w FROM wm) AS closed FROM e GROUP BY 1, 2""", ST.events_daily_stream)

register("events_dedupe_stream", """SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM events) t WHERE rn = 1""",
         ST.events_dedupe_stream)

register("events_redelivered_stream", f"""SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM (
    SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % {ST.REDELIVERED} = 0) d) t WHERE rn = 1""",
         ST.events_redelivered_stream)

register("events_late_rows", f"""
WITH wm AS (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL 1 HOUR AS w FROM events WHERE event_id % {ST.SECOND} <> 0),
e AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start, event_type, event_id % {ST.SECOND} = 0 AS second FROM events),
l AS (SELECT *, second AND day_start + INTERVAL 1 DAY <= (SELECT w FROM wm) AS late FROM e)
SELECT day_start, event_type, COUNT(CASE WHEN NOT late THEN 1 END) AS n_taken, COUNT(CASE WHEN late THEN 1 END) AS n_late
FROM l GROUP BY 1, 2""", ST.events_late_rows)

# ------------------------------------------------------------------ forecasting


def _unpivot(src: str, cols: str, metrics) -> str:
    return " UNION ALL ".join(f"SELECT {cols}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {src}"
                              for m in metrics)


_SERIES_CTES = [
    ("fw", "SELECT 'weather' AS domain, location_name, year_month, metric, value FROM ("
           + _unpivot("monthly_macro_weather", "location_name, year_month", DOMAIN_METRICS["weather"])
           + ") u WHERE year_month IS NOT NULL AND value IS NOT NULL AND location_name IS NOT NULL"),
    ("fe", "SELECT DISTINCT 'economic' AS domain, CAST(NULL AS VARCHAR) AS location_name, year_month, metric, value FROM ("
           + _unpivot("monthly_retail_macro", "year_month", DOMAIN_METRICS["economic"])
           + ") u WHERE year_month IS NOT NULL AND value IS NOT NULL"),
    ("fr", "SELECT DISTINCT 'retail' AS domain, CAST(NULL AS VARCHAR) AS location_name, year_month, metric, value FROM ("
           + _unpivot("monthly_retail_macro", "year_month", DOMAIN_METRICS["retail"])
           + ") u WHERE year_month IS NOT NULL AND value IS NOT NULL"),
    ("fseries", "SELECT domain || ':' || metric || ':' || COALESCE(location_name, 'national') AS series_key, domain, "
                "metric, location_name, CAST(year_month || '-01' AS DATE) AS month, value "
                "FROM (SELECT * FROM fw UNION ALL SELECT * FROM fe UNION ALL SELECT * FROM fr) a"),
    ("fsplit", f"""SELECT series_key, domain, metric, location_name, month, value,
        CASE WHEN n <= {FCQ.TEST_MONTHS} THEN 'too_short' WHEN rk <= {FCQ.TEST_MONTHS} THEN 'test' ELSE 'train' END
        AS split FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY month DESC) AS rk,
               COUNT(*) OVER (PARTITION BY series_key) AS n FROM fseries) x"""),
]
_MARTS = ["monthly_macro_weather", "monthly_retail_macro"]

register("forecast_series", with_ctes(_MARTS, "SELECT * FROM fseries", _SERIES_CTES[:4]), FCQ.series)
register("train_test_split", with_ctes(_MARTS, "SELECT * FROM fsplit", _SERIES_CTES), FCQ.train_test)
register("series_profile", with_ctes(_MARTS, """SELECT series_key, COUNT(*) AS n, COUNT(DISTINCT month) AS n_months,
  MIN(month) AS first_month, MAX(month) AS last_month,
  COUNT(*) = COUNT(DISTINCT month) AND COUNT(*) = CAST(datediff('month', MIN(month), MAX(month)) AS INTEGER) + 1
  AS is_regular FROM fseries GROUP BY series_key""", _SERIES_CTES[:4]), FCQ.profile)

_GAPPY = [("uneven", f"""SELECT series_key, month FROM fseries
    WHERE NOT (month(month) = {FCQ.LOST_MONTH} AND year(month) % 2 = 0 AND length(series_key) % 2 = 0)
  UNION ALL SELECT series_key, month FROM fseries WHERE month(month) = {FCQ.TWICE_MONTH} AND length(series_key) % 3 = 0"""),
  ("seen", "SELECT series_key, month, COUNT(*) AS n FROM uneven GROUP BY ALL"),
  ("spine", """SELECT series_key, unnest(generate_series(MIN(month)::TIMESTAMP, MAX(month)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month
    FROM seen GROUP BY series_key"""),
  ("faults", """SELECT p.series_key, p.month, COALESCE(s.n, 0) AS n, CASE WHEN s.n IS NULL THEN 'gap' ELSE 'duplicate' END AS reason
    FROM spine p LEFT JOIN seen s ON p.series_key = s.series_key AND p.month = s.month WHERE COALESCE(s.n, 0) <> 1""")]
register("series_faults", with_ctes(_MARTS, "SELECT * FROM faults", _SERIES_CTES[:4] + _GAPPY), FCQ.faults)
register("regular_series", with_ctes(_MARTS, """SELECT series_key, month FROM uneven
WHERE series_key NOT IN (SELECT series_key FROM faults)""", _SERIES_CTES[:4] + _GAPPY), FCQ.regular)

_ERR = "actual - predicted"
register("eval_metrics_naive", with_ctes(_MARTS, f"""SELECT series_key,
  {round_half_up(f"sqrt({exact_avg(f'({_ERR}) * ({_ERR})')})", 4)} AS rmse,
  {round_half_up(exact_avg(f'abs({_ERR})'), 4)} AS mae,
  {round_half_up(exact_avg(f'CASE WHEN actual <> 0 THEN abs({_ERR}) / abs(actual) END') + ' * 100', 4)} AS mape,
  COUNT(*) AS n, COUNT(*) AS n_scored, 'ok' AS status
FROM pairs GROUP BY series_key""", _SERIES_CTES + [
    ("pairs", """SELECT series_key, value AS actual, predicted FROM (
       SELECT *, LAG(value, 12) OVER (PARTITION BY series_key ORDER BY month) AS predicted FROM fsplit) x
     WHERE split = 'test' AND predicted IS NOT NULL""")]), FCQ.naive_metrics)

register("subzero_calendar_days", with_ctes(["stg_weather"], """SELECT location_id,
  strftime(observation_date, '%Y-%m') AS year_month, COUNT(CASE WHEN t < 0 THEN 1 END) AS subzero_calendar_days
FROM (SELECT location_id, observation_date, AVG(temperature_c) AS t FROM stg_weather GROUP BY 1, 2) d
GROUP BY 1, 2"""), lambda spark, sf: MD.subzero_calendar_days(Models(spark, sf).stg_weather()))
