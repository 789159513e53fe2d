"""DuckDB oracle SQL for the registered queries.

Only the driver's base tables exist in the oracle database, so each query starts
with the adapter views and the models it needs as common table expressions. The
expressions mirror the Spark side exactly (decimal sums where order matters,
decimal rounding, explicit NULL ordering, explicit result types).
"""

from __future__ import annotations

from tempora.functions.constants import ECONOMIC_PIVOT, RETAIL_PIVOT
from tempora.plans import AS_OF
from tempora.sources.fixtures import SQL_VIEWS

AS_OF_TS = f"TIMESTAMP '{AS_OF}'"
YEAR_START = f"TIMESTAMP '{AS_OF[:4]}-01-01 00:00:00'"


def exact_avg(x: str) -> str:
    return (f"CASE WHEN COUNT({x}) = 0 THEN NULL ELSE "
            f"CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE) END")


def exact_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS DOUBLE)"


def round_half_up(x: str, d: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def sdiv(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"


def desc_order(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def streak_ctes(source: str, value: str, cond: str, day_expr: str = "observation_date"):
    """(name, sql) CTEs for the longest run of days with AVG(value) <cond>; the last, `best`,
    holds (location_id, best)."""
    return [
        ("_daily", f"SELECT location_id, {day_expr} AS observation_date, AVG({value}) AS v "
                   f"FROM {source} GROUP BY 1, 2 HAVING AVG({value}) {cond}"),
        ("_isl", "SELECT location_id, observation_date - CAST(ROW_NUMBER() OVER (PARTITION BY location_id "
                 "ORDER BY observation_date) AS INTEGER) AS grp FROM _daily"),
        ("_runs", "SELECT location_id, grp, COUNT(*) AS streak_length FROM _isl GROUP BY 1, 2"),
        ("best", "SELECT location_id, MAX(streak_length) AS best FROM _runs GROUP BY 1"),
    ]


def ctes_text(pairs) -> str:
    return ",\n".join(f"{n} AS ({t})" for n, t in pairs)


MODEL_SQL = {
    "stg_weather": f"""
SELECT location_id, observed_at, CAST(observed_at AS DATE) AS observation_date, temperature_c,
       COALESCE(precipitation, CAST(0.0 AS DOUBLE)) AS precipitation_mm
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY location_id, observed_at
        ORDER BY {desc_order(['created_at', 'temperature_c', 'precipitation', 'id'])}) AS rn
      FROM weather_observations
      WHERE observed_at <= {AS_OF_TS} + INTERVAL 1 DAY) t
WHERE rn = 1""",
    "stg_economic": """
SELECT series_id, series_name, value, observed_at, CAST(observed_at AS DATE) AS observation_date,
       strftime(observed_at, '%Y-%m') AS year_month
FROM economic_observations""",
    "stg_retail": f"""
SELECT md5(naics_code || strftime(observed_at, '%Y-%m-%d %H:%M:%S')) AS observation_id,
       naics_code, category_name, CAST(value AS DOUBLE) AS sales_millions,
       CAST(observed_at AS DATE) AS observed_date,
       CAST(EXTRACT(year FROM observed_at) AS INTEGER) AS observed_year,
       CAST(EXTRACT(month FROM observed_at) AS INTEGER) AS observed_month
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY naics_code, observed_at
        ORDER BY {desc_order(['created_at', 'value', 'category_name'])}) AS rn
      FROM retail_observations) t
WHERE rn = 1""",
    "stg_locations": "SELECT id, name, country, region, latitude, longitude FROM locations",
    "monthly_weather": f"""
SELECT location_id, strftime(observed_at, '%Y-%m') AS year_month,
       {round_half_up(exact_avg('temperature_c'))} AS avg_monthly_temp_c,
       {round_half_up(exact_sum('precipitation_mm'))} AS total_monthly_precipitation_mm,
       CAST(SUM(CASE WHEN temperature_c < 0 THEN 1 ELSE 0 END) AS BIGINT) AS subzero_days
FROM stg_weather GROUP BY 1, 2""",
    "economic_pivot": "SELECT year_month, " + ", ".join(
        f"MAX(CASE WHEN series_id = '{k}' THEN value END) AS {v}" for k, v in ECONOMIC_PIVOT.items())
    + " FROM stg_economic GROUP BY year_month",
    "retail_pivot": """
SELECT *, """ + sdiv("total_retail_sales_millions - LAG(total_retail_sales_millions, 12) OVER w",
                     "LAG(total_retail_sales_millions, 12) OVER w") + """ * 100 AS total_retail_sales_yoy_growth_pct
FROM (SELECT observed_year, observed_month, """ + ", ".join(
        f"SUM(CASE WHEN naics_code = '{k}' THEN sales_millions ELSE 0 END) AS {v}" for k, v in RETAIL_PIVOT.items())
    + """ FROM stg_retail GROUP BY 1, 2) p
WINDOW w AS (ORDER BY observed_year, observed_month)""",
    "subzero_streaks": "WITH " + ctes_text(streak_ctes("stg_weather", "temperature_c", "< 0")) + """
SELECT b.location_id, l.name, CAST(COALESCE(b.best, 0) AS BIGINT) AS longest_subzero_streak
FROM best b LEFT JOIN stg_locations l ON l.id = b.location_id""",
    "monthly_macro_weather": """
SELECT w.location_id, l.name AS location_name, w.year_month, w.avg_monthly_temp_c,
       w.total_monthly_precipitation_mm, w.subzero_days, m.cpi, m.unemployment_rate, m.gdp
FROM monthly_weather w
LEFT JOIN economic_pivot m ON w.year_month = m.year_month
LEFT JOIN stg_locations l ON w.location_id = l.id""",
    "monthly_retail_macro": """
SELECT w.*, r.total_retail_sales_millions, r.total_retail_sales_yoy_growth_pct, r.grocery_sales_millions,
       r.ecommerce_sales_millions, r.auto_sales_millions, r.clothing_sales_millions
FROM monthly_macro_weather w
LEFT JOIN retail_pivot r ON w.year_month = printf('%d-%02d', r.observed_year, r.observed_month)""",
}

# model -> models it reads (adapter views are resolved the same way)
DEPS = {
    "stg_weather": ["weather_observations"],
    "stg_economic": ["economic_observations"],
    "stg_retail": ["retail_observations"],
    "stg_locations": ["locations"],
    "monthly_weather": ["stg_weather"],
    "economic_pivot": ["stg_economic"],
    "retail_pivot": ["stg_retail"],
    "subzero_streaks": ["stg_weather", "stg_locations"],
    "monthly_macro_weather": ["monthly_weather", "economic_pivot", "stg_locations"],
    "monthly_retail_macro": ["monthly_macro_weather", "retail_pivot"],
}


def with_ctes(names, body: str, extra=()) -> str:
    """``WITH`` clause holding ``names`` and everything they read, in dependency order,
    then the query-local CTEs ``extra`` as (name, sql) pairs, then ``body``."""
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        text = SQL_VIEWS.get(n) or MODEL_SQL[n]
        parts.append(f"{n} AS ({text}\n)")
    parts += [f"{n} AS ({text}\n)" for n, text in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


def model(name: str) -> str:
    return with_ctes([name], f"SELECT * FROM {name}")
