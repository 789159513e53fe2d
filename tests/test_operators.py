"""Literal edge cases for the core operators (FIXTURES.md section 4)."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tempora.functions.exprs import round_half_up
from tempora.operators.dedupe import dedupe_latest
from tempora.operators.pivots import pivot_values
from tempora.operators.streaks import longest_streak
from tempora.operators.windows import period_change, rolling_avg
from tempora.plans.models import retail_pivot

OBS = "location_id long, observed_at timestamp_ntz, temperature_c double, precipitation double"
LOCS = "id long, name string"


def ts(*a):
    return datetime(*a)


def test_round_half_up_on_decimal_value(spark):
    df = spark.createDataFrame([(2.345,), (-2.5,), (0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got == [2.35, -2.5, 0.13, None]
    assert df.select(round_half_up("x", 0)).collect()[1][0] == -3.0


def test_dedupe_is_deterministic_on_ties(spark):
    rows = [(1, ts(2024, 1, 1), 5.0, 1.0, ts(2024, 1, 2)), (1, ts(2024, 1, 1), 7.0, 1.0, ts(2024, 1, 2)),
            (1, ts(2024, 1, 1), 9.0, 1.0, ts(2024, 1, 1)), (2, ts(2024, 1, 1), 3.0, None, None)]
    df = spark.createDataFrame(rows, "location_id long, observed_at timestamp_ntz, t double, p double, "
                                     "created_at timestamp_ntz")
    for parts in (1, 3):
        out = dedupe_latest(df.repartition(parts), ["location_id", "observed_at"], ["created_at"]) \
            .orderBy("location_id").collect()
        assert [(r.location_id, r.t) for r in out] == [(1, 7.0), (2, 3.0)]


def test_streak_gap_year_end_and_empty_location(spark):
    days = [ts(2023, 12, 30), ts(2023, 12, 31), ts(2024, 1, 1), ts(2024, 1, 3), ts(2024, 1, 4)]
    rows = [(1, d, -5.0, 0.0) for d in days] + [(1, ts(2024, 1, 2), 3.0, 0.0), (2, ts(2024, 1, 1), 1.0, 0.0)]
    obs = spark.createDataFrame(rows, OBS)
    locs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], LOCS)
    only = {r.location_id: r.longest_streak for r in longest_streak(obs, locs, "temperature_c", "<", 0).collect()}
    assert only == {1: 3}
    every = {r.name: r.longest_streak for r in longest_streak(obs, locs, "temperature_c", "<", 0, keep_all=True)
             .collect()}
    assert every == {"A": 3, "B": 0, "C": 0}


def test_streak_uses_daily_mean(spark):
    rows = [(1, ts(2024, 1, 1, 0), -10.0, 0.0), (1, ts(2024, 1, 1, 12), 4.0, 0.0), (1, ts(2024, 1, 2), -1.0, 0.0)]
    obs = spark.createDataFrame(rows, OBS)
    locs = spark.createDataFrame([(1, "A")], LOCS)
    assert longest_streak(obs, locs, "temperature_c", "<", 0).first().longest_streak == 2


def test_rolling_rows_vs_calendar(spark):
    rows = [(1, ts(2024, 1, d), float(d), 0.0) for d in (1, 2, 10)]
    obs = spark.createDataFrame(rows, OBS)
    by_rows = {r.observation_date.day: r.rolling_avg for r in rolling_avg(obs, rows=2).collect()}
    by_cal = {r.observation_date.day: r.rolling_avg for r in rolling_avg(obs, rows=2, calendar=True).collect()}
    assert by_rows == {1: 1.0, 2: 1.5, 10: 6.0}
    assert by_cal == {1: 1.0, 2: 1.5, 10: 10.0}


def test_period_change_zero_divisor_is_null(spark):
    df = spark.createDataFrame([(1, 2000, 0.0), (1, 2001, 5.0), (2, 2000, 4.0)], "e long, y int, v double")
    out = {(r.e, r.y): r.change for r in period_change(df, "e", "y", "v", pct=True).collect()}
    assert out == {(1, 2000): None, (1, 2001): None, (2, 2000): None}
    diff = {(r.e, r.y): r.change for r in period_change(df, "e", "y", "v").collect()}
    assert diff[(1, 2001)] == 5.0


def test_pivot_missing_code_null_vs_zero(spark):
    df = spark.createDataFrame([("2024-01", "A", 1.0), ("2024-01", "B", 2.0), ("2024-02", "A", 3.0)],
                               "ym string, code string, v double")
    mx = {r.ym: r.b for r in pivot_values(df, "ym", "code", "v", {"A": "a", "B": "b"}).collect()}
    sm = {r.ym: r.b for r in pivot_values(df, "ym", "code", "v", {"A": "a", "B": "b"}, agg="sum", missing=0)
          .collect()}
    assert mx == {"2024-01": 2.0, "2024-02": None}
    assert sm == {"2024-01": 2.0, "2024-02": 0.0}


def test_retail_yoy_counts_rows_and_zero_prior(spark):
    # 13 months of the total; month 1 has total 0 -> month 13 growth NULL; a missing code is 0.
    rows = [(f"m{i}", "44W72", 0.0 if i == 1 else 100.0 + i, date(2020 + (i - 1) // 12, (i - 1) % 12 + 1, 1),
             2020 + (i - 1) // 12, (i - 1) % 12 + 1) for i in range(1, 14)]
    rows += [("x", "445", 5.0, date(2021, 1, 1), 2021, 1)]
    stg = spark.createDataFrame(rows, "observation_id string, naics_code string, sales_millions double, "
                                      "observed_date date, observed_year int, observed_month int")
    out = {(r.observed_year, r.observed_month): r for r in retail_pivot(stg).collect()}
    assert out[(2021, 1)].total_retail_sales_yoy_growth_pct is None
    assert out[(2021, 1)].grocery_sales_millions == 5.0
    assert out[(2020, 2)].grocery_sales_millions == 0.0
    assert out[(2020, 12)].total_retail_sales_yoy_growth_pct is None


def test_empty_inputs(spark):
    obs = spark.createDataFrame([], OBS)
    locs = spark.createDataFrame([(1, "A")], LOCS)
    assert rolling_avg(obs).count() == 0
    assert longest_streak(obs, locs, "temperature_c", "<", 0).count() == 0
    assert longest_streak(obs, locs, "temperature_c", "<", 0, keep_all=True).first().longest_streak == 0
    assert obs.agg(F.avg("temperature_c")).first()[0] is None


def test_future_cutoff_boundary_and_null_rain(spark):
    from tempora.operators.staging import stg_weather
    rows = [(1, 1, ts(2024, 1, 2, 0, 0, 0), 1.0, None, ts(2024, 1, 2)),
            (2, 1, ts(2024, 1, 2, 0, 0, 1), 2.0, 3.0, ts(2024, 1, 2))]
    obs = spark.createDataFrame(rows, "id long, location_id long, observed_at timestamp_ntz, temperature_c double, "
                                      "precipitation double, created_at timestamp_ntz")
    out = stg_weather(obs, "2024-01-01 00:00:00").collect()
    assert [(r.observed_at, r.precipitation_mm) for r in out] == [(ts(2024, 1, 2), 0.0)]


def test_all_null_rain_year_total_vs_top(spark):
    from tempora.operators.aggregates import period_agg, top_periods
    rows = [(1, ts(2000, 1, 1), 1.0, None), (1, ts(2000, 6, 1), 1.0, None), (1, ts(2001, 1, 1), 1.0, 4.0),
            (1, ts(2002, 1, 1), 1.0, 4.0)]
    obs = spark.createDataFrame(rows, OBS)
    locs = spark.createDataFrame([(1, "A")], LOCS)
    totals = {r.year: r.total_rain for r in period_agg(obs, locs, "year", "precipitation", "sum", fill=0,
                                                       out="total_rain").collect()}
    assert totals == {2000: 0.0, 2001: 4.0, 2002: 4.0}
    top = [(r.year, r.total_precip) for r in top_periods(obs, "year", "precipitation", "sum", n=2,
                                                         out="total_precip").collect()]
    assert top == [(2000, None), (2001, 4.0)]              # NULL first, then the tie broken by year


def test_null_measure_is_ignored_by_means(spark):
    from tempora.operators.aggregates import period_agg
    rows = [(1, ts(2000, 1, 1), None, 0.0), (1, ts(2000, 1, 2), 4.0, 0.0)]
    obs = spark.createDataFrame(rows, OBS)
    assert period_agg(obs, None, "year", "temperature_c", "avg", out="t").first().t == 4.0
