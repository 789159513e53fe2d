"""Data-quality checks return exactly the failing rows."""

from datetime import date, datetime

from tempora.operators import quality as Q

AS_OF = "2024-06-01 00:00:00"


def models(spark):
    w = spark.createDataFrame([
        (1, datetime(2024, 1, 1), date(2024, 1, 1), 95.0, 0.0),
        (1, datetime(2024, 1, 2), date(2024, 1, 2), -120.0, 0.0),
        (1, datetime(2024, 1, 3), date(2024, 1, 3), 10.0, 2500.0),
        (1, datetime(2024, 1, 4), date(2024, 1, 4), 10.0, -1.0),
        (2, datetime(2024, 6, 3), date(2024, 6, 3), 10.0, 1.0),
        (2, datetime(2024, 6, 3), date(2024, 6, 3), 10.0, 1.0),
        (None, datetime(2024, 1, 5), date(2024, 1, 5), 1.0, 1.0),
    ], "location_id long, observed_at timestamp_ntz, observation_date date, temperature_c double, "
       "precipitation_mm double")
    e = spark.createDataFrame([
        ("GDP", "GDP", -1.0, datetime(2024, 1, 1), date(2024, 1, 1), "2024-01"),
        ("UNRATE", "u", -1.0, datetime(2022, 1, 1), date(2022, 1, 1), "2022-01"),
        ("CPIAUCSL", "c", 0.0, datetime(2024, 7, 1), date(2024, 7, 1), "2024-07"),
    ], "series_id string, series_name string, value double, observed_at timestamp_ntz, observation_date date, "
       "year_month string")
    r = spark.createDataFrame([("a", "445", "g", -5.0, date(2024, 1, 1), 2024, 1),
                               ("a", "445", "g", 5.0, date(2024, 2, 1), 2024, 2)],
                              "observation_id string, naics_code string, category_name string, sales_millions double, "
                              "observed_date date, observed_year int, observed_month int")
    locs = spark.createDataFrame([(1, "A", "X", None, 1.0, 2.0), (2, "B", "X", None, 1.0, 2.0)],
                                 "id long, name string, country string, region string, latitude double, "
                                 "longitude double")
    return {"stg_weather_observations": w, "stg_economic_observations": e, "stg_retail_observations": r,
            "stg_locations": locs}


def test_checks(spark):
    c = Q.all_checks(models(spark), AS_OF)
    assert sorted(r.failure_reason for r in c["dq_out_of_bounds"].collect()) == \
        ["precip_negative", "precip_too_high", "temp_too_high", "temp_too_low"]
    assert [r.series_id for r in c["dq_economic_positive"].collect()] == ["GDP"]
    assert [r.series_id for r in c["dq_no_future_economic"].collect()] == ["CPIAUCSL"]
    assert c["dq_no_future_weather"].count() == 2
    assert [r.series_id for r in c["dq_stale_economic"].collect()] == ["UNRATE"]
    assert c["dq_retail_positive"].count() == 1
    assert c["dq_unique_coordinates"].first().duplicate_count == 2
    assert c["dq_unique_weather"].count() == 1
    assert [(r.model, r.column_name, r.failures) for r in c["dq_not_null"].collect()] == \
        [("stg_weather_observations", "location_id", 1)]
    assert {(r.model, r.value) for r in c["dq_unique"].collect()} == {("stg_retail_observations", "a")}
    report = {r.check_name: r.status for r in Q.check_report(c).collect()}
    assert len(report) == 10 and set(report.values()) == {"FAIL"}


def test_one_pass_report_equals_per_check_report(spark):
    m = models(spark)
    a = {(r.check_name, r.failures, r.status) for r in Q.check_report(Q.all_checks(m, AS_OF)).collect()}
    b = {(r.check_name, r.failures, r.status) for r in Q.report_one_pass(m, AS_OF).collect()}
    assert a == b
