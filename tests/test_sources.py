"""Landed payload and CSV readers on literal files."""

import json
import os
from datetime import datetime

from tempora.sources import landed as S


def _dump(d, name, obj):
    with open(os.path.join(d, name), "w") as f:
        json.dump(obj, f)


HOURLY = {"time": ["2026-08-01T00:00", "2026-08-01T01:00"], "temperature_2m": [20.1, 19.5],
          "windspeed_10m": [3.0, 2.0], "pressure_msl": [1012.0, 1011.0], "relative_humidity_2m": [50.0, 55.0]}


def test_forecast_payload_zips_arrays_and_fills_rain(spark, tmp_dir):
    _dump(tmp_dir, "a.json", {"location_id": 1, "hourly": {**HOURLY, "precipitation": [1.2, 0.0]}})
    _dump(tmp_dir, "b.json", {"location_id": 2, "hourly": {**HOURLY, "precipitation": [None]}})
    _dump(tmp_dir, "c.json", {"location_id": 3, "hourly": {**HOURLY, "temperature_2m": [1.0]}})
    rows = S.read_weather_forecast_json(spark, f"{tmp_dir}/*.json").orderBy("location_id", "observed_at").collect()
    assert [(r.location_id, r.precipitation) for r in rows] == [(1, 1.2), (1, 0.0), (2, 0.0), (2, 0.0)]
    assert rows[0].observed_at == datetime(2026, 8, 1, 0, 0) and rows[0].temperature_c == 20.1
    assert [r.location_id for r in S.short_hourly_payloads(spark, f"{tmp_dir}/*.json").collect()] == [3]


def test_archive_payload_pads_nulls(spark, tmp_dir):
    _dump(tmp_dir, "a.json", {"location_id": 3, "hourly": {**HOURLY, "temperature_2m": [1.0]}})
    _dump(tmp_dir, "b.json", {"location_id": 4})
    rows = S.read_weather_archive_json(spark, f"{tmp_dir}/*.json").orderBy("observed_at").collect()
    assert [(r.temperature_c, r.precipitation) for r in rows] == [(1.0, None), (None, None)]


def test_economic_payload_skips_sentinel_and_window(spark, tmp_dir):
    obs = [{"date": "2019-12-01", "value": "1.0"}, {"date": "2024-01-01", "value": "310.2"},
           {"date": "2024-02-01", "value": "."}]
    _dump(tmp_dir, "e1.json", {"series_id": "CPIAUCSL", "observations": obs})
    _dump(tmp_dir, "e2.json", {"series_id": "UNRATE", "observations": []})
    rows = S.read_economic_json(spark, f"{tmp_dir}/*.json", start="2020-01-01").collect()
    assert [(r.series_id, r.value) for r in rows] == [("CPIAUCSL", 310.2)]
    assert [r.series_id for r in S.empty_economic_payloads(spark, f"{tmp_dir}/*.json").collect()] == ["UNRATE"]


def test_census_payload(spark, tmp_dir):
    _dump(tmp_dir, "r.json", [["cell_value", "data_type_code", "category_code", "time", "geo", "extra"],
                              ["12345", "SM", "445", "2024-01", "us", ""], ["1", "SM", "445", "2024-13", "us", ""],
                              [None, "SM", "441", "2024-02", "us", ""], ["abc", "SM", "448", "2024-02", "us", ""],
                              ["5", "MPCSM", "445", "2024-01", "us", ""], ["7", "SM", "999", "2024-01", "us", ""]])
    rows = sorted((r.naics_code, r.value, r.observed_at) for r in S.read_retail_json(spark, f"{tmp_dir}/r.json")
                  .collect())
    assert rows == [("441", 0.0, datetime(2024, 2, 1)), ("445", 12345.0, datetime(2024, 1, 1))]


def test_csv_readers_and_guard(spark, tmp_dir):
    with open(f"{tmp_dir}/loc.csv", "w") as f:
        f.write("id,name,country,region,latitude,longitude\n1,Alpha,US,CA,33.5,-117.5\n2,Beta,UK,,51.5,-0.1\n")
    with open(f"{tmp_dir}/series.csv", "w") as f:
        f.write("CPIAUCSL,Inflation (CPI)\nGDP,GDP\n")
    locs = S.read_locations_csv(spark, f"{tmp_dir}/loc.csv")
    assert locs.count() == 2 and dict(locs.dtypes)["latitude"] == "double"
    assert S.read_series_csv(spark, f"{tmp_dir}/series.csv").count() == 2
    empty = spark.createDataFrame([], locs.schema)
    assert S.load_if_empty(empty, locs).count() == 2
    assert S.load_if_empty(locs.limit(1), locs).count() == 1
    pts = spark.createDataFrame([(33.5, -117.5), (0.0, 0.0)], "latitude double, longitude double")
    assert [r.name for r in S.locate(locs, pts).collect()] == ["Alpha"]


def test_paging_seed_and_validation(spark):
    import pytest
    df = spark.range(10).withColumnRenamed("id", "k")
    assert [r.k for r in S.keyset_page(df, "k", 3, 2).collect()] == [4, 5]
    assert S.seed_locations(spark, [(1, "A", "US", None, 1.0, 2.0)]).count() == 1
    S.validate_coordinates(45.0, -120.0)
    with pytest.raises(ValueError):
        S.validate_coordinates(91.0, 0.0)


def test_every_forecast_payload_is_read_or_quarantined(spark, tmp_dir):
    import json
    from tempora.sources import landed as L
    good = {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0], "windspeed_10m": [1.0], "pressure_msl": [1.0],
            "relative_humidity_2m": [1.0]}
    payloads = {"good": {"location_id": 1, "hourly": good}, "none": {"location_id": 2},
                "time": {"location_id": 3, "hourly": {**good, "time": ["soon"]}}}
    for name, payload in payloads.items():
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            json.dump(payload, f)
    with open(f"{tmp_dir}/cut.json", "w") as f:
        f.write('{"location_id": 4, "hourly": {"time": ["2024')
    assert [r.location_id for r in L.read_weather_forecast_json(spark, f"{tmp_dir}/*.json").collect()] == [1]
    assert L.short_hourly_payloads(spark, f"{tmp_dir}/*.json").count() == 3


def test_peeks(spark):
    df = spark.range(20).selectExpr("id", "timestamp_ntz '2000-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id)) AS observed_at")
    assert S.peek(df).count() == 5 and S.peek(df.limit(0)).count() == 0
    assert [r.id for r in S.peek_latest(df, n=2).collect()] == [19, 18]
