"""Jobs: model runner over the driver tables, daily ingest from landed payloads, backfill."""

import json
import os
from datetime import date

from pyspark.sql import functions as F

from tempora.plans import jobs as J
from tempora.sinks import writers as W

SF = "/root/testdata/sf0.001"


def test_model_order_respects_dependencies():
    order = J.model_order()
    for name, (deps, _fn, _m) in J.MODEL_GRAPH.items():
        for d in deps:
            if d in J.MODEL_GRAPH:
                assert order.index(d) < order.index(name)


def test_run_models_on_driver_tables(spark, tmp_dir):
    import pytest
    with pytest.raises(RuntimeError, match="dq_no_future_economic"):
        J.run_models(spark, J.driver_sources(spark, SF), f"{tmp_dir}/gated")
    report = J.run_models(spark, J.driver_sources(spark, SF), f"{tmp_dir}/marts", gate=False)
    status = {r.check_name: r.status for r in report.collect()}
    assert status["dq_out_of_bounds"] == "PASS" and status["dq_no_future_economic"] == "FAIL" and len(status) == 10
    mart = spark.read.parquet(f"{tmp_dir}/marts/fct_monthly_retail_macro")
    assert mart.count() > 0 and "total_retail_sales_yoy_growth_pct" in mart.columns


def _dump(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f)


def test_daily_run_from_landed_payloads(spark, tmp_dir):
    hours = [f"2024-01-0{d}T{h:02d}:00" for d in (1, 2) for h in (0, 12)]
    n = len(hours)
    _dump(f"{tmp_dir}/land/weather/a.json", {"location_id": 1, "hourly": {
        "time": hours, "temperature_2m": [-1.0, -2.0, 3.0, 4.0], "windspeed_10m": [1.0] * n,
        "pressure_msl": [1000.0] * n, "relative_humidity_2m": [50.0] * n, "precipitation": [0.0, None, 1.0, 0.0]}})
    _dump(f"{tmp_dir}/land/weather/bad.json", {"location_id": 2, "hourly": {"time": hours, "temperature_2m": [1.0]}})
    _dump(f"{tmp_dir}/land/economic/cpi.json", {"series_id": "CPIAUCSL", "observations": [
        {"date": "2024-01-01", "value": "310.2"}, {"date": "2024-02-01", "value": "."}]})
    _dump(f"{tmp_dir}/land/retail/r.json", [["cell_value", "data_type_code", "category_code", "time", "geo", "x"],
                                            ["100", "SM", "44W72", "2024-01", "us", ""]])
    locs = spark.createDataFrame([(1, "A", "X", None, 1.0, 2.0), (2, "B", "X", None, 3.0, 4.0)],
                                 "id long, name string, country string, region string, latitude double, "
                                 "longitude double")
    args = (spark, f"{tmp_dir}/land", f"{tmp_dir}/tables", f"{tmp_dir}/marts", "2024-01-03 00:00:00", locs)
    status = {r.check_name: r.status for r in J.run_daily(*args, gate=False).collect()}
    assert "dq_out_of_bounds" in status and (status["ingest_weather"], status["ingest_retail"]) == ("FAIL", "PASS")  # a payload is lost
    weather = spark.read.parquet(f"{tmp_dir}/tables/weather")
    assert weather.count() == 4                      # the short-array payload was quarantined
    mart = spark.read.parquet(f"{tmp_dir}/marts/fct_monthly_macro_weather").collect()
    assert [(r.location_id, r.year_month, r.cpi, r.subzero_days) for r in mart] == [(1, "2024-01", 310.2, 2)]
    # re-delivery of the same payloads is idempotent
    J.run_daily(*args, gate=False)
    assert spark.read.parquet(f"{tmp_dir}/tables/weather").count() == 4


def test_an_unreadable_table_is_never_overwritten(spark, tmp_dir):
    import pytest
    table = f"{tmp_dir}/t"
    os.makedirs(f"{table}/obs_period=2024-01")
    with open(f"{table}/obs_period=2024-01/part-0.parquet", "w") as f:
        f.write("damaged")
    rows = spark.createDataFrame([("A", 1.0)], "series_id string, value double").selectExpr(
        "series_id", "value", "timestamp_ntz'2024-01-01 00:00:00' AS observed_at", "timestamp_ntz'2024-01-02 00:00:00' AS created_at")
    with pytest.raises(Exception):
        J._merge_or_create(spark, table, rows, ["series_id", "observed_at"], "upsert", ["value"], "series_id")
    assert open(f"{table}/obs_period=2024-01/part-0.parquet").read() == "damaged"


def test_a_failed_domain_is_reported_and_gates_the_run(spark, tmp_dir):
    import pytest
    _dump(f"{tmp_dir}/land/economic/cpi.json", {"series_id": "CPIAUCSL", "observations": [
        {"date": "2024-01-01", "value": "310.2"}, {"date": "2024-02-01", "value": "N/A"}, {"date": "soon", "value": "1"}]})
    out = J.ingest_economic(spark, f"{tmp_dir}/land/economic/*.json", f"{tmp_dir}/tables/economic", "2024-01-03 00:00:00")
    assert spark.read.parquet(f"{tmp_dir}/tables/economic").count() == 1
    assert sorted(r.reason for r in out["rejected"].collect()) == ["time", "value"]
    with pytest.raises(Exception):  # no weather and no retail landed, so there is nothing to build from
        J.run_daily(spark, f"{tmp_dir}/land", f"{tmp_dir}/tables", f"{tmp_dir}/marts", "2024-01-03 00:00:00", None)


def test_backfill_plan_and_first_write_wins(spark, tmp_dir):
    locs = spark.createDataFrame([(1, "A")], "id long, name string")
    plan = J.backfill_plan(spark, locs, f"{tmp_dir}/w", "1950-02-15 00:00:00").orderBy("chunk_start").collect()
    assert plan[0].chunk_start == date(1950, 1, 1) and plan[0].chunk_end == date(1950, 1, 20)
    assert plan[-1].chunk_end == date(1950, 2, 14)
    hourly = {"time": ["1950-01-01T00:00"], "temperature_2m": [1.0], "windspeed_10m": [1.0], "pressure_msl": [1.0],
              "relative_humidity_2m": [1.0]}
    _dump(f"{tmp_dir}/arch/a.json", {"location_id": 1, "hourly": hourly})
    J.backfill_load(spark, f"{tmp_dir}/arch/*.json", f"{tmp_dir}/w", "1950-02-15 00:00:00")
    _dump(f"{tmp_dir}/arch2/a.json", {"location_id": 1, "hourly": {**hourly, "temperature_2m": [9.0]}})
    J.backfill_load(spark, f"{tmp_dir}/arch2/*.json", f"{tmp_dir}/w", "1950-02-16 00:00:00")
    assert [r.temperature_c for r in spark.read.parquet(f"{tmp_dir}/w").collect()] == [1.0]
    assert J.backfill_plan(spark, locs, f"{tmp_dir}/w", "1950-01-03 00:00:00").first().chunk_start == date(1950, 1, 2)


def test_what_an_ingest_leaves_out_is_in_a_table_and_in_the_report(spark, tmp_dir):
    import pytest
    hourly = {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0], "windspeed_10m": [1.0], "pressure_msl": [1000.0],
              "relative_humidity_2m": [50.0]}
    header = ["cell_value", "data_type_code", "category_code", "time", "geo", "x"]
    land = f"{tmp_dir}/land"
    _dump(f"{land}/weather/a.json", {"location_id": 1, "hourly": hourly})
    _dump(f"{land}/weather/bad.json", {"location_id": 2, "hourly": {**hourly, "temperature_2m": []}})
    _dump(f"{land}/economic/cpi.json", {"series_id": "CPIAUCSL", "observations": [
        {"date": "2024-01-01", "value": "310.2"}, {"date": "2024-02-01", "value": "N/A"}, {"date": "2024-03-01", "value": "."}]})
    _dump(f"{land}/economic/none.json", {"series_id": "GDP", "observations": []})
    _dump(f"{land}/retail/r.json", [header, ["100", "SM", "44W72", "2024-01", "us", ""], ["(S)", "SM", "44W72", "2024-02", "us", ""],
                                    ["7", "SM", "44W72", "soon", "us", ""], ["x", "MM", "44W72", "soon", "us", ""]])
    _dump(f"{land}/retail/error.json", {"error": "no data"})
    locs = spark.createDataFrame([(1, "A", "X", None, 1.0, 2.0)], "id long, name string, country string, region string, "
                                                                  "latitude double, longitude double")
    args = (spark, land, f"{tmp_dir}/tables", f"{tmp_dir}/marts", "2024-03-03 00:00:00", locs)
    report = {r.check_name: (r.status, r.failures) for r in J.run_daily(*args, gate=False).collect()}
    assert [report[f"ingest_{k}"] for k in ("weather", "economic", "retail")] == [("FAIL", 1), ("FAIL", 2), ("FAIL", 3)]
    with pytest.raises(RuntimeError, match="rows rejected"):
        J.run_daily(*args)
    _dump(f"{tmp_dir}/arch/a.json", {"location_id": 1, "hourly": {**hourly, "time": ["1950-01-01T00:00", "soon", None]}})
    _dump(f"{tmp_dir}/arch/b.json", {"location_id": 3, "reason": "rate limit"})
    out = J.backfill_load(spark, f"{tmp_dir}/arch/*.json", f"{tmp_dir}/tables/weather_archive", "2024-03-03 00:00:00")
    assert out["counts"] == {"payload": 1, "row": 2}
    rejects = spark.read.parquet(f"{tmp_dir}/tables/rejects").collect()  # the second run has replaced its own rows
    assert sorted((r.domain, r.kind, r.reason, r.file.rpartition("/")[2]) for r in rejects) == [
        ("archive", "payload", "empty", "b.json"), ("archive", "row", "time", "a.json"), ("archive", "row", "time", "a.json"),
        ("economic", "payload", "empty", "none.json"), ("economic", "row", "value", "cpi.json"),
        ("retail", "payload", "empty", "error.json"), ("retail", "row", "time", "r.json"), ("retail", "row", "value", "r.json"),
        ("weather", "payload", "empty", "bad.json")]
    assert any('"N/A"' in r.record for r in rejects)


def test_payloads_get_their_key_from_where_they_were_landed(spark, tmp_dir):
    """A real payload names neither its series nor its place; rows without a key are rejected, never merged."""
    obs = {"observations": [{"date": "2024-01-01", "value": "310.2"}, {"date": "2024-02-01", "value": "311"}]}
    _dump(f"{tmp_dir}/economic/CPIAUCSL/start=2024-01-01_end=unknown/1.json", obs)
    _dump(f"{tmp_dir}/economic/loose.json", obs)
    table = f"{tmp_dir}/tables/economic"
    for day in (3, 4):
        out = J.ingest_economic(spark, f"{tmp_dir}/economic", table, f"2024-01-0{day} 00:00:00")
        assert out["counts"] == {"payload": 0, "row": 2} and {r.reason for r in out["rejected"].collect()} == {"key"}
        assert [r.series_id for r in spark.read.parquet(table).collect()] == ["CPIAUCSL"] * 2
    hours = {"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0], "windspeed_10m": [1.0], "pressure_msl": [1000.0],
                        "relative_humidity_2m": [50.0]}}
    locs = spark.createDataFrame([(7, 33.5, -117.25)], "id long, latitude double, longitude double")
    made = [("weather", "33.5,-117.25", "2024-01-01", "2024-01-31", "t", json.dumps(hours)),
            ("weather", "0.0,0.0", "2024-02-01", "2024-02-28", "t", json.dumps(hours)), ("other", "x", None, None, "t", "{")]
    W.land_raw(spark.createDataFrame(made, "source string, identifier string, window_start string, window_end string, "
                                           "fetched_at string, payload string"), f"{tmp_dir}/raw")
    january = W.read_landed(spark, f"{tmp_dir}/raw", "weather", end="2024-01-15")
    assert "PartitionFilters: [" in january._jdf.queryExecution().executedPlan().toString() and january.count() == 1
    out = J.ingest_weather(spark, W.read_landed(spark, f"{tmp_dir}/raw", "weather"), f"{tmp_dir}/tables/weather", "2024-02-03 00:00:00", locs)
    assert out["counts"] == {"payload": 0, "row": 1}
    assert [r.location_id for r in spark.read.parquet(f"{tmp_dir}/tables/weather").collect()] == [7]


def test_a_truncated_payload_fails_the_ingest(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/weather")
    with open(f"{tmp_dir}/weather/cut.json", "w") as f:
        f.write('{"location_id": 1, "hourly": {"time": ["2024-01-01T00:00", "2024-01-')
    out = J.ingest_weather(spark, f"{tmp_dir}/weather/*.json", f"{tmp_dir}/t/weather", "2024-01-03 00:00:00")
    assert out["counts"] == {"payload": 1, "row": 0} and out["months"] == []


def test_migrate_dry_run(spark, tmp_dir):
    from tempora.sources import fixtures as fx
    src = fx.economic_observations(spark, SF)
    n = J.migrate(spark, src, f"{tmp_dir}/m", "economic", dry_run=True)
    assert n == src.count() == J.migrate(spark, src, f"{tmp_dir}/m", "economic")
    assert spark.read.parquet(f"{tmp_dir}/m").filter(F.col("observed_at").contains("T")).count() == n


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Context(master)


def test_checkpoint_dir_is_read_from_session_and_never_local_on_a_cluster():
    import pytest
    from tempora.session import ensure_checkpoint_dir
    shared = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(shared) == "hdfs:///shared/ckpt" and shared.sparkContext.dir == "hdfs:///shared/ckpt"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))
    local = _Session("local[2]")
    assert ensure_checkpoint_dir(local).startswith(("/tmp", __import__("os").environ.get("TMPDIR", "/tmp")))
