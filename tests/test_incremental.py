"""Incremental model runs equal full runs, and touch the months that changed only."""

import os
from datetime import datetime

import pytest

from tempora.plans import incremental as I
from tempora.plans import jobs as J
from tempora.sinks import writers as W

LOCS = "id long, name string, country string, region string, latitude double, longitude double"
WEATHER = "id long, location_id long, temperature_c double, precipitation double, observed_at timestamp_ntz, created_at timestamp_ntz"
SERIES = "series_id string, series_name string, value double, observed_at timestamp_ntz, created_at timestamp_ntz"
SALES = "naics_code string, category_name string, value double, observed_at timestamp_ntz, created_at timestamp_ntz"


class World:
    """Raw tables in a folder, and both kinds of runs over them."""

    def __init__(self, spark, root):
        self.spark, self.root, self.ledger = spark, root, I.Ledger(spark, f"{root}/ledger")
        self.locs = spark.createDataFrame([(1, "A", "X", None, 1.0, 2.0), (2, "B", "X", None, 3.0, 4.0)], LOCS)
        self.raw = {n: f"{root}/raw/{n}" for n in ("weather_observations", "economic_observations", "retail_observations")}

    def add(self, name, schema, rows):
        df = self.spark.createDataFrame(rows, schema)
        self.ledger.changed({name: W.touched_months(df)})
        W.write_table(df, self.raw[name], mode="append")

    def run(self, as_of):
        return I.run(self.spark, {**self.raw, "locations": self.locs}, f"{self.root}/models", self.ledger, as_of)

    def model(self, name):
        df = self.spark.read.parquet(f"{self.root}/models/{name}")
        return df.drop(W.PART_COL)

    def same_as_full(self, as_of):
        sources = {n: self.spark.read.parquet(p).drop(W.PART_COL) for n, p in self.raw.items()} | {"locations": self.locs}
        out = f"{self.root}/full-{as_of[:10]}-{len(os.listdir(self.root))}"
        J.run_models(self.spark, sources, out, as_of, gate=False)
        for name in ("stg_weather_observations", "stg_economic_observations", "stg_retail_observations",
                     "fct_location_climate_summary", "fct_monthly_macro_weather", "fct_monthly_retail_macro"):
            full = self.spark.read.parquet(f"{out}/{name}")
            mine = self.model(name).select(*full.columns)
            assert sorted(map(str, mine.collect())) == sorted(map(str, full.collect())), name


@pytest.fixture()
def world(spark, tmp_dir):
    w = World(spark, tmp_dir)
    created = datetime(2024, 1, 1)
    w.add("weather_observations", WEATHER, [(m * 100 + d, 1 + d % 2, float(d - m), 0.5 * d, datetime(2022 + m // 12, m % 12 + 1, d), created)
                                            for m in range(30) for d in (1, 2, 9)])
    w.add("economic_observations", SERIES, [("CPIAUCSL", "c", 300.0 + m, datetime(2022 + m // 12, m % 12 + 1, 1), created) for m in range(24)])
    w.add("retail_observations", SALES, [("445", "g", 10.0 * m, datetime(2022 + m // 12, m % 12 + 1, 1), created) for m in range(24) if m != 5])
    return w


def test_runs_touch_changed_months_only_and_equal_full_runs(world):
    done = world.run("2024-01-10 00:00:00")
    assert len(done["stg_weather_observations"]) == 30 and world.run("2024-01-10 00:00:00") == {}
    world.same_as_full("2024-01-10 00:00:00")
    before = {f: os.stat(f).st_mtime_ns for f in _files(f"{world.root}/models/stg_weather_observations")}

    # a late reading of an old month; the clock moves on over forecast rows of two months
    world.add("weather_observations", WEATHER, [(9, 1, -40.0, None, datetime(2022, 3, 5), datetime(2024, 2, 9))])
    done = world.run("2024-02-09 00:00:00")
    assert done["stg_weather_observations"] == {"2022-03", "2024-01", "2024-02"} == done["fct_monthly_macro_weather"]
    assert "stg_economic_observations" not in done and "int_retail_pivoted" not in done
    after = {f: os.stat(f).st_mtime_ns for f in _files(f"{world.root}/models/stg_weather_observations")}
    kept = {f for f in before if not any(m in f for m in ("2022-03", "2024-01", "2024-02"))}
    assert kept and all(after.get(f) == before[f] for f in kept)
    world.same_as_full("2024-02-09 00:00:00")

    # a month of sales that was missing shifts the comparison of the twelve rows after it
    world.add("retail_observations", SALES, [("445", "g", 7.0, datetime(2022, 6, 1), datetime(2024, 2, 9))])
    done = world.run("2024-02-09 00:00:00")
    assert done["stg_retail_observations"] == {"2022-06"} and len(done["int_retail_pivoted"]) == 13
    assert "fct_location_climate_summary" not in done
    world.same_as_full("2024-02-09 00:00:00")
    with pytest.raises(ValueError):
        world.run("2024-01-01 00:00:00")


def test_an_ended_run_is_taken_up_again(world, monkeypatch):
    world.run("2024-01-10 00:00:00")
    world.add("economic_observations", SERIES, [("UNRATE", "u", 4.0, datetime(2023, 5, 1), datetime(2024, 1, 9))])
    plain = I._build

    def fails(spark, model, tables, partitioned, dirty, path, as_of):
        if path.endswith("fct_monthly_macro_weather"):
            raise RuntimeError("executor lost")
        return plain(spark, model, tables, partitioned, dirty, path, as_of)

    monkeypatch.setattr(I, "_build", fails)
    with pytest.raises(RuntimeError):
        world.run("2024-01-10 00:00:00")
    monkeypatch.setattr(I, "_build", plain)
    done = world.run("2024-01-10 00:00:00")
    assert done == {"fct_monthly_macro_weather": {"2023-05"}, "fct_monthly_retail_macro": {"2023-05"}}
    world.same_as_full("2024-01-10 00:00:00")


def test_second_day_reads_touched_months_only(spark, world):
    """The plan of a staging model scans the partitions of its months, no others."""
    df = I._read(spark, world.raw["weather_observations"], {"2022-03"})
    assert len(df.inputFiles()) > 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2022-03" in plan
    assert {r[0] for r in df.selectExpr("date_format(observed_at, 'yyyy-MM')").distinct().collect()} == {"2022-03"}


def _files(root):
    return [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
