"""Forecasting properties (the source's offline checks, re-aimed at the Spark jobs)."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.functions import arima
from tempora.operators import forecast as FC


def synthetic(n=72, seed=42):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    month = t % 12 + 1
    return 450 + 0.5 * t + 10 * np.sin(2 * np.pi * month / 12) + rng.normal(0, 3, n)


def series_df(spark, keys=("retail:total_retail_sales_millions:national",), n=72):
    rows = []
    for i, k in enumerate(keys):
        y = synthetic(n, 42 + i)
        for j in range(n):
            rows.append((k, "retail", "total_retail_sales_millions", None, date(2018 + j // 12, j % 12 + 1, 1),
                         float(y[j])))
    return spark.createDataFrame(rows, "series_key string, domain string, metric string, location_name string, "
                                       "month date, value double")


SMALL_GRID = [(1, 1, 1, 0, 0, 0, 12), (0, 1, 1, 0, 1, 1, 12), (1, 0, 0, 1, 0, 0, 12)]


def test_grid_is_144_in_product_order():
    g = FC.order_grid()
    assert len(g) == 144 and g[0] == (0, 0, 0, 0, 0, 0, 12) and g[1] == (0, 0, 0, 0, 0, 1, 12)
    assert g[-1] == (2, 1, 2, 1, 1, 1, 12)


def test_split_lengths_and_order(spark):
    split = FC.train_test_split(series_df(spark), 12)
    train = [r.month for r in split.filter("split = 'train'").orderBy("month").collect()]
    test = [r.month for r in split.filter("split = 'test'").orderBy("month").collect()]
    assert len(train) == 60 and len(test) == 12 and max(train) < min(test)
    short = series_df(spark, n=3)
    assert [r.split for r in FC.train_test_split(short, 5).collect()] == ["too_short"] * 3


def test_domain_validation(spark):
    s = series_df(spark)
    with pytest.raises(ValueError):
        FC.load_series(s, "nope", "x")
    with pytest.raises(ValueError):
        FC.load_series(s, "retail", "cpi")
    with pytest.raises(ValueError):
        FC.load_series(s, "weather", "avg_monthly_temp_c")
    assert FC.load_series(s, "retail", "total_retail_sales_millions").count() == 72


def test_kernel_properties():
    y = synthetic()
    res = arima.fit(y[:60], (1, 1, 1), (0, 1, 1, 12), start=arima.common_start(FC.order_grid(), 60))
    assert res is not None and np.isfinite(res["aic"])
    mean, lo, hi = arima.forecast(y[:60], res, 24)
    assert len(mean) == 24 and np.all(np.isfinite(mean)) and np.all(lo <= hi)
    assert np.sqrt(np.mean((mean[:12] - y[60:]) ** 2)) < 30


def test_batched_fit_equals_single_fits():
    """A batch of series fitted together gives each series the fit it gets alone (own damping,
    acceptance and stopping point), also when one series fails or stops early."""
    ys = np.stack([synthetic(60, seed) for seed in range(5)])
    ys[3] = 5.0                                          # constant: zero residuals after differencing
    ys[4, 30] = 1e6                                      # one wild point
    start = arima.common_start(FC.order_grid(), 60)
    for order, seasonal in [((1, 1, 1), (0, 1, 1, 12)), ((2, 0, 0), (1, 0, 0, 12)), ((0, 1, 2), (1, 1, 1, 12)),
                            ((0, 0, 0), (0, 1, 0, 12))]:
        batch = arima.fit_many(ys, order, seasonal, start=start)
        for y, b in zip(ys, batch):
            one = arima.fit(y, order, seasonal, start=start)
            assert (one is None) == (b is None)
            if one is not None:
                assert b["iterations"] == one["iterations"]
                assert abs(b["aic"] - one["aic"]) <= 1e-9 * max(1.0, abs(one["aic"]))
                assert np.allclose(b["params"], one["params"], rtol=1e-9, atol=1e-12)


def test_fit_rows_grouped_by_order_and_length():
    """The task-side function groups rows by (order, series length) into batches; every row
    gets the AIC of its own single fit, in its own position, whatever the row order."""
    import pandas as pd
    grid = SMALL_GRID
    rows = []
    for sid, n in enumerate([60, 48, 60, 14, 48, 37]):
        y = synthetic(n, 100 + sid)
        for gi, g in enumerate(grid):
            rows.append({"series_key": f"s{sid}", "values": y, "grid_idx": gi,
                         **dict(zip(FC.ORDER_COLS, g))})
    pdf = pd.DataFrame(rows).sample(frac=1.0, random_state=7).reset_index(drop=True)
    out = pd.concat(list(FC._fit_batches(iter([pdf]))))
    assert list(out["series_key"]) == list(pdf["series_key"]) and list(out["grid_idx"]) == list(pdf["grid_idx"])
    full = FC.order_grid()
    for r, aic in zip(pdf.itertuples(index=False), out["aic"]):
        one = arima.fit(r.values, (r.p, r.d, r.q), (r.sp, r.sd, r.sq, r.s),
                        start=arima.common_start(full, len(r.values)))
        if one is None:
            assert pd.isna(aic)
        else:
            assert abs(aic - one["aic"]) <= 1e-9 * max(1.0, abs(one["aic"]))


def test_grid_slices_cover_grid_once_and_balance_cost():
    grid = FC.order_grid()
    for n in (1, 7, 32, 144, 200):
        slices = FC.grid_slices(grid, n)
        flat = sorted(i for sl in slices for i in sl)
        assert flat == list(range(len(grid)))
        sizes = [len(sl) for sl in slices if sl]
        assert max(sizes) - min(sizes) <= 1
    with_ma = [sum(1 for i in sl if grid[i][2] + grid[i][5] > 0) for sl in FC.grid_slices(grid, 32)]
    assert max(with_ma) - min(with_ma) <= 1


def test_fit_units_ship_each_series_once_per_slice(spark):
    """The fan-out is series x slices, not series x 144 candidates, and every candidate of
    the grid is in exactly one slice."""
    s = series_df(spark, keys=("a:x:national", "b:y:national", "c:z:national"))
    packed = FC.pack(s)
    rows, slices = FC.fit_units(packed, FC.order_grid())
    par = spark.sparkContext.defaultParallelism
    assert len(slices) == min(144, 4 * par)
    assert rows.count() == 3 * len(slices)
    assert rows.rdd.getNumPartitions() == len(slices)
    assert rows.groupBy("_slice").count().filter("count != 3").count() == 0
    assert FC.fit_units(packed.limit(0), FC.order_grid()) is None
    plan = FC.fit_candidates(packed)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "MapInPandas" in plan and "Generate" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_batched_fit_mixed_lengths_equals_single_fits():
    """Series of different lengths share a batch (front-padded and masked); each gets the fit
    and the sample (its own common start) it gets alone; too-short ones give None."""
    ys = [synthetic(n, 200 + n) for n in (67, 40, 25, 90, 14, 55)]
    starts = [arima.common_start(FC.order_grid(), len(y)) for y in ys]
    for order, seasonal in [((1, 1, 1), (0, 1, 1, 12)), ((2, 1, 2), (1, 1, 1, 12)), ((1, 0, 0), (1, 0, 0, 12))]:
        batch = arima.fit_many(ys, order, seasonal, start=starts)
        for y, st, b in zip(ys, starts, batch):
            one = arima.fit(y, order, seasonal, start=st)
            assert (one is None) == (b is None)
            if one is not None:
                assert b["iterations"] == one["iterations"] and b["n"] == one["n"]
                assert abs(b["aic"] - one["aic"]) <= 1e-8 * max(1.0, abs(one["aic"]))


def test_too_short_series_fail():
    assert arima.fit(np.arange(10.0), (2, 1, 2), (1, 1, 1, 12)) is None
    assert arima.fit_many(np.ones((3, 14)), (1, 1, 1), (1, 1, 1, 12)) == [None, None, None]


def test_evaluate_and_predict_jobs(spark):
    s = series_df(spark, keys=("a:x:national", "b:y:national"))
    split = FC.train_test_split(s, 12)
    train = FC.pack(split.filter("split = 'train'"))
    orders = FC.choose_orders(FC.fit_candidates(train, SMALL_GRID))
    rows = orders.collect()
    assert len(rows) == 2 and all(isinstance(r.p, int) and np.isfinite(r.aic) for r in rows)
    fc = FC.forecast(train, orders, 12 + 6).collect()
    assert len(fc) == 2 * 18 and all(r.lower <= r.mean <= r.upper for r in fc)
    assert min(r.month for r in fc) == date(2023, 1, 1)
    # FC-9: a cached order is refitted once instead of searching the grid
    cache = FC.updated_cache(None, orders)
    fc2, orders2 = FC.predict(s, 12, cache)
    assert fc2.count() == 24
    assert {(r.series_key, r.p, r.d, r.q) for r in orders2.collect()} == {(r.series_key, r.p, r.d, r.q) for r in rows}


def test_fallback_when_every_candidate_fails(spark):
    s = series_df(spark, n=8)                      # too short for any seasonal candidate
    orders = FC.choose_orders(FC.fit_candidates(FC.pack(s), [(2, 1, 2, 1, 1, 1, 12)])).first()
    assert orders.fallback and (orders.p, orders.d, orders.q, orders.sp, orders.s) == (1, 1, 1, 0, 0)


def test_metrics(spark):
    perfect = spark.createDataFrame([("k", 100.0, 100.0)] * 12, "series_key string, actual double, predicted double")
    r = FC.error_metrics(perfect).first()
    assert (r.rmse, r.mae, r.mape) == (0.0, 0.0, 0.0)
    off = spark.createDataFrame([("k", 100.0 + i, 95.0 + i + (i % 3)) for i in range(12)],
                                "series_key string, actual double, predicted double")
    r = FC.error_metrics(off).first()
    assert r.rmse >= r.mae
    zeros = spark.createDataFrame([("k", 0.0, 0.1), ("k", 0.0, 0.2), ("k", 0.0, 0.0)],
                                  "series_key string, actual double, predicted double")
    assert FC.error_metrics(zeros).first().mape is None


def test_metrics_of_a_diverging_series_do_not_end_the_job(spark):
    rows = [("big", 1.0, 1e15), ("big", 1.0, 2.0), ("nan", 1.0, float("nan")), ("fine", 1.0, 2.0)]
    got = {r.series_key: r for r in FC.error_metrics(spark.createDataFrame(
        rows, "series_key string, actual double, predicted double")).collect()}
    assert (got["big"].status, got["big"].n, got["big"].n_scored, got["big"].mae) == ("ok", 2, 2, 5e14)
    assert got["big"].rmse == (((1e15 - 1) ** 2 + 1) / 2) ** 0.5
    assert got["nan"].n_scored == 0 and got["nan"].rmse is None
    assert got["fine"].status == "ok" and got["fine"].rmse == 1.0


def test_disjoint_months_give_no_pairs(spark):
    a = spark.createDataFrame([("k", date(2024, 1, 1), 1.0)], "series_key string, month date, actual double")
    p = spark.createDataFrame([("k", date(2025, 1, 1), 1.0)], "series_key string, month date, predicted double")
    pairs = a.join(p, ["series_key", "month"], "inner")
    assert FC.error_metrics(pairs).count() == 0


def test_synthetic_series_and_date_map(spark):
    s = FC.synthetic_series(spark, 24)
    assert s.count() == 24 and s.agg(F.min("month")).first()[0] == date(2018, 1, 1)
    m = FC.date_value_map(s, "value").first()["value"]
    assert sorted(m)[:2] == ["2018-01-01", "2018-02-01"] and len(m) == 24
    with pytest.raises(ValueError):
        FC.predict(s, 0)


def _months(spark, rows):
    return spark.createDataFrame([(k, date(2024 + (m - 1) // 12, (m - 1) % 12 + 1, 1), float(m)) for k, m in rows], "series_key string, month date, value double")


def test_gaps_and_duplicates_are_named_and_refused(spark):
    s = _months(spark, [("a", m) for m in (1, 2, 5, 5, 13)] + [("b", m) for m in (11, 12, 13)] + [("c", 4)])
    found = {(r.series_key, r.month.year * 12 + r.month.month - 2024 * 12, r.n, r.reason) for r in FC.series_faults(s).collect()}
    assert found == {("a", m, 0, "gap") for m in (3, 4, *range(6, 13))} | {("a", 5, 2, "duplicate")}
    assert {r.series_key for r in FC.regular_series(s).collect()} == {"b", "c"}
    assert FC.series_faults(s.limit(0)).count() == 0


def test_no_month_in_common_is_an_error_of_the_plan(spark):
    actual = _months(spark, [("a", 1), ("a", 2), ("b", 1)]).withColumnRenamed("value", "actual")
    fits = _months(spark, [("a", 2), ("b", 1), ("b", 9), ("z", 1)]).withColumnRenamed("value", "predicted")
    assert {(r.series_key, r.actual, r.predicted) for r in FC.aligned(actual, fits).collect()} == {("a", 2.0, 2.0), ("b", 1.0, 1.0)}
    with pytest.raises(Exception, match="no month in common: b"):
        FC.aligned(actual, fits.filter("series_key = 'a'")).collect()
    assert FC.aligned(actual.limit(0), fits).count() == 0
