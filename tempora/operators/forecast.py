"""Forecasting as Spark jobs over many series at once (FC-1..FC-14, AGG-14, JN-8).

series table (one row per series and month, from the marts)
  -> train/test split (row_number per series, newest months = test)
  -> one packed row per series: months and values as arrays, sorted by month
  -> one row per (series, grid slice); a slice is a share of the 144 candidates, and the
     slice count falls as the series count grows, so each series is shipped a few times
     at most, not once per candidate
  -> mapInPandas: per (bucket of series, slice) the numpy kernel fits each candidate of
     the slice to the whole bucket as one batch (AIC, NULL on failure)
  -> best candidate per series by (aic, grid position): row_number window
  -> fallback order where every candidate failed; order cache joined in first
  -> mapInPandas: forecast means and 95 % intervals
  -> metrics: join forecasts to held-out actuals on (series, month), aggregate.

A series is its months (bounded by the calendar), so packing it into one row is bounded
whatever the data size; the work that grows -- series x candidates -- is spread by Spark.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions import arima
from tempora.functions.constants import (
    DOMAIN_METRICS, FALLBACK_ORDER, FALLBACK_SEASONAL, GRID_D, GRID_P, GRID_Q, GRID_SD, GRID_SP, GRID_SQ, MAX_ITER,
    SEASONAL_PERIOD, Z_95,
)
from tempora.functions.exprs import exact_avg, round_half_up
from tempora.session import cut_lineage

ORDER_COLS = ["p", "d", "q", "sp", "sd", "sq", "s"]


def order_grid(s: int = SEASONAL_PERIOD) -> list[tuple]:
    """FC-7: (p,d,q) outer, (P,D,Q) inner, in product order (ties go to the earlier one)."""
    return [(p, d, q, P, D, Q, s) for p, d, q in itertools.product(GRID_P, GRID_D, GRID_Q)
            for P, D, Q in itertools.product(GRID_SP, GRID_SD, GRID_SQ)]


# ------------------------------------------------------------------ FC-1 .. FC-5: series

def series_table(macro_weather: DataFrame, retail_macro: DataFrame, domains=("weather", "economic", "retail"),
                 location: str | None = None) -> DataFrame:
    """(series_key, domain, metric, location_name, month, value) for every whitelisted
    metric. Weather is per city (FC-2); economic and retail are national and the mart
    repeats them per city, so they are de-duplicated (FC-3)."""
    parts = []
    for domain in domains:
        metrics = DOMAIN_METRICS[domain]
        src = macro_weather if domain == "weather" else retail_macro
        keep = ["location_name", "year_month"] if domain == "weather" else ["year_month"]
        base = src
        if domain == "weather" and location:
            base = base.filter(F.col("location_name") == location)
        long = base.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
            keep, metrics, "metric", "value")
        long = long.filter(F.col("year_month").isNotNull() & F.col("value").isNotNull())
        if domain == "weather":
            long = long.filter(F.col("location_name").isNotNull())
        else:
            long = long.distinct().withColumn("location_name", F.lit(None).cast("string"))
        parts.append(long.withColumn("domain", F.lit(domain)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    key = F.concat_ws(":", "domain", "metric", F.coalesce(F.col("location_name"), F.lit("national")))
    return out.select(key.alias("series_key"), "domain", "metric", "location_name",
                      F.to_date(F.concat("year_month", F.lit("-01"))).alias("month"), "value")


def series_from_models(monthly_weather: DataFrame, econ_pivot: DataFrame, retail_pivot: DataFrame,
                       locations: DataFrame) -> DataFrame:
    """The same table as ``series_table`` over the marts, computed from the models the marts
    are made of. National values are those of months present in the weather facts (the
    mart's left joins keep exactly those months; its per-city repetition is what DISTINCT
    undoes), so the pivots are semi-joined to the weather months instead of being fanned
    out per city and de-duplicated again."""
    names = locations.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"))
    weather_metrics = DOMAIN_METRICS["weather"]
    weather = (monthly_weather.join(names, "location_id", "left")
               .select("location_name", "year_month", *[F.col(m).cast("double").alias(m) for m in weather_metrics])
               .unpivot(["location_name", "year_month"], weather_metrics, "metric", "value")
               .filter(F.col("location_name").isNotNull() & F.col("year_month").isNotNull()
                       & F.col("value").isNotNull())
               .withColumn("domain", F.lit("weather")))
    months = monthly_weather.select("year_month").distinct()
    retail = retail_pivot.select(F.format_string("%d-%02d", "observed_year", "observed_month").alias("year_month"),
                                 *DOMAIN_METRICS["retail"])
    national = months.join(econ_pivot, "year_month", "left").join(retail, "year_month", "left")
    nat_metrics = DOMAIN_METRICS["economic"] + DOMAIN_METRICS["retail"]
    domain_of = F.when(F.col("metric").isin(DOMAIN_METRICS["economic"]), "economic").otherwise("retail")
    nat = (national.select("year_month", *[F.col(m).cast("double").alias(m) for m in nat_metrics])
           .unpivot(["year_month"], nat_metrics, "metric", "value")
           .filter(F.col("year_month").isNotNull() & F.col("value").isNotNull())
           .select(F.lit(None).cast("string").alias("location_name"), "year_month", "metric", "value",
                   domain_of.alias("domain")))
    out = weather.unionByName(nat)
    key = F.concat_ws(":", "domain", "metric", F.coalesce(F.col("location_name"), F.lit("national")))
    return out.select(key.alias("series_key"), "domain", "metric", "location_name",
                      F.to_date(F.concat("year_month", F.lit("-01"))).alias("month"), "value")


def load_series(series: DataFrame, domain: str, metric: str, location: str | None = None) -> DataFrame:
    """FC-1: one whitelisted series (ValueError on an unknown pair or missing city)."""
    if domain not in DOMAIN_METRICS:
        raise ValueError(f"no such domain: {domain!r} (there are {', '.join(DOMAIN_METRICS)})")
    if metric not in DOMAIN_METRICS[domain]:
        raise ValueError(f"domain {domain!r} has no metric {metric!r}")
    if domain == "weather" and not location:
        raise ValueError("a weather series needs a city")
    df = series.filter((F.col("domain") == domain) & (F.col("metric") == metric))
    return df.filter(F.col("location_name") == location) if domain == "weather" else df


def series_profile(series: DataFrame) -> DataFrame:
    """FC-4: months, span and regularity (no gap, no duplicate month) per series."""
    g = series.groupBy("series_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("month").alias("n_months"),
                                          F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    span = F.months_between("last_month", "first_month").cast("int") + 1
    return g.withColumn("is_regular", (F.col("n") == F.col("n_months")) & (F.col("n") == span))


def series_faults(series: DataFrame) -> DataFrame:
    """FC-4: (series_key, month, n, reason), a row for every month between a series' first and last that it
    lacks ('gap', n = 0) or has more than once ('duplicate'). The gaps are generated from each month to the next one
    there, so the calendar needs no join; a window holds one row a month of one series."""
    seen = series.filter(F.col("month").isNotNull()).groupBy("series_key", "month").agg(F.count(F.lit(1)).alias("n"))
    after = F.lead("month").over(Window.partitionBy("series_key").orderBy("month"))
    step = F.expr("INTERVAL 1 MONTH")
    first, last = F.add_months("month", 1), F.add_months("next", -1)
    lacking = F.when(first <= last, F.sequence(first, last, step))
    ahead = seen.withColumn("next", after)
    gaps = ahead.select("series_key", F.explode(lacking).alias("month"), F.lit(0).cast("long").alias("n"), F.lit("gap").alias("reason"))
    return gaps.unionByName(seen.filter("n > 1").withColumn("reason", F.lit("duplicate")))


def regular_series(series: DataFrame) -> DataFrame:
    """FC-4: the rows of the series that have every month once; the others are refused (``series_faults`` says why)."""
    return series.join(series_faults(series).select("series_key").distinct(), "series_key", "left_anti")


def aligned(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """JN-8: actual and predicted values of the months that both have. A series of ``actual`` that has no month
    in common with its prediction ends the job with an error that names it, raised by the plan itself."""
    both = actual.join(predicted.withColumn("_met", F.lit(True)), ["series_key", "month"], "left")
    met = F.count("_met").over(Window.partitionBy("series_key"))
    refused = F.raise_error(F.concat(F.lit("no month in common: "), "series_key"))
    ok = F.when(met == 0, refused.cast("boolean")).otherwise(F.col("_met"))
    return both.withColumn("_ok", ok).filter("_ok").drop("_met", "_ok")


def train_test_split(series: DataFrame, test_months: int = 12) -> DataFrame:
    """FC-5: the newest ``test_months`` months of each series are 'test', the rest 'train';
    series with no more than ``test_months`` months cannot be split and come back as 'too_short'."""
    if test_months < 0:
        raise ValueError("test_months must be >= 0")
    w = Window.partitionBy("series_key")
    newest = F.row_number().over(w.orderBy(F.col("month").desc()))
    df = series.withColumn("_rank", newest).withColumn("_n", F.count(F.lit(1)).over(w))
    return (df.withColumn("split", F.when(F.col("_n") <= test_months, "too_short")
                          .when(F.col("_rank") <= test_months, "test").otherwise("train"))
            .drop("_rank", "_n"))


def pack(series: DataFrame) -> DataFrame:
    """One row per series: months and values sorted by month."""
    pts = F.sort_array(F.collect_list(F.struct("month", "value")))
    return (series.groupBy("series_key").agg(pts.alias("pts"))
            .select("series_key", F.col("pts.month").alias("months"), F.col("pts.value").alias("values")))


# ------------------------------------------------------------------ FC-6 .. FC-9: fitting

FIT_SCHEMA = "series_key string, grid_idx int, p int, d int, q int, sp int, sd int, sq int, s int, aic double"

# Series per kernel batch: large enough to share the per-step cost of the residual
# recursion, small enough that a batch's arrays (series x parameters x months) stay small.
BATCH_SERIES = 512


def _by_length(pdf, pos):
    """Row positions ``pos`` ordered by series length, so a chunk of them pads little."""
    lengths = pdf["values"].map(len).to_numpy()[pos]
    return pos[np.argsort(lengths, kind="stable")]


def _fit_batches(batches):
    """Rows (series, candidate) -> AIC per row. Rows of one candidate order are fitted
    together as ``arima.fit_many`` batches (series of any lengths, shortest first)."""
    grid = order_grid()
    for pdf in batches:
        if pdf.empty:
            continue
        aics = np.full(len(pdf), np.nan)
        keys = pdf[ORDER_COLS].astype(int)
        for key, idx in keys.groupby(ORDER_COLS, sort=False).groups.items():
            p, d, q, sp, sd, sq, s = (int(v) for v in key)
            pos = _by_length(pdf, pdf.index.get_indexer(idx))
            for lo in range(0, len(pos), BATCH_SERIES):
                chunk = pos[lo:lo + BATCH_SERIES]
                ys = [np.asarray(pdf["values"].iat[i], dtype=float) for i in chunk]
                try:
                    res = arima.fit_many(ys, (p, d, q), (sp, sd, sq, s), max_iter=MAX_ITER,
                                         start=[arima.common_start(grid, len(y)) for y in ys])
                except Exception:  # a failing candidate is skipped, as in the source
                    res = [None] * len(chunk)
                aics[chunk] = [np.nan if r is None else r["aic"] for r in res]
        out = pdf[["series_key", "grid_idx", *ORDER_COLS]].copy()
        out["aic"] = pd.Series(aics, index=pdf.index, dtype="float64").where(np.isfinite(aics))
        yield out


def _heavy_first(grid) -> list[int]:
    """Grid positions ordered by expected fit cost, highest first: candidates with an MA
    part run a recursion over time at every step; more parameters mean more steps."""
    return sorted(range(len(grid)), key=lambda i: (-(grid[i][2] + grid[i][5] > 0), -sum(grid[i][j] for j in
                                                                                     (0, 2, 3, 5)), i))


def grid_slices(grid, n_slices: int) -> list[list[int]]:
    """The grid dealt round-robin from the costliest candidate down, so every slice holds
    about the same amount of fitting work."""
    order = _heavy_first(grid)
    return [order[j::n_slices] for j in range(n_slices)]


def _fit_slices(grid, slices):
    """Task function: rows (series, values, slice) -> one AIC row per series and candidate
    of the slice. Series of one slice (any lengths, shortest first) are fitted as one batch
    per candidate."""
    full = order_grid()

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            out = []
            for sl, idx in pdf.groupby("_slice", sort=False).groups.items():
                pos = _by_length(pdf, pdf.index.get_indexer(idx))
                for lo in range(0, len(pos), BATCH_SERIES):
                    chunk = pos[lo:lo + BATCH_SERIES]
                    ys = [np.asarray(pdf["values"].iat[i], dtype=float) for i in chunk]
                    start = [arima.common_start(full, len(y)) for y in ys]
                    names = pdf["series_key"].to_numpy()[chunk]
                    for gi in slices[int(sl)]:
                        g = grid[gi]
                        try:
                            res = arima.fit_many(ys, g[:3], g[3:], start=start, max_iter=MAX_ITER)
                        except Exception:  # a failing candidate is skipped, as in the source
                            res = [None] * len(chunk)
                        cols = {"series_key": names, "grid_idx": np.full(len(chunk), gi, dtype=np.int32)}
                        cols.update({c: np.full(len(chunk), v, dtype=np.int32) for c, v in zip(ORDER_COLS, g)})
                        cols["aic"] = pd.array([None if r is None else r["aic"] for r in res], dtype="Float64")
                        out.append(pd.DataFrame(cols))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def fit_candidates(packed: DataFrame, grid=None, tasks: int | None = None) -> DataFrame:
    """FC-6/FC-7: AIC of every (series, candidate); NULL where the fit failed.

    Work unit = (bucket of about ``BATCH_SERIES`` series, slice of the grid): a task fits
    every candidate of its slice to its bucket, one ``fit_many`` batch per candidate. A
    series is shipped once per slice, not once per candidate, and the slice count falls as
    the series count grows: slices = ceil(target tasks / buckets), at most the grid size,
    with target tasks = ``tasks`` or 4 per core. So few series still spread over all cores,
    and many series shuffle each series about once. Groups are range-partitioned on a
    dense id so that each gets its own task while groups <= tasks (the partition count is
    explicit: CPU-heavy but byte-light rows must not be coalesced), capped at
    max(4 per core, 256) tasks."""
    grid = grid or order_grid()
    units = fit_units(packed, grid, tasks)
    if units is None:                                 # e.g. every series found in the order cache
        return packed.sparkSession.createDataFrame([], FIT_SCHEMA)
    rows, slices = units
    return rows.mapInPandas(_fit_slices(grid, slices), FIT_SCHEMA)


def fit_units(packed: DataFrame, grid, tasks: int | None = None):
    """(rows, slices) for ``fit_candidates``: one row per (series, grid slice), partitioned
    so that each (slice, series bucket) group is one task; None when there is no series."""
    spark = packed.sparkSession
    n_series = packed.count()
    if n_series == 0:
        return None
    buckets = max(1, -(-n_series // BATCH_SERIES))
    par = max(spark.sparkContext.defaultParallelism, 1)
    target = tasks or par * 4
    n_slices = max(1, min(len(grid), -(-target // buckets)))
    n_tasks = tasks or max(1, min(n_slices * buckets, max(par * 4, 256)))
    gid = F.col("_slice").cast("long") * buckets + F.pmod(F.xxhash64("series_key"), F.lit(buckets))
    rows = (packed.select("series_key", "values", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("_slice"))
            .withColumn("_gid", gid).repartitionByRange(n_tasks, "_gid").drop("_gid"))
    return rows, grid_slices(grid, n_slices)


def choose_orders(fits: DataFrame) -> DataFrame:
    """FC-7/FC-8: lowest AIC per series (earliest grid position on ties); when every
    candidate failed, the fallback (1,1,1)(0,0,0,0) with NULL aic."""
    w = Window.partitionBy("series_key").orderBy(F.col("aic").asc_nulls_last(), "grid_idx")
    best = fits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
    failed = F.col("aic").isNull()
    fb = dict(zip(ORDER_COLS, FALLBACK_ORDER + FALLBACK_SEASONAL))
    cols = [F.when(failed, F.lit(fb[c])).otherwise(F.col(c)).alias(c) for c in ORDER_COLS]
    return best.select("series_key", *cols, "aic", failed.alias("fallback"))


def _spread_by_order(rows: DataFrame, n_series: int) -> DataFrame:
    """Rows with a chosen order per series: series of one order travel together (in buckets
    of about BATCH_SERIES, so an order chosen by most series is still split over many
    tasks) and are fitted as one batch."""
    buckets = max(1, -(-n_series // BATCH_SERIES))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, 1) * 2
    bucket = F.pmod(F.xxhash64("series_key"), F.lit(buckets))
    return rows.repartition(tasks, *ORDER_COLS, bucket)


def select_orders(packed: DataFrame, cache: DataFrame | None = None, grid=None) -> DataFrame:
    """FC-9: series found in the order cache refit only their cached order; the grid runs
    for the misses and for cached orders that no longer fit."""
    if cache is None:
        return choose_orders(fit_candidates(packed, grid))
    cached = packed.join(cache.select("series_key", *ORDER_COLS), "series_key", "inner") \
        .withColumn("grid_idx", F.lit(-1))
    refit = _spread_by_order(cached, packed.count()) \
        .mapInPandas(_fit_batches, FIT_SCHEMA).filter(F.col("aic").isNotNull())
    hits = cut_lineage(refit.select("series_key", *ORDER_COLS, "aic", F.lit(False).alias("fallback")))
    misses = packed.join(hits.select("series_key"), "series_key", "left_anti")
    return hits.unionByName(choose_orders(fit_candidates(misses, grid)))


def updated_cache(cache: DataFrame | None, orders: DataFrame) -> DataFrame:
    """The order cache after a run: new choices replace old ones per series."""
    new = orders.select("series_key", *ORDER_COLS)
    if cache is None:
        return new
    return cache.select("series_key", *ORDER_COLS).join(new.select("series_key"), "series_key", "left_anti") \
        .unionByName(new)


# ------------------------------------------------------------------ FC-10 .. FC-12: forecasting

FORECAST_SCHEMA = "series_key string, step int, mean double, lower double, upper double"


def _forecast_batches(batches):
    """Refit each series' chosen order (series of one order as one batch) and forecast
    ``steps`` months."""
    grid = order_grid()
    for pdf in batches:
        out = []
        keys = pdf[ORDER_COLS].astype(int)
        for key, idx in keys.groupby(ORDER_COLS, sort=False).groups.items():
            p, d, q, sp, sd, sq, s = (int(v) for v in key)
            order, seasonal = (p, d, q), (sp, sd, sq, s)
            pos = _by_length(pdf, pdf.index.get_indexer(idx))
            for lo in range(0, len(pos), BATCH_SERIES):
                chunk = pos[lo:lo + BATCH_SERIES]
                ys = [np.asarray(pdf["values"].iat[i], dtype=float) for i in chunk]
                fits = arima.fit_many(ys, order, seasonal, max_iter=MAX_ITER,
                                      start=[arima.common_start(grid, len(y)) for y in ys])
                for i, y, res in zip(chunk, ys, fits):
                    if res is None:
                        res = arima.fit(y, order, seasonal, start=0, max_iter=MAX_ITER)
                    if res is None:
                        continue
                    steps = int(pdf["steps"].iat[i])
                    mean, lo_, hi = arima.forecast(y, res, steps, Z_95)
                    key_ = pdf["series_key"].iat[i]
                    out.extend((key_, j + 1, float(mean[j]), float(lo_[j]), float(hi[j])) for j in range(steps))
        yield pd.DataFrame(out, columns=["series_key", "step", "mean", "lower", "upper"])


def forecast(packed: DataFrame, orders: DataFrame, steps: int) -> DataFrame:
    """FC-10/FC-11: ``steps`` monthly forecasts after each series' last month with 95 %
    intervals -> (series_key, step, month, mean, lower, upper)."""
    rows = packed.join(orders.select("series_key", *ORDER_COLS), "series_key", "inner") \
        .withColumn("steps", F.lit(int(steps)))
    fc = _spread_by_order(rows, orders.count()).mapInPandas(_forecast_batches, FORECAST_SCHEMA)
    last = packed.select("series_key", F.element_at("months", -1).alias("_last"))
    return fc.join(last, "series_key").select(
        "series_key", "step", F.add_months("_last", F.col("step")).alias("month"), "mean", "lower", "upper")


# ------------------------------------------------------------------ AGG-14, FC-13, FC-14

#: Errors up to this have squares whose sums fit decimal(38,10); larger ones are scaled by a power of two.
PLAIN_ERROR = 1e9


def error_metrics(pairs: DataFrame, actual: str = "actual", predicted: str = "predicted",
                  by: str = "series_key") -> DataFrame:
    """AGG-14: RMSE, MAE and MAPE (over non-zero actuals; NULL when all are zero), rounded
    to 4 places. Sums are decimal, so the result does not depend on row order; a series with larger errors is
    summed in units of a power of two, which loses nothing a double could show. Every pair whose errors are finite
    is scored; ``status`` says when some are not."""
    err = F.abs(F.col(actual) - F.col(predicted))
    ape = F.when(F.col(actual) != 0, err / F.abs(F.col(actual)))
    ok = F.coalesce((err < float("inf")) & (F.coalesce(ape, F.lit(0.0)) < float("inf")), F.lit(False))
    series = Window.partitionBy(by)  # the grouping below has the same key: one shuffle
    found = pairs.withColumn("_ae", F.when(ok, err)).withColumn("_ape", F.when(ok, ape))
    for c in ("_ae", "_ape"):
        most = F.max(c).over(series)
        found = found.withColumn(f"{c}_unit", F.when(most < PLAIN_ERROR, 1.0).otherwise(F.pow(F.lit(2.0), F.ceil(F.log2(most / PLAIN_ERROR)))))
    scaled = F.col("_ae") / F.col("_ae_unit")
    g = found.withColumn("_sq", scaled * scaled).withColumn("_ae", scaled).withColumn("_ape", F.col("_ape") / F.col("_ape_unit"))

    def rounded(x, unit):
        value = x * F.max(unit)  # beyond 2^52 a double is whole
        return F.when(value < float(1 << 52), round_half_up(F.when(value < float(1 << 52), value), 4)).otherwise(value)

    scored = F.count("_sq")
    return g.groupBy(by).agg(
        rounded(F.sqrt(exact_avg("_sq")), "_ae_unit").alias("rmse"),
        rounded(exact_avg("_ae"), "_ae_unit").alias("mae"),
        rounded(exact_avg("_ape") * 100, "_ape_unit").alias("mape"),
        F.count(F.lit(1)).alias("n"), scored.alias("n_scored"),
        F.when(scored == F.count(F.lit(1)), "ok").otherwise("unscored points").alias("status"))


def evaluate(series: DataFrame, test_months: int = 12, cache: DataFrame | None = None):
    """FC-13: fit on train, forecast the held-out months, align on month (``aligned``),
    metrics per series. Returns (metrics, orders, trajectory).

    The packed series and the chosen orders (one row per series each) are checkpointed
    into the shared checkpoint folder, so the order search runs once however often its
    result is referenced downstream."""
    split = train_test_split(series, test_months)
    train = cut_lineage(pack(split.filter(F.col("split") == "train")))
    orders = cut_lineage(select_orders(train, cache))
    fc = forecast(train, orders, test_months)
    test = split.filter(F.col("split") == "test").select("series_key", "month", F.col("value").alias("actual"))
    pairs = aligned(test, fc.withColumnRenamed("mean", "predicted"))
    return error_metrics(pairs), orders, fc


def predict(series: DataFrame, months: int = 12, cache: DataFrame | None = None):
    """FC-12: fit on all months (orders from the cache when present), forecast ``months``
    months ahead. Returns (forecast, orders)."""
    if months < 1:
        raise ValueError("forecast months must be >= 1")
    packed = cut_lineage(pack(series))
    orders = cut_lineage(select_orders(packed, cache))
    return forecast(packed, orders, months), orders


def trajectory(series: DataFrame, test_months: int = 12, future_months: int = 12) -> DataFrame:
    """FC-14: long table of train, actual, predicted and future points per series:
    (series_key, role, month, value, lower, upper)."""
    split = train_test_split(series, test_months)
    train = cut_lineage(pack(split.filter(F.col("split") == "train")))
    orders = cut_lineage(select_orders(train))
    fc = forecast(train, orders, test_months + future_months)
    hist = split.filter(F.col("split") != "too_short").select("series_key", F.when(F.col("split") == "train", "train").otherwise("actual").alias("role"),
                        "month", "value", F.lit(None).cast("double").alias("lower"),
                        F.lit(None).cast("double").alias("upper"))
    pred = fc.select("series_key", F.when(F.col("step") <= test_months, "predicted").otherwise("future").alias("role"),
                     "month", F.col("mean").alias("value"), "lower", "upper")
    return hist.unionByName(pred)


def date_value_map(df: DataFrame, value: str, by: str = "series_key", month: str = "month") -> DataFrame:
    """FN-20: per series, {ISO date: round(value, 4)} as MAP<STRING, DOUBLE> in month order
    (a series' months are bounded by the calendar)."""
    entry = F.struct(F.date_format(month, "yyyy-MM-dd").alias("k"), round_half_up(F.col(value), 4).alias("v"))
    return df.groupBy(by).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(value))


def synthetic_series(spark, n_obs: int = 72, seed: int = 42, start: str = "2018-01-01",
                     key: str = "retail:total_retail_sales_millions:national") -> DataFrame:
    """SRC-15: 450 + 0.5 i + 10 sin(2 pi month / 12) + N(0, 3) monthly points, generated on
    executors (Spark's normal stream differs from numpy's: property tests only)."""
    i = F.col("id")
    month_col = F.add_months(F.to_date(F.lit(start)), i.cast("int"))
    noise = F.randn(seed) * 3.0
    val = F.lit(450.0) + i * 0.5 + F.sin(F.lit(2 * 3.141592653589793) * F.month(month_col) / 12.0) * 10.0 + noise
    return spark.range(n_obs).select(F.lit(key).alias("series_key"), F.lit("retail").alias("domain"),
                                     F.lit("total_retail_sales_millions").alias("metric"),
                                     F.lit(None).cast("string").alias("location_name"),
                                     month_col.alias("month"), val.alias("value"))
