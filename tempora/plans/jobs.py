"""Jobs composed of the operators (JOB-1..JOB-6, UDF-2).

Model graph (name -> builder over already-built upstream models, materialisation):
staging and marts are written as Parquet tables (the written table also cuts the
lineage for every downstream model); intermediate models stay views and are
re-expanded inside the mart that reads them. Models run in dependency order by one
runner; the data-quality report gates the run.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.constants import FRED_SERIES
from tempora.operators import merge as M
from tempora.operators import quality as Q
from tempora.operators import staging
from tempora.plans import AS_OF
from tempora.plans import incremental as I
from tempora.plans import models as MD
from tempora.sinks import writers as W
from tempora.sources import backfill
from tempora.sources import fixtures as fx
from tempora.sources import paths
from tempora.sources import payloads as PL
from tempora.streaming.streams import scratch_path

# name -> (upstream names, builder(as_of, *upstream DataFrames), materialisation)
MODEL_GRAPH = {
    "stg_weather_observations": (["weather_observations"], lambda a, w: staging.stg_weather(w, a), "table"),
    "stg_economic_observations": (["economic_observations"], lambda a, e: staging.stg_economic(e), "table"),
    "stg_retail_observations": (["retail_observations"], lambda a, r: staging.stg_retail(r), "table"),
    "stg_locations": (["locations"], lambda a, l: staging.stg_locations(l), "view"),
    "int_monthly_weather_aggregates": (["stg_weather_observations"], lambda a, w: MD.monthly_weather(w), "view"),
    "int_economic_indicators_pivoted": (["stg_economic_observations"], lambda a, e: MD.economic_pivot(e), "view"),
    "int_retail_pivoted": (["stg_retail_observations"], lambda a, r: MD.retail_pivot(r), "view"),
    "int_weather_daily": (["stg_weather_observations"], lambda a, w: MD.weather_daily(w), "view"),
    "int_weather_monthly": (["stg_weather_observations"], lambda a, w: MD.weather_monthly(w), "view"),
    "int_weather_streaks": (["stg_weather_observations", "stg_locations"],
                            lambda a, w, l: MD.subzero_streaks(w, l), "view"),
    "int_dry_spell": (["stg_weather_observations", "stg_locations"], lambda a, w, l: MD.dry_spell(w, l), "view"),
    "fct_location_climate_summary": (["stg_locations", "int_monthly_weather_aggregates", "int_weather_streaks"],
                                     lambda a, l, m, s: MD.location_climate_summary(l, m, s), "table"),
    "fct_monthly_macro_weather": (["int_monthly_weather_aggregates", "int_economic_indicators_pivoted",
                                   "stg_locations"], lambda a, m, e, l: MD.monthly_macro_weather(m, e, l), "table"),
    "fct_monthly_retail_macro": (["fct_monthly_macro_weather", "int_retail_pivoted"],
                                 lambda a, w, r: MD.monthly_retail_macro(w, r), "table"),
}


def model_order(graph=MODEL_GRAPH) -> list[str]:
    order: list[str] = []

    def visit(n):
        for d in graph.get(n, ([], None, None))[0]:
            visit(d)
        if n in graph and n not in order:
            order.append(n)

    for n in graph:
        visit(n)
    return order


def run_models(spark: SparkSession, sources: dict, out_dir: str, as_of: str = AS_OF,
               gate: bool = True) -> DataFrame:
    """JOB-1 transform + check: build every model in dependency order from ``sources``
    (raw tables by name), write the 'table' models under ``out_dir``, then run the check
    suite on the written staging tables. Returns the check report; raises when ``gate``
    and a check fails (a failing suite stops the later steps)."""
    built = dict(sources)
    for name in model_order():
        deps, fn, mat = MODEL_GRAPH[name]
        df = fn(as_of, *[built[d] for d in deps])
        if mat == "table":
            path = f"{out_dir.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            df = spark.read.parquet(path)
        built[name] = df
    return _checked({k: built[k] for k in CHECKED}, as_of, gate)


CHECKED = ["stg_weather_observations", "stg_economic_observations", "stg_retail_observations", "stg_locations"]


def _checked(models: dict, as_of: str, gate: bool) -> DataFrame:
    """The check report on the staging tables; raises when ``gate`` and a check fails."""
    report = Q.report_one_pass(models, as_of).cache()
    if gate and report.filter(F.col("status") == "FAIL").limit(1).count() > 0:
        raise RuntimeError("data-quality checks failed: " +
                           ", ".join(r.check_name for r in report.filter(F.col("status") == "FAIL").collect()))
    return report


def driver_sources(spark: SparkSession, sf_dir: str) -> dict:
    """The raw tables as adapter views over the driver tables."""
    return {name: build(spark, sf_dir) for name, build in fx.VIEWS.items()}


# ------------------------------------------------------------------ ingest (JOB-2..JOB-4)

WEATHER_UPDATE = ["temperature_c", "wind_speed", "pressure", "humidity", "precipitation"]


def _stamp(df: DataFrame, fetched_at: str) -> DataFrame:
    return df.withColumn("created_at", F.to_timestamp_ntz(F.lit(fetched_at)))


def _parsed(spark: SparkSession, table: str, domain: str, fetched_at: str, parsed: DataFrame) -> tuple[DataFrame, dict]:
    """Good rows of what an ingest parsed, and how many payloads and rows it lost. The landed files are scanned once, into a
    stage in the shared folder; lost payloads and rows go to the table ``rejects`` beside the
    ingest's own, as landed, before anything is merged; a run replaces its own rows only."""
    good, lost = PL.split(parsed, scratch_path(spark, f"parsed-{domain}"))
    counts = {"payload": 0, "row": 0} | {r["kind"]: r["count"] for r in lost.groupBy("kind").count().collect()}
    if any(counts.values()):
        lost.withColumn("domain", F.lit(domain)).withColumn("fetched_at", F.lit(fetched_at)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("domain", "fetched_at").parquet(rejects_path(table))
    return good, {"rejected": lost, "counts": counts}


def rejects_path(table: str) -> str:
    return f"{table.rstrip('/').rpartition('/')[0]}/rejects"


def _payloads(spark: SparkSession, landing) -> DataFrame:
    """Landed payloads: a path of files, or a frame (file, identifier, payload), such as ``writers.read_landed`` gives."""
    return landing if isinstance(landing, DataFrame) else PL.files(spark, landing)


def ingest_weather(spark: SparkSession, landing, table: str, fetched_at: str, locations: DataFrame | None = None, changed=None) -> dict:
    """JOB-2: all landed forecast payloads in one job, a lost one does not stop the others; rows upserted on
    (location_id, observed_at) into the month-partitioned table. A payload without a location is of the one at the
    coordinates that its landing folder names."""
    rows, left_out = _parsed(spark, table, "weather", fetched_at, PL.forecast(_payloads(spark, landing), locations))
    rows = _stamp(rows, fetched_at).withColumn("id", F.lit(None).cast("long"))
    months = _merge_or_create(spark, table, rows, ["location_id", "observed_at"], "upsert", WEATHER_UPDATE, "location_id", changed)
    return {"months": months, **left_out}


def ingest_economic(spark: SparkSession, landing, table: str, fetched_at: str, changed=None) -> dict:
    """JOB-3: all landed series payloads; label from the series map; upsert on (series_id, observed_at) updating name and
    value. The series is the payload's own or its landing folder's; rows without one are rejected."""
    rows, left_out = _parsed(spark, table, "economic", fetched_at, PL.economic(_payloads(spark, landing)))
    label = F.element_at(F.create_map(*[F.lit(x) for pair in FRED_SERIES.items() for x in pair]), F.col("series_id"))
    rows = _stamp(rows.withColumn("series_name", label), fetched_at)
    months = _merge_or_create(spark, table, rows, ["series_id", "observed_at"], "upsert", ["series_name", "value"], "series_id", changed)
    return {"months": months, **left_out}


def ingest_retail(spark: SparkSession, landing, table: str, fetched_at: str, start_year: int | None = None, changed=None) -> dict:
    """JOB-4: landed Census payloads; nothing parsed -> nothing written."""
    rows, left_out = _parsed(spark, table, "retail", fetched_at, PL.retail(_payloads(spark, landing), start_year))
    return {"months": _merge_or_create(spark, table, _stamp(rows, fetched_at), ["naics_code", "observed_at"], "upsert",
                                       ["category_name", "value"], "naics_code", changed), **left_out}


def _merge_or_create(spark, table, rows, keys, mode, update_cols, cluster_col, changed=None):
    """Merge into the table, or write it where nothing is yet. A table that is there but cannot
    be read raises; an ingest never overwrites one. ``changed`` is told the months before they are written."""
    months = W.touched_months(rows)
    if changed:
        changed(months)
    if not paths.exists(spark, table):
        first = M.one_per_key(rows, keys, ("created_at",), newest_first=mode == "upsert")
        W.write_table(first, table, cluster_col=cluster_col, mode="errorifexists")
        return months
    return W.rewrite_partitions(spark, table, rows, keys, mode, update_cols, cluster_col=cluster_col, months=months)


# ------------------------------------------------------------------ backfill and migration (JOB-5, JOB-6)

def backfill_plan(spark: SparkSession, locs: DataFrame, table: str, as_of: str) -> DataFrame:
    """JOB-5 step 1: the 20-day chunks each location still needs (fetching is outside Spark)."""
    obs = spark.read.parquet(table) if paths.exists(spark, table) else \
        spark.createDataFrame([], "location_id long, observed_at timestamp_ntz")
    return backfill.backfill_chunks(locs, obs, as_of)


def backfill_load(spark: SparkSession, landing, table: str, fetched_at: str, locations: DataFrame | None = None, changed=None) -> dict:
    """JOB-5 step 2: landed archive chunks inserted first-write-wins (existing readings are
    never overwritten); unreadable chunks and hours do not stop the others and are recorded."""
    rows, left_out = _parsed(spark, table, "archive", fetched_at, PL.archive(_payloads(spark, landing), locations))
    rows = _stamp(rows, fetched_at).withColumn("id", F.lit(None).cast("long"))
    return {"months": _merge_or_create(spark, table, rows, ["location_id", "observed_at"], "ignore", WEATHER_UPDATE,
                                       "location_id", changed), **left_out}


def migrate(spark: SparkSession, src: DataFrame, out: str, kind: str = "weather", dry_run: bool = False) -> int:
    """JOB-6: normalise and truncate-load; ``dry_run`` only counts."""
    norm = M.normalise_weather(src) if kind == "weather" else M.normalise_economic(src)
    if dry_run:
        return norm.count()
    W.overwrite(norm, out)
    return spark.read.parquet(out).count()


def run_daily(spark: SparkSession, landing_root: str, tables_root: str, out_dir: str, fetched_at: str,
              locations: DataFrame, as_of: str | None = None, gate: bool = True, locations_changed: bool = False) -> DataFrame:
    """JOB-1: ingest the three domains (each isolated from the others' failure), bring the models up to date
    (the months touched only, see ``incremental``; say so when the locations have changed), gate on the checks.
    Returns the check report with one row per ingest, whose failures count the payloads and rows lost (all in the table
    ``rejects``); a domain that failed or lost anything is FAIL there, and a run with ``gate`` raises after the rest is done."""
    as_of = as_of or fetched_at
    status, counts, ledger = {}, {}, I.Ledger(spark, f"{tables_root}/ledger")
    ingests = {"weather": partial(ingest_weather, locations=locations), "economic": ingest_economic, "retail": ingest_retail}
    for name, fn in ingests.items():
        try:
            n = counts[name] = fn(spark, f"{landing_root}/{name}", f"{tables_root}/{name}", fetched_at,
                                  changed=lambda months, t=f"{name}_observations": ledger.changed({t: months}))["counts"]
            status[name] = "ok" if not any(n.values()) else f"{n['payload']} payloads and {n['row']} rows rejected"
        except Exception as e:  # one domain's failure does not stop the others
            status[name] = f"{type(e).__name__}: {e}"[:300]
    if locations_changed:
        ledger.changed({"locations": [I.ALL]})
    sources = {f"{name}_observations": f"{tables_root}/{name}" for name in ingests} | {"locations": locations}
    I.run(spark, sources, out_dir, ledger, as_of)
    report = _checked({n: I.read_table(spark, f"{out_dir.rstrip('/')}/{n}") for n in CHECKED}, as_of, gate)
    failed = {k: v for k, v in status.items() if k not in counts or any(counts[k].values())}
    if gate and failed:
        raise RuntimeError(f"ingest failed: {failed}")
    rows = [(f"ingest_{k}", sum(counts[k].values()) if k in counts else 1, "FAIL" if k in failed else "PASS", v)
            for k, v in status.items()]
    ingests = spark.createDataFrame(rows, "check_name string, failures long, status string, detail string")
    return report.unionByName(ingests, allowMissingColumns=True)
