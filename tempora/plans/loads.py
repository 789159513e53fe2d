"""Load scenarios over the driver data for the merge / incremental / backfill operators.

The existing table ("target") and the arriving batch are both cut from the whole
weather or economic view by observation time -- an older table and a newer,
overlapping delivery -- so every operator runs over all rows of its inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators import merge as M
from tempora.operators.dedupe import dedupe_latest
from tempora.operators.staging import stg_economic, stg_retail, stg_weather
from tempora.plans import AS_OF
from tempora.plans import incremental as I
from tempora.plans.models import Models
from tempora.session import written_once
from tempora.sinks import writers as W
from tempora.sinks.evolving import EvolvingTable
from tempora.sinks.migration import Migration
from tempora.sinks.outbox import Outbox
from tempora.sources import backfill, fixtures as fx
from tempora.streaming.streams import scratch_path, upsert_stream

KEY = ["location_id", "observed_at"]
TARGET_BEFORE = "2000-01-01 00:00:00"     # existing table: readings before this
BATCH_FROM = "1999-07-01 00:00:00"        # delivery: readings from this on (6 months overlap)
SPLIT = "1999-12-20 00:00:00"             # between the two incremental runs, within a month
ECON_BATCH_FROM = "1999-01-01 00:00:00"
BACKFILL_AS_OF = "2002-03-01 00:00:00"   # a later "today" so locations have ranges to fetch
NO_TIME, NO_PLACE = 97, 89               # every so many-th reading of the migration lacks a time, or a place
MEASURES = ["temperature_c", "wind_speed", "pressure", "humidity", "precipitation"]
TIE = ["id", "temperature_c", "wind_speed", "pressure", "humidity", "precipitation"]


def _before(df, ts):
    return df.filter(F.col("observed_at") < F.to_timestamp_ntz(F.lit(ts)))


def _from(df, ts):
    return df.filter(F.col("observed_at") >= F.to_timestamp_ntz(F.lit(ts)))


def weather_target(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_latest(_before(fx.weather_observations(spark, sf), TARGET_BEFORE), KEY, ["created_at"], TIE)


def weather_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The re-delivery carries revised temperatures (+1.0) for the overlap."""
    b = _from(fx.weather_observations(spark, sf), BATCH_FROM)
    return b.withColumn("temperature_c", F.col("temperature_c") + 1.0)


def upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1. The delivery is read twice by the merge, so its newest row per key is written first."""
    batch = M.one_per_key(weather_batch(spark, sf), KEY, ["created_at"], newest_first=True)
    return M.upsert_last_wins(weather_target(spark, sf), written_once(batch, "delivery"), KEY, MEASURES)


def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2. As above, with the first row per key."""
    batch = M.one_per_key(weather_batch(spark, sf), KEY, ["created_at"], newest_first=False)
    return M.insert_ignore(weather_target(spark, sf), written_once(batch, "delivery"), KEY)


def upsert_by_stream(spark: SparkSession, sf: str) -> DataFrame:
    """ST-5: the same delivery as ``upsert_last_wins``, brought into the stored table by a stream in two parts
    (readings before and from ``TARGET_BEFORE``), with the first part delivered a second time in between: the ledger of
    epochs makes each micro-batch count once, and a repeated delivery changes nothing."""
    root = scratch_path(spark, "upsert-stream")
    W.write_table(weather_target(spark, sf), f"{root}/table", cluster_col="location_id")
    batch = weather_batch(spark, sf)
    parts = {"1": _before(batch, TARGET_BEFORE), "2": _before(batch, TARGET_BEFORE), "3": _from(batch, TARGET_BEFORE)}
    for name, rows in parts.items():
        rows.write.parquet(f"{root}/in/{name}")
        stream = spark.readStream.schema(batch.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        upsert_stream(stream, f"{root}/table", f"{root}/checkpoint", KEY, MEASURES)
    return spark.read.parquet(f"{root}/table").select(*batch.columns)


def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    econ = fx.economic_observations(spark, sf)
    return M.merge_insert_only(_before(econ, TARGET_BEFORE), _from(econ, ECON_BATCH_FROM),
                               ["series_id", "observed_at"])


def migrate_weather(spark: SparkSession, sf: str) -> DataFrame:
    return M.normalise_weather(fx.weather_observations(spark, sf))


def migrate_economic(spark: SparkSession, sf: str) -> DataFrame:
    return M.normalise_economic(fx.economic_observations(spark, sf))


def _migration(spark: SparkSession, sf: str) -> Migration:
    """The readings, every 97th without a time and every 89th without a place, brought over in eight ranges of ids: ended
    after three, then resumed by another run."""
    obs = fx.weather_observations(spark, sf)
    damaged = obs.withColumn("observed_at", F.when(F.col("id") % NO_TIME != 0, F.col("observed_at"))).withColumn(
        "location_id", F.when(F.col("id") % NO_PLACE != 0, F.col("location_id")))
    reason = F.when(F.col("observed_at").isNull(), "no time").when(F.col("location_id").isNull(), "no place")
    root = scratch_path(spark, "migration")

    def again() -> Migration:
        return Migration(spark, root, damaged, "id", lambda df: M.normalise_weather(df, "id"), reason, ranges=8)

    again().run(most=3)
    resumed = again()
    resumed.run()
    return resumed


def migrate_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-6: the rows that an ended and resumed migration has brought over."""
    return _migration(spark, sf).migrated()


def migrate_errors(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-6: the rows that it refused, with the reason."""
    return _migration(spark, sf).errors().select("id", "reason")


def evolve_add_column(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-14: readings before ``TARGET_BEFORE`` are stored without rain, later ones with it; the table is read
    as one, rain of the old files is 0."""
    versions = [{"id": ("bigint", None), "location_id": ("bigint", None), "temperature_c": ("double", None), "observed_at": ("timestamp_ntz", None)},
                {"precipitation": ("double", 0.0)}]
    table = EvolvingTable(spark, scratch_path(spark, "evolving"), versions, cluster_col="location_id")
    obs = fx.weather_observations(spark, sf)
    table.append(_before(obs, TARGET_BEFORE), version=1)
    table.append(_from(obs, TARGET_BEFORE))
    return table.read()


def outbox_delivered(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-11: the readings from ``BATCH_FROM`` go to two sinks, the second of which fails at first: what each holds
    in the end, and how many attempts it took."""
    root, failed = scratch_path(spark, "outbox"), []
    box, batch = Outbox(spark, root), _from(fx.weather_observations(spark, sf), BATCH_FROM)

    def lines(df: DataFrame) -> None:
        if not failed:
            failed.append(1)
            raise ConnectionError("not there yet")
        df.write.mode("overwrite").json(f"{root}/lines")

    sinks = {"archive": lambda df: df.write.mode("overwrite").parquet(f"{root}/archive"), "lines": lines}
    box.deliver("readings", batch, sinks)
    if left := box.deliver("readings", batch, sinks):
        raise RuntimeError(f"not delivered: {', '.join(left)}")
    held = [spark.read.schema(batch.schema).format(kind).load(f"{root}/{name}").select(F.lit(name).alias("sink"), "location_id")
            for name, kind in (("archive", "parquet"), ("lines", "json"))]
    counts = held[0].unionByName(held[1]).groupBy("sink", "location_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(box.status("readings").select("sink", "attempts"), "sink")


def incremental_merge(spark: SparkSession, sf: str, policy: str = "global_hwm") -> DataFrame:
    """ST-2: staged target holds readings before 2000; the run stages only source rows
    past the high-water mark and upserts them on the key."""
    target = _before(Models(spark, sf).stg_weather(), TARGET_BEFORE)
    src = M.incremental_source(target, fx.weather_observations(spark, sf), "observed_at", policy,
                               entity="location_id")
    new = written_once(stg_weather(src, AS_OF), "staged")
    return M.upsert_last_wins(target, new, KEY, ["observation_date", "temperature_c", "precipitation_mm"],
                              order_cols=(), keep_cols=())


def last_observed(spark: SparkSession, sf: str) -> DataFrame:
    return backfill.last_observed(fx.weather_observations(spark, sf))


def backfill_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return backfill.backfill_chunks(fx.locations(spark, sf), fx.weather_observations(spark, sf), BACKFILL_AS_OF)


def new_locations(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: every supplier nation seen in the weather feed must exist in the dimension;
    here the dimension lacks the nations of the last region, which get new ids."""
    locs = fx.locations(spark, sf)
    known = locs.filter(F.col("country") != "MIDDLE EAST")
    return M.get_or_create(known, locs, ["latitude", "longitude"])


def incremental_marts(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-2: the retail mart after two incremental runs. The first sees the readings, indicators and sales before
    ``SPLIT``, the second the rest, appended to the raw tables; it takes the months touched only."""
    root = scratch_path(spark, "incremental")
    ledger, raw = I.Ledger(spark, f"{root}/ledger"), {n: f"{root}/raw/{n}" for n in fx.VIEWS if n != "locations"}
    for cut, as_of in ((_before, SPLIT), (_from, AS_OF)):
        rows = {name: cut(fx.VIEWS[name](spark, sf), SPLIT) for name in raw}
        ledger.changed({name: W.touched_months(df) for name, df in rows.items()})
        for name, path in raw.items():
            W.write_table(rows[name], path, mode="append")
        I.run(spark, {**raw, "locations": fx.locations(spark, sf)}, f"{root}/models", ledger, as_of)
    return spark.read.parquet(f"{root}/models/fct_monthly_retail_macro").drop(W.PART_COL)


def _incremental_by_mark(spark: SparkSession, sf: str, name: str, keys: list[str], update: list[str], stage) -> DataFrame:
    """STG-2 / STG-3: the staged table holds what was observed before 2000; only source rows past its newest
    observation are staged and merged on the key."""
    source = fx.VIEWS[name](spark, sf)
    target = stage(_before(source, TARGET_BEFORE))
    mark = _before(source, TARGET_BEFORE).agg(F.max("observed_at").alias("m")).first()["m"]  # one scalar
    new = written_once(stage(source if mark is None else source.filter(F.col("observed_at") > M.ts_literal(mark, source.schema["observed_at"].dataType))), "staged")
    return M.upsert_last_wins(target, new, keys, update, order_cols=(), keep_cols=())


def incremental_merge_economic(spark: SparkSession, sf: str) -> DataFrame:
    return _incremental_by_mark(spark, sf, "economic_observations", ["series_id", "observed_at"],
                                ["series_name", "value", "observation_date", "year_month"], stg_economic)


def incremental_merge_retail(spark: SparkSession, sf: str) -> DataFrame:
    return _incremental_by_mark(spark, sf, "retail_observations", ["observation_id"],
                                ["naics_code", "category_name", "sales_millions", "observed_date", "observed_year", "observed_month"], stg_retail)
