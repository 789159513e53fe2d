"""Key-based merges as DataFrame set logic (SNK-1..SNK-4, SNK-12, SNK-14, ST-2).

Parquet tables have no MERGE; each operator returns the merged table as a DataFrame and
``tempora.sinks.writers.rewrite_partitions`` writes it back touching only the
partitions the batch hits. Joins are on the table's composite unique key; Spark
shuffles both sides on that key (or broadcasts the batch when the planner's size check
passes), and AQE splits skewed key partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tempora.operators.dedupe import _orderable
from tempora.session import cut_lineage


def keep_one(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def one_per_key(df: DataFrame, keys, order_cols, newest_first: bool) -> DataFrame:
    """One row per key under ``order_cols``, the remaining columns breaking ties."""
    return keep_one(df, keys, _batch_order(df, keys, order_cols, newest_first))


def _batch_order(df: DataFrame, keys, order_cols, newest_first: bool) -> list[Column]:
    order_cols = list(order_cols) + _orderable(df, set(keys) | set(order_cols))
    return [F.col(c).desc_nulls_last() if newest_first else F.col(c).asc_nulls_last() for c in order_cols]


def upsert_last_wins(target: DataFrame, batch: DataFrame, keys, update_cols, order_cols=("created_at",),
                     keep_cols=("id", "created_at")) -> DataFrame:
    """SNK-1 (INSERT .. ON CONFLICT DO UPDATE): for a key in the batch, the batch's
    ``update_cols`` replace the target's; ``keep_cols`` (row identity, creation time) stay
    from the target when the key existed. Inside the batch the newest row per key wins
    (``order_cols`` descending, remaining columns as tie-break). The target's key is unique."""
    keys = list(keys)
    b = one_per_key(batch, keys, order_cols, newest_first=True)
    kept = [c for c in target.columns if c not in keys and c not in update_cols
            and (c in keep_cols or c not in batch.columns)]
    old = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in kept], F.lit(True).alias("_in_t"))
    arrived = b.join(old, keys, "left")
    out = []
    for c in target.columns:
        if c in kept:
            fallback = F.col(c) if c in batch.columns else F.lit(None)
            out.append(F.when(F.col("_in_t"), F.col(f"_t_{c}")).otherwise(fallback).alias(c))
        else:
            out.append(F.col(c))
    untouched = target.join(b.select(*keys), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(arrived.select(*out))


def insert_ignore(target: DataFrame, batch: DataFrame, keys, order_cols=("created_at",)) -> DataFrame:
    """SNK-2 (ON CONFLICT DO NOTHING): keys already in the target are skipped; inside the
    batch the first row per key (``order_cols`` ascending) is the one inserted."""
    keys = list(keys)
    first = keep_one(batch, keys, _batch_order(batch, keys, order_cols, newest_first=False))
    return target.unionByName(inserted_rows(target, first, keys))


def inserted_rows(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Batch rows whose key is not in the target (left anti join)."""
    return batch.join(target.select(*keys), list(keys), "left_anti")


def merge_insert_only(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """SNK-4 (MERGE .. WHEN NOT MATCHED THEN INSERT): only the target is checked, so
    duplicates inside the batch are all inserted."""
    return target.unionByName(inserted_rows(target, batch.select(*target.columns), keys))


def get_or_create(dim: DataFrame, candidates: DataFrame, natural_key, id_col: str = "id") -> DataFrame:
    """SNK-3: members of ``candidates`` missing from ``dim`` (by natural key) get new
    surrogate ids max(id)+1, +2, .. in natural-key order; returns the new members.

    Consecutive ids without a single-partition window over the members: they are range
    partitioned on the natural key and checkpointed (so partition numbers are fixed), numbered
    within their partition, and offset by the counts of the partitions before (one row each)."""
    natural_key = list(natural_key)
    others = [c for c in candidates.columns if c != id_col]
    first = one_per_key(candidates.select(*others), natural_key, (), newest_first=False)
    new = first.join(dim.select(*natural_key), natural_key, "left_anti").select(*others)
    parts = cut_lineage(new.repartitionByRange(*natural_key).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    top = dim.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("top")).first()["top"]  # one scalar
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*natural_key))
    numbered = parts.withColumn("_rank", rank).join(before, "_part")
    return numbered.withColumn(id_col, F.lit(top) + F.col("_before") + F.col("_rank")).select(*candidates.columns)


def add_missing_columns(df: DataFrame, columns: dict) -> DataFrame:
    """SNK-14: add absent columns as typed NULLs (ADD COLUMN IF NOT EXISTS)."""
    for name, dtype in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(dtype))
    return df


def iso_text(ts) -> Column:
    """ISO-8601 text of a timestamp ('YYYY-MM-DDTHH:MM:SS', fraction only when non-zero)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))


def normalise_weather(df: DataFrame, *keep: str) -> DataFrame:
    """SNK-12 (weather): warehouse row shape, ISO timestamps, and the columns to ``keep`` as they are."""
    return df.select(*keep, "location_id", "temperature_c", "wind_speed", "pressure", "humidity", "precipitation",
                     iso_text("observed_at").alias("observed_at"), iso_text("created_at").alias("created_at"))


def normalise_economic(df: DataFrame) -> DataFrame:
    """SNK-12 (economic): NULL name -> '', value as double, ISO timestamp."""
    return df.select("series_id", F.coalesce(F.col("series_name"), F.lit("")).alias("series_name"),
                     F.col("value").cast("double").alias("value"), iso_text("observed_at").alias("observed_at"))


# ------------------------------------------------------------------ incremental load (ST-2)

def ts_literal(value, dtype) -> Column:
    """A literal of the column's own timestamp type (NTZ stays NTZ, no zone shift)."""
    if isinstance(dtype, TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))
    return F.lit(value)


def high_water_mark(target: DataFrame, ts: str):
    """MAX(ts) of the target as a driver-side scalar (one value): used as a literal, so
    the source filter is pushed down to the Parquet scan."""
    return target.agg(F.max(ts).alias("hwm")).first()["hwm"]


def incremental_source(target: DataFrame, src: DataFrame, ts: str, policy: str = "global_hwm",
                       entity: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows of ``src`` to process in an incremental run.

    global_hwm  (source behaviour) only rows newer than the target's overall MAX(ts);
                late rows for any key are dropped. Empty target -> full load.
    per_key_hwm rows newer than their own entity's MAX(ts) (a join on the entity).
    watermark   rows newer than MAX(ts) - delay (e.g. '2 days'); the merge then
                upserts the re-read overlap."""
    if policy == "per_key_hwm":
        marks = target.groupBy(entity).agg(F.max(ts).alias("_hwm"))
        j = src.join(marks, entity, "left")
        return j.filter(F.col("_hwm").isNull() | (F.col(ts) > F.col("_hwm"))).drop("_hwm")
    hwm = high_water_mark(target, ts)
    if hwm is None:
        return src
    mark = ts_literal(hwm, src.schema[ts].dataType)
    if policy == "watermark":
        mark = mark - F.expr(f"INTERVAL {delay or '1 day'}")
    elif policy != "global_hwm":
        raise ValueError(f"unknown policy {policy}")
    return src.filter(F.col(ts) > mark)
