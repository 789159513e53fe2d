"""WIN-1 / Q-6: keep the newest row per key.

``row_number() over (partition by key order by ... desc) = 1``. Spark plans this as a
partial WindowGroupLimit *before* the shuffle and a final one after, so even a key
holding a third of all rows is cut to one row per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def _orderable(df: DataFrame, exclude) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, (ArrayType, MapType, StructType))]


def dedupe_latest(df: DataFrame, keys, order_desc, tie_break=None) -> DataFrame:
    """Keep one row per ``keys``: the greatest ``order_desc`` columns; ties broken by
    ``tie_break`` (default: every other column, descending), so the result is the
    same whatever the input order. NULLs sort last."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_desc = [order_desc] if isinstance(order_desc, str) else list(order_desc)
    if tie_break is None:
        tie_break = _orderable(df, set(keys) | set(order_desc))
    order = [F.col(c).desc_nulls_last() for c in list(order_desc) + list(tie_break)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
