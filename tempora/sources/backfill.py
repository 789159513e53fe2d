"""Backfill planning (SRC-13, SRC-14): which archive ranges each location still needs.

start = day after the location's latest reading (or 1950-01-01 when it has none),
end   = the day before as_of; the range is cut into inclusive 20-day chunks.
One row per (location, chunk); the sequence is generated per location on executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.constants import BACKFILL_CHUNK_DAYS, BACKFILL_START
from tempora.functions.exprs import ntz


def last_observed(obs: DataFrame, entity="location_id", ts="observed_at") -> DataFrame:
    """SRC-13: MAX(observed_at) per location."""
    return obs.groupBy(entity).agg(F.max(ts).alias("last_observed"))


def backfill_chunks(locs: DataFrame, obs: DataFrame, as_of: str, chunk_days: int = BACKFILL_CHUNK_DAYS,
                    first_day: str = BACKFILL_START) -> DataFrame:
    """SRC-14: (location_id, chunk_start, chunk_end) still to fetch."""
    last = last_observed(obs)
    end = F.date_sub(F.to_date(ntz(as_of)), 1)
    plan = (locs.select(F.col("id").alias("location_id"))
            .join(last, "location_id", "left")
            .select("location_id",
                    F.coalesce(F.date_add(F.to_date("last_observed"), 1), F.to_date(F.lit(first_day))).alias("s"),
                    end.alias("e"))
            .filter(F.col("s") <= F.col("e")))
    step = F.expr(f"INTERVAL {chunk_days} DAYS")
    chunks = plan.select("location_id", "e", F.explode(F.sequence("s", "e", step)).alias("chunk_start"))
    return chunks.select("location_id", "chunk_start",
                         F.least(F.date_add("chunk_start", chunk_days - 1), F.col("e")).alias("chunk_end"))
