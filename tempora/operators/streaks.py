"""UDF-1 / Q-5, Q-22, Q-23: longest run of consecutive calendar days whose daily mean
satisfies a comparison (gaps-and-islands).

Plan: aggregate to one row per (location, day) -> keep qualifying days ->
row_number per location by day -> island id = day - row_number -> count per island ->
max per location. The only window is per location over *daily* rows, so a location's
partition is bounded by its number of calendar days whatever the raw row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.exprs import exact_avg

COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def streak_lengths(daily: DataFrame, entity="location_id", date_col="observation_date") -> DataFrame:
    """One row per (entity, island) with its length, from rows of qualifying days."""
    w = Window.partitionBy(entity).orderBy(date_col)
    islands = daily.select(entity, F.date_sub(F.col(date_col), F.row_number().over(w)).alias("grp"))
    return islands.groupBy(entity, "grp").agg(F.count(F.lit(1)).alias("streak_length"))


def longest_streak(obs: DataFrame, locs: DataFrame, value: str, op: str, target,
                   keep_all: bool = False, out: str = "longest_streak",
                   entity="location_id", ts="observed_at", date_col="observation_date") -> DataFrame:
    """Longest streak of days with ``avg(value) <op> target``.

    keep_all=False: only locations having at least one qualifying day, left-joined to
    the dimension -> (location_id, name, out).
    keep_all=True: every location of the dimension, 0 when none -> (name, out)."""
    if op not in COMPARISONS:
        raise ValueError(f"operator must be one of {sorted(COMPARISONS)}")
    day = F.col(date_col) if date_col in obs.columns else F.to_date(ts)
    daily = (obs.groupBy(entity, day.alias(date_col)).agg(exact_avg(value).alias(value))
             .filter(COMPARISONS[op](F.col(value), F.lit(target))))
    best = streak_lengths(daily, entity, date_col).groupBy(entity).agg(F.max("streak_length").alias("_best"))
    dim = locs.select(F.col("id"), F.col("name"))
    if keep_all:
        joined = dim.join(best, dim.id == best[entity], "left")
        return joined.select("name", F.coalesce(F.col("_best"), F.lit(0)).cast("long").alias(out))
    joined = best.join(dim, best[entity] == dim.id, "left")
    return joined.select(entity, "name", F.coalesce(F.col("_best"), F.lit(0)).cast("long").alias(out))
