"""Period aggregates, top periods, before/after split (Q-3, Q-7..Q-16, Q-33..Q-35).

Facts are aggregated by location id first and only then joined to the location
dimension for names: the join sees one row per group instead of one per reading.
(Location id is the dimension's primary key, so this equals join-then-group.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.exprs import exact_avg, exact_sum

PERIODS = {
    "year": lambda ts: [F.year(ts).alias("year")],
    "month": lambda ts: [F.year(ts).alias("year"), F.month(ts).alias("month")],
    "day": lambda ts: [F.to_date(ts).alias("observation_date")],
}


def with_city(agg: DataFrame, locs: DataFrame, entity="location_id", name_as="city") -> DataFrame:
    """Inner join of per-location results to the dimension for the location name."""
    dim = locs.select(F.col("id").alias(entity), F.col("name").alias(name_as))
    return agg.join(dim, entity, "inner")


def period_agg(obs: DataFrame, locs: DataFrame | None, period: str, value: str, agg: str = "avg",
               fill=None, out: str | None = None, entity="location_id", ts="observed_at") -> DataFrame:
    """Mean or total of ``value`` per location and period (year | month | day).
    ``fill`` replaces an all-NULL group's result (COALESCE over the aggregate)."""
    fn = {"avg": exact_avg, "sum": exact_sum}[agg]
    res = fn(value)
    if fill is not None:
        res = F.coalesce(res, F.lit(fill).cast("double"))
    out = out or f"{agg}_{value}"
    keys = ([entity] if entity else []) + PERIODS[period](F.col(ts))
    grouped = obs.groupBy(*keys).agg(res.alias(out))
    return with_city(grouped, locs, entity) if locs is not None else grouped


def top_periods(obs: DataFrame, period: str, value: str, agg: str, n: int = 10, out: str | None = None,
                nulls_first: bool = True, ts="observed_at") -> DataFrame:
    """Top-n periods by an aggregate, descending (NULLs first as in the source database).
    Ties are broken by the period so the cut is deterministic. Planned as a distributed
    TakeOrderedAndProject (partial top-n per partition)."""
    out = out or f"{agg}_{value}"
    fn = {"avg": exact_avg, "sum": exact_sum}[agg]
    keys = PERIODS[period](F.col(ts))
    g = obs.groupBy(*keys).agg(fn(value).alias(out))
    order = F.col(out).desc_nulls_first() if nulls_first else F.col(out).desc_nulls_last()
    period_cols = [f.name for f in g.schema.fields if f.name != out]
    return g.orderBy(order, *period_cols).limit(n)


def split_mean(obs: DataFrame, value: str, cut: str, after: bool, ts="observed_at", out="avg_temp") -> DataFrame:
    """Global mean on one side of a cut timestamp (>= cut if after, else < cut); the range
    predicate is pushed to the Parquet scan."""
    cond = F.col(ts) >= F.to_timestamp_ntz(F.lit(cut)) if after else F.col(ts) < F.to_timestamp_ntz(F.lit(cut))
    return obs.filter(cond).agg(exact_avg(value).alias(out))


def before_after(obs: DataFrame, value: str = "temperature_c", cut: str = "2000-01-01 00:00:00",
                 labels=("2000_and_after", "before_2000"), ts="observed_at", out="avg_temp") -> DataFrame:
    """Both sides as two labelled rows from one pass (an empty side still gives a NULL row)."""
    after = F.col(ts) >= F.to_timestamp_ntz(F.lit(cut))
    sides = obs.agg(exact_avg(F.when(after, F.col(value))).alias("a"), exact_avg(F.when(~after, F.col(value))).alias("b"))
    return sides.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("period"), F.col(side).alias(out)) for label, side in zip(labels, "ab")])))
