"""Window operators: rolling mean (WIN-5, Q-1) and period-over-period change (WIN-3/4, Q-2, Q-4).

Both run after an aggregation to one row per entity and day/year/month, so every
window partition is bounded by the calendar (days per location), not by raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.exprs import DEC, exact_avg, safe_pct_change


def daily_mean(obs: DataFrame, entity="location_id", ts="observed_at", value="temperature_c",
               out="avg_temp", date_col="observation_date") -> DataFrame:
    return obs.groupBy(entity, F.to_date(ts).alias(date_col)).agg(exact_avg(value).alias(out))


def rolling_avg(obs: DataFrame, entity="location_id", ts="observed_at", value="temperature_c",
                rows: int = 30, only=None, calendar: bool = False, out="rolling_avg") -> DataFrame:
    """Daily mean per entity, then the mean of the last ``rows`` daily rows (gaps in the
    calendar are skipped, as a ROWS frame does). ``calendar=True`` uses the last ``rows``
    calendar days instead (RANGE frame). ``only`` restricts to one entity (pushed to the scan).

    The frame mean is a decimal sum over the frame / count, so it does not depend on how
    the engine accumulates the frame."""
    if only is not None:
        obs = obs.filter(F.col(entity) == only)
    daily = daily_mean(obs, entity, ts, value, "avg_temp")
    if calendar:
        w = (Window.partitionBy(entity).orderBy(F.unix_date("observation_date"))
             .rangeBetween(-(rows - 1), 0))
    else:
        w = Window.partitionBy(entity).orderBy("observation_date").rowsBetween(-(rows - 1), 0)
    frame_sum = F.sum(F.col("avg_temp").cast(DEC)).over(w).cast("double")
    frame_n = F.count("avg_temp").over(w).cast("double")
    return daily.select(entity, "observation_date", F.try_divide(frame_sum, frame_n).alias(out))


def period_change(df: DataFrame, entity, order_cols, value, lag: int = 1, pct: bool = False,
                  scale: float = 100.0, out="change") -> DataFrame:
    """value - LAG(value, lag) per entity ordered by ``order_cols`` (rows, not calendar).
    ``pct=True`` gives (value - prev) / prev * scale with NULL on a zero divisor.
    ``entity=None`` is one global series (only for inputs of one row per period)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    w = Window.orderBy(*order_cols) if entity is None else Window.partitionBy(entity).orderBy(*order_cols)
    prev = F.lag(value, lag).over(w)
    expr = safe_pct_change(F.col(value), prev, scale) if pct else F.col(value) - prev
    return df.withColumn(out, expr)
