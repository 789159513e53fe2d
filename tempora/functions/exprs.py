"""Column-expression helpers. All are built-in Spark expressions (JVM side, codegen'd).

Float discipline: sums of non-integer doubles depend on summation order, and the
results are compared value-for-value across engines. Where a measure is not
integer-valued, sums go through a fixed-scale decimal so the answer does not depend
on partitioning; rounding goes through a decimal so ties round half away from zero
on the decimal value the user sees (2.345 -> 2.35), whatever the binary double is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC = "decimal(38,10)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_month(ts) -> Column:
    """'YYYY-MM' string of a timestamp/date (sorts lexically)."""
    return F.date_format(_c(ts), "yyyy-MM")


def month_start(ts) -> Column:
    """First day of the month as TIMESTAMP_NTZ (time-zone independent)."""
    return F.trunc(F.to_date(_c(ts)), "MM").cast("timestamp_ntz")


def round_half_up(col, digits: int = 2) -> Column:
    return F.round(_c(col).cast(DEC), digits).cast("double")


def exact_sum(col) -> Column:
    """Order-independent sum of a double measure (fixed 10-digit scale)."""
    return F.sum(_c(col).cast(DEC)).cast("double")


def exact_avg(col) -> Column:
    """Order-independent mean: decimal sum / non-null count, NULL on no input."""
    return F.try_divide(exact_sum(col), F.count(_c(col)).cast("double"))


def safe_pct_change(cur, prev, scale: float = 100.0) -> Column:
    """(cur - prev) / prev * scale; NULL on a zero or NULL divisor."""
    return F.try_divide(_c(cur) - _c(prev), _c(prev)) * F.lit(scale)


def ntz(ts: str) -> Column:
    """A TIMESTAMP_NTZ literal from 'YYYY-MM-DD HH:MM:SS'."""
    return F.to_timestamp_ntz(F.lit(ts))
