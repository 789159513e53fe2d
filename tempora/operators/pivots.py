"""Conditional pivots (AGG-5 / AGG-6, Q-17, Q-19).

``missing=None``: MAX(CASE WHEN code = c THEN v END) -> NULL when a code is absent.
``missing=0``:    SUM(CASE WHEN code = c THEN v ELSE 0 END) -> 0 when absent.
Spark's ``pivot()`` always gives NULL for absent cells, so the zero form is written out.
Both are single-pass hash aggregations with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_values(df: DataFrame, by, code_col: str, value_col: str, mapping: dict,
                 agg: str = "max", missing=None) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    cols = []
    for code, name in mapping.items():
        hit = F.col(code_col) == code
        cell = F.when(hit, F.col(value_col)) if missing is None else \
            F.when(hit, F.col(value_col)).otherwise(F.lit(missing))
        fn = {"max": F.max, "sum": F.sum}[agg]
        cols.append(fn(cell).alias(name))
    return df.groupBy(*by).agg(*cols)
