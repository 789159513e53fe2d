"""tempora — Spark-native analytics for long-format climate, economic and retail time series.

Layout:
  sources/    readers (landed JSON/CSV, adapter views over the driver tables, backfill planning)
  functions/  column-expression helpers and fixed lookup values
  operators/  DataFrame -> DataFrame operators (staging, dedupe, windows, streaks, pivots, merge, checks, forecast)
  plans/      the named queries and models built from operators, plus their DuckDB oracle SQL
  sinks/      writers (append, overwrite, partitioned layout, merge-and-rewrite)
  streaming/  Structured Streaming forms of the incremental operators
"""

__version__ = "0.1.0"
