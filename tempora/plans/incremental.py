"""Incremental model runs (UDF-2, SNK-13, STG-2, STG-3): a run reads and writes the months that changed.

Tables are partitioned by month. Whoever changes a table says which months in the *change ledger* (commit,
table, month; month ``*`` is everything); every model keeps a *mark*, the commit up to which it has
taken its upstream changes. A run visits the models in order of dependency. A model's months
are those its upstream tables changed since its mark; it reads them alone, replaces them alone, and enters
them in the ledger for the models below. The mark is written last: a run that ends in the middle leaves the
marks of unfinished models behind, and the next run takes their months again (replacing is repeatable).

Kinds of models: ``months`` (a month needs the same month upstream), ``lagged`` (a month also needs the
rows before it, so a change reaches the rows after it as well), ``whole`` (rebuilt from its upstream tables
when anything changed; its inputs are the small monthly and daily tables).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.constants import FUTURE_TOLERANCE_DAYS
from tempora.functions.exprs import ntz, year_month
from tempora.operators import staging
from tempora.operators.streaks import longest_streak
from tempora.plans import models as MD
from tempora.sinks.writers import PART_COL
from tempora.sources import paths

ALL = "*"
LEDGER = "commit long, table string, month string, as_of string"
#: Rows that the year-over-year comparison looks back.
LAG = 12


@dataclass(frozen=True)
class Model:
    deps: tuple[str, ...]
    build: Callable[..., DataFrame]
    kind: str = "months"
    month: Column | None = None
    horizon: bool = False  # takes rows up to the run's time, so time itself changes it


def _streaks(daily: DataFrame, locs: DataFrame) -> DataFrame:
    days = daily.select("location_id", F.col("observed_at_date").alias("observation_date"), F.col("avg_daily_temp_c").alias("temperature_c"))
    return longest_streak(days, locs, "temperature_c", "<", 0, out="longest_subzero_streak")


def graph() -> dict[str, Model]:
    """The models in order of dependency."""
    return {
        "stg_weather_observations": Model(("weather_observations",), lambda a, w: staging.stg_weather(w, a), month=year_month("observed_at"), horizon=True),
        "stg_economic_observations": Model(("economic_observations",), lambda a, e: staging.stg_economic(e), month=F.col("year_month")),
        "stg_retail_observations": Model(("retail_observations",), lambda a, r: staging.stg_retail(r), month=year_month("observed_date")),
        "stg_locations": Model(("locations",), lambda a, l: staging.stg_locations(l), "whole"),
        "int_monthly_weather_aggregates": Model(("stg_weather_observations",), lambda a, w: MD.monthly_weather(w), month=F.col("year_month")),
        "int_weather_daily": Model(("stg_weather_observations",), lambda a, w: MD.weather_daily(w), month=year_month("observed_at_date")),
        "int_economic_indicators_pivoted": Model(("stg_economic_observations",), lambda a, e: MD.economic_pivot(e), month=F.col("year_month")),
        "int_retail_pivoted": Model(("stg_retail_observations",), lambda a, r: MD.retail_pivot(r), "lagged",
                                    F.format_string("%d-%02d", "observed_year", "observed_month")),
        "fct_location_climate_summary": Model(
            ("stg_locations", "int_monthly_weather_aggregates", "int_weather_daily"),
            lambda a, l, m, d: MD.location_climate_summary(l, m, _streaks(d, l)), "whole"),
        "fct_monthly_macro_weather": Model(
            ("int_monthly_weather_aggregates", "int_economic_indicators_pivoted", "stg_locations"),
            lambda a, m, e, l: MD.monthly_macro_weather(m, e, l), month=F.col("year_month")),
        "fct_monthly_retail_macro": Model(("fct_monthly_macro_weather", "int_retail_pivoted"),
                                          lambda a, w, r: MD.monthly_retail_macro(w, r), month=F.col("year_month")),
    }


class Change(NamedTuple):
    """A month of a table that a commit changed."""
    commit: int
    table: str
    month: str


class Mark(NamedTuple):
    """The commit up to which a model has taken its upstream changes, and the time it was built for."""
    commit: int
    as_of: str


class Ledger:
    """The change ledger and the marks: one small append-only table under ``root``. What belongs to one
    event is one append, so it is there as a whole or not at all."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/ledger"

    def read(self) -> tuple[list[Change], dict[str, Mark]]:
        """All changes (bounded by runs and calendar months), and the newest mark of every model."""
        rows = self.spark.read.schema(LEDGER).json(self.path).collect() if paths.exists(self.spark, self.path) else []
        marks = {r.table: Mark(r.commit, r.as_of) for r in sorted(rows, key=lambda r: r.commit) if r.as_of}
        return [Change(r.commit, r.table, r.month) for r in rows if r.month], marks

    def next_commit(self) -> int:
        changes, marks = self.read()
        return 1 + max([c.commit for c in changes] + [m.commit for m in marks.values()], default=0)

    def _append(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").json(self.path)

    def changed(self, tables: dict[str, list[str]]) -> None:
        """Say that months of tables change; called before they are written, and again when a write is repeated."""
        if any(tables.values()):
            commit = self.next_commit()
            self._append([(commit, t, m, None) for t, months in tables.items() for m in sorted(months)])

    def built(self, model: str, months, commit: int, as_of: str) -> None:
        """Say that a model has replaced some months, and has taken all changes up to ``commit``."""
        self._append([(commit, model, m, None) for m in sorted(months)] + [(commit, model, None, as_of)])


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Months that a table has, from its folders alone."""
    return [n.partition("=")[2] for n in paths.folder_names(spark, path) if n.startswith(f"{PART_COL}=")]


def _read(spark: SparkSession, table, months: set[str] | None) -> DataFrame:
    """A table's rows of some months (all: None); a DataFrame stands for itself."""
    if isinstance(table, DataFrame):
        return table
    df = spark.read.parquet(table)
    if PART_COL not in df.columns:
        return df
    kept = df if months is None else df.filter(F.col(PART_COL).cast("string").isin(sorted(months)))
    return kept.drop(PART_COL)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A model's table as a whole, without its partition column."""
    return _read(spark, path, None)


def _write_months(df: DataFrame, month: Column, months: set[str], path: str) -> None:
    out = df.withColumn(PART_COL, month).filter(F.col(PART_COL).isin(sorted(months)))
    first = next(c for c in df.columns if c != PART_COL)
    # rebalanced: a large month is split over tasks, small ones share one
    out.hint("rebalance", PART_COL).sortWithinPartitions(PART_COL, first).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PART_COL).parquet(path)


def _months_between(first: str, last: str) -> set[str]:
    (y, m), end, out = (int(x) for x in first.split("-")[:2]), last[:7], set()
    while f"{y:04d}-{m:02d}" <= end:
        out.add(f"{y:04d}-{m:02d}")
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return out


def run(spark: SparkSession, sources: dict, out: str, ledger: Ledger, as_of: str) -> dict[str, set[str]]:
    """Bring every model under ``out`` up to date. ``sources`` names the raw tables: a path of a
    month-partitioned table, or a DataFrame (a dimension). Returns the months each model replaced
    (``*``: the whole table). The run's time may not go back, as rows would have to leave models."""
    models, tables, done = graph(), dict(sources), {}
    changes, marks = ledger.read()
    commit = 1 + max([c.commit for c in changes] + [m.commit for m in marks.values()], default=0)
    tables |= {name: f"{out.rstrip('/')}/{name}" for name in models}
    for name, model in models.items():
        mark, path = marks.get(name), tables[name]
        dirty = {c.month for c in changes if c.table in model.deps and (mark is None or c.commit > mark.commit)}
        partitioned = [d for d in model.deps if not isinstance(tables[d], DataFrame) and models.get(d, model).kind != "whole"]
        if mark is None:
            dirty.add(ALL)
        elif mark.as_of > as_of:
            raise ValueError(f"{name} has been built as of {mark.as_of}")
        elif model.horizon:
            until = [spark.range(1).select(F.timestamp_add("DAY", F.lit(FUTURE_TOLERANCE_DAYS), ntz(a)).cast("string")).first()[0]
                     for a in (mark.as_of, as_of)]
            dirty |= _months_between(*until) & set(stored_months(spark, tables[model.deps[0]])) if until[0] != until[1] else set()
        if dirty:
            done[name] = _build(spark, model, tables, partitioned, dirty, path, as_of)
            changes += [Change(commit, name, m) for m in done[name]]
        if dirty or mark.as_of != as_of:
            ledger.built(name, done.get(name, ()), commit, as_of)
    return done


def _build(spark, model: Model, tables: dict, partitioned: list[str], dirty: set[str], path: str, as_of: str) -> set[str]:
    if model.kind == "whole":
        model.build(as_of, *[_read(spark, tables[d], None) for d in model.deps]).write.mode("overwrite").parquet(path)
        return {ALL}
    have = sorted({m for d in partitioned for m in stored_months(spark, tables[d])})
    months = set(have) if ALL in dirty else dirty & set(have)
    needed = months
    if model.kind == "lagged":
        at = {m: k for k, m in enumerate(have)}
        months = {have[j] for m in months for j in range(at[m], min(at[m] + LAG + 1, len(have)))}
        needed = {have[j] for m in months for j in range(max(at[m] - LAG, 0), at[m] + 1)}
    if months:
        inputs = [_read(spark, tables[d], needed if d in partitioned else None) for d in model.deps]
        _write_months(model.build(as_of, *inputs), model.month, months, path)
    return months
