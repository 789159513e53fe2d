"""A stored table whose schema grows without a rewrite of its old files (SNK-14).

Files lie below ``schema_version=n``; a version adds columns, each with a type and the value that
rows written before it shall have. A reader gets one schema whatever the age of the files: a column that a file is too old
to hold comes as its default, one that it holds comes as it is, nulls included. One scan covers all versions, and filters on
the version or the period choose folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tempora.sinks import writers
from tempora.sources import paths

VERSION_COL = "schema_version"


class EvolvingTable:
    """``versions``: for each version the columns that it adds, as {name: (type, default)}; the first
    version's defaults are not used."""

    def __init__(self, spark: SparkSession, root: str, versions: list[dict[str, tuple[str, object]]],
                 ts_col: str = "observed_at", cluster_col: str | None = None):
        names = [c for v in versions for c in v]
        if not versions or len(names) != len(set(names)):
            raise ValueError("versions add columns, each once")
        self.spark, self.root, self.versions = spark, root.rstrip("/"), versions
        self.ts_col, self.cluster_col = ts_col, cluster_col

    def columns(self, version: int | None = None) -> list[str]:
        return [c for v in self.versions[:version] for c in v]

    def append(self, df: DataFrame, version: int | None = None) -> None:
        """Append rows under the newest version, or under an older one that a late writer still has."""
        version = len(self.versions) if version is None else version
        types = {c: t for v in self.versions for c, (t, _) in v.items()}
        rows = df.select(*[F.col(c).cast(types[c]).alias(c) for c in self.columns(version)])
        laid = writers.with_layout(rows, self.ts_col, self.cluster_col).withColumn(VERSION_COL, F.lit(version))
        laid.write.mode("append").partitionBy(VERSION_COL, writers.PART_COL).parquet(self.root)

    def _value(self, name: str, since: int, kind: str, default: object) -> Column:
        old = F.col(VERSION_COL) < since
        return F.col(name) if since == 1 else F.when(old, F.lit(default).cast(kind)).otherwise(F.col(name)).alias(name)

    def read(self) -> DataFrame:
        """All rows in the newest schema."""
        ddl = ", ".join(f"`{c}` {t}" for v in self.versions for c, (t, _) in v.items())
        found = any(n.startswith(f"{VERSION_COL}=") for n in paths.folder_names(self.spark, self.root))
        if not found:
            return self.spark.createDataFrame([], ddl)
        schema = self.spark.createDataFrame([], ddl).schema.add(VERSION_COL, IntegerType()).add(writers.PART_COL, StringType())
        rows = self.spark.read.schema(schema).parquet(self.root)
        return rows.select(*[self._value(c, n, t, d) for n, v in enumerate(self.versions, 1) for c, (t, d) in v.items()])
