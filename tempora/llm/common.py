"""Helpers shared by the operators: scratch tables in the shared folder, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import ensure_checkpoint_dir

#: Edges up to which a round of ``components`` broadcasts its minima (16 bytes a node); beyond, the edges are shuffled to meet them.
FEW_EDGES = 200_000
#: Tasks of such a round, however many partitions a shuffle has.
FEW_TASKS = 8


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage,
    so a lost executor costs a re-read, not the work before."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected ``edges`` (u, v): every node of an edge with the
    smallest node it can reach, as (node, component).

    Alternating large-star and small-star steps: each is a minimum per node (map-side
    combined) joined back to the edges, so a node with very many edges never sits in one
    task's memory. Minima of few edges are broadcast, as a small round is mostly the fixed cost
    of its shuffles and tasks. The edge table is written after every round; the loop ends when a round
    leaves it as it was (count and checksum), a star per component.
    """
    pairs = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs, before = stored(pairs, name), None
    few = False

    def gathered(df: DataFrame) -> DataFrame:
        return df.coalesce(FEW_TASKS) if few else df

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    while True:
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return gathered(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                pairs.select("v", "v")).distinct())
        before, few = mark, mark[0] <= FEW_EDGES
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = gathered(both.groupBy("u").agg(F.min("v").alias("m"))).select(
            F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(near(low), both.u == low.w).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = large if few else large.distinct()
        low = gathered(large.groupBy("u").agg(F.min("v").alias("m"))).select(F.col("u").alias("w"), "m")
        small = large.join(near(low), large.u == low.w).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(gathered(small.union(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()), name)
