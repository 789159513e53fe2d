"""Mixing sources to target weights (operator 9) by Poisson replication. DataFrame functions only.

A source's mean repetition rate is (its target share x the target size) / its size. Every
document draws its number of copies by inverting the Poisson distribution with that mean at a
uniform number hashed from the seed and its doc_id, so the draw needs no state and is the same
on every run. Copies are exploded and the rows ordered by a second hash: a global shuffle.

The distribution is one small table row per source (the probabilities up to every count that
has a noticeable chance), so a source that holds most rows costs nothing extra: the table is
written first, so the planner knows its size, and broadcasts it only under its threshold;
beyond that the join is a sort-merge join that AQE can split.

Sizes are code points plus one a document, so empty documents and sources of them count.

Defined cases: a null source is a source of its own; a null text counts as empty and is kept
null; repeated rows draw the same count each; null doc_ids draw as the text 'null'; sources
without a target weight (or with weight 0) get no copies; an empty table gives no rows; only the
columns of documents are read, so others may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The hash's leading hexadecimal digits make a number below 2^52.
DIGITS, UNIT = 13, float(1 << 52)


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from the seed and the given columns (null: 'null')."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long") / F.lit(UNIT)


def rates(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5,
          growth: float = 1.0) -> DataFrame:
    """(source, size, rate) per source. Target weights are ``weights`` (source, weight), or the
    sizes to the ``power`` (1: as they are, 0: all equal; no weight above 0: no copies); the mix has ``growth`` times the size
    of the input."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).cast("long").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(float(power))))
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0.0, ["weight"])
    sizes = stored(sizes, "sizes")
    whole = sizes.agg(F.sum("size").alias("size"), F.max("weight").alias("most")).first()  # two scalars
    if not whole["most"]:
        return sizes.select("source", "size", F.lit(0.0).alias("rate"))
    # in parts of the largest weight, as decimals: the sum does not depend on the order of the sources
    part = F.col("weight") / F.lit(whole["most"])
    parts = float(sizes.agg(F.sum(part.cast("decimal(28,20)")).cast("double").alias("s")).first()["s"])
    rate = part / F.lit(parts) * F.lit(float(whole["size"])) * F.lit(float(growth)) / F.col("size")
    return sizes.select("source", "size", rate.alias("rate"))


def distribution(rate_table: DataFrame) -> DataFrame:
    """(source, base, cdf): cdf[i] is the chance of at most base + i copies, for all counts
    within ten standard deviations (and 40) of the rate."""
    spread = 10 * F.sqrt("rate")
    base = F.greatest(F.lit(0), F.floor(F.col("rate") - spread - 10)).cast("long")
    last = F.ceil(F.col("rate") + spread + 40).cast("long")
    per = rate_table.filter("rate > 0").select("source", "rate", base.alias("base"), last.alias("last"))
    rows = per.select("source", "rate", "base", F.explode(F.sequence("base", "last")).alias("k"))
    n = F.col("base").cast("double")
    # ln(base!) by Stirling's series, exact to double precision from 10 on; base is 0 or comes from a rate over 100
    ln_base = F.when(F.col("base") == 0, 0.0).otherwise(
        n * F.ln(n) - n + F.ln(2 * math.pi * n) / 2 + 1 / (12 * n) - 1 / (360 * n * n * n))
    order = Window.partitionBy("source").orderBy("k")
    ln_k = ln_base + F.sum(F.when(F.col("k") > F.col("base"), F.ln("k")).otherwise(0.0)).over(order)
    chance = F.exp(F.col("k") * F.ln("rate") - F.col("rate") - ln_k)
    rows = rows.withColumn("p", chance).withColumn("cdf", F.sum("p").over(order))
    return rows.groupBy("source", "base").agg(F.array_sort(F.collect_list("cdf")).alias("cdf"))


def mix(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, growth: float = 1.0,
        seed: str = "mix") -> DataFrame:
    """``docs`` (the columns of documents) with every row as often as it drew: the same columns,
    ``copy`` (from 1) and ``shuffle_key``, range-partitioned and sorted by that key."""
    docs = docs.select(*COLUMNS)
    table = stored(distribution(rates(docs, weights, power, growth)), "poisson").withColumnRenamed("source", "_s")
    drawn = docs.withColumn("_u", uniform(seed, F.col("doc_id"))).join(table, F.col("source").eqNullSafe(F.col("_s")))
    copies = F.col("base") + F.size(F.filter("cdf", lambda c: c <= F.col("_u")))
    out = drawn.withColumn("_n", copies).filter("_n > 0").select(
        *COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("copy"))
    out = out.withColumn("shuffle_key", uniform(seed + ":order", F.col("doc_id"), F.col("copy")))
    return out.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")
