"""Secret scans (operator 1) with an incremental blob ledger.

Every version of every document is content-addressed (SHA-256 of its text). The ledger is a
table of (blob, rule, version, spans): a row for each blob and rule version that was ever
scanned, clean ones included. ``scan`` finds the pairs that the ledger lacks, reads one copy of
each such blob, scans it with the missing rules only and appends the rows; ``findings`` joins
the ledger back to all paths. A new version of one rule rescans with that rule alone; unchanged
content is never scanned again, however many paths or versions share it.

Spans are (kind, start, end): code points of the whole match, end exclusive, leftmost and
non-overlapping for each kind; matches whose checked group is too short are dropped.

Defined cases: a null text is the empty text; repeated rows each get their blob's findings;
null keys are keys like others; texts of any length are scanned whole; an empty table gives no
rows and leaves the ledger as it is; columns other than the keys and the text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import stored

#: Unseen blobs, at most, whose list is sent to every task.
FEW = 200_000
LEDGER = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, its least length, and lower-case strings of
    which any match holds one (a cheap test; none: always scan)."""
    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    needs: tuple[str, ...] = ()


# The kinds of secrets, in the order they are listed.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, False, ("akia",)),
    # runs are maximal, so the bound may stand in the pattern
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)


@lru_cache(maxsize=64)
def _compiled(rule: Rule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))


def spans_of(text: str, rule: Rule, lowered: str | None = None) -> list[tuple[int, int]]:
    """Spans of one rule in a whole text."""
    if rule.needs:
        lowered = text.lower() if lowered is None else lowered
        if not any(word in lowered for word in rule.needs):
            return []
    return [m.span() for m in _compiled(rule).finditer(text) if len(m.group(rule.group)) >= rule.least]


def _scan(batches, rules: dict[str, Rule]):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    seen = set()  # rows that repeat a key and a blob meet in one partition
    for batch in batches:
        rows = []
        for blob, missing, text in zip(batch.column("blob"), batch.column("missing"), batch.column("text")):
            content, blob = text.as_py() or "", blob.as_py()
            if blob in seen:
                continue
            seen.add(blob)
            lowered = content.lower()
            for name in missing.as_py():
                rule = rules[name]
                rows.append((blob, name, rule.version,
                             [{"start": a, "end": b} for a, b in spans_of(content, rule, lowered)]))
        types = [pa.binary(), pa.string(), pa.int32(), span]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                         names=["blob", "rule", "version", "spans"])


def _blob(content: str):
    return F.unhex(F.sha2(F.coalesce(F.col(content), F.lit("")), 256)).alias("blob")


def addressed(versions: DataFrame, keys: list[str], content: str = "text") -> DataFrame:
    """Every version's keys and blob, written once (32 bytes a version)."""
    return stored(versions.select(*keys, _blob(content)), "paths")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger; an empty one is made where none is."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def by_broadcast(unseen: int, versions: int) -> bool:
    """An incremental run: few of the versions, and few enough (some 100 bytes each) to send to every task."""
    return unseen <= FEW and unseen * 10 <= versions


def scan(versions: DataFrame, paths: DataFrame, ledger: str, keys: list[str], content: str = "text",
         rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the pairs of blob and rule version that the ledger lacks, and append them.

    One copy of each such blob is picked by its smallest key (map-side combined, so thousands of
    copies are one row a task), and only picked rows are joined back to the texts. Where few blobs are unseen (``by_broadcast``)
    their list goes to the texts, otherwise both are shuffled; without an unseen blob no text is read.
    """
    known = read_ledger(versions.sparkSession, ledger).select("blob", "rule", "version")
    offered = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
    picked = paths.groupBy("blob").agg(F.min(F.struct(*keys)).alias("key"))
    unseen = picked.select("blob", "key", offered.alias("r")).select("blob", "key", "r.*").join(
        known, ["blob", "rule", "version"], "left_anti")
    todo = unseen.groupBy("blob", "key").agg(F.collect_set("rule").alias("missing")).select(
        F.col("blob").alias("b"), *[F.col("key")[k].alias(f"_k{i}") for i, k in enumerate(keys)], "missing")
    todo = stored(todo, "unseen")
    new = todo.count()
    if not new:
        return
    todo = todo.hint("broadcast" if by_broadcast(new, paths.count()) else "shuffle_hash")
    texts = versions.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], F.col(content).alias("text"), _blob(content))
    same = F.col("blob") == F.col("b")
    for i in range(len(keys)):
        same = same & F.col(f"_t{i}").eqNullSafe(F.col(f"_k{i}"))
    rows = texts.join(todo, same).select("blob", "missing", "text").mapInArrow(
        partial(_scan, rules={r.name: r for r in rules}), LEDGER)
    rows.write.mode("append").parquet(ledger)


def findings(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths`` with ``spans``: all findings of its blob under the current rule versions, as
    (start, order of the kind, end, kind), sorted."""
    current = F.lit(False)
    order = F.lit(0)
    for i, r in enumerate(rules):
        current = current | ((F.col("rule") == r.name) & (F.col("version") == r.version))
        order = F.when(F.col("rule") == r.name, i).otherwise(order)
    rows = read_ledger(paths.sparkSession, ledger).filter(current & (F.size("spans") > 0)).withColumn("o", order)
    spans = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.col("o").alias("o"), s["end"].alias("end"), F.col("rule").alias("kind")))
    by_blob = rows.select("blob", spans.alias("spans")).groupBy("blob").agg(  # a row a rule, at most
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"))
    return paths.join(by_blob, "blob", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<start:int,o:int,end:int,kind:string>>")))


def _masked(batches, mask: str):
    for batch in batches:
        texts, masked = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist()):
            if spans:
                out, at = [], 0
                for s in spans:
                    if s["end"] > at:  # spans of two kinds may overlap
                        out += [text[at:s["start"]], mask] if s["start"] >= at else []
                        at = s["end"]
                text = "".join(out) + text[at:]
            texts.append(text)
            masked.append(len(spans or ()))
        kept = [i for i, n in enumerate(batch.schema.names) if n not in ("text", "_spans")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), *[batch.column(i) for i in kept], pa.array(masked, pa.int32())],
            names=["text", *[batch.schema.names[i] for i in kept], "masked"])


def redact(docs: DataFrame, found: DataFrame, keys: list[str], mask: str = "[secret]") -> DataFrame:
    """``docs`` (with ``text``) with every span of ``found`` (keys, blob, spans) masked, and
    ``masked``, their number (in place of a column of that name); every document stays, with its other columns,
    whatever their names (but for those that begin with ``_``)."""
    docs = docs.drop("masked")
    hits = found.filter(F.size("spans") > 0).select(*keys, "blob", "spans").dropDuplicates([*keys, "blob"])
    b = hits.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("blob").alias("_b"), F.col("spans").alias("_spans"))
    a = docs.select("*", _blob("text").alias("_blob"))
    same = F.col("_blob") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    both = a.join(b.hint("shuffle_hash"), same, "left").select(*docs.columns, "_spans")
    names = ["text", *[c for c in docs.columns if c != "text"]]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return both.mapInArrow(partial(_masked, mask=mask), schema + ", masked int").select(*docs.columns, "masked")
