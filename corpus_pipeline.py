"""The corpus pipeline: language ID, near-duplicate removal, secret scans, mixing, packing.

``STAGES`` are (name, function) in order; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and reread as the next one's docs. All but the last
return the columns of documents.

* language_id drops documents without a language (null, empty or letterless texts);
* near_duplicates keeps one document, that of the smallest doc_id, of every group (five-word
  shingles, similarity 0.8 or more); repeated rows of one doc_id and text count as copies, documents without a doc_id
  are kept all;
* secrets masks every secret in the text and keeps all documents;
* mix draws copies so that the sources meet their target weights (sizes to the power 0.5);
* packing cuts and packs what is left into sequences of 2048 tokens, which are written to the shared
  folder; the rows of ``run`` are their pieces, with the CRC-32 of the ids read back.

Every stage reads the columns of documents only, so others may have any name; takes whole texts of any length; and
gives no rows for an empty table. Defined cases by stage:

* language_id: nulls in doc_id, lang or source stay; ties go to the smaller language; rows that repeat are each kept or dropped;
* near_duplicates: null and empty texts (there are none after language_id) are copies of nothing but rows of their own doc_id and text;
  of rows that repeat a doc_id and text the smallest lang, source and n_chars stays (null first);
* secrets: null texts stay null; a doc_id's rows are masked each by its own text; overlapping findings are masked as one;
* mix: a null source is a source; rows that repeat a doc_id draw the same number of copies each; ties of the shuffle go by doc_id and copy;
* packing: null texts have the end id only; copies are packed each.

SQL cannot express the profiles, hashing and packing, so ``ORACLE_SQL`` is None; the stages' operators
are tested against brute-force versions, the stages on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import minmax_dedup, nnls_packing, poisson_mix, rank_langid, secret_ledger
from tempora.llm.common import scratch, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    profiles = rank_langid.learn(docs.filter(F.col("doc_id").isNotNull() & ~rank_langid.held_out()))
    named = rank_langid.predict(docs, profiles, keep_text=True)
    # without anything to learn from no document has a language to miss
    return (named.filter(F.col("lang_pred") != rank_langid.UNKNOWN) if profiles else docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = stored(minmax_dedup.near_duplicates(docs, words=5, percent=80).filter("doc_id IS NOT NULL"), "near")
    left = docs.join(found.filter("NOT kept").select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_anti")
    if not found.groupBy("doc_id").count().filter("count > 1").isEmpty():  # rows that repeat
        nameless = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())  # rows without a doc_id are copies of nothing
        rest = F.min(F.struct("lang", "source", "n_chars")).alias("rest")  # one of them, the same on every run
        left = left.withColumn("_own", nameless).groupBy("doc_id", "text", "_own").agg(rest).select("doc_id", "text", "rest.*")
    return left.select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, ledger = docs.select(*COLUMNS), scratch(spark, "ledger")
    paths = secret_ledger.addressed(docs, ["doc_id"])
    secret_ledger.scan(docs, paths, ledger, ["doc_id"])
    clean = secret_ledger.redact(docs, secret_ledger.findings(paths, ledger), ["doc_id"])
    n_chars = F.when(F.col("masked") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson_mix.mix(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sequences")
    nnls_packing.write_sequences(nnls_packing.pack(nnls_packing.cut(docs)), path)
    return nnls_packing.sequence_digest(spark, path)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
