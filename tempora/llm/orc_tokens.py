"""Token-ID output (operator 10): ids of whole texts in ORC files, in ascending doc_id order.

Files hold one row per document: integer run-length encoded id lists, row indexes and a
Bloom filter on ``doc_id``. Stripes are read in parallel; a lookup by doc_id skips files,
stripes and row groups by their statistics and Bloom filters.

Defined cases: null or empty text is the end id alone; null doc_ids come first in the
order; repeated rows are kept, each with its own place; an empty table gives no rows; only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.tokens import default_tokenizer, encoder

FILE_SCHEMA = "part int, doc_id long, before long, n_ids long, ids array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(64 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
#: Ids of a batch that goes back to Spark.
BATCH_IDS = 2_000_000


def _encode(batches, tokenizer: str, end_id: int):
    """Rows of one sorted partition: ids, and how many ids the partition holds before them."""
    enc, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
    end = np.array([end_id], dtype="<u4").tobytes()

    def packed(rows):
        ids = np.frombuffer(b"".join(r[2] for r in rows), dtype="<i4")
        sizes = np.array([len(r[2]) // 4 for r in rows])
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.int64()), pa.array(sizes, pa.int64()), lists],
            names=["part", "doc_id", "before", "n_ids", "ids"])

    rows, held = [], 0
    for batch in batches:
        texts = (text.as_py() for text in batch.column("text"))
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.each(texts)):
            ids += end
            rows.append((doc_id, before, ids))
            before += len(ids) // 4
            held += len(ids) // 4
            if held >= BATCH_IDS:
                yield packed(rows)
                rows, held = [], 0
    if rows:
        yield packed(rows)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Write the ids of every document of ``docs`` (doc_id, text) to ORC files under ``path``.

    The texts, smaller than their ids, are what is shuffled: one range exchange on doc_id
    (a row number breaks ties, so repeated ids spread over partitions), then each partition is
    encoded and written in order.
    """
    keyed = docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row").asc()]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    run = partial(_encode, tokenizer=tokenizer or default_tokenizer(), end_id=end_id)
    ordered.mapInArrow(run, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written files: doc_id, ids, and ``start``, the ids of all documents before it.

    ``start`` is the row's count within its file part plus the totals of the parts before,
    a running sum over one row per part.
    """
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    return files.join(_bases(files), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "ids")


def _bases(files: DataFrame) -> DataFrame:
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of the given documents; the filter is pushed to the ORC indexes."""
    return spark.read.schema(FILE_SCHEMA).orc(path).filter(F.col("doc_id").isin(list(doc_ids)))


def _digest(batches):
    for batch in batches:
        lists = batch.column("ids")
        ids, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("doc_id"), batch.column("before"),
             pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())],
            names=["part", "doc_id", "before", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Read every file back: doc_id, start, n_tokens and the CRC-32 of the ids. The ids are
    digested where they are read; only the digests meet the running sums."""
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    rows = files.select("part", "doc_id", "before", "ids").mapInArrow(
        _digest, "part int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return rows.join(_bases(files), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
