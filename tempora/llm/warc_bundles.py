"""WARC records in seekable Zstandard bundles (operator 8).

A bundle is a sequence of independent Zstandard frames, each holding whole WARC records, and
ends in a seek table (a skippable frame: compressed and decompressed size of every frame, their
number, a magic number), so any frame is read by itself and plain decompressors see one
continuous WARC file. An index table maps every record to its bundle, frame and the
offset within the decompressed frame.

Of records with equal payloads (bytes, from ``min_bytes`` on) the one with the largest page_id
is the response; the others are revisits that name its digest and record and carry no payload.

Every task writes its bundles under names of its own and returns the index rows; a bundle of a
task that failed or ran twice is in no index and is never read.

Defined cases: null html is the empty payload; null urls are written as empty; rows without a
page_id are responses that nothing refers to; rows that repeat a page_id are archived each, and
if the response's row is repeated all its copies are responses; an empty table gives no rows; payloads
of any length are one record in a frame of their own; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from functools import lru_cache, partial

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the public seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Decompressed bytes of a frame and compressed bytes of a bundle, about.
FRAME, BUNDLE = 1 << 19, 64 << 20
#: Bytes of records that a task reads back.
PART = 64 << 20
INDEX = "page_id long, record_id string, bundle string, frame int, at long, length long"


def decided(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) with a row per page: the winner per digest is a map-side
    combined maximum, joined back over small columns only."""
    small = pages.select("page_id", F.octet_length(_payload()).alias("bytes"), F.sha1(_payload()).alias("digest"))
    last = small.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("last"))
    return small.join(last, "digest", "left").select(
        "page_id", "digest", F.when(F.col("page_id") < F.col("last"), F.col("last")).alias("refers_to"))


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}:{digest}"


def _record(page_id, url, payload: bytes, refers_to) -> tuple[str, bytes]:
    """A WARC/1.1 record; the HTTP block of a revisit keeps the length of the payload it lacks."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    own = record_id(page_id, digest)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    more = ""
    if refers_to is None:
        block += payload
    else:
        more = ("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
                f"WARC-Refers-To: <{record_id(refers_to, digest)}>\r\n")
    head = (f"WARC/1.1\r\nWARC-Type: {'response' if refers_to is None else 'revisit'}\r\nWARC-Record-ID: <{own}>\r\n"
            f"WARC-Target-URI: {' '.join((url or '').split())}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            f"WARC-Payload-Digest: sha1:{digest}\r\n{more}"
            f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n")
    return own, head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def _write(batches, folder: str):
    """Index rows of one task's bundles; memory holds one frame and one open file."""
    fs, root = pafs.FileSystem.from_uri(folder)
    press = zstandard.ZstdCompressor(level=3)
    out = name = None
    frames: list[tuple[int, int]] = []
    held: list[bytes] = []
    rows: list[tuple] = []
    size = written = 0

    def index():
        types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                           names=["page_id", "record_id", "bundle", "frame", "at", "length"])
        rows.clear()
        return batch

    def close_frame():
        nonlocal held, size, written
        data = press.compress(b"".join(held))
        out.write(data)
        frames.append((len(data), size))
        written += len(data)
        held, size = [], 0

    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
        for page_id, url, html, refers_to in zip(*columns):
            page_id, refers_to = page_id.as_py(), refers_to.as_py()
            own, record = _record(page_id, url.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"), refers_to)
            if out is None:
                name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                out, frames, written = fs.open_output_stream(f"{root}/{name}", compression=None), [], 0
            if held and size + len(record) > FRAME:
                close_frame()
            rows.append((page_id, own, name, len(frames), size, len(record)))
            held.append(record)
            size += len(record)
            if written >= BUNDLE:
                close_frame()
                out.write(seek_table(frames))
                out.close()
                out = None
        if rows:
            yield index()
    if out is not None:
        if held:
            close_frame()
        out.write(seek_table(frames))
        out.close()


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Archive ``pages`` (page_id, url, html) as bundles under ``folder``, with the index table beside
    them. The pages are shuffled once, by page_id and digest, to meet their decisions."""
    chosen = decided(pages, min_bytes).filter("refers_to IS NOT NULL").distinct().select(
        F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to")
    keyed = pages.select("page_id", "url", "html", F.sha1(_payload()).alias("digest"))
    both = keyed.join(chosen.hint("shuffle_hash"), (F.col("page_id") == F.col("p")) & (F.col("digest") == F.col("d")), "left")
    make_folder(f"{folder}/bundles")
    both.select("page_id", "url", "html", "refers_to").mapInArrow(
        partial(_write, folder=f"{folder}/bundles"), INDEX).write.parquet(f"{folder}/index")


def make_folder(folder: str) -> None:
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)


@lru_cache(maxsize=64)
def _frames(bundle: str) -> list[tuple[int, int]]:
    """(offset, compressed size) of every frame, from the seek table at the bundle's end."""
    fs, path = pafs.FileSystem.from_uri(bundle)
    with fs.open_input_file(path) as f:
        end = f.size()
        n, _, magic = struct.unpack("<IBI", f.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table in {bundle}")
        sizes = struct.unpack(f"<{2 * n}I", f.read_at(8 * n, end - 9 - 8 * n))[::2]
    out, at = [], 0
    for size in sizes:
        out.append((at, size))
        at += size
    return out


def read_frame(bundle: str, frame: int) -> bytes:
    at, size = _frames(bundle)[frame]
    fs, path = pafs.FileSystem.from_uri(bundle)
    with fs.open_input_file(path) as f:
        return zstandard.ZstdDecompressor().decompress(f.read_at(size, at))


def parse(record: bytes) -> dict:
    """The fields of one record, and its payload where it has one."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length"))

    def page(field):
        text = fields.get(field, "").strip("<>").split(":")
        return int(text[2]) if len(text) > 2 and text[2] != "none" else None

    if fields["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if len(payload) != length or fields["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"page_id": page("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload": payload, "payload_bytes": length,
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"],
            "refers_to": page("WARC-Refers-To")}


FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(batches, folder: str, with_payload: bool):
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    names = [f.split()[0] for f in FIELDS.split(", ")] + ["payload"] * with_payload
    for batch in batches:
        for bundle, frame, records in zip(*(batch.column(c) for c in ("bundle", "frame", "records"))):
            data = read_frame(f"{folder}/{bundle.as_py()}", frame.as_py())
            found = [parse(data[r["at"]:r["at"] + r["length"]]) for r in records.as_py()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[n] for x in found], t) for n, t in zip(names, types)], names=names)


def read_bundles(spark: SparkSession, folder: str, wanted: DataFrame | None = None, with_payload: bool = True) -> DataFrame:
    """Records read back from the bundles: all, or those of ``wanted`` (page_id). Only frames that
    hold wanted records are read and decompressed, each once; a frame's records are bounded by
    the frame's size. A task reads about ``PART`` bytes of records, whatever the size of their index."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    if wanted is not None:
        index = index.join(wanted.select("page_id").distinct(), "page_id", "left_semi")
    there = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count_distinct("bundle", "frame").alias("frames")).first()
    parts = max(1, min(there["frames"], max(spark.sparkContext.defaultParallelism, -(-there["bytes"] // PART))))
    frames = index.repartition(parts, "bundle", "frame").groupBy("bundle", "frame").agg(F.collect_list(F.struct("at", "length")).alias("records"))
    return frames.mapInArrow(partial(_read, folder=f"{folder}/bundles", with_payload=with_payload),
                             FIELDS + (", payload binary" if with_payload else ""))
