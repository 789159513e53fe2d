"""MinHash near-duplicates (operator 2) by min-max hashing.

Under every permutation of the shingle space a document keeps both the minimum and the
maximum of its set, so 64 permutations give 128 signature values. Bands of four minima and
bands of four maxima (16 + 16) make candidate buckets: two sets of similarity 0.8 share no
bucket with probability (1 - 0.8^4)^32 < 1e-7. Every candidate link is confirmed on the full
shingle sets.

No bucket is expanded into all its pairs:

* documents with equal sets are one class with one representative (map-side combined);
* in every bucket each member is compared with the bucket's smallest member (its pivot);
* confirmed links give components; only buckets that still hold several components are
  looked at again, and there only pairs of different components are compared, so no link
  between components is lost. What a document shares with any other of them, and with the member
  that all of its bucket were compared with, bounds its similarity exactly, which rules out heavily
  changed copies without comparing them.

Defined cases: null and empty texts, and texts of white space, have the empty set and link
with nothing; fewer words than a shingle make one shingle of the whole sequence; repeated rows
are rows of one class; rows that share a doc_id but not the text are one document with several
sets, linked by any of them and of one component (also a row of its without a set); a null doc_id links with nothing, has no component and is not kept; an
empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import components, stored

PERMUTATIONS = 64
ROWS = 4
#: Shingles hashed under all permutations at a time (64 x 4096 x 8 bytes).
CHUNK = 4096

_RNG = np.random.default_rng(20240607)
_MULTIPLY = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_BAND = _RNG.integers(0, 1 << 63, (2 * PERMUTATIONS // ROWS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values (the finaliser of a public 64-bit hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct ``words``-word shingles of the whole text as sorted 64-bit hashes. Words
    are runs of other than ASCII white space, A-Z lower-cased (what bytes.lower and
    bytes.split do)."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts)), dtype=">u8").astype(np.uint64)
    size = min(words, len(hashes))
    # a short text is one shingle of its own kind: its length is hashed in
    total = np.full(len(hashes) - size + 1, size if size < words else 0, dtype=np.uint64)
    for k in range(size):
        total += hashes[k:len(hashes) - size + 1 + k] * _PLACE[k]
    return np.unique(_mix(total))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """Bucket keys: one for each band of minima and each band of maxima."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), CHUNK):
        values = shingles[at:at + CHUNK][None, :] * _MULTIPLY[:, None] + _ADD[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return _mix((_mix(np.concatenate([low, high])).reshape(-1, ROWS) * _BAND).sum(axis=1, dtype=np.uint64)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def _sign(batches, words: int):
    for batch in batches:
        for part in _slices(batch):
            sets = [shingle_set(t.as_py(), words) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                _lists([band_keys(s) if len(s) else np.zeros(0, np.int64) for s in sets]),
            ], names=["doc_id", "n_shingles", "set_id", "bands"])


def _sets(batches, words: int):
    """Sets of one partition of the join by doc_id, each once even where rows repeat."""
    seen = set()
    for batch in batches:
        for part in _slices(batch):
            found = {}
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                shingles = shingle_set(text.as_py(), words)
                key = (doc_id, hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                if len(shingles) and key not in seen:
                    seen.add(key)
                    found[key] = shingles.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int64()), pa.array([len(v) for v in found.values()], pa.int64()),
                 _lists(list(found.values()))], names=["rep", "n", "shingles"])


def _slices(batch: pa.RecordBatch, rows: int = 256):
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _possible(n: str, m: str, percent: int):
    """Sets of these sizes can reach the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _open(members: DataFrame, found: DataFrame, shared: DataFrame | None) -> DataFrame:
    """(key, rep, n, c) of the members, pivots aside, of buckets whose members are of several
    components c (pivots were compared with every member); with ``shared``, of its rows only."""
    labelled = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", "n", "pivot", F.coalesce("component", "rep").alias("c"))
    if shared is not None:
        labelled = labelled.join(shared, "rep")
    several = labelled.filter("rep <> pivot").groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter(
        "low <> high").select("key")
    return labelled.join(several, "key").filter("rep <> pivot").drop("pivot")


def _shared(sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(rep, shared): how many of a document's shingles any other of ``reps`` has too; documents that
    have too few for any link are left out."""
    each = sets.join(reps, "rep", "left_semi").select("rep", "n", F.explode("shingles").alias("x"))
    common = each.groupBy("x").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("x")
    return each.join(common, "x").groupBy("rep", "n").agg(F.count(F.lit(1)).alias("shared")).filter(
        100 * F.col("shared") >= percent * F.col("n")).select("rep", "shared")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, other, n, m, both): sizes of the full sets of the pairs and of their intersection. The set
    of ``rep`` travels to ``other``; both joins are plain sort-merge joins that AQE can split when one
    document is in very many pairs."""
    left = pairs.join(sets, "rep").select("rep", "other", "n", "shingles")
    right = sets.select(F.col("rep").alias("other"), F.col("n").alias("m"), F.col("shingles").alias("theirs"))
    return left.join(right, "other").select(
        "rep", "other", "n", "m", F.size(F.array_intersect("shingles", "theirs")).cast("long").alias("both"))


def _links(overlaps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar, as edges (u, v)."""
    return overlaps.filter(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both"))).select(
        F.col("rep").alias("u"), F.col("other").alias("v"))


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Edges with the components of ``found`` and of more links: what was found is stars already."""
    return found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(links)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of
    ``words``-word shingles; component_id is the smallest doc_id reachable over links.
    """
    texts = docs.select("doc_id", "text")
    signed = stored(texts.mapInArrow(partial(_sign, words=words),
                                     "doc_id long, n_shingles long, set_id binary, bands array<long>"), "signatures")
    linkable = signed.filter("set_id IS NOT NULL AND doc_id IS NOT NULL")
    # equal sets have equal bands, so any row's will do
    classes = linkable.groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")

    in_bucket = classes.select("rep", "n", F.explode("bands").alias("key"))
    pivots = in_bucket.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("size"))
    members = in_bucket.join(pivots.filter("size > 1").drop("size"), "key")
    members = stored(members, "members")

    sizes = classes.select(F.col("rep").alias("other"), F.col("n").alias("m"))
    first = members.filter("rep <> pivot").select("rep", "n", F.col("pivot").alias("other")).distinct()
    first = first.join(sizes, "other").filter(_possible("n", "m", percent)).select("rep", "other")

    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(texts.join(wanted.hint("shuffle_hash"), "doc_id").mapInArrow(
        partial(_sets, words=words), "rep long, n long, shingles array<long>"), "sets")
    # rows of one doc_id with several sets are one document: it links the classes of its sets
    several = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.coalesce("set_id", F.lit(b""))).alias("low"), F.max(F.coalesce("set_id", F.lit(b""))).alias("high")).filter(
        "low <> high").select("doc_id")
    own = stored(linkable.join(several, "doc_id", "left_semi").select("doc_id", "set_id").distinct().join(
        classes.select("set_id", "rep"), "set_id").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")), "own")
    links = stored(_links(_overlaps(first, sets), percent).union(own.filter("u <> v")), "links")
    found = components(links, "components")

    # buckets that hold several components: first against their least changed member ...
    rest = stored(_open(members, found, None), "open")
    shared = stored(_shared(sets, rest.select("rep").distinct(), percent), "shared")
    rest = rest.join(shared, "rep")
    cleanest = rest.groupBy("key").agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("s"), "rep")).alias("best")).select(
        "key", F.col("best.rep").alias("other"))
    middle = rest.join(cleanest, "key").filter("rep <> other").select("rep", "other").distinct()
    compared = stored(_overlaps(middle, sets), "compared")
    found = components(_joined(found, _links(compared, percent)), "components")

    # ... then, where components are still several, across all of them
    rest = _open(members, found, shared).join(cleanest, "key").join(
        compared.select("rep", "other", "both"), ["rep", "other"])
    rest = stored(rest.withColumn("own", F.col("shared") - F.col("both")), "open")
    # the buckets of a set, at most one for each band: a pair that meets in several is taken in the smallest
    keys = rest.groupBy("rep", "n").agg(F.collect_set("key").alias("keys"))
    rest = rest.join(keys, ["rep", "n"])
    a, b = rest.alias("a"), rest.alias("b")
    # what two documents have in common lies inside their bucket's least changed member, where neither has
    # more than it shares with that, or outside it, where neither has more than it shares with any other
    most = F.least("a.both", "b.both") + F.least("a.own", "b.own")
    reach = 100 * most >= percent * (F.col("a.n") + F.col("b.n") - most)
    second = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.rep") < F.col("b.rep"))
                    & (F.col("a.c") != F.col("b.c")) & reach
                    & (F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")))
    second = second.select(F.col("b.rep").alias("rep"), F.col("a.rep").alias("other")).distinct()
    more = stored(_links(_overlaps(second, sets), percent), "more-links")
    if not more.isEmpty():
        found = components(_joined(found, more), "components")

    named = classes.select("set_id", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_id", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    # a row without a set is of its document's component, if other rows of the document have sets
    whole = own.join(found.withColumnRenamed("node", "v"), "v", "left").groupBy(F.col("u").alias("doc_id")).agg(
        F.min(F.coalesce("component", "v")).alias("whole"))
    out = out.join(whole, "doc_id", "left") if not own.isEmpty() else out.withColumn("whole", F.lit(None).cast("long"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "whole", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
