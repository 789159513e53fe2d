"""Packing (operator 6): documents into fixed windows with little padding, by non-negative
least squares over length combinations.

1. ``cut``: every document (ids, then an end id) is cut into full windows and one remainder.
2. The lengths of the pieces make a histogram of at most ``window`` entries.
3. ``plan``: combinations of up to three lengths that fill a window exactly are enumerated;
   a non-negative least-squares fit gives how often to use each so that the histogram is
   matched; repeats are rounded, kept within what is there, and the residual pieces are
   packed greedily (largest first, then the largest that still fits). All of this is on the
   histogram, so its size depends on the window alone, never on the corpus.
4. ``assign``: the piece of rank r among those of its length takes the r-th place that the
   plan has for that length.
5. ``write_sequences``: the pieces, ids and all, meet in their sequence: one row for each, its tokens
   padded, written to the shared folder. ``sequence_digest`` reads them back.

Ids travel and are stored as little-endian numbers of two bytes where the vocabulary fits, else of four
(``numbers`` reads them).

Sequences are padded to the window, except when their tokens are a power of two.

Defined cases: null or empty text is the end id alone (a piece of one token); repeated rows
are packed each; an empty table gives no rows; only ``doc_id`` and ``text`` are read, so other
columns may have any name; null doc_ids are packed like others.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.common import stored
from tempora.llm.tokens import default_tokenizer, encoder

WINDOW = 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
#: Rounds of the least-squares fit.
FIT_ROUNDS = 300
#: Ids of a batch that goes back to Spark.
BATCH_IDS = 2_000_000
#: Pieces that are put into sequences at a time.
FILL_ROWS = 1024
#: Rows (length, partition) of the counts that are broadcast at most; beyond, the pieces are shuffled to meet them.
BASES = 500_000
SEQUENCES = ("sequence_id long, doc_ids array<long>, starts array<long>, lengths array<long>, doc_tokens array<long>, "
             "tokens long, ids binary")
DIGEST = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")


def _cut(batches, tokenizer: str, window: int, end_id: int, with_ids: bool):
    """Pieces of a partition; ``nth`` counts those of one length within the partition."""
    enc, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), {}
    kind = "<u2" if max(enc.vocab_size, end_id + 1) <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype="<u4").tobytes()
    types = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]

    def packed(cols, ids):
        arrays = [pa.array(c, t) for c, t in zip(cols, types)]
        if not with_ids:
            return pa.RecordBatch.from_arrays(arrays, names=names)
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())], names=[*names, "ids"])

    for batch in batches:
        cols, held, size = [[] for _ in types], [], 0
        texts = (text.as_py() for text in batch.column("text"))
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.each(texts)):
            ids += end
            total = len(ids) // 4
            for start in range(0, total, window):
                piece = ids[4 * start:4 * (start + window)]
                n = len(piece) // 4
                nth = seen.get(n, 0)
                seen[n] = nth + 1
                for col, value in zip(cols, (doc_id, start, n, zlib.crc32(piece), total, part, nth)):
                    col.append(value)
                if with_ids:
                    held.append(np.frombuffer(piece, "<u4").astype(kind).tobytes())
                    size += n
                    if size >= BATCH_IDS:
                        yield packed(cols, held)
                        cols, held, size = [[] for _ in types], [], 0
        yield packed(cols, held)


def numbers(cells: pa.Array, count: int) -> np.ndarray:
    """The ids of binary cells one after another; ``count`` of them, so their width is known."""
    offsets = np.frombuffer(cells.buffers()[1], "<i4")[cells.offset:cells.offset + len(cells) + 1]
    data = np.frombuffer(cells.buffers()[2] or b"", "u1")[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), f"<u{len(data) // count}") if count else np.zeros(0, "<u2")


def _cells(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Ids cut into binary cells of the given lengths."""
    ends = np.cumsum(lengths) * ids.itemsize
    data = ids.tobytes()
    return pa.array([data[a:b] for a, b in zip((ends - np.asarray(lengths) * ids.itemsize).tolist(), ends.tolist())], pa.binary())


def cut(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = 1,
        with_ids: bool = True) -> DataFrame:
    """Pieces of every document of ``docs`` (doc_id, text): full windows and one remainder."""
    run = partial(_cut, tokenizer=tokenizer or default_tokenizer(), window=window, end_id=end_id, with_ids=with_ids)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Every combination of two or three of ``lengths`` that fills ``window`` exactly, as rows
    of three lengths in falling order (0: none)."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    there[0] = True
    found = []
    for a in lengths[(lengths < window) & (3 * lengths >= window)]:
        b = np.arange((window - a + 1) // 2, min(a, window - a) + 1)
        c = window - a - b
        ok = there[b] & there[c]
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


def fit_repeats(combos: np.ndarray, counts: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Non-negative x that minimises |A x - counts|^2, column j of A holding how often each
    length is in combination j: projected gradient steps with momentum."""
    size = len(counts)

    def used(x):  # A x; length 0 is no piece
        total = sum(np.bincount(combos[:, k], weights=x, minlength=size) for k in range(3))
        total[0] = 0
        return total

    def back(r):  # A^T r
        return r[combos].sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue of A^T A bounds the step
        w = back(used(v))
        top = np.linalg.norm(w)
        v = w / top
    x = y = np.zeros(len(combos))
    goal, t = counts.astype(float).copy(), 1.0
    goal[0] = 0
    for _ in range(rounds):
        new = np.maximum(0, y - back(used(y) - goal) / (1.01 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use exactly ``counts[l]`` pieces
    of every length l."""
    left = counts.copy()
    out = [((window,), int(left[window]))] if left[window] else []
    left[window] = 0
    combos = combinations(np.flatnonzero(left), window)
    if len(combos):
        x = fit_repeats(combos, left)
        order = np.argsort(-x, kind="stable")
        # rounding that keeps the running total: each repeat is its share of the rounded sum
        share = np.diff(np.concatenate([[0], np.floor(np.cumsum(x[order]) + 0.5)])).astype(np.int64)
        for j, n in zip(order[share > 0], share[share > 0]):
            need: dict[int, int] = {}
            for length in combos[j]:
                if length:
                    need[int(length)] = need.get(int(length), 0) + 1
            n = min(int(n), *(int(left[k]) // m for k, m in need.items()))
            if n > 0:
                for k, m in need.items():
                    left[k] -= n * m
                out.append((tuple(k for k, m in need.items() for _ in range(m)), n))
    lengths = [int(k) for k in np.flatnonzero(left)]
    while lengths:
        space, need = window, {}
        top = len(lengths)
        while (at := bisect_right(lengths, space, hi=top)) > 0:
            k = lengths[at - 1]
            m = min(int(left[k]), space // k)
            need[k] = m
            space -= m * k
            top = at - 1
        n = min(int(left[k]) // m for k, m in need.items())
        for k, m in need.items():
            left[k] -= n * m
        out.append((tuple(k for k, m in need.items() for _ in range(m)), n))
        lengths = [k for k in lengths if left[k]]
    return out


def places(patterns: list[tuple[tuple[int, ...], int]], window: int = WINDOW) -> dict[str, np.ndarray]:
    """The plan as ranges of ranks: for pieces of one length from rank ``rank`` on, how many go
    in one sequence, the first sequence, and the offset there; sorted by (length, rank)."""
    rows, next_rank, sequence = [], {}, 0
    for lengths, n in patterns:
        offset, total = 0, sum(lengths)
        padded = total if total & (total - 1) == 0 else window
        for k in sorted(set(lengths), reverse=True):
            m = lengths.count(k)
            rows.append((k, next_rank.get(k, 0), m, sequence, offset, padded))
            next_rank[k] = next_rank.get(k, 0) + n * m
            offset += m * k
        sequence += n
    rows.sort()
    names = ("length", "rank", "each", "sequence", "offset", "padded")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


#: Ranks of one length stay below this, so (length, rank) is one sortable number.
RANKS = 1 << 48


def _assign(batches, table: dict[str, np.ndarray]):
    keys = table["length"] * RANKS + table["rank"]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        at = np.searchsorted(keys, length * RANKS + rank, side="right") - 1
        within = rank - table["rank"][at]
        each = table["each"][at]
        more = [table["sequence"][at] + within // each, table["offset"][at] + within % each * length,
                table["padded"][at]]
        kept = [i for i, name in enumerate(batch.schema.names) if name != "rank"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in kept] + [pa.array(m, pa.int64()) for m in more],
            names=[batch.schema.names[i] for i in kept] + ["sequence_id", "offset", "sequence_tokens"])


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Give every piece (of ``cut``) its sequence and offset; other columns are carried along.

    ``pieces`` is written once. A piece's rank among those of its length is its count within
    its partition plus the counts of the partitions before, from a table of one row per length
    and partition, so no group of equal lengths is ever sorted or gathered.
    """
    pieces = stored(pieces, "pieces", compression="zstd")
    by_part = stored(pieces.groupBy("length", "part").count(), "lengths")
    counts = np.zeros(window + 1, dtype=np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("count")).collect():  # at most `window` rows
        counts[length] = n
    table = places(plan(counts, window), window)
    base = by_part.select("length", "part", (F.sum("count").over(
        Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("base"))
    if by_part.count() <= BASES:  # the pieces carry their ids, so they had better not be shuffled for this
        base = F.broadcast(base)
    ranked = pieces.join(base, ["length", "part"]).select(
        *[pieces[c] for c in pieces.columns if c not in ("part", "nth")],
        (F.col("base") + F.col("nth")).alias("rank"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(partial(_assign, table=table), ", ".join(
        fields + ["sequence_id long", "offset long", "sequence_tokens long"]))


def _fill(batches, pad_id: int):
    """Sequences of a partition sorted by (sequence_id, offset); only the one that a batch ends in is carried on."""
    held = None
    for batch in (b.slice(at, FILL_ROWS) for b in batches for at in range(0, b.num_rows, FILL_ROWS)):
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        last = int(np.searchsorted(rows.column("sequence_id").to_numpy(), rows.column("sequence_id")[-1].as_py()))
        held = rows.slice(last)
        if last:
            yield _filled(rows.slice(0, last), pad_id)
    if held is not None:
        yield _filled(held, pad_id)


def _filled(rows: pa.RecordBatch, pad_id: int) -> pa.RecordBatch:
    number, offset, length, tokens = (rows.column(c).to_numpy() for c in ("sequence_id", "offset", "length", "sequence_tokens"))
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    sizes, begin = np.diff(np.append(first, len(number))), np.concatenate([[0], np.cumsum(tokens[first])])
    at = np.repeat(begin[:-1], sizes) + offset  # where a piece begins among the tokens of all sequences
    flat = numbers(rows.column("ids"), int(length.sum()))
    ids = np.full(begin[-1], pad_id, dtype=flat.dtype)
    ids[np.repeat(at - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(len(flat))] = flat
    offsets = pa.array(np.append(first, len(number)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(number[first])]
        + [pa.ListArray.from_arrays(offsets, rows.column(c)) for c in ("doc_id", "start", "length", "doc_tokens")]
        + [pa.array(tokens[first]), _cells(ids, tokens[first])],
        names=["sequence_id", "doc_ids", "starts", "lengths", "doc_tokens", "tokens", "ids"])


def write_sequences(packed: DataFrame, path: str, pad_id: int = 0) -> None:
    """Write the packed pieces (of ``pack``, with ids) as Parquet: a row for every sequence with its pieces in
    order and its tokens, padded with ``pad_id``. The tokens that are no padding are the first sum(lengths)."""
    placed = packed.select("sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", "sequence_tokens", "ids")
    ordered = placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    ordered.mapInArrow(partial(_fill, pad_id=pad_id), SEQUENCES).write.option("compression", "zstd").parquet(path)


def _digest(batches):
    for batch in batches:
        lists = {c: batch.column(c) for c in ("doc_ids", "starts", "lengths", "doc_tokens")}
        sizes = np.diff(lists["lengths"].offsets.to_numpy())
        tokens = batch.column("tokens").to_numpy()
        length = lists["lengths"].flatten().to_numpy(zero_copy_only=False)
        before = np.cumsum(length) - length
        begins = np.cumsum(sizes) - sizes
        offset = before - np.repeat(before[begins], sizes) if len(length) else before
        ids = numbers(batch.column("ids"), int(tokens.sum())).astype("<u4")
        at = np.repeat(np.cumsum(tokens) - tokens, sizes) + offset
        crc = [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(at.tolist(), length.tolist())]
        yield pa.RecordBatch.from_arrays(
            [lists["doc_ids"].flatten(), lists["starts"].flatten(), lists["lengths"].flatten(), pa.array(crc, pa.int64()),
             lists["doc_tokens"].flatten(), pa.array(np.repeat(batch.column("sequence_id").to_numpy(), sizes), pa.int64()),
             pa.array(offset, pa.int64()), pa.array(np.repeat(tokens, sizes), pa.int64())],
            names=[f.split()[0] for f in DIGEST.split(", ")])


def sequence_digest(spark: SparkSession, path: str) -> DataFrame:
    """Read the written sequences back: a row for every piece with the CRC-32 of its ids where they stand now."""
    return spark.read.schema(SEQUENCES).parquet(path).mapInArrow(_digest, DIGEST)
