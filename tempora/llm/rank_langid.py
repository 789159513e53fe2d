"""Language ID (operator 7) by rank-order profiles.

A profile is the most frequent letter n-grams (one to three letters, word ends marked) of all
training texts of a language, in order of frequency. A document's own most frequent n-grams are
compared with every profile by out-of-place distance: the sum, over the document's n-grams, of
how far the two ranks lie apart, at most the profile's length for an n-gram that it lacks. The
nearest language wins (ties: the smaller name); the score is 1 - distance / largest distance.

Counts cover all training documents and whole texts: every task adds up its own counts per
language, which are then summed by key. Only the finished profiles (languages x PROFILE rows)
reach the driver.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every
text when nothing could be learned; rows without a language or doc_id are not learned from;
repeated rows count as often as they occur and each gets its prediction; an empty table gives
no rows; only ``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: N-grams of a language profile and of a document profile.
PROFILE = 400
OWN = 300
UNKNOWN = "und"
#: Stands for anything between two words; no letter has this code point.
EDGE = 1
#: Counts a task holds before it passes them on.
HELD = 1_000_000
#: Code points that are counted at a time.
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text as packed code points, and their counts."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    points = np.where(_letters()[points], points, EDGE)
    points = np.concatenate([[EDGE], points, [EDGE]])
    points = points[np.concatenate([[True], (points[1:] != EDGE) | (points[:-1] != EDGE)])]
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(points), CHUNK):
        part = points[at:at + CHUNK + 2]  # two more, for n-grams that begin in this chunk
        own = min(CHUNK, len(part))
        one = part[:own]
        two = (part[:-1] << 42 | part[1:] << 21)[:own]
        three = (part[:-2] << 42 | part[1:-1] << 21 | part[2:])[:own]
        inner = part[1:-1][:own] != EDGE
        found = np.concatenate([one[one != EDGE] << 42, two, three[inner]])
        k, c = np.unique(found, return_counts=True)
        keys, counts = merged(np.concatenate([keys, k]), np.concatenate([counts, c])) if len(keys) else (k, c)
    return keys, counts


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most frequent n-grams (ties: the smaller) and their ranks from 0; n-grams of
    one frequency share their mean rank, so a short text has no made-up order."""
    order = np.lexsort((keys, -counts))[:most]
    keys, counts = keys[order], counts[order]
    first = np.concatenate([[True], counts[1:] != counts[:-1]]) if len(counts) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    return keys, (np.bincount(group, weights=np.arange(len(keys))) / np.bincount(group))[group] if len(keys) else np.zeros(0)


def _count(batches):
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            keys, counts = merged(*(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            part = grams(text.as_py())
            held.setdefault(lang, []).append(part)
            size += len(part[0])
            if size >= HELD:
                held = {k: [merged(*(np.concatenate(x) for x in zip(*v)))] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size >= HELD // 2:
                    yield from flush()
                    held, size = {}, 0
    yield from flush()


def learn(labelled: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """Profiles from ``labelled`` (lang, text): language -> its n-grams by falling frequency."""
    counts = labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(
        _count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = counts.withColumn("place", place).filter(F.col("place") <= profile)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "place", "gram").collect():  # languages x profile rows
        found.setdefault(row.lang, []).append((row.place, row.gram))
    return {lang: [g for _, g in sorted(rows)] for lang, rows in sorted(found.items())}


def _predict(batches, profiles: dict[str, list[int]], own: int, keep_text: bool):
    langs = list(profiles)
    longest = max(map(len, profiles.values()), default=0)
    known = np.unique(np.concatenate([np.array(g, np.int64) for g in profiles.values()])) if langs else np.zeros(0, np.int64)
    ranks = np.full((len(known) + 1, len(langs)), np.nan)
    for j, lang in enumerate(langs):
        ranks[np.searchsorted(known, profiles[lang]), j] = np.arange(len(profiles[lang]))
    for batch in batches:
        names, scores = [], []
        for text in batch.column("text"):
            found = grams(text.as_py())
            letters = found[0] & ((1 << 42) - 1) == 0  # single letters, whether or not among the first ``own``
            keys, place = ranked(*found, own)
            if not langs or not letters.any():
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            there = known[at] == keys
            apart = np.abs(ranks[np.where(there, at, len(known))] - place[:, None])
            distance = np.where(np.isnan(apart), longest, np.minimum(apart, longest)).sum(axis=0)
            best = int(distance.argmin())
            names.append(langs[best])
            scores.append(float(1 - distance[best] / (longest * len(keys))))
        kept = [i for i, n in enumerate(batch.schema.names) if keep_text or n != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            names=[batch.schema.names[i] for i in kept] + ["lang_pred", "score"])


def predict(texts: DataFrame, profiles: dict[str, list[int]], own: int = OWN,
            keep_text: bool = False) -> DataFrame:
    """``texts`` (``text`` and columns to carry) with lang_pred and score, and the text if kept."""
    carried = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if keep_text or f.name != "text"]
    return texts.mapInArrow(partial(_predict, profiles=profiles, own=own, keep_text=keep_text),
                            ", ".join([*carried, "lang_pred string", "score double"]))


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang)."""
    profiles = learn(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), profiles)
