"""Periodic run detection (operator 13): runs of repeated words by Lyndon roots.

The words of a text are numbered; Baier's grouping (phase one of a suffix sorter) is run on them
under an order and under its reverse. It ends with every position in the group of its longest
Lyndon word, so the group's length is the Lyndon array and an equal group is an equal word. Every
run has, under one of the orders, Lyndon roots that follow each other; a chain of three roots of one
group (a run of four periods has one) is extended to both sides by longest common extensions.

Before that, a text is cut at words that no wanted run can hold: in a stretch of m words the
period is at most m/4, so a word of a run meets itself within m/4 words. Cutting repeats while it
finds something; what it leaves goes through the grouping, whole, whatever its length.

Defined cases: a null or empty text has no words and no run, its collapsed text is empty; a null
doc_id is never rewritten; repeated rows are kept, each with its own row; an empty table gives no
rows; texts are taken whole, however long; only ``doc_id`` and ``text`` are read, so other columns
may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words taken through the cut at once.
BLOCK_WORDS = 200_000
#: Rounds of cutting; what is left then is grouped as it is.
CUTS = 12

SCHEMA = """doc_id long, n_runs long, start long, length long, period long, exponent_milli long,
    runs_sha256 string, collapsed_sha256 string"""


def lyndon_groups(symbols: list[int]) -> tuple[list[int], list[int]]:
    """Baier's grouping: for every position the number of the group of its longest Lyndon word,
    and that word's length. Groups are numbered in the order of their words.

    Groups hold suffixes that begin with the same word, highest group first. Of each suffix of
    the group in hand the nearest earlier suffix of a lower group takes the group's word (as
    often as it was met) at the end of its own, into a new group just above its old one.
    """
    n = len(symbols)
    group, before = [0] * n, list(range(-1, n - 1))
    held, size, length = {}, {}, {}
    lowest = [0] * n  # last place of a group -> its first place, the group's number
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    at = 0
    for c in sorted(by_symbol):
        members = by_symbol[c]
        held[at], size[at], length[at] = members, len(members), 1
        for i in members:
            group[i] = at
        at += len(members)
        lowest[at - 1] = at - len(members)
    end, found = n - 1, [0] * n
    while end >= 0:
        g = lowest[end]
        end, word = g - 1, length[g]
        met: dict[int, int] = {}
        for i in sorted(i for i in held.pop(g) if group[i] == g):
            found[i] = word
            j = before[i]
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, times in met.items():
            moves.setdefault((-times, group[j]), []).append(j)
        for times, old in sorted(moves) if len(moves) > 1 else moves:
            moved = moves[times, old]
            top = old + size[old] - 1
            new = top + 1 - len(moved)
            longer = length[old] - times * word
            if new != old:
                size[old] -= len(moved)
                lowest[new - 1], lowest[top] = old, new
                for j in moved:
                    group[j] = new
            held[new], size[new], length[new] = moved, len(moved), longer
    return group, found


def _extension(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of ``a`` and ``b`` agree, looked at in doubling pieces."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        to = min(at + step, n)
        differ = np.flatnonzero(a[at:to] != b[at:to])
        if len(differ):
            return at + int(differ[0])
        at, step = to, step * 2
    return n


def runs(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of one stretch of numbered words, by start and period."""
    out = set()
    for ordered in (symbols, -symbols):
        group, word = (np.array(x) for x in lyndon_groups(ordered.tolist()))
        here = np.arange(len(symbols))
        here = here[here + 2 * word < len(symbols)]
        p = word[here]
        chain = (group[here] == group[here + p]) & (group[here] == group[here + 2 * p])
        earlier = np.maximum(here - p, 0)
        first = chain & ~((here >= p) & (group[earlier] == group[here]))
        for i, q in zip(here[first].tolist(), p[first].tolist()):
            right = _extension(symbols[i:], symbols[i + q:])
            left = _extension(symbols[:i][::-1], symbols[:i + q][::-1])
            if left + q + right >= max(LEAST_WORDS, LEAST_PERIODS * q):
                out.add((i - left, left + q + right, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(symbols: np.ndarray, texts: np.ndarray) -> list[tuple[int, int]]:
    """Places (start, end) outside of which no wanted run has a word; ``texts`` numbers the text of each word."""
    def pieces(alive):
        here = np.flatnonzero(alive)
        edge = np.flatnonzero((np.diff(here) > 1) | (np.diff(texts[here]) != 0))
        if not len(here):
            return here, here, here
        return here, here[np.concatenate([[0], edge + 1])], here[np.concatenate([edge, [len(here) - 1]])] + 1

    key = texts.astype(np.int64) * (int(symbols.max(initial=0)) + 1) + symbols
    order = np.argsort(key, kind="stable")
    alive = np.ones(len(symbols), bool)
    for _ in range(CUTS):
        here, starts, ends = pieces(alive)
        size = ends - starts
        stretch = np.zeros(len(symbols), np.int64)
        stretch[here] = np.repeat(np.arange(len(starts)), size)
        order = order[alive[order]]
        a, b = order[:-1], order[1:]
        near = (key[a] == key[b]) & (stretch[a] == stretch[b])
        near &= (b - a) * LEAST_PERIODS <= size[stretch[a]]
        near &= size[stretch[a]] >= LEAST_WORDS
        alive = np.zeros(len(symbols), bool)
        alive[a[near]] = True
        alive[b[near]] = True
        if alive.sum() == len(here):
            break
    _, starts, ends = pieces(alive)
    return list(zip(starts.tolist(), ends.tolist()))


def rewritten(doc_id: int | None, words: list) -> list:
    """The words of a document after the contract's rewriting of every tenth one."""
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def find(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """The runs of every list of words."""
    numbers: dict = {}
    flat = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(texts)), sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(flat, of):
        t = int(of[a])
        out[t] += [(a - int(first[t]) + s, n, p) for s, n, p in runs(flat[a:b])]
    return out


def _row(doc_id, words: list, found: list[tuple[int, int, int]]) -> tuple:
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = words
    if found:
        keep = np.ones(len(words), bool)
        for start, length, period in found:
            keep[start + period:start + length] = False
        kept = [words[i] for i in np.flatnonzero(keep)]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def _scan(batches, schema: pa.Schema):
    def flush(rows):
        found = find([words for _, words in rows])
        cells = [_row(doc_id, words, f) for (doc_id, words), f in zip(rows, found)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), schema.types)], schema=schema)

    rows, held = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = rewritten(doc_id, (text.as_py() or "").encode().split())
            rows.append((doc_id, words))
            held += len(words) + 1
            if held >= BLOCK_WORDS:
                yield flush(rows)
                rows, held = [], 0
    if rows:
        yield flush(rows)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its number of runs, its run of greatest exponent, and digests of all
    runs and of the words left when every run keeps its first period only."""
    schema = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("n_runs", "start", "length", "period", "exponent_milli")]
                       + [(n, pa.string()) for n in ("runs_sha256", "collapsed_sha256")])
    return docs.select("doc_id", "text").mapInArrow(partial(_scan, schema=schema), SCHEMA)
