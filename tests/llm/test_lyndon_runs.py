"""Periodic runs against brute force."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tempora.llm import lyndon_runs as L


def plain_runs(s):
    """Every period tried at every place."""
    out = set()
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(s[i:i + n - d] == s[i + d:i + n] for d in range(1, q)):
                out.add((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in found), " ".join(kept))]
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


pieces = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9))
texts = st.lists(pieces, max_size=6).map(lambda ps: [c for u, k in ps for c in u * k])


@settings(max_examples=200, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_runs_equal_brute_force(many):
    assert L.find(many) == [plain_runs(s) for s in many]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=18))
def test_groups_are_the_longest_lyndon_words(s):
    group, length = L.lyndon_groups(s)
    words = {}
    for i in range(len(s)):
        best = max(n for n in range(1, len(s) - i + 1) if all(s[i:i + n] < s[i + k:i + n] for k in range(1, n)))
        assert length[i] == best
        assert words.setdefault(group[i], s[i:i + best]) == s[i:i + best]


def test_cut_keeps_every_run_of_a_long_text():
    rng = np.random.default_rng(3)
    noise = rng.integers(0, 400, 30_000)
    noise[9_000:9_400] = np.tile(np.arange(50) + 1000, 8)
    noise[20_000:20_020] = 7
    assert L.find([noise.tolist()]) == [plain_runs_sparse(noise.tolist())]


def plain_runs_sparse(s):
    """Brute force by array comparison, for a long text."""
    a, out = np.array(s), set()
    for q in range(1, 400):
        same = np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]])
        for i, j in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            n = int(j - i + q)
            w = s[i:i + n]
            if n >= max(6, 4 * q) and not any(w[:n - d] == w[d:] for d in range(1, q)):
                out.add((int(i), n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_rows(spark, docs):
    tenth = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b " * 9), (4, "a b " * 9), (5, "x " * 6), (6, "x " * 5), (7, "ä b " * 7),
            (8, "line one two\n" * 500), (9, "w" * 50_000), (-3, "a b c d e f g")]
    rows += [(i, " ".join(f"w{k * k % 97}" for k in range(i % 60))) for i in tenth]
    frame = docs(rows).withColumnRenamed("component_id", "start")
    got = sorted(tuple(r) for r in L.periodic_runs(frame).collect())
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted((plain_row(*r) for r in rows), key=key)
    assert any(r[1] for r in got if r[0] in tenth)
    null = L.periodic_runs(docs([(None, "a a a a a a")])).first()
    assert (null.doc_id, null.n_runs, null.start, null.length, null.period, null.exponent_milli) == (None, 1, 0, 6, 1, 6000)
    assert L.periodic_runs(docs(rows).limit(0)).count() == 0


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted((plain_row(r.doc_id, r.text) for r in rows.collect() if len((r.text or "").split()) < 1500), key=lambda r: r[0])
    got = {r[0]: tuple(r) for r in L.periodic_runs(rows).collect()}
    assert want and all(got[r[0]] == r for r in want)
    assert len(got) == rows.count()
