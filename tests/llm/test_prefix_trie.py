"""The conversation trie against a plain one built in memory."""

import collections
import hashlib
import random
import zlib

from tempora.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth string, name string, part string"


def plain(rows):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = own.get(base, [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = collections.defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                    digest(c for c in m if len(built[c]) == len(k))) for k, m in members.items()), key=str)


def same(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in P.prefix_trie(frame).collect()]
    assert sorted(got, key=str) == plain(rows)
    return got


def test_defined_cases(spark):
    rows = [(5, None, None, None), (5, 0, "user", "héllo"), (5, 0, "user", "héllo"), (5, 1, "user", ""), (7, 3, "user", "héllo"),
            (7, 2, None, "x" * 200_000), (None, 0, "user", "lost"), (-3, 0, "a", "b"), (-3, 1, "a", "b"), (0, 0, "u", "t"), (1, 0, "u", "t"),
            (10**15, 9, "u", "t")]
    same(spark, rows)
    frame = spark.createDataFrame([(*rows[0], "x", "y", "z")], SCHEMA).limit(0)
    assert P.prefix_trie(frame).count() == 0


def test_deep_conversations_over_several_parts(spark):
    """One conversation holds most rows, others leave it at every turn, some with longer rests."""
    trunk = [("u", f"turn {k}") for k in range(120)]
    rows = [(5 * 1000, k, *t) for k, t in enumerate(trunk)]
    for c in range(1, 60):
        rows += [(5 * c, k, *t) for k, t in enumerate(trunk[:2 * c] + [("a", f"rest {c} {k}") for k in range(c % 7 * 10)])]
    got = same(spark, rows)
    assert max(r[1] for r in got) >= 120


def test_many_equal_conversations(spark):
    rng = random.Random(1)
    rows = [(c, t, "u", f"{t} {rng.randrange(1 + c % 3)}") for c in range(400) for t in range(rng.choice((1, 2, 3, 11)))]
    rows += [(c, t, "u", "same") for c in range(1000, 1300) for t in range(10)]
    same(spark, rows)


def test_names_of_stretches_combine(spark, monkeypatch):
    """Names carried across parts equal those of whole conversations."""
    rows = [(c, t, "u", str(t * c % 5)) for c in range(4) for t in range(50)]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    few = {tuple(r) for r in P.prefixes(frame).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = {tuple(r) for r in P.prefixes(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert few == many and len(few) == 200


def test_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in P.prefix_trie(frame).collect()), key=str) == plain(rows)
