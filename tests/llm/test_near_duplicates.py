"""Near duplicates against brute force over full sets, and the defined edge cases."""

import random

import pytest

from tempora.llm import common
from tempora.llm import minmax_dedup as M
from tempora.llm.common import components


def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_changed_copies_match_brute_force(spark, docs):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for base in range(4):
        text = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(25):
            own = list(text)
            for _ in range(rng.randrange(0, 9)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    rows += [(1000, rows[3][1].upper()), (1001, "two words"), (1002, "Two  words"), (1003, None), (1004, ""), (1005, " \n"), (1006, "a b c d e f")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs(rows), 4, 80).collect()}
    assert got == brute(rows, 4, 80)


def test_edge_cases(spark, docs):
    long = " ".join(f"x{k}" for k in range(20_000))
    rows = [(5, long), (3, long + " tail"), (7, "same text here now"), (7, "same text here now"), (None, "same text here now"), (9, "lone")]
    got = [(r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(docs(rows), 4, 80).collect()]
    assert sorted(got, key=str) == sorted(
        [(5, 3, False), (3, 3, True), (7, 7, True), (7, 7, True), (None, None, False), (9, 9, True)], key=str)
    assert M.near_duplicates(docs(rows).limit(0), 4, 80).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    assert got == {**{i: 0 for i in range(31)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def test_heavily_changed_copies_of_one_text_match_brute_force(spark, docs):
    """Copies around the bound: edits drawn from few passages, so that copies share what the text lacks."""
    rng = random.Random(11)
    text = [f"b{k}" for k in range(150)]
    passages = [[f"p{j}x{k}" for k in range(12)] for j in range(4)]
    rows = []
    for _ in range(160):
        own = list(text)
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(0, 130, 10)
            own[at:at + 12] = rng.choice(passages)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = f"r{rng.randrange(40)}"
        rows.append((len(rows), " ".join(own[:rng.choice([150, 150, 135, 120])])))
    rows += [(k, rows[0][1] + f" {k}") for k in (500, 500)] + [(501, rows[5][1])]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs(rows), 4, 80).collect()}
    assert got == brute(rows, 4, 80)
    assert len({c for _, c, _ in got.values()}) > 3


def test_rows_that_share_a_doc_id_link_the_classes_of_their_texts(spark, docs):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (7, a), (7, b), (9, b + " tail"), (20, ""), (20, a), (30, "alone in the world"), (30, None), (31, None),
            (40, "one set of its"), (40, "another of its own")]
    got = [(r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(docs(rows), 4, 80).collect()]
    assert sorted(got) == sorted([(1, 1, True), (7, 1, False), (7, 1, False), (9, 1, False), (20, 1, False), (20, 1, False),
                                  (30, 30, True), (30, 30, True), (31, 31, True), (40, 40, True), (40, 40, True)])


@pytest.mark.parametrize("few", [10, 100_000])
def test_rounds_over_few_edges_shuffle_only_for_their_minima(spark, monkeypatch, few):
    """Few edges are not shuffled to meet the minima and take few tasks; more of them are; the components are the same."""
    plans, write = [], common.stored

    def stored(df, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = write(df, name, **options)
        files.append(len(out.inputFiles()))
        return out

    files = []
    monkeypatch.setattr(common, "stored", stored)
    monkeypatch.setattr(common, "FEW_EDGES", few, raising=False)
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                                 "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for key, value in zip(kept, ("-1", "40", "false")):
            spark.conf.set(key, value)
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert got == {i: root(i) for i in up}
    assert all(("SortMergeJoin" in p) == (few == 10) for p in plans[1:]) and len(plans) > 2
    assert few == 10 or max(files[1:]) <= common.FEW_TASKS
