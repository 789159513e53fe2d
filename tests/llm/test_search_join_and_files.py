"""Vector search and join, license scans, WARC bundles, mixing and language ID against brute force."""

import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tempora.llm import license_scan as L
from tempora.llm import poisson_mix as X
from tempora.llm import rank_langid as R
from tempora.llm import subspace_join as J
from tempora.llm import taat_topk as T
from tempora.llm import warc_bundles as W
from tempora.llm.common import scratch

VECTORS = "vec_id long, embedding array<float>, label int, score long"


def vectors(seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=16)) for i in range(150)]
    base = rng.normal(size=16)
    rows += [(200 + i, base + rng.normal(size=16) * rng.choice([0.05, 0.25])) for i in range(60)]  # a crowd around one vector
    rows += [(300 + i, rows[0][1] * (i + 1)) for i in range(5)] + [(400 + i, rows[1][1]) for i in range(4)]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


ODD = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, []), (905, [float("inf")] * 16)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, -1) for i, v in rows], VECTORS).repartition(4)


def test_top_k_matches_brute_force(spark):
    rows = vectors() + [(50 * k + 1000, [0.01 * k] * 16) for k in range(3)] + [(1000, [0.0] * 16), (3, [9.0] * 16), (1050, [0.01] * 16)]
    got = {}
    for r in T.top_k(frame(spark, rows + ODD), F.col("vec_id") % 50 == 0, block=64, query_block=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows + [(901, ODD[1][1]), (904, [])]]
    want = {}
    for n, (q, own) in enumerate(whole):
        if q % 50 == 0:  # every other row is a candidate, also one of the same vec_id
            scores = sorted((-sum(a * b for a, b in zip(own, w)), i) for m, (i, w) in enumerate(whole) if m != n)[:5]
            want.setdefault(q, []).extend((n + 1, i, -s) for n, (s, i) in enumerate(scores))
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}
    assert len(got[1000]) == len(got[1050]) == 10
    assert T.top_k(frame(spark, ODD[:1]), F.col("vec_id") % 50 == 0).count() == 0


def test_rows_without_a_vec_id_are_candidates(spark):
    """Only the vector decides who takes part; ids beyond 2^53 stay whole beside a null one."""
    big = (1 << 53) + 1
    rows = [(50, [1.0, 1.0]), (None, [3.0, 3.0]), (None, [1.0, 1.0]), (big, [1.0, 1.0]), (100, [0.5, 0.5]), (None, None), (None, [float("nan"), 1.0])]
    got = {}
    for r in T.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, block=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    one = 2 * 256 * 256
    assert {q: sorted(v, key=lambda x: x[0]) for q, v in got.items()} == {
        50: [(1, None, 3 * one), (2, big, one), (3, None, one), (4, 100, one // 2)],
        100: [(1, None, 3 * one // 2), (2, 50, one // 2), (3, big, one // 2), (4, None, one // 2)]}


def test_large_weights_take_part_exactly(spark):
    """Components beyond 2^27 / 256 are kept; what leaves 64 bits raises; sums that only pass through there do not."""
    rows = [(50, [1e6] * 16), (100, [1.0, -2.0] * 8), (1, [1e6, -1e6] * 8), (2, [999_999.0] + [1e6] * 15), (3, [3e7, 3e7, -3e7] + [0.5] * 13), (4, [0.25] * 16),
            (150, [3e8, 3e8, 3e8]), (5, [0.0, 0.0, 0.0, 1e30])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}

    def best(q, own):
        return sorted((-sum(a * b for a, b in zip(own[q], w)), i) for i, w in own.items() if i != q)[:5]

    for left in ({5, 150}, {3, 5, 50, 1, 2}):  # 3e8 x 3e7 and 1e6 x 1e30 leave 64 bits
        own = {i: w for i, w in whole.items() if i not in left}
        got = {}
        for r in T.top_k(frame(spark, [r for r in rows if r[0] not in left]), F.col("vec_id") % 50 == 0).collect():
            got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert {q: sorted(v) for q, v in got.items()} == {q: best(q, own) for q in own if q % 50 == 0}
    with pytest.raises(Exception, match="does not fit in 64 bits"):
        T.top_k(frame(spark, [r for r in rows if r[0] in (50, 5)]), F.col("vec_id") % 50 == 0).collect()


def test_sums_that_pass_64_bits_on_the_way_are_exact():
    import pandas as pd
    big = np.array([float(1 << 40), float(1 << 40), 7.0])
    block = pd.DataFrame({"row": [1, 2], "vec_id": [1, 2], "weights": [np.array([float(1 << 40), -float(1 << 40), 3.0]), np.array([0.0, 0.0, 1.0])]})
    out = T.block_topk(block, pd.DataFrame({"row": [0], "vec_id": [0], "weights": [big]}), 5)
    assert sorted(zip(out["vec_id"], out["score"])) == [(1, 21), (2, 7)]
    with pytest.raises(OverflowError):
        T.block_topk(block, pd.DataFrame({"row": [0], "vec_id": [0], "weights": [np.array([float(1 << 23), 0.0, 0.0])]}), 5)


@pytest.mark.parametrize("chunk", [16384, 40])
def test_near_vectors_match_brute_force(spark, chunk):
    rows = vectors()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in J.near_vectors(
        frame(spark, rows + ODD), 0.9, block_dims=4, chunk=chunk).collect()}
    u = J.unit(np.array([v for _, v in rows]))
    ids = [i for i, _ in rows]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    label = list(ids)
    changed = True
    while changed:
        new = [min([label[a]] + [label[b] for b in np.flatnonzero(linked[a])]) for a in range(len(ids))]
        changed, label = new != label, new
    for k, i in enumerate(ids):
        assert got[i] == (int(linked[k].sum()), label[k], label[k] == i), i
    assert all(got[i] == (0, i, True) for i, _ in ODD)
    assert J.near_vectors(frame(spark, ODD), 0.9).count() == len(ODD)


def test_every_length_is_joined(spark):
    """Links within a less common length count as those within the commonest."""
    base = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, [float(i == j) for j in range(8)]) for i in range(8)] + [(20, base), (21, [1.0, 2.0, 3.0, 4.1]), (22, base), (23, [-1.0, 0.0, 0.0, 0.0])]
    rows += [(30, [2.0]), (31, [3.0]), (40, [1.0, 1.0]), (41, [1.0, 1.0]), (50, [1.0] * 3)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in J.near_vectors(frame(spark, rows + ODD), 0.9).collect()}
    want = {i: (0, i) for i, _ in rows + ODD} | {20: (2, 20), 21: (2, 20), 22: (2, 20), 30: (1, 30), 31: (1, 30), 40: (1, 40), 41: (1, 40)}
    assert got == want


def test_crowded_groups_are_counted_like_sparse_ones(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE", 16)
    test_near_vectors_match_brute_force(spark, 16384)


def test_licenses(spark, docs):
    words = " ".join(f"w{k}" for k in range(3000))
    rows = [(1, f"{words} Licensed under the Apache License, Version 2.0. {words}"), (2, "released UNDER the mit license!"), (3, "the MIT license"),
            (4, None), (5, ""), (2, "released UNDER the mit license!"), (6, L.TEMPLATES["BSD-text"].replace("binary", "other")),
            (7, "x " + L.TEMPLATES["MIT-text"][:-25])]
    got = sorted((r.doc_id, r.license, r.first_word) for r in L.scan(docs(rows)).collect())
    assert got == [(1, "Apache-2.0", 3000), (2, "MIT", 0), (2, "MIT", 0), (7, "MIT-text", 1)]
    assert L.scan(docs(rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.scan(docs(rows), {"short": "too short"})


def test_common_notices_and_whole_texts(spark, docs):
    """Every template finds its own text, in other layout and case, and of the notices no other."""
    names = sorted(L.TEMPLATES)
    assert {"LGPL-2.1-notice", "MPL-2.0-notice", "CC-BY-SA-4.0", "CC0-notice", "ISC", "GPL-3-body", "Apache-2.0-body"} <= set(names)
    rows = [(k, "intro: " + "\n".join(L.TEMPLATES[n].upper().split()) + " end") for k, n in enumerate(names)]
    got = {}
    for r in L.scan(docs(rows)).collect():
        got.setdefault(names[r.doc_id], set()).add(r.license)
    whole = {"MIT-full": {"MIT-text"}}
    assert all(n in got[n] for n in names)
    assert {n: got[n] - {n} for n in names if not n.endswith("-body")} == {n: whole.get(n, set()) for n in names if not n.endswith("-body")}
    assert not any(m.endswith("-body") for n in names for m in got[n] - {n})


def test_a_notice_of_one_shingle_is_found_whatever_stands_beside_it(spark):
    notice = L.TEMPLATES["MIT"]
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("x " + notice + " v"), F.col("id")).alias("text"))
    assert L.scan(rows, {"MIT": notice}).count() == 60_000


def _plain_shingles(text, size=5):
    w = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def edited(words, rng, share):
    """Words of a template with some changed, lost or added."""
    out = []
    for w in words:
        how = rng.random()
        out += [w] if how > share else [[], ["changed"], [w, "added"]][int(3 * how / share)]
    return out


def test_edited_copies_are_retrieved_as_the_bands_promise(spark, docs):
    """Every copy that keeps 80 % of a template's shingles is found, and nothing else, for templates of all levels."""
    rng = random.Random(8)
    vocabulary = [f"t{k}" for k in range(4000)]
    templates = {f"n{n}": " ".join(rng.sample(vocabulary, n + 4)) for n in (1, 2, 4, 5, 6, 9, 19, 20, 21, 40, 130, 700)}
    rows = []
    for name, text in templates.items():
        for share in (0.0, 0.01, 0.03, 0.04, 0.05) * 12:
            pad = [f"p{rng.randrange(500)}" for _ in range(rng.randrange(9))]
            rows.append((len(rows), " ".join(pad + edited(text.split(), rng, share) + pad)))
    sets = {n: _plain_shingles(t) for n, t in templates.items()}
    want = {(i, n) for i, t in rows for n, own in sets.items() if 100 * len(own & _plain_shingles(t)) >= 80 * len(own)}
    got = [(r.doc_id, r.license) for r in L.scan(docs(rows), templates).collect()]
    assert set(got) == want and len(got) == len(want) > 300
    met = {(r.doc_id, r.license) for r in L.retrieved(docs(rows), L.template_table(spark, templates)).select("doc_id", "t.license").collect()}
    assert want <= met < {(i, n) for i, t in rows for n, own in sets.items() if own & _plain_shingles(t)} | want


def test_windows_of_single_permutations_are_those_of_the_array(spark):
    """Permutations given one by one (cheaper to read) make the band values of the array of them; a shingle's hash is that of its words."""
    texts = [" ".join(f"w{k * k % 13}" for k in range(n)) for n in range(24)]
    rows = spark.createDataFrame([(t,) for t in [*texts, None, " ,, ", "...a b c d e."]], "text string")
    rows = rows.select(L.words(F.col("text")).alias("w")).withColumn("sh", L.shingles(F.col("w")))
    plain = F.expr("CASE WHEN size(w) < 5 THEN array() ELSE transform(sequence(0, size(w) - 5), i -> "
                   "xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])) END")
    assert all(list(r.sh) == list(r.plain) for r in rows.withColumn("plain", plain).collect())
    each = [F.col("sh")] + [F.get(L.permuted(F.col("sh")), j) for j in range(1, L.BANDS)]
    for _, length, stride in L.LEVELS:
        both = rows.select(L.signatures(F.col("sh"), each, length, stride).alias("a"),
                           L.signatures(F.col("sh"), L.permuted(F.col("sh")), length, stride).alias("b"), F.size("sh").alias("n"))
        for r in both.collect():
            windows = len(range(0, r.n - length + 1, stride))
            assert r.a == r.b and len(r.a) == windows * (1 if length == 1 else L.BANDS)


def test_bands_collide_at_the_stated_rate(spark):
    """Windows with i of u shingles in common share a band with probability 1 - (1 - i(i - 1)/(u(u - 1)))^2."""
    n = 20_000
    pairs = spark.range(n).select(
        F.expr("transform(sequence(0, 7), i -> xxhash64(id, i))").alias("a"), F.expr("transform(sequence(2, 9), i -> xxhash64(id, i))").alias("b"))
    sides = pairs.select(*[L.signatures(F.col(c), L.permuted(F.col(c)), 8, 8).alias(c) for c in "ab"])
    rate = sides.filter(F.arrays_overlap("a", "b")).count() / n
    assert abs(rate - (1 - (1 - 6 * 5 / (10 * 9)) ** 2)) < 0.02


def test_templates_beyond_one_literal_are_scanned_in_groups(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "MOST", 40)
    rows = [(1, "released under the mit license"), (2, L.TEMPLATES["BSD-text"] + " " + L.TEMPLATES["MPL-2.0-notice"]), (3, None)]
    few = {k: L.TEMPLATES[k] for k in ("MIT", "BSD-text", "MPL-2.0-notice", "CC0-notice", "MIT-full")}
    assert len(L._groups(L.template_table(spark, few))) > 1
    assert sorted((r.doc_id, r.license) for r in L.scan(docs(rows), few).collect()) == [(1, "MIT"), (2, "BSD-text"), (2, "MPL-2.0-notice")]


PAGES = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "x y\nz", ""), (5, "http://c", "z" * 700_000),
         (None, "http://d", "<p>é</p>"), (6, "http://e", "own")]


def test_bundles_round_trip(spark, tmp_dir):
    folder = scratch(spark, "warc")
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    W.write_bundles(pages.coalesce(2), folder)
    rows = {r.page_id: r for r in W.read_bundles(spark, folder).collect()}
    assert len(rows) == len(PAGES)
    assert (rows[1].record_type, rows[1].refers_to, bytes(rows[1].payload)) == ("revisit", 2, b"")
    assert (rows[2].record_type, rows[2].refers_to, bytes(rows[2].payload).decode()) == ("response", None, "<p>é</p>")
    assert (rows[3].record_type, rows[3].refers_to, rows[3].payload_bytes) == ("revisit", 4, 0)
    assert rows[1].payload_digest == rows[2].payload_digest and rows[1].payload_bytes == 9 and rows[None].record_type == "response"
    assert len(rows[5].payload) == 700_000
    assert [r.page_id for r in W.read_bundles(spark, folder, spark.createDataFrame([(6,)], "page_id long")).collect()] == [6]
    index = spark.read.parquet(f"{folder}/index").collect()
    for r in index:  # a frame is a stream of its own, and a bundle read in one go is the same records
        assert W.read_frame(f"{folder}/bundles/{r.bundle}", r.frame)[r.at:].startswith(b"WARC/1.1\r\n")
    name = index[0].bundle
    with open(f"{folder}/bundles/{name}".removeprefix("file:").replace("//", "/", 1), "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == sum(r.bundle == name for r in index)
    smaller = W.decided(pages, min_bytes=5).filter("refers_to IS NOT NULL").collect()
    assert [(r.page_id, r.refers_to) for r in smaller] == [(1, 2)]


def test_many_frames_are_read_by_several_tasks(spark):
    folder = scratch(spark, "warc")
    rng = random.Random(3)
    rows = [(i, f"http://{i}", "".join(rng.choices("abcdefgh <>", k=150_000))) for i in range(24)] + [(5, "http://again", "own"), (5, "http://twice", "own")]
    W.write_bundles(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    back = W.read_bundles(spark, folder)
    used = back.select(F.spark_partition_id().alias("p"), "page_id").distinct().groupBy("p").count()
    assert used.count() > 1
    assert sorted((r.page_id, r.url) for r in back.collect()) == sorted((i, u) for i, u, _ in rows)  # repeated ids are rows of their own
    none = scratch(spark, "warc")
    W.write_bundles(spark.createDataFrame([], "page_id long, url string, html string"), none)
    assert W.read_bundles(spark, none).count() == 0


def test_rates_of_repeated_rows_and_of_no_weight(spark, docs):
    rows = [(1, "a" * 9, "en", "s")] * 3 + [(2, "b" * 29, "en", "t"), (3, None, "en", None)]
    got = {r.source: (r.size, r.rate) for r in X.rates(docs(rows)).collect()}
    sizes = {"s": 30, "t": 30, None: 1}
    roots = sum(math.sqrt(n) for n in sizes.values())
    assert {k: v[0] for k, v in got.items()} == sizes
    assert all(abs(got[k][1] - math.sqrt(n) / roots * 61 / n) < 1e-12 for k, n in sizes.items())
    drawn = [r["count"] for r in X.mix(docs(rows), growth=3.0).filter("doc_id = 1").groupBy("copy").count().collect()]
    assert set(drawn) <= {3}  # rows that repeat draw the same
    assert X.mix(docs(rows), spark.createDataFrame([("none", 1.0)], "source string, weight double")).count() == 0


def test_mix_draws_poisson_counts(spark, docs):
    rows = [(i, "t" * 9, "en", ["a", "b", None][i % 3]) for i in range(6000)] + [(9000, None, "en", "a")]
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    out = X.mix(docs(rows), weights).cache()
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"a", "b"} and abs(n["a"] / n["b"] - 3) < 0.35 and abs(n["a"] + n["b"] - 6000) < 400
    again = X.mix(docs(rows), weights)
    assert sorted(out.select("doc_id", "copy").collect()) == sorted(again.select("doc_id", "copy").collect())
    keys = [r.shuffle_key for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys) and X.mix(docs(rows).limit(0)).count() == 0
    table = {r.source: r for r in X.distribution(spark.createDataFrame(
        [("s", 1, 2.5), ("t", 1, 5000.0)], "source string, size long, rate double")).collect()}
    exact = [sum(math.exp(-2.5) * 2.5 ** i / math.factorial(i) for i in range(k + 1)) for k in range(12)]
    assert table["s"].base == 0 and np.allclose(table["s"].cdf[:12], exact) and abs(table["t"].cdf[-1] - 1) < 1e-9


def test_language_profiles(spark, docs):
    rng = random.Random(1)
    syllables = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "er", "ung", "ein"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[g], k=3)) for _ in range(60)), g) for i in range(60) for g in [["xx", "yy"][i % 2]]]
    rows += [(100, None, "xx"), (101, "1234 !!", "xx"), (102, "", None), (103, "schererung", None), (None, "kalomi tumi", "xx")]
    got = {r.doc_id: r for r in R.identify(docs(rows)).collect()}
    assert all(got[i].lang_pred == g for i, _, g in rows[:60])
    assert [got[i].lang_pred for i in (100, 101, 102, 103, None)] == ["und", "und", "und", "yy", "xx"]
    assert all(0 <= r.score <= 1 for r in got.values()) and {r.held_out for r in got.values()} == {True, False}
    assert {r.lang_pred for r in R.identify(docs([(1, "text", None)])).collect()} == {"und"}


def _plain_profile(texts, most):
    """N-grams of one to three letters in order of frequency, words between marks, from plain strings."""
    n = {}
    for text in texts:
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        padded = " " + " ".join(words) + " " if words else " "
        for size in (1, 2, 3):
            for i in range(len(padded) - size + 1):
                g = padded[i:i + size]
                if g != " " and not (size == 3 and g[1] == " "):
                    n[g] = n.get(g, 0) + 1
    key = lambda g: [1 if c == " " else ord(c) for c in g]
    return sorted(n.items(), key=lambda x: (-x[1], key(x[0])))[:most]


def _plain_prediction(text, profiles):
    if not any(c.isalpha() for c in (text or "").lower()):
        return "und", 0.0
    own = _plain_profile([text], R.OWN)
    place = {g: sum(k for k, (_, m) in enumerate(own) if m == n) / sum(m == n for _, m in own) for g, n in own}
    longest = max(len(p) for p in profiles.values())
    far = {lang: sum(min(abs(p[g] - place[g]), longest) if g in p else longest for g in place) for lang, p in profiles.items()}
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (longest * len(place))


def test_language_equals_plain_profiles(spark, docs):
    """Profiles, ranks and distances written out with strings and dictionaries give the same languages and scores."""
    rng = random.Random(11)
    letters = {"aa": "abcdeé", "bb": "bcdfgñ", "cc": "aeioußж"}
    def text(lang, n):
        return "".join(rng.choice(letters[lang] + "   .,1") for _ in range(n))
    rows = [(i, text(lang, rng.choice([1, 5, 40, 400])), lang) for i, lang in enumerate(list(letters) * 30)]
    rows += [(200, "", "aa"), (201, None, "bb"), (202, "x" * 5000, None), (203, "ab ab ab", None), (204, "12", None)] * 2
    learned = [r for r in rows if r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    profiles = {lang: {g: k for k, (g, _) in enumerate(_plain_profile([t for _, t, own in learned if own == lang], R.PROFILE))} for lang in letters}
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in R.identify(docs(rows)).collect())
    assert got == sorted((i, lang, round(score, 9)) for i, (lang, score) in ((i, _plain_prediction(t, profiles)) for i, t, _ in rows))
    assert R.identify(docs(rows).limit(0)).count() == 0


def test_a_table_of_many_letters_has_letters(spark, docs):
    """160 ideographs with gaps between them: all n-grams tie, and those at word edges come first."""
    table = " ".join(chr(0x4E00 + k) for k in range(160))
    keys = R.ranked(*R.grams(table), R.OWN)[0]
    assert not (keys & ((1 << 42) - 1) == 0).any()
    rows = [(i, "一 丁 七 万", "zh") for i in range(9)] + [(100, table, None), (101, "12 !", None)]
    got = {r.doc_id: r.lang_pred for r in R.identify(docs(rows)).collect()}
    assert got[100] == "zh" and got[101] == "und"


def test_grams_of_a_long_text_do_not_depend_on_chunks(monkeypatch):
    text = "Hällo wörld, ünd so weiter. " * 50
    whole = R.grams(text)
    monkeypatch.setattr(R, "CHUNK", 37)
    parts = R.grams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
