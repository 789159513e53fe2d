"""The pipeline's stages on a small table: what each drops, keeps and changes."""

import corpus_pipeline as C
from tests.llm.test_secrets import plain

WORDS = " ".join(["the", "of", "and", "inging", "hethe", "ertion", "ening", "onan", "thand", "reti", "ofthe", "ander"])
COPY = " ".join(a + b for a in ["the", "of", "and", "ing", "he"] for b in ["er", "ti", "on", "th", "re", "in"])


def test_stages(spark, docs):
    rows = [(i, f"{WORDS} {' '.join(WORDS.split()[(i * k) % 12] for k in range(30))} n{i}", "en", f"s{i % 2}") for i in range(20)]
    rows += [(100, COPY, "en", "s0"), (101, COPY + " tail", "en", "s1"), (101, COPY + " tail", "en", "s1"), (102, "4711 !", "en", "s0"),
             (103, None, "en", "s0"), (104, "the token = 'abcdef123456' and of the ander thand", None, None)]
    d = docs(rows).drop("component_id")
    counts = {}
    for name, stage in C.STAGES:
        d = C.stored(stage(spark, d, ""), name)
        counts[name] = {r.doc_id for r in d.select("doc_id").collect()}
        if name == "secrets":
            masked = d.filter("doc_id = 104").first()
            assert "[secret]" in masked.text and "abcdef123456" not in masked.text and masked.n_chars == len(masked.text)
        if name != "packing":
            assert d.columns == C.COLUMNS
    everything = {r[0] for r in rows}
    assert counts["language_id"] == everything - {102, 103}
    assert counts["near_duplicates"] >= {100, 104} and 101 not in counts["near_duplicates"]
    assert counts["secrets"] == counts["near_duplicates"]
    assert counts["packing"] == counts["mix"] <= counts["secrets"]


def test_rows_that_repeat_are_copies(spark, docs):
    out = C.near_duplicates(spark, docs([(1, COPY), (1, COPY), (2, "else"), (None, "free"), (3, COPY)]), "")
    assert sorted((r.doc_id, r.text[:4]) for r in out.collect() if r.doc_id) == [(1, COPY[:4]), (2, "else")]
    assert out.filter("doc_id IS NULL").count() == 1


def test_of_repeated_rows_the_smallest_stays(spark):
    rows = [(1, COPY, "en", s, n) for s, n in (("t", 1), (None, 9), ("s", 2))] + [(2, "own words", "en", "t", 4), (2, "own words", "en", "s", 5)]
    for turn in (rows, rows[::-1]):
        d = spark.createDataFrame(turn, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
        out = sorted((r.doc_id, r.source, r.n_chars) for r in C.near_duplicates(spark, d, "").collect())
        assert out == [(1, None, 9), (2, "s", 5)]


def test_secrets_of_copies_and_odd_rows_are_masked(spark, docs):
    """Every row's text with each of its plain findings masked, overlapping ones as one."""
    texts = ["token=abcdef123 and password: hunter22", "secret=0123456789abcdef01234567", None, "", "plain", "x" * 300_000 + " api_key=zzzzzzz"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (1, "plain"), (None, texts[0])]

    def masked(text):
        out, at = "", 0
        for a, _, b, _ in plain(text):
            out, at = (out + text[at:a] + "[secret]", b) if a >= at else (out, max(at, b))
        return text if text is None else out + text[at:]

    got = sorted((str(r.doc_id), str(r.text)) for r in C.secrets(spark, docs(rows), "").collect())
    assert got == sorted((str(i), str(masked(t))) for i, t in rows)


def test_a_group_keeps_a_document_where_rows_share_a_doc_id(spark, docs):
    other = " ".join(f"b{k}" for k in range(60))
    out = C.near_duplicates(spark, docs([(1, COPY), (7, COPY), (7, other), (9, other + " tail")]), "")
    assert [r.doc_id for r in out.collect()] == [1]


def test_rows_without_a_doc_id_stay_whether_or_not_others_repeat(spark, docs):
    for more in ([], [(1, COPY)]):
        out = C.near_duplicates(spark, docs([(None, "free"), (None, "free"), (1, COPY), (2, "else"), *more]), "")
        assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "None", "None"]


def test_an_empty_table_goes_through(spark, docs):
    d = docs([(1, "x")]).drop("component_id").limit(0)
    for name, stage in C.STAGES:
        d = C.stored(stage(spark, d, ""), name)
        assert d.count() == 0
