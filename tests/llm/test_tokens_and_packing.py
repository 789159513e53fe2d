"""Token ids, ORC round trip and packing against plain encoding."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tempora.llm import nnls_packing as P
from tempora.llm import orc_tokens as O
from tempora.llm.common import scratch
from tempora.llm.tokens import default_tokenizer, encoder

PLAIN = Tokenizer.from_file(default_tokenizer())
ROWS = [(3, "Hello wide world. " * 900), (1, "It's one,\nline.\n\nTwo  spaces\ttab é ñandú 日本 <|endoftext|>"), (2, None), (4, ""),
        (None, "no id"), (3, "again"), (3, "again"), (9, "w" * 70_000)]


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abZé ñ\n\t.,;:!?'s<|>1  日endoftext")), max_size=60))
def test_memo_equals_whole_text(text):
    assert encoder(default_tokenizer()).ids(text) == np.array(ids(text), dtype="<u4").tobytes()


def test_orc_round_trip(spark, docs):
    path = scratch(spark, "orc")
    O.write_tokens(docs(ROWS), path)
    rows = O.token_digest(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 3, 4, 9]
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    want = sorted(zlib.crc32(np.array(ids(t) + [2], dtype="<u4").tobytes()) for _, t in ROWS)
    assert sorted(r.ids_crc32 for r in rows) == want
    assert [list(r.ids) for r in O.lookup(spark, path, [2]).collect()] == [[2]]
    assert {tuple(r.ids) for r in O.read_tokens(spark, path).filter("doc_id = 1").collect()} == {tuple(ids(ROWS[1][1]) + [2])}
    empty = scratch(spark, "orc")
    O.write_tokens(docs(ROWS).limit(0), empty)
    assert O.token_digest(spark, empty).count() == 0


def check(rows, window):
    total = 0
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for pieces in by.values():
        at = 0
        for offset, length, tokens in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window and tokens == (at if at & (at - 1) == 0 else window)
        total += tokens - at
    assert sorted(by) == list(range(len(by)))
    return total


def test_packing_places_every_token_once(spark, docs):
    rows = P.pack(P.cut(docs(ROWS))).collect()
    assert sum(r.length for r in rows) == sum(len(ids(t)) + 1 for _, t in ROWS)
    for r in rows:
        assert len(r.ids) == 2 * r.length and zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32
        assert r.start % 2048 == 0 and r.start + r.length <= r.doc_tokens
    check(rows, 2048)
    assert P.pack(P.cut(docs(ROWS).limit(0))).count() == 0


def test_sequences_hold_the_tokens_of_their_pieces(spark, docs, monkeypatch):
    """The registered query and the pipeline's stage write sequences whose tokens are those of the plain encoding."""
    import corpus_pipeline as C
    from tempora.llm import queries as Q
    rows = ROWS + [(100 + i, f"text number {i} " * (i % 37 + 1)) for i in range(200)]
    made, write = [], P.write_sequences
    monkeypatch.setattr(P, "write_sequences", lambda packed, path: (made.append(path), write(packed, path)))
    monkeypatch.setattr(Q, "table", lambda *_: docs(rows))
    for out in (Q.op6_packing(spark, ""), C.packing(spark, docs(rows), "")):
        pieces = out.collect()
        check(pieces, 2048)
        stream = {}  # (sequence, offset) -> tokens of the piece there
        for s in spark.read.parquet(made[-1]).collect():
            at, tokens = 0, np.frombuffer(s.ids, "<u2").tolist()
            assert len(tokens) == s.tokens
            for doc_id, start, n in zip(s.doc_ids, s.starts, s.lengths):
                stream[s.sequence_id, at] = (doc_id, start, tokens[at:at + n], len(tokens))
                at += n
            assert not any(tokens[at:])
        want = sorted((str(i), at, (ids(t) + [1])[at:at + 2048]) for i, t in rows for at in range(0, len(ids(t)) + 1, 2048))
        assert sorted((str(d), at, k) for d, at, k, _ in stream.values()) == want
        for r in pieces:
            doc_id, start, tokens, padded = stream.pop((r.sequence_id, r.offset))
            assert (doc_id, start, len(tokens), padded) == (r.doc_id, r.start, r.length, r.sequence_tokens)
            assert zlib.crc32(np.array(tokens, dtype="<u4").tobytes()) == r.ids_crc32
        assert not stream
    empty = scratch(spark, "sequences")
    write(P.pack(P.cut(docs(rows).limit(0))), empty)
    assert P.sequence_digest(spark, empty).count() == 0


def test_batches_do_not_split_sequences(spark, docs, monkeypatch):
    import pyarrow as pa
    rows = pa.RecordBatch.from_pydict({"sequence_id": [3, 3, 4, 9], "offset": [0, 2, 0, 0], "doc_id": [1, 2, 1, None], "start": [0, 0, 2, 0],
                                       "length": [2, 1, 2, 1], "doc_tokens": [4, 1, 4, 1], "sequence_tokens": [4, 4, 2, 1],
                                       "ids": pa.nulls(4, pa.binary())})
    for kind in ("<u2", "<u4"):  # a small and a large vocabulary
        cells = pa.array([np.array(x, kind).tobytes() for x in ([5, 6], [7], [8, 9], [1])], pa.binary())
        held = rows.set_column(rows.num_columns - 1, "ids", cells)
        for step in (1, 2, 3, 4):
            out = pa.Table.from_batches(P._fill([held.slice(k, step) for k in range(0, 4, step)], 0)).to_pydict()
            assert [np.frombuffer(x, kind).tolist() for x in out["ids"]] == [[5, 6, 7, 0], [8, 9], [1]]
            assert out["sequence_id"] == [3, 4, 9] and out["tokens"] == [4, 2, 1] and out["doc_ids"] == [[1, 2], [1], [None]]


def test_a_tokenizer_with_another_cut_is_encoded_whole(tmp_path):
    """The memo is for the byte-level pattern alone; a prefix space makes the same file another tokenizer."""
    import json
    made = json.load(open(default_tokenizer()))
    made["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(made))
    other = Tokenizer.from_file(str(path))
    for text in ("one two, three", "again"):
        want = np.array(other.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder(str(path)).ids(text) == want
    assert not encoder(str(path)).by_groups and encoder(default_tokenizer()).by_groups


def test_new_words_are_encoded_together_without_offsets():
    """The words of a text cost one call, and no offsets, which the library takes long to follow."""
    from tempora.llm.tokens import Encoder
    enc, calls = Encoder(default_tokenizer()), []

    class Fast:
        def encode_batch_fast(self, texts, add_special_tokens):
            calls.append(texts)
            return PLAIN.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    enc.tokenizer = Fast()
    text = " plain words, ñandú and plain antidisestablishmentarianism".replace(",", " of")
    assert enc.ids(text) == enc.ids(text) == np.array(ids(text), dtype="<u4").tobytes()
    assert len(calls) == 1


def test_new_groups_of_many_texts_are_encoded_together():
    """Words, and groups without a space or letters, of several texts cost one call; ids stay those of each whole text."""
    from tempora.llm.tokens import Encoder
    enc, calls = Encoder(default_tokenizer()), []

    class Fast:
        def encode_batch_fast(self, texts, add_special_tokens):
            calls.append(texts)
            return PLAIN.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    enc.tokenizer = Fast()
    texts = ["One text, it's new: 42 of 7!", None, "Ñandú and one, text's (second) 42 ...", "", "x"]
    want = [np.array(ids(t), dtype="<u4").tobytes() for t in texts]
    assert list(enc.each(texts)) == list(enc.each(iter(texts))) == want
    assert len(calls) == 1


def test_texts_are_encoded_in_order_across_chunks_and_full_memos(monkeypatch):
    from tempora.llm import tokens
    monkeypatch.setattr(tokens, "CHARS", 40)
    monkeypatch.setattr(tokens, "MEMO_GROUPS", 6)
    rng = np.random.default_rng(5)
    words = ["one", "two", "é", "\n", "  ", "3", "it's", "日", "<|endoftext|>", "."]
    texts = [None] + [" ".join(rng.choice(words, 6)) for _ in range(200)]
    assert list(tokens.Encoder(default_tokenizer()).each(texts)) == [np.array(ids(t), dtype="<u4").tobytes() for t in texts]


def test_a_word_and_the_signs_behind_it_are_one_unit():
    """Texts are cut at spaces and before line feeds; a repeated unit costs one look-up, whatever its groups."""
    from tempora.llm.tokens import Encoder
    enc = Encoder(default_tokenizer())
    assert enc.units("One (two), three.\nFour") == ["\rOne", "(two),", "three.", "\nFour"]
    text = "One (two), it's three!\nFour three! it's\n\nFour  (two), x " * 2
    assert enc.ids(text) == np.array(ids(text), dtype="<u4").tobytes()
    assert {"(two),", "three!", "it's", "\nFour", "\n"} < set(enc.memo)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", "é", " ", "  ", "\n", "\n\n", "'", "'s", "'ll", "!", ".", "_", "7", "<|", "\t", "x" * 70, "ab-c" * 20]), max_size=25))
def test_runs_of_blanks_apostrophes_and_long_units(parts):
    text = "".join(parts)
    assert encoder(default_tokenizer()).ids(text) == np.array(ids(text), dtype="<u4").tobytes()


def test_long_units_are_not_kept():
    from tempora.llm.tokens import LONG, Encoder
    enc, text = Encoder(default_tokenizer()), "short " + "a,b;c" * 500 + " short"
    for _ in range(2):
        assert enc.ids(text) == np.array(ids(text), dtype="<u4").tobytes()
    assert enc.memo and max(map(len, enc.memo)) <= LONG


def test_a_tokenizer_with_merges_across_groups_is_encoded_whole(tmp_path):
    """Its merges would join the words and signs of a unit if the pattern were left out."""
    import json
    made = json.load(open(default_tokenizer()))
    made["model"]["vocab"]["e."] = max(made["model"]["vocab"].values()) + 1 + len(made["added_tokens"])
    made["model"]["merges"].insert(0, "e ." if isinstance(made["model"]["merges"][0], str) else ["e", "."])
    path = tmp_path / "across.json"
    path.write_text(json.dumps(made))
    other = Tokenizer.from_file(str(path))
    assert not encoder(str(path)).by_groups
    text = "one. the file."
    assert encoder(str(path)).ids(text) == np.array(other.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_plan_uses_every_piece_and_wastes_little():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(2048, rng.lognormal(6, 1, 20_000).astype(int) + 1), minlength=2049)
    patterns = P.plan(counts.astype(np.int64))
    used = np.zeros(2049, dtype=np.int64)
    for lengths, n in patterns:
        assert sum(lengths) <= 2048
        for k in lengths:
            used[k] += n
    assert (used == counts).all()
    tokens = sum(sum(k) * n for k, n in patterns)
    assert tokens / (2048 * sum(n for _, n in patterns)) > 0.995


def test_combinations_fill_the_window():
    found = {tuple(c) for c in P.combinations(np.array([2, 3, 5, 8]), 10)}
    assert found == {(5, 5, 0), (8, 2, 0), (5, 3, 2)}
