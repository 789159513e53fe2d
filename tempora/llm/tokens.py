"""Token ids of whole texts, shared by the packing and token-output operators.

Ids come from the ``tokenizers`` library. A byte-level tokenizer cuts a text into groups by a fixed
pattern and encodes every group by itself, so the ids of a text are the ids of its groups one after
another. A unit is a word with the space or line feed before it and the signs behind it: one group or
several, cut where the text is split at spaces. Units repeat a lot: each worker keeps the ids of those
it has seen lately (two bounded memos; a full one takes the place of the older), and the library encodes the
new ones of many texts together, without its pattern, as no merge of the vocabulary goes beyond a group. This holds for texts of printable
ASCII, line feeds and Latin letters without special-token strings, where the pattern below is the
library's; other texts, and all texts of a tokenizer with another pre-tokenizer, a normalizer or merges across
groups, are encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np

#: Units that each of a worker's two memos may hold, the present one and the one before it; about 200 bytes each.
MEMO_GROUPS = 350_000
#: Characters of texts that are encoded together.
CHARS = 1_000_000
#: New units in one string for the library.
JOINED = 128
#: Longer units are encoded again whenever they come, so a full memo stays small.
LONG = 64

#: A space at the beginning of a byte-level token.
SPACE = "\u0120"
#: A line feed as a byte-level token.
LINE = "\u010a"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Texts that the pattern of groups is right for.
PLAIN = re.compile(f"[\n -~{LETTERS}]*")
# Fixed pattern of the byte-level pre-tokenizer, for the characters above.
GROUPS = re.compile(f" ?[{LETTERS}]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^\\s0-9{LETTERS}]+|\\s+(?!\\S)|\\s+")
#: White space whose groups are not single characters.
WIDE = re.compile(r"[ \n]{3}|[ \n]{2}\Z")
#: Before a unit that follows neither a space nor a line feed; no plain text has it.
BARE = "\r"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_kinds() -> dict[str, str]:
    """The byte-level characters of plain texts: letter, digit, sign, line feed or space. All bytes beyond ASCII are letters' there."""
    kinds = {chr(b): "letter" if chr(b).isalpha() else "digit" if chr(b).isdigit() else "sign" for b in range(33, 127)}
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that stand for themselves; the others come after 255
    other = iter(range(256, 512))
    named = {b: chr(b if b in shown else next(other)) for b in range(256)}
    first, last = "À".encode()[0], "ɏ".encode()[0]
    return kinds | {named[b]: "letter" for b in (*range(128, 192), *range(first, last + 1))} | {SPACE: "space", LINE: "line"}


def merges_within_groups(merges: Iterable[tuple[str, str]]) -> bool:
    """Whether no merge that a plain text can meet joins two groups: beyond the space before it, all of one kind. Contractions aside,
    whose units are cut into groups."""
    kinds = _byte_kinds()
    for pair in merges:
        token = "".join(pair)
        found = {kinds.get(c) for c in token[token[0] == SPACE:]}
        if len(found) > 1 and None not in found and "'" not in token:
            return False
    return True


class Encoder:
    """Ids of whole texts by one tokenizer file, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.full = Tokenizer.from_file(path)
        self.tokenizer = Tokenizer(self.full.model)  # the same bytes and merges, without the pattern
        self.tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        made = json.loads(self.full.to_str())
        cut, model = made["pre_tokenizer"] or {}, made["model"]
        self.by_groups = (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
                          and made["normalizer"] is None and model.get("type") == "BPE" and LINE in model["vocab"]
                          and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                             "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                          and all(t["content"].startswith("<|") for t in made["added_tokens"])
                          and merges_within_groups(m if isinstance(m, list) else m.split(" ") for m in model["merges"]))
        vocab = self.full.get_vocab()
        self.vocab_size = self.full.get_vocab_size()
        self.spaced = np.zeros(max(vocab.values(), default=0) + 1, bool)  # ids of tokens that begin with a space
        self.spaced[[n for token, n in vocab.items() if token.startswith(SPACE)]] = True
        self.line = vocab.get(LINE, -1)

    def whole(self, text: str) -> bytes:
        return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()

    @staticmethod
    def units(text: str) -> list[str]:
        """A plain text cut into units: without the space before them, from their line feed on, or behind BARE."""
        if any(blanks in text for blanks in ("  ", "\n\n", " \n", "\n ")) and WIDE.search(text):
            return [g[1:] if g[0] == " " and g[1:2] != "\n" else g if g[0] == "\n" else BARE + g for g in GROUPS.findall(text)]
        return (BARE + text).replace("\n", " \n").split(" ")

    def learn(self, units: list[str]) -> dict[str, bytes]:
        """The ids of distinct new units, encoded in one call: those behind a space one after another, where a token that
        begins with a space begins a unit, and other ones on lines of their own. Units with an apostrophe and blank ones are
        cut into their groups."""
        spaced, lines, bare, cut = [], [], [], []
        for unit in units:
            if "'" in unit or not unit.strip() or unit[0] == " ":
                cut.append(unit)
            elif unit[0] == BARE:
                bare.append(unit)
            else:
                (lines if unit[0] == "\n" else spaced).append(unit)
        groups = {u: GROUPS.findall(u[1:] if u[:1] == BARE else u if u[:1] == "\n" else " " + u) for u in cut}
        pieces = list(dict.fromkeys(g for found in groups.values() for g in found if not g.isspace()))
        on_lines = lines + ["\n" + unit[1:] for unit in bare] + ["\n" + g for g in pieces]
        texts = [" " + " ".join(spaced[a:a + JOINED]) for a in range(0, len(spaced), JOINED)]
        cuts = len(texts)
        texts += ["".join(on_lines[a:a + JOINED]) for a in range(0, len(on_lines), JOINED)]
        made = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

        def parts(found: list[list[int]], count: int, begins_unit, skip: int) -> list[bytes]:
            ids = np.fromiter(chain.from_iterable(found), "<u4")
            begins = np.flatnonzero(begins_unit(ids))
            ends = np.append(begins[1:], len(ids))
            if len(begins) != count or (count and begins[0]) or (ends <= begins + skip).any():
                raise ValueError("the tokenizer's groups are not those of its pattern")
            data = ids.tobytes()
            return [data[a:b] for a, b in zip((4 * begins).tolist(), (4 * ends).tolist())]

        ids_of = dict(zip(spaced, parts(made[:cuts], len(spaced), lambda ids: self.spaced[ids], 0)))
        found = parts(made[cuts:], len(on_lines), lambda ids: ids == self.line, 1)
        ids_of.update(zip(lines, found))
        without = [ids[4:] for ids in found[len(lines):]]  # the line feed is not theirs
        ids_of.update(zip(bare, without))
        known = dict(zip(pieces, without[len(bare):]))
        ids_of.update((unit, b"".join(known.get(g) or self.whole(g) for g in its)) for unit, its in groups.items())
        return ids_of

    def known(self, units: list[str]) -> list[bytes]:
        """Ids of units, one after another."""
        found = list(map(self.memo.get, units))
        missed = [at for at, ids in enumerate(found) if ids is None]
        if missed:
            new = list(dict.fromkeys(units[at] for at in missed))
            if len(self.memo) + len(new) > MEMO_GROUPS:
                self.memo, self.older, new = {}, self.memo, list(dict.fromkeys(units))
            got = dict(zip(new, map(self.older.get, new)))
            learnt = self.learn([unit for unit, ids in got.items() if ids is None])
            got |= learnt
            if max(map(len, learnt), default=0) > LONG:
                self.memo.update((unit, ids) for unit, ids in got.items() if len(unit) <= LONG)
            else:
                self.memo.update(got)
            for at in missed:
                found[at] = got[units[at]]
        return found

    def _gathered(self, held: list[bytes | None], units: list[str], ends: list[int]) -> Iterator[bytes]:
        """What is held, with the ids of its units in place of None; ``ends`` are the texts' among the units."""
        found = self.known(units)
        cuts = pairwise([0, *ends])
        for ids in held:
            if ids is None:
                a, b = next(cuts)
                ids = b"".join(found[a:b])
            yield ids

    def each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of every whole text, in order; null counts as empty."""
        held, units, ends, size = [], [], [], 0
        for text in texts:
            if not text:
                held.append(b"")
            elif not self.by_groups or "<|" in text or not PLAIN.fullmatch(text):
                held.append(self.whole(text))
            else:
                units += self.units(text)
                held.append(None)
                ends.append(len(units))
            size += len(text or "") + 1
            if size >= CHARS:
                yield from self._gathered(held, units, ends)
                held, units, ends, size = [], [], [], 0
        yield from self._gathered(held, units, ends)

    def ids(self, text: str | None) -> bytes:
        """Ids of the whole text; null counts as empty."""
        return next(self.each([text]))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
