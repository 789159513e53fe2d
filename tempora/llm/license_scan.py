"""License scans (operator 4). DataFrame functions only.

Notices and whole texts of known licenses are templates: sequences of hashed word shingles. A text is cut into
overlapping windows of a few shingles, a template into the windows of the same length at every place. A window's
MinHash signature is the minimum and the maximum of its shingles under each of ``BANDS`` permutations, a band of two rows each (the
maximum is the minimum under the reversed order); a text and a template meet when a band of a window of the one equals that of a
window of the other, which two windows with i shingles in common, of u in all, do with
probability 1 - (1 - i(i - 1)/(u(u - 1)))^BANDS. Retrieved templates are verified exactly: the share
of a template's distinct shingles that the document's whole shingle set contains.

The windows' lengths follow from ``percent`` = 80. A changed, lost or added word inside a stretch takes at least four shingles (of
five words), so a copy of n shingles that keeps 80 % of them has at most n/20 such breaks, and an unbroken stretch of at least
16n/(n + 20). ``LEVELS`` are chosen so that a window of the text lies wholly in that stretch (length + stride - 1 shingles at most): it
equals a window of the template, s is 1, and the copy is retrieved with certainty. This holds for any word edits of a template
without repeated shingles; where the kept shingles are also put in another order, the probability above is what is left.
A window of one shingle (templates of fewer than five) has that shingle as minimum and maximum, so the shingle is its signature.

All of this happens within a row; only documents that met a template are exploded, and only
their matches are grouped. The templates are a parameter; their signatures are literals of the plan, in groups of about ``MOST``
band values, and each group is one scan of the texts.

Words are runs of letters and digits, lower-cased. Defined cases: null, empty and short texts
match nothing (a template shorter than a shingle is refused); repeated rows match each; ties need
no order, as every matching template is returned; null doc_ids are carried; an empty table gives
no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from importlib.resources import files
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, BANDS = 5, 2
#: Templates of at least so many shingles: shingles of a window, and stride of the windows of a text.
LEVELS = ((1, 1, 1), (5, 3, 2), (20, 6, 3))
#: Band values of the templates of one scan: 8 bytes each in one literal of the plan.
MOST = 50_000

_GNU = "under the terms of the GNU %s Public License as published by the Free Software Foundation, either version %s of the License"


def _body(name: str) -> str:
    """The terms of a license, without the appendix on how to apply them."""
    return files("tempora.llm").joinpath("licenses", f"{name}.txt").read_text(encoding="utf-8").split("END OF TERMS AND CONDITIONS")[0]


# Notices of public licenses, as they are commonly written. Where two differ in a word, that word is in more
# than a fifth of the shingles of each, so one is not taken for the other.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
                "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
                "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
                "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
                "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies",
    "BSD-3-clause": "may be used to endorse or promote products derived from this software without specific prior written permission",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0-notice": _GNU % ("General", "2"),
    "GPL-3.0-notice": _GNU % ("General", "3"),
    "LGPL-2.1-notice": _GNU % ("Lesser General", "2.1"),
    "LGPL-3.0-notice": _GNU % ("Lesser General", "3"),
    "AGPL-3.0-notice": _GNU % ("Affero General", "3"),
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-short": "Licensed under CC BY 4.0",
    "CC-BY-SA-short": "Licensed under CC BY-SA 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0-notice": "has waived all copyright and related or neighboring rights to this work",
    "Unlicense": "This is free and unencumbered software released into the public domain",
} | {f"{name}-body": _body(name) for name in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0")}


def words(text: Column) -> Column:
    """Lower-case words of a text; null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(w: Column, size: int = WORDS) -> Column:
    """Hashes of the ``size``-word shingles, in order of the text."""
    count = F.greatest(F.size(w) - (size - 1), F.lit(0))
    # the hash of a struct is that of its fields, so a shingle is one expression instead of a few for each word
    return F.transform(F.arrays_zip(*[F.slice(w, k + 1, count) for k in range(size)]), lambda x: F.xxhash64(x))


def once(df: DataFrame, name: str, value: Column, *kept: str) -> DataFrame:
    """``kept`` columns and ``value``, computed once a row: a one-element explode, which the optimizer
    does not merge into the expressions above it (they would repeat it for every array element)."""
    return df.select(*kept, F.explode(F.array(value)).alias(name))


def permuted(sh: Column) -> Column:
    """The shingles under every permutation; under the first a shingle's hash is its own."""
    def under(k: int) -> Column:
        return F.transform(sh, lambda x: F.xxhash64(x, F.lit(k)))

    return F.array(sh, *[under(k) for k in range(1, BANDS)])


def signatures(sh: Column, perms: Column | list[Column], length: int, stride: int) -> Column:
    """Band values of the windows of ``length`` shingles that start at every ``stride``-th. ``perms`` is an array
    (of ``permuted``) or its elements, which are cheaper to read one by one."""
    if length == 1 and stride == 1:
        return sh

    def band(j: int) -> Column:
        own = perms[j] if isinstance(perms, list) else F.get(perms, j)

        def value(at: Column) -> Column:
            window = [F.get(own, at + i if i else at) for i in range(length)]  # cheaper than a slice of each
            return F.xxhash64(F.lit(length), F.lit(j), F.least(*window), F.greatest(*window))
        return F.transform(F.sequence(F.lit(0), F.size(sh) - length, F.lit(stride)), value)

    return F.when(F.size(sh) >= length, F.concat(*[band(j) for j in range(BANDS)])).otherwise(F.array().cast("array<bigint>"))


def _numbers(values) -> Column:
    """An array literal, folded from a string when planned: one node, not one for each number."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _member(known: set[int]):
    """Exact test for membership: the leading bits of a hash name a bucket, a short stretch of one literal."""
    bits = max(1, len(known).bit_length())
    at = sorted(known, key=lambda x: x % (1 << 64))
    sizes = Counter(x % (1 << 64) >> 64 - bits for x in at)
    ends = list(accumulate(sizes[b] for b in range(1 << bits)))
    values, starts = _numbers(at), _numbers([0, *ends])

    def test(x: Column) -> Column:
        bucket = F.shiftrightunsigned(x, 64 - bits).cast("int")
        first, end = F.get(starts, bucket).cast("int"), F.get(starts, bucket + 1).cast("int")
        return (end > first) & F.array_contains(F.slice(values, first + 1, end - first), x)

    return test


def template_table(spark, templates: dict[str, str], size: int = WORDS) -> list[tuple[str, list[int], list[int], int]]:
    """(name, distinct shingles, band values of the windows at every place, level) of every template."""
    rows = once(spark.createDataFrame(list(templates.items()), "name string, text string"), "w", words(F.col("text")), "name")
    rows = once(rows, "sh", shingles(F.col("w"), size), "name")
    rows = once(rows, "p", permuted(F.col("sh")), "name", "sh")
    own = F.array(*[signatures(F.col("sh"), F.col("p"), length, 1) for _, length, _ in LEVELS])
    table = []
    for r in rows.select("name", F.size("sh").alias("n"), F.array_distinct("sh").alias("s"), own.alias("keys")).collect():
        if not r.n:
            raise ValueError(f"templates need {size} words at least")
        level = max(k for k, (least, _, _) in enumerate(LEVELS) if r.n >= least)
        table.append((r.name, r.s, sorted(set(r["keys"][level])), level))
    return sorted(table)


def _groups(table: list) -> list[list]:
    """The templates in groups of at most MOST band values, or of one template."""
    groups, room = [], 0
    for row in table:
        if len(row[2]) > room:
            groups.append([])
            room = MOST
        groups[-1].append(row)
        room -= len(row[2])
    return groups


def retrieved(docs: DataFrame, table: list, size: int = WORDS) -> DataFrame:
    """(doc_id, sh, t): the shingles of every document and a template (license, s, k) that one of its windows meets."""
    hashed = once(once(docs, "w", words(F.col("text")), "doc_id"), "sh", shingles(F.col("w"), size), "doc_id")
    columns, perms = ["doc_id", "sh"], [F.col("sh")]
    for j in range(1, BANDS):
        hashed = once(hashed, f"p{j}", F.get(permuted(F.col("sh")), j), *columns)
        columns.append(f"p{j}")
        perms.append(F.col(f"p{j}"))
    hits = []
    for level, (_, length, stride) in enumerate(LEVELS):
        known = {x for _, _, keys, own in table if own == level for x in keys}
        if known:
            hits.append(F.filter(signatures(F.col("sh"), perms, length, stride), _member(known)))
    found = once(hashed, "hits", F.array_distinct(F.concat(*hits)), "doc_id", "sh").filter(F.size("hits") > 0)

    def part(lists: list, i: int) -> Column:
        end = sum(map(len, lists[:i + 1]))
        return F.struct(F.lit(end - len(lists[i]) + 1).alias("at"), F.lit(len(lists[i])).alias("n"))

    shingled, banded = [row[1] for row in table], [row[2] for row in table]
    s, k = (_numbers(x for own in lists for x in own) for lists in (shingled, banded))
    rows = F.array(*[F.struct(F.lit(row[0]).alias("license"), part(shingled, i).alias("s"), part(banded, i).alias("k"))
                     for i, row in enumerate(table)])
    literal = F.transform(rows, lambda t: F.struct(
        t["license"].alias("license"), F.slice(s, t["s"]["at"], t["s"]["n"]).alias("s"), F.slice(k, t["k"]["at"], t["k"]["n"]).alias("k")))
    return found.select("doc_id", "sh", F.explode(F.filter(literal, lambda t: F.arrays_overlap(t["k"], F.col("hits")))).alias("t"))


def _verified(met: DataFrame, percent: int) -> DataFrame:
    shared = F.array_intersect("sh", "t.s")  # in order of the text
    checked = met.select(
        "doc_id", F.col("t.license").alias("license"), F.size(shared).cast("long").alias("n_shared"),
        F.size("t.s").cast("long").alias("n_shingles"), (F.array_position("sh", F.get(shared, 0)) - 1).alias("first_word"))
    return checked.filter(100 * F.col("n_shared") >= percent * F.col("n_shingles"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = 80, size: int = WORDS) -> DataFrame:
    """(doc_id, license, n_shared, n_shingles, first_word) for every document of ``docs``
    (doc_id, text) and every template of which it contains ``percent`` of the shingles; first_word
    is the place (from 0) of the first of them."""
    table = template_table(docs.sparkSession, templates, size)
    return reduce(DataFrame.union, [_verified(retrieved(docs, group, size), percent) for group in _groups(table)])
