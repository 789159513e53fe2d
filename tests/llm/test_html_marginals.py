"""Main text of pages: the page reader, exact marginals, labelled pages and whole texts."""

import html
import itertools
import re

import numpy as np
import pytest

from tempora.llm import html_marginals as H
from tempora.llm import html_training as T
from tempora.llm.dom import parse

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


@pytest.mark.parametrize("page, want", [
    ("", []), ("<script>var a='</p>'", []), ("a<div>b<p>c<div>d</div>e</div>f<!-- x", ["a", "b", "c", "d", "e", "f"]),
    ("<p><b>one &amp; two<br>three<p>x <a href=q>l</a>y", ["one & two three", "x ly"]), ("1 < 2 <3 &copy <b", ["1 < 2 <3 ©"]),
    ("<p>a\n\t b&nbsp;c<hr>d", ["a b c", "d"]), ("<title>t</title><head><style>p{}</style></head>x", ["x"]),
    ("<textarea><p>no</textarea><select><option>no</select><noscript>no</noscript>yes", ["yes"]),
    ('<p title="a>b" x=\'>\'>in</p>', ["in"]), ("<p>a</b></i></div>b", ["ab"]), ("<![CDATA[a&b]]>c", ["a&bc"]),
    ("<div>" * 3000 + "deep", ["deep"]), ("<svg><text>no</text></svg>ok", ["ok"]), ("<!DOCTYPE html", []),
])
def test_reader(page, want):
    assert [n.text for n in parse(page) if n.tag == "#text"] == want


def test_marginals_are_exact():
    page = parse("<article><h1>a</h1><p>some words here</p></article><div class=ad>x</div>")
    model = H.default_model()
    forest = H.Forest([page], model.features)
    own = H.forest_scores(forest, model.weights)
    total, chance = 0.0, np.zeros(len(page))
    for states in itertools.product((0, 1), repeat=len(page)):
        score = sum(own[k, s] for k, s in enumerate(states))
        score += sum(model.pair[forest.leaf[k], states[page[k].parent], states[k]] for k in range(1, len(page)))
        total += np.exp(score)
        chance += np.exp(score) * np.array(states)
    assert np.allclose(chance / total, model.marginals([page])[0])


def test_layouts_not_learned_from():
    """Left out of the fit, three layouts are read right from names and tags alone."""
    wrong = total = 0
    for i in (0, 7, 13, 23):
        model = H.fit(T.pages(layouts=T.LAYOUTS[:i] + T.LAYOUTS[i + 1:]))
        for page in T.pages(seed=11, layouts=[T.LAYOUTS[i]])[:T.FILLINGS]:
            nodes = parse(page)
            for node, truth, p in zip(nodes, H.labels(nodes), model.marginals([nodes])[0]):
                total += node.tag == "#text"
                wrong += node.tag == "#text" and (p > 0.5) != truth
    assert total > 300 and wrong <= 0.02 * total


def test_given_pages(spark):
    """In the given pages the article element is the main text."""
    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in frame.collect():
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        want[r.page_id] = "\n".join(b for b in blocks if b)
    got = H.main_text(frame).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_defined_cases(spark):
    long = "<article>" + "<p>many words in a paragraph, again.</p>" * 20_000 + "</article><footer>end</footer>"
    menu = "<nav><ul><li><a href=a>one</a></li><li><a href=b>two</a></li></ul></nav>"
    page = menu + "<article><h1>Head</h1><p>Some  text &amp; more.</p><p>No.</p></article>" \
        "<section class=comments><p>A reader writes a long comment here, all of it.</p></section><footer>&copy; us</footer>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, menu), (None, "u", page), (5, "u", page), (5, "u", page), (6, "u", long), (7, "u", "<p")]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = H.main_text(frame).collect()
    text = "Head\nSome text & more.\nNo."
    assert [(r.page_id, r.url) for r in got] == [r[:2] for r in rows]
    assert [r.text for r in got][:6] == ["", "", "", text, text, text] and got[7].text == ""
    assert got[6].text.count("\n") == 19_999 and got[6].n_chars == len(got[6].text)
    assert H.main_text(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        H.fit([""] * (H.MOST_PAGES + 1))
