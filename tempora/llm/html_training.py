"""Labelled pages for the extraction model: layouts written by hand, with filler text by rule.

``data-main`` marks an element whose text is main, ``data-off`` one within it whose text is not.
In a layout, ``{p}`` is a long paragraph, ``{s}`` a sentence, ``{w}`` a few words, ``{u}`` list items that are
links and ``{b}`` some paragraphs of the article, among them very short ones. Every layout is taken with
several lengths, and again without its names and with its structural tags as plain ``div``s.
"""

from __future__ import annotations

import random
import re

LAYOUTS = [
    """<head><title>{w}</title></head><body><nav><ul>{u}</ul></nav><div class="ad">{s}</div>
    <article data-main><h1>{w}</h1>{b}</article><footer>&copy; {w} &middot; {s}</footer></body>""",
    """<body><header class="site-header"><a href="/">{w}</a><p>{s}</p><nav><a href="a">{w}</a> <a href="b">{w}</a></nav></header>
    <main><article data-main><h1>{w}</h1>{b}<h2>{w}</h2>{b}</article><section id="comments"><h2>{w}</h2><ol class="comment-list">
    <li><cite>{w}</cite><p>{p}</p></li><li><cite>{w}</cite><p>{s}</p></li></ol></section></main>
    <aside class="sidebar"><h3>{w}</h3><ul>{u}</ul><p>{p}</p></aside><footer><p>{s}</p><p>&copy; {w}</p></footer></body>""",
    """<body><div id="wrapper"><div id="top"><ul class="menu">{u}</ul></div><div id="content"><div class="post" data-main><h2
    class="entry-title"><a href="x">{w}</a></h2><div class="entry-content">{b}</div><div class="share" data-off><a>{w}</a> <a>{w}</a></div>
    </div><div class="comments"><div class="comment"><p class="comment-author">{w}</p><div class="comment-content"><p>{p}</p></div></div>
    </div></div><div id="sidebar"><div class="widget"><h3>{w}</h3><ul>{u}</ul></div><div class="widget"><p>{s}</p></div></div>
    <div id="footer"><p>{s} <a href="x">{w}</a></p></div></div></body>""",
    """<body><div class="cookie-banner" role="dialog"><p>{p}</p><button>{w}</button></div><div class="page"><div class="main" data-main>
    <h1>{w}</h1>{b}{b}</div></div><div class="newsletter"><p>{s}</p><form><label>{w}</label><input><button>{w}</button></form></div>
    <div class="legal"><p>{s}</p></div></body>""",
    """<body><nav class="navbar">{w} <a href="x">{w}</a></nav><article class="story" data-main><header><h1>{w}</h1><p class="byline">{w}</p>
    </header>{b}<div class="advert" data-off>{s}</div>{b}<figure><img src="x"><figcaption>{s}</figcaption></figure><aside class="related" data-off>
    <h3>{w}</h3><ul>{u}</ul></aside>{b}<footer data-off><p>{w} <a href="t">{w}</a></p></footer></article>
    <div id="disqus_thread"><h3>{w}</h3><p>{p}</p><p>{s}</p></div><footer class="site-footer">{s}</footer></body>""",
    """<body><table><tr><td class="menu"><a href="a">{w}</a> <a href="b">{w}</a> <a href="c">{w}</a></td><td data-main><h1>{w}</h1>{b}{b}</td></tr>
    <tr><td colspan="2" class="copyright">&copy; {w} {s}</td></tr></table></body>""",
    """<body><nav><ol class="breadcrumb">{u}</ol></nav><main data-main><h1>{w}</h1>{b}<ul><li>{w}</li><li>{s}</li><li><a href="x">{w}</a></li></ul>
    <pre>{s}</pre><blockquote><p>{s}</p></blockquote><table><tr><th>{w}</th><th>{w}</th></tr><tr><td>{w}</td><td>{w}</td></tr></table>
    <dl><dt>{w}</dt><dd>{s}</dd></dl>{b}</main><div class="pagination"><a href="1">{w}</a> <a href="2">{w}</a></div><footer>{s}</footer></body>""",
    """<body><form id="aspnetForm"><div class="header"><h1>{w}</h1><p>{s}</p></div><div class="content" data-main><h2>{w}</h2>{b}{b}</div>
    <div class="footer"><ul>{u}</ul><p>{s}</p></div></form></body>""",
    """<body><div class="modal" id="signup"><h2>{w}</h2><p>{p}</p></div><section class="promo"><p>{p}</p></section><div role="alert">{s}</div>
    <section class="article-body" data-main><h1>{w}</h1>{b}{b}{b}</section><section class="recommended"><h2>{w}</h2><p>{s}</p><p>{s}</p></section>
    <div role="contentinfo">{s}</div></body>""",
    """<body data-main><h1>{w}</h1>{b}{b}</body>""",
    """<body><div data-main><h1>{w}</h1>{b}{b}</div></body>""",
    """<body data-main>{p}<br><br>{p}</body>""",
    """<body><header><h1><a href="/">{w}</a></h1></header><ul class="nav">{u}</ul><h2>{w}</h2><ul>{u}{u}</ul><footer><p>&copy; {w}</p></footer></body>""",
    """<body><div role="banner"><a href="/">{w}</a></div><div role="navigation">{u}</div><div role="main" data-main><h1>{w}</h1>{b}<h3>{w}</h3>{b}
    <ol><li><p>{s}</p></li><li><p>{w}</p></li></ol></div><div role="complementary"><h4>{w}</h4><p>{p}</p></div>
    <div role="search"><form><label>{w}</label></form></div></body>""",
    """<body><nav><ul>{u}</ul></nav><div class="notice"><p>{p}</p></div><article data-main><h1>{w}</h1><p>{w}</p>{b}<div class="ads" data-off>
    <p>{p}</p></div><section><h2>{w}</h2>{b}</section></article><aside><p>{p}</p><p>{p}</p></aside>
    <section class="comments"><article class="comment"><p>{p}</p></article><article class="comment"><p>{s}</p><p>{w}</p></article>
    <form class="reply"><label>{w}</label><p>{s}</p></form></section></body>""",
    """<body><div class="container"><div class="row"><div class="col" data-main><h1>{w}</h1>{b}{b}</div><div class="col"><h4>{w}</h4><ul>{u}</ul>
    <h4>{w}</h4><ul>{u}</ul></div></div></div><div class="bottom"><a href="a">{w}</a> | <a href="b">{w}</a> {w}</div></body>""",
    """<body><div id="header"><h1>{w}</h1></div><div id="nav">{u}</div><div id="main"><div class="article" data-main><h2>{w}</h2>
    <p class="meta">{w}</p>{b}<p>{s} <a href="x">{w}</a> {s}</p>{b}</div><div class="related-posts"><h3>{w}</h3><p><a href="x">{s}</a></p>
    <p><a href="x">{s}</a></p></div><div class="post-comments"><h3>{w}</h3><p>{p}</p><p>{p}</p><p>{s}</p></div></div>
    <div class="sponsored"><p>{p}</p></div></body>""",
    """<body><div class="popup">{s}</div><header><p>{s}</p></header><main><h1 data-main>{w}</h1><div data-main>{b}</div><div class="subscribe"><h3>{w}</h3>
    <p>{s}</p></div><div data-main>{b}</div><div class="social">{w} <a href="a">{w}</a></div></main><footer><div><p>{p}</p></div></footer></body>""",
    """<body><article data-main><h1>{w}</h1>{b}<form data-off><p>{s}</p><label>{w}</label></form><nav data-off><a href="a">{w}</a> <a href="b">{w}</a></nav>
    {b}<section class="comments" data-off><h2>{w}</h2><div><p>{p}</p></div><div><p>{s}</p></div></section></article></body>""",
    """<body><div class="topbar">{s}</div><div class="layout"><aside class="toc"><ul>{u}</ul></aside><article data-main><h1>{w}</h1>{b}
    <div class="note"><p>{s}</p></div><details><summary>{w}</summary><p>{s}</p></details>{b}</article></div>
    <div class="cookie-consent"><p>{p}</p><p><a href="p">{w}</a></p></div></body>""",
    """<body><nav>{w} <a href="a">{w}</a></nav><main><article data-main><h1>{w}</h1>{b}{b}</article><div id="comments"><p>{p}</p><p>{p}</p><p>{s}</p></div>
    <ul class="comments"><li><p>{p}</p></li><li>{s}</li></ul></main><footer><p>{p}</p></footer></body>""",
    """<body><div class="page-header"><p>{s}</p></div><section class="content" data-main><h1>{w}</h1>{b}<p class="notice" data-off>{s}</p>{b}
    <p class="advertisement" data-off>{p}</p><div class="sidebar" data-off><p>{p}</p><p>{s}</p></div>{b}</section><section class="reader-comments">
    <div><p>{p}</p><p>{p}</p></div><div><p>{s}</p></div></section><div class="site-footer"><p>{p}</p></div></body>""",
    """<body><main><div class="post" data-main><h1>{w}</h1>{b}{b}</div><aside id="related"><h2>{w}</h2><p>{p}</p><p>{p}</p></aside>
    <section id="discussion"><h2>{w}</h2><ol><li><div><p>{p}</p></div></li><li><div><p>{p}</p><p>{s}</p></div></li></ol></section>
    <section class="subscribe"><h2>{w}</h2><p>{p}</p></section></main><div id="gdpr"><p>{p}</p><p>{s}</p></div></body>""",
    """<body><div class="ad-slot"><p>{p}</p><p>{p}</p></div><div id="sidebar-left"><p>{p}</p><p>{s}</p></div><div id="article" data-main><h1>{w}</h1>
    {b}{b}<div class="ad" data-off><p>{s}</p></div><div class="cookie-notice" data-off><p>{p}</p></div>{b}</div><div class="responses"><div
    class="response"><p>{p}</p></div><div class="reply"><p>{p}</p></div></div><div class="menu"><p>{w}</p><p>{w}</p></div></body>""",
    """<body><header><h2>{w}</h2><p>{p}</p></header><article data-main><header><h1>{w}</h1></header><section><h2>{w}</h2>{b}</section>
    <section>{b}</section><section class="comments" data-off><h3>{w}</h3><article><p>{p}</p></article><article><p>{p}</p></article></section>
    <form class="newsletter" data-off><p>{p}</p></form></article><section class="teasers"><article><h3>{w}</h3><p>{s}</p></article></section></body>""",
]
#: Kinds of article paragraphs, by weight of occurrence.
PARAGRAPHS = ["<p>{p}</p>"] * 4 + ["<p>{s}</p>"] * 3 + ["<p>{w}</p>", "<p>{s}<br>{s}</p>", "<p><b>{w}</b> {s}</p>",
              "<p><a href='x'>{w}</a></p>", "<p>{p} <a href='x'>{w}</a> {s}</p>", "<p><b>{s}<br>",
              "<h2>{w}</h2><p>{s}</p>", "<h3>{w}</h3><p>{p}</p>", "<ul><li>{w}</li><li>{s}</li><li><a href='x'>{w}</a></li></ul>",
              "<ol><li><p>{s}</p></li><li>{p}</li></ol>", "<blockquote><p>{s}</p></blockquote>", "<pre>{s}</pre>",
              "<table><tr><th>{w}</th><th>{w}</th></tr><tr><td>{w}</td><td>{s}</td></tr></table>", "<dl><dt>{w}</dt><dd>{s}</dd></dl>",
              "<figure><img src='x'><figcaption>{s}</figcaption></figure>", "<div>{p}</div>"]
NAMES = re.compile(r' (?:class|id|role)="[^"]*"')
PLAIN = re.compile(r"(</?)(?:article|main|section|nav|aside|header|footer)\b")
#: Fillings of every layout as it stands, and of each of its plainer forms (no names, no structural tags, no body).
FILLINGS, PLAINER, BARE = 6, 2, 2


def _fill(layout: str, rng: random.Random) -> str:
    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice("aeioubdklmnprst") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(low, high)))

    kinds = {"w": lambda: words(1, 4), "s": lambda: words(4, 16).capitalize() + ".",
             "p": lambda: " ".join(words(6, 18).capitalize() + "." for _ in range(rng.randint(2, 6))),
             "u": lambda: "".join(f'<li><a href="/{k}">{words(1, 3)}</a></li>' for k in range(rng.randint(3, 8))),
             "b": lambda: "".join(rng.choice(PARAGRAPHS) for _ in range(rng.choice((0, 1, 2, 4, 8, 12))))}
    out = re.sub(r"\{b\}", lambda _: kinds["b"](), layout)
    return re.sub(r"\{([wspu])\}", lambda m: kinds[m[1]](), out)


def pages(seed: int = 7, layouts: list[str] | None = None) -> list[str]:
    """The labelled pages, the same at every call."""
    rng, out = random.Random(seed), []
    for layout in layouts or LAYOUTS:
        forms = [layout] * FILLINGS + [NAMES.sub("", layout)] * PLAINER + [PLAIN.sub(r"\1div", layout)] * PLAINER
        forms += [re.sub("</?body>", "", layout)] * BARE
        out += ["<!DOCTYPE html><html>" + _fill(form, rng) + "</html>" for form in forms[:-BARE]]
        out += [_fill(form, rng) for form in forms[-BARE:]]
    return out
