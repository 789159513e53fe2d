"""Block trees of web pages, for the extraction operator.

A page becomes a tree of block elements with the runs of text between block boundaries as
leaves; phrase-level markup (links, emphasis, spans) belongs to the run it stands in. The reader
never fails: unclosed, crossed and unknown tags are taken as browsers take the usual cases.
"""

from __future__ import annotations

import re
from html import unescape

#: Fixed names of the markup language.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt
    ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose inside is not markup.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
#: Elements that never show text of their own page.
UNSEEN = frozenset("""script style title xmp iframe noembed noframes noscript template svg math head object applet canvas audio
    video select datalist textarea button""".split())
HEAD_ONLY = frozenset("title meta link style script base noscript template".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul""".split())
#: A start tag closes an open element of these names, looked for up to a boundary.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"caption"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
#: Open elements at most; beyond, a new element is taken as a sibling of the innermost one, as browsers do.
DEEPEST = 512

P_BOUNDARY = frozenset("table td th caption button html body".split())

NAME = re.compile(r"[A-Za-z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))?)?|(=|["']))""")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Node:
    """A block element, or a run of text where ``tag`` is ``#text``."""

    __slots__ = ("tag", "parent", "attributes", "text", "linked")

    def __init__(self, tag: str, parent: int, attributes: dict, text: str = "", linked: int = 0):
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.text, self.linked = text, linked  # linked: characters of the run within links


def parse(html: str) -> list[Node]:
    """The nodes of a page, parents before children, in page order. Unseen elements and white space leave no node."""
    nodes = [Node("#page", -1, {})]
    stack: list[tuple[str, int, bool]] = [("#page", 0, False)]  # name, nearest block node, unseen
    run: list[str] = []
    links, linked, paragraphs = 0, 0, 0

    def flush():
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                nodes.append(Node("#text", stack[-1][1], {}, text, linked))
            run.clear()
            linked = 0

    def pop_to(depth: int):
        """Leave open elements down to ``depth``; a block that ends, ends the run."""
        nonlocal links, paragraphs
        for name, _, _ in stack[depth:]:
            links -= name == "a"
            paragraphs -= name == "p"
        if any(name not in INLINE for name, _, _ in stack[depth:]):
            flush()
        del stack[depth:]

    def data(text: str):
        nonlocal linked
        if stack[-1][0] == "head" and text.strip():
            pop_to(len(stack) - 1)
        if not stack[-1][2]:
            text = unescape(text)
            run.append(text)
            if links:
                linked += len(text)

    def close_open(names, boundary):
        for depth in range(len(stack) - 1, 0, -1):
            name = stack[depth][0]
            if name in names:
                return pop_to(depth)
            if name in boundary:
                return None
        return None

    at, n = 0, len(html)
    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            data(html[at:])
            break
        if mark > at:
            data(html[at:mark])
        after = html[mark + 1:mark + 2]
        if after in ("!", "?"):
            if html.startswith("<!-->", mark) or html.startswith("<!--->", mark):
                end = html.find(">", mark)
            elif html.startswith("<!--", mark):
                end = html.find("-->", mark + 4)
                end = end if end < 0 else end + 2
            elif html.startswith("<![CDATA[", mark):
                end = html.find("]]>", mark)
                if end > 0:
                    data(html[mark + 9:end].replace("&", "&amp;"))
                    end += 2
            else:
                end = html.find(">", mark)
            at = n if end < 0 else end + 1
            continue
        if after == "/":
            found = NAME.match(html, mark + 2)
            end = html.find(">", mark)
            at = n if end < 0 else end + 1
            if found:
                name = found.group().lower()
                if name in ("body", "html") or name == "br":
                    if name == "br":
                        data(" ")
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == name:
                        pop_to(depth)
                        break
                    if name in INLINE and stack[depth][0] not in INLINE:
                        break  # an inline end tag does not leave a block
                    if stack[depth][0] in ("td", "th") and name not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot"):
                        break
            continue
        found = NAME.match(html, mark + 1)
        if not found:
            data("&lt;")
            at = mark + 1
            continue
        name, attributes, at, closed = found.group().lower(), {}, found.end(), False
        while at < n:
            if html[at] == ">":
                closed, at = True, at + 1
                break
            piece = ATTRIBUTE.match(html, at)
            if not piece:
                at += 1
                continue
            at = piece.end()
            if piece.group(1):
                value = piece.group(2) or piece.group(3) or piece.group(4) or ""
                attributes.setdefault(piece.group(1).lower(), unescape(value) if "&" in value else value)
        if not closed:
            break  # the page ends within a tag
        if stack[-1][0] == "head" and name not in HEAD_ONLY:
            pop_to(len(stack) - 1)
        if name in ("html", "body") and any(s[0] == name for s in stack):
            continue
        if paragraphs and name in CLOSES_P:
            close_open({"p"}, P_BOUNDARY)
        if name in IMPLIED:
            close_open(*IMPLIED[name])
        elif name in ("h1", "h2", "h3", "h4", "h5", "h6") and stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6"):
            pop_to(len(stack) - 1)
        elif name == "a":
            close_open({"a"}, CLOSES_P | P_BOUNDARY)
        if name in RAW:
            end = ENDS[name].search(html, at)
            at = n if end is None else html.find(">", end.end()) + 1 or n
            continue
        unseen = stack[-1][2] or name in UNSEEN
        if len(stack) >= DEEPEST and name not in VOID:
            pop_to(len(stack) - 1)
        if name in VOID:
            if name == "br":
                data(" ")
            elif name == "hr":
                flush()
            continue
        if name in INLINE or unseen:
            if name not in INLINE and name != "button":
                flush()
            stack.append((name, stack[-1][1], unseen))
            links += name == "a"
        else:
            flush()
            nodes.append(Node(name, stack[-1][1], attributes))
            stack.append((name, len(nodes) - 1, False))
            paragraphs += name == "p"
    flush()
    return nodes
