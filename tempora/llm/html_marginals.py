"""HTML extraction (operator 12): main text by marginals of a tree-structured graphical model.

The block tree of a page (``dom``) is a Markov random field: every node is main (it holds text of
the article) or not, a potential of its own features, and one between parent and child. Messages
are summed up the tree and then down it, which gives every node's exact marginal; runs of text
whose marginal passes one half are the main text, in page order. The potentials are fitted to
labelled pages by the likelihood of their labels, with the same messages giving the gradient.

``fit`` takes at most ``MOST_PAGES`` labelled pages; the pages of ``html_training`` are the default.
Labels are attributes of the markup: ``data-main`` on an element whose text is main, ``data-off``
within it on one whose text is not.

Defined cases: null or empty html, and pages without main text, give the empty text; repeated rows
are kept; broken markup is read as browsers read it; pages are taken whole, however long; elements
nested deeper than 512 count as siblings; an empty table gives no rows; only ``page_id``, ``url``
and ``html`` are read, so other columns may have any name; null ids and urls stay null.
"""

from __future__ import annotations

import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tempora.llm.dom import Node, parse

#: Labelled pages that ``fit`` takes at most.
MOST_PAGES = 2_000
#: Steps and strength of the fit.
STEPS, STEP, RIDGE = 300, 0.15, 0.003
#: Characters of html whose trees are held at once in a task.
BLOCK_CHARS = 4_000_000

SCHEMA = "page_id long, url string, text string, n_chars long"

#: Fixed words of class, id and role names, by what they hint at.
CUES = {
    "comments": "comment comments commentlist disqus respond response responses reply replies discussion discussions guestbook reactions",
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination tabs skip sitemap toolbar links",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsense "
              "dfp outbrain taboola commercial affiliate",
    "side": "sidebar side aside widget widgets related recommended recommendations popular trending rail teaser teasers "
            "complementary latest also",
    "notice": "cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog toast banner "
              "infobar announcement paywall privacy message warning",
    "share": "share sharing social facebook twitter follow",
    "foot": "footer foot copyright legal contentinfo bottom colophon imprint credits",
    "head": "header head masthead topbar top logo branding",
    "form": "form login signin signup register subscribe subscription newsletter search survey poll contact",
    "main": "article content main post entry story body text prose hentry blog maincontent articlebody",
    "meta": "byline author date meta tags tag category timestamp published",
}
CUE_OF = {word: cue for cue, words in CUES.items() for word in words.split()}
NAMES = ("class", "id", "role", "itemprop")
#: Tags with a feature of their own.
TAGS = frozenset("""#page html body div p article main section nav aside header footer form ul ol li dl dt dd table tbody thead tr
    td th h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption address fieldset legend details summary dialog menu hgroup
    center""".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _cues(node: Node) -> set[str]:
    found = set()
    for name in NAMES:
        for token in node.attributes.get(name, "").split():
            hints = {CUE_OF.get(w.lower()) for w in WORDS.findall(token)}
            found |= hints - {"main"} if hints - {"main", "meta", None} else hints  # post-comments are comments
    style = node.attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in node.attributes or "display:none" in style or "visibility:hidden" in style:
        found.add("hidden")
    return found - {None}


def _level(value: float, steps: tuple) -> int:
    return sum(value >= s for s in steps)


class Forest:
    """The nodes of several pages as arrays: parents, levels from the root, and features."""

    def __init__(self, pages: list[list[Node]], features: dict[str, int], grow: bool = False):
        self.pages = pages
        self.first = np.cumsum([0] + [len(p) for p in pages])
        n = int(self.first[-1])
        self.parent, depth = np.empty(n, np.int64), np.zeros(n, np.int64)
        rows, columns = [], []
        for page, base in zip(pages, self.first.tolist()):
            size, linked, runs = ([0] * len(page) for _ in range(3))
            for k in range(len(page) - 1, -1, -1):
                node = page[k]
                if node.tag == "#text":
                    size[k], linked[k], runs[k] = len(node.text), min(node.linked, len(node.text)), 1
                if k:
                    size[node.parent] += size[k]
                    linked[node.parent] += linked[k]
                    runs[node.parent] += runs[k]
            for k, node in enumerate(page):
                self.parent[base + k] = base + node.parent if k else -1
                if k:
                    depth[base + k] = depth[base + node.parent] + 1
                for name in self._names(node, page, size[k], linked[k], runs[k]):
                    column = features.setdefault(name, len(features)) if grow else features.get(name)
                    if column is not None:
                        rows.append(base + k)
                        columns.append(column)
        self.rows, self.columns = np.array(rows, np.int64), np.array(columns, np.int64)
        self.leaf = np.array([node.tag == "#text" for page in pages for node in page], np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if n else []

    @staticmethod
    def _names(node: Node, page: list[Node], size: int, linked: int, runs: int):
        dense = _level(linked / size if size else 0.0, (0.01, 0.35, 0.75))
        if node.tag == "#text":
            yield f"run in {page[node.parent].tag if page[node.parent].tag in TAGS else 'other'}"
            yield f"run links {dense}"
            yield f"run size {_level(size, (20, 80, 250))}"
            if node.text[:1] in "©" or node.text[:3].lower() == "(c)":
                yield "run copyright"
            return
        yield f"tag {node.tag if node.tag in TAGS else 'other'}"
        for cue in sorted(_cues(node)):
            yield f"cue {cue}"
        if node.parent >= 0:
            yield f"links {dense}"
            yield f"size {_level(size, (1, 80, 400, 1500))}"
            yield f"runs {_level(runs, (2, 5, 15))}"

    def messages(self, own: np.ndarray, pair: np.ndarray):
        """Sum-product over the forest. ``own`` holds a log potential of every node for either
        state, ``pair[leaf]`` one of (parent's state, child's state). Returns the marginals of
        nodes, those of (parent, child) pairs, and the log of every normaliser's sum."""
        up = own.copy()  # log of own potential times the messages of all children
        sent = np.zeros_like(own)  # log message of a node to its parent
        for level in reversed(self.levels[1:]):
            scores = pair[self.leaf[level]] + up[level][:, None, :]
            sent[level] = np.logaddexp(scores[:, :, 0], scores[:, :, 1])
            np.add.at(up, self.parent[level], sent[level])
        down = np.zeros_like(own)  # log message of the parent to a node
        joint = np.zeros((len(own), 2, 2))
        for level in self.levels[1:]:
            above = up[self.parent[level]] + down[self.parent[level]] - sent[level]
            scores = above[:, :, None] + pair[self.leaf[level]]
            down[level] = np.logaddexp(scores[:, 0, :], scores[:, 1, :])
            joint[level] = scores + up[level][:, None, :]
        belief = up + down
        norm = np.logaddexp(belief[:, 0], belief[:, 1])
        marginal = np.exp(belief - norm[:, None])
        joint = np.exp(joint - norm[:, None, None])
        roots = self.levels[0] if self.levels else []
        return marginal, joint, float(norm[roots].sum())


class Model:
    """Weights of the features for the main state, and the potentials of pairs."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, pair: np.ndarray):
        self.features, self.weights, self.pair = features, weights, pair

    def marginals(self, pages: list[list[Node]]) -> list[np.ndarray]:
        """The probability of being main for every node of every page."""
        forest = Forest(pages, self.features)
        return np.split(forest.messages(forest_scores(forest, self.weights), self.pair)[0][:, 1], forest.first[1:-1])

    def texts(self, pages: list[list[Node]]) -> list[str]:
        """The main text of every page, blocks joined by line feeds."""
        return ["\n".join(n.text for n, p in zip(page, chance) if n.tag == "#text" and p > 0.5)
                for page, chance in zip(pages, self.marginals(pages))]


def forest_scores(forest: Forest, weights: np.ndarray) -> np.ndarray:
    own = np.zeros((len(forest.parent), 2))
    own[:, 1] = np.bincount(forest.rows, weights[forest.columns], minlength=len(own))
    return own


def labels(page: list[Node]) -> list[int]:
    """Which nodes of a labelled page are main: runs by the nearest mark above them, elements that hold such a run."""
    marked, out = [0] * len(page), [0] * len(page)
    for k, node in enumerate(page):
        above = marked[node.parent] if k else 0
        marked[k] = 1 if "data-main" in node.attributes else 0 if "data-off" in node.attributes else above
        out[k] = above if node.tag == "#text" else 0
    for k in range(len(page) - 1, 0, -1):
        out[page[k].parent] |= out[k]
    return out


def fit(labelled: list[str]) -> Model:
    """Potentials of greatest (penalised) likelihood on labelled pages."""
    if len(labelled) > MOST_PAGES:
        raise ValueError(f"at most {MOST_PAGES} labelled pages")
    pages, features = [parse(h) for h in labelled], {}
    truth = np.array([y for page in pages for y in labels(page)])
    forest = Forest(pages, features, grow=True)
    weights, pair = np.zeros(len(features)), np.zeros((2, 2, 2))
    inner = forest.parent >= 0
    seen = np.bincount(forest.columns, truth[forest.rows], minlength=len(features))
    seen_pair = np.zeros((2, 2, 2))
    np.add.at(seen_pair, (forest.leaf[inner], truth[forest.parent[inner]], truth[inner]), 1)
    moment = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(pair), np.zeros_like(pair)]
    for t in range(1, STEPS + 1):
        marginal, joint, _ = forest.messages(forest_scores(forest, weights), pair)
        slope = seen - np.bincount(forest.columns, marginal[forest.rows, 1], minlength=len(features)) - RIDGE * len(pages) * weights
        due = np.zeros_like(pair)
        np.add.at(due, forest.leaf[inner], joint[inner])
        slope_pair = seen_pair - due - RIDGE * len(pages) * pair
        for value, g, a, b in ((weights, slope, *moment[:2]), (pair, slope_pair, *moment[2:])):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            value += STEP * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)
    return Model(features, weights, pair)


@lru_cache(maxsize=1)
def default_model() -> Model:
    from tempora.llm.html_training import pages
    return fit(pages())


def _extract(batches, model: Model):
    def flush(rows):
        texts = model.texts([parse(h) for _, _, h in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
             pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    rows, held = [], 0
    for batch in batches:
        for page_id, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            rows.append((page_id, url, html.as_py() or ""))
            held += len(rows[-1][2]) + 1000
            if held >= BLOCK_CHARS:
                yield flush(rows)
                rows, held = [], 0
    if rows:
        yield flush(rows)


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, the main text of the whole html and its length in code points."""
    run = partial(_extract, model=model or default_model())
    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
