"""Main-text extraction by a tree-structured graphical model over the DOM.

Every block element is a binary variable: part of the article or not.  An element's
own potential is log-linear in its tag, the words of its class, id and role, and the
length and links of its text; a potential on every parent-child edge ties an element
to its parent.  On a tree the sum-product algorithm is exact: one pass of messages
up, one down, and each element has its marginal.  Elements of a marginal of 1/2 or
more give their text.  The weights maximise the conditional likelihood of labelled
pages (:mod:`tomeflow.llm.html_pages` writes these); the gradient is the difference
between labels and marginals.

A batch of pages is one forest, worked off level by level in numpy.  Work is per
row: no shuffle, memory of one Arrow batch.

Defined results: null or empty html gives the empty text; broken, cut-off and very
long pages are read as far as they go; repeated rows and null identifiers pass
through; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tomeflow.llm import html_pages
from tomeflow.llm.batches import small_batches

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    # Formulas are text; their parts stand in it without spaces.
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics".split()
)
#: Elements whose content is not page text; those of the first kind hold raw text, which an end tag alone ends.
RAW_TEXT = frozenset("script style noscript iframe title textarea xmp".split())
SKIPPED = RAW_TEXT | frozenset("template svg annotation annotation-xml object canvas audio video head".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: An opening tag ends an open element of these, unless one of the barriers is between.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

TAGS = (
    "html body div section article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption "
    "nav header footer aside form fieldset button label select option legend menu details summary address dialog center hr"
).split()

#: Groups of words in class, id and role; a name's part belongs to a group if it starts with one of these.
WORDS = {
    "content": "article content post entry story body main text prose",
    "advert": "ad ads adv advert adsense banner sponsor promo dfp outbrain taboola",
    "menu": "nav menu breadcrumb crumb pagination pager tabs toolbar toc skip",
    "comment": "comment reply replies disqus respond discussion feedback guestbook review reader",
    "foot": "foot copyright legal imprint colophon",
    "head": "header masthead topbar logo branding site",
    "side": "side aside widget related recommend rail more popular trending teaser tag",
    "notice": "cookie consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall message announcement privacy banner",
    "share": "share social follow facebook twitter meta byline author date",
    "form": "form search login input contact button field",
}
_WORDS = [(group, tuple(words.split())) for group, words in WORDS.items()]
LENGTHS = (0, 1, 4, 10, 25, 60)

FEATURES = (
    [f"tag {t}" for t in TAGS]
    + ["tag other"]
    + [f"name {g}" for g in WORDS]
    + [f"own words {n}" for n in LENGTHS]
    + [f"all words {n}" for n in LENGTHS]
    + ["own links", "all links", "sentence", "copyright", "hidden", "bias"]
)
INDEX = {f: i for i, f in enumerate(FEATURES)}
#: Edges by the kind of child: text-level elements follow their parent more closely than containers.
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre figcaption ul ol dl".split())


@functools.lru_cache(maxsize=20_000)
def _name_features(attrs: str) -> tuple[int, ...]:
    out = set()
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("hidden", "aria-hidden") and value.lower() != "false" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            out.add(INDEX["hidden"])
        elif name in ("class", "id", "role", "itemprop"):
            parts = [p.lower() for p in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value)]
            for part in parts:
                for group, words in _WORDS:
                    # Short words count as whole parts only: "ad" is an advert, "address" is not.
                    if any(part == w or len(w) > 3 and part.startswith(w) for w in words):
                        out.add(INDEX[f"name {group}"])
    return tuple(out)


class Page:
    """Block elements of a page, parents before children, and its text in runs, each owned by an element."""

    __slots__ = ("tags", "parents", "names", "runs", "words", "linked", "ends", "copyright")

    def __init__(self, source: str):
        self.tags, self.parents, self.names = ["html"], [-1], [()]
        self.runs: list[tuple[int, str, int]] = []  # element, text, words of it in links
        self._parse(source)
        n = len(self.tags)
        self.words, self.linked = [0] * n, [0] * n
        self.ends, self.copyright = [False] * n, [False] * n

    def _parse(self, source: str) -> None:
        stack = [0]
        text: list[str] = []
        linked: list[tuple[int, str]] = []
        anchor = False
        tags, parents, names, runs = self.tags, self.parents, self.names, self.runs

        def end_run() -> None:
            if text:
                runs.append((stack[-1], "".join(text), sum(len(t.split()) for a, t in linked if a)))
                text.clear()
                linked.clear()

        at, size = 0, len(source)
        while at < size:
            m = TOKEN.search(source, at)
            stop = m.start() if m else size
            if stop > at:
                piece = html_lib.unescape(source[at:stop])
                text.append(piece)
                linked.append((anchor, piece))
            if not m:
                break
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            closing = bool(m["close"] or m["close2"])
            attrs = m["attrs"] or m["attrs2"] or ""
            if tag in SKIPPED:
                if not closing and (tag in RAW_TEXT or not attrs.endswith("/")):
                    if tag == "head":  # its elements are skipped one by one: a head may lack its end tag
                        continue
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    if end or tag in RAW_TEXT:
                        at = end.end() if end else size
                continue
            if tag in ("br", "hr", "wbr"):
                if tag != "wbr":
                    text.append("\n")
                    linked.append((False, "\n"))
                continue
            if tag in VOID or tag in ("html", "body") and closing:
                continue
            if tag in INLINE:
                if tag == "a":
                    anchor = not closing
                continue
            end_run()
            anchor = False
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == tag:
                        del stack[k:]
                        break
                continue
            if tag == "html" or tag == "body" and "body" in tags:
                continue
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == "p":
                        del stack[k:]
                        break
                    if tags[stack[k]] in ("button", "td", "th", "table", "div", "section", "article", "li"):
                        break
            if tag in SIBLINGS:
                ends, barriers = SIBLINGS[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] in barriers:
                        break
                    if tags[stack[k]] in ends:
                        del stack[k:]
                        break
            parents.append(stack[-1])
            tags.append(tag)
            names.append(_name_features(attrs) if attrs.strip() else ())
            stack.append(len(tags) - 1)
        end_run()

    def features(self) -> list[list[int]]:
        """Indices of the features that each element has."""
        n = len(self.tags)
        own, links = [0] * n, [0] * n
        for node, text, in_links in self.runs:
            words = len(text.split())
            own[node] += words
            links[node] += in_links
            tail = text.rstrip()[-1:]
            if tail and tail in ".!?…。！？:;\"»”":
                self.ends[node] = True
            if "©" in text or "All rights reserved" in text:
                self.copyright[node] = True
        every, every_links = own[:], links[:]
        for node in range(n - 1, 0, -1):
            every[self.parents[node]] += every[node]
            every_links[self.parents[node]] += every_links[node]
        out = []
        for node in range(n):
            f = [INDEX["bias"], INDEX.get(f"tag {self.tags[node]}", INDEX["tag other"]), *self.names[node]]
            f.append(INDEX[f"own words {max(x for x in LENGTHS if x <= own[node])}"])
            f.append(INDEX[f"all words {max(x for x in LENGTHS if x <= every[node])}"])
            if own[node] and 2 * links[node] > own[node]:
                f.append(INDEX["own links"])
            if every[node] and 2 * every_links[node] > every[node]:
                f.append(INDEX["all links"])
            if self.ends[node]:
                f.append(INDEX["sentence"])
            if self.copyright[node]:
                f.append(INDEX["copyright"])
            out.append(f)
        return out

    def text(self, keep) -> str:
        """Kept runs in page order, white space inside a run made one space."""
        runs = (" ".join(text.split()) for node, text, _ in self.runs if keep[node])
        return " ".join(r for r in runs if r)


class Forest:
    """Many trees as arrays: parents, levels from the roots, kinds of edges."""

    def __init__(self, pages: list[Page]):
        base, parents, kinds = 0, [], []
        for page in pages:
            parents += [p + base if p >= 0 else -1 for p in page.parents]
            kinds += [int(t in TEXT_LEVEL) for t in page.tags]
            base += len(page.parents)
        self.parent, self.kind = np.array(parents, np.int64), np.array(kinds, np.int64)
        depth = np.zeros(base, np.int64)
        for i, p in enumerate(parents):
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if base else []

    def marginals(self, own: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum-product: log odds of own potentials and ``edges[kind, parent, child]`` to marginals.

        Returns the probability of 1 for every node, the joint ``[node, parent, child]`` of every
        edge (zero at roots) and the log-partition function of each root.
        """
        n = len(self.parent)
        below = np.zeros((n, 2))  # own potential and messages from children
        below[:, 1] = own
        up = np.zeros((n, 2))  # message to the parent
        for level in reversed(self.levels[1:]):
            scores = edges[self.kind[level]] + below[level][:, None, :]
            up[level] = np.logaddexp(scores[:, :, 0], scores[:, :, 1])
            np.add.at(below, self.parent[level], up[level])
        above = np.zeros((n, 2))  # message from the parent
        joint = np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            p = self.parent[level]
            rest = above[p] + below[p] - up[level]  # what the parent knows without this child
            scores = edges[self.kind[level]] + rest[:, :, None]
            above[level] = np.logaddexp(scores[:, 0, :], scores[:, 1, :])
            full = scores + below[level][:, None, :]
            full -= full.max(axis=(1, 2), keepdims=True)
            e = np.exp(full)
            joint[level] = e / e.sum(axis=(1, 2), keepdims=True)
        total = above + below
        roots = self.levels[0] if self.levels else np.zeros(0, np.int64)
        z = np.logaddexp(below[roots, 0], below[roots, 1])
        return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -60, 60))), joint, z


class Model:
    """Weights of the features and of the edges."""

    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights, self.edges = weights, edges

    def content(self, pages: list[Page]) -> list[np.ndarray]:
        """For each page, the marginal of every element."""
        if not pages:
            return []
        own = np.array([self.weights[f].sum() for page in pages for f in page.features()])
        p, _, _ = Forest(pages).marginals(own, self.edges)
        return np.split(p, np.cumsum([len(page.tags) for page in pages])[:-1])

    def extract(self, sources: list[str | None]) -> list[str]:
        pages = [Page(s or "") for s in sources]
        return [page.text(p >= 0.5) for page, p in zip(pages, self.content(pages))]


def fit(labelled: list[str], rounds: int = 300, ridge: float = 0.002) -> Model:
    """Weights by gradient ascent on the conditional likelihood of labelled pages.

    A labelled page is its source, in which elements of the article carry the attribute
    ``data-main="1"`` and others ``data-main="0"``; an element without it has its parent's label.
    """
    pages, labels = [], []
    for source in labelled:
        page = Page(source)
        marks = _marks(source, page)
        pages.append(page)
        labels += marks
    y = np.array(labels)
    forest = Forest(pages)
    rows = [f for page in pages for f in page.features()]
    x = np.zeros((len(rows), len(FEATURES)))
    for i, f in enumerate(rows):
        x[i, f] = 1
    inner = forest.parent >= 0
    truth = np.zeros((2, 2, 2))
    np.add.at(truth, (forest.kind[inner], y[forest.parent[inner]], y[inner]), 1)
    weights, edges = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(edges), np.zeros_like(edges)]
    for t in range(1, rounds + 1):
        p, joint, _ = forest.marginals(x @ weights, edges)
        g = x.T @ (y - p) / len(pages) - ridge * weights
        expected = np.stack([joint[inner & (forest.kind == k)].sum(axis=0) for k in (0, 1)])
        ge = (truth - expected) / len(pages) - ridge * edges
        for value, grad, m, v in ((weights, g, state[0], state[1]), (edges, ge, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.02 * (grad * grad - v)
            value += 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.98**t)) + 1e-8)
    return Model(weights, edges)


def _marks(source: str, page: Page) -> list[int]:
    """Labels of a page's elements, from the data-main attributes of the tags that made them."""
    opened = [m for m in TOKEN.finditer(source) if (m["tag"] or "").lower() in {*TAGS} and not m["close"] and m["tag"].lower() not in ("html", "hr")]
    out = [0]
    it = iter(opened)
    for tag, parent in zip(page.tags[1:], page.parents[1:]):
        m = next(it)
        if m["tag"].lower() != tag:
            raise ValueError(f"{tag} and {m['tag']} do not match")
        mark = re.search(r"data-main=\"([01])\"", m["attrs"])
        out.append(int(mark[1]) if mark else out[parent])
    return out


@functools.lru_cache(maxsize=1)
def trained() -> Model:
    return fit(html_pages.labelled_pages())


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` of every row, with ``text`` and ``n_chars``."""
    small_batches(pages.sparkSession)
    model = trained()
    n = len(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema) + ", text string, n_chars long"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                texts = model.extract(part.column(n).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"]
                )

    return pages.select(*keep, html_col).mapInArrow(extract, schema)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL: dict[str, str] = {}
