"""Main text of web pages by a tree-structured graphical model (operator 8).

Every block element and every run of text of a page is a node that is content or not. A
log-linear potential scores a node by its own features (tag, words of class, id and role,
length, share of link text), another one couples child and parent. Sum-product messages
upwards and downwards give each node's exact marginal; runs of text whose marginal
exceeds one half are the main text. The weights are trained by maximum likelihood on the
labelled pages of ``html_pages``.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from tamarind.llm.common import Shared, add_columns
from tamarind.llm.html_pages import LABEL, labelled_pages

# fixed values: HTML element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template head title iframe svg audio video datalist".split())
IN_HEAD = frozenset("html head title base basefont bgsound link meta script style template noscript noframes".split())
ENDS_SVG = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li menu nobr ol p
pre ruby s small span strong strike sub sup table tt u ul var""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr br img noscript object canvas map math mi mo mn ms mtext mrow mfrac msqrt
mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation mstyle mpadded
mphantom menclose merror mspace""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd""".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "option": {"select"}, "tbody": {"table"}}
SECTIONS = frozenset("article section main div body aside nav footer header form table blockquote fieldset td".split())

_NAMES = re.compile(r"[a-z]+")


class Page(HTMLParser):
    """Nodes of one page in document order (a parent before its children). Only a ``labelled``
    page's label attributes are read; on others they mean anything."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self, html: str, labelled: bool = True):
        super().__init__(convert_charrefs=True)
        self.parent, self.depth, self.tag, self.names = [-1], [0], ["#page"], [frozenset()]
        self.text, self.link, self.label, self.labelled = [""], [0], [0], labelled
        self.open: list[tuple[str, int]] = []  # (tag, node of the nearest block)
        self.at: dict[str, list[int]] = {}  # places of the open elements of each tag
        self.skip: list[str] = []  # a skipped element and the open ones within it
        self.skip_at: dict[str, list[int]] = {}
        self.run: list[str] = []
        self.in_link = self.link_chars = 0
        self.feed(html)
        self.close()
        self.flush()

    @property
    def block(self) -> int:
        return self.open[-1][1] if self.open else 0

    def node(self, tag, names, text="", link=0, label=None):
        self.parent.append(self.block)
        self.depth.append(self.depth[self.block] + 1)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.link.append(link)
        self.label.append(self.label[self.block] if label is None else label)

    def flush(self):
        """Ends the run of text of the current block."""
        text = " ".join("".join(self.run).split())
        if text:
            self.node("#text", frozenset(), text, min(self.link_chars, len(text)))
        self.run, self.link_chars = [], 0

    def push(self, tag: str, node: int):
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, node))

    def push_skip(self, tag: str):
        self.skip_at.setdefault(tag, []).append(len(self.skip))
        self.skip.append(tag)

    def drop_skip(self, at: int = 0):
        """Ends the skipped element's open ones from a place on; from the first: the element."""
        for tag in self.skip[at:]:
            self.skip_at[tag].pop()
        del self.skip[at:]

    def innermost(self, tags) -> int:
        """Place of the innermost open element of some tags, or -1."""
        return max((places[-1] for t in tags if (places := self.at.get(t))), default=-1)

    def pop_to(self, tags, scope=frozenset()):
        """Closes the innermost open element of ``tags`` and all within it, but none beyond ``scope``."""
        i = self.innermost(tags)
        if i < 0 or self.innermost(scope) > i:
            return
        closed = self.open[i:]
        if any(t not in INLINE for t, _ in closed):
            self.flush()
        for t, _ in closed:
            self.at[t].pop()
            self.in_link -= t == "a"
        del self.open[i:]

    def ends_skip(self, tag) -> bool:
        """Whether a start tag cannot stand in the skipped element, which then was not closed."""
        if self.skip[0] == "head":
            return tag == "body" or (tag not in IN_HEAD and self.skip[-1] in ("head", "noscript"))
        return self.skip[0] == "svg" and tag in ENDS_SVG and not any(self.skip_at.get(t) for t in ("foreignobject", "desc", "title"))

    def handle_starttag(self, tag, attrs):
        if self.skip and self.ends_skip(tag):
            self.drop_skip()
        if self.skip:
            if tag not in VOID:
                self.push_skip(tag)
            return
        if tag == "br":
            self.run.append(" ")
            return
        if tag in SKIPPED:
            self.push_skip(tag)
            return
        if tag in VOID:
            if tag not in INLINE:
                self.flush()
            return
        if tag in CLOSES_P:
            self.pop_to({"p"}, SECTIONS)
        if tag in CLOSED_BY:
            self.pop_to(CLOSED_BY[tag], SCOPES[tag])
        if tag in INLINE:
            if tag == "a":
                self.in_link += 1
            self.push(tag, self.block)
            return
        self.flush()
        a = dict(attrs)
        words = " ".join(a.get(k) or "" for k in ("class", "id", "role", "aria-label", "itemprop"))
        words = re.sub(r"([a-z])([A-Z])", r"\1 \2", words).lower()
        names = set(_NAMES.findall(words))
        if "hidden" in a or (a.get("aria-hidden") or "") == "true" or "display:none" in (a.get("style") or "").replace(" ", ""):
            names.add("hidden")
        self.node(tag, frozenset(names), label=int(a[LABEL]) if self.labelled and LABEL in a else None)
        self.push(tag, len(self.parent) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (self.skip or tag not in SKIPPED):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skip:
            if self.skip_at.get(tag):  # of the skipped element or of one within it
                self.drop_skip(self.skip_at[tag][-1])
                return
            if self.skip[0] == "head" or not (tag in ("body", "html") or (self.at.get(tag) and tag not in INLINE)):
                return
            self.drop_skip()  # an enclosing block ends
        if tag not in VOID:
            self.pop_to({tag}, SECTIONS - {tag} if tag in INLINE or tag == "p" else frozenset())

    def handle_data(self, data):
        if self.skip == ["head"] and data.strip():
            self.drop_skip()
        if not self.skip:
            self.run.append(data)
            if self.in_link > 0:
                self.link_chars += len(data.strip())


TAGS = ["#page", "#text", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "table", "pre",
        "blockquote", "figure", "figcaption", "nav", "header", "footer", "aside", "form", "button", "select", "textarea", "menu",
        "dialog", "address", "details", "#other"]
# words of class, id and role with one meaning each, by beginning; fixed values
NAMES = {
    "advert": ("ad", "ads", "adv", "advert", "sponsor", "promo", "banner", "outbrain", "taboola", "dfp"),
    "notice": ("cookie", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "disclaimer", "paywall", "privacy"),
    "comment": ("comment", "reply", "replies", "disqus", "discussion", "respond", "feedback", "reviews"),
    "menu": ("nav", "menu", "breadcrumb", "toolbar", "pagination", "pager", "tabs", "skip", "toc"),
    "side": ("sidebar", "side", "widget", "related", "recommend", "popular", "trending", "teaser", "more", "aside", "complementary"),
    "foot": ("footer", "foot", "copyright", "colophon", "bottom", "contentinfo", "legal"),
    "head": ("header", "masthead", "topbar", "logo", "branding", "sitename"),
    "share": ("share", "social", "follow", "newsletter", "subscribe", "signup", "login", "search", "form"),
    "byline": ("byline", "author", "meta", "tags", "date"),
    "content": ("content", "article", "post", "entry", "story", "main", "body", "text", "prose", "page"),
    "hidden": ("hidden", "invisible", "noprint", "sr"),
}
_EXACT = frozenset(("ad", "ads", "adv", "nav", "side", "more", "foot", "sr", "toc", "tabs", "date", "form", "text", "page", "skip", "meta", "dfp"))
KINDS = list(NAMES)
N_TEXT = 8
N_FEATURES = len(TAGS) * 2 + len(KINDS) * 2 + N_TEXT + 1
_TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}
_kinds_of: dict = {}


def kinds(names: frozenset) -> tuple[int, ...]:
    if names not in _kinds_of:
        if len(_kinds_of) > 100_000:
            _kinds_of.clear()
        _kinds_of[names] = tuple(i for i, k in enumerate(KINDS) for words in [NAMES[k]] if any(
            n == w or (w not in _EXACT and n.startswith(w)) for n in names for w in words))
    return _kinds_of[names]


#: Levels of fewer nodes are passed node by node; a deep nest has hundreds of thousands of them.
THIN = 8


def _logsum(x: float, y: float) -> float:
    return max(x, y) + math.log1p(math.exp(-abs(x - y)))


class Forest:
    """The trees of a batch of pages with their features, ready for message passing."""

    def __init__(self, pages: list[Page]):
        size = np.array([len(p.parent) for p in pages], np.int64)
        base = np.cumsum(size) - size
        n = int(size.sum())
        self.page = np.repeat(np.arange(len(pages)), size)
        own = np.concatenate([np.array(p.parent, np.int64) for p in pages]) if n else np.zeros(0, np.int64)
        self.parent = np.where(own >= 0, own + base[self.page], -1)
        self.label = np.concatenate([np.array(p.label, np.int64) for p in pages]) if n else np.zeros(0, np.int64)
        self.texts = [t for p in pages for t in p.text]
        tags = [t for p in pages for t in p.tag]
        names = [x for p in pages for x in p.names]
        tag = np.array([_TAG_NUMBER.get(t, len(TAGS) - 1) for t in tags], np.int64)
        chars = np.fromiter(map(len, self.texts), np.float64, n)
        link = np.array([x for p in pages for x in p.link], np.float64)
        marks = np.fromiter((sum(map(t.count, ".,;!?")) for t in self.texts), np.float64, n)
        self.depth = np.concatenate([np.array(p.depth, np.int64) for p in pages]) if n else np.zeros(0, np.int64)
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(self.depth))[:-1]) if n else []
        # sums over each subtree, which is the nodes from it to the next that is no deeper
        end = self._subtree_ends(n)
        chars, link, marks = (np.concatenate([[0.0], np.cumsum(x)])[[end, np.arange(n)]] for x in (chars, link, marks))
        chars, link, marks = (x[0] - x[1] for x in (chars, link, marks))
        density = link / np.maximum(chars, 1)
        f = np.zeros((n, N_FEATURES))
        f[np.arange(n), tag] = 1
        has = self.parent >= 0
        f[np.flatnonzero(has), len(TAGS) + tag[self.parent[has]]] = 1
        at = 2 * len(TAGS)
        for i, x in enumerate(names):
            for k in kinds(x):
                f[i, at + k] = 1
        f[has, at + len(KINDS):at + 2 * len(KINDS)] = f[self.parent[has], at:at + len(KINDS)]
        at += 2 * len(KINDS)
        leaf = tag == _TAG_NUMBER["#text"]
        f[:, at] = density
        f[:, at + 1] = density > 0.6
        f[:, at + 2] = np.minimum(np.log1p(chars) / 8, 1.5)
        f[:, at + 3] = np.where(leaf, np.minimum(np.log1p(chars) / 8, 1.5), 0)
        f[:, at + 4] = np.where(leaf, density, 0)
        f[:, at + 5] = np.minimum(marks / np.maximum(chars, 1) * 20, 1.0)
        f[:, at + 6] = chars == 0
        f[:, at + 7] = [t.startswith(("©", "(c)", "Copyright")) for t in self.texts]
        f[:, -1] = 1
        self.features, self.leaf = f, leaf

    def _subtree_ends(self, n: int) -> np.ndarray:
        """For each node the place after its last descendant (nodes stand in document order)."""
        end, open_ = np.empty(n, np.int64), []
        depth = self.depth.tolist()
        for i, d in enumerate(depth):
            while open_ and depth[open_[-1]] >= d:
                end[open_.pop()] = i
            open_.append(i)
        end[open_] = n
        return end

    def marginals(self, weight: np.ndarray, pair: np.ndarray, joints: bool = True):
        """(P(content) of each node, joint marginals of each child and parent, log partition)."""
        n = len(self.parent)
        unary = np.zeros((n, 2))
        unary[:, 1] = self.features @ weight
        belief, up = unary.copy(), np.zeros((n, 2))
        ((a, b), (c, d)) = pair.tolist()
        for level in reversed(self.levels[1:]):
            if len(level) < THIN:
                for i in level.tolist():
                    x, y = belief[i].tolist()
                    up[i] = x, y = _logsum(x + a, y + b), _logsum(x + c, y + d)
                    belief[self.parent[i]] += up[i]
                continue
            up[level] = np.logaddexp(belief[level, :1] + pair[:, 0], belief[level, 1:] + pair[:, 1])
            np.add.at(belief, self.parent[level], up[level])
        total = belief.copy()
        for level in self.levels[1:]:
            if len(level) < THIN:
                for i in level.tolist():
                    x, y = (total[self.parent[i]] - up[i]).tolist()
                    u, v = belief[i].tolist()
                    total[i] = _logsum(x + a, y + c) + u, _logsum(x + b, y + d) + v
                continue
            rest = total[self.parent[level]] - up[level]
            total[level] = np.logaddexp(rest[:, :1] + pair[0], rest[:, 1:] + pair[1]) + belief[level]
        joint = np.zeros((n, 2, 2))
        if joints and n:
            child = np.flatnonzero(self.parent >= 0)
            both = (total[self.parent[child]] - up[child])[:, :, None] + pair[None] + belief[child][:, None, :]
            joint[child] = np.exp(both - np.logaddexp(total[child, 0], total[child, 1])[:, None, None])
        p = 1.0 / (1.0 + np.exp(np.clip(total[:, 0] - total[:, 1], -50, 50)))
        roots = self.levels[0] if self.levels else np.zeros(0, np.int64)
        return p, joint, float(np.logaddexp(total[roots, 0], total[roots, 1]).sum())


def train(pages: list[str], steps: int = 400, rate: float = 0.1, l2: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights of node features and of (parent, child) states: regularised maximum likelihood
    by adaptive gradient steps on labelled pages."""
    forest = Forest([Page(h) for h in pages])
    child = forest.parent >= 0
    y = forest.label.astype(np.float64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (forest.label[forest.parent[child]], forest.label[child]), 1.0)
    weight, pair = np.zeros(N_FEATURES), np.zeros((2, 2))
    m = [np.zeros_like(weight), np.zeros_like(pair)]
    v = [np.zeros_like(weight), np.zeros_like(pair)]
    for t in range(1, steps + 1):
        p, joint, _ = forest.marginals(weight, pair)
        g = [forest.features.T @ (p - y) + l2 * weight, joint[child].sum(axis=0) - seen + l2 * pair]
        for i, x in enumerate((weight, pair)):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            v[i] = 0.99 * v[i] + 0.01 * g[i] ** 2
            x -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return weight, pair


def extract_texts(htmls: list[str], model) -> list[str]:
    """Main text of each page: content blocks in page order, joined by two line feeds."""
    forest = Forest([Page(h, labelled=False) for h in htmls])
    p, _, _ = forest.marginals(*model, joints=False)
    out: list[list[str]] = [[] for _ in htmls]
    for i in np.flatnonzero(forest.leaf & (p > 0.5)).tolist():
        out[forest.page[i]].append(forest.texts[i])
    return ["\n\n".join(x) for x in out]


def extract(pages: DataFrame, html_col: str = "html", model=None, keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` (the main text, empty if none) and ``n_chars`` (its code points).

    White space inside a block is one space, blocks are joined by two line feeds; a null or
    empty page has an empty text. Without ``model`` one is trained on the built-in labelled
    pages. Existing columns with the names of added ones are replaced.
    """
    shared = Shared(pages.sparkSession, model or train(labelled_pages()))

    def make():
        weights = shared.value

        def fn(batch):
            texts = extract_texts([h or "" for h in batch.column(html_col).to_pylist()], weights)
            return [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]

        return fn

    return add_columns(pages, [html_col], [StructField("text", StringType()), StructField("n_chars", LongType())], make, keep)
