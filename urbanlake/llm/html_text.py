"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node with a hidden label, content or not. A node's potential is a weighted sum of its
features (tag, words of class and id, amounts of text, links and punctuation); an edge's potential depends on the labels of
parent and child. Messages are passed from the leaves to the root and back (sum-product), which gives each node's marginal
probability of being content under all evidence of the tree. Text that stands directly in a node is taken where its marginal
is above one half.

The weights are fitted by gradient steps on the likelihood of labelled pages, whose gradient is the difference of observed
and expected features under the marginals. They are drawn towards prior weights, so that features which no labelled page
shows (a cookie notice, reader comments) keep their meaning; words of class and id are evidence that the text and the
neighbours of a node can outweigh. Labels come from pages with semantic markup: what stands in an
``article`` or ``main`` element and in none of ``BOILER`` is content. Training reads at most ``TRAIN_PAGES`` pages, those with
the least hash of their id.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm.common import query, table

TRAIN_PAGES = 200
#: Longer pages are not trained on, so that the sample is bounded in bytes too.
TRAIN_BYTES = 1 << 18
STEPS = 25

#: Quotes bind an attribute's value only right after its equals sign; elsewhere they are characters like others.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")

RAW = {"script", "style", "template", "noscript", "svg", "iframe", "title", "textarea", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q s samp small span strike strong sub sup time tt u var".split())
#: Formulas and embedded objects stand in a line of text; what they hold is read as text.
INLINE |= set("object math annotation maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
PEERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
BOILER = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "head"}
GOOD = {"article", "main"}
TEXTUAL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "td", "dd", "figcaption"}
#: Words of class and id that name what is no article, and words that often do but may name a part of one as well.
STRONG_WORDS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu breadcrumb breadcrumbs sidebar masthead comment comments discussion disqus replies cookie cookies consent popup modal overlay sharing newsletter subscribe subscription signup login pagination pager toolbar".split())
WEAK_WORDS = set("side aside footer header reply respond notice notices alert share social related recommended search form widget copyright legal".split())
GOOD_WORDS = set("article articlebody content body post entry story main text blog".split())

#: Prior weights, by feature.
PRIOR = {
    "bias": -1.0, "good_tag": 8.0, "boiler_tag": -6.0, "strong_word": -5.0, "good_word": 2.0, "textual": 0.5, "some_text": 0.3,
    "long_text": 1.0, "links": -2.0, "stops": 0.7, "heading": 0.3, "list": -0.3, "weak_box": -3.5, "weak_text": -0.5,
}
FEATURES = list(PRIOR)
#: Prior log-potentials of (parent, child) labels: 0 other, 1 content. An advert in an article says little against it.
EDGES = [[1.0, -1.0], [-0.2, 1.5]]


class Page:
    """Nodes in page order, so that parents come before their children, and text runs with their node."""

    def __init__(self, source: str):
        self.tags, self.parent, self.words = ["#"], [-1], [set()]
        self.runs: list[list] = []
        self.size, self.linked = [0], [0]
        stack, fresh, links, at = [("#", 0)], True, 0, 0
        for m in TOKEN.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at:
                fresh = self._text(source[at : m.start()], stack[-1][1], fresh, links)
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if m[1]:
                if name == "a":
                    links = max(0, links - 1)
                if name not in INLINE:
                    fresh = True
                    depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                    if depth:
                        del stack[depth:]
                        links = 0
                continue
            if name == "xmp":
                # Its text is no markup, whatever it looks like.
                end = re.compile(r"</xmp\s*>", re.I).search(source, at)
                self._open("xmp", stack, ""), self._text(html.escape(source[at : end.start() if end else len(source)]), stack.pop()[1], True, 0)
                fresh, at = True, end.end() if end else len(source)
                continue
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if name in VOID:
                if name == "br":
                    fresh = self._text(" ", stack[-1][1], fresh, links)
                elif name == "hr":
                    fresh = True
                continue
            if name in INLINE:
                links += name == "a"
                continue
            if name in CLOSES_P:
                self._close(stack, {"p"}, {"table", "td", "th", "button", "object"})
            if name in PEERS:
                self._close(stack, PEERS[name], SCOPE.get(name, set()))
            fresh, links = True, 0
            self._open(name, stack, m[3] or "")
        if at < len(source):
            self._text(source[at:], stack[-1][1], fresh, links)

    def _open(self, name: str, stack: list, attributes: str) -> None:
        words = set()
        for a, b, c in ATTRIBUTE.findall(attributes):
            words.update(WORD.findall((a or b or c).lower()))
        self.tags.append(name), self.parent.append(stack[-1][1]), self.words.append(words)
        self.size.append(0), self.linked.append(0)
        stack.append((name, len(self.tags) - 1))

    @staticmethod
    def _close(stack: list, names: set, scope: set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    def _text(self, text: str, node: int, fresh: bool, links: int) -> bool:
        """Add text to the node's run, or start one; returns whether the next text starts a run."""
        if fresh and not text.strip():
            return True
        if fresh:
            self.runs.append([node, text])
        else:
            self.runs[-1][1] += text
        self.size[node] += len(text)
        if links:
            self.linked[node] += len(text)
        return False

    def features(self) -> list[list[int]]:
        """The numbers of the features that each node has."""
        ends = [0] * len(self.tags)
        for node, text in self.runs:
            ends[node] += text.count(". ") + text.count(", ") + text.rstrip().endswith((".", "!", "?"))
        out = []
        for i, tag in enumerate(self.tags):
            own = [0]
            # A comment may be an article of its own, and says so.
            if tag in GOOD and not self.words[i] & STRONG_WORDS:
                own.append(1)
            if tag in BOILER:
                own.append(2)
            if self.words[i]:
                if self.words[i] & STRONG_WORDS:
                    own.append(3)
                elif self.words[i] & WEAK_WORDS and tag not in GOOD:
                    own.append(13 if tag in TEXTUAL else 12)
                if self.words[i] & GOOD_WORDS:
                    own.append(4)
            if tag in TEXTUAL:
                own.append(5)
            size = self.size[i]
            if size > 20:
                own.append(6)
            if size > 120:
                own.append(7)
            if size and 2 * self.linked[i] > size:
                own.append(8)
            if ends[i]:
                own.append(9)
            if tag[0] == "h" and tag[1:].isdigit():
                own.append(10)
            if tag in ("ul", "ol", "dl"):
                own.append(11)
            out.append(own)
        return out

    def labels(self) -> list[int] | None:
        """Labels from semantic markup; none where the page has none."""
        if not GOOD & set(self.tags):
            return None
        out = [0] * len(self.tags)
        for i in range(1, len(self.tags)):
            tag = self.tags[i]
            # The words of class and id take no part, so that they are weighed by the pages and not by themselves.
            out[i] = int(tag not in BOILER and (tag in GOOD or out[self.parent[i]] == 1))
        return out


def _sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(parent: list[int], score: list[float], edges: list[list[float]]) -> tuple[list[float], list[list[list[float]]] | None]:
    """Log-odds of content of every node: messages up, then down. ``score`` is the log-potential of content against other.

    Messages are kept as log-odds too: what a child says about its parent and a parent about its child.
    """
    (e00, e01), (e10, e11) = edges
    n = len(parent)
    below = list(score)
    up = [0.0] * n
    for i in range(n - 1, 0, -1):
        b = below[i]
        up[i] = _sum(e10, e11 + b) - _sum(e00, e01 + b)
        below[parent[i]] += up[i]
    belief = list(below)
    for i in range(1, n):
        rest = belief[parent[i]] - up[i]
        belief[i] = below[i] + _sum(e01, e11 + rest) - _sum(e00, e10 + rest)
    return belief, up


def pair_marginals(parent: list[int], score: list[float], edges: list[list[float]]) -> list[list[float]]:
    """Expected counts of the labels of parent and child over a tree."""
    belief, up = marginals(parent, score, edges)
    below = list(score)
    for i in range(len(parent) - 1, 0, -1):
        below[parent[i]] += up[i]
    out = [[0.0, 0.0], [0.0, 0.0]]
    for i in range(1, len(parent)):
        rest = belief[parent[i]] - up[i]
        logs = [[edges[0][0], edges[0][1] + below[i]], [edges[1][0] + rest, edges[1][1] + rest + below[i]]]
        top = max(max(logs[0]), max(logs[1]))
        cells = [[math.exp(x - top) for x in row] for row in logs]
        total = sum(map(sum, cells))
        for a in (0, 1):
            for b in (0, 1):
                out[a][b] += cells[a][b] / total
    return out


class Model:
    def __init__(self, weights: list[float], edges: list[list[float]]):
        self.weights, self.edges = weights, edges

    def content(self, page: Page) -> list[bool]:
        score = [sum(self.weights[f] for f in own) for own in page.features()]
        return [x > 0 for x in marginals(page.parent, score, self.edges)[0]]


def fit(sources: list[str], steps: int = STEPS, rate: float = 0.5, strength: float = 0.02, edge_strength: float = 0.3) -> Model:
    """Fit on the pages with semantic markup; without any, the prior stands. Four edge potentials, which all nodes of all
    pages pull at, are held more firmly than the weights of features."""
    pages = [(p, y) for p in map(Page, sources) if (y := p.labels())]
    weights, edges = [PRIOR[f] for f in FEATURES], [list(r) for r in EDGES]
    known = [(p.parent, p.features(), y) for p, y in pages]
    nodes = sum(len(y) for _, _, y in known)
    for _ in range(steps if nodes else 0):
        slope, joint = [0.0] * len(FEATURES), [[0.0, 0.0], [0.0, 0.0]]
        for parent, features, y in known:
            score = [sum(weights[f] for f in own) for own in features]
            belief, _ = marginals(parent, score, edges)
            for own, b, label in zip(features, belief, y):
                gap = label - 1 / (1 + math.exp(-max(-500.0, min(500.0, b))))
                for f in own:
                    slope[f] += gap
            expected = pair_marginals(parent, score, edges)
            for i in range(1, len(parent)):
                joint[y[parent[i]]][y[i]] += 1
            for a in (0, 1):
                for b in (0, 1):
                    joint[a][b] -= expected[a][b]
        for f, name in enumerate(FEATURES):
            weights[f] += rate * (10 * slope[f] / nodes - strength * (weights[f] - PRIOR[name]))
        for a in (0, 1):
            for b in (0, 1):
                edges[a][b] += rate * (10 * joint[a][b] / nodes - edge_strength * (edges[a][b] - EDGES[a][b]))
    return Model(weights, edges)


def main_text(source: str | None, model: Model) -> str:
    """Blocks of content in page order, joined by line feeds; white space in a block is one space."""
    page = Page(source or "")
    content = model.content(page)
    blocks = (" ".join(html.unescape(text).split()) for node, text in page.runs if content[node])
    return "\n".join(b for b in blocks if b)


def train(pages: DataFrame, key: str = "page_id", source: str = "html", rows: int = TRAIN_PAGES) -> Model:
    """A model from at most ``rows`` pages of at most ``TRAIN_BYTES``, those with the least hash of their id and markup."""
    pages = pages.where(F.octet_length(source) <= TRAIN_BYTES)
    ids = pages.where(F.col(source).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(F.lit("train"), key, source).alias("h"))
    few = [r.h for r in ids.distinct().orderBy("h").limit(rows).collect()]
    found = pages.where(F.xxhash64(F.lit("train"), key, source).isin(few)).select(source).distinct().collect()
    return fit(sorted(r[0] for r in found)[:rows])


def extract(pages: DataFrame, model: Model, source: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text; empty for a null or empty page or one without content.

    Repeated rows repeat; a column called ``out`` is replaced, all others pass unchanged.
    """
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.edges))
    kept = pages.drop(out)
    schema = kept.select("*", F.lit("").alias(out)).schema

    def read(batches):
        own = Model(*shared.value)
        for batch in batches:
            texts = [main_text(x, own) for x in batch.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return kept.mapInArrow(read, schema)


@query("op9_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = extract(pages, train(pages))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
