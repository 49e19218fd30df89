"""Main text of web pages by a tree-structured graphical model (operator 9).

Every element of a page is a binary variable: content or not.  A potential per
element (features of its tag, names and text) and one per parent and child
make a tree-shaped model; sum-product messages, from the leaves up and from
the root down, give each element's marginal.  The blocks of text whose element
is content with at least ``CUT`` make the main text, in page order.

The weights are learned by gradient ascent of the conditional likelihood on
labelled pages: the built-in ones of ``labelled_pages`` and up to
``TRAIN_PAGES`` pages of the table, of at most ``TRAIN_BYTES`` each, that mark
their article themselves with one ``article`` or ``main`` element (chosen by a
hash of the url).

Defined cases: null or empty html gives an empty text; character references
are decoded; ``br`` is white space; scripts, styles, templates, graphics,
embedded objects and form controls are no text, up to their own end, and leave
the block around them whole; hidden elements are a feature for the model, their
text is judged like any other; only the elements that browsers end a paragraph
for end one, and elements that HTML doesn't know are part of their line; list
items and table cells are repaired as browsers do; time is linear in the page's
length and depth; repeated rows give equal rows; an empty table gives no rows;
columns named ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, without

CUT = 0.5
TRAIN_PAGES = 60
TRAIN_BYTES = 30_000
EPOCHS, RATE, DECAY = 60, 0.4, 2e-4
#: Weight of a built-in page, by that of a page of the table (whose shapes are alike).
BUILT_IN = 3.0

# Elements of HTML by their part in a page.  Elements that are in none of these sets are part of their line.
SILENT = set("script style noscript template svg title iframe object audio video canvas map select option optgroup textarea "
             "button datalist".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSE_P = set("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
              "header hgroup hr li main menu nav ol p pre search section summary table ul".split())
BLOCKS = CLOSE_P | set("body caption html legend tbody td tfoot th thead tr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tr", "td", "th"}}
SCOPES = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "html", "main", "aside", "nav", "form"}
P_SCOPES = SCOPES | {"td", "th", "li"}
TAGS = [{"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog"}, {"p", "blockquote", "pre"},
        {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "ul", "ol", "dl", "dt", "dd"}, {"table", "tr", "td", "th", "tbody"},
        {"div", "section"}, {"body", "html", ""}]
NAMES = [re.compile(p) for p in (
    r"content|article|post\b|entry|story|text|body|main|prose", r"nav|menu|breadcrumb|crumb|pagination|pager|tabs|skip",
    r"\bads?\b|advert|sponsor|promo|banner|adslot|outbrain|taboola", r"comment|reply|replies|disqus|discussion|respond|feedback",
    r"side|widget|related|recommend|share|social|tags|author-bio|trending|popular",
    r"notice|cookie|consent|gdpr|newsletter|subscribe|popup|modal|overlay|alert|paywall|signup|login",
    r"foot|copyright|legal|colophon", r"head(?!line)|masthead|topbar|logo|search|toolbar")]
SENTENCE = re.compile(r"[.!?。](?:\s|$)")
BLANK = re.compile(r"\s+")
N_FEATURES = 1 + len(TAGS) + len(NAMES) + 7


class Node:
    __slots__ = ("tag", "names", "parent", "children", "hidden", "chars", "links", "ends", "label")

    def __init__(self, tag: str, names: str, parent: int, hidden: bool, label: int | None):
        self.tag, self.names, self.parent, self.hidden, self.label = tag, names, parent, hidden, label
        self.children: list[int] = []
        self.chars = self.links = self.ends = 0


class Page(HTMLParser):
    """Block elements (parents before children; all others are part of their block's line) and blocks (element, text)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("", "", -1, False, None)]
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: dict[str, list[int]] = {}  # by tag, its places on the stack
        self.silent: list[str] = []  # a silent element, and all within it that isn't closed
        self.within: dict[str, int] = {}  # how many of each those are
        self.blocks: list[tuple[int, str]] = []
        self.held: list[str] = []
        self.links = self.held_links = 0
        self.feed(html)
        self.close()
        self._break()

    def _break(self) -> None:
        text = BLANK.sub(" ", "".join(self.held)).strip()
        at = self.stack[-1][1]
        if text:
            self.blocks.append((at, text))
            node = self.nodes[at]
            node.chars += len(text)
            node.links += min(self.held_links, len(text))
            node.ends += len(SENTENCE.findall(text))
        self.held, self.held_links = [], 0

    def _innermost(self, tags: set[str]) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _end_at(self, k: int) -> None:
        """Ends the elements from place ``k`` of the stack on."""
        self._break()
        for tag, _ in self.stack[k:]:
            self.open[tag].pop()
        del self.stack[k:]

    def _close(self, tags: set[str], scopes: set[str]) -> None:
        k = self._innermost(tags)
        if k > self._innermost(scopes - tags):
            self._end_at(k)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent or tag in SILENT:  # up to its own end, whatever stands in it
            if tag not in VOID:
                self.silent.append(tag)
                self.within[tag] = self.within.get(tag, 0) + 1
            return
        if tag not in BLOCKS:
            self.links += tag == "a"
            if tag == "br":
                self.held.append(" ")
            return
        if tag == "hr":
            self._close({"p"}, P_SCOPES)
            self._break()
            return
        if tag in CLOSE_P:
            self._close({"p"}, P_SCOPES)
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPES)
        self._break()
        given = dict(attrs)
        style = (given.get("style") or "").replace(" ", "")
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        names = " ".join(given.get(a) or "" for a in ("class", "id", "role", "itemprop")).lower()
        label, up = given.get("data-y"), self.stack[-1][1]
        self.nodes.append(Node(tag, names, up, hidden or self.nodes[up].hidden, int(label) if label in ("0", "1") else None))
        self.nodes[up].children.append(len(self.nodes) - 1)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, len(self.nodes) - 1))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if self.within.get(tag):
                while (ended := self.silent.pop()) != tag:
                    self.within[ended] -= 1
                self.within[tag] -= 1
                return
            if not self.open.get(tag):
                return
            self.silent, self.within = [], {}  # what is around it ends: it was never closed
        if tag not in BLOCKS:
            self.links = max(0, self.links - (tag == "a"))
        elif self.open.get(tag):
            self._end_at(self.open[tag][-1])
        elif tag == "p":
            self._break()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.held.append(data)
            if self.links:
                self.held_links += len(data)


def features(page: Page) -> np.ndarray:
    """Features (nodes, N_FEATURES); text figures are of the element with all below it."""
    nodes = page.nodes
    total = np.array([[n.chars, n.links, n.ends] for n in nodes], float)
    for i in range(len(nodes) - 1, 0, -1):
        total[nodes[i].parent] += total[i]
    x = np.zeros((len(nodes), N_FEATURES))
    x[:, 0] = 1
    for i, n in enumerate(nodes):
        for j, tags in enumerate(TAGS):
            x[i, 1 + j] = n.tag in tags
        if n.names:
            for j, pattern in enumerate(NAMES):
                x[i, 1 + len(TAGS) + j] = pattern.search(n.names) is not None
        x[i, -1] = n.hidden
    chars, links, ends = total.T
    x[:, -7] = np.log1p(chars) / 5
    x[:, -6] = links / np.maximum(1, chars)
    x[:, -5] = (chars > 0) & (links > 0.6 * chars)
    x[:, -4] = np.minimum(1, ends / 3)
    x[:, -3] = (chars > 0) & (chars < 60) & (ends == 0)
    x[:, -2] = chars == 0
    return x


def beliefs(page: Page, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the elements (content) and, for every child, of (parent, child) as 2 x 2, by sum-product.

    unary: log-odds of content by itself; pair[parent, child]: log potentials."""
    nodes, n = page.nodes, len(page.nodes)
    own = np.stack([np.zeros(n), unary], axis=1)
    up, message = own.copy(), np.zeros((n, 2))
    for i in range(n - 1, 0, -1):  # children come after their parents
        message[i] = np.logaddexp(pair[:, 0] + up[i, 0], pair[:, 1] + up[i, 1])
        up[nodes[i].parent] += message[i]
    down = np.zeros((n, 2))
    joint = np.zeros((n, 2, 2))
    for i in range(1, n):
        p = nodes[i].parent
        rest = up[p] + down[p] - message[i]
        both = rest[:, None] + pair + up[i][None, :]
        joint[i] = np.exp(both - np.logaddexp.reduce(both, axis=None))
        down[i] = np.logaddexp(rest[0] + pair[0], rest[1] + pair[1])
    at = up + down
    return 1 / (1 + np.exp(np.clip(at[:, 0] - at[:, 1], -50, 50))), joint


class Model:
    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def extract(self, html: str | None) -> str:
        page = Page(html or "")
        if not page.blocks:
            return ""
        marginal, _ = beliefs(page, features(page) @ self.weights, self.pair)
        return "\n".join(text for at, text in page.blocks if marginal[at] >= CUT)


def labels_of(page: Page) -> np.ndarray:
    """Labels of a labelled page: an element has its parent's unless it has its own (data-y)."""
    y = np.zeros(len(page.nodes), int)
    for i, n in enumerate(page.nodes[1:], 1):
        y[i] = y[n.parent] if n.label is None else n.label
    return y


def own_labels(page: Page) -> np.ndarray | None:
    """Labels of a page that marks its article by one element; None for others."""
    marks = [i for i, n in enumerate(page.nodes) if n.tag in ("article", "main") or n.names == "articlebody"]
    if len(marks) != 1:
        return None
    y = np.zeros(len(page.nodes), int)
    aside = {"nav", "aside", "footer", "form", "header", "dialog"}
    for i, n in enumerate(page.nodes):
        inside = i == marks[0] or i > 0 and y[n.parent]
        y[i] = bool(inside) and not n.hidden and n.tag not in aside and not any(p.search(n.names) for p in NAMES[1:6])
    return y


def train(pages: list[tuple[Page, np.ndarray, float]]) -> Model:
    """pages: page, labels, weight."""
    weights, pair = np.zeros(N_FEATURES), np.zeros((2, 2))
    given = [(page, y, features(page), w) for page, y, w in pages]
    n = sum(w * len(y) for _, y, _, w in given)
    moments = [np.full(N_FEATURES, 1e-6), np.full((2, 2), 1e-6)]
    for _ in range(EPOCHS):
        g_weights, g_pair = -DECAY * n * weights, -DECAY * n * pair
        for page, y, x, w in given:
            marginal, joint = beliefs(page, x @ weights, pair)
            g_weights = g_weights + w * (x.T @ (y - marginal))
            g_pair = g_pair - w * joint[1:].sum(axis=0)
            parents = [node.parent for node in page.nodes[1:]]
            np.add.at(g_pair, (y[parents], y[1:]), w)
        for value, grad, square in ((weights, g_weights / n, moments[0]), (pair, g_pair / n, moments[1])):
            square += grad**2
            value += RATE * grad / np.sqrt(square)
    return Model(weights, pair)


_TEXT = ("The river had risen in the night, and by morning the lower road was gone. Nobody in the village was surprised.",
         "Work on the new bridge began in spring; it was paid for by the county, and finished two years later.",
         "She kept a record of every flood since then. The numbers, she says, speak for themselves.",
         "In the end the council agreed to move the school to higher ground. The vote was close.")


def labelled_pages() -> list[str]:
    """Pages of common shapes, each with short, middling and long texts; data-y says what is content (1)
    and what isn't (0), and is inherited."""
    return [page for texts in (_TEXT[:1], _TEXT[1:3], _TEXT, _TEXT * 4) for page in _shapes(texts)]


def _shapes(texts: tuple[str, ...]) -> list[str]:
    p = "".join(f"<p>{t}</p>" for t in texts)
    nav = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/s'>Sport</a></li></ul></nav>"
    bar = "<div class='menu'><a href='/'>Home</a> <a href='/n'>News</a> <a href='/w'>Weather today</a></div>"
    head = "<header><a href='/'>The Daily</a><p>News from the valley since 1911.</p></header>"
    foot = "<footer><p>Copyright The Daily. All rights reserved.</p><a href='/i'>Imprint</a></footer>"
    aside = f"<aside class='sidebar'><h3>Related</h3><ul><li><a href='/1'>Another flood</a></li></ul><p>{_TEXT[1]}</p></aside>"
    ad = f"<div class='ad'>Buy two pay one. {_TEXT[2]}</div>"
    cookie = "<div class='cookie-notice'><p>We use cookies to improve this site. You can change this at any time.</p><button>OK</button></div>"
    notes = ("<div id='comments'><h3>2 comments</h3><div class='comment'><p>I was there, and it was much worse. Thank you for this.</p></div>"
             f"<div class='comment'><p>{_TEXT[3]}</p></div></div>")
    form = "<form><label>Your e-mail</label><input name='e'><p>Get our letter every week. No spam.</p><button>Send</button></form>"
    share = "<div class='share'><a href='#'>Tweet</a> <a href='#'>Share</a></div>"
    table = "<table><tr><th>Year</th><th>Level</th></tr><tr><td>1953</td><td>4.2 m</td></tr></table>"
    points = "<ul><li>The road is closed.</li><li>The school stays open, for now.</li></ul>"
    title = "<h1>High water</h1>"
    unseen = f"<p aria-hidden='true'>{texts[0]}</p>"
    hidden = f"<div style='display: none'><p>{_TEXT[1]}</p></div>"
    brief = f"{title}{p}" + (points if len(texts) > 1 else "")
    body = brief if len(texts) < 3 else f"{title}{p}<h2>What comes next</h2><p>{_TEXT[0]} {_TEXT[1]}</p>{points}{table}<blockquote>{_TEXT[2]}</blockquote>"

    def shape(inner: str, before: str = "", after: str = "") -> str:
        return f"<html><body>{before}{inner}{after}</body></html>"

    def drop(part: str) -> str:
        return part.replace(">", " data-y='0'>", 1)

    article = f"<article data-y='1'>{body}</article>"
    return [
        shape(article, nav + ad, foot), shape(article, head + nav, aside + notes + foot),
        shape(f"<main data-y='1'>{body}</main>", bar + cookie, form + foot),
        shape(f"<article data-y='1'>{body}{drop(share)}{drop(notes)}</article>", head, foot),
        shape(f"<article data-y='1'>{drop('<header><p>By Ann Lee</p></header>')}{body}{drop(aside)}{drop(ad)}{p}</article>", nav, foot + cookie),
        shape(f"<div id='content' data-y='1'>{body}</div>", bar, "<div id='footer'><p>Legal notice. All rights reserved.</p></div>"),
        shape(f"<div class='wrap'><div class='post entry' data-y='1'>{body}{drop(form)}</div>{aside}</div>", head + nav, foot),
        shape(f"<section class='story' data-y='1'>{title}{p}{p}</section>", nav + cookie, notes + aside + foot),
        shape(f"<table><tr><td class='nav'><a href='/'>Home</a><br><a href='/n'>News</a></td><td data-y='1'>{title}{p}{p}</td></tr></table>"),
        shape(f"<div data-y='1'>{title}{p}{p}</div>", bar, "<div class='related'><a href='/1'>More on floods</a></div>"),
        shape(f"<div class='page'>{head}<div class='text' data-y='1'><p>{'<p>'.join(texts)}</div>{ad}{foot}</div>"),
        shape(f"<article data-y='1'><p><b>{_TEXT[0]}<br><p>{_TEXT[1]}<p>{_TEXT[2]}</article>", nav + ad, foot),
        shape(f"<article data-y='1'><h1>Brief</h1><p>Short.</p><p>Sun.</p></article>", nav + ad, foot + notes),
        shape(f"<main><article data-y='1'>{body}</article>{drop(notes)}{drop(aside)}</main>", head, foot),
        shape(f"<article data-y='1'>{title}{p}{drop(aside)}{p}{drop(ad)}{p}{drop(form)}</article>", nav, foot),
        shape(f"<main data-y='1'>{body}{drop(notes)}</main>", head.replace("<a href='/'>The Daily</a>", "<h1>The Daily</h1>"), foot),
        shape(f"<div class='article-body' data-y='1'>{body}</div>", bar, aside.replace("aside", "div") + notes + cookie),
        shape(f"<div role='main' data-y='1'>{body}</div>", nav + form, ad + share + foot),
        shape(f"<article data-y='1'>{title}{p}{drop(hidden)}{p}</article>", nav + hidden, foot),
        shape(f"<article data-y='1'>{title}{p}{drop(unseen)}{p}{drop(unseen)}</article>", head + nav, foot),
        shape(f"<main data-y='1'>{drop(unseen)}{body}{drop(hidden)}{drop(unseen)}</main>", bar, notes + foot),
        shape(f"<div data-y='1'>{body}{drop('<div hidden><p>You need to be signed in to see this. It takes a minute.</p></div>')}</div>", bar, foot),
    ]


def fit(pages: DataFrame, html: str = "html", url: str = "url") -> Model:
    """A model from the built-in pages and a bounded sample of the table's own."""
    mine = pages.where(F.octet_length(F.col(f"`{html}`")).between(1, TRAIN_BYTES))
    n = mine.count()
    draw = F.pmod(F.xxhash64(F.col(f"`{url}`"), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    rows = mine.where(draw < F.lit(TRAIN_PAGES / max(1, n))).select(F.col(f"`{html}`").alias("html")).limit(2 * TRAIN_PAGES).collect()
    given = [(page, labels_of(page), BUILT_IN) for page in map(Page, labelled_pages())]
    for page in map(Page, sorted(r.html for r in rows)):
        y = own_labels(page)
        if y is not None:
            given.append((page, y, 1.0))
    return train(given)


def extract(pages: DataFrame, model: Model, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages`` (all, if None) with text and n_chars."""
    kept = without(pages if keep is None else pages.select(*[f"`{c}`" for c in keep]), "text", "n_chars")
    names = kept.columns
    given = pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html}`").alias("__html"))
    schema = kept.select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = [shared.value.extract(h) for h in rows["__html"]]
            yield rows[names].assign(text=texts, n_chars=[len(t) for t in texts])
    return given.mapInPandas(run, schema)


def op9_dom_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit(pages), keep=["page_id", "url"])
