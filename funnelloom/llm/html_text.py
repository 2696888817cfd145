"""Main text of HTML pages by boosted trees over DOM nodes.

A page becomes a tree of elements. Every element that can hold text gets features: its
tag, the tokens of its class, id and role, its depth, the density of text and links in
its subtree, and how it stands among its siblings. Gradient-boosted trees score each
element as content or not. Decoding is hierarchical: from the root down, an element is
taken or left as a whole when that suits the sum of its descendants' scores better than
any mixture does, so that no descendant contradicts an ancestor.

Nothing here learns from a downloaded model: ``training_pages`` lays out pages of many
kinds by rule, with texts from the pages table itself, and knows the label of each
element. The number of pages is a documented bound on what the driver fits.

Text: character references decoded, white space inside a block made one space, blocks in
page order joined by a line feed. Scripts, styles, comments and form controls never give
text. Defined results: null or empty html gives an empty text; unclosed elements are
closed by what follows; repeated rows each give a row; an empty table gives none.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.tokens import slices

# Fixed values of HTML: elements without an end tag, those whose content is no text,
# those that begin a block, and which open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "option", "button")
BLOCK = frozenset(
    "html body p div section article main nav header footer aside form ul ol li dl dt dd table tbody thead tfoot tr td th"
    " h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption details summary address fieldset hr br".split()
)
CLOSES = {
    "p": ("p",),
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
ENDS_P = BLOCK - {"br", "td", "th", "li", "html", "body"}

TAGS = "body main article section div p h1 h2 h3 nav header footer aside form ul ol li table blockquote figure a span".split()
# Tokens of class, id and role by what they tell; a token counts if it holds one of these.
HINTS = (
    ("ad", r"^(ads?|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|dfp|teaser)$"),
    ("menu", r"nav|menu|breadcrumb|crumbs|pagination|pager|toolbar|tabs$|skip|toc$"),
    ("side", r"side|aside|widget|related|recommend|popular|trending|more|archive|tag(s|cloud)$|complementary"),
    ("head", r"^(head|header|masthead|topbar|top|logo|branding|site-?header|banner)$"),
    ("foot", r"foot|copyright|legal|imprint|contentinfo|bottom|credits"),
    ("notice", r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|paywall|disclaimer|privacy"),
    ("comment", r"comment|discuss|repl(y|ies)|respond|disqus|feedback|review"),
    ("share", r"share|social|follow|like|rating|meta$|byline|author|date"),
    ("content", r"content|article|post|entry|story|main|text|body|prose|page"),
)
_HINTS = tuple(re.compile(p) for _, p in HINTS)
# Elements that tell what lies in them, looked for among a node's ancestors.
REGIONS = "main article nav header footer aside form".split()
N_PAGES = 600
NESTED = 0.3  # often enough for the trees to trust a sign inside an article as well
_OPENS = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/<>]*))")
_SPECIAL = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "hints", "parent", "parts", "label")

    def __init__(self, tag: str, hints: tuple[int, ...], parent: int, label: int = 0):
        self.tag, self.hints, self.parent, self.label = tag, hints, parent, label
        self.parts: list[str | int] = []  # text and numbers of child nodes, in order


@lru_cache(maxsize=10_000)
def hints_of(attributes: str) -> tuple[int, ...]:
    tokens = [t for m in _ATTRIBUTE.finditer(attributes) for t in re.split(r"[\s_]+", (m[2] or m[3] or m[4] or "").lower()) if t]
    tokens += [p for t in tokens if "-" in t for p in t.split("-")]
    return tuple(k for k, hint in enumerate(_HINTS) if any(hint.search(t) for t in tokens))


class _Marks:
    """Tags, comments and declarations of a page, in time linear in its length.

    A ``>`` inside quotes ends no tag, so a broken quote can make a tag run to the page's end
    and fail there. How a scan goes on from a quote depends on that quote alone: those that
    led nowhere are kept, and the next special character is kept while it lies ahead.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()
        self.searched, self.special = 0, -1  # no special character lies between these places

    def _next_special(self, at: int) -> int:
        if not self.searched <= at <= self.special:
            m = _SPECIAL.search(self.page, at)
            self.searched, self.special = at, m.start() if m else len(self.page)
        return self.special

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` of a tag whose attributes begin at ``at``, -1 if there is none."""
        page, seen = self.page, []
        while at <= self.last[">"]:
            at = self._next_special(at)
            if at >= len(page) or at in self.dead:
                break
            if page[at] == ">":
                return at
            seen.append(at)
            if at >= self.last[page[at]]:
                break
            at = page.find(page[at], at + 1) + 1
        self.dead.update(seen)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, closes, tag, attributes); the tag is empty for all but elements."""
        page, at = self.page, 0
        while m := _OPENS.search(page, at):
            if m[1]:
                end = page.find("-->", m.end())
                at = end + 3 if end >= 0 else len(page)
                yield m.start(), at, False, "", ""
                continue
            end = page.find(">", m.end()) if m[2] and m.end() <= self.last[">"] else -1 if m[2] else self._tag_end(m.end())
            at = end + 1 if end >= 0 else m.start() + 1
            if end >= 0:
                yield m.start(), at, bool(m[3]), (m[4] or "").lower(), page[m.end() : end] if m[4] else ""


def parse(page: str) -> list[Node]:
    """Elements in page order; node 0 is the root."""
    nodes, stack, at = [Node("", (), -1)], [0], 0
    blocks: list[int] = []  # places of block elements on the stack
    open_: Counter[str] = Counter()

    def cut(depth: int) -> None:
        for k in stack[depth:]:
            open_[nodes[k].tag] -= 1
        del stack[depth:]
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    for start, end, closes, tag, attributes in _Marks(page):
        if start < at:
            continue
        if start > at:
            nodes[stack[-1]].parts.append(page[at:start])
        at = end
        if not tag:
            continue
        if closes:
            if open_[tag] > 0:
                cut(next(d for d in range(len(stack) - 1, 0, -1) if nodes[stack[d]].tag == tag))
            continue
        while len(stack) > 1 and (nodes[stack[-1]].tag in CLOSES.get(tag, ()) or tag in ENDS_P and nodes[stack[-1]].tag == "p"):
            cut(len(stack) - 1)
        if tag in ENDS_P | {"p"} and blocks and nodes[stack[blocks[-1]]].tag == "p":
            # A paragraph also ends where inline elements in it were left open.
            cut(blocks[-1])
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        node = Node(tag, hints_of(attributes) if attributes else (), stack[-1])
        nodes[stack[-1]].parts.append(len(nodes))
        nodes.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(len(nodes) - 1)
            open_[tag] += 1
            if tag in BLOCK:
                blocks.append(len(stack) - 1)
    if at < len(page):
        nodes[stack[-1]].parts.append(page[at:])
    return nodes


def tree_features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """(features, own text length) of every node; subtree sums go from the last node up."""
    n = len(nodes)
    parent = np.fromiter((x.parent for x in nodes), np.int64, n)
    own = np.fromiter((sum(len(p.strip()) for p in x.parts if p.__class__ is str) for x in nodes), np.float64, n)
    link = np.fromiter((x.tag == "a" for x in nodes), bool, n)
    para = np.fromiter((x.tag in ("p", "blockquote", "pre") for x in nodes), bool, n)
    item = np.fromiter((x.tag == "li" for x in nodes), bool, n)
    control = np.fromiter((x.tag in ("input", "label") for x in nodes), bool, n)
    sums = np.stack((own, own * link, np.ones(n), own * para, para, link, item, control), axis=1)
    depth, order = np.zeros(n), np.zeros(n)
    children = np.zeros(n)
    up = parent.tolist()
    total = sums.tolist()
    for i in range(n - 1, 0, -1):
        t, s = total[up[i]], total[i]
        for k in range(8):
            t[k] += s[k]
    for i in range(1, n):
        depth[i] = depth[up[i]] + 1
        order[i] = children[up[i]]
        children[up[i]] += 1
    total = np.array(total)
    text = np.maximum(total[:, 0], 1)
    up_safe = np.maximum(parent, 0)
    columns = [
        np.log1p(total[:, 0]),
        total[:, 1] / text,
        total[:, 0] / total[:, 2],
        total[:, 3] / text,
        np.log1p(total[:, 4]),
        total[:, 5] / total[:, 2],
        total[:, 6] / total[:, 2],
        total[:, 7] / total[:, 2],
        depth,
        np.log1p(own),
        np.log1p(children),
        order / np.maximum(children[up_safe], 1),
        total[:, 0] / np.maximum(total[up_safe, 0], 1),
        total[:, 0] / max(total[0, 0], 1.0),
    ]
    known = {t: k for k, t in enumerate(TAGS)}
    region = {t: k for k, t in enumerate(REGIONS)}
    tags, hints = np.zeros((n, len(TAGS))), np.zeros((n, len(HINTS)))
    above, within = np.zeros((n, len(HINTS))), np.zeros((n, len(REGIONS)))
    for i, x in enumerate(nodes):
        if (k := known.get(x.tag)) is not None:
            tags[i, k] = 1
        for k in x.hints:
            hints[i, k] = 1
        if i:
            above[i] = np.maximum(above[up[i]], hints[up[i]])
            within[i] = within[up[i]]
        if (k := region.get(x.tag)) is not None:
            within[i, k] = 1
    return np.concatenate((np.stack(columns, axis=1), tags, hints, above, within), axis=1), own


class Trees:
    """Gradient-boosted regression trees for the logistic loss, on binned features."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        margin, self.trees = np.full(len(y), self.base), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            size = (1 << self.depth + 1) - 1
            feature, split, value = np.full(size, -1), np.zeros(size), np.zeros(size)
            node = np.zeros(len(y), np.int64)
            for at in range(size):
                mine = np.flatnonzero(node == at)
                if not len(mine):
                    continue
                sg, sh = g[mine].sum(), h[mine].sum()
                value[at] = self.rate * sg / (sh + 1.0)
                if at >= (1 << self.depth) - 1 or len(mine) < 20:
                    continue
                best = (1e-3, -1, 0)
                for f, e in enumerate(self.edges):
                    if not len(e):
                        continue
                    lg = np.cumsum(np.bincount(binned[mine, f], g[mine], len(e) + 1))[:-1]
                    lh = np.cumsum(np.bincount(binned[mine, f], h[mine], len(e) + 1))[:-1]
                    gain = lg**2 / (lh + 1) + (sg - lg) ** 2 / (sh - lh + 1) - sg**2 / (sh + 1)
                    gain[(lh < 1) | (sh - lh < 1)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
                if best[1] >= 0:
                    feature[at], split[at] = best[1], self.edges[best[1]][best[2]]
                    node[mine] = 2 * at + 1 + (binned[mine, best[1]] > best[2])
            self.trees.append((feature, split, value))
            margin += value[node]
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, split, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f < 0, node, 2 * node + 1 + (x[rows, f] > split[node]))
            out += value[node]
        return out


def decode(nodes: list[Node], own: np.ndarray, margins: np.ndarray) -> np.ndarray:
    """Which nodes' own text is taken: best labels where each subtree is whole or split.

    A node's evidence is its margin times the text it holds itself. A subtree may be taken
    whole, left whole, or be decided child by child; every such choice costs ``SWITCH``
    for each child that differs from the node, which keeps lone contradictions out.
    """
    n = len(nodes)
    weight = np.clip(margins, -4, 4) * np.log1p(own)
    evidence = weight + np.clip(margins, -4, 4)
    take, leave = np.where(evidence > 0, evidence, evidence).tolist(), [0.0] * n
    up = [x.parent for x in nodes]
    for i in range(n - 1, 0, -1):
        p = up[i]
        # Below a node that is left nothing is taken unless it pays for the switch, and the other way round.
        take[p] += max(take[i], leave[i] - SWITCH)
        leave[p] += max(leave[i], take[i] - SWITCH)
    taken = np.zeros(n, bool)
    for i in range(1, n):
        if taken[up[i]]:
            taken[i] = take[i] >= leave[i] - SWITCH
        else:
            taken[i] = take[i] - SWITCH > leave[i]
    return taken


SWITCH = 3.0


def text_of(nodes: list[Node], taken: np.ndarray) -> str:
    blocks: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        if piece:
            line = _SPACE.sub(" ", html.unescape("".join(piece))).strip()
            if line:
                blocks.append(line)
            piece.clear()

    work: list[tuple[int, int]] = [(0, 0)]
    while work:
        i, at = work.pop()
        parts = nodes[i].parts
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.__class__ is str:
                if taken[i]:
                    piece.append(part)
                continue
            if nodes[part].tag in BLOCK:
                flush()
            work.append((i, at))
            i, at, parts = part, 0, nodes[part].parts
        if nodes[i].tag in BLOCK:
            flush()
    flush()
    return "\n".join(blocks)


def extract(pages: list[str | None], trees: Trees) -> list[str]:
    """Main texts; the nodes of all given pages are scored together."""
    parsed = [parse(p or "") for p in pages]
    made = [tree_features(nodes) for nodes in parsed]
    margins = trees.margins(np.concatenate([x for x, _ in made])) if made else np.zeros(0)
    ends = np.cumsum([len(nodes) for nodes in parsed]).tolist()
    return [
        text_of(nodes, decode(nodes, own, margins[end - len(nodes) : end]))
        for nodes, (_, own), end in zip(parsed, made, ends)
    ]


# --- training pages ---------------------------------------------------------------------
_GOOD = ("", 'class="content"', 'class="post-body"', 'id="article"', 'class="entry-content"', 'id="main"', 'class="story text"', 'role="main"')
_BAD = {
    "nav": ("", 'class="menu"', 'id="navbar"', 'class="breadcrumbs"'),
    "header": ("", 'class="site-header"', 'id="masthead"'),
    "footer": ("", 'class="footer"', 'id="site-footer"'),
    "aside": ("", 'class="sidebar"', 'class="related-posts"', 'class="widget"'),
    "form": ("", 'class="newsletter-form"', 'id="search"', 'class="comment-form"'),
    "div": (
        'class="ad"', 'class="ads banner"', 'id="sponsored"', 'class="advert"', 'class="cookie-notice"', 'id="consent"', 'class="sidebar"',
        'class="menu"', 'class="footer"', 'id="comments"', 'class="comment-list"', 'class="related"', 'class="share"', 'class="popup newsletter"',
        'class="header"', 'class="promo"', 'class="notice"',
    ),
    "section": ('class="comments"', 'id="comments"', 'class="related"', 'class="newsletter"'),
}


def training_pages(texts: list[str], n: int, seed: int = 0, nested: float = 0.08) -> list[str]:
    """Pages laid out by rule; texts are lines of prose, and a mark begins each main block.

    ``nested`` is the chance of boilerplate after a block, inside the main element.
    """
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    line = lambda: pick(texts)
    some = lambda low, high: range(int(rng.integers(low, high)))
    passage = lambda: " ".join(line() for _ in some(1, 9))
    short = lambda: " ".join(line().split()[: int(rng.integers(1, 6))])
    mark = "\x02"

    def boilerplate() -> str:
        tag = pick(list(_BAD))
        attributes = pick(_BAD[tag])
        kind = int(rng.integers(4))
        if kind == 0:
            inner = "<ul>" + "".join(f'<li><a href="/x">{html.escape(short())}</a></li>' for _ in some(2, 9)) + "</ul>"
        elif kind == 1:
            inner = html.escape(line() if rng.random() < 0.8 else passage())
        elif kind == 2:
            inner = "".join(f"<p>{html.escape(line())}</p>" for _ in some(1, 4))
        else:
            inner = "".join(f'<div class="item"><a href="/y">{html.escape(short())}</a> <span>{html.escape(short())}</span></div>' for _ in some(1, 5))
        if tag == "form":
            inner = f"<label>{html.escape(short())}</label><input type=text>" + inner
        return f"<{tag} {attributes}>{inner}</{tag}>"

    pages = []
    for _ in range(n):
        body = []
        if rng.random() < 0.8:
            body.append(f"<h1>{mark}{html.escape(line()[:80])}</h1>")
        for _ in some(1, 10):
            kind = rng.random()
            if kind < 0.75:
                text = passage() if rng.random() < 0.6 else line() if rng.random() < 0.8 else short()
                lead, close = pick((("", ""), ("", ""), ("", ""), ("<b>", ""), ("<b>", "</b><br>"), ("<span>", "</span>")))
                body.append(f"<p>{lead}{mark}{html.escape(text)}{close}{pick(('</p>', '</p>', '</p>', '<br>'))}")
            elif kind < 0.83:
                text = short()
                body.append(f"<h2>{mark}{html.escape(text)}</h2>")
            elif kind < 0.9:
                text = line()
                body.append(f"<blockquote><p>{mark}{html.escape(text)}</p></blockquote>")
            elif kind < 0.95:
                body.append("<ul>" + "".join(f"<li>{mark}{html.escape(short())}</li>" for _ in some(2, 5)) + "</ul>")
            else:
                first, *rest = line().split(" ")
                body.append(f'<p>{mark}<a href="/z">{html.escape(first)}</a> {html.escape(" ".join(rest))}</p>')
            if rng.random() < nested:
                body.append(boilerplate())
        tag = pick(["article", "article", "main", "div", "div", "section"])
        attributes = pick(_GOOD[1:]) if tag in ("div", "section") or rng.random() < 0.5 else ""
        inner = f"<{tag} {attributes}>{''.join(body)}</{tag}>"
        for _ in some(0, 3):
            inner = f"<div {pick(('', 'class=wrapper', 'id=page', 'class=container'))}>{inner}</div>"
        before = "".join(boilerplate() for _ in some(0, 4))
        after = "".join(boilerplate() for _ in some(0, 4))
        pages.append(f"<!DOCTYPE html><html><head><title>{html.escape(short())}</title></head><body>{before}{inner}{after}</body></html>")
    return pages


def fit(texts: list[str], n: int = N_PAGES) -> Trees:
    """Trees from ``n`` laid-out pages. An element is content if main text lies in it and
    no element below it holds other text than main text."""
    xs, ys = [], []
    for page in training_pages(texts, n, nested=NESTED):
        nodes = parse(page)
        good, bad = np.zeros(len(nodes)), np.zeros(len(nodes))
        for i, x in enumerate(nodes):
            for part in x.parts:
                if part.__class__ is str and part.strip():
                    (good if "\x02" in part or x.label else bad)[i] += 1
            for part in x.parts:
                # Inline elements of a marked block belong to it.
                if part.__class__ is int and nodes[part].tag in ("a", "span", "b"):
                    nodes[part].label = int(x.label or any(p.__class__ is str and "\x02" in p for p in x.parts))
                    if good[i]:
                        bad[i] = 0
        for i in range(len(nodes) - 1, 0, -1):
            good[nodes[i].parent] += good[i]
            bad[nodes[i].parent] += bad[i]
        for x in nodes:
            x.parts = [p.replace("\x02", "") if p.__class__ is str else p for p in x.parts]
        features, _ = tree_features(nodes)
        xs.append(features[1:])
        ys.append(((good > 0) & (good > 2 * bad))[1:])
    return Trees().fit(np.concatenate(xs), np.concatenate(ys).astype(np.float64))


def prose(pages: DataFrame, n: int = 400) -> list[str]:
    """At most ``n`` lines of text from pages, for laying out training pages."""
    part = F.explode(F.split(F.regexp_replace("html", "<[^>]*>", "\n"), "\n")).alias("line")
    chosen = pages.where("html IS NOT NULL").orderBy(F.xxhash64("page_id", "url")).limit(40)
    rows = chosen.select(part).where(F.length(F.btrim("line")) > 30).distinct().orderBy(F.xxhash64("line")).limit(n).collect()
    return [html.unescape(r.line).strip() for r in rows] or ["Some words of plain prose to lay out a page with."]


def extracted(pages: DataFrame, n_training: int = N_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    trees = pages.sparkSession.sparkContext.broadcast(fit(prose(pages), n_training))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 2 << 20):
            texts = extract(batch.column("html").to_pylist(), trees.value)
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *made], names=["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
