"""Main text of web pages by minimum-cut labelling (operator 3).

A page is cut into text blocks.  A logistic classifier turns each block's place
in the DOM, class names, links, length, position and neighbours into the log
odds of content, which are the capacities to the two terminals.  Blocks next
to each other and blocks under one parent are tied by smoothness edges, the
tighter the closer they are in the DOM.  The minimum cut, found by max-flow,
is the labelling with the least total cost: a short line between paragraphs
goes with them, an advert among them does not.

Classifier and ties are fitted on a bounded sample of the pages at hand, whose
labels are their own ``article``, ``nav``, ``aside``, ``footer`` elements; half
of the sample is seen without tags and names, so that what a block says of
itself carries weight where a layout has no telling names.  Where few blocks
are labelled, the fit stays near the weights it starts from.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role, and name parts that sites use.
RAW = {"script", "style", "textarea", "title", "template", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog",
          "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3",
          "h4", "h5", "h6", "head", "header", "hgroup", "html", "label", "legend", "li", "main", "menu", "nav", "ol",
          "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot",
          "th", "thead", "tr", "ul", "xmp"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
          "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
#: Inline elements that are blocks of their own where their name says that they are adverts.
INLINE = {"span", "ins", "em", "small", "b", "i", "strong", "font"}
SCOPE = {"table", "ul", "ol", "dl", "select", "article", "section", "div", "body", "nav", "main", "aside", "footer", "header"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TAG_WEIGHT = {"nav": -8.0, "menu": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "dialog": -8.0, "search": -8.0,
              "button": -8.0, "select": -8.0, "fieldset": -8.0, "head": -20.0, "label": -3.0, "header": -6.0,
              "noscript": -4.0, "article": 4.0, "main": 2.5, "p": 0.7, "blockquote": 0.5, "pre": 0.7, "xmp": 0.7, "h1": 0.5, "figcaption": 0.2}
BAD_NAMES = {"ad", "ads", "adbox", "adsense", "advert", "adverts", "advertisement", "advertising", "alert", "banner",
             "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies",
             "copyright", "disclaimer", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu",
             "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager",
             "pagination", "popup", "privacy", "promo", "promoted", "promotion", "recommended", "related", "reply",
             "replies", "respond", "responses", "search", "share", "sharing", "sidebar", "sidenav", "signup", "sitemap",
             "signin", "register", "subscription", "feedback", "discussion", "teaser", "teasers", "notices",
             "notification", "notifications", "paywall", "donate", "legal", "colophon", "crumbs", "adslot", "adunit",
             "adbanner", "rail", "popular", "trending", "offer", "offers", "poll", "skip", "skyscraper", "social", "sponsor", "sponsors", "sponsored", "subscribe", "toc", "toolbar",
             "topbar", "widget", "widgets"}
BAD_STARTS = ("advert", "breadcrumb", "comment", "cookie", "navig", "newsletter", "sidebar", "sponsor")
GOOD_NAMES = {"article", "articlebody", "body", "content", "entry", "main", "post", "story", "text"}
#: Of the bad names those that are no topics; in the id of an article's part, beside no other words than names of layout.
SITE_NAMES = {"ad", "adbanner", "adbox", "ads", "adsense", "adslot", "adunit", "advert", "adverts", "breadcrumb", "breadcrumbs",
              "colophon", "comment", "commentlist", "comments", "consent", "cookie", "crumbs", "disqus", "gdpr", "masthead",
              "menubar", "nav", "navbar", "newsletter", "pager", "pagination", "paywall", "promo", "promoted", "share", "sidebar",
              "sidenav", "signin", "signup", "sitemap", "skyscraper", "sponsored", "subscribe", "teaser", "teasers", "toc",
              "topbar"}
LAYOUT = {"area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "col", "column", "container", "div", "id", "inner",
          "item", "items", "left", "link", "links", "list", "outer", "page", "panel", "post", "right", "section", "site", "thread",
          "top", "wrap", "wrapper"}
#: Elements whose ids name parts of a page; other ids are anchors.
CONTAINERS = {"article", "aside", "center", "details", "dialog", "div", "dl", "fieldset", "footer", "form", "header", "main", "menu",
              "nav", "ol", "search", "section", "table", "ul"}
#: Classes that, with names of layout alone, say of a part of an article that it is none.
ASIDES = {"related", "recommended"}
#: Names of adverts, which also an inline element may have.
ADVERT_NAMES = {"ad", "adbanner", "adbox", "ads", "adsense", "adslot", "adunit", "advert", "adverts", "advertisement", "advertising",
                "promo", "promoted", "sponsor", "sponsored"}
BAD_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar",
             "navigation", "note", "search", "toolbar"}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ENDS = re.compile(r"[.!?…。][\"'»”)\]]*\s*$")

NAME_WEIGHT, ID_WEIGHT, GOOD_WEIGHT, ROLE_WEIGHT = -8.0, -5.0, 1.5, -8.0
#: What bears out a name that may be a topic: so much of the text in links, or a form field for so many characters.
LINKED, FIELD_CHARS = 0.5, 200
#: A reader's comment, by id or by name.
REPLY_ID = re.compile(r"(?:comment|reply|response)[-_]?\d+", re.I)
REPLIES = {"comment", "comments", "commentlist", "replies", "reply"}
#: An element with so much evidence against it takes no credit from what it stands in.
AGAINST = -3.0
#: Elements that an article inside one shows to be unclosed, or to wrap the page.
WRAPPERS = {"nav", "menu", "header", "form", "noscript"}
#: Smoothness: neighbours under one parent, neighbours elsewhere by common depth, and the next block of one parent.
SIBLINGS, NEAR, FAR = 2.0, 0.6, 0.15
SCALE = 100


class _Node:
    """An open element: its name, its own evidence, its place, and what it holds (characters, those in links, form
    fields, comments).  ``doubtful``: its id has a bad name that may be a topic, too."""
    __slots__ = ("tag", "own", "doubtful", "reply", "parent", "depth", "inside", "chars", "linked", "fields", "replies", "weight",
                 "certain")

    def __init__(self, tag: str, parent: _Node | None, own: float = 0.0, doubtful: bool = False, reply: bool = False):
        self.tag, self.parent, self.own, self.doubtful, self.reply = tag, parent, own, doubtful, reply
        self.depth = parent.depth + 1 if parent else 0
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.chars = self.linked = self.fields = self.replies = 0
        self.weight, self.certain = 0.0, False

    def report(self) -> None:
        """What it holds, its parent holds."""
        up = self.parent
        up.chars += self.chars
        up.linked += self.linked
        up.fields += self.fields
        up.replies += self.replies + self.reply

    def settle(self) -> None:
        """The evidence of the element and its ancestors, of which it is the last to be settled."""
        tag, weight = self.tag, self.own
        if self.doubtful and (self.linked > LINKED * self.chars or self.chars <= FIELD_CHARS * self.fields or self.replies):
            weight += NAME_WEIGHT
        above, certain = self.parent.weight, self.parent.certain
        # boilerplate above it that no unclosed or wrapping element explains
        self.certain = certain or weight <= AGAINST and not (tag in WRAPPERS and weight == TAG_WEIGHT[tag])
        if tag == "main" or tag == "article" and not certain:
            above = max(above, 0.0)
        elif weight <= AGAINST:                    # boilerplate inside an article is still boilerplate
            above = min(above, 0.0)
        self.weight = above + weight


def _weight(tag: str, attributes: str, in_article: bool) -> tuple[float, bool, bool]:
    """An element's own evidence, whether its id's name may be a topic as well, and whether it is a reader's comment."""
    w, doubtful, reply = TAG_WEIGHT.get(tag, 0.0), False, in_article and tag == "article"
    if tag == "header" and in_article:
        w = -1.0
    if not attributes or attributes.isspace():
        return w, doubtful, reply
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            w -= 20.0
        elif name == "role":
            w += ROLE_WEIGHT if value.lower() in BAD_ROLES else GOOD_WEIGHT if value.lower() in ("main", "article") else 0.0
        elif name in ("class", "id") and tag not in ("html", "body"):
            parts = {p.lower() for p in NAME.findall(value)}
            reply = reply or (bool(REPLY_ID.fullmatch(value)) if name == "id" else not parts.isdisjoint(REPLIES))
            part_of = in_article or tag in ("article", "main")
            if part_of and (tag in HEADINGS or name == "id" and tag not in CONTAINERS and not parts & ADVERT_NAMES):
                continue                           # a name made from its text, or an anchor
            bad = {p for p in parts if p in BAD_NAMES or p.startswith(BAD_STARTS)}
            if bad == {"header"} and parts & GOOD_NAMES:      # the head of an entry, not of the site
                w -= 1.0
            elif bad and part_of and (name == "id" or not (bad & SITE_NAMES or parts <= ASIDES | LAYOUT or any(p.startswith(BAD_STARTS) for p in bad))):
                if bad & SITE_NAMES and parts <= BAD_NAMES | LAYOUT:
                    w += NAME_WEIGHT if tag == "article" else ID_WEIGHT
                else:
                    doubtful = True
            elif bad:
                w += NAME_WEIGHT
            elif parts & GOOD_NAMES:
                w += GOOD_WEIGHT
    return w, doubtful, reply


def _is_advert(attributes: str) -> bool:
    return any(name.lower() in ("class", "id") and not ADVERT_NAMES.isdisjoint(p.lower() for p in NAME.findall(value))
               for name, value in ATTRIBUTE.findall(attributes)) if attributes and not attributes.isspace() else False


def _end_tag(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I)


def blocks(page: str) -> list[Block]:
    """The text blocks in page order."""
    root = _Node("", None)
    nodes: list[_Node] = []
    node, out, text, linked, in_link, foreign, at = root, [], [], 0, False, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                line = " ".join(words)
                out.append((line, len(words), min(1.0, linked / len(line)), node))
                node.chars += len(line)
                node.linked += min(linked, len(line))
            text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text.append(raw)
        if in_link:
            linked += len(raw.strip())

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            add(" ")
        elif tag == "hr":
            flush()
        elif tag == "input":
            node.fields += "hidden" not in attributes.lower()
        elif tag in RAW:
            node.fields += tag == "textarea" and not closing
            if not closing and not (foreign and attributes.endswith("/")):
                end = _end_tag(tag).search(page, at)
                at = end.end() if end else len(page)
        elif tag in ("svg", "math"):                    # a raw element in them may be empty
            foreign = max(0, foreign - 1) if closing else foreign + (not attributes.endswith("/"))
        elif tag in BLOCKS or tag == "noscript" and not node.inside or tag in INLINE and (      # in an article noscript is part of a line
                closing and node.tag == tag or not closing and _is_advert(attributes)):
            flush()
            if closing:
                up = node
                while up is not root and up.tag != tag:
                    up = up.parent
                if up is not root:
                    node = up.parent
            else:
                in_link = False
                if tag == "body":                       # an open head ends here
                    up = node
                    while up is not root and up.tag != "head":
                        up = up.parent
                    node = up.parent if up is not root else node
                up = node
                closes = CLOSES.get(tag, ())
                while up is not root and up.tag not in SCOPE:
                    if up.tag == "p" or up.tag in closes or up.tag in HEADINGS and tag in HEADINGS:
                        node = up.parent
                    up = up.parent
                node = _Node(tag, node, *_weight(tag, attributes, node.inside))
                node.fields += tag == "select"
                nodes.append(node)
                if tag == "xmp" and (end := _end_tag(tag).search(page, at)):      # its text is shown as it is written
                    add(html.escape(page[at:end.start()]))
                    flush()
                    node, at = node.parent, end.end()
    flush()
    for n in reversed(nodes):                      # what stands in an element was opened after it
        n.report()
    for n in nodes:
        n.settle()
    return [Block(line, words, links, n) for line, words, links, n in out]


class Block(NamedTuple):
    """Text, its words, the share of it in links, and the element it stands in."""
    text: str
    words: int
    links: float
    node: _Node


#: What the classifier sees of a block, and the weights that a fit starts from.
START = {"one": -0.6, "place": 1.0, "length": 1.0, "links": -4.0, "ends": 0.5, "heading": 0.4, "one_link": -6.5, "parent_links": 0.0,
         "parent_length": 0.0, "before_length": 0.0, "after_length": 0.0, "around_links": 0.0, "from_top": 0.0, "from_middle": 0.0}
PLACE = list(START).index("place")
#: Most that a block's own evidence is worth, and a tie.
CLIP, TIE_CLIP = 8.0, 3.0
#: How firmly a fit holds to where it starts: as so many labelled blocks, and pairs of neighbours.
HOLD, HOLD_PAIRS = 50.0, 400.0
#: The sample: pages, and labelled blocks of a page, evenly spread over it. A bound of memory; the fit alone depends on it.
FIT_PAGES, FIT_BLOCKS = 1_000, 64


class Model(NamedTuple):
    weights: tuple[float, ...] = tuple(START.values())
    ties: tuple[float, float, float] = (SIBLINGS, NEAR, FAR)


def _length(words: int) -> float:
    return min(words, 60) / 20.0


def features(found: list[Block]) -> np.ndarray:
    """One row per block, in the order of ``START``."""
    x = np.zeros((len(found), len(START)))
    for i, (text, words, links, node) in enumerate(found):
        before, after = found[i - 1] if i else None, found[i + 1] if i + 1 < len(found) else None
        around = [o.links for o in (before, after) if o]
        up = node.parent if node.parent is not None else node
        at = i / max(1, len(found) - 1)
        x[i] = (1.0, node.weight, _length(words), max(0.0, links - 0.3), bool(ENDS.search(text)), node.tag in HEADINGS,
                links > 0.9 and node.tag in ("p", "div", "center"), max(0.0, up.linked / max(1, up.chars) - 0.3), min(up.chars, 4_000) / 4_000,
                _length(before.words) if before else 0.0, _length(after.words) if after else 0.0, sum(around) / max(1, len(around)),
                at, abs(at - 0.5))
    return x


def _label(node: _Node) -> int | None:
    """What the page's own elements say of a block: 1 content, 0 boilerplate; None where they say nothing, or names object."""
    up, objected = node, False
    while up is not None:
        if up.tag in ("article", "main"):
            return None if objected or up.own < 0 or up.reply else 1
        if up.tag in ("nav", "aside", "footer", "menu", "form", "dialog", "search"):
            return 0
        if up.tag == "header" and not up.inside:
            return 0
        objected = objected or up.own < 0 or up.doubtful or up.reply
        up = up.parent
    return None


def _tied(found: list[Block]) -> Iterator[tuple[int, int, int, float]]:
    """The smoothness edges: two blocks, the kind of the tie, and its share of that kind's weight."""
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            yield i - 1, i, _tie(found[i - 1].node, b.node), 1.0
        before = last.get(id(b.node.parent))
        if before is not None and before < i - 1:
            yield before, i, 0, 0.5
        last[id(b.node.parent)] = i


def _lesson(page: str, hide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one page: features and labels of labelled blocks, and per kind of tie the neighbours of one label and of two."""
    found = blocks(page)
    labels = [_label(b.node) for b in found]
    pairs = np.zeros((3, 2))
    for a, b, kind, share in _tied(found):
        if share == 1.0 and labels[a] is not None and labels[b] is not None:
            pairs[kind, int(labels[a] != labels[b])] += 1
    known = [i for i, y in enumerate(labels) if y is not None]
    known = known[::max(1, -(-len(known) // FIT_BLOCKS))]
    x = features(found)[known]
    if hide:
        x[:, PLACE] = 0.0
    return x, np.array([labels[i] for i in known], float), pairs


def fit(x: np.ndarray, y: np.ndarray, pairs: np.ndarray) -> Model:
    """Logistic regression by Newton's method, held to ``START``; ties from how often neighbours of a kind agree."""
    start = np.array(list(START.values()))
    w = start.copy()
    weight = np.where(y > 0, 0.5 / max(1.0, (y > 0).sum()), 0.5 / max(1.0, (y == 0).sum())) * len(y)      # both labels count alike
    if len(y) and 0 < y.sum() < len(y):
        for _ in range(30):
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - y)) + HOLD * (w - start)
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + HOLD * np.eye(len(w))
            step = np.linalg.solve(curve, slope)
            w = w - step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
            if np.abs(step).max() < 1e-8:
                break
    ties = []
    for base, (same, other) in zip((SIBLINGS, NEAR, FAR), pairs):
        odds = np.exp(2.0 * base)                             # a tie is half the log odds that two neighbours agree
        ties.append(float(np.clip(0.5 * np.log((same + HOLD_PAIRS * odds / (1 + odds)) / (other + HOLD_PAIRS / (1 + odds))), 0.0, TIE_CLIP)))
    return Model(tuple(w.tolist()), tuple(ties))


def train(pages: DataFrame, html_col: str = "html", fit_pages: int = FIT_PAGES) -> Model:
    """A model of these pages, from about ``fit_pages`` of them chosen by the hash of their text."""
    n = pages.count()
    place = F.pmod(F.xxhash64(html_col), F.lit(1 << 30))
    share = min(1.0, fit_pages / max(n, 1))
    sample = pages.filter(F.col(html_col).isNotNull()).filter(place < F.lit(int(share * (1 << 30)))).select(
        F.col(html_col).cast("string"), (F.pmod(F.xxhash64(F.lit(1), html_col), F.lit(2)) == 0).alias("hide")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, hide in zip(batch.column(0), batch.column(1)):
                x, y, pairs = _lesson(page.as_py(), hide.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in (x, y, pairs)], ["x", "y", "pairs"])
    lessons = sample.mapInArrow(run, "x binary, y binary, pairs binary").limit(2 * fit_pages).collect()
    x = np.concatenate([np.zeros((0, len(START))), *(np.frombuffer(r["x"]).reshape(-1, len(START)) for r in lessons)])
    y = np.concatenate([np.zeros(0), *(np.frombuffer(r["y"]) for r in lessons)])
    pairs = sum((np.frombuffer(r["pairs"]).reshape(3, 2) for r in lessons), np.zeros((3, 2)))
    return fit(x, y, pairs)


def _tie(a: _Node, b: _Node) -> int:
    """The kind of a tie: 0 under one parent, 1 near in the DOM, 2 far."""
    if a is b or a.parent is b.parent:
        return 0
    x, y = a, b
    while x.depth > y.depth:
        x = x.parent
    while y.depth > x.depth:
        y = y.parent
    while x is not y:
        x, y = x.parent, y.parent
    return 1 if a.depth + b.depth - 2 * x.depth <= 3 else 2


def min_cut(evidence: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which blocks are on the content side of the minimum cut (ties go to boilerplate), by Dinic's max-flow."""
    n = len(evidence)
    if all(e > 0 for e in evidence) or all(e <= 0 for e in evidence):
        return [e > 0 for e in evidence]
    supply = [max(0, round(e * SCALE)) for e in evidence]
    demand = [max(0, round(-e * SCALE)) for e in evidence]
    graph: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        c = round(w * SCALE)
        graph[a][b] = graph[a].get(b, 0) + c
        graph[b][a] = graph[b].get(a, 0) + c
    while True:
        level = {i: 0 for i in range(n) if supply[i]}
        queue, found = deque(level), False
        while queue:
            a = queue.popleft()
            found = found or demand[a] > 0
            for b, c in graph[a].items():
                if c and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if not found:
            return [i in level for i in range(n)]
        rest = [iter(list(g)) for g in graph]
        for start in [i for i in range(n) if supply[i]]:
            path = [start]
            while path and supply[start]:
                a = path[-1]
                if demand[a]:
                    flow = min(supply[start], demand[a], *(graph[x][y] for x, y in zip(path, path[1:])))
                    supply[start] -= flow
                    demand[a] -= flow
                    for x, y in zip(path, path[1:]):
                        graph[x][y] -= flow
                        graph[y][x] = graph[y].get(x, 0) + flow
                    for i, (x, y) in enumerate(zip(path, path[1:])):
                        if not graph[x][y]:
                            del path[i + 1:]
                            break
                    continue
                step = next((b for b in rest[a] if graph[a][b] and level.get(b) == level[a] + 1), None)
                if step is None:
                    path.pop()
                    level[a] = -1
                else:
                    path.append(step)


def label(page: str | None, model: Model = Model()) -> tuple[list[Block], list[float], list[bool]]:
    """The page's blocks, their own evidence, and which are content by the minimum cut."""
    found = blocks(page or "")
    evidence = np.clip(features(found) @ np.array(model.weights), -CLIP, CLIP).tolist()
    return found, evidence, min_cut(evidence, [(a, b, share * model.ties[kind]) for a, b, kind, share in _tied(found)])


def main_text(page: str | None, model: Model = Model()) -> str:
    """The page's content blocks, joined by one line feed; empty for a null or empty page."""
    found, _, keep = label(page, model)
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      model: Model | None = None) -> DataFrame:
    """One row per page: ``page_id, url, text``.

    Null and empty pages, and pages without content, have the empty text; long
    pages are read whole.  Repeated rows give repeated rows; an empty table
    gives an empty result; extra columns are ignored.  Without a ``model`` one
    is fitted on these pages; pages are independent, and nothing is shuffled
    but the sample."""
    model = train(pages, html_col) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), model) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])
    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id bigint, url string, text string")
