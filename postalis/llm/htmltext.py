"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Each block element is a node with a hidden label: content, what stands around it, or a container that holds both. Its
own potential is the naive-Bayes odds of what the element itself shows: tag, class words, length of its own text, share
of links; nothing of its ancestors. Names of boxes that mostly stand around an article start from fixed odds, which
what the box holds and stands in can outweigh: a section named related-work within an article is part of it. Only
elements that mean navigation, forms, footers and asides, and hidden ones, are certain. Parent-child potentials are the odds of a child's label given its parent's; within what stands around,
nothing is content. Sum-product messages go up the tree and down again, which gives each node's exact marginal: a
paragraph in a comment section or an advert is like any other by itself, and differs by the messages it gets.

Both tables are learned from labelled nodes: those in or under semantic elements (article, main, nav, footer, ...) of a
bounded sample of sample_pages pages, drawn by a hash of the id. Nodes in or under elements whose class names a part
around an article stay unlabelled there, since semantic elements say nothing of them. Fixed prior counts stand beside.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import map_arrow

# HTML element groups.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
RAW = frozenset("script style title textarea".split())  # their text is no markup
MUTED = frozenset("template noscript iframe svg head select button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset("ul ol dl table menu body article main section div".split())
ITEMS = frozenset("li dt dd tr td th".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption summary".split())
# Elements whose name says what their text is: 1 the article, 0 what stands around it. A header is 0
# outside of an article.
SEMANTIC = {"article": 1, "main": 1, "nav": 0, "footer": 0, "aside": 0, "form": 0, "fieldset": 0, "menu": 0, "dialog": 0, "search": 0}
# Words of class, id and role that name parts around an article, also within longer names; words that do
# so as a whole name only; and words of the article itself.
SURE = frozenset("ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs byline-links comments commentlist consent contentinfo cookie cookies copyright disqus footer gdpr hidden login masthead menu modal nav navbar navigation newsletter outbrain pager pagination paywall popup promo promoted recommended related share sharing sidebar signup social sponsor sponsored subscribe taboola toolbar widget widgets".split())
DOUBTFUL = frozenset("alert aside comment complementary discussion dropdown feedback form header notice notification overlay promotion replies reply respond responses search skip tracking warning".split())
CONTENT = frozenset("article articlebody content entry main post story".split())
AROUND, ARTICLE, CONTAINER = 0, 1, 2
#: Chances of a container's own text and of its children's labels; a page itself is a container or all content.
OWN = {"none": 0.9, "short": 0.06, "middle": 0.03, "long": 0.01}
HELD = (0.5, 0.2, 0.3)
#: Observations that the prior adds for a usual sign; log odds of a sure sign; share of both labels' pooled counts that
#: is mixed into each label's, as features of a node depend on each other.
PRIOR, SURELY, POOLED = 4000.0, 1e4, 0.35
#: Log odds that a box named as a part around the article starts from: by its whole name, by a word in a longer name. What
#: is in it and around it decides by messages: leaving the article for a part around it costs about 5.
NAMED, NAMED_IN_PART = 12.0, 6.0
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW | MUTED}
BLOCK_START = re.compile(rf"<(?:{'|'.join(sorted(BLOCKS))})\b", re.I)


@dataclass
class Node:
    parent: int
    tag: str
    known: int | None = None  # what semantic elements say
    names: list[str] = field(default_factory=list)  # class, id and role
    own: int = 0
    text: int = 0
    link: int = 0
    signed: bool = False  # with a copyright sign in its own text


def names_of(attributes: str, tag: str = "") -> list[str]:
    """Classes and role, and the id of a box; ids of headings and other texts are slugs of what they say."""
    out = []
    if attributes and not attributes.isspace():
        for name, *values in ATTRIBUTE.findall(attributes):
            value, name = "".join(values).lower(), name.lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                out.append("hidden")
            elif name in ("class", "role") or name == "id" and tag not in TEXTUAL:
                out += [x for x in value.split() if not x.startswith(("has-", "with-", "no-", "without-"))]  # of what it holds
    return out


def parts_of(name: str) -> list[str]:
    return re.findall(r"[a-z]+", name)


def around(names: list[str]) -> bool:
    return any(n in SURE or n in DOUBTFUL or SURE.intersection(parts_of(n)) for n in names)


class Parser:
    """Block nodes in page order (parents first) and the text blocks (node, text), in time linear in the page."""

    def __init__(self, html: str) -> None:
        self.html, self.at = html, 0
        self.nodes, self.blocks, self.stack = [Node(-1, "html")], [], [0]
        self.open: Counter = Counter()  # tags on the stack
        self.parts: list[str] = []
        self.linked = self.held = 0
        self.endless: set[str] = set()  # tags without a further end tag
        self.run()

    def flush(self) -> None:
        text = " ".join(unescape("".join(self.parts)).split())
        self.parts.clear()
        if text:
            node = self.nodes[self.stack[-1]]
            node.own += len(text)
            node.text += len(text)
            node.link += min(self.held, len(text))
            node.signed |= "\N{COPYRIGHT SIGN}" in text
            self.blocks.append((self.stack[-1], text))
        self.held = 0

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.linked:
            self.held += len(text)

    def pop(self) -> str:
        tag = self.nodes[self.stack.pop()].tag
        self.open[tag] -= 1
        return tag

    def skip(self, tag: str) -> None:
        """Past the end tag; without one, scripts and styles take the rest, other elements end before the next block."""
        end = None if tag in self.endless else ENDS[tag].search(self.html, self.at)
        if end is None:
            self.endless.add(tag)
        if tag in RAW:
            self.at = end.end() if end else len(self.html) if tag in ("script", "style") else self.next_block()
        elif tag in ("button", "select"):  # which hold no blocks
            block = self.next_block()
            self.at = min(end.end(), block) if end else block
        else:
            self.at = end.end() if end else self.next_block()

    def next_block(self) -> int:
        found = BLOCK_START.search(self.html, self.at)
        return found.start() if found else len(self.html)

    def start(self, tag: str, attributes: str) -> None:
        nodes, stack = self.nodes, self.stack
        self.flush()
        if tag in CLOSES_P and nodes[stack[-1]].tag == "p":
            self.pop()
        if tag in SAME and any(self.open[x] for x in SAME[tag]):
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag in SAME[tag]:
                    while len(stack) > k:
                        self.pop()
                    break
                if nodes[stack[k]].tag in SCOPE:
                    break
        if tag in ("hr", "html", "body"):
            return
        parent, names = nodes[stack[-1]], names_of(attributes, tag)
        known = SEMANTIC.get(tag, parent.known)
        if parent.known == 0 and known == 1:  # an article in a sidebar is a teaser
            known = 0
        if tag == "header" and parent.known != 1:
            known = 0
        nodes.append(Node(stack[-1], tag, known, names))
        stack.append(len(nodes) - 1)
        self.open[tag] += 1
        self.linked = 0

    def run(self) -> None:
        html, size = self.html, len(self.html)
        while self.at < size:
            m = TOKEN.search(html, self.at)
            if m is None:
                self.add(html[self.at :])
                break
            if m.start() > self.at:
                self.add(html[self.at : m.start()])
            self.at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag == "a":
                    self.linked = max(0, self.linked - 1)
                elif tag in BLOCKS:
                    self.flush()
                    if self.open[tag]:
                        while self.pop() != tag:
                            pass
            elif tag in ENDS:
                if not m[3].rstrip().endswith("/"):
                    self.skip(tag)
            elif tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.linked += 1
            elif tag in BLOCKS:
                self.start(tag, m[3])
        self.flush()
        for node in reversed(self.nodes[1:]):
            self.nodes[node.parent].text += node.text
            self.nodes[node.parent].link += node.link


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    found = Parser(html)
    return found.nodes, found.blocks


def features(node: Node) -> Iterator[str]:
    """What the element shows of itself. A name counts whole and in parts, apart for boxes and for textual elements."""
    density = node.link / node.text if node.text else -1.0
    if node.tag not in ITEMS:  # whose list or table shows it once for all of them
        yield "tag:page header" if node.tag == "header" and node.known == 0 else f"tag:{node.tag}"
        yield f"links:{'none' if density < 0 else 'few' if density < 0.2 else 'some' if density < 0.6 else 'most'}"
    size = "none" if not node.own else "short" if node.own < 40 else "middle" if node.own < 150 else "long"
    if node.tag not in ITEMS or size in ("middle", "long"):
        yield f"own:{size}"
    if node.signed:
        yield "copyright"
    if node.names:
        kind = "text" if node.tag in TEXTUAL else "box"
        for name in dict.fromkeys(node.names):
            yield f"{kind}:{name}"
            if len(parts := dict.fromkeys(parts_of(name))) > 1:
                yield from (f"{kind} part:{p}" for p in parts)


def certain() -> dict[str, float]:
    """Log odds of features that no count changes."""
    out = {f"tag:{tag}": -SURELY for tag, label in SEMANTIC.items() if not label} | {"tag:page header": -SURELY}
    out |= {f"box:{word}": -NAMED for word in SURE | DOUBTFUL} | {f"box part:{word}": -NAMED_IN_PART for word in SURE} | {f"box part:{word}": -NAMED_IN_PART * 3 / 4 for word in DOUBTFUL}
    out["box:hidden"] = out["text:hidden"] = -SURELY
    return out | {f"tag:{tag}": SURELY / 100 for tag, label in SEMANTIC.items() if label}  # less: one in a sidebar is a teaser


def prior() -> Counter:
    """Fixed prior counts by ('f' + label, feature) and ('e' + parent label, child label)."""
    out: Counter = Counter()
    for word in SURE | DOUBTFUL:
        out["f0", f"text:{word}"], out["f0", f"text part:{word}"], out["f0", f"box part:{word}"] = 20.0, 7.0, 20.0
    for word in CONTENT:
        out["f1", f"box:{word}"] = out["f1", f"box part:{word}"] = PRIOR / 40
    for tag in ("p", "h1", "h2", "h3", "blockquote", "pre"):
        out["f1", f"tag:{tag}"], out["f0", f"tag:{tag}"] = PRIOR / 4, PRIOR / 16
    out["f1", "links:few"], out["f0", "links:few"], out["f0", "links:most"] = PRIOR / 2, PRIOR / 4, PRIOR
    for size, share in (("short", 4), ("middle", 8), ("long", 16)):
        out["f1", f"own:{size}"], out["f0", f"own:{size}"] = PRIOR / 4, PRIOR / share
    out["e1", "0"], out["e1", "1"] = PRIOR * 0.01, PRIOR * 0.99
    return out


def summed(a: float, b: float, c: float) -> float:
    """log(exp(a) + exp(b) + exp(c))"""
    top = max(a, b, c)
    return top + math.log(math.exp(a - top) + math.exp(b - top) + math.exp(c - top))


class Model:
    def __init__(self, seen: dict[tuple[str, str], float]) -> None:
        """seen: counts by ('f' + label, feature), ('n', label) and ('e' + parent label, child label)."""
        total = prior()
        total.update(seen)
        size = [total["n", y] + 4 * PRIOR for y in "01"]
        sure = certain()
        self.odds: dict[str, tuple[float, float]] = {}  # of article and of container, against around
        for f in {f for k, f in total if k in ("f0", "f1")} | set(sure):
            both = (total["f0", f] + total["f1", f] + 2.0) / (sum(size) + 4.0)
            around_, article = (math.log((1 - POOLED) * (total[f"f{y}", f] + 1.0) / (size[y] + 2.0) + POOLED * both) for y in (0, 1))
            kind, _, value = f.partition(":")
            container = math.log(OWN[value] if kind == "own" else both) - (6.0 if kind == "tag" and value in TEXTUAL else 0.0)
            self.odds[f] = (sure.get(f, article - around_), min(sure.get(f, 0.0), 0.0) + container - around_)
        ends, never = total["e1", "0"] / (total["e1", "0"] + total["e1", "1"]), -100 * SURELY
        self.edge = [[0.0, never, never], [math.log(ends), math.log(1 - ends), never], [math.log(x) for x in HELD]]  # log P(child | parent)

    def own(self, node: Node) -> tuple[float, float, float]:
        """Log potential of each label from the node's own features."""
        known = [self.odds[f] for f in features(node) if f in self.odds]
        return 0.0, sum(x[0] for x in known), sum(x[1] for x in known)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log odds of the article against the other labels: messages from the leaves to the root, then back."""
        edge, n = self.edge, len(nodes)
        up, sent, down = [self.own(x) for x in nodes], [(0.0, 0.0, 0.0)] * n, [(0.0, 0.0, 0.0)] * n
        up[0] = (-SURELY, up[0][1], up[0][1])  # the page
        for i in range(n - 1, 0, -1):
            a, b, c = up[i]
            x, y, z = (summed(e[0] + a, e[1] + b, e[2] + c) for e in edge)
            top = max(x, y, z)
            sent[i] = m = (x - top, y - top, z - top)
            p = up[nodes[i].parent]
            up[nodes[i].parent] = (p[0] + m[0], p[1] + m[1], p[2] + m[2])
        for i in range(1, n):
            k, m = nodes[i].parent, sent[i]
            a, b, c = (up[k][j] + down[k][j] - m[j] for j in range(3))
            x, y, z = (summed(edge[0][j] + a, edge[1][j] + b, edge[2][j] + c) for j in range(3))
            top = max(x, y, z)
            down[i] = (x - top, y - top, z - top)
        out = []
        for u, d in zip(up, down, strict=True):
            rest = summed(u[AROUND] + d[AROUND], u[CONTAINER] + d[CONTAINER], -math.inf)
            out.append(u[ARTICLE] + d[ARTICLE] - rest)
        return out


def observed(html: str) -> Counter:
    """Counts of the page's labelled nodes."""
    seen: Counter = Counter()
    nodes, _ = parse(html)
    unsure = [False] * len(nodes)
    labels: list[int | None] = [None] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        unsure[i] = unsure[node.parent] or around(node.names)
        if unsure[i] or node.known is None:
            continue
        labels[i] = y = node.known
        seen["n", str(y)] += 1
        for f in features(node):
            seen[f"f{y}", f] += 1
        if (p := labels[node.parent]) is not None:
            seen[f"e{p}", str(y)] += 1
    return seen


def fit(pages: DataFrame, sample_pages: int = 2000) -> Model:
    """Counts of a sample of about sample_pages pages; as many features as they show."""
    n = pages.count()
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col("page_id")), F.lit(1 << 30)) / float(1 << 30)
    sample = pages.filter(part < min(1.0, sample_pages / max(n, 1)) if n > sample_pages else F.lit(True))

    def make():
        def step(batch: pa.RecordBatch):
            seen: Counter = Counter()
            for html in batch.column(0).to_pylist():
                seen.update(observed(html or ""))
            yield {"kind": [k for k, _ in seen], "value": [v for _, v in seen], "n": list(seen.values())}

        return step

    counts = map_arrow(sample.select(F.col("html").cast("string")), make, "kind string, value string, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    return Model({(r.kind, r.value): r.n for r in counts.collect()})  # features of the sample


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars): text blocks whose node is as likely content as not, or more, joined by line feeds.

    pages needs page_id, url and html; other columns, whatever their names, are left aside. Null and empty html give an
    empty text. Very long and deeply nested pages take time in proportion to their length. Repeated rows repeat their
    result; an empty table gives an empty one.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)  # features of sample_pages pages

    def make():
        known = sent.value

        def step(batch: pa.RecordBatch):
            texts = []
            for html in batch.column(2).to_pylist():
                nodes, blocks = parse(html or "")
                odds = known.marginals(nodes) if blocks else ()
                texts.append("\n".join(text for node, text in blocks if odds[node] >= 0))
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

        return step

    return map_arrow(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")), make, "page_id long, url string, text string, n_chars long")
