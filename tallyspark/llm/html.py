"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree.  Each has a hidden label, content or
not; its own features give a node potential, and each parent-child pair a
potential by the two labels and the child's kind.  Sum-product messages upward
and downward give every block's marginal, and blocks that are more likely
content than not make up the text.  Weights are learned by gradient ascent on
the conditional likelihood of labelled pages.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.markup import END, RAW, TEXT, tokens
from tallyspark.llm.common import small_batches

# fixed values: HTML element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var center picture output math svg object canvas noscript".split()
)
#: start tags that end an open <p>, and end tags implied by a sibling
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("html body table ul ol dl td th article section aside nav main header footer form div".split())
#: formulas and drawings: what is inside is part of the line
FOREIGN = frozenset(("math", "svg"))
#: open elements, as in browsers: a deeper one takes the place of the last
MAX_DEPTH = 512

# fixed values: what names of classes and ids say, by the start of a word
FAMILIES = {
    "comment": "comment reply replies discuss disqus respond",
    "nav": "nav menu breadcrumb crumb pagination pager toc tabs skip",
    "ad": "ad ads advert advertisement sponsor promo banner adsense outbrain taboola",
    "notice": "cookie consent notice alert gdpr newsletter subscribe popup modal overlay paywall message warning toast",
    "side": "side sidebar widget related recommend share social trending popular rail aside tags",
    "head": "header masthead topbar logo brand",
    "foot": "footer foot copyright legal colophon",
    "form": "form search login signup input",
    "main": "article content post entry story main body text prose page",
}
_FAMILY = {w: f for f, ws in FAMILIES.items() for w in ws.split()}
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    attrs: str = ""
    chars: int = 0
    link_chars: int = 0
    inner: int = 0
    inner_links: int = 0
    gold: int | None = None
    features: list[str] = field(default_factory=list)


@dataclass
class Page:
    """Block nodes in page order, and text chunks (node, block number, text)."""

    nodes: list[Node]
    chunks: list[tuple[int, int, str]]


def parse(html: str) -> Page:
    nodes = [Node("#root", -1)]
    chunks: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements, with the block node each stands in
    links = block = 0
    drawn = False  # whether a formula or drawing may be open
    for kind, tag, text, _, _ in tokens(html):
        if tag in RAW:
            continue
        if kind == TEXT:
            if "&" in text:
                text = entities.unescape(text)
            if text:
                at = stack[-1][1]
                chunks.append((at, block, text))
                n = len(text) if not text.isspace() else 0
                nodes[at].chars += n
                nodes[at].link_chars += n if links else 0
            continue
        if kind == END:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    block += stack[-1][1] != stack[k - 1][1]
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag == "br":
            chunks.append((stack[-1][1], block, " "))
            continue
        if tag in VOID:
            block += tag == "hr"
            continue
        foreign = next((k for k in range(1, len(stack)) if stack[k][0] in FOREIGN), 0) if drawn else 0
        if foreign and tag in CLOSES_P:
            # a block ends a formula or drawing that was left open
            links -= sum(t == "a" for t, _ in stack[foreign:])
            del stack[foreign:]
            foreign = 0
        drawn = bool(foreign) or tag in FOREIGN
        if len(stack) >= MAX_DEPTH:
            links -= stack[-1][0] == "a"
            del stack[-1]
        ends = ("p",) if tag in CLOSES_P else SIBLINGS.get(tag, ())
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in SCOPES:
                    break
        if tag in INLINE or foreign:
            links += tag == "a"
            stack.append((tag, stack[-1][1]))
            continue
        block += 1
        nodes.append(Node(tag, stack[-1][1], text))
        stack.append((tag, len(nodes) - 1))
    return Page(nodes, chunks)


def _features(page: Page) -> None:
    nodes = page.nodes
    for n in nodes:
        n.inner, n.inner_links = n.chars, n.link_chars
    for n in reversed(nodes[1:]):
        nodes[n.parent].inner += n.inner
        nodes[n.parent].inner_links += n.inner_links
    for n in nodes:
        f = ["bias", "tag=" + n.tag]
        if n.attrs:
            words, shown = set(), True
            for name, value in _ATTR.findall(n.attrs):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id", "role"):
                    words.update(_WORDS.findall(value))
                elif name == "hidden" or name == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
                    shown = False
            found = {_FAMILY[w] for w in words if w in _FAMILY}
            found |= {_FAMILY[w[:-1]] for w in words if w.endswith("s") and w[:-1] in _FAMILY}
            found |= {fam for w in words for k, fam in _FAMILY.items() if len(k) > 4 and w not in _FAMILY and w.startswith(k)}
            if found - {"main"}:
                found.discard("main")
            f += ["fam=" + x for x in sorted(found)]
            if not shown:
                f.append("hidden")
        share = n.inner_links / n.inner if n.inner else 0.0
        f.append("links=" + ("none" if not share else "some" if share < 0.3 else "many" if share < 0.7 else "most"))
        own = n.chars
        f.append("own=" + ("0" if not own else "s" if own < 25 else "m" if own < 100 else "l"))
        n.features = f


@dataclass(frozen=True)
class Model:
    """Log potentials: of a feature with label content, and of (child kind,
    parent label, child label)."""

    node: dict[str, float]
    edge: dict[tuple[str, int, int], float]

    def marginals(self, nodes: list[Node]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
        """P(content) of each node, and of each node's pair with its parent
        (parent label, child label) = 00, 01, 10, 11."""
        w, e = self.node, self.edge
        unary = [sum(w.get(f, 0.0) for f in n.features) for n in nodes]
        # messages are kept as normalised odds of content, in logs
        up, to_parent = unary[:], [0.0] * len(nodes)
        pair = []
        for n in nodes:
            k = _kind(n)
            pair.append((e.get((k, 0, 0), 0.0), e.get((k, 0, 1), 0.0), e.get((k, 1, 0), 0.0), e.get((k, 1, 1), 0.0)))
        for i in range(len(nodes) - 1, 0, -1):
            p00, p01, p10, p11 = pair[i]
            to_parent[i] = _add(p10, p11 + up[i]) - _add(p00, p01 + up[i])
            up[nodes[i].parent] += to_parent[i]
        full, pairs = up[:], [(0.0, 0.0, 0.0, 0.0)] * len(nodes)
        for i in range(1, len(nodes)):
            p00, p01, p10, p11 = pair[i]
            rest = full[nodes[i].parent] - to_parent[i]  # the parent's belief without this child
            full[i] = up[i] + _add(p01, p11 + rest) - _add(p00, p10 + rest)
            s = (p00, p01 + up[i], p10 + rest, p11 + rest + up[i])
            top = max(s)
            x = [math.exp(v - top) for v in s]
            t = sum(x)
            pairs[i] = (x[0] / t, x[1] / t, x[2] / t, x[3] / t)
        return [_sigmoid(v) for v in full], pairs

    def beliefs(self, nodes: list[Node]) -> list[float]:
        return self.marginals(nodes)[0]


def _kind(n: Node) -> str:
    if n.tag in ("article", "main", "nav", "aside", "footer", "header", "form", "section", "div", "ul", "ol", "p"):
        return n.tag
    return "other"


def _add(a: float, b: float) -> float:
    m = a if a > b else b
    return m + math.log1p(math.exp(-abs(a - b)))


def _sigmoid(v: float) -> float:
    return 1 / (1 + math.exp(-v)) if v > -700 else 0.0


def train(pages: list[Page], rounds: int = 40, rate: float = 0.5, decay: float = 1e-3) -> Model:
    """Fit both kinds of potentials on pages whose nodes carry ``gold``
    (AdaGrad over whole passes)."""
    for p in pages:
        _features(p)
    node: dict[str, float] = {}
    edge: dict[tuple[str, int, int], float] = {}
    seen: dict = {}
    for _ in range(rounds):
        grad: dict = {}
        model = Model(node, edge)
        for p in pages:
            beliefs, pairs = model.marginals(p.nodes)
            for i, n in enumerate(p.nodes):
                d = n.gold - beliefs[i]
                for f in n.features:
                    grad[f] = grad.get(f, 0.0) + d
                if i:
                    k = _kind(n)
                    gold = 2 * p.nodes[n.parent].gold + n.gold
                    for at, prob in enumerate(pairs[i]):
                        key = (k, at >> 1, at & 1)
                        grad[key] = grad.get(key, 0.0) + (at == gold) - prob
        for key, g in grad.items():
            table = node if isinstance(key, str) else edge
            g = g / len(pages) - decay * table.get(key, 0.0)
            seen[key] = seen.get(key, 1e-8) + g * g
            table[key] = table.get(key, 0.0) + rate * g / math.sqrt(seen[key])
    return Model(node, edge)


def main_text(html: str | None, model: Model) -> str:
    """Content blocks in page order, joined by newlines; white space inside a
    block is one blank."""
    if not html:
        return ""
    page = parse(html)
    _features(page)
    keep = [b >= 0.5 for b in model.beliefs(page.nodes)]
    blocks: list[str] = []
    last, run = None, []
    for at, block, text in [*page.chunks, (0, None, "")]:
        if (at, block) != last:
            joined = _SPACE.sub(" ", "".join(run)).strip()
            if joined and keep[last[0]]:
                blocks.append(joined)
            last, run = (at, block), []
        run.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``pages`` with the column ``text`` in place of ``html_col``.

    A null or empty html, and a page without content blocks, gives the empty
    text.  Every page is read whole.  Other columns are carried; an input
    column ``text`` is replaced.  An empty table gives no row.
    """
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in pages.columns if c.lower() not in ("text", html_col.lower())]
    slim = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, shared.value) for h in b.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], names=b.schema.names)

    return slim.mapInArrow(run, T.StructType([*slim.schema.fields[:-1], T.StructField("text", T.StringType())]))
