"""Main text of web pages by gradient-boosted trees over DOM nodes.

Each block-level node gets features of its tag, attribute tokens, depth, siblings and of the text, links and tags below
it. Boosted trees, written here in numpy, give every node a log odds of being content. Decoding then picks the best
consistent choice on the tree: a dropped node drops all below it, and a node is kept only below kept ones, so that no
ancestor and descendant contradict each other.

There are no labelled pages. Training takes `SAMPLE_PAGES` pages, those with the smallest hash of their id, labels their
nodes by the meaning of HTML's own sectioning elements, and rebuilds each sampled page in other layouts (containers told
apart only by attribute tokens or by text and link density), where every node's label is known by construction.

Cases: null or empty html, or a page without main text, gives an empty text; unclosed and misnested tags are closed as a
browser would; repeated rows are treated alike; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 400
SAMPLE_CHARS = 200_000
LAYOUTS = 3
TREES = 40
DEPTH = 3
BINS = 32
RATE = 0.25
BATCH_NODES = 20_000

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr label".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul li dd dt".split()
)
LIST_ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|object)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|(?P<text>[^<]++|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
PART = re.compile(r"[a-z]+")
# Attribute tokens that tell boilerplate and content apart.
BAD = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion promoted banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs header masthead topbar footer foot bottom sidebar side aside rail widget widgets "
    "related recommended recommendations more trending popular comment comments reply replies respond disqus discussion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social follow form search copyright legal disclaimer contentinfo complementary pagination pager toolbar "
    "tags meta skip hidden outbrain taboola".split()
)
GOOD = frozenset("article articlebody content main post entry story body text maincontent page blog news prose read paragraph headline".split())


class Node:
    __slots__ = ("tag", "parent", "depth", "children", "bad", "good", "hidden", "runs", "order", "index", "links", "below")

    def __init__(self, tag: str, parent: Node | None, attrs: str, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.bad = self.good = self.links = self.below = 0
        self.hidden = 0
        self.runs: list[int] = []
        if attrs:
            for m in ATTRIBUTE.finditer(attrs):
                for part in PART.findall((m[1] or m[2] or m[3] or "").lower()):
                    self.bad += part in BAD
                    self.good += part in GOOD
            self.hidden = int(bool(HIDDEN.search(attrs)))
        if parent:
            parent.children.append(self)


@dataclass
class Page:
    """Block-level nodes in page order, and the text runs with the node that owns each."""

    nodes: list[Node] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    owners: list[Node] = field(default_factory=list)


def parse(source: str) -> Page:
    """A tolerant DOM: nodes of block-level elements, and the collapsed text between their boundaries."""
    page = Page()
    root = Node("#root", None, "", 0)
    page.nodes.append(root)
    stack: list[tuple[str, Node]] = [("#root", root)]  # open elements; an inline one keeps its block's node
    pieces: list[str] = []
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                owner = stack[-1][1]
                owner.runs.append(len(page.texts))
                page.texts.append(text)
                page.linked.append(linked)
                page.owners.append(owner)
            pieces.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal links
        if any(t not in INLINE for t, _ in stack[at:]):
            flush()
        links -= sum(t == "a" for t, _ in stack[at:])
        del stack[at:]

    for m in TOKEN.finditer(source):
        kind = m.lastgroup
        text = m["text"]
        if text is not None:
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            if links:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None or kind == "raw":
            continue
        tag = tag.lower()
        if m["end"]:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
                # An inline end tag does not close the blocks around it.
                if tag in INLINE and stack[at][0] not in INLINE:
                    break
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in CLOSES_P:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == "p":
                    close(at)
                    break
                if stack[at][0] not in INLINE:
                    break
        if tag in SAME:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in SAME[tag]:
                    close(at)
                    break
                if stack[at][0] in LIST_ITEMS[tag]:
                    break
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            links += tag == "a"
            stack[-1][1].below += 1
            stack.append((tag, stack[-1][1]))
            continue
        flush()
        node = Node(tag, stack[-1][1], m["attrs"], len(page.nodes))
        page.nodes.append(node)
        if not (m["attrs"] or "").rstrip().endswith("/"):
            stack.append((tag, node))
    flush()
    return page


TAGS = (
    ("article", "main"), ("nav", "menu"), ("footer",), ("header",), ("aside",),
    ("form", "button", "select", "option", "fieldset", "input"), ("head",), ("p", "blockquote", "pre"),
    ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "li", "dl", "dt", "dd"), ("div", "section", "td", "th", "table", "tr"), ("body",),
)
GROUP = {tag: g for g, tags in enumerate(TAGS) for tag in tags}
N_UP = 7  # groups whose presence among the ancestors is a feature
FEATURES = len(TAGS) + N_UP + 17


def features(page: Page) -> np.ndarray:
    """A row per node."""
    n = len(page.nodes)
    size, link, tags, blocks, marks = ([0] * n for _ in range(5))
    own = [0] * n
    for k, (text, linked, owner) in enumerate(zip(page.texts, page.linked, page.owners, strict=True)):
        i = owner.order
        own[i] += len(text)
        size[i] += len(text)
        link[i] += min(linked, len(text))
        blocks[i] += 1
        marks[i] += text.count(",") + text.count(".")
    for i in range(n - 1, 0, -1):
        up = page.nodes[i].parent.order
        tags[i] += 1 + page.nodes[i].below
        for total in (size, link, tags, blocks, marks):
            total[up] += total[i]
    whole = max(size[0], 1)
    out = np.zeros((n, FEATURES), np.float32)
    above: list[tuple[tuple[int, ...], int, int, int]] = [((0,) * N_UP, 0, 0, 0)] * n
    kin: dict[int, Counter[str]] = {}  # tags of a node's children, counted once
    seen = 0
    for i, node in enumerate(page.nodes):
        groups, bad, good, hidden = above[node.parent.order] if node.parent else ((0,) * N_UP, 0, 0, 0)
        g = GROUP.get(node.tag, -1)
        row = [0.0] * len(TAGS)
        if g >= 0:
            row[g] = 1.0
        siblings = node.parent.children if node.parent else [node]
        up = node.parent.order if node.parent else -1
        if up not in kin:
            kin[up] = Counter(s.tag for s in siblings)
        alike = kin[up][node.tag]
        node.index = 0 if not node.parent else getattr(node.parent, "index", 0)
        row += groups
        row += [
            node.bad, node.good, bad, good, node.hidden + hidden, node.depth, len(siblings), alike / len(siblings),
            math.log1p(size[i]), math.log1p(own[i]), link[i] / max(size[i], 1), tags[i] / max(size[i], 1) * 100,
            marks[i] / max(size[i], 1) * 100, size[i] / max(blocks[i], 1), size[i] / whole, seen / whole, len(node.children),
        ]
        out[i] = row
        above[i] = (
            tuple(1 if k == g else v for k, v in enumerate(groups)) if 0 <= g < N_UP else groups,
            bad + node.bad, good + node.good, hidden + node.hidden,
        )
        seen += own[i]
    return out


@dataclass
class Trees:
    """Boosted regression trees of fixed depth, as arrays: node k of a tree has the children 2k+1 and 2k+2."""

    cuts: list[np.ndarray]
    feature: np.ndarray  # TREES x inner nodes
    bin: np.ndarray
    value: np.ndarray  # TREES x leaves
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], 1).astype(np.uint8)

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.bin, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            out += value[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Trees:
    """Logistic loss, second-order gains on histograms."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    model = Trees(cuts, np.zeros((trees, 2**DEPTH - 1), np.int64), np.full((trees, 2**DEPTH - 1), BINS, np.int64), np.zeros((trees, 2**DEPTH)), math.log(share / (1 - share)))
    b = model.bins(x).astype(np.int64)
    n, width = x.shape
    flat = b + np.arange(width) * BINS
    margin = np.full(n, model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                own = np.flatnonzero(at == node)
                left, right = 2 * node + 1, 2 * node + 2
                at[own] = left
                if len(own) < 20:
                    continue
                where = flat[own].ravel()
                gs = np.bincount(where, np.repeat(g[own], width), width * BINS).reshape(width, BINS).cumsum(1)
                hs = np.bincount(where, np.repeat(h[own], width), width * BINS).reshape(width, BINS).cumsum(1)
                total_g, total_h = gs[0, -1], hs[0, -1]
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                f, cut = divmod(int(gain[:, :-1].argmax()), BINS - 1)
                model.feature[t, node], model.bin[t, node] = f, cut
                at[own] = np.where(b[own, f] > cut, right, left)
        leaf = at - (2**DEPTH - 1)
        value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        model.value[t] = value
        margin += value[leaf]
    return model


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The best consistent set of kept nodes: all below a dropped node is dropped, the root is kept."""
    n = len(page.nodes)
    # A node counts with its own text; one without text counts a little, so that containers follow what they hold.
    worth = [float(o) * (0.2 + math.log1p(sum(len(page.texts[r]) for r in node.runs))) for node, o in zip(page.nodes, odds, strict=True)]
    keep, drop = worth[:], [-w for w in worth]
    for i in range(n - 1, 0, -1):
        up = page.nodes[i].parent.order
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.nodes[i].parent.order] and keep[i] > drop[i]
    return kept


def main_text(page: Page, kept: list[bool]) -> str:
    return "\n\n".join(t for t, owner in zip(page.texts, page.owners, strict=True) if kept[owner.order] and owner.parent is not None)


def teacher(page: Page) -> np.ndarray:
    """Labels by HTML's own meaning: inside article or main and inside nothing that is set apart from it."""
    out = np.zeros(len(page.nodes))
    inside: list[tuple[bool, bool]] = []
    for i, node in enumerate(page.nodes):
        good, bad = inside[node.parent.order] if node.parent else (False, False)
        good = good or node.tag in ("article", "main")
        bad = bad or node.tag in ("nav", "footer", "aside", "form", "button", "head") or node.bad > 0 or node.hidden > 0
        inside.append((good, bad))
        out[i] = good and not bad
    below = out.copy()
    for i in range(len(page.nodes) - 1, 0, -1):
        below[page.nodes[i].parent.order] = max(below[page.nodes[i].parent.order], below[i])
    # What holds content is kept: the containers on the way to it.
    return np.where([n.tag in ("#root", "html", "body") or b for n, b in zip(page.nodes, below, strict=True)], 1.0, out)


def relaid(page: Page, labels: np.ndarray, rng: random.Random) -> tuple[str, list[str], list[str]]:
    """The page's own text in another layout: (html, content blocks, other blocks)."""
    good = [t for t, o in zip(page.texts, page.owners, strict=True) if labels[o.order] and o.parent is not None]
    bad = [t for t, o in zip(page.texts, page.owners, strict=True) if not labels[o.order]] or ["Home", "About us"]
    if not good:
        return "", [], bad
    esc = entities.escape
    one = lambda: esc(rng.choice(bad))
    words = esc(" ".join(rng.choice(good).split()[: rng.randint(4, 40)]))
    menu = lambda n: "<ul>" + "".join(f'<li><a href="/{k}">{esc(rng.choice(bad)[:20])}</a></li>' for k in range(n)) + "</ul>"
    body = "".join(f"<h{1 + (k > 0)}>{esc(t)}</h{1 + (k > 0)}>" if len(t) < 90 and k == 0 else rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}</b></p>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>"] if k > 1 and rng.random() < 0.2 else ["<p>{}</p>"]).format(esc(t)) for k, t in enumerate(good))
    wrap = rng.choice([
        "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main-content">{}</div>',
        '<section class="post-body">{}</section>', '<div class="entry"><article>{}</article></div>', "<div>{}</div>", '<main><article class="story">{}</article></main>',
    ])
    apart = [
        f"<nav>{menu(rng.randint(2, 9))}</nav>", f'<div class="menu">{menu(4)}</div>', f"<header><div>{one()}</div>{menu(3)}</header>",
        f'<div class="ad">{words}</div>', f'<div class="sponsored-box"><p>{words}</p></div>', f'<aside><h3>{one()}</h3>{menu(5)}<p>{words}</p></aside>',
        f'<div id="sidebar"><p>{words}</p>{menu(4)}</div>', f'<div class="cookie-notice"><p>{words}</p><button>{one()}</button></div>',
        f'<section class="comments"><h2>{one()}</h2><div class="comment"><p>{words}</p></div><div class="comment"><p>{words}</p></div></section>',
        f'<form action="/s"><label>{one()}</label><input><button>{one()}</button></form>', f'<div role="alert">{words}</div>',
        f"<footer>{words}</footer>", f'<div class="footer"><p>&copy; {one()}</p>{menu(3)}</div>', f'<div class="related">{menu(5)}</div>',
        f'<div id="newsletter"><p>{words}</p></div>', f'<div class="share"><a href="#">{one()}</a> <a href="#">{one()}</a></div>',
    ]
    rng.shuffle(apart)
    before, after = apart[: rng.randint(1, 4)], apart[4 : 4 + rng.randint(1, 4)]
    if rng.random() < 0.3:
        inner = apart[8]
        body += inner
    return "<html><head><title>x</title></head><body>" + "".join(before) + wrap.format(body).replace("<", "<", 1) + "".join(after) + "</body></html>", good, bad


def training_set(pages: list[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights (by text) of the sampled pages and their other layouts."""
    rng = random.Random(seed)
    xs, ys, ws = [], [], []

    def add(page: Page, labels: np.ndarray) -> None:
        xs.append(features(page))
        ys.append(labels)
        ws.append(np.array([0.2 + math.log1p(sum(len(page.texts[r]) for r in n.runs)) for n in page.nodes]))

    for source in pages:
        page = parse(source)
        labels = teacher(page)
        if not labels[[o.order for o in page.owners]].any():
            continue  # without sectioning elements there is nothing to learn from
        add(page, labels)
        for _ in range(LAYOUTS):
            other, good, _ = relaid(page, labels, rng)
            if not other:
                break
            laid = parse(other)
            wanted, k = set(), 0
            # The content blocks come in order and once each; all other runs are set apart.
            marked = [False] * len(laid.texts)
            for r, t in enumerate(laid.texts):
                if k < len(good) and t == good[k] and not _apart(laid.owners[r]):
                    marked[r], k = True, k + 1
            for r, hit in enumerate(marked):
                node = laid.owners[r] if hit else None
                while node is not None:
                    wanted.add(node.order)
                    node = node.parent
            add(laid, np.array([float(n.order in wanted or n.tag in ("#root", "html", "body")) for n in laid.nodes]))
    if not xs:
        return np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0)
    return np.concatenate(xs), np.concatenate(ys), np.concatenate(ws)


def _apart(node: Node | None) -> bool:
    while node is not None:
        if node.tag in ("nav", "footer", "aside", "form", "button", "header") or node.bad:
            return True
        node = node.parent
    return False


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Trees | None:
    """Fit on at most `sample_pages` pages of at most `SAMPLE_CHARS` characters."""
    rows = pages.select(F.col(id_col).alias("__id"), F.col(html_col).alias("__html")).where(F.length("__html").between(1, SAMPLE_CHARS))
    ids = rows.select("__id").orderBy(F.xxhash64("__id"), "__id").limit(sample_pages).collect()
    if not ids:
        return None
    wanted = sorted({r["__id"] for r in ids if r["__id"] is not None})
    sample = rows.where(F.col("__id").isin(wanted)).dropDuplicates(["__id"]).collect()
    x, y, w = training_set([r["__html"] for r in sorted(sample, key=lambda r: r["__id"])])
    return boost(x, y, w) if len(y) and 0 < y.sum() < len(y) else None


def _extractor(held):
    def done(sources: list[str | None]) -> list[str]:
        model = held.value
        pages = [parse(s or "") for s in sources]
        if model is None:
            return [main_text(p, [bool(k) for k in teacher(p)]) for p in pages]
        odds = model.predict(np.concatenate([features(p) for p in pages]))
        ends = np.cumsum([len(p.nodes) for p in pages])
        return [main_text(p, decode(p, odds[e - len(p.nodes) : e])) for p, e in zip(pages, ends, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = done(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], ["__id", "__url", "__text"]
                )

    return run


def extract(pages: DataFrame, model: Trees | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url and main text. The model has a fixed size. Without one the sectioning elements decide."""
    held = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(F.col(id_col).cast("long").alias("__id"), F.col(url_col).cast("string").alias("__url"), F.col(html_col).cast("string").alias("__html"))
    out = rows.mapInArrow(_extractor(held), "__id long, __url string, __text string")
    return out.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), F.col("__text").alias("text"))


def main_texts(pages: DataFrame) -> DataFrame:
    return extract(pages, train(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
