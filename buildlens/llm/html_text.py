"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded so that the choices fit the tree.

Every block element is scored by trees over its subtree's text and link density, the words of its tag, class, id and
role, its depth and its siblings. Decoding picks the likeliest set of kept nodes in which the parent of a kept node is
kept. The trees are fitted on layouts in the markup conventions of the web, filled with the texts of sampled pages: so
every node's answer is known, and no label is needed.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens.llm.common import slices

# fixed values: elements of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page, and those whose content is not markup.
DROPPED = set(
    "head script style noscript template textarea select button iframe object svg math canvas audio video datalist".split()
)
RAW = set("script style textarea title iframe noscript".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: An element that ends when one of the same list begins in the same parent.
SIBLING_ENDS = {
    **dict.fromkeys(["li"], {"li"}),
    **dict.fromkeys(["dt", "dd"], {"dt", "dd"}),
    **dict.fromkeys(["td", "th"], {"td", "th"}),
    **dict.fromkeys(["tr"], {"tr", "td", "th"}),
    **dict.fromkeys(["tbody", "thead", "tfoot"], {"tbody", "thead", "tfoot", "tr", "td", "th"}),
}
#: Elements that the implied end of a list item or cell does not cross.
SCOPES = set("table ul ol dl menu html body".split())
# fixed values: words of tags, classes, ids and roles
AGAINST = set(
    "ad ads advert advertisement advertising adsense alert aside banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies copyright dialog discussion disqus footer form gdpr header legal "
    "login masthead menu modal nav navbar navigation newsletter notice notification pagination pager popup promo promoted "
    "promotion rail recommended related replies reply respond search share sharing sidebar signup skyscraper social sponsor "
    "sponsored subscribe tags toolbar topbar widget".split()
)
FOR = set("article articlebody blog content entry main post prose story text".split())
# end of fixed values

_TAG = re.compile(
    r"<(?:!--(?:.*?-->|.*)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>"
    r"|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>)",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOPS = re.compile(r"[.,;:!?]")


@dataclass
class Page:
    """Block elements in page order, the first the page itself, and the blocks of text in them."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    words: list[list[str]] = field(default_factory=lambda: [[]])
    inputs: list[int] = field(default_factory=lambda: [0])
    links: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The tree of block elements. Elements that are not closed end where HTML says or with their parent."""
    page = Page()
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements: tag, node of the nearest block
    pieces: list[str] = []
    at, end, linked = 0, len(source), 0

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                page.blocks.append((stack[-1][1], text))

    while at < end:
        m = _TAG.search(source, at)
        text = source[at : m.start()] if m else source[at:]
        if text:
            pieces.append(text)
            if linked and not text.isspace():
                page.links[stack[-1][1]] += len(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name == "br":
                pieces.append(" ")
                continue
            depth = len(stack) - 1
            while depth > 0 and stack[depth][0] != name:
                if name not in BLOCK and stack[depth][0] in BLOCK:
                    depth = 0
                    break
                depth -= 1
            if depth > 0:
                if name in BLOCK:
                    flush()
                linked -= sum(tag == "a" for tag, _ in stack[depth:])
                del stack[depth:]
            continue
        if name in DROPPED or name == "title":
            if name == "input":
                continue
            at = _skipped(source, at, name, m[0].endswith("/>"))
            pieces.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                pieces.append(" ")
            elif name == "input":
                page.inputs[stack[-1][1]] += 1
            continue
        if name in ("html", "body"):
            if name == "body" and len(page.tag) == 1:
                page.words[0] = _words("", m[3] or m[6] or "")
            continue
        if name in BLOCK:
            flush()
            depth = len(stack) - 1
            ends = SIBLING_ENDS.get(name, set())
            for k in range(depth, 0, -1):
                tag = stack[k][0]
                if tag == "p" or tag in ends:
                    linked -= sum(x == "a" for x, _ in stack[k:])
                    del stack[k:]
                elif tag in BLOCK and (not ends or tag in SCOPES):
                    break
            page.parent.append(stack[-1][1])
            page.tag.append(name)
            page.words.append(_words(name, m[3] or m[6] or ""))
            page.inputs.append(0)
            page.links.append(0)
            stack.append((name, len(page.tag) - 1))
        else:
            linked += name == "a"
            stack.append((name, stack[-1][1]))
    flush()
    return page


def _skipped(source: str, at: int, name: str, closed: bool) -> int:
    """Where a dropped element ends; a head that is not closed ends at the body."""
    if closed and name not in RAW:
        return at
    if name == "head":
        m = re.compile(r"</head\s*>|(?=<body[\s>])", re.IGNORECASE).search(source, at)
        return m.end() if m else at
    m = re.compile(f"</{name}\\s*>", re.IGNORECASE).search(source, at)
    return m.end() if m else (len(source) if name in RAW else at)


def _words(tag: str, attributes: str) -> list[str]:
    found = [tag] if tag else []
    if "=" in attributes:
        for m in _NAMED.finditer(attributes):
            found += _WORD.findall(m[1] or m[2] or m[3] or "")
    return [x.lower() for x in found]


FEATURES = 24


def features(page: Page) -> np.ndarray:
    """A row for each node."""
    n = len(page.tag)
    size, stops, count, own = [0] * n, [0] * n, [0] * n, [0] * n
    total = 0
    for node, text in page.blocks:
        own[node] += len(text)
        stops[node] += len(_STOPS.findall(text))
        count[node] += 1
        total += len(text)
    size[:] = own
    links, inputs, nodes = page.links[:], page.inputs[:], [1] * n
    paragraphs = [int(x == "p") for x in page.tag]
    against = [sum(x in AGAINST for x in w) for w in page.words]
    favour = [sum(x in FOR for x in w) for w in page.words]
    against_text, favour_text = [0] * n, [0] * n
    depth, above_against, above_favour, sign = [0] * n, [0] * n, [0] * n, [0] * n
    children: list[list[int]] = [[] for _ in range(n)]
    for v in range(1, n):
        up = page.parent[v]
        children[up].append(v)
        depth[v] = depth[up] + 1
        above_against[v] = above_against[up] + (against[up] > 0)
        above_favour[v] = above_favour[up] + (favour[up] > 0)
        sign[v] = (-1 if against[up] else 1) if against[up] or favour[up] else sign[up]
    for v in range(n - 1, 0, -1):
        up = page.parent[v]
        for x in (size, stops, count, links, inputs, nodes, paragraphs):
            x[up] += x[v]
        against_text[up] += size[v] if against[v] else against_text[v]
        favour_text[up] += size[v] if favour[v] else favour_text[v]
    place, around = [0] * n, [(0, 0, 1)] * n
    for own_children in children:
        for k, v in enumerate(own_children):
            place[v] = k
            left = size[own_children[k - 1]] if k else 0
            right = size[own_children[k + 1]] if k + 1 < len(own_children) else 0
            around[v] = (left, right, len(own_children))
    first_block = [0] * n
    for v in range(1, n):
        up, k = page.parent[v], place[v]
        first_block[v] = first_block[up] + own[up] * (k > 0)
        if k:
            sibling = children[up][k - 1]
            first_block[v] = first_block[sibling] + size[sibling]
    whole = max(total, 1)
    rows = []
    for v in range(n):
        up = max(page.parent[v], 0)
        tag, s = page.tag[v], max(size[v], 1)
        left, right, siblings = around[v]
        kind = 3 if tag == "p" else 2 if tag in HEADINGS else 1 if tag in ("li", "td", "th", "dt", "dd", "tr") else 0
        rows.append(
            (
                against[v], favour[v], above_against[v], above_favour[v], sign[v], depth[v], place[v], siblings,
                first_block[v] / whole, math.log1p(size[v]), links[v] / s, size[v] / nodes[v], paragraphs[v] / nodes[v],
                stops[v] / s, inputs[v], math.log1p(own[v]), kind, size[v] / whole, size[up] / whole, math.log1p(left),
                math.log1p(right), against_text[v] / s, favour_text[v] / s, size[v] / max(count[v], 1),
            )
        )
    return np.array(rows, float).reshape(n, FEATURES)


@dataclass
class Trees:
    """Boosted trees of one depth: cut feature, cut value by place in each tree, and the value of each leaf."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.3, bins: int = 32) -> Trees:
    """Newton boosting for the logistic loss, with cuts between quantiles."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins)[:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = math.log(share / (1 - share))
    score, inner = np.full(len(y), base), 2**depth - 1
    features_, cuts_, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            start, width = 2**level - 1, 2**level
            local = at - start
            best = np.full(width, 1e-6)
            for f in range(x.shape[1]):
                if len(cuts[f]) < 2:
                    continue
                cell = local * (bins + 1) + binned[:, f]
                g = np.bincount(cell, slope, width * (bins + 1)).reshape(width, -1).cumsum(1)
                h = np.bincount(cell, bend, width * (bins + 1)).reshape(width, -1).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain = gain[:, : len(cuts[f])]
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                better = value > best
                feature[start : start + width][better] = f
                cut[start : start + width][better] = cuts[f][top[better]]
                best = np.maximum(best, value)
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        local = at - inner
        leaf = rate * np.bincount(local, slope, inner + 1) / (np.bincount(local, bend, inner + 1) + 1)
        score += leaf[local]
        features_.append(feature)
        cuts_.append(cut)
        leaves.append(leaf)
    return Trees(np.array(features_), np.array(cuts_), np.array(leaves), base)


def decode(parent: list[int], odds: np.ndarray) -> list[bool]:
    """The likeliest choice of nodes in which every kept node's parent is kept, by one pass up and one down.

    Keeping a node gains its log-odds and what its children can gain; a subtree that gains nothing is left out.
    """
    gain = odds.tolist()
    for v in range(len(parent) - 1, 0, -1):
        if gain[v] > 0:
            gain[parent[v]] += gain[v]
    kept = [True] * len(parent)
    for v in range(1, len(parent)):
        kept[v] = kept[parent[v]] and gain[v] > 0
    return kept


def main_text(page: Page, odds: np.ndarray) -> str:
    kept = decode(page.parent, odds)
    return "\n".join(text for node, text in page.blocks if kept[node])


#: Pages that give the layouts their texts (expected number; chosen by hash), and layouts that the trees are fitted on.
SAMPLE, LAYOUTS = 300, 600


def layout(rng: random.Random, prose: list[str], scraps: list[str]) -> str:
    """A page in a random layout; the letter M stands before every block of its main text."""
    esc = html.escape

    def scrap() -> str:
        return esc(rng.choice(scraps)[: rng.choice([20, 60, 200])])

    def attributes(names: list[str]) -> str:
        name = rng.choice(names) + rng.choice(["", "", "-1", " wide", "-box", " block"])
        return rng.choice([f' class="{name}"', f' id="{name}"', f' class="x {name}"', f' role="{name}"'])

    def listed(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{scrap()[:18]}</a></li>' for k in range(n)) + "</ul>"

    def box(tags: list[str], names: list[str], inner: str) -> str:
        tag = rng.choice([*tags, "div", "section"])
        return f"<{tag}{attributes(names) if tag in ('div', 'section') or rng.random() < 0.5 else ''}>{inner}</{tag}>"

    def para(text: str) -> str:
        return f"<p>{text}</p>"

    def menu() -> str:
        return box(["nav"], ["nav", "menu", "navbar", "navigation", "breadcrumb"], listed(rng.randint(2, 9)))

    def head() -> str:
        inner = f"<h1>{scrap()}</h1>" + rng.choice(["", para(scrap())])
        return box(["header"], ["header", "masthead", "topbar", "banner"], inner)

    def foot() -> str:
        return box(["footer"], ["footer", "copyright", "legal", "contentinfo"], rng.choice(["&copy; ", ""]) + scrap())

    def side() -> str:
        inner = f"<h3>{scrap()}</h3>" + rng.choice([listed(4), para(scrap()) * 2])
        return box(["aside"], ["sidebar", "aside", "widget", "related", "complementary"], inner)

    def note() -> str:
        inner = rng.choice([scrap(), para(scrap())]) + rng.choice(["", "<button>OK</button>"])
        return box(["dialog"], ["cookie-notice", "notice", "consent", "alert", "popup"], inner)

    def ad() -> str:
        inner = rng.choice([scrap(), para(scrap()), para(esc(rng.choice(prose)))])
        return box(["div"], ["ad", "ads", "advert", "sponsored", "promo"], inner)

    def form() -> str:
        inner = rng.choice([scrap(), para(scrap()), f"<label>{scrap()}</label>"])
        named = rng.choice(["", attributes(["search", "newsletter", "signup", "form"])])
        return f'<form{named}>{inner}<input name="q"><button>Go</button></form>'

    def talk() -> str:
        shapes = [para, lambda x: f'<div class="comment">{x}</div>', lambda x: f"<div>{para(x)}</div>"]
        inner = "".join(rng.choice(shapes)(esc(rng.choice(prose))) for _ in range(rng.randint(1, 5)))
        return box(["section"], ["comments", "comment-list", "discussion", "replies", "respond"], inner)

    def share() -> str:
        return box(["div"], ["share", "social", "toolbar", "related", "tags"], listed(3))

    shapes = [
        para,
        para,
        para,
        lambda x: f"<p><b>{x}<br>",
        lambda x: f"<h2>{x[:40]}</h2>",
        lambda x: f"<ul><li>{x}</li><li>{x[:30]}</li></ul>",
        lambda x: f"<blockquote>{x}</blockquote>",
    ]
    parts = [rng.choice(shapes)("M" + esc(rng.choice(prose))) for _ in range(rng.choice([1, 1, 2, 4, 8, 14]))]
    for _ in range(rng.choice([0, 0, 1, 2])):
        parts.insert(rng.randint(0, len(parts)), rng.choice([ad, share, form, note, side, talk])())
    if rng.random() < 0.2:
        parts.append(talk())
    title = rng.choice(["", f"<h1>M{scrap()[:60]}</h1>"])
    tag = rng.choice(["article", "main", "div", "div", "section"])
    if tag in ("article", "main") and rng.random() < 0.7:
        named = ""
    elif rng.random() < 0.75:
        named = attributes(["content", "post", "entry", "story", "article-body", "main"])
    else:
        named = rng.choice(["", ' class="x"'])
    main = f"<{tag}{named}>{title}{''.join(parts)}</{tag}>"
    if rng.random() < 0.3:
        main = f'<div class="{rng.choice(["wrap", "container", "row", "page"])}">{main}{rng.choice(["", side()])}</div>'
    above = [f() for f in (note, head, menu, ad, form) if rng.random() < 0.45]
    below = [f() for f in (share, talk, side, ad, form, note, foot) if rng.random() < 0.4]
    rng.shuffle(above)
    return "<html><head><title>t</title></head><body>" + "".join(above) + main + "".join(below) + "</body></html>"


def fit(sources: list[str], layouts: int = LAYOUTS) -> Trees:
    """Trees from layouts filled with the texts of some pages; the same for the same pages."""
    prose, scraps = [], []
    for source in sources:
        page = parse(source)
        inside = [False] * len(page.tag)
        for v in range(1, len(page.tag)):
            inside[v] = inside[page.parent[v]] or page.tag[v] in ("article", "main")
        for node, text in page.blocks:
            (prose if inside[node] or page.tag[node] == "p" else scraps).append(text.lstrip("M") or "text")
    prose, scraps = prose or ["Some words of text, and some more."], scraps or ["some words"]
    rng = random.Random(7)
    rows, labels = [], []
    for _ in range(layouts):
        page = parse(layout(rng, prose, scraps))
        keep = [False] * len(page.tag)
        for k, (node, text) in enumerate(page.blocks):
            keep[node] |= text.startswith("M")
            page.blocks[k] = (node, text.removeprefix("M"))
        for v in range(len(keep) - 1, 0, -1):
            keep[page.parent[v]] |= keep[v]
        rows.append(features(page))
        labels += keep
    return boost(np.concatenate(rows), np.array(labels, float))


def sampled(pages: DataFrame, source: str = "html", sample: int = SAMPLE) -> list[str]:
    """The sources of about ``sample`` pages, chosen by the hash of their source."""
    count = pages.filter(F.col(source).isNotNull()).count()
    draw = F.pmod(F.xxhash64(F.col(source), F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    chosen = pages.filter(F.col(source).isNotNull() & (draw < sample / max(count, 1))).select(F.col(source).alias("s"))
    return sorted(row["s"] for row in chosen.collect())


def text_of(source: Column, trees: Trees) -> Column:
    """The main text of a column of pages: its blocks in page order, joined by line breaks; empty for null.

    References are decoded, white space within a block becomes one space. Whole pages are read; nothing is cut.
    """

    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (part for batch in batches for part in slices(batch)):
            pages = [parse(x) for x in texts.to_pylist()]
            odds = trees.scores(np.concatenate([features(page) for page in pages]))
            ends = np.cumsum([len(page.tag) for page in pages])
            yield pa.array([main_text(page, odds[end - len(page.tag) : end]) for page, end in zip(pages, ends)], pa.string())

    extracted.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(extracted, "string")(source)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``; equal pages have equal texts."""
    trees = fit(sampled(pages))
    found = pages.select("page_id", "url", text_of(F.col("html"), trees).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
