"""Main text of web pages: boosted trees over DOM nodes, decoded as a tree.

A page is read into a tree of elements.  Each element has features of its
subtree (text, tags, links, density), its place (depth, siblings), its tag and
the words of its attributes; gradient-boosted trees give the probability that
it is main text.  Decoding takes one consistent choice for the whole tree: an
element is all main, all boilerplate, or mixed, and only below a mixed element
may its children choose for themselves.

The trees are fitted on the elements of a sample of at most ``SAMPLE`` pages,
taken by a hash of the page's id, and of pages assembled from their text in
other layouts; the layout says what is main and what is not.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import arrow_batch

#: Pages whose elements are the labelled rows.
SAMPLE = 120
#: Pages of this many characters and more stay out of the sample (not of the result).
LONGEST = 200_000
#: Stories that the assembled pages are made from, at least.
STORIES = 24
#: Assembled pages for each of the variants, at least.
LAYOUTS = 120
TREES, DEPTH, BINS, RATE = 30, 3, 16, 0.25
#: Log-probability of an element being mixed, against main or boilerplate.
MIXED = -1.5

# Fixed values of HTML: elements without end tag, without shown text, and blocks.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head script style template noscript title iframe textarea select".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup"
    " html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul option button legend".split())
#: A start tag of the first closes an open element of the second.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol table dl body html article section div td select".split())

#: Elements around the whole page.
PAGE = frozenset("#page html body".split())

TAGS = ("p", "h", "li", "a", "article main", "nav menu", "header", "footer", "aside", "form fieldset label button legend input",
        "div section td", "ul ol dl", "b i em strong span u small", "blockquote pre", "table tbody tr th", "figure figcaption")
TOKENS = (
    "nav menu navbar breadcrumb breadcrumbs pagination pager toc topbar",
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "comment comments reply replies respond disqus discussion reader",
    "form login signup subscribe newsletter search register",
    "cookie cookies consent notice notices popup modal alert gdpr message warning",
    "footer header masthead copyright legal bottom top foot head",
    "sidebar side aside widget related recommended share social tags author meta trending",
    "article content main post entry story body text maincontent",
)
#: Token groups and tags that are not main text within ``article`` or ``main`` either.
ASIDE_GROUPS = sum(1 << i for i in range(5))
ASIDE_TAGS = frozenset("nav form aside footer".split())
TAG_GROUP = {t: i for i, g in enumerate(TAGS) for t in g.split()} | {f"h{n}": 1 for n in range(1, 7)}
TOKEN_GROUP = {t: i for i, g in enumerate(TOKENS) for t in g.split()}
N_FEATURES = 18 + len(TAGS) + 2 * len(TOKENS) + len(TAGS)


class Tree(HTMLParser):
    """Elements in page order: parent, tag, attribute groups; texts with the
    element that owns them and the number of the block they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.groups = [-1], ["#page"], [0]
        self.texts: list[tuple[int, int, str]] = []
        self.open, self.block, self.hidden = [0], 0, 0
        self.opened: dict[str, int] = {}                # open elements by tag

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A declaration of an unknown kind is a comment."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def _close(self, at: int) -> None:
        for n in self.open[at:]:
            self.opened[self.tag[n]] -= 1
            self.hidden -= self.tag[n] in HIDDEN
            self.block += self.tag[n] in BLOCK
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.block += 1
            wanted = CLOSES.get(tag, ())
            for at in range(len(self.open) - 1, 0, -1):
                name = self.tag[self.open[at]]
                if name == "p" or name in wanted:
                    self._close(at)
                    if name != "p" or not wanted:
                        break
                elif name in SCOPE:
                    break
        groups = 0
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                for token in re.split(r"[^a-z]+", value.lower()):
                    if token in TOKEN_GROUP:
                        groups |= 1 << TOKEN_GROUP[token]
        n = len(self.tag)
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.groups.append(groups)
        if tag == "br":
            self.texts.append((self.open[-1], self.block, " "))
        if tag not in VOID:
            self.open.append(n)
            self.opened[tag] = self.opened.get(tag, 0) + 1
            self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if not self.opened.get(tag):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[at]] == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.texts.append((self.open[-1], self.block, data))


#: A tag that the input ends in.
DANGLING = re.compile(r"</?[A-Za-z]")


def parse(html: str) -> Tree:
    """The tree of a page; a tag that the input ends in is no text and no element."""
    tree = Tree()
    end = DANGLING.search(html, html.rfind(">") + 1)
    tree.feed(html[:end.start()] if end else html)
    tree.close()
    return tree


def node_features(tree: Tree) -> np.ndarray:
    """One row per element: subtree, place, tag and attribute features."""
    n = len(tree.tag)
    parent = tree.parent
    chars, links, paras, marks, blocks = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    own_chars = [0] * n
    for who, _, text in tree.texts:
        size = len(text) - text.count(" ") if not text.isspace() else 0
        if size:
            own_chars[who] += size
            chars[who] += size
            blocks[who] += 1
            marks[who] += text.count(",") + text.count(".") + text.count(";")
    depth, children, index, same = [0] * n, [0] * n, [0] * n, {}
    above, above_tags = [0] * n, [0] * n
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        index[i] = children[p]
        children[p] += 1
        same[p, tree.tag[i]] = same.get((p, tree.tag[i]), 0) + 1
        above[i] = above[p] | tree.groups[i]
        above_tags[i] = above_tags[p] | (1 << TAG_GROUP[tree.tag[i]] if tree.tag[i] in TAG_GROUP else 0)
    tags = [1] * n
    for i in range(n - 1, 0, -1):
        p = parent[i]
        if tree.tag[i] == "a":
            links[i] = chars[i]
        if tree.tag[i] in ("p", "blockquote", "pre"):
            paras[i] = chars[i]
        for own in (chars, links, paras, marks, blocks, tags):
            own[p] += own[i]
    out = np.zeros((n, N_FEATURES), np.float32)
    total = max(1, chars[0])
    rows = [(depth[i], children[parent[i]] if i else 0, index[i], index[i] / max(1, children[parent[i]] - 1) if i else 0.0, children[i],
             chars[i], chars[i] / total, chars[i] / max(1, chars[parent[i]]) if i else 1.0, tags[i], chars[i] / tags[i], links[i] / max(1, chars[i]),
             paras[i] / max(1, chars[i]), marks[i] / max(1, chars[i]), blocks[i], chars[i] / max(1, blocks[i]), own_chars[i] / max(1, chars[i]),
             same.get((parent[i], tree.tag[i]), 1), len(tree.tag[i])) for i in range(n)]
    out[:, :18] = rows
    at = 18
    for i in range(n):
        g = TAG_GROUP.get(tree.tag[i])
        if g is not None:
            out[i, at + g] = 1.0
    at += len(TAGS)
    for bits, width in ((tree.groups, len(TOKENS)), (above, len(TOKENS)), (above_tags, len(TAGS))):
        out[:, at:at + width] = (np.array(bits)[:, None] >> np.arange(width)) & 1
        at += width
    return out


@dataclass
class Boosted:
    """Complete trees of ``DEPTH`` levels: feature and limit per inner node,
    value per leaf."""

    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += value[node - (2 ** DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    """Newton boosting of logistic loss over binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    share = np.average(y, weights=weight).clip(1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))))
    raw = np.full(len(y), model.start)
    inner = 2 ** DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, limit, cut = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32), np.full(inner, BINS + 1)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for j in range(x.shape[1]):
                if not len(edges[j]):
                    continue
                key = (node - first) * (BINS + 1) + binned[:, j]
                gs = np.bincount(key, g, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                hs = np.bincount(key, h, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                gain = gain[:, :len(edges[j])]
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[first + k], cut[first + k], limit[first + k] = top[k], j, at[k], edges[j][at[k]]
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        model.trees.append((feature, limit, value))
        raw += value[leaf]
    return model


def decode(tree: Tree, raw: np.ndarray) -> list[bool]:
    """For every element whether its own text is main.

    Best sum of log-probabilities over the tree, where an element below a
    main (boilerplate) one is main (boilerplate) too.  The page's own elements
    are always mixed."""
    n = len(raw)
    main = (-np.logaddexp(0, -raw)).tolist()
    other = (-np.logaddexp(0, raw)).tolist()
    all_main, all_other, best_below = main[:], other[:], [0.0] * n
    choice = [0] * n
    for i in range(n - 1, -1, -1):
        mixed = MIXED + best_below[i]
        if tree.tag[i] in PAGE:
            top = best_below[i]
        else:
            top = max(all_main[i], all_other[i], mixed)
            choice[i] = 1 if top == all_main[i] else 2 if top == all_other[i] else 0
        if i:
            p = tree.parent[i]
            all_main[p] += all_main[i]
            all_other[p] += all_other[i]
            best_below[p] += top
    for i in range(1, n):
        if choice[tree.parent[i]]:
            choice[i] = choice[tree.parent[i]]
    return [c == 1 or (c == 0 and r > 0) for c, r in zip(choice, raw.tolist(), strict=True)]


def render(tree: Tree, keep: list[bool]) -> str:
    """The kept texts, a line per block."""
    blocks: dict[int, list[str]] = {}
    for who, block, text in tree.texts:
        if keep[who]:
            blocks.setdefault(block, []).append(text)
    return "\n".join(line for b in blocks.values() if (line := " ".join("".join(b).split())))


# Layouts of the training pages ------------------------------------------------

FILLER = ["Home", "About us", "Contact", "Read more", "Terms of use", "Privacy", "Sign in", "Next page", "All rights reserved", "Follow us", "Latest news"]

#: What stories are made from where the sample has too few.
SENTENCES = [
    "The river rose during the night and covered the lower road.", "Nobody had expected so much rain in a single week.",
    "By noon the water had reached the first houses of the village.", "Volunteers carried sand and boards to the bridge.",
    "A new study follows four hundred households over ten years.", "Its authors compare what people planned with what they did.",
    "Most savings were made in the first winter, and few after that.", "Prices fell again in March, though less than a year before.",
    "The old theatre will open its doors in autumn.", "Its roof has been repaired and the seats are new.", "Tickets are cheap.",
    "Bake the bread for forty minutes, then let it cool on a rack.", "It keeps for three days.", "Use a heavy pan with a lid, because the steam must stay inside while the crust forms.",
    "The team played well in the second half but could not score.", "Their coach spoke of bad luck and a good goalkeeper.",
    "Engineers found the fault in a small valve, which had been fitted the wrong way round.", "The train was two hours late.",
    "In the archive there are letters from sailors, bills of merchants and a map of the harbour drawn by hand in 1782.",
    "What the council decides next month will matter for schools, buses and the two libraries in the north of the town.",
    "Was it worth the effort?", "Yes, she says, and laughs.", "Birds return to the island every spring, and each year a few more pairs stay to breed.",
    "The software reads the measurements once a minute, stores them and sends a short report at the end of the day.",
]


def _story(rng: random.Random) -> list[str]:
    """Lines of one to seven sentences, the first a title."""
    return [rng.choice(SENTENCES)[:60], *(" ".join(rng.choices(SENTENCES, k=rng.randint(1, 7))) for _ in range(rng.randint(1, 12)))]


def _block(text: str, shape: str) -> str:
    """A paragraph of main text in one of the shapes that pages give it."""
    words = text.split()
    half = len(words) // 2
    one, two = " ".join(words[:half]), " ".join(words[half:])
    return {
        "p": f"<p data-main>{text}</p>",
        "open": f"<p data-main><b data-main>{text}<br>",
        "div": f"<div data-main>{text}</div>",
        "list": f"<ul data-main><li data-main>{one}</li><li data-main>{two}</li></ul>",
        "items": f"<ul data-main><li data-main>{text}</li></ul>",
        "quote": f"<blockquote data-main><p data-main>{text}</p></blockquote>",
        "pre": f"<pre data-main>{text}</pre>",
        "terms": f"<dl data-main><dt data-main>{' '.join(words[:2])}</dt><dd data-main>{' '.join(words[2:])}</dd></dl>",
        "figure": f"<figure data-main><img src='x'><figcaption data-main>{' '.join(words[:20])}</figcaption></figure>",
        "link": f"<p data-main><a href='/x' data-main>{' '.join(words[:20])}</a></p>",
        "table": "<table data-main>" + "".join(
            f"<tr data-main><{cell} data-main>{w}</{cell}><{cell} data-main>{v}</{cell}></tr>"
            for cell, w, v in zip(("th", "td", "td", "td"), words[:4], words[4:8], strict=False)) + "</table>",
    }[shape]


#: Shapes of single paragraphs among others, and shapes that a whole story may have.
AMONG = ("open", "div", "items", "list", "quote", "pre", "terms", "figure", "link", "table")
WHOLE = ("p", "p", "p", "p", "p", "div", "items", "text")
#: Elements around a story; an empty tag is none at all.
AROUND = (("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("section", "story"), ("div", "entry text"),
          ("div", ""), ("div", ""), ("section", ""), ("", ""), ("", ""))
OUTER = ("", "", "wrapper", "container", "page", "row", "col")


def _body(paragraphs: list[str], marked: bool, rng: random.Random) -> list[str]:
    """The blocks of a story, in sections or not; ``marked`` if the element
    around them is all main text, so that it may hold text of its own."""
    shape = rng.choice(WHOLE)
    if shape == "text":
        joined = "<br><br>".join(paragraphs)
        blocks = [joined if marked else f"<div data-main>{joined}</div>"]
    else:
        blocks = [_block(p, rng.choice(AMONG) if rng.random() < 0.25 else shape) for p in paragraphs]
    title = paragraphs[0][:60]
    level = rng.choice("11123")
    head = f"<h{level} data-main>{title}</h{level}>"
    if rng.random() < 0.15:
        head = f"<header data-main>{head}</header>"
    if rng.random() < 0.3:
        tag, parts = rng.choice(("section", "div")), []
        while blocks:
            size = rng.randint(1, 4)
            sub = f"<h2 data-main>{' '.join(rng.choice(paragraphs).split()[:rng.randint(1, 4)])}</h2>" if rng.random() < 0.6 else ""
            parts.append(f"<{tag} data-main>{sub}{''.join(blocks[:size])}</{tag}>")
            blocks = blocks[size:]
        blocks = parts
    return [head, *blocks]


def _layouts(paragraphs: list[str], other: list[str], rng: random.Random) -> str:
    """A page around these paragraphs; elements of main text are marked by
    the attribute ``data-main``."""
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    some = lambda k: [rng.choice(other) if rng.random() < 0.5 else rng.choice(FILLER) for _ in range(rng.randint(1, k))]
    links = lambda k: "".join(f"<li><a href='/x'>{esc(w[:30])}</a></li>" for w in some(k))
    box = lambda tag, cls, body: f"<{tag} class='{cls}'>{body}</{tag}>" if cls else f"<{tag}>{body}</{tag}>"
    texts = lambda k: "".join(f"<p>{esc(t)}</p>" for t in some(k))
    menu = lambda: rng.choice([f"<nav><ul>{links(8)}</ul></nav>", box("div", rng.choice(["menu", "navbar", "nav top"]), f"<ul>{links(8)}</ul>"), f"<header>{box('div', 'logo', esc(rng.choice(FILLER)))}<ul>{links(6)}</ul></header>", box("header", "", f"<h1>{esc(rng.choice(FILLER))}</h1><p>{esc(rng.choice(other)[:60])}</p>")])
    advert = lambda: box(rng.choice(["div", "section", "aside"]), rng.choice(["ad", "advert", "banner", "promo", "sponsored ad-box"]), rng.choice([esc(rng.choice(other)), texts(2)]))
    side = lambda: rng.choice([f"<aside>{texts(3)}<ul>{links(5)}</ul></aside>", box("div", rng.choice(["sidebar", "related", "widget", "share social"]), f"<h3>{esc(rng.choice(FILLER))}</h3><ul>{links(6)}</ul>{texts(2)}")])
    notice = lambda: box(rng.choice(["div", "section"]), rng.choice(["cookie", "notice", "consent popup", "alert"]), f"<p>{esc(rng.choice(other))}</p><button>OK</button>")
    form = lambda: f"<form class='{rng.choice(['', 'search', 'newsletter', 'login'])}'><label>{esc(rng.choice(FILLER))}</label><input><p>{esc(rng.choice(other)[:80])}</p><button>Send</button></form>"
    said = lambda: box(rng.choice(["div", "section", "ol", "ul"]), rng.choice(["comments", "comment-list", "reader-comments", "replies"]), "".join(rng.choice(["<div class='comment'><b>{0}</b><p>{1}</p></div>", "<li><p>{1}</p></li>", "<article class='comment'><p>{1}</p></article>"]).format(esc(rng.choice(FILLER)), esc(rng.choice(other))) for _ in range(rng.randint(1, 4))))
    foot = lambda: rng.choice([f"<footer>&copy; {esc(rng.choice(FILLER))} &middot; {esc(rng.choice(other))}</footer>", box("div", rng.choice(["footer", "bottom legal"]), texts(2) + f"<ul>{links(4)}</ul>")])
    paragraphs = [esc(p) for p in paragraphs]
    tag, cls = rng.choice(AROUND)
    within = [f() for f in (advert, side, form, notice, said) if rng.random() < 0.12]
    body = _body(paragraphs, bool(tag) and not within, rng)
    for extra in within:
        body.insert(rng.randint(1, len(body)), extra)
    main = "".join(body)
    if tag:
        main = f"<{tag} class='{cls}'{'' if within else ' data-main'}>{main}</{tag}>"
    if tag == "article" and rng.random() < 0.3:
        main = f"<main>{main}</main>"
    before = [f() for f in (menu, advert, notice, side, form) if rng.random() < 0.5]
    after = [f() for f in (side, said, advert, form, notice) if rng.random() < 0.4]
    rng.shuffle(before)
    after.append(foot() if rng.random() < 0.8 else "")
    kind = rng.random()
    if kind < 0.07:
        page = f"<table><tr><td>{''.join(before)}</td><td>{main}</td><td>{''.join(after)}</td></tr></table>"
    else:
        for _ in range(rng.choice((0, 0, 0, 1, 2)) if tag else 0):
            main = box("div", rng.choice(OUTER), main)
        page = f"{''.join(before)}{main}{''.join(after)}"
        if kind < 0.2:
            page = box("div", rng.choice(OUTER), page)
    return f"<html><head><title>{paragraphs[0]}</title></head><body>{page}</body></html>"


class Marked(Tree):
    """A tree that also notes which elements are marked as main."""

    def __init__(self) -> None:
        super().__init__()
        self.marked = [False]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        super().handle_starttag(tag, attrs)
        self.marked.append(any(k == "data-main" for k, _ in attrs))


def _own_labels(html: str) -> tuple[Tree, np.ndarray]:
    """Labels of a real page by the meaning of its tags: inside ``article`` or
    ``main`` or not, and there not in comments, adverts, forms and the like;
    elements around both have none (-1), nor has any of a page without such tags."""
    tree = parse(html)
    n = len(tree.tag)
    label, aside = np.zeros(n), [False] * n
    for i in range(1, n):
        top, up = tree.tag[i] in ("article", "main"), tree.parent[i]
        groups = tree.groups[i]
        named = groups & ASIDE_GROUPS and not (top and groups & 1 << 7)
        aside[i] = aside[up] or bool(named and (top or label[up] == 1)) or (tree.tag[i] in ASIDE_TAGS and label[up] == 1)
        label[i] = not aside[i] and (top or label[up] == 1)
    if not label.any():
        return tree, np.full(n, -1.0)
    for i in range(n - 1, 0, -1):
        if label[i] != 1 and label[tree.parent[i]] == 1:
            label[tree.parent[i]] = -1
    return tree, _mixed(tree, label)


def _mixed(tree: Tree, label: np.ndarray) -> np.ndarray:
    for i in range(len(label) - 1, 0, -1):
        if label[i] != 0 and label[tree.parent[i]] == 0:
            label[tree.parent[i]] = -1
    return label


def training_rows(pages: list[str], seed: int = 11, variants: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the elements of these pages and of the layouts
    made from their text."""
    rng = random.Random(seed)
    xs, ys = [], []
    stories = []
    for html in pages:
        tree, label = _own_labels(html)
        xs.append(node_features(tree))
        ys.append(label)
        lines = [x for x in render(tree, [v == 1 for v in label]).split("\n") if x]
        if lines:
            stories.append(lines[:40])
    stories += [_story(rng) for _ in range(STORIES - len(stories))]
    other = [x[:200] for s in stories for x in s[:6]]
    for _ in range(variants):
        for story in stories * (-(-LAYOUTS // len(stories))):
            first, many = rng.randrange(len(story)), rng.choice((1, 2, 3, 6, 40))
            part = [p if rng.random() < 0.6 else p[:rng.randint(30, 200)] for p in story[first:first + many]]
            tree = Marked()
            tree.feed(_layouts(part, other, rng))
            tree.close()
            xs.append(node_features(tree))
            ys.append(_mixed(tree, np.array(tree.marked, float)))
    x, y = np.concatenate(xs), np.concatenate(ys)
    used = (y >= 0) & (x[:, 5] > 0)
    return x[used], y[used]


def train(pages: DataFrame, sample: int = SAMPLE) -> Boosted:
    # Only ids compete for the sample: a task sends at most ``sample`` of them.
    usable = pages.select("page_id", "html").filter(f"page_id IS NOT NULL AND length(html) < {LONGEST}")
    chosen = [r.page_id for r in usable.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect()]
    rows = usable.filter(F.col("page_id").isin(chosen)).orderBy(F.xxhash64("page_id"), F.xxhash64("html")).limit(sample).select("html").collect()
    x, y = training_rows([r.html for r in rows])
    return fit(x, y, np.ones(len(y)))


def main_text(html: str, model: Boosted) -> str:
    tree = parse(html)
    return render(tree, decode(tree, model.raw(node_features(tree))))


def extract(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """Per page ``page_id, url, text, n_chars``.

    A null or empty html gives an empty text, as does a page without main
    text.  Repeated rows stay repeated; a page is read whole; an empty table
    gives an empty result; other columns are left aside.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model or train(pages))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = pa.schema([b.schema.field("page_id"), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                trees = [parse(h) for h in part.column("html").to_pylist()]
                rows = [node_features(t) for t in trees]
                raw = sent.value.raw(np.concatenate(rows))
                ends = np.cumsum([len(r) for r in rows])
                texts = [render(t, decode(t, raw[e - len(r):e])) for t, r, e in zip(trees, rows, ends, strict=True)]
                yield arrow_batch(out, [part.column("page_id"), part.column("url"), texts, [len(t) for t in texts]])

    data = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return data.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
