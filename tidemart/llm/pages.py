"""Main text of web pages: a tree-structured graphical model over the DOM, solved by sum-product message passing."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidemart.llm.arrow import map_batches
from tidemart.llm.labelled_pages import labelled_pages

# Fixed values of HTML: elements without an end, without shown text, those that hold formulas or what is shown in place
# of something else, those that make lines of their own, and those whose start ends an open paragraph, list item, term, cell, row or choice.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template iframe svg title select textarea button datalist".split())
FALLBACK = frozenset("noscript object math canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body html caption dd dt li tbody td tfoot th thead tr legend summary".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "p": ("td", "th", "li", "blockquote", "div", "section", "article", "aside")}

#: Words in class, id and role that speak against or for main text.
AGAINST = re.compile(
    r"(?:^|[^a-z])(?:ads?|adsby\w*|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|pag(?:er|ination)|header|masthead|topbar|footer|copyright|legal|"
    r"sidebar|side|widgets?|related|recommend\w*|trending|popular|cookies?|consent|gdpr|notices?|popup|modal|overlay|alert|paywall|newsletter|subscri\w*|sign-?up|"
    r"log-?in|search|form|shar(?:e|ing)|social|follow|comments?|commentlist|repl(?:y|ies)|discussion|responses?|disqus|complementary|contentinfo|navigation|dialog)(?:$|[^a-z])"
)
FOR = re.compile(r"(?:^|[^a-z])(?:article|content|post|entry|story|main|body|text|prose)(?:$|[^a-z])")
TAGS = "other html body div section article main aside nav header footer form p h1 h2 h3 ul ol li a b i em strong span code pre blockquote table tr td figure figcaption label".split()
TAG = {t: i for i, t in enumerate(TAGS)}
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote figure table".split())
PARAGRAPHS = frozenset("p blockquote pre li".split())
SIZES = (0, 4, 12, 60)  # words
DENSITIES = (0.0, 0.3, 0.7)  # words inside links, as a share


class Tree(HTMLParser):
    """Elements of a page in document order, and its texts with the element and line that each belongs to.

    ``labels`` says that the page is for training, with marks of what is main; in others such a mark may mean anything.
    """

    def __init__(self, labels: bool):
        super().__init__(convert_charrefs=True)
        self.labels = labels
        self.parent, self.depth, self.tag, self.hint, self.label = [], [], [], [], []
        self.texts: list[tuple[int, int, str]] = []
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag, in the stack
        self.blocks: list[int] = []  # of the open blocks
        self.line = self.hidden = 0
        self.open("html", {})

    def open(self, tag: str, attrs: dict) -> None:
        parent = self.stack[-1][1] if self.stack else -1
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''} {attrs.get('role') or ''}".lower().replace("_", "-")
        hint = (AGAINST.search(names) is not None) + 2 * (FOR.search(names) is not None) if names.strip() else 0
        self.stack.append((tag, len(self.parent)))
        if parent >= 0:
            self.places[tag].append(len(self.stack) - 1)
            if tag in BLOCK:
                self.blocks.append(len(self.stack) - 1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.hint.append(hint)
        mark = attrs.get("data-main") if self.labels else None
        self.label.append(int(mark) if mark else self.label[parent] if parent >= 0 else 0)
        if tag in HIDDEN:
            self.hidden += 1
        if tag in BLOCK:
            self.line += 1

    def close_to(self, at: int) -> None:
        while len(self.stack) > at:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            if tag in HIDDEN:
                self.hidden -= 1
            if tag in BLOCK:
                self.blocks.pop()
                self.line += 1

    def nearest(self, tags: tuple[str, ...], fence: tuple[str, ...]) -> int:
        at, stop = (max((self.places[t][-1] for t in some if self.places[t]), default=0) for some in (tags, fence))
        return at if at > stop else 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag == "body" and self.hidden:
            self.close_to(1)
        if tag in ENDS_P and (at := self.nearest(("p",), FENCE["p"])):
            self.close_to(at)
        if tag in SIBLINGS:
            while at := self.nearest(SIBLINGS[tag], FENCE.get(tag, ())):
                self.close_to(at)
        if tag in VOID:
            if tag in BLOCK:
                self.line += 1
            elif tag == "br":
                self.handle_data(" ")
            return
        self.open(tag, dict(attrs))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID:
            return
        if not self.places[tag]:
            return
        at = self.places[tag][-1]
        inline = tag not in BLOCK and tag not in HIDDEN and tag not in FALLBACK
        if not (inline and self.blocks and self.blocks[-1] > at):  # an inline end does not close a block
            self.close_to(at)

    def handle_data(self, data: str) -> None:
        if not self.hidden and data:
            self.texts.append((self.stack[-1][1], self.line, data))


def parse(html: bytes | None, labels: bool = True) -> Tree:
    tree = Tree(labels)
    tree.feed((html or b"").decode("utf-8", "replace"))
    tree.close()
    return tree


def features(trees: list[Tree]) -> dict[str, np.ndarray]:
    """Features of all elements of some pages, each a small number: parent, depth, tag, hint, size, link density, whether
    it is a block of text that stands right in the body under no name, and what it holds: none, one or more paragraphs of
    some length, and a title or not. ``block`` is how much these count: nothing for elements inside lines, and for blocks
    less the more of their tag stand side by side, which say much the same: n of them count as 1 + log n."""
    shift, out = 0, {k: [] for k in ("parent", "depth", "tag", "hint", "size", "density", "loose", "holds", "block", "label")}
    for tree in trees:
        n = len(tree.parent)
        words, linked = [0] * n, [0] * n
        for node, _, text in tree.texts:
            words[node] += len(text.split())
        for i in range(n - 1, -1, -1):
            if tree.tag[i] == "a":
                linked[i] = words[i]
            if i and tree.tag[i] not in BLOCK:  # a block speaks for itself, inline elements for their block too
                words[tree.parent[i]] += words[i]
                linked[tree.parent[i]] += linked[i]
        out["parent"] += [p + shift if p >= 0 else -1 for p in tree.parent]
        out["depth"] += tree.depth
        out["tag"] += [TAG.get(t, 0) for t in tree.tag]
        out["hint"] += tree.hint
        out["size"] += words
        out["density"] += [b / a if a else 0.0 for a, b in zip(words, linked)]
        out["loose"] += [int(not h and t in TEXT_BLOCKS and p >= 0 and tree.tag[p] == "body") for t, h, p in zip(tree.tag, tree.hint, tree.parent)]
        held, titled = [0] * n, [0] * n
        for p, t, h, w, d in zip(tree.parent, tree.tag, tree.hint, words, linked):
            if p >= 0 and t in PARAGRAPHS and h != 1 and w >= 8 and 2 * d <= w:
                held[p] += 1
            elif p >= 0 and t == "h1":
                titled[p] = 3
        out["holds"] += [min(a, 2) + b for a, b in zip(held, titled)]
        out["block"] += [int(t in BLOCK) for t in tree.tag]
        out["label"] += tree.label
        shift += n
    arrays = {k: np.array(v) for k, v in out.items()}
    arrays["size"] = np.digitize(arrays["size"], SIZES, right=True)
    arrays["density"] = np.digitize(arrays["density"], DENSITIES, right=True)
    _, which, alike = np.unique(arrays["parent"] * len(TAGS) + arrays["tag"], return_inverse=True, return_counts=True)
    arrays["block"] = arrays["block"] * ((1 + np.log(alike)) / alike)[which]
    return arrays


LEVELS = {"size": len(SIZES) + 1, "density": len(DENSITIES) + 1, "loose": 2, "holds": 6}
#: Many paragraphs say the same about the part they stand in, so these potentials count by a power below 1.
TEMPER = {"size": 0.3, "density": 0.3, "loose": 0.5, "holds": 0.8}


def train(pages: list[str], weight: float = 1.0, pooled: float = 4.0) -> dict[str, np.ndarray]:
    """Log potentials from labelled pages.

    A block's: its size, links and what it holds given whether it is main; elements inside lines say nothing more. An edge's: whether a child of this tag and with such
    names is main, given its parent, smoothed by ``pooled`` counts of what holds for all tags with such names.
    """
    f = features([parse(p.encode()) for p in pages])
    y, child = f["label"], f["parent"] >= 0
    up, tag, hint = y[f["parent"][child]], f["tag"][child], f["hint"][child]
    by_hint = np.full((4, 2, 2), weight / 2)
    np.add.at(by_hint, (hint, up, y[child]), 1)
    edge = np.tile(pooled * by_hint / by_hint.sum(axis=2, keepdims=True), (len(TAGS), 1, 1, 1))
    np.add.at(edge, (tag, hint, up, y[child]), 1)
    model = {"edge": np.log(edge / edge.sum(axis=3, keepdims=True)), "root": np.log(np.array([0.99, 0.01]))}
    for name, levels in LEVELS.items():
        counts = np.full((2, levels), weight)
        np.add.at(counts, (y, f[name]), f["block"])
        model[name] = TEMPER[name] * np.log(counts / counts.sum(axis=1, keepdims=True)).T
    return model


def marginals(f: dict[str, np.ndarray], model: dict[str, np.ndarray]) -> np.ndarray:
    """Probability of being main text for every element of some pages: messages up the trees, then down, a level at a time."""
    parent, depth = f["parent"], f["depth"]
    belief = sum(model[name][f[name]] for name in LEVELS) * f["block"][:, None]
    belief[parent < 0] += model["root"]
    by = np.argsort(depth, kind="stable")
    levels = np.split(by, np.flatnonzero(np.diff(depth[by])) + 1) if len(depth) else []
    message = np.zeros_like(belief)
    for nodes in reversed(levels[1:]):
        edge = model["edge"][f["tag"][nodes], f["hint"][nodes]]
        message[nodes] = np.logaddexp(*np.moveaxis(edge + belief[nodes][:, None, :], 2, 0))
        np.add.at(belief, parent[nodes], message[nodes])
    for nodes in levels[1:]:
        edge = model["edge"][f["tag"][nodes], f["hint"][nodes]]
        rest = belief[parent[nodes]] - message[nodes]
        belief[nodes] += np.logaddexp(*np.moveaxis(edge + rest[:, :, None], 1, 0))
        belief[nodes] -= belief[nodes].max(axis=1, keepdims=True)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def main_texts(trees: list[Tree], model: dict[str, np.ndarray]) -> list[str]:
    """Lines of the texts whose element is more likely main than not."""
    main = (marginals(features(trees), model) > 0.5).tolist()
    out, shift = [], 0
    for tree in trees:
        lines: dict[int, list[str]] = {}
        for node, line, text in tree.texts:
            if main[shift + node]:
                lines.setdefault(line, []).append(text)
        joined = (" ".join("".join(parts).split()) for parts in lines.values())
        out.append("\n".join(line for line in joined if line))
        shift += len(tree.parent)
    return out


def extract(pages: DataFrame, training: list[str] | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", chunk: int = 1 << 22) -> DataFrame:
    """Main text of every page from its whole html.

    Returns ``page_id``, ``url``, ``text`` (empty if there is none) and ``n_chars``. Character references are decoded;
    white space inside a block becomes one blank; blocks follow each other in page order, a line each. The model is
    trained on the driver from ``training`` (by default ``labelled_pages()``, whose number is its parameter). A null or
    empty html gives an empty text. Broken markup is read as browsers do in the common cases: open paragraphs, items
    and cells end where the next begins, stray end tags are ignored. Repeated rows are read one by one, an empty table
    gives an empty result, other columns are not looked at.
    """
    model = train(labelled_pages() if training is None else training)

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts: list[str] = []
            trees, size = [], 0
            for value in batch["html"]:
                trees.append(parse(value, labels=False))
                size += len(value or b"")
                if size > chunk:
                    texts += main_texts(trees, model)
                    trees, size = [], 0
            texts += main_texts(trees, model) if trees else []
            yield {"key": batch["key"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    slim = pages.select(F.col(page_id).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    schema = StructType([slim.schema["key"], slim.schema["url"], *_parse_datatype_string("text string, n_chars long")])
    return map_batches(slim, schema, run).withColumnRenamed("key", page_id).withColumnRenamed("url", url)
