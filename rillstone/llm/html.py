"""Main text of web pages by wrapper induction over the pages of a host.

A page is read into a tree of its block elements; inline markup is seen through. Per host, a page of median size of the
most frequent outline is the reference, and every page of the host is aligned to it by simple tree matching: two nodes match
if their labels do, and children are matched in order so that most nodes match (equal texts count twice). A reference
node whose text is the same on nearly all pages that match it is template; nodes that vary are slots. Pages that repeat
most of the reference's text are copies of it and do not vote, or a copied article would look like template; only text
that is not on nearly all pages counts for that, and of a page with an article its text alone.

A page's text is what stands below its content root, without template and without elements whose tag, role, class or id
says that they are menus, headers, footers, sidebars, notices, adverts, forms, comments and the like. The root is the
article or main element that the host's root matches, or else the one to which the containers with most of the page's
varying text lead; without such an element, it is the innermost of these containers that holds all of that text.

Alignment needs labels, parents and text hashes only, so whole pages move once, to meet their host's wrapper. Pages are
streamed past it and never gathered; adaptive execution cuts a host with many pages over several tasks.

Defined results: NULL, empty or textless html has an empty text; NULL and unreadable urls are one host; repeated rows
are pages of their own; elements nested deeper than DEEPEST stand beside each other below the one at that depth, as in
browsers, and their end tags close nothing above it; cut tags at the end are dropped; other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import settle

DEEPEST = 512  # as browsers have it
CELLS, LONG = 1 << 20, 48  # how alignment computes, not what: cells kept for going back, children from which on numpy pays
VOTES, CONSTANT, COPY, MAIN, LEAST = 5, 0.8, 0.5, 0.5, 24

# Element names of HTML by their role, and words that mark parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math canvas object".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul caption button".split()
)
CONTAINER = frozenset("html body div section article main center table tbody tr td blockquote".split())
LINKED = frozenset("h1 h2 h3 h4 h5 h6 hgroup p".split())
DROPPED = frozenset("nav footer aside form button select option fieldset legend dialog menu search head".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar comment comments "
    "commentlist respond reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager menu menus nav navbar navigation masthead footer widget toolbar search skip disqus".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# End tags that a start tag implies: the elements it closes, and those it does not look beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
BARRIERS = frozenset("table td th caption button body html".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Block elements in document order, and the text between them."""

    tags: list[str] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    out: list[bool] = field(default_factory=list)  # says by itself that it is no content
    items: list[tuple[int, str, bool]] = field(default_factory=list)  # node, text, in a link; "" ends a block

    def open(self, tag: str, marks: str, parent: int, out: bool) -> int:
        self.tags.append(tag)
        self.marks.append(marks)
        self.parents.append(parent)
        self.out.append(out)
        return len(self.tags) - 1


def _marks(attributes: str) -> tuple[str, bool]:
    """Class, id and role as text, and whether they or `hidden` say that the element is no content."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return "", False
    values, out = [], False
    for name, *value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(value).lower()
        if name in ("class", "id"):
            out |= not MARKS.isdisjoint(_WORD.findall(value))
            values.append(value)
        elif name == "role":
            out |= value in ROLES
            values.append(value)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            out = True
        elif name == "style" and "none" in value and re.search(r"display\s*:\s*none", value):
            out = True
    return " ".join(values), out


class _Surplus:
    """Open elements below DEEPEST. In the tree they stand beside each other; only one that is no content holds others."""

    def __init__(self):
        self.open: list[tuple[str, int]] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.outs: list[int] = []

    def push(self, tag: str, node: int, out: bool) -> None:
        at = len(self.open)
        self.open.append((tag, node))
        self.places[tag].append(at)
        if tag in BLOCK:
            self.blocks.append(at)
        if out:
            self.outs.append(at)

    def cut(self, size: int) -> None:
        while len(self.open) > size:
            tag, _ = self.open.pop()
            self.places[tag].pop()
        for places in (self.blocks, self.outs):
            while places and places[-1] >= size:
                places.pop()


def parse(html: str) -> Page:
    """The tree of a page. Lenient: unclosed, unopened and badly nested elements are taken as browsers take them."""
    page = Page()
    root = page.open("html", "", -1, False)
    stack: list[tuple[str, int]] = [("html", root)]  # open elements; inline ones have the node around them
    deep = _Surplus()
    links, at, size = 0, 0, len(html)
    while at < size:
        found = _TAG.search(html, at)
        text = html[at : found.start()] if found else html[at:]
        inside = (deep.open or stack)[-1][1]
        if text:
            page.items.append((inside, text, links > 0))
        if not found:
            # A tag that is cut off by the end of the page, or that has an open quote, is no text.
            if cut := re.search(r"<[a-zA-Z/!]", text):
                page.items[-1] = (inside, text[: cut.start()], links > 0)
            break
        at = found.end()
        slash, tag, attributes, _ = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            links -= links > 0 and tag == "a"
            names = [t for t, _ in stack]
            last = deep.places[tag][-1] if deep.places.get(tag) else -1
            if last < 0 and tag not in names[1:]:
                if tag == "p" or tag in BLOCK:
                    page.items.append((inside, "", False))
                continue
            # An inline end tag closes no block.
            if tag not in BLOCK and deep.blocks and deep.blocks[-1] > last:
                continue
            if last < 0 and tag not in BLOCK and any(t in BLOCK for t in names[len(names) - names[::-1].index(tag) :]):
                continue
            deep.cut(max(last, 0))
            while last < 0 and stack.pop()[0] != tag:
                pass
            if tag in BLOCK:
                page.items.append(((deep.open or stack)[-1][1], "", False))
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            closing = html.find(">", end.end() - 1) if end else -1
            at = closing + 1 if closing >= 0 else size
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                page.items.append((inside, " " if tag == "br" else "", False))
            continue
        if tag in BLOCK:
            if not deep.open:
                _close_implied(stack, tag)
                inside = stack[-1][1]
            page.items.append((inside, "", False))
            if tag == "body" and any(t == "body" for t, _ in stack):
                continue
        links += tag == "a"
        marks, out = _marks(attributes)
        out |= tag in DROPPED or tag == "header" and not any(t in ("article", "main") for t, _ in [*stack, *deep.open])
        if tag == "html":
            continue
        if tag in BLOCK or tag == "head" or out:
            if deep.open:
                inside = deep.open[deep.outs[0]][1] if deep.outs else stack[-1][1]
            inside = page.open(tag, marks, inside, out)
        if len(stack) < DEEPEST:
            stack.append((tag, inside))
        else:
            deep.push(tag, inside, out)
    return page


def _close_implied(stack: list[tuple[str, int]], tag: str) -> None:
    if stack[-1][0] == "head" and tag == "body":
        stack.pop()
    closed, stops = CLOSES.get(tag, (set(), set()))
    for names, barriers in ((closed, stops), ({"p"}, BARRIERS)):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
            elif stack[i][0] in barriers:
                break


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) >> 33


@dataclass
class Tree:
    """What alignment needs of a page: for each node its label, parent, text hash, text size, whether it is dropped."""

    labels: list[int]
    parents: list[int]
    texts: list[int]
    sizes: list[int]
    flags: list[int]  # 1: dropped by itself; 2: a container; 4: article or main

    def __post_init__(self):
        self.children: list[list[int]] = [[] for _ in self.labels]
        for i, p in enumerate(self.parents):
            if p >= 0:
                self.children[p].append(i)

    def to_bytes(self) -> bytes:
        columns = (self.labels, self.parents, self.texts, self.sizes, self.flags)
        return np.array(columns, dtype=np.int32).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        return cls(*np.frombuffer(data, dtype=np.int32).reshape(5, -1).tolist())


def tree_of(page: Page) -> Tree:
    """Text sizes leave out links, as lists of links are no article, but not those in headings and paragraphs."""
    texts: list[list[str]] = [[] for _ in page.tags]
    sizes = [0] * len(page.tags)
    for node, text, link in page.items:
        if text:
            texts[node].append(text)
            sizes[node] += 0 if link and page.tags[node] not in LINKED else len(text.strip())
    hashes = [_hash(" ".join("".join(t).split())) for t in texts]
    labels = [_hash(f"{t} {m}") for t, m in zip(page.tags, page.marks)]
    flags = [o + 2 * (t in CONTAINER) + 4 * (t in ("article", "main")) for o, t in zip(page.out, page.tags)]
    tree = Tree(labels, page.parents, hashes, sizes, flags)
    # What only looks dropped because of a class stays if it holds an article, or, on a page without any, most text.
    marked = [i for i, t in enumerate(page.tags) if page.out[i] and t not in DROPPED]
    if marked:
        articles = any(f & 4 for f in flags)
        total = None if articles else _totals(Tree(labels, page.parents, hashes, sizes, [0] * len(flags)), sizes.__getitem__)
        for i in marked:
            if _holds_article(tree, i) if articles else total[i] > MAIN * total[0]:
                tree.flags[i] &= ~1
    return tree


def _holds_article(tree: Tree, node: int) -> bool:
    todo = [node]
    while todo:
        i = todo.pop()
        if tree.flags[i] & 4:
            return True
        todo += tree.children[i]
    return False


def _totals(tree: Tree, of) -> list[int]:
    """Sums over each node and what is below it, without dropped parts."""
    out = [0] * len(tree.labels)
    for i in range(len(out) - 1, -1, -1):
        out[i] += of(i)
        if tree.parents[i] >= 0 and not tree.flags[i] & 1:
            out[tree.parents[i]] += out[i]
    return out


def _shapes(tree: Tree) -> tuple[list[int], list[int]]:
    """For each node a hash of all that stands below it, and the number of nodes."""
    shapes, sizes = [0] * len(tree.labels), [1] * len(tree.labels)
    for i in range(len(shapes) - 1, -1, -1):
        below = tree.children[i]
        shapes[i] = hash((tree.labels[i], tree.texts[i], *[shapes[c] for c in below]))
        sizes[i] += sum(sizes[c] for c in below)
    return shapes, sizes


class _Alignment:
    """Simple tree matching of two pages, without recursion. Equal parts at both ends of two lists of children are
    matched first, which is never worse; what is left is compared in full. Of long lists only some rows of the table are
    kept, and the others computed again on the way back, so memory stays near linear in their length."""

    def __init__(self, a: Tree, b: Tree):
        self.a, self.b = a, b
        (self.shapes, self.sizes), (self.others, _) = _shapes(a), _shapes(b)
        self.known: dict[tuple[int, int], int] = {}  # the size of the best matching of two subtrees
        self.columns: dict[int, tuple[np.ndarray, ...]] = {}

    def ends(self, x: int, y: int) -> tuple[int, int]:
        """How many children of both are equal at the start, and how many at the end."""
        xs, ys, p, q = self.a.children[x], self.b.children[y], self.shapes, self.others
        most, first, last = min(len(xs), len(ys)), 0, 0
        while first < most and p[xs[first]] == q[ys[first]]:
            first += 1
        while last < most - first and p[xs[-1 - last]] == q[ys[-1 - last]]:
            last += 1
        return first, last

    def left_over(self, x: int, y: int) -> tuple[list[int], list[int]]:
        first, last = self.ends(x, y)
        xs, ys = self.a.children[x], self.b.children[y]
        return xs[first : len(xs) - last], ys[first : len(ys) - last]

    def pair(self, c: int, d: int) -> int | None:
        """The size of the best matching of two subtrees with equal labels at the top, None if not known yet."""
        if self.shapes[c] == self.others[d]:
            return 2 * self.sizes[c]
        if not self.a.children[c] or not self.b.children[d]:
            return 1 + (self.a.texts[c] == self.b.texts[d])
        return self.known.get((c, d))

    def _short(self, row: list[int], c: int, ys: list[int], missing: list) -> list[int]:
        """The best sizes with the first 0, 1, 2 ... of ys, after one more child of the other list."""
        made, left, label, labels = [0], 0, self.a.labels[c], self.b.labels
        for j, y in enumerate(ys):
            best = row[j + 1]
            if best < left:
                best = left
            if label == labels[y]:
                size = self.pair(c, y)
                if size is None:
                    missing.append((c, y))
                elif row[j] + size > best:
                    best = row[j] + size
            made.append(best)
            left = best
        return made

    def _long(self, row: np.ndarray, c: int, y: int, ys: list[int], missing: list) -> np.ndarray:
        """The same for many ys: what a child adds is one array, and the best to the left a running maximum."""
        if y not in self.columns:
            columns = [[of[d] for d in ys] for of in (self.b.labels, self.b.texts)]
            self.columns[y] = *(np.array(x, dtype=np.int64) for x in columns), np.array([bool(self.b.children[d]) for d in ys], dtype=bool)
        labels, texts, inner = self.columns[y]
        alike = labels == self.a.labels[c]
        size = np.where(alike, 1 + (texts == self.a.texts[c]), 0)
        if self.a.children[c]:
            for j in np.flatnonzero(alike & inner).tolist():
                found = self.pair(c, ys[j])
                size[j] = found or 0
                if found is None:
                    missing.append((c, ys[j]))
        out = row.copy()
        np.maximum(out[1:], np.where(alike, row[:-1] + size, 0), out=out[1:])
        return np.maximum.accumulate(out)

    def rows(self, y: int, xs: list[int], ys: list[int], start, missing: list):
        """The row after each child of xs, from the one before the first."""
        row = start
        for c in xs:
            row = self._long(row, c, y, ys, missing) if len(ys) >= LONG else self._short(row, c, ys, missing)
            yield row

    def _zeros(self, ys: list[int]):
        return np.zeros(len(ys) + 1, dtype=np.int64) if len(ys) >= LONG else [0] * (len(ys) + 1)

    def weigh(self) -> None:
        todo = [(0, 0)] if self.pair(0, 0) is None else []
        while todo:
            x, y = todo[-1]
            if (x, y) in self.known:
                todo.pop()
                continue
            xs, ys = self.left_over(x, y)
            missing: list[tuple[int, int]] = []
            row = self._zeros(ys)
            for row in self.rows(y, xs, ys, row, missing):
                pass
            self.columns.pop(y, None)
            if missing:
                todo += missing
                continue
            first, last = self.ends(x, y)
            below = self.a.children[x]
            equal = sum(2 * self.sizes[c] for c in [*below[:first], *below[len(below) - last :]])
            self.known[x, y] = 1 + (self.a.texts[x] == self.b.texts[y]) + equal + int(row[-1])

    def _back(self, y: int, xs: list[int], ys: list[int]) -> list[tuple[int, int]]:
        """The pairs of a best matching of two lists of children."""
        every = len(xs) if len(xs) * len(ys) <= CELLS else math.isqrt(len(xs)) + 1
        kept = {0: self._zeros(ys)}
        if every < len(xs):
            for i, row in enumerate(self.rows(y, xs, ys, kept[0], []), 1):
                if i % every == 0:
                    kept[i] = row
        out, i, j, part, low = [], len(xs), len(ys), [], 0
        while i and j:
            if not part or i <= low:
                low = (i - 1) // every * every
                part = [kept[low], *self.rows(y, xs[low:i], ys, kept[low], [])]
            above, row = part[i - 1 - low], part[i - low]
            if row[j] == above[j]:
                i -= 1
            elif row[j] == row[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((xs[i], ys[j]))
        self.columns.pop(y, None)
        return out

    def matched(self) -> dict[int, int]:
        self.weigh()
        out, todo = {}, [(0, 0)]
        while todo:
            x, y = todo.pop()
            out[x] = y
            first, last = self.ends(x, y)
            xs, ys = self.a.children[x], self.b.children[y]
            todo += [*zip(xs[:first], ys[:first]), *zip(xs[len(xs) - last :], ys[len(ys) - last :])]
            if first + last not in (len(xs), len(ys)):
                todo += self._back(y, *self.left_over(x, y))
        return out


def align(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: nodes of b by the nodes of a they match."""
    return _Alignment(a, b).matched() if a.labels[0] == b.labels[0] else {}


def telling(reference: Tree, seen: np.ndarray, own: np.ndarray) -> list[int]:
    """The nodes of the reference that tell whether a page is a copy of it: those of its articles, if it has any, whose
    text is not on nearly all pages of the host or of the same outline. None if hardly any text is left. The counts are
    of pages that hold each node's text, and of all pages at the end."""
    outside = _dropped(reference)
    within = [False] * len(reference.labels)
    for i, p in enumerate(reference.parents):
        within[i] = not outside[i] and (bool(reference.flags[i] & 4) or p >= 0 and within[p])
    scope = [i for i, w in enumerate(within) if (w if any(within) else not outside[i]) and reference.sizes[i]]
    common = seen[:-1] >= CONSTANT * seen[-1]
    if own[-1] >= VOTES:
        common |= own[:-1] >= CONSTANT * own[-1]
    rare = [i for i in scope if not common[i]]
    return rare if sum(reference.sizes[i] for i in rare) >= LEAST else []


def votes(reference: Tree, page: Tree, tell: list[int]) -> np.ndarray | None:
    """For each node of the reference whether the page matches it, and with the same text; None for copies."""
    if not tell:
        return None
    matched = align(reference, page)
    out = np.zeros((2, len(reference.labels)), dtype=np.int64)
    for x, y in matched.items():
        out[:, x] = 1, reference.texts[x] == page.texts[y]
    same, total = (sum(reference.sizes[x] for x in of) for of in ([x for x in tell if out[1, x]], tell))
    return None if same > COPY * total else out


def _dropped(tree: Tree) -> list[bool]:
    out = [False] * len(tree.labels)
    for i, p in enumerate(tree.parents):
        out[i] = bool(tree.flags[i] & 1) or p >= 0 and out[p]
    return out


def content_root(tree: Tree, template: set[int]) -> int:
    """Down from the top, as long as one container holds most of the text that is no template. Unless that ends at an
    article, back up to where none of this text stands outside."""
    total = _totals(tree, lambda i: 0 if i in template else tree.sizes[i])
    node = whole = 0
    while not tree.flags[node] & 4:
        inside = [c for c in tree.children[node] if not tree.flags[c] & 1 and tree.flags[c] & 2]
        main = max(inside, key=lambda c: total[c], default=None)
        if main is None or total[main] <= MAIN * total[node]:
            # An article in a body that has more text outside it is the article still.
            main = max((c for c in inside if tree.flags[c] & 4), key=lambda c: total[c], default=None)
            if main is None or not total[main]:
                return whole
        node = main
        if total[node] == total[0]:
            whole = node
    return node


@dataclass
class Wrapper:
    reference: Tree
    template: set[int]
    root: int

    @classmethod
    def of(cls, reference: Tree, matched: np.ndarray, same: np.ndarray) -> Wrapper:
        template = {int(i) for i in np.flatnonzero((matched >= VOTES) & (same >= CONSTANT * matched))}
        return cls(reference, template, content_root(reference, template))


def main_text(html: str, wrapper: Wrapper | None) -> str:
    """The blocks of the page's main text, one to a line."""
    page = parse(html)
    tree = tree_of(page)
    matched = align(wrapper.reference, tree) if wrapper else {}
    template = {
        y for x, y in matched.items() if x in wrapper.template and tree.texts[y] == wrapper.reference.texts[x]
    }
    # The host's root holds only if it is an article: any other may have text beside it that its reference has not.
    root = matched.get(wrapper.root) if wrapper else None
    if root is None or not tree.flags[root] & 4:
        root = content_root(tree, template)
    inside = [False] * len(tree.labels)
    for i, p in enumerate(tree.parents):
        inside[i] = i == root or p >= 0 and inside[p] and not tree.flags[i] & 1
    out: list[str] = []
    block: list[str] = []

    def end():
        if block:
            if text := " ".join("".join(block).split()):
                out.append(text)
            block.clear()

    for node, text, _ in page.items:
        if not text:
            end()
        elif inside[node] and node not in template:
            block.append(entities.unescape(text))
    end()
    return "\n".join(out)


def host(url: str) -> Column:
    """The host part of a url column, without case and a leading www; empty if there is none."""
    found = F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.regexp_replace(F.lower(found), r"^www\.", ""), F.lit(""))


def _profiles(batches):
    """Outline, size and tree of every page beside its host."""
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            trees = [tree_of(parse(h.as_py() or "")) for h in part.column(1)]
            outlines = []
            for t in trees:
                depth = [0] * len(t.labels)
                for i, p in enumerate(t.parents):
                    depth[i] = depth[p] + 1 if p >= 0 else 0
                seen = dict.fromkeys((depth[i], x) for i, x in enumerate(t.labels) if depth[i] <= 3)
                outlines.append(_hash(str(list(seen))))
            columns = [
                part.column(0), pa.array(outlines, pa.int64()), pa.array([len(t.labels) for t in trees], pa.int64()),
                pa.array([t.to_bytes() for t in trees], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "outline", "nodes", "tree"])


def _counts(reference: Tree, page: Tree, alike: bool) -> np.ndarray:
    """For each node of the reference whether its text is on the page, and if the page has its outline; 1 at the end."""
    held = set(page.texts)
    seen = np.array([*(t in held for t in reference.texts), True], dtype=np.int64)
    return np.array([seen, seen * alike])


def _summed(rows: DataFrame, count, names: tuple[str, str]) -> DataFrame:
    """(host, v) from (host, tree, reference, more): the sums of the two numbers which `count` gives for each node."""

    def run(batches):
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            references: dict[str, Tree] = {}
            for name, tree, reference, more in zip(*(batch.column(i) for i in range(4))):
                name = name.as_py()
                if name not in references:
                    references[name] = Tree.from_bytes(reference.as_py())
                got = count(references[name], Tree.from_bytes(tree.as_py()), more.as_py())
                if got is not None:
                    sums[name] = sums[name] + got if name in sums else got
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sums))] + [pa.array([s[i].tolist() for s in sums.values()]) for i in (0, 1)],
                    names=["host", *names],
                )

    one, two = names
    summed = rows.mapInArrow(run, f"host string, {one} array<bigint>, {two} array<bigint>")
    nodes = summed.select("host", F.posexplode(F.arrays_zip(one, two)).alias("node", "v"))
    sums = nodes.groupBy("host", "node").agg(F.sum(f"v.{one}").alias(one), F.sum(f"v.{two}").alias(two))
    return sums.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", one, two))).alias("v"))


def _told(batches):
    """Each host's reference with its telling nodes."""
    for batch in batches:
        lists = []
        for reference, v in zip(batch.column(1), batch.column(2)):
            counts = np.array([(x["seen"], x["own"]) for x in v.as_py()]).T
            lists.append(telling(Tree.from_bytes(reference.as_py()), *counts))
        columns = [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "reference", "tell"])


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, reference, v) from (host, html): how many pages of each host match each node of its reference, and how
    many with the same text."""
    read = pages.select("host", "html").mapInArrow(_profiles, "host string, outline long, nodes long, tree binary")
    profiles = settle(read, "page-trees")
    outlines = profiles.groupBy("host", "outline").agg(F.count("*").alias("n"), F.median("nodes").alias("middle"))
    best = outlines.groupBy("host").agg(F.max(F.struct("n", "outline", "middle")).alias("best"))
    alike = profiles.join(best.select("host", "best.outline", "best.middle"), ["host", "outline"])
    order = F.struct(F.abs(F.col("nodes") - F.col("middle")).alias("off"), F.xxhash64("tree").alias("tie"), "tree")
    hosts = alike.groupBy("host").agg(F.min(F.struct(order.alias("o"), "outline")).alias("least"))
    hosts = settle(hosts.select("host", F.col("least.outline").alias("best"), F.col("least.o.tree").alias("reference")), "hosts")
    asked = profiles.join(hosts, "host").select("host", "tree", "reference", F.expr("outline = best").alias("more"))
    told = hosts.drop("best").join(_summed(asked, _counts, ("seen", "own")), "host")
    told = settle(told.mapInArrow(_told, "host string, reference binary, tell array<int>"), "telling")
    asked = profiles.select("host", "tree").join(told, "host").select("host", "tree", "reference", "tell")
    lists = _summed(asked, votes, ("matched", "same"))
    return settle(hosts.drop("best").join(lists, "host", "left"), "wrappers")


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    pages = df.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host(url).alias("host")
    )
    joined = pages.join(wrappers(pages), "host").select("page_id", "url", "html", "host", "reference", "v")
    kind = joined.schema["page_id"].dataType.simpleString()

    def run(batches):
        now, wrapper = None, None
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = []
                for i in range(part.num_rows):
                    if (name := part.column(3)[i].as_py()) != now:
                        v = part.column(5)[i].as_py() or []
                        reference = Tree.from_bytes(part.column(4)[i].as_py())
                        matched, same = (np.zeros(len(reference.labels), dtype=np.int64) for _ in range(2))
                        for x in v:
                            matched[x["node"]], same[x["node"]] = x["matched"], x["same"]
                        now, wrapper = name, Wrapper.of(reference, matched, same)
                    texts.append(main_text(part.column(2)[i].as_py() or "", wrapper))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts])],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
