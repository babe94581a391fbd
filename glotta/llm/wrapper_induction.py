"""Main text of web pages by wrapper induction.

Per host, two pages are reference trees: of ``DRAWS`` that hashes choose among
its distinct pages, the one of median size and a longer one, so a stub is hardly
ever one and a block that one lacks may be in the other.  Simple tree matching
aligns every page of the host with both.  Per reference node, counts over all
pages give: on how many pages it was found, on how many with the same text, and
how much text outside of links it held.  They induce the host's wrapper:

* a node whose text is the same on nearly all aligned pages is template;
* the others are slots.  The content's region is found from the root down: a
  child that holds ``MAJOR`` of the slots' text, of a shape of its own among
  its neighbours, narrows it; paragraphs and their like never do.

Extraction aligns the page with its host's references and takes the slots of the
content's region, and headings that vary beside it; template goes.  What tags,
roles, classes or ids mark as menu, header, footer, sidebar, notice, advert,
form or reader comments only decides where the wrapper doesn't: inside the
region, and on pages whose host has no wrapper (fewer than ``PAGES`` pages).
There, an ``article`` (else ``main``) bounds the search where a page has one;
without either, blocks that are mostly links go too.

Counts are added up per task before they are grouped, so a host with a third of
all pages is no burden.  Wrappers go to all tasks while they measure at most
``BROADCAST_BYTES``; beyond that, each host's pages stream past its wrapper, and
large hosts are dealt out with a copy of theirs for each share.

Text: character references are decoded, white space inside a block becomes one
space, blocks join by a newline; ``br`` counts as white space.

Edge cases: null or empty html gives an empty text; pages without a host are
read without a wrapper; null page ids and repeated rows give a row each;
unclosed and stray tags are repaired as browsers would, in time linear in the
page; tags may nest to any depth; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_HEAVY, batch, materialize, only_members, plain, ship, text_slices

#: Share of aligned pages, and least number of them, that make a template.
CONSTANT = 0.9
PAGES = 3
#: Share of the slots' text that a region of the content holds.
MAJOR = 0.75
#: Least share of all text that slots hold; below it, a host's pages are copies
#: of each other and tell nothing.
VARIES = 0.1
#: Pages that hashes choose per host, and which of them by size are references.
DRAWS = 15
CHOSEN = (DRAWS // 2, 3 * DRAWS // 4)
BROADCAST_BYTES = 32 << 20
#: References, as (host, two numbers), that are broadcast.
BROADCAST_ROWS = 100_000
#: Pages of a host that one task takes, where wrappers aren't broadcast.
SHARE_PAGES = 2000
#: Cells of one alignment of two child lists in plain Python; larger ones go
#: through numpy rows, with the same sum.
CELLS = 1 << 16

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption legend".split()
)
_CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "thead", "tbody", "tfoot")),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select", "datalist")),
}
#: Tags whose content is never text of the page.
_SILENT = frozenset("head script style noscript template iframe svg canvas object audio video select textarea input title".split())
_DROPPED = frozenset("nav footer aside form dialog menu button label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner nav navbar navigation menu submenu breadcrumb breadcrumbs "
    "sidebar rail widget widgets footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup comment comments disqus replies respond share sharing social related recommended recommendations login search pagination pager toolbar skip".split()
)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


#: Tags that hold a passage and are never a region by themselves.
_PASSAGES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote figcaption caption summary legend address".split())


class Node:
    __slots__ = ("tag", "attributes", "children", "parent", "number")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list = []  # nodes and strings
        self.number = -1

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]


def _tokens(page: str):
    """(text before, tag, closing, attributes, place after) of each tag, in one
    forward scan.  A quote hides > up to its partner; where that leaves a tag
    without an end, its first > ends it."""
    last = {c: page.rfind(c) for c in ">\"'"}
    failed: set[int] = set()

    def end(at: int) -> int:
        here, seen = at, []
        while here not in failed and here <= last[">"]:
            seen.append(here)
            m = _STOP.search(page, here)
            if m[0] == ">":
                return m.start()
            if m.start() >= last[m[0]]:
                break
            here = page.find(m[0], m.end()) + 1
        failed.update(seen)
        return page.find(">", at)

    at = text = 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            to = len(page) if close < 0 else close + 3
            yield page[text:at], "", False, "", to
            at = text = to
            continue
        if at > last[">"]:
            break
        m = _NAME.match(page, at + 1)
        if m:
            to = end(m.end())
            place = yield page[text:at], m[2].lower(), bool(m[1]), page[m.end() : to], to + 1
            at = text = to + 1 if place is None else place
        elif page[at + 1 : at + 2] in ("!", "?"):
            to = page.find(">", at) + 1
            yield page[text:at], "", False, "", to
            at = text = to
        else:
            at += 1
    yield page[text:], "", False, "", len(page)


def parse(page: str) -> Node:
    """The page's tree, with missing end tags supplied."""
    root = here = Node("#root")
    open_: Counter = Counter()
    low = None

    def leave(to: Node) -> Node:
        """Close everything up to and with ``to``."""
        x = here
        while x is not to:
            open_[x.tag] -= 1
            x = x.parent
        open_[to.tag] -= 1
        return to.parent

    tokens = _tokens(page)
    place = None
    while True:
        try:
            text, tag, closing, attributes, at = tokens.send(place)
        except StopIteration:
            return root
        place = None
        if text:
            here.children.append(text)
        if not tag:
            continue
        if closing:
            if open_[tag]:
                x = here
                while x.tag != tag:
                    x = x.parent
                here = leave(x)
            continue
        if tag in _BLOCK and open_["p"]:  # a block ends an open paragraph
            x = here
            while x is not root and x.tag not in ("p", "button", "td", "th", "table", "article", "section", "div", "li"):
                x = x.parent
            if x.tag == "p":
                here = leave(x)
        if tag in _CLOSES:
            ends, stops = _CLOSES[tag]
            ends = ends.split()
            x, found = here, None
            while any(open_[e] for e in ends) and x is not root and x.tag not in stops:
                if x.tag in ends:
                    found = x
                x = x.parent
            if found is not None:
                here = leave(found)
        node = Node(tag, attributes, here)
        here.children.append(node)
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK and tag not in _RAW:
            continue
        if tag in _RAW:
            if low is None:
                low = page.lower()
                if len(low) != len(page):  # some letters change their length
                    low = page
            end = low.find(f"</{tag}", at)
            end = len(page) if end < 0 else end
            node.children.append(page[at:end])
            close = page.find(">", end)
            place = len(page) if close < 0 else close + 1
            continue
        open_[tag] += 1
        here = node


def _squeezed(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def own_text(node: Node, linked: bool = False) -> tuple[str, int]:
    """Text of a node outside of the blocks within it, and how many of its
    characters aren't of links."""
    parts: list[str] = []
    bare = 0
    stack: list[tuple] = [(c, linked) for c in reversed(node.children)]
    while stack:
        c, link = stack.pop()
        if isinstance(c, str):
            parts.append(c)
            bare += 0 if link else len(c)
        elif c.tag == "br":
            parts.append(" ")
        elif c.tag not in _BLOCK and c.tag not in _RAW and c.tag not in _SILENT:
            stack.extend((k, link or c.tag == "a") for k in reversed(c.children))
    text = _squeezed(parts)
    return text, min(bare, len(text))


def blocks_of(node: Node, linked: bool) -> list[tuple[Node, bool]]:
    """The nearest block nodes below, and whether they are in a link."""
    out: list[tuple[Node, bool]] = []
    stack = [(c, linked) for c in reversed(node.nodes())]
    while stack:
        n, link = stack.pop()
        if n.tag in _BLOCK:
            out.append((n, link))
        elif n.tag not in _RAW and n.tag not in _SILENT:
            stack.extend((c, link or n.tag == "a") for c in reversed(n.nodes()))
    return out


class Tree:
    """The block nodes of a page, numbered in page order."""

    def __init__(self, page: str):
        self.root = parse(page)
        self.nodes: list[Node] = []
        self.below: list[list[int]] = []
        self.up: list[int] = []
        self._linked: list[bool] = []
        self._add(self.root)
        self._own: dict[int, tuple[str, int]] = {}

    def _add(self, root: Node) -> None:
        stack: list[tuple[Node, bool, int]] = [(root, False, -1)]
        while stack:
            node, linked, up = stack.pop()
            node.number = len(self.nodes)
            self.nodes.append(node)
            self.below.append([])
            self.up.append(up)
            self._linked.append(linked)
            if up >= 0:
                self.below[up].append(node.number)
            stack.extend((c, link, node.number) for c, link in reversed(blocks_of(node, linked)))

    def own(self, i: int) -> tuple[str, int]:
        if i not in self._own:
            self._own[i] = own_text(self.nodes[i], self._linked[i])
        return self._own[i]

    def text(self, i: int) -> str:
        return self.own(i)[0]


def _label(n: Node) -> str:
    return n.tag


def _short_plan(x: list[int], y: list[int], weight: Callable[[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """The greatest sum of an ordered alignment of two lists, and its places."""
    # rows of the best sums; choices are read back from them
    table = [[0] * (len(y) + 1)]
    for p in x:
        last, row = table[-1], [0]
        for k, q in enumerate(y):
            best = last[k + 1] if last[k + 1] >= row[k] else row[k]
            w = weight(p, q)
            if w and last[k] + w > best:
                best = last[k] + w
            row.append(best)
        table.append(row)
    plan, r, k = [], len(x), len(y)
    while r and k:
        if table[r][k] == table[r - 1][k]:
            r -= 1
        elif table[r][k] == table[r][k - 1]:
            k -= 1
        else:
            r, k = r - 1, k - 1
            plan.append((r, k))
    return table[-1][-1], plan


def _plan(x: list[int], y: list[int], weight: Callable[[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """As ``_short_plan``.  Equal shapes at both ends pair up, which no other
    alignment beats; the rest goes through plain Python or numpy."""
    n, head, tail = min(len(x), len(y)), 0, 0
    while head < n and x[head] == y[head]:
        head += 1
    while tail < n - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    plan = [(k, k) for k in range(head)] + [(len(x) - 1 - k, len(y) - 1 - k) for k in range(tail)]
    total = sum(weight(x[r], y[k]) for r, k in plan)
    x, y = x[head : len(x) - tail], y[head : len(y) - tail]
    if not x or not y:
        return total, plan
    more, middle = (_long_plan if len(x) * len(y) > CELLS else _short_plan)(x, y, weight)
    return total + more, plan + [(head + r, head + k) for r, k in middle]


def _long_plan(x: list[int], y: list[int], weight: Callable[[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """As ``_short_plan``; every ``step``-th row is kept, and those after it are
    computed again when the choices are read back."""
    (one, p), (two, q) = (np.unique(z, return_inverse=True) for z in (x, y))
    weights = np.array([[weight(i, j) for j in two.tolist()] for i in one.tolist()], np.int64)

    def after(row: np.ndarray, r: int) -> np.ndarray:
        best = np.maximum(row[1:], row[:-1] + weights[p[r]][q])
        return np.concatenate([[0], np.maximum.accumulate(best)])

    step = isqrt(len(x)) + 1
    row, kept = np.zeros(len(y) + 1, np.int64), []
    for r in range(len(x)):
        if r % step == 0:
            kept.append(row)
        row = after(row, r)
    total, plan = int(row[-1]), []
    r, k = len(x), len(y)
    while r and k:
        first = (r - 1) // step * step
        table = [kept[first // step]]
        for i in range(first, r):
            table.append(after(table[-1], i))
        while r > first and k:
            here, up = table[r - first], table[r - first - 1]
            if here[k] == up[k]:
                r -= 1
            elif here[k] == here[k - 1]:
                k -= 1
            else:
                r, k = r - 1, k - 1
                plan.append((r, k))
    return total, plan


#: Results of alignments that a task keeps for a reference.
KEPT = 200_000


class Matcher:
    """Simple tree matching with one tree.  A pair's alignment follows from its
    two shapes, so pages that share shapes share the work."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self._begin()

    def _begin(self) -> None:
        self.known: dict = {}  # a tree of tags -> its shape's number
        self.of: list[tuple[str, tuple[int, ...]]] = []
        self.sizes: dict[tuple[int, int], int] = {}
        self.plans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.mine = self._shapes(self.tree)

    def _shapes(self, tree: Tree) -> list[int]:
        """Per node a number that equal trees of tags share."""
        out = [0] * len(tree.nodes)
        for i in range(len(out) - 1, -1, -1):  # children come after their parents
            shape = (_label(tree.nodes[i]), tuple(out[c] for c in tree.below[i]))
            out[i] = self.known.setdefault(shape, len(self.of))
            if out[i] == len(self.of):
                self.of.append(shape)
        return out

    def __call__(self, other: Tree) -> list[tuple[int, int]]:
        """The pairs of nodes of a largest top-down, ordered alignment of equal
        tags."""
        if len(self.sizes) + len(self.of) > KEPT + 2 * len(self.mine):
            self._begin()
        mine, theirs = self.mine, self._shapes(other)
        of, sizes, plans = self.of, self.sizes, self.plans

        def weight(s: int, t: int) -> int:
            return sizes.get((s, t), 0)

        todo = [(mine[0], theirs[0])]
        while todo:
            s, t = todo[-1]
            if (s, t) in sizes:
                todo.pop()
                continue
            x, y = of[s][1], of[t][1]
            by_label: dict[str, list[int]] = {}
            for q in dict.fromkeys(y):
                by_label.setdefault(of[q][0], []).append(q)
            before = len(todo)
            for p in dict.fromkeys(x):
                todo.extend((p, q) for q in by_label.get(of[p][0], ()) if (p, q) not in sizes)
            if len(todo) > before:
                continue
            todo.pop()
            sizes[s, t] = 1
            if x and y:
                total, plans[s, t] = _plan(x, y, weight)
                sizes[s, t] += total
        out, stack = [], [(0, 0)]
        while stack:
            i, j = stack.pop()
            out.append((i, j))
            x, y = self.tree.below[i], other.below[j]
            stack.extend((x[r], y[k]) for r, k in plans.get((mine[i], theirs[j]), ()))
        return out


def match(a: Tree, b: Tree) -> list[tuple[int, int]]:
    return Matcher(a)(b)


def _marked(n: Node) -> bool:
    """Is this node marked as something else than the article?"""
    if n.tag in _DROPPED:
        return True
    if not n.attributes:
        return False
    known = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(n.attributes)}
    if "hidden" in known or known.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", known.get("style", "")):
        return True
    if n.tag in ("html", "body", "main"):
        return False
    words = {w.lower() for k in ("class", "id") for w in _SPLIT.split(known.get(k, ""))}
    if n.tag == "article":
        return bool(words & {"comment", "comments", "ad", "advert", "promo", "related"})
    return known.get("role", "").lower() in _ROLES or bool(words & _NAMES)


def _nothing(n: Node) -> bool:
    return False


def _roots(tree: Tree, marked: Callable[[Node], bool] = _marked) -> tuple[list[Node], bool]:
    """Where the article is: article nodes, else main nodes, else the page."""
    for tag in ("article", "main"):
        found, stack = [], [tree.root]
        while stack:
            n = stack.pop()
            if n.tag in _SILENT or marked(n):
                continue
            if n.tag == tag or tag == "main" and 'role="main"' in n.attributes:
                found.append(n)
            else:
                stack.extend(reversed(n.nodes()))
        if found:
            return found, True
    return [tree.root], False


def extract(page: str, template: frozenset[int] = frozenset(), tree: Tree | None = None, regions: list[int] | None = None, marks: bool = True) -> str:
    """The main text.  ``template`` numbers the page's nodes to leave out,
    ``regions`` those that hold the content, where a wrapper knows; without
    ``marks`` nothing is left out for what its tag or attributes say."""
    tree = tree or Tree(page)
    marked = _marked if marks else _nothing
    roots, sure = ([tree.nodes[i] for i in regions], True) if regions else _roots(tree, marked)
    out: list[str] = []
    parts: list[str] = []
    links = 0
    for r in roots:
        stack: list = [(c, False, r.number not in template) for c in reversed(r.children)]
        stack.insert(0, None)
        while stack:
            item = stack.pop()
            if item is None:  # a block begins or ends
                text = _squeezed(parts)
                if text and (sure or links < 0.6 * len(text)):
                    out.append(text)
                parts, links = [], 0
                continue
            c, inside, keep = item
            if isinstance(c, str):
                if keep:
                    parts.append(c)
                    links += len(c) if inside else 0
            elif c.tag == "br":
                parts.append(" ")
            elif c.tag in _SILENT or marked(c) or c.tag == "header" and not sure:
                if c.tag in _BLOCK:
                    stack.append(None)
            elif c.tag in _BLOCK:
                stack.append(None)
                stack.extend((k, inside, c.number not in template) for k in reversed(c.children))
                stack.append(None)
            else:
                stack.extend((k, inside or c.tag == "a", keep) for k in reversed(c.children))
    return "\n".join(out)


# ---------------------------------------------------------------- wrappers


class Wrapper:
    """What a host's pages have in common with one of its reference pages."""

    def __init__(self, page: str, fixed: list[int], region: int):
        self.page, self.fixed, self.region = page, frozenset(fixed), region
        self.tree = Tree(page)
        self.match = Matcher(self.tree)


def induce(tree: Tree, counts: dict[int, tuple[int, int, int]]) -> tuple[list[int], int]:
    """The reference nodes that are template, and the one that holds the content
    (-1 if no node below the body does); ``counts`` has each node's pages, those
    of the same text, and text outside of links."""
    none = (0, 0, 0)
    total = sum(c[2] for c in counts.values())
    fixed = [i for i, (pages, same, _) in sorted(counts.items()) if pages >= PAGES and same >= CONSTANT * pages and tree.text(i)]
    mass = [counts.get(i, none)[2] for i in range(len(tree.nodes))]
    for i in fixed:
        mass[i] = 0
    if counts.get(0, none)[0] < PAGES or sum(mass) < VARIES * total:
        return [], -1
    for i in range(len(mass) - 1, 0, -1):
        mass[tree.up[i]] += mass[i]
    at = 0
    while True:
        below = [c for c in tree.below[at] if mass[c]]
        best = max(below, key=lambda c: mass[c], default=-1)
        if best < 0 or mass[best] < MAJOR * mass[at] or tree.nodes[best].tag in _PASSAGES:
            break
        if sum(_shape(tree.nodes[c]) == _shape(tree.nodes[best]) for c in below) > 1:
            break
        at = best
    return fixed, at if tree.nodes[at].tag not in ("#root", "html", "body") else -1


def _shape(n: Node) -> tuple[str, str]:
    found = re.search(r"class\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", n.attributes)
    return n.tag, found[1].strip("\"'") if found else ""


def apply(wrappers: list[Wrapper], page: str, marks: bool = True) -> str:
    """The page's text by its host's wrappers."""
    tree = Tree(page)
    template: set[int] = set()
    regions: list[int] | None = None
    for w in wrappers:
        if not w.fixed and w.region < 0:
            continue
        pairs = w.match(tree)
        template |= {j for i, j in pairs if i in w.fixed and w.tree.text(i) == tree.text(j)}
        region = next((j for i, j in pairs if i == w.region), None)
        if regions is None and region is not None:
            end = region + 1  # the region's nodes follow it
            while end < len(tree.nodes) and tree.up[end] >= region:
                end += 1
            beside = [j for i, j in pairs if tree.nodes[j].tag in ("h1", "h2") and i not in w.fixed and not region <= j < end]
            regions = sorted([region, *(j for j in beside if not marks or not _within_marked(tree, j))])
    return extract(page, frozenset(template), tree, regions, marks)


def _within_marked(tree: Tree, i: int) -> bool:
    while i >= 0:
        if _marked(tree.nodes[i]) or tree.nodes[i].tag == "header":
            return True
        i = tree.up[i]
    return False


# ---------------------------------------------------------------- operators

_STATS = pa.schema([("host", pa.string()), ("which", pa.int32()), ("node", pa.int32()), ("pages", pa.int64()), ("same", pa.int64()), ("mass", pa.int64())])
_WRAPPERS = pa.schema([("host", pa.string()), ("which", pa.int32()), ("html", pa.string()), ("fixed", pa.list_(pa.int32())), ("region", pa.int32())])
_OUT = pa.schema([("row_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
#: Columns of what streams through a task; ``which`` numbers wrappers, and is
#: ROW for pages.
_STREAM = ["which", "host", "page_id", "url", "html", "fixed", "region"]
ROW = 9
#: Hosts whose trees a task keeps.
HOSTS = 200


def _streamed(batches, known: dict | None):
    """Slices of pages, and a function that gives a host's wrappers: of the
    broadcast ones, or those that came just before."""
    trees: dict[str, list[Wrapper]] = {}
    last = ROW

    def wrappers(host: str | None) -> list[Wrapper]:
        if known is not None and host is not None and host not in trees and host in known:
            if len(trees) >= HOSTS:
                trees.clear()
            trees[host] = [Wrapper(*w) for w in known[host]]
        return trees.get(host, [])

    for b in text_slices(batches, 4):
        rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
        at = 0
        for k in range(len(rows) + 1):
            if k == len(rows) or rows[k][0] != ROW:
                if k > at:
                    yield rows[at:k], wrappers
                at = k + 1
                if k < len(rows):
                    which, host, _, _, page, fixed, region = rows[k]
                    if host not in trees or which <= last:  # a host or a share of it begins
                        trees.clear()
                    last = which
                    trees.setdefault(host, []).append(Wrapper(page, fixed or [], -1 if region is None else region))


def _align(sent):
    """Per reference node: on how many pages it was found, on how many with the
    same text, and their text outside of links; that of nodes without a partner
    counts for the nearest node above that has one."""

    def run(batches):
        found: dict[tuple, list[int]] = {}
        for rows, wrappers in _streamed(batches, sent and sent.value):
            for _, host, _, _, page, _, _ in rows:
                known = wrappers(host)
                if not page or not known:
                    continue
                tree = Tree(page)
                for which, w in enumerate(known):
                    if page == w.page:
                        continue
                    partner = [-1] * len(tree.nodes)
                    for i, j in w.match(tree):
                        partner[j] = i
                        c = found.setdefault((host, which, i), [0, 0, 0])
                        c[0] += 1
                        c[1] += w.tree.text(i) == tree.text(j)
                    for j in range(len(partner)):
                        if partner[j] < 0:
                            partner[j] = partner[tree.up[j]]
                        if mass := tree.own(j)[1]:
                            found[host, which, partner[j]][2] += mass
            if len(found) > 200_000:
                yield _stats(found)
                found = {}
        if found:
            yield _stats(found)

    return run


def _stats(found: dict) -> pa.RecordBatch:
    return batch(_STATS, *(list(c) for c in zip(*found, strict=True)), *(list(c) for c in zip(*found.values(), strict=True)))


def _induce(batches):
    """(host, which, html, counts): each reference with its wrapper."""
    for b in text_slices(batches, 2):
        rows = []
        for page, counts in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            rows.append(induce(Tree(page), {c["node"]: (c["pages"], c["same"], c["mass"]) for c in counts or []}))
        yield batch(_WRAPPERS, b.column(0), b.column(1), b.column(2), [r[0] for r in rows], [r[1] for r in rows])


def _extract(sent, marks: bool):
    def run(batches):
        for rows, wrappers in _streamed(batches, sent and sent.value):
            texts = [apply(wrappers(host), page, marks) if page else "" for _, host, _, _, page, _, _ in rows]
            yield batch(_OUT, [r[2] for r in rows], [r[3] for r in rows], texts, [len(t) for t in texts])

    return run


def _with_wrappers(pages: DataFrame, wrappers: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make(sent)`` over pages and their hosts' wrappers: sent to all tasks
    while they are small; else streamed before each share of a host's pages."""
    spark = pages.sparkSession
    size = wrappers.agg(F.sum(F.length("html") + 8 * F.size("fixed") + 64)).first()[0] or 0
    pages = pages.select(F.lit(ROW).alias("which"), "host", "page_id", "url", "html", F.lit(None).cast("array<int>").alias("fixed"), F.lit(None).cast("int").alias("region"))
    if size <= BROADCAST_BYTES:
        known: dict[str, list[tuple]] = {}
        for r in wrappers.orderBy("host", "which").toLocalIterator():
            known.setdefault(r.host, []).append((r.html, r.fixed, r.region))
        sent = spark.sparkContext.broadcast(known)
        return pages.select(*_STREAM).mapInArrow(make(sent), schema)
    counts = pages.where("host is not null").groupBy("host").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    bound = max(SHARE_PAGES, total // MOST_HEAVY)  # so few hosts are above it
    shares = counts.where(F.col("n") > bound).select("host", F.ceil(F.col("n") / bound).cast("int").alias("shares"))
    own = F.xxhash64("page_id", "url")
    dealt = pages.join(F.broadcast(shares), "host", "left")
    dealt = dealt.withColumn("share", F.when(F.col("host").isNull(), F.pmod(own, F.lit(1 << 20))).otherwise(F.pmod(own, F.coalesce("shares", F.lit(1)))).cast("int"))
    copies = wrappers.join(F.broadcast(shares), "host", "left")
    copies = copies.withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).withColumns({"page_id": F.lit(None).cast("long"), "url": F.lit(None).cast("string")})
    both = dealt.select(*_STREAM, "share").unionByName(copies.select(*_STREAM, "share"))
    return both.repartition("host", "share").sortWithinPartitions("host", "share", "which").select(*_STREAM).mapInArrow(make(None), schema)


def _references(pages: DataFrame) -> DataFrame:
    """host, which, html: one choice at any partitioning.  Each draw is the page
    of least hash under a seed, so equal pages count once; only numbers are
    aggregated, and html of the chosen pages alone."""
    pages = pages.withColumn("own", F.xxhash64("html"))
    one = [F.min(F.struct(F.xxhash64("own", F.lit(k)).alias("hash"), F.length("html").alias("size"), "own")) for k in range(DRAWS)]
    drawn = pages.groupBy("host").agg(F.sort_array(F.transform(F.array(*one), lambda r: F.struct(r["size"].alias("size"), r["own"].alias("own")))).alias("drawn"))
    chosen = materialize(drawn.select("host", F.posexplode(F.array_distinct(F.array(*[F.col("drawn")[k]["own"] for k in CHOSEN]))).alias("which", "own")), "chosen")
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    else:  # no html but the references' goes through the shuffle
        pages = only_members(pages, "own", chosen.select("own"))
    found = pages.join(chosen, ["host", "own"]).groupBy("host", "which").agg(F.min("html").alias("html"))
    return found.select("host", "which", "html", F.array().cast("array<int>").alias("fixed"), F.lit(-1).alias("region"))


def main_text(pages: DataFrame, marks: bool = True) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    ship(pages.sparkSession)
    pages = plain(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    pages = pages.withColumn("host", host)
    references = materialize(_references(pages.where("host is not null and html <> ''").select("host", "html")), "references")
    stats = _with_wrappers(pages, references, _align, "host string, which int, node int, pages long, same long, mass long")
    stats = stats.groupBy("host", "which", "node").agg(F.sum("pages").alias("pages"), F.sum("same").alias("same"), F.sum("mass").alias("mass"))
    counts = stats.groupBy("host", "which").agg(F.collect_list(F.struct("node", "pages", "same", "mass")).alias("counts"))
    induced = references.join(counts, ["host", "which"]).select("host", "which", "html", "counts").mapInArrow(_induce, "host string, which int, html string, fixed array<int>, region int")
    wrappers = materialize(induced.where("region >= 0 or size(fixed) > 0"), "wrappers")
    out = _with_wrappers(pages, wrappers, lambda sent: _extract(sent, marks), "row_id long, url string, text string, n_chars long")
    return out.withColumnRenamed("row_id", "page_id")
