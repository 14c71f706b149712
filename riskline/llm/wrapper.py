"""HTML extraction by wrapper induction.

Pages of a host are parsed into trees.  The trees of a bounded group of pages are aligned by
simple tree matching, in which equal texts weigh more, into a template that counts, for each
node, its pages and its commonest texts; templates of groups are merged the same way, level
by level, until a host has one.  Nodes whose text is constant over their pages are template.  A page's content is what is left of its article (or of its body
without one) after template nodes and elements that are by name or class menus, headers,
footers, sidebars, notices, adverts, forms or comments.  A class or id counts as a whole:
``has-sidebar`` or ``share-price`` only mention a role.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import staged

#: Pages, and templates, that one task aligns at a time.
GROUP = 64
#: A node is template if its text is the same in this share of its pages, at least MIN_PAGES.
CONSTANT, MIN_PAGES = 0.8, 2
#: Texts that a node of a template counts.  A text in over 1 / (TEXTS + 1) of the pages is
#: never lost, whatever the order of merging, and what its count may lack is known.
TEXTS = 8
#: Weight of a pair of nodes with the same text, more than what a shift of their siblings gains.
SAME = 1000
#: Pairs of siblings up to which lists are aligned by a table in plain Python, which is quicker for
#: them; longer lists are aligned alike by :class:`_Long`, in arrays.
PAIRS = 40000
#: Numbers that :class:`_Long` holds at a time, beside two rows for each halving of its table.
CELLS = 2_000_000
#: Calls in one another that lists in long lists may take, about ten for each of DEPTH levels.
CALLS = 3000

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "noscript", "iframe", "template", "svg")
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"html", "body", "title"}
DROP = set("aside button datalist dialog fieldset footer form head input label menu nav object option script select style noscript template textarea iframe svg".split())
DROP_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "sidebar sidebars sidenav menu menus nav navbar navigation breadcrumb breadcrumbs masthead header footer "
    "comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "newsletter subscribe subscription signup login register share sharing social related recommended recommendations widget widgets toolbar "
    "pagination pager search searchform copyright legal disclaimer skip hidden".split()
)
#: Words that may come before, and after, those of DROP_WORDS in a class or id that still names a role.
BEFORE = set("site page global top bottom left right main primary secondary post article js id and to us".split())
AFTER = set("left right top bottom primary secondary list item items box block container wrapper inner section area bar links link button buttons icons posts articles form group panel unit slot zone".split())
ROLES = set("navigation banner complementary contentinfo search dialog alertdialog alert form menu menubar toolbar".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())

#: Elements in one another; what is nested deeper becomes siblings of what it is nested in, text and all.
DEPTH = 120
#: Quoted values of a tag; a tag with more ends at its first ``>``.
QUOTES = 200

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_MARK = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANK = re.compile(r"\s+")


class Node:
    """An element; ``items`` holds its texts and elements in page order."""

    __slots__ = ("tag", "marks", "items")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.items = tag, marks, []


class _Scanner:
    """Tags of a page from left to right, each character looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.last = page, {c: page.rfind(c) for c in ">\"'"}

    def tag_end(self, at: int) -> int:
        """Where the tag that is open at ``at`` ends: its first ``>`` outside quotes, or its first one
        at all if a quote isn't closed; -1 if there is none."""
        if at > self.last[">"]:
            return -1
        pos = at
        for _ in range(QUOTES):
            stop = _STOP.search(self.page, pos)
            if stop is None:
                break
            if stop[0] == ">":
                return stop.start()
            if stop.start() >= self.last[stop[0]]:
                break
            pos = self.page.find(stop[0], stop.start() + 1) + 1
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, re.Match | None] | None:
        """(start, end, name) of the next comment, declaration (name None) or tag."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), None
            if page.startswith(("<!", "<?"), start):
                end = page.find(">", start)
                return start, end + 1 if end >= 0 else len(page), None
            name = _OPEN.match(page, start)
            if name and (end := self.tag_end(name.end())) >= 0:
                return start, end + 1, name
            if start > self.last[">"]:
                return None
            at = start + 1
        return None


def parse(page: str) -> Node:
    """A lenient tree of at most DEPTH levels: end tags close their nearest open element, a block
    closes an open p, li closes li; unknown end tags are ignored."""
    root = Node("#root")
    stack, at, n, scanner = [root], 0, len(page), _Scanner(page)
    while at < n:
        m = scanner.next(at)
        if m is None:
            stack[-1].items.append(page[at:])
            break
        start, end, name = m
        if start > at:
            stack[-1].items.append(page[at:start])
        at = end
        if name is None:
            continue
        tag = name[2].lower()
        if name[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            for k in range(len(stack) - 1, 0, -1):
                open_tag = stack[k].tag
                if open_tag == "p" or (open_tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    del stack[k:]
                    break
                if open_tag in BLOCK:
                    break
        own = page[name.end() : end - 1]
        found = _MARK.findall(own) if "=" in own else ()
        marks = " ".join(f"role={v}" if kind.lower() == "role" else v for kind, v in ((k, x or y or z) for k, x, y, z in found))
        node = Node(tag, marks)
        del stack[DEPTH:]
        stack[-1].items.append(node)
        if tag in VOID or own.endswith("/"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else n
            continue
        stack.append(node)
    return root


def _names_role(mark: str, inside: bool) -> bool:
    """Whether a class, id or role is as a whole the name of a menu, notice, advert, ..."""
    if mark.startswith("role="):
        return mark[5:].lower() in ROLES and not (inside and mark[5:].lower() == "banner")
    words = [w.lower() for w in _PARTS.findall(mark)]
    while words and words[-1] in AFTER and words[-1] not in DROP_WORDS:
        words.pop()
    if not words or words[-1] not in DROP_WORDS or (inside and words[-1] == "header"):  # as the element header
        return False
    return all(w in DROP_WORDS or w in BEFORE for w in words)


def is_boilerplate(node: Node, inside: bool) -> bool:
    if node.tag in DROP:
        return True
    if node.tag == "header":
        return not inside
    if node.marks and node.tag not in ("html", "body", "main") and node.tag not in HEADINGS:
        return any(_names_role(mark, inside) for mark in node.marks.split())
    return False


# --- templates ---------------------------------------------------------------------------


def _key(node: Node) -> str:
    return f"{node.tag}.{node.marks.split(' ')[0]}" if node.marks else node.tag


def skeleton(node: Node, key: str = "#root", elements: bool = False) -> list:
    """[key, pages, pages by text's digest, what a count may lack, children], and the element."""
    texts = [x.strip() for x in node.items if not isinstance(x, Node) and not x.isspace()]
    said = {hashlib.md5(" ".join(texts).encode("utf-8", "surrogatepass")).hexdigest()[:12]: 1} if texts else {}
    own = [key, 1, said, 0, [skeleton(x, _key(x), elements) for x in node.items if isinstance(x, Node)]]
    return [*own, node] if elements else own


def _plain(x: list, y: list) -> bool:
    """Whether two lists of children have the same keys, each once: then matching has no choice."""
    keys = [c[0] for c in x]
    return keys == [d[0] for d in y] and len(set(keys)) == len(keys)


def _weight(c: list, d: list) -> int:
    return 0 if c[0] != d[0] else (1 if c[2].keys().isdisjoint(d[2]) else SAME) + _score(c, d)


def _score(a: list, b: list) -> int:
    x, y = a[4], b[4]
    if not x or not y:
        return 0
    if _plain(x, y):
        return sum(_weight(c, d) for c, d in zip(x, y))
    return _Long(x, y).score() if len(x) * len(y) > PAIRS else _matching(x, y)[0]


def align(a: list, b: list) -> list:
    """Simple tree matching of the children of a and b: matched pairs of indices."""
    x, y = a[4], b[4]
    if _plain(x, y):
        return [(i, i) for i in range(len(x))]
    return _Long(x, y).pairs() if len(x) * len(y) > PAIRS else _matching(x, y)[1]


def _matching(x: list, y: list) -> tuple[int, list]:
    w = [[_weight(c, d) for d in y] for c in x]
    m = [[0] * (len(y) + 1)]
    for row in w:
        above, left, now = m[-1], 0, [0]
        for j, weight in enumerate(row):
            best = above[j] + weight if weight else 0
            if above[j + 1] > best:
                best = above[j + 1]
            if left > best:
                best = left
            now.append(best)
            left = best
        m.append(now)
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if w[i - 1][j - 1] and m[i][j] == m[i - 1][j - 1] + w[i - 1][j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif m[i][j] == m[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return m[-1][-1], pairs[::-1]


class _Long:
    """The alignment of :func:`_matching`, ties and all, for lists of any length.

    Nodes are told apart only by what counts for the other list: nodes of one kind have the same
    keys and, of the texts that the other list has at the same place, the same ones.  ``most`` is
    what a node of a kind can weigh at most.  A cell of the table whose rows and columns before
    and after it cannot reach the best score is left out; a row is one array, and of the rows
    only as many are held as CELLS allows, the others are computed again on the way back.
    """

    def __init__(self, x: list, y: list):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), CALLS))
        self.paths: dict = {}  # (path of the parent, key): path
        self.kinds: dict = {}  # (path, texts, kinds of the children): kind
        self.node: list = []  # of a kind: a node with these texts and children only
        self.path, self.below, self.bare, self.most, self.plain = [], [], [], [], []
        self.known: dict = {}
        said_x: dict = {}
        said_y: dict = {}
        self._texts(x, 0, said_x)
        self._texts(y, 0, said_y)
        kinds_x = [self._kind(c, 0, said_y) for c in x]
        self.y = [self._kind(d, 0, said_x) for d in y]
        self.index = [i for i, k in enumerate(kinds_x) if k >= 0]
        self.x = [kinds_x[i] for i in self.index]
        # Equal ends weigh the most that either can: matched, as on the way back through the table.
        self.tail: list = []
        self.tail_score = 0
        while self.x and self.y and self.x[-1] == self.y[-1]:
            self.tail_score += self.most[self.x.pop()]
            self.y.pop()
            self.tail.append((self.index[len(self.x)], len(self.y)))
        self.most_x = np.cumsum([0, *[self.most[k] for k in self.x]])
        self.most_y = np.cumsum([0, *[self.most[k] if k >= 0 else 0 for k in self.y]])
        self.top = int(min(self.most_x[-1], self.most_y[-1]))
        self.number = np.int32 if self.top < 1 << 30 else np.int64
        self.none = -(1 << 30) if self.top < 1 << 30 else -(1 << 62)
        self.shape = np.array([self.bare[k] if k >= 0 else -1 for k in self.y], np.int64)
        self.shapes, self.which = np.unique(self.shape, return_inverse=True)
        at: dict = {}
        for j, k in enumerate(self.y):
            for spot in self._said(k) if k >= 0 else ():
                at.setdefault(spot, []).append(j)
        self.at = {spot: np.array(js) for spot, js in at.items()}
        self.rows: dict = {}  # of a kind without texts: its weights with all of y, -1 while not asked for
        self.unasked: dict = {}  # how many shapes that is
        self.having: dict = {}

    def _texts(self, nodes: list, parent: int, out: dict) -> None:
        for c in nodes:
            path = self.paths.setdefault((parent, c[0]), len(self.paths) + 1)
            out.setdefault(path, set()).update(c[2])
            self._texts(c[4], path, out)

    def _kind(self, c: list, parent: int, other: dict) -> int:
        path = self.paths[parent, c[0]]
        if path not in other:
            return -1
        below = [k for d in c[4] if (k := self._kind(d, path, other)) >= 0]
        return self._intern(c[0], path, frozenset(c[2].keys() & other[path]), tuple(below))

    def _intern(self, key: str, path: int, texts: frozenset, below: tuple) -> int:
        k = self.kinds.get((path, texts, below))
        if k is not None:
            return k
        blank = tuple(self.bare[b] for b in below)
        bare = self._intern(key, path, frozenset(), blank) if texts or blank != below else len(self.node)
        k = self.kinds[path, texts, below] = len(self.node)
        self.node.append([key, 1, dict.fromkeys(texts, 1), 0, [self.node[b] for b in below]])
        self.path.append(path)
        self.below.append(below)
        self.bare.append(bare)
        self.most.append((SAME if texts else 1) + sum(self.most[b] for b in below))
        self.plain.append(len({self.path[b] for b in below}) == len(below) and all(self.plain[b] for b in below))
        return k

    def _said(self, kind: int) -> list:
        """(path, text) of all texts in a node of the kind; only nodes with one of them in common
        weigh more than their keys do."""
        if kind == self.bare[kind]:
            return []
        found, todo = set(), [(self.path[kind], self.node[kind])]
        while todo:
            path, c = todo.pop()
            found.update((path, said) for said in c[2])
            todo += [(self.paths[path, d[0]], d) for d in c[4]]
        return sorted(found)

    def _pair(self, k: int, t: int) -> int:
        if k == t:
            return self.most[k]
        if (k, t) not in self.known:
            if len(self.known) > 1 << 20:
                self.known.clear()
            self.known[k, t] = _weight(self.node[k], self.node[t])
        return self.known[k, t]

    def _weights(self, k: int, a: int, b: int) -> np.ndarray:
        """Weights of a node of kind k with those at a..b of the other list."""
        bare = self.bare[k]
        if bare not in self.rows:
            if len(self.rows) * len(self.y) > CELLS:
                self.rows.clear()
            first = {t: self.most[t] if t == bare else -1 for t in self.shapes.tolist() if t >= 0 and self.path[t] == self.path[bare]}
            self.rows[bare] = np.array([first.get(t, 0) for t in self.shapes.tolist()], self.number)[self.which]
            self.unasked[bare] = sum(t < 0 for t in first.values())
        w = self.rows[bare][a:b]
        if k == bare and not self.unasked[bare]:
            return w
        w = w.copy()
        if k != bare:
            self._add_texts(w, k, a, b)
        while self.unasked[bare] and len(open_ := np.flatnonzero(w < 0)):  # asked for only here: nested lists are long to match
            n = self.which[a + open_[0]]
            found, there = self._pair(bare, int(self.shapes[n])), self.which == n
            self.rows[bare][there] = found
            self.unasked[bare] -= 1
            w[there[a:b] & (w < 0)] = found
        return w

    def _add_texts(self, w: np.ndarray, k: int, a: int, b: int) -> None:
        """Set the weights of nodes that have a text in common with one of kind k."""
        bare, odd = self.bare[k], []
        for _, spots in groupby(self._said(k), lambda spot: spot[0]):
            spots = [spot for spot in spots if spot in self.at]
            if not self.plain[bare]:
                odd += [(spot, self._within(self.at[spot], a, b)) for spot in spots]
            elif spots:  # where the keys leave no choice, each text in common adds its weight
                js = self._within(np.unique(np.concatenate([self.at[spot] for spot in spots])) if len(spots) > 1 else self.at[spots[0]], a, b)
                alike = self.shape[js] == bare
                w[js[alike] - a] += SAME - 1
                odd += [(spot, js[~alike]) for spot in spots if not alike.all()]
        if not odd:
            return
        if len(odd) > 60 or self.plain[bare]:
            for j in set(np.concatenate([js for _, js in odd]).tolist()):
                w[j - a] = self._pair(k, self.y[j])
            return
        # Nodes that have the same texts in common with this one differ only in where they have them.
        common = np.zeros(b - a, np.int64)
        for n, (_, js) in enumerate(odd):
            common[js - a] |= 1 << n
        touched = np.flatnonzero(common)
        which, group = np.unique(common[touched], return_inverse=True)
        order, ends = np.argsort(group, kind="stable"), np.cumsum(np.bincount(group, minlength=len(which)))
        for bits, js in zip(which.tolist(), np.split(touched[order], ends[:-1])):
            if len(js) < 4:
                w[js] = [self._pair(k, self.y[j + a]) for j in js.tolist()]
                continue
            spots = frozenset(spot for n, (spot, _) in enumerate(odd) if bits >> n & 1)
            having, kinds = self._reduced(spots)
            these, place = np.unique(kinds[having.searchsorted(js + a)], return_inverse=True)
            own = self._only(k, spots)
            w[js] = np.array([self._pair(own, int(t)) for t in these], self.number)[place]

    @staticmethod
    def _within(js: np.ndarray, a: int, b: int) -> np.ndarray:
        return js[js.searchsorted(a) : js.searchsorted(b)]

    def _only(self, kind: int, spots: frozenset) -> int:
        """The kind without its other texts."""
        if kind == self.bare[kind]:
            return kind
        c, path = self.node[kind], self.path[kind]
        return self._intern(c[0], path, frozenset(said for said in c[2] if (path, said) in spots), tuple(self._only(k, spots) for k in self.below[kind]))

    def _reduced(self, spots: frozenset) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of the other list that have all of these texts, and their kinds without others."""
        if spots not in self.having:
            if sum(len(js) for js, _ in self.having.values()) > CELLS:
                self.having.clear()
            js = functools.reduce(lambda x, y: np.intersect1d(x, y, assume_unique=True), [self.at[spot] for spot in spots])
            self.having[spots] = js, np.array([self._only(self.y[j], spots) for j in js.tolist()], np.int64)
        return self.having[spots]

    def _bounds(self, least: int) -> tuple[list, list]:
        """First and last cell of each row through which a score of ``least`` is possible."""
        lo = self.most_y.searchsorted(least - (self.most_x[-1] - self.most_x), "left")
        hi = self.most_y.searchsorted(self.most_y[-1] - least + self.most_x, "right") - 1
        return lo.tolist(), hi.tolist()

    def _sweep(self, row: np.ndarray, start: int, stop: int, end: int, lo: list, hi: list) -> Iterator[np.ndarray]:
        """The rows after ``start``, whose cells are ``row``, up to ``stop``, as far as column ``end``."""
        for i in range(start + 1, stop + 1):
            a, b, c, d = lo[i - 1], min(hi[i - 1], end), lo[i], min(hi[i], end)
            new = np.full(d - c + 1, self.none, self.number)
            e = min(b, d)
            if c <= e:
                new[: e - c + 1] = row[c - a : e - a + 1]
            f, g = max(c, a + 1), min(d, b + 1)
            if f <= g:
                part = new[f - c : g - c + 1]
                np.maximum(part, row[f - 1 - a : g - a] + self._weights(self.x[i - 1], f - 1, g), out=part)
            row = np.maximum.accumulate(new, out=new)
            yield row

    def _first(self, lo: list, hi: list) -> np.ndarray:
        return np.zeros(hi[0] - lo[0] + 1, self.number)

    def _best(self) -> int:
        """The best score but for the tail.  A score no less than the bound that cells were left
        out by is the best one; else the bound is lowered."""
        if not self.x or not self.y:
            return 0
        gap, least = self.top // 256 + 1, self.top
        while True:
            least = max(least, self.top - gap)
            lo, hi = self._bounds(least)
            got = -1
            if all(a <= b for a, b in zip(lo, hi)):
                for row in self._sweep(self._first(lo, hi), 0, len(self.x), len(self.y), lo, hi):
                    pass
                got = int(row[-1])
            if got >= least:
                return got
            gap, least = 4 * gap, max(got, 0)

    def score(self) -> int:
        return self._best() + self.tail_score

    def pairs(self) -> list:
        found: list = []
        if self.x and self.y:
            lo, hi = self._bounds(self._best())
            self._back(self._first(lo, hi), 0, len(self.x), len(self.y), lo, hi, found)
        return [(self.index[i], j) for i, j in found[::-1]] + self.tail[::-1]

    def _back(self, row: np.ndarray, start: int, stop: int, j: int, lo: list, hi: list, found: list) -> int:
        """Pairs on the way back from cell (stop, j) to the row ``start``, whose cells are ``row``;
        returns the column it comes to."""
        row = row[: min(hi[start], j) - lo[start] + 1]
        if stop - start > 1 and sum(min(hi[i], j) - lo[i] + 1 for i in range(start, stop + 1)) > CELLS:
            middle = (start + stop) // 2
            for half in self._sweep(row, start, middle, j, lo, hi):
                pass
            j = self._back(half, middle, stop, j, lo, hi, found)
            del half
            return self._back(row, start, middle, j, lo, hi, found)
        rows = [row, *self._sweep(row, start, stop, j, lo, hi)]
        i = stop
        while i > start and j:
            here, above, a = rows[i - start][j - lo[i]], rows[i - 1 - start], lo[i - 1]
            weight = self._pair(self.x[i - 1], self.y[j - 1]) if self.y[j - 1] >= 0 else 0
            if weight and 0 <= j - 1 - a < len(above) and here == above[j - 1 - a] + weight:
                i, j = i - 1, j - 1
                found.append((i, j))
            elif 0 <= j - a < len(above) and here == above[j - a]:
                i -= 1
            else:
                j -= 1
        return j


def _counted(a: dict, b: dict) -> tuple[dict, int]:
    """The sum of two counts of texts, at most TEXTS of them, and what was taken off each."""
    both = dict(a)
    for said, n in b.items():
        both[said] = both.get(said, 0) + n
    if len(both) <= TEXTS:
        return both, 0
    off = sorted(both.values(), reverse=True)[TEXTS]
    return {said: n - off for said, n in both.items() if n > off}, off


def merge(a: list, b: list) -> list:
    """Template a with b aligned into it."""
    texts, off = _counted(a[2], b[2])
    children, i, j = [], 0, 0
    for p, q in [*align(a, b), (len(a[4]), len(b[4]))]:
        children += a[4][i:p] + b[4][j:q]
        if p < len(a[4]) and q < len(b[4]):
            children.append(merge(a[4][p], b[4][q]))
        i, j = p + 1, q + 1
    return [a[0], a[1] + b[1], texts, a[3] + b[3] + off, children]


def settled(template: list, pages: int | None = None) -> list | None:
    """The template with its constant texts only, and the nodes that lead to them.

    A node with a class or id that is alone with it among its siblings is asked about the
    pages that have it.  Any other may be one of a list that differs in length, whose end only
    a few near copies reach: it is asked about the pages that have its parent."""
    key, own, texts, lacks, below = template
    pages = own if pages is None else pages
    keys = Counter(c[0] for c in below)
    said = {d: n for d, n in texts.items() if n >= MIN_PAGES and n + lacks >= CONSTANT * pages}
    kept = [k for c in below if (k := settled(c, c[1] if "." in c[0] and keys[c[0]] == 1 else own))]
    return [key, own, said, lacks, kept] if said or kept else None


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [json.dumps(t) if (t := settled(json.loads(x.as_py()))) else None for x in batch.column("template")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(done, pa.string())], names=["host", "template"])


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [json.dumps(skeleton(parse(page.as_py()))) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(trees, pa.string())], names=["host", "template"])


def _reduce(table: pa.Table) -> pa.Table:
    done = None
    for t in sorted(table.column("template").to_pylist()):  # the same template in every run
        one = json.loads(t)
        done = one if done is None else merge(done, one)
    return _as_row(table, done)


def _as_row(table: pa.Table, template: list) -> pa.Table:
    return pa.table([pa.array([table.column("host")[0].as_py()], pa.string()), pa.array([table.column("part")[0].as_py()], pa.int64()), pa.array([json.dumps(template)], pa.string())], names=["host", "part", "template"])


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def induce(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """(host, template) from pages (host, html).  A task aligns about ``group`` trees or
    templates at a time, so that a host of any size spreads over many tasks.  Pages of one
    tree with the same texts, which exact copies are, count once."""
    trees = staged(pages.mapInArrow(_skeletons, "host string, template string").distinct(), "trees")
    shape = "host string, part long, template string"
    sizes = trees.groupBy("host").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("template"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / group)))
    level = trees.join(sizes, "host").select("host", part.alias("part"), "template")
    while True:
        level = staged(level.groupBy("host", "part").applyInArrow(_reduce, shape), "templates")
        if (level.groupBy("host").count().agg(F.max("count")).first()[0] or 0) <= 1:
            return staged(level.select("host", "template").mapInArrow(_settle, "host string, template string"), "settled")
        level = level.select("host", F.floor(F.col("part") / group).alias("part"), "template")


# --- content -----------------------------------------------------------------------------


def constant_nodes(page: Node, template: list | None) -> set[int]:
    """ids of the page's elements whose node of the settled template has their text.

    Paragraphs (p) beside varying ones in an article are its text, whatever other pages say."""
    found: set[int] = set()
    if template is None:
        return found

    def walk(a: list, t: list, article: bool) -> bool:
        same = not a[2].keys().isdisjoint(t[2])
        if same:
            found.add(id(a[5]))
        article = article or a[5].tag in ("article", "main")
        plain = [id(a[4][i][5]) for i, j in align(a, t) if walk(a[4][i], t[4][j], article) and t[4][j][0] == "p"]
        if article and len(plain) < sum(c[0] == "p" for c in a[4]):
            found.difference_update(plain)
        return same

    walk(skeleton(page, elements=True), template, False)
    return found


def _length(node: Node) -> int:
    return sum(_length(x) if isinstance(x, Node) else len(x) for x in node.items)


def _articles(node: Node, tag: str, whole: bool, out: list) -> None:
    """(parent, article) of the outermost articles."""
    for x in node.items:
        if isinstance(x, Node) and (whole or not is_boilerplate(x, True)):
            if x.tag == tag:
                out.append((node, x))
            else:
                _articles(x, tag, whole, out)


def content(page: str, template: list | None = None) -> str:
    root = parse(page)
    constant = constant_nodes(root, template)
    tops, inside = [root], False
    # An article within a menu, advert, ... counts if there is no other: what holds it stays.
    for tag, whole in (("article", False), ("main", False), ("article", True), ("main", True)):
        found: list = []
        _articles(root, tag, whole, found)
        if found:
            # the longest one, and the others of its parent: a text in several articles
            parent = max(found, key=lambda f: _length(f[1]))[0]
            tops, inside = [x for p, x in found if p is parent], True
            break
    whole_length = sum(map(_length, tops))
    blocks: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = _BLANK.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            blocks.append(text)

    def walk(node: Node) -> None:
        drop_own = id(node) in constant
        for x in node.items:
            if isinstance(x, Node):
                if x.tag == "br":
                    held.append(" ")
                elif not is_boilerplate(x, inside) or (x.tag == "form" and 2 * _length(x) > whole_length):
                    # a form round most of the text is the page's frame, no form
                    if x.tag in BLOCK:
                        close()
                        walk(x)
                        close()
                    else:
                        walk(x)
            elif not drop_own:
                held.append(x)

    for top in tops:
        walk(top)
        close()
    return "\n\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    for batch in batches:
        texts = []
        for page, host, template in zip(batch.column("html"), batch.column("host").to_pylist(), batch.column("template")):
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                t = template.as_py()
                known[host] = json.loads(t) if t else None
            texts.append(content(page.as_py(), known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Null and empty html give an empty text.  Pages of a null url, or one without a host, share
    the host ''.  A page alone in its host has no template; it loses only what is
    boilerplate by name.  Repeated rows get equal texts.  Other columns are ignored.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"),
    )
    # At rest, the templates' size is known: Spark broadcasts them if they are small, else it
    # joins by host and splits large hosts.
    templates = induce(rows.select("host", "html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.join(templates, "host", "left").mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
