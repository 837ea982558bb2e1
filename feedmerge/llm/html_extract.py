"""Main text of web pages by wrapper induction over the pages of a host.

Pages of one host are parsed into DOM trees. The tree of elements that may hold content, without
repeated siblings, is the shape of a page, and one page of every shape is aligned by simple tree
matching: the matching of two trees with equal labels is one plus the best in-order matching of
their children. A shape is aligned to the layout template it matches best, which gets the nodes
it lacks; if less than ``ALIKE`` of its nodes match, it begins a template of its own. Over all
distinct pages of the host it is counted how many have a block of text at a place and how many have the same
text there. A text that is the same on most pages that have the place is constant; the rest varies. The wrapper
of a host is the set of constant texts by their place, and for each layout the place whose slots
hold most of the varying text.

A page's content is the element at a content place of its host's wrapper; an ``article`` (or ``main``)
is taken first only among the places of a layout that all hold most of its varying text. A page without
such a place, as its host has too few pages or its text lies in no one element, falls back to its
own ``article``, else ``main``, else body. From the content come all blocks, except
subtrees whose element, role or class says that they are menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles or reader comments, and except constant
texts, inside articles too. A page whose texts are all constant keeps them. Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined with line feeds in page order; nothing else is
dropped.

A host of more than ``TOGETHER`` shapes is aligned in rounds, as many tasks at once as it takes: shapes that share
the smallest hash of their labels meet, at most about ``TOGETHER`` in a task, and the templates that come out meet again
under another hash, until a round merges less than ``SHRINK`` of them. Each round is linear in
the shapes. What rounds leave apart are layouts of their own.

The wrapper is fitted on all pages of a host, whatever their size and depth, and each page counts once
however often it is repeated. A host of fewer than ``LEAST_PAGES`` distinct pages has no wrapper, nor has a layout with fewer.
Every page is extracted whole. Null and empty
html give empty text; a null or unparsable url belongs to the host ''.
Rows with equal ids are extracted one by one.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, sliced

LEAST_PAGES = 3
CONSTANT = 0.6
CONTENT = 0.7
#: Share of matched nodes from which a page is of a template's layout.
ALIKE = 0.8
#: Shapes that one task aligns, and the share of templates that a round has to merge for another one.
TOGETHER = 128
SHRINK = 0.05

# Element names of the HTML standard by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math object q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "annotation maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: Start tags that end an open element of the same kind, and what that search stops at.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}
SKIP_TAGS = frozenset(
    "head nav footer aside form button select option textarea input script style noscript template iframe svg embed "
    "canvas audio video menu title link meta search".split()
)
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
SKIP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "sidebar aside header masthead topbar footer "
    "cookie cookies consent notice gdpr popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus reply replies respond".split()
)

#: Words beside which those above don't name the element's role.
QUALIFIERS = frozenset("has with no without not".split())
#: Words with which a header is that of an article.
OF_ARTICLE = frozenset("article post entry story content".split())
#: Last words of a name that say where or in what an element is, but not what it is.
NEUTRAL = frozenset("area bar block box bottom column container content group holder inner item left list outer right section slot top unit widget wrap wrapper".split())
#: Elements that mark content themselves, and blocks that are content but not its place.
MARKS = ("article", "main")
LEAVES = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 hr pre blockquote address summary legend caption figcaption".split())
#: Lines that belong to the text after them.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th".split())
OUTERMOST = ("#root", "html", "body")
NEVER_SKIP = frozenset("html body main".split())
#: Headings and text blocks, whose ids are made from their text.
TEXT_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th tr table caption blockquote pre figure figcaption".split())

TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[!?][^>]*>)", re.S)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"[0-9]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    __slots__ = ("tag", "label", "children", "skip")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.label, self.skip = tag, tag, tag in SKIP_TAGS
        self.children: list = []
        if attrs and not attrs.isspace():
            for m in ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "class":
                    self.label = f"{tag}.{DIGITS.sub('', value)}" if tag not in NEVER_SKIP else tag
                if name in ("class", "id"):
                    judged = tag != "article" and not (name == "id" and tag in TEXT_BLOCKS)
                    self.skip |= judged and names_boilerplate(value)
                elif name == "role":
                    self.skip |= value.lower() in SKIP_ROLES
                else:
                    self.skip |= name == "hidden" or value == "true"
            self.skip &= tag not in NEVER_SKIP


def names_boilerplate(value: str) -> bool:
    """Whether a class or id says that its element is not content.

    Each name is judged by itself: by its last word, or the last before words like ``wrapper``.
    """
    for name in value.split():
        words = [w.lower() for w in TOKEN.findall(name)]
        while len(words) > 1 and words[-1] in NEUTRAL:
            words.pop()
        if words and words[-1] in SKIP_WORDS and QUALIFIERS.isdisjoint(words) and not (words[-1] == "header" and OF_ARTICLE.intersection(words)):
            return True
    return False


def parse(text: str) -> Node:
    """The DOM tree of a page; text children are decoded strings."""
    root = Node("#root")
    stack = [root]
    at, end = 0, len(text)
    while at < end:
        m = TAG.search(text, at)
        stop = m.start() if m else end
        if stop > at:
            stack[-1].children.append(html.unescape(text[at:stop]))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P:
            _close(stack, ("p",), ("table", "td", "th", "button", "object"))
        elif tag in IMPLIED:
            _close(stack, *IMPLIED[tag])
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(text, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def _close(stack: list[Node], ends: tuple[str, ...], stops: tuple[str, ...]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in ends:
            del stack[k:]
            return
        if stack[k].tag in stops:
            return


def squeeze(text: str) -> str:
    return SPACE.sub(" ", text).strip()


class Slot:
    """A template node: its label and its aligned children."""

    __slots__ = ("label", "children")

    def __init__(self, label: str):
        self.label, self.children = label, []

    @classmethod
    def of(cls, node: Node) -> Slot:
        slot = cls(node.label)
        todo = [(slot, node)]
        while todo:
            parent, x = todo.pop()
            for c in elements(x):
                parent.children.append(cls(c.label))
                todo.append((parent.children[-1], c))
        return slot


def number(text: str) -> int:
    """64 bits of a digest, never one of the small numbers that mark other rows."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) | 1 << 8


@functools.lru_cache(1 << 16)
def step(path: int, label: str) -> int:
    """The number of the path that goes on from another to a child."""
    return number(f"{path}>{label}")


def constant_key(path: int, text: str) -> int:
    return number(f"{path} {text}")


def elements(node: Node) -> list[Node]:
    return [c for c in node.children if not isinstance(c, str) and c.tag not in RAW]


def matching(a, b, memo: dict) -> int:
    """Simple tree matching of a template slot and a page node, by shape."""
    if a.label != b.label:
        return 0
    key = memo["of_slot"][id(a)], memo["of_node"][id(b)]
    if key not in memo["pairs"]:
        memo["pairs"][key] = 1 + best(a.children, elements(b), memo)[-1][-1]
    return memo["pairs"][key]


def best(xs: list, ys: list, memo: dict) -> list[list[int]]:
    """Scores of the best in-order matching of the first i slots with the first j nodes."""
    table = [[0] * (len(ys) + 1)]
    for x in xs:
        row, above = [0], table[-1]
        for j, y in enumerate(ys):
            row.append(max(row[j], above[j + 1], above[j] + matching(x, y, memo)))
        table.append(row)
    return table


def align(slot: Slot, node: Node, memo: dict) -> None:
    """Let a page's node be aligned with its slot, children by children; add what is missing."""
    todo = [(slot, node)]
    while todo:
        slot, node = todo.pop()
        xs, ys = slot.children, elements(node)
        table = best(xs, ys, memo)
        i, j, merged = len(xs), len(ys), []
        while i or j:
            if i and j and (w := matching(xs[i - 1], ys[j - 1], memo)) and table[i][j] == table[i - 1][j - 1] + w:
                todo.append((xs[i - 1], ys[j - 1]))
                merged.append(xs[i - 1])
                i, j = i - 1, j - 1
            elif j and table[i][j] == table[i][j - 1]:
                merged.append(Slot.of(ys[j - 1]))
                j -= 1
            else:
                merged.append(xs[i - 1])
                i -= 1
        slot.children = merged[::-1]


def _shapes(root, children, out: dict, shapes: dict) -> None:
    """Shape numbers of all nodes below ``root``, children first."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += children(x)
    for x in reversed(order):
        key = (x.label, tuple(out[id(c)] for c in children(x)))
        out[id(x)] = shapes.setdefault(key, len(shapes))


class Page:
    """The lines of a page: texts cut where block elements begin and end.

    ``tag``, ``label``, ``path``, ``up`` and ``home`` describe its block elements, parents first:
    ``up`` is the parent and ``home`` the innermost element, itself or above, that may hold content.
    ``lines`` are pairs of a block element and a text.
    """

    def __init__(self, root: Node):
        self.tag, self.label, self.path, self.up, self.home = [root.tag], [root.label], [0], [-1], [0]
        self.lines: list[tuple[int, str]] = []
        line: list[str] = []

        def flush(at: int, dead: bool):
            text = squeeze("".join(line))
            if text and not dead:
                self.lines.append((at, text))
            line.clear()

        # dead: inside a header that is not of an article or main
        todo: list = [(c, 0, False, False, True) for c in reversed(root.children)]
        while todo:
            x, at, marked, dead, opening = todo.pop()
            if isinstance(x, str):
                line.append(x)
                continue
            if not opening:
                # ``at`` is the element that ends
                flush(at, dead)
                continue
            inline = x.tag in INLINE
            if x.skip:
                if not inline:
                    flush(at, dead)
                continue
            if x.tag == "br":
                line.append(" ")
                continue
            inner, kept = at, dead
            if not inline:
                flush(at, dead)
                marked = marked or x.tag in MARKS
                kept = not marked and (dead or x.tag == "header")
                inner = len(self.tag)
                self.tag.append(x.tag)
                self.label.append(x.label)
                self.path.append(step(self.path[at], x.label))
                self.up.append(at)
                self.home.append(inner if self.home[at] == at and x.tag not in LEAVES else self.home[at])
                todo.append((x, inner, marked, kept, False))
            todo += [(c, inner, marked, kept, True) for c in reversed(x.children)]
        flush(0, False)

    def skeleton(self) -> str:
        """The elements that may hold content, those of one path once, as JSON: parent and label."""
        seen: dict[int, int] = {}
        out = []
        for i, (path, label) in enumerate(zip(self.path, self.label)):
            if self.home[i] == i and path not in seen:
                seen[path] = len(out)
                out.append([seen[self.path[self.up[i]]] if i else -1, label])
        return json.dumps(out, separators=(",", ":"))

    def facts(self) -> list[tuple[int, int, int, int]]:
        """(path, key, home, chars): of each line and, with key 0, of each element with lines."""
        chars: dict[tuple[int, int], list[int]] = {}
        for at, text in self.lines:
            path = self.path[at]
            for key in (0, constant_key(path, text)):
                chars.setdefault((path, key), [self.path[self.home[at]], 0])[1] += len(text)
        return [(path, key, home, n) for (path, key), (home, n) in chars.items()]

    def within(self, path: int, other: int) -> bool:
        """Whether elements of a path lie in those of another."""
        i = self.up[self.path.index(path)]
        while i >= 0 and self.path[i] != other:
            i = self.up[i]
        return i >= 0

    def below(self, roots: list[int], kept: list[bool]) -> list[str]:
        """The texts of the kept lines inside some of the elements."""
        inside = [False] * len(self.tag)
        for i in roots:
            inside[i] = True
        for i, up in enumerate(self.up):
            inside[i] = inside[i] or (up >= 0 and inside[up])
        return [text for (at, text), k in zip(self.lines, kept) if k and inside[at]]


def tree(skeleton: str) -> Node:
    nodes: list[Node] = []
    for up, label in json.loads(skeleton):
        node = Node(label.split(".")[0])
        node.label = label
        nodes.append(node)
        if up >= 0:
            nodes[up].children.append(node)
    return nodes[0]


def size_of(root) -> tuple[int, int]:
    """The nodes of a tree, and how many of them every page has."""
    n, outer, todo = 0, 0, [root]
    while todo:
        x = todo.pop()
        n += 1
        outer += x.label in OUTERMOST
        todo += x.children
    return n, outer


def labels_of(root) -> Counter:
    found, todo = Counter(), [root]
    while todo:
        x = todo.pop()
        found[x.label] += 1
        todo += x.children
    return found


def templates(shapes: list[tuple[str, int]]) -> list[list]:
    """[template, pages] of each layout: skeletons aligned to the template they match best."""
    out: list[list] = []
    # labels of each template, how many nodes it has and how many of them every page has
    known: list[tuple[Counter, int, int]] = []
    for skeleton, pages in sorted(shapes, key=lambda s: (-s[1], s[0])):
        node = tree(skeleton)
        labels, (size, outer) = labels_of(node), size_of(node)
        # a chain of one element in another is matched in one call below another
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 3 * size + 1000))
        found, near = None, ALIKE
        for i, layout in enumerate(out):
            theirs, whole, common = known[i]
            # against the smaller of the two, as a template holds what only some pages have
            least = min(size - outer, whole - common)
            alike_at = lambda n: (n - min(outer, common)) / least if least else float(size - outer == whole - common)  # noqa: E731, B023
            # no more nodes match than have a label in common
            if alike_at((theirs & labels).total()) <= near:
                continue
            memo: dict = {"shapes": {}, "pairs": {}, "of_slot": {}, "of_node": {}}
            _shapes(layout[0], lambda s: s.children, memo["of_slot"], memo["shapes"])
            _shapes(node, elements, memo["of_node"], memo["shapes"])
            alike = alike_at(matching(layout[0], node, memo))
            if alike > near:
                found, near, used = i, alike, memo
        if found is None:
            out.append([Slot.of(node), pages])
            known.append((labels, size, outer))
        else:
            align(out[found][0], node, used)
            out[found][1] += pages
            known[found] = (labels_of(out[found][0]), *size_of(out[found][0]))
    return out


def flat(root: Slot) -> str:
    """A template as JSON: parent and label of its slots, parents first."""
    out, todo = [], [(root, -1)]
    while todo:
        slot, up = todo.pop()
        out.append([up, slot.label])
        todo += [(c, len(out) - 1) for c in reversed(slot.children)]
    return json.dumps(out, separators=(",", ":"))


def place_of(template: Slot, pages: int, homes: dict[int, tuple[int, int]]) -> int | None:
    """The place of a layout whose slots hold most of the varying text.

    ``homes``: the varying characters of each path and the pages that have it. The places
    that hold ``CONTENT`` of the text lie in each other; an article among them goes first,
    then a main, then the innermost.
    """
    up: dict[int, int] = {}
    kind: dict[int, str] = {}
    depth: dict[int, int] = {}
    todo = [(template, 0, -1, 0)]
    while todo:
        slot, path, above, d = todo.pop()
        if path not in depth:
            up[path], kind[path], depth[path] = above, slot.label.split(".")[0], d
        todo += [(c, step(path, c.label), path, d + 1) for c in slot.children]
    weight: dict[int, float] = dict.fromkeys(depth, 0.0)
    order = sorted(depth, key=lambda p: (-depth[p], p))
    for path in order:
        chars, holders = homes.get(path, (0, 0))
        weight[path] += chars / max(holders, pages)
        if path:
            weight[up[path]] += weight[path]
    if not weight[0]:
        return None
    deep = [p for p in order if weight[p] >= CONTENT * weight[0] * (1 - 1e-9)]
    place = min(deep, key=lambda p: (MARKS.index(kind[p]) if kind[p] in MARKS else len(MARKS), -depth[p]))
    return None if kind[place] in OUTERMOST else place


def wrapper_of(layouts: list[tuple[Slot, int]], facts: list[tuple[int, int, int, int, int]]) -> dict:
    """The wrapper from the layouts and from (path, key, home, chars, pages) of a host's pages."""
    holders = {path: n for path, key, _, _, n in facts if not key}
    constant = set()
    homes: dict[int, tuple[int, int]] = {}
    for path, key, home, chars, n in facts:
        fixed = key and n >= max(LEAST_PAGES, CONSTANT * holders[path])
        if fixed:
            constant.add(key)
        if fixed or not key:
            sum_, most = homes.get(home, (0, 0))
            homes[home] = (sum_ - chars, most) if key else (sum_ + chars, max(most, n))
    places = [place_of(t, n, homes) for t, n in layouts if n >= LEAST_PAGES]
    return {"constant": sorted(constant), "content": sorted({p for p in places if p is not None})}


def induce(pages: list[str]) -> dict:
    """The wrapper of a host: keys of constant texts by place, and the places of the content."""
    shapes: dict[str, int] = {}
    facts: dict[tuple[int, int], list[int]] = {}
    for text in pages:
        page = Page(parse(text))
        shapes[page.skeleton()] = shapes.get(page.skeleton(), 0) + 1
        for path, key, home, chars in page.facts():
            fact = facts.setdefault((path, key), [home, 0, 0])
            fact[1] += chars
            fact[2] += 1
    return wrapper_of(templates(list(shapes.items())), [(*k, *v) for k, v in facts.items()])


def extract(page: str | None, constant: frozenset[int] = frozenset(), places: frozenset[int] = frozenset()) -> str:
    return choose(page, constant, places)[0]


def with_headings(found: Page, varying: list[bool]) -> list[bool]:
    """``varying``, and the constant headings whose own text varies: the next line below the same parent that is no heading."""
    kept = list(varying)
    for i, (at, _) in enumerate(found.lines):
        if varying[i] or found.tag[at] not in HEADINGS:
            continue
        # a term or table head may lie in a row of its own
        parent = found.up[found.up[at]] if found.tag[at] == "th" else found.up[at]
        for j in range(i + 1, len(found.lines)):
            node = found.lines[j][0]
            if found.tag[node] in HEADINGS and not varying[j]:
                if found.up[node] == found.up[at] and found.tag[at][0] == "h" and found.tag[node] <= found.tag[at]:
                    break
                continue
            while node > parent:
                node = found.up[node]
            kept[i] = node == parent and varying[j]
            break
    return kept


def choose(page: str | None, constant: frozenset[int], places: frozenset[int]) -> tuple[str, str]:
    """The text of a page and what decided where it is: wrapper, article, main or body."""
    if not page:
        return "", ""
    found = Page(parse(page))
    varying = [not constant or constant_key(found.path[at], text) not in constant for at, text in found.lines]
    if not any(varying):
        # all its text is constant, as on copies of one text: nothing tells it from a menu
        varying = [True] * len(varying)
    size = [0] * len(found.tag)
    for (at, text), kept in zip(found.lines, varying):
        size[at] += kept * len(text)
    for i in range(len(size) - 1, 0, -1):
        size[found.up[i]] += size[i]
    # headings do not decide where the content is, but belong to it
    varying = with_headings(found, varying)
    held: dict[int, int] = {}
    for i, path in enumerate(found.path):
        if path in places:
            held[path] = held.get(path, 0) + size[i]
    place = max(held, key=lambda p: (held[p], -found.path.index(p)), default=0)
    if held.get(place):
        # of places in it the innermost that still holds most of its text
        for path in found.path:
            if held.get(path, 0) >= CONTENT * held[place] and found.within(path, place):
                place = path
        return "\n".join(found.below([i for i, p in enumerate(found.path) if p == place], varying)), "wrapper"
    for kind in (*MARKS, "body"):
        roots = [i for i, tag in enumerate(found.tag) if tag == kind and (size[i] or kind == "body")]
        if roots:
            return "\n".join(found.below(roots, varying)), kind
    return "\n".join(found.below([0], varying)), "body"


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    return pages.withColumn("_host", host)


FACT = "_host string, path bigint, key bigint, page bigint, home bigint, chars bigint, skeleton string"


def page_facts(pages: DataFrame) -> DataFrame:
    """Facts of every page: (path, key, home, chars) of its lines; a row of key 1 for its shape.

    The skeleton of a shape goes with the first page that has it in a task.
    """

    def run(batches):
        seen: set[tuple[str, int]] = set()
        for batch in sliced(batches, "html"):
            rows: list[tuple] = []
            for host, text, page in zip(*(batch.column(c).to_pylist() for c in ("_host", "html", "page"))):
                found = Page(parse(text))
                skeleton = found.skeleton()
                shape = number(skeleton)
                rows.append((host, shape, 1, page, 0, 0, None if (host, shape) in seen else skeleton))
                if len(seen) > 100_000:
                    seen.clear()
                seen.add((host, shape))
                rows += [(host, path, key, page, home, chars, None) for path, key, home, chars in found.facts()]
            kinds = [pa.string(), *[pa.int64()] * 5, pa.string()]
            names = [f.split()[0] for f in FACT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    hosted = with_host(pages.select("url", "html")).where("html is not null and html <> ''")
    return hosted.select("_host", "html", F.xxhash64("html").alias("page")).mapInArrow(run, FACT)


LAYOUT = "_host string, skeleton string, n bigint"


def aligned(shapes: DataFrame, *group: str) -> DataFrame:
    """The templates of the shapes of each group, as skeletons with the pages that have them."""

    def run(pdf):
        import pandas as pd

        found = templates(list(zip(pdf["skeleton"], pdf["n"].tolist())))
        return pd.DataFrame({"_host": pdf["_host"].iloc[0], "skeleton": [flat(t) for t, _ in found], "n": [n for _, n in found]})

    return shapes.groupBy(*group).applyInPandas(run, LAYOUT)


def signed(shapes: DataFrame, seed: int) -> DataFrame:
    """``shapes`` with _sign, the smallest hash of a label: shapes agree in it as often as in their labels."""

    def run(frames):
        for pdf in frames:
            least = [min(step(seed, label) for label in {x[1] for x in json.loads(s)}) for s in pdf["skeleton"]]
            yield pdf.assign(_sign=least)

    return shapes.mapInPandas(run, LAYOUT + ", _sign bigint")


def layouts_of(shapes: DataFrame, scratch: Scratch) -> DataFrame:
    """(_host, skeleton, n): the layouts of every host from its shapes, in tasks of at most about ``TOGETHER``."""
    shapes = scratch.put(shapes)
    sizes = shapes.groupBy("_host").agg(F.count(F.lit(1)).alias("_k"))
    large = scratch.put(sizes.where(F.col("_k") > TOGETHER))
    few = aligned(shapes.join(large, "_host", "left_anti"), "_host")
    rest = scratch.put(shapes.join(large, "_host", "left_semi"))
    count, seed = rest.count(), 0
    while count:
        seed += 1
        dealt = scratch.put(signed(rest, seed))
        held = dealt.groupBy("_host", "_sign").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("_parts"))
        part = F.pmod(F.xxhash64("skeleton", F.lit(seed)), F.col("_parts")).alias("_part")
        spread = dealt.join(held, ["_host", "_sign"]).select("_host", "skeleton", "n", "_sign", part)
        rest = scratch.put(aligned(spread, "_host", "_sign", "_part"))
        before, count = count, rest.count()
        if count > (1 - SHRINK) * before:
            break
    return few.unionByName(rest)


def fit_wrappers(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(_host, wrapper): the wrapper of every host as JSON, from all its distinct pages."""
    facts = scratch.put(page_facts(pages))
    # a heavily copied page is one page: equal html counts once
    once = facts.groupBy("_host", "path", "key", "page").agg(F.max("home").alias("home"), F.max("chars").alias("chars"))
    counted = once.groupBy("_host", "path", "key").agg(F.max("home").alias("home"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    counted = scratch.put(counted.where(f"key in (0, 1) or n >= {LEAST_PAGES}"))
    holders = counted.where("key = 0").select("_host", "path", F.col("n").alias("of"))
    constant = counted.where("key not in (0, 1)").join(holders, ["_host", "path"]).where(F.col("n") >= F.lit(CONSTANT) * F.col("of")).drop("of")
    skeletons = facts.where("skeleton is not null").groupBy("_host", "path").agg(F.min("skeleton").alias("skeleton"))
    shapes = counted.where("key = 1").join(skeletons, ["_host", "path"]).select("_host", "skeleton", "n")
    layouts = layouts_of(shapes, scratch).where(F.col("n") >= LEAST_PAGES)
    # no null among the numbers, which pandas would turn into doubles
    layouts = layouts.withColumns({c: F.lit(v).cast("long") for c, v in (("path", 0), ("key", 1), ("home", 0), ("chars", 0))})
    # a host without a layout of enough pages gets an empty wrapper from its facts
    known = layouts.unionByName(counted.where("key = 0").unionByName(constant), allowMissingColumns=True)

    def run(pdf):
        import pandas as pd

        of_layout = pdf["key"] == 1
        layouts = [(Slot.of(tree(s)), n) for s, n in zip(pdf["skeleton"][of_layout], pdf["n"][of_layout].tolist())]
        rows = pdf[~of_layout]
        wrapper = wrapper_of(layouts, list(zip(*(rows[c].tolist() for c in ("path", "key", "home", "chars", "n")))))
        return pd.DataFrame({"_host": [pdf["_host"].iloc[0]], "wrapper": [json.dumps(wrapper)]})

    return known.groupBy("_host").applyInPandas(run, "_host string, wrapper string")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    scratch = Scratch(pages.sparkSession, "html")
    wrappers = scratch.put(fit_wrappers(pages, scratch))
    hosted = with_host(pages.select("page_id", "url", "html")).join(wrappers, "_host", "left")

    def run(batches):
        known: dict[str | None, tuple[frozenset[int], frozenset[int]]] = {None: (frozenset(), frozenset())}
        for batch in sliced(batches, "html"):
            texts = []
            for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                if wrapper not in known:
                    if len(known) > 1000:
                        known = {None: known[None]}
                    w = json.loads(wrapper)
                    known[wrapper] = frozenset(w["constant"]), frozenset(w["content"])
                texts.append(extract(page, *known[wrapper]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return hosted.select("page_id", "url", "html", "wrapper").mapInArrow(run, schema)
