"""Main text of web pages by wrappers: union-free regular expressions over page structure.

Every page is read as a stream of block-level tags and text. Runs of equally shaped siblings
become repeated groups. The pages of one host are aligned one after the other: where two
streams mismatch, the odd part becomes an optional group, and text that differs becomes a
text slot. What remains is the host's wrapper, an expression of sequence, ``?``, ``+`` and
slots without alternatives, that matches all its pages.

The wrapper decides what is kept. It knows how much text its slots carry and on how many
pages a text stands: the main region is the ``article`` (or ``main``) group, or else the
innermost group that holds most of the slot text outside links, menus, forms and the like.
Pages are then read again, and the text of that region is kept block by block, without what is
the same on most pages of the host (unless that is a large part of the page: pages may be
copies). Class words only break ties: they leave out small groups, never one that holds most
of the text, and never what lies around the region.

Alignment is associative enough to run in stages: wrappers are inferred inside each task,
then merged per host in ``SALTS`` parts, then per host. A task only ever holds wrappers,
which are bounded: a group has at most ``WIDEST`` different parts, the least common of further
ones are one remainder, blocks beyond ``LEVELS`` levels are taken into the last one, and a
slot counts at most ``TEXTS`` texts. Reading, inferring and merging are linear in a page's length.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, sized_broadcast, small_partitions
from loomline.llm.url_templates import host_and_path

SALTS = 64
LONGEST_PERIOD = 3
# Bounds of a wrapper: levels, different parts of a group, texts counted per slot.
LEVELS, WIDEST, TEXTS = 128, 64, 32
# Share of a group's text that one child must hold for the main region to lie inside it.
DOMINANT = 0.6
# Share of all text from which a group is kept whatever its class words say.
SPARED = 0.5
# A text on so many pages and this share of the host's pages is constant; it is dropped where
# constant texts are at most the last share of a page's text.
LEAST_PAGES, CONSTANT, SMALL = 3, 0.5, 0.2
# Chunks of a batch's wrappers are handed on after this many hosts.
HOSTS_HELD = 2_000

# Fixed values of HTML: elements whose content is no text, blocks, and elements without end tag.
RAW = "script|style|noscript|template|textarea|title|svg|iframe|canvas|audio|video|annotation-xml|annotation"
BLOCK = frozenset(
    "html body head main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead "
    "tbody tfoot tr td th form fieldset legend blockquote pre figure figcaption address details summary dialog menu center hgroup "
    "search option select button label".split()
)
CLOSES_P = BLOCK - {"option", "select", "button", "label", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
STOPS = {"ul", "ol", "menu", "dl", "table", "select"}
# Elements and class, id or role words of what surrounds an article.
AROUND_TAGS = frozenset("head nav aside header footer form menu dialog button select option label fieldset legend search".split())
AROUND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert menu menus nav navbar navigation breadcrumb breadcrumbs sidebar side aside header masthead footer foot comment "
    "comments commentlist reply replies respond disqus share sharing social related recommended newsletter subscribe subscription "
    "signup login popup modal overlay toolbar pagination pager widget widgets skip copyright disclaimer search complementary contentinfo".split()
)
KEPT_TAGS = frozenset("html body main".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond promo promoted sponsored related".split())
# Words that turn a class around ("no-sidebar" has none).
DENIED = frozenset("no not non with without has have".split())
# Share of a slot's text in links from which a region without an ``article`` leaves it out.
LINKED = 0.6

_OPENING = re.compile(r"<(?:!--|[!?]|/?([a-zA-Z][a-zA-Z0-9:-]*))")
_SPECIAL = re.compile("[>\"']")
_IS_RAW = re.compile(rf"(?:{RAW})\Z", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])|[0-9]{3,}")


def _machine_made(word: str) -> bool:
    """A word of letters and digits mixed, as build tools make them: it says nothing and differs by page."""
    return len(word) > 4 and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def _label(tag: str, attributes: str) -> str:
    """Tag with its class, id and role names, each name as words joined by ``-``."""
    if "=" not in attributes:
        return tag
    names = []
    for m in _NAMED.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _SPLIT.split(name) if w and not _machine_made(w)]
            if words:
                names.append("-".join(words))
    return f"{tag}.{'.'.join(names)}" if names else tag


def _listed(names: list[str], listed: frozenset[str]) -> bool:
    """Whether a name's first or last word is listed, if no word of it denies the others."""
    for name in names:
        words = name.split("-")
        if (words[0] in listed or words[-1] in listed) and DENIED.isdisjoint(words):
            return True
    return False


def around(label: str) -> bool:
    """Whether a group of this label surrounds the article by its tag or its names."""
    tag, *names = label.split(".")
    if tag in KEPT_TAGS:
        return False
    return tag in AROUND_TAGS or _listed(names, COMMENT_WORDS if tag == "article" else AROUND_WORDS)


def spareable(label: str) -> bool:
    """Whether much text keeps the group: named by classes other than those of comments, or a form (some sites put all in one)."""
    tag, *names = label.split(".")
    return (tag not in AROUND_TAGS or tag == "form") and not _listed(names, COMMENT_WORDS)


# -- reading ------------------------------------------------------------------


class _Tags:
    """Where tags end: at the first ``>`` outside quotes. Found for all places at once, in one pass from the end."""

    def __init__(self, page: str) -> None:
        self.places = [m.start() for m in _SPECIAL.finditer(page)]
        self.ends = [-1] * (len(self.places) + 1)
        following = {'"': len(self.places), "'": len(self.places)}
        for k in range(len(self.places) - 1, -1, -1):
            mark = page[self.places[k]]
            if mark == ">":
                self.ends[k] = self.places[k]
            else:
                closing = following[mark]
                self.ends[k] = self.ends[closing + 1] if closing < len(self.places) else -1
                following[mark] = k

    def end(self, at: int) -> int:
        return self.ends[bisect_left(self.places, at)]


def _parts_of(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``(start, end, tag, closing, attributes)`` of tags, comments and content that is no text (tag empty)."""
    tags, at, last = _Tags(page), 0, page.rfind(">")
    while True:
        m = _OPENING.search(page, at)
        if m is None:
            return
        start, name = m.start(), m[1]
        if name is None:
            if m[0] == "<!--":
                stop = page.find("-->", m.end())
                at = stop + 3 if stop >= 0 else len(page)
            elif start > last:
                return
            else:
                at = page.find(">", start) + 1
            yield start, at, "", False, ""
            continue
        stop = tags.end(m.end())
        if stop < 0:
            at = m.end()  # no tag: the characters are text
            continue
        closing = m[0][1] == "/"
        at = stop + 1
        if not closing and _IS_RAW.match(name):
            over = _ENDS[name.lower()].search(page, at)
            at = over.end() if over else len(page)
            yield start, at, "", False, ""
        else:
            yield start, at, name.lower(), closing, page[m.end() : stop]


def blocks(page: str | None) -> Iterator[tuple[int, str | None, list[tuple[str, bool]]]]:
    """The page's stream: ``(depth, label, [])`` for an opened block, ``(depth, None, pieces)`` for text between block tags.

    A piece is text and whether it is in a link. Tags left open and stray end tags are taken
    as browsers take them; blocks beyond ``LEVELS`` levels belong to the last level.
    """
    tags: list[str] = []
    opened: dict[str, int] = {}
    pieces: list[tuple[str, bool]] = []
    links, at = 0, 0
    page = page or ""

    def pop_to(names, stops=frozenset()) -> None:
        if not any(opened.get(n) for n in names):
            return
        for k in range(len(tags) - 1, -1, -1):
            if tags[k] in names:
                for gone in tags[k:]:
                    opened[gone] -= 1
                del tags[k:]
                return
            if tags[k] in stops:
                return

    for start, end, tag, closing, attributes in _parts_of(page):
        if start > at:
            pieces.append((page[at:start], links > 0))
        at = end
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            pieces.append((" ", False))
        elif tag in BLOCK or tag == "hr":
            if pieces:
                yield min(len(tags), LEVELS), None, pieces
                pieces = []
            if closing:
                pop_to((tag,))
                links = 0
                continue
            if tag in CLOSES_P or tag == "hr":
                pop_to(("p",), BLOCK - {"p"})
            if tag in SIBLINGS:
                pop_to(SIBLINGS[tag], STOPS)
            if tag != "hr" and not attributes.endswith("/"):
                tags.append(tag)
                opened[tag] = opened.get(tag, 0) + 1
                if len(tags) <= LEVELS:
                    yield len(tags), _label(tag, attributes), []
    if at < len(page):
        pieces.append((page[at:], links > 0))
    if pieces:
        yield min(len(tags), LEVELS), None, pieces


# -- wrappers -----------------------------------------------------------------

TEXT, GROUP, REST = "#text", "()", "..."


def _mark(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class Node:
    """Part of a wrapper: a label, its parts, ``?`` and ``+``, its pages, and of a slot the text so far.

    ``texts`` counts the occurrences of a slot's most common texts by their hash; a count is
    never too high, and a text that makes up more than a share ``1 / (TEXTS + 1)`` is there.
    """

    __slots__ = ("label", "parts", "optional", "repeated", "constant", "size", "linked", "pages", "texts")

    def __init__(self, label: str, parts: list[Node] | None = None, text: str | None = None, size: int = 0, linked: int = 0):
        self.label, self.parts, self.optional, self.repeated, self.pages = label, parts or [], False, False, 1
        self.constant = text if text is None or len(text) <= 80 else f"{text[:80]} {_mark(text)}"
        self.texts = {} if text is None else {_mark(text): 1}
        self.size, self.linked = size, linked

    def expression(self) -> str:
        """The wrapper as text: slots as ``#``, constant text quoted."""
        if self.label == TEXT:
            inside = "#" if self.constant is None else json.dumps(self.constant)
        elif self.label == REST:
            inside = REST
        else:
            body = " ".join(p.expression() for p in self.parts)
            inside = f"({body})" if self.label == GROUP else f"<{self.label}>{body}</>"
        return inside + ("+" if self.repeated else "") + ("?" if self.optional else "")


def encoded(root: Node) -> bytes:
    """A wrapper as a flat list of its nodes, parents first."""
    out, todo = [], [(0, root)]
    while todo:
        depth, n = todo.pop()
        out.append((depth, n.label, n.optional, n.repeated, n.constant, n.size, n.linked, n.pages, n.texts))
        todo += [(depth + 1, p) for p in reversed(n.parts)]
    return pickle.dumps(out)


def decoded(data: bytes) -> Node:
    trail: list[Node] = []
    for depth, label, optional, repeated, constant, size, linked, pages, texts in pickle.loads(data):
        node = Node(label)
        node.optional, node.repeated, node.constant, node.size, node.linked = optional, repeated, constant, size, linked
        node.pages, node.texts = pages, texts
        del trail[depth:]
        if trail:
            trail[-1].parts.append(node)
        trail.append(node)
    return trail[0]


def _common(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
    """Counts added; beyond ``TEXTS`` of them all are lowered by the next largest count."""
    out = dict(a)
    for text, n in b.items():
        out[text] = out.get(text, 0) + n
    if len(out) <= TEXTS:
        return out
    low = sorted(out.values(), reverse=True)[TEXTS]
    return {t: n - low for t, n in out.items() if n > low}


def _merge(a: Node, b: Node, beside: bool = False) -> Node:
    """The expression that matches what ``a`` and ``b`` (of one label) match; ``beside``: they stand on one page."""
    out = Node(a.label, _align(a.parts, b.parts) if a.label not in (TEXT, REST) else [], None, a.size + b.size, a.linked + b.linked)
    out.constant = a.constant if a.constant == b.constant else None
    out.texts = _common(a.texts, b.texts)
    out.pages = max(a.pages, b.pages) if beside else a.pages + b.pages
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    return out


def _align(a: list[Node], b: list[Node]) -> list[Node]:
    """Longest common alignment of two sequences; what only one of them has becomes optional."""
    if [x.label for x in a] == [y.label for y in b] and all(x.label != GROUP for x in a):
        return [_merge(x, y) for x, y in zip(a, b)]
    fits = lambda x, y: x.label == y.label and (x.label != GROUP or [p.label for p in x.parts] == [p.label for p in y.parts])
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]  # at most WIDEST + 2 parts each
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], (best[i + 1][j + 1] + 1) if fits(a[i], b[j]) else 0)
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and fits(a[i], b[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    return _narrow(_fold(out))


def _whole(node: Node) -> tuple[int, int]:
    """All text of a part, and all of it in links."""
    size, linked, todo = 0, 0, [node]
    while todo:
        n = todo.pop()
        size, linked = size + n.size, linked + n.linked
        todo += n.parts
    return size, linked


def _narrow(parts: list[Node]) -> list[Node]:
    """At most ``WIDEST`` parts and a remainder that keeps the amounts of text of the others.

    The parts of the most pages stay, of these the ones with most text.
    """
    if len(parts) <= WIDEST + 1:
        return parts
    amounts = [_whole(p) for p in parts]
    order = sorted((i for i, p in enumerate(parts) if p.label != REST), key=lambda i: (-parts[i].pages, -amounts[i][0], i))
    kept = set(order[:WIDEST])
    rest = Node(REST)
    rest.optional = rest.repeated = True
    for i, p in enumerate(parts):
        if i not in kept:
            rest.size, rest.linked = rest.size + amounts[i][0], rest.linked + amounts[i][1]
    return [p for i, p in enumerate(parts) if i in kept] + [rest]


def _fold(parts: list[Node]) -> list[Node]:
    """Tandem repeats of one to ``LONGEST_PERIOD`` siblings become repeated groups."""
    for period in range(1, LONGEST_PERIOD + 1):
        out: list[Node] = []
        i = 0
        while i < len(parts):
            window = [p.label for p in parts[i : i + period]]
            j = i + period
            while len(window) == period and len(set(window)) == period and [p.label for p in parts[j : j + period]] == window:
                j += period
            if j == i + period or (period > 1 and TEXT in window and GROUP in window):
                out.append(parts[i])
                i += 1
                continue
            rows = [parts[k : k + period] for k in range(i, j, period)]
            if period == 1:
                one = rows[0][0]
                for (other,) in rows[1:]:
                    one = _merge(one, other, True)
            else:
                one = Node(GROUP, rows[0])
                for row in rows[1:]:
                    one = Node(GROUP, [_merge(x, y, True) for x, y in zip(one.parts, row)])
            one.repeated = one.label != REST or one.repeated
            one.pages = max(p.pages for row in rows for p in row)
            one.optional = all(p.optional for row in rows for p in row)
            out.append(one)
            i = j
        parts = out
    return parts


def of_page(page: str | None) -> Node:
    """Wrapper of a single page."""
    trail = [Node("")]
    for depth, label, pieces in blocks(page):
        keep = depth + 1 if label is None else depth
        while len(trail) > keep:
            _closed(trail.pop())
        if label is not None:
            node = Node(label)
            trail[-1].parts.append(node)
            trail.append(node)
            continue
        text = " ".join("".join(p for p, _ in pieces).split())
        if text:
            trail[-1].parts.append(Node(TEXT, None, text, sum(len(p) for p, _ in pieces), sum(len(p) for p, link in pieces if link)))
    while len(trail) > 1:
        _closed(trail.pop())
    return _closed(trail[0])


def _closed(node: Node) -> Node:
    """A node whose parts are complete: repeats folded, width bounded."""
    node.parts = _narrow(_fold(node.parts))
    return node


Path = tuple[str, ...]


class _Weights:
    """Slot text outside links per node: of everything, and without the groups that surround an article."""

    def __init__(self, root: Node) -> None:
        order, todo = [], [root]
        while todo:
            n = todo.pop()
            order.append(n)
            todo += n.parts
        self.all: dict[int, int] = {}
        for n in reversed(order):
            own = n.size - n.linked + sum(self.all[id(p)] for p in n.parts)
            self.all[id(n)] = own if not around(n.label) or spareable(n.label) else 0
        self.most = SPARED * self.all[id(root)]
        self.inner: dict[int, int] = {}
        for n in reversed(order):
            self.inner[id(n)] = 0 if self.outside(n) else n.size - n.linked + sum(self.inner[id(p)] for p in n.parts)

    def outside(self, n: Node) -> bool:
        """Surrounds the article by its label, and does not hold most of the text."""
        return around(n.label) and not (spareable(n.label) and 0 < self.most <= self.all[id(n)])


def _below(node: Node, path: Path) -> Iterator[tuple[Node, Path]]:
    """The parts of a node that are blocks, those of a repeated group as if they stood alone."""
    for p in node.parts:
        if p.label == GROUP:
            yield from _below(p, path)
        elif p.label not in (TEXT, REST):
            yield p, (*path, p.label)


def _named_regions(root: Node, tag: str, weights: _Weights) -> list[Path]:
    out, todo = [], list(_below(root, ()))[::-1]
    while todo:
        n, path = todo.pop()
        if weights.outside(n):
            continue
        head, *names = n.label.split(".")
        named = head == tag or (tag == "main" and head == "div" and "main" in names) or (tag == "article" and "article-body" in names)
        if named and weights.inner[id(n)]:
            out.append(path)
        else:
            todo += list(_below(n, path))[::-1]
    return list(dict.fromkeys(out))


def _link_slots(node: Node, path: Path) -> list[Path]:
    """Paths from ``node`` down whose text is mostly links."""
    out, todo = [], [(node, path)]
    while todo:
        n, at = todo.pop()
        text = [p for q in n.parts for p in (q.parts if q.label == GROUP else [q]) if p.label == TEXT]
        size = sum(p.size for p in text)
        if size and sum(p.linked for p in text) >= LINKED * size:
            out.append(at)
        todo += _below(n, at)
    return list(dict.fromkeys(out))


def _facts(root: Node, weights: _Weights) -> tuple[list[Path], list[str]]:
    """Paths of groups that are spared in spite of their class words, and hashes of constant texts."""
    spared, constant, todo = [], [], [(root, ())]
    least = max(LEAST_PAGES, CONSTANT * root.pages)
    while todo:
        n, path = todo.pop()
        if around(n.label) and not weights.outside(n):
            spared.append(path)
        for q in n.parts:
            for p in q.parts if q.label == GROUP else [q]:
                if p.label == TEXT:
                    constant += [t for t, count in p.texts.items() if count >= least]
        todo += _below(n, path)
    return list(dict.fromkeys(spared)), sorted(set(constant))


def main_regions(root: Node) -> dict[str, list]:
    """What the wrapper keeps: ``regions``, without ``links`` and without ``constant`` texts; ``spared`` groups stay."""
    weights = _Weights(root)
    spared, constant = _facts(root, weights)
    rule = {"regions": [], "links": [], "spared": spared, "constant": constant}
    for tag in ("article", "main"):
        found = _named_regions(root, tag, weights)
        if found:
            return rule | {"regions": found}
    if not weights.inner[id(root)]:
        return rule
    node, path = root, ()
    while True:
        inner = list(_below(node, path))
        by_path: dict[Path, int] = {}
        for p, at in inner:
            by_path[at] = by_path.get(at, 0) + weights.inner[id(p)]
        top = max(inner, key=lambda x: by_path[x[1]], default=None)
        if top is None or top[0].repeated or by_path[top[1]] < DOMINANT * weights.inner[id(node)] or all(q.label == TEXT for q in top[0].parts):
            return rule | {"regions": [path], "links": _link_slots(node, path)}
        node, path = top


class _Rule:
    """A rule as a tree of labels, to follow while a page is read."""

    def __init__(self, rule: dict[str, list]) -> None:
        self.root: dict = {}
        self.constant = frozenset(rule["constant"])
        for kind in ("regions", "links", "spared"):
            for path in rule[kind]:
                at = self.root
                for label in path:
                    at = at.setdefault(label, {})
                at[None] = {*at.get(None, ()), kind}


def text_of(page: str | None, rule: _Rule) -> str:
    """The page's blocks that the rule keeps, white space made single, joined by one space."""
    out: list[tuple[str, bool]] = []
    # per open block: its place in the rule, inside a region, left out, and a slot of links
    first = rule.root.get(None, ())
    trail = [(rule.root, "regions" in first, False, "links" in first)]
    for depth, label, pieces in blocks(page):
        if label is not None:
            del trail[depth:]
            place, inside, out_of_it, _ = trail[-1]
            place = place.get(label) if place else None
            marks = place.get(None, ()) if place else ()
            # class words and tags count inside a region only
            out_of_it = out_of_it or (inside and "spared" not in marks and around(label))
            trail.append((place, inside or "regions" in marks, out_of_it, "links" in marks))
            continue
        del trail[depth + 1 :]
        _, inside, out_of_it, linked = trail[-1]
        if inside and not out_of_it and not linked:
            raw = " ".join("".join(p for p, _ in pieces).split())
            text = " ".join(references.unescape(raw).split())
            if text:
                out.append((text, bool(rule.constant) and _mark(raw) in rule.constant))
    whole, same = sum(len(t) for t, _ in out), sum(len(t) for t, constant in out if constant)
    if 0 < same <= SMALL * whole:
        out = [x for x in out if not x[1]]
    return " ".join(t for t, _ in out)


# -- Spark --------------------------------------------------------------------


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, regions)``: the encoded wrapper of each host of ``(host, html)`` and its main regions."""

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Node] = {}

        def hand_on() -> pa.RecordBatch:
            rows = [list(held), [encoded(w) for w in held.values()]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.binary())], ["host", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = of_page(page.as_py())
                held[host] = _merge(held[host], own) if host in held else own
                if len(held) > HOSTS_HELD:
                    yield hand_on()
        yield hand_on()

    def merged(key, rows: pd.DataFrame) -> pd.DataFrame:
        found = [decoded(w) for w in rows["wrapper"]]
        one = found[0]
        for other in found[1:]:
            one = _merge(one, other)
        return pd.DataFrame({"host": [key[0]], "wrapper": [encoded(one)], "regions": [json.dumps(main_regions(one))]})

    parts = pages.select("host", "html").mapInArrow(infer, "host string, wrapper binary")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    kinds = "host string, wrapper binary, regions string"
    once = salted.groupBy("host", "salt").applyInPandas(merged, kinds)
    return once.select("host", "wrapper").groupBy("host").applyInPandas(merged, kinds)


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of every page.

    Null and empty pages, and pages without text in the main region of their host's wrapper
    or of their own, give the empty text. Pages without a host share one wrapper. Repeated
    rows are read each; broken markup is read as browsers read it.
    """
    host, _ = host_and_path(F.col("url").cast("string"))
    rows = small_partitions(pages.select("page_id", "url", F.col("html").cast("string").alias("html"))).withColumn("host", host)
    rules = checkpointed(wrappers(rows).select("host", "regions"))
    read = rows.join(sized_broadcast(rules), "host", "left").select("page_id", "url", "html", "regions")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, _Rule] = {}
        for batch in batches:
            out = []
            for page, rule in zip(batch.column(2), batch.column(3).to_pylist()):
                page = page.as_py()
                if rule not in known:
                    known[rule] = _Rule(json.loads(rule) if rule else main_regions(Node("")))
                out.append(text_of(page, known[rule]) or text_of(page, _Rule(main_regions(of_page(page)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return read.mapInArrow(run, f"{kinds}, text string")
