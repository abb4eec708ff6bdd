"""Operator 1: main text of HTML pages by wrappers inferred for their hosts.

A page's tokens become a tree of block elements; inline mark-up stays inside the text. The tree
is read as a union-free regular expression: runs of alike siblings fold into repeated groups.
Wrappers of one host are aligned sibling list by sibling list; what only one side has becomes
optional, what repeats on either side becomes repeated, and differing texts become text slots.
Wrappers are merged inside the tasks first and then in rounds of bounded groups, so a host of
any size costs each task a few wrappers.

A host's wrapper tells which parts are article: parts named as page furniture are not, nor are
texts outside the article that are the same on all pages, nor lists of links. A page is aligned
with its host's wrapper and its blocks of the article are returned in order.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from operator import add
from zlib import adler32, crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.store import Store

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An element of the key is closed by the start of one of these among its parent's children.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "p": CLOSES_P}
FURNITURE_TAGS = frozenset("head nav footer aside form script style noscript template button select textarea iframe svg canvas object dialog menu title".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related "
    "share sharing social cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login search comment comments reply replies "
    "disqus footer masthead copyright legal pagination pager skip toolbar topbar".split()
)

_NAMED = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.IGNORECASE) for tag in RAW}

#: Levels of elements that become levels of the tree (browsers stop there as well): deeper ones become
#: siblings, in page order. Cells of a table of one exact alignment; longer lists are cut at anchors.
DEPTH, CELLS = 512, 1 << 20

# Each level takes a few Python frames, which use no C stack.
RECURSION = 20_000

#: Merged wrappers of one task that are held at once, and wrappers merged by one call.
HELD_HOSTS, FAN_IN = 2000, 64


class Node:
    """An element: `key` is its name and the words of its class, id and role; children may be text."""

    __slots__ = ("key", "tag", "children")

    def __init__(self, key: str, tag: str):
        self.key, self.tag, self.children = key, tag, []


def _key(tag: str, attributes: str) -> str:
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name in ("class", "id", "role"):
            words.update(_NAME.findall(value))
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            words.add("hidden")
    return tag + "".join(f".{w}" for w in sorted(words))


def tokens(html: str) -> Iterator[tuple[str, bool, str]]:
    """(tag, whether it ends, attributes) and ("", False, text), in one pass over the page.

    A `<` that opens no mark-up is text, and so is all after the last `>` but for a comment. A quote
    that is never closed is an ordinary character: its tag ends at the next `>`.
    """
    at, plain, cdata = 0, 0, True
    while (start := html.find("<", at)) >= 0:
        if start > at:
            yield "", False, html[at:start]
        at = start
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = end + 3 if end >= 0 else len(html)
            continue
        if cdata and html.startswith("<![CDATA[", at):
            end = html.find("]]>", at)
            cdata = end >= 0
            if cdata:
                yield "", False, html[at + 9 : end]
                at = end + 3
                continue
        first = html.find(">", at)
        if first < 0:
            comment = html.find("<!--", at)
            yield "", False, html[at : comment if comment >= 0 else len(html)]
            return
        if html[at + 1] in "!?":
            at = first + 1
            continue
        named = _NAMED.match(html, at)
        if not named:
            yield "", False, "<"
            at += 1
            continue
        end, seek = first, named.end()
        while at >= plain:
            stop = _STOP.search(html, seek)
            if stop is None or stop.group() == ">":
                end = stop.start() if stop else first
                break
            close = html.find(stop.group(), stop.end())
            if close < 0:
                plain = stop.end()  # tags up to here would only meet this quote again
                break
            seek = close + 1
        tag, ends = named.group(1).lower(), html[at + 1] == "/"
        yield tag, ends, html[named.end() : end]
        at = end + 1
        if tag in RAW and not ends:
            close = _RAW_END[tag].search(html, at)
            over = html.find(">", close.end()) if close else -1
            at = over + 1 if over >= 0 else len(html)
    if at < len(html):
        yield "", False, html[at:]


def parse(html: str) -> Node:
    """The tree of block elements; a text child is [its parts, characters inside links].

    Below DEPTH levels a text becomes a child of the last level under its innermost element's key,
    unless an element around it is furniture; no other text is left out.
    """
    root = Node("#root", "#root")
    stack, link, opened = [root], 0, Counter()
    deep_furniture = 0

    def text(raw: str) -> None:
        if not raw or deep_furniture:
            return
        node = stack[-1]
        if len(stack) > DEPTH:
            last = stack[DEPTH - 1].children
            if not last or last[-1] is not node:
                # Its texts before and after an element inside it are blocks of their own.
                node = stack[-1] = Node(node.key, node.tag) if node.children else node
                last.append(node)
        children = node.children
        if not children or isinstance(children[-1], Node):
            children.append([[], 0])
        children[-1][0].append(raw)
        if link:
            children[-1][1] += len(raw)

    def close(first: int) -> None:
        nonlocal deep_furniture
        for place in range(first, len(stack)):
            opened[stack[place].tag] -= 1
            if place >= DEPTH and furniture(stack[place].key):
                deep_furniture -= 1
        del stack[first:]

    for tag, ends, attributes in tokens(html):
        if not tag:
            text(attributes)
            continue
        if tag in RAW and not ends:
            continue
        if tag == "a":
            link = 0 if ends else 1
        if tag in INLINE:
            if tag in ("br", "img"):
                text(" ")
            continue
        if ends:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                link = 0
            continue
        if tag in ("html", "body") and opened[tag]:
            continue
        for i in range(len(stack) - 1, max(0, len(stack) - 9), -1):
            if tag in CLOSED_BY.get(stack[i].tag, ()):
                close(i)
                break
            if stack[i].tag not in ("tbody", "p"):
                break
        if tag == "body" and stack[-1].tag == "head":
            close(len(stack) - 1)
        node = Node(_key(tag, attributes), tag)
        if len(stack) < DEPTH:
            stack[-1].children.append(node)
        if tag not in VOID and not (attributes.rstrip().endswith("/") and tag not in CLOSES_P):
            opened[tag] += 1
            deep_furniture += len(stack) >= DEPTH and furniture(node.key)
            stack.append(node)
    return root


def words(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def hash_text(s: str) -> int:
    raw = s.encode()
    return crc32(raw) << 32 | adler32(raw)


# A wrapper item is [key, quantifier, pages, body]. Body of an element is its list of items, of a
# group "()" too; of a text slot "#" it is [constant digest or None, characters, link characters].
TEXT, GROUP = "#", "()"


def _either(q1: str, q2: str) -> str:
    optional, many = q1 in "?*" or q2 in "?*", q1 in "+*" or q2 in "+*"
    return "*" if optional and many else "?" if optional else "+" if many else "1"


def _optional(item: list) -> list:
    return [item[0], _either(item[1], "?"), item[2], item[3]]


def _same_group(a: list, b: list) -> bool:
    return a[0] == b[0] and (a[0] != GROUP or [x[0] for x in a[3]] == [x[0] for x in b[3]])


def join_items(a: list, b: list, pages=add) -> list:
    """Two aligned items as one; `pages` is `add` for items of different pages, `max` within a page."""
    if a[0] == TEXT:
        same = a[3][0] if a[3][0] == b[3][0] else None
        body = [same, a[3][1] + b[3][1], a[3][2] + b[3][2]]
    else:
        body = align(a[3], b[3], pages)
    return [a[0], _either(a[1], b[1]), pages(a[2], b[2]), body]


def pairs(a: list, b: list, same) -> list[tuple[int | None, int | None]]:
    """An alignment of two lists with the most equal places (None: only the other side has it)."""
    lo = 0
    while lo < min(len(a), len(b)) and same(a[lo], b[lo]):
        lo += 1
    tail = 0
    while tail < min(len(a), len(b)) - lo and same(a[-1 - tail], b[-1 - tail]):
        tail += 1
    x, y = a[lo : len(a) - tail], b[lo : len(b) - tail]
    if len(x) * len(y) > CELLS:
        middle = _anchored(x, y, same)
        return [(i, i) for i in range(lo)] + [(i if i is None else lo + i, j if j is None else lo + j) for i, j in middle] + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if same(x[i], y[j]) else max(best[i + 1][j], best[i][j + 1])
    out: list[tuple[int | None, int | None]] = [(i, i) for i in range(lo)]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and same(x[i], y[j]):
            out.append((lo + i, lo + j))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            out.append((lo + i, None))
            i += 1
        else:
            out.append((None, lo + j))
            j += 1
    return out + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def _sign(item: list) -> tuple:
    """Equal for items that `_same_group` takes for the same."""
    return (GROUP, *(x[0] for x in item[3])) if item[0] == GROUP else (item[0],)


def _anchored(x: list, y: list, same) -> list[tuple[int | None, int | None]]:
    """An alignment of two long lists: items that occur once on each side and in the same order anchor
    it, and what lies between two anchors is aligned by itself; without anchors, each item takes the
    next equal one."""
    signs_x, signs_y = [_sign(i) for i in x], [_sign(i) for i in y]
    count_x, count_y = Counter(signs_x), Counter(signs_y)
    place = {s: j for j, s in enumerate(signs_y) if count_y[s] == 1}
    both = [(i, place[s]) for i, s in enumerate(signs_x) if count_x[s] == 1 and s in place]
    # The longest chain of anchors that rises on both sides: `tops` holds the lowest end of each length.
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(both):
        at = bisect_left(tops, j)
        tops[at : at + 1], ends[at : at + 1] = [j], [n]
        before.append(ends[at - 1] if at else -1)
    anchors: list[tuple[int, int]] = []
    n = ends[-1] if ends else -1
    while n >= 0:
        anchors.append(both[n])
        n = before[n]
    if not anchors:
        places: dict[tuple, list[int]] = {}
        for j, s in enumerate(signs_y):
            places.setdefault(s, []).append(j)
        at = 0
        for i, s in enumerate(signs_x):
            later = places.get(s, [])
            n = bisect_left(later, at)
            if n < len(later):
                anchors.append((i, later[n]))
                at = later[n] + 1
        return _between(anchors, x, y, lambda p, q: [*((i, None) for i in range(len(p))), *((None, j) for j in range(len(q)))])
    return _between(anchors[::-1], x, y, lambda p, q: pairs(p, q, same))


def _between(anchors: list[tuple[int, int]], x: list, y: list, inner) -> list[tuple[int | None, int | None]]:
    """The anchors with what `inner` makes of the lists between them."""
    out: list[tuple[int | None, int | None]] = []
    i0 = j0 = 0
    for i, j in [*anchors, (len(x), len(y))]:
        out += [(p if p is None else i0 + p, q if q is None else j0 + q) for p, q in inner(x[i0:i], y[j0:j])]
        if i < len(x):
            out.append((i, j))
        i0, j0 = i + 1, j + 1
    return out


def align(a: list, b: list, pages=add) -> list:
    """Two lists of items as one: mismatches become optional, then repeats fold."""
    out = []
    for i, j in pairs(a, b, _same_group):
        out.append(_optional(b[j]) if i is None else _optional(a[i]) if j is None else join_items(a[i], b[j], pages))
    return fold(out)


def fold(items: list) -> list:
    """Runs of alike items, alone or as a sequence of up to four, as repeated groups."""
    out: list = []
    for item in items:
        out.append(item)
        for size in range(1, 5):
            b = out[-size:]
            last = out[-size - 1] if len(out) > size else None
            if last and last[0] == GROUP and len(last[3]) == size and all(_same_group(x, y) for x, y in zip(last[3], b)):
                # A further turn of a group that has been found before.
                out[-size - 1 :] = [[GROUP, "+" if last[1] in "1+" else "*", last[2], [join_items(x, y, max) for x, y in zip(last[3], b)]]]
                break
            a = out[-2 * size : -size]
            if len(a) < size or not all(_same_group(x, y) for x, y in zip(a, b)):
                continue
            if size == 1 and a[0][0] == TEXT:
                joined = join_items(a[0], b[0], max)
            elif size == 1:
                joined = join_items(a[0], b[0], max)
                joined[1] = "*" if a[0][1] in "?*" and b[0][1] in "?*" else "+"
                joined[2] = max(a[0][2], b[0][2])
            elif len({x[0] for x in a}) > 1:
                joined = [GROUP, "+", max(a[0][2], b[0][2]), [join_items(x, y, max) for x, y in zip(a, b)]]
            else:
                continue
            out[-2 * size :] = [joined]
            break
    return out


def wrapper(node: Node) -> list:
    """The items of one page's element."""
    items = []
    for child in node.children:
        if isinstance(child, Node):
            items.append([child.key, "1", 1, [] if furniture(child.key) else wrapper(child)])
        else:
            own = words(child[0])
            if own:
                items.append([TEXT, "1", 1, [hash_text(own), len(own), child[1]]])
    return fold(items)


def furniture(key: str) -> bool:
    """Whether an element's name or class, id and role words say that it is no article."""
    tag, *names = key.split(".")
    return tag in FURNITURE_TAGS or "hidden" in names or any(n in FURNITURE_NAMES for n in names)


#: Pages of a host from which on equal texts are taken for furniture, and how long such are.
SAME_PAGES, SAME_CHARS = 4, 400


class Rules:
    """What a host's wrapper says about its pages."""

    def __init__(self, items: list):
        self.items = items
        self.article = _has(items, ("article", "main"))

    def blocks(self, page: Node) -> list[str]:
        out: list[str] = []
        if self.article:
            for node in _roots(page):
                self._walk(node, None, out, inside=True)
        if not out:
            self._walk(page, self.items, out, inside=False)
        return out

    def _walk(self, node: Node, items: list | None, out: list[str], inside: bool) -> None:
        """Appends the blocks under `node`; `items` is the wrapper's list for its children."""
        children = [c if isinstance(c, Node) else [TEXT, words(c[0]), c[1], sum(map(len, c[0]))] for c in node.children]
        children = [c for c in children if isinstance(c, Node) or c[1]]
        slots = _slots(children, items) if items else [None] * len(children)
        for child, slot in zip(children, slots):
            if isinstance(child, Node):
                if furniture(child.key) or (child.tag == "header" and not inside):
                    continue
                below = slot[3] if slot else None
                if not inside and slot and _links(slot) > 0.5:
                    continue
                self._walk(child, below, out, inside)
            elif inside or not slot or not self._same_everywhere(slot):
                if not inside and child[2] > 0.5 * child[3]:
                    continue
                out.append(child[1])

    def _same_everywhere(self, slot: list) -> bool:
        constant, chars, _ = slot[3]
        return constant is not None and slot[2] >= SAME_PAGES and chars <= SAME_CHARS * slot[2]


def _roots(page: Node) -> list[Node]:
    """The outermost article elements (or else main ones) that are no furniture."""
    for tags in (("article",), ("main",)):
        out, stack = [], [page]
        while stack:
            node = stack.pop()
            if furniture(node.key):
                continue
            names = node.key.split(".")
            if names[0] in tags or (node.tag != "#root" and tags == ("main",) and "main" in names[1:]):
                out.append(node)
            else:
                stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
        if out:
            return out
    return []


def _has(items: list, tags: tuple[str, ...]) -> bool:
    return any(i[0].split(".")[0] in tags or (i[0] != TEXT and _has(i[3], tags)) for i in items)


def _links(item: list) -> float:
    chars, links = _chars(item)
    return links / chars if chars else 0.0


def _chars(item: list) -> tuple[int, int]:
    if item[0] == TEXT:
        return item[3][1], item[3][2]
    below = [_chars(i) for i in item[3]]
    return sum(c for c, _ in below), sum(n for _, n in below)


def _slots(children: list, items: list) -> list:
    """The wrapper's item of each child: its next item of the same key, or the last such before."""
    spread = [x for i in items for x in (i[3] if i[0] == GROUP else [i])]
    by_key: dict[str, list[int]] = {}
    for n, item in enumerate(spread):
        by_key.setdefault(item[0], []).append(n)
    out, at = [], -1
    for child in children:
        key = child.key if isinstance(child, Node) else TEXT
        places = by_key.get(key, [])
        if at >= 0 and spread[at][0] == key and spread[at][1] in "+*":
            place = at
        else:
            later = bisect_right(places, at)
            place = places[min(later, len(places) - 1)] if places else None
        if place is not None:
            at = place
        out.append(None if place is None else spread[place])
    return out


def main_text(html: str | None, rules: Rules) -> str:
    return "\n\n".join(b for b in rules.blocks(parse(html)) if b) if html else ""


def host_of(url):
    """The host of a url column, lower-cased; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sys.setrecursionlimit(RECURSION)
    held: dict[str, list] = {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for host, html in zip(batch.column(0), batch.column(1)):
            if html.as_py():
                own, name = wrapper(parse(html.as_py())), host.as_py()
                held[name] = align(held[name], own) if name in held else own
        if len(held) > HELD_HOSTS:
            yield rows()
            held = {}
    if held:
        yield rows()


def _merge(group: pa.Table) -> pa.Table:
    sys.setrecursionlimit(RECURSION)
    out = None
    for w in sorted(group["wrapper"].to_pylist()):
        own = json.loads(w)
        out = own if out is None else align(out, own)
    return pa.table([group["host"].slice(0, 1), pa.array([json.dumps(out)], pa.string())], names=["host", "wrapper"])


def induce(store: Store, pages: DataFrame) -> DataFrame:
    """(host, wrapper) of `pages` (host, html), one row for each host with a page."""
    wrappers = store.put("wrappers-0", pages.mapInArrow(_induce, "host string, wrapper string"))
    turn = 0
    while (most := wrappers.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        turn += 1
        salts = -(-most // FAN_IN)
        salted = wrappers.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
        wrappers = store.put(f"wrappers-{turn}", salted.groupBy("host", "salt").applyInArrow(_merge, "host string, wrapper string"))
    return wrappers


#: Bytes of all wrappers up to which they are sent to every task; more are joined by host.
BROADCAST_BYTES = 8 << 20


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) of every page: blocks of the article joined by two line feeds.

    Any html gives a text, however deep or broken; a page costs time about in proportion to its length.
    Null and empty html gives an empty text. Pages whose url is null or names no host share one
    wrapper. Repeated rows come back repeated, null ids as they are; further columns are ignored.
    A page without any article element gets the text that is not furniture.
    """
    spark = pages.sparkSession
    store = Store(spark, "html_extract")
    own = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), host_of(F.col(url_column)).alias("host"), F.col(html_column).alias("html"))
    wrappers = induce(store, own.select("host", "html"))
    size = wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    joined = own.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(RECURSION)
        known: dict[str | None, Rules] = {}
        for batch in batches:
            out = []
            for html, w in zip(batch.column(2), batch.column(3)):
                name = w.as_py()
                if name not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[name] = Rules(json.loads(name) if name else [])
                out.append(main_text(html.as_py(), known[name]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    return joined.mapInArrow(run, "page_id long, url string, text string")
