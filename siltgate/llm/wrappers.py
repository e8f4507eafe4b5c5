"""Main text of web pages by wrapper inference.

Pages of one host mostly come from few templates.  Per host all pages are aligned into a
union-free regular expression over elements and texts: pages of equal structure first,
then the structures with each other, in rounds of groups of about ``FAN``.  In it elements
in the same order match; one that only some pages have becomes optional; neighbours (up to
four in a row) that come again become a repeated group; what differs becomes a slot.

Every item of the wrapper, a text, an element or a repeated run, knows whether all it holds
has been the same wherever it occurred, and on how many pages of different content.  What
never changed over ``TEMPLATE_PAGES`` of them is template and goes, whatever it is called
and wherever it stands, also inside an article; copies of a page count once.

What is left changes from page to page, and there alignment cannot tell an article from,
say, a list of links.  So the wrapper also names the part that holds the article: elements
that say so, and of several the one with most running text.  Only outside that part do
names throw out menus, adverts, notices and the like; inside it only what is no text of an
article in any sense goes (``nav``, ``aside``, ``form``, comments, adverts, notices), and
no word that an article's own section may bear (``related``, ``share``, ``legal``) counts.

Wrappers do not depend on the order of pages or on how they are dealt to tasks, and copies
of a page change nothing.  A wrapper grows with the different structures of its host.
Nothing here recurses, so pages may be nested as deeply as they like; long lists of
different children are aligned at the children that both sides have once.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.sources import staging_dir, written

#: Structures of a host, about, that one group aligns in a round.
FAN = 64
#: Characters of pages that a task holds as wrappers before it hands them on.
HELD_CHARS = 8_000_000
#: Pages of different content that must agree on an item before it is template.
TEMPLATE_PAGES = 3
#: Longest blocks of a page that say what it is about if no element does.
_TELLING = 3
#: Cells of the table that aligns two lists exactly; longer ones are aligned at anchors.
_TABLE = 250_000
#: How far a greedy match may jump between anchors.
_JUMP = 64
BROADCAST_BYTES = 32 * 1024 * 1024
_PERIOD = 4
_EDGE = 3

#: Elements whose text is never part of an article.
SKIPPED = frozenset(
    "head script style template svg iframe select option button "
    "textarea input form nav footer aside menu dialog".split()
)
#: Elements that only format a run of text.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr nobr acronym".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe template svg".split())
_ENDS = {  # an element that ends an open one of these by starting
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_BOILER = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|advertising|sponsor\w*|promo\w*|banner\w*|cookies?|"
    r"consent|notices?|gdpr|newsletter|subscri\w+|signup|sidebar\w*|side|menus?|nav|navbar|"
    r"navigation|breadcrumbs?|footer|foot|header|masthead|topbar|comment\w*|respond|replies|"
    r"reply|discussion|disqus|related|recommended|share|sharing|social|widgets?|popup|modal|"
    r"overlay|login|search|pagination|pager|toolbar|copyright|legal|skip|alert|"
    r"contentinfo|complementary|dialog|form)(?:$|[^a-z])"
)
#: What is no part of an article even inside it, though it changes from page to page.
_NEVER = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|advertising|sponsor\w*|promo\w*|banner\w*|cookies?|"
    r"consent|notices?|gdpr|newsletter|subscri\w+|signup|sidebar\w*|nav|navbar|navigation|"
    r"breadcrumbs?|comment\w*|respond|replies|disqus|social|widgets?|popup|modal|overlay|login|"
    r"pagination|pager|toolbar)(?:$|[^a-z])"
)
_MODIFIER = re.compile(r"(?:has|with|without|no|is)[-_]|(?:article|post|entry|content|page)[-_]?(?:header|title)$")
_MAIN = re.compile(r"(?:^|[^a-z])(?:article|main|content|post|entry|story|body)(?:$|[^a-z])")
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Node:
    """An element of a page: name, what its class, id and role say, children in order."""

    __slots__ = ("children", "hint", "name")

    def __init__(self, name: str, hint: str = ""):
        self.name, self.hint, self.children = name, hint, []

    @property
    def key(self) -> str:
        return f"{self.name}.{self.hint}" if self.hint else self.name


def parse(page: str) -> Node:
    """Tree of block elements; inline elements dissolve into the text around them.

    Children are ``Node`` or ``str``.  End tags that match nothing open are ignored; a
    missing one is implied by the end of an element around it.
    """
    root = Node("#page")
    stack, at, n = [root], 0, len(page)
    opened: Counter[str] = Counter()
    text: list[str] = []

    def flush() -> None:
        joined = " ".join(html_lib.unescape("".join(text)).split())
        text.clear()
        if joined:
            stack[-1].children.append(joined)

    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            text.append(page[at:])
            break
        text.append(page[at : tag.start()])
        at = tag.end()
        if tag["cdata"] is not None:
            text.append(html_lib.escape(tag["cdata"], quote=False))
            continue
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if name == "br":
            text.append(" ")
        elif name in INLINE:
            continue
        elif tag["end"]:
            if opened[name]:
                flush()
                while opened[name]:
                    closed = stack.pop().name
                    opened[closed] -= 1
                    if closed == name:
                        break
        elif name in _RAW:
            flush()
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else n
            stack[-1].children.append(Node(name))
        else:
            flush()
            if stack[-1].name == "p" or stack[-1].name in _ENDS.get(name, ()):
                opened[stack.pop().name] -= 1
            hint = " ".join(
                sorted((a or b or c).lower() for _, a, b, c in _NAMED.findall(tag["attrs"] or ""))
            )
            node = Node(name, re.sub(r"\d+", "0", hint))
            stack[-1].children.append(node)
            if name not in _VOID and not (tag["attrs"] or "").endswith("/"):
                stack.append(node)
                opened[name] += 1
    flush()
    return root


# A wrapper is a list of items; an item is [kind, key, times, seen, edges, items below]:
#   "e", an element; "t", a text, with the key #text; "g", several neighbours that repeat
#   times: "1", "?" optional, "+" repeated, "*" both
#   seen: [digest of all it holds, smallest hashes of the contents of pages it was on, up to
#   TEMPLATE_PAGES of them], or None for a slot
#   edges: of what repeats, what was seen in the first and in the last _EDGE times around:
#   neighbours of one name need not be of one kind; else None
KIND, KEY, TIMES, SEEN, EDGES, BELOW = range(6)


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), signed=True)


def _combined(digests: list[int]) -> int:
    return digests[0] if len(digests) == 1 else _digest(",".join(map(str, digests)))


def _preorder(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def page_items(page: str) -> list:
    """Folded items of one page, marked with a hash of what the page is about."""
    root = parse(page)
    contents = [_digest(_about(root))]
    made: dict[int, list] = {}
    for node in reversed(_preorder(root)):  # children before parents
        items = [
            ["t", "#text", "1", [_digest(c), contents], None, []] if isinstance(c, str) else made.pop(id(c))
            for c in node.children
        ]
        digest = _combined([0, *(i[SEEN][0] for i in items)])
        made[id(node)] = ["e", node.key, "1", [digest, contents], None, fold(items)]
    return made[id(root)][BELOW]


def _about(root: Node) -> str:
    """The text of the part that calls itself the article, else the longest blocks."""
    main = _named_main(root)
    if main:
        return "\n".join(b for node in main for b in _blocks(node, {}, True))
    blocks = _blocks(root, {}, False)
    return "\n".join(sorted(sorted(blocks, key=lambda b: (-len(b), b))[:_TELLING]))


def _shape(keys: list[str]) -> list[tuple[str, str, list]]:
    """How items with these keys fold: ``(kind, key, places)``.

    Kind ``one`` has one place, ``run`` the places of equal neighbours, ``group`` a list for
    each time around, of entries of the same form.
    """
    entries: list[tuple[str, str, list]] = [("one", key, [k]) for k, key in enumerate(keys)]
    for period in range(1, _PERIOD + 1):
        out, k = [], 0
        names = [e[1] for e in entries]
        while k < len(entries):
            unit, times = names[k : k + period], 1
            if len(unit) < period or unit == ["#text"]:
                out.append(entries[k])
                k += 1
                continue
            while names[k + times * period : k + (times + 1) * period] == unit:
                times += 1
            if times == 1:
                out.append(entries[k])
                k += 1
            elif period == 1:
                out.append(("run", unit[0], [p for e in entries[k : k + times] for p in e[2]]))
                k += times
            else:
                turns = [entries[k + t * period : k + (t + 1) * period] for t in range(times)]
                out.append(("group", "+".join(unit), turns))
                k += times * period
        entries = out
    return entries


def fold(items: list) -> list:
    """Turn neighbours of one page that come again, alone or up to four in a row, into repeats."""
    return _folded(_shape([i[KEY] for i in items]), items)


def _folded(shape: list, items: list) -> list:
    # Groups within groups are at most _PERIOD deep, so this may call itself.
    out = []
    for kind, key, places in shape:
        if kind == "one":
            out.append(items[places[0]])
            continue
        if kind == "run":
            turns = [[items[p]] for p in places]
        else:
            turns = [_folded(turn, items) for turn in places]
        merged = turns[0]
        for turn in turns[1:]:
            merged = merge(merged, turn)
        held = [_all_seen([i[SEEN] for i in turn]) for turn in turns]
        edges = [held[:_EDGE], held[: -_EDGE - 1 : -1]]
        if kind == "run":
            out.append([*merged[0][:TIMES], "+", _all_seen(held), edges, merged[0][BELOW]])
        else:
            out.append(["g", key, "+", _all_seen(held), edges, merged])
    return out


def _all_seen(parts: list) -> list | None:
    """What was seen of several parts of one page together."""
    return None if None in parts else [_combined([s[0] for s in parts]), parts[0][1]]


def _times(a: str, b: str) -> str:
    if "?" in (a, b) or "*" in (a, b):
        return "*" if "+" in (a, b) or "*" in (a, b) else "?"
    return "+" if "+" in (a, b) else "1"


def _optional(item: list) -> list:
    return [*item[:TIMES], "*" if item[TIMES] in "+*" else "?", *item[SEEN:]]


def _seen(a: list | None, b: list | None) -> list | None:
    if a is None or b is None or a[0] != b[0]:
        return None
    return [a[0], a[1] if a[1] is b[1] else sorted({*a[1], *b[1]})[:TEMPLATE_PAGES]]


def _edges(a: list, b: list) -> list | None:
    """Edges of two items joined; what does not repeat is its own first and last."""
    if a[EDGES] is None and b[EDGES] is None:
        return None
    out = []
    for one, other in zip(a[EDGES] or [[a[SEEN]]] * 2, b[EDGES] or [[b[SEEN]]] * 2, strict=True):
        short = min(len(one), len(other))
        joined = [_seen(x, y) for x, y in zip(one, other, strict=False)]
        out.append(joined + one[short:] + other[short:])
    return out


def _constant(seen: list | None) -> bool:
    return seen is not None and len(seen[1]) >= TEMPLATE_PAGES


def is_template(item: list) -> bool:
    """Whether an item was the same on enough pages of different content."""
    return _constant(item[SEEN])


def _template_turns(item: list, n: int) -> list[bool]:
    """Which of ``n`` times around are template, by the edges of a repeated item."""
    out = [False] * n
    if item[EDGES]:
        for places, seen in zip((range(n), range(n - 1, -1, -1)), item[EDGES], strict=True):
            for place, s in zip(places, seen, strict=False):
                out[place] |= _constant(s)
    return out


def _matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A long common subsequence of two lists of keys, as pairs of places.

    The longest one for lists of ordinary length.  Longer ones are cut at keys that both
    have once, in the order of the longest rising run of them; what lies between is aligned
    by table if it is short and greedily if not.
    """
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    tail = 0
    while tail < min(len(a), len(b)) - same and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    pairs = [(k, k) for k in range(same)]
    x, y = a[same : len(a) - tail], b[same : len(b) - tail]
    if len(x) * len(y) <= _TABLE:
        found = _by_table(x, y)
    else:
        found, i, j = [], 0, 0
        for p, q in [*_anchors(x, y), (len(x), len(y))]:
            part = x[i:p], y[j:q]
            close = _by_table if len(part[0]) * len(part[1]) <= _TABLE else _greedily
            found += [(i + m, j + n) for m, n in close(*part)]
            if p < len(x):
                found.append((p, q))
            i, j = p + 1, q + 1
    pairs += [(same + i, same + j) for i, j in found]
    return pairs + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def _by_table(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of keys that both lists have once, in the longest run that rises in both."""
    once_a = {k for k, n in Counter(a).items() if n == 1}
    place = {k: j for j, k in enumerate(b) if k in once_a}
    once = {k for k, n in Counter(b).items() if n == 1} & once_a
    pairs = [(i, place[k]) for i, k in enumerate(a) if k in once]
    ends: list[int] = []  # least last place of a rising run of each length
    at: list[int] = []
    back = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        length = bisect_left(ends, j)
        back[n] = at[length - 1] if length else -1
        if length == len(ends):
            ends.append(j)
            at.append(n)
        else:
            ends[length], at[length] = j, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _greedily(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    places: dict[str, list[int]] = {}
    for j, key in enumerate(b):
        places.setdefault(key, []).append(j)
    pairs, j = [], 0
    for i, key in enumerate(a):
        where = places.get(key, [])
        k = bisect_left(where, j)
        if k < len(where) and where[k] - j <= _JUMP:
            pairs.append((i, where[k]))
            j = where[k] + 1
    return pairs


def merge(one: list, other: list) -> list:
    """Generalise a wrapper so that it also matches other (folded) items."""
    whole: list = []
    todo = [(one, other, whole)]
    while todo:
        a, b, out = todo.pop()
        i = j = 0
        for p, q in [*_matches([x[KEY] for x in a], [x[KEY] for x in b]), (len(a), len(b))]:
            out += [_optional(x) for x in a[i:p]] + [_optional(x) for x in b[j:q]]
            if p < len(a):
                x, y, below = a[p], b[q], []
                seen = _seen(x[SEEN], y[SEEN])
                out.append([x[KIND], x[KEY], _times(x[TIMES], y[TIMES]), seen, _edges(x, y), below])
                if x[BELOW] or y[BELOW]:
                    todo.append((x[BELOW], y[BELOW], below))
            i, j = p + 1, q + 1
    return whole


def align(wrappers: list[list]) -> list:
    """One wrapper of several, aligned in the given order."""
    whole: list | None = None
    for items in wrappers:
        whole = items if whole is None else merge(whole, items)
    return whole or []


def infer(pages: list[str]) -> list:
    """Wrapper of the pages of one host, aligned in the given order."""
    return align([page_items(page) for page in pages])


def _walk(items: list) -> Iterator[tuple[int, list]]:
    """Items and their depth, each before those below it."""
    todo = [(0, i) for i in reversed(items)]
    while todo:
        depth, item = todo.pop()
        yield depth, item
        todo += [(depth + 1, i) for i in reversed(item[BELOW])]


def to_text(items: list) -> str:
    """A wrapper as JSON: its items in order, each with its depth."""
    return json.dumps([[depth, *item[:BELOW]] for depth, item in _walk(items)], separators=(",", ":"))


def from_text(text: str) -> list:
    whole: list = []
    open_lists = [whole]
    for depth, *fields in json.loads(text):
        item = [*fields, []]
        open_lists[depth].append(item)
        del open_lists[depth + 1 :]
        open_lists.append(item[BELOW])
    return whole


def _structure(items: list) -> int:
    """Hash of the items without what was seen."""
    return _digest("\n".join(f"{depth} {i[KIND]} {i[KEY]}" for depth, i in _walk(items)))


def _says(key: str) -> str | None:
    """What an element's name, class, id or role says: skip, main or nothing."""
    name, _, hint = key.partition(".")
    if name in SKIPPED:
        return "skip"
    if name in ("article", "main"):
        return "main"
    if hint and name != "body":
        # "with-sidebar" is not a sidebar, and an article's own header holds its title.
        words = [w for w in hint.split() if not _MODIFIER.match(w)]
        if any(_BOILER.search(w) for w in words):
            return "skip"
        if any(_MAIN.search(w) for w in words):
            return "main"
    return None


def _never(key: str) -> bool:
    """Whether an element is no part of an article even where it stands inside one."""
    name, _, hint = key.partition(".")
    return name in SKIPPED or any(_NEVER.search(w) for w in hint.split() if not _MODIFIER.match(w))


def main_path(wrapper: list) -> list[str]:
    """Keys from the page down to the part that holds the article, [] if none is named.

    Of several parts that say so, an article or main element goes first, then the one with
    most running text that changes from page to page.
    """
    weight: dict[int, float] = {}
    for _, item in reversed(list(_walk(wrapper))):  # what is below comes first
        if item[KIND] == "t":
            weight[id(item)] = 1.0 if item[SEEN] is None else 0.0
            continue
        inner = sum(weight[id(i)] for i in item[BELOW])
        if item[KIND] == "e":
            inner *= (3 if item[KEY].partition(".")[0] == "p" else 1) * (2 if item[TIMES] in "+*" else 1)
            if _says(item[KEY]) == "skip":
                inner = 0.0
        weight[id(item)] = inner
    best, found = (-1.0, -1), []
    todo = [(i, ()) for i in reversed(wrapper)]
    while todo:
        item, path = todo.pop()
        if item[KIND] == "t" or (item[KIND] == "e" and _says(item[KEY]) == "skip"):
            continue
        if item[KIND] == "e":
            path = (path, item[KEY])
            if _says(item[KEY]) == "main":
                strong = item[KEY].partition(".")[0] in ("article", "main")
                depth, link = 0, path
                while link:
                    depth, link = depth + 1, link[0]
                if (weight[id(item)] + 1e6 * strong, depth) > best:
                    best, found = (weight[id(item)] + 1e6 * strong, depth), path
        todo += [(i, path) for i in reversed(item[BELOW])]
    keys = []
    while found:
        found, key = found
        keys.append(key)
    return keys[::-1]


def extract(page: str | None, wrapper: list) -> str:
    """Blocks of the article in page order, joined by line feeds; empty if there are none."""
    return _extract(page, wrapper, main_path(wrapper)[-1:])


def _extract(page: str | None, wrapper: list, main: list[str]) -> str:
    if not page:
        return ""
    root = parse(page)
    gone = template_parts(root, wrapper) if wrapper else {}
    found = main and _find(root, lambda n: n.key == main[0])
    parts = found or _named_main(root)
    return "\n".join(b for node in parts or [root] for b in _blocks(node, gone, bool(parts)))


def template_parts(root: Node, wrapper: list) -> dict[int, set[int]]:
    """Read a page along its host's wrapper: places of the children of each node (by ``id``)
    that are template."""
    gone: dict[int, set[int]] = {}
    todo: list = [(root, None, wrapper)]
    while todo:
        node, entries, items = todo.pop()
        if entries is None:
            entries = _shape([c.key if isinstance(c, Node) else "#text" for c in node.children])
        for i, j in _matches([e[1] for e in entries], [x[KEY] for x in items]):
            (kind, _, places), item = entries[i], items[j]
            if is_template(item):
                gone.setdefault(id(node), set()).update(_places(entries[i]))
                continue
            for turn, template in zip(places, _template_turns(item, len(places)), strict=True):
                if template:
                    gone.setdefault(id(node), set()).update(_places((kind, "", [turn])))
                elif kind == "group":
                    todo.append((node, turn, item[BELOW]))
                elif isinstance(node.children[turn], Node) and node.children[turn].children:
                    todo.append((node.children[turn], None, item[BELOW]))
    return gone


def _places(entry: tuple[str, str, list]) -> list[int]:
    kind, _, places = entry
    if kind != "group":
        return places
    return [p for turn in places for e in turn for p in _places(e)]


def _named_main(root: Node) -> list[Node]:
    return _find(root, lambda n: n.name in ("article", "main")) or _find(
        root, lambda n: _says(n.key) == "main"
    )


def _find(root: Node, wanted) -> list[Node]:
    """Outermost wanted elements outside skipped parts, in page order."""
    found = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node is not root and _says(node.key) == "skip":
            continue
        if node is not root and wanted(node):
            found.append(node)
            continue
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def _blocks(top: Node, gone: dict[int, set[int]], inside: bool) -> list[str]:
    """Texts below ``top`` in page order without what is ``gone`` and what names throw out."""
    blocks: list[str] = []
    todo: list[Node | str] = [top]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            blocks.append(node)
            continue
        left_out = gone.get(id(node), ())
        kept: list[Node | str] = []
        for k, child in enumerate(node.children):
            if k in left_out:
                continue
            if isinstance(child, str):
                if node.name != "title":
                    kept.append(child)
            elif inside:
                if not _never(child.key):
                    kept.append(child)
            elif _says(child.key) != "skip" and child.name != "header":
                kept.append(child)
        todo += reversed(kept)
    return blocks


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    return F.coalesce(
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
        F.lit(""),
    )


def _of_structures(pages: DataFrame) -> DataFrame:
    """``host, s, wrapper``: pages of equal structure ``s`` as one wrapper each.

    Tasks align theirs first, so a host sends a row per structure and task, however many
    pages it has.
    """
    most = HELD_CHARS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], list] = {}
        chars = 0

        def out() -> pd.DataFrame:
            return pd.DataFrame(
                [(host, s, to_text(items)) for (host, s), items in held.items()],
                columns=["host", "s", "wrapper"],
            )

        for batch in batches:
            for host, page in zip(batch["host"], batch["html"], strict=True):
                items = page_items(page)
                at = host, _structure(items)
                if at in held:
                    held[at] = merge(held[at], items)
                    continue
                held[at] = items
                chars += len(page)
                if chars > most:
                    yield out()
                    held, chars = {}, 0
        if held:
            yield out()

    parts = (
        pages.select(host_of(F.col("url")).alias("host"), "html")
        .filter("html IS NOT NULL")
        .mapInPandas(run, "host string, s long, wrapper string")
    )
    return _aligned(parts, ["host", "s"], "host", "s")


def _aligned(parts: DataFrame, group: list[str], *kept: str) -> DataFrame:
    """One wrapper of each group, aligned in the order of ``s``."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("s", kind="stable")["wrapper"]
        if len(ordered) > 1:
            ordered = [to_text(align([from_text(w) for w in ordered]))]
        return pd.DataFrame([[*key, next(iter(ordered))]], columns=[*group, "wrapper"])

    schema = ", ".join(f"{c} {'string' if c == 'host' else 'long'}" for c in group)
    return parts.groupBy(*group).applyInPandas(run, f"{schema}, wrapper string").selectExpr(*kept, "wrapper")


def learn_wrappers(pages: DataFrame, fan: int | None = None) -> DataFrame:
    """``host, wrapper`` (JSON), one row per host, from all its pages.

    Structures are aligned in rounds, until each host has about ``fan`` or fewer partial
    wrappers left, so no group grows with the table.
    """
    fan = fan or FAN
    spark = pages.sparkSession
    parts = written(_of_structures(pages), staging_dir(spark, "structures"))
    while True:
        sizes = parts.groupBy("host").agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n").alias("n")).first()["n"] or 0) <= 2 * fan:
            return _aligned(parts, ["host"], "host")
        dealt = parts.join(sizes, "host").selectExpr(
            "host", "s", "wrapper", f"pmod(xxhash64(s), CAST(ceil(n / {fan}) AS INT)) AS part"
        )
        parts = written(_aligned(dealt, ["host", "part"], "host", "part AS s"), staging_dir(spark, "structures"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    NULL and empty pages, and pages without an article, give an empty text; a NULL url is
    a host of its own.  Repeated rows give repeated rows.  Wrappers are written and
    measured; up to ``BROADCAST_BYTES`` they go to the pages, beyond that the pages are
    shuffled to them.
    """
    spark = pages.sparkSession
    wrappers = written(
        learn_wrappers(pages).select(F.col("host").alias("_host"), "wrapper"),
        staging_dir(spark, "wrappers"),
    )
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    width = F.sum(F.octet_length("_host") + F.octet_length("wrapper") + 64)
    if (wrappers.agg(width.alias("n")).first()["n"] or 0) <= BROADCAST_BYTES:
        # Each process gets one copy, and reads each wrapper it needs once.
        shared = spark.sparkContext.broadcast({r["_host"]: r["wrapper"] for r in wrappers.toLocalIterator()})
        joined = rows.withColumn("wrapper", F.lit(None).cast("string"))
    else:
        shared = None
        joined = rows.join(wrappers, F.col("host") == F.col("_host"), "left").drop("_host")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}

        def wrapper_of(host: str, text: str | None) -> tuple[list, list[str]]:
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                text = shared.value.get(host) if shared else text
                items = from_text(text) if isinstance(text, str) else []
                known[host] = items, main_path(items)[-1:]
            return known[host]

        for batch in batches:
            texts = [
                _extract(page, *wrapper_of(host, text))
                for page, host, text in zip(batch["html"], batch["host"], batch["wrapper"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return joined.mapInPandas(
        run, f"page_id {types['page_id']}, url string, text string, n_chars long"
    )
