"""Main-text extraction with wrappers: union-free regular expressions inferred from pages of one host.

A page becomes a stream of tags and texts. Groups that repeat side by side are folded into one repeated group. The
streams of a host's pages are aligned one after another into its wrapper: where two texts differ, the text becomes a slot;
where tags differ, what only one side has becomes optional; a group that repeats on one side and stands alone on the other
becomes a repeated group. A text that fills one slot on most pages of a host is template. Copies of a page count once, so
no page is template for having copies; nor is what fills a slot that few of the host's pages have.

The wrapper then tells where the article is, without looking at names of tags or classes: of the elements that hold most of
the text that is not in links (`region_share`), the innermost one, widened to its parents as long as these add neither links
nor texts that all pages share. A page's own stream is matched with its host's wrapper; texts whose slots lie in that region
are the article's. Lists of tags, roles and classes only break ties: they drop menus, comments, forms or adverts inside the
region, and decide alone for pages of which the wrapper tells nothing (hosts with few pages, structures of their own). There,
an article or main element holds the text if there is one, and blocks of two or more links and nothing else are menus.
Paragraphs that at least `template_share` of a host's distinct pages repeat are template; headings never are. The rest, with
character references decoded, is joined block by block.

Scale: the streams of pages, with hashes for texts, are dealt by host and hash of the page, so copies meet and a hot host
is no hot group; copies within a task are sent once. The distinct ones are folded into one partial wrapper per host and
stream shape within each task. Partial wrappers are merged in a tree: by host and shape, by host and a share of its shapes,
by host. Repeated texts are counted exactly, by host and text. Wrappers are sent to all tasks if their measured size allows;
else they are joined to the pages by host.

Edge cases: null or empty html gives the empty text; a page whose host is unknown, or the only one of its host, is read
without a wrapper; unclosed elements end with what surrounds them; very long pages are read whole, and their streams
are aligned by longest common subsequences like all others; repeated rows are treated alike; null keys pass; ties between elements go to the
innermost; an empty table gives an empty result; other columns pass through (those named like the new ones are replaced).
"""

from __future__ import annotations

import html as entities
import json
import marshal
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlink.llm.common import durable, small_batches
from masterlink.llm.urls import url_host

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|svg|iframe|object|select)\b(?:"[^"]*"|'[^']*'|[^'">])*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)|([^<]+|<)""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w-])hidden(?![\w-])""")
# Element kinds of HTML and words in class names that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("nav footer aside form script style head title button menu dialog noscript template".split())
PLAIN = frozenset("script style head title noscript template".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote".split()) | INLINE
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adbox banner sponsor sponsored promo promotion sidebar side aside comment comments commentlist reply replies "
    "discussion disqus notice notices cookie cookies consent alert warning gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations menu nav navbar navigation breadcrumb breadcrumbs footer header masthead toolbar pagination pager tags widget skip hidden".split()
)
#: Of these words, ones that also name the layout around an article, and words beside which they name a part of it.
LAYOUT = frozenset("sidebar side aside header footer nav navbar menu widget ad ads skip hidden".split())
CONTENT = frozenset("article post entry story content main body page text".split())
CLOSES_P = frozenset("p div ul ol li dl table section article header footer nav aside form h1 h2 h3 h4 h5 h6 blockquote pre hr main figure address fieldset".split())


@dataclass(frozen=True)
class HtmlParams:
    #: Nodes of the longest group that is looked for as a repeat.
    longest_repeat: int = 12
    #: Distinct pages of a host from which texts may count as template, and the share of them a text must be on.
    least_pages: int = 8
    template_share: float = 0.8
    #: Share of a host's text outside links that its article's element holds.
    region_share: float = 0.8
    #: Whether lists of tags, roles and classes break ties.
    lists: bool = True
    #: Texts that a slot remembers for people who read the wrapper; no decision rests on them.
    remembered: int = 6
    #: Cells of a table of common subsequences that are held at once; beyond, rows are computed again, to the same result.
    most_cells: int = 1_000_000
    #: Shares of a host's shapes that are merged apart before the last merge.
    tree: int = 32
    #: Partial wrappers held by a task, and bytes of wrappers that are sent to all tasks.
    held: int = 4000
    #: Texts that a task counts before it sends the counts.
    counted: int = 200_000
    #: Streams that a task sends at once.
    sent: int = 200
    broadcast_bytes: int = 32 << 20


@dataclass
class Page:
    """Symbols of the stream and, for each text, what is known of it."""

    symbols: list[str] = field(default_factory=list)
    texts: list[tuple[int, str, bool, bool, bool, bool]] = field(default_factory=list)  # symbol index, text, dropped, in article, in link, in heading
    blocks: list[int] = field(default_factory=list)  # number of the block of each text
    has_article: bool = False


def kind_of(name: str, attributes: str, in_article: bool = False) -> tuple[str, int]:
    """The symbol of an opening tag, and 0, or 1 or 2 if its class, id, role or style marks it as not the article.

    1: the mark may also be of layout around the article; 2: it is not. Within an article, headings have no marks, and ids
    only as a whole: their parts are words of what the section is about.
    """
    if not attributes.strip(" /\n\t"):
        return name, 0
    classes, mark = [], 0
    for m in ATTRIBUTE.finditer(attributes):
        key = (m[1] or "hidden").lower()
        value = next((v for v in m.groups()[1:] if v is not None), "").lower()
        if key in ("class", "id"):
            words = re.split(r"[\s_]+", value)
            for word in words:
                parts = {word} if in_article and key == "id" else {word, *word.split("-")}
                found = parts & MARKS
                if found and name not in ("html", "body", "article", "main") and not (found <= {"header", "side"} and parts & CONTENT):
                    mark = max(mark, 1 if found <= LAYOUT else 2)
                elif found - LAYOUT and name == "article":
                    mark = 2
            classes += [w for w in words if w and key == "class" and not any(c.isdigit() for c in w)]
        elif key == "role":
            mark = max(mark, 2 * (value in ROLES))
            classes += [value] if value == "main" else []
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            mark = 2
    return ".".join([name, *sorted(set(classes))]), 0 if in_article and name in HEADINGS else mark


def parse(source: str, lists: bool = True) -> Page:
    """Reads a page leniently, in one pass.

    A mark of layout on an element is taken back when the element turns out to hold the article, a main element or the
    top heading.
    """
    page, block = Page(), 0
    stack: list[tuple[str, bool, int, bool]] = []  # name, never holds the article, number of its mark, opens the article
    never_kinds = NEVER if lists else PLAIN
    never = articles = links = marks = headings = 0
    open_marks: tuple[int, ...] = ()
    hard: set[int] = set()
    cleared: set[int] = set()
    texts: list[tuple[int, str, bool, tuple[int, ...], bool, bool, bool]] = []

    def pop() -> None:
        nonlocal never, articles, links, headings, open_marks
        name, drops, mark, opens = stack.pop()
        never -= drops
        articles -= opens
        links -= name == "a"
        headings -= name in HEADINGS
        if mark:
            open_marks = open_marks[:-1]

    def close(name: str) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                while len(stack) > k:
                    pop()
                return

    def keep(symbol: int, text: str) -> None:
        texts.append((symbol, text, never > 0, open_marks, articles > 0, links > 0, headings > 0))
        page.blocks.append(block)

    for m in TOKEN.finditer(source):
        if (text := m[5]) is not None:
            if text.isspace():
                if texts and page.blocks[-1] == block:
                    keep(-1, " ")
                continue
            keep(len(page.symbols), text)
            page.symbols.append("T")
        elif m[3]:
            name = m[3].lower()
            if name not in INLINE:
                block += 1
            if m[2]:
                page.symbols.append("/" + name)
                if name not in VOID:
                    close(name)
                continue
            symbol, mark = kind_of(name, m[4], articles > 0)
            mark = mark if lists else 0
            page.symbols.append(symbol if name not in ("html", "body") else name)
            if name == "br" and texts and page.blocks[-1] == block:
                keep(-1, " ")
            if name in VOID or m[4].endswith("/") and name not in CLOSES_P:
                continue
            if name in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):  # an open paragraph ends here, unless a container began within
                    if stack[k][0] == "p":
                        close("p")
                        break
                    if stack[k][0] not in INLINE:
                        break
            if name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
                pop()
            inside = never > 0 or any(x in hard for x in open_marks)
            main = lists and (name in ("article", "main") or ".main" in symbol and "role" in m[4].lower()) and not mark and not inside
            if (main or name == "h1") and not inside:
                cleared.update(open_marks)
            page.has_article |= main
            # A header within the article holds its heading.
            drops = name in never_kinds or lists and name == "header" and not articles
            if mark:
                marks += 1
                open_marks = (*open_marks, marks)
                if mark == 2:
                    hard.add(marks)
            stack.append((name, drops, marks if mark else 0, main))
            never += drops
            articles += main
            links += name == "a"
            headings += name in HEADINGS
    page.texts = [(k, t, dropped or any(x not in cleared for x in within), *rest) for k, t, dropped, within, *rest in texts]
    return page


# Wrapper items: [symbol, optional, pages, text hash or None, {text hash: pages}, items of a repeated group or None,
# characters of its texts on all pages, those of them in links].
SYMBOL, OPTIONAL, PAGES, TEXT, FREQUENT, GROUP, CHARS, LINKED = range(8)


def key_of(items: list[list]) -> tuple:
    return tuple(x[SYMBOL] if x[GROUP] is None else ("+", key_of(x[GROUP])) for x in items)


def item(symbol: str, text: tuple[int, int, int] | None = None) -> list:
    """Of a tag, or of a text with its hash, its characters and those in links."""
    key, chars, linked = text or (None, 0, 0)
    return [symbol, False, 1, key, {key: 1} if text else {}, None, chars, linked]


def fold(symbols: list[str], texts: dict[int, tuple[int, int, int]], longest: int) -> tuple[list[list], list[list[int]]]:
    """Items with side-by-side repeats folded, and for each text symbol the list of its places among the items."""
    out: list[list] = []
    keys: list = []
    held: dict[int, list[int]] = {}  # id of an item -> text symbols

    def absorb(into: list[list], other: list[list]) -> None:
        for a, b in zip(into, other, strict=True):
            if b[GROUP] is not None:
                absorb(a[GROUP], b[GROUP])
                continue
            if b[SYMBOL] == "T":
                if a[TEXT] != b[TEXT]:
                    a[TEXT] = None
                for h in b[FREQUENT]:
                    a[FREQUENT][h] = 1
                a[CHARS] += b[CHARS]
                a[LINKED] += b[LINKED]
                held.setdefault(id(a), []).extend(held.pop(id(b), ()))

    for k, symbol in enumerate(symbols):
        x = item(symbol, texts.get(k))
        if symbol == "T":
            held[id(x)] = [k]
        out.append(x)
        keys.append(symbol)
        folded = True
        while folded:
            folded = False
            if not isinstance(keys[-1], tuple) and keys[-1][0] != "/":
                break  # a group ends with a closing tag or another group
            for n in range(1, min(longest, len(keys)) + 1):
                body = tuple(keys[-n:])
                if isinstance(body[0], str) and (body[0] == "T" or body[0][0] == "/"):
                    continue
                if n < len(keys) and keys[-n - 1] == ("+", body):
                    absorb(out[-n - 1][GROUP], out[-n:])
                    del out[-n:], keys[-n:]
                    folded = True
                    break
                if 2 * n <= len(keys) and keys[-n] == keys[-2 * n] and tuple(keys[-2 * n : -n]) == body and not (n == 1 and isinstance(body[0], tuple)):
                    group = out[-2 * n : -n]
                    absorb(group, out[-n:])
                    plus = item("+")
                    plus[GROUP] = group
                    out[-2 * n :], keys[-2 * n :] = [plus], [("+", body)]
                    folded = True
                    break
    place: list[list[int]] = []

    def walk(items: list[list]) -> None:
        for x in items:
            if x[GROUP] is not None:
                walk(x[GROUP])
            elif x[SYMBOL] == "T":
                place.append(held.get(id(x), []))

    walk(out)
    return out, place


def slots(items: list[list]) -> list[list]:
    """The text items in order, those in repeated groups too."""
    return [y for x in items for y in (slots(x[GROUP]) if x[GROUP] is not None else [x] if x[SYMBOL] == "T" else [])]


def zip_merge(into: list[list], other: list[list], remembered: int) -> None:
    """Merge items of the same keys."""
    for a, b in zip(into, other, strict=True):
        a[PAGES] += b[PAGES]
        a[OPTIONAL] = a[OPTIONAL] or b[OPTIONAL]
        if a[GROUP] is not None:
            zip_merge(a[GROUP], b[GROUP], remembered)
        elif a[SYMBOL] == "T":
            a[CHARS] += b[CHARS]
            a[LINKED] += b[LINKED]
            if a[TEXT] != b[TEXT]:
                a[TEXT] = None
            for h, n in b[FREQUENT].items():
                a[FREQUENT][h] = a[FREQUENT].get(h, 0) + n
            if len(a[FREQUENT]) > 4 * remembered:
                a[FREQUENT] = dict(sorted(a[FREQUENT].items(), key=lambda x: (-x[1], x[0]))[:remembered])


def grouped(items: list[list], bodies: set[tuple]) -> list[list]:
    """Single instances of groups that repeat on the other side become repeated groups."""
    for body in sorted(bodies, key=len, reverse=True):
        keys, n, k = list(key_of(items)), len(body), 0
        while k + n <= len(items):
            if tuple(keys[k : k + n]) == body:
                plus = item("+")
                plus[PAGES], plus[GROUP] = items[k][PAGES], items[k : k + n]
                items, keys[k : k + n] = [*items[:k], plus, *items[k + n :]], [("+", body)]
            k += 1
    return items


def common_subsequence(a: tuple, b: tuple, most_cells: int) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, the same one whatever `most_cells` is.

    A row of the table is an integer: bit k from the end of b is unset where the subsequence of the rest of a and of b from
    there on grows by one. If more bits than the room of most_cells cells are needed, rows are kept at intervals and those
    between are computed again.
    """
    n, m = len(a), len(b)
    number: dict = {}
    ka, kb = ([number.setdefault(key, len(number)) for key in side] for side in (a, b))
    places: dict[int, list[int]] = {}
    for j, key in enumerate(kb):
        places.setdefault(key, []).append(m - 1 - j)
    masks: dict[int, int] = {}
    full, most = (1 << m) - 1, max(2, 64 * most_cells // max(1, m))

    def before(i: int, row: int) -> int:
        """The row of a's places from i on, given that from i + 1 on."""
        key = ka[i]
        if (at := places.get(key)) is None:
            return row
        if (mask := masks.get(key)) is None:
            bits = bytearray(m // 8 + 1)
            for k in at:
                bits[k >> 3] |= 1 << (k & 7)
            if len(masks) >= most:
                masks.clear()
            mask = masks[key] = int.from_bytes(bits, "little")
        met = row & mask
        return ((row + met) | (row - met)) & full

    def rows(lo: int, hi: int, row: int) -> Iterator[int]:
        """Rows lo to hi - 1, given row hi."""
        step = -(-(hi - lo) // most)
        kept = []
        for i in range(hi - 1, lo - 1, -1):
            if (i + 1 - lo) % step == 0 or i == hi - 1:
                kept.append((i + 1, row))
            row = before(i, row)
        if step == 1:
            yield row
            yield from (x for k, x in reversed(kept) if k < hi)
            return
        for k, x in reversed(kept):
            yield from rows(lo, k, x)
            lo = k

    out, i, j = [], 0, 0
    found = rows(0, n, full) if n and m else iter(())
    packed = lambda row: row.to_bytes(m // 8 + 1, "little")
    grows = lambda row, j: not row[(m - 1 - j) >> 3] >> ((m - 1 - j) & 7) & 1
    rest = lambda row, j: m - j - (row & ((1 << (m - j)) - 1)).bit_count()
    now = next(found, full)
    here, left = packed(now), rest(now, 0)
    while i < n and j < m and left:
        below = next(found, full)
        under, less = packed(below), rest(below, j)
        while True:
            if ka[i] == kb[j]:
                out.append((i, j))
                less -= grows(under, j)
                j += 1
                break
            if less >= left - grows(here, j):
                break
            left, less, j = left - grows(here, j), less - grows(under, j), j + 1
        i, here, left = i + 1, under, less
    return out


def align(wrapper: list[list], other: list[list], remembered: int, most_cells: int = HtmlParams.most_cells) -> list[list]:
    """The wrapper of both: a longest common subsequence is merged, the rest becomes optional."""
    a_keys, b_keys = key_of(wrapper), key_of(other)
    if a_keys != b_keys:
        repeats = lambda keys: {k[1] for k in keys if isinstance(k, tuple)}
        wrapper, other = grouped(wrapper, repeats(b_keys) - repeats(a_keys)), grouped(other, repeats(a_keys) - repeats(b_keys))
        a_keys, b_keys = key_of(wrapper), key_of(other)
    head = 0
    while head < min(len(a_keys), len(b_keys)) and a_keys[head] == b_keys[head]:
        head += 1
    tail = 0
    while tail < min(len(a_keys), len(b_keys)) - head and a_keys[-1 - tail] == b_keys[-1 - tail]:
        tail += 1
    out = wrapper[:head]
    zip_merge(out, other[:head], remembered)
    a, b = wrapper[head : len(wrapper) - tail], other[head : len(other) - tail]
    ka, kb = a_keys[head : len(a_keys) - tail], b_keys[head : len(b_keys) - tail]
    i = j = 0
    for x, y in [*common_subsequence(ka, kb, most_cells), (len(a), len(b))]:
        for rest in (*a[i:x], *b[j:y]):
            rest[OPTIONAL] = True
            out.append(rest)
        if x < len(a):
            zip_merge([a[x]], [b[y]], remembered)
            out.append(a[x])
        i, j = x + 1, y + 1
    if tail:
        last = wrapper[len(wrapper) - tail :]
        zip_merge(last, other[len(other) - tail :], remembered)
        out += last
    return out


def match(wrapper: list[list], page: list[list], most_cells: int = HtmlParams.most_cells) -> list[list | None]:
    """For each text slot of the page's items, the wrapper's slot that it meets, if any."""
    marked: dict[int, list] = {}

    def twin(items: list[list]) -> list[list]:
        copy = []
        for x in items:
            y = [x[SYMBOL], False, 0, None, {}, twin(x[GROUP]) if x[GROUP] is not None else None, 0, 0]
            if x[GROUP] is None and x[SYMBOL] == "T":
                marked[id(y)] = x
            copy.append(y)
        return copy

    copy = twin(wrapper)
    theirs = slots(page)
    for number, x in enumerate(theirs):
        x[FREQUENT] = {("page", number): 1}
    found: list[list | None] = [None] * len(theirs)
    for x in slots(align(copy, page, 1 << 30, most_cells)):
        for h in x[FREQUENT]:
            if id(x) in marked:
                found[h[1]] = marked[id(x)]
    return found


def dump(items: list[list], remembered: int) -> str:
    def plain(xs: list[list]) -> list:
        return [[x[SYMBOL], int(x[OPTIONAL]), x[PAGES], x[TEXT], sorted(x[FREQUENT].items(), key=lambda f: (-f[1], f[0]))[:remembered], plain(x[GROUP]) if x[GROUP] is not None else None, x[CHARS], x[LINKED]] for x in xs]

    return json.dumps(plain(items), separators=(",", ":"))


def load(text: str) -> list[list]:
    def rich(xs: list) -> list[list]:
        return [[x[0], bool(x[1]), x[2], x[3], dict(map(tuple, x[4])), rich(x[5]) if x[5] is not None else None, x[6], x[7]] for x in xs]

    return rich(json.loads(text))


def regex_of(items: list[list]) -> str:
    """The wrapper as a union-free regular expression, for people."""
    return "".join((f"({regex_of(x[GROUP])})+" if x[GROUP] is not None else "#text" if x[SYMBOL] == "T" and x[TEXT] is None else "text" if x[SYMBOL] == "T" else f"<{x[SYMBOL]}>") + "?" * x[OPTIONAL] for x in items)


def text_hash(text: str) -> int:
    return int.from_bytes(blake2b(" ".join(text.split()).encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


def items_of(page: Page, params: HtmlParams) -> tuple[list[list], list[list[int]]]:
    texts = {k: (text_hash(t), len(t.strip()), len(t.strip()) if link else 0) for k, t, _, _, link, _ in page.texts if k >= 0}
    return fold(page.symbols, texts, params.longest_repeat)


class Element:
    """An element of a wrapper, with the slots inside it."""

    def __init__(self, name: str, parent: Element | None):
        self.name, self.parent, self.children, self.own = name, parent, [], []
        if parent:
            parent.children.append(self)

    def slots(self) -> Iterator[list]:
        """Those of its children too."""
        open_ = [self]
        while open_:
            x = open_.pop()
            yield from x.own
            open_ += x.children


def elements(wrapper: list[list]) -> Element:
    """The tree of a wrapper's tags; those of optional items stand where they are."""
    root = now = Element("", None)
    flat: list[list] = []

    def walk(items: list[list]) -> None:
        for x in items:
            if x[GROUP] is not None:
                walk(x[GROUP])
            else:
                flat.append(x)

    walk(wrapper)
    for x in flat:
        symbol = x[SYMBOL]
        if symbol == "T":
            now.own.append(x)
        elif symbol[0] == "/":
            up = now
            while up.parent and up.name != symbol[1:]:
                up = up.parent
            now = up.parent or now
        elif (name := symbol.split(".")[0]) not in VOID:
            if name in CLOSES_P and now.name == "p" or name == now.name and name in ("li", "tr", "td", "th", "dt", "dd"):
                now = now.parent
            now = Element(name, now)
    return root


def region_of(wrapper: list[list], params: HtmlParams) -> set[int]:
    """The ids of the slots in the element that holds the article; none if the wrapper tells nothing."""
    mass = lambda x: sum(t[CHARS] - t[LINKED] for t in x.slots())
    root = elements(wrapper)
    total, now, heavy = mass(root), root, root
    while heavy:
        now = heavy
        heavy = next((c for c in now.children if c.name not in LEAF and total and mass(c) >= params.region_share * total), None)
    page = ("", "html", "body")
    while now.parent and now.parent.name not in page and now.name not in page:
        inside = {id(t) for t in now.slots()}
        added = [t for t in now.parent.slots() if id(t) not in inside]
        if any(2 * t[LINKED] > t[CHARS] or t[TEXT] is not None for t in added):
            break
        now = now.parent
    return set() if now.name in page else {id(t) for t in now.slots()}


def region_on(page: Element, found: dict[int, list | None], region: set[int]) -> set[int]:
    """The ids of the page's slots in the region, given the wrapper's slot that each of them meets.

    The innermost element around all texts that meet the region is the page's region as a whole, unless that is the page.
    """
    inside = {i for i, slot in found.items() if slot is not None and id(slot) in region}
    now, deeper = page, page
    while deeper:
        now = deeper
        deeper = next((c for c in now.children if c.name not in LEAF and inside and inside <= {id(t) for t in c.slots()}), None)
    if now.name not in ("", "html", "body"):
        inside.update(id(t) for t in now.slots())
    return inside


def main_text(page: Page, template: set[int], region: set[int]) -> tuple[str, bool]:
    """The article's blocks, and whether the wrapper told them; the sets hold symbol numbers of texts."""
    by_wrapper = any(k in region and not dropped for k, _, dropped, *_ in page.texts)
    blocks: dict[int, list[str]] = {}
    links: dict[int, list[bool]] = {}
    kept = False
    for (k, text, dropped, in_article, in_link, in_heading), block in zip(page.texts, page.blocks, strict=True):
        if k >= 0:  # white space goes with the text before it
            kept = not dropped and (k not in template or in_heading) and (k in region if by_wrapper else in_article or not page.has_article)
        if kept:
            blocks.setdefault(block, []).append(text)
            if not text.isspace():
                links.setdefault(block, []).append(in_link)
    out = []
    for block, parts in blocks.items():
        text = " ".join(entities.unescape("".join(parts)).split())
        menu = not by_wrapper and not page.has_article and len(links.get(block, ())) > 1 and all(links[block])
        if text and not menu:
            out.append(text)
    return "\n\n".join(out), by_wrapper


@dataclass(frozen=True)
class HostWrapper:
    """A host's wrapper as text, its number of distinct pages and the hashes of texts that most of them repeat."""

    wrapper: str
    pages: int
    frequent: frozenset[int] = frozenset()


class Extractor:
    """Extracts pages of hosts whose wrappers are known."""

    def __init__(self, params: HtmlParams):
        self.params = params
        self.wrappers: dict[str, tuple[list[list], set[int]]] = {}
        self.matches: dict[tuple, tuple[list[bool], list[bool]]] = {}

    def told(self, host: str, known: HostWrapper | None, page: Page) -> tuple[set[int], set[int]]:
        """Symbol numbers of the page's template texts and of those in the article's region."""
        p = self.params
        if known is None or known.pages < p.least_pages:
            return set(), set()
        items, places = items_of(page, p)
        shape = (host, key_of(items))
        if shape not in self.matches:
            if len(self.wrappers) > 500 or len(self.matches) > 5000:
                self.wrappers.clear()
                self.matches.clear()
            if host not in self.wrappers:
                wrapper = load(known.wrapper)
                self.wrappers[host] = wrapper, region_of(wrapper, p)
            wrapper, inside = self.wrappers[host]
            own, tree = slots(items), elements(items)
            met = match(wrapper, items, p.most_cells)
            within = region_on(tree, {id(x): slot for x, slot in zip(own, met, strict=True)}, inside)
            self.matches[shape] = [slot is not None for slot in met], [id(x) in within for x in own]
        hashes = {k: text_hash(t) for k, t, *_ in page.texts if k >= 0} if known.frequent else {}
        template: set[int] = set()
        region: set[int] = set()
        for aligned, within, symbols in zip(*self.matches[shape], places, strict=True):
            region.update(symbols if within else ())
            template.update(k for k in symbols if aligned and hashes.get(k) in known.frequent)
        return template, region

    def read(self, host: str, known: HostWrapper | None, source: str | None) -> tuple[str, bool]:
        """The main text, and whether the host's wrapper told it."""
        if not source:
            return "", False
        page = parse(source, self.params.lists)
        return main_text(page, *self.told(host, known, page))

    def extract(self, host: str, known: HostWrapper | None, source: str | None) -> str:
        return self.read(host, known, source)[0]


WRAPPERS = "host string, shape string, pages long, wrapper string"


def infer_wrappers(pages: DataFrame, params: HtmlParams = HtmlParams(), url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, distinct pages, wrapper, frequent) of every host; frequent: hashes of texts that most of its pages repeat."""
    rows = pages.select(url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).filter((F.col("host") != "") & (F.length("html") > 0))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, bytes]] = set()
        out: list[tuple[str, bytes, bytes]] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.binary(), pa.binary()))], names=["host", "page", "items"])
            out.clear()
            return batch

        for b in batches:
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = blake2b(source.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                if (host, page) in seen:
                    continue
                if len(seen) >= 1 << 17:  # copies that this task forgets meet after the shuffle
                    seen.clear()
                seen.add((host, page))
                out.append((host, page, marshal.dumps(items_of(parse(source, params.lists), params)[0])))
                if len(out) >= params.sent:
                    yield flush()
        if out:
            yield flush()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, tuple], list] = {}

        def flush() -> pa.RecordBatch:
            out = [(host, str(zlib.crc32(repr(key).encode())) + ":" + str(len(key)), n, dump(items, params.remembered)) for (host, key), (n, items) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], names=["host", "shape", "pages", "wrapper"])

        for b in batches:
            for host, source in zip(b.column(0), b.column(1), strict=True):
                items = marshal.loads(source.as_py())
                known = held.setdefault((host.as_py(), key_of(items)), [0, items])
                if known[0]:
                    zip_merge(known[1], items, params.remembered)
                known[0] += 1
                if len(held) >= params.held:
                    yield flush()
        if held:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct pages of this task by host and text."""
        found: Counter[tuple[str, int]] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array([h for h, _ in found], pa.string()), pa.array([t for _, t in found], pa.int64()), pa.array(list(found.values()), pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=["host", "text", "n"])

        for b in batches:
            for host, source in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found.update({(host, h) for x in slots(marshal.loads(source.as_py())) for h in x[FREQUENT]})
                if len(found) >= params.counted:
                    yield flush()
        if found:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        merged, pages = None, 0
        for r in sorted(group.to_pylist(), key=lambda r: (-r["pages"], r["shape"], r["wrapper"])):
            items = load(r["wrapper"])
            merged = items if merged is None else align(merged, items, params.remembered, params.most_cells)
            pages += r["pages"]
        first = group.slice(0, 1).to_pylist()[0]
        return pa.table([[first["host"]], [first["shape"]], pa.array([pages], pa.int64()), [dump(merged, params.remembered)]], names=["host", "shape", "pages", "wrapper"])

    distinct = small_batches(rows).mapInArrow(read, "host string, page binary, items binary").dropDuplicates(["host", "page"])
    distinct = durable(distinct.select("host", "items").hint("rebalance"))
    partial = distinct.mapInArrow(learn, WRAPPERS)
    by_shape = partial.groupBy("host", "shape").applyInArrow(merge, WRAPPERS)
    branches = by_shape.groupBy("host", F.pmod(F.xxhash64("shape"), F.lit(params.tree)).alias("branch")).applyInArrow(lambda key, group: merge(group), WRAPPERS)
    wrappers = durable(branches.groupBy("host").applyInArrow(merge, WRAPPERS).select("host", "pages", "wrapper"))
    many = wrappers.filter(F.col("pages") >= params.least_pages).select("host", "pages")
    texts = distinct.join(many.select("host"), "host", "left_semi").mapInArrow(count, "host string, text long, n long").groupBy("host", "text").agg(F.sum("n").alias("n"))
    frequent = texts.join(many, "host").filter(F.col("n") >= params.template_share * F.col("pages")).groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("frequent"))
    return wrappers.join(frequent, "host", "left").withColumn("frequent", F.coalesce("frequent", F.array().cast("array<bigint>")))


def extract_main_text(pages: DataFrame, params: HtmlParams = HtmlParams(), url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all but the html, by default) with main_text and by_wrapper (whether the host's wrapper told it)."""
    new = ("main_text", "by_wrapper")
    keep = [c for c in (keep if keep is not None else pages.columns) if c not in (*new, html_col)]
    wrappers = durable(infer_wrappers(pages, params, url_col, html_col).filter(F.col("pages") >= params.least_pages))
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper") + 40 * F.size("frequent")), F.lit(0)).alias("n")).head()["n"]
    rows = pages.select(*(F.col(f"`{c}`") for c in keep), url_host(F.col(url_col)).alias("__host"), F.col(html_col).alias("__html"))
    columns = ("wrapper", "pages", "frequent")
    shared = None
    if size <= params.broadcast_bytes:
        shared = pages.sparkSession.sparkContext.broadcast({r["host"]: HostWrapper(r["wrapper"], r["pages"], frozenset(r["frequent"])) for r in wrappers.toLocalIterator()})
        rows = rows.withColumns({f"__{c}": F.lit(None).cast(wrappers.schema[c].dataType) for c in columns})
    else:
        rows = rows.join(wrappers.select(F.col("host").alias("__host"), *(F.col(c).alias(f"__{c}") for c in columns)), "__host", "left")
        rows = rows.select(*(f"`{c}`" for c in keep), "__host", "__html", *(f"__{c}" for c in columns))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(params)
        for b in batches:
            n = len(keep)
            hosts, sources, *given = (b.column(n + k).to_pylist() for k in range(5))
            known = [shared.value.get(h) for h in hosts] if shared else [w and HostWrapper(w, p, frozenset(f)) for w, p, f in zip(*given, strict=True)]
            found = [extractor.read(h, w, s) for h, w, s in zip(hosts, known, sources, strict=True)]
            more = [pa.array([t for t, _ in found], pa.string()), pa.array([w for _, w in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + more, names=[*keep, *new])

    schema = rows.drop("__host", "__html", *(f"__{c}" for c in columns)).withColumns({new[0]: F.lit(""), new[1]: F.lit(False)}).schema
    return small_batches(rows).mapInArrow(apply, schema)
