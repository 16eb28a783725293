"""Main text of web pages, by wrappers inferred for each host.

A wrapper is a union-free regular expression over a host's pages: elements with text
slots, in which a part may be optional or repeated, but never one of several.  A page is
such an expression to begin with, its tandem repeats folded into groups.  Aligning two
expressions pairs their equal elements in order; what only one of them has becomes
optional.  An element's whole text goes into the expression as a hash: where two pages differ it becomes
a slot, else it stays a constant of the template.  So a host's wrapper grows page by page.  Its
elements also count the text that its pages have there.

From the wrapper follow the places of the main text: its article elements, its main element
and elements named for content, the later ones where they hold more than the earlier and
are not in or around them; else the innermost container that holds nearly all of the other text
outside links, with the headings and paragraphs that come before it.  A page's text is read from those places without the parts whose
tag, class, id or role says menu, header, footer, sidebar, notice, advert, form or comment,
and without the template: blocks outside articles whose text is constant over all pages of the
host, if it has three or more and its slots hold more text than they.  What an article element
holds is its own, and an optional or a single page's block is no template.  A page that has
none of its host's places is read by the wrapper of its own, which has no template.

Wrappers are merged inside each task first, so a hot host sends one expression a task; equal
ones go once; the merge over tasks streams through a host's sorted rows.

Nulls: null or empty html has an empty text.  A null URL or one without a host belongs to the
host ''.  Broken markup is read as far as it goes.  Repeated rows are rows.  Columns beside
the named ones do not take part.
"""

from __future__ import annotations

import functools
import html
import itertools
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quoteloom.llm.common import pieces
from quoteloom.llm.urls import host_of
from quoteloom.shared import land

MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_WORD = re.compile("[a-z]+")

# What HTML says about its elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small"
    " span strike strong sub sup time tt u var wbr img del".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_LIKE = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPE = set("ul ol dl table article section div nav aside body".split())
NEVER = set(
    "head script style noscript template iframe svg nav footer aside form button select textarea"
    " menu dialog object canvas audio video title".split()
)
NEVER_NAMES = set(
    "nav navbar navigation menu masthead footer sidebar aside widget ad ads adv advert adverts"
    " advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent notice"
    " notices alert popup modal newsletter subscribe signup login comment comments disqus respond"
    " replies share sharing social related recommended breadcrumb breadcrumbs pagination pager"
    " toolbar contentinfo complementary search".split()
)
HEAD_NAMES = {"header"}
WHOLE = set("html body main article".split())  # no name drops these
# what says where or how much in a name and not what: "comment-list" is as good as "comment"
PLACE_WORDS = set(
    "left right top bottom main site page global primary secondary list slot box area section block"
    " container wrapper wrap inner outer bar panel link links button buttons item items user users"
    " reader readers posts stories articles topics".split()
)
CONTENT_NAMES = set("article content post entry story main".split())
LEADING = set("h1 h2 h3 h4 h5 h6 p blockquote".split())
CONTAINERS = set("html body div section main center table tbody tr td".split())


SLOT = -1


class Element:
    """A part of an expression: an element, or a repeated group of elements."""

    __slots__ = ("key", "flags", "chars", "parts", "text", "pages")

    def __init__(
        self, key: str, flags: str = "", chars: int = 0, parts: list | None = None, text: int = 0, pages: int = 1
    ):
        self.key, self.flags, self.chars, self.parts = key, flags, chars, parts or []
        # of all text inside: 0 for none, a hash while it is the same on all pages, or SLOT
        self.text = text
        self.pages = pages

    def stored(self) -> list:
        """The parts in page order, each with its depth."""
        rows, todo = [], [(0, self)]
        while todo:
            depth, part = todo.pop()
            rows.append([depth, part.key, part.flags, part.chars, part.text, part.pages])
            todo += [(depth + 1, p) for p in reversed(part.parts)]
        return rows

    @staticmethod
    def read(stored: list) -> Element:
        open_parts: list[Element] = []
        for depth, key, flags, chars, text, pages in stored:
            part = Element(key, flags, chars, None, text, pages)
            del open_parts[depth:]
            if open_parts:
                open_parts[-1].parts.append(part)
            open_parts.append(part)
        return open_parts[0]

    def expression(self) -> str:
        """The expression as text: ? optional, + repeated, # a text."""
        return steps_done(self._expression())

    def _expression(self):
        inner = ["#"] if self.chars else []
        for p in self.parts:
            inner.append((yield p._expression()))
        body = f"({' '.join(inner)})" if self.key.startswith("(") else f"<{self.key}>{' '.join(inner)}</>"
        return body + "".join(c for c in "+?" if c in self.flags)


def steps_done(step):
    """The result of a recursion whose steps are generators that yield their calls.

    Pages nest as deep as they like; the stack is a list of ours.
    """
    stack, value = [step], None
    while stack:
        try:
            call = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(call)
            value = None
    return value


def element_key(tag: str, attributes: str) -> str:
    names = []
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            # a whole name without its numbers, which differ from page to page
            whole = ("-".join(NAME_WORD.findall(n)) for n in (m[2] or m[3] or m[4] or "").lower().split())
            names += [n for n in whole if n]
    return ".".join([tag, *sorted(set(names))]) if names else tag


def tag_of(key: str) -> str:
    return key.split(".", 1)[0]


def says(names: list[str], words: set[str]) -> bool:
    """Whether a name is one of ``words``, or is made of such words and of those for places alone."""
    for name in names:
        parts = set(name.split("-"))
        if not parts.isdisjoint(words) and parts <= words | PLACE_WORDS:
            return True
    return False


@functools.lru_cache(20_000)
def never(key: str, inside: bool, named: bool = True) -> bool:
    """Whether an element is no main text, here ``inside`` an article or not; ``named``: by whole names, too."""
    tag, *names = key.split(".")
    if tag in NEVER or not inside and tag == "header":
        return True
    if not named or tag in WHOLE:
        return False
    return says(names, NEVER_NAMES) or not inside and says(names, HEAD_NAMES)


def events(page: str) -> Iterator[tuple[str, str]]:
    """("open", key), ("close", tag), ("text", text) and ("break", ""), well nested."""
    stack: list[str] = []
    opened: Counter = Counter()
    at, size = 0, len(page)
    while at < size:
        m = MARK.search(page, at)
        if m is None:
            yield "text", page[at:]
            break
        if m.start() > at:
            yield "text", page[at : m.start()]
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if opened[tag]:
                while stack:
                    top = stack.pop()
                    opened[top] -= 1
                    yield "close", top
                    if top == tag:
                        break
            elif tag == "p":
                yield "break", ""
            continue
        attributes = m[3] or m[6] or ""
        if m[0][-1] != ">":
            break  # the page ends inside this tag
        if tag in VOID:
            if tag not in INLINE:
                yield "break", ""
            continue
        shut = {"p"} if tag in CLOSES_P and opened["p"] else CLOSES_LIKE.get(tag, ())
        for depth in range(len(stack) - 1, -1, -1) if shut else ():
            if stack[depth] in shut:
                for top in reversed(stack[depth:]):
                    yield "close", top
                opened.subtract(stack[depth:])
                del stack[depth:]
                if tag != "tr":
                    break
            elif stack[depth] in SCOPE:
                break
        yield "open", element_key(tag, attributes)
        stack.append(tag)
        opened[tag] += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            stack.pop()
            opened[tag] -= 1
            yield "close", tag
    for tag in reversed(stack):
        yield "close", tag


def with_text(text: int, more: str) -> int:
    return below(text, more) or 1


def with_element(text: int, tag: str, inside: int) -> int:
    """A text's hash with an element after it; what is no text at all, like a script, does not count."""
    return with_text(text, str(inside)) if inside and tag not in NEVER else text


def texts_inside(parsed: list[tuple[str, str]]) -> list[int]:
    """For each element of a page, in the order of opening, the hash of all text inside."""
    found, stack = [0], [0]
    for kind, value in parsed:
        if kind == "open":
            stack.append(len(found))
            found.append(0)
        elif kind == "close":
            inside = found[stack.pop()]
            found[stack[-1]] = with_element(found[stack[-1]], value, inside)
        elif kind == "text" and (value := value.strip()):
            found[stack[-1]] = with_text(found[stack[-1]], value)
    return found[1:]


def page_tree(page: str) -> Element:
    root = Element("")
    stack, links = [root], 0
    for kind, value in events(page):
        if kind == "open":
            child = Element(value)
            stack[-1].parts.append(child)
            stack.append(child)
            links += tag_of(value) == "a"
        elif kind == "close":
            done = stack.pop()
            links -= tag_of(done.key) == "a"
            done.parts = steps_done(fold_steps(done.parts))
            stack[-1].text = with_element(stack[-1].text, tag_of(done.key), done.text)
        elif kind == "text" and (value := value.strip()):
            stack[-1].text = with_text(stack[-1].text, value)
            stack[-1].chars += 0 if links else len(value)
    root.parts = steps_done(fold_steps(root.parts))
    return root


def fold_key(part: Element) -> str:
    """What has to be equal in elements that repeat: of a container without a name its parts, too."""
    return part.key if part.key not in CONTAINERS else " ".join([part.key, *sorted({p.key for p in part.parts})])


def fold_steps(parts: list[Element], widest: int = 4):
    """Tandem repeats of up to ``widest`` elements become one, marked as repeated."""
    for width in range(1, widest + 1):
        if len(parts) < 2 * width:
            break
        keys = [fold_key(p) for p in parts]
        out, i = [], 0
        while i < len(parts):
            n = 1
            while keys[i : i + width] == keys[i + n * width : i + (n + 1) * width] and i + (n + 1) * width <= len(parts):
                n += 1
            if n == 1:
                out.append(parts[i])
                i += 1
                continue
            merged = parts[i : i + width]
            for k in range(1, n):
                more = parts[i + k * width : i + (k + 1) * width]
                pairs, merged = zip(merged, more), []
                for a, b in pairs:
                    merged.append((yield align_steps(a, b, True)))
            if width == 1:
                merged[0].flags = "".join(sorted({*merged[0].flags, "+"}))
                out += merged
            else:
                out.append(Element("(" + " ".join(m.key for m in merged) + ")", "+", 0, merged))
            i += n * width
        parts = out
    return parts


def align(a: Element, b: Element) -> Element:
    """The expression of both: equal parts pair up in order, others become optional."""
    return steps_done(align_steps(a, b))


def text_of_both(a: int, b: int, in_row: bool) -> int:
    """A mismatch of two pages is a slot; texts ``in_row``, of repeated elements, are one sequence."""
    if not in_row:
        return a if a == b else SLOT
    if SLOT in (a, b):
        return SLOT
    return (below(a, str(b)) or 1) if a or b else 0


def align_steps(a: Element, b: Element, in_row: bool = False):
    flags = "".join(sorted({*a.flags, *b.flags}))
    x, y = a.parts, b.parts
    # equal ends pair up; only what lies between them has to be searched
    short = min(len(x), len(y))
    head = next((i for i in range(short) if x[i].key != y[i].key), short)
    tail = next((i for i in range(short - head) if x[-1 - i].key != y[-1 - i].key), short - head)
    m, n = len(x) - tail, len(y) - tail
    best = [[0] * (n - head + 1) for _ in range(m - head + 1)]
    for i in range(m - 1, head - 1, -1):
        for j in range(n - 1, head - 1, -1):
            if x[i].key == y[j].key:
                best[i - head][j - head] = best[i - head + 1][j - head + 1] + 1
            else:
                best[i - head][j - head] = max(best[i - head + 1][j - head], best[i - head][j - head + 1])
    parts, i, j = [], 0, 0
    while i < len(x) or j < len(y):
        inside = head <= i < m or head <= j < n
        if i < len(x) and j < len(y) and x[i].key == y[j].key and (not inside or i < m and j < n):
            parts.append((yield align_steps(x[i], y[j], in_row)))
            i, j = i + 1, j + 1
            continue
        if j == n or i < m and best[i - head + 1][j - head] >= best[i - head][j - head + 1]:
            part, i = x[i], i + 1
        else:
            part, j = y[j], j + 1
        part.flags = "".join(sorted({*part.flags, "?"}))
        parts.append(part)
    if [p.key for p in x] != [p.key for p in y]:
        parts = yield fold_steps(parts)
    text = text_of_both(a.text, b.text, in_row)
    return Element(a.key, flags, a.chars + b.chars, parts, text, max(a.pages, b.pages) if in_row else a.pages + b.pages)


def below(path: int, key: str) -> int:
    """The number of an element's path, from that of the element around it."""
    return xxh64_intdigest(key.encode(), path) >> 1


ROOT = 0


def template(wrapper: Element, least: int = 3) -> set[int]:
    """Blocks outside articles whose text is constant over all pages of a host, as numbers of path and text.

    What is optional is none, and there is no template in fewer than ``least`` pages, nor one
    that holds more text than the slots.
    """
    if wrapper.pages < least:
        return set()
    order, todo = [], [wrapper]
    while todo:
        part = todo.pop()
        order.append(part)
        todo += part.parts
    amount = {}
    for p in reversed(order):
        amount[id(p)] = p.chars + sum(amount[id(c)] for c in p.parts)
    found: dict[int, int] = {}
    slots = 0
    walk = [(wrapper, ROOT, True)]
    while walk:
        part, path, everywhere = walk.pop()
        everywhere = everywhere and "?" not in part.flags
        if part.key and not part.key.startswith("("):
            if never(part.key, False):
                continue
            path, tag = below(path, part.key), tag_of(part.key)
            if tag == "article":
                slots += amount[id(part)]
                continue
            if tag not in INLINE and part.text not in (0, SLOT) and everywhere and "+" not in part.flags:
                found[below(path, str(part.text))] = amount[id(part)]
                continue
        slots += part.chars
        walk += [(p, path, everywhere) for p in part.parts]
    return set(found) if sum(found.values()) < slots else set()


def places(wrapper: Element, by_name: bool = True, fixed: set[int] = frozenset()) -> list[list[int]]:
    """The elements that hold the main text, each as the numbers of the paths down to it.

    Names drop nothing if they would drop all.  The template, in ``fixed``, is no text.
    """
    found: dict[str, list[tuple[list[int], int]]] = {"article": [], "main": [], "named": []}
    amount: dict[int, int] = {}
    # (part, path of what is around it, inside an article); None closes the part before it
    todo: list[tuple[Element, int, bool] | None] = [(wrapper, ROOT, False)]
    chain, open_parts, kinds = [], [], []
    while todo:
        step = todo.pop()
        if step is None:
            part, kind = open_parts.pop(), kinds.pop()
            amount[id(part)] = part.chars + sum(amount[id(p)] for p in part.parts)
            if kind:
                found[kind].append((list(chain), amount[id(part)]))
            if part.key and not part.key.startswith("("):
                chain.pop()
            continue
        part, path, inside = step
        kind, grouped = None, part.key.startswith("(")
        if part.key and not grouped:
            path = below(path, part.key)
            if never(part.key, inside, by_name) or not inside and below(path, str(part.text)) in fixed:
                amount[id(part)] = 0
                continue
            chain.append(path)
            tag, *names = part.key.replace("-", ".").split(".")
            if not inside:
                if tag == "article":
                    kind = "article"
                elif tag == "main" or "main" in names:
                    kind = "main"
                elif not CONTENT_NAMES.isdisjoint(names):
                    kind = "named"
            inside = inside or tag == "article"
        open_parts.append(part)
        kinds.append(kind)
        todo.append(None)
        todo += [(p, path, inside) for p in reversed(part.parts)]

    total = amount[id(wrapper)]
    if not total and by_name:
        return places(wrapper, False, fixed)
    chosen: list[tuple[list[int], int]] = []
    for kind in found.values():
        least = sum(n for _, n in chosen)
        taken = {c[-1] for c, _ in chosen}
        above = {path for c, _ in chosen for path in c}
        # later kinds are read where no earlier one is in or around them, and only if they hold more
        new = [(c, n) for c, n in kind if not taken & set(c) and c[-1] not in above and n > least]
        # an element inside another one of these is read with it
        last = {c[-1] for c, _ in new}
        chosen += [(c, n) for c, n in new if not last & set(c[:-1])]
    if chosen:
        return sorted({tuple(c): list(c) for c, _ in chosen}.values())
    return container(wrapper, amount, by_name, fixed)


def container(wrapper: Element, amount: dict[int, int], by_name: bool, fixed: set[int]) -> list[list[int]]:
    """The innermost container with nearly all text, and the headings and paragraphs before it."""
    total, part, chain, beside = amount[id(wrapper)], wrapper, [], []
    while True:
        heavy = [
            i
            for i, p in enumerate(part.parts)
            if amount.get(id(p), 0) > 0.8 * total and "+" not in p.flags and tag_of(p.key) in CONTAINERS
        ]
        if not heavy:
            return [*beside, chain or [ROOT]]
        around = chain[-1] if chain else ROOT
        for p in part.parts[: heavy[0]]:
            path = below(around, p.key)
            if tag_of(p.key) in LEADING and below(path, str(p.text)) not in fixed and not never(p.key, False, by_name):
                beside.append([*chain, path])
        part = part.parts[heavy[0]]
        chain = [*chain, below(around, part.key)]


def read_text(page: str, where: list[list[int]], fixed: list[int] = ()) -> str | None:
    """The main text at the given places without the template's; None if the page has none of them."""
    fixed = set(fixed)
    wanted = {chain[-1] for chain in where}
    around = {path for chain in where for path in chain}
    found = ROOT in wanted
    blocks, block = [], []

    def flush():
        text = " ".join(html.unescape("".join(block)).split())
        if text:
            blocks.append(text)
        block.clear()

    parsed = list(events(page)) if fixed else events(page)
    inside_of = iter(texts_inside(parsed)) if fixed else itertools.repeat(0)
    # for each open element: its path, inside a place, dropped, inside an article
    stack = [(ROOT, found, False, False)]
    for kind, value in parsed:
        if kind == "text":
            if stack[-1][1] and not stack[-1][2]:
                block.append(value)
            continue
        if kind == "break" or (value if kind == "close" else tag_of(value)) not in INLINE:
            flush()
        if kind == "open":
            path, inside, dropped, article = stack[-1]
            path = below(path, value)
            article = article or tag_of(value) == "article"
            found = found or path in wanted
            text = next(inside_of)
            dropped = dropped or never(value, article, path not in around)
            dropped = dropped or not article and below(path, str(text)) in fixed
            stack.append((path, inside or path in wanted, dropped, article))
        elif kind == "close":
            stack.pop()
    flush()
    return " ".join(blocks) if found else None


def main_text(page: str | None, where: list[list[int]], fixed: list[int] = ()) -> str:
    if not page:
        return ""
    text = read_text(page, where, fixed)
    return read_text(page, places(page_tree(page))) if text is None else text


def _merging(rows: Iterator[tuple[str, Element]], most: int) -> Iterator[dict[str, Element]]:
    """Wrappers by host; handed on whenever ``most`` hosts are held."""
    held: dict[str, Element] = {}
    for host, wrapper in rows:
        held[host] = align(held[host], wrapper) if host in held else wrapper
        if len(held) > most:
            yield held
            held = {}
    yield held


def _batch(held: dict[str, Element]) -> pa.RecordBatch:
    texts = [json.dumps(w.stored(), separators=(",", ":")) for w in held.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"]
    )


def wrappers(pages: DataFrame, *, url: str = "url", html: str = "html", most: int = 2_000) -> DataFrame:
    """(host, wrapper): the expression of each host's pages, as JSON."""
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    rows = rows.where("html IS NOT NULL AND html != ''")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            seen = set()
            for piece in pieces(batches, "html"):
                for host, page in zip(*(piece.column(c).to_pylist() for c in ("host", "html"))):
                    # copies say nothing of what differs
                    mark = xxh64_intdigest(page.encode(), below(ROOT, host))
                    if mark not in seen:
                        seen.add(mark)
                        yield host, page_tree(page)

        yield from map(_batch, _merging(each(), most))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Element] = {}
        for batch in batches:
            for host, stored in zip(*(batch.column(c).to_pylist() for c in ("host", "wrapper"))):
                if host not in held and len(held) > most:
                    yield _batch(held)
                    held = {}
                new = Element.read(json.loads(stored))
                held[host] = align(held[host], new) if host in held else new
        yield _batch(held)

    schema = "host string, wrapper string"
    first = rows.mapInArrow(partial, schema).distinct()
    # salted first, so that a hot host's rows of very many tasks meet in steps
    salted = first.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(64)))
    salted = salted.repartition("host", "salt").sortWithinPartitions("host", "salt")
    second = salted.select("host", "wrapper").mapInArrow(whole, schema).distinct()
    return second.repartition("host").sortWithinPartitions("host").mapInArrow(whole, schema)


def extract(
    pages: DataFrame,
    wrapped: DataFrame | None = None,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``id``, ``url`` and the main text of every page in ``text``."""
    wrapped = wrappers(pages, url=url, html=html) if wrapped is None else wrapped
    rows = pages.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")
    ).withColumn("host", host_of(F.col("url")))

    def to_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [Element.read(json.loads(w)) for w in batch.column("wrapper").to_pylist()]
            fixed = [template(t) for t in trees]
            found = pa.array([places(t, fixed=f) for t, f in zip(trees, fixed)], pa.list_(pa.list_(pa.int64())))
            fixed = pa.array([sorted(f) for f in fixed], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("host"), found, fixed], ["host", "where", "fixed"])

    # short rows in a table of known size: Spark sends them to the pages where they are few, and
    # html is dealt by host only where they are not
    where = land(wrapped.mapInArrow(to_places, "host string, where array<array<bigint>>, fixed array<bigint>"), "places")
    joined = rows.join(where, "host", "left").select("id", "url", "html", "where", "fixed")
    kind = joined.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            columns = (piece.column(c).to_pylist() for c in ("html", "where", "fixed"))
            texts = [main_text(page, found or [], fixed or []) for page, found, fixed in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("url"), pa.array(texts, pa.string())],
                ["id", "url", "text"],
            )

    out = joined.mapInArrow(run, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id), F.col("url").alias(url), "text")
