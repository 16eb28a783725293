"""Personal data: patterns, and a skip-chain conditional random field over what they miss.

Patterns find the base spans.  Tokens that hold a digit or an @ are the field's nodes; all
other tokens are outside by definition and so drop out of it.  A node's own potential comes
from its shape and the word before it; neighbours in the text share a chain potential, and
distant tokens with the same letters and digits share a skip potential, each linked to the
nearest observed occurrence, or to the first one if none is observed.  Base spans are observed.
Loopy message passing runs until the messages of a document settle, in rounds that follow its
longest chain, so a token that repeats part of a known number or address takes its label.

The potentials are logarithms of counts over all documents, with the base spans as
labels: one pass, whose result has a fixed size.  (Tokens that repeat part of a base span
count as unknown there, for else the field would learn that repeats are outside.)

Nulls: a null text is an empty one.  Repeated rows are rows.  All columns pass through, and
the operator's own column name must be free.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.llm.common import pieces

KINDS = ["email", "ip", "card", "phone"]
OUTSIDE = 4
LABELS = 5
BUCKETS = 4096
SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("base", T.BooleanType())
)

# The contract's patterns, without the ways in which they would try a place twice: an
# email is found from its @, and a run of digits is entered at its start only.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CLUE = re.compile("[0-9@]")
BLACK = re.compile(r"\S*")
DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    found = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if CLUE.search(text) is None:
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = "".join(DIGITS.findall(m[0]))
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGITS.findall(m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def shape(token: str) -> str:
    """Letters as a, digits as 9, runs shortened to at most three."""
    out = []
    for c in token:
        c = "9" if c.isdigit() else "a" if c.isalpha() else c
        if out[-3:] != [c] * 3:
            out.append(c)
        if len(out) == 24:
            break
    return "".join(out)


def same_key(token: str) -> str:
    """Tokens that repeat each other: their digits if there are many, else letters and digits."""
    kept = "".join(c for c in token.lower() if c.isalnum())
    digits = "".join(c for c in kept if c.isdigit())
    return digits if len(digits) >= 6 else kept


def bucket(feature: str) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


class Graph:
    """The nodes and edges of some documents."""

    def __init__(self, texts: list[str]):
        self.doc, self.start, self.end, self.features, self.seen = [], [], [], [], []
        self.chain, self.skip, self.base = [], [], []
        for d, text in enumerate(texts):
            spans = base_spans(text)
            self.base.append(spans)
            self._nodes(d, text, sorted((a, b, k) for k, a, b in spans))

    def _nodes(self, d: int, text: str, spans: list) -> None:
        at, last, turn, keys = 0, None, 0, {}
        while clue := CLUE.search(text, at):
            start = clue.start()
            while start > at and not text[start - 1].isspace():
                start -= 1
            end = BLACK.match(text, clue.start()).end()
            token, node = text[start:end], len(self.doc)
            gap = text[at:start]
            word = gap[-40:].split()
            before = word[-1].lower() if word else "" if last is None else "9"
            self.doc.append(d)
            self.start.append(start)
            self.end.append(end)
            self.features.append((bucket("s" + shape(token)), bucket("w" + before)))
            while turn < len(spans) and spans[turn][1] <= start:
                turn += 1
            here = [s for s in spans[turn : turn + 4] if s[0] < end and s[1] > start]
            self.seen.append(here[0][2] if here else -1)
            if last is not None and not gap.strip():
                self.chain.append((last, node))
            key = same_key(token)
            if len(key) >= 4:
                if key in keys:
                    self.skip.append((keys[key], node))
                keys[key] = node
            at, last = end, node


@dataclass(frozen=True)
class Potentials:
    """Log potentials: by shape bucket, by bucket of the word before, chain, skip."""

    shape: np.ndarray
    word: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _tally(graph: Graph) -> np.ndarray:
    """Counts in one vector: shape x label, word x label, chain pairs, skip pairs.

    A token outside all base spans that repeats one inside is of unknown label: it and
    its pairs are not counted.
    """
    seen = np.array(graph.seen, np.int64)
    size = BUCKETS * LABELS
    out = np.zeros(2 * size + 2 * LABELS * LABELS, np.int64)
    if not len(seen):
        return out
    label = np.where(seen >= 0, seen, OUTSIDE)
    group = np.arange(len(seen))
    for a, b in graph.skip:
        group[b] = group[a]
    inside = np.zeros(len(seen), bool)
    inside[group[seen >= 0]] = True
    sure = (seen >= 0) | ~inside[group]
    features = np.array(graph.features)[sure]
    np.add.at(out, features[:, 0] * LABELS + label[sure], 1)
    np.add.at(out, size + features[:, 1] * LABELS + label[sure], 1)
    for place, pairs in ((2 * size, graph.chain), (2 * size + LABELS**2, graph.skip)):
        if pairs:
            pairs = np.array(pairs)
            p = label[pairs[sure[pairs].all(1)]]
            np.add.at(out, place + p[:, 0] * LABELS + p[:, 1], 1)
    return out


def _texts(piece: pa.RecordBatch, text: str) -> list[str]:
    return [t or "" for t in piece.column(text).to_pylist()]


def fit(docs: DataFrame, text: str = "text") -> Potentials:
    """Potentials from counts over all documents; what reaches the driver has a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for piece in pieces(batches, "text"):
            total = total + _tally(Graph(_texts(piece, "text")))
        if not np.isscalar(total):
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "slot bigint, n bigint")
    rows = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(2 * BUCKETS * LABELS + 2 * LABELS * LABELS)
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    size = BUCKETS * LABELS
    prior = counts[:size].reshape(BUCKETS, LABELS).sum(0) + 1.0
    prior /= prior.sum()

    def given(part):
        table = part.reshape(-1, LABELS) + 0.5 * prior
        return np.log(table / table.sum(1, keepdims=True))

    def pairs(part):
        table = part.reshape(LABELS, LABELS) + 0.5
        return np.log(table / (table.sum(1, keepdims=True) * table.sum(0) / table.sum()))

    return Potentials(
        given(counts[:size]),
        given(counts[size : 2 * size]) - np.log(prior),
        pairs(counts[2 * size : 2 * size + LABELS**2]),
        pairs(counts[2 * size + LABELS**2 :]),
    )


def skip_links(graph: Graph) -> list[tuple[int, int]]:
    """A link of each occurrence to the nearest observed one of its group, else to the first one."""
    group = np.arange(len(graph.doc))
    for a, b in graph.skip:
        group[b] = group[a]
    members: dict[int, list[int]] = {}
    for node in sorted({n for pair in graph.skip for n in pair}):
        members.setdefault(int(group[node]), []).append(node)
    links = []
    for nodes in members.values():
        centers = [n for n in nodes if graph.seen[n] >= 0] or nodes[:1]
        inside = set(centers)
        for n in nodes:
            if n not in inside:
                at = bisect(centers, n)
                near = min(centers[max(0, at - 1) : at + 1], key=lambda c: abs(c - n))
                links.append((min(near, n), max(near, n)))
    return links


def most_rounds(graph: Graph) -> np.ndarray:
    """For each text: damped messages need some rounds a link, along its longest run of neighbours."""
    longest, run, last = np.zeros(max(graph.doc) + 1, np.int64), 0, None
    for a, b in graph.chain:
        run = run + 1 if a == last else 1
        longest[graph.doc[a]], last = max(longest[graph.doc[a]], run), b
    return 40 + 4 * longest


def beliefs(graph: Graph, potentials: Potentials, rounds: int | None = None) -> np.ndarray:
    """The label probabilities of all nodes after loopy message passing.

    Without ``rounds`` each text's messages stay as they are once none of them changes by a
    thousandth, so what a text gets does not depend on the texts beside it.
    """
    features, seen = np.array(graph.features), np.array(graph.seen)
    own = potentials.shape[features[:, 0]] + potentials.word[features[:, 1]]
    known = np.flatnonzero(seen >= 0)
    own[known] = -1e6  # more than the messages of any number of repeats
    own[known, seen[known]] = 0.0
    edges, tables = [], []
    for pairs, table in ((graph.chain, potentials.chain), (skip_links(graph), potentials.skip)):
        for a, b in pairs:
            edges += [(a, b), (b, a)]
            tables += [table, table.T]
    total = own
    if edges:
        edge, table = np.array(edges), np.array(tables)
        back = np.arange(len(edge)) ^ 1
        message = np.zeros((len(edge), LABELS))
        text = np.array(graph.doc)[edge[:, 0]]
        limit = most_rounds(graph)[text] if rounds is None else np.full(len(edge), rounds)
        live, turn = np.flatnonzero(limit > 0), 0
        while len(live):
            total = own.copy()
            np.add.at(total, edge[live, 1], message[live])
            cavity = total[edge[live, 0]] - message[back[live]]
            sent = cavity[:, :, None] + table[live]
            top = sent.max(1, keepdims=True)
            new = np.log(np.exp(sent - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            change = np.zeros(text.max() + 1)
            np.maximum.at(change, text[live], np.abs(new - message[live]).max(1))
            message[live] = 0.5 * message[live] + 0.5 * new
            turn += 1
            unsettled = change[text[live]] >= 1e-3 if rounds is None else True
            live = live[(limit[live] > turn) & unsettled]
        total = own.copy()
        np.add.at(total, edge[:, 1], message)
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def label_spans(texts: list[str], potentials: Potentials, sure: float) -> list[list[dict]]:
    """All spans of each text, base ones first, each list by kind and start."""
    graph = Graph(texts)
    found = [
        [{"kind": KINDS[k], "start": a, "end": b, "base": True} for k, a, b in spans]
        for spans in graph.base
    ]
    if graph.doc:
        p = beliefs(graph, potentials)
        label = p.argmax(1)
        fresh = (np.array(graph.seen) < 0) & (label != OUTSIDE) & (p.max(1) >= sure)
        for node in np.flatnonzero(fresh).tolist():
            d, a, b = graph.doc[node], graph.start[node], graph.end[node]
            while a < b and not (texts[d][a].isalnum() or texts[d][a] == "+"):
                a += 1
            while b > a and not texts[d][b - 1].isalnum():
                b -= 1
            if a < b:
                kind = KINDS[label[node]]
                found[d].append({"kind": kind, "start": a, "end": b, "base": False})
    return found


def find_pii(
    docs: DataFrame,
    potentials: Potentials | None = None,
    *,
    text: str = "text",
    spans: str = "pii",
    sure: float = 0.9,
) -> DataFrame:
    """``docs`` with all spans in the array column ``spans``: kind, start, end (code points), base."""
    if spans in docs.columns:
        raise ValueError(f"the input already has a column {spans!r}")
    model = potentials or fit(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for piece in pieces(batches, text):
            found = pa.array(label_spans(_texts(piece, text), model, sure), to_arrow_type(SPANS))
            yield pa.RecordBatch.from_arrays([*piece.columns, found], [*piece.schema.names, spans])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(spans, SPANS)]))


def mask_pii(found: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """The result of ``find_pii`` with every span of ``text`` replaced by its kind in brackets."""

    def masked(text: str, marks: list[dict]) -> str:
        at, out = 0, []
        for s in sorted(marks, key=lambda s: (s["start"], -s["end"])):
            if s["end"] > at:
                if s["start"] >= at:
                    out += [text[at : s["start"]], f"[{s['kind']}]"]
                at = s["end"]
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            at = piece.schema.get_field_index(text)
            texts, marks = piece.column(at).to_pylist(), piece.column(spans).to_pylist()
            new = [masked(t, m) if m and t is not None else t for t, m in zip(texts, marks)]
            column = pa.array(new, piece.schema.field(at).type)
            yield piece.set_column(at, piece.schema.field(at), column)

    return found.mapInArrow(run, found.schema)
