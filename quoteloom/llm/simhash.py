"""SimHash near-duplicates: fingerprints, and the components of close ones.

A document's fingerprint has a bit set if over half of its shingles' hashes set it.
Documents link if their fingerprints differ in at most ``max_bits`` bits; linked ones
share a component.

The join walks a binary trie against itself.  A node pair carries the bits that differ so
far and is dropped as soon as they exceed the budget.  For many machines the walk starts
below the root: the bits are cut into ``max_bits + r`` blocks, and close fingerprints agree
in at least ``r`` of them, so for each choice of ``r`` blocks those come first in the
trie's bit order, and only pairs within one node below them are walked, one node a group.
More fingerprints take a larger ``r``, which keeps groups small.  Only distinct
fingerprints take part, so copies cost nothing.

Nulls and texts without words have fingerprint zero and link like any other.  Fewer words
than a shingle has make one shingle.  Repeated rows are rows.  A null id is kept and never
names a component that has another id.  Columns beside the two named ones do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import pieces
from quoteloom.llm.components import components
from quoteloom.shared import land

BITS = 64
# A trie walk's group: above this many fingerprints expected in one, more blocks are used.
GROUP = 4_000


def fingerprint(texts: list[bytes], shingle: int, seed: int = 42) -> np.ndarray:
    """The fingerprints of some texts, as uint64."""
    from xxhash import xxh64_intdigest

    hashes, counts = [], []
    for text in texts:
        words = text.lower().split()  # of bytes: ASCII letters, ASCII white space
        before = len(hashes)
        if len(words) <= shingle:
            if words:
                hashes.append(xxh64_intdigest(b" ".join(words), seed))
        else:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            first = [0, *ends[:-shingle].tolist()]
            last = (ends[shingle - 1 :] - 1).tolist()
            hashes += [xxh64_intdigest(line[a:b], seed) for a, b in zip(first, last)]
        counts.append(len(hashes) - before)
    counts = np.array(counts)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if some.size:
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        starts = (np.cumsum(counts) - counts)[some]
        for b in range(BITS):
            bit = (octets[:, b // 8] >> (b % 8)) & 1
            ones = np.add.reduceat(bit, starts, dtype=np.int64)
            out[some] |= (2 * ones > counts[some]).astype(np.uint64) << np.uint64(b)
    return out


def fingerprints(
    docs: DataFrame, shingle: int = 4, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id`` and ``fingerprint`` (a long with the same 64 bits) of every row."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = fingerprint([t or b"" for t in piece.column("text").to_pylist()], shingle)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(found.view(np.int64))], ["id", "fingerprint"]
            )

    return rows.mapInArrow(run, f"id {kind}, fingerprint bigint").withColumnRenamed("id", id)


def trie_links(
    values: np.ndarray, order: list[int], top: int, budget: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all pairs of ``values`` that differ in ``budget`` bits or less.

    Only pairs that agree in the first ``top`` bits of ``order``, the trie's bit order,
    count; ``values`` are distinct uint64.  The walk goes down one bit at a time with all
    live node pairs at once.  It runs with a budget of 1, 2, ... in turn: node pairs whose
    values are all connected already need no second visit, which keeps a dense group of
    near copies from costing the square of its size.
    """
    keys = np.zeros(len(values), np.uint64)
    for bit in order:
        keys = keys << np.uint64(1) | (values >> np.uint64(bit)) & np.uint64(1)
    place = np.argsort(keys)
    keys = keys[place]
    depth = len(order) - top
    cuts = np.flatnonzero(np.diff(keys >> np.uint64(depth))) + 1
    groups = np.stack([np.append(0, cuts), np.append(cuts, len(keys))], 1)
    groups = groups[groups[:, 1] - groups[:, 0] > 1]
    root = np.arange(len(keys))
    left, right = [], []
    for allowed in range(1, budget + 1):
        uniform = _uniform(root)
        a = b = groups
        spent = np.zeros(len(groups), np.int8)
        for level in range(depth - 1, -1, -1):
            a, b, spent = _descend(keys, a, b, spent, np.uint64(1 << level), allowed)
            single = (a[:, 1] - a[:, 0] == 1) & (b[:, 1] - b[:, 0] == 1)
            if single.any():
                x, y = a[single, 0], b[single, 0]
                near = np.bitwise_count(keys[x] ^ keys[y]) <= allowed
                x, y = x[near], y[near]
                root, kept = _join(root, x, y)
                left.append(x[kept])
                right.append(y[kept])
                uniform = _uniform(root)
            linked = (
                (uniform[a[:, 0]] >= a[:, 1])
                & (uniform[b[:, 0]] >= b[:, 1])
                & (root[a[:, 0]] == root[b[:, 0]])
            )
            live = ~(single | linked)
            a, b, spent = a[live], b[live], spent[live]
            if not len(a):
                break
    if not left:
        return values[:0], values[:0]
    x, y = np.concatenate(left), np.concatenate(right)
    return values[place[x]], values[place[y]]


def _uniform(root: np.ndarray) -> np.ndarray:
    """For each place, the end of the run of equal roots that it lies in."""
    ends = np.append(np.flatnonzero(np.diff(root)) + 1, len(root))
    return ends[np.searchsorted(ends, np.arange(len(root)), side="right")]


def _descend(keys, a, b, spent, bit, allowed):
    """The children's pairs of all node pairs; nodes are ranges of the sorted keys."""

    def middle(node):
        # the first key in the node with this level's bit set
        lo, hi = node[:, 0], node[:, 1]
        while (unsure := lo < hi).any():
            mid = (lo + hi) // 2
            set_ = (keys[np.minimum(mid, len(keys) - 1)] & bit) != 0
            lo, hi = np.where(unsure & ~set_, mid + 1, lo), np.where(unsure & set_, mid, hi)
        return lo

    ma, mb = middle(a), middle(b)
    low_a, high_a = np.stack([a[:, 0], ma], 1), np.stack([ma, a[:, 1]], 1)
    low_b, high_b = np.stack([b[:, 0], mb], 1), np.stack([mb, b[:, 1]], 1)
    same = (a[:, 0] == b[:, 0]) & (a[:, 1] == b[:, 1])
    aa = np.concatenate([low_a, high_a, low_a, high_a])
    bb = np.concatenate([low_b, high_b, high_b, low_b])
    ss = np.concatenate([spent, spent, spent + 1, spent + 1])
    keep = np.append(np.ones(3 * len(a), bool), ~same)
    keep &= (ss <= allowed) & (aa[:, 0] < aa[:, 1]) & (bb[:, 0] < bb[:, 1])
    keep &= ~((aa[:, 0] == bb[:, 0]) & (aa[:, 1] - aa[:, 0] == 1) & (bb[:, 1] - bb[:, 0] == 1))
    return aa[keep], bb[keep], ss[keep]


def _join(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connect places pairwise; also says which of the pairs were needed (a forest)."""
    parent = root.copy()

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = np.zeros(len(x), bool)
    unlike = np.flatnonzero(root[x] != root[y])
    for k in unlike.tolist():
        i, j = find(x[k]), find(y[k])
        if i != j:
            parent[max(i, j)] = min(i, j)
            kept[k] = True
    if kept.any():
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent, kept


def rotations(count: int, max_bits: int) -> list[tuple[list[int], int]]:
    """Bit orders and the number of leading bits in which a pair has to agree.

    ``count`` is the number of distinct fingerprints; more of them take more blocks.
    """
    for agree in range(1, BITS - max_bits):
        blocks = np.array_split(np.arange(BITS), max_bits + agree)
        top = sum(len(x) for x in blocks[-agree:])
        if top >= log2(max(count, 1) / GROUP) or comb(max_bits + agree + 1, max_bits) > 200:
            break
    orders = []
    for chosen in combinations(range(len(blocks)), agree):
        first = [int(b) for i in chosen for b in blocks[i]]
        orders.append((first + [b for b in range(BITS) if b not in set(first)], len(first)))
    return orders


def close_links(distinct: DataFrame, max_bits: int = 4, chunk: int = 200_000) -> DataFrame:
    """(u, v): links that connect all fingerprints of ``distinct`` that are close."""
    orders = rotations(distinct.count(), max_bits)
    heads = F.array(*[F.struct(F.lit(i).alias("turn"), _head(order[:top]).alias("head"))
                      for i, (order, top) in enumerate(orders)])
    rows = distinct.select("fingerprint", F.explode(heads).alias("node")).select(
        "fingerprint", "node.turn", "node.head"
    )
    grouped = rows.repartition("turn", "head").sortWithinPartitions("turn", "head")

    def walk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        turns = np.concatenate([h.column("turn").to_numpy() for h in held])
        values = np.concatenate([h.column("fingerprint").to_numpy() for h in held]).view(np.uint64)
        found = [
            trie_links(values[turns == t], *orders[t], max_bits) for t in np.unique(turns).tolist()
        ]
        x, y = (np.concatenate([f[k] for f in found]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if n + batch.num_rows > chunk:
                # walk all groups that are complete: those before the last one's first row
                turn, head = (batch.column(c).to_numpy() for c in ("turn", "head"))
                cuts = np.flatnonzero((np.diff(turn) != 0) | (np.diff(head) != 0)) + 1
                if cuts.size:
                    cut = int(cuts[-1])
                    yield walk([*held, batch.slice(0, cut)])
                    held, n, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield walk(held)

    return grouped.mapInArrow(run, "u bigint, v bigint")


def _head(bits: list[int]):
    value = F.lit(0).cast("long")
    for b in bits:
        bit = F.shiftrightunsigned("fingerprint", b).bitwiseAND(F.lit(1).cast("long"))
        value = F.shiftleft(value, 1).bitwiseOR(bit)
    return value


def _labels(prints: DataFrame, max_bits: int, id: str) -> DataFrame:
    """(fingerprint, root, component_id): each fingerprint's component and that one's least id."""
    classes = land(prints.groupBy("fingerprint").agg(F.min(id).alias("least")), "classes")
    linked = components(close_links(classes.select("fingerprint"), max_bits))
    rooted = classes.join(linked, classes["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    *,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``id``, ``fingerprint`` and ``component_id``, the least id of the row's component."""
    prints = land(fingerprints(docs, shingle, id=id, text=text), "fingerprints")
    labels = _labels(prints, max_bits, id)
    return prints.join(labels, "fingerprint").select(id, "fingerprint", "component_id")


def deduplicate(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    *,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with one row left of each component: one with the least id.

    Components of rows without any id keep one of those.
    """
    prints = land(fingerprints(docs, shingle, id=id, text=text), "fingerprints")
    labels = land(_labels(prints, max_bits, id), "labels")
    named = labels.select(F.col("component_id").alias(id)).where(F.col(id).isNotNull()).distinct()
    kept = docs.join(named, id, "left_semi").dropDuplicates([id])
    # rows without id, in components that have none: by their fingerprints
    unnamed = docs.where(F.col(id).isNull()).withColumn("_row", F.struct("*"))
    marked = fingerprints(unnamed.select(F.col("_row").alias(id), text), shingle, id=id, text=text)
    alone = marked.join(labels.where("component_id IS NULL"), "fingerprint").dropDuplicates(["root"])
    return kept.select(*docs.columns).union(alone.select(f"{id}.*").select(*docs.columns))
