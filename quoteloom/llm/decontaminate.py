"""Benchmark decontamination with one FM-index per shard of documents.

Test phrases are windows of consecutive words of the benchmark's items.  A task indexes
its shard's words: suffix array, Burrows-Wheeler transform in a wavelet matrix, and
sampled suffix positions.  All phrases search it together, backwards, one word a step; the
occurrences are located from the samples and merged into spans.

Words that no item has act as separators, and a stretch between separators too short for
any phrase is left out of the index, for no occurrence can touch either.

The benchmark is taken in passes of bounded size, each a pass over the documents, which are
landed between two of them.  No document is shuffled: memory follows the shard and the pass.

Empty tables: no documents give no rows, no items no hits.  Nulls: a null text has no words.  Items that are null, have no id or no words are no phrases.
Repeated documents and items are fine; an item counts once.  All columns of the documents
pass through; the operator's own column names must be free.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.llm.common import pieces
from quoteloom.shared import Landing

# A-Z in lower case; bytes that no word has become spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SAMPLING = 16


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class FMIndex:
    """An index of runs of positive symbols, each run followed by a 0 in ``symbols``."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = suffix_array(symbols)
        last = symbols[order - 1]  # what stands before each suffix; 0 before a run
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        self.levels = []
        column = last
        for bit in range(max(1, int(symbols.max()).bit_length()) - 1, -1, -1):
            ones = column >> bit & 1
            ranks = np.concatenate([[0], np.cumsum(ones)]).astype(np.int32)
            self.levels.append((ranks, n - int(ranks[-1])))
            column = np.concatenate([column[ones == 0], column[ones == 1]])
        known = np.flatnonzero((last == 0) | (order % SAMPLING == 0))
        self.sampled = np.zeros(n, bool)
        self.sampled[known] = True
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[known]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before the first ``row`` suffixes."""
        low = np.zeros_like(row)
        for depth, (ones, zeros) in enumerate(self.levels):
            right = symbol >> (len(self.levels) - 1 - depth) & 1 == 1
            row = np.where(right, zeros + ones[row], row - ones[row])
            low = np.where(right, zeros + ones[low], low - ones[low])
        return row - low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges that start with each phrase; rows of ``phrases`` end with it."""
        width = phrases.shape[1]
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.sampled), np.int64)
        live = np.arange(len(phrases))
        for step in range(width):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            if not live.size:
                break
            symbol = phrases[live, width - 1 - step]
            there = symbol < len(self.first) - 1
            hi[live[~there]] = lo[live[~there]]
            live, symbol = live[there], symbol[there]
            lo[live] = self.first[symbol] + self.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.rank(symbol, hi[live])
        return lo, hi

    def step_back(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that start one symbol earlier."""
        low, symbol = np.zeros_like(row), np.zeros_like(row)
        for ones, zeros in self.levels:
            right = ones[row + 1] > ones[row]
            row = np.where(right, zeros + ones[row], row - ones[row])
            low = np.where(right, zeros + ones[low], low - ones[low])
            symbol = symbol * 2 + right
        return self.first[symbol] + row - low

    def locate(self, row: np.ndarray) -> np.ndarray:
        row, steps = row.copy(), np.zeros(len(row), np.int64)
        walking = np.flatnonzero(~self.sampled[row])
        while walking.size:
            row[walking] = self.step_back(row[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[row[walking]]]
        return self.samples[self.sample_rank[row]] + steps


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; zeros end a comparison, an earlier one is smaller."""
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols.astype(np.int64) + int(ends.sum()))
    width = 1
    while True:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key)
        key = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == len(rank) - 1:
            return order
        width *= 2


class Phrases:
    """The windows of a pass over the benchmark, as word numbers."""

    def __init__(self, items: list[tuple[object, list[bytes]]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for at in range(max(1, len(ids) - size + 1)):
                owners.setdefault(tuple(ids[at : at + size]), set()).add(item)
        self.owners = list(owners.values())
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.least = int(self.lengths.min()) if owners else 0
        self.matrix = np.zeros((len(owners), size), np.int64)
        for row, window in enumerate(owners):
            self.matrix[row, size - len(window) :] = window

    def occurrences(self, ids: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, phrase) of all occurrences; ``opens`` marks where documents start."""
        known = ids > 0
        before = np.concatenate([[False], known[:-1]]) & ~opens
        begin = np.flatnonzero(known & ~before)
        after = np.concatenate([known[1:] & ~opens[1:], [False]])
        end = np.flatnonzero(known & ~after) + 1
        long = end - begin >= self.least
        begin, size = begin[long], (end - begin)[long]
        if not begin.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # each stretch and a place for its separator
        stop = np.cumsum(size + 1)
        where = np.arange(stop[-1]) + np.repeat(begin - (stop - size - 1), size + 1)
        symbols = ids[np.minimum(where, len(ids) - 1)].copy()
        symbols[stop - 1] = 0
        index = FMIndex(symbols)
        lo, hi = index.search(self.matrix, self.lengths)
        found = np.maximum(hi - lo, 0)
        phrase = np.repeat(np.arange(len(found)), found)
        row = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + lo[phrase]
        return where[index.locate(row)], phrase


def _scan(piece: pa.RecordBatch, text: str, phrases: Phrases, earlier: list | None):
    """(word counts, spans, items) of a piece; spans are word ranges, end exclusive."""
    get = phrases.vocabulary.get
    counts, ids = [], []
    for t in piece.column(text):
        words = words_of(t.as_buffer().to_pybytes() if t.is_valid else None)
        counts.append(len(words))
        ids += [get(w, 0) for w in words]
    ids = np.array(ids, np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    spans, items = [[] for _ in counts], [set() for _ in counts]
    hit = np.zeros(len(ids) + 1, np.int64)
    if len(ids):
        opens = np.zeros(len(ids) + 1, bool)
        opens[starts[:-1]] = True
        first, phrase = phrases.occurrences(ids, opens[:-1])
        np.add.at(hit, first, 1)
        np.add.at(hit, first + phrases.lengths[phrase], -1)
        doc = np.searchsorted(starts, first, side="right") - 1
        for d, p in {*zip(doc.tolist(), phrase.tolist())}:
            items[d] |= phrases.owners[p]
    covered = np.cumsum(hit[:-1]) > 0
    for d, (before_spans, before_items) in enumerate(earlier or ()):
        items[d].update(before_items)
        for span in before_spans:
            covered[starts[d] + span["start"] : starts[d] + span["end"]] = True
    touched = np.unique(np.searchsorted(starts, np.flatnonzero(covered), side="right") - 1)
    for d in touched.tolist():
        edges = np.diff(np.concatenate([[0], covered[starts[d] : starts[d + 1]].view(np.int8), [0]]))
        begin, end = np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()
        spans[d] = [{"start": a, "end": b} for a, b in zip(begin, end)]
    return counts, spans, [sorted(i) for i in items]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = 16_000_000,
    pass_bytes: int = 16_000_000,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (word ranges hit) and ``items`` (ids that hit).

    A pass searches for about ``pass_bytes`` of the benchmark, all that the driver and a task hold
    of it at a time.  What a pass before the last one finds is landed, so each plan has one pass.
    """
    taken = {"n_words", "spans", "items", "_bytes"} & set(docs.columns)
    if taken:
        raise ValueError(f"the documents already have columns {sorted(taken)}")
    asked = benchmark.select(F.col(f"`{item}`").alias("id"), F.col(f"`{item_text}`").alias("text"))
    asked = asked.where("id IS NOT NULL AND text IS NOT NULL")
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-total // pass_bytes))
    kind = T.ArrayType(asked.schema["id"].dataType)
    span = T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))
    result = docs.withColumn("_bytes", F.col(f"`{text}`").cast("binary"))
    landing = Landing(docs.sparkSession)
    for turn in range(passes):
        part = asked.where(F.pmod(F.hash("id"), F.lit(passes)) == turn)
        rows = part.select("id", F.col("text").cast("binary")).toArrow().to_pydict()
        listed = [(i, words_of(t)) for i, t in zip(rows["id"], rows["text"])]
        result = _one_pass(result, Phrases([x for x in listed if x[1]], window), kind, span, shard_bytes)
        if turn < passes - 1:
            older, landing = landing, Landing(docs.sparkSession)
            result = landing.land(result, "pass")
            older.clear()
    return result.drop("_bytes")


def _one_pass(docs, phrases, kind, span, shard_bytes):
    new = T.StructType().add("n_words", T.LongType()).add("spans", span).add("items", kind)
    again = "spans" in docs.columns
    kept = [f for f in docs.schema.fields if f.name not in new.names]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(new)
        for piece in pieces(batches, "_bytes", shard_bytes):
            earlier = None
            if again:
                earlier = list(zip(*(piece.column(c).to_pylist() for c in ("spans", "items"))))
            found = _scan(piece, "_bytes", phrases, earlier)
            columns = [pa.array(c, f.type) for c, f in zip(found, arrow)]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), *columns], [*names, *new.names]
            )

    return docs.mapInArrow(run, T.StructType([*kept, *new.fields]))


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of ``find_leaks`` with the spans' words, and all between them, cut from ``text``."""

    def cut(data: bytes, spans) -> bytes:
        places = [m.span() for m in WORD.finditer(data)]
        at, kept = 0, []
        for s in spans:
            kept.append(data[at : places[s["start"]][0]])
            at = places[s["end"] - 1][1]
        return b"".join([*kept, data[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            at = piece.schema.get_field_index(text)
            texts = [
                cut(t.encode(), s).decode() if s and t is not None else t
                for t, s in zip(piece.column(at).to_pylist(), piece.column("spans").to_pylist())
            ]
            column = pa.array(texts, piece.schema.field(at).type)
            yield piece.set_column(at, piece.schema.field(at), column)

    return found.mapInArrow(run, found.schema)
