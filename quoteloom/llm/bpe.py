"""Byte-level BPE: text to token ids and back, with a public vocabulary file.

A pre-token's symbols form a doubly linked list.  A heap holds every adjacent pair that
the merge table knows, lowest rank first and leftmost among equals; an entry whose
symbols have changed since is stale and skipped when it comes up.  That takes
O(n log n) for n symbols, also in a text that is one endless word.  Decoding
concatenates vocabulary strings.

Nulls: a null text encodes like an empty one, to no ids; null ids decode to an empty
text.  Every row is kept, repeated ones too; all other columns pass through.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quoteloom.llm.common import pieces, worker_state

# Fixed value: how this family of vocabularies cuts text into pre-tokens.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters of texts in Latin script, for which a plain pattern cuts alike and faster.
LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
LATIN_PRETOKEN = rf" ?[{LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s0-9{LATIN}]+|\s+(?!\S)|\s+"
NOT_LATIN = "[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]"

SYMBOL_BITS = 20
PLACE_BITS = 32


def printable_bytes() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes each byte.

    Printable Latin-1 bytes stand for themselves, all others take letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[dict, dict[str, int], list[bytes]]:
    """What the file stores of the model, its special tokens, and the string of each id."""
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    letters = printable_bytes()
    vocab = stored["model"]["vocab"]
    specials = {t["content"]: t["id"] for t in stored.get("added_tokens", [])}
    strings = [b""] * (1 + max([*vocab.values(), *specials.values()]))
    for word, i in vocab.items():
        strings[i] = bytes(letters[c] for c in word)
    for word, i in specials.items():
        strings[i] = word.encode()
    return stored["model"], specials, strings


def joined(strings: list[bytes], ids: np.ndarray) -> str:
    return b"".join(map(strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Codec:
    """A vocabulary ready for use in one process."""

    def __init__(self, path: str, remembered: int = 100_000):
        import regex

        model, self.specials, self.strings = read_vocabulary(path)
        vocab = model["vocab"]
        by_bytes = {s: i for i, s in enumerate(self.strings)}
        self.byte_ids = [by_bytes[bytes([b])] for b in range(256)]
        # for each left symbol: right symbol -> rank and result, in a heap entry's upper bits
        self.merges = [{} for _ in self.strings]
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            entry = (rank << SYMBOL_BITS | vocab[a + b]) << PLACE_BITS
            self.merges[vocab[a]][vocab[b]] = entry
        self.cut_any = regex.compile(PRETOKEN).findall
        self.cut_latin = re.compile(LATIN_PRETOKEN).findall
        self.not_latin = re.compile(NOT_LATIN).search
        found = sorted(map(regex.escape, self.specials), key=len, reverse=True)
        self.split = regex.compile(f"({'|'.join(found)})").split if found else None
        # two generations: the words used lately stay when the older half is dropped
        self.limit, self.young, self.old = remembered, {}, {}

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        merges, ids = self.merges, [self.byte_ids[b] for b in word]
        n = len(ids)
        valid = [0] * n  # the entry that now stands for the pair at each place
        heap = []
        for i in range(n - 1):
            m = merges[ids[i]].get(ids[i + 1])
            if m is not None:
                valid[i] = m = m | i
                heap.append(m)
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        symbol, place = (1 << SYMBOL_BITS) - 1, (1 << PLACE_BITS) - 1
        while heap:
            entry = heapq.heappop(heap)
            i = entry & place
            if valid[i] != entry:
                continue  # stale: one of its two symbols has changed since
            a = ids[i] = entry >> PLACE_BITS & symbol
            j = after[i]
            ids[j], valid[i], valid[j] = -1, 0, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = merges[a].get(ids[k])
                if m is not None:
                    valid[i] = m = m | i
                    heapq.heappush(heap, m)
            h = before[i]
            if h >= 0:
                m = merges[ids[h]].get(a)
                valid[h] = m = 0 if m is None else m | h
                if m:
                    heapq.heappush(heap, m)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        """The ids of a pre-token as int32 bytes, remembered for short ones."""
        ids = self.old.get(word)
        if ids is None:
            ids = array("i", self.merge(word.encode())).tobytes()
            if len(word) > 64:
                return ids
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[word] = ids
        return ids

    def plain(self, text: str) -> list[bytes]:
        words, seen = (self.cut_any if self.not_latin(text) else self.cut_latin)(text), self.young
        found = [seen.get(w) for w in words]
        if None in found:
            found = [f if f is not None else self.young.get(w) or self.word(w) for w, f in zip(words, found)]
        return found

    def encode(self, text: str) -> np.ndarray:
        if self.split and any(s in text for s in self.specials):
            parts = []
            for part in self.split(text):
                if part in self.specials:
                    parts.append(np.int32(self.specials[part]).tobytes())
                elif part:
                    parts += self.plain(part)
        else:
            parts = self.plain(text)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return joined(self.strings, ids)


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name in df.columns:
        raise ValueError(f"the input already has a column {name!r}")
    return T.StructType([*df.schema.fields, T.StructField(name, kind, False)])


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` in the array column ``ids``.

    ``vocabulary`` is a file that every executor has.  A special token's string in a text
    becomes that token.
    """
    out = _with_column(df, ids, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_state(f"bpe {vocabulary}", lambda: Codec(vocabulary))
        for piece in pieces(batches, text):
            found = [codec.encode(t or "") for t in piece.column(text).to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            column = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int32()))
            yield pa.RecordBatch.from_arrays([*piece.columns, column], [*piece.schema.names, ids])

    return df.mapInArrow(run, out)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids ``ids`` in the column ``text``."""
    out = _with_column(df, text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # decoding needs no merges and no memory of words
        strings = worker_state(f"bpe strings {vocabulary}", lambda: read_vocabulary(vocabulary)[2])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                found = [
                    joined(strings, row.values.to_numpy()) if row.is_valid else ""
                    for row in piece.column(ids)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(found, pa.string())], [*piece.schema.names, text]
                )

    return df.mapInArrow(run, out)
