"""Exact repeats: every byte under a string of ``length`` bytes that starts twice.

Suffixes are sorted bucket by bucket.  A bucket holds all suffixes whose first ``length``
bytes have the same minimizer (the least hash of their ``GRAM``-byte strings), so equal
beginnings always meet in one bucket.  Neighbouring suffixes of a bucket travel together as
one fragment of text, and fragments whose minimizer occurs once in all texts stay where they
are, for nothing in them can repeat.

Within a block of buckets, suffixes are sorted by their first ``PERIOD`` bytes.  Ties that last
longer are resolved by ranks of a difference-cover sample, computed beforehand: for any two
suffixes some shift below ``PERIOD`` brings both to sampled places, whose ranks settle the order.
Neighbours in the order are then compared byte by byte.  Memory is that of a block.

Equal texts are one text with a count; if there are several, all of it repeats.  A minimizer
that very many fragments share (a common passage) would make a hot bucket: there, fragments of
equal text are found first and repeat as a whole, and the suffixes of the different ones are
not sorted but counted by two 64-bit hashes of their first ``length`` bytes.

Nulls: a null text is an empty one.  Texts under ``length`` bytes have no repeats.  Repeated rows
are rows.  Columns beside the two named ones do not take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import merged_spans, pieces

GRAM = 48
PERIOD = 32
HOT = 1_000  # fragments of one minimizer
BLOCK_BYTES = 2_000_000
# odd multipliers of the rolling hashes
BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def difference_cover(period: int) -> np.ndarray:
    """Places below ``period`` whose differences, modulo it, are all numbers below it; greedy."""
    cover, seen = [0], {0}
    while len(seen) < period:
        gains = [
            len({(x - c) % period for c in cover} | {(c - x) % period for c in cover} | seen)
            for x in range(period)
        ]
        cover.append(int(np.argmax(gains)))
        seen = {(a - b) % period for a in cover for b in cover}
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)
PLACE = np.full(PERIOD, -1)
PLACE[COVER] = np.arange(len(COVER))
_sampled = PLACE >= 0
# the least shift that brings two residues into the cover
SHIFT = np.array(
    [
        [
            next(s for s in range(PERIOD) if _sampled[(a + s) % PERIOD] and _sampled[(b + s) % PERIOD])
            for b in range(PERIOD)
        ]
        for a in range(PERIOD)
    ]
)


def dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by the keys, first one first, and each element's dense rank."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; big end first."""
    out = np.zeros(len(text) - 8, np.uint64)
    for i in range(8):
        out |= text[i : len(text) - 8 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def cover_ranks(words: np.ndarray, n_blocks: int, depth: int) -> np.ndarray:
    """Ranks of the sampled suffixes by ``depth`` bytes or more; block by block, by place."""
    sample = (np.arange(n_blocks)[:, None] * PERIOD + COVER).ravel()
    _, rank = dense(*(words[sample + i] for i in range(0, PERIOD, 8)))
    width = 1
    while width * PERIOD < depth:
        ahead = np.zeros_like(rank)
        step = width * len(COVER)
        ahead[:-step] = rank[step:] + 1
        _, rank = dense(rank * (int(rank.max()) + 2) + ahead)
        width *= 2
    return rank


def repeated(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``starts`` share their first ``length`` bytes with another."""
    n_blocks = len(text) // PERIOD + 2
    padded = np.concatenate([text, np.zeros((n_blocks + 2) * PERIOD + 8 + length - len(text), np.uint8)])
    words = words_at(padded)
    rank = cover_ranks(words, n_blocks, length)
    order, group = dense(*(words[starts + i] for i in range(0, PERIOD, 8)))
    at, group = starts[order], group[order]
    live = np.arange(len(at))  # slots in groups that are still tied
    while True:
        head = np.flatnonzero(np.diff(group[live], prepend=-1))
        size = np.diff(np.append(head, len(live)))
        live = live[np.repeat(size > 1, size)]
        if not live.size:
            break
        head = np.flatnonzero(np.diff(group[live], prepend=-1))
        size = np.diff(np.append(head, len(live)))
        one, pivot = at[live], np.repeat(at[live][head + size // 2], size)
        shift = SHIFT[one % PERIOD, pivot % PERIOD]
        rank_one, rank_pivot = (
            rank[(p // PERIOD) * len(COVER) + PLACE[p % PERIOD]] for p in (one + shift, pivot + shift)
        )
        side = np.sign(rank_one - rank_pivot)
        turn = np.argsort((group[live] << 2) + side + 1, kind="stable")
        side = side[turn]
        at[live] = one[turn]
        # a group's number is its first slot, so parts keep apart from all other groups
        part = np.flatnonzero((np.diff(group[live], prepend=-1) != 0) | (np.diff(side, prepend=9) != 0))
        group[live] = np.repeat(live[part], np.diff(np.append(part, len(live))))
        live = live[side != 0]
    same = np.ones(max(0, len(at) - 1), bool)
    last = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for i in last:
        held = np.flatnonzero(same)
        same[held] = words[at[held] + i] == words[at[held + 1] + i]
    hit = np.zeros(len(at), bool)
    hit[:-1] |= same
    hit[1:] |= same
    out = np.empty(len(at), bool)
    # places may come in any order; give the answer in theirs
    back = np.argsort(at, kind="stable")
    out[np.argsort(starts, kind="stable")] = hit[back]
    return out


class Rolling:
    """Rolling hashes of all strings of a size."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, text: np.ndarray, size: int) -> np.ndarray:
        n = len(text)
        if len(self.up) < n + 1:
            ones = np.ones(n + 1, np.uint64)
            self.up, self.down = ones.copy(), ones.copy()
            self.up[1:], self.down[1:] = np.uint64(self.base), np.uint64(self.inverse)
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text + np.uint64(1)) * self.up[:n], dtype=np.uint64)])
        value = (sums[size:] - sums[:-size]) * self.down[: n - size + 1]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xFF51AFD7ED558CCD)
        return value ^ value >> np.uint64(29)


def sliding(values: np.ndarray, width: int, best: np.ufunc, worst: int) -> np.ndarray:
    """The least or greatest of each ``width`` values in a row."""
    rows = -(-len(values) // width)
    table = np.full(rows * width, worst, np.uint64)
    table[: len(values)] = values
    table = table.reshape(rows, width)
    ahead = best.accumulate(table, 1).ravel()
    behind = best.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return best(behind[:count], ahead[width - 1 : width - 1 + count])


def fragments(text: np.ndarray, ends: np.ndarray, length: int, rolls: list[Rolling]):
    """(key, first start, last start, occurrences) of the runs of suffixes with one key.

    The key is made of the minimizers under each of ``rolls``.  ``ends`` are where the texts
    in ``text`` end, one after the other.  Occurrences are the places within the run that have
    the minimizer, the fewest of all functions: over one if the run may repeat itself.
    """
    n = len(text)
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    width, count = length - GRAM + 1, n - length + 1
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    whole = doc[:count] == doc[length - 1 :]
    new = np.ones(count, bool)
    new[1:] = doc[1:count] != doc[: count - 1]
    functions = []
    for roll in rolls:
        grams = roll(text.astype(np.uint64), GRAM)
        least = sliding(grams, width, np.minimum, np.iinfo(np.uint64).max)
        functions.append((grams, least))
        new[1:] |= least[1:] != least[:-1]
    first = np.flatnonzero(new & whole)
    stop = np.append(np.flatnonzero(new | ~whole), count)
    last = stop[np.searchsorted(stop, first, side="right")] - 1
    key = np.zeros(len(first), np.uint64)
    times = np.full(len(first), n)
    edge = np.zeros(width - 1, np.uint64)
    for grams, least in functions:
        # the places that are the minimizer of a suffix
        most = sliding(np.concatenate([edge, np.where(whole, least, np.uint64(0)), edge]), width, np.maximum, 0)
        chosen = np.flatnonzero(grams == most)
        low = np.searchsorted(chosen, first)
        size = np.searchsorted(chosen, last + width) - low
        fragment = np.repeat(np.arange(len(first)), size)
        place = np.arange(len(fragment)) - np.repeat(np.cumsum(size) - size - low, size)
        own = grams[chosen[place]] == least[first[fragment]]
        times = np.minimum(times, np.bincount(fragment[own], minlength=len(first)))
        key = key * np.uint64(BASES[1]) + least[first]
    return key.view(np.int64), first, last, times


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and where each value ends."""
    sizes = np.array([len(v.as_buffer()) for v in column], np.int64)
    text = np.frombuffer(b"".join(v.as_buffer() for v in column), np.uint8)
    return text, np.cumsum(sizes)


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """(mark, data, copies): each different text once, and how many rows have it."""
    data = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = docs.select(data.alias("data")).select(F.unhex(F.md5("data")).alias("mark"), "data")
    # joins on mark would add this filter to their branch; with it in all of them they share a shuffle
    rows = rows.where(F.col("mark").isNotNull())
    return rows.groupBy("mark").agg(F.first("data").alias("data"), F.count("*").alias("copies"))


def find_fragments(texts: DataFrame, length: int, bases: list[int]) -> DataFrame:
    """(key, mark, first, last, times): the fragments of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls = [Rolling(b) for b in bases]
        for piece in pieces(batches, "data", 1_000_000):
            text, ends = _joined(piece.column("data"))
            key, first, last, times = fragments(text, ends, length, rolls)
            doc = np.searchsorted(ends, first, side="right")
            begin = ends - np.diff(ends, prepend=0)
            columns = [
                pa.array(key),
                piece.column("mark").take(pa.array(doc)),
                pa.array(first - begin[doc], pa.int32()),
                pa.array(last - begin[doc], pa.int32()),
                pa.array(times, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "mark", "first", "last", "times"])

    return texts.mapInArrow(run, "key long, mark binary, first int, last int, times int")


def shared_fragments(texts: DataFrame, length: int, bases: list[int]) -> DataFrame:
    """(mark, fragment, n): the fragments whose key occurs n > 1 times in all texts."""
    found = find_fragments(texts, length, bases)
    counts = found.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1")
    fragment = F.struct("key", "first", "last").alias("fragment")
    return found.join(counts, "key").select("mark", fragment, "n")


def find_repeats(docs: DataFrame, length: int = 200, *, text: str = "text", hot: int = HOT) -> DataFrame:
    """(mark, data, copies, spans): each different text with the byte ranges that repeat.

    ``mark`` is the MD5 of the text.  ``spans`` are in order, apart from each other, ends exclusive.
    """
    if length < max(GRAM, PERIOD):
        raise ValueError(f"a repeat has {max(GRAM, PERIOD)} bytes or more")
    texts = distinct_texts(docs, text)
    shared = shared_fragments(texts, length, BASES[:1])
    rest = cut_fragments(texts, shared.where(F.col("n") <= hot), length)
    spans = _sorted_buckets(rest, length)
    spans = spans.union(_counted_suffixes(cut_fragments(texts, shared.where(F.col("n") > hot), length), length))
    by_text = spans.groupBy("mark").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    size = F.octet_length("data")
    whole = F.array(F.struct(F.lit(0).alias("start"), size.alias("end")))
    merged = F.when((F.col("copies") > 1) & (size >= length), whole).otherwise(
        F.coalesce(merged_spans(F.col("spans")), F.expr("array()"))
    )
    return texts.join(by_text, "mark", "left").select("mark", "data", "copies", merged.alias("spans"))


def cut_fragments(texts: DataFrame, shared: DataFrame, length: int) -> DataFrame:
    """(key, mark, first, text): fragments with their text."""
    listed = shared.groupBy("mark").agg(F.collect_list("fragment").alias("fragments"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["key", "mark", "first", "text"], [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        for piece in pieces(batches, "data"):
            rows = zip(*(piece.column(c).to_pylist() for c in ("mark", "data", "fragments")))
            cut = [
                (f["key"], mark, f["first"], data[f["first"] : f["last"] + length])
                for mark, data, some in rows
                for f in some
            ]
            columns = [pa.array(c, k) for c, k in zip(zip(*cut), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    joined = texts.join(listed, "mark")
    return joined.mapInArrow(run, "key long, mark binary, first int, text binary")


def _sorted_buckets(cut: DataFrame, length: int) -> DataFrame:
    """(mark, span) from the sorted suffixes of all fragments, a block of buckets at a time."""
    rows = cut.select("key", "mark", "first", "text")
    dealt = rows.repartition("key").sortWithinPartitions("key")

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        text, ends = _joined(table.column("text").chunk(0))
        sizes = np.diff(ends, prepend=0)
        begin = ends - sizes
        count = sizes - length + 1
        owner = np.repeat(np.arange(len(ends)), count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        hit = repeated(text, begin[owner] + within, length)
        owner, at = owner[hit], within[hit]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > length)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(owner)) - 1 if len(head) else head
        first = table.column("first").to_numpy()[owner[head]]
        span = pa.StructArray.from_arrays(
            [
                pa.array(first + at[head], pa.int32()),
                pa.array(first + at[tail] + length, pa.int32()),
            ],
            ["start", "end"],
        )
        mark = table.column("mark").chunk(0).take(pa.array(owner[head]))
        return pa.RecordBatch.from_arrays([mark, span], ["mark", "span"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text", BLOCK_BYTES // 4):
            if size > BLOCK_BYTES:
                keys = piece.column("key").to_numpy()
                before = held[-1].column("key")[-1].as_py()
                cuts = np.flatnonzero(np.concatenate([[before], keys[:-1]]) != keys)
                if cuts.size:
                    done = int(cuts[0])
                    yield block([*held, piece.slice(0, done)])
                    held, size, piece = [], 0, piece.slice(done)
            held.append(piece)
            size += piece.column("text").nbytes
        if held:
            yield block(held)

    return dealt.mapInArrow(run, "mark binary, span struct<start:int,end:int>")


def _distinct(rows: DataFrame) -> DataFrame:
    """Fragments of equal text once: mark, data, n, and the place and ``alone`` of one of them."""
    return rows.where(F.col("same").isNotNull()).groupBy(F.col("same").alias("mark")).agg(
        F.first("text").alias("data"),
        F.count("*").alias("n"),
        F.min("mark").alias("owner"),
        F.min("first").alias("start"),
        F.min("alone").alias("alone"),
    )


def _whole(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(mark, span) of the fragments whose text occurs more than once."""
    often = groups.where("n > 1").select(F.col("mark").alias("same"))
    span = F.struct(F.col("first").alias("start"), (F.col("first") + F.octet_length("text")).alias("end"))
    return rows.where("alone").join(often, "same", "left_semi").select("mark", span.alias("span"))


def _counted_suffixes(hot: DataFrame, length: int) -> DataFrame:
    """(mark, span) of what repeats in hot buckets.

    Fragments of equal text repeat as a whole.  The different ones, the others and one of each
    equal ones, are cut anew under the minimizers of more hash functions, all together as key:
    few of the suffixes that reach out of a common passage still share theirs with another.
    Of the pieces that do, equal ones again repeat as a whole, and the suffixes of the
    different ones are counted by two hashes.
    """
    same = F.unhex(F.md5("text")).alias("same")
    rows = hot.select("mark", "first", "text", same, F.lit(True).alias("alone"))
    groups = _distinct(rows)
    listed = shared_fragments(groups.select("mark", "data"), length, BASES[1:]).groupBy("mark").agg(
        F.collect_list("fragment").alias("fragments")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["mark", "first", "text", "alone"]
        kinds = [pa.binary(), pa.int32(), pa.binary(), pa.bool_()]
        for piece in pieces(batches, "data"):
            parts = []
            columns = (piece.column(c).to_pylist() for c in ("owner", "start", "n", "data", "fragments"))
            for owner, start, n, data, some in zip(*columns):
                for f in some:
                    text = data[f["first"] : f["last"] + length]
                    parts.append((owner, start + f["first"], text, n == 1))
            columns = zip(*parts) if parts else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    parts = groups.join(listed, "mark").mapInArrow(
        cut, "mark binary, first int, text binary, alone boolean"
    )
    parts = parts.select("mark", "first", "text", same, "alone")
    pieces_left = _distinct(parts)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls = [Rolling(b) for b in BASES[:2]]
        names = ["key", "check", "alone", "mark", "first"]
        for piece in pieces(batches, "data", 500_000):
            text, ends = _joined(piece.column("data"))
            count = np.diff(ends, prepend=0) - length + 1
            owner = np.repeat(np.arange(len(ends)), count)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            at = (ends - np.diff(ends, prepend=0))[owner] + within
            alone = (piece.column("n").to_numpy() == 1) & piece.column("alone").to_numpy(zero_copy_only=False)
            columns = [
                *(pa.array(r(text.astype(np.uint64), length)[at].view(np.int64)) for r in rolls),
                pa.array(alone[owner]),
                piece.column("owner").take(pa.array(owner)),
                pa.array(piece.column("start").to_numpy()[owner] + within, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    suffixes = pieces_left.mapInArrow(
        expand, "key long, check long, alone boolean, mark binary, first int"
    )
    twice = suffixes.groupBy("key", "check").agg(F.count("*").alias("n")).where("n > 1")
    found = suffixes.where("alone").join(twice, ["key", "check"])
    span = F.struct(F.col("first").alias("start"), (F.col("first") + length).alias("end"))
    found = found.select("mark", span.alias("span"))
    return found.union(_whole(rows, groups)).union(_whole(parts, pieces_left))


def summary(docs: DataFrame, length: int = 200, *, id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Per row: ``id``, bytes, bytes and runs removed, and ``kept`` (the SHA-256 of what stays)."""
    found = find_repeats(docs, length, text=text, hot=hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "data"):
            out = [[], [], [], []]
            for data, spans in zip(piece.column("data").to_pylist(), piece.column("spans").to_pylist()):
                at, kept = 0, hashlib.sha256()
                for s in spans:
                    kept.update(data[at : s["start"]])
                    at = s["end"]
                kept.update(data[at:])
                row = (len(data), sum(s["end"] - s["start"] for s in spans), len(spans), kept.hexdigest())
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = [piece.column("mark"), *(pa.array(c, k) for c, k in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(columns, ["mark", "n_bytes", "n_removed", "n_spans", "kept"])

    by_text = found.mapInArrow(
        run, "mark binary, n_bytes long, n_removed long, n_spans long, kept string"
    )
    data = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.unhex(F.md5(data)).alias("mark"))
    return rows.join(by_text, "mark").select(
        F.col("id").alias(id), "n_bytes", "n_removed", "n_spans", "kept"
    )
