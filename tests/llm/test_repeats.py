from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from quoteloom.llm import repeats


def brute(rows, length):
    seen = {}
    for r, (_, text) in enumerate(rows):
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            seen.setdefault(data[i : i + length], []).append((r, i))
    gone = [bytearray(len((t or "").encode())) for _, t in rows]
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                gone[r][i : i + length] = b"\1" * length
    out = []
    for (doc, text), g in zip(rows, gone):
        data = (text or "").encode()
        kept = bytes(b for b, x in zip(data, g) if not x)
        runs = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        out.append((str(doc), len(data), sum(g), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def ours(spark, rows, length, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((str(r[0]), *r[1:]) for r in repeats.summary(frame, length, **options).collect())


def sample(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choices("abcé ", k=n))
    shared = [say(n) for n in (150, 199, 200, 201, 400, 900)]
    rows = [(i, say(rng.choice([0, 10, 199, 200, 500]))) for i in range(30)]
    for i in range(60):
        s = rng.choice(shared)
        cut = rng.randrange(len(s))
        rows.append((100 + i, say(rng.randrange(80)) + s[cut // 4 :] + say(rng.randrange(80))))
    rows += [(500, "a" * 1500), (501, "ab" * 600), (502, shared[4]), (503, shared[4])]
    rows += [(None, None), (504, ""), (505, shared[5] + shared[5]), (30, rows[3][1])]
    return rows


@pytest.mark.parametrize("hot", [1_000, 3])
def test_equals_brute_force(spark, hot):
    rows = sample(1)
    assert ours(spark, rows, 200, hot=hot) == brute(rows, 200)


def test_small_blocks_and_odd_lengths_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2_000)
    rows = sample(2)
    for length in (48, 203):
        assert ours(spark, rows, length) == brute(rows, length)


def test_cover_and_suffix_order():
    differences = {(a - b) % 32 for a in repeats.COVER for b in repeats.COVER}
    assert differences == set(range(32)) and len(repeats.COVER) <= 9
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    text[1000:1700] = text[2000:2700]
    text[3000:3400] = 97
    starts = rng.permutation(np.arange(len(text) - 200 + 1))
    got = repeats.repeated(text, starts, 200)
    data = text.tobytes()
    seen = {}
    for s in starts.tolist():
        seen[data[s : s + 200]] = seen.get(data[s : s + 200], 0) + 1
    assert got.tolist() == [seen[data[s : s + 200]] > 1 for s in starts.tolist()]


def test_empty_table(spark):
    assert ours(spark, [], 200) == []
