from __future__ import annotations

import random

import xxhash

from quoteloom.llm import simhash


def brute(rows):
    prints = []
    for _, text in rows:
        words = bytes(text or "", "utf-8").lower().split()
        if not words:
            prints.append(0)
            continue
        runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        (str(doc), f"{prints[i]:016x}", str(least.get(find(i)))) for i, (doc, _) in enumerate(rows)
    )


def ours(spark, rows, schema="doc_id long, text string"):
    found = simhash.near_duplicates(spark.createDataFrame(rows, schema))
    return sorted(
        (str(r[0]), f"{r[1] & (1 << 64) - 1:016x}", str(r[2])) for r in found.collect()
    )


def test_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.choice([3, 30, 200]))
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.choice([0, 0, 1, 4])):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(["x", "Y", "é"])
            rows.append((len(rows), "\t".join(words)))
    rows += [(None, None), (900, ""), (901, None), (901, "  \n"), (5, rows[5][1]), (902, "One two")]
    rows += [(903, "a " * 50_000)]
    assert ours(spark, rows) == brute(rows)


def test_many_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(300)]
    values += [v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) ^ 5 for v in values[:200]]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    some = []
    for group in (4_000, 0.0001):
        monkeypatch.setattr(simhash, "GROUP", group)
        links = simhash.close_links(frame, 4)
        found = simhash.components(links).collect()
        some.append(sorted((r[0], r[1]) for r in found))
    assert some[0] == some[1] and len(some[0]) > 300


def test_empty_and_clashing_columns(spark):
    assert ours(spark, []) == []
    frame = spark.createDataFrame(
        [(1, "a b", "z", 3), (2, "a b", "y", 4)],
        "doc_id long, text string, fingerprint string, component int",
    )
    found = simhash.near_duplicates(frame).collect()
    assert {r["component_id"] for r in found} == {1} and len(found) == 2
