from __future__ import annotations

import random
import re

import numpy as np

from quoteloom.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, size=10):
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            q = words(t)
            if item is None or not q:
                continue
            for at in range(max(1, len(q) - size + 1)):
                window = q[at : at + size]
                for i in range(len(w) - len(window) + 1):
                    if w[i : i + len(window)] == window:
                        hit.update(range(i, i + len(window)))
                        found.add(item)
        out.append((doc, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=repr)


def ours(spark, docs, items, **options):
    found = d.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        **options,
    )
    return sorted(
        (
            (r.doc_id, r.n_words, [i for s in r.spans for i in range(s["start"], s["end"])], r["items"])
            for r in found.collect()
        ),
        key=repr,
    )


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "d", "É", "7"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice([1, 4, 9, 10, 11, 25]) if i > 3 else 30)) for i in range(12)]
    items += [(20, None), (None, "a b"), (21, "--"), (22, items[0][1])]
    docs = [(i, say(rng.choice([0, 3, 40, 200]))) for i in range(40)]
    docs += [(100 + i, f"{say(15)}, Zz {items[i][1].upper()}!zz {say(5)}") for i in range(12)]
    docs += [(None, None), (1, ""), (1, docs[3][1]), (2, "a " * 5000)]
    return docs, [i for i in items if i[1] is None or len(words(i[1])) != 1]


def test_equals_brute_force(spark):
    docs, items = sample(1)
    assert ours(spark, docs, items) == brute(docs, items)


def test_passes_and_small_shards_give_the_same(spark):
    docs, items = sample(2)
    assert ours(spark, docs, items, pass_bytes=100, shard_bytes=300) == brute(docs, items)


def test_however_many_passes_a_plan_holds_one(spark):
    docs, items = sample(4)
    frames = [spark.createDataFrame(r, f"{n} long, text string") for n, r in (("doc_id", docs), ("item_id", items))]
    plan = d.find_leaks(*frames, pass_bytes=50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_empty_tables(spark):
    docs, items = sample(3)
    assert ours(spark, [], items) == []
    assert all(r[2] == [] and r[3] == [] for r in ours(spark, docs, []))


def test_index_finds_all_positions():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 4, 500)
    symbols[-1] = 0
    index = d.FMIndex(symbols)
    phrases = rng.integers(1, 4, (50, 3))
    lo, hi = index.search(phrases, np.full(50, 3))
    for p, a, b in zip(phrases, lo, hi):
        want = [i for i in range(498) if (symbols[i : i + 3] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_spans_are_cut_and_other_columns_stay(spark):
    frame = spark.createDataFrame([(1, "Ä: one two-three four.", 9)], "doc_id long, text string, id int")
    items = spark.createDataFrame([(1, "Two three")], "item_id long, text string")
    found = d.remove_spans(d.find_leaks(frame, items)).first()
    assert (found["text"], found["id"]) == ("Ä: one  four.", 9)
