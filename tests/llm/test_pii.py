from __future__ import annotations

import random
import re

import numpy as np
import pytest

from quoteloom.llm import pii

# The patterns of the contract.
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = [
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                16 <= len(digits) <= 19 and pii.luhn(digits),
                8 <= len(digits) <= 15,
            ][kind]
            if fits:
                found.append((kind, *m.span()))
    return found


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a", "Z", "0", "1", "25", "255", "4111", "4111111111111111", "@", ".", "-", " ", "+", "(", ")", "é", "_", "\n", "a@b.c", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(30)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1 " * 90_000])
def test_long_runs_take_linear_time(text):
    pii.Graph([text])


def test_repeated_part_of_a_number_takes_its_label(spark):
    filler = "word " * 30
    rows = [
        (i, f"{filler}call +1 (555) 01{i:02d}-4477 now {filler} and ask 01{i:02d}-4477, {filler} in 1987")
        for i in range(60)
    ]
    rows += [(200 + i, f"+1 (555) 02{i:02d}-1234, again +1 (555) 02{i:02d}-1234") for i in range(40)]
    rows += [(100, None), (101, ""), (None, "year 1987")]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100].pii == [] and found[101].pii == [] and found[None].pii == []
    text, spans = found[7].text, found[7].pii
    assert [(s.kind, s.base, text[s.start : s.end]) for s in spans] == [
        ("phone", True, "+1 (555) 0107-4477"),
        ("phone", False, "0107-4477"),
    ]


def test_masking_and_other_columns(spark):
    frame = spark.createDataFrame([(1, "x a@b.co y", 5), (2, None, 6)], "doc_id long, text string, kind int")
    rows = pii.mask_pii(pii.find_pii(frame)).orderBy("doc_id").collect()
    assert [(r.text, r.kind) for r in rows] == [("x [email] y", 5), (None, 6)]


def test_message_passing_is_exact_on_a_tree():
    graph = pii.Graph(["7 8 9"])
    graph.seen = [-1, -1, -1]
    rng = np.random.default_rng(2)
    table = rng.normal(size=(pii.BUCKETS, 5))
    model = pii.Potentials(table, 0 * table, rng.normal(size=(5, 5)), np.zeros((5, 5)))
    own = table[[f[0] for f in graph.features]]
    joint = np.exp(
        own[0][:, None, None] + own[1][:, None] + own[2] + model.chain[:, :, None] + model.chain[None]
    )
    joint /= joint.sum()
    got = pii.beliefs(graph, model, rounds=60)
    assert np.allclose(got, [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))], atol=1e-6)
    assert graph.chain == [(0, 1), (1, 2)]


def test_fifty_repeats_take_the_label():
    """Each repeat takes it as a single one would, however many there are."""
    text = "call +49 30 1234567 now " + "word and 1234567 then " * 50
    graph = pii.Graph([text])
    own, skip = np.zeros((pii.BUCKETS, 5)), np.zeros((5, 5))
    own[:, pii.OUTSIDE] = 1.0
    np.fill_diagonal(skip, 4.0)
    p = pii.beliefs(graph, pii.Potentials(own, 0 * own, np.zeros((5, 5)), skip))
    repeats = [i for i, s in enumerate(graph.seen) if s < 0]
    assert len(repeats) == 50 and (p[repeats].argmax(1) == 3).all() and (p[repeats, 3] > 0.9).all()


def test_long_chains_settle():
    graph = pii.Graph([" ".join(str(i % 10) for i in range(80))])
    graph.seen[0] = 3
    table = np.zeros((5, 5))
    np.fill_diagonal(table, 12.0)
    p = pii.beliefs(graph, pii.Potentials(np.zeros((pii.BUCKETS, 5)), np.zeros((pii.BUCKETS, 5)), table, 0 * table))
    assert p[-1].argmax() == 3 and p[-1, 3] > 0.9


def test_a_text_gets_the_same_alone_and_beside_others(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"{rng.integers(300)}-{rng.integers(9)}" for _ in range(n)) for n in (3, 40, 1, 12)]
    texts[2] = "call +49 30 1234567 now and 1234567 then 8 9 10 8"
    model = pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    together, graph = pii.Graph(texts), [pii.Graph([t]) for t in texts]
    alone = np.concatenate([pii.beliefs(g, model) for g in graph if g.doc])
    assert np.array_equal(pii.beliefs(together, model), alone)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(frame).count() == 0 and pii.mask_pii(pii.find_pii(frame)).count() == 0
