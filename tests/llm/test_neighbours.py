from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quoteloom.llm import neighbours, queries


def brute(rows, every, k=5):
    sound = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v]
    sound = {(i, tuple(v)) for i, v in sound if np.isfinite(v).all() and v.any() and len(v) == 64}
    ids = np.array([i for i, _ in sound])
    x = np.array([v for _, v in sound])
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for i, v in sound:
        if i % every == 0:
            q = np.array(v)
            score = (x * q).sum(1) / (norm * np.sqrt((q * q).sum()))
            other = ids != i
            best = np.lexsort((ids[other], -score[other]))[:k]
            out[i] = list(zip(ids[other][best].tolist(), score[other][best].tolist()))
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == {q for q in want if want[q]}
    hit = total = 0
    for q, best in want.items():
        assert sorted(found[q]) == list(range(1, len(best) + 1))
        scores = [found[q][r][1] for r in sorted(found[q])]
        assert scores == sorted(scores, reverse=True)
        hit += len({i for i, _ in found[q].values()} & {i for i, _ in best})
        total += len(best)
    return hit / total


@pytest.mark.parametrize("block_rows", [8_192, 500])
def test_recall_on_the_table(spark, block_rows):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(table, F.col("vec_id") % 50 == 0, block_rows=block_rows).collect()
    want = brute([(r.vec_id, r.embedding) for r in table.collect()], 50)
    assert recall(got, want) >= 0.95


def test_ties_copies_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=64).tolist()
    rows = [(i, rng.normal(size=64).tolist()) for i in range(300)]
    rows += [(1000 + i, same) for i in range(200)]
    rows += [(1000, same), (2000, None), (2050, [0.0] * 64), (2100, [float("nan")] + [1.0] * 63)]
    rows += [(2150, [1.0]), (2200, [None] + [1.0] * 63)]
    frame = spark.createDataFrame(rows + [(None, same)], "vec_id long, embedding array<double>")
    frame = frame.withColumn("block", F.lit("x")).withColumn("vector", F.lit(1))
    got = neighbours.nearest(frame, F.col("vec_id") % 50 == 0, block_rows=100, sure=1.0).collect()
    want = brute(rows, 50)
    assert recall(got, want) == 1
    assert [r.vec_id for r in got if r.query_id == 1100] == [1000, 1001, 1002, 1003, 1004]


def test_few_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = neighbours.nearest(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 2)]
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(frame.limit(1), F.col("vec_id") == 0).count() == 0


def test_hot_and_oversized_blocks_are_split(spark, monkeypatch):
    """A third of all rows and most queries lie close together, so one block gets them."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) + (6.0 if i % 3 else 0.0)).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "QUERIES_AT_ONCE", 7)
    sent = []
    land = neighbours.land

    def noted(df, label):
        landed = land(df, label)
        if label in ("blocks", "dealt", "queries"):
            sent.append((label, landed))
        return landed

    monkeypatch.setattr(neighbours, "land", noted)
    got = neighbours.nearest(frame, F.col("vec_id") % 10 == 0, block_rows=20, sure=1.0).collect()
    assert recall(got, brute(rows, 10)) == 1
    (_, dealt), (_, asked), (_, first), (_, second) = sent
    sizes = {r["block"]: r["count"] for r in dealt.groupBy("block").count().collect()}
    queries = {r["block"]: r["count"] for r in asked.groupBy("block").count().collect()}
    # copies follow the queries of a block, and blocks without queries are not sent at all
    assert {r.block: r.shares for r in first.collect()} == {b: -(-n // 7) for b, n in queries.items()}
    assert {r.block: r.parts for r in first.collect()} == {b: -(-sizes[b] // 40) for b in queries}
    assert len(queries) < len(sizes) and max(sizes.values()) < 900
