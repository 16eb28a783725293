"""Approximate nearest neighbours by cosine: stable projections in kd-trees, and a stop test.

Vectors of length one are projected on ``dims`` Gaussian directions.  If two vectors are d
apart, the square of their projected distance over d squared has a chi-square distribution
with ``dims`` degrees of freedom.  So a search takes points in the order of their projected
distance, checks each in full, and may stop as soon as a point that beats its k-th best would
have come up by now with probability ``sure``.

Two levels of kd-trees over the projections hold all rows: a coarse tree, fitted on a bounded
sample, deals rows out to blocks, and each block has a tree of its own.  A query is searched in
its own block first; its k-th best there tells by the same test which other blocks it must visit.

Rows without an id, and vectors that are null, zero, of another length than most, or that hold
null or non-finite components take no part.  Rows of equal id and vector are one row; a row with
the query's id is the query's own.  Of equal vectors, the ``k + 1`` smallest ids are kept, for
no answer can hold another.  Columns beside the two named ones do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, factorial, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.shared import land

LEAF = 64  # points in a leaf of a block's tree
SAMPLE = 20_000  # rows that the coarse tree is fitted on, or four for each of its leaves
MOST_BLOCKS = 1 << 16
QUERIES_AT_ONCE = 20_000  # in one task


def chi_square(x: np.ndarray, dims: int) -> np.ndarray:
    """The distribution function for an even number of degrees of freedom."""
    half = np.minimum(x / 2, 700.0)
    return 1 - np.exp(-half) * sum(half**i / factorial(i) for i in range(dims // 2))


class KdTree:
    """A complete kd-tree's splits; leaves are numbered from the left."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(1 << depth, np.int64)
        self.value = np.full(1 << depth, np.inf)
        held = [np.arange(len(points))]
        for level in range(depth):
            children = []
            for i, rows in enumerate(held):
                node = (1 << level) + i
                if len(rows):
                    part = points[rows]
                    axis = int((part.max(0) - part.min(0)).argmax())
                    self.axis[node], self.value[node] = axis, np.median(part[:, axis])
                right = points[rows, self.axis[node]] > self.value[node]
                children += [rows[~right], rows[right]]
            held = children

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.axis[node]] > self.value[node])
        return node - (1 << self.depth)

    def boxes(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest corner of every leaf's part of space."""
        low, high = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)
        for level in range(self.depth):
            low, high = np.repeat(low, 2, 0), np.repeat(high, 2, 0)
            node = np.arange(1 << level, 2 << level)
            left = 2 * np.arange(1 << level)
            high[left, self.axis[node]] = np.minimum(high[left, self.axis[node]], self.value[node])
            low[left + 1, self.axis[node]] = np.maximum(low[left + 1, self.axis[node]], self.value[node])
        return low, high


def gap(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    away = np.maximum(np.maximum(low - point, point - high), 0)
    return (away * away).sum(1)


class Block:
    """Some vectors under a kd-tree of their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: np.ndarray):
        length = np.sqrt((vectors * vectors).sum(1))
        projected = (vectors / length[:, None]) @ directions
        depth = max(0, ceil(log2(max(1, len(ids)) / LEAF)))
        leaf = KdTree(projected, depth).leaf(projected)
        order = np.argsort(leaf, kind="stable")
        self.ids, self.vectors, self.length = ids[order], vectors[order], length[order]
        self.starts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
        self.ends = np.append(self.starts[1:], len(ids))
        self.low = np.minimum.reduceat(projected[order], self.starts, 0)
        self.high = np.maximum.reduceat(projected[order], self.starts, 0)
        self.directions = directions

    def search(self, own: int, query: np.ndarray, k: int, sure: float, worst: float):
        """Ids and cosines of up to k rows, and the squared distance of the k-th best so far.

        ``worst`` is the squared distance of the k-th best found elsewhere.
        """
        length = np.sqrt((query * query).sum())
        far = gap((query / length) @ self.directions, self.low, self.high)
        turn = np.argsort(far, kind="stable")
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 4
        while at < len(turn):
            ahead = far[turn[at]]
            if ahead > 0 and chi_square(ahead / max(worst, 1e-12), self.directions.shape[1]) >= sure:
                break
            rows = np.concatenate([np.arange(self.starts[t], self.ends[t]) for t in turn[at : at + step]])
            at += step
            cosine = (self.vectors[rows] * query).sum(1) / (self.length[rows] * length)
            ids = np.concatenate([ids, self.ids[rows]])
            scores = np.concatenate([scores, cosine])
            other = ids != own
            ids, scores = ids[other], scores[other]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                worst = min(worst, max(0.0, 2 - 2 * float(scores[-1])))
        return ids, scores, worst


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, as doubles."""
    rows = vectors.select(
        F.col(f"`{id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & sound & F.exists("vector", lambda v: v != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").limit(1).collect()
    return rows.where(F.size("vector") == (most[0]["size"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    *,
    dims: int = 8,
    sure: float = 0.98,
    block_rows: int = 8_192,
    id: str = "vec_id",
    vector: str = "embedding",
    seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): up to k nearest rows by cosine of every query row.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id, vector)
    same = Window.partitionBy("vector").orderBy("vec_id")
    points = rows.distinct().withColumn("nth", F.row_number().over(same)).where(f"nth <= {k + 1}")
    points = land(points.select("vec_id", "vector"), "points")
    queries = rows.where(is_query).distinct()
    size, n = points.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)), F.count("*")).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    directions = np.random.default_rng(seed).normal(size=(size, dims))

    def project(batch: np.ndarray) -> np.ndarray:
        return batch / np.sqrt((batch * batch).sum(1, keepdims=True)) @ directions

    blocks = min(MOST_BLOCKS, max(1, 2 ** round(log2(max(1.0, n / block_rows)))))
    # some rows for each leaf of the coarse tree
    share = int(min(1.0, max(SAMPLE, 4 * blocks) / n) * 2**31)
    sample = points.where(F.pmod(F.xxhash64("vec_id"), F.lit(2**31)) < share).select("vector").toArrow()
    fitted = _matrix(sample.column("vector").combine_chunks()) if sample.num_rows else np.ones((1, size))
    coarse = KdTree(project(fitted), int(log2(blocks)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                block = coarse.leaf(project(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), batch.column("vec_id"), batch.column("vector")],
                    ["block", "vec_id", "vector"],
                )

    dealt = land(points.mapInArrow(deal, "block long, vec_id long, vector array<double>"), "dealt")
    # a block with more rows than it should have is searched in parts; one row for each block
    sizes = dealt.groupBy("block").agg(F.ceil(F.count("*") / F.lit(2 * block_rows)).alias("parts"))

    result = "query_id long, vector array<double>, block long, worst double, ids array<long>, scores array<double>"

    def search(some: pa.Table, wanted: pa.Table) -> pa.Table:
        found = {c: [] for c in ("query_id", "vector", "block", "worst", "ids", "scores")}
        block = None
        if some.num_rows:
            ids = some.column("vec_id").to_numpy()
            block = Block(ids, _matrix(some.column("vector").combine_chunks()), directions)
        lists = (wanted.column(c).to_pylist() for c in ("vec_id", "vector", "block", "worst"))
        for own, query, home, worst in zip(*lists):
            ids, scores = [], []
            if block is not None:
                ids, scores, worst = block.search(own, np.array(query), k, sure, worst)
            for name, value in zip(found, (own, query, home, worst, ids, scores)):
                found[name].append(value)
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.float64()]
        kinds += [pa.list_(pa.int64()), pa.list_(pa.float64())]
        return pa.table([pa.array(v, t) for v, t in zip(found.values(), kinds)], names=list(found))

    def meet(wanted: DataFrame) -> DataFrame:
        """Every query with all parts of its block; blocks that no query asks for stay where they are.

        A block of many queries is sent once for each ``QUERIES_AT_ONCE`` of them.
        """
        per = wanted.groupBy("block").agg(F.ceil(F.count("*") / F.lit(QUERIES_AT_ONCE)).alias("shares"))
        per = land(per.join(sizes, "block"), "blocks")
        one = F.lit(1).cast("long")
        there = dealt.join(per, "block").select(
            "block",
            "vec_id",
            "vector",
            F.pmod(F.xxhash64("vec_id"), "parts").alias("part"),
            F.explode(F.sequence(one, "shares")).alias("share"),
        )
        asked = wanted.join(per, "block", "left").select(
            *wanted.columns,
            (F.pmod(F.xxhash64("vec_id"), F.coalesce("shares", one)) + 1).alias("share"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", one) - 1)).alias("part"),
        )
        keys = ("block", "part", "share")
        return there.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, result)

    home = land(queries.mapInArrow(deal, "block long, vec_id long, vector array<double>"), "queries")
    first = land(meet(home.withColumn("worst", F.lit(float("inf")))), "first-search")
    best = first.groupBy("query_id", "vector", "block").agg(F.min("worst").alias("worst"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = coarse.boxes(dims)
        for batch in batches:
            if not batch.num_rows:
                continue
            places = project(_matrix(batch.column("vector")))
            worst, own = batch.column("worst").to_numpy(), batch.column("block").to_numpy()
            for i in range(batch.num_rows):
                far = gap(places[i], low, high)
                visit = chi_square(far / max(worst[i], 1e-12), dims) < sure
                visit[own[i]] = False
                there = np.flatnonzero(visit)
                if there.size:
                    row = batch.slice(i, 1).take(np.zeros(there.size, np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(there), *(row.column(c) for c in ("query_id", "vector", "worst"))],
                        ["block", "vec_id", "vector", "worst"],
                    )

    routed = best.select("query_id", "vector", "block", "worst").mapInArrow(
        route, "block long, vec_id long, vector array<double>, worst double"
    )
    more = meet(land(routed, "visits"))
    hits = first.select("query_id", "ids", "scores").union(more.select("query_id", "ids", "scores"))
    hits = hits.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    flat = hits.select("query_id", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score"))
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
