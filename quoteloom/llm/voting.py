"""Quality by the votes of nearest labelled texts.

A text becomes counts of its word shapes: letters, digits and marks by kind, runs drawn
together, alone and in pairs, and how often a word repeats the one before it.  Weighted by
rarity and projected on the leading directions of a labelled sample (latent semantic analysis),
it is a short vector.  The vectors and labels of the sample are broadcast, and every document's
cosines with all of them are computed, in blocks.  The ``neighbours`` nearest vote, each with its
cosine to the power of ``sharpness`` as weight: the score is the weighted share of label 1.

Labels come from a bounded sample: about ``rows`` labelled documents that are not held out,
picked by a hash of the id.  The model has at most ``rows`` vectors of ``dimensions`` numbers
and ``features`` directions, whatever the size of the input; shapes are counted in tasks.
Scoring reads every whole text in place, without a shuffle.

Nulls: a null text scores like an empty one; rows without label or id teach nothing; a null id
is not held out.  A text without words, or like no neighbour at all, scores the sample's share of
label 1, and one half if no label is usable.  Ties: all neighbours as near as the last one vote.
Repeated rows are rows.  Columns beside the named ones do not take part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.llm.common import pieces, worker_state

RUN = re.compile(r"(.)\1+")
LONGEST_SHAPE = 12
# Documents of a block, labelled vectors of a block: a product holds at most this many cosines.
DOCUMENTS, VECTORS = 256, 4096
# Shapes of words that a worker process keeps; more are worked out anew.
KEPT_SHAPES = 200_000


def held_out(id: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def shape(word: str) -> str:
    kinds = ["X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word]
    return RUN.sub(r"\1", "".join(kinds))[:LONGEST_SHAPE]


def counts(text: str | None) -> Counter:
    """How often a text has each shape, each pair of neighbours on a line, and a repeated word."""
    known = worker_state("word_shapes", dict)
    found: Counter = Counter()
    for line in (text or "").split("\n"):
        before, last = "^", None
        for word in line.split():
            s = known.get(word)
            if s is None:
                s = shape(word)
                if len(known) < KEPT_SHAPES:
                    known[word] = s
            found[s] += 1
            found[before, s] += 1
            if word == last:
                found["="] += 1
            before, last = s, word
        if last is not None:
            found[before, "$"] += 1
    return Counter({f if isinstance(f, str) else " ".join(f): n for f, n in found.items()})


@dataclass(frozen=True)
class Model:
    places: dict[str, int]
    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float
    neighbours: int
    sharpness: int

    def vector(self, weights: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit vectors (or zero) of texts, given as places and weights of their features."""
        found = np.zeros((len(weights), self.directions.shape[1]))
        for i, (places, values) in enumerate(weights):
            found[i] = values @ self.directions[places]
        return unit(found)

    def score(self, texts: list[str | None]) -> np.ndarray:
        scores = np.full(len(texts), self.share)
        if not len(self.vectors):
            return scores
        for at in range(0, len(texts), DOCUMENTS):
            some = texts[at : at + DOCUMENTS]
            block = np.zeros((DOCUMENTS, self.vectors.shape[1]))
            block[: len(some)] = self.vector([weighted(t, self.places, self.rarity) for t in some])
            cosines = np.concatenate(
                [block @ self.vectors[v : v + VECTORS].T for v in range(0, len(self.vectors), VECTORS)], axis=1
            )[: len(some)]
            # the last bits differ with the order of a sum: equal texts shall tie
            cosines = np.maximum(cosines.round(9), 0)
            k = min(self.neighbours, cosines.shape[1])
            nearest = np.partition(cosines, -k, axis=1)[:, -k]
            votes = np.where(cosines >= nearest[:, None], cosines, 0) ** self.sharpness
            total = votes.sum(axis=1)
            voted = np.divide(votes @ self.labels, total, out=np.full(len(some), self.share), where=total > 0)
            scores[at : at + len(some)] = voted.clip(0, 1)
        return scores


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-9)


def weighted(text: str | None, places: dict[str, int], rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of a text's features: rarity times one and the logarithm of the count."""
    found = [(places[f], n) for f, n in counts(text).items() if f in places]
    at = np.array([p for p, _ in sorted(found)], np.int64)
    n = np.array([n for _, n in sorted(found)], np.float64)
    return at, (1 + np.log(n)) * rarity[at]


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, id: str, text: str, label: str) -> DataFrame:
    """(id, text, label) of about ``rows`` labelled documents that are not held out."""
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    share = int(min(1.0, rows / max(1, known.count())) * 2**31)
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(2**31)) < share)
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # the sample has a bounded size, so the texts need not move
    return texts.join(F.broadcast(known), "id").select("id", "text", "label")


def document_counts(sample: DataFrame) -> DataFrame:
    """(feature, n): in how many texts a feature is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(seen):
            columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["feature", "n"])

        seen: Counter = Counter()
        for piece in pieces(batches, "text"):
            for text in piece.column("text").to_pylist():
                seen.update(counts(text).keys())
                if len(seen) > 500_000:
                    yield rows(seen)
                    seen = Counter()
        yield rows(seen)

    counted = sample.mapInArrow(count, "feature string, n bigint")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = 4_000,
    features: int = 1_024,
    dimensions: int = 48,
    neighbours: int = 15,
    sharpness: int = 4,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Learn from the labelled documents outside the held-out fourth."""
    sample = training_rows(docs, labels, rows, id, text, label)
    n = sample.count()
    top = document_counts(sample).orderBy(F.desc("n"), "feature").limit(features).collect()
    places = {r["feature"]: i for i, r in enumerate(top)}
    rarity = np.array([np.log((1 + n) / (1 + r["n"])) + 1 for r in top])

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = [weighted(t, places, rarity) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("label"),
                    pa.array([p for p, _ in found], pa.list_(pa.int64())),
                    pa.array([w for _, w in found], pa.list_(pa.float64())),
                ],
                ["label", "places", "weights"],
            )

    got = sample.mapInArrow(to_rows, "label int, places array<bigint>, weights array<double>").toArrow()
    x = np.zeros((got.num_rows, len(places)))
    for row, at, weights in zip(x, got.column("places").to_pylist(), got.column("weights").to_pylist()):
        row[at] = weights
    x = unit(x)
    y = got.column("label").to_numpy().astype(np.float64)
    # leading directions of the sample: eigenvectors of a matrix of features x features
    _, vectors = np.linalg.eigh(x.T @ x)
    directions = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions])
    share = float(y.mean()) if len(y) else 0.5
    return Model(places, rarity, directions, unit(x @ directions), y, share, neighbours, sharpness)


def score(docs: DataFrame, model: Model, *, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text; all columns pass through."""
    if column in docs.columns:
        raise ValueError(f"the input already has a column {column!r}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            scores = shared.value.score(piece.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(scores, pa.float64())], [*piece.schema.names, column]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
