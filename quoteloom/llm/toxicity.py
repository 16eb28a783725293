"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over the words that a text holds, and over their first letters.  In training, every labelled text
that names a group is also read with the group's name swapped for others of its kind, and
the change that this makes to the score is penalised.  So a name cannot carry weight of
its own, and neutral mentions of a group are not taken for abuse.

Labels come from a bounded sample: about ``rows`` labelled documents, picked by a hash of
the id.  Word counts and training rows are made in tasks; the driver gets ``words`` word
statistics and the sample's rows over those words, then solves for the weights.  Scoring
reads every whole text in place, without a shuffle.

Very long texts count to their end, once for each different word.  Without a usable label every
score is one half.  Words that tell equally much are taken in the order of the alphabet.  An
empty table scores no rows.  Nulls: a null text scores like an empty one; rows without label or id teach nothing; a null
id is not held out.  Repeated rows are rows.  Columns beside the named ones do not take part.
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

from quoteloom.llm.common import pieces

WORD = re.compile(r"\w+")
STEM = 4

# Names of groups, by kind and language.  Those of a row stand in for each other.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["black", "white", "asian", "latino", "african", "european", "arab", "indigenous"],
    ["immigrants", "refugees", "foreigners", "natives", "migrants"],
    ["deaf", "blind", "disabled", "autistic"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["muslime", "christen", "juden", "hindus"],
    ["femmes", "hommes", "filles", "garçons"],
    ["musulmans", "chrétiens", "juifs", "hindous"],
    ["mujeres", "hombres", "niñas", "niños"],
    ["musulmanes", "cristianos", "judíos", "hindúes"],
]


NAMES = frozenset(t for row in IDENTITY_TERMS for t in row)


def features(text: str | None) -> set[str]:
    """A text's words in lower case, and the first letters of longer ones with a star.

    A group's name has no feature but itself, so that a swap changes all that it stands for.
    """
    words = set(WORD.findall((text or "").lower()))
    return words | {w[:STEM] + "*" for w in words - NAMES if len(w) > STEM}


def identity_swaps() -> dict[str, list[str]]:
    """Each term's possible stand-ins."""
    swaps: dict[str, list[str]] = {}
    for row in IDENTITY_TERMS:
        for term in row:
            swaps.setdefault(term, []).extend(t for t in row if t != term)
    return swaps


def held_out(id: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        words = features(text)
        total = self.bias + sum(self.weights[w] for w in self.weights.keys() & words)
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def training_rows(
    docs: DataFrame, labels: DataFrame, rows: int, id: str, text: str, label: str
) -> DataFrame:
    """(text, label) of about ``rows`` labelled documents that are not held out."""
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    share = int(min(1.0, rows / max(1, known.count())) * 2**31)
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(2**31)) < share)
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # the sample has a bounded size, so the texts need not move
    return texts.join(F.broadcast(known), "id").select("text", "label")


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, n, hits): in how many texts a word is, and in how many of label 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, hits = Counter(), Counter()
        for piece in pieces(batches, "text"):
            for text, label in zip(piece.column("text").to_pylist(), piece.column("label").to_pylist()):
                words = features(text)
                seen.update(words)
                if label:
                    hits.update(words)
            if len(seen) > 500_000:
                yield rows(seen, hits)
                seen, hits = Counter(), Counter()
        yield rows(seen, hits)

    def rows(seen, hits):
        columns = [list(seen), list(seen.values()), [hits[w] for w in seen]]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n", "hits"]
        )

    counted = sample.mapInArrow(count, "word string, n bigint, hits bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def solve(
    rows: list[np.ndarray], y: np.ndarray, swaps: list[np.ndarray], size: int, fairness: float, ridge: float
) -> tuple[np.ndarray, float]:
    """Newton's method for weights and bias.  ``swaps`` are changes of a row under a swap."""
    x = np.zeros((len(rows), size + 1), np.float32)
    x[:, size] = 1
    for i, words in enumerate(rows):
        x[i, words] = 1
    penalty = np.eye(size + 1) * ridge
    penalty[size, size] = 1e-6
    if swaps:
        change = np.zeros((len(swaps), size + 1))
        for i, (gone, come) in enumerate(swaps):
            change[i, gone] -= 1
            change[i, come] += 1
        penalty += fairness * change.T @ change / len(swaps)
    w = np.zeros(size + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + penalty @ w
        bend = (x * (p * (1 - p) / len(y))[:, None].astype(np.float32)).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:size], float(w[size])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = 20_000,
    words: int = 768,
    fairness: float = 1.0,
    ridge: float = 3e-5,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Learn from the labelled documents outside the held-out fifth."""
    sample = training_rows(docs, labels, rows, id, text, label)
    n, hits = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n:
        return Model({}, 0.0)
    swaps = identity_swaps()
    gap = F.col("hits") - F.col("n") * F.lit(hits / n)
    counted = word_counts(sample).where("n >= 3")
    top = counted.orderBy(F.desc(gap * gap / F.col("n")), "word").limit(words).collect()
    vocabulary = sorted({r["word"] for r in top} | set(swaps))
    place = {w: i for i, w in enumerate(vocabulary)}

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = [
                [place[w] for w in place.keys() & features(t)]
                for t in piece.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("label"), pa.array(found, pa.list_(pa.int32()))], ["label", "words"]
            )

    table = sample.mapInArrow(to_rows, "label int, words array<int>").toArrow()
    found = [np.array(r, np.int64) for r in table.column("words").to_pylist()]
    changes = []
    for row in found:
        here = set(row.tolist())
        for i in here:
            others = [place[t] for t in swaps.get(vocabulary[i], ())]
            changes += [(i, j) for j in others if j not in here]
    y = table.column("label").to_numpy().astype(np.float64)
    weights, bias = solve(found, y, changes, len(vocabulary), fairness, ridge)
    return Model(dict(zip(vocabulary, weights.tolist())), bias)


def score(
    docs: DataFrame, model: Model, *, text: str = "text", column: str = "score"
) -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text; all columns pass through."""
    if column in docs.columns:
        raise ValueError(f"the input already has a column {column!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            scores = [model.score(t) for t in piece.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(scores, pa.float64())], [*piece.schema.names, column]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
