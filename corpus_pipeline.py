"""The corpus pipeline: documents in, clean token ids out, one corpus operator a stage.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.  All stages but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.llm import bpe, decontaminate, pii, simhash, toxicity
from quoteloom.llm.common import table
from quoteloom.shared import Landing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; all of them if no label is usable."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if not model.weights:
        # the model knows nothing and scores every text one half
        return docs.select(*COLUMNS)
    return toxicity.score(docs, model, column="_score").where("_score < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that with the least id."""
    return simhash.deduplicate(docs.select(*COLUMNS), shingle=4, max_bits=4)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that they share with the benchmark."""
    found = decontaminate.find_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), window=10)
    return _documents(decontaminate.remove_spans(found))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    return _documents(pii.mask_pii(pii.find_pii(docs.select(*COLUMNS), spans="_pii"), spans="_pii"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text back."""
    vocabulary = str(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = bpe.encode(docs.select(*COLUMNS), vocabulary)
    decoded = bpe.decode(encoded, vocabulary)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("exact")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("benchmark", cut_benchmark),
    ("personal_data", mask_personal_data),
    ("tokens", to_tokens),
]

# Learned scores and message passing have no SQL; the test holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what an earlier one landed is removed once the next has read it."""
    docs, older = table(spark, sf_dir, "documents"), Landing(spark)
    for name, stage in STAGES:
        landing = Landing(spark)
        docs = landing.land(stage(spark, docs, sf_dir), f"stage-{name}")
        older.clear()
        older = landing
    return docs
