"""Audits: duplicates, missing values, counts, and flattening of nested records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.contract import Contract


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Value combinations that occur more than once, with how often."""
    wanted = list(columns) if columns is not None else df.columns
    return df.groupBy(*wanted).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each column: all rows and missing ones.  A single pass for all columns."""
    wanted = list(columns) if columns is not None else df.columns
    counted = df.agg(
        F.count("*").alias("_all"), *[F.count(f"`{c}`").alias(f"_{i}") for i, c in enumerate(wanted)]
    )
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_all").alias("n_rows"),
            (F.col("_all") - F.col(f"_{i}")).alias("n_null"),
        )
        for i, c in enumerate(wanted)
    ]
    return counted.select(F.inline(F.array(*per_column)))


def incomplete_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that lack at least one required value."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(f"`{c}`").isNull()
    return df.where(missing)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def reconcile(received: DataFrame, written: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of one load in one row, and whether they add up."""
    counts = None
    for name, df in (("rows_in", received), ("rows_written", written), ("rows_rejected", rejected)):
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
        counts = part if counts is None else counts.unionByName(part)
    pick = [
        F.sum(F.when(F.col("what") == name, F.col("n"))).alias(name)
        for name in ("rows_in", "rows_written", "rows_rejected")
    ]
    return counts.agg(*pick).withColumn(
        "balanced", F.col("rows_in") == F.col("rows_written") + F.col("rows_rejected")
    )


def typed_empty(spark: SparkSession, contract: Contract) -> DataFrame:
    """No rows, but the contract's columns and types."""
    return spark.createDataFrame([], contract.struct_type)


def flatten_records(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Unnest a list of lists of records: one output row, with its fields, per record."""
    return df.select(*keep, F.inline(F.flatten(column)))
