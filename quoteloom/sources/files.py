"""File and text sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_with_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose first line holds the names.  The header is checked against ``schema``."""
    return spark.read.csv(
        path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST", multiLine=False
    )


def csv_with_names(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """CSV without header: names are given, types are inferred by an extra pass over the files."""
    return spark.read.csv(path, header=False, inferSchema=True).toDF(*names)


def json_records(
    df: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Parse a text column of JSON records by a declared schema.

    A key that a record lacks, and text that is no record, become null.
    """
    return df.select(*keep, F.from_json(column, schema).alias("_record")).select(
        *keep, "_record.*"
    )
