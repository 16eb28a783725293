"""Catalog tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quoteloom.contract import quote_name


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(quote_name(table))


def sql_scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {quote_name(table)}")


def sql_count(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS n_rows FROM {quote_name(table)}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(quote_name(table)) if c.isPartition]


def uses_v2_catalog(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` lives in a pluggable catalog (one with its own table format and MERGE)."""
    first = table.split(".")[0].strip("`")
    if "." in table and spark.conf.get(f"spark.sql.catalog.{first}", None):
        return True
    current = spark.catalog.currentCatalog()
    return spark.conf.get(f"spark.sql.catalog.{current}", None) is not None
