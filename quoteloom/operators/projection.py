"""Projection, renaming, lineage and ordered limits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.errors import ContractError
from quoteloom.functions import batch_stamp


def _named(name: str):
    return F.col(f"`{name}`")


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"{what} lacks required columns {missing}; it has {df.columns}")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns`` in that order; extra columns go, a missing one is an error."""
    require_columns(df, columns)
    return df.select(*[_named(c) for c in columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    require_columns(df, list(names))
    return df.withColumnsRenamed(dict(names))


def add_lineage(
    df: DataFrame,
    stamp: dt.datetime | str | None = None,
    column: str = "import_time",
    **constants: object,
) -> DataFrame:
    """Add the batch stamp, and any further constants, to every row."""
    added = {column: batch_stamp(stamp)}
    added.update({name: F.lit(value) for name, value in constants.items()})
    return df.withColumns(added)


def cast_to_string(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    wanted = list(columns) if columns is not None else df.columns
    require_columns(df, wanted)
    return df.withColumns({c: _named(c).cast("string") for c in wanted})


def limit_ordered(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows under ``order_by``, with all other columns as tie-break.

    Spark runs this as a top-n per task plus a merge of those, not as a full sort.
    """
    rest = [c for c in df.columns if c not in order_by]
    return df.orderBy(*[_named(c) for c in [*order_by, *rest]]).limit(n)
