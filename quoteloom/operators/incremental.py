"""Incremental loading: what to load next, and how to merge it.

The rules for start dates and merging are this library's own reading of an
incremental load: next day after the last loaded one, and source row replaces
target row on equal keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.errors import LoadError
from quoteloom.functions import resolve_run_date
from quoteloom.operators.projection import require_columns


def high_water_mark(loaded: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Last loaded date of each key.  Pre-aggregates before its shuffle."""
    return loaded.groupBy(key).agg(F.max(date).alias("last_date"))


def advance_marks(
    marks: DataFrame, batch: DataFrame, key: str = "symbol", date: str = "date"
) -> DataFrame:
    """High-water marks after ``batch``, without reading the loaded table again.

    Kept in a table of their own, marks let the cost of the next work list follow
    the number of keys and not the length of the history.
    """
    both = marks.select(key, "last_date").unionByName(high_water_mark(batch, key, date))
    return both.groupBy(key).agg(F.max("last_date").alias("last_date"))


def build_worklist(
    keys: DataFrame,
    marks: DataFrame,
    default_start: dt.date | str,
    key: str = "symbol",
) -> DataFrame:
    """Every key with the first date still to load.

    The day after the last loaded one, or ``default_start`` for a new key.
    """
    first = F.lit(resolve_run_date(default_start))
    return keys.join(marks, key, "left").select(
        key, F.coalesce(F.date_add("last_date", 1), first).alias("start_date")
    )


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = ()
) -> DataFrame:
    """One row for each key: the first under ``order_by``.

    All remaining columns follow as tie-breaks, so the result does not depend on
    row order.  Spark keeps one row per key and task before the shuffle, so a key
    with very many rows does not end up in one task.
    """
    require_columns(df, list(keys))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order_by, *rest) if rest or order_by else None
    if ranked is None:
        return df.dropDuplicates(list(keys))
    return (
        df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` after the merge of ``source``: equal keys replaced, others added, none deleted.

    ``source`` must hold each key once.  Only the key columns of ``source`` enter
    the join, so a daily batch is usually small enough for Spark to broadcast and
    the target is then filtered in place; beyond that size both sides are shuffled
    on the keys.  Hand in a landed source: Spark then knows its size, and can split
    a hot key of the target across tasks.  Null keys are equal to nothing.
    """
    require_columns(target, list(keys), "merge target")
    require_columns(source, target.columns, "merge source")
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "merge source") -> None:
    """Raise if a key occurs twice.  Runs one counting job and fetches one row."""
    twice = df.groupBy(*keys).count().where("count > 1").first()
    if twice is not None:
        raise LoadError(f"{what} has key {twice.asDict()} more than once")
