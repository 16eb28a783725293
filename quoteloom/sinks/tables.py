"""Catalog tables as sinks.

On the session catalog a replacement writes its rows once, to a new folder beside the table,
the snapshot, and then points the table to it: one statement for a table without partitions,
one for each partition otherwise.  Readers see the old rows or the new ones, of a partition
at a time, and never a part of either.  What was replaced stays until the next sink of that
table starts, so a query that had begun before the switch ends well.

``<table>__pending`` is the snapshot as a table of its own.  Once its rows are complete it says
what is to be done with it, and every sink first does what an earlier run left undone (or drops
what was never complete).  Tables keep their format, types and partitioning; no data is moved.
One writer at a time.  On a pluggable catalog (``iceberg``, ``delta``) the catalog's own atomic
operations are used.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.contract import Contract, quote_name
from quoteloom.errors import ContractError, LoadError
from quoteloom.operators.incremental import dedup_by_key, require_unique, upsert
from quoteloom.operators.projection import require_columns
from quoteloom.shared import Landing, discard, folders, store_lines
from quoteloom.sources.tables import partition_columns, uses_v2_catalog

SESSION_FORMAT = "parquet"
# The partition column of bucketed tables, and the property that says how they are dealt.
BUCKET, DEALT = "bucket", "quoteloom.dealt"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    sql = f"CREATE NAMESPACE IF NOT EXISTS {quote_name(name)}"
    if location:
        sql += " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(sql)


def _format(spark: SparkSession, table: str, fmt: str | None) -> str | None:
    """The format to name: as asked, else Parquet on the session catalog, else the catalog's own."""
    return fmt or (None if uses_v2_catalog(spark, table) else SESSION_FORMAT)


def create_table(
    spark: SparkSession,
    contract: Contract,
    fmt: str | None = None,
    location: str | None = None,
) -> None:
    """Create the contract's table if it is absent."""
    recover(spark, contract.table)
    spark.sql(contract.create_table_sql(_format(spark, contract.table, fmt), location))


def create_bucketed_table(
    spark: SparkSession, contract: Contract, buckets: int, tasks: int, fmt: str | None = None
) -> None:
    """Create the contract's table, if it is absent, such that a merge rewrites only what it touches.

    For tables whose key holds no partition column.  A row's ``bucket``, a hash of its key
    below ``buckets``, is the partition column, so a merge reads and rewrites the buckets
    of its batch only; sinks fill it in.  Within a bucket, rows are clustered by the key into
    ``tasks`` files: as many tasks merge, and the table's side of their join is not shuffled.
    Take many more buckets than a batch has keys, and files of a few hundred megabytes.
    """
    if not contract.keys or contract.partition_by:
        raise ContractError(f"{contract.table}: a bucketed table needs keys and has no other partitions")
    if BUCKET in contract.columns:
        raise ContractError(f"{contract.table}: the column name {BUCKET} is taken")
    recover(spark, contract.table)
    columns = ", ".join(f"{_column(f.name)} {f.data_type.simpleString()}" for f in contract.fields)
    keys = ", ".join(map(_column, contract.keys))
    dealt = json.dumps({"keys": list(contract.keys), "buckets": int(buckets)})
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote_name(contract.table)} ({columns}, {BUCKET} INT)"
        f" USING {fmt or SESSION_FORMAT} PARTITIONED BY ({BUCKET}) CLUSTERED BY ({keys}) INTO {int(tasks)} BUCKETS"
        f" TBLPROPERTIES ('{DEALT}' = {_text(dealt)})"
    )


def _dealt(spark: SparkSession, table: str) -> dict | None:
    """Keys and number of a bucketed table's buckets."""
    if uses_v2_catalog(spark, table):
        return None
    shown = _property(spark, quote_name(table), DEALT)
    return json.loads(shown) if shown else None


def _with_bucket(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the bucket of each row, if ``table`` is bucketed; keys count in the table's types."""
    dealt = _dealt(df.sparkSession, table)
    if not dealt:
        return df
    require_columns(df, dealt["keys"], f"rows for {table}")
    types = {f.name: f.dataType for f in df.sparkSession.table(quote_name(table)).schema.fields}
    keys = [F.col(f"`{k}`").cast(types[k]) for k in dealt["keys"]]
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(dealt["buckets"])).cast("int"))


def _spread_for(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring a partition's rows together before a partitioned write.

    Sizes are measured at run time: small partitions share a task and a hot one is
    split, so files come out near the advisory size.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _in_table_order(df: DataFrame, table: str, drop_extra: bool = False) -> DataFrame:
    """The table's columns, by name and in its types; a value that does not fit is an error."""
    df = _with_bucket(df, table)
    fields = df.sparkSession.table(quote_name(table)).schema.fields
    require_columns(df, [f.name for f in fields], f"rows for {table}")
    extra = [c for c in df.columns if c not in {f.name for f in fields}]
    if extra and not drop_extra:
        raise ContractError(f"{table} has no columns {extra}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


# ---- replacements that can be redone ------------------------------------------------------

TODO, PREVIOUS = "quoteloom.todo", "quoteloom.previous"
SNAPSHOTS = "__snapshots"

# Partitions of one statement.
MOST_PARTITIONS = 500

# Fixed value: how Spark names the folder of a null in a partition column.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _pending(table: str) -> str:
    return quote_name(f"{table}__pending")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _column_list(rows: DataFrame) -> str:
    return ", ".join(f"{_column(f.name)} {f.dataType.simpleString()}" for f in rows.schema)


def _described(spark: SparkSession, table: str, what: str, partition: str = "") -> str | None:
    """A line of a table's or partition's description; the first one that comes."""
    part = f" PARTITION ({partition})" if partition else ""
    lines = spark.sql(f"DESCRIBE EXTENDED {table}{part}").where(F.col("col_name") == what).collect()
    return lines[0]["data_type"] if lines else None


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return shown.get(name)


def _partitions(spark: SparkSession, table: str) -> dict[str, str]:
    """Partitions as statements name them, with the folder each has below its table."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = []
        for part in row[0].split("/"):
            name, value = part.split("=", 1)
            values.append(f"{_column(name)} = {'null' if value == NULL_FOLDER else _text(unquote(value))}")
        found[", ".join(values)] = row[0]
    return found


def _snapshot_root(location: str) -> str:
    above = location.rsplit("/", 1)[0]
    return above if above.endswith(SNAPSHOTS) else location + SNAPSHOTS


def _new_snapshot(spark: SparkSession, table: str) -> str:
    """A folder beside the table's; for a table that does not exist, in its namespace."""
    if spark.catalog.tableExists(quote_name(table)):
        location = _described(spark, quote_name(table), "Location")
    else:
        namespace = table.rsplit(".", 1)[0] if "." in table else spark.catalog.currentDatabase()
        shown = spark.sql(f"DESCRIBE NAMESPACE {quote_name(namespace)}").where("info_name = 'Location'")
        location = f"{shown.first()['info_value'].rstrip('/')}/{table.rsplit('.', 1)[-1].strip('`')}"
    return f"{_snapshot_root(location)}/{uuid.uuid4().hex}"


def _replaced(spark: SparkSession, table: str, snapshot: str, touched_only: bool) -> list[str]:
    """The folders that nothing refers to once ``table`` points to ``snapshot``."""
    if not spark.catalog.tableExists(quote_name(table)):
        return []
    if touched_only:
        old = _partitions(spark, quote_name(table))
        touched = [p for p in _partitions(spark, _pending(table)) if p in old]
        return [_described(spark, quote_name(table), "Location", p) for p in touched]
    location = _described(spark, quote_name(table), "Location")
    beside = folders(spark, snapshot.rsplit("/", 1)[0])
    return [f for f in [location, *beside] if f.rsplit("/", 1)[-1] != snapshot.rsplit("/", 1)[-1]]


def _replace(
    rows: DataFrame,
    table: str,
    shape: str | None = None,
    partition_by: Sequence[str] = (),
    touched_only: bool = False,
    spread: bool = True,
) -> None:
    """Write ``rows`` once, as the pending snapshot, and point ``table`` to it.

    ``shape`` is the format if the table is to be made anew, with the columns of ``rows``.
    """
    spark = rows.sparkSession
    snapshot = _new_snapshot(spark, table)
    if shape:
        by = ", ".join(map(_column, partition_by))
        spark.sql(
            f"CREATE TABLE {_pending(table)} ({_column_list(rows)}) USING {shape}"
            + (f" PARTITIONED BY ({by})" if by else "")
            + f" LOCATION {_text(snapshot)}"
        )
        rows = _in_table_order(rows, f"{table}__pending")
    else:
        spark.sql(f"CREATE TABLE {_pending(table)} LIKE {quote_name(table)} LOCATION {_text(snapshot)}")
    if spread:
        rows = _spread_for(rows, partition_by)
    rows.write.insertInto(_pending(table))
    # a folder whose name starts with _ is not read as data
    previous = f"{snapshot}/_previous/folders"
    replaced = _replaced(spark, table, snapshot, touched_only)
    if replaced:
        store_lines(spark, previous, replaced)
    todo = {
        "snapshot": snapshot,
        "shape": bool(shape),
        "touched_only": touched_only,
        "previous": previous if replaced else None,
    }
    # from here on the snapshot is complete, and what is pending is finished by whoever comes next
    spark.sql(f"ALTER TABLE {_pending(table)} SET TBLPROPERTIES ('{TODO}' = {_text(json.dumps(todo))})")
    _switch(spark, table)


def _point(spark: SparkSession, table: str, location: str, partition: str = "") -> None:
    part = f" PARTITION ({partition})" if partition else ""
    spark.sql(f"ALTER TABLE {table}{part} SET LOCATION {_text(location)}")


def _switch(spark: SparkSession, table: str) -> None:
    """Point ``table`` to its pending snapshot, as often as it takes."""
    pending, name = _pending(table), quote_name(table)
    todo = json.loads(_property(spark, pending, TODO))
    snapshot, exists = todo["snapshot"], spark.catalog.tableExists(name)
    # data goes with the entry of a managed table or partition, so entries that go point nowhere first
    nowhere = f"{snapshot}/_nowhere"
    if todo["shape"]:
        if todo["previous"]:
            spark.sql(f"ALTER TABLE {pending} SET TBLPROPERTIES ('{PREVIOUS}' = {_text(todo['previous'])})")
        if exists:
            _point(spark, name, nowhere)
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {pending} RENAME TO {name}")
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{TODO}')")
        return
    if partition_columns(spark, table):
        new, old = _partitions(spark, pending), _partitions(spark, name)
        added = []
        for partition, folder in new.items():
            place = f"{snapshot}/{folder}"
            if partition in old:
                _point(spark, name, place, partition)
            else:
                added.append(f"PARTITION ({partition}) LOCATION {_text(place)}")
        gone = [] if todo["touched_only"] else sorted(old.keys() - new.keys())
        for partition in gone:
            _point(spark, name, nowhere, partition)
        for at in range(0, len(added), MOST_PARTITIONS):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[at : at + MOST_PARTITIONS])}")
        for at in range(0, len(gone), MOST_PARTITIONS):
            parts = ", ".join(f"PARTITION ({p})" for p in gone[at : at + MOST_PARTITIONS])
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
    if not todo["touched_only"]:
        _point(spark, name, snapshot)
    spark.catalog.refreshTable(name)
    if todo["previous"]:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = {_text(todo['previous'])})")
    spark.sql(f"DROP TABLE {pending}")


def recover(spark: SparkSession, table: str) -> None:
    """Finish a replacement of ``table`` that is pending, and remove what an earlier one replaced."""
    if uses_v2_catalog(spark, table):
        return
    pending, name = _pending(table), quote_name(table)
    if spark.catalog.tableExists(pending):
        if _property(spark, pending, TODO):
            _switch(spark, table)
        else:
            unfinished = _described(spark, pending, "Location")
            spark.sql(f"DROP TABLE {pending}")
            discard(spark, unfinished)
    if spark.catalog.tableExists(name) and (previous := _property(spark, name, PREVIOUS)):
        for row in spark.read.text(previous).collect():
            discard(spark, row[0])
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{PREVIOUS}')")


def write_overwrite(
    df: DataFrame,
    table: str,
    fmt: str | None = None,
    partition_by: Sequence[str] | None = None,
    drop_extra: bool = False,
) -> None:
    """Replace all rows of a table; it keeps its format, types and partitioning.

    ``fmt`` and ``partition_by`` are for a table that does not exist yet.
    """
    spark = df.sparkSession
    recover(spark, table)
    if not spark.catalog.tableExists(quote_name(table)):
        write_replace(df, table, fmt, partition_by or ())
        return
    columns = partition_columns(spark, table)
    if partition_by is not None and list(partition_by) != columns:
        raise LoadError(f"{table} is partitioned by {columns}; use write_replace to change that")
    rows = _in_table_order(df, table, drop_extra)
    if uses_v2_catalog(spark, table):
        _spread_for(rows, columns).writeTo(quote_name(table)).overwrite(F.lit(True))
        return
    _replace(rows, table, partition_by=columns)


def write_replace(
    df: DataFrame,
    table: str,
    fmt: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Create or replace a table, its shape, format and partitioning included.

    On the session catalog the new table takes the place of the old one by name; between two
    statements there is none.  It is an external table then: dropping it leaves its files.
    """
    spark = df.sparkSession
    columns = list(partition_by)
    if not uses_v2_catalog(spark, table):
        recover(spark, table)
        _replace(df, table, fmt or SESSION_FORMAT, columns)
        return
    writer = _spread_for(df, columns).writeTo(quote_name(table))
    if fmt:
        writer = writer.using(fmt)
    if columns:
        writer = writer.partitionedBy(*[F.col(c) for c in columns])
    writer.createOrReplace()


def write_append(df: DataFrame, table: str, drop_extra: bool = False) -> None:
    """Append by column name to an existing table."""
    spark = df.sparkSession
    recover(spark, table)
    rows = _spread_for(_in_table_order(df, table, drop_extra), partition_columns(spark, table))
    if uses_v2_catalog(spark, table):
        rows.writeTo(quote_name(table)).append()
    else:
        rows.write.insertInto(quote_name(table))


def write_partitions(df: DataFrame, table: str, drop_extra: bool = False) -> None:
    """Replace the partitions that occur in ``df``; all others stay."""
    spark = df.sparkSession
    recover(spark, table)
    columns = partition_columns(spark, table)
    rows = _in_table_order(df, table, drop_extra)
    if uses_v2_catalog(spark, table):
        _spread_for(rows, columns).writeTo(quote_name(table)).overwritePartitions()
        return
    if not columns:
        raise LoadError(f"{table} is not partitioned; use write_overwrite")
    _replace(rows, table, partition_by=columns, touched_only=True)


def merge_into(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    landed: bool = False,
    keep_first_by: Sequence[Column | str] | None = None,
) -> None:
    """Merge ``source`` into ``table``: equal keys replaced, others added, none deleted.

    Merging the same batch again changes nothing.  When the partition columns are
    part of the key, or the table is bucketed by it, only the partitions that the batch
    touches are read and rewritten; the cost then follows the batch and not the table.

    ``source`` is read several times, so it is landed in the shared folder first.
    ``landed=True`` says that it already is a scan of a table or of files.  A key that
    occurs twice is an error, unless ``keep_first_by`` gives the order that decides.
    """
    spark = source.sparkSession
    recover(spark, table)
    area = Landing(spark)
    if keep_first_by is not None:
        source = dedup_by_key(source, keys, keep_first_by)
    if keep_first_by is not None or not landed:
        source = area.land(source, "batch")
    require_unique(source, keys)
    if uses_v2_catalog(spark, table):
        rows = _in_table_order(source, table).alias("source")
        same = " AND ".join(f"source.`{k}` = {quote_name(table)}.`{k}`" for k in keys)
        rows.mergeInto(quote_name(table), F.expr(same)).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    else:
        target = spark.table(quote_name(table))
        columns = partition_columns(spark, table)
        source = _in_table_order(source, table)
        dealt = _dealt(spark, table)
        if dealt and set(dealt["keys"]) == set(keys):
            merged = merged_buckets(target, source, keys)
            _replace(merged, table, partition_by=columns, touched_only=True, spread=False)
        elif not columns or not set(columns) <= set(keys):
            write_overwrite(upsert(target, source, keys), table)
        else:
            write_partitions(upsert(touched_partitions(target, source, columns), source, keys), table)
    area.clear()


def merged_buckets(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The buckets that ``source`` has rows for, after the merge.

    Both sides have the columns of the table.  The target is clustered by ``keys``, so only
    ``source`` is shuffled for the join, and each task writes its own file of a bucket.
    """
    # at most as many numbers as the table has buckets
    touched = [r[0] for r in source.select(BUCKET).distinct().collect()]
    old = target.where(F.col(BUCKET).isin(touched))
    new = source.withColumn("_new", F.lit(True))
    both = old.alias("old").join(new.alias("new"), [F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys], "full_outer")
    return both.select(
        *[F.when(F.col("_new"), F.col(f"new.`{c}`")).otherwise(F.col(f"old.`{c}`")).alias(c) for c in target.columns]
    )


def touched_partitions(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``target`` in partitions that ``source`` has rows for, null partitions included.

    The range of each partition column in ``source``, one row, bounds both sides; within it a
    semi join with plain equality lets Spark prune ``target`` at run time.  Partitions with a
    null have a branch of their own, and only if ``source`` has such rows.
    """
    some_null = F.lit(False)
    for c in columns:
        some_null = some_null | F.col(f"`{c}`").isNull()
    marks = [F.max(some_null)]
    for c in columns:
        marks += [F.min(F.when(~some_null, F.col(f"`{c}`"))), F.max(F.when(~some_null, F.col(f"`{c}`")))]
    nulls, *ranges = source.agg(*marks).first()
    lows, highs = ranges[::2], ranges[1::2]

    touched = source.select(*[F.col(f"`{c}`").alias(f"_{c}") for c in columns]).distinct()
    parts = []
    if all(v is not None for v in ranges):
        same = F.lit(True)
        inside, wanted = target, touched
        for c, low, high in zip(columns, lows, highs):
            inside = inside.where(F.col(f"`{c}`").between(F.lit(low), F.lit(high)))
            wanted = wanted.where(F.col(f"`_{c}`").between(F.lit(low), F.lit(high)))
            same = same & (F.col(f"`{c}`") == F.col(f"`_{c}`"))
        parts.append(inside.join(wanted, same, "left_semi"))
    if nulls:
        same = F.lit(True)
        for c in columns:
            same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_{c}`"))
        parts.append(target.where(some_null).join(touched, same, "left_semi"))
    if not parts:
        return target.where(F.lit(False))
    return parts[0].union(parts[1]) if len(parts) == 2 else parts[0]
