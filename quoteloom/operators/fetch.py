"""Ranged fetch: work items in, rows out, through a pluggable provider.

A provider is ``provider(key, start, end)`` and returns a pandas frame or an Arrow
table with the rows of one key for ``start <= date < end`` (``end`` may be None: no
end).  It runs inside tasks, must be safe to repeat, and Spark decides which task
makes which call.  ``range_filter`` is the set form for data already in a table.
"""

from __future__ import annotations

import datetime as dt
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.errors import ContractError
from quoteloom.functions import resolve_run_date
from quoteloom.operators.projection import require_columns
from quoteloom.operators.ranges import join_ranges

Provider = Callable[[str, dt.date, dt.date | None], "pd.DataFrame | pa.Table"]

ERROR = "error"
# Columns of a recorded fetch: filled in the one row that closes each call, null in fetched rows.
CALL_START, CALL_END, CALL_ROWS = "call_start", "call_end", "call_rows"


def distribute(
    worklist: DataFrame, max_parallel: int | None = None, cost: Column | None = None
) -> DataFrame:
    """Spread work items over tasks.

    The task count is fixed on purpose: size-based coalescing would put a small
    work list, however slow its calls, into one task.  ``max_parallel`` bounds the
    calls in flight; by default there are four tasks for each core.

    With ``cost``, what an item's call is expected to take, items are dealt in the order of their
    cost, back and forth over the tasks, so that all get as much to do; each begins
    with its longest call, and no long one is left for the end.
    """
    cores = worklist.sparkSession.sparkContext.defaultParallelism
    tasks = max_parallel or 4 * cores
    if cost is None:
        return worklist.repartition(tasks, *worklist.columns)
    by_cost = F.desc("_cost")
    ordered = worklist.withColumn("_cost", cost).repartitionByRange(by_cost).sortWithinPartitions(by_cost)
    # within a range of costs the number of a row goes over the tasks, forth and back
    turn = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + F.spark_partition_id()
    at = F.pmod(turn, F.lit(2 * tasks))
    dealt = ordered.withColumn("_task", F.when(at < tasks, at).otherwise(2 * tasks - 1 - at).cast("int"))
    return dealt.repartitionById(tasks, F.col("_task")).sortWithinPartitions(by_cost).drop("_cost", "_task")


def days_to_fetch(run_date: dt.date | str | None = None, lo: str = "lo", hi: str = "hi") -> Column:
    """The cost of an item by the days it asks for; one without an end is counted up to the run date."""
    now = F.lit(resolve_run_date(run_date))
    return F.coalesce(F.greatest(F.datediff(F.coalesce(F.col(hi), now), F.col(lo)), F.lit(0)), F.lit(0))


def split_ranges(
    worklist: DataFrame,
    max_days: int,
    run_date: dt.date | str | None = None,
    start: str = "start_date",
    end: str = "end_date",
    open_ended: bool = False,
) -> DataFrame:
    """Cut each item's range into pieces of at most ``max_days``.

    A key with a long history then becomes many calls in many tasks.  The pieces
    cover the range exactly; items with nothing to fetch disappear.  An item without an
    end (all of them, if ``open_ended``) is cut up to the run date and has one last piece
    from there on that has no end either.  An item without a start is handed on as it is,
    for the fetch to refuse.
    """
    now = F.lit(resolve_run_date(run_date))
    if open_ended:
        stop = F.lit(None).cast("date")
    else:
        stop = F.col(end).cast("date") if end in worklist.columns else now
    others = [c for c in worklist.columns if c not in (start, end)]
    days = F.lit(int(max_days))
    step = F.make_interval(days=days)
    first, last = F.col("_first"), F.col("_last")
    cut = F.coalesce(last, F.greatest(now, first))
    pieces = F.when(
        first < cut,
        F.transform(
            F.sequence(first, F.date_sub(cut, 1), step),
            lambda d: F.struct(d.alias("lo"), F.least(F.date_add(d, days), cut).alias("hi")),
        ),
    ).otherwise(F.expr("CAST(array() AS array<struct<lo:date,hi:date>>)"))
    no_end = F.lit(None).cast("date").alias("hi")
    pieces = (
        F.when(first.isNull(), F.array(F.struct(first.alias("lo"), last.alias("hi"))))
        .when(last.isNull(), F.concat(pieces, F.array(F.struct(cut.alias("lo"), no_end))))
        .otherwise(pieces)
    )
    return (
        worklist.withColumn("_first", F.col(start).cast("date"))
        .withColumn("_last", stop)
        .withColumn("_piece", F.explode(pieces))
        .select(*others, F.col("_piece.lo").alias(start), F.col("_piece.hi").alias(end))
    )


def period_worklist(keys: DataFrame, months: int, end: dt.date | str | None = None) -> DataFrame:
    """A work list that reaches ``months`` back from ``end`` for every key."""
    last = F.lit(resolve_run_date(end))
    return keys.select("*", F.add_months(last, -months).alias("start_date"), last.alias("end_date"))


# How the column types of a fetch travel between Python and Spark.
ARROW_TYPES = {
    T.DateType: pa.date32(),
    T.DoubleType: pa.float64(),
    T.FloatType: pa.float32(),
    T.IntegerType: pa.int32(),
    T.LongType: pa.int64(),
    T.StringType: pa.string(),
    T.TimestampType: pa.timestamp("us", "UTC"),
}


def arrow_schema(schema: T.StructType) -> pa.Schema:
    unknown = [f.name for f in schema.fields if type(f.dataType) not in ARROW_TYPES]
    if unknown:
        raise ContractError(f"a fetch has no type for columns {unknown}")
    return pa.schema([pa.field(f.name, ARROW_TYPES[type(f.dataType)]) for f in schema.fields])


def caller(provider: Provider, schema: T.StructType, key: str, date: str | None = None):
    """Wrap a provider so that a call gives an Arrow table of ``schema``, key included.

    Rows that lack a column or hold a value of another type fail their own call and
    no other.  The function it returns needs nothing of this library where it runs.
    """
    values = arrow_schema(T.StructType([f for f in schema.fields if f.name != key]))
    key_type = arrow_schema(schema).field(key).type
    columns = schema.fieldNames()

    def from_pandas(rows: pd.DataFrame) -> pa.Table:
        if not set(values.names) <= set(rows.columns):
            rows = rows.reset_index()
        rows = rows[values.names]
        for field in values:
            # a zoned time stands for its date in that zone, not in UTC
            if pa.types.is_date(field.type) and isinstance(
                rows[field.name].dtype, pd.DatetimeTZDtype
            ):
                rows = rows.assign(**{field.name: rows[field.name].dt.date})
        return pa.Table.from_pandas(rows, schema=values, preserve_index=False)

    def call(item, lo, until) -> pa.Table:
        rows = provider(item, lo, until)
        if isinstance(rows, pa.Table):
            rows = rows.select(values.names).cast(values)
        else:
            rows = from_pandas(rows)
        if date is not None:
            asked = pc.greater_equal(rows[date], lo)
            if until is not None:
                asked = pc.and_(asked, pc.less(rows[date], until))
            rows = rows.filter(asked)
        keys = pa.repeat(pa.scalar(item, key_type), rows.num_rows)
        return rows.append_column(key, keys).select(columns)

    return call


def packer(full: int = 10_000):
    """Let the results of small calls travel together.

    ``pack(tables)`` yields batches of at least ``full`` rows, except for the last, so
    memory stays bounded by one call plus one full batch.
    """

    def pack(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        held, n_rows = [], 0
        for table in tables:
            if table.num_rows:
                held.append(table)
                n_rows += table.num_rows
            if n_rows >= full:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, n_rows = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return pack


def runner(
    provider: Provider,
    good: T.StructType,
    key: str,
    date: str | None = None,
    on_error: str = "fail",
    pause: tuple[float, float] | None = None,
    pace: tuple[int, float] | None = None,
):
    """(schema, run): ``run`` turns batches of (item, lo, hi) into batches of fetched rows.

    It needs nothing of this library where it runs.  ``pace`` is (tasks, calls a second): each of
    so many tasks makes its share of the calls, and they begin one after another.
    """
    if on_error not in ("fail", "drop", "route", "record"):
        raise ValueError(f"on_error must be fail, drop, route or record, not {on_error!r}")
    recorded = on_error == "record"
    routed = on_error == "route" or recorded
    out = T.StructType([*good.fields, T.StructField(ERROR, T.StringType())]) if routed else good
    if recorded:
        dates = [T.StructField(c, T.DateType()) for c in (CALL_START, CALL_END)]
        out = T.StructType([*out.fields, *dates, T.StructField(CALL_ROWS, T.LongType())])
    call = caller(provider, good, key, date)
    arrow = arrow_schema(out)
    pack = packer()
    error, names = ERROR, (CALL_START, CALL_END, CALL_ROWS)

    def closing(item, lo, hi, n, message=None):
        record = {key: item, error: message}
        if recorded:
            record |= dict(zip(names, (lo, hi, n)))
        return pa.Table.from_pylist([record], schema=arrow)

    def call_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        due = 0.0
        if pace:
            due = time.monotonic() + TaskContext.get().partitionId() % pace[0] / pace[1]
        for batch in batches:
            for item, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("item", "lo", "hi"))):
                if pace:
                    time.sleep(max(0.0, due - time.monotonic()))
                    due = max(due, time.monotonic()) + pace[0] / pace[1]
                try:
                    if lo is None:
                        raise ValueError("no start date")
                    rows = call(item, lo, hi)
                    for field in list(arrow)[rows.num_columns :]:
                        rows = rows.append_column(field, pa.nulls(rows.num_rows, field.type))
                    yield rows
                    if recorded:
                        yield closing(item, lo, hi, rows.num_rows)
                except Exception as e:
                    if on_error == "fail":
                        raise RuntimeError(f"fetch failed for {item!r}: {e}") from e
                    if routed:
                        yield closing(item, lo, hi, 0, str(e))
                if pause:
                    time.sleep(random.uniform(*pause))

    return out, lambda batches: pack(call_each(batches))


def due_items(
    worklist: DataFrame,
    run_date: dt.date | str | None = None,
    open_ended: bool = False,
    key: str = "symbol",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """(item, lo, hi) of the items with something to fetch, and of those without a start."""
    require_columns(worklist, [key, start], "work list")
    if open_ended:
        stop = F.lit(None).cast("date")
    elif end in worklist.columns:
        stop = F.col(end).cast("date")
    else:
        stop = F.lit(resolve_run_date(run_date))
    return worklist.select(
        F.col(key).alias("item"), F.col(start).cast("date").alias("lo"), stop.alias("hi")
    ).where("hi IS NULL OR lo IS NULL OR lo < hi")


def fetch(
    worklist: DataFrame,
    provider: Provider,
    schema: T.StructType,
    *,
    run_date: dt.date | str | None = None,
    open_ended: bool = False,
    key: str = "symbol",
    start: str = "start_date",
    end: str = "end_date",
    date: str | None = None,
    on_error: str = "fail",
    max_parallel: int | None = None,
    pause: tuple[float, float] | None = None,
    rate: float | None = None,
) -> DataFrame:
    """Call ``provider`` once for each work item and return all rows it yields.

    An item whose start is not before its end is up to date and makes no call; one
    without a start fails.  The result has ``schema``'s columns and the key.  ``on_error``
    says what a failing call does: ``fail`` ends the job, ``drop`` leaves that item's rows
    out, ``route`` also adds one row with the key and the message in ``error`` (null in
    every other row), ``record`` closes every call with such a row, which also has the call's
    range and number of rows (see :func:`fetch_calls`).  ``date`` names the result's date column; given it, rows that a
    service sends beyond the asked range are cut.  ``pause`` waits a random time
    between those bounds after each call.  ``rate`` is the most calls a second that the service
    takes from all tasks together, however many cores run them: each of the ``max_parallel``
    tasks keeps to its share.  Items are dealt by the days they ask for.

    The plan is not for running twice: land the result, then use it.
    """
    items = due_items(worklist, run_date, open_ended, key, start, end)
    good = T.StructType([*schema.fields, T.StructField(key, worklist.schema[key].dataType)])
    out, run = runner(provider, good, key, date, on_error, pause, pace_of(items, max_parallel, rate))
    return distribute(items, max_parallel, days_to_fetch(run_date)).mapInArrow(run, out)


def pace_of(items: DataFrame, max_parallel: int | None, rate: float | None) -> tuple[int, float] | None:
    """How many tasks share a rate."""
    if rate is None:
        return None
    if rate <= 0:
        raise ValueError("rate must be positive")
    return max_parallel or 4 * items.sparkSession.sparkContext.defaultParallelism, float(rate)


def fetched_rows(landed: DataFrame) -> DataFrame:
    """The good rows of a landed ``route`` or ``record`` fetch."""
    rows = landed.where(F.col(ERROR).isNull())
    if CALL_ROWS in landed.columns:
        rows = rows.where(F.col(CALL_ROWS).isNull())
    return rows.drop(ERROR, CALL_START, CALL_END, CALL_ROWS)


def fetch_calls(landed: DataFrame, key: str = "symbol") -> DataFrame:
    """One row for each call of a landed ``record`` fetch: key, range, rows and error, if any."""
    return landed.where(F.col(CALL_ROWS).isNotNull()).select(key, CALL_START, CALL_END, CALL_ROWS, ERROR)


def fetch_errors(landed: DataFrame, key: str = "symbol") -> DataFrame:
    """One row for each failed call of a landed ``route`` fetch: key and message."""
    return landed.where(F.col(ERROR).isNotNull()).select(key, ERROR)


def whole_keys_only(landed: DataFrame, key: str = "symbol") -> DataFrame:
    """Good rows of the keys that had no failed call.

    Needed after ``split_ranges``, where one key may have good and failed pieces.
    """
    failed = fetch_errors(landed, key).select(key)
    return fetched_rows(landed).join(failed, key, "left_anti")


def withheld_rows(landed: DataFrame, key: str = "symbol") -> DataFrame:
    """Good rows that :func:`whole_keys_only` leaves out."""
    failed = fetch_errors(landed, key).select(key)
    return fetched_rows(landed).join(failed, key, "left_semi")


def earliest_start(worklist: DataFrame, start: str = "start_date") -> dt.date | None:
    """The first date a work list asks for: one row from a (landed) work list."""
    return worklist.agg(F.min(F.col(start).cast("date"))).first()[0]


def range_filter(
    rows: DataFrame,
    worklist: DataFrame,
    run_date: dt.date | str | None = None,
    *,
    key: str = "symbol",
    date: str = "date",
    start: str = "start_date",
    end: str = "end_date",
    not_before: dt.date | str | None = None,
) -> DataFrame:
    """Rows that the work list asks for: same key and ``start <= date < run_date``.

    As in :func:`fetch`, an ``end`` column of the work list counts in place of the run date, and
    null there is no end; a key may then have several ranges, see
    :func:`quoteloom.operators.ranges.join_ranges`.

    A semi join: each row comes out once at most, and only the row's own columns
    move on.  Spark broadcasts the work list when its measured size allows and
    otherwise sort-merges, splitting a hot key's rows across tasks.  The run date
    and ``not_before`` (see :func:`earliest_start`) are pushed to the scan, where they
    prune the history of a table that is partitioned by date.  Hand in a landed work
    list: Spark then knows its size, and splits hot keys if it has to sort-merge.
    """
    bounded = rows
    if not_before is not None:
        bounded = bounded.where(F.col(date) >= F.lit(resolve_run_date(not_before)))
    if end in worklist.columns:
        return join_ranges(bounded, worklist, key=key, date=date, start=start, end=end, how="left_semi")
    bounded = bounded.where(F.col(date) < F.lit(resolve_run_date(run_date)))
    wanted = worklist.select(F.col(key).alias("_key"), F.col(start).cast("date").alias("_start"))
    return bounded.join(
        wanted,
        (F.col(key) == F.col("_key")) & (F.col(date) >= F.col("_start")),
        "left_semi",
    )


def due_rows(
    rows: DataFrame,
    worklist: DataFrame,
    default_start: dt.date | str,
    run_date: dt.date | str | None = None,
    *,
    key: str = "symbol",
    date: str = "date",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """:func:`range_filter`, with a scan bound of their own for keys that were never loaded.

    New keys start at ``default_start`` or before; all others later.  One new key therefore
    does not make the scan for the known ones reach back to the default start.  Hand in
    a landed work list.  One that has an ``end`` column may have a key in both parts: it is not
    parted.
    """
    first = F.lit(resolve_run_date(default_start))
    starts = F.col(start).cast("date")
    if end in worklist.columns:
        bound = earliest_start(worklist, start)
        if bound is None:
            return rows.where(F.lit(False))
        return range_filter(rows, worklist, key=key, date=date, start=start, end=end, not_before=bound)
    parts = []
    for some in (worklist.where(starts > first), worklist.where(starts <= first)):
        bound = earliest_start(some, start)
        if bound is not None:
            parts.append(
                range_filter(
                    rows, some, run_date, key=key, date=date, start=start, not_before=bound
                )
            )
    if not parts:
        return rows.where(F.lit(False))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
