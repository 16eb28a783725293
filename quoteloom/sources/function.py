"""The ranged fetch as a table function for SQL: ``SELECT * FROM name(TABLE(...))``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.operators.fetch import Provider, runner


def register_fetch_function(
    spark: SparkSession,
    name: str,
    provider: Provider,
    schema: T.StructType,
    *,
    key: str = "symbol",
    key_type: T.DataType | None = None,
    date: str | None = None,
    on_error: str = "fail",
) -> None:
    """Register ``provider`` as the table function ``name``.

    Its argument is a table of (item, lo, hi): key, start and end of each call, as
    :func:`quoteloom.operators.fetch.due_items` makes it; a null end is no end.  The calls are
    those of :func:`quoteloom.operators.fetch.fetch`, errors included, in the tasks that the
    table comes in: hand in a distributed one.
    """
    good = T.StructType([*schema.fields, T.StructField(key, key_type or T.StringType())])
    out, run = runner(provider, good, key, date, on_error)

    class Fetch:
        def eval(self, items: pa.RecordBatch):
            for batch in run(iter([items])):
                yield pa.Table.from_batches([batch])

    spark.udtf.register(name, F.arrow_udtf(Fetch, returnType=out))
