"""What the corpus operators share."""

from __future__ import annotations

import contextlib
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object that this Python worker process makes once and keeps between tasks."""
    held = sys.modules.setdefault("_quoteloom_worker", types.ModuleType("_quoteloom_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 200):
    """Arrow batches of few rows, for actions in the block whose rows each carry a whole text.

    Joins repeat a long text for each of its partners; batches of the usual row count would
    then hold gigabytes.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, rows)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def pieces(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4_000_000
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``max_bytes`` of ``text``, one row at least.

    Texts differ a thousandfold in length; this bounds what one step holds in Python by
    bytes and not by rows.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def merged_spans(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")
    return F.aggregate(
        spans,
        none,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
