"""Places of rows within groups, however large a group is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.shared import Landing

# Fixed value: monotonically_increasing_id() has the task above this bit, the row's index below.
INDEX_BITS = 33


def ranked(
    df: DataFrame, group: str, order: Sequence[Column | str], landing: Landing
) -> DataFrame:
    """``df``, landed, with ``pos`` (from 0, in ``order`` within ``group``) and the group's ``size``.

    Rows are dealt by ranges of group and order together and counted per task, so a group with
    a third of all rows is spread over many tasks.  What a group needs in one place is one
    row for each task.  ``group`` has no nulls.  Rows that tie come in any order: let ``order``
    end in what tells rows apart.
    """
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    landed = landing.land(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = landed.withColumns(
        {
            "_part": F.shiftright("_at", INDEX_BITS),
            "_index": F.col("_at").bitwiseAND((1 << INDEX_BITS) - 1),
        }
    )
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_index").alias("_first"))
    parts = Window.partitionBy(group)
    before = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        group,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(parts).alias("size"),
    )
    return (
        placed.join(shifts, [group, "_part"])
        .withColumn("pos", F.col("_index") + F.col("_shift"))
        .drop("_part", "_index", "_shift", "_at")
    )
