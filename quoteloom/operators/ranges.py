"""Rows that fall into ranges of dates, many ranges for each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.operators.projection import require_columns

# Days of a bin: a range is met in each bin that it covers.
BIN_DAYS = 32


def _bin(date: Column, days: int) -> Column:
    return F.floor(F.unix_date(date) / F.lit(days)).cast("int")


def join_ranges(
    rows: DataFrame,
    ranges: DataFrame,
    *,
    key: str = "symbol",
    date: str = "date",
    start: str = "start_date",
    end: str = "end_date",
    how: str = "inner",
    bin_days: int = BIN_DAYS,
) -> DataFrame:
    """Every row with each range that holds it: same key, ``start <= date < end``.

    Ranges may overlap, and a key may have very many: both sides are joined on key and bin of
    days, so a row meets only the ranges near its date, and a key with a third of all rows is
    many join keys.  The result has all columns of ``rows``, then those of ``ranges`` but the
    key; with ``how="left_semi"`` each row once and its own columns only.  A range without
    an end has none; one without a start, or that is empty, holds nothing.  Ranges without
    an end are joined apart, on the key: they would have no last bin.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"how must be inner or left_semi, not {how!r}")
    require_columns(rows, [key, date], "rows")
    require_columns(ranges, [key, start, end], "ranges")
    others = [c for c in ranges.columns if c != key]
    clash = [c for c in others if c in rows.columns]
    if how == "inner" and clash:
        raise ValueError(f"rows and ranges both have columns {clash}")
    lo, hi = F.col(start).cast("date"), F.col(end).cast("date")
    kept = [] if how == "left_semi" else others
    asked = ranges.select(
        F.col(key).alias("_key"),
        lo.alias("_lo"),
        hi.alias("_hi"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("_range"),
    ).where("_lo IS NOT NULL")
    closed = asked.where("_lo < _hi")
    bins = F.sequence(_bin(F.col("_lo"), bin_days), _bin(F.date_sub("_hi", 1), bin_days))
    binned = closed.withColumn("_range_bin", F.explode(bins))
    open_ended = asked.where("_hi IS NULL")

    placed = rows.withColumn("_bin", _bin(F.col(f"`{date}`").cast("date"), bin_days))
    same = F.col(f"`{key}`") == F.col("_key")
    day = F.col(f"`{date}`")
    near = same & (F.col("_bin") == F.col("_range_bin")) & (day >= F.col("_lo")) & (day < F.col("_hi"))
    if how == "left_semi":
        # an open range of a key asks for all that the earliest one asks for
        earliest = open_ended.groupBy("_key").agg(F.min("_lo").alias("_lo"))
        late = rows.join(earliest, same & (day >= F.col("_lo")), "left_semi")
        early = placed.join(earliest, same & (day >= F.col("_lo")), "left_anti").join(binned, near, "left_semi")
        return late.unionByName(early.drop("_bin"))
    columns = [*[F.col(f"`{c}`") for c in rows.columns], *[F.col("_range")[c].alias(c) for c in kept]]
    late = rows.join(open_ended, same & (day >= F.col("_lo"))).select(*columns)
    return placed.join(binned, near).select(*columns).unionByName(late)
