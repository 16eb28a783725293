"""Date and time expressions.  All stay inside Spark's built-in functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms in which dates and stamps are written.
DATE_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
STAMP_MS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_date(ts: Column | str, zone: str, source_zone: str | None = None) -> Column:
    """The calendar date of ``ts`` in ``zone``.

    A zoned timestamp needs no ``source_zone``.  For a timestamp without zone,
    ``source_zone`` says where its wall clock was read.
    """
    source = F.lit(source_zone) if source_zone else F.current_timezone()
    return F.to_date(F.convert_timezone(source, F.lit(zone), _col(ts)))


def stamp_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), STAMP_FORMAT)


def date_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_FORMAT)


def stamp_ms_text(ts: Column | str) -> Column:
    """Text with zero-padded milliseconds, truncated and not rounded."""
    return F.date_format(_col(ts), STAMP_MS_FORMAT)


def parse_date(text: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Text to date; text that is not a date becomes null instead of failing the job."""
    return F.try_to_date(_col(text), fmt)


def parse_timestamp(text: Column | str, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(_col(text), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(text))


def batch_stamp(stamp: dt.datetime | str | None = None) -> Column:
    """One literal timestamp for a whole run; the driver reads the clock once if none is given."""
    if stamp is None:
        stamp = dt.datetime.now(dt.timezone.utc)
    if isinstance(stamp, dt.datetime):
        stamp = stamp.isoformat()
    return F.lit(stamp).cast("timestamp")


def resolve_run_date(run_date: dt.date | str | None = None) -> dt.date:
    """The one run date of a batch, today in UTC unless given."""
    if run_date is None:
        return dt.datetime.now(dt.timezone.utc).date()
    return dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
