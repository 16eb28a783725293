from quoteloom.functions.temporal import (
    batch_stamp,
    date_text,
    local_date,
    parse_date,
    parse_timestamp,
    resolve_run_date,
    stamp_ms_text,
    stamp_text,
)

__all__ = [
    "batch_stamp",
    "date_text",
    "local_date",
    "parse_date",
    "parse_timestamp",
    "resolve_run_date",
    "stamp_ms_text",
    "stamp_text",
]
