"""Time expressions. Session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from settlekit.schemas import EVENT_TIME_FORMAT


def parse_event_time(text) -> Column:
    """Wire text -> TIMESTAMP; NULL (not an error under ANSI) when unparseable."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c, F.lit(EVENT_TIME_FORMAT))


def format_event_time(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, EVENT_TIME_FORMAT)


def day(ts) -> Column:
    """Day bucket of an event time."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch (sub-seconds cut off)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(c.cast("timestamp"))
