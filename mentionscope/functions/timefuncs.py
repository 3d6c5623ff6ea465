"""Quarter-hour segment arithmetic (F6-F9, F16) as Spark column expressions.

Segments are 15-minute files named ``yyyyMMddHHmm00.gkg.csv`` in UTC. Every
function works on a timestamp column; the session time zone must be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ------------------------------------------------------------
SEGMENT_MINUTES = 15
SEGMENT_SECONDS = SEGMENT_MINUTES * 60
SEGMENT_NAME_PATTERN = "yyyyMMddHHmm00"
SEGMENT_EXTENSION = ".gkg.csv"
SEGMENT_PREFIX = "v2/gkg/"
# ---- end of fixed values -----------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stamp_minute(stamp) -> Column:
    """fixed-position parse of ``yyyyMMddHHmm...`` to a UTC minute (seconds = 0)."""
    s = _c(stamp)
    head = F.substring(s, 1, 12)
    return F.when(head.rlike("^[0-9]{12}$"), F.try_to_timestamp(head, F.lit("yyyyMMddHHmm")))


def floor_segment(ts, minutes: int = SEGMENT_MINUTES) -> Column:
    """Start of the segment holding ``ts`` (floor to the quarter hour)."""
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(_c(ts).cast("timestamp")) / step) * step)


def next_segment(ts, minutes: int = SEGMENT_MINUTES) -> Column:
    """next quarter-hour strictly after the current minute of ``ts``."""
    step = minutes * 60
    minute = F.floor(F.unix_seconds(_c(ts).cast("timestamp")) / 60) * 60
    return F.timestamp_seconds(F.floor(minute / step) * step + step)


def last_full_segment(ts, minutes: int = SEGMENT_MINUTES) -> Column:
    """F8: the quarter hour one full interval before the floor of ``ts``."""
    return floor_segment(ts, minutes) - F.make_interval(mins=F.lit(minutes))


def segment_name(ts) -> Column:
    """file name of the segment starting at ``ts``."""
    return F.concat(F.date_format(_c(ts), SEGMENT_NAME_PATTERN), F.lit(SEGMENT_EXTENSION))


def segment_start_from_file(file) -> Column:
    """Inverse of F9: the start time encoded in a segment file name (NULL if none)."""
    stamp = F.regexp_extract(_c(file), r"([0-9]{14})\.gkg\.csv$", 1)
    return F.when(stamp != "", F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")))


def segment_key(ts, prefix: str = SEGMENT_PREFIX) -> Column:
    """F16: object key = prefix + file name."""
    return F.concat(F.lit(prefix), segment_name(ts))


def segment_window(now, window_minutes: int = 60, minutes: int = SEGMENT_MINUTES) -> Column:
    """Array of segment starts covering the last ``window_minutes`` before ``now``.

    The list ends one full interval back (the newest segment that is surely
    complete) and steps back in 15-minute strides.
    """
    last = last_full_segment(now, minutes)
    first = last - F.make_interval(mins=F.lit(window_minutes - minutes))
    return F.sequence(first, last, F.expr(f"INTERVAL {minutes} MINUTES"))
