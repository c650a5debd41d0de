"""Event-time helpers.

Time is carried as epoch milliseconds (``bigint``) like the record types of
the stream jobs this library re-expresses; a ``timestamp`` column is derived
only where Spark needs one (``window``, ``withWatermark``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_UNITS_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


def duration_ms(d: int | str) -> int:
    """``5000``, ``'5 seconds'``, ``'-5 minutes'``, ``'2h'`` -> milliseconds."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"unrecognised duration: {d!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def interval_str(ms: int) -> str:
    """Milliseconds -> a Spark interval string usable by ``window``/``withWatermark``."""
    if ms % 1000 == 0:
        return f"{ms // 1000} seconds"
    return f"{ms} milliseconds"


def to_millis(col: str | Column, dtype=None) -> Column:
    """Epoch milliseconds (floor) of a timestamp column.

    ``TIMESTAMP_NTZ`` is read as UTC wall-clock time from its date and time
    fields, so the result never depends on the session time zone (a cast to
    ``TIMESTAMP`` would shift it by the zone's offset, DST included).
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, TimestampNTZType):
        micros = (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
                  + (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * F.lit(1_000_000)
                  + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint"))
        return floor_div(micros, 1000)
    return F.unix_millis(c)


def floor_div(x: Column, n: int) -> Column:
    """Exact integer floor division.  SQL ``div`` truncates toward zero, so
    the remainder is taken off first; the quotient is then exact."""
    return F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def millis_to_ts(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c)


def window_bounds_ms(window_col: str = "window") -> list[Column]:
    """``window.start``/``window.end`` as epoch-ms ``bigint`` columns."""
    return [F.unix_millis(F.col(f"{window_col}.start")).alias("window_start"),
            F.unix_millis(F.col(f"{window_col}.end")).alias("window_end")]


def tumble_start(ts_ms: str | Column, size_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts_ms`` (floor)."""
    c = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return floor_div(c, size_ms) * F.lit(size_ms)


def processing_time() -> Column:
    """Processing-time clock (the alternative to an event-time column when a
    job runs on processing time); fixed per query or micro-batch."""
    return F.current_timestamp()
