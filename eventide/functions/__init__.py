from eventide.functions.time import (duration_ms, interval_str, millis_to_ts, to_millis,
                                     tumble_start, window_bounds_ms)

__all__ = ["duration_ms", "interval_str", "millis_to_ts", "to_millis", "tumble_start", "window_bounds_ms"]
