from roadsight.functions.exprs import (  # noqa: F401
    bitmap_offset, epoch_ms, event_time, half_up_mean, track_row_key, window_bounds_ms,
)
