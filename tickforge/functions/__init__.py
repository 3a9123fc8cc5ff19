from tickforge.functions.columns import (
    bin_left_closed, day_of, epoch_ms_to_day, iso_to_day, nan_to_null,
    safe_div, trunc_time, weekday_mon1,
)

__all__ = [
    "bin_left_closed", "day_of", "epoch_ms_to_day", "iso_to_day", "nan_to_null",
    "safe_div", "trunc_time", "weekday_mon1",
]
