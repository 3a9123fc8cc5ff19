"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI mode raises on x/0)."""
    return F.try_divide(_c(num), _c(den))


def nan_to_null(x) -> Column:
    """NaN -> null: ``ignorenulls`` and most null handling do not skip NaN."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def day_of(ts) -> Column:
    """Truncate a timestamp to its day, as ``timestamp_ntz`` (time-zone free)."""
    return _c(ts).cast("date").cast("timestamp_ntz")


def trunc_time(ts, unit: str) -> Column:
    """Truncate to ``unit`` ('day', 'hour', 'minute', ...) as ``timestamp_ntz``."""
    if unit == "day":
        return day_of(ts)
    # date_trunc answers in the session zone, which the session helper pins to UTC
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def epoch_ms_to_day(ms) -> Column:
    """Epoch milliseconds -> UTC day as ``timestamp_ntz`` (pure integer arithmetic)."""
    days = F.floor(_c(ms) / F.lit(86_400_000)).cast("int")
    return F.date_from_unix_date(days).cast("timestamp_ntz")


def iso_to_day(s) -> Column:
    """ISO-8601 string (with or without offset) -> UTC day as ``timestamp_ntz``; null
    for a string that is no timestamp."""
    return F.try_to_timestamp(_c(s)).cast("date").cast("timestamp_ntz")


def weekday_mon1(ts) -> Column:
    """Monday = 1 ... Sunday = 7 (Spark's ``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(ts)) + F.lit(1)


def bin_left_closed(x, edges, labels=None) -> Column:
    """Left-closed bins ``[e0,e1) [e1,e2) ...`` -> label (1..k by default), as double.

    Values outside ``[e0, e_k)`` and nulls give null.
    """
    c = _c(x)
    labels = labels or list(range(1, len(edges)))
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c >= F.lit(lo)) & (c < F.lit(hi))
        out = F.when(cond, F.lit(float(lab))) if out is None else out.when(cond, F.lit(float(lab)))
    return out.otherwise(F.lit(None).cast("double"))
