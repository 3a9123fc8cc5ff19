"""Bars: resampling, targets, flags, lags, rolling statistics, proxy alignment,
gap fills and the silver column order (S3, J1, P2, P8-P10, W1-W6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions import safe_div, trunc_time

KEY = "ticker"
ORDER = "t"
BAR_FIELDS = ["o", "h", "l", "c", "v", "vw", "n"]


def series_window(key: str = KEY, order: str = ORDER):
    """The one window spec every per-series operator shares.

    Equal specs let Catalyst put adjacent window steps behind a single
    exchange + sort on ``key``.
    """
    return Window.partitionBy(key).orderBy(order)


# --------------------------------------------------------------------- S3

def resample_bars(ticks: DataFrame, key: str, ts: str, price: str, qty: str,
                  unit: str = "day", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Ticks -> OHLCV bars ``(ticker, t, o, h, l, c, v, vw, n)``.

    Open / close are the price of the first / last tick by ``tiebreak`` columns
    then price (a total order, so ties are deterministic).  All aggregates are
    algebraic, so Spark combines them map-side before the shuffle on
    ``(key, bucket)``: a hot key or bucket never travels as raw rows.
    """
    order = F.struct(*[F.col(c) for c in tiebreak], F.col(price))
    px, q = F.col(price), F.col(qty)
    return (ticks
            .groupBy(F.col(key).alias(KEY), trunc_time(ts, unit).alias(ORDER))
            .agg(F.min_by(px, order).alias("o"),
                 F.max(px).alias("h"),
                 F.min(px).alias("l"),
                 F.max_by(px, order).alias("c"),
                 F.sum(q).cast("double").alias("v"),
                 F.coalesce(safe_div(F.sum(px * q), F.sum(q)), F.lit(0.0)).alias("vw"),
                 F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------- W3 W4 P8

def add_targets(df: DataFrame, key: str = KEY, order: str = ORDER,
                close: str = "c", open_: str = "o") -> DataFrame:
    """``target`` = next row's (c - o); ``next_c`` = next row's c."""
    w = series_window(key, order)
    return df.select("*",
                     F.lead(F.col(close) - F.col(open_)).over(w).alias("target"),
                     F.lead(close).over(w).alias("next_c"))


def add_class_flags(df: DataFrame, target: str = "target",
                    close: str = "c", open_: str = "o") -> DataFrame:
    """``target_class`` = target > 0 (0 when target is null, as the reference);
    ``c_class`` = c > o."""
    return df.select("*",
                     F.when(F.col(target) > 0, 1).otherwise(0).cast("long").alias("target_class"),
                     F.when(F.col(close) > F.col(open_), 1).otherwise(0).cast("long").alias("c_class"))


# ------------------------------------------------------------------ W5 W6

def add_lags(df: DataFrame, cols: Sequence[str] = ("vw", "n"), k: int = 5,
             key: str = KEY, order: str = ORDER) -> DataFrame:
    """``<col>_lag_<i>`` for i = 1..k, in one projection."""
    w = series_window(key, order)
    return df.select("*", *[F.lag(c, i).over(w).alias(f"{c}_lag_{i}")
                            for c in cols for i in range(1, k + 1)])


def add_rolling_stats(df: DataFrame, cols: Sequence[str] = ("vw", "n"), k: int = 5,
                      key: str = KEY, order: str = ORDER) -> DataFrame:
    """Mean and sample stddev of the k rows *before* the current one."""
    w = series_window(key, order).rowsBetween(-k, -1)
    out = []
    for c in cols:
        out += [F.avg(c).over(w).alias(f"{c}_rolling_mean"),
                F.stddev_samp(c).over(w).alias(f"{c}_rolling_std")]
    return df.select("*", *out)


# ------------------------------------------------------------------ J1 P2

def target_rows(df: DataFrame, targets: Sequence[str] | None, proxies: Sequence[str],
                key: str = KEY) -> DataFrame:
    """Rows of the target tickers; ``targets`` None means every ticker that is not a proxy."""
    if targets is None:
        return df.filter(~F.col(key).isin(list(proxies)))
    return df.filter(F.col(key).isin(list(targets)))


def attach_proxies(bars: DataFrame, targets: Sequence[str] | None, proxies: Sequence[str],
                   fields: Sequence[str] = BAR_FIELDS, key: str = KEY,
                   order: str = ORDER) -> DataFrame:
    """Left-join every proxy's bar fields onto the target series by ``order``.

    The reference runs one left join per proxy.  Because (key, order) is
    unique, pivoting the proxies once (explicit value list: no extra job to
    discover it) and joining once is the same result with one exchange.
    Columns are ``<proxy>_<field>``.  ``targets`` None: every ticker that is not a
    proxy.  ``bars`` is read twice; materialise it first where it is expensive.
    """
    proxies = list(proxies)
    wide = (bars.filter(F.col(key).isin(proxies))
            .groupBy(order)
            .pivot(key, proxies)
            .agg(*[F.first(f).alias(f) for f in fields]))
    if len(fields) == 1:  # pivot names single-aggregate columns by value only
        wide = wide.select(order, *[F.col(f"`{p}`").alias(f"{p}_{fields[0]}") for p in proxies])
    return target_rows(bars, targets, proxies, key).join(wide, on=order, how="left")


def proxy_columns(proxies: Sequence[str], fields: Sequence[str] = BAR_FIELDS) -> list[str]:
    return [f"{p}_{f}" for p in proxies for f in fields]


# ------------------------------------------------------------------ W1 W2

def ffill(df: DataFrame, cols: Sequence[str] | None = None, key: str = KEY,
          order: str = ORDER) -> DataFrame:
    """Forward fill: last non-null value up to the current row (one projection)."""
    cols = [c for c in (cols or df.columns) if c not in (key, order)]
    w = running_window(key, order)
    return df.select(*[F.last(F.col(f"`{c}`"), ignorenulls=True).over(w).alias(c)
                       if c in cols else F.col(f"`{c}`") for c in df.columns])


def bfill(df: DataFrame, cols: Sequence[str] | None = None, key: str = KEY,
          order: str = ORDER) -> DataFrame:
    """Backward fill: next non-null value from the current row on.

    Written as a running ``last`` over the *descending* order: Spark's
    current..unbounded-following frame recomputes per row (quadratic), the
    growing frame is incremental.  Note: uses future rows (the reference's
    ``fill_initial_nulls``).
    """
    cols = [c for c in (cols or df.columns) if c not in (key, order)]
    w = reverse_running_window(key, order)
    return df.select(*[F.last(F.col(f"`{c}`"), ignorenulls=True).over(w).alias(c)
                       if c in cols else F.col(f"`{c}`") for c in df.columns])


def running_window(key: str = KEY, order: str = ORDER):
    """Unbounded preceding .. current row (incremental frame)."""
    return series_window(key, order).rowsBetween(Window.unboundedPreceding, 0)


def reverse_running_window(key: str = KEY, order: str = ORDER):
    """Current row .. unbounded following, as a growing frame over the
    reversed order."""
    return (Window.partitionBy(key).orderBy(F.col(order).desc())
            .rowsBetween(Window.unboundedPreceding, 0))


# ------------------------------------------------------------------ P9 P10

def dropna_any(df: DataFrame) -> DataFrame:
    """Drop rows with any null (or NaN) value."""
    return df.dropna(how="any")


def target_last(df: DataFrame, target: str = "target",
                drop: Sequence[str] = ()) -> DataFrame:
    """Reorder so ``target`` is the last column, dropping helper columns."""
    cols = [c for c in df.columns if c != target and c not in drop]
    return df.select(*[F.col(f"`{c}`") for c in cols], F.col(target))
