"""Finite-frame and prefix indicators.

Every indicator is a window expression over ``partitionBy(key).orderBy(order)``
with a bounded row frame, so a batch of them is one projection behind one
sort, inside whole-stage code generation.  Until the frame holds ``window``
rows the value is null; any x/0 is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions import bin_left_closed, safe_div, weekday_mon1
from tickforge.operators.bars import KEY, ORDER, running_window, series_window


def _frame(w: int, key: str, order: str, win=None):
    return (win or series_window(key, order)).rowsBetween(-(w - 1), 0)


def _full(w: int, key: str, order: str, win=None) -> Column:
    return F.count(F.lit(1)).over(_frame(w, key, order, win)) >= F.lit(w)


# ``win``: the base (partition, order) window; default per key ordered by
# ``order``; the block-parallel mode passes a per-(key, block) window.

def williams_r(window: int = 14, high="h", low="l", close="c", key=KEY, order=ORDER, win=None) -> Column:
    """-100 * (HH - c) / (HH - LL) over the last ``window`` rows."""
    f = _frame(window, key, order, win)
    hh, ll = F.max(high).over(f), F.min(low).over(f)
    return F.when(_full(window, key, order, win),
                  safe_div(F.lit(-100.0) * (hh - F.col(close)), hh - ll))


def stoch_k(window: int = 14, high="h", low="l", close="c", key=KEY, order=ORDER, win=None) -> Column:
    """100 * (c - LL) / (HH - LL) over the last ``window`` rows."""
    f = _frame(window, key, order, win)
    hh, ll = F.max(high).over(f), F.min(low).over(f)
    return F.when(_full(window, key, order, win),
                  safe_div(F.lit(100.0) * (F.col(close) - ll), hh - ll))


def roc(window: int = 12, close="c", key=KEY, order=ORDER, win=None) -> Column:
    """Rate of change: 100 * (c - c[-window]) / c[-window]."""
    prev = F.lag(close, window).over(win or series_window(key, order))
    return safe_div(F.col(close) - prev, prev) * F.lit(100.0)


def typical_price(high="h", low="l", close="c") -> Column:
    return (F.col(high) + F.col(low) + F.col(close)) / F.lit(3.0)


def cci(window: int = 20, constant: float = 0.015, high="h", low="l", close="c",
        key=KEY, order=ORDER, win=None) -> Column:
    """Commodity channel index: (tp - mean tp) / (constant * mean |tp - mean tp|),
    the deviation taken around the current frame's own mean."""
    f = _frame(window, key, order, win)
    tp = typical_price(high, low, close)
    frame = F.collect_list(tp).over(f)
    n = F.size(frame)
    sma = F.aggregate(frame, F.lit(0.0), lambda a, x: a + x) / n
    mad = F.aggregate(F.transform(frame, lambda x: F.abs(x - sma)), F.lit(0.0),
                      lambda a, x: a + x) / n
    return F.when(n >= F.lit(window), safe_div(tp - sma, F.lit(constant) * mad))


def bollinger(window: int = 20, k: float = 2.0, close="c", key=KEY, order=ORDER,
              win=None) -> dict[str, Column]:
    """Mean and mean +/- k population standard deviations over ``window`` rows."""
    f = _frame(window, key, order, win)
    full = _full(window, key, order, win)
    mavg = F.avg(close).over(f)
    sd = F.stddev_pop(close).over(f)
    return {"bollinger_mavg": F.when(full, mavg),
            "bollinger_hband": F.when(full, mavg + F.lit(k) * sd),
            "bollinger_lband": F.when(full, mavg - F.lit(k) * sd)}


def vwap_terms(high="h", low="l", close="c", volume="v") -> tuple[Column, Column]:
    """Numerator and denominator terms of VWAP: v * tp and v."""
    return F.col(volume) * (F.col(high) + F.col(low) + F.col(close)) / F.lit(3.0), F.col(volume)


def vwap(high="h", low="l", close="c", volume="v", key=KEY, order=ORDER) -> Column:
    """Running volume-weighted typical price from the start of the series (Q8)."""
    w = running_window(key, order)
    num, den = vwap_terms(high, low, close, volume)
    return safe_div(F.sum(num).over(w), F.sum(den).over(w))


def calendar(ts=ORDER) -> dict[str, Column]:
    """Monday = 1 day of week, month, quarter, as doubles."""
    return {"dayofweek": weekday_mon1(ts).cast("double"),
            "month": F.month(ts).cast("double"),
            "quarter": F.quarter(ts).cast("double")}


def rsi_category(rsi="rsi") -> Column:
    """Bins [0,30) [30,70) [70,100) -> 1, 2, 3; 100 and nulls -> null (Q9)."""
    return bin_left_closed(rsi, [0, 30, 70, 100])


FRAME_HALO = 19   # deepest look-back of the frame indicators (20-row frames)


def frame_columns(key: str = KEY, order: str = ORDER, win=None) -> dict[str, Column]:
    """The finite-frame gold columns over a base window."""
    return {"williams_r": williams_r(key=key, order=order, win=win),
            "stoch_k": stoch_k(key=key, order=order, win=win),
            "roc": roc(key=key, order=order, win=win),
            "cci": cci(key=key, order=order, win=win),
            **bollinger(key=key, order=order, win=win)}


def add_frame_indicators(df: DataFrame, key: str = KEY, order: str = ORDER, mode: str = "key",
                         rn: str | None = None, block_rows: int = 4096) -> DataFrame:
    """All frame / prefix indicators of the gold table.

    ``mode='key'``: one projection of window expressions per key.
    ``mode='blocks'`` (needs a dense row number ``rn``): the frames run over
    (key, block) windows with a 19-row halo and VWAP takes block carries, so
    no task holds a whole series (see ``operators.blocks``).
    """
    if mode == "key":
        cols = frame_columns(key, order)
        v = vwap(key=key, order=order)
        cols["vwap"] = v
        cols["pvwap"] = F.col("c") - v
        cols.update(calendar(order))
        return df.select("*", *[c.alias(n) for n, c in cols.items()])
    from tickforge.operators import blocks as BK
    if rn is None:
        raise ValueError("blocks mode needs a dense row-number column")
    halo = BK.with_halo(df, rn, block_rows, back=FRAME_HALO)
    fr = halo.select("*", *[c.alias(n) for n, c in frame_columns(win=BK.block_window(key, rn)).items()])
    fr = BK.drop_halo(fr)
    num, den = vwap_terms()
    fr = BK.running_sums(fr, key, rn, block_rows, {"_vnum": num, "_vden": den})
    v = safe_div(F.col("_vnum"), F.col("_vden"))
    fr = fr.select("*", v.alias("vwap"), (F.col("c") - v).alias("pvwap"),
                   *[c.alias(n) for n, c in calendar(order).items()])
    return fr.drop("_vnum", "_vden")
