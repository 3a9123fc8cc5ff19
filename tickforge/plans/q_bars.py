"""Queries over bars: resampling, targets, flags, lags, rolling statistics."""

from __future__ import annotations

from tickforge.operators import bars as B
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.sqlparts import BARS_DAILY, BARS_HOURLY, rounded
from tickforge.sources import fixtures as FX

BAR_DBL = ["o", "h", "l", "c", "v", "vw"]
BAR_COLS = "ticker, t, o, h, l, c, v, vw, n"


@register("bars_daily", rounded(f"WITH {BARS_DAILY} SELECT {BAR_COLS} FROM bars", BAR_DBL))
def bars_daily(spark, sf_dir):
    """S3: daily OHLCV bars per brand from lineitem ticks."""
    return round_doubles(FX.daily_bars(spark, sf_dir))


@register("bars_hourly", rounded(f"WITH {BARS_HOURLY} SELECT {BAR_COLS} FROM bars", BAR_DBL))
def bars_hourly(spark, sf_dir):
    """S3: hourly bars per event type from events."""
    return round_doubles(FX.hourly_bars(spark, sf_dir))


W = "OVER (PARTITION BY ticker ORDER BY t)"


@register("targets", rounded(f"""WITH {BARS_DAILY}
SELECT {BAR_COLS}, lead(c - o) {W} AS target, lead(c) {W} AS next_c FROM bars""",
                             BAR_DBL + ["target", "next_c"]))
def targets(spark, sf_dir):
    """Next-day (c - o) and next close."""
    return round_doubles(B.add_targets(FX.daily_bars(spark, sf_dir)))


@register("flags", rounded(f"""WITH {BARS_DAILY}, tg AS (
SELECT {BAR_COLS}, lead(c - o) {W} AS target FROM bars)
SELECT *, CAST(CASE WHEN target > 0 THEN 1 ELSE 0 END AS BIGINT) AS target_class,
          CAST(CASE WHEN c > o THEN 1 ELSE 0 END AS BIGINT) AS c_class FROM tg""",
                           BAR_DBL + ["target"]))
def flags(spark, sf_dir):
    """Class flags (target_class is 0 where target is null)."""
    df = FX.daily_bars(spark, sf_dir)
    w = B.series_window()
    from pyspark.sql import functions as F
    df = df.select("*", F.lead(F.col("c") - F.col("o")).over(w).alias("target"))
    return round_doubles(B.add_class_flags(df))


def _lag_sql(cols=("vw", "n"), k=5):
    return ", ".join(f"lag({c}, {i}) {W} AS {c}_lag_{i}" for c in cols for i in range(1, k + 1))


@register("lags", rounded(f"WITH {BARS_DAILY} SELECT {BAR_COLS}, {_lag_sql()} FROM bars",
                          BAR_DBL + [f"vw_lag_{i}" for i in range(1, 6)]))
def lags(spark, sf_dir):
    """Lags 1..5 of vw and n."""
    return round_doubles(B.add_lags(FX.daily_bars(spark, sf_dir)))


RW = "OVER (PARTITION BY ticker ORDER BY t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


@register("rolling_stats", rounded(f"""WITH {BARS_DAILY}
SELECT {BAR_COLS}, avg(vw) {RW} AS vw_rolling_mean, stddev_samp(vw) {RW} AS vw_rolling_std,
       avg(n) {RW} AS n_rolling_mean, stddev_samp(n) {RW} AS n_rolling_std FROM bars""",
                                   BAR_DBL + ["vw_rolling_mean", "vw_rolling_std",
                                              "n_rolling_mean", "n_rolling_std"]))
def rolling_stats(spark, sf_dir):
    """Mean and sample std of the 5 previous rows."""
    return round_doubles(B.add_rolling_stats(FX.daily_bars(spark, sf_dir)))
