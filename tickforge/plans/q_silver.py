"""Queries for proxy alignment, fills, news and the silver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import bars as B
from tickforge.operators.news import attach_news, daily_text
from tickforge.plans import pipeline as PL
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.sqlparts import (BARS_DAILY, NEWS_DAILY, PROXIES_SQL, proxy_cols,
                                      proxy_pivot_sql, q, rounded)
from tickforge.session import materialise
from tickforge.sources import fixtures as FX

BAR_DBL = ["o", "h", "l", "c", "v", "vw"]
PCOLS = proxy_cols()
PDBL = [c for c in PCOLS if not c.endswith("_n")]
BASE = ["ticker", "t", "o", "h", "l", "c", "v", "vw", "n"]

JOINED = f"""{BARS_DAILY},
px AS ({proxy_pivot_sql()}),
joined AS (
  SELECT b.ticker, b.t, b.o, b.h, b.l, b.c, b.v, b.vw, b.n, {", ".join("px." + q(c) for c in PCOLS)}
  FROM bars b LEFT JOIN px ON b.t = px.t WHERE b.ticker NOT IN {PROXIES_SQL})"""

WB = "OVER (PARTITION BY ticker ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
WF = "OVER (PARTITION BY ticker ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _select(cols, fn):
    return ", ".join(fn(c) for c in cols)


@register("proxies_joined", rounded(f"WITH {JOINED} SELECT * FROM joined", BAR_DBL + PDBL))
def proxies_joined(spark, sf_dir):
    """11 proxy series pivoted once and left-joined on t."""
    bars = materialise(FX.daily_bars(spark, sf_dir))
    return round_doubles(B.attach_proxies(bars, FX.TARGETS, FX.PROXIES))


@register("ffill", rounded(
    f"WITH {JOINED} SELECT {', '.join(BASE)}, "
    + _select(PCOLS, lambda c: f"last_value({q(c)} IGNORE NULLS) {WB} AS {q(c)}")
    + " FROM joined", BAR_DBL + PDBL))
def ffill(spark, sf_dir):
    """Forward fill of the proxy columns along each target series."""
    bars = materialise(FX.daily_bars(spark, sf_dir))
    return round_doubles(B.ffill(B.attach_proxies(bars, FX.TARGETS, FX.PROXIES), PCOLS))


@register("bfill", rounded(
    f"WITH {JOINED} SELECT {', '.join(BASE)}, "
    + _select(PCOLS, lambda c: f"first_value({q(c)} IGNORE NULLS) {WF} AS {q(c)}")
    + " FROM joined", BAR_DBL + PDBL))
def bfill(spark, sf_dir):
    """Backward fill (next non-null from the current row on)."""
    bars = materialise(FX.daily_bars(spark, sf_dir))
    return round_doubles(B.bfill(B.attach_proxies(bars, FX.TARGETS, FX.PROXIES), PCOLS))


@register("news_daily", f"WITH {NEWS_DAILY} SELECT * FROM news_daily")
def news_daily(spark, sf_dir):
    """Daily text per ticker, articles in (time, id) order."""
    return daily_text(FX.news_articles(spark, sf_dir))


@register("bars_with_news", rounded(f"""WITH {BARS_DAILY}, {NEWS_DAILY}
SELECT b.*, coalesce(nd.aggregated_text, ' ') AS aggregated_text
FROM bars b LEFT JOIN news_daily nd ON b.ticker = nd.ticker AND b.t = nd.t""", BAR_DBL))
def bars_with_news(spark, sf_dir):
    """News attached to bars by (ticker, day); ' ' when none."""
    bars = FX.daily_bars(spark, sf_dir)
    return round_doubles(attach_news(bars, daily_text(FX.news_articles(spark, sf_dir))))


W = "OVER (PARTITION BY ticker ORDER BY t)"
RW = "OVER (PARTITION BY ticker ORDER BY t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
LAGS = [f"{c}_lag_{i}" for c in ("vw", "n") for i in range(1, 6)]
ROLL = ["vw_rolling_mean", "vw_rolling_std", "n_rolling_mean", "n_rolling_std"]
SILVER_DBL = BAR_DBL + PDBL + ["next_c", "target"] + [c for c in LAGS if c.startswith("vw")] + ROLL
SILVER_COLS = BASE + PCOLS + ["aggregated_text", "next_c", "target_class", "c_class"] + LAGS + ROLL + ["target"]

SILVER_SQL = f"""{JOINED}, {NEWS_DAILY},
filled AS (
  SELECT ticker, t, """ + _select(
    BASE[2:] + PCOLS, lambda c: f"coalesce(last_value({q(c)} IGNORE NULLS) {WB}, first_value({q(c)} IGNORE NULLS) {WF}) AS {q(c)}") + f"""
  FROM joined),
withnews AS (
  SELECT f.*, coalesce(nd.aggregated_text, ' ') AS aggregated_text
  FROM filled f LEFT JOIN news_daily nd ON f.ticker = nd.ticker AND f.t = nd.t),
derived AS (
  SELECT *, lead(c - o) {W} AS target, lead(c) {W} AS next_c,
         CAST(CASE WHEN c > o THEN 1 ELSE 0 END AS BIGINT) AS c_class,
         {", ".join(f"lag({c}, {i}) {W} AS {c}_lag_{i}" for c in ("vw", "n") for i in range(1, 6))},
         avg(vw) {RW} AS vw_rolling_mean, stddev_samp(vw) {RW} AS vw_rolling_std,
         avg(n) {RW} AS n_rolling_mean, stddev_samp(n) {RW} AS n_rolling_std
  FROM withnews),
silver AS (
  SELECT *, CAST(CASE WHEN target > 0 THEN 1 ELSE 0 END AS BIGINT) AS target_class FROM derived)"""

SILVER_WHERE = " AND ".join(f"{q(c)} IS NOT NULL" for c in SILVER_COLS)


@register("silver", rounded(
    f"WITH {SILVER_SQL} SELECT {', '.join(q(c) for c in SILVER_COLS)} FROM silver WHERE {SILVER_WHERE}",
    SILVER_DBL))
def silver(spark, sf_dir):
    """Whole silver layer: proxies, fills, news, targets, lags, rolling, dropna."""
    bars = FX.daily_bars(spark, sf_dir)
    return round_doubles(PL.build_silver(bars, FX.news_articles(spark, sf_dir),
                                         FX.TARGETS, FX.PROXIES))


@register("silver_long_series", rounded(
    f"WITH {SILVER_SQL} SELECT {', '.join(q(c) for c in SILVER_COLS)} FROM silver WHERE {SILVER_WHERE}",
    SILVER_DBL))
def silver_long_series(spark, sf_dir):
    """Silver with no per-ticker window: block carries for the fills and
    (ticker, block) windows with a halo for lead / lags / rolling (300-row
    blocks); equals ``silver``."""
    bars = FX.daily_bars(spark, sf_dir)
    return round_doubles(PL.build_silver(bars, FX.news_articles(spark, sf_dir), FX.TARGETS, FX.PROXIES,
                                         mode="blocks", block_rows=300))


# bars with holes in their own columns: c, vw and n null on every 7th day of a month
GAPS_SQL = SILVER_SQL.replace("bars AS (", "bars0 AS (", 1).replace("px AS (", """bars AS (
  SELECT ticker, t, o, h, l, CASE WHEN day(t) % 7 = 0 THEN NULL ELSE c END AS c, v,
         CASE WHEN day(t) % 7 = 0 THEN NULL ELSE vw END AS vw, CASE WHEN day(t) % 7 = 0 THEN NULL ELSE n END AS n
  FROM bars0),
px AS (""", 1)


@register("silver_own_gaps", rounded(
    f"WITH {GAPS_SQL} SELECT {', '.join(q(c) for c in SILVER_COLS)} FROM silver WHERE {SILVER_WHERE}",
    SILVER_DBL))
def silver_own_gaps(spark, sf_dir):
    """Silver over bars with nulls in the tickers' own columns: every column is filled, so no day is lost."""
    bars = FX.daily_bars(spark, sf_dir)
    hole = F.day("t") % 7 == 0
    bars = bars.withColumns({c: F.when(~hole, F.col(c)) for c in ("c", "vw", "n")})
    return round_doubles(PL.build_silver(bars, FX.news_articles(spark, sf_dir), FX.TARGETS, FX.PROXIES))


NOLOOK_SQL = f"""{JOINED}, {NEWS_DAILY},
filled AS (SELECT ticker, t, """ + _select(BASE[2:] + PCOLS, lambda c: f"last_value({q(c)} IGNORE NULLS) {WB} AS {q(c)}") + f"""
  FROM joined),
withnews AS (""" + SILVER_SQL.split("withnews AS (", 1)[1]


@register("silver_no_lookahead", rounded(
    f"WITH {NOLOOK_SQL} SELECT {', '.join(q(c) for c in SILVER_COLS)} FROM silver WHERE {SILVER_WHERE}",
    SILVER_DBL))
def silver_no_lookahead(spark, sf_dir):
    """Silver without the backward fill: rows before a proxy's first bar have no value and are dropped."""
    return round_doubles(PL.build_silver(FX.daily_bars(spark, sf_dir), FX.news_articles(spark, sf_dir),
                                         FX.TARGETS, FX.PROXIES, bfill=False))
