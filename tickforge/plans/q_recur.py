"""Queries for the recurrence indicators (EMA, RSI, ATR, ADX, MACD), their
block-parallel variants and the warm-up fill.  The oracle is a recursive CTE
over per-ticker row numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import frames as FR
from tickforge.operators import recurrence as R
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.sqlparts import BARS_DAILY, q, rounded
from tickforge.sources import fixtures as FX

BAR_DBL = ["o", "h", "l", "c", "v", "vw"]
BASE = "ticker, t, o, h, l, c, v, vw, n"
BASE_COLS = BASE.split(", ")


def lit(x: float) -> str:
    """A double literal parsed exactly like Python's float."""
    return f"CAST('{x!r}' AS DOUBLE)"


A = {w: R.ema_alpha(w) for w in (9, 12, 20, 26, 50, 100)}
W14 = 1.0 / 14


def _step(prev: str, x: str, alpha: float) -> str:
    return f"{lit(1.0 - alpha)} * r.{prev} + ({lit(alpha)} * n.{x})"


def _seeded(prev: str, x: str, alpha: float, seed_row: int, seed: str) -> str:
    return (f"CASE WHEN n.rn < {seed_row} THEN NULL WHEN n.rn = {seed_row} THEN n.{seed} "
            f"ELSE {_step(prev, x, alpha)} END")


def _avg_rows(col: str, lo: int, hi: int) -> str:
    f = f"FILTER (WHERE rn BETWEEN {lo} AND {hi})"
    return f"CASE WHEN count(*) {f} = {hi - lo + 1} THEN avg({col}) {f} END"


def recur_cte(prefix: str, src: str) -> str:
    """Recurrence CTEs (ending in ``rec``) over the series CTE ``src``."""
    return f"""{prefix},
b0 AS (
  SELECT {BASE}, row_number() OVER w - 1 AS rn, lag(c) OVER w AS pc, lag(h) OVER w AS ph,
         lag(l) OVER w AS pl
  FROM {src} WINDOW w AS (PARTITION BY ticker ORDER BY t)),
b1 AS (
  SELECT *,
    CASE WHEN pc IS NULL THEN 0.0 ELSE greatest(c - pc, 0.0) END AS gain,
    CASE WHEN pc IS NULL THEN 0.0 ELSE greatest(pc - c, 0.0) END AS loss,
    CASE WHEN pc IS NULL THEN h - l ELSE greatest(h - l, abs(h - pc), abs(l - pc)) END AS tr,
    CASE WHEN (h - ph) > (pl - l) AND (h - ph) > 0 THEN h - ph ELSE 0.0 END AS pdm,
    CASE WHEN (pl - l) > (h - ph) AND (pl - l) > 0 THEN pl - l ELSE 0.0 END AS mdm
  FROM b0),
sd AS (
  SELECT ticker, {_avg_rows('tr', 0, 13)} AS tr_seed, {_avg_rows('tr', 1, 14)} AS tr_s1,
         {_avg_rows('pdm', 1, 14)} AS pdm_s1, {_avg_rows('mdm', 1, 14)} AS mdm_s1
  FROM b1 GROUP BY ticker),
b2 AS (SELECT b1.*, sd.tr_seed, sd.tr_s1, sd.pdm_s1, sd.mdm_s1 FROM b1 JOIN sd USING (ticker)),
r1 AS (
  SELECT ticker, rn, c AS e12, c AS e20, c AS e26, c AS e50, c AS e100, gain AS up, loss AS dn,
         CAST(NULL AS DOUBLE) AS atr, CAST(NULL AS DOUBLE) AS trw, CAST(NULL AS DOUBLE) AS pdmw,
         CAST(NULL AS DOUBLE) AS mdmw
  FROM b2 WHERE rn = 0
  UNION ALL
  SELECT n.ticker, n.rn, {_step('e12', 'c', A[12])}, {_step('e20', 'c', A[20])},
         {_step('e26', 'c', A[26])}, {_step('e50', 'c', A[50])}, {_step('e100', 'c', A[100])},
         {_step('up', 'gain', W14)}, {_step('dn', 'loss', W14)},
         {_seeded('atr', 'tr', W14, 13, 'tr_seed')}, {_seeded('trw', 'tr', W14, 14, 'tr_s1')},
         {_seeded('pdmw', 'pdm', W14, 14, 'pdm_s1')}, {_seeded('mdmw', 'mdm', W14, 14, 'mdm_s1')}
  FROM r1 r JOIN b2 n ON n.ticker = r.ticker AND n.rn = r.rn + 1),
d1 AS (
  SELECT b2.*, r1.* EXCLUDE (ticker, rn),
         100.0 * (r1.pdmw / nullif(r1.trw, 0)) AS pdi, 100.0 * (r1.mdmw / nullif(r1.trw, 0)) AS mdi,
         CASE WHEN b2.rn >= 25 THEN r1.e12 - r1.e26 END AS macd
  FROM b2 JOIN r1 ON b2.ticker = r1.ticker AND b2.rn = r1.rn),
d2 AS (SELECT *, 100.0 * (abs(pdi - mdi) / nullif(pdi + mdi, 0)) AS dx FROM d1),
sd2 AS (SELECT ticker, {_avg_rows('dx', 14, 27)} AS dx_seed FROM d2 GROUP BY ticker),
d3 AS (SELECT d2.*, sd2.dx_seed FROM d2 JOIN sd2 USING (ticker)),
r2 AS (
  SELECT ticker, rn, CAST(NULL AS DOUBLE) AS adx, CAST(NULL AS DOUBLE) AS sig FROM d3 WHERE rn = 0
  UNION ALL
  SELECT n.ticker, n.rn, {_seeded('adx', 'dx', W14, 27, 'dx_seed')},
         {_seeded('sig', 'macd', A[9], 25, 'macd')}
  FROM r2 r JOIN d3 n ON n.ticker = r.ticker AND n.rn = r.rn + 1),
rec AS (
  SELECT d3.*, r2.adx AS adx_raw, r2.sig,
    CASE WHEN d3.rn >= 19 THEN e20 END AS "20D-EMA",
    CASE WHEN d3.rn >= 49 THEN e50 END AS "50D-EMA",
    CASE WHEN d3.rn >= 99 THEN e100 END AS "100D-EMA",
    CASE WHEN d3.rn >= 13 THEN (CASE WHEN dn = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + up / dn) END) END AS rsi,
    pdi AS "DMP_16", r2.adx AS adx,
    CASE WHEN d3.rn >= 33 THEN r2.sig END AS "MACDs_12_26_9",
    CASE WHEN d3.rn >= 33 THEN macd - r2.sig END AS "MACDh_12_26_9"
  FROM d3 JOIN r2 ON d3.ticker = r2.ticker AND d3.rn = r2.rn)"""


RECUR_CTE = recur_cte(BARS_DAILY, "bars")


def _recur_sql(cols: list[str], extra: str = "") -> str:
    sel = ", ".join(q(c) for c in cols)
    return rounded(f"WITH RECURSIVE {RECUR_CTE} SELECT {BASE}, {sel}{extra} FROM rec",
                   BAR_DBL + cols)


def _bars(spark, sf_dir):
    return FX.daily_bars(spark, sf_dir)


EMA_COLS = ["20D-EMA", "50D-EMA", "100D-EMA"]


@register("ema", _recur_sql(EMA_COLS))
def ema(spark, sf_dir):
    """20/50/100-row EMAs of close (per-ticker scan)."""
    return round_doubles(R.add_ema(_bars(spark, sf_dir)))


@register("ema_long_series", _recur_sql(EMA_COLS))
def ema_long_series(spark, sf_dir):
    """T7-T9 with the block-parallel scan (256-row blocks)."""
    return round_doubles(R.add_ema(_bars(spark, sf_dir), mode="blocks", block_rows=256))


@register("rsi", _recur_sql(["rsi"]))
def rsi(spark, sf_dir):
    """Wilder RSI, 14 rows."""
    return round_doubles(R.add_rsi(_bars(spark, sf_dir)))


@register("rsi_long_series", _recur_sql(["rsi"]))
def rsi_long_series(spark, sf_dir):
    """T15 with the block-parallel scan (256-row blocks)."""
    return round_doubles(R.add_rsi(_bars(spark, sf_dir), mode="blocks", block_rows=256))


RSICAT_SQL = (", CAST(CASE WHEN rsi >= 0 AND rsi < 30 THEN 1 WHEN rsi >= 30 AND rsi < 70 THEN 2 "
              "WHEN rsi >= 70 AND rsi < 100 THEN 3 END AS DOUBLE) AS rsicat")


@register("rsi_bin", _recur_sql(["rsi"], RSICAT_SQL))
def rsi_bin(spark, sf_dir):
    """RSI bins [0,30) [30,70) [70,100) -> 1, 2, 3."""
    df = R.add_rsi(_bars(spark, sf_dir))
    return round_doubles(df.withColumn("rsicat", FR.rsi_category("rsi")))


def _tech(spark, sf_dir, cols, mode="key"):
    df = R.add_technical_recurrences(_bars(spark, sf_dir), mode=mode, block_rows=256)
    return round_doubles(df.select(*BASE_COLS, *[F.col(f"`{c}`") for c in cols]))


@register("atr", _recur_sql(["atr"]))
def atr(spark, sf_dir):
    """Wilder ATR, seeded by the mean of the first 14 true ranges."""
    return _tech(spark, sf_dir, ["atr"])


@register("adx", _recur_sql(["adx", "DMP_16"]))
def adx(spark, sf_dir):
    """ADX and +DI (14 rows)."""
    return _tech(spark, sf_dir, ["adx", "DMP_16"])


@register("macd", _recur_sql(["MACDs_12_26_9", "MACDh_12_26_9"]))
def macd(spark, sf_dir):
    """MACD signal (EMA9 of EMA12 - EMA26) and histogram."""
    return _tech(spark, sf_dir, ["MACDs_12_26_9", "MACDh_12_26_9"])


TECH_COLS = ["20D-EMA", "50D-EMA", "100D-EMA", "rsi", "atr", "adx", "DMP_16",
             "MACDs_12_26_9", "MACDh_12_26_9"]


@register("technical_long_series", _recur_sql(TECH_COLS))
def technical_long_series(spark, sf_dir):
    """All recurrence indicators with the block-parallel scan (equals the
    per-ticker results)."""
    return _tech(spark, sf_dir, TECH_COLS, mode="blocks")
