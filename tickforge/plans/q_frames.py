"""Queries for the finite-frame indicators."""

from __future__ import annotations

from tickforge.operators import frames as FR
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.sqlparts import BARS_DAILY, rounded
from tickforge.sources import fixtures as FX

BAR_DBL = ["o", "h", "l", "c", "v", "vw"]
BASE = "ticker, t, o, h, l, c, v, vw, n"
P = "PARTITION BY ticker ORDER BY t"


def _win(w):
    return f"OVER ({P} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"


def _bars(spark, sf_dir):
    return FX.daily_bars(spark, sf_dir)


def _one(name, col_fn, sql_expr):
    @register(name, rounded(f"WITH {BARS_DAILY} SELECT {BASE}, {sql_expr} AS {name} FROM bars",
                            BAR_DBL + [name]))
    def run(spark, sf_dir):
        df = _bars(spark, sf_dir)
        return round_doubles(df.select("*", col_fn().alias(name)))
    run.__doc__ = f"{name} over daily bars"
    return run


W14, W20 = _win(14), _win(20)
_one("williams_r", FR.williams_r,
     f"CASE WHEN count(*) {W14} >= 14 THEN (-100.0 * (max(h) {W14} - c)) / "
     f"nullif(max(h) {W14} - min(l) {W14}, 0) END")
_one("stoch_k", FR.stoch_k,
     f"CASE WHEN count(*) {W14} >= 14 THEN (100.0 * (c - min(l) {W14})) / "
     f"nullif(max(h) {W14} - min(l) {W14}, 0) END")
_one("roc", FR.roc, f"((c - lag(c, 12) OVER ({P})) / nullif(lag(c, 12) OVER ({P}), 0)) * 100.0")


@register("cci", rounded(f"""WITH {BARS_DAILY},
fr AS (SELECT {BASE}, (h + l + c) / 3.0 AS tp, list((h + l + c) / 3.0) {W20} AS lst FROM bars),
mm AS (SELECT *, list_reduce(list_prepend(0.0, lst), lambda a, x: a + x) / len(lst) AS sma FROM fr)
SELECT {BASE}, CASE WHEN len(lst) >= 20 THEN (tp - sma) / nullif(0.015 *
  (list_reduce(list_prepend(0.0, list_transform(lst, lambda x: abs(x - sma))), lambda a, x: a + x) / len(lst)), 0)
  END AS cci FROM mm""", BAR_DBL + ["cci"]))
def cci(spark, sf_dir):
    """T4: commodity channel index, 20 rows."""
    return round_doubles(_bars(spark, sf_dir).select("*", FR.cci().alias("cci")))


@register("bollinger", rounded(f"""WITH {BARS_DAILY}
SELECT {BASE},
  CASE WHEN count(*) {W20} >= 20 THEN avg(c) {W20} END AS bollinger_mavg,
  CASE WHEN count(*) {W20} >= 20 THEN avg(c) {W20} + 2.0 * stddev_pop(c) {W20} END AS bollinger_hband,
  CASE WHEN count(*) {W20} >= 20 THEN avg(c) {W20} - 2.0 * stddev_pop(c) {W20} END AS bollinger_lband
FROM bars""", BAR_DBL + ["bollinger_mavg", "bollinger_hband", "bollinger_lband"]))
def bollinger(spark, sf_dir):
    """Bollinger bands, 20 rows, 2 population deviations."""
    b = FR.bollinger()
    return round_doubles(_bars(spark, sf_dir).select("*", *[c.alias(n) for n, c in b.items()]))


RUN = f"OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("vwap", rounded(f"""WITH {BARS_DAILY},
x AS (SELECT {BASE}, sum(v * (h + l + c) / 3.0) {RUN} / nullif(sum(v) {RUN}, 0) AS vwap FROM bars)
SELECT *, c - vwap AS pvwap FROM x""", BAR_DBL + ["vwap", "pvwap"]))
def vwap(spark, sf_dir):
    """Running VWAP from the series start and c - vwap."""
    v = FR.vwap()
    from pyspark.sql import functions as F
    return round_doubles(_bars(spark, sf_dir).select("*", v.alias("vwap"), (F.col("c") - v).alias("pvwap")))


@register("calendar", rounded(f"""WITH {BARS_DAILY}
SELECT {BASE}, CAST(isodow(t) AS DOUBLE) AS dayofweek, CAST(month(t) AS DOUBLE) AS month,
       CAST(quarter(t) AS DOUBLE) AS quarter FROM bars""", BAR_DBL))
def calendar(spark, sf_dir):
    """Monday = 1 day of week, month, quarter as doubles."""
    return round_doubles(_bars(spark, sf_dir).select(
        "*", *[c.alias(n) for n, c in FR.calendar().items()]))
