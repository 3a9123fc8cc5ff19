"""Queries for model preparation, metrics, bands and the business-day
calendar (W8-W13, A2-A6, H7, J3, U2, U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import exchange as EX
from tickforge.operators import forecast as FC
from tickforge.operators import metrics as M
from tickforge.operators import prep as PR
from tickforge.operators.bars import series_window
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.sqlparts import BARS_DAILY, rounded
from tickforge.session import materialise
from tickforge.sources import fixtures as FX

FEATS = ["o", "h", "l", "c", "v", "vw", "n", "target"]
W = "OVER (PARTITION BY ticker ORDER BY t)"


def features(spark, sf_dir):
    """F1 bars with the next-day target; n as double."""
    b = FX.daily_bars(spark, sf_dir)
    return b.select("ticker", "t", "o", "h", "l", "c", "v", "vw", F.col("n").cast("double").alias("n"),
                    F.lead(F.col("c") - F.col("o")).over(series_window()).alias("target"))


FEAT_SQL = f"""{BARS_DAILY},
f AS (SELECT ticker, t, o, h, l, c, v, vw, CAST(n AS DOUBLE) AS n, lead(c - o) {W} AS target FROM bars),
st AS (SELECT ticker, {", ".join(f"min({c}) AS {c}__min, max({c}) AS {c}__max" for c in FEATS)}
       FROM f GROUP BY ticker),
sc AS (SELECT f.ticker, f.t, {", ".join(
    f"CASE WHEN st.{c}__max = st.{c}__min THEN 0.0 ELSE (f.{c} - st.{c}__min) / (st.{c}__max - st.{c}__min) END AS {c}"
    for c in FEATS)} FROM f JOIN st ON f.ticker = st.ticker)"""


def _scaled(spark, sf_dir):
    f = materialise(features(spark, sf_dir))
    stats = PR.minmax_fit(f, FEATS)
    return PR.minmax_scale(f, FEATS, stats), stats


@register("scaled", rounded(f"WITH {FEAT_SQL} SELECT * FROM sc", FEATS))
def scaled(spark, sf_dir):
    """Per-ticker min-max scaling; constant column -> 0."""
    return round_doubles(_scaled(spark, sf_dir)[0])


@register("scaled_train_fit", rounded(f"""WITH {FEAT_SQL},
nn AS (SELECT *, row_number() {W} AS rn, count(*) OVER (PARTITION BY ticker) AS nr FROM f),
tr AS (SELECT ticker, {", ".join(f"min({c}) AS {c}__min, max({c}) AS {c}__max" for c in FEATS)}
       FROM nn WHERE rn <= floor(nr * 0.8) GROUP BY ticker)
SELECT f.ticker, f.t, {", ".join(
    f"CASE WHEN tr.{c}__max = tr.{c}__min THEN 0.0 ELSE (f.{c} - tr.{c}__min) / (tr.{c}__max - tr.{c}__min) END AS {c}"
    for c in FEATS)} FROM f JOIN tr ON f.ticker = tr.ticker""", FEATS))
def scaled_train_fit(spark, sf_dir):
    """W9 without leakage: the scaler is fitted on the first 80% of each ticker's rows."""
    f = materialise(features(spark, sf_dir))
    return round_doubles(PR.minmax_scale(f, FEATS, PR.minmax_fit(f, FEATS, fit_on="train")))


@register("unscaled", rounded(f"""WITH {FEAT_SQL}
SELECT sc.ticker, sc.t, {", ".join(f"sc.{c} * (st.{c}__max - st.{c}__min) + st.{c}__min AS {c}" for c in FEATS)}
FROM sc JOIN st ON sc.ticker = st.ticker""", FEATS))
def unscaled(spark, sf_dir):
    """Inverse scaling restores the inputs."""
    s, stats = _scaled(spark, sf_dir)
    return round_doubles(PR.inverse_minmax(s, FEATS, stats))


SEQ_SQL = f"""{FEAT_SQL},
num AS (SELECT *, row_number() {W} - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS n_rows FROM sc),
lab AS (SELECT ticker, t AS ts, rn, rn - 4 AS seq_idx, n_rows, target AS y FROM num
        WHERE rn >= 4 AND rn <= n_rows - 2)"""


@register("sequences", rounded(f"""WITH {SEQ_SQL}
SELECT lab.ticker, lab.ts, lab.seq_idx, lab.y, CAST(num.rn - (lab.rn - 4) AS INTEGER) AS step,
       {", ".join(f"num.{c} AS x_{c}" for c in FEATS)}
FROM lab JOIN num ON num.ticker = lab.ticker AND num.rn BETWEEN lab.rn - 4 AND lab.rn - 1""",
                               ["y"] + [f"x_{c}" for c in FEATS]))
def sequences(spark, sf_dir):
    """4-row look-back windows of scaled features (one output row per
    sequence step, features as columns)."""
    seqs = PR.sequences(_scaled(spark, sf_dir)[0], FEATS, "target", 5)
    ex = seqs.select("ticker", "ts", "seq_idx", "y", F.posexplode("X").alias("step", "x"))
    return round_doubles(ex.select("ticker", "ts", "seq_idx", "y", F.col("step").cast("int"),
                                   *[F.get("x", i).alias(f"x_{c}") for i, c in enumerate(FEATS)]))


@register("sequences_long_series", rounded(f"""WITH {SEQ_SQL}
SELECT lab.ticker, lab.ts, lab.seq_idx, lab.y, CAST(num.rn - (lab.rn - 4) AS INTEGER) AS step,
       {", ".join(f"num.{c} AS x_{c}" for c in FEATS)}
FROM lab JOIN num ON num.ticker = lab.ticker AND num.rn BETWEEN lab.rn - 4 AND lab.rn - 1""",
                                            ["y"] + [f"x_{c}" for c in FEATS]))
def sequences_long_series(spark, sf_dir):
    """W8 in the block-parallel mode (100-row blocks, 4-row halo); equals
    ``sequences``."""
    seqs = PR.sequences(_scaled(spark, sf_dir)[0], FEATS, "target", 5, mode="blocks", block_rows=100)
    ex = seqs.select("ticker", "ts", "seq_idx", "y", F.posexplode("X").alias("step", "x"))
    return round_doubles(ex.select("ticker", "ts", "seq_idx", "y", F.col("step").cast("int"),
                                   *[F.get("x", i).alias(f"x_{c}") for i, c in enumerate(FEATS)]))


@register("chrono_split", rounded(f"""WITH {SEQ_SQL}
SELECT ticker, ts, seq_idx, y, CASE WHEN seq_idx < floor(n_rows * 0.8) THEN 'train' ELSE 'test' END AS split
FROM lab""", ["y"]))
def chrono_split(spark, sf_dir):
    """First floor(0.8 N) sequences train, the rest test."""
    seqs = PR.chrono_split(PR.sequences(_scaled(spark, sf_dir)[0], FEATS, "target", 5))
    return round_doubles(seqs.select("ticker", "ts", "seq_idx", "y", "split"))


@register("rolling_folds", f"""WITH {BARS_DAILY},
num AS (SELECT ticker, t, row_number() {W} - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS nr FROM bars),
cand AS (
  SELECT ticker, t, rn, nr, CAST(floor(rn / 20) AS BIGINT) * 20 AS start, 'train' AS role FROM num
  UNION ALL
  SELECT ticker, t, rn, nr, (CAST(floor(rn / 20) AS BIGINT) - 1) * 20 AS start, 'valid' AS role FROM num)
SELECT ticker, t, CAST(start / 20 AS INTEGER) AS fold, role, rn AS row_idx FROM cand
WHERE start >= 0 AND start < nr - 40""")
def rolling_folds(spark, sf_dir):
    """20-row rolling folds, (fold, role) per row."""
    b = FX.daily_bars(spark, sf_dir).select("ticker", "t")
    return PR.rolling_folds(b, 20)


BAR_DBL = ["o", "h", "l", "c", "v", "vw"]


@register("last_row", rounded(f"""WITH {BARS_DAILY}
SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t DESC) = 1""", BAR_DBL))
def last_row(spark, sf_dir):
    """The most recent bar per ticker (map-side max_by)."""
    return round_doubles(PR.last_row(FX.daily_bars(spark, sf_dir)))


@register("last_k", rounded(f"""WITH {BARS_DAILY}
SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t DESC) <= 60""", BAR_DBL))
def last_k(spark, sf_dir):
    """The 60 most recent bars per ticker."""
    return round_doubles(PR.last_k(FX.daily_bars(spark, sf_dir), 60))


# ----------------------------------------------------------- F5 metrics

def predictions(spark, sf_dir):
    """y = next (c - o), yhat = mean of the 5 previous y."""
    b = FX.daily_bars(spark, sf_dir)
    w = series_window()
    p = b.select("ticker", "t", F.lead(F.col("c") - F.col("o")).over(w).alias("y"))
    p = p.select("*", F.avg("y").over(w.rowsBetween(-5, -1)).alias("yhat"))
    return materialise(p.filter(F.col("y").isNotNull() & F.col("yhat").isNotNull()))


PRED_SQL = f"""{BARS_DAILY},
pr0 AS (SELECT ticker, t, lead(c - o) {W} AS y FROM bars),
pr1 AS (SELECT ticker, t, y, avg(y) OVER (PARTITION BY ticker ORDER BY t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
        AS yhat FROM pr0),
preds AS (SELECT * FROM pr1 WHERE y IS NOT NULL AND yhat IS NOT NULL),
pm AS (SELECT p.*, m.ybar, m.phbar FROM preds p JOIN (
        SELECT ticker, avg(y) AS ybar, avg(yhat) AS phbar FROM preds GROUP BY ticker) m USING (ticker))"""


@register("metrics", rounded(f"""WITH {PRED_SQL}
SELECT ticker, count(*) AS n, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
       1.0 - sum((y - yhat) * (y - yhat)) / nullif(sum(pow(y - ybar, 2)), 0) AS r2,
       quantile_cont(abs(y - yhat), 0.5) AS medae
FROM pm GROUP BY ticker""", ["rmse", "mae", "r2", "medae"]))
def metrics(spark, sf_dir):
    """A2: RMSE, MAE, R^2 and median absolute error per ticker."""
    return round_doubles(M.regression_metrics(predictions(spark, sf_dir)))


@register("mape", rounded(f"""WITH {PRED_SQL}
SELECT ticker, avg(abs((y - yhat) / nullif(y, 0))) * 100.0 AS mape FROM preds GROUP BY ticker""", ["mape"]))
def mape(spark, sf_dir):
    """A3: mean absolute percentage error (y = 0 rows skipped)."""
    return round_doubles(M.mape(predictions(spark, sf_dir)))


DA = "CASE WHEN sign(y - ybar) = sign(yhat - phbar) THEN 1.0 ELSE 0.0 END"


@register("directional_accuracy", rounded(f"""WITH {PRED_SQL}
SELECT ticker, avg({DA}) AS directional_accuracy FROM pm GROUP BY ticker""", ["directional_accuracy"]))
def directional_accuracy(spark, sf_dir):
    """A4: share of matching directions around the means."""
    return round_doubles(M.directional_accuracy(predictions(spark, sf_dir)))


@register("combined_metric", rounded(f"""WITH {PRED_SQL},
g AS (SELECT ticker, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
             sum((y - yhat) * (y - yhat)) AS sse, sum(pow(y - ybar, 2)) AS sst, avg({DA}) AS da,
             max(y) - min(y) AS rng FROM pm GROUP BY ticker)
SELECT ticker, rmse / nullif(rng, 0) + 0.5 * (mae / nullif(rng, 0))
       - 1.5 * (1.0 - sse / (sst + CAST('{M.EPS!r}' AS DOUBLE))) - da AS combined_metric FROM g""",
                                     ["combined_metric"]))
def combined_metric(spark, sf_dir):
    """A5: the reference's combined network metric."""
    return round_doubles(M.combined_metric(predictions(spark, sf_dir)))


@register("band", rounded(f"""WITH {PRED_SQL}
SELECT *, yhat * CAST('{1.0 - 0.95!r}' AS DOUBLE) AS lower, yhat * CAST('{1.0 + 0.95!r}' AS DOUBLE) AS upper
FROM preds""", ["y", "yhat", "lower", "upper"]))
def band(spark, sf_dir):
    """H7: the reference's band yhat * (1 -/+ 0.95)."""
    return round_doubles(M.prediction_band(predictions(spark, sf_dir), "yhat", 0.95))


@register("residual_band", rounded(f"""WITH {PRED_SQL},
qq AS (SELECT ticker, quantile_cont(y - yhat, 0.05) AS qlo, quantile_cont(y - yhat, 0.95) AS qhi
       FROM preds GROUP BY ticker)
SELECT p.*, p.yhat + qq.qlo AS lower, p.yhat + qq.qhi AS upper FROM preds p JOIN qq USING (ticker)""",
                                   ["y", "yhat", "lower", "upper"]))
def residual_band(spark, sf_dir):
    """H7 (alternative): yhat plus per-ticker 5% / 95% residual quantiles."""
    return round_doubles(M.residual_band(predictions(spark, sf_dir)))


# ------------------------------------------------------ J3 U2 U4

HOL_SQL = "(" + ", ".join(f"DATE '{d}'" for d in FC.HOLIDAYS) + ")"
BDAYS_TAIL = f"""
lastd AS (SELECT ticker, CAST(max(t) AS DATE) AS d0 FROM bars GROUP BY ticker),
cand AS (SELECT ticker, CAST(d0 + INTERVAL (k) DAY AS DATE) AS d FROM lastd, range(1, 90) r(k)),
bd AS (SELECT ticker, CAST(d AS TIMESTAMP) AS t,
              CAST(row_number() OVER (PARTITION BY ticker ORDER BY d) AS INTEGER) AS step
       FROM cand WHERE isodow(d) <= 5 AND d NOT IN {HOL_SQL}
       QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY d) <= 5)"""
BDAYS_SQL = f"{BARS_DAILY},{BDAYS_TAIL}"


@register("business_days", f"WITH {BDAYS_SQL} SELECT * FROM bd")
def business_days(spark, sf_dir):
    """Next 5 exchange days after each ticker's last bar."""
    last = FX.daily_bars(spark, sf_dir).groupBy("ticker").agg(F.max("t").alias("t"))
    return FC.next_business_days(last, 5, FC.holiday_table(spark, FC.HOLIDAYS))


@register("history_plus_forecast", rounded(f"""WITH {PRED_SQL}, {BDAYS_TAIL},
lastp AS (SELECT * FROM preds QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t DESC) = 1)
SELECT ticker, t, y, yhat, CAST(NULL AS INTEGER) AS step FROM preds
UNION ALL
SELECT bd.ticker, bd.t, CAST(NULL AS DOUBLE) AS y, lastp.yhat, bd.step FROM bd JOIN lastp USING (ticker)""",
                                           ["y", "yhat"]))
def history_plus_forecast(spark, sf_dir):
    """Prediction history plus 5 forecast rows per ticker (last yhat
    carried forward), other columns null."""
    preds = predictions(spark, sf_dir)
    last = FX.daily_bars(spark, sf_dir).groupBy("ticker").agg(F.max("t").alias("t"))
    days = FC.next_business_days(last, 5, FC.holiday_table(spark, FC.HOLIDAYS))
    lastp = PR.last_row(preds).select("ticker", "yhat")
    fc = days.join(lastp, "ticker", "inner")
    return round_doubles(FC.append_forecast(preds, fc))


#: Years that the calendar query moves the order days by, so that they span more than 20.
SHIFTS = (0, 8, 16)


@register("open_days", """WITH RECURSIVE seen AS (
  SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) + to_years(s.k) AS DATE) AS day
  FROM orders, (VALUES (0), (8), (16)) s(k)),
y AS (SELECT range AS y FROM range(1990, 2022)),
g AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y),
g2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM g),
g3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM g2),
east AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS e FROM g3),
fixed AS (
  SELECT make_date(y, m, d) AS d, sat FROM y, (VALUES (1, 1, false), (7, 4, true), (12, 25, true)) f(m, d, sat)),
hol AS (
  SELECT CASE isodow(d) WHEN 7 THEN d + 1 WHEN 6 THEN (CASE WHEN sat THEN d - 1 END) ELSE d END AS d FROM fixed
  UNION ALL SELECT make_date(y, e // 31, e % 31 + 1) - 2 FROM east
  UNION ALL SELECT d FROM (
    SELECT CAST(r.d AS DATE) AS d, month(r.d) AS m, isodow(r.d) AS w, (day(r.d) - 1) // 7 + 1 AS nth,
           day(last_day(r.d)) - day(r.d) < 7 AS final, year(r.d) AS y
    FROM range(DATE '1990-01-01', DATE '2022-01-01', INTERVAL 1 DAY) r(d))
  WHERE (m = 1 AND w = 1 AND nth = 3 AND y >= 1998) OR (m = 2 AND w = 1 AND nth = 3) OR (m = 5 AND w = 1 AND final)
     OR (m = 9 AND w = 1 AND nth = 1) OR (m = 11 AND w = 4 AND nth = 4)),
bd AS (
  SELECT day, CAST(c.d AS DATE) AS d, row_number() OVER (PARTITION BY day ORDER BY c.d) AS step
  FROM seen, (SELECT range AS k FROM range(1, 15)) k, LATERAL (SELECT CAST(day + CAST(k.k AS INTEGER) AS DATE) AS d) c
  WHERE isodow(c.d) <= 5 AND c.d NOT IN (SELECT d FROM hol WHERE d IS NOT NULL))
SELECT day, CAST(d AS TIMESTAMP) AS t, CAST(step AS INTEGER) AS step FROM bd WHERE step <= 3""")
def open_days(spark, sf_dir):
    """The next 3 open days by the rule calendar after every order day, moved so that they span more than 20 years."""
    orders = FX.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    days = orders.select(F.explode(F.array(*[F.add_months("d", 12 * k) for k in SHIFTS])).alias("day")).distinct()
    last = days.withColumn("t", F.col("day"))
    return EX.next_open_days(last, 3, EX.calendar(spark, 1990, 2021), key="day")
