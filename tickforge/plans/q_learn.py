"""Gold table, warm-up fill and the learning / forecasting queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge.operators import learn as L
from tickforge.operators import metrics as M
from tickforge.operators import search as S
from tickforge.operators import state as ST
from tickforge.plans import pipeline as PL
from tickforge.operators.forecast import HOLIDAYS, carry_forward, holiday_table, next_business_days
from tickforge.operators.prep import last_row, rolling_folds
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.q_frames import W14, W20
from tickforge.plans.q_prep import HOL_SQL
from tickforge.plans.q_recur import RSICAT_SQL, recur_cte
from tickforge.plans.q_silver import SILVER_COLS, SILVER_DBL, SILVER_SQL, SILVER_WHERE
from tickforge.plans.sqlparts import BARS_DAILY, BARS_HOURLY, q, rounded
from tickforge.session import materialise, scratch_path
from tickforge.sources import fixtures as FX

P = "PARTITION BY ticker ORDER BY t"
RUN = f"OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
REV = "OVER (PARTITION BY ticker ORDER BY t DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

def ind_sql(prefix: str, src: str) -> str:
    """All 22 derived columns (CTE ``ind``) over the series CTE ``src``."""
    return f"""{recur_cte(prefix, src)},
fr AS (
  SELECT ticker, t,
    CASE WHEN count(*) {W14} >= 14 THEN (-100.0 * (max(h) {W14} - c)) / nullif(max(h) {W14} - min(l) {W14}, 0) END
      AS williams_r,
    CASE WHEN count(*) {W14} >= 14 THEN (100.0 * (c - min(l) {W14})) / nullif(max(h) {W14} - min(l) {W14}, 0) END
      AS stoch_k,
    ((c - lag(c, 12) OVER ({P})) / nullif(lag(c, 12) OVER ({P}), 0)) * 100.0 AS roc,
    (h + l + c) / 3.0 AS tp, list((h + l + c) / 3.0) {W20} AS lst,
    CASE WHEN count(*) {W20} >= 20 THEN avg(c) {W20} END AS bollinger_mavg,
    CASE WHEN count(*) {W20} >= 20 THEN avg(c) {W20} + 2.0 * stddev_pop(c) {W20} END AS bollinger_hband,
    CASE WHEN count(*) {W20} >= 20 THEN avg(c) {W20} - 2.0 * stddev_pop(c) {W20} END AS bollinger_lband,
    sum(v * (h + l + c) / 3.0) {RUN} / nullif(sum(v) {RUN}, 0) AS vwap,
    CAST(isodow(t) AS DOUBLE) AS dayofweek, CAST(month(t) AS DOUBLE) AS month,
    CAST(quarter(t) AS DOUBLE) AS quarter
  FROM {src}),
fr2 AS (SELECT *, list_reduce(list_prepend(0.0, lst), lambda a, x: a + x) / len(lst) AS sma FROM fr),
fr3 AS (SELECT * EXCLUDE (lst, sma, tp), CASE WHEN len(lst) >= 20 THEN (tp - sma) / nullif(0.015 *
  (list_reduce(list_prepend(0.0, list_transform(lst, lambda x: abs(x - sma))), lambda a, x: a + x) / len(lst)), 0)
  END AS cci FROM fr2),
ind0 AS (
  SELECT fr3.*, rec.c - fr3.vwap AS pvwap, rec.adx, rec.atr, rec."20D-EMA", rec."50D-EMA", rec."100D-EMA",
         rec.rsi, rec."MACDs_12_26_9", rec."MACDh_12_26_9", rec."DMP_16"
  FROM fr3 JOIN rec ON fr3.ticker = rec.ticker AND fr3.t = rec.t),
ind AS (SELECT *{RSICAT_SQL} FROM ind0)"""


IND_SQL = ind_sql(BARS_DAILY, "bars")


@register("warmup_filled", rounded(
    f"WITH RECURSIVE {IND_SQL} SELECT ticker, t, "
    + ", ".join(f"last_value({q(c)} IGNORE NULLS) {REV} AS {q(c)}" for c in PL.GOLD_DERIVED)
    + " FROM ind", PL.GOLD_DERIVED))
def warmup_filled(spark, sf_dir):
    """W7 over all 22 derived gold columns of the daily bars: NaN -> null,
    then the reference's backward fill of the warm-up rows."""
    ind = PL.indicators(FX.daily_bars(spark, sf_dir))
    return round_doubles(PL.warmup_fill(ind, PL.GOLD_DERIVED, "bfill"))


@register("warmup_filled_long_series", rounded(
    f"WITH RECURSIVE {IND_SQL} SELECT ticker, t, "
    + ", ".join(f"last_value({q(c)} IGNORE NULLS) {REV} AS {q(c)}" for c in PL.GOLD_DERIVED)
    + " FROM ind", PL.GOLD_DERIVED))
def warmup_filled_long_series(spark, sf_dir):
    """All 22 derived columns plus the warm-up fill in the block-parallel mode
    (200-row blocks: halo frames, block carries for VWAP and the fill, block
    scans for the recurrences); equals ``warmup_filled``."""
    ind = PL.indicators(FX.daily_bars(spark, sf_dir), mode="blocks", block_rows=200, keep_rn=True)
    out = PL.warmup_fill(ind, PL.GOLD_DERIVED, "bfill", rn="_rn", block_rows=200).drop("_rn")
    return round_doubles(out)


@register("indicators_hourly", rounded(
    f"WITH RECURSIVE {ind_sql(BARS_HOURLY, 'bars')} SELECT ticker, t, "
    + ", ".join(q(c) for c in PL.GOLD_DERIVED) + " FROM ind", PL.GOLD_DERIVED))
def indicators_hourly(spark, sf_dir):
    """The 22 derived columns over hourly bars of the events table (F2):
    the same operators on an intraday series."""
    return round_doubles(PL.indicators(FX.hourly_bars(spark, sf_dir)))


def _silver(spark, sf_dir):
    bars = FX.daily_bars(spark, sf_dir)
    return PL.build_silver(bars, FX.news_articles(spark, sf_dir), FX.TARGETS, FX.PROXIES)


GOLD_COLS = [c for c in SILVER_COLS if c not in ("aggregated_text", "target")] + PL.GOLD_DERIVED + ["target"]


@register("gold_features", rounded(
    f"WITH RECURSIVE {ind_sql(SILVER_SQL + f', sv AS (SELECT * FROM silver WHERE {SILVER_WHERE})', 'sv')},"
    + " wf AS (SELECT ticker, t, "
    + ", ".join(f"last_value({q(c)} IGNORE NULLS) {REV} AS {q(c)}" for c in PL.GOLD_DERIVED)
    + " FROM ind) SELECT " + ", ".join(f"sv.{q(c)}" if c not in PL.GOLD_DERIVED else f"wf.{q(c)}"
                                     for c in GOLD_COLS)
    + " FROM sv JOIN wf ON sv.ticker = wf.ticker AND sv.t = wf.t",
    [c for c in SILVER_DBL] + PL.GOLD_DERIVED))
def gold_features(spark, sf_dir):
    """The gold table without the text embedding: silver, the 22 derived
    columns computed on the silver rows (every recurrence seeded at a
    ticker's first silver row, Q22) and the warm-up fill; SQL-checked."""
    silver = materialise(_silver(spark, sf_dir))
    return round_doubles(PL.build_gold(silver, embed=False))


@register("gold")
def gold(spark, sf_dir):
    """Whole gold layer: silver materialised once (checkpoint in the shared
    folder), indicators, warm-up fill, Word2Vec text embedding; rows-only."""
    silver = materialise(_silver(spark, sf_dir))
    return PL.build_gold(silver)


EMBEDDING = 100


def _features(spark, sf_dir):
    """The whole gold table, embedding expanded, with the last 20% of each ticker's rows held out."""
    g = PL.build_gold(materialise(_silver(spark, sf_dir)), embedding_size=EMBEDDING)
    return materialise(L.hold_out(L.expand_embedding(L.add_ticker_effect(g), EMBEDDING)))


def _fitted(f, booster, params):
    """Model on the rows that are not held out; the last 20% of those steer early stopping."""
    train = L.hold_out(f.filter(~F.col("held")).drop("held"), name="late")
    return L.fit(train, L.feature_columns(f), params, booster, valid="late" if booster == "gbtree" else None)


def _scores(spark, sf_dir, booster, params):
    f = _features(spark, sf_dir)
    return L.score(_fitted(f, booster, params), f.filter("held"))


TREES = {"rounds": 10, "max_depth": 4, "eta": 0.3}


@register("boosted_tree_scores")
def boosted_tree_scores(spark, sf_dir):
    """Gradient-boosted trees over all tickers and all gold columns, with early stopping,
    scored on the held-out last 20% of each ticker; rows-only (``heldout_rows`` checks the rows)."""
    return _scores(spark, sf_dir, "gbtree", TREES)


@register("linear_scores")
def linear_scores(spark, sf_dir):
    """H2, H5: elastic-net linear regression, held-out scores; rows-only."""
    return _scores(spark, sf_dir, "gblinear", {"lambda": 0.1, "alpha": 0.01})


@register("heldout_metrics")
def heldout_metrics(spark, sf_dir):
    """A2 on held-out boosted-tree predictions (Q15: not in-sample); rows-only."""
    pred = boosted_tree_scores(spark, sf_dir)
    return M.regression_metrics(materialise(pred.filter(F.col("y").isNotNull())))


@register("heldout_rows", rounded(
    f"WITH {SILVER_SQL}, sv AS (SELECT * FROM silver WHERE {SILVER_WHERE}), "
    f"pr AS (SELECT ticker, t, target AS y, percent_rank() OVER ({P}) AS pr FROM sv) "
    "SELECT ticker, t, y FROM pr WHERE pr >= 0.8", ["y"]))
def heldout_rows(spark, sf_dir):
    """H5: the (ticker, t, y) that the models are scored on."""
    return round_doubles(L.hold_out(_silver(spark, sf_dir)).filter("held").select(
        "ticker", "t", F.col("target").alias("y")))


#: Rows of a fold (the reference's) and trials of the registered search.
FOLD, TRIALS = 20, 3


@register("param_search")
def param_search(spark, sf_dir):
    """Seeded random search over all rolling folds of ``FOLD`` rows; the trials table; rows-only."""
    f = _features(spark, sf_dir).filter(~F.col("held")).drop("held")
    return L.search_params(f, L.feature_columns(f), trials=TRIALS, window=FOLD, seed=7)[0]


@register("refit_metrics")
def refit_metrics(spark, sf_dir):
    """H3, A2: the linear search's best parameters fitted anew on all training rows; held-out metrics; rows-only."""
    f = _features(spark, sf_dir)
    train, feats = f.filter(~F.col("held")).drop("held"), L.feature_columns(f)
    _, best = L.search_params(train, feats, trials=TRIALS, window=FOLD, seed=7, boosters=("gblinear",))
    model = L.refit(train, feats, best)
    return M.regression_metrics(materialise(L.score(model, f.filter("held"))))


@register("forecast")
def forecast(spark, sf_dir):
    """Fit, save, load, then predict the next 2 exchange days of
    every ticker step by step; rows-only (``forecast_days`` checks the days)."""
    f = _features(spark, sf_dir).drop("held")
    model = L.fit(f, L.feature_columns(f), TREES, "gbtree")
    path = scratch_path(spark, f"model-{uuid.uuid4().hex[:12]}")
    L.save_model(model, path)
    return L.forecast(L.load_model(path), f, 2, holiday_table(spark, HOLIDAYS))


@register("forecast_days", f"""WITH {SILVER_SQL}, sv AS (SELECT * FROM silver WHERE {SILVER_WHERE}),
lastd AS (SELECT ticker, CAST(max(t) AS DATE) AS d0 FROM sv GROUP BY ticker),
cand AS (SELECT ticker, CAST(d0 + INTERVAL (k) DAY AS DATE) AS d FROM lastd, range(1, 60) r(k)),
bd AS (SELECT ticker, CAST(d AS TIMESTAMP) AS t,
              CAST(row_number() OVER (PARTITION BY ticker ORDER BY d) AS INTEGER) AS step
       FROM cand WHERE isodow(d) <= 5 AND d NOT IN {HOL_SQL})
SELECT ticker, t, step, CAST(isodow(t) AS DOUBLE) AS dayofweek, CAST(month(t) AS DOUBLE) AS month,
       CAST(quarter(t) AS DOUBLE) AS quarter FROM bd WHERE step <= 2""")
def forecast_days(spark, sf_dir):
    """The forecast rows' days and calendar features."""
    last = last_row(_silver(spark, sf_dir).select("ticker", "t")
                    .withColumns({c: F.lit(0.0) for c in ("dayofweek", "month", "quarter")}))
    days = next_business_days(last.select("ticker", "t"), 2, holiday_table(spark, HOLIDAYS))
    return carry_forward(last, days).select("ticker", "t", "step", "dayofweek", "month", "quarter")


STEPPED = [c for c in ST.DERIVED if c != "c_class"]
_LAGGED = ", ".join(
    f"lag({x}, {i}) OVER ({P}) AS {x}_lag_{i}" for x in ST.LAGGED for i in range(1, 6)) + ", " + ", ".join(
    f"avg({x}) OVER ({P} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS {x}_rolling_mean, "
    f"stddev_samp({x}) OVER ({P} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS {x}_rolling_std" for x in ST.LAGGED)


@register("appended_days", rounded(
    f"WITH RECURSIVE {IND_SQL}, lg AS (SELECT ticker, t, {_LAGGED} FROM bars), "
    "al AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY t DESC) AS back, "
    "count(*) OVER (PARTITION BY ticker) AS n_rows FROM ind JOIN lg USING (ticker, t)) SELECT ticker, t, "
    + ", ".join(q(c) for c in STEPPED) + " FROM al WHERE back <= 2 AND n_rows >= 36",
    [c for c in STEPPED if not c.startswith("n_lag")]))
def appended_days(spark, sf_dir):
    """The derived columns of each ticker's last two days, from the state before them and the two bars
    alone; equal to those of the whole series (tickers of 36 rows and more, whose recurrences have settled)."""
    bars = materialise(FX.daily_bars(spark, sf_dir))
    w = Window.partitionBy("ticker")
    bars = bars.withColumn("back", F.row_number().over(w.orderBy(F.desc("t")))).withColumn("rows", F.count(F.lit(1)).over(w))
    state = materialise(ST.series_state(bars.filter("back > 2 AND rows >= 36").drop("back", "rows")))
    made, _ = ST.fold(state, bars.filter("back <= 2"), 2)
    return round_doubles(made.select("ticker", "t", *[F.col(f"`{c}`") for c in STEPPED]))


@register("ticker_effects", rounded(
    f"WITH {SILVER_SQL}, sv AS (SELECT * FROM silver WHERE {SILVER_WHERE}) SELECT ticker, t, "
    f"coalesce(sum(target) OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) / "
    f"(count(target) OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 20.0) AS ticker_effect FROM sv",
    ["ticker_effect"]))
def ticker_effects(spark, sf_dir):
    """H1, H2: the ticker as the shrunken mean of its earlier labels."""
    return round_doubles(L.add_ticker_effect(_silver(spark, sf_dir)).select("ticker", "t", "ticker_effect"))


@register("fold_sums", f"""WITH {SILVER_SQL}, sv AS (SELECT * FROM silver WHERE {SILVER_WHERE}),
held AS (SELECT *, percent_rank() OVER ({P}) AS pr FROM sv),
r AS (SELECT *, row_number() OVER ({P}) - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS m FROM held WHERE pr < 0.8),
f AS (SELECT r.*, CAST(rn // 20 AS INTEGER) AS fold, 'train' AS role FROM r WHERE (rn // 20) * 20 < m - 40
      UNION ALL SELECT r.*, CAST(rn // 20 - 1 AS INTEGER) AS fold, 'valid' AS role FROM r
      WHERE rn >= 20 AND (rn // 20 - 1) * 20 < m - 40)
SELECT fold, role, count(*) AS n, round(avg(c), 4) AS mean_c, round(avg(target), 4) AS mean_target,
       round(covar_pop(c, target), 3) AS covariance, round(var_pop(target), 3) AS variance FROM f GROUP BY fold, role""")
def fold_sums(spark, sf_dir):
    """The sums that all linear trials of a search are solved from, for every fold and role: rows, means and
    centred products (here of the close and the label)."""
    df = L.hold_out(_silver(spark, sf_dir)).filter("NOT held")
    rows = rolling_folds(df, FOLD).select("fold", "role", F.array(F.col("c").cast("double"), F.col("target").cast("double")).alias("x"))
    p = S.fold_sums(rows, 64)
    # partial sums of a fold: added up by the definition (rows, means, centred products)
    n = F.sum("n")
    mean = [F.sum(F.col("n") * F.col("mean")[k]) / n for k in (0, 1)]
    product = lambda i, j: (F.sum(F.col("products")[2 * i + j] + F.col("n") * F.col("mean")[i] * F.col("mean")[j]) / n
                            - mean[i] * mean[j])
    return p.groupBy("fold", "role").agg(
        n.alias("n"), F.round(mean[0], 4).alias("mean_c"), F.round(mean[1], 4).alias("mean_target"),
        F.round(product(0, 1), 3).alias("covariance"), F.round(product(1, 1), 3).alias("variance"))
