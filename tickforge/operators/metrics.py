"""Forecast metrics and bands (A2-A5, H7).

Directional accuracy compares with the means of y and of the prediction, which
come from a first aggregation joined back by key (one row per key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions import safe_div
from tickforge.operators.quantiles import exact_quantiles

KEY = "ticker"
# Fixed values of the combined metric: epsilon of the R^2 denominator; weights of MAE and R^2.
EPS, MAE_WEIGHT, R2_WEIGHT = 1e-7, 0.5, 1.5


def _with_means(df: DataFrame, y: str, yhat: str, by: str) -> DataFrame:
    """Attach the per-key means (a per-key table joined back by key; pass a
    constant key column for one global figure)."""
    m = df.groupBy(by).agg(F.avg(y).alias("_ybar"), F.avg(yhat).alias("_phbar"))
    return df.join(m, by, "left")


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: str = KEY) -> DataFrame:
    """RMSE, MAE, R^2 = 1 - SSE / SST with SST = n * var_pop(y), median absolute error.

    One grouped aggregation; the median is an exact quantile by range sort, which gathers no
    key in one task (``operators.quantiles``).  ``df`` is read twice."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - safe_div(F.sum(e * e), F.count(y) * F.var_pop(y))).alias("r2"))
    med = exact_quantiles(df, by, F.abs(e), [0.5], ["medae"])
    return g.join(med, by, "left")


def mape(df: DataFrame, y: str = "y", yhat: str = "yhat", by: str = KEY) -> DataFrame:
    """Mean absolute percentage error; rows with y = 0 are skipped (null)."""
    a = (F.avg(F.abs(safe_div(F.col(y) - F.col(yhat), F.col(y)))) * F.lit(100.0)).alias("mape")
    return df.groupBy(by).agg(a)


def _direction_hit(y: str, yhat: str):
    return F.when(F.signum(F.col(y) - F.col("_ybar")) == F.signum(F.col(yhat) - F.col("_phbar")),
                  F.lit(1.0)).otherwise(F.lit(0.0))


def directional_accuracy(df: DataFrame, y: str = "y", yhat: str = "yhat", by: str = KEY) -> DataFrame:
    """Share of rows where sign(y - mean y) equals sign(yhat - mean yhat)."""
    x = _with_means(df, y, yhat, by)
    a = F.avg(_direction_hit(y, yhat)).alias("directional_accuracy")
    return x.groupBy(by).agg(a)


def combined_metric(df: DataFrame, y: str = "y", yhat: str = "yhat", by: str = KEY) -> DataFrame:
    """rmse/range + 0.5 mae/range - 1.5 R^2 - directional accuracy, with
    R^2 = 1 - SSE / (SST + 1e-7) and range = max y - min y (A5)."""
    x = _with_means(df, y, yhat, by)
    e = F.col(y) - F.col(yhat)
    parts = [F.sqrt(F.avg(e * e)).alias("_rmse"), F.avg(F.abs(e)).alias("_mae"),
             F.sum(e * e).alias("_sse"), F.sum((F.col(y) - F.col("_ybar")) ** 2).alias("_sst"),
             F.avg(_direction_hit(y, yhat)).alias("_da"), (F.max(y) - F.min(y)).alias("_rng")]
    g = x.groupBy(by).agg(*parts)
    r2 = F.lit(1.0) - F.col("_sse") / (F.col("_sst") + F.lit(EPS))
    comb = (safe_div(F.col("_rmse"), F.col("_rng")) + F.lit(MAE_WEIGHT) * safe_div(F.col("_mae"), F.col("_rng"))
            - F.lit(R2_WEIGHT) * r2 - F.col("_da"))
    return g.select(by, comb.alias("combined_metric"))


def prediction_band(df: DataFrame, yhat: str = "yhat", pct: float = 0.95) -> DataFrame:
    """yhat * (1 - pct), yhat * (1 + pct): the reference's 'confidence' band."""
    return df.select("*", (F.col(yhat) * F.lit(1.0 - pct)).alias("lower"),
                     (F.col(yhat) * F.lit(1.0 + pct)).alias("upper"))


def residual_band(df: DataFrame, y: str = "y", yhat: str = "yhat", lo: float = 0.05,
                  hi: float = 0.95, by: str = KEY) -> DataFrame:
    """yhat plus the per-key lo / hi quantiles of the residuals y - yhat (exact, by range sort)."""
    q = exact_quantiles(df, by, F.col(y) - F.col(yhat), [lo, hi], ["_qlo", "_qhi"])
    j = df.join(q, by, "left")
    return j.select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col(yhat) + F.col("_qlo")).alias("lower"), (F.col(yhat) + F.col("_qhi")).alias("upper"))
