"""Bars, fills, targets and the silver pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, bars_df
from tickforge.operators import bars as B
from tickforge.plans import pipeline as PL
from tickforge.sources import fixtures as FX


def _series(spark, vals):
    data = [("A", dt.datetime(2020, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    return spark.createDataFrame(data, "ticker string, t timestamp_ntz, x double")


def test_ffill_bfill_nulls(spark):
    df = _series(spark, [None, None, 1.0, None, 3.0, None, None])
    f = [r["x"] for r in B.ffill(df, ["x"]).orderBy("t").collect()]
    assert f == [None, None, 1.0, 1.0, 3.0, 3.0, 3.0]
    b = [r["x"] for r in B.bfill(df, ["x"]).orderBy("t").collect()]
    assert b == [1.0, 1.0, 1.0, 3.0, 3.0, None, None]
    both = [r["x"] for r in PL.fill_both(df, ["x"]).orderBy("t").collect()]
    assert both == [1.0, 1.0, 1.0, 1.0, 3.0, 3.0, 3.0]


def test_ffill_idempotent(spark):
    df = _series(spark, [None, 2.0, None, None, 5.0, None])
    once = B.ffill(df, ["x"])
    twice = B.ffill(once, ["x"])
    assert once.orderBy("t").collect() == twice.orderBy("t").collect()


def test_nan_is_not_null_for_fill(spark):
    df = _series(spark, [1.0, float("nan"), None])
    f = [r["x"] for r in B.ffill(df, ["x"]).orderBy("t").collect()]
    assert f[0] == 1.0 and f[1] != f[1] and f[2] != f[2]   # NaN carried: callers map NaN -> null first


def test_targets_and_rolling(spark):
    df = bars_df(spark, [(i, 10, 12, 9, 10 + i) for i in range(8)])
    out = B.add_rolling_stats(B.add_targets(df), ["c"], 5).orderBy("t").collect()
    assert out[0]["target"] == pytest.approx(1.0) and out[-1]["target"] is None
    assert out[0]["c_rolling_mean"] is None and out[1]["c_rolling_std"] is None
    assert out[2]["c_rolling_std"] == pytest.approx(0.70710678, rel=1e-6)
    assert out[6]["c_rolling_mean"] == pytest.approx(13.0)   # rows 1..5


def test_resample_open_close_ties(spark):
    data = [("A", dt.datetime(2020, 1, 1, 9), 1, 5.0), ("A", dt.datetime(2020, 1, 1, 9), 1, 3.0),
            ("A", dt.datetime(2020, 1, 1, 10), 2, 4.0)]
    ticks = spark.createDataFrame(data, "k string, ts timestamp_ntz, id long, px double").withColumn("q", F.lit(2.0))
    r = B.resample_bars(ticks, "k", "ts", "px", "q", "day", ["ts", "id"]).collect()[0]
    assert (r["o"], r["c"], r["h"], r["l"], r["v"], r["n"]) == (3.0, 4.0, 5.0, 3.0, 6.0, 3)
    assert r["vw"] == pytest.approx(4.0)


def test_missing_proxy_fails_early(spark):
    bars = FX.daily_bars(spark, SF0001)
    with pytest.raises(ValueError, match="without rows"):
        PL.build_silver(bars, None, FX.TARGETS, FX.PROXIES + ["NOPE"], check_proxies=True)


def test_silver_shape(spark):
    bars = FX.daily_bars(spark, SF0001)
    s = PL.build_silver(bars, FX.news_articles(spark, SF0001), FX.TARGETS, FX.PROXIES)
    assert s.columns[-1] == "target"
    assert len([c for c in s.columns if c.startswith("Brand#")]) == 77
    n = s.count()
    assert n > 0
    assert s.dropna().count() == n


def test_daily_text_order_and_nulls(spark):
    from tickforge.operators.news import daily_text
    rows = [("X", "2020-01-02T15:00:00Z", "late", "second\nline", ["k1", None], 2),
            ("X", "2020-01-02T09:00:00Z", "early", None, None, 7),
            ("X", "2020-01-03T09:00:00Z", None, None, None, 1)]
    news = spark.createDataFrame(rows, "search_ticker string, published_utc string, title string, "
                                       "description string, keywords array<string>, id long")
    got = {r["t"].day: r["aggregated_text"] for r in daily_text(news).collect()}
    # earlier article first; null fields and null keywords skipped (a null keyword
    # list joins to ''), newline -> space
    assert got[2] == " early second line k1 late"
    assert got[3] == ""


def test_own_nulls_are_filled(spark):
    rows = [(i, 10.0, 12.0, 9.0, 10.0 + i) for i in range(30)]
    bars = bars_df(spark, rows).unionByName(bars_df(spark, rows, "P"))
    holed = bars.withColumn("c", F.when((F.col("ticker") != "A") | (F.dayofmonth("t") != 15), F.col("c")))
    for mode in ("key", "blocks"):
        s = PL.build_silver(holed, None, None, ["P"], mode=mode, block_rows=7)
        assert s.count() == 24 and s.filter(F.dayofmonth("t") == 15).first()["c"] == 10.0 + 13


def test_silver_without_lookahead(spark):
    """Without the backward fill no value depends on later rows: cutting the series keeps earlier rows."""
    bars = bars_df(spark, [(i, 10.0, 12.0, 9.0, 10.0 + i) for i in range(30)]).unionByName(
        bars_df(spark, [(i, 1.0, 2.0, 0.5, 1.0 + i) for i in range(10, 30)], "P"))
    whole = PL.build_silver(bars, None, None, ["P"], bfill=False)
    cut = PL.build_silver(bars.filter(F.dayofmonth("t") <= 20), None, None, ["P"], bfill=False)
    late = PL.build_silver(bars, None, None, ["P"])
    assert late.count() == 24 and whole.count() == 19     # the proxy starts on day 11
    a = {r["t"]: r for r in whole.collect()}
    assert cut.count() > 0 and all(a[r["t"]] == r for r in cut.collect())


def test_absent_proxy_raises_by_default(spark):
    with pytest.raises(ValueError, match="without rows"):
        PL.build_silver(bars_df(spark, [(i, 1, 2, 0.5, 1.5) for i in range(20)]), None, None, ["NOPE"])


def test_malformed_publication_time(spark):
    from tickforge.operators.news import daily_text
    rows = [("X", "not a time", "a", "b", None, 1), ("X", "2020-01-02T09:00:00Z", "c", "d", None, 2)]
    news = spark.createDataFrame(rows, "search_ticker string, published_utc string, title string, "
                                       "description string, keywords array<string>, id long")
    assert {r["t"] and r["t"].day: r["aggregated_text"].strip() for r in daily_text(news).collect()} == {None: "b  a", 2: "d  c"}


def test_ticks_are_scanned_once(spark):
    """One materialised bar table feeds targets, proxies and the check."""
    s = PL.build_silver(FX.daily_bars(spark, SF0001), None, FX.TARGETS, FX.PROXIES)
    assert "lineitem" not in s._jdf.queryExecution().executedPlan().toString()


def test_texts_stay_out_of_the_ticker_windows(spark):
    """Texts meet the rows by (ticker, day) above every window and are not broadcast: no task holds a ticker's whole text."""
    bars = bars_df(spark, [(i, 10.0, 12.0, 9.0, 10.0 + i) for i in range(30)]).unionByName(
        bars_df(spark, [(i, 1.0, 2.0, 0.5, 1.0 + i) for i in range(30)], "P"))
    news = spark.createDataFrame([("A", "2020-01-20T15:00:00Z", "a title", "a text", ["k"], 1)],
                                 "search_ticker string, published_utc string, title string, description string, "
                                 "keywords array<string>, id long")
    for mode in ("key", "blocks"):
        s = PL.build_silver(bars, news, None, ["P"], mode=mode, block_rows=7)
        assert {r["t"].day: r["aggregated_text"] for r in s.collect()} == {
            d: "a text k a title" if d == 20 else " " for d in range(6, 30)}
        plan = s._jdf.queryExecution().optimizedPlan().toString().splitlines()
        text = next(i for i, x in enumerate(plan) if "Join" in x and "LeftOuter" in x)
        assert not any("Window" in x for x in plan[:text]) and any("Window" in x for x in plan[text:])
        ran = s._jdf.queryExecution().executedPlan().toString().splitlines()
        assert "SortMergeJoin" in next(x for x in ran if "Join [" in x)
