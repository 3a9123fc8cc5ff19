"""Frame indicators, text operators, model preparation and metrics."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, bars_df
from tickforge.operators import frames as FR
from tickforge.operators import prep as PR
from tickforge.operators import text as X
from tickforge.plans import pipeline as PL
from tickforge.sources import fixtures as FX


def test_indicator_bounds(spark):
    ind = PL.indicators(FX.daily_bars(spark, SF0001))
    e = 1e-9
    bad = ind.filter((F.col("williams_r") < -100 - e) | (F.col("williams_r") > e) |
                     (F.col("stoch_k") < -e) | (F.col("stoch_k") > 100 + e) |
                     (F.col("rsi") < 0) | (F.col("rsi") > 100) |
                     (F.col("bollinger_lband") > F.col("bollinger_mavg") + 1e-9) |
                     (F.col("bollinger_mavg") > F.col("bollinger_hband") + 1e-9))
    assert bad.count() == 0
    assert ind.filter(F.col("dayofweek").between(1, 7)).count() == ind.count()


def test_rsicat_bins(spark):
    df = spark.createDataFrame([(0.0,), (29.99,), (30.0,), (69.9,), (70.0,), (99.9,), (100.0,), (None,)],
                               "rsi double")
    got = [r[0] for r in df.select(FR.rsi_category("rsi")).collect()]
    assert got == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0, None, None]


def test_no_lookahead_with_null_warmup(spark):
    bars = FX.daily_bars(spark, SF0001).filter(F.col("ticker") == "Brand#1")
    cut = dt.datetime(1998, 6, 30)
    full = PL.warmup_fill(PL.indicators(bars), PL.GOLD_DERIVED, "null")
    part = PL.warmup_fill(PL.indicators(bars.filter(F.col("t") <= cut)), PL.GOLD_DERIVED, "null")
    a = {r["t"]: r for r in full.filter(F.col("t") <= cut).collect()}
    b = {r["t"]: r for r in part.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in PL.GOLD_DERIVED:
            assert a[k][c] == b[k][c] or (a[k][c] is not None and a[k][c] == pytest.approx(b[k][c]))


def test_tokenizer_edge_cases(spark):
    df = spark.createDataFrame([(1, " "), (2, "Hello  World\n"), (3, "The cat and THE dog")], "id int, s string")
    toks = {r["id"]: r["tk"] for r in X.tokenize(df, "s", "tk").collect()}
    assert toks[1] == [] and toks[2] == ["hello", "", "world"]
    f = {r["id"]: r["f"] for r in X.remove_stopwords(X.tokenize(df, "s", "tk"), "tk", "f").collect()}
    assert f[3] == ["cat", "dog"]
    assert "the" in X.english_stopwords() and len(X.english_stopwords()) == 181


def test_embedding_shape_and_determinism(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, " "), (3, "beta delta alpha")], "id int, s string")
    a = {r["id"]: r["e"] for r in X.embed_text(df, "s", "e", size=8).collect()}
    b = {r["id"]: r["e"] for r in X.embed_text(df, "s", "e", size=8).collect()}
    assert all(len(v) == 8 for v in a.values())
    assert a[2] == [0.0] * 8
    assert a == b


def test_scaling_roundtrip_and_constant(spark):
    df = spark.createDataFrame([("A", 1.0, 5.0), ("A", 3.0, 5.0), ("B", 2.0, 1.0), ("B", 6.0, 2.0)],
                               "ticker string, x double, k double")
    st_ = PR.minmax_fit(df, ["x", "k"])
    s = PR.minmax_scale(df, ["x", "k"], st_)
    rows = s.collect()
    assert {r["k"] for r in rows if r["ticker"] == "A"} == {0.0}
    back = PR.inverse_minmax(s, ["x", "k"], st_).orderBy("ticker", "x").collect()
    assert [r["x"] for r in back] == [1.0, 3.0, 2.0, 6.0]


def test_sequences_shape(spark):
    df = bars_df(spark, [(i, 1, 2, 0, 1 + i) for i in range(10)]).withColumn("target", F.col("c") * 1.0)
    seqs = PR.sequences(df, ["o", "c"], "target", 5).orderBy("seq_idx").collect()
    assert len(seqs) == 10 - 5                       # rows 4..8 (the last row is never a label)
    assert all(len(r["X"]) == 4 and len(r["X"][0]) == 2 for r in seqs)
    assert seqs[0]["y"] == 5.0 and seqs[0]["X"][-1][1] == 4.0


def test_rolling_folds(spark):
    df = bars_df(spark, [(i, 1, 1, 1, 1) for i in range(100)])
    f = PR.rolling_folds(df, 20)
    folds = {(r["fold"], r["role"]): r["n"] for r in f.groupBy("fold", "role").agg(F.count("*").alias("n")).collect()}
    assert sorted({k[0] for k in folds}) == [0, 1, 2]    # starts 0, 20, 40 < 100 - 40
    assert all(v == 20 for v in folds.values())


def test_last_k_and_last_row(spark):
    df = bars_df(spark, [(i, 1, 1, 1, i) for i in range(30)])
    assert PR.last_row(df).collect()[0]["c"] == 29.0
    assert sorted(r["c"] for r in PR.last_k(df, 3).collect()) == [27.0, 28.0, 29.0]


def test_metrics_known_values(spark):
    from tickforge.operators import metrics as M
    rnd = random.Random(1)
    ys = [rnd.uniform(-1, 1) for _ in range(50)]
    ps = [y + rnd.uniform(-0.1, 0.1) for y in ys]
    df = spark.createDataFrame([("A", y, p) for y, p in zip(ys, ps)], "ticker string, y double, yhat double")
    r = M.regression_metrics(df).collect()[0]
    import statistics
    e = [y - p for y, p in zip(ys, ps)]
    assert r["rmse"] == pytest.approx((sum(x * x for x in e) / 50) ** 0.5)
    assert r["mae"] == pytest.approx(sum(abs(x) for x in e) / 50)
    assert r["medae"] == pytest.approx(statistics.median(abs(x) for x in e))
    ybar = sum(ys) / 50
    assert r["r2"] == pytest.approx(1 - sum(x * x for x in e) / sum((y - ybar) ** 2 for y in ys))


def test_business_days_skip_weekend_and_holiday(spark):
    from tickforge.operators import forecast as FC
    last = spark.createDataFrame([("A", dt.datetime(2001, 11, 21))], "ticker string, t timestamp_ntz")
    got = [r["t"].date().isoformat() for r in
           FC.next_business_days(last, 3, FC.holiday_table(spark, FC.HOLIDAYS)).orderBy("step").collect()]
    assert got == ["2001-11-23", "2001-11-26", "2001-11-27"]   # 22nd is a holiday, 24-25 weekend


def test_input_order_irrelevant(spark):
    bars = FX.daily_bars(spark, SF0001).filter(F.col("ticker").isin("Brand#1", "Brand#2"))
    shuffled = bars.repartition(7, F.rand(5)).sortWithinPartitions(F.rand(9))
    a = sorted(PL.indicators(bars).collect())
    b = sorted(PL.indicators(shuffled).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c in PL.GOLD_DERIVED:
            assert x[c] == y[c] or (x[c] is not None and x[c] == pytest.approx(y[c], rel=1e-12))


def test_adding_a_ticker_changes_no_other_series(spark):
    bars = FX.daily_bars(spark, SF0001)
    one = bars.filter(F.col("ticker") == "Brand#3")
    both = bars.filter(F.col("ticker").isin("Brand#3", "Brand#9"))
    a = {r["t"]: r for r in PL.indicators(one).collect()}
    b = {r["t"]: r for r in PL.indicators(both).filter(F.col("ticker") == "Brand#3").collect()}
    assert a == b


def test_blocks_mode_folds_equal_key_mode(spark):
    bars = FX.daily_bars(spark, SF0001).select("ticker", "t")
    a = sorted(PR.rolling_folds(bars, 20).collect())
    b = sorted(PR.rolling_folds(bars, 20, mode="blocks").select(*PR.rolling_folds(bars, 20).columns).collect())
    assert a == b


def test_exact_quantiles_equal_percentile(spark):
    from tickforge.operators.quantiles import exact_quantiles
    rnd = random.Random(4)
    rows = [("hot", float(rnd.choice([0, 0, 0, 1, 2, 3.5]) + rnd.random() * (i % 3 == 0))) for i in range(3000)]
    rows += [("b", rnd.uniform(-5, 5)) for _ in range(101)] + [("c", 7.0)] + [("d", 1.0), ("d", 2.0)]
    rows += [("e", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    qs = [0.05, 0.5, 0.95]
    got = {r["k"]: r for r in exact_quantiles(df, "k", "x", qs, ["a", "m", "z"], partitions=8).collect()}
    exp = {r["k"]: r for r in df.groupBy("k").agg(
        F.percentile("x", 0.05).alias("a"), F.percentile("x", 0.5).alias("m"),
        F.percentile("x", 0.95).alias("z")).collect()}
    assert set(got) == {k for k in exp if exp[k]["m"] is not None}
    for k in got:
        for c in "amz":
            assert got[k][c] == exp[k][c], (k, c)


def test_metrics_sort_median_equals_percentile(spark):
    from tickforge.operators import metrics as M
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.choice("AB"), rnd.uniform(-1, 1), rnd.uniform(-1, 1)) for _ in range(400)],
                               "ticker string, y double, yhat double")
    a = {r["ticker"]: r["m"] for r in df.groupBy("ticker").agg(F.percentile(F.abs(F.col("y") - F.col("yhat")), 0.5).alias("m")).collect()}
    b = {r["ticker"]: r["medae"] for r in M.regression_metrics(df).collect()}
    assert a == b


def test_rule_calendar_knows_holidays_and_counts_open_days(spark):
    import datetime as d
    import pytest
    from tickforge.operators import exchange as EX
    from tickforge.operators.forecast import HOLIDAYS
    by_rule = {r["d"].isoformat() for r in EX.holidays(spark, 2001, 2002).collect()}
    assert by_rule == {h for h in HOLIDAYS if not "2001-09-11" <= h <= "2001-09-14"}
    known = {2021: "2021-04-02", 2024: "2024-03-29", 2038: "2038-04-23", 1954: "1954-04-16"}
    for y, good_friday in known.items():
        assert good_friday in {r["d"].isoformat() for r in EX.holidays(spark, y, y).collect()}
    assert "2021-12-31" not in {r["d"].isoformat() for r in EX.holidays(spark, 2021, 2022).collect()}    # a Saturday's New Year
    days = EX.calendar(spark, 2000, 2003, ["2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14"])
    rows = days.orderBy("d").collect()
    n = 0
    for r in rows:
        n += r["open"]
        assert r["ordinal"] == n
    assert len(rows) == 1461 and sum(r["open"] for r in rows if r["d"].year == 2001) == 248
    last = spark.createDataFrame([("A", d.datetime(2001, 9, 10)), ("B", d.datetime(2001, 9, 15))], "ticker string, t timestamp_ntz")
    got = {(r["ticker"], r["step"]): r["t"].date().isoformat() for r in EX.next_open_days(last, 2, days).collect()}
    assert got == {("A", 1): "2001-09-17", ("A", 2): "2001-09-18", ("B", 1): "2001-09-17", ("B", 2): "2001-09-18"}
    with pytest.raises(Exception, match="more years"):
        EX.next_open_days(last, 900, days).collect()
