"""Recurrences: hand-worked values, edge cases, and block scan == per-key scan."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import bars_df
from tickforge.operators import recurrence as R


def _ema_py(xs, w):
    a = 2.0 / (w + 1)
    out, y = [], None
    for i, x in enumerate(xs):
        y = x if i == 0 else (1 - a) * y + a * x
        out.append(y if i >= w - 1 else None)
    return out


def _col(df, c):
    return [r[c] for r in df.orderBy("t").collect()]


def test_ema_hand_worked(spark):
    closes = [10, 11, 12, 11, 13, 14, 13, 15, 16, 15]
    df = bars_df(spark, [(i, c, c, c, c) for i, c in enumerate(closes)])
    out = R.add_ema(df, windows=(3,), names=["ema3"])
    got = _col(out, "ema3")
    exp = _ema_py(closes, 3)
    assert got[:2] == [None, None]
    for g, e in zip(got[2:], exp[2:]):
        assert g == pytest.approx(e, rel=1e-12)


def test_rsi_monotone_and_flat(spark):
    up = bars_df(spark, [(i, 10 + i, 10 + i, 10 + i, 10 + i) for i in range(20)])
    r = _col(R.add_rsi(up), "rsi")
    assert r[:13] == [None] * 13
    assert all(x == 100.0 for x in r[13:])          # no losses: D = 0 -> 100
    flat = bars_df(spark, [(i, 5, 5, 5, 5) for i in range(20)])
    assert all(x == 100.0 for x in _col(R.add_rsi(flat), "rsi")[13:])


def test_rsi_bounds_and_known_value(spark):
    closes = [44.34, 44.09, 44.15, 43.61, 44.33, 44.83, 45.10, 45.42, 45.84, 46.08, 45.89, 46.03,
              45.61, 46.28, 46.28, 46.00, 46.03, 46.41, 46.22, 45.64]
    df = bars_df(spark, [(i, c, c, c, c) for i, c in enumerate(closes)])
    got = _col(R.add_rsi(df), "rsi")
    # plain-Python Wilder EMA of gains / losses, alpha = 1/14, seeded at row 0
    up = dn = 0.0
    exp = []
    for i, c in enumerate(closes):
        d = 0.0 if i == 0 else c - closes[i - 1]
        g, lo = max(d, 0.0), max(-d, 0.0)
        up, dn = (g, lo) if i == 0 else ((13 / 14) * up + g / 14, (13 / 14) * dn + lo / 14)
        exp.append(None if i < 13 else (100.0 if dn == 0 else 100 - 100 / (1 + up / dn)))
    for g, e in zip(got, exp):
        assert (g is None and e is None) or g == pytest.approx(e, rel=1e-12)
    assert all(0 <= x <= 100 for x in got if x is not None)


def test_atr_adx_flat_prices(spark):
    df = bars_df(spark, [(i, 5, 5, 5, 5) for i in range(40)])
    out = R.add_technical_recurrences(df).orderBy("t").collect()
    assert [r["atr"] for r in out[13:]] == [0.0] * 27          # zero range
    assert all(r["adx"] is None for r in out)                   # x/0 -> null, never NaN
    assert all(r["DMP_16"] is None for r in out)


def test_short_series_all_null(spark):
    df = bars_df(spark, [(i, 1 + i, 2 + i, i, 1 + i) for i in range(5)])
    out = R.add_technical_recurrences(df).collect()
    for r in out:
        for c in ("20D-EMA", "rsi", "atr", "adx", "MACDs_12_26_9"):
            assert r[c] is None


def test_single_row(spark):
    df = bars_df(spark, [(0, 1, 2, 0.5, 1.5)])
    out = R.add_ema(df, windows=(1,), names=["e1"]).collect()
    assert out[0]["e1"] == 1.5


@pytest.mark.parametrize("block_rows", [1, 3, 7, 64])
def test_block_scan_equals_key_scan(spark, block_rows):
    rnd = random.Random(block_rows)
    rows = []
    for tk in ("A", "B", "C"):
        n = rnd.randint(1, 60)
        for i in range(n):
            c = 50 + rnd.uniform(-5, 5)
            rows.append((tk, i, c))
    import datetime as dt
    df = spark.createDataFrame([(tk, dt.datetime(2021, 1, 1) + dt.timedelta(days=i), c, c + 1, c - 1, c, 1.0)
                                for tk, i, c in rows],
                               "ticker string, t timestamp_ntz, o double, h double, l double, c double, v double")
    a = {(r["ticker"], r["t"]): r for r in R.add_technical_recurrences(df).collect()}
    b = {(r["ticker"], r["t"]): r for r in
         R.add_technical_recurrences(df, mode="blocks", block_rows=block_rows).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in R.TECH_OUT:
            x, y = a[k][c], b[k][c]
            assert (x is None) == (y is None), (k, c)
            if x is not None:
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9), (k, c)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.5, 0.9, 1.0]), st.floats(-100, 100)), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=10))
def test_affine_scan_block_property(spark, ab, m):
    import datetime as dt
    data = [("k", dt.datetime(2020, 1, 1) + dt.timedelta(days=i), a, b) for i, (a, b) in enumerate(ab)]
    df = spark.createDataFrame(data, "ticker string, t timestamp_ntz, a double, b double")
    seq, y = [], 0.0
    for a, b in ab:
        y = b if a == 0.0 else a * y + b
        seq.append(y)
    numbered = R.with_row_numbers(df, col="rn", method="buckets", span=86400.0 * 3)
    out = R.affine_scan(numbered, {"y": ("a", "b")}, mode="blocks", block_rows=m, rn="rn", fanout=2)
    got = [r["y"] for r in out.orderBy("t").collect()]
    for g, e in zip(got, seq):
        assert g == pytest.approx(e, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("method", ["range", "buckets"])
def test_row_numbers_dense_and_ordered(spark, method):
    import datetime as dt
    # a hot key (A: 600 rows, half of them in one burst day) next to a small one
    data = [("A", dt.datetime(2020, 1, 1) + dt.timedelta(seconds=60 * i)) for i in range(300)]
    data += [("A", dt.datetime(2020, 2, 1) + dt.timedelta(days=i)) for i in range(300)]
    data += [("B", dt.datetime(2020, 1, 1) + dt.timedelta(days=7 * i)) for i in range(40)]
    df = spark.createDataFrame(data, "ticker string, t timestamp_ntz").repartition(5)
    out = R.with_row_numbers(df, method=method, partitions=6, span=86400.0 * 30)
    for tk, n in (("A", 600), ("B", 40)):
        rows = out.filter(F.col("ticker") == tk).orderBy("t").collect()
        assert [r["rn"] for r in rows] == list(range(n))


def _same(a, b, cols):
    assert a.keys() == b.keys()
    for k in a:
        for c in cols:
            x, y = a[k][c], b[k][c]
            assert (x is None) == (y is None), (k, c)
            if isinstance(x, float):
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9), (k, c)
            else:
                assert x == y, (k, c)


@pytest.mark.parametrize("block_rows", [19, 50])
def test_blocks_mode_indicators_equal_key_mode(spark, block_rows):
    from conftest import SF0001
    from tickforge.plans import pipeline as PL
    from tickforge.sources import fixtures as FX
    bars = FX.daily_bars(spark, SF0001).filter(F.col("ticker").isin("Brand#1", "Brand#7"))
    a = {(r["ticker"], r["t"]): r for r in
         PL.warmup_fill(PL.indicators(bars), PL.GOLD_DERIVED).collect()}
    ind = PL.indicators(bars, mode="blocks", block_rows=block_rows, keep_rn=True)
    b = {(r["ticker"], r["t"]): r for r in
         PL.warmup_fill(ind, PL.GOLD_DERIVED, rn="_rn", block_rows=block_rows).collect()}
    _same(a, b, PL.GOLD_DERIVED)


def test_blocks_mode_silver_equals_key_mode(spark):
    from conftest import SF0001
    from tickforge.plans import pipeline as PL
    from tickforge.sources import fixtures as FX
    bars = FX.daily_bars(spark, SF0001)
    news = FX.news_articles(spark, SF0001)
    k = PL.build_silver(bars, news, FX.TARGETS, FX.PROXIES)
    b = PL.build_silver(bars, news, FX.TARGETS, FX.PROXIES, mode="blocks", block_rows=40)
    assert k.columns == b.columns
    _same({(r["ticker"], r["t"]): r for r in k.collect()},
          {(r["ticker"], r["t"]): r for r in b.collect()}, k.columns)


def test_halo_larger_than_block_is_rejected(spark):
    from tickforge.operators.blocks import with_halo
    df = spark.createDataFrame([(1, 0)], "x int, rn long")
    with pytest.raises(ValueError):
        with_halo(df, "rn", 10, back=19)


def _wilder_py(h, l, c, n=14):
    """Plain-Python textbook Wilder ATR / +DI / ADX, the definitions the
    operators implement (seeds: mean of the first n values)."""
    m = len(c)
    tr = [h[0] - l[0]] + [max(h[i] - l[i], abs(h[i] - c[i - 1]), abs(l[i] - c[i - 1])) for i in range(1, m)]
    pdm, mdm = [0.0], [0.0]
    for i in range(1, m):
        up, dn = h[i] - h[i - 1], l[i - 1] - l[i]
        pdm.append(up if up > dn and up > 0 else 0.0)
        mdm.append(dn if dn > up and dn > 0 else 0.0)
    a = 1.0 / n

    def smooth(x, seed_row, lo):
        out = [None] * m
        if m > seed_row:
            out[seed_row] = sum(x[lo:seed_row + 1]) / (seed_row + 1 - lo)
            for i in range(seed_row + 1, m):
                out[i] = (1 - a) * out[i - 1] + a * x[i]
        return out

    atr = smooth(tr, n - 1, 0)
    trw, pw, mw = smooth(tr, n, 1), smooth(pdm, n, 1), smooth(mdm, n, 1)
    pdi = [None if t is None or t == 0 else 100 * p / t for p, t in zip(pw, trw)]
    mdi = [None if t is None or t == 0 else 100 * q / t for q, t in zip(mw, trw)]
    dx = [None if p is None or q is None or p + q == 0 else 100 * abs(p - q) / (p + q) for p, q in zip(pdi, mdi)]
    adx = [None] * m
    if m > 2 * n - 1 and all(d is not None for d in dx[n:2 * n]):
        adx[2 * n - 1] = sum(dx[n:2 * n]) / n
        for i in range(2 * n, m):
            adx[i] = (1 - a) * adx[i - 1] + a * dx[i]
    return atr, pdi, adx


def test_atr_adx_hand_worked(spark):
    rnd = random.Random(11)
    c, h, l = [], [], []
    px = 100.0
    for _ in range(45):
        px += rnd.uniform(-2, 2)
        lo, hi = px - rnd.uniform(0, 1.5), px + rnd.uniform(0, 1.5)
        c.append(px), h.append(hi), l.append(lo)
    df = bars_df(spark, [(i, c[i], h[i], l[i], c[i]) for i in range(45)])
    out = R.add_technical_recurrences(df).orderBy("t").collect()
    atr, pdi, adx = _wilder_py(h, l, c)
    for r, x, p, d in zip(out, atr, pdi, adx):
        for got, exp in ((r["atr"], x), (r["DMP_16"], p), (r["adx"], d)):
            assert (got is None) == (exp is None)
            if exp is not None:
                assert got == pytest.approx(exp, rel=1e-9)


def test_window_minus_one_rows(spark):
    df = bars_df(spark, [(i, 1 + i, 2 + i, i, 1 + i) for i in range(13)])
    assert all(r["rsi"] is None for r in R.add_rsi(df).collect())
    df19 = bars_df(spark, [(i, 1, 1, 1, 1 + i) for i in range(19)])
    assert all(r["20D-EMA"] is None for r in R.add_ema(df19).collect())


def test_blocks_mode_gold_equals_key_mode(spark):
    from conftest import SF0001
    from tickforge.plans import pipeline as PL
    from tickforge.sources import fixtures as FX
    silver = PL.build_silver(FX.daily_bars(spark, SF0001), None, ["Brand#1", "Brand#2"], FX.PROXIES).checkpoint(eager=True)
    k = PL.build_gold(silver, embed=False)
    b = PL.build_gold(silver, embed=False, mode="blocks", block_rows=40)
    assert sorted(k.columns) == sorted(b.columns)
    _same({(r["ticker"], r["t"]): r for r in k.collect()},
          {(r["ticker"], r["t"]): r for r in b.collect()}, PL.GOLD_DERIVED + ["target"])


@pytest.mark.parametrize("fanout", [2, 1024])
def test_null_stays_until_the_next_reset_in_both_modes(spark, fanout):
    """A null input, thousands of steps whose coefficients' product underflows to 0, then a reset."""
    n = 6000
    a = [0.0] + [0.5] * (n - 1)
    b = [1.0] * n
    b[100], a[5000], b[5000] = None, 0.0, 7.0
    df = spark.createDataFrame([("A", i, a[i], b[i]) for i in range(n)], "ticker string, t long, a double, b double")
    key = {r["t"]: r["y"] for r in R.affine_scan(df, {"y": ("a", "b")}).collect()}
    blocks = {r["t"]: r["y"] for r in R.affine_scan(df, {"y": ("a", "b")}, mode="blocks", block_rows=64, rn="t",
                                                    fanout=fanout).collect()}
    assert all(key[i] is None for i in range(100, 5000)) and key[99] is not None and key[5000] == 7.0
    assert all((blocks[i] is None) == (key[i] is None) for i in range(n))
    assert all(blocks[i] == pytest.approx(key[i], rel=1e-12) for i in range(n) if key[i] is not None)


def test_scan_kernel_equals_a_loop():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 5, 64, 257):
        a, b = rng.uniform(-1, 1, (3, n)), rng.normal(size=(3, n))
        a[rng.random((3, n)) < 0.05] = 0.0
        b[rng.random((3, n)) < 0.02] = np.nan
        got = R.scan(a, b, np.array([1.0, 0.0, np.nan]))
        for k, y in enumerate((1.0, 0.0, np.nan)):
            for i in range(n):
                y = b[k, i] if a[k, i] == 0.0 else a[k, i] * y + b[k, i]
                assert (np.isnan(y) and np.isnan(got[k, i])) or got[k, i] == pytest.approx(y, rel=1e-12, abs=1e-15)
