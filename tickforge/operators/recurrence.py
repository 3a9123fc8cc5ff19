"""Linear recurrences y_i = a_i * y_(i-1) + b_i per series (section 4.3).

EMA, Wilder averages (RSI, ATR, ADX) and MACD are all of this form with a
reset row (a_i = 0, y_i = b_i) at the seed.  Spark has no scan operator, so:

* ``mode="key"``: one pandas task per series (``groupBy(key).applyInPandas``),
  the series sorted inside the task.  Right for bar series, whose length is
  bounded by the calendar.
* ``mode="blocks"``: a block-parallel scan for long series.  Rows get global
  per-key numbers from a range-partitioned sort (no single-task window),
  are cut into blocks of ``block_rows``, each block is reduced to one affine
  map, the maps are folded into carry-in values in two levels (super-blocks
  of ``fanout`` maps), and every block is replayed from its carry.  A hot
  series spreads over many tasks; no task holds more than one block, one
  super-block of maps, or a key's super-maps.

Every column of the input passes through the pandas step, so no join back is
needed; callers keep the frame narrow.  Nulls: a null ``b`` makes ``y`` null until the next
reset, in both modes: a composed map carries its reset as a flag of its own.  The kernels work on
NumPy arrays, about 2 sqrt(n) vector steps for n rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.bars import KEY, ORDER, series_window
from tickforge.session import materialise

Spec = Mapping[str, tuple]  # out name -> (a column, b column)


# ------------------------------------------------------------ pandas kernels

def block_map(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compose the steps along the last axis into y_out = A * y_in + B, or y_out = B where the flag
    says that a reset (a = 0) occurred."""
    A, B, reset = np.ones(a.shape[:-1]), np.zeros(a.shape[:-1]), np.zeros(a.shape[:-1], bool)
    for j in range(a.shape[-1]):
        aj, bj = a[..., j], b[..., j]
        at = aj == 0.0
        B = np.where(at, bj, aj * B + bj)
        A = np.where(at, 0.0, aj * A)
        reset |= at
    return A, B, reset


def step_map(A, B, reset, y):
    return np.where(reset, B, A * y + B)


def scan(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """y_i = a_i * y_(i-1) + b_i along the last axis of (series, n) arrays, from ``y`` (series).

    The n steps are laid out as about sqrt(n) rows of sqrt(n) steps: all rows are composed side by side, the
    rows' carries follow one after the other, and all rows are replayed side by side.  A null (NaN) b
    stays until the next reset."""
    k, n = a.shape
    if not n:
        return np.zeros((k, 0))
    m = max(1, int(np.ceil(np.sqrt(n))))
    rows = -(-n // m)
    pad = rows * m - n
    a = np.concatenate([a, np.ones((k, pad))], axis=1).reshape(k, rows, m)
    b = np.concatenate([b, np.zeros((k, pad))], axis=1).reshape(k, rows, m)
    A, B, reset = block_map(a, b)
    carry = np.empty((k, rows))
    for r in range(rows):
        carry[:, r] = y
        y = step_map(A[:, r], B[:, r], reset[:, r], y)
    out, y = np.empty_like(a), carry
    for j in range(m):
        y = step_map(a[..., j], b[..., j], a[..., j] == 0.0, y)
        out[..., j] = y
    return out.reshape(k, rows * m)[:, :n]


def _stack(pdf: pd.DataFrame, names: Sequence[str]) -> np.ndarray:
    return np.stack([pdf[c].to_numpy(dtype="float64", na_value=np.nan) for c in names]) if len(names) else np.zeros((0, len(pdf)))


# ------------------------------------------------------------- row numbers

def order_value(df: DataFrame, order: str) -> Column:
    """The order column as a number (seconds for timestamps and dates)."""
    dt = df.schema[order].dataType
    c = F.col(order)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000.0)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double") * F.lit(86_400.0)
    return c.cast("double")


def with_row_numbers(df: DataFrame, key: str = KEY, order: str = ORDER, col: str = "rn",
                     method: str = "range", partitions: int | None = None,
                     span: float = 90 * 86_400.0) -> DataFrame:
    """Dense 0-based row number per key, without a per-key single-task window.

    ``method="range"`` (default): a range-partitioned sort on (key, order)
    cuts the data by sampled boundaries, so a hot key or a burst in time is
    split over many partitions; each row gets its partition's position id,
    fixed once by a checkpoint in the shared checkpoint folder (a retried or
    re-planned step cannot renumber).  The partition counts per key form a
    summary of (#keys x #partitions) rows whose prefix sums give the offsets.

    ``method="buckets"``: no sort; rows are bucketed by ``span`` units of the
    order value and numbered inside (key, bucket), with offsets from the
    prefix-summed bucket counts.  Cheaper, but one bucket is one task.

    (key, order) must be unique.
    """
    if method == "range":
        from tickforge.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        s = (df.repartitionByRange(n, F.col(key), F.col(order))
             .sortWithinPartitions(key, order)
             .withColumn("_gid", F.monotonically_increasing_id())
             .checkpoint(eager=True))
        s = s.withColumn("_pid", F.shiftright(F.col("_gid"), 33))
        cnt = s.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_gid").alias("_g0"))
        w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        offs = cnt.select(key, "_pid", "_g0", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_start"))
        out = s.join(offs, [key, "_pid"], "inner")
        return out.select(*[F.col(f"`{c}`") for c in df.columns],
                          (F.col("_start") + F.col("_gid") - F.col("_g0")).cast("long").alias(col))
    if method != "buckets":
        raise ValueError(f"unknown numbering method {method!r}")
    b = F.floor(order_value(df, order) / F.lit(float(span))).cast("long")
    s = df.withColumn("_bkt", b)
    cnt = s.groupBy(key, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = cnt.select(key, "_bkt", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(key, "_bkt").orderBy(order)
    out = s.join(offs, [key, "_bkt"], "inner")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("_start") + F.row_number().over(inner) - F.lit(1)).cast("long").alias(col))


# ------------------------------------------------------------------ scans

def affine_scan(df: DataFrame, specs: Spec, key: str = KEY, order: str = ORDER,
                mode: str = "key", block_rows: int = 4096, rn: str | None = None,
                fanout: int = 1024) -> DataFrame:
    """Add one column per spec ``out -> (a, b)`` holding the scan result.

    Every input column passes through the pandas step unchanged, so no join
    back is needed; keep the frame narrow (the gold pipeline scans bar
    columns only and joins the indicator block once).
    """
    names = list(specs)
    tmp = []
    for i, nm in enumerate(names):
        a, b = specs[nm]
        a = F.col(a) if isinstance(a, str) else a
        b = F.col(b) if isinstance(b, str) else b
        tmp += [a.cast("double").alias(f"_a{i}"), b.cast("double").alias(f"_b{i}")]
    wide = df.select("*", *tmp)
    out_schema = T.StructType(list(df.schema.fields) +
                              [T.StructField(n, T.DoubleType()) for n in names])
    if mode == "key":
        return _scan_by_key(wide, names, key, order, df.columns, out_schema)
    if mode == "blocks":
        if rn is None:
            raise ValueError("blocks mode needs a row-number column (see with_row_numbers)")
        return _scan_blocks(wide, names, key, rn, block_rows, df.columns, out_schema, fanout)
    raise ValueError(f"unknown mode {mode!r}")


def _finish(pdf: pd.DataFrame, cols: list, names: list, ys: np.ndarray) -> pd.DataFrame:
    out = pdf[cols].copy()
    for nm, y in zip(names, ys):
        out[nm] = y                     # NaN arrives as null
    return out


def _scan_by_key(wide, names, key, order, cols, schema):
    k = len(names)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="mergesort")
        a, b = (_stack(pdf, [f"_{x}{i}" for i in range(k)]) for x in "ab")
        return _finish(pdf, cols, names, scan(a, b, np.zeros(k)))

    return wide.groupBy(key).applyInPandas(run, schema)


def _scan_blocks(wide, names, key, rn, m, cols, schema, fanout: int = 1024):
    k = len(names)
    wide = materialise(wide)          # read twice, for the maps and for the replay
    blocked = wide.withColumn("_blk", F.floor(F.col(rn) / F.lit(m)).cast("long"))
    kt = wide.schema[key].dataType
    abr = ["A", "B", "R"]

    def fields(at: str, parts: Sequence[str]) -> T.StructType:
        return T.StructType([T.StructField(key, kt), T.StructField(at, T.LongType())]
                            + [T.StructField(f"_{x}{i}", T.DoubleType()) for i in range(k) for x in parts])

    def one_row(pdf, at, A, B, reset):
        row = {key: [pdf[key].iloc[0]], at: [int(pdf[at].iloc[0])]}
        for i in range(k):
            row[f"_A{i}"], row[f"_B{i}"], row[f"_R{i}"] = [A[i]], [B[i]], [float(reset[i])]
        return pd.DataFrame(row)[[key, at] + [f"_{x}{i}" for i in range(k) for x in abr]]

    # 1. one map (A, B, reset) per block and output, from (a, b) columns only
    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(rn, kind="mergesort")
        n = len(pdf)
        a, b = (_stack(pdf, [f"_{x}{i}" for i in range(k)]) for x in "ab")
        side = max(1, int(np.sqrt(n)))           # compose rows side by side, then the rows
        pad = -n % side
        a = np.concatenate([a, np.ones((k, pad))], axis=1).reshape(k, side, -1)
        b = np.concatenate([b, np.zeros((k, pad))], axis=1).reshape(k, side, -1)
        return one_row(pdf, "_blk", *_fold(*block_map(a, b)))

    ab = [c for i in range(k) for c in (f"_a{i}", f"_b{i}")]
    maps = (blocked.select(key, "_blk", rn, *ab)
            .groupBy(key, "_blk").applyInPandas(summarize, fields("_blk", abr)))

    # 2. carry-in per block, in two levels so no task folds a whole key:
    #    maps are grouped into super-blocks of ``fanout`` blocks, each
    #    super-block is composed to one map, the (#blocks / fanout) super-maps
    #    of a key are folded, and each super-block replays its maps from its
    #    super-carry.
    def maps_of(pdf: pd.DataFrame):
        A, B, R = (_stack(pdf, [f"_{x}{i}" for i in range(k)]) for x in abr)
        return A, B, R > 0

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk", kind="mergesort")
        return one_row(pdf, "_sb", *_fold(*maps_of(pdf)))

    def carries_of(pdf: pd.DataFrame, y0: np.ndarray, at: str) -> pd.DataFrame:
        pdf = pdf.sort_values(at, kind="mergesort")
        A, B, R = maps_of(pdf)
        out, y = np.empty(A.shape), y0
        for j in range(A.shape[1]):
            out[:, j] = y
            y = step_map(A[:, j], B[:, j], R[:, j], y)
        return pd.DataFrame({key: pdf[key].to_numpy(), at: pdf[at].to_numpy(),
                             **{f"_y{i}": out[i] for i in range(k)}})

    maps = maps.withColumn("_sb", F.floor(F.col("_blk") / F.lit(fanout)).cast("long"))
    sup = maps.groupBy(key, "_sb").applyInPandas(compose, fields("_sb", abr))
    sup_carries = sup.groupBy(key).applyInPandas(
        lambda pdf: carries_of(pdf, np.zeros(k), "_sb"), fields("_sb", ["y"]))

    def start(cdf: pd.DataFrame) -> np.ndarray:
        return np.array([cdf[f"_y{i}"].iloc[0] for i in range(k)], dtype="float64") if len(cdf) else np.zeros(k)

    def fold_block(pdf: pd.DataFrame, cdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame({f.name: [] for f in fields("_blk", ["y"]).fields})
        return carries_of(pdf, start(cdf), "_blk")

    carries = (maps.groupBy(key, "_sb").cogroup(sup_carries.groupBy(key, "_sb"))
               .applyInPandas(fold_block, fields("_blk", ["y"])))

    # 3. replay every block from its carry (co-grouped on (key, block))
    def replay(pdf: pd.DataFrame, cdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        pdf = pdf.sort_values(rn, kind="mergesort")
        a, b = (_stack(pdf, [f"_{x}{i}" for i in range(k)]) for x in "ab")
        return _finish(pdf, cols, names, scan(a, b, start(cdf)))

    return (blocked.groupBy(key, "_blk")
            .cogroup(carries.groupBy(key, "_blk"))
            .applyInPandas(replay, schema))


def _fold(A: np.ndarray, B: np.ndarray, reset: np.ndarray):
    """Compose maps along the last axis."""
    a, b, z = np.ones(A.shape[0]), np.zeros(A.shape[0]), np.zeros(A.shape[0], bool)
    for j in range(A.shape[1]):
        b = step_map(A[:, j], B[:, j], reset[:, j], b)
        a = np.where(reset[:, j], 0.0, A[:, j] * a)
        z |= reset[:, j]
    return a, b, z


# ----------------------------------------------------- series helpers

def row_number0(key: str = KEY, order: str = ORDER) -> Column:
    return (F.row_number().over(series_window(key, order)) - F.lit(1)).cast("long")


def prev_values(df: DataFrame, cols: Mapping[str, str], k: int, key: str, order: str,
                rn: str | None, mode: str, block_rows: int = 4096) -> DataFrame:
    """Values k rows earlier in the series, ``{source: alias}``.  Key mode: ``lag``.  Blocks mode:
    ``lag`` inside (key, block) with a halo of k rows, so a long series is spread evenly."""
    if mode == "key":
        w = series_window(key, order)
        return df.select("*", *[F.lag(c, k).over(w).alias(a) for c, a in cols.items()])
    from tickforge.operators import blocks as BK
    w = BK.block_window(key, rn)
    h = BK.with_halo(df, rn, block_rows, back=k)
    return BK.drop_halo(h.select("*", *[F.lag(c, k).over(w).alias(a) for c, a in cols.items()]))


def head_means(df: DataFrame, specs: Mapping[str, tuple], key: str, order: str, rn: str,
               mode: str) -> DataFrame:
    """Per key, the mean of a column over rows lo..hi (0-based, inclusive),
    null unless all rows exist; ``{alias: (col, lo, hi)}``.

    Key mode: a 14-row window evaluated everywhere (read at the seed row).
    Blocks mode: the few head rows are filtered first, aggregated per key and
    joined back (a per-key table, broadcast by AQE when small).
    """
    if mode == "key":
        out = []
        for alias, (c, lo, hi) in specs.items():
            w = series_window(key, order).rowsBetween(-(hi - lo), 0)
            full = F.count(F.lit(1)).over(w) == F.lit(hi - lo + 1)
            out.append(F.when((F.col(rn) == F.lit(hi)) & full, F.avg(c).over(w)).alias(alias))
        return df.select("*", *out)
    aggs = []
    for alias, (c, lo, hi) in specs.items():
        inside = (F.col(rn) >= lo) & (F.col(rn) <= hi)
        aggs.append(F.when(F.sum(F.when(inside, 1).otherwise(0)) == F.lit(hi - lo + 1),
                           F.avg(F.when(inside, F.col(c)))).alias(alias))
    top = max(hi for _, _, hi in specs.values())
    m = df.filter(F.col(rn) <= top).groupBy(key).agg(*aggs)
    return df.join(m, key, "left")


# ------------------------------------------------------------- indicators

def ema_alpha(window: int) -> float:
    return 2.0 / (window + 1)


def _ema_spec(x: str, alpha: float, rn: str):
    """EMA seeded with the first value: reset at row 0, then (1-a) y + a x."""
    a = F.when(F.col(rn) == 0, F.lit(0.0)).otherwise(F.lit(1.0 - alpha))
    b = F.when(F.col(rn) == 0, F.col(x)).otherwise(F.lit(alpha) * F.col(x))
    return a, b


def _seeded_spec(x: str, alpha: float, seed_row: int, seed: str, rn: str):
    """Value ``seed`` at ``seed_row``, then (1-alpha) y + alpha x; null before."""
    a = F.when(F.col(rn) <= seed_row, F.lit(0.0)).otherwise(F.lit(1.0 - alpha))
    b = (F.when(F.col(rn) < seed_row, F.lit(None).cast("double"))
         .when(F.col(rn) == seed_row, F.col(seed))
         .otherwise(F.lit(alpha) * F.col(x)))
    return a, b


def _numbered(df, key, order, mode):
    """Per-key row numbers: a window in key mode; in blocks mode the
    range-sort numbering, whose checkpoint also cuts the lineage that the
    block steps read several times."""
    if mode == "key":
        return df.withColumn("_rn", row_number0(key, order)), "_rn"
    return with_row_numbers(df, key, order, "_rn"), "_rn"


def add_ema(df: DataFrame, windows: Sequence[int] = (20, 50, 100), close: str = "c",
            names: Sequence[str] | None = None, key: str = KEY, order: str = ORDER,
            mode: str = "key", block_rows: int = 4096) -> DataFrame:
    """Exponential moving averages, alpha = 2 / (window + 1), seeded with the
    first close; null until ``window`` rows (T7-T9)."""
    names = list(names or [f"{w}D-EMA" for w in windows])
    df, rn = _numbered(df, key, order, mode)
    specs = {f"_ema{w}": _ema_spec(close, ema_alpha(w), rn) for w in windows}
    df = affine_scan(df, specs, key, order, mode, block_rows, rn)
    for w, nm in zip(windows, names):
        df = df.withColumn(nm, F.when(F.col(rn) >= w - 1, F.col(f"_ema{w}")))
    return df.drop(rn, *specs)


def _gain_loss(close: str, prev: str):
    diff = F.col(close) - F.col(prev)
    return (F.coalesce(F.greatest(diff, F.lit(0.0)), F.lit(0.0)).alias("_gain"),
            F.coalesce(F.greatest(-diff, F.lit(0.0)), F.lit(0.0)).alias("_loss"))


def rsi_from(u: str, d: str) -> Column:
    """100 - 100 / (1 + U/D); 100 when D = 0."""
    return F.when(F.col(d) == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col(u) / F.col(d)))


def add_rsi(df: DataFrame, window: int = 14, close: str = "c", name: str = "rsi",
            key: str = KEY, order: str = ORDER, mode: str = "key",
            block_rows: int = 4096) -> DataFrame:
    """Wilder RSI: EMAs (alpha = 1/window) of gains and losses from row 0;
    null for the first window - 1 rows (T15)."""
    df, rn = _numbered(df, key, order, mode)
    df = prev_values(df, {close: "_pc"}, 1, key, order, rn, mode, block_rows)
    df = df.select("*", *_gain_loss(close, "_pc"))
    al = 1.0 / window
    specs = {"_up": _ema_spec("_gain", al, rn), "_dn": _ema_spec("_loss", al, rn)}
    df = affine_scan(df, specs, key, order, mode, block_rows, rn)
    df = df.withColumn(name, F.when(F.col(rn) >= window - 1, rsi_from("_up", "_dn")))
    return df.drop(rn, "_pc", "_gain", "_loss", "_up", "_dn")


def true_range(high="h", low="l", prev_close="_pc") -> Column:
    """max(h - l, |h - prev c|, |l - prev c|); h - l on the first row."""
    hl = F.col(high) - F.col(low)
    return F.greatest(hl, F.abs(F.col(high) - F.col(prev_close)), F.abs(F.col(low) - F.col(prev_close)))


TECH_OUT = ["adx", "atr", "20D-EMA", "50D-EMA", "100D-EMA", "rsi",
            "MACDs_12_26_9", "MACDh_12_26_9", "DMP_16"]
#: Running values of the recurrences at their default windows.
INTERNALS = [*(f"_ema{w}" for w in (12, 20, 26, 50, 100)), "_up", "_dn", "_atr", "_tr_w", "_pdm_w", "_mdm_w", "_adx", "_sig"]


def add_technical_recurrences(df: DataFrame, key: str = KEY, order: str = ORDER,
                              mode: str = "key", block_rows: int = 4096,
                              ema_windows: Sequence[int] = (20, 50, 100),
                              rsi_window: int = 14, atr_window: int = 14, adx_window: int = 14,
                              macd=(12, 26, 9), rn: str | None = None, internals: bool = False) -> DataFrame:
    """EMAs, RSI, ATR, ADX with +DI (``DMP_16``), MACD signal and histogram
    (T5-T9, T15, T20-T22).  Needs columns h, l, c; in blocks mode ``rn`` may
    name an existing dense row number (else rows are numbered here).

    Per-row inputs (previous bar, gains, true range, directional movement,
    seeds) are window expressions.  Key mode then runs both scan rounds
    (the second depends on the first: MACD signal, ADX) in one pandas pass
    per ticker, so the plan has a single exchange on the key.  Blocks mode
    runs each round as a block-parallel scan.  ``internals`` keeps the row number (``_rn``) and the running values behind the
    columns (``INTERNALS``), which ``operators.state`` continues.
    """
    fast, slow, sig = macd
    n, na = atr_window, adx_window
    emas = sorted(set(ema_windows) | {fast, slow})
    df0 = df   # an external row number (blocks mode) is kept in the output
    if rn is None or mode == "key":
        df, rn = _numbered(df, key, order, mode)
    df = prev_values(df, {"c": "_pc", "h": "_ph", "l": "_pl"}, 1, key, order, rn, mode, block_rows)
    up = F.col("h") - F.col("_ph")
    dn = F.col("_pl") - F.col("l")
    df = df.select("*", *_gain_loss("c", "_pc"),
                   F.coalesce(true_range(), F.col("h") - F.col("l")).alias("_tr"),
                   F.when((up > dn) & (up > 0), up).otherwise(F.lit(0.0)).alias("_pdm"),
                   F.when((dn > up) & (dn > 0), dn).otherwise(F.lit(0.0)).alias("_mdm"))
    # seeds: ATR = mean TR of rows 0..n-1; ADX parts = mean of rows 1..na
    df = head_means(df, {"_tr_seed": ("_tr", 0, n - 1), "_tr_s1": ("_tr", 1, na),
                         "_pdm_s1": ("_pdm", 1, na), "_mdm_s1": ("_mdm", 1, na)},
                    key, order, rn, mode)
    specs = {f"_ema{w}": _ema_spec("c", ema_alpha(w), rn) for w in emas}
    specs["_up"] = _ema_spec("_gain", 1.0 / rsi_window, rn)
    specs["_dn"] = _ema_spec("_loss", 1.0 / rsi_window, rn)
    specs["_atr"] = _seeded_spec("_tr", 1.0 / n, n - 1, "_tr_seed", rn)
    for c in ("_tr", "_pdm", "_mdm"):
        specs[f"{c}_w"] = _seeded_spec(c, 1.0 / na, na, f"{c}_s1", rn)
    if mode == "key" and not internals:
        return _tech_by_key(df, df0.columns, specs, key, order, rn, ema_windows, rsi_window, na, macd)

    df = affine_scan(df, specs, key, order, mode, block_rows, rn)
    pdi = F.lit(100.0) * F.try_divide(F.col("_pdm_w"), F.col("_tr_w"))
    mdi = F.lit(100.0) * F.try_divide(F.col("_mdm_w"), F.col("_tr_w"))
    df = df.select("*", pdi.alias("_pdi"), mdi.alias("_mdi"),
                   F.when(F.col(rn) >= slow - 1, F.col(f"_ema{fast}") - F.col(f"_ema{slow}")).alias("_macd"))
    df = df.withColumn("_dx", F.lit(100.0) * F.try_divide(F.abs(F.col("_pdi") - F.col("_mdi")),
                                                        F.col("_pdi") + F.col("_mdi")))
    df = head_means(df, {"_dx_seed": ("_dx", na, 2 * na - 1)}, key, order, rn, mode)
    specs2 = {
        "_adx": _seeded_spec("_dx", 1.0 / na, 2 * na - 1, "_dx_seed", rn),
        "_sig": _seeded_spec("_macd", ema_alpha(sig), slow - 1, "_macd", rn),
    }
    df = affine_scan(df, specs2, key, order, mode, block_rows, rn)
    sig_ok = F.col(rn) >= slow + sig - 2
    out = {"adx": F.col("_adx"), "atr": F.col("_atr")}
    out.update({f"{w}D-EMA": F.when(F.col(rn) >= w - 1, F.col(f"_ema{w}")) for w in ema_windows})
    out["rsi"] = F.when(F.col(rn) >= rsi_window - 1, rsi_from("_up", "_dn"))
    out["MACDs_12_26_9"] = F.when(sig_ok, F.col("_sig"))
    out["MACDh_12_26_9"] = F.when(sig_ok, F.col("_macd") - F.col("_sig"))
    out["DMP_16"] = F.col("_pdi")
    keep = [c for c in df0.columns if c not in out]
    more = [F.col(rn).alias("_rn")] * (rn not in keep) + [F.col(c) for c in INTERNALS] if internals else []
    return df.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(k) for k, v in out.items()], *more)


def _tech_by_key(df, cols, specs, key, order, rn, ema_windows, rsi_window, na, macd):
    """Both scan rounds in one pandas pass per key; the arithmetic is the
    same, in the same order, as the block-mode column expressions."""
    fast, slow, sig = macd
    names = list(specs)
    tmp = []
    for i, nm in enumerate(names):
        a, b = specs[nm]
        tmp += [a.cast("double").alias(f"_a{i}"), b.cast("double").alias(f"_b{i}")]
    wide = df.select(*[F.col(f"`{c}`") for c in cols], F.col(rn), *tmp)
    keep = [c for c in cols if c not in TECH_OUT]
    out_fields = [df.schema[c] for c in keep] + [T.StructField(c, T.DoubleType()) for c in TECH_OUT]
    a_sig, a_na = ema_alpha(sig), 1.0 / na

    def ratio(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.where(y == 0.0, np.nan, x / np.where(y == 0.0, 1.0, y))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="mergesort")
        k = len(names)
        a, b = (_stack(pdf, [f"_{x}{i}" for i in range(k)]) for x in "ab")
        r = dict(zip(names, scan(a, b, np.zeros(k))))
        rows = pdf[rn].to_numpy(dtype="int64")
        pdi, mdi = (100.0 * ratio(r[c], r["_tr_w"]) for c in ("_pdm_w", "_mdm_w"))
        dx = 100.0 * ratio(np.abs(pdi - mdi), pdi + mdi)
        mac = np.where(rows >= slow - 1, r[f"_ema{fast}"] - r[f"_ema{slow}"], np.nan)
        # ADX seed: mean of DX over rows na .. 2na-1 (all rows present), summed in order
        lo, hi = na, 2 * na - 1
        head = dx[lo:hi + 1][~np.isnan(dx[lo:hi + 1])] if len(rows) > hi else np.empty(0)
        seed = np.add.accumulate(head)[-1] / len(head) if len(head) else np.nan
        a2 = np.where(rows <= hi, 0.0, 1.0 - a_na)
        b2 = np.where(rows < hi, np.nan, np.where(rows == hi, seed, a_na * dx))
        a3 = np.where(rows <= slow - 1, 0.0, 1.0 - a_sig)
        b3 = np.where(rows == slow - 1, mac, a_sig * mac)
        adx, sg = scan(np.stack([a2, a3]), np.stack([b2, b3]), np.zeros(2))
        ok = rows >= slow + sig - 2
        up, dn = r["_up"], r["_dn"]
        made = {"adx": adx, "atr": r["_atr"],
                "rsi": np.where(rows < rsi_window - 1, np.nan,
                                np.where(dn == 0, 100.0, 100.0 - 100.0 / (1.0 + up / np.where(dn == 0, 1.0, dn)))),
                "MACDs_12_26_9": np.where(ok, sg, np.nan), "MACDh_12_26_9": np.where(ok, mac - sg, np.nan),
                "DMP_16": pdi}
        made |= {f"{w}D-EMA": np.where(rows >= w - 1, r[f"_ema{w}"], np.nan) for w in ema_windows}
        out = pdf[keep].copy()
        for c in TECH_OUT:
            out[c] = made[c]            # NaN arrives as null
        return out

    return wide.groupBy(key).applyInPandas(run, T.StructType(out_fields))
