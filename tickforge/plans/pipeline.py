"""build_silver / build_gold: the reference's per-ticker layers as one plan
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.operators import bars as B
from tickforge.operators.news import attach_news, daily_text
from tickforge.session import materialise

KEY, ORDER = B.KEY, B.ORDER


def check_proxies_present(bars: DataFrame, proxies: Sequence[str]) -> None:
    """Fail early when a proxy has no rows: its columns would stay null and
    the final ``dropna`` would empty the table (Q11).  Collects at most
    ``len(proxies)`` keys."""
    present = {r[0] for r in bars.filter(F.col(KEY).isin(list(proxies)))
               .select(KEY).distinct().collect()}
    missing = [p for p in proxies if p not in present]
    if missing:
        raise ValueError(f"proxy series without rows: {missing}")


def fill_both(df: DataFrame, cols: Sequence[str], key: str = KEY, order: str = ORDER) -> DataFrame:
    """Forward fill, then backward fill for leading gaps, in one projection.

    ``coalesce(last-so-far, next-from-here)`` equals the reference's two
    passes; both are incremental running frames (ascending and descending).
    """
    back = B.running_window(key, order)
    fwd = B.reverse_running_window(key, order)
    cols = set(cols)

    def filled(c):
        x = F.col(f"`{c}`")
        return F.coalesce(F.last(x, True).over(back), F.last(x, True).over(fwd)).alias(c)
    return df.select(*[filled(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def align(bars: DataFrame, targets: Sequence[str] | None, proxies: Sequence[str],
          bfill: bool = True) -> DataFrame:
    """Targets with proxy columns; gaps of every column but the keys are filled along
    each target's own days, forward and (``bfill``) then backward."""
    joined = B.attach_proxies(bars, targets, proxies)
    cols = [c for c in joined.columns if c not in (KEY, ORDER)]
    return fill_both(joined, cols) if bfill else B.ffill(joined, cols)


def derive(df: DataFrame, lookback: int = 5, cols: Sequence[str] = ("vw", "n"),
           rn: str | None = None, block_rows: int = 4096) -> DataFrame:
    """target / next_c, class flags, lags and rolling statistics.  With a
    dense row number ``rn`` the windows run per (key, block) with a halo of
    ``lookback`` rows back and one row ahead."""
    if rn is None:
        df = B.add_targets(df)
        df = B.add_class_flags(df)
        df = B.add_lags(df, cols, lookback)
        return B.add_rolling_stats(df, cols, lookback)
    from tickforge.operators import blocks as BK
    h = BK.with_halo(df, rn, block_rows, back=lookback, fwd=1)
    w = BK.block_window(KEY, rn)
    rw = w.rowsBetween(-lookback, -1)
    out = [F.lead(F.col("c") - F.col("o")).over(w).alias("target"), F.lead("c").over(w).alias("next_c")]
    out += [F.lag(c, i).over(w).alias(f"{c}_lag_{i}") for c in cols for i in range(1, lookback + 1)]
    for c in cols:
        out += [F.avg(c).over(rw).alias(f"{c}_rolling_mean"), F.stddev_samp(c).over(rw).alias(f"{c}_rolling_std")]
    h = BK.drop_halo(h.select("*", *out))
    h = B.add_class_flags(h)
    first = ["target", "next_c", "target_class", "c_class"]
    rest = [f"{c}_lag_{i}" for c in cols for i in range(1, lookback + 1)] + \
        [f"{c}_rolling_{s}" for c in cols for s in ("mean", "std")]
    base = [c for c in h.columns if c not in first + rest]
    return h.select(*[F.col(f"`{c}`") for c in base + first + rest])


def build_silver(bars: DataFrame, news: DataFrame | None, targets: Sequence[str] | None,
                 proxies: Sequence[str], lookback: int = 5,
                 check_proxies: bool = True, mode: str = "key",
                 block_rows: int = 4096, bfill: bool = True) -> DataFrame:
    """Silver table for every target ticker at once (``targets`` None: every ticker that
    is not a proxy).

    The bars are materialised once, since targets, proxies and the check read them.  Nulls in
    any column are filled along each ticker's days, forward and then backward; ``bfill=False``
    leaves out the backward fill, which looks ahead.  A proxy without rows raises.

    bars: (ticker, t, o, h, l, c, v, vw, n) with ``t`` a day timestamp.
    news: bronze news rows (search_ticker, published_utc, title,
    description, keywords, id) or None.
    ``mode='blocks'``: no per-ticker window; rows are numbered per ticker,
    fills take block carries and the lead / lag / rolling windows run per
    (ticker, block) with a halo (``operators.blocks``).
    """
    bars = materialise(bars)
    if check_proxies:
        check_proxies_present(bars, proxies)
    rn = None
    if mode == "key":
        df = align(bars, targets, proxies, bfill)
    else:
        from tickforge.operators import blocks as BK
        from tickforge.operators.recurrence import _numbered
        joined = B.attach_proxies(bars, targets, proxies)
        df, rn = _numbered(joined, KEY, ORDER, "blocks")
        pc = [c for c in joined.columns if c not in (KEY, ORDER)]
        df = BK.fill_blocks(df, pc, KEY, rn, block_rows, "forward")
        if bfill:
            df = BK.fill_blocks(df, pc, KEY, rn, block_rows, "backward")
    first = [c for c in df.columns if c != rn]
    df = derive(df, lookback, rn=rn, block_rows=block_rows)
    if rn is not None:
        df = df.drop(rn)
    df = B.dropna_any(df)
    # no window reads the text, so it is joined to the finished rows: a ticker's texts never go through one task
    if news is not None:
        nd = daily_text(B.target_rows(news, targets, proxies, "search_ticker"))
        df = attach_news(df, nd)
    else:
        df = df.withColumn("aggregated_text", F.lit(" "))
    rest = [c for c in df.columns if c not in first and c != "aggregated_text"]
    return B.target_last(df.select(*[F.col(f"`{c}`") for c in [*first, "aggregated_text", *rest]]))


# --------------------------------------------------------------------- gold

# Names and order of the derived gold columns.
GOLD_DERIVED = ["williams_r", "stoch_k", "roc", "cci", "adx", "atr", "20D-EMA", "50D-EMA",
                "100D-EMA", "bollinger_mavg", "bollinger_hband", "bollinger_lband", "vwap",
                "pvwap", "rsi", "rsicat", "dayofweek", "month", "quarter", "MACDs_12_26_9",
                "MACDh_12_26_9", "DMP_16"]


def indicators(series: DataFrame, mode: str = "key", block_rows: int = 4096,
               key: str = KEY, order: str = ORDER, keep_rn: bool = False) -> DataFrame:
    """The 22 technical and calendar columns of the gold table over
    (key, order, o, h, l, c, v): frame indicators as JVM windows, the
    recurrences as the affine scan on this narrow frame."""
    from tickforge.operators import frames as FR
    from tickforge.operators import recurrence as R
    narrow = series.select(key, order, "o", "h", "l", "c", "v")
    if mode == "key":
        df = FR.add_frame_indicators(narrow, key, order)
        df = R.add_technical_recurrences(df, key, order, mode=mode)
    else:
        num, rn = R._numbered(narrow, key, order, "blocks")
        df = FR.add_frame_indicators(num, key, order, "blocks", rn, block_rows)
        df = R.add_technical_recurrences(df, key, order, mode="blocks", block_rows=block_rows, rn=rn)
    df = df.withColumn("rsicat", FR.rsi_category("rsi"))
    extra = ["_rn"] if keep_rn and mode != "key" else []
    return df.select(key, order, *extra, *[F.col(f"`{c}`") for c in GOLD_DERIVED])


def warmup_fill(df: DataFrame, cols, mode: str = "bfill", key: str = KEY, order: str = ORDER,
                rn: str | None = None, block_rows: int = 4096) -> DataFrame:
    """Warm-up handling of derived columns (W7): NaN -> null, then either the
    reference's backward fill (uses later values) or leave nulls.  With a
    dense row number ``rn`` the fill runs block-parallel (block carries)."""
    from tickforge.functions import nan_to_null
    cols = list(cols)
    cs = set(cols)
    df = df.select(*[nan_to_null(F.col(f"`{c}`")).alias(c) if c in cs else F.col(f"`{c}`")
                     for c in df.columns])
    if mode == "null":
        return df
    if rn is not None:
        from tickforge.operators.blocks import fill_blocks
        return fill_blocks(df, cols, key, rn, block_rows, "backward")
    return B.bfill(df, cols, key, order)


def _fit_text_model(text: DataFrame, size: int, min_count: int, seed: int, partitions: int | None):
    """Word2Vec fitted on tokenized, stop-word-free daily texts; None when
    the texts hold no word at all (every embedding is then zero)."""
    from tickforge.operators import text as X
    toks = X.hash_tokens(X.remove_stopwords(X.tokenize(text, "aggregated_text", "_tokens"), "_tokens", "_filtered"),
                         "_filtered")
    if not toks.filter(F.size("_filtered") > 0).limit(1).take(1):
        return None
    return X.fit_word2vec(toks, "_filtered", size, min_count, seed, partitions)


def build_gold(silver: DataFrame, warmup: str = "bfill", embed: bool = True, mode: str = "key",
               block_rows: int = 4096, embedding_size: int = 100, min_count: int = 0,
               seed: int = 42, w2v_partitions: int | None = None, scope: str = "global") -> DataFrame:
    """Gold table: silver + 22 derived columns (warm-up filled) + the daily
    text embedding; ``aggregated_text`` dropped, ``target`` last.

    Indicators are computed on the silver rows (after its dropna), so every
    recurrence is seeded at the first silver row of each ticker (Q22).
    ``scope='global'`` fits one Word2Vec over every ticker (one distributed
    fit); ``'per_ticker'`` fits one per ticker, as the reference.
    ``w2v_partitions``: Word2Vec training tasks (default: the cluster's parallelism).
    """
    from tickforge.operators import text as X
    if mode == "key":
        ind = warmup_fill(indicators(silver, mode, block_rows), GOLD_DERIVED, warmup)
    else:
        ind = warmup_fill(indicators(silver, mode, block_rows, keep_rn=True), GOLD_DERIVED, warmup,
                          rn="_rn", block_rows=block_rows).drop("_rn")
    df = silver.join(ind, on=[KEY, ORDER], how="inner")
    if embed:
        # fit on the text column alone: Word2Vec runs several jobs over its
        # input, which should not recompute the indicator branch
        text = silver.select(KEY, "aggregated_text")
        if scope == "per_ticker":
            tickers = sorted(r[0] for r in silver.select(KEY).distinct().collect())
            parts = []
            for tk in tickers:
                m = _fit_text_model(text.filter(F.col(KEY) == tk), embedding_size, min_count, seed,
                                    w2v_partitions)
                parts.append(X.embed_text(df.filter(F.col(KEY) == tk), size=embedding_size, model=m,
                                          fit=False))
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            df = out
        else:
            m = _fit_text_model(text, embedding_size, min_count, seed, w2v_partitions)
            df = X.embed_text(df, size=embedding_size, model=m, fit=False)
    df = df.drop("aggregated_text")
    return B.target_last(df)


def run_layers(bars: DataFrame, news: DataFrame | None, out_dir: str, targets: Sequence[str] | None,
               proxies: Sequence[str], fmt: str = "parquet", **gold_args) -> dict[str, str]:
    """bronze (bars, news) -> silver -> gold as written tables (S4, S7); returns their paths.

    Silver is written once, partitioned by ticker and sorted by t, and gold is
    built from that table (gold branches over silver several times, so it is
    materialised instead of recomputed).  Rewriting a subset of tickers only
    replaces their partitions.  ``mode='blocks'`` uses the block-parallel windows throughout.
    """
    from tickforge.sources.tables import read_table, write_table
    spark = bars.sparkSession
    paths = {x: f"{out_dir.rstrip('/')}/{x}" for x in ("bars", "news", "silver", "gold")}
    mode = gold_args.pop("mode", "key")
    write_table(bars, paths["bars"], KEY, ORDER, fmt)
    bars = read_table(spark, paths["bars"], fmt=fmt)
    if news is None:
        paths.pop("news")
    else:
        write_table(news, paths["news"], "search_ticker", "published_utc", fmt)
        news = read_table(spark, paths["news"], key="search_ticker", fmt=fmt)
    write_table(build_silver(bars, news, targets, proxies, mode=mode), paths["silver"], KEY, ORDER, fmt)
    silver = read_table(spark, paths["silver"], targets, fmt=fmt)
    write_table(build_gold(silver, mode=mode, **gold_args), paths["gold"], KEY, ORDER, fmt)
    return paths
