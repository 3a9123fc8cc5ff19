"""Inputs derived from the driver's tables (see FIXTURES.md section 2).

F1 daily bars: ``lineitem`` joined to ``part``; ticker = brand, price =
extendedprice / quantity.  F2 hourly bars: ``events``.  F3 news: ``documents``.
Everything is a lazy plan over the parquet tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators.bars import resample_bars

# Fixed values of the fixture mapping: the proxy tickers.  Targets: None, every ticker
# that is not a proxy.
TARGETS = None
PROXIES = [f"Brand#{i}" for i in range(15, 26)]

# Total order for open / close of a bar built from lineitem rows.
LINEITEM_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per lineitem: (ticker, ts, px, qty, tie-break keys)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # join strategy is Catalyst's: broadcast only below the size threshold,
    # otherwise a shuffle join (AQE splits a skewed partkey)
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(F.col("p_brand").alias("ticker"), F.col("l_shipdate").alias("ts"),
                    (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
                    F.col("l_quantity").alias("qty"), *LINEITEM_TIEBREAK)


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily OHLCV bars per brand."""
    return resample_bars(lineitem_ticks(spark, sf_dir), "ticker", "ts", "px", "qty",
                         unit="day", tiebreak=LINEITEM_TIEBREAK)


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ev.select(F.col("event_type").alias("ticker"), "ts",
                     F.col("value").alias("px"), F.lit(1.0).alias("qty"), "event_id")


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly bars per event type; open / close by (ts, event_id)."""
    return resample_bars(event_ticks(spark, sf_dir), "ticker", "ts", "px", "qty",
                         unit="hour", tiebreak=["ts", "event_id"])


def news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze news rows (search_ticker, published_utc, title, description,
    keywords, id) derived from ``documents``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    day = F.date_add(F.lit("1995-01-02").cast("date"), ((F.col("doc_id") * 37) % 2499).cast("int"))
    return d.select(
        F.concat(F.lit("Brand#"), ((F.col("doc_id") % 25) + 1).cast("string")).alias("search_ticker"),
        F.date_format(day.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_utc"),
        F.substring("text", 1, 60).alias("title"),
        F.col("text").alias("description"),
        F.array("lang", "source").alias("keywords"),
        F.col("doc_id").alias("id"))
