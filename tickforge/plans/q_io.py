"""Queries exercising sources and sinks: bars landed as vendor JSON pages,
a partitioned bar table scanned with key pruning, news pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickforge.functions import epoch_ms_to_day
from tickforge.plans.catalog import register, round_doubles
from tickforge.plans.sqlparts import BARS_DAILY, NEWS, in_list, rounded
from tickforge.session import scratch_path
from tickforge.sources import fixtures as FX
from tickforge.sources.pages import read_bar_pages, read_news_pages, write_pages
from tickforge.sources.tables import read_table, write_table

BAR_DBL = ["o", "h", "l", "c", "v", "vw"]
# Keys of the pruned scan (the feature of the query).
SCANNED = [f"Brand#{i}" for i in range(1, 7)]


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def land_bar_pages(spark, sf_dir, path):
    """F1 bars as vendor pages (one page per ticker and year; epoch-ms t;
    ``vw`` left out where n % 7 = 0 and ``n`` where n % 11 = 0)."""
    b = FX.daily_bars(spark, sf_dir)
    ms = (F.unix_micros(F.col("t").cast("timestamp")) / 1000).cast("long")
    rows = b.select("ticker", ms.alias("t"), "o", "h", "l", "c", "v",
                    F.when(F.col("n") % 7 != 0, F.col("vw")).alias("vw"),
                    F.when(F.col("n") % 11 != 0, F.col("n")).alias("n"),
                    F.year("t").alias("_y"))
    write_pages(rows, path, "ticker", F.col("_y"), ["t", "o", "h", "l", "c", "v", "vw", "n"])


@register("bars_from_pages", rounded(f"""WITH {BARS_DAILY}
SELECT ticker, t, o, h, l, c, v, CASE WHEN n % 7 = 0 THEN 0.0 ELSE vw END AS vw,
       CASE WHEN n % 11 = 0 THEN 0 ELSE n END AS n FROM bars""", BAR_DBL))
def bars_from_pages(spark, sf_dir):
    """Vendor pages -> bronze rows (missing vw / n -> 0), epoch ms -> day."""
    path = _scratch(spark, "bar-pages")
    land_bar_pages(spark, sf_dir, path)
    br = read_bar_pages(spark, path)
    return round_doubles(br.withColumn("t", epoch_ms_to_day("t")))


@register("bars_pruned_scan", rounded(f"WITH {BARS_DAILY} SELECT * FROM bars WHERE ticker IN {in_list(SCANNED)}",
                                      BAR_DBL))
def bars_pruned_scan(spark, sf_dir):
    """Bars written partitioned by ticker, scanned for some
    tickers only (partition pruning)."""
    path = _scratch(spark, "bars-table")
    write_table(FX.daily_bars(spark, sf_dir), path, "ticker", "t")
    df = read_table(spark, path, SCANNED)
    return round_doubles(df.select("ticker", "t", "o", "h", "l", "c", "v", "vw", "n"))


@register("news_from_pages", f"""WITH {NEWS}
SELECT search_ticker, published_utc, title, description, array_to_string(keywords, ',') AS keywords, id
FROM news""")
def news_from_pages(spark, sf_dir):
    """News pages -> bronze news rows stamped with search_ticker."""
    path = _scratch(spark, "news-pages")
    news = FX.news_articles(spark, sf_dir)
    write_pages(news, path, "search_ticker", F.substring("published_utc", 1, 4),
                ["id", "published_utc", "title", "description", "keywords"])
    df = read_news_pages(spark, path).withColumn("id", F.col("id").cast("long"))
    return df.select("search_ticker", "published_utc", "title", "description",
                     F.array_join("keywords", ",").alias("keywords"), "id")


@register("evolved_table", rounded(f"""WITH {BARS_DAILY}
SELECT ticker, t, c, v, n, CASE WHEN year(t) >= 1997 THEN vw END AS vw,
       CASE WHEN year(t) >= 1997 THEN n * 1.5 ELSE NULL END AS weight FROM bars""", ["c", "v", "vw", "weight"]))
def evolved_table(spark, sf_dir):
    """A table whose later write adds two columns and widens one (n: int, then long), read back whole."""
    path = _scratch(spark, "evolved")
    bars = FX.daily_bars(spark, sf_dir).withColumn("y", F.year("t"))
    early = bars.filter("y < 1997").select("ticker", "y", "t", "c", "v", F.col("n").cast("int").alias("n"))
    late = bars.filter("y >= 1997").select("ticker", "y", "t", "vw", "n", "c", "v", (F.col("n") * 1.5).alias("weight"))
    write_table(early, path, ["ticker", "y"], "t")
    write_table(late, path, ["ticker", "y"], "t")
    return round_doubles(read_table(spark, path).select("ticker", "t", "c", "v", "n", "vw", "weight"))
