"""News: text combine, per-day aggregation and the join onto bars
(P4-P7, A1, J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions import iso_to_day

KEY = "ticker"
ORDER = "t"


def combine_text(news: DataFrame) -> F.Column:
    """description, keywords (space-joined) and title, nulls skipped (P5)."""
    return F.concat_ws(" ", F.col("description"), F.concat_ws(" ", F.col("keywords")),
                       F.col("title"))


def daily_text(news: DataFrame, key: str = "search_ticker", published: str = "published_utc",
               article_id: str = "id") -> DataFrame:
    """One row per (ticker, day) with every article's text joined by a space.

    An article whose time cannot be read has the day null, as the reference's
    truncation gives; it joins no bar.  The gathered list of a group is the
    output text itself in pieces.  Articles are ordered by (publication time, article id) so the text is
    deterministic; newlines become spaces (P4, P5, P6, A1).
    """
    ts = F.try_to_timestamp(F.col(published))
    per_article = news.select(
        F.col(key).alias(KEY), iso_to_day(F.col(published)).alias(ORDER),
        F.struct(ts.alias("ts"), F.col(article_id).alias("id"),
                 combine_text(news).alias("text")).alias("a"))
    g = per_article.groupBy(KEY, ORDER).agg(F.array_sort(F.collect_list("a")).alias("arts"))
    text = F.array_join(F.transform("arts", lambda a: a["text"]), " ")
    return g.select(KEY, ORDER, F.regexp_replace(text, "\n", " ").alias("aggregated_text"))


def attach_news(bars: DataFrame, news_daily: DataFrame, key: str = KEY,
                order: str = ORDER, default: str = " ") -> DataFrame:
    """Left join of the daily text onto bars; days without news get ``default``
    (P7, J2).  News on days without a bar is dropped, as in the reference.

    The texts grow with the news, so they are dealt by (ticker, day) and never broadcast."""
    j = bars.join(news_daily.withColumnRenamed("aggregated_text", "_agg_text").hint("merge"),
                  on=[key, order], how="left")
    return j.select(*[F.col(f"`{c}`") for c in bars.columns],
                    F.coalesce(F.col("_agg_text"), F.lit(default)).alias("aggregated_text"))
