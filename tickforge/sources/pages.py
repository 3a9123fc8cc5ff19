"""Landed vendor pages (S1, S2): JSON objects ``{"ticker": ..., "results": [...]}``
read with an explicit schema and flattened with ``explode`` on the executors
(the reference flattens them in driver memory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.sources.schemas import stored_schema

BAR_RESULT = T.StructType([
    T.StructField("t", T.LongType()), T.StructField("o", T.DoubleType()),
    T.StructField("h", T.DoubleType()), T.StructField("l", T.DoubleType()),
    T.StructField("c", T.DoubleType()), T.StructField("v", T.DoubleType()),
    T.StructField("vw", T.DoubleType()), T.StructField("n", T.LongType()),
])

BAR_PAGE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("results", T.ArrayType(BAR_RESULT)),
])

# Fields of a news result that later steps use; a page may hold any others (``extra``).
NEWS_FIELDS = {"published_utc": "string", "title": "string", "description": "string",
               "keywords": "array<string>", "id": "string"}

# bronze bar schema: epoch-ms t, doubles (the reference's float32 only loses precision)
BRONZE_BARS = T.StructType([T.StructField("ticker", T.StringType())] + list(BAR_RESULT.fields))


def _ticker_from_path() -> F.Column:
    # .../ticker=XYZ/... or .../XYZ.json
    p = F.col("_metadata.file_path")
    part = F.regexp_extract(p, r"ticker=([^/]+)", 1)
    base = F.regexp_extract(p, r"([^/]+)\.json[^/]*$", 1)
    return F.when(part != "", part).otherwise(base)


def read_bar_pages(spark: SparkSession, path: str, ticker: str | None = None) -> DataFrame:
    """Bar pages -> bronze rows (ticker, t, o, h, l, c, v, vw, n).

    The ticker comes from the page's ``ticker`` field, else from the file
    path, else the ``ticker`` argument.  Missing ``vw`` / ``n`` become 0.
    """
    return flatten_bar_pages(spark.read.schema(BAR_PAGE).json(path), ticker)


def flatten_bar_pages(pages: DataFrame, ticker: str | None = None) -> DataFrame:
    """Page rows -> bar rows; works on batch and streaming frames alike."""
    tk = F.coalesce(F.col("ticker"), F.when(_ticker_from_path() != "", _ticker_from_path()),
                    F.lit(ticker))
    rows = pages.select(tk.alias("ticker"), F.explode("results").alias("r"))
    r = F.col("r")
    return rows.select(
        "ticker", r["t"].alias("t"),
        *[r[c].cast("double").alias(c) for c in ("o", "h", "l", "c", "v")],
        F.coalesce(r["vw"].cast("double"), F.lit(0.0)).alias("vw"),
        F.coalesce(r["n"].cast("long"), F.lit(0)).alias("n"))


def read_news_pages(spark: SparkSession, path: str, ticker: str | None = None,
                    fields: dict[str, str] | None = None, table: str | None = None) -> DataFrame:
    """News pages -> bronze news rows with the ``search_ticker`` stamp.

    ``NEWS_FIELDS`` are there even where no page has them; ids are strings.  What else is a column is said by ``fields``
    (name: type), or by the stored schema of the bronze ``table`` that the rows are for.  Then the pages are read
    once, nothing is inferred, and one batch's columns never differ from another's: a value that does not fit its type is
    null there, and it and every unknown field stay as JSON text in ``extra`` (map<string,string>).
    Without either (a first landing), every field of the vendor's results is a column of the type inferred.
    """
    if fields is None and table is not None:
        had = stored_schema(spark, table)
        if had is not None:
            fields = {f.name: f.dataType.simpleString() for f in had[1].fields
                      if f.name not in NEWS_FIELDS and f.name not in ("search_ticker", "extra")}
    if fields is None:
        return _inferred_news(spark, path, ticker)
    pages = spark.read.schema("ticker string, results array<variant>").json(path)
    tk = F.coalesce(F.col("ticker"), F.lit(ticker))
    rows = pages.select(tk.alias("search_ticker"), F.explode("results").alias("r"))
    rows = rows.withColumn("m", F.from_json(F.to_json("r"), "map<string,string>"))
    want = NEWS_FIELDS | fields
    rows = rows.select("search_ticker", "m", *[
        F.try_variant_get("r", "$['" + c.replace("'", "\\'") + "']", t).alias(c) for c, t in want.items()])
    missed = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in want]))
    extra = F.map_filter("m", lambda k, v: v.isNotNull() & (~k.isin(list(want)) | F.array_contains(missed, k)))
    return rows.select("search_ticker", *[F.col(f"`{c}`") for c in want], F.coalesce(extra, _nothing()).alias("extra"))


def _nothing() -> F.Column:
    return F.create_map().cast("map<string,string>")


def _inferred_news(spark: SparkSession, path: str, ticker: str | None) -> DataFrame:
    pages = spark.read.json(path)
    tk = F.coalesce(F.col("ticker") if "ticker" in pages.columns else F.lit(None).cast("string"), F.lit(ticker))
    if "results" not in pages.columns:
        pages = pages.withColumn("results", F.array().cast("array<struct<id:string>>"))
    rows = pages.select(tk.cast("string").alias("search_ticker"), F.explode("results").alias("r"))
    have = rows.schema["r"].dataType.fieldNames()
    known = [(F.col("r").getField(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c)
             for c, t in NEWS_FIELDS.items()]
    rest = [F.col("r").getField(c).alias(c) for c in have if c not in NEWS_FIELDS and c not in ("search_ticker", "extra")]
    return rows.select("search_ticker", *known, *rest, _nothing().alias("extra"))


def write_pages(df: DataFrame, path: str, key: str, page: F.Column, fields: list[str],
                page_rows: int = 1000) -> None:
    """Group rows into pages ``{ticker, results: [...]}`` of about ``page_rows`` rows of one (key, page) and
    write them as JSON lines."""
    rows = df.select(F.col(key).alias("ticker"), page.alias("_page"), F.struct(*[F.col(c) for c in fields]).alias("r"))
    parts = rows.groupBy("ticker", "_page").agg(F.ceil(F.count(F.lit(1)) / page_rows).alias("_parts"))
    (rows.join(parts, ["ticker", "_page"])
     .groupBy("ticker", "_page", F.pmod(F.xxhash64("r"), F.col("_parts")).alias("_part"))
     .agg(F.array_sort(F.collect_list("r")).alias("results"))
     .select("ticker", "results").write.mode("overwrite").json(path))
