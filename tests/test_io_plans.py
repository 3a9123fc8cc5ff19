"""Sources, sinks and physical-plan checks."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0001
from tickforge.plans import pipeline as PL
from tickforge.sources import fixtures as FX
from tickforge.sources.pages import read_bar_pages, read_news_pages
from tickforge.sources.tables import read_table, write_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bar_pages_missing_fields(spark):
    d = tempfile.mkdtemp(prefix="pages-")
    with open(os.path.join(d, "AAA.json"), "w") as f:
        f.write(json.dumps({"results": [{"t": 86_400_000, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10}]}) + "\n")
        f.write(json.dumps({"ticker": "BBB", "results": [
            {"t": 0, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10, "vw": 1.2, "n": 7}]}) + "\n")
    rows = {r["ticker"]: r for r in read_bar_pages(spark, d).collect()}
    assert rows["AAA"]["vw"] == 0.0 and rows["AAA"]["n"] == 0     # ticker from the file name
    assert rows["BBB"]["vw"] == 1.2 and rows["BBB"]["n"] == 7


def test_news_pages(spark):
    d = tempfile.mkdtemp(prefix="news-")
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(json.dumps({"ticker": "X", "results": [
            {"id": 1, "published_utc": "2020-01-02T10:00:00Z", "title": "t", "description": None,
             "keywords": ["a", "b"]}]}) + "\n")
    r = read_news_pages(spark, d).collect()[0]
    assert r["search_ticker"] == "X" and r["keywords"] == ["a", "b"] and r["description"] is None


def test_partitioned_roundtrip_prunes(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tbl-"), "bars")
    bars = FX.daily_bars(spark, SF0001)
    write_table(bars, d, "ticker", "t")
    df = read_table(spark, d, ["Brand#1", "Brand#2"])
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(ticker" in plan or "PartitionFilters: [ticker" in plan
    assert df.count() == bars.filter(F.col("ticker").isin("Brand#1", "Brand#2")).count()
    # dynamic overwrite: rewriting one ticker keeps the others
    write_table(bars.filter(F.col("ticker") == "Brand#1"), d, "ticker", "t")
    assert read_table(spark, d).count() == bars.count()


def test_scan_pushdown_and_pruning(spark):
    plan = _plan(FX.daily_bars(spark, SF0001))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    li = next(ln for ln in scans if "lineitem" in ln)
    assert "l_discount" not in li and "l_tax" not in li and "l_returnflag" not in li   # column pruning
    assert "PushedFilters: [IsNotNull(l_partkey)]" in li
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in plan


def test_silver_windows_are_partitioned(spark):
    bars = FX.daily_bars(spark, SF0001)
    s = PL.build_silver(bars, FX.news_articles(spark, SF0001), FX.TARGETS, FX.PROXIES)
    plan = _plan(s)
    assert "SinglePartition" not in plan
    assert "Window [" in plan
    import re
    wins = [ln for ln in plan.splitlines() if re.search(r"(^|- )Window \[", ln.strip())]
    assert wins
    for line in wins:
        assert re.search(r"\], \[ticker#\d+L?\]", line), line[-200:]   # partitioned by ticker


def test_key_mode_recurrences_add_no_exchange(spark):
    from tickforge.operators import recurrence as R
    bars = spark.read.parquet(f"{SF0001}/part.parquet").select(
        F.col("p_brand").alias("ticker"), F.current_timestamp().cast("timestamp_ntz").alias("t"),
        F.col("p_retailprice").alias("o"), F.col("p_retailprice").alias("h"),
        F.col("p_retailprice").alias("l"), F.col("p_retailprice").alias("c"))
    plan = _plan(R.add_technical_recurrences(bars.dropDuplicates(["ticker", "t"])))
    # one exchange for the dedup and one for the per-ticker windows; the
    # pandas scans and later windows reuse the ticker partitioning
    assert plan.count("Exchange hashpartitioning(ticker") <= 2


def test_streaming_landing_appends_exactly_once(spark):
    from tickforge.streaming.landing import land_bar_pages
    base = tempfile.mkdtemp(prefix="stream-")
    landing, table, ckpt = (os.path.join(base, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(landing)

    def page(name, ticker, ts):
        with open(os.path.join(landing, name), "w") as f:
            f.write(json.dumps({"ticker": ticker, "results": [
                {"t": t, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10} for t in ts]}) + "\n")

    page("a.json", "AAA", [0, 86_400_000])
    land_bar_pages(spark, landing, table, ckpt).awaitTermination()
    page("b.json", "AAA", [2 * 86_400_000])
    page("c.json", "BBB", [0])
    land_bar_pages(spark, landing, table, ckpt).awaitTermination()
    land_bar_pages(spark, landing, table, ckpt).awaitTermination()   # nothing new: no duplicates
    got = spark.read.parquet(table)
    assert got.count() == 4
    assert got.filter(F.col("ticker") == "AAA").count() == 3


def test_prefix_scan_merges_schemas(spark):
    from tickforge.sources.tables import read_prefix
    base = tempfile.mkdtemp(prefix="prefix-")
    a = spark.createDataFrame([("A", 1.0)], "ticker string, c double")
    b = spark.createDataFrame([("B", 2.0, 5)], "ticker string, c double, n int")   # a column added later
    write_table(a, os.path.join(base, "t"), "ticker", None, mode="append")
    write_table(b, os.path.join(base, "t"), "ticker", None, mode="append")
    df = read_prefix(spark, os.path.join(base, "t"))
    assert set(df.columns) == {"ticker", "c", "n"}
    rows = {r["ticker"]: r for r in df.collect()}
    assert rows["A"]["n"] is None and rows["B"]["n"] == 5


def test_package_is_shipped_to_workers(spark):
    import zipfile
    from tickforge import session as S
    S.configure(spark)
    assert S._ZIP and spark.sparkContext.applicationId in S._SHIPPED
    names = set(zipfile.ZipFile(S._ZIP[0]).namelist())
    assert {"tickforge/__init__.py", "tickforge/operators/recurrence.py",
            "tickforge/plans/pipeline.py"} <= names


def test_entry_schema_is_stable(spark):
    import __spark_entry__ as E
    a, b = E.entry(spark).schema, E.entry(spark).schema
    assert a == b and len(a.fields) == 105


def test_numeric_tickers_keep_their_text(spark):
    out = tempfile.mkdtemp(prefix="num-")
    df = spark.createDataFrame([("005930", 1, 1.0), ("000660", 1, 2.0), ("AAPL", 1, 3.0)], "ticker string, t long, c double")
    write_table(df, out, "ticker", "t")
    assert {r["ticker"] for r in read_table(spark, out).collect()} == {"005930", "000660", "AAPL"}
    assert read_table(spark, out, ["005930"]).count() == 1


def test_hot_ticker_is_written_by_many_tasks(spark):
    out = tempfile.mkdtemp(prefix="hot-")
    df = spark.range(200_000).select(F.lit("HOT").alias("ticker"), F.col("id").alias("t"), F.rand(1).alias("c"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(df, out, "ticker", "t")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([f for f in os.listdir(os.path.join(out, "ticker=HOT")) if f.endswith(".parquet")]) > 1
    assert read_table(spark, out).count() == 200_000


def test_news_pages_keep_string_ids_and_other_fields(spark):
    import json
    from tickforge.sources.pages import read_news_pages
    out = tempfile.mkdtemp(prefix="news-")
    with open(os.path.join(out, "p.json"), "w") as f:
        f.write(json.dumps({"ticker": "X", "results": [{"id": "a1-b2", "published_utc": "2020-01-02T00:00:00Z", "title": "t",
                                                        "author": "someone", "amp_url": "http://x"}]}) + "\n")
    r = read_news_pages(spark, out).first()
    assert (r["id"], r["author"], r["amp_url"], r["keywords"], r["search_ticker"]) == ("a1-b2", "someone", "http://x", None, "X")


def test_news_drift_reads_back(spark):
    """A vendor field that changes its type from batch to batch stays readable, in one pass without inference."""
    base = tempfile.mkdtemp(prefix="drift-")
    table = os.path.join(base, "news")
    batches = [{"id": 1, "published_utc": "2020-01-02T10:00:00Z", "title": "a", "keywords": ["x"], "score": 1},
               {"id": "two", "published_utc": "2020-01-03T10:00:00Z", "title": {"odd": 1}, "keywords": None, "score": {"v": 1}},
               {"id": 3, "published_utc": None, "sco'res": [1, "b"], "score": "high", "title": "c"}]
    for k, r in enumerate(batches):
        d = os.path.join(base, f"land{k}")
        os.makedirs(d)
        with open(os.path.join(d, "p.json"), "w") as f:
            f.write(json.dumps({"ticker": f"T{k}", "results": [r]}) + "\n")
        write_table(read_news_pages(spark, d, table=table), table, "search_ticker", "published_utc")
    got = {r["search_ticker"]: r for r in read_table(spark, table, key="search_ticker", merge_schema=True).collect()}
    assert [got[f"T{k}"]["id"] for k in range(3)] == ["1", "two", "3"]
    assert [got[f"T{k}"]["score"] for k in range(3)] == [1, None, None]
    assert got["T0"]["keywords"] == ["x"] and "score" not in got["T0"]["extra"]
    assert got["T1"]["extra"]["score"] == '{"v":1}' and got["T2"]["extra"]["score"] == "high"
    assert got["T2"]["extra"]["sco'res"] == '[1,"b"]'


def test_schema_grows_and_never_narrows(spark):
    import pytest
    from tickforge.sources.schemas import SchemaConflict, stored_schema
    d = os.path.join(tempfile.mkdtemp(prefix="evolve-"), "t")
    write_table(spark.createDataFrame([("A", 1, 1.5, (1,))], "ticker string, n int, x float, s struct<a:int>"), d, "ticker", None)
    write_table(spark.createDataFrame([("005", 1 << 40, 2.5, (2, "z"), "new")], "ticker string, n long, x double, s struct<a:long,b:string>, y string"),
                d, "ticker", None)
    write_table(spark.createDataFrame([("C", 7)], "ticker string, n int"), d, "ticker", None)      # narrower: cast up
    got = {r["ticker"]: r for r in read_table(spark, d).collect()}
    assert got["A"]["n"] == 1 and got["005"]["n"] == 1 << 40 and got["C"]["n"] == 7 and got["C"]["y"] is None
    assert got["A"]["x"] == 1.5 and got["A"]["s"]["a"] == 1 and got["A"]["s"]["b"] is None and got["005"]["s"]["b"] == "z"
    assert stored_schema(spark, d)[0] == 2
    with pytest.raises(SchemaConflict, match="n: bigint and string"):
        write_table(spark.createDataFrame([("A", "x")], "ticker string, n string"), d, "ticker", None)
    assert read_table(spark, d).count() == 3


def test_writing_runs_the_plan_once(spark):
    """The rows behind a written table are computed once, though their ranges are sampled."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).selectExpr("concat('T', id % 7) AS ticker", "id AS t").mapInPandas(count, "ticker string, t long")
    d = os.path.join(tempfile.mkdtemp(prefix="once-"), "t")
    write_table(df, d, "ticker", "t")
    assert seen.value == 1000 and read_table(spark, d).count() == 1000
