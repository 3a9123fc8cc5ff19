"""Exact dedup by a heavy-hitter split (DataFrame functions only).

1. One pass over the texts leaves a narrow table (id, length, SHA-256 of the
   text without white space), written once.
2. Misra-Gries counters (Spark's ``approx_top_k``, a frequent-items sketch that
   combines map-side) name the digests that may be frequent.  Every digest with
   more than about 4 / ``counters`` of all rows is among them.
3. The named digests are counted exactly with map-side combining; each one's
   best row and size (at most ``heavy`` rows of fixed width) are broadcast, so rows of
   frequent digests are settled where they are read and never shuffled.
4. All other digests are shuffled once, as narrow rows, and settled by a window.

Order of preference inside a group: more code points, then smaller id (null
last).  Rows that agree in id and text are told apart by an ordinal fixed by
that table; exactly one row of a group is kept.

Null text counts as empty; empty and white-space texts form one group; an empty
table gives an empty result.  Other columns never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import (WHITE_SPACE, col, documents, keep_decided, written)

#: Digests that may be broadcast, and counters of the frequent-items sketch.
HEAVY, COUNTERS = 256, 4096


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256)."""
    rows = written(docs.select(
        col(id_col).alias("id"),
        F.length(F.coalesce(col(text_col), F.lit(""))).alias("len"),
        digest(col(text_col)).alias("digest"),
        F.monotonically_increasing_id().alias("rid")))
    rank = F.struct((-F.col("len")).alias("l"), F.col("id").isNull().alias("n"),
                    F.col("id").alias("id"), F.col("rid").alias("rid"))

    named = (rows.agg(F.expr(f"approx_top_k(digest, {heavy}, {counters})").alias("top"))
             .select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest")))
    winners = (rows.join(F.broadcast(named), "digest", "left_semi")
               .groupBy("digest")
               .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
               .filter("group_size > 1"))
    marked = rows.join(F.broadcast(winners), "digest", "left")

    frequent = marked.filter("best is not null")
    w = Window.partitionBy("digest")
    rest = (marked.filter("best is null").drop("best", "group_size")
            .withColumn("best", F.first(rank).over(w.orderBy(rank)))
            .withColumn("group_size", F.count(F.lit(1)).over(w)))
    return frequent.unionByName(rest).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("group_size"),
        (F.col("best.rid") == F.col("rid")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    kept = (exact_dedup(docs, id_col, text_col).filter("kept")
            .select(col(id_col).alias("id"), F.col("text_sha256").alias("digest")))
    return keep_decided(docs, kept, {"id": col(id_col), "digest": digest(col(text_col))})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d
"""
