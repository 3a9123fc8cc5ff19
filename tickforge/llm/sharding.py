"""Sharding by sampled splitters: contiguous key ranges of near equal bytes.

A record's key is (64-bit hash of its text, id, ordinal), so equal texts are
neighbours and a group is cut only where a shard is full.

1. One pass leaves narrow rows (key, size, CRC-32), written once.
2. Keys are sampled with chance in proportion to size, ``per_shard`` for each
   shard on average.  The sample's size does not grow with the input; its
   quantiles are the splitters, and records larger than a sampling step are
   always drawn.
3. Records are dealt into ranges by binary search.  Ranges that turn out to hold
   more than ``overfull`` times their share are subdivided by ever denser samples of
   their own keys (four times as dense each time, eight times at most: 65,536 times as dense as the first).
4. Running sizes inside each range plus the sum of the ranges before it give each
   record's exact place in the whole; its midpoint decides the shard.  Shards
   therefore differ by less than one record, whatever the sample was.

Law ``bytes``.  Ids may have any type.  Null text has size ``overhead``; empty tables give no rows; null
ids sort first; repeated rows are told apart by an ordinal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import col, documents, free_name, written

SHARDS, OVERHEAD = 40, 16
#: Ranges and mean number of sampled keys for each shard; share over which a range is subdivided.
RANGES_PER_SHARD, PER_SHARD, OVERFULL = 16, 256, 4.0


def _packed(h, i, r) -> np.ndarray:
    """Order-preserving 24-byte keys of three signed 64-bit columns."""
    m = np.empty((len(h), 3), dtype=">u8")
    for k, v in enumerate((h, i, r)):
        m[:, k] = np.asarray(v, dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return m.view("S24").ravel() if len(h) else np.empty(0, "S24")


def _sample(rows: DataFrame, step: float, salt: int) -> np.ndarray:
    """Sorted packed keys of records drawn with chance size / step (1 above it)."""
    u = (F.xxhash64("h", "i", "rid", F.lit(salt)).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53)))
    pdf = rows.filter(u * F.lit(float(step)) < F.col("size")).select("h", "i", "rid").toPandas()
    return np.sort(_packed(pdf["h"], pdf["i"], pdf["rid"]))


def _ranged(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    bounds = splitters.tobytes()

    @F.pandas_udf("long")
    def which(h: pd.Series, i: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.frombuffer(bounds, "S24"), _packed(h, i, r), side="right"))

    return rows.withColumn("range", which("h", "i", "rid"))


def _whole_number(docs: DataFrame, id_col: str):
    """Ids as whole numbers: themselves, the hash of others, the least for null (they only break ties of the text hash)."""
    kind = docs.schema[id_col].dataType
    i = col(id_col).cast("long") if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else F.when(
        col(id_col).isNotNull(), F.xxhash64(col(id_col)))
    return F.coalesce(i, F.lit(-(1 << 63)))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          overhead: int = OVERHEAD) -> DataFrame:
    """One row per row of ``docs``: (id, size, text_crc32, law, shard, slot, grown_shard)."""
    text = F.coalesce(col(text_col), F.lit(""))
    rows = written(docs.select(
        col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("crc"),
        F.xxhash64(text).alias("h"),
        _whole_number(docs, id_col).alias("i"),
        F.monotonically_increasing_id().alias("rid")))
    total = rows.agg(F.sum("size")).first()[0] or 0
    n_ranges = shards * RANGES_PER_SHARD
    step = max(1.0, total / (shards * PER_SHARD))
    share = total / n_ranges
    drawn = _sample(rows, step, 0)
    cut = np.unique(drawn[np.linspace(0, len(drawn), n_ranges + 1)[1:-1].astype(int)]) if len(drawn) else drawn
    for salt in range(1, 9):
        ranged = _ranged(rows, cut)
        sums = (ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
                .toPandas())
        full = sums[(sums["bytes"] > OVERFULL * share) & (sums["n"] > 64)]["range"].tolist()
        if not full:
            break
        more = _sample(ranged.filter(F.col("range").isin(full)), step / (4 ** salt), salt)
        cut = np.unique(np.concatenate([cut, more[::8]]))
    ranged = written(ranged, "ranged")

    # exact places: running sums in each range, behind the sum of the ranges before it
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (spark_frame(docs.sparkSession, sums)
               .withColumn("bytes_before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
               .withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .select("range", "bytes_before", "rows_before"))
    run = Window.partitionBy("range").orderBy("h", "i", "rid")
    placed = (ranged.withColumn("upto", F.sum("size").over(run)).withColumn("pos", F.row_number().over(run))
              .join(F.broadcast(offsets), "range")      # one row for each range: bounded by the splitters
              .withColumn("mid2", 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size"))
              .withColumn("shard", F.least(F.lit(shards - 1), F.floor(
                  F.col("mid2") * F.lit(shards) / F.lit(2 * max(total, 1)))).cast("int"))
              .withColumn("place", F.col("rows_before") + F.col("pos")))
    # a shard's first place, from one row for each (range, shard)
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return (placed.join(F.broadcast(first), "shard")
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def spark_frame(spark: SparkSession, sums: pd.DataFrame) -> DataFrame:
    return spark.createDataFrame([tuple(map(int, r)) for r in sums[["range", "bytes", "n"]].itertuples(index=False)],
                                 "range long, bytes long, n long")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> None:
    """Write ``docs`` as one Parquet folder for each shard (``shard=K``), rows in ``slot`` order; every row once, whatever its
    id.  The rows get an ordinal in a table written first, and are joined to their places by it.  If ``docs`` has a
    column ``shard`` or ``slot``, the new one gets underscores before its name."""
    row, shard_col, slot = (free_name(docs, x) for x in ("row", "shard", "slot"))
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    places = shard(rows, id_col=row, **options).select(col(row).alias("_place_of"), F.col("shard").alias(shard_col), F.col("slot").alias(slot))
    out = rows.join(places, rows[row] == places["_place_of"]).drop("_place_of", row)
    (out.repartitionByRange(col(shard_col), col(slot)).sortWithinPartitions(col(shard_col), col(slot))
     .write.partitionBy(shard_col).parquet(path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


ORACLE_SQL = None
