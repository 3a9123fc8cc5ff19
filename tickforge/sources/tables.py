"""Partitioned tables (S4-S8): overwrite by key with dynamic partition
overwrite, scans with key pruning, schema evolution on write and read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.session import scratch_path
from tickforge.sources.schemas import merged, reconciled, store_schema, stored_schema


def write_table(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = "ticker",
                order: str | None = "t", fmt: str = "parquet", mode: str = "overwrite", evolve: bool = True) -> None:
    """Write partitioned by key; only the partitions present in ``df`` are
    replaced (dynamic overwrite).  Rows are dealt by ranges of (key, ``order``) and sorted
    inside each file, so a later scan of one key reads few, ordered files, and a key with
    many rows is written by many tasks.

    The rows are staged once in the shared checkpoint folder: finding the ranges samples its two columns there, and the
    plan behind ``df`` runs once.  With ``evolve`` the table's schema is stored beside it, and a later write
    may add or widen columns (``sources.schemas``); what is neither raises before anything is written."""
    spark = df.sparkSession
    if evolve:
        had = stored_schema(spark, path)
        schema = df.schema if had is None else merged(had[1], df.schema)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        df = df if had is None else reconciled(df, schema)
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    out = df
    if parts:
        by = [*parts, *([order] if order else [])]
        staged = scratch_path(spark, f"staged-{uuid.uuid4().hex[:12]}")
        df.write.parquet(staged)
        out = (spark.read.schema(df.schema).parquet(staged)
               .repartitionByRange(*[F.col(p) for p in by]).sortWithinPartitions(*by))
    elif order:
        out = out.sortWithinPartitions(order)
    w = (out.write.mode(mode).format(fmt)
         .option("partitionOverwriteMode", "dynamic"))
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    if evolve and (had is None or had[1] != schema):
        store_schema(spark, path, schema, 1 if had is None else had[0] + 1)


def read_table(spark: SparkSession, path: str, tickers: Sequence[str] | None = None,
               key: str = "ticker", fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Scan a table, optionally restricted to some keys.  On a partitioned
    table the key predicate prunes directories (``PartitionFilters``);
    otherwise it is pushed to the Parquet reader (``PushedFilters``).

    The stored schema is used where there is one: no footer is read to find it, and files written before a column was
    added or widened read as null or wider (S8).  Without one, ``merge_schema`` reconciles files with added
    columns; it reads every file's footer.  The key is a string as it was written: Spark would guess a number from
    the folder names (``005930`` as 5930)."""
    had = stored_schema(spark, path)
    if had is not None:
        schema = had[1]
    else:
        read = spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower())
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == key else f.dataType)
                               for f in read.load(path).schema.fields])
    df = spark.read.format(fmt).schema(schema).load(path)
    if tickers is not None:
        df = df.filter(F.col(key).isin(list(tickers)))
    return df


def read_prefix(spark: SparkSession, prefix: str, fmt: str = "parquet", merge_schema: bool = True) -> DataFrame:
    """Every file under a prefix as one table (S6, U1): Spark lists and
    unions the files itself, with partition discovery.  ``merge_schema`` reads every footer; without it all
    files are taken to have the columns of one."""
    return spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower()).load(prefix)
