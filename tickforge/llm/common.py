"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import itertools
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import scratch_path

#: The ASCII white space that separates words: space and \\t \\n \\v \\f \\r.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WHITE_SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Tables that are written between two collections of the driver's garbage.
TIDY = 8
_TABLES = itertools.count(1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a table as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage like ``checkpoint()``, but the reread table also has its real size: the estimates that a
    checkpointed table keeps multiply with every join of a loop."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    if next(_TABLES) % TIDY == 0:
        tidy(spark)
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage.  Spark drops the shuffles and broadcasts of steps that have ended only when the driver's
    JVM finds that nothing refers to them; by itself it lets its heap grow to the limit first."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it
    (column names clash without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """Column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def apart(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own identity, so that it can be co-grouped with a table it shares a source with."""
    return df.select(*[col(c).alias(c) for c in df.columns])


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash of a row over all columns that can be hashed."""
    use = [f.name for f in df.schema.fields
           if (columns is None or f.name in columns) and "map" not in f.dataType.simpleString()]
    return F.xxhash64(*[col(c) for c in use])


def keep_decided(docs: DataFrame, kept: DataFrame, on: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose expressions ``on`` equal a row of ``kept`` (null
    equals null), one for each row of ``kept``.

    ``kept`` has one column for each key of ``on``, without repeats.  Rows of
    ``docs`` that agree on every key are interchangeable; the one with the
    smallest row hash stays.  The join and the window share one exchange.
    """
    from pyspark.sql import Window

    tmp = {k: free_name(docs, f"_on_{k}") for k in on}
    rn, rh = free_name(docs, "_rn"), free_name(docs, "_rh")
    left = docs.withColumns({tmp[k]: e for k, e in on.items()} | {rh: row_hash(docs)})
    right = kept.select(*[col(k).alias(f"_k_{k}") for k in on])
    cond = None
    for k in on:
        c = left[tmp[k]].eqNullSafe(right[f"_k_{k}"])
        cond = c if cond is None else cond & c
    joined = left.join(right, cond, "left_semi")
    w = Window.partitionBy(*[col(t) for t in tmp.values()]).orderBy(col(rh))
    return (joined.withColumn(rn, F.row_number().over(w)).filter(col(rn) == 1)
            .select(*[col(c) for c in docs.columns]))
