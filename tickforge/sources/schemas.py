"""Schemas of written tables (S4, S8): stored beside the data, versioned, and reconciled before a write.

A column may be added (older rows read as null) or widened; a narrower incoming column is cast up to the stored type.  Nothing is
ever narrowed: a change that is no widening raises before any file is touched.  Widenings are those that Spark's Parquet reader
performs on older files: whole numbers to longer ones, int to double, float to double, more decimal digits, date to timestamp
without zone, and the same inside structs, arrays and maps (a struct may get fields).

A version is one text file in ``<table>/_schemas/<number>`` (folders that begin with ``_`` are no data to Spark).  Versions are
never changed; the newest counts.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "_schemas"
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
#: What a type may become, besides longer whole numbers.
_WIDER = {(T.FloatType, T.DoubleType), (T.ByteType, T.DoubleType), (T.ShortType, T.DoubleType),
          (T.IntegerType, T.DoubleType), (T.DateType, T.TimestampNTZType)}


class SchemaConflict(ValueError):
    """An incoming column that is neither equal to, narrower nor wider than the stored one."""


def wider(a: T.DataType, b: T.DataType, where: str = "value") -> T.DataType:
    """The type that holds both: one of them, or a nested type made of such."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b, where)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, f"{where}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider(a.valueType, b.valueType, f"{where}[]"), a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        if scale + whole <= 38:
            return T.DecimalType(scale + whole, scale)
    kinds = type(a), type(b)
    if all(k in _WHOLE for k in kinds):
        return a if _WHOLE.index(kinds[0]) >= _WHOLE.index(kinds[1]) else b
    if kinds in _WIDER:
        return b
    if kinds[::-1] in _WIDER:
        return a
    raise SchemaConflict(f"{where}: {a.simpleString()} and {b.simpleString()} have no common wider type")


def merged(stored: T.StructType, incoming: T.StructType, where: str = "") -> T.StructType:
    """``stored`` with the columns of ``incoming`` added or widened; columns keep their order, names clash without regard to case."""
    new = {f.name.lower(): f for f in incoming.fields}
    out = []
    for f in stored.fields:
        g = new.pop(f.name.lower(), None)
        at = f"{where}.{f.name}" if where else f.name
        out.append(f if g is None else T.StructField(f.name, wider(f.dataType, g.dataType, at), True))
    return T.StructType(out + [T.StructField(g.name, g.dataType, True) for g in incoming.fields if g.name.lower() in new])


def stored_schema(spark: SparkSession, path: str) -> tuple[int, T.StructType] | None:
    """(version, schema) of a table, or None where none was stored."""
    try:
        rows = spark.read.option("wholetext", "true").text(f"{path.rstrip('/')}/{FOLDER}/*")
        newest = rows.agg(F.max_by("value", F.get_json_object("value", "$.version").cast("int")).alias("v")).first()["v"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if newest is None:
        return None
    d = json.loads(newest)
    return d["version"], T.StructType.fromJson(d["schema"])


def store_schema(spark: SparkSession, path: str, schema: T.StructType, version: int) -> None:
    text = json.dumps({"version": version, "schema": schema.jsonValue()})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path.rstrip('/')}/{FOLDER}/{version:08d}")


def reconciled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; columns it lacks are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`").cast(f.dataType) if f.name.lower() in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
