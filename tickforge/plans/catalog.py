"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables.  Double columns are rounded on both sides, because float
summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.session import configure

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

# Results are snapped to a binary grid of 2**-20 (about 1e-6): scaling by a
# power of two is exact in IEEE arithmetic, and the grid's half-way points
# are dyadic numbers that cents / quantities practically never hit, so both
# engines snap a value and its last-bit-noisy twin to the same double.
GRID_BITS = 20
DIGITS = GRID_BITS


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return run
    return deco


def _rnd(x, digits: int):
    # explicit scale-round-unscale, the same IEEE steps the SQL side takes
    # (decimal rounding would split values that sit exactly on a half)
    k = float(2 ** digits)
    r = F.round(x * F.lit(k)) / F.lit(k)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)  # one zero: -0.0 -> 0.0


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double (and array-of-double) column for hash-stable compares."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = _rnd(c, digits)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            c = F.transform(c, lambda x: _rnd(x, digits))
        elif (isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.ArrayType)
              and isinstance(f.dataType.elementType.elementType, T.DoubleType)):
            c = F.transform(c, lambda a: F.transform(a, lambda x: _rnd(x, digits)))
        out.append(c.alias(f.name))
    return df.select(*out)


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_all() -> None:
    # importing the modules registers their queries
    from tickforge.plans import q_bars, q_frames, q_io, q_learn, q_prep, q_recur, q_silver, q_text  # noqa: F401
