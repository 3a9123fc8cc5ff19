"""Exact per-key quantiles without gathering a key's values in one task.

``percentile`` keeps a map of every distinct value of a group in one
aggregation buffer, so a key holding a third of all rows is one task holding
a third of all values.  Here:

1. ``(key, value)`` counts: duplicates collapse map-side (partial
   aggregation), so a hot value costs one row;
2. a range-partitioned sort on (key, value) spreads a hot key over many
   partitions; position ids are fixed once by a checkpoint in the shared
   checkpoint folder;
3. weighted ranks: a running count inside each (key, partition) slice plus
   prefix-summed slice totals (a #keys x #partitions summary) give every
   distinct value its rank range [lo, hi);
4. the one or two values whose ranges hold floor / ceil of q * (N - 1) are
   picked and interpolated with ``percentile``'s own formula, so results
   equal ``percentile`` exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, key: str, value, qs: Sequence[float] = (0.5,),
                    names: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Per key, exact linearly interpolated quantiles of ``value`` (nulls
    ignored), one column per q: (key, q_..)."""
    from tickforge.session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    names = list(names or [f"q_{q:g}" for q in qs])
    v = F.col(value) if isinstance(value, str) else value
    d = (df.select(F.col(key), v.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
         .groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_w")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (d.repartitionByRange(n, F.col(key), F.col("_v")).sortWithinPartitions(key, "_v")
         .withColumn("_gid", F.monotonically_increasing_id())
         .checkpoint(eager=True)
         .withColumn("_pid", F.shiftright(F.col("_gid"), 33)))
    inner = Window.partitionBy(key, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_cum", F.sum("_w").over(inner))
    tot = s.groupBy(key, "_pid").agg(F.sum("_w").alias("_pw"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    offs = tot.select(key, "_pid", F.coalesce(F.sum("_pw").over(before), F.lit(0)).alias("_off"),
                      F.sum("_pw").over(whole).alias("_n"))
    r = s.join(offs, [key, "_pid"], "inner")
    r = r.select(key, "_v", "_n", (F.col("_off") + F.col("_cum") - F.col("_w")).alias("_lo"),
                 (F.col("_off") + F.col("_cum")).alias("_hi"))
    aggs = []
    for q, nm in zip(qs, names):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        inside = lambda k: (F.col("_lo") <= k) & (k < F.col("_hi"))
        aggs += [F.max(F.when(inside(lo), F.col("_v"))).alias(f"_vl{nm}"),
                 F.max(F.when(inside(hi), F.col("_v"))).alias(f"_vh{nm}")]
    # only rows holding a wanted rank survive the filter: at most two per key and q
    want = None
    for q in qs:
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        c = ((F.col("_lo") <= F.floor(pos)) & (F.floor(pos) < F.col("_hi"))) | \
            ((F.col("_lo") <= F.ceil(pos)) & (F.ceil(pos) < F.col("_hi")))
        want = c if want is None else want | c
    g = r.filter(want).groupBy(key).agg(F.first("_n").alias("_n"), *aggs)
    out = [F.col(key)]
    for q, nm in zip(qs, names):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        interp = (hi - pos) * F.col(f"_vl{nm}") + (pos - lo) * F.col(f"_vh{nm}")
        out.append(F.when(lo == hi, F.col(f"_vl{nm}")).otherwise(interp).alias(nm))
    return g.select(*out)
