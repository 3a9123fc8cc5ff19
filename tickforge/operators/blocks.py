"""Block-parallel windows for long series.

A per-key window puts a whole series into one task.  For series that are too
long for that (a hot ticker, tick-level data), rows carry a dense per-key row
number (``recurrence.with_row_numbers``) and are cut into blocks of ``m``
rows, so windows run over ``partitionBy(key, block)``:

* finite frames reaching ``back`` rows into the past (or ``fwd`` rows into
  the future) see copies of those rows from the neighbouring block (a halo),
  which are dropped afterwards: exact for frames up to ``m`` rows;
* running sums and forward / backward fills take a carry from a per-(key,
  block) summary of (#keys x #blocks) rows, prefix-summed over blocks.

Every shuffle is by (key, block), so a series of any length spreads over
``rows / m`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLK, HALO = "_blk", "_halo"


def block_of(rn: str, m: int) -> F.Column:
    return F.floor(F.col(rn) / F.lit(m)).cast("long")


def block_window(key: str, rn: str):
    """The window every blocked expression uses: per (key, block), row order."""
    return Window.partitionBy(key, BLK).orderBy(rn)


def with_halo(df: DataFrame, rn: str, m: int, back: int = 0, fwd: int = 0) -> DataFrame:
    """Each row in its block, plus copies of the last ``back`` rows of every
    block in the next block and of the first ``fwd`` rows in the previous
    one, flagged ``_halo``."""
    if back > m or fwd > m:
        raise ValueError(f"halo ({back}, {fwd}) larger than the block ({m} rows)")
    b = block_of(rn, m)
    pos = F.col(rn) - b * F.lit(m)
    place = lambda blk, halo: F.struct(blk.alias(BLK), F.lit(halo).alias(HALO))
    places = [place(b, False)]
    if back:
        places.append(F.when(pos >= m - back, place(b + 1, True)))
    if fwd:
        places.append(F.when((pos < fwd) & (b > 0), place(b - 1, True)))
    x = df.select("*", F.explode(F.array_compact(F.array(*places))).alias("_at"))
    return x.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"_at.{BLK}").alias(BLK), F.col(f"_at.{HALO}").alias(HALO))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO, BLK)


def running_sums(df: DataFrame, key: str, rn: str, m: int, cols: dict) -> DataFrame:
    """``{out: column}`` -> running sum of each column from the series start,
    as an in-block running sum plus the sum of all earlier blocks."""
    b = block_of(rn, m)
    x = df.select("*", b.alias(BLK))
    tot = x.groupBy(key, BLK).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in cols.items()])
    prior = Window.partitionBy(key).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(key, BLK, *[F.coalesce(F.sum(f"_t_{o}").over(prior), F.lit(0.0)).alias(f"_k_{o}")
                                   for o in cols])
    j = x.join(carry, [key, BLK], "left")
    inner = Window.partitionBy(key, BLK).orderBy(rn).rowsBetween(Window.unboundedPreceding, 0)
    out = [(F.col(f"_k_{o}") + F.sum(c).over(inner)).alias(o) for o, c in cols.items()]
    return j.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def fill_blocks(df: DataFrame, cols: Sequence[str], key: str, rn: str, m: int,
                direction: str = "backward") -> DataFrame:
    """Forward or backward fill of ``cols`` across blocks: the in-block fill,
    else the nearest non-null value of an earlier (later) block from a
    per-(key, block) summary."""
    b = block_of(rn, m)
    x = df.select("*", b.alias(BLK))
    fwd = direction == "forward"
    pick = F.max_by if fwd else F.min_by
    summ = x.groupBy(key, BLK).agg(*[pick(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(rn)))
                                    .alias(f"_e_{i}") for i, c in enumerate(cols)])
    order = F.col(BLK) if fwd else F.col(BLK).desc()
    prior = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(key, BLK, *[F.last(f"_e_{i}", True).over(prior).alias(f"_c_{i}")
                                    for i in range(len(cols))])
    j = x.join(carry, [key, BLK], "left")
    o = F.col(rn) if fwd else F.col(rn).desc()
    inner = Window.partitionBy(key, BLK).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    idx = {c: i for i, c in enumerate(cols)}
    sel = [F.coalesce(F.last(F.col(f"`{c}`"), True).over(inner), F.col(f"_c_{idx[c]}")).alias(c)
           if c in idx else F.col(f"`{c}`") for c in df.columns]
    return j.select(*sel)
