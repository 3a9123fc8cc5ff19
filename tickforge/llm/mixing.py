"""Mixing sources to target weights by Pareto order sampling.

Sizes are words.  Sources, in code point order with null last, weigh 1, 2, 3 and
so on again; together they share the whole corpus.  A source's target is at most
``most`` times its size, and what is cut off is shared anew by weight among the
others until none is above.

Each document of a source is wanted r = target / size times: floor(r) certain
whole copies, and one more with chance f = r - floor(r).  For that copy documents
are ranked by Pareto order sampling, (u / (1 - u)) / (f / (1 - f)) with u a uniform
number hashed from the document, and are taken in that order until the words still
wanted are reached (a sample of fixed size, in words), each only if it fits whole.
As f is one number for a source and sources are drawn apart, these ranks order a source's documents as u does: the draw
is a sequential sample by u, in which all documents of a source are alike.
Last, the one untaken document that brings the source nearest to its target is
added, if that helps.

Scale: u is a hash, so the ranks are cut into ``cells`` equal cells for each
source.  Cells before the cut are taken and cells behind it are not, by their summed
sizes alone; only the one cell that holds the cut is put in order, so a source
with a third of all rows is never sorted in one task.  Only the table of sources
(one row for each) reaches the driver; it is checked to have at most
``max_sources`` rows and is then broadcast.

Null text has size 0; documents without words are never taken.  A source without
words has target 0.  Equal rows have equal ranks and differ by an ordinal.
Empty tables give no rows.  Reruns give the same sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import (WHITE_SPACE_CLASS, col, documents, free_name, written)

MOST, CELLS, SEED, MAX_SOURCES = 3, 4096, 7, 1_000_000


def words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    t = F.coalesce(text, F.lit(""))
    return F.regexp_count(t, F.lit(WHITE_SPACE_CLASS.replace("[", "[^") + "+")).cast("long")


def targets(sizes: dict, weights: dict, most: float = MOST) -> dict:
    """Words wanted of each source: shares of the total by weight, none above
    ``most`` times its size."""
    got, open_ = {}, {s for s in sizes if sizes[s] > 0}
    left = float(sum(sizes.values()))
    got = {s: 0.0 for s in sizes}
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > most * sizes[s]}
        if not over:
            for s in open_:
                got[s] = left * weights[s] / w
            break
        for s in sorted(over, key=lambda s: (s is None, s or "")):
            got[s] = float(most * sizes[s])
            left -= got[s]
        open_ -= over
    return got


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(1, 2, 3), most: int = MOST, cells: int = CELLS, seed: int = SEED,
        max_sources: int = MAX_SOURCES) -> DataFrame:
    """One row per row of ``docs``: (id, source, size, source_size, target, copies, taken, row_key)."""
    spark = docs.sparkSession
    text = F.coalesce(col(text_col), F.lit(""))
    rows = written(docs.select(
        col(id_col).alias("id"), col(source_col).cast("string").alias("source"),
        words(col(text_col)).alias("size"), F.xxhash64(text).alias("row_key"),
        F.monotonically_increasing_id().alias("rid"))
        .withColumn("u", (F.xxhash64("id", "row_key", F.lit(seed)).bitwiseAND((1 << 53) - 1) + F.lit(0.5))
                    / F.lit(float(1 << 53))))

    per = rows.groupBy("source").agg(F.sum("size").alias("s")).limit(max_sources + 1).collect()
    if len(per) > max_sources:
        raise ValueError(f"more than {max_sources} sources; group them, or raise max_sources")
    sizes = {r["source"]: int(r["s"]) for r in per}
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weigh = {s: weights[k % len(weights)] for k, s in enumerate(ordered)}
    want = targets(sizes, weigh, most)
    plan = []
    for s in ordered:
        r = want[s] / sizes[s] if sizes[s] else 0.0
        whole = min(int(r + 1e-9), most)
        plan.append((s, sizes[s], float(want[s]), whole, max(0.0, want[s] - whole * sizes[s])))
    table = F.broadcast(spark.createDataFrame(
        plan, "src string, source_size long, target double, whole int, need double"))

    joined = rows.join(table, rows["source"].eqNullSafe(table["src"])).drop("src")
    frac = F.when(F.col("source_size") > 0, F.col("need") / F.col("source_size")).otherwise(0.0)
    # Pareto rank; inside a source f is one number, so the order is that of u
    odds = (F.col("u") / (1 - F.col("u"))) / (frac / (1 - frac))
    ranked = (joined.withColumn("pareto", F.when((frac > 0) & (frac < 1), odds))
              .withColumn("cell", F.floor(F.col("u") * cells)))

    w = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cut = (ranked.groupBy("source", "cell").agg(F.sum("size").alias("b"), F.first("need").alias("nd"))
           .withColumn("before", F.coalesce(F.sum("b").over(w), F.lit(0)))
           .filter((F.col("before") <= F.col("nd")) & (F.col("before") + F.col("b") > F.col("nd")))
           .groupBy("source").agg(F.min("cell").alias("cut"), F.min_by("before", "cell").alias("before")))
    cut = F.broadcast(cut.select(F.col("source").alias("src"), "cut", "before"))   # one row for each source
    placed = ranked.join(cut, ranked["source"].eqNullSafe(cut["src"]), "left").drop("src")

    inside = F.col("cell") == F.col("cut")
    order = Window.partitionBy("source").orderBy("pareto", "id", "row_key", "rid")
    edge = (placed.filter(inside).withColumn("run", F.sum("size").over(order))
            .withColumn("extra", ((F.col("before") + F.col("run") <= F.col("need"))
                                  & F.col("pareto").isNotNull()).cast("int")).drop("run"))
    rest = placed.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "extra", (F.col("pareto").isNotNull()
                  & (F.col("cut").isNull() | (F.col("cell") < F.col("cut")))).cast("int"))
    drawn = edge.unionByName(rest)

    # closing document: the untaken one that brings a source nearest to its target
    gaps = (drawn.groupBy("source").agg(
        (F.first("need") - F.sum(F.col("extra") * F.col("size"))).alias("gap")))
    gaps = F.broadcast(gaps.select(F.col("source").alias("src"), "gap"))
    free = (drawn.filter((F.col("extra") == 0) & (F.col("size") > 0) & F.col("pareto").isNotNull())
            .join(gaps, drawn["source"].eqNullSafe(gaps["src"])).drop("src")
            .filter(F.abs(F.col("size") - F.col("gap")) < F.abs("gap")))
    close = (free.groupBy("source").agg(F.min(F.struct(
        F.abs(F.col("size") - F.col("gap")).alias("off"), F.col("pareto").alias("p"), F.col("rid").alias("rid")))
        .alias("best")).select(F.col("best.rid").alias("close_rid")))
    out = (drawn.join(F.broadcast(close), drawn["rid"] == close["close_rid"], "left")
           .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.col("extra")
                                        + F.col("close_rid").isNotNull().cast("int")).otherwise(0)))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
                      "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
                      "row_key", "rid")


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                **options) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as the mix takes it."""
    n, key, key2, src, own, rn, of, copy, c = (free_name(docs, x) for x in (
        "_copies", "_mix_id", "_mix_key", "_mix_source", "_mix_text", "_mix_rn", "_mix_of", "_mix_copy", "_mix_c"))
    m = mix(docs, id_col, text_col, source_col, **options)
    # rows that agree in id, source and text are interchangeable: their copies are summed
    # and dealt evenly in row-hash order
    per = (m.filter("copies > 0").groupBy(col(id_col).alias(key), col(source_col).alias(src), F.col("row_key").alias(key2))
           .agg(F.sum("copies").alias(c)))
    from tickforge.llm.common import row_hash
    left = docs.withColumn(own, F.xxhash64(F.coalesce(col(text_col), F.lit(""))))
    j = left.join(per, left[id_col].eqNullSafe(per[key]) & (left[own] == per[key2])
                  & left[source_col].cast("string").eqNullSafe(per[src]))
    same = Window.partitionBy(key, key2, src)
    j = (j.withColumn(rn, F.row_number().over(same.orderBy(row_hash(docs))))
         .withColumn(of, F.count(F.lit(1)).over(same))
         .withColumn(n, F.floor(F.col(c) / F.col(of)) + (F.col(rn) <= F.col(c) % F.col(of)).cast("int"))
         .filter(col(n) > 0))
    return (j.withColumn(copy, F.explode(F.sequence(F.lit(1), col(n).cast("int"))))
            .select(*[col(x) for x in docs.columns]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = None
