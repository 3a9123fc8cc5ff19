"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: longs) that is not the smallest of its
    component; root is that smallest node.

    Each round hooks every node to its smallest smaller neighbour, flattens the trees by
    pointer jumping, and contracts the links; the tables shrink from round to round.  All
    steps are joins and grouped minima over links; nothing is gathered.
    """
    edges = _ordered(links.select("a", "b"))
    labels = None
    while not edges.isEmpty():
        hook = written(edges.groupBy("a").agg(F.min("b").alias("p")))
        while True:
            up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            jumped = written(hook.join(up, "p", "left")
                                  .select("a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")))
            hook = jumped.select("a", "p")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = hook
        else:
            up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            labels = written(labels.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"))
                                  .unionByName(hook))
        to = hook.select(F.col("a").alias("n"), F.col("p").alias("r"))
        edges = (edges.join(to.toDF("a", "ra"), "a", "left").join(to.toDF("b", "rb"), "b", "left")
                 .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
        edges = _ordered(edges)
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, root long")
    return labels.select(F.col("a").alias("node"), F.col("p").alias("root"))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, root) after more ``links`` (a, b): only the roots that the links touch move."""
    a, b = (labels.toDF(k, "r" + k) for k in "ab")
    over = written(links.join(a, "a", "left").join(b, "b", "left")
                   .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    moved = components(over).toDF("root", "to")
    return written(labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
                   .unionByName(moved.select(F.col("root").alias("node"), F.col("to").alias("root")))
                   .distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct())
