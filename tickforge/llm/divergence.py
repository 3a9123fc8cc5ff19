"""Source divergence audit: how far apart the vocabularies of the sources of a language are.

Terms are runs of ASCII letters and non-ASCII characters, only A-Z in lower case.  A language keeps the terms that
occur in at least ``min_docs`` of its documents.  With N a group's occurrences of kept terms and V the number of kept
terms, a term's smoothed share is p = 1 + floor(scale * (count + smooth) / (N + smooth * V)), in whole numbers.

1. Each task counts occurrences and documents per (lang, source, term) in bounded tables and emits them when they are
   full, so a hot source or term leaves a task as one row per table and not per occurrence.
2. The tasks' counts are added by (lang, source, term), and these by (lang, term), which gives the kept terms.  They are dealt into blocks of about ``BLOCK`` terms by hash; a term's id
   is its place in its block.
3. Each group's counts of a block are one array sorted by term id (at most about ``BLOCK`` entries).
4. Pair tasks: the arrays of two tiles of ``TILE`` sources are co-grouped for each block; every unordered pair of
   sources in them is merged by galloping: ids of the shorter array are looked for in the longer one in windows whose end
   is found by doubling.  Overlaps, terms of one side and terms of neither are priced, both ways at once, since the price
   is symmetric.  The sums of the blocks are added up.
5. Terms whose share in a group exceeds the language's are ranked per group; only the first ``top`` stay (a partial limit runs
   before the shuffle).

Nothing is sampled or capped.  Null text, lang and source are read as ''.  A group without terms still meets all other
sources of its language, by its smoothed shares; a language without kept terms gives its pairs the value 0.  Ties rank by item in
UTF-8 order.  Repeated rows count each time.  An empty table gives no row.  Other columns never matter.  Exact while
N + smooth * V stays below 9.2e15.
"""

from __future__ import annotations

from collections import _count_elements
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import apart, col, documents, written

#: Entries of a task's count tables before they are emitted; terms of a block; sources of a tile; bytes counted at a time.
ENTRIES, BLOCK, TILE, PIECE = 700_000, 1 << 16, 16, 1 << 20
MIN_DOCS, SMOOTH, TOP = 30, 5, 50
#: Fixed value: shares are in parts of 10^9, multiplied in three steps of 10^3.
STEPS, STEP = 3, 1000

#: Bytes of a text as letters (A-Z in lower case, bytes of non-ASCII characters) or a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term binary, n long, docs long"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, about ``PIECE`` bytes at a time."""
    if len(text) <= PIECE:
        yield text.translate(_LETTERS).split()
        return
    at = 0
    while at < len(text):
        to, tail = min(len(text), at + PIECE), b""
        block = text[at:to].translate(_LETTERS)
        while to < len(text) and not block.endswith(b" "):        # do not cut a term
            nxt = text[to:to + 4096].translate(_LETTERS)
            cut = nxt.find(b" ")
            tail = nxt if cut < 0 else nxt[:cut + 1]
            block, to = block + tail, to + len(tail)
        yield block.split()
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[tuple[str, str], tuple[dict, dict]] = {}
    entries = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in tables.items():
            terms = [b"", *n]                                      # the empty term tells that the group occurs
            for at in range(0, len(terms), 1 << 15):
                part = terms[at:at + (1 << 15)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                     pa.array(part, pa.binary()), pa.array([n.get(t, 0) for t in part], pa.int64()),
                     pa.array([docs.get(t, 0) for t in part], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            n, docs = tables.setdefault((lang, source), ({}, {}))
            before, seen = len(n), set()
            for terms in _pieces(text.as_py()):
                _count_elements(n, terms)
                seen.update(terms)
            _count_elements(docs, seen)
            entries += len(n) - before
            if entries >= ENTRIES:
                yield from rows()
                tables.clear()
                entries = 0
    yield from rows()


def share(count: Column, total: Column, terms: Column, smooth: int = SMOOTH) -> Column:
    """1 + floor(10^9 * (count + smooth) / (total + smooth * terms)), by long division in steps."""
    below = (total + F.lit(smooth) * terms).cast("long")
    rest, out = (count + F.lit(smooth)).cast("long"), F.lit(0).cast("long")
    for _ in range(STEPS):
        scaled = rest * F.lit(STEP)
        digit = F.call_function("div", scaled, below)
        rest, out = scaled - digit * below, out * F.lit(STEP) + digit
    return out + F.lit(1)


def _shares(count: np.ndarray, total: int, terms: int, smooth: int) -> np.ndarray:
    below = total + smooth * terms
    rest, out = np.asarray(count, np.int64) + smooth, np.zeros(len(count), np.int64)
    for _ in range(STEPS):
        rest = rest * STEP
        digit = rest // below
        rest, out = rest - digit * below, out * STEP + digit
    return out + 1


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each id of ``short`` its place in ``long`` (both sorted, distinct), or -1.  The ids are looked for a
    run at a time in a window whose end is found by doubling from the end of the run before."""
    out = np.full(len(short), -1, np.int64)
    at, run = 0, 64
    for k in range(0, len(short), run):
        ids = short[k:k + run]
        width, last = run, ids[-1]
        while at + width < len(long) and long[at + width] < last:
            width *= 2
        window = long[at:at + width + 1]
        place = np.searchsorted(window, ids)
        inside = place < len(window)
        hit = np.zeros(len(ids), bool)
        hit[inside] = window[place[inside]] == ids[inside]
        out[k:k + run][hit] = at + place[hit]
        at += int(place[-1])
    return out


def merge_price(x: tuple, y: tuple, kept: int) -> int:
    """Sum of abs(p_x - p_y) over the ``kept`` terms of a block.  x, y: (ids, shares, share of an absent term)."""
    if len(x[0]) > len(y[0]):
        x, y = y, x
    (xi, xp, x0), (yi, yp, y0) = x, y
    place = gallop(xi, yi)
    both = place >= 0
    overlap = np.abs(xp[both] - yp[place[both]]).sum()
    only_x = np.abs(xp[~both] - y0).sum()
    only_y = np.abs(yp - x0).sum() - np.abs(yp[place[both]] - x0).sum()
    absent = kept - len(xi) - len(yi) + int(both.sum())
    return int(overlap + only_x + only_y) + absent * abs(x0 - y0)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): partial counts, several rows of a term possible; each group has the empty term."""
    text = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    src = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"),
                      text(text_col).cast("binary").alias("text"))
    return src.mapInArrow(_count, _COUNTS)


def _pair_values(arrays: DataFrame, smooth: int) -> DataFrame:
    """(lang, source, item, value) for both directions of every pair.  ``arrays``: lang, source, place, tiles (of
    the language), block, kept (terms of the block), ids, counts, total, terms."""
    tile = F.floor((F.col("place") - 1) / TILE).cast("int")
    tiled = arrays.withColumn("tile", tile)
    left = tiled.withColumn("i", F.col("tile")).withColumn("j", F.explode(F.sequence("tile", F.col("tiles") - 1)))
    right = apart(tiled).withColumn("j", F.col("tile")).withColumn("i", F.explode(F.sequence(F.lit(0), "tile")))
    out = pa.schema([("lang", pa.string()), ("x", pa.string()), ("y", pa.string()), ("value", pa.int64())])

    def sources(t: pa.Table) -> list[tuple]:
        got = []
        for r in t.to_pylist():
            counts = np.asarray(r["counts"] or [], np.int64)
            p = _shares(np.append(counts, 0), r["total"], r["terms"], smooth)
            got.append((r["place"], r["source"], r["kept"], (np.asarray(r["ids"] or [], np.int32), p[:-1], int(p[-1]))))
        return got

    def price(key, lt: pa.Table, rt: pa.Table) -> pa.Table:
        ys = sources(rt)
        rows = [(key[0].as_py(), xs, ysrc, merge_price(x, y, kept))
                for xp, xs, kept, x in sources(lt) for yp, ysrc, _, y in ys if xp < yp]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * 4, out)], schema=out)

    on = ["lang", "block", "i", "j"]
    sums = (left.groupBy(*on).cogroup(right.groupBy(*on))
            .applyInArrow(price, "lang string, x string, y string, value long")
            .groupBy("lang", "x", "y").agg(F.sum("value").alias("value")))
    ways = F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")),
                             F.struct(F.col("y").alias("source"), F.col("x").alias("item"))))
    return sums.select("lang", ways.alias("w"), "value").select("lang", "w.source", "w.item", "value")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               min_docs: int = MIN_DOCS, smooth: int = SMOOTH, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language, part
    ``term`` the ``top`` terms that the group uses more than its language."""
    counts = written(term_counts(docs, lang_col, source_col, text_col).groupBy("lang", "source", "term")
                     .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    kept = (counts.filter("length(term) > 0").groupBy("lang", "term")
            .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
            .drop("docs"))
    kept = written(kept, "kept")
    blocks = max(1, -(-kept.count() // BLOCK))
    block = F.pmod(F.xxhash64("lang", "term"), F.lit(blocks)).cast("int")
    kept = kept.withColumn("block", block).withColumn(
        "id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("lang_total"))
    of_block = kept.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("kept"))

    group_terms = written(counts.drop("docs").join(kept, ["lang", "term"]), "group_terms")
    totals = group_terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    w = Window.partitionBy("lang")
    groups = written(
        counts.filter("length(term) = 0").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
        .withColumn("place", F.row_number().over(w.orderBy("source")))
        .withColumn("tiles", F.ceil(F.count(F.lit(1)).over(w) / TILE).cast("int")), "groups")

    arrays = (group_terms.groupBy("lang", "source", "block")
              .agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("a"))
              .select("lang", "source", "block", F.col("a.id").alias("ids"), F.col("a.n").alias("counts")))
    priced = (groups.filter("terms > 0").join(of_block, "lang").join(arrays, ["lang", "source", "block"], "left"))
    pairs = _pair_values(priced, smooth)
    bare = groups.filter("terms = 0").select("lang", "source")             # a language without kept terms
    zero = (bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item")
            .withColumn("value", F.lit(0).cast("long")))
    pair = pairs.unionByName(zero).withColumn("part", F.lit("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pair = pair.withColumn("rank", F.row_number().over(order))

    p = share(F.col("n"), F.col("total"), F.col("terms"), smooth)
    q = share(F.col("all_n"), F.col("lang_total"), F.col("terms"), smooth)
    term = (group_terms.filter("n > 0").join(groups.drop("place", "tiles"), ["lang", "source"])
            .withColumn("value", p - q).filter("value > 0")
            .select("lang", "source", F.col("term").cast("string").alias("item"), "value", F.lit("term").alias("part"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS all_n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
n AS (
  SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(all_n)::HUGEINT AS total FROM kept GROUP BY lang),
g AS (
  SELECT g.lang, g.source, coalesce(sum(n.n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.all_n + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= 50
"""
