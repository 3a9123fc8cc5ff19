"""Document fingerprints from closed syncmers (DataFrame functions only).

Tokens are words; a word of more than ``LONG`` characters (unspaced scripts, for instance) is its characters, and so is a whole text
of fewer than ``K`` words.  Tokens are hashed; a k-mer is ``K`` tokens in a row, and it is a closed syncmer if the
smallest of its inner ``S``-token hashes is the first or the last one.  Whether a k-mer is
chosen depends on its own tokens alone, so a passage gives the same anchors wherever it
stands (``anchors`` lists them with their positions).

Anchors are matched by position: an element of the fingerprint is an anchor together with the next one and the distance
between them, so two texts have an element in common where two anchors follow each other at the same distance in
both, wherever the passage stands.  The fingerprint is the smallest distinct element hashes of the whole text, in order, as 16 hex
digits each: all up to ``SIZE``, and of more the smallest one in ``SHARE`` (at least ``SIZE``), so it grows with the text.
Two fingerprints' likeness is the Jaccard similarity of their elements up to the largest hash that both kept (of
all elements where neither left any out).

A text with words but without a syncmer (fewer than ``K`` characters, for instance) has
the hash of the whole text as its only element; so has white space.  The empty text
(and null) has the empty fingerprint; two empty fingerprints are alike (1), an empty and
another are not (0).

The query's edited texts need each document's successor in descending id order.  Documents
are dealt into blocks of about ``BLOCK_CHARS`` characters by splitters from a size-weighted
sample of (id, text hash) (at most ``MAX_BLOCKS`` blocks: beyond that many times ``BLOCK_CHARS`` blocks grow); the first document of
a block is also copied to the block above it.  So texts are shuffled once and no block is the whole table, nor are
all null ids one block.  Null ids come last, equal ids by their texts' hash; the successor of a table's only document is
itself.  Ids that are no whole numbers are first numbered in their order.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import WHITE_SPACE_CLASS, col, documents, written

K, S, SIZE, SHARE, LONG = 5, 2, 64, 16, 32
BLOCK_CHARS, MAX_BLOCKS, PER_BLOCK = 2_000_000, 1 << 17, 8
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _hashed(df: DataFrame, text: str, pre: str) -> DataFrame:
    """``df`` with ``{pre}h`` (token hashes) and ``{pre}s`` (hashes of S tokens in a row).

    Each step is a column of its own, so that no array is computed twice."""
    df = df.withColumn(pre + "w", F.array_remove(F.split(col(text), WHITE_SPACE_CLASS + "+"), ""))
    words = col(pre + "w")
    cut = F.flatten(F.transform(words, lambda w: F.when(F.length(w) > LONG, F.split(w, "")).otherwise(F.array(w))))
    tokens = (F.when(F.exists(words, lambda w: F.length(w) > LONG), cut)
              .when(F.size(words) < K, F.split(F.array_join(words, " "), "")).otherwise(words))
    df = df.withColumn(pre + "h", F.transform(tokens, lambda w: F.xxhash64(w))).drop(pre + "w")
    h = col(pre + "h")
    n = F.size(h) - (S - 1)
    inner = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))
    return df.withColumn(pre + "s", F.when(n > 0, inner).otherwise(F.array().cast("array<bigint>")))


def _syncmer(s: Column, i: Column) -> Column:
    """Hash of the k-mer at word i if it is a closed syncmer, else null."""
    last = K - S
    inside = F.least(*[F.get(s, i + j) for j in range(1, last)])
    cover = sorted({*range(0, last, S), last})
    return F.when(F.least(F.get(s, i), F.get(s, i + last)) <= inside,
                  F.xxhash64(*[F.get(s, i + j) for j in cover]))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the ordered smallest element hashes (array of longs) of a text column without nulls, and
    ``out``_upto: the largest hash up to which none is left out."""
    pre = f"_{out}_"
    df = _hashed(df, text, pre)
    s = col(pre + "s")
    n = F.size(s) - (K - S)
    places = F.filter(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("at"), _syncmer(s, i).alias("h"))),
                      lambda a: a["h"].isNotNull())
    df = df.withColumn(pre + "a", F.when(n > 0, places))
    a = col(pre + "a")
    pairs = F.transform(a, lambda x, i: F.xxhash64(x["h"], F.get(a, i + 1)["h"], F.get(a, i + 1)["at"] - x["at"]))
    df = df.withColumn(pre + "f", F.when(F.size(a) > 0, F.sort_array(F.array_distinct(pairs))))
    f = col(pre + "f")
    keep = F.greatest(F.lit(SIZE), F.ceil(F.size(f) / SHARE).cast("int"))
    whole = F.when(col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(text)))
    return (df.withColumn(out, F.when(f.isNotNull(), F.slice(f, 1, keep)).otherwise(whole))
            .withColumn(out + "_upto", F.when(F.size(f) > F.size(out), F.element_at(out, -1)).otherwise(F.lit(MOST)))
            .drop(pre + "h", pre + "s", pre + "a", pre + "f"))


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Of two fingerprint columns (with their ``_upto`` columns)."""
    upto = F.least(col(a + "_upto"), col(b + "_upto"))
    x, y = (F.filter(col(c), lambda h: h <= upto) for c in (a, b))
    both = F.size(F.array_intersect(x, y))
    every = F.size(x) + F.size(y) - both
    return F.when(every == 0, 1.0).otherwise(both / every)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return with_fingerprint(rows, "text", "fp").select(F.col("id").alias(id_col), as_text(F.col("fp")).alias("fingerprint"))


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, position, anchor): every closed syncmer with the number of its first word."""
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = _hashed(rows, "text", "_")
    s = F.col("_s")
    n = F.size(s) - (K - S)
    at = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: _syncmer(s, i)))
    return (rows.select("id", F.posexplode(at).alias("position", "anchor")).filter("anchor is not null")
            .withColumnRenamed("id", id_col))


def _longs(values: list[int]) -> Column:
    """A constant array (folded by the optimizer)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, i, text, h): i is a whole number in the order of the ids, the least for null."""
    base = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    if isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        base = base.withColumn("i", F.col("id").cast("long"))
    else:
        ids = written(base.filter("id IS NOT NULL").select("id").distinct().orderBy("id")
                      .withColumn("i", F.monotonically_increasing_id()), "ids")
        base = base.join(ids, "id", "left")
    return base.withColumn("i", F.coalesce("i", F.lit(LEAST))).withColumn("h", F.xxhash64("text")).select("id", "i", "text", "h")


def with_successor(docs: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, i, h, text, halo, block): rows dealt into blocks by (id, text hash), and copies (halo 1) of each block's
    first row in the block that comes before it in descending order."""
    base = _ordered(docs, id_col, text_col).withColumn("g", F.bitwise_not("h"))        # the lesser hash comes first
    narrow = written(base.select("i", "g", F.length("text").alias("n")))
    total = narrow.agg((F.sum("n") + F.count(F.lit(1))).alias("t")).first()[0] or 1
    blocks = int(min(MAX_BLOCKS, max(1, total // block_chars)))
    step = float(max(1, total // (blocks * PER_BLOCK)))
    u = F.xxhash64("i", "g", F.lit(5)).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))
    drawn = sorted((r["i"], r["g"]) for r in narrow.filter(u * step < F.col("n") + 1).select("i", "g").collect())   # about PER_BLOCK a block
    levels = max(1, blocks.bit_length())
    splitters = sorted({drawn[len(drawn) * k // blocks] for k in range(1, blocks)}) if drawn else []
    splitters += [(MOST, MOST)] * ((1 << levels) - 1 - len(splitters))
    bi, bg = (_longs([x[k] for x in splitters]) for k in (0, 1))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(levels))])

    def below(at: Column) -> Column:
        i = F.element_at(bi, at)
        return (i < F.col("i")) | ((i == F.col("i")) & (F.element_at(bg, at) <= F.col("g")))
    # binary search: the number of splitters at or below the row
    block = F.aggregate(steps, F.lit(0), lambda acc, st: F.when(below(acc + st), acc + st).otherwise(acc))
    tops = (narrow.withColumn("block", block).groupBy("block")
            .agg(F.max(F.struct("i", "g")).alias("top")).orderBy("block").collect())   # one row a block
    if not tops:
        return base.drop("g").withColumns({"halo": F.lit(0), "block": F.lit(0)})
    above = {r["block"]: tops[(k + 1) % len(tops)]["block"] for k, r in enumerate(tops)}
    ids, gs, to = [0] * (1 << levels), [0] * (1 << levels), [-1] * (1 << levels)
    for r in tops:
        ids[r["block"]], gs[r["block"]], to[r["block"]] = r["top"]["i"], r["top"]["g"], above[r["block"]]
    at = F.col("block") + 1
    is_top = (F.element_at(_longs(ids), at) == F.col("i")) & (F.element_at(_longs(gs), at) == F.col("g"))
    own = F.struct(F.col("block").cast("long").alias("block"), F.lit(0).alias("halo"))
    copy = F.struct(F.element_at(_longs(to), at).alias("block"), F.lit(1).alias("halo"))
    return (base.withColumn("block", block)
            .withColumn("where", F.explode(F.when(is_top, F.array(own, copy)).otherwise(F.array(own))))
            .select("id", "i", "h", "text", F.col("where.halo").alias("halo"), F.col("where.block").alias("block")))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    w = Window.partitionBy("block").orderBy("halo", F.col("i").desc(), "h")
    rows = with_fingerprint(with_successor(docs, id_col, text_col), "text", "fp")
    rows = (rows.withColumn("next_text", F.lead("text").over(w)).withColumn("next_fp", F.lead("fp").over(w))
            .withColumn("next_fp_upto", F.lead("fp_upto").over(w))
            .filter("halo = 0").withColumn("n_chars", F.length("text").cast("long")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    rows = with_fingerprint(rows, "edited", "edited_fp")
    return rows.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))


ORACLE_SQL = None
