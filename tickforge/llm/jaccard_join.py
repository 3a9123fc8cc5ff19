"""N-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct word shingles.  For sets of a and b
members with Jaccard at least J the symmetric difference has at most
(a + b) (1 - J) / (1 + J) members.

1. Sketch.  Each shingle flips one bit of a parity sketch (XOR hashing), so the
   Hamming distance of two sketches is at most the symmetric difference.
2. Pigeonhole join.  Sizes fall into bands with ratio 1 / J; linked sets lie in the same
   or in neighbouring bands.  With at most t differences in a band, the shingle hashes are cut into
   t + 1 ranges, and at least one range must be equal: the XOR of its members is a
   key.  A document gives keys for its own band and the next.  Keys are sorted in
   the cluster; sets that meet in a key are candidates.
3. Classes.  Equal sets form a class from the start and only meet as such: copies link by their
   class.  Classes that hold very many rows (found by a frequent-items sketch, at most ``HEAVY``,
   broadcast) give the keys of one row only.
4. Candidates.  In a key's run every class is paired with the first (a star, linear in the
   run).  Pairs pass the Hamming bound of the sketches, then the exact test on the shingle sets.
   Links are contracted to components.  Where a key still holds classes of different
   components, stars around other classes follow while they find links (at most ``STARS``).  What is
   then left in different components is compared whole: all pairs across components that share a key, listed for
   keys with few classes and else compared in blocks of classes by the Hamming bound (only pairs that pass leave a
   block), and verified in the same way.
   So no link that joins two components is lost.

Documents without words are linked with nothing; null text counts as empty.  Repeated rows
are copies.  Null ids are never a component's smallest id unless all are null.  Empty tables
give no rows.  Texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import WHITE_SPACE_CLASS, col, documents, keep_decided, written
from tickforge.llm.components import components, joined
from tickforge.llm.words import mix, shingles, word_hashes

#: Bits of a parity sketch for each shingle, and at least.
BITS_EACH, BITS_LEAST = 1, 2048
HEAVY, COUNTERS = 256, 4096
#: Bits of the table that tells which rows may be candidates (false positives only cost time).
FILTER_BITS = 1 << 22
#: Per cent of hash ranges added to the t + 1.
SPARE = 8
#: Further stars at most, before components are compared whole.
STARS = 3
#: Most classes of a key whose pairs are listed; keys with more are compared in blocks of about
#: CHUNK classes, by sketches folded to FOLD bytes.
LISTED, CHUNK, FOLD = 32, 256, 256
#: Keys that leave a Python worker at a time.
KEYS = 1 << 16


class Bounds:
    """Bands and numbers of ranges for Jaccard >= num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges, self.cuts = [1], {}

    def most(self, a, b):
        """Largest symmetric difference of linked sets with a and b members."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(self.edges[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def ranges(self, band: int) -> tuple[np.ndarray, int]:
        """(lower edges of a band's hash ranges, how many of them are equal at least in linked sets).

        Some more ranges than t + 1, so that an equal one remains besides the empty ones."""
        while len(self.edges) < band + 2:
            self.edges.append(self.edges[-1] * self.den // self.num + 1)
        top = self.edges[band + 1] - 1
        t = self.most(top, top)
        m = 1 if t == 0 else t + 1 + -(-(t + 1) * SPARE // 100)
        if m not in self.cuts:
            self.cuts[m] = np.array([-((-j << 64) // m) for j in range(m)], dtype=np.uint64)
        return self.cuts[m], m - t

    def linked(self, a: int, b: int, common: int) -> bool:
        return self.den * common >= self.num * (a + b - common)


def _class(s: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest(), "<i8")
    return int(d[0]), int(d[1])


def sketch(s: np.ndarray) -> bytes:
    """Parity sketch of a set of hashes: a power of two bits, at least ``BITS_EACH`` for each member."""
    size = max(BITS_LEAST, 1 << int(BITS_EACH * len(s) - 1).bit_length()) if len(s) else BITS_LEAST
    bits = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(b: bytes, size: int) -> np.ndarray:
    """A sketch as 64-bit numbers, folded to ``size`` bytes (the sketch of the same set with fewer bits)."""
    x = np.frombuffer(b, np.uint64)
    while 8 * len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def distances(one: bytes, others: list[bytes]) -> np.ndarray:
    """Hamming distances of a sketch and others, all folded to the smallest."""
    size = min(len(one), *map(len, others))
    return np.bitwise_count(folded(one, size) ^ np.stack([folded(o, size) for o in others])).sum(axis=1)


def _features(docs: DataFrame, k: int) -> DataFrame:
    """(id, idh, th, n, c1, c2, sketch) of rows (id, idh, text, th); c1, c2: digest of the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, c1, c2, sketches = [], [], [], []
            for words in word_hashes(b.column(2).to_pylist()):
                s = shingles(words, k)
                d = _class(s)
                n.append(len(s))
                c1.append(d[0])
                c2.append(d[1])
                sketches.append(sketch(s))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                 pa.array(sketches, pa.binary())], names=["id", "idh", "th", "n", "c1", "c2", "sketch"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, idh long, th long, n long, c1 long, c2 long, sketch binary")


def _few(found: Iterable[tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
    """(key, c) of pairs (keys, c), at most ``KEYS`` rows in a batch: the keys of a batch of texts take more room than the texts."""
    keys, cs, size = [], [], 0
    for key, c in found:
        keys.append(key)
        cs.append(np.full(len(key), c, np.int64))
        size += len(key)
        if size >= KEYS:
            yield from _cut(keys, cs)
            keys, cs, size = [], [], 0
    if size:
        yield from _cut(keys, cs)


def _cut(keys: list[np.ndarray], cs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    t = pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(cs))], names=["key", "c"])
    for at in range(0, t.num_rows, KEYS):
        yield t.slice(at, KEYS)


def _keys(docs: DataFrame, k: int, bounds: Bounds, hot) -> DataFrame:
    """(key, c) for every range of both bands of every set; of a class in ``hot`` only the id named there."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
        for b in batches:
            for idh, words in zip(b.column(0).to_pylist(), word_hashes(b.column(1).to_pylist())):
                s = shingles(words, k)
                if not len(s):
                    continue
                c = _class(s)[0]
                if hot.value.get(c, idh) != idh:
                    continue
                acc = np.zeros(len(s) + 1, np.uint64)
                np.bitwise_xor.accumulate(mix(s), out=acc[1:])
                band = bounds.band(len(s))
                for at in (band, band + 1):
                    cuts, equal = bounds.ranges(at)
                    m = len(cuts)
                    if m < 2:          # no difference allowed: only equal sets, which are one class
                        continue
                    lo = np.searchsorted(s, cuts)
                    hi = np.append(lo[1:], len(s))
                    where = np.arange(m, dtype=np.uint64) + np.uint64((at + 1) << 40)
                    key = mix((acc[hi] ^ acc[lo]) + mix(where))
                    empty = hi == lo
                    if empty.sum() < equal:      # then some equal range has members: empty ones need not meet
                        key = key[~empty]
                    yield key, c

    return docs.select("idh", "text").mapInArrow(lambda batches: _few(found(batches)), "key long, c long")


def _meetings(keys: DataFrame) -> DataFrame:
    """(key, hub, c) for every class that shares a key with another; hub is the key's smallest class.

    Reads sorted runs as a stream: a run may be longer than a batch and is never gathered.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, hub, last = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            k, c = b.column(0).to_numpy(), b.column(1).to_numpy()
            new = np.empty(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            new[0] = last_key is None or k[0] != last_key
            run_of = np.cumsum(new)
            heads = np.concatenate(([hub], c[new]))
            hubs = heads[run_of]
            other = np.empty(len(k), bool)
            other[1:] = c[1:] != c[:-1]
            other[0] = c[0] != last
            out = ~new & (c != hubs) & other
            last_key, hub, last = int(k[-1]), int(hubs[-1]), int(c[-1])
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(hubs[out]), pa.array(c[out])],
                                                 names=["key", "hub", "c"])

    return (keys.repartition("key").sortWithinPartitions("key", "c")
            .mapInArrow(run, "key long, hub long, c long"))


def _near(pairs: DataFrame, classes: DataFrame, bounds: Bounds) -> DataFrame:
    """Pairs (a, b) of classes whose sizes and sketches allow a link."""
    num, den = bounds.num, bounds.den
    an, bn = (classes.select(F.col("c1").alias(k), F.col("n").alias(k + "n")) for k in "ab")
    pairs = (pairs.join(an, "a").join(bn, "b")          # sizes first: sketches of long texts are long
             .filter(den * F.least("an", "bn") >= num * F.greatest("an", "bn")))
    x, y = (classes.select(F.col("c1").alias(k), F.col("sketch").alias(k + "sketch")) for k in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                far = np.array([distances(x, [y])[0] for x, y in zip(t.column(4).to_pylist(), t.column(5).to_pylist())])
                ok = far <= bounds.most(t.column(2).to_numpy(), t.column(3).to_numpy())
                yield t.select(["a", "b"]).filter(pa.array(ok))

    return (pairs.join(x, "a").join(y, "b").select("a", "b", "an", "bn", "asketch", "bsketch")
            .mapInArrow(run, "a long, b long"))


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(c, members) for the classes (c, id) in ``wanted``; members: the sorted hashes, packed.

    A table of ``FILTER_BITS`` bits over the ids skips most other rows before they are hashed.
    """
    spark = docs.sparkSession
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bits = np.zeros(FILTER_BITS, bool)
    bits[wanted.select(slot(F.col("id")).alias("s")).distinct().toPandas()["s"].to_numpy(dtype=np.int64)] = True
    sent = spark.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(sent.value).astype(bool)
        for b in batches:
            b = b.filter(pa.array(table[b.column(0).to_numpy()]))
            c, members = [], []
            for words in word_hashes(b.column(1).to_pylist()):
                s = shingles(words, k)
                c.append(_class(s)[0])
                members.append(s.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(members, pa.binary())],
                                             names=["c", "members"])

    found = docs.select(slot(F.col("id")).alias("s"), "text").mapInArrow(run, "c long, members binary")
    return found.join(wanted.select("c").distinct(), "c", "left_semi").dropDuplicates(["c"])


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, bounds: Bounds) -> DataFrame:
    """The pairs (a, b) that link, by their whole shingle sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    wanted = written(ends.join(classes.select(F.col("c1").alias("c"), "id"), "c"))
    sets = written(_sets(docs, wanted, k), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                ok.append(bounds.linked(len(x), len(y), int((y[at] == x).sum())))
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(sets.toDF("a", "amembers"), "a").join(sets.toDF("b", "bmembers"), "b")
            .select("a", "b", "amembers", "bmembers").mapInArrow(run, "a long, b long"))


def _again(met: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) for another star: every class with a hub that is drawn anew for each key, where their components
    differ."""
    members = _labelled(met, labels)
    draw = F.xxhash64("c", F.lit(turn))
    hubs = members.groupBy("key").agg(F.min(F.struct(draw.alias("d"), F.col("c").alias("hub"), F.col("root").alias("to"))).alias("h"),
                                      F.min("root").alias("lo"), F.max("root").alias("hi"))
    return (members.join(hubs.filter("lo <> hi").select("key", "h.hub", "h.to"), "key").filter("root <> to")
            .select(F.greatest("c", "hub").alias("a"), F.least("c", "hub").alias("b")).distinct())


def _labelled(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, c, root): every class under every key it shares, with its component."""
    members = met.select("key", "c").unionByName(met.select("key", F.col("hub").alias("c")).distinct())
    return (members.join(labels.select(F.col("node").alias("c"), "root"), "c", "left")
            .withColumn("root", F.coalesce("root", "c")))


def _across(met: DataFrame, labels: DataFrame, classes: DataFrame, bounds: Bounds) -> DataFrame:
    """Pairs of classes that share a key and lie in different components.

    A key's sketches are never gathered: sets have keys in proportion to their size, so that would grow with its
    square.  Pairs of keys with few classes are listed (at most ``LISTED`` / 2 for each class); keys with more are
    compared in blocks, where only pairs within the Hamming bound of small folded sketches leave."""
    labelled = _labelled(met, labels)
    mixed = (labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("g"))
             .filter("lo <> hi").select("key", "g"))
    rows = written(labelled.join(mixed, "key"))
    few = rows.filter(F.col("g") <= LISTED).select("key", "c", "root")
    other = few.toDF("key", "d", "other")
    listed = (few.join(other, "key").filter("c > d AND root <> other")
              .select(F.col("c").alias("a"), F.col("d").alias("b")).distinct())
    crowd = (rows.filter(F.col("g") > LISTED).withColumn("chunks", F.ceil(F.col("g") / CHUNK).cast("int"))
             .join(_folded(classes), "c")
             .withColumn("chunk", F.pmod(F.xxhash64("c", "key"), F.col("chunks")).cast("int")))
    block = crowd.groupBy("key", "chunk", "chunks").agg(          # about CHUNK members each
        F.collect_list(F.struct("c", "root", "n", "sketch")).alias("m"))
    paired = (block.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .groupBy("key", F.least("chunk", "with").alias("x"), F.greatest("chunk", "with").alias("y"))
              .agg(F.min_by("m", "chunk").alias("l"), F.max_by("m", "chunk").alias("r")))
    num, den = bounds.num, bounds.den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            a, b = [], []
            for ls, rs in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
                size = min(len(m["sketch"]) for s in (ls, rs) for m in s)
                (lc, lr, ln, ls_), (rc, rr, rn, rs_) = [
                    (np.array([m["c"] for m in s]), np.array([m["root"] for m in s]), np.array([m["n"] for m in s]),
                     np.stack([folded(m["sketch"], size) for m in s])) for s in (ls, rs)]
                for i in range(len(lc)):
                    ok = ((lr[i] != rr) & (np.bitwise_count(ls_[i] ^ rs_).sum(axis=1) <= bounds.most(ln[i], rn))
                          & (den * np.minimum(ln[i], rn) >= num * np.maximum(ln[i], rn)))
                    b.append(np.minimum(rc[ok], lc[i]))
                    a.append(np.maximum(rc[ok], lc[i]))
            if a:       # keys of one group of near copies give the same pairs
                once = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1).astype(np.int64), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(once[:, 0]), pa.array(once[:, 1])], names=["a", "b"])

    return listed.unionByName(paired.select("l", "r").mapInArrow(run, "a long, b long")).distinct()


def _folded(classes: DataFrame) -> DataFrame:
    """(c, n, sketch): sketches folded to at most ``FOLD`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            small = [folded(x, min(len(x), FOLD)).tobytes() for x in t.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(small, pa.binary())], names=["c", "n", "sketch"])

    return classes.select("c1", "n", "sketch").mapInArrow(run, "c long, n long, sketch binary")


def _linked(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(rows of ``_features``, (node, root) of the classes that are linked with another)."""
    bounds = Bounds(num, den)
    spark = docs.sparkSession
    texts = docs.select(col(id_col).alias("id"), F.xxhash64(col(id_col)).alias("idh"),
                        col(text_col).alias("text"), F.xxhash64(F.coalesce(col(text_col), F.lit(""))).alias("th"))
    rows = written(_features(texts, k), "sketches")
    hot = (rows.filter("n > 0").agg(F.expr(f"approx_top_k(c1, {HEAVY}, {COUNTERS})").alias("t"))
           .select(F.explode("t").alias("t")).select(F.col("t.item").alias("c1")))
    first = {r["c1"]: r["idh"] for r in rows.join(F.broadcast(hot), "c1", "left_semi")
             .groupBy("c1").agg(F.min("idh").alias("idh")).collect()}
    sent = spark.sparkContext.broadcast(first)
    met = written(_meetings(_keys(texts, k, bounds, sent)), "meetings")
    # classes that meet another one: one row each
    ends = met.select(F.explode(F.array("hub", "c")).alias("c1")).distinct()
    classes = written(rows.join(ends, "c1", "left_semi").groupBy("c1").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("id").alias("id")))

    star = met.select(F.col("c").alias("a"), F.col("hub").alias("b")).distinct()
    links = written(_verified(written(_near(star, classes, bounds)), texts, classes, k, bounds))
    labels = components(links)
    tested = star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for turn in range(STARS):
        more = written(_again(met, labels, turn).join(tested, ["a", "b"], "left_anti"))
        new = written(_verified(written(_near(more, classes, bounds)), texts, classes, k, bounds))
        if new.isEmpty():
            break
        tested = tested.unionByName(more)
        labels = joined(labels, new)
    more = _across(met, labels, classes, bounds).join(tested, ["a", "b"], "left_anti")
    more = written(_near(written(more), classes, bounds))
    if not more.isEmpty():
        labels = joined(labels, _verified(more, texts, classes, k, bounds))
    return rows, labels


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                    num: int = 90, den: int = 100) -> DataFrame:
    """(id, n_shingles, component_id) of every row: sets of k-word shingles, links at
    Jaccard >= num / den."""
    rows, labels = _linked(docs, id_col, text_col, k, num, den)
    smallest = (rows.filter("n > 0").groupBy("c1").agg(F.min("id").alias("id"))
                .join(labels.select(F.col("node").alias("c1"), "root"), "c1", "left")
                .withColumn("root", F.coalesce("root", "c1")))
    of_root = smallest.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = smallest.join(of_root, "root").select(F.col("c1").alias("cls"), "component_id")
    return (rows.join(of_class, (rows["c1"] == of_class["cls"]) & (rows["n"] > 0), "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                     num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id (null last) and text hash; rows
    without words stay.  Rows are named by id and text: only rows equal in both are copies whatever their words."""
    rows, labels = _linked(docs, id_col, text_col, k, num, den)
    name = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("th").alias("text"))
    kept = (rows.filter("n > 0").groupBy("c1").agg(F.min(name).alias("best"))
            .join(labels.select(F.col("node").alias("c1"), "root"), "c1", "left")
            .groupBy(F.coalesce("root", "c1").alias("root")).agg(F.min("best").alias("best"))
            .select("best.id", "best.text"))
    words = F.coalesce(col(text_col).rlike(WHITE_SPACE_CLASS.replace("[", "[^")), F.lit(False))
    with_words = keep_decided(docs.filter(words), kept, {"id": col(id_col), "text": F.xxhash64(F.coalesce(col(text_col), F.lit("")))})
    return docs.filter(~words).unionByName(with_words)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = None
