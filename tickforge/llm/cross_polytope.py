"""Approximate nearest neighbours by cross-polytope hashing.

1. Rows with a usable vector (no null, NaN or infinite component, not all zero) and an id take part.  Equal vectors form
   a class that keeps its ``k + 1`` smallest ids: no more can rank, since all of them tie.  A vector that a third
   of all rows share is searched, and searched for, once.
2. Largest inner products become nearest directions by one more coordinate: sqrt(R^2 - |x|^2) for a row, R the largest norm,
   and 0 for a query.  Vectors are filled up with zeros to a power of two.
3. A hash function rotates by three rounds of random signs and a fast Hadamard transform and names the nearest signed axis.  A
   table concatenates K of them, at most as many as leave ``FILL`` classes in a bucket on average (and three).
4. Multiprobe: a query visits the ``probes`` buckets of each table with the least summed loss (best minus own projection,
   squared).  ``probes`` is measured, not guessed: the exact neighbours of at most ``SAMPLE`` queries (smallest hashes) are
   found by one pass over all classes, and ``probes`` is the least number that finds a share ``recall`` of them.  K is the one
   for which blocks visited and classes compared cost least: clustered vectors take more hashes, random ones fewer.
5. First each query meets its own bucket of each table; the score of the last of its best ``k + 1`` there is a floor: what is
   below it cannot rank, so the probes after it pass on few rows, however many groups they visit.
6. Buckets are dealt into groups of about ``GROUP`` classes by hash.  A group that is larger (a hot bucket) is cut into blocks of
   classes and blocks of queries that all meet: nothing is dropped.  A co-grouped block multiplies the queries of each bucket
   with its classes and keeps each query's best ``k + 1`` by exact scores.
7. The best of all tables are merged.  Queries that met fewer than ``k + 1`` rows in all (tiny tables) are searched again against all
   classes in blocks, so they get every candidate.

A score is the inner product of the original vectors in double precision (shorter vectors count as filled up with zeros).
Ties go to the smaller id.  A query row never finds itself; another row with the same id is a candidate.  Null ids take no part.
Empty tables give no row.  Other columns never matter.  Only the sample's neighbours (``SAMPLE`` x ``k`` vectors) and
a few totals reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import apart, col, written

K, TABLES, RECALL, SAMPLE = 20, 8, 0.97, 128
#: Classes of a bucket on average (at most), of a group, and of a block; queries of a block; cells of a product at a time.
FILL, GROUP, BLOCK, CELLS = 4096, 8192, 16384, 1 << 22
ROUNDS, SEED = 3, 20240611
#: Hashes of a table at most; classes compared in the time that one more row to a block takes.
DEEPEST, PER_ROW = 3, 4096


def matrix(packed: list[bytes], dim: int, kind: str) -> np.ndarray:
    """Packed vectors as rows of doubles, filled up with zeros."""
    size = dim * np.dtype(kind).itemsize
    if all(len(p) == size for p in packed):
        return np.frombuffer(b"".join(packed), kind).reshape(len(packed), dim).astype(np.float64)
    out = np.zeros((len(packed), dim))
    for row, p in zip(out, packed):
        v = np.frombuffer(p, kind)
        row[:len(v)] = v
    return out


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), orthonormal."""
    rows, n = x.shape
    h = 1
    while h < n:
        y = x.reshape(rows, n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(rows, n)
        h *= 2
    return x / np.sqrt(n)


@dataclass(frozen=True)
class Hashing:
    dim: int
    radius: float
    tables: int
    depth: int
    kind: str

    @property
    def width(self) -> int:
        return 1 << self.dim.bit_length()                  # a power of two, at least dim + 1

    @property
    def buckets(self) -> int:
        return (2 * self.width) ** self.depth

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        out[:, :self.dim] = x
        norm2 = (x * x).sum(1)
        if query:
            return out / np.sqrt(norm2)[:, None]
        out[:, self.dim] = np.sqrt(np.maximum(self.radius ** 2 - norm2, 0.0))
        return out / self.radius

    def axes(self, lifted: np.ndarray, table: int, part: int) -> np.ndarray:
        """Projections on all signed axes: first the positive, then the negative ones."""
        y = lifted
        for r in range(ROUNDS):
            signs = np.random.default_rng([SEED, table, part, r]).choice([-1.0, 1.0], self.width)
            y = hadamard(y * signs)
        return np.concatenate((y, -y), axis=1)

    def bucket(self, lifted: np.ndarray, table: int) -> np.ndarray:
        out = np.zeros(len(lifted), np.int64)
        for part in range(self.depth):
            out = out * (2 * self.width) + self.axes(lifted, table, part).argmax(1)
        return out

    def losses(self, lifted: np.ndarray, table: int) -> list[np.ndarray]:
        got = []
        for part in range(self.depth):
            a = self.axes(lifted, table, part)
            got.append((a.max(1, keepdims=True) - a) ** 2)
        return got

    def probes(self, lifted: np.ndarray, table: int, n: int) -> np.ndarray:
        """The ``n`` buckets of least loss for each query, the best one first (the best prefixes make the best wholes)."""
        code = loss = None
        for part in self.losses(lifted, table):
            if loss is None:
                loss, code = part, np.broadcast_to(np.arange(part.shape[1]), part.shape)
            else:
                total = (loss[:, :, None] + part[:, None, :]).reshape(len(part), -1)
                code = (code[:, :, None] * part.shape[1] + np.arange(part.shape[1])).reshape(len(part), -1)
                loss = total
            if n < loss.shape[1]:
                best = np.argpartition(loss, n - 1, axis=1)[:, :n]
                loss, code = np.take_along_axis(loss, best, 1), np.take_along_axis(code, best, 1)
        code = code.copy()
        row, own = np.arange(len(code)), loss.argmin(1)
        code[row, own], code[:, 0] = code[:, 0].copy(), code[row, own]
        return code

    def rank(self, query: np.ndarray, near: np.ndarray, table: int) -> np.ndarray:
        """For one lifted query: how many buckets come before those of the lifted rows ``near``."""
        losses = [x[0] for x in self.losses(query[None], table)]
        own = sum(loss[self.axes(near, table, part).argmax(1)] for part, loss in enumerate(losses))
        sums = np.zeros(1)
        for loss in losses[:-1]:
            sums = (sums[:, None] + loss).ravel()
        last = np.sort(losses[-1])
        return np.array([np.searchsorted(last, s - sums - 1e-12).sum() for s in own])


def best_rows(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, exact score) of each query's ``k`` best rows of x; ties go to the smaller of ``ids``."""
    out = []
    step = max(1, CELLS // max(1, len(x)))
    for at in range(0, len(q), step):
        part = q[at:at + step]
        s = part @ x.T
        if len(x) > k:
            # products of a whole block may differ in the last digits from exact scores: leave room
            room = 1e-9 * np.abs(s).max()
            kth = np.partition(s, len(x) - k, axis=1)[:, len(x) - k]
            a, b = np.nonzero(s >= (kth - room)[:, None])
        else:
            a, b = (g.ravel() for g in np.indices(s.shape))
        score = (part[a] * x[b]).sum(1) + 0.0
        a, b, score = first_rows(a, b, score, ids, k)
        out.append((a + at, b, score))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, int),) * 2 + (np.empty(0),)


def first_rows(a: np.ndarray, b: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    order = np.lexsort((ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    start = np.flatnonzero(np.diff(a, prepend=-1))
    place = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    keep = place < k
    return a[keep], b[keep], score[keep]


def _pack(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, packed, dims, norms = [], [], [], []
            for i, v in enumerate(b.column(1)):
                v = np.array([np.nan if c is None else c for c in v.as_py()], kind) + np.zeros(1, kind)   # -0.0 is 0.0
                if len(v) and np.isfinite(v).all() and v.any():
                    d = v.astype(np.float64)
                    ids.append(i)
                    packed.append(v.tobytes())
                    dims.append(len(v))
                    norms.append(float((d * d).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(packed, pa.binary()),
                 pa.array(dims, pa.int32()), pa.array(norms, pa.float64())], names=["id", "vec", "dim", "norm2"])
    return run


def _exact_sample(classes: DataFrame, sample: list[bytes], dim: int, kind: str, k: int) -> dict[int, list[bytes]]:
    """The vectors of the ``k`` nearest rows of each sampled vector but its class, by one pass over all classes."""
    q = matrix(sample, dim, kind)
    own = {v: i for i, v in enumerate(sample)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = b.column(0).to_pylist()
            x = matrix(packed, dim, kind)
            if not len(x):
                continue
            a, r, s = best_rows(q, x, np.arange(len(x)), k + 1)
            ok = [own.get(packed[j]) != i for i, j in zip(a, r)]
            a, r, s = a[ok], r[ok], s[ok]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array([packed[j] for j in r], pa.binary()),
                                              pa.array(s, pa.float64()), b.column(1).take(pa.array(r, pa.int64()))],
                                             names=["q", "vec", "score", "rows"])
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec")
    near = (classes.select("vec", F.size("ids").alias("rows")).mapInArrow(scan, "q int, vec binary, score double, rows int")
            .withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k).orderBy("q", "n"))
    out: dict[int, list[bytes]] = {}
    for r in near.collect():                                  # at most SAMPLE * k rows
        got = out.setdefault(r.q, [])
        got += [bytes(r.vec)] * min(r.rows, k - len(got))
    return out


def measured_probes(h: Hashing, sample: list[bytes], near: dict[int, list[bytes]], recall: float) -> int:
    """Least number of probes a table that finds a share ``recall`` of the sampled neighbours."""
    need = []
    for i, rows in near.items():
        q = h.lifted(matrix([sample[i]], h.dim, h.kind), True)[0]
        x = h.lifted(matrix(rows, h.dim, h.kind), False)
        need.append(np.min([h.rank(q, x, t) for t in range(h.tables)], axis=0))
    if not need:
        return 1
    need = np.sort(np.concatenate(need))
    return min(h.buckets, int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)]) + 1)


def _met(left: DataFrame, right: DataFrame, on: list[str], h: Hashing, k: int) -> DataFrame:
    """(qid, cid, first_id, score): each query's best ``k`` classes of each co-grouped block that score at least its
    ``floor``.  left: classes (cid, first_id, vec, bucket); right: queries (qid, vec, buckets, floor)."""
    empty = pa.table({"qid": pa.array([], pa.int64()), "cid": pa.array([], pa.int64()),
                      "first_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def search(ct: pa.Table, qt: pa.Table) -> pa.Table:
        if not ct.num_rows or not qt.num_rows:
            return empty
        x, q = (matrix(t["vec"].to_pylist(), h.dim, h.kind) for t in (ct, qt))
        cid, first, qid = (t[c].to_numpy() for t, c in ((ct, "cid"), (ct, "first_id"), (qt, "qid")))
        floor = qt["floor"].to_numpy()
        order = np.argsort(ct["bucket"].to_numpy(), kind="stable")
        bucket = ct["bucket"].to_numpy()[order]
        lists = qt["buckets"].combine_chunks()
        asked = lists.flatten().to_numpy()
        asker = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
        by = np.argsort(asked, kind="stable")
        asked, asker = asked[by], asker[by]
        found = []
        for code in np.unique(bucket):
            rows = order[np.searchsorted(bucket, code):np.searchsorted(bucket, code, "right")]
            who = asker[np.searchsorted(asked, code):np.searchsorted(asked, code, "right")]
            if len(who):
                a, b, s = best_rows(q[who], x[rows], first[rows], k)
                ok = s >= floor[who[a]]
                found.append((who[a[ok]], rows[b[ok]], s[ok]))
        if not found:
            return empty
        a, b, s = first_rows(*(np.concatenate(c) for c in zip(*found)), first, k)
        return pa.table({"qid": qid[a], "cid": cid[b], "first_id": first[b], "score": s}, schema=empty.schema)

    return (left.groupBy(*on).cogroup(apart(right).groupBy(*on))
            .applyInArrow(search, "qid long, cid long, first_id long, score double"))


def _best(met: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "first_id")
    return (met.groupBy("qid", "cid", "first_id").agg(F.max("score").alias("score"))
            .withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k).drop("n"))


def _salt(key: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts).cast("int")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = TABLES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row with ``is_query`` (a condition on the column ``id``); whole-number ids."""
    kind = "<f4" if "float" in vectors.schema[vec_col].dataType.simpleString() else "<f8"
    src = vectors.select(col(id_col).cast("long").alias("id"), col(vec_col).alias("v")).filter("id is not null and v is not null")
    rows = written(src.mapInArrow(_pack(kind), "id long, vec binary, dim int, norm2 double"), "vectors")
    total = rows.agg(F.max("dim").alias("dim"), F.max("norm2").alias("norm2"), F.count(F.lit(1)).alias("n")).first()
    queries = rows.filter(is_query).select("id", "vec")
    result = "query_id long, rank int, vec_id long, score double"
    if not total.n:
        return rows.sparkSession.createDataFrame([], result)

    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= k + 1)
    asked = queries.select("vec").distinct().withColumn("asked", F.lit(True))
    classes = written(few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                      .join(asked, "vec", "left")
                      .select(F.monotonically_increasing_id().alias("cid"), "vec", "ids", F.col("ids")[0].alias("first_id"),
                              F.coalesce("asked", F.lit(False)).alias("asked")), "classes")
    n = classes.count()
    width = 1 << int(total.dim).bit_length()
    sample = [bytes(r.vec) for r in classes.filter("asked").select("vec", F.xxhash64("vec").alias("x"))
              .orderBy("x", "vec").limit(SAMPLE).collect()]
    if not sample:
        return rows.sparkSession.createDataFrame([], result)
    near = _exact_sample(classes, sample, int(total.dim), kind, k)
    h, probes, least = None, 0, np.inf
    for depth in range(1, DEEPEST + 1):
        if depth > 1 and n <= FILL * (2 * width) ** (depth - 1):
            break
        one = Hashing(int(total.dim), float(np.sqrt(total.norm2)), tables, depth, kind)
        asked_for = measured_probes(one, sample, near, recall)
        held_each = n / one.buckets
        cost = asked_for * (np.ceil(held_each / BLOCK) + held_each / PER_ROW)
        if cost < least:
            h, probes, least = one, asked_for, cost
    groups = -(-n // GROUP)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = h.lifted(matrix(b.column(2).to_pylist(), h.dim, kind), False)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(np.full(len(x), t, np.int32)), pa.array(h.bucket(x, t))],
                    names=["cid", "first_id", "vec", "t", "bucket"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                x = h.lifted(matrix(part.column(1).to_pylist(), h.dim, kind), True)
                for t in range(tables):
                    got = h.probes(x, t, probes)
                    lists = pa.ListArray.from_arrays(np.arange(0, got.size + 1, got.shape[1], dtype=np.int32), pa.array(got.ravel()))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(x), t, np.int32)), lists],
                                                     names=["qid", "vec", "t", "buckets"])

    in_group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int")
    held = (classes.select("cid", "first_id", "vec")
            .mapInArrow(index, "cid long, first_id long, vec binary, t int, bucket long").withColumn("g", in_group("bucket")))
    probed = (classes.filter("asked").select(F.col("cid").alias("qid"), "vec")
              .mapInArrow(probe, "qid long, vec binary, t int, buckets array<long>"))
    asks = (probed.select("qid", "t", F.explode("buckets").alias("bucket"), "vec").withColumn("g", in_group("bucket"))
            .groupBy("qid", "t", "g").agg(F.collect_list("bucket").alias("buckets"), F.first("vec").alias("vec")))
    # how many blocks of classes and of queries each group needs
    many = (held.groupBy("t", "g").agg(F.count(F.lit(1)).alias("c"))
            .join(asks.groupBy("t", "g").agg(F.count(F.lit(1)).alias("q")), ["t", "g"])
            .select("t", "g", F.ceil(F.col("c") / BLOCK).cast("int").alias("cb"), F.ceil(F.col("q") / BLOCK).cast("int").alias("qb")))
    many = written(many, "groups")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    on = ["t", "g", "ci", "qi"]
    left = held.join(many, ["t", "g"]).withColumn("ci", _salt("cid", F.col("cb"))).withColumn("qi", every("qb")).drop("cb", "qb")
    right = lambda a: (a.join(many, ["t", "g"]).withColumn("qi", _salt("qid", F.col("qb"))).withColumn("ci", every("cb"))
                       .select(*on, "qid", "vec", "buckets", "floor"))
    lowest = F.lit(float("-inf"))
    own = (probed.withColumn("g", in_group(F.col("buckets")[0])).withColumn("buckets", F.slice("buckets", 1, 1))
           .withColumn("floor", lowest))
    floor = (_best(_met(left, right(own), on, h, k + 1), k + 1).groupBy("qid")
             .agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("floor")))
    asks = asks.join(floor, "qid", "left").withColumn("floor", F.coalesce("floor", lowest))
    found = written(_best(_met(left, right(asks), on, h, k + 1), k + 1), "found")
    ids = classes.select("cid", "ids")
    rows_met = found.join(ids, "cid").groupBy("qid").agg(F.sum(F.size("ids")).alias("met"))
    short = written(classes.filter("asked").select(F.col("cid").alias("qid"), "vec").join(rows_met, "qid", "left")
                    .filter(F.coalesce("met", F.lit(0)) < min(k + 1, int(total.n))).select("qid", "vec"), "short")
    if not short.isEmpty():
        blocks = -(-n // BLOCK)
        left = (classes.select("cid", "first_id", "vec", F.lit(0).cast("long").alias("bucket"))
                .withColumn("ci", _salt("cid", F.lit(blocks))))
        right = (short.withColumn("buckets", F.array(F.lit(0).cast("long")))
                 .withColumn("floor", lowest).withColumn("ci", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
        again = _best(_met(left, right, ["ci"], h, k + 1), k + 1)
        found = found.join(short.select("qid"), "qid", "left_anti").unionByName(again)

    # one sorted list of (score, id) for each query class, then one row of results for each query row
    entry = F.expr("flatten(transform(collect_list(struct(score, ids, cid)), "
                   "c -> transform(c.ids, i -> struct(-c.score as s, i as i, c.cid as c))))")
    lists = (found.join(ids, "cid").groupBy("qid").agg(F.slice(F.array_sort(entry), 1, k + 1).alias("l"))
             .join(classes.select(F.col("cid").alias("qid"), "vec"), "qid").select("vec", "qid", "l"))
    at = F.expr("array_position(transform(l, e -> e.i = id and e.c = qid), true)")
    others = F.expr(f"slice(filter(l, (e, p) -> p + 1 <> own), 1, {k})")       # without the row itself
    return (queries.join(lists, "vec").withColumn("own", at)
            .select(F.col("id").alias("query_id"), F.posexplode(others).alias("p", "e"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.i").alias("vec_id"),
                    (-F.col("e.s") + F.lit(0.0)).alias("score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


ORACLE_SQL = None
