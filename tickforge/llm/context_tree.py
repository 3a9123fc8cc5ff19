"""LM scoring by context-tree weighting over bytes.

A text is its words (A-Z in lower case), each followed by a space, then an end mark.
Every byte is eight binary decisions.  A node is a context (the last 0 to ``DEPTH`` bytes,
ending at the text's start) and the bits decided so far; it counts zeros and ones in the training
texts.  Its Krichevsky-Trofimov probability Pe and the product of its children's weighted
probabilities give Pw = (Pe + product) / 2, and the posterior of stopping there,
(Pe / 2) / Pw.  A bit's probability mixes the estimates of all depths by those posteriors; where a
deeper context was never seen, the deepest seen one takes the rest.  Code length per byte follows
from ``score`` and ``n_bytes``.

How it runs.  Tasks reduce whole texts to distinct (context, byte) pairs and distinct words, each with
its training count, packed in arrays and dealt by hash.

1. Counts: pairs and words are counted in each task, summed for each hash bucket.
2. Tree: the pairs are regrouped by their last two bytes (hashed), where all nodes of depth 2 and more are
   at home; the sums for depths 1 and 0 (at most 256 * 255 rows) reach the driver.
3. Scores: documents are dealt into chunks of about ``CHUNK_BYTES``; a chunk asks the tables for its distinct
   pairs and words only, and sums the answers for each document.

All arrays are bounded by a chunk, or by distinct pairs or words over the number of buckets, which grows with
the input; frequent pairs and words arrive once from each task.  Words are known by
64-bit hashes.  Nothing is sampled, pruned or truncated.

Null and empty texts are the end mark alone (n_tokens 1).  Null ids count as the empty text in the fold.
With no training text every count is 0 and every bit has probability 1/2.  Repeated rows get equal
scores.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import col, documents, written
from tickforge.llm.lang_id import fold
from tickforge.llm.words import mix, word_hashes

DEPTH = 5
CHUNK_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20
#: Bytes of a stream that are handled at a time, and texts' bytes counted before a task deals them out.
PIECE, FLUSH = 1 << 20, 32 << 20
PAIRS, WORDS = 0, 1
_U = np.uint64


def stream(text: str | None) -> bytes:
    """The bytes that are scored: each word and a space, then the end mark (a line feed)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return b" ".join(words) + b" \n" if words else b"\n"


def pair_keys(buf: np.ndarray, lo: int) -> np.ndarray:
    """For every byte of ``buf`` from ``lo``: its context, latest byte highest and cut at
    a line feed, and the byte itself lowest (56 bits)."""
    n = len(buf) - lo
    key = buf[lo:].astype(_U)
    alive = np.ones(n, bool)
    for d in range(DEPTH):
        b = np.zeros(n, np.uint8)
        skip = max(0, d + 1 - lo)
        if skip < n:
            b[skip:] = buf[lo + skip - 1 - d:len(buf) - 1 - d]
        b *= alive
        key |= b.astype(_U) << _U(8 * (6 - d))
        alive &= b != 10
    return key


def pieces(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """(pair keys, start of each text in them, number of each text), some texts at a time; a text longer than
    ``PIECE`` comes in several parts."""
    batch, size, at = [], 0, []
    for k, t in enumerate(texts):
        s = stream(t)
        if batch and (size + len(s) > PIECE or len(batch) > 0xFFFF):
            yield _piece(batch, at)
            batch, size, at = [], 0, []
        if len(s) > PIECE:
            buf = np.frombuffer(b"\n" + s, np.uint8)
            for lo in range(1, len(buf), PIECE):
                head = max(0, lo - DEPTH)
                yield pair_keys(buf[head:lo + PIECE], lo - head), np.zeros(1, np.int64), [k]
        else:
            batch.append(s)
            at.append(k)
            size += len(s)
    if batch:
        yield _piece(batch, at)


def _piece(batch: list[bytes], at: list[int]):
    starts = np.cumsum([0] + [len(b) for b in batch[:-1]])
    return pair_keys(np.frombuffer(b"\n" + b"".join(batch), np.uint8), 1), starts, at


def close(keys: np.ndarray) -> np.ndarray:
    """Pair keys without their unused byte (48 bits), in the same order."""
    return keys >> _U(16) << _U(8) | keys & _U(255)


def text_sums(keys: np.ndarray, starts: np.ndarray, table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's pairs.  ``table``: closed keys in order.  The pairs are sorted together with
    their text's number, so each distinct pair is looked up once, and in order."""
    sizes = np.diff(np.append(starts, len(keys)))
    s = np.sort(close(keys) << _U(16) | np.repeat(np.arange(len(sizes), dtype=_U), sizes))
    k = s >> _U(16)
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    v = values[np.searchsorted(table, k[first])]
    v = np.repeat(v, np.diff(np.append(first, len(k))))
    return np.bincount((s & _U(0xFFFF)).astype(np.int64), weights=v, minlength=len(sizes))


def _sum_by(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their summed counts."""
    if not len(keys):
        return keys, n
    o = np.argsort(keys, kind="stable")
    k = keys[o]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[first], np.add.reduceat(n[o], first)


def _tally(keys: np.ndarray, train: bool) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.unique(keys, return_counts=True)
    return k, n if train else np.zeros(len(k), np.int64)


def _dealt(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys) >> _U(16)) % _U(buckets)


def _packed(kind: int, keys: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[tuple]:
    b = _dealt(keys, buckets)
    o = np.argsort(b, kind="stable")
    keys, n, b = keys[o], n[o], b[o]
    edge = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else []
    for lo, hi in zip(edge, [*edge[1:], len(b)]):
        yield kind, int(b[lo]), keys[lo:hi].tobytes(), n[lo:hi].tobytes()


class _Tally:
    """Distinct keys with counts, added up a piece at a time."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, part: tuple[np.ndarray, np.ndarray]) -> None:
        self.parts.append(part)
        self.held += len(part[0])
        if self.held > 4_000_000:
            self.parts = [self.total()]
            self.held = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, _U), np.empty(0, np.int64)
        return _sum_by(np.concatenate([k for k, _ in self.parts]), np.concatenate([n for _, n in self.parts]))


def _count(docs: DataFrame, buckets: int) -> DataFrame:
    """(kind, bucket, keys, n): distinct pairs and words of each task's texts with training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            rows = [r for kind in (PAIRS, WORDS) for r in _packed(kind, *tally[kind].total(), buckets)]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                names=["kind", "bucket", "keys", "n"])

        tally, seen = (_Tally(), _Tally()), 0
        for b in batches:
            held = b.column(0).to_numpy(zero_copy_only=False)
            for train in (True, False):
                texts = b.column(1).filter(pa.array(held != train)).to_pylist()
                for keys, _, _ in pieces(texts):
                    tally[PAIRS].add(_tally(keys, train))
                if texts:
                    tally[WORDS].add(_tally(np.concatenate(list(word_hashes(texts))), train))
            seen += b.column(1).nbytes
            if seen > FLUSH:
                yield out()
                tally, seen = (_Tally(), _Tally()), 0
        yield out()

    return docs.select("held_out", "text").mapInArrow(run, "kind int, bucket int, keys binary, n binary")


def _arrays(table: pa.Table, *cols: tuple[str, str]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in cols]


def _summed(counts: DataFrame, homes: int) -> DataFrame:
    """(kind, bucket, home, keys, n): counts over all tasks; pairs split by the home of their last two bytes."""
    def run(t: pa.Table) -> pa.Table:
        kind, bucket = t.column("kind")[0].as_py(), t.column("bucket")[0].as_py()
        k, n = _sum_by(*_arrays(t, ("keys", "<u8"), ("n", "<i8")))
        if kind == WORDS:
            rows = [(kind, bucket, -1, k.tobytes(), n.tobytes())]
        else:
            rows = [(kind, bucket, h, a, b) for _, h, a, b in _by_home(k, n, homes)]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], ty) for i, ty in enumerate(
            (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["kind", "bucket", "home", "keys", "n"])

    return counts.groupBy("kind", "bucket").applyInArrow(run, "kind int, bucket int, home int, keys binary, n binary")


def _by_home(k: np.ndarray, n: np.ndarray, homes: int):
    h = (mix(k >> _U(40)) >> _U(16)) % _U(homes)
    o = np.argsort(h, kind="stable")
    k, n, h = k[o], n[o], h[o]
    edge = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else []
    for lo, hi in zip(edge, [*edge[1:], len(h)]):
        yield 0, int(h[lo]), k[lo:hi].tobytes(), n[lo:hi].tobytes()


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = np.where(x < 8, x + 8, x)
    z = 1 / y
    out = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + z * (1 / 12 - z * z * (1 / 360 - z * z / 1260))
    small = x < 8
    if small.any():
        p = np.ones(int(small.sum()))
        for k in range(8):
            p *= x[small] + k
        out[small] -= np.log(p)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - np.log(np.pi)


def weigh(a, b, children, inner) -> tuple[np.ndarray, np.ndarray]:
    """(log Pw, posterior of stopping) of nodes; ``children``: summed log Pw of the children of inner nodes."""
    pe = estimate(a, b)
    pw = np.where(inner, np.logaddexp(pe, children) - np.log(2), pe)
    stop = np.where(inner, 1 / (1 + np.exp(np.clip(children - pe, -700, 700))), 1.0)
    return pw, stop


def _depth_mask(d: int) -> np.uint64:
    return _U(sum(255 << 8 * (6 - k) for k in range(d)))


def depths(keys: np.ndarray) -> np.ndarray:
    """Number of context bytes of each pair: up to and with the first line feed, or ``DEPTH``."""
    out = np.full(len(keys), DEPTH)
    for d in reversed(range(DEPTH)):
        out[(keys >> _U(8 * (6 - d)) & _U(255)) == 10] = d + 1
    return out


def bit(keys: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, value) of bit j of the pairs' bytes; the prefix has a leading one."""
    s = keys & _U(255)
    return _U(1) << _U(j) | s >> _U(8 - j), (s >> _U(7 - j) & _U(1)).astype(bool)


def _levels(keys: np.ndarray, n: np.ndarray, deep: np.ndarray, least: int):
    """Nodes of depth ``least`` to ``DEPTH``: (ids in order, zeros, ones) for each depth."""
    out = {}
    for d in range(least, DEPTH + 1):
        ids, zeros, ones = [], [], []
        here = deep >= d
        k, m = keys[here], n[here]
        for j in range(8):
            prefix, value = bit(k, j)
            node = (k & _depth_mask(d)) | prefix
            at, total = _sum_by(node, m)
            ids.append(at)
            one = _sum_by(node, m * value)[1]
            ones.append(one)
            zeros.append(total - one)
        ids = np.concatenate(ids)
        o = np.argsort(ids)
        out[d] = ids[o], np.concatenate(zeros)[o].astype(float), np.concatenate(ones)[o].astype(float)
    return out


def _ends(ids: np.ndarray, d: int) -> np.ndarray:
    """Whether nodes of depth d have no deeper context."""
    return (ids >> _U(8 * (7 - d)) & _U(255)) == 10 if d < DEPTH else np.ones(len(ids), bool)


def _deep(sums: DataFrame) -> DataFrame:
    """Rows of two kinds: (bucket, keys, p) with each pair's eight bit probabilities from depth 2 on (NaN where no such
    context was seen), and (node, a, b, w): counts and summed log Pw of the children of depth-1 nodes."""
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("p", pa.binary()), ("node", pa.int64()),
                        ("a", pa.float64()), ("b", pa.float64()), ("w", pa.float64())])

    def run(t: pa.Table) -> pa.Table:
        keys, n = _arrays(t, ("keys", "<u8"), ("n", "<i8"))
        bucket = np.repeat(t.column("bucket").to_numpy(), [len(x) // 8 for x in t.column("keys").to_pylist()])
        deep = depths(keys)
        seen = n > 0
        levels = _levels(keys[seen], n[seen], deep[seen], 1)
        stop, above = {}, None
        for d in range(DEPTH, 0, -1):
            ids, a, b = levels[d]
            children = np.zeros(len(ids))
            if above is not None:
                up = np.searchsorted(ids, (above[0] & _depth_mask(d)) | (above[0] & _U(255)))
                children = np.bincount(up, weights=above[1], minlength=len(ids))
            if d == 1:
                break
            pw, stop[d] = weigh(a, b, children, ~_ends(ids, d))
            above = ids, pw
        p = np.full((len(keys), 8), np.nan, np.float32)
        for j in range(8):
            prefix, value = bit(keys, j)
            got, rest, last = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), np.nan)
            for d in range(2, DEPTH + 1):
                at, za, on = levels[d]
                if not len(at):
                    continue
                node = (keys & _depth_mask(d)) | prefix
                i = np.minimum(np.searchsorted(at, node), len(at) - 1)
                ok = (at[i] == node) & (deep >= d)
                kt = (np.where(value, on[i], za[i]) + 0.5) / (za[i] + on[i] + 1)
                got += np.where(ok, rest * stop[d][i] * kt, 0)
                rest = np.where(ok, rest * (1 - stop[d][i]), rest)
                last = np.where(ok, kt, last)
            p[:, j] = got + rest * last
        o = np.argsort(bucket, kind="stable")
        bo = bucket[o]
        edge = np.flatnonzero(np.concatenate(([True], bo[1:] != bo[:-1])))
        spans = list(zip(edge, [*edge[1:], len(bo)]))
        ids, a, b = levels[1]
        m, none = len(ids), [None] * len(spans)
        return pa.Table.from_arrays([
            pa.array([int(bo[x]) for x, _ in spans] + [None] * m, pa.int32()),
            pa.array([keys[o[x:y]].tobytes() for x, y in spans] + [None] * m, pa.binary()),
            pa.array([p[o[x:y]].tobytes() for x, y in spans] + [None] * m, pa.binary()),
            pa.array(none + (ids >> _U(40) | ids & _U(255)).astype(np.int64).tolist(), pa.int64()),
            *[pa.array(none + v.tolist(), pa.float64()) for v in (a, b, children)]], schema=schema)

    return (sums.filter(F.col("kind") == PAIRS).groupBy("home")
            .applyInArrow(run, "bucket int, keys binary, p binary, node long, a double, b double, w double"))


class Top:
    """Depths 0 and 1: for (last byte, prefix, bit value) the mixed probability so far, the weight left for deeper contexts,
    and the estimate that takes it where there is none."""

    def __init__(self, rows: list):
        a, b, w = np.zeros((3, 256, 256))
        for r in rows:      # node: last byte * 256 + prefix (at most 256 * 255 of them)
            a[r["node"] >> 8, r["node"] & 255], b[r["node"] >> 8, r["node"] & 255] = r["a"], r["b"]
            w[r["node"] >> 8, r["node"] & 255] = r["w"]
        there = a + b > 0
        inner = np.ones((256, 1), bool)
        inner[10] = False
        pw1, stop1 = weigh(a, b, w, inner)
        a0, b0 = a.sum(axis=0), b.sum(axis=0)
        _, stop0 = weigh(a0, b0, np.where(there, pw1, 0).sum(axis=0), np.ones(256, bool))
        self.got, self.rest, self.last = (np.zeros((256, 256, 2)) for _ in range(3))
        for v, n0, n1 in ((0, a0, a), (1, b0, b)):
            kt0, kt1 = (n0 + 0.5) / (a0 + b0 + 1), (n1 + 0.5) / (a + b + 1)
            first = np.where(a0 + b0 > 0, stop0, 0.0)
            self.got[:, :, v] = first * kt0 + np.where(there, (1 - first) * stop1 * kt1, 0)
            self.rest[:, :, v] = (1 - first) * np.where(there, 1 - stop1, 1.0)
            self.last[:, :, v] = np.where(there, kt1, np.where(a0 + b0 > 0, kt0, 0.5))

    def log10(self, keys: np.ndarray, p: np.ndarray) -> np.ndarray:
        last, out = (keys >> _U(48) & _U(255)).astype(np.int64), np.zeros(len(keys))
        for j in range(8):
            prefix, value = bit(keys, j)
            at = last, prefix.astype(np.int64), value.astype(np.int64)
            out += np.log10(self.got[at] + self.rest[at] * np.where(np.isnan(p[:, j]), self.last[at], p[:, j]))
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes) of every row."""
    spark = docs.sparkSession
    base = docs.select(col(id_col).alias("id"), (fold(col(id_col), folds) == 0).alias("held_out"), col(text_col).alias("text"))
    size = base.agg(F.sum(F.octet_length("text")).alias("b"),
                    F.count(F.when(~F.col("held_out"), 1)).alias("train")).first()
    buckets = max(8, (size["b"] or 0) // BUCKET_BYTES)
    chunks = max(4, (size["b"] or 0) // CHUNK_BYTES)
    texts = base.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))

    sums = written(_summed(_count(texts, buckets), buckets), "counts")
    deep = written(_deep(sums), "tree")
    top = Top(deep.filter("node is not null").groupBy("node").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("w").alias("w")).collect())

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            n = np.frombuffer(b"".join(t.column(0).to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([int((n > 0).sum())])], names=["n", "v"])

    known = (sums.filter(F.col("kind") == WORDS).select("n").mapInArrow(totals, "n long, v long")
             .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first())
    ends = size["train"] or 0
    n_train = (known["n"] or 0) + ends
    per_known = n_train + 0.1 * ((known["v"] or 0) + (ends > 0) + 1)
    sent = spark.sparkContext.broadcast(top)

    # the tables that answer: (kind, bucket, keys, values), log10 of a pair's byte or count of a word
    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            v = [sent.value.log10(np.frombuffer(k, "<u8"), np.frombuffer(p, "<f4").reshape(-1, 8)).tobytes()
                 for k, p in zip(t.column(1).to_pylist(), t.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([PAIRS] * t.num_rows, pa.int32()), t.column(0), t.column(1),
                                              pa.array(v, pa.binary())], names=["kind", "bucket", "keys", "v"])

    table = (deep.filter("keys is not null").select("bucket", "keys", "p")
             .mapInArrow(final, "kind int, bucket int, keys binary, v binary")
             .unionByName(sums.filter(F.col("kind") == WORDS).select("kind", "bucket", "keys", F.col("n").alias("v"))))

    def ask(t: pa.Table) -> pa.Table:
        chunk, texts = t.column("chunk")[0].as_py(), t.column("text").to_pylist()
        pairs = _Tally()
        for keys, _, _ in pieces(texts):
            pairs.add(_tally(keys, False))
        words = np.unique(np.concatenate(list(word_hashes(texts))))
        rows = [r for kind, k in ((PAIRS, pairs.total()[0]), (WORDS, words))
                for r in _packed(kind, k, np.zeros(len(k), np.uint8), buckets)]
        return pa.Table.from_arrays([pa.array([chunk] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()),
                                     pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
                                    names=["chunk", "kind", "bucket", "keys"])

    def answer(q: pa.Table, t: pa.Table) -> pa.Table:
        out = []
        if q.num_rows:
            kind = q.column("kind")[0].as_py()
            keys, v = _arrays(t, ("keys", "<u8"), ("v", "<f8" if kind == PAIRS else "<i8"))
            o = np.argsort(keys)
            keys, v = keys[o], v[o].astype("<f8")
            for c, k in zip(q.column("chunk").to_pylist(), q.column("keys").to_pylist()):
                out.append((c, kind, k, v[np.searchsorted(keys, np.frombuffer(k, "<u8"))].tobytes()))
        return pa.Table.from_arrays([pa.array([r[i] for r in out], ty) for i, ty in enumerate(
            (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["chunk", "kind", "keys", "v"])

    kind = base.schema["id"].dataType.simpleString()

    def scored(t: pa.Table, r: pa.Table) -> pa.Table:
        texts = t.column("text").to_pylist()
        look = {}
        for k in (PAIRS, WORDS):
            keys, v = _arrays(r.filter(pa.compute.equal(r.column("kind"), k)), ("keys", "<u8"), ("v", "<f8"))
            o = np.argsort(keys)
            look[k] = keys[o], v[o]
        total, size, n, n_known, plain = np.zeros((5, len(texts)))
        keys, v = look[PAIRS]
        keys = close(keys)
        for k, starts, at in pieces(texts):
            np.add.at(total, at, text_sums(k, starts, keys, v))
            np.add.at(size, at, np.diff(np.append(starts, len(k))))
        keys, v = look[WORDS]
        end = np.log10((ends + 0.1) / per_known)
        for i, w in enumerate(word_hashes(texts)):
            c = v[np.searchsorted(keys, w)]
            n[i], n_known[i] = len(w) + 1, np.count_nonzero(c) + (ends > 0)
            plain[i] = np.log10((c + 0.1) / per_known).sum() + end
        return pa.Table.from_arrays([
            t.column("id").combine_chunks(), t.column("held_out").combine_chunks(), pa.array(n.astype(np.int64)),
            pa.array(n_known.astype(np.int64)), pa.array([n_train] * len(texts), pa.int64()), pa.array(plain), pa.array(total),
            pa.array(size.astype(np.int64))],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"])

    asked = texts.groupBy("chunk").applyInArrow(ask, "chunk int, kind int, bucket int, keys binary")
    answers = (asked.groupBy("kind", "bucket").cogroup(table.groupBy("kind", "bucket"))
               .applyInArrow(answer, "chunk int, kind int, keys binary, v binary"))
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        scored, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, n_bytes long")
    return out.withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


ORACLE_SQL = None
