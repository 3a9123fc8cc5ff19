"""Substring dedup by hashing units of text.

A text is cut into units: lines (``unit='line'``), paragraphs (between empty lines) or
sentences (lines cut after . ! ? and their CJK forms; a line without a long enough sentence is
one unit).  A unit is normalised (lower case, white space
collapsed) and has a 128-bit digest; units of fewer than ``min_words`` words never count.
Equal digests are grouped over the whole table; of each group the earliest occurrence
stays, by (id, start), and the others are to be removed, where they stand in a run of repeated units
of at least ``min_run`` words (a lone short line that many texts share is left alone; 0 removes it too).
Offsets are code points of the original text.

Passages (``repeated_passages``, the query) do not depend on where sentences end.  Removed are the later occurrences of

* every run of ``min_run`` words in a row, wherever it starts: all such runs of a text count, so a longer
  shared passage goes from its first to its last word;
* every whole line or paragraph of at least ``min_words`` words, however short its run;
* shorter repeated sentences of at least ``min_words`` words, where they make up a run of ``min_run`` words together
  with what goes beside them, at most a short unit apart.

Spans that follow each other with the same place of the kept text are one row; rows of a text do not overlap.
Runs of words are named by the smallest hash of their inner runs of a third of the words.  Neighbours mostly share
their name and are one entry, a stretch.  Equal runs have equal names, so only names that occur again matter.  If all
stretches of a name are equal, they are settled whole; if they differ, every run in them is settled by itself.

Scale of passages: whole texts are shuffled once, into chunks of about ``CHUNK_BYTES`` by id and text, whose texts are
hashed many at a time.  A chunk asks,
with packed arrays dealt by hash, which of its distinct names (of stretches and short units) occur again in the table, and
whether their stretches differ; a bucket of names gets each name once from a chunk, so no name is hot in it.  Only
entries whose name occurs again become rows.  A stretch whose runs are settled by themselves leaves its chunk as one row with its
runs' digests; it is a row for each run where digests are settled, so rows are in proportion to the words of what repeats.
Digests of more than one row in ``HEAVY`` are named by a frequent-items sketch and settled with map-side combining and broadcast
(few by that; counted, or an error).  All rows are shuffled once: those of settled digests one by one, all others by digest,
settled by a window, whose groups are small by that.

Texts are numbered so that those of one id (null: all of them) are in the order of their texts' hashes: chunks are
cells of a grid, ranges of that hash by hashes of the id.

Ids may have any type that can be ordered.  Null and empty texts have no units.  Null ids rank last, by their texts' hash.
Repeated rows are copies: the occurrences of the first one stay (they share a chunk).  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import col, documents, free_name, row_hash, written
from tickforge.llm.words import mix

#: Words of the shortest unit; words of the shortest run of repeated units that goes.
MIN_WORDS, MIN_RUN = 5, 15
HEAVY, COUNTERS = 256, 4096
UNITS = {
    "sentence": re.compile(r"[^\n.!?。！？]+[.!?。！？]*"),
    "line": re.compile(r"[^\n]+"),
    "paragraph": re.compile(r"(?:[^\n]|\n(?![^\S\n]*\n))+"),
}
#: Kinds of rows: short units, runs of words, and texts.
SENTENCE, LINE, PARAGRAPH, RUN, TEXT = range(5)
CHUNK_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20
#: Least number of chunks; code points hashed at a time (a longer text makes its block longer).
CHUNKS, BLOCK = 32, 1 << 17
#: What is known of a name: it occurs again, and its stretches differ or may repeat in themselves.
AGAIN, MIXED = 1, 2
_STOP = np.zeros(1 << 16, bool)
_STOP[[ord(c) for c in ".!?。！？"]] = True
_SPACE = np.array([chr(c).isspace() for c in range(1 << 16)])
_CHAR = np.random.default_rng(20240229).integers(1, 1 << 63, 1 << 16, dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)           # odd, so they have inverses modulo 2**64
_POWERS: list[np.ndarray] = []


def units(text: str, unit: str, min_words: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(start, end, number of the first word, words, digest) of the units of a text; white space around a
    unit is not part of it."""
    word = 0
    for block in UNITS["line" if unit == "sentence" else unit].finditer(text):
        whole = _unit(block.group(), block.start(), word, min_words)
        if unit == "sentence":
            found, at = [], word
            for m in UNITS["sentence"].finditer(block.group()):
                u = _unit(m.group(), block.start() + m.start(), at, min_words)
                at += u[3]
                found += [u] if u[4] else []
            yield from found or ([whole] if whole[4] else [])
        elif whole[4]:
            yield whole
        word += whole[3]


def _unit(u: str, at: int, word: int, min_words: int) -> tuple[int, int, int, int, bytes | None]:
    words = u.lower().split()
    counts = len(words) >= max(1, min_words)
    return (at + len(u) - len(u.lstrip()), at + len(u.rstrip()), word, len(words),
            hashlib.blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=16).digest() if counts else None)


def _unit_rows(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, found = [], []
            for i, t in enumerate(b.column(2).to_pylist()):
                for u in units(t or "", unit, min_words):
                    at.append(i)
                    found.append(u)
            d = np.frombuffer(b"".join(u[4] for u in found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), b.column(1).take(pa.array(at, pa.int64())),
                 pa.array([u[0] for u in found], pa.int32()), pa.array([u[1] for u in found], pa.int32()),
                 pa.array([u[2] for u in found], pa.int32()), pa.array([u[3] for u in found], pa.int32()),
                 pa.array(d[:, 0]), pa.array(d[:, 1])],
                names=["id", "rid", "start", "end", "word", "words", "d1", "d2"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, rid long, start int, end int, word int, words int, d1 long, d2 long")


def _frequent(rows: DataFrame) -> DataFrame:
    """The values of d1 that more than one row in ``HEAVY`` has (the sketch counts none too low).  They are written: made
    anew, a sketch may name others, and a row would be settled twice or not at all."""
    return written(rows.agg(F.expr(f"approx_top_k(d1, {HEAVY}, {COUNTERS})").alias("t"), F.count(F.lit(1)).alias("n"))
                   .select("n", F.explode("t").alias("t")).filter(F.col("t.count") * HEAVY > F.col("n"))
                   .select(F.col("t.item").alias("d1")), "frequent")


def _named(rows: DataFrame) -> list[int]:
    """The values of ``_frequent``, fewer than ``HEAVY``."""
    return [r["d1"] for r in _frequent(rows).collect()]


def _later(rows: DataFrame, rank: list[Column], inside: list[str]) -> DataFrame:
    """The rows whose digest occurs again, with ``best`` (the least ``rank`` of the digest) and ``group_size``.  The columns
    ``inside`` the rank move as its fields only; they come back as columns."""
    rows = rows.withColumn("own", F.struct(*rank)).drop(*inside)
    first = written(rows.filter(F.col("d1").isin(_named(rows))).groupBy("d1", "d2").agg(
        F.min("own").alias("hot_best"), F.count(F.lit(1)).alias("hot_size")), "first")
    if (n := first.count()) > 4 * HEAVY:       # digests that share their first half with a named one: a few at most
        raise ValueError(f"{n} frequent digests share {HEAVY} first halves; too many to broadcast")
    # each row once, with what is known of its digest; those of frequent digests are dealt one by one
    dealt = (rows.join(F.broadcast(first), ["d1", "d2"], "left")
             .withColumn("alone", F.when(F.col("hot_size").isNotNull(), F.xxhash64("own"))))
    w = Window.partitionBy("d1", "d2", "alone")
    return (dealt.withColumn("group_size", F.coalesce("hot_size", F.count(F.lit(1)).over(w))).filter("group_size > 1")
            .withColumn("best", F.coalesce("hot_best", F.first("own").over(w.orderBy("own"))))
            .drop("hot_best", "hot_size", "alone").select("*", *[F.col(f"own.{c}").alias(c) for c in inside]))


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                   min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """One row per unit to be removed: (id, start, end, n_words, run_words, keep_id, keep_start, group_size,
    row_hash); row_hash tells rows with the same id apart.  ``min_run`` 0 removes every repeated unit."""
    rid = F.xxhash64(F.coalesce(col(text_col), F.lit("")))
    rows = written(_unit_rows(docs.select(col(id_col).alias("id"), rid.alias("rid"),
                                          col(text_col).alias("text")), unit, min_words), "units")
    rows = rows.withColumn("ord", F.monotonically_increasing_id())
    rank = [F.col("id").isNull().alias("n"), F.col("id"), F.col("rid"), F.col("start"), F.col("ord")]
    again = (_later(rows, rank, ["id", "rid", "start", "ord"]).filter(F.col("best.ord") != F.col("ord"))
             .withColumn("after", F.col("word") + F.col("words")))
    # runs of repeated units that follow each other in a text, at most a short unit apart
    text = Window.partitionBy("id", "rid").orderBy("word", "ord")
    again = again.withColumn("run", F.sum(F.coalesce(
        (F.col("word") - F.lag("after").over(text) > min_words).cast("int"), F.lit(1))).over(text))
    run = Window.partitionBy("id", "rid", "run")
    return (again.withColumn("run_words", F.max("after").over(run) - F.min("word").over(run))
            .filter(F.col("run_words") >= min_run)
            .select(F.col("id").alias(id_col), "start", "end", F.col("words").alias("n_words"), "run_words", F.col("best.id").alias("keep_id"), F.col("best.start").alias("keep_start"), "group_size",
                    F.col("rid").alias("row_hash")))


def blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of the texts to be hashed at a time."""
    at = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield at, texts[at:k]
            at, size = k, 0
        size += len(t) + 2
    if texts:
        yield at, texts[at:]


def _lower(text: str) -> str:
    """Lower case; a letter whose lower case is longer stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


class Words:
    """The words of texts as ``lower().split()`` gives them, and hashes of word runs.  The texts stand one after another with
    an empty line between them, so nothing goes from one to the next; places count from the first text's begin."""

    def __init__(self, texts: list[str]):
        joined = "\n\n".join(texts)
        low = joined.lower()
        if len(low) != len(joined):
            low = "\n\n".join(map(_lower, texts))
        self.codes = codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not _POWERS or len(_POWERS[0]) < len(codes) + 1:
            _POWERS[:] = []
            for b in [y for x in _BASES for y in (x, pow(x, -1, 1 << 64))]:
                p = np.full(max(1 << 16, len(codes) + max(1 << 16, len(codes) // 4)), b, np.uint64)
                p[0] = 1
                _POWERS.append(np.multiply.accumulate(p))
        far = codes > 0xFFFF
        some = bool(far.any())
        self.near = near = np.where(far, 0, codes) if some else codes
        self.inside = ~_SPACE[near] | far
        x = _CHAR[near]
        if some:
            x[far] = mix(codes[far].astype(np.uint64))
        self.total = self._sums(x, 0)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], self.inside, [False])).view(np.int8)))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.h = self.hashes(self.starts, self.ends)
        #: where texts begin, and their first words
        self.begin = np.cumsum([0, *(len(t) + 2 for t in texts[:-1])])
        self.first = np.searchsorted(self.starts, self.begin)
        self.sums = [self._sums(self.h, k) for k in range(2)]

    def text(self, places: np.ndarray) -> np.ndarray:
        """Number of the text of places."""
        return np.searchsorted(self.begin, places, "right") - 1

    @staticmethod
    def _sums(x: np.ndarray, k: int) -> np.ndarray:
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * _POWERS[2 * k][:len(x)], out=total[1:])
        return total

    @staticmethod
    def _between(total: np.ndarray, a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
        return mix((total[b] - total[a]) * _POWERS[2 * k + 1][a] + (b - a).astype(np.uint64))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of pieces of the text."""
        return self._between(self.total, starts, ends, 0)

    def digest(self, k: int, a: np.ndarray, b: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
        """Hash of each run of words [a, b), of hashes ``h`` instead of the words' own where given; k: the first or second hash."""
        return self._between(self.sums[k] if h is None else self._sums(h, k), a, b, k).view(np.int64)

    def short_units(self, least: int, below: int) -> Iterator[tuple]:
        """(kind, starts, ends, first words, words, d1, d2) of sentences, lines and paragraphs of at least ``least``
        and fewer than ``below`` words."""
        line = self.codes == 10
        cut = _STOP[self.near] | line
        heads = np.flatnonzero(~cut & np.concatenate(([True], cut[:-1])))      # of sentences
        breaks = np.flatnonzero(line)
        tails = np.append(heads[1:], len(line))
        if len(breaks):
            at = np.searchsorted(breaks, heads)
            tails = np.minimum(tails, np.where(at < len(breaks), breaks[np.minimum(at, len(breaks) - 1)], len(line)))
        # a sentence may begin inside a word
        inner = heads[self.inside[heads] & (heads > 0) & self.inside[np.maximum(heads, 1) - 1]]
        starts = np.sort(np.concatenate((self.starts, inner)))
        ends = np.sort(np.concatenate((self.ends, inner)))
        yield from self._units(SENTENCE, starts, ends, self.hashes(starts, ends) if len(inner) else None, heads, tails, least, below)
        heads, tails = np.append(0, breaks + 1), np.append(breaks, len(line))
        yield from self._units(LINE, self.starts, self.ends, None, heads, tails, least, below)
        # paragraphs: lines with words in a row, two at least
        full = np.searchsorted(self.starts, tails) > np.searchsorted(self.starts, heads)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], full, [False])).view(np.int8)))
        a, b = edge[::2], edge[1::2]
        a, b = a[b - a > 1], b[b - a > 1]
        yield from self._units(PARAGRAPH, self.starts, self.ends, None, heads[a], tails[b - 1], least, below)

    def _units(self, kind, starts, ends, h, heads, tails, least, below) -> Iterator[tuple]:
        a, b = np.searchsorted(starts, heads), np.searchsorted(starts, tails)
        ok = (b - a >= max(1, least)) & (b - a < below)
        a, b = a[ok], b[ok]
        if len(a):
            d1, d2 = (self.digest(k, a, b, h) for k in range(2))
            word = np.searchsorted(self.starts, starts[a])
            yield kind, starts[a], ends[b - 1], word, np.searchsorted(self.starts, ends[b - 1]) - word, d1 + kind, d2


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n words in a row."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASES[0]) + h[j:j + m]
    return mix(out)


def stretches(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, first run, runs, whether a run may occur twice in it) of the stretches of runs of n words (2 at least) with one
    name; ``of``: the text of each word."""
    inner = max(1, n // 3)
    wide, m = n - inner + 1, len(h) - n + 1
    whole = of[n - 1:] == of[:max(0, m)]           # runs inside one text
    if not whole.any():
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    s = _rolled(h, inner)
    least = s[:m].copy()
    for j in range(1, wide):
        np.minimum(least, s[j:j + m], out=least)
    head = whole.copy()
    head[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
    first, upto = np.flatnonzero(head), np.cumsum(whole)
    many = np.diff(np.append(upto[first] - 1, upto[-1]))
    # inner runs are equal in one text only
    own = of[:len(s)]
    s = np.where(of[inner - 1:] == own, s ^ mix(own.astype(np.uint64)), np.arange(len(s), dtype=np.uint64))
    again = np.zeros(len(s) + 1, np.int64)
    for p in range(1, min(wide, len(s))):
        again[1:len(s) - p + 1] |= s[p:] == s[:-p]
    np.cumsum(again, out=again)
    return least[first], first, many, (many > wide) | (again[first + many + wide - 1] > again[first])


class Entries:
    """What of texts may occur again: stretches of runs of n words, then short units; each has a name."""

    def __init__(self, texts: list[str], least: int, n: int):
        self.x, self.n = x, n = Words(texts), n
        self.stretch, self.first, self.many, self.twice = stretches(x.h, x.text(x.starts), n)
        self.short = list(x.short_units(least, n))
        self.names = np.concatenate([self.stretch, *(u[5].view(np.uint64) for u in self.short)])

    def whole(self, of) -> np.ndarray:
        """Digest of all the words of stretches."""
        a = self.first[of]
        return self.x.digest(0, a, a + self.many[of] + self.n - 1)

    def digests(self) -> np.ndarray:
        """32 bits that tell the stretches (or units) of one name apart."""
        return np.concatenate([self.whole(slice(None)), *(u[6] for u in self.short)]).view(np.uint64).astype(np.uint32)

    def known(self) -> np.ndarray:
        """``MIXED`` for a stretch that may repeat in itself."""
        return np.concatenate([self.twice * MIXED, np.zeros(len(self.names) - len(self.twice), int)]).astype(np.uint8)

    def rows(self, known: np.ndarray) -> Iterator[tuple]:
        """(text, kind, start, end, word, words, d1, d2, runs, their starts, ends and digests), arrays, of what occurs again.
        Places count from the text's begin.  Stretches that differ have the name and 0 for digest, and their runs (number)."""
        x, n, m = self.x, self.n, len(self.stretch)
        none = (np.empty(0, np.int64),) * 3
        s = known[:m]
        of = np.flatnonzero(s == AGAIN)
        if len(of):
            a, b = self.first[of], self.first[of] + self.many[of] + n - 1
            yield *self._placed(RUN, x.starts[a], x.ends[b - 1], a, b - a), self.stretch[of].view(np.int64), self.whole(of), 0 * of, *none
        of = np.flatnonzero(s & MIXED)
        if len(of):
            a, many = self.first[of], self.many[of]
            w = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(many.sum())
            begin = np.repeat(x.starts[a], many)
            yield (*self._placed(RUN, x.starts[a], x.ends[a + many + n - 2], a, 0 * of + n), self.stretch[of].view(np.int64), 0 * of,
                   many, x.starts[w] - begin, x.ends[w + n - 1] - begin, x.digest(1, w, w + n))
        for u in self.short:
            of, m = np.flatnonzero(known[m:m + len(u[1])]), m + len(u[1])
            if len(of):
                yield *self._placed(u[0], *(v[of] for v in u[1:5])), u[5][of], u[6][of], 0 * of, *none

    def _placed(self, kind: int, start, end, word, words) -> tuple:
        of = self.x.text(start)
        begin = self.x.begin[of]
        return of, np.full(len(of), kind), start - begin, end - begin, word - self.x.first[of], words


def _known(names: np.ndarray, digests: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names in order, a digest of each, and what is known of them together."""
    o = np.argsort(names, kind="stable")
    names, digests, known = names[o], digests[o], known[o]
    at = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.empty(0, np.int64)
    if not len(at):
        return names, digests, known
    size = np.diff(np.append(at, len(names)))
    apart_ = np.minimum.reduceat(digests, at) != np.maximum.reduceat(digests, at)
    return names[at], digests[at], np.bitwise_or.reduceat(known, at) | (size > 1) * np.uint8(AGAIN) | apart_ * np.uint8(MIXED)


_ROW = ("kind int, doc long, start int, end int, word int, words int, d1 long, d2 long, "
        "starts array<int>, ends array<int>, runs array<long>, id ")
_KINDS = (pa.int32(), pa.int64(), *[pa.int32()] * 4, *[pa.int64()] * 2)


def _recurring(docs: DataFrame, id_col: str, text_col: str, min_words: int, n: int) -> DataFrame:
    """Rows of ``_ROW``: entries whose name occurs again (doc: number of a row of ``docs``; where its stretches differ with the
    starts, ends and digests of the runs), and a ``TEXT`` row (d1: hash of the text) for each text that has some."""
    src = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("rid"), col(text_col).alias("text")).filter("text <> ''")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(CHUNKS, size // CHUNK_BYTES), max(8, size // BUCKET_BYTES)
    ranges = math.isqrt(chunks)
    slots = -(-chunks // ranges)
    share = F.shiftright("rid", 33) + F.lit(1 << 30)           # of 2 ** 31
    cell = lambda k: F.shiftright(share * F.lit(k), 31)
    texts = src.withColumn("chunk", F.when(F.col("id").isNull(), cell(ranges * slots)).otherwise(
        cell(ranges) * slots + F.pmod(F.xxhash64("id"), F.lit(slots))).cast("int"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def ask(t: pa.Table) -> pa.Table:
        chunk, parts = t.column("chunk")[0].as_py(), []
        for _, some in blocks(t.column("text").to_pylist()):
            e = Entries(some, min_words, n)
            parts.append((e.names, e.digests(), e.known()))
        names, digests, known = _known(*(np.concatenate(c) for c in zip(*parts)))
        bucket = mix(names) % np.uint64(buckets)
        o = np.argsort(bucket, kind="stable")
        names, digests, known, bucket = names[o], digests[o], known[o], bucket[o].astype(np.int64)
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        spans = list(zip(at, [*at[1:], len(bucket)]))
        return pa.table([pa.array([chunk] * len(spans), pa.int32()), pa.array(bucket[at], pa.int32()),
                         *[pa.array([v[i:j].tobytes() for i, j in spans], pa.binary()) for v in (names, digests, known)]],
                        names=["chunk", "bucket", "names", "digests", "known"])

    def answer(t: pa.Table) -> pa.Table:
        arrays = [[np.frombuffer(b, k) for b in t.column(c).to_pylist()]
                  for c, k in (("names", "<u8"), ("digests", "<u4"), ("known", "u1"))]
        names, _, known = _known(*map(np.concatenate, arrays))
        names, known = names[known > 0], known[known > 0]
        out = []
        for chunk, own in zip(t.column("chunk").to_pylist(), arrays[0]):
            at = np.searchsorted(names, own)
            hit = np.flatnonzero(np.append(names, np.uint64(0))[at] == own) if len(names) else []
            if len(hit):
                out.append((chunk, own[hit].tobytes(), known[at[hit]].tobytes()))
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                        names=["chunk", "names", "known"])

    id_arrow = pa.schema([f for f in _arrow_schema(src.select("id"))])

    def found(t: pa.Table, r: pa.Table) -> pa.Table:
        names, known = (np.frombuffer(b"".join(r.column(c).to_pylist()), k) for c, k in (("names", "<u8"), ("known", "u1")))
        o = np.argsort(names)
        names, known = np.append(names[o], np.uint64(0)), np.append(known[o], np.uint8(0))
        rows = []
        t = t.take(pa.array(np.argsort(t.column("rid").to_numpy(), kind="stable")))
        rids = t.column("rid").to_numpy()
        for at, some in blocks(t.column("text").to_pylist()) if len(names) > 1 else ():
            e = Entries(some, min_words, n)
            found_at = np.searchsorted(names[:-1], e.names)
            own = np.where(names[found_at] == e.names, known[found_at], np.uint8(0))
            if own.any():
                mine = [(at + of, *v) for of, *v in e.rows(own)]
                who = np.unique(np.concatenate([v[0] for v in mine]))
                zero, none = 0 * who, np.empty(0, np.int64)
                rows += [(who, zero + TEXT, *[zero] * 4, rids[who], zero, zero, none, none, none), *mine]
        who, kind, *cols, many, starts, ends, runs = ([np.concatenate(c) for c in zip(*rows)] if rows else [np.empty(0, np.int64)] * 12)
        first = t.column("chunk")[0].as_py() << 32 if t.num_rows else 0
        ids = t.column("id").combine_chunks().take(pa.array(who, pa.int64()))
        ends_at = pa.array(np.concatenate(([0], np.cumsum(many))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends_at, pa.array(v.astype(k.to_pandas_dtype()), k))
                 for v, k in ((starts, pa.int32()), (ends, pa.int32()), (runs, pa.int64()))]
        return pa.table([*(pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip((kind, first + who, *cols), _KINDS)), *lists,
                         ids.cast(id_arrow.field(0).type)], names=[x.split()[0] for x in _ROW.split(", ")])

    asked = texts.groupBy("chunk").applyInArrow(ask, "chunk int, bucket int, names binary, digests binary, known binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "chunk int, names binary, known binary")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(found, _ROW + id_type)


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(df.schema)


def _each(rows: DataFrame) -> DataFrame:
    """A row for each run of the stretches that have runs, one for every other; the digest first where it is a run's: a name may
    have very many runs."""
    split = F.size("runs") > 0
    whole = F.array(F.struct(F.lit(0).alias("starts"), (F.col("end") - F.col("start")).alias("ends"), F.col("d2").alias("runs")))
    part = rows.select("*", F.posexplode(F.when(split, F.arrays_zip("starts", "ends", "runs")).otherwise(whole)).alias("i", "part"))
    return part.select("kind", "id", "doc", (F.col("start") + F.col("part.starts")).alias("start"), (F.col("word") + F.col("i")).alias("word"),
                       (F.col("start") + F.col("part.ends")).alias("end"), "words",
                       F.when(split, F.col("part.runs")).otherwise(F.col("d1")).alias("d1"),
                       F.when(split, F.col("d1")).otherwise(F.col("part.runs")).alias("d2"))


def _joined(rows: DataFrame, alone: Column, order: list[str]) -> DataFrame:
    """Rows of a text that follow each other here and in the kept text as one; rows that are ``alone`` stay."""
    w = Window.partitionBy("doc").orderBy(*order)
    off = F.col("best_word") - F.col("word")
    step = rows.withColumn("run", F.sum(F.coalesce(
        (alone | (F.col("word") > F.lag("after").over(w)) | (F.col("best_doc") != F.lag("best_doc").over(w))
         | (off != F.lag(off).over(w))).cast("int"), F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return step.groupBy("run", "kind", "doc", "best_doc", "best_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("word").alias("word"), F.max("after").alias("after"),
        F.min("best_start").alias("best_start"), F.min("best_word").alias("best_word"),
        F.max("group_size").alias("group_size")).drop("run")


def _passages(docs: DataFrame, id_col: str, text_col: str, min_words: int, min_run: int) -> tuple[DataFrame, DataFrame]:
    """(texts that have something that occurs again: doc, id, rid; spans to be removed)."""
    n = max(2, min_run)
    rows = written(_recurring(docs, id_col, text_col, min_words, n), "recurring")
    base = rows.filter(F.col("kind") == TEXT).select("doc", "id", F.col("d1").alias("rid"))
    inside = ["id", "doc", "start", "word"]
    rank = [F.col("id").isNull().alias("n"), *map(F.col, inside)]
    later = (_later(_each(rows.filter(F.col("kind") != TEXT)), rank, inside)
             .filter((F.col("best.doc") != F.col("doc")) | (F.col("best.start") != F.col("start")))
             .select("kind", "doc", "start", "end", "word", (F.col("word") + F.col("words")).alias("after"),
                     *[F.col(f"best.{c}").alias(f"best_{c}") for c in inside], "group_size"))

    # runs that follow each other here and in the kept text are one span; a short unit is a span of its own
    spans = _joined(later.withColumn("short", F.col("kind") != RUN), F.col("short"), ["short", "word", "start", "kind"])
    text = Window.partitionBy("doc").orderBy("word", "start")
    # short sentences go in runs only
    behind = F.max("after").over(text.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("run", F.sum(F.coalesce((F.col("word") - behind > min_words).cast("int"), F.lit(1))).over(text))
    run = Window.partitionBy("doc", "run")
    spans = (spans.withColumn("all", F.max("after").over(run) - F.min("word").over(run))
             .filter((F.col("kind") != SENTENCE) | (F.col("all") >= min_run)).drop("run", "all"))
    # spans inside another go; of two that overlap the first ends where the second begins
    w = Window.partitionBy("doc").orderBy("start", F.col("end").desc(), F.col("kind").desc())
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("_before", before).filter("_before IS NULL OR end > _before")
    spans = (spans.withColumn("end", F.least("end", F.lead("start").over(w))).withColumn(
        "after", F.least("after", F.lead("word").over(w))).withColumn("n_words", F.col("after") - F.col("word")))
    follows = F.coalesce((F.col("word") > F.lag("after").over(w)).cast("int"), F.lit(1))
    spans = (spans.withColumn("island", F.sum(follows).over(w))
             .withColumn("run_words", F.sum("n_words").over(Window.partitionBy("doc", "island")).cast("int")))
    return base, spans


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      min_run: int = MIN_RUN) -> DataFrame:
    """One row per span to be removed, with the columns of ``repeated_units``; ``keep_start`` is where the kept text of the
    span begins, ``group_size`` the occurrences of its most frequent part."""
    base, spans = _passages(docs, id_col, text_col, min_words, min_run)
    return spans.join(base, "doc").select(
        F.col("id").alias(id_col), "start", "end", "n_words", "run_words", F.col("best_id").alias("keep_id"),
        F.col("best_start").alias("keep_start"), "group_size", F.col("rid").alias("row_hash"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                   min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with the repeated units (``unit="passage"``: passages) cut out of the text; all columns and rows stay."""
    k1, k2, k3, spans = (free_name(docs, x) for x in ("_unit_id", "_unit_hash", "_unit_copy", "_unit_spans"))
    h, n = free_name(docs, "_own_hash"), free_name(docs, "_own_copy")
    left = docs.withColumn(h, F.xxhash64(F.coalesce(col(text_col), F.lit(""))))
    if unit == "passage":      # repeated rows: the first one keeps what the others lose
        base, found = _passages(docs, id_col, text_col, min_words, min_run)
        copies = base.select("doc", "id", "rid", F.row_number().over(Window.partitionBy("id", "rid").orderBy("doc")).alias("copy"))
        found = found.join(copies, "doc").select(F.col("id").alias(k1), F.col("rid").alias(k2), F.col("copy").alias(k3), "start", "end")
        left = left.withColumn(n, F.row_number().over(
            Window.partitionBy(col(id_col), col(h)).orderBy(row_hash(docs))))
    else:
        found = repeated_units(docs, id_col, text_col, unit, min_words, min_run).select(
            col(id_col).alias(k1), F.col("row_hash").alias(k2), F.lit(1).alias(k3), "start", "end")
        left = left.withColumn(n, F.lit(1))
    cut = found.groupBy(k1, k2, k3).agg(F.collect_set(F.struct("start", "end")).alias(spans))          # at most a text's own units

    @F.pandas_udf("string")
    def without(text: pd.Series, where: pd.Series) -> pd.Series:
        def one(t, spans):
            if t is None or spans is None or not len(spans):
                return t
            out, at = [], 0
            for s, e in sorted((int(x["start"]), int(x["end"])) for x in spans):
                out.append(t[at:s])
                at = max(at, e)
            return "".join([*out, t[at:]])
        return pd.Series([one(t, s) for t, s in zip(text, where)], dtype=object)

    joined = left.join(cut, left[id_col].eqNullSafe(cut[k1]) & (left[h] == cut[k2]) & (left[n] == cut[k3]), "left")
    return joined.select(*[(without(col(c), col(spans)).alias(c) if c == text_col else col(c)) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "start", "end", "n_words", "run_words", F.col("keep_id").alias("keep_doc_id"), "keep_start", "group_size")


ORACLE_SQL = None
