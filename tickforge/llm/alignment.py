"""Cross-tokenizer alignment: where the tokens of two vocabularies meet, and how common their links are.

A is a byte-level BPE vocabulary (JSON), B a sentencepiece BPE model with byte fallback that puts a space before a text.  Both
cover the bytes of space + text.  Byte offsets where tokens of both end cut the tokens into groups; an A and a B token are linked
when their byte ranges overlap.

1. Exact-text deduplication: rows are shuffled by full text and counted (combined map-side, so a text that a third of all rows
   hold leaves a task as one row).  Everything after works on distinct texts, weighted by their number of rows.
2. Each text is cut at single spaces between two characters that are no white space.  Neither tokenizer joins bytes across such
   a place (A's pattern begins a word there; no piece of B has a space after another character, which is checked), so a text's tokens,
   groups and links are those of its units in a row.  A task numbers the distinct units of a chunk of texts, tokenises and aligns
   each once on NumPy arrays, and keeps a text as its list of unit numbers.  A chunk ends at ``UNITS`` units or ``LISTED`` listed numbers.
3. A chunk's distinct links (A id, B id) with the number of documents that hold them go, packed, to buckets by hash of the link.  A bucket
   adds them up (a chunk names a link once, so no link is hot) and answers each chunk with the totals of its links.
4. The largest total of each A id is a table of at most one row per A id; it is sent to the workers.
5. Chunks meet their answers: totals are summed over links, units and texts.
6. Measures are joined to the rows by SHA-256 of the text; adaptive execution splits the join for a text of many rows.

Texts that are null, empty, or that a tokenizer alters (B reads U+2581 as a space) have no tokens: zeros and ''.  Special tokens
of A inside a text are plain text.  Rows count each time, also repeated ones and null ids.  Other columns never matter; an empty table gives
no row.  Nothing is sampled or capped; a text is held whole by one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.bpe import SPLIT, byte_letters, default_vocabulary
from tickforge.llm.common import apart, col, documents, written
from tickforge.llm.words import mix

#: Units and listed unit numbers at which a chunk of texts ends; links that a bucket adds up on average (at most).
UNITS, LISTED, BUCKET = 400_000, 8_000_000, 4_000_000
#: Fixed value: the mark that stands for a space in sentencepiece vocabularies.
SPACE_MARK = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_LOOSE = re.compile(r"\s | \s")

MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def pack(a: np.ndarray) -> bytes:
    """An integer array, its bytes sorted by place and compressed."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(
        a.dtype.char.encode() + np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def unpack(b: bytes) -> np.ndarray:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(b)
    kind = np.dtype(raw[:1].decode())
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=1).reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.int64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b))


class Tokenizers:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, spec: str, model: bytes):
        import sentencepiece
        import tiktoken
        j = json.loads(spec)
        letters = byte_letters()
        special = {t["content"] for t in j.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in s): i for s, i in j["model"]["vocab"].items() if s not in special}
        made = [ranks[bytes(letters[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))]
                for m in j["model"]["merges"]]
        if made != sorted(set(made)):
            raise ValueError("the ids of the vocabulary do not follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n_a, self.n_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.len_a = np.zeros(self.n_a, np.int64)
        for token, i in ranks.items():
            self.len_a[i] = len(token)
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self.bytes_b, self.cuts = [], True
        for i in range(self.n_b):
            p = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode())
            self.cuts &= SPACE_MARK not in p.lstrip(SPACE_MARK)
        self.len_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # how a token is written in a group: followed by ',' inside its side, '|' after A's side, ';' after B's
        self.words = np.array([f"{i}{end}" for end in ",|;" for i in range(max(self.n_a, self.n_b))], dtype=object)
        self.span = max(self.n_a, self.n_b)

    def units(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if _LOOSE.search(text) or text[0].isspace() or text[-1].isspace():
            return _CUT.split(text)
        return text.split(" ")                                 # every space is between two words


def _tokens(t: Tokenizers, units: list[str], sizes: np.ndarray):
    """(A ids, B ids, which units are unaltered, A tokens and B tokens of each unit).  Units without white space at
    their ends are tokenised some dozens at a time, since no token crosses from one to the next."""
    lines, run = [], []
    for u in units:
        if u and not u[0].isspace() and not u[-1].isspace() and t.cuts:
            run.append(u)
            if len(run) < 64:
                continue
        if run:
            lines.append(" ".join(run))
        if not (run and run[-1] is u):
            lines.append(u)
        run = []
    if run:
        lines.append(" ".join(run))
    a = np.fromiter(chain.from_iterable([t.a.encode_ordinary(" " + x) for x in lines]), np.int64)
    b = np.fromiter(chain.from_iterable(t.b.encode(lines, num_threads=1) if lines else []), np.int64)
    whole = "".join([" " + u for u in units]).encode()
    if b"".join(map(t.bytes_b.__getitem__, b.tolist())) == whole:         # A has every byte and alters nothing
        ends = np.cumsum(sizes)
        n_a, n_b = (np.diff(np.searchsorted(np.cumsum(size[x]), ends, "right"), prepend=0)
                    for x, size in ((a, t.len_a), (b, t.len_b)))
        return a, b, np.ones(len(units), bool), n_a, n_b
    ids_a, ids_b = [t.a.encode_ordinary(" " + u) for u in units], t.b.encode(units, num_threads=1)
    good = np.array([b"".join(map(t.bytes_b.__getitem__, x)) == (" " + u).encode() for u, x in zip(units, ids_b)], bool)
    for ids in (ids_a, ids_b):
        ids[:] = [x if ok else [] for x, ok in zip(ids, good)]
    return (*(np.array(list(chain.from_iterable(x)), np.int64) for x in (ids_a, ids_b)), good,
            *(np.array(list(map(len, x)), np.int64) for x in (ids_a, ids_b)))


class Aligned:
    """The alignment of many units at once; unit k has tokens, groups and links in rows of the flat arrays."""

    def __init__(self, t: Tokenizers, units: list[str]):
        n = len(units)
        sizes = np.fromiter(map(len, map(str.encode, units)), np.int64, n) + 1
        a, b, self.good, self.n_a, self.n_b = _tokens(t, units, sizes)
        end_a, end_b = np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b])
        ends = _distinct(np.concatenate((end_a, end_b)))                   # where links end
        at_a, at_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        of_a, of_b = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        of_a[at_a] = of_b[at_b] = 1
        both = of_a & of_b                                                 # where groups end
        link_a, link_b, group = (np.cumsum(x) - x for x in (of_a, of_b, both))
        self.codes = a[link_a] * t.n_b + b[link_b]
        unit_of_a = np.repeat(np.arange(n), self.n_a)
        self.n_links = np.bincount(unit_of_a[link_a], minlength=n)
        self.n_groups = np.bincount(unit_of_a[of_b[at_a] == 1], minlength=n)
        # tokens in writing order: by group, A's before B's
        group_a, group_b = group[at_a], group[at_b]
        groups = int(both.sum())
        upto_a, upto_b = np.cumsum(np.bincount(group_a, minlength=groups)), np.cumsum(np.bincount(group_b, minlength=groups))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.append(0, upto_b)[group_a]] = a + t.span * (of_b[at_a] == 1)
        code[np.arange(len(b)) + upto_a[group_b]] = b + 2 * t.span * (of_a[at_b] == 1)
        words = t.words[code].tolist()
        stop = np.cumsum(self.n_a + self.n_b)
        start = (stop - self.n_a - self.n_b).tolist()
        self.written = ["".join(words[i:j]) for i, j in zip(start, stop.tolist())]

def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(x[1:] != x[:-1], True)[:len(x)]]


class _Numbers(dict):
    """Numbers its keys in order of their first use."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, in a row."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Chunk:
    """Distinct units of some texts, and the documents that hold each link."""

    def __init__(self, t: Tokenizers):
        self.t, self.numbers, self.listed = t, _Numbers(), 0
        self.n_a = self.n_b = self.n_groups = self.n_links = np.empty(0, np.int64)
        self.good = np.empty(0, bool)
        self.codes, self.written = np.empty(0, np.int64), []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, texts: list[str], rows: np.ndarray) -> list[tuple]:
        """(measures..., unit numbers) of each text; counts its links ``rows`` times."""
        lists = [list(map(self.numbers.__getitem__, self.t.units(x))) for x in texts]
        self._grow(list(self.numbers)[len(self.n_a):])
        if not self.good.all():
            for k, (x, units) in enumerate(zip(texts, lists)):
                if not self.good[units].all():
                    lists[k] = self._whole(x)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        bounds = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(lists)), sizes)
        sums = [np.bincount(text, x[flat], len(lists)).astype(np.int64) for x in (self.n_a, self.n_b, self.n_groups, self.n_links)]
        # each text's distinct units, then its distinct links
        key = _distinct(text * len(self.n_a) + flat)
        text, unit = np.divmod(key, len(self.n_a))
        first = np.cumsum(self.n_links) - self.n_links
        span = self.t.n_a * self.t.n_b
        key = _distinct(np.repeat(text, self.n_links[unit]) * span + self.codes[ranges(first[unit], self.n_links[unit])])
        text, code = np.divmod(key, span)
        self._hold(code, rows[text])
        self.listed += len(flat)
        word = self.written.__getitem__
        out = []
        for k, units in enumerate(lists):
            s = "".join(map(word, units))[:-1]
            out.append((*(int(x[k]) for x in sums), hashlib.sha256(s.encode()).hexdigest() if s else "",
                        pack(flat[bounds[k]:bounds[k] + sizes[k]].astype(np.uint32))))
        return out

    def _whole(self, x: str) -> list[int]:
        """Number of a text that has a unit altered by a tokenizer: one unit, with no tokens if the whole is altered."""
        n = self.numbers[(x,)]                                     # a key that no unit has
        if n >= len(self.n_a):
            self._append(Aligned(self.t, [x]))
        return [n]

    def _grow(self, units: list[str]) -> None:
        if units:
            self._append(Aligned(self.t, units))

    def _append(self, got: Aligned) -> None:
        for name in ("n_a", "n_b", "n_groups", "n_links", "good", "codes"):
            setattr(self, name, np.concatenate((getattr(self, name), getattr(got, name))))
        self.written += got.written

    def _hold(self, codes: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(codes, kind="stable")
        self.held.append(_summed(codes[order], rows[order]))
        if len(self.held) > 1 and len(self.held[-2][0]) <= 2 * len(self.held[-1][0]):
            self._join()

    def _join(self) -> None:
        codes, rows = (np.concatenate(c) for c in zip(*self.held))
        order = np.argsort(codes, kind="stable")
        self.held = [_summed(codes[order], rows[order])]

    def full(self) -> bool:
        return len(self.numbers) >= UNITS or self.listed >= LISTED

    def links(self) -> tuple[bytes, bytes, bytes, bytes, int]:
        """Packed: distinct links, their documents, links of each unit, and their places among the distinct links."""
        self._join()
        codes, rows = self.held[0]
        # a unit whose texts all have an altered unit is in no list: its links may be no link of the chunk
        place = np.searchsorted(codes, self.codes)
        place = np.where(place < len(codes), place, 0).astype(np.uint32)
        return pack_sorted(codes), pack(rows), pack(self.n_links.astype(np.uint32)), pack(place), len(codes)


def _summed(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``rows`` for each distinct value of the sorted ``codes``."""
    if not len(codes):
        return codes, rows
    at = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
    return codes[at], np.add.reduceat(rows, at)


_LOADED: dict[tuple, Tokenizers] = {}


def tokenizers(spec: str, model: bytes) -> Tokenizers:
    """Both tokenizers, built once per worker."""
    key = (hashlib.sha256(spec.encode()).digest(), hashlib.sha256(model).digest())
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizers(spec, model)
    return _LOADED[key]


_ALIGNED = pa.schema([
    ("key", pa.binary()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("chunk", pa.int64()), ("units", pa.binary()), ("codes", pa.binary()), ("rows", pa.binary()),
    ("sizes", pa.binary()), ("places", pa.binary()), ("n_codes", pa.int64())])
_ALIGNED_SQL = (f"key binary, {MEASURES}, chunk long, units binary, codes binary, rows binary, sizes binary, places binary, "
                "n_codes long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ALIGNED)], schema=_ALIGNED)


def _answered(n_b: int, best):
    """Function of a chunk's texts and links with the totals of its links: (key, n_best, count_sum)."""
    out = pa.schema([("key", pa.binary()), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(texts: pa.Table, totals: pa.Table) -> pa.Table:
        keys = texts["key"].to_pylist()
        head = next((k for k, v in enumerate(keys) if v is None), None)
        if head is None or len(keys) == 1:
            return out.empty_table()
        codes = np.concatenate([unpack(b) for b in totals["codes"].to_pylist()] or [np.empty(0, np.int64)])
        count = np.concatenate([unpack(b) for b in totals["counts"].to_pylist()] or [np.empty(0, np.int64)])
        order = np.argsort(codes)
        codes, count = codes[order], count[order]
        top = count == best.value[codes // n_b]
        places = unpack(texts["places"][head].as_py())
        ends = np.cumsum(unpack(texts["sizes"][head].as_py()).astype(np.int64))
        zero = np.zeros(1, np.int64)
        unit_sums = []
        for x in (top.astype(np.int64), count):
            total = np.concatenate((zero, np.cumsum(x[places] if len(x) else places.astype(np.int64) * 0)))
            unit_sums.append(np.diff(total[ends], prepend=0))
        got = []
        for key, units in zip(keys, texts["units"].to_pylist()):
            if key is not None:
                u = unpack(units)
                got.append((key, int(unit_sums[0][u].sum()), int(unit_sums[1][u].sum())))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*got), out)], schema=out)
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          model: str | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:     # read on the driver, sent to the workers
        spec = spark.sparkContext.broadcast(f.read())
    with open(model or default_model(), "rb") as f:
        proto = spark.sparkContext.broadcast(f.read())
    own = tokenizers(spec.value, proto.value)
    n_a, n_b = own.n_a, own.n_b
    src = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    texts = src.filter("text is not null and text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("rows"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(spec.value, proto.value)
        chunk, serial = Chunk(t), TaskContext.get().partitionId() << 32

        def close() -> pa.RecordBatch:
            codes, rows, sizes, places, n = chunk.links()
            return _rows([(None,) * 6 + (serial, None, codes, rows, sizes, places, n)])

        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(0).to_pylist()
            got = chunk.add(texts, b.column(1).to_numpy())
            yield _rows([(hashlib.sha256(x.encode()).digest(), *g[:5], serial, g[5], *(None,) * 5) for x, g in zip(texts, got)])
            if chunk.full():
                yield close()
                chunk, serial = Chunk(t), serial + 1
        if chunk.listed:
            yield close()

    aligned = written(texts.mapInArrow(measure, _ALIGNED_SQL), "aligned")
    heads = aligned.filter("codes is not null")
    buckets = max(1, -(-int(heads.agg(F.sum("n_codes")).first()[0] or 0) // BUCKET))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, codes, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                codes, rows = unpack_sorted(codes), unpack(rows)
                bucket = (mix(codes.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                codes, rows, bucket = codes[order], rows[order], bucket[order]
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                parts = [(int(bucket[i]), chunk, pack(codes[i:j]), pack(rows[i:j])) for i, j in zip(at, [*at[1:], len(codes)])]
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                        zip(*parts), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "codes", "rows"])

    def total(t: pa.Table) -> pa.Table:
        codes = [unpack(b) for b in t["codes"].to_pylist()]
        rows = np.concatenate([unpack(b) for b in t["rows"].to_pylist()])
        every = np.concatenate(codes)
        order = np.argsort(every, kind="stable")
        held, sums = _summed(every[order], rows[order])
        a = held // n_b
        at = np.flatnonzero(np.diff(a, prepend=-1))
        most = np.maximum.reduceat(sums, at)
        return pa.table({
            "chunk": pa.array([*t["chunk"].to_pylist(), None], pa.int64()),
            "codes": pa.array([*map(pack, codes), pack(a[at])], pa.binary()),
            "counts": pa.array([*(pack(sums[np.searchsorted(held, c)]) for c in codes), pack(most)], pa.binary())})

    answers = written(heads.select("chunk", "codes", "rows").mapInArrow(deal, "bucket int, chunk long, codes binary, rows binary")
                      .groupBy("bucket").applyInArrow(total, "chunk long, codes binary, counts binary"), "totals")

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, most in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(unpack(a)), pa.array(unpack(most))], names=["a", "most"])

    best = np.zeros(n_a, np.int64)
    for r in (answers.filter("chunk is null").select("codes", "counts").mapInArrow(largest, "a long, most long")
              .groupBy("a").agg(F.max("most").alias("most")).collect()):       # at most one row for each id of A
        best[r.a] = r.most
    best = spark.sparkContext.broadcast(best)

    sums = (aligned.select("chunk", "key", "units", "sizes", "places").groupBy("chunk")
            .cogroup(apart(answers.filter("chunk is not null")).groupBy("chunk"))
            .applyInArrow(_answered(n_b, best), "key binary, n_best long, count_sum long"))
    counted = aligned.filter("key is not null").select("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    measures = counted.join(sums, "key")
    zero = {c: 0 for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}
    return (src.select("id", F.unhex(F.sha2("text", 256)).alias("key")).join(measures, "key", "left")
            .na.fill(zero).na.fill({"groups_sha256": ""})
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))


ORACLE_SQL = None
