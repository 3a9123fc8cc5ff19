"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens; it accepts exactly the token sequences that the merge
list produces.  It starts as one state with an arc for each byte; each merge (x, y) in
turn adds a gadget: after x, the arc y goes away and the arc xy appears.  After all
merges there is one state for each token u ("the last token was u"), and the arc v
leaves it unless some gadget removed it.  The gadget of (x, y) removes it exactly if x
is the last segment of u and y the first segment of v at the time of that merge.
Those segments are the right spine of u and the left spine of v in the merge tree,
each alive from its own merge to the one that consumes it, so the result of all
gadgets on an arc is known from two short spines.  Arcs (tokens squared) are
therefore compiled when first used, and kept in a table.

Encoding: text is split into words (byte-level pattern).  The accepted sequence of a word is
unique.  A table-driven walk finds it: from a state it takes the longest token that the byte
trie of the vocabulary finds in what is left; if the arc is gone, it tries the next shorter one, and if none is left
it takes the last arc back and marks the place as dead, so no place is tried twice.
Words, and the units between single spaces (where a word always begins), are memoised in tables of at most twice ``CACHE``
entries per Python worker; when a newer table is full it takes the place of the older (the results do not change).
Decoding emits the labels (bytes) of the arcs.

Null text is the empty text: no tokens, empty decoded text.  Special tokens of the
vocabulary file that occur in a text are one token each.  Bytes that do not form
UTF-8 decode to U+FFFD.  Rows keep their other columns; repeated rows and empty
tables need nothing special.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import col, documents

#: Entries of a worker's newer tables; the older ones have as many, its arc table has four times as many.
CACHE = 150_000
#: Longest key that is memoised.
KEPT = 64
#: Fixed value: the pattern that splits text into words in byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 60
#: White space beside a space: the words around it do not simply begin at spaces.
_LOOSE = re.compile(r"\s | \s")
#: Letters below are letters in every edition of Unicode that a tokenizer may know.
_LATIN_END = "\u0250"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the vocabulary file: printable
    Latin-1 bytes for themselves, the others for 256, 257 and so on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Memo(dict):
    """Values of a function, the last ``CACHE`` to twice as many of them kept."""

    def __init__(self, compute: Callable):
        self.compute, self.older = compute, {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.compute(key)
        if len(key) <= KEPT:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got

    def forget(self) -> None:
        self.clear()
        self.older = {}


class Automaton:
    """States are tokens; ``arc(u, v)`` tells whether v may follow u."""

    def __init__(self, spec: str):
        import regex
        j = json.loads(spec)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab, merges = j["model"]["vocab"], j["model"]["merges"]
        special = {a["content"]: a["id"] for a in j.get("added_tokens", []) if a.get("special")}
        self.labels = {i: as_bytes(s) for s, i in vocab.items() if s not in special}
        self.labels |= {i: s.encode() for s, i in special.items()}
        self.special = special
        self.at_special = (regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
                           if special else None)
        self.words = regex.compile(SPLIT)
        # gadgets: rank of each merge, and the spines it prolongs
        self.rank, born, halves = {}, {}, {}
        for r, m in enumerate(merges):
            x, y = m if isinstance(m, list) else m.split(" ")
            u, v, z = vocab[x], vocab[y], vocab[x + y]
            self.rank[u, v] = r
            if z not in born:
                born[z], halves[z] = r, (u, v)
        self.born, self.halves = born, halves
        self.left, self.right = {}, {}
        # byte trie of the vocabulary, byte -> (token that ends there or -1, next bytes), and each token's
        # longest proper prefix that is a token
        self.root: dict = {}
        plain = {i: label for i, label in self.labels.items() if label.decode("utf-8", "replace") not in special}
        for i, label in plain.items():
            node = self.root
            for b in label[:-1]:
                node = node.setdefault(b, [-1, {}])[1]
            node.setdefault(label[-1], [-1, {}])[0] = i
        self.shorter, self.size = {}, {i: len(label) for i, label in plain.items()}
        for i, label in plain.items():
            node, last = self.root, -1
            for b in label[:-1]:
                t, node = node[b]
                last = t if t >= 0 else last
            self.shorter[i] = last
        self.arcs = {}
        self.of_word = _Memo(self._word)
        self.of_unit = _Memo(self._unit)

    def _spine(self, t: int, side: int) -> list[tuple[int, int, int]]:
        """(segment, born, consumed) along the left (0) or right (1) edge of a token."""
        memo = self.right if side else self.left
        if t not in memo:
            out, until = [], NEVER
            while True:
                since = self.born.get(t, -1)
                out.append((t, since, until))
                if since < 0:
                    break
                t, until = self.halves[t][side], since
            memo[out[0][0]] = out
            return out
        return memo[t]

    def arc(self, u: int, v: int) -> bool:
        """Whether no gadget removed the arc v from state u."""
        key = u << 20 | v
        ok = self.arcs.get(key)
        if ok is None:
            ok, rank = True, self.rank
            for x, x0, x1 in self._spine(u, 1):
                for y, y0, y1 in self._spine(v, 0):
                    r = rank.get((x, y))
                    # in a run of one segment the left pair merges first: hence <= on the right side only
                    if r is not None and x0 < r and y0 < r and r < x1 and r <= y1:
                        ok = False
                        break
                if not ok:
                    break
            if len(self.arcs) >= 4 * CACHE:
                self.arcs.clear()
            self.arcs[key] = ok
        return ok

    def encode_word(self, word: bytes) -> list[int]:
        n, root, arc, shorter, size = len(word), self.root, self.arcs.get, self.shorter, self.size
        out, i, dead, t = [], 0, set(), -2
        while i < n:
            if t == -2:                                        # a new place: the longest token there
                node, t = root, -1
                for b in word[i:]:
                    found = node.get(b)
                    if found is None:
                        break
                    here, node = found
                    if here >= 0:
                        t = here
            while t >= 0:
                if i + size[t] not in dead:
                    if not out:
                        break
                    ok = arc(out[-1] << 20 | t)
                    if ok is None:
                        ok = self.arc(out[-1], t)
                    if ok:
                        break
                t = shorter[t]
            if t >= 0:
                out.append(t)
                i += size[t]
                t = -2
            elif out:                                          # no way on from here
                dead.add(i)
                t = out.pop()
                i -= size[t]
                t = shorter[t]
            else:
                raise ValueError("the vocabulary has no token for a byte")
        return out

    def _word(self, word: str) -> bytes:
        got = self.encode_word(word.encode())
        return struct.pack(f"<{len(got)}I", *got)

    def _unit(self, unit: str) -> bytes:
        if unit.isalpha() and max(unit) < _LATIN_END:           # a space and letters are one word
            return self._word(" " + unit)
        return b"".join(map(self.of_word.__getitem__, self.words.findall(" " + unit)))

    def _plain(self, part: str) -> list[bytes]:
        if not part:
            return []
        if _LOOSE.search(part) or part[0].isspace() or part[-1].isspace():
            return list(map(self.of_word.__getitem__, self.words.findall(part)))
        head, *units = part.split(" ")                         # every space is between two words
        return [*map(self.of_word.__getitem__, self.words.findall(head)), *map(self.of_unit.__getitem__, units)]

    def parts(self, text: str) -> list[bytes]:
        """Token ids of consecutive parts of a text, as little-endian unsigned 32-bit integers."""
        if self.at_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for p in self.at_special.split(text):
            out += [struct.pack("<I", self.special[p])] if p in self.special else self._plain(p)
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(self.parts(text))

    def forget(self) -> None:
        """Empty the tables (a worker that waits for other work should hold little)."""
        for memo in (self.of_word, self.of_unit):
            memo.forget()

    def decode(self, ids: bytes) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_COMPILED: dict[str, Automaton] = {}


def automaton(spec: str) -> Automaton:
    """The automaton of a vocabulary file's content, compiled once per worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Automaton(spec)
    return _COMPILED[key]


def _vocabulary(spark: SparkSession, path: str | None):
    with open(path or default_vocabulary(), encoding="utf-8") as f:     # read on the driver, sent to the workers
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col`` array<int>.  A column of that name gives way."""
    spec = _vocabulary(docs.sparkSession, vocabulary)

    @F.pandas_udf("array<int>")
    def ids(s):
        import numpy as np
        import pandas as pd
        a = automaton(spec.value)
        return pd.Series([np.frombuffer(a.encode(t or ""), "<u4").astype("int32") for t in s], dtype=object)

    keep = [c for c in docs.columns if c.lower() != ids_col.lower() or c == text_col]
    return docs.select(*[col(c) for c in keep], ids(col(text_col)).alias(ids_col))


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """``df`` with ``text_col``: the text of the ids (null ids: empty)."""
    spec = _vocabulary(df.sparkSession, vocabulary)

    @F.pandas_udf("string")
    def text(s):
        import numpy as np
        import pandas as pd
        a = automaton(spec.value)
        return pd.Series([a.decode(np.asarray([] if x is None else x, "<u4").tobytes()) for x in s], dtype=object)

    keep = [c for c in df.columns if c.lower() != text_col.lower() or c == ids_col]
    return df.select(*[col(c) for c in keep], text(col(ids_col)).alias(text_col))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded in one pass."""
    spec = _vocabulary(docs.sparkSession, vocabulary)
    src = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(spec.value)
        for b in batches:
            n, enc, dec = [], [], []
            for t in b.column(1):
                ids = a.encode(t.as_py() or "")
                n.append(len(ids) // 4)
                enc.append(hashlib.sha256(ids).hexdigest())
                dec.append(hashlib.sha256(a.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        a.forget()

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


ORACLE_SQL = None
