"""Operators 11 to 13 against brute force: alignment of two tokenizers, nearest neighbours, divergence of sources."""

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from test_llm_ops import EDGES, SCHEMA, clashing, prepared

from tickforge.llm import alignment, bpe, cross_polytope, divergence

MARKED = [(20, "a▁b altered by a tokenizer", "en", "a", 26), (21, "  two  spaces \n\n and lines ", "en", "b", 27),
          (22, "don't  can't\x1c it's\x85 é à 日本", "de", "a", 20), (20, "x " * 400, None, None, 800)]


@pytest.fixture(scope="module")
def odd(spark):
    return prepared(spark).createDataFrame(EDGES + MARKED, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return prepared(spark).createDataFrame([], SCHEMA)


# --- 11 ---------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def plain_tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(bpe.default_vocabulary())
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    letters = bpe.byte_letters()
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    bytes_a = {i: bytes(letters[c] for c in s) for s, i in vocab.items() if s != "<|endoftext|>"}
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.default_model())

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    return a, bytes_a, b, piece


def _plain_alignment(text, tools):
    """(a ids, b ids, groups string, list of linked (a, b) occurrences) by the definition."""
    a, bytes_a, b, piece = tools
    if not text:
        return [], [], "", []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)
    whole = (" " + text).encode()
    ta, tb = [bytes_a[i] for i in ids_a], [piece(i) for i in ids_b]
    if b"".join(ta) != whole or b"".join(tb) != whole:
        return [], [], "", []
    ends_a, ends_b = (np.cumsum([len(x) for x in t]).tolist() for t in (ta, tb))
    links, groups, i, j = [], [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        ga, gb = [], []
        while i < len(ends_a) and ends_a[i] <= cut:
            ga.append(i)
            i += 1
        while j < len(ends_b) and ends_b[j] <= cut:
            gb.append(j)
            j += 1
        links += [(ids_a[x], ids_b[y]) for x in ga for y in gb
                  if ends_a[x] - len(ta[x]) < ends_b[y] and ends_b[y] - len(tb[y]) < ends_a[x]]
        groups.append(",".join(str(ids_a[x]) for x in ga) + "|" + ",".join(str(ids_b[y]) for y in gb))
    return ids_a, ids_b, ";".join(groups), links


def _alignment_of(rows, tools):
    got = [(i, *_plain_alignment(t, tools)) for i, t in rows]
    count = Counter(p for *_, links in got for p in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted((repr(i), len(a), len(b), g.count(";") + 1 if g else 0, len(links),
                   sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                   hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, g, links in got)


def _rows(df):
    return sorted((repr(r[0]), *r[1:]) for r in df.collect())


def test_alignment_of_odd_rows(odd, empty, plain_tokenizers):
    want = _alignment_of([r[:2] for r in EDGES + MARKED], plain_tokenizers)
    assert _rows(alignment.align(odd)) == want
    assert _rows(alignment.align(clashing(odd).withColumn("key", F.lit(1)).withColumn("chunk", F.lit(2)))) == want
    assert alignment.align(empty).count() == 0
    only_null = odd.filter("text is null or text = ''")
    assert {tuple(r[1:]) for r in alignment.align(only_null).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    altered = odd.filter("text like '%altered by%'")
    assert [tuple(r)[1:] for r in alignment.align(altered).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_alignment_of_a_table_in_small_chunks(spark, plain_tokenizers, monkeypatch):
    docs = prepared(spark).read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(250)
    rows = [tuple(r) for r in docs.collect()]
    monkeypatch.setattr(alignment, "UNITS", 300)
    monkeypatch.setattr(alignment, "BUCKET", 5_000)
    assert _rows(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"))) == _alignment_of(rows, plain_tokenizers)


def test_packing_keeps_arrays():
    for a in (np.arange(5), np.array([], np.uint32), np.array([7, 1 << 40, -3]), np.arange(300, dtype=np.uint32)):
        assert (alignment.unpack(alignment.pack(a)) == a).all() and alignment.unpack(alignment.pack(a)).dtype == a.dtype
    s = np.array([3, 9, 1 << 35])
    assert (alignment.unpack_sorted(alignment.pack_sorted(s)) == s).all()


# --- 12 ---------------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def _usable(v):
    return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def _plain_search(rows, every, k):
    use = [(i, np.asarray(v, np.float64)) for i, v in rows if i is not None and _usable(v)]
    d = max((len(v) for _, v in use), default=0)
    use = [(i, np.pad(v, (0, d - len(v)))) for i, v in use]
    out = []
    for p, (i, v) in enumerate(use):
        if i % every == 0:
            near = sorted((-float((v * w).sum()), j) for r, (j, w) in enumerate(use) if r != p)[:k]
            out += [(i, n + 1, j, round(-s, 9)) for n, (s, j) in enumerate(near)]
    return sorted(out)


def _searched(df, every=20, **more):
    got = cross_polytope.nearest(df, F.col("id") % every == 0, **more).collect()
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got)


def test_search_of_odd_rows_gives_every_candidate(spark):
    rng = np.random.default_rng(3)
    vec = lambda: [float(x) for x in rng.normal(size=6)]
    same = vec()
    rows = [(i, vec()) for i in range(30)] + [(100 + i, same) for i in range(30)]
    rows += [(200, None), (220, []), (240, [0.0] * 6), (260, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (280, [float("nan")] * 6),
             (300, [float("inf")] + [1.0] * 5), (None, vec()), (320, [1.0, 2.0]), (340, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0]),
             (341, [0.0, 1.0, -0.0, 0.0, 0.0, 0.0]), (20, [10 * x for x in same])]
    data = [(i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in rows]
    df = prepared(spark).createDataFrame(data, VECTORS)
    # scores of float components: the table keeps floats
    kept = [(r.vec_id, r.embedding) for r in df.collect()]
    want = _plain_search(kept, 20, 20)
    got = _searched(df)
    assert [r[:2] for r in got] == [r[:2] for r in want]                      # as many rows, gapless ranks
    near = lambda rs: Counter((q, v, s) for q, _, v, s in rs)
    assert (near(got) & near(want)).total() >= 0.9 * len(want)
    assert _searched(df, recall=1.0, k=5) == _plain_search(kept, 20, 5)
    clash = df.withColumns({c: F.lit(1) for c in ("id", "vec", "cid", "qid", "score", "rank", "t", "g", "bucket", "ids")})
    assert _searched(clash) == got
    assert _searched(df.filter("vec_id < 0")) == [] and _searched(df.filter("vec_id = 1")) == []
    assert _searched(df.filter("vec_id in (0, 1, 2)")) == _plain_search([r for r in kept if r[0] in (0, 1, 2)], 20, 20)


def test_search_recall_and_exact_scores(spark):
    df = prepared(spark).read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want, got = _plain_search(rows, 20, 20), _searched(df)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    near = lambda rs: {(q, v) for q, _, v, _ in rs}
    assert len(near(got) & near(want)) >= 0.9 * len(want)
    score = {(q, v): s for q, _, v, s in _plain_search(rows, 20, len(rows))}
    assert all(abs(score[q, v] - s) < 1e-8 for q, _, v, s in got)


def test_search_cuts_hot_groups_and_long_tables_lose_nothing(spark, monkeypatch):
    """Small blocks and two hashes a table give the same neighbours where every bucket is asked."""
    rng = np.random.default_rng(9)
    hot = rng.normal(size=8)
    data = [(i, [float(np.float32(x)) for x in (hot + rng.normal(size=8) * (0.05 if i % 3 else 1.0))], 0) for i in range(240)]
    df = prepared(spark).createDataFrame(data, VECTORS)
    monkeypatch.setattr(cross_polytope, "FILL", 4)
    monkeypatch.setattr(cross_polytope, "GROUP", 64)
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    want = _plain_search([r[:2] for r in data], 20, 20)
    got = _searched(df, recall=1.0, tables=3)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    near = lambda rs: {(q, v) for q, _, v, _ in rs}
    assert len(near(got) & near(want)) >= 0.9 * len(want)


def test_hadamard_is_a_rotation_and_ranks_count_better_buckets():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = cross_polytope.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(cross_polytope.hadamard(y), x)
    h = cross_polytope.Hashing(15, 1.0, 2, 2, "<f8")
    q, near = h.lifted(x[:1, :15], True), h.lifted(x[1:, :15] / 9, False)
    order = h.probes(q, 1, h.buckets)[0]
    loss = [p[0] for p in h.losses(q, 1)]
    total = [loss[0][c // (2 * h.width)] + loss[1][c % (2 * h.width)] for c in order]
    assert sorted(order) == list(range(h.buckets))
    ranks = h.rank(q[0], near, 1)
    for code, r in zip(h.bucket(near, 1), ranks):
        own = loss[0][code // (2 * h.width)] + loss[1][code % (2 * h.width)]
        assert r == sum(t < own - 1e-12 for t in total)
        assert code in h.probes(q, 1, int(r) + 1)[0]


# --- 13 ---------------------------------------------------------------------------------------------------------------

def _plain_divergence(rows, min_docs):
    rows = [(t or "", g or "", s or "") for _, t, g, s, *_ in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for t, g, s in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower))
        n[g, s].update(words)
        docs[g].update(set(words))
        groups.add((g, s))
    out = []
    for g in {g for g, _ in groups}:
        kept = [w for w, d in docs[g].items() if d >= min_docs]
        v = len(kept)
        count = {s: {w: n[g, s][w] for w in kept} for x, s in groups if x == g}
        every = {w: sum(c[w] for c in count.values()) for w in kept}
        p = lambda c: {w: 1 + 10 ** 9 * (c[w] + 5) // (sum(c.values()) + 5 * v) for w in kept}
        shares, q = {s: p(c) for s, c in count.items()}, p(every)
        for s in count:
            pair = sorted((-sum(abs(shares[s][w] - shares[o][w]) for w in kept), o.encode(), o) for o in count if o != s)
            term = sorted((q[w] - shares[s][w], w.encode(), w) for w in kept if count[s][w] and shares[s][w] > q[w])[:50]
            for part, items in (("pair", pair), ("term", term)):
                out += [(g, s, part, i, -x, k + 1) for k, (x, _, i) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize("min_docs", [1, 2, 99])
def test_divergence_of_odd_rows(odd, empty, min_docs):
    want = _plain_divergence(EDGES + MARKED, min_docs)
    assert sorted(map(tuple, divergence.divergence(odd, min_docs=min_docs).collect())) == want
    clash = clashing(odd).withColumns({c: F.lit(1) for c in ("term", "n", "docs", "block", "total", "place", "rank", "value")})
    assert sorted(map(tuple, divergence.divergence(clash, min_docs=min_docs).collect())) == want
    assert divergence.divergence(empty).count() == 0


def test_divergence_over_many_blocks_tiles_and_flushes(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é"[:rng.choice((3, 4))] for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))) + "!x-Y", rng.choice(("en", "de")), f"s{rng.randint(0, 8)}", 0)
            for i in range(300)]
    monkeypatch.setattr(divergence, "BLOCK", 40)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "ENTRIES", 500)
    monkeypatch.setattr(divergence, "PIECE", 64)
    df = prepared(spark).createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, divergence.divergence(df, min_docs=5).collect())) == _plain_divergence(rows, 5)


def test_galloping_finds_what_searching_finds():
    rng = np.random.default_rng(2)
    for size in (0, 1, 70, 5000):
        long = np.unique(rng.integers(0, 20000, 9000))
        short = np.unique(rng.integers(0, 21000, size))
        place = divergence.gallop(short, long)
        assert ((place >= 0) == np.isin(short, long)).all() and (long[place[place >= 0]] == short[place >= 0]).all()
    assert (divergence.gallop(np.arange(3), np.arange(0)) == -1).all()


def test_pieces_do_not_cut_terms():
    text = ("ab" * 5000 + " cd" * 3000 + " ").encode() * 3
    whole = text.translate(divergence._LETTERS).split()
    for size in (10, 999, 4096):
        old, divergence.PIECE = divergence.PIECE, size
        try:
            assert [w for p in divergence._pieces(text) for w in p] == whole
        finally:
            divergence.PIECE = old
