"""The operators against brute force on the small tables and on hand-made edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001

from tickforge.llm import (bpe, catalog, context_tree, exact_dedup, ftrl, jaccard_join, lang_id, mixing, quality,
                           sharding, syncmers, unit_dedup)
from tickforge.llm.components import components
from tickforge.llm.words import word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in every column, empty and white texts, ties, repeated rows, a long text.
LONG = " ".join(f"word{i % 997} and" for i in range(60_000))
EDGES = [
    (1, "The cat sat on the mat. The dog ran far away today.", "en", "a", 51),
    (2, "The cat sat on the mat. The dog ran far away today.", "en", "a", 51),
    (3, " The cat\tsat on the mat. The dog ran far away today. ", "en", None, 54),
    (4, None, "en", "b", None), (5, "", None, None, 0), (6, " \n\t ", "de", "b", 4), (7, "123 456 !!", "en", "b", 10),
    (8, "x", None, "c", 1), (9, "Der Hund und die Katze sind im Haus und im Garten.", "de", "c", 50),
    (9, "Der Hund und die Katze sind im Haus und im Garten.", "de", "c", 50),
    (None, "no id here at all, but some words to read", "en", "a", None), (12, LONG, "en", "a", len(LONG)),
    (13, "<|endoftext|> tail", "en", "é", 18), (14, "日本語のテキスト。はい。", "ja", "c", 12),
]


def prepared(spark):
    catalog.prepare(spark)
    return spark


@pytest.fixture(scope="module")
def edges(spark):
    return prepared(spark).createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return prepared(spark).createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return prepared(spark).read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF001}/documents.parquet' ORDER BY doc_id").fetchall()


def clashing(df):
    """Extra columns with names the operators use inside or return."""
    return df.withColumns({c: F.lit(1) for c in ("id", "digest", "rid", "size", "score", "shard", "kept", "h", "keep_id",
                                                 "component_id", "target", "_rn", "ids", "lang_pred", "range", "key")})


OPERATORS = {
    "op1": lambda d: quality.classify(d, d.sparkSession.createDataFrame(
        [(1, 1, 0), (9, 0, 1), (8, None, 0)], "doc_id long, quality int, toxic int")),
    "op2": lang_id.identify, "op3": jaccard_join.near_components, "op4": context_tree.score,
    "op5": unit_dedup.repeated_units, "op6": syncmers.edited_likeness, "op7": mixing.mix,
    "op8": exact_dedup.exact_dedup, "op9": bpe.round_trip, "op10": sharding.shard,
}


@pytest.mark.parametrize("op", OPERATORS)
def test_edge_rows_empty_tables_and_clashing_names(op, edges, nothing):
    f = OPERATORS[op]
    assert f(nothing).count() == 0
    got = sorted(map(repr, f(edges).drop("rid", "row_key").collect()))
    assert got == sorted(map(repr, f(clashing(edges)).drop("rid", "row_key").collect()))
    if op != "op5":
        assert len(got) == len(EDGES)


def _sets(rows, k):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def _components(sets, num, den):
    parent, where = {i: i for i in sets}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, s in sets.items():
        common = Counter(j for x in s for j in where[x])
        for x in s:
            where[x].append(i)
        for j, n in common.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_components(docs, rows, k, num, den):
    sets = _sets([r[:2] for r in rows], k)
    want = _components(sets, num, den)
    got = jaccard_join.near_components(docs, k=k, num=num, den=den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}


def test_jaccard_chain_across_components(spark):
    """Texts that differ by one more word each: neighbours link, and the star around a key's first class is not
    enough; a group of near copies whose members do not all link."""
    base = [f"w{i}" for i in range(120)]
    texts, rng = [], np.random.default_rng(5)
    cur = list(base)
    for step in range(40):
        cur[(step * 31) % 120] = f"x{step}"
        texts.append(" ".join(cur))
    for m in range(60):
        w = list(base)
        for at in rng.choice(120, 3, replace=False):
            w[at] = f"y{m}_{at}"
        texts.append(" ".join(w))
    data = list(enumerate(texts))
    df = prepared(spark).createDataFrame(data, "doc_id long, text string")
    want = _components(_sets(data, 3), 90, 100)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_components(df).collect()}
    assert got == want
    want = _components(_sets(data, 3), 80, 100)
    assert {r.doc_id: r.component_id for r in jaccard_join.near_components(df, num=80).collect()} == want


def test_parity_sketch_bounds_the_difference():
    b = jaccard_join.Bounds(90, 100)
    for n in range(1, 3000):
        k = b.band(n)
        assert b.edges[k] <= n < b.edges[k + 1]
        assert b.band(n * 100 // 90) <= k + 1          # the largest size it can link with
        cuts, equal = b.ranges(k)
        assert len(cuts) - equal >= b.most(n, n) and equal >= 1


def test_components_contract(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1200)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(prepared(spark).createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent) if find(x) != x}


def test_exact_dedup_edges(edges):
    got = {}
    for r in exact_dedup.exact_dedup(edges).collect():
        got.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert got[1] == [(3, 3, False)] and got[2] == [(3, 3, False)] and got[3] == [(3, 3, True)]
    assert sorted(got[9]) == [(9, 2, False), (9, 2, True)]
    assert got[6] == [(6, 3, True)] and got[4] == [(6, 3, False)]
    left = exact_dedup.drop_copies(edges)
    assert left.columns == edges.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(
        ["3", "6", "7", "8", "9", "None", "12", "13", "14"])


def test_exact_dedup_heavy_and_light_agree(spark):
    data = [(i, f"t{i % 7}") for i in range(500)] + [(1000 + i, f"u{i}") for i in range(300)]
    df = prepared(spark).createDataFrame(data, "doc_id long, text string")
    a = sorted(map(tuple, exact_dedup.exact_dedup(df).collect()))
    b = sorted(map(tuple, exact_dedup.exact_dedup(df, heavy=1, counters=32).collect()))
    assert a == b and sum(r[3] for r in a) == 307


def test_language_held_out_accuracy(docs, rows):
    got = {r.doc_id: r for r in lang_id.identify(docs).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    lang = {r[0]: r[2] for r in rows}
    assert np.mean([got[i].lang_pred == lang[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edges(edges):
    got = defaultdict(list)
    for r in lang_id.identify(edges).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    for i in (4, 5, 6, 7):
        assert got[i] == [("und", 0.0)]
    assert got[9][0] == got[9][1] and got[9][0][0] != "und"
    assert {r.doc_id for r in lang_id.known_language(edges).collect()} == {1, 2, 3, 8, 9, None, 12, 13, 14}


def test_ftrl_separates_and_calibrates():
    rng = np.random.default_rng(0)
    x = [(np.array([y, 3]), np.array([1.0, 1.0]), y) for y in rng.integers(0, 3, 300).tolist()]
    w = ftrl.fit(x, 5, 3)
    assert all(int((v @ w[i]).argmax()) == y for i, v, y in x) and not w[4].any()
    z = rng.normal(size=(4000, 3))
    p = ftrl.softmax(z / 2.0)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert abs(ftrl.temperature(z, y) - 2.0) < 0.25


def test_context_tree_against_plain_definition(spark):
    """Scores from per-node counts of the definition, computed text by text."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF0001}/documents.parquet' ORDER BY length(text) LIMIT 60").fetchall()
    rows += [(10_000, None), (10_001, "Zz éé 0"), (10_002, "a b  a b\na")]
    depth, count, kids, words, ends = context_tree.DEPTH, defaultdict(lambda: [0, 0]), defaultdict(set), Counter(), 0

    def contexts(s, k):
        past = (b"\n" + s[:k])[::-1][:depth]
        return [past[:d] for d in range(len(past) + 1)]
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            ends += 1
            words.update((t or "").encode().lower().split())
            s = context_tree.stream(t)
            for k, c in enumerate(s):
                node = 1
                for j in range(8):
                    b = c >> 7 - j & 1
                    xs = contexts(s, k)
                    for x in xs:
                        count[x, node][b] += 1
                    for x, y in zip(xs, xs[1:]):
                        kids[x, node].add(y)
                    node = 2 * node + b
    memo = {}

    def weighted(x, node):
        if (x, node) not in memo:
            a, b = count[x, node]
            e = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
            below = kids.get((x, node))
            if below:
                c = sum(weighted(y, node)[0] for y in below)
                w = float(np.logaddexp(e, c)) - math.log(2)
                memo[x, node] = w, math.exp(e - math.log(2) - w)
            else:
                memo[x, node] = e, 1.0
        return memo[x, node]
    n, v = sum(words.values()) + ends, len(words) + 1
    got = {r.doc_id: r for r in context_tree.score(prepared(spark).createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        s, total = context_tree.stream(t), 0.0
        for k, c in enumerate(s):
            node = 1
            for j in range(8):
                b, p, rest, last = c >> 7 - j & 1, 0.0, 1.0, 0.5
                for x in contexts(s, k):
                    if (x, node) not in count:
                        break
                    m, stop = count[x, node], weighted(x, node)[1]
                    last = (m[b] + .5) / (sum(m) + 1)
                    p += rest * stop * last
                    rest *= 1 - stop
                total += math.log10(p + rest * last)
                node = 2 * node + b
        w = (t or "").encode().lower().split()
        plain = sum(math.log10((words[x] + .1) / (n + .1 * (v + 1))) for x in w) + math.log10((ends + .1) / (n + .1 * (v + 1)))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.n_bytes) == (len(w) + 1, sum(words[x] > 0 for x in w) + 1, n, len(s))
        assert r.score == pytest.approx(total, rel=1e-6) and r.base_score == pytest.approx(plain, rel=1e-9)


def test_context_tree_bits_sum_to_one():
    keys, _ = np.unique(np.concatenate([k for k, _, _ in context_tree.pieces(["a b a", "b a"])]), return_counts=True)
    every = (keys[:1] & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
    rows = [{"node": (97 << 8) | 1, "a": 3.0, "b": 1.0, "w": -2.0}]
    p = context_tree.Top(rows).log10(every, np.full((256, 8), np.nan))
    assert np.sum(10.0 ** p) == pytest.approx(1.0)


def test_context_tree_long_text_in_pieces(monkeypatch):
    text = "ab cd " * 500
    whole = [k for k, _, _ in context_tree.pieces([text])][0]
    monkeypatch.setattr(context_tree, "PIECE", 64)
    assert (np.concatenate([k for k, _, _ in context_tree.pieces([text])]) == whole).all()


def test_unit_dedup_keeps_the_first(docs, rows):
    first, want = {}, set()
    for i, t, *_ in rows:
        for s, e, _, _, d in unit_dedup.units(t or "", "sentence", unit_dedup.MIN_WORDS):
            if d in first:
                want.add((i, s, e, *first[d]))
            else:
                first[d] = (i, s)
    got = {(r.doc_id, r.start, r.end, r.keep_id, r.keep_start)
           for r in unit_dedup.repeated_units(docs, min_run=0).collect()}
    assert got == want
    assert {tuple(r)[:3] for r in unit_dedup.repeated_units(docs).select("doc_id", "start", "end").collect()} < {x[:3] for x in want}


def test_unit_dedup_cuts_by_original_offsets(spark):
    shared = "A shared passage stands here with quite a few words in it. And so it goes on for a while longer than most."
    data = [(1, f"First text opens. {shared} It ends."), (2, f"Another é start!\n\n {shared.upper()}\tTail stays."), (3, None)]
    got = {r.doc_id: r.text for r in unit_dedup.remove_repeats(
        prepared(spark).createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: data[0][1], 2: "Another é start!\n\n  \tTail stays.", 3: None}


def _covered(rows, n, least):
    """Plain Python: places (row, character) of words in later occurrences of n words in a row, and of whole lines."""
    words = [[(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"\S+", t or "")] for _, t in rows]
    seen, out = set(), set()
    for k, w in enumerate(words):
        lines = re.finditer(r"[^\n]+", rows[k][1] or "")
        for key, s, e in [(tuple(x[0] for x in w[i:i + n]), w[i][1], w[i + n - 1][2]) for i in range(len(w) - n + 1)] + [
                (("line", *m.group().lower().split()), m.start(), m.end()) for m in lines if len(m.group().split()) >= least]:
            if key in seen:
                out |= {(k, c) for c in range(s, e) if not rows[k][1][c].isspace()}
            seen.add(key)
    return out


def test_passages_do_not_need_sentence_ends(spark):
    rnd = random.Random(5)
    prose = lambda n: " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(n))
    mid, shout, line, para = prose(60), "WORD!! " * 3 + "STOP. " + prose(20) + " no. yes. no.", "one short line of six words", "a b\nc d e f"
    data = [(1, f"{prose(9)} {mid} {prose(9)}\n{line}"), (2, f"{prose(30)}, {mid.upper()}\n {prose(30)}"), (3, f"{prose(7)}\n{line}\n{prose(8)}"),
            (4, f"{prose(5)} {shout} {prose(5)}"), (5, f"{prose(11)} {shout} {prose(3)}"), (6, f"{prose(7)}\n\n{para}"),
            (7, f"{para}\n\n{prose(6)}"), (8, "x y z " * 40), (9, f"{prose(5)} x y z x y z x y z x y z x y z {prose(5)}"), (10, None),
            (11, f"\u0130stanbul {prose(4)} {' '.join(mid.split()[5:25])} \U0001f600 {prose(4)}")]
    df = prepared(spark).createDataFrame(data, "doc_id long, text string")
    got = unit_dedup.repeated_passages(df).collect()
    text = dict(data)
    spans = sorted((r.doc_id, r.start, r.end) for r in got)
    assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))           # none overlap
    for r in got:
        cut = text[r.doc_id][r.start:r.end].lower().split()
        assert len(cut) == r.n_words and text[r.keep_id][r.keep_start:].lower().split()[:len(cut)] == cut
    places = {(r.doc_id - 1, c) for r in got for c in range(r.start, r.end) if not text[r.doc_id][c].isspace()}
    want = _covered(data, 15, 5) | {(6, c) for c in range(len(para)) if not para[c].isspace()}
    assert places == want
    assert mid.upper() in [text[2][r.start:r.end] for r in got if r.doc_id == 2]
    left = {r.doc_id: r.text for r in unit_dedup.remove_repeats(df.unionByName(df), unit="passage").collect() if r.text and r.text.strip()}
    assert left[1] == text[1] and mid.upper() not in left[2] and line not in left[3]


def test_passages_cover_every_repeated_run(docs, rows):
    want = _covered([r[:2] for r in rows], unit_dedup.MIN_RUN, unit_dedup.MIN_WORDS)
    at = {r[0]: k for k, r in enumerate(rows)}
    got = {(at[r.doc_id], c) for r in unit_dedup.repeated_passages(docs).collect() for c in range(r.start, r.end)}
    assert want and want <= got


def test_units_of_all_kinds():
    t = "one two. three four\n\nfive six\nseven"
    cut = lambda u: [t[s:e] for s, e, *_ in unit_dedup.units(t, u, 1)]
    assert cut("sentence") == ["one two.", "three four", "five six", "seven"]
    assert cut("line") == ["one two. three four", "five six", "seven"]
    assert cut("paragraph") == ["one two. three four", "five six\nseven"]


def test_syncmers_edited_texts(docs, rows):
    order = [r[:2] for r in rows][::-1]
    got = {r.doc_id: r for r in syncmers.edited_likeness(docs).collect()}
    by_text = defaultdict(set)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        by_text[t].add(got[i].fingerprint)
        by_text[e].add(got[i].edited_fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.95


def test_syncmers_blocks_do_not_matter(docs, monkeypatch):
    a = sorted(map(tuple, syncmers.edited_likeness(docs).collect()))
    monkeypatch.setattr(syncmers, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(syncmers.with_successor, "__defaults__", (20_000,))
    assert a == sorted(map(tuple, syncmers.edited_likeness(docs).collect()))


def test_syncmers_are_context_free(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    df = prepared(spark).createDataFrame([(1, f"a b c {passage} d e f"), (2, f"{passage} x y z")], "doc_id long, text string")
    at = defaultdict(dict)
    for r in syncmers.anchors(df).collect():
        at[r.doc_id][r.anchor] = r.position
    common = set(at[1]) & set(at[2])
    assert len(common) > 5 and {at[1][x] - at[2][x] for x in common} == {3}


def test_mixing_targets_and_sample(docs, rows):
    size, kind = Counter(), {}
    for i, t, _, s in rows:
        size[s] += len((t or "").encode().split())
        kind[i] = s
    got = mixing.mix(docs).collect()
    names = sorted(size, key=lambda s: s.encode())
    want = mixing.targets(dict(size), {s: k % 3 + 1 for k, s in enumerate(names)})
    taken = Counter()
    for r in got:
        assert r.source_size == size[kind[r.doc_id]] and r.target == pytest.approx(want[kind[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[kind[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] for s in size)
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    mixed = mixing.repeat_rows(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == Counter(
        {r.doc_id: r.copies for r in got if r.copies})


def test_mixing_repeats_rows_with_clashing_names(docs):
    names = ["c", "_mix_text", "_mix_source", "_mix_rn", "_mix_of", "_mix_copy", "_copies"]
    few = docs.limit(60).withColumns({x: F.lit(f"own {x}") for x in names})
    got = mixing.repeat_rows(few)
    assert got.columns == few.columns
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in mixing.repeat_rows(docs.limit(60)).collect())
    assert rows and all(r[x] == f"own {x}" for r in rows for x in names)


def test_mixing_target_cap():
    t = mixing.targets({"a": 10, "b": 100, None: 1000, "d": 0}, {"a": 3, "b": 2, None: 1, "d": 2})
    assert t["a"] == 30 and t["b"] == 300 and t[None] == pytest.approx(780) and t["d"] == 0


def test_bpe_equals_the_library(docs, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    got = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    for i, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_random_texts_and_round_trip(edges):
    import random
    from tokenizers import Tokenizer
    tok, a = Tokenizer.from_file(bpe.default_vocabulary()), bpe.Automaton(open(bpe.default_vocabulary()).read())
    random.seed(1)
    parts = ["a" * k for k in (1, 2, 3, 5, 8)] + list("-=_ \n\t!?.*0é") + ["  ", "日本", "\U0001f600", "<|endoftext|>", "'s",
                                                                          "123", "th", "ing", " the", " ", "​"]
    for _ in range(4000):
        s = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        ids = a.encode(s)
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(s, add_special_tokens=False).ids, s
        assert a.decode(ids) == s
    back = bpe.decode(bpe.encode(edges)).collect()
    assert all(r.decoded == (r.text or "") for r in back)


def test_sharding_law(docs, rows):
    got = sharding.shard(docs).collect()
    size = {i: len((t or "").encode()) + 16 for i, t, *_ in rows}
    slots, load, where = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        assert (r.size, r.law, r.grown_shard) == (size[r.doc_id], "bytes", None)
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        where[r.text_crc32].add(r.shard)
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(size.values()) / 40
    assert all(abs(n - share) <= max(size.values()) for n in load.values())
    assert sum(len(s) - 1 for s in where.values()) < 40         # groups are cut only at shard edges


def test_sharding_subdivides_a_hot_group(spark):
    data = [(i, "same text") for i in range(6000)] + [(10_000 + i, f"text {i} " * 3) for i in range(2000)]
    df = prepared(spark).createDataFrame(data, "doc_id long, text string")
    load = Counter()
    for r in sharding.shard(df).collect():
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= 2 * 60


def test_quality_learns_and_shrinks(spark):
    catalog.prepare(spark)
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    lab = spark.read.parquet(f"{SF001}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(d, lab).collect()}
    known = lab.collect()
    good = [got[r.doc_id].keep for r in known if r.quality == 1 and r.toxic == 0]
    bad = [got[r.doc_id].keep for r in known if r.quality == 0 or r.toxic == 1]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.35


def test_quality_reads_whole_texts():
    """The class of capitals has one formula at every length, and sees every character."""
    capitals = lambda t: quality._stats(t)[0]
    prose = "Abc def ghi " * 500                       # 1 capital of 9 letters, in 12 characters
    assert {capitals(prose[:n]) for n in (1500, 3990, 3999, 4000, 4005, 6000)} == {quality.DIMS + 3}
    between = "".join("a" if i % 4 == 0 else "B" for i in range(8000))         # stands between the points of a stride of 4
    assert capitals(between) == capitals(between[:3000]) == quality.DIMS + 5


def test_quality_site_prior_moves_uncertain_documents(spark):
    """A document without evidence follows its site; a sparse site follows the world."""
    words = {0: "spam junk offer", 1: "fine prose here"}
    data, lab = [], []
    for i in range(600):
        good = i % 3 != 0
        data.append((i, words[good] + f" n{i}", "bad" if not good else "fine", "p"))
        lab.append((i, int(good), 0))
    data += [(9000, "neutral", "bad", "p"), (9001, "neutral", "fine", "p"), (9002, "neutral", "new", "p")]
    df = prepared(spark).createDataFrame(data, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in quality.classify(df, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")).collect()}
    assert got[9000].quality < got[9002].quality < got[9001].quality
    assert got[9000].site_quality < 0.3 and got[9001].site_quality > 0.9


def test_word_hashes_are_words():
    texts = ["A b\tC", None, "", "x" * 1_200_000 + " y", " a B c "]
    h = list(word_hashes(texts))
    assert [len(x) for x in h] == [3, 0, 0, 2, 3] and (h[0] == h[4]).all() and len(set(h[0].tolist())) == 3


def test_native_operators_run_no_python(docs):
    for df in (exact_dedup.exact_dedup(docs), syncmers.edited_likeness(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_language_sample_is_not_cut():
    assert lang_id.SAMPLE == 2000
