"""The pipeline, stage by stage, against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

from conftest import SF0001

import corpus_pipeline as P
from tickforge.llm import bpe, catalog, common, jaccard_join, mixing
from tickforge.llm.common import documents, written


def _near(rows):
    sets, where, parent = {}, defaultdict(list), {}
    for r in rows:
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        parent[r.doc_id] = r.doc_id

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in sets.items():
        common = Counter(j for x in s for j in where[x])
        for x in s:
            where[x].append(i)
        for j, n in common.items():
            if 10 * n >= 8 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i for i in sets if find(i) == i}


def test_stages_against_plain_python(spark):
    from tokenizers import Tokenizer
    catalog.prepare(spark)
    stages = dict(P.STAGES)
    assert list(stages) == ["language", "exact_copies", "near_copies", "mixture", "tokens"]
    base = documents(spark, SF0001)
    extra = spark.createDataFrame([(90_001, None, "en", "src0", None), (90_002, " 12 ?", "en", None, 5),
                                   (90_003, "Ünïque wörds hêre", None, None, 17)], base.schema)
    docs = written(base.unionByName(extra))
    before = {r.doc_id: r for r in docs.collect()}

    kept = written(stages["language"](spark, docs, SF0001))
    assert kept.columns == base.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in before.items() if r.text and re.search(r"[^\W\d_]", r.text)}

    once = written(stages["exact_copies"](spark, kept, SF0001))
    best = {}
    for r in kept.collect():
        k = re.sub(r"[ \t\n\x0b\f\r]", "", r.text)
        best[k] = min(best.get(k, (0, None)), (-len(r.text), r.doc_id), key=lambda x: (x[0], x[1] if x[1] is not None else 1 << 60))
    assert once.columns == base.columns and {r.doc_id for r in once.collect()} == {i for _, i in best.values()}

    near = written(stages["near_copies"](spark, once, SF0001))
    assert near.columns == base.columns and {r.doc_id for r in near.collect()} == _near(once.collect())

    mixed = written(stages["mixture"](spark, near, SF0001))
    want = {r.doc_id: r.copies for r in mixing.mix(near).collect() if r.copies}
    assert mixed.columns == base.columns and Counter(r.doc_id for r in mixed.collect()) == Counter(want)

    tok = Tokenizer.from_file(bpe.default_vocabulary())
    for r in stages["tokens"](spark, mixed, SF0001).collect():
        t = before[r.doc_id].text
        ids = tok.encode(t, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_keys_leave_a_worker_in_small_batches(monkeypatch):
    """Also those of one long text; none is lost."""
    monkeypatch.setattr(jaccard_join, "KEYS", 100)
    sets = [(np.arange(n, dtype=np.uint64) + np.uint64((1 << 63) + 1000 * c), c) for c, n in enumerate([3, 0, 99, 250, 100, 1, 7])]
    taken = []

    def found():
        for x in sets:
            taken.append(x)
            yield x
    batches = jaccard_join._few(found())
    first = next(batches)
    assert len(taken) < len(sets)          # a batch leaves before all are made
    batches = [first, *batches]
    assert all(0 < b.num_rows <= 100 for b in batches)
    got = [(k, c) for b in batches for k, c in zip(b.column("key").to_pylist(), b.column("c").to_pylist())]
    assert got == [(k, c) for keys, c in sets for k in keys.view(np.int64).tolist()]
    assert list(jaccard_join._few([])) == []


def test_stages_take_small_batches(spark):
    catalog.prepare(spark)
    before = int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
    for _, stage in P.STAGES:
        catalog.prepare(spark)
        stage(spark, documents(spark, SF0001).limit(0), SF0001)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == P.BATCH_BYTES < before
    catalog.prepare(spark)


def test_run_and_empty_input(spark):
    catalog.prepare(spark)
    out = P.run(spark, SF0001)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
    docs = documents(spark, SF0001).limit(0)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF0001))
        assert docs.count() == 0


def test_repeated_rows_go_through(spark):
    catalog.prepare(spark)
    docs = documents(spark, SF0001)
    twice = written(docs.unionByName(docs))
    stages = dict(P.STAGES)
    a = {r.doc_id for r in stages["exact_copies"](spark, docs, SF0001).collect()}
    b = [r.doc_id for r in stages["exact_copies"](spark, twice, SF0001).collect()]
    assert len(b) == len(set(b)) and set(b) == a


def test_near_copies_with_null_and_repeated_ids(spark):
    """Rows are not merged by their id: only by their words."""
    rnd = np.random.default_rng(9)
    prose = lambda n: " ".join(f"w{x}" for x in rnd.integers(0, 10 ** 6, n))
    a, b, c, d, e = (prose(60) for _ in range(5))
    data = [(None, a), (None, b), (None, a + " more"), (5, c), (5, d), (4, c + " more"), (6, e), (6, e), (None, " \n"), (None, None),
            (7, ""), (7, "")]
    schema = documents(spark, SF0001).schema
    docs = spark.createDataFrame([(i, t, "en", "src0", None) for i, t in data], schema)
    catalog.prepare(spark)
    stages = dict(P.STAGES)
    got = Counter((r.doc_id, r.text) for r in stages["near_copies"](spark, docs, SF0001).collect())
    of_a = [k for k in got if k[1] in (a, a + " more")]
    assert len(of_a) == 1 and of_a[0][0] is None
    assert got == Counter([of_a[0], (None, b), (4, c + " more"), (5, d), (6, e), (None, " \n"), (None, None), (7, ""), (7, "")])
    through = docs
    for name in ("language", "exact_copies", "near_copies"):
        through = written(stages[name](spark, through, SF0001), name)
    assert Counter((r.doc_id, r.text) for r in through.collect())[(5, d)] == 1
    assert {r.text for r in through.collect()} >= {b, d, e}


def test_the_driver_collects_its_garbage_between_written_tables(spark, monkeypatch):
    """What ended steps hold in the driver goes every ``TIDY`` tables, not when its heap is full."""
    jvm, calls, tidy = spark.sparkContext._jvm, [], common.tidy
    held = jvm.java.lang.ref.WeakReference(jvm.java.util.ArrayList())
    monkeypatch.setattr(common, "tidy", lambda s: (calls.append(s), tidy(s)))
    for _ in range(3 * common.TIDY):
        common.written(spark.range(1))
    assert len(calls) == 3 and held.get() is None


def test_language_learns_all_rows_and_decides(spark, monkeypatch):
    """Every labelled row is learned (also those that op2 holds out), and texts whose language is not known go."""
    catalog.prepare(spark)
    rng = np.random.default_rng(3)
    say = lambda words: " ".join(rng.choice(words, 12))
    rows = [(i, say(["the", "of", "and", "with", "that"]), "en") for i in range(150)]
    rows += [(1000 + i, say(["xuq", "quz", "zyx", "juq"]), f"l{i % 3}") for i in range(300)]   # one tongue, three names
    rows += [(5000, "12 ?", "en"), (5001, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    train = P.lang_id.train
    monkeypatch.setattr(P.lang_id, "train", lambda d, *a: (seen.append(d.count()), train(d, *a))[1])
    got = {r.doc_id for r in P.language(spark, docs, None).collect()}
    assert seen == [len(rows)]
    assert got >= set(range(150)) and not got & {5000, 5001}
    assert len([i for i in got if i >= 1000]) < 60
