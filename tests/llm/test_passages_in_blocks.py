"""op5: texts hashed many at a time, stretches that move as one row, and what counts as frequent."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tickforge.llm import unit_dedup
from tickforge.llm.catalog import prepare

RND = random.Random(11)
TEXTS = ["", "  ", "ΣΣ aΣ", "İstanbul and more words \U0001f600 stand here", "x y z " * 40, "one. two\nthree four five six\n\nseven", "a.b c d e f g",
         *(" ".join(f"w{RND.randrange(30)}" for _ in range(RND.randrange(60))) + RND.choice(["", "\n", ".", " \n\n"]) for _ in range(60))]


def _prose(n):
    return " ".join(f"w{RND.randrange(10 ** 6)}" for _ in range(n))


def test_texts_of_a_block_keep_apart(monkeypatch):
    """Names, digests and rows of many texts are those of each text alone."""
    def all_of(size):
        monkeypatch.setattr(unit_dedup, "BLOCK", size)
        names, rows = [], []
        for at, some in unit_dedup.blocks(TEXTS):
            e = unit_dedup.Entries(some, 2, 6)
            names += zip(e.names.tolist(), e.digests().tolist(), e.known().tolist())
            for of, *v, many, starts, ends, runs in e.rows((1 + e.names % np.uint64(3)).astype(np.uint8) % 3 * (1 + 2 * (e.names % np.uint64(2))).astype(np.uint8)):
                upto = np.cumsum(many)
                rows += [(at + int(k), *(int(c[i]) for c in v), *(tuple(c[upto[i] - many[i]:upto[i]].tolist()) for c in (starts, ends, runs)))
                         for i, k in enumerate(of)]
        return sorted(names), sorted(rows)
    assert len(list(unit_dedup.blocks(TEXTS))) == 1
    alone = all_of(0)
    assert alone[1] and all_of(1 << 17) == alone == all_of(300)


def test_stretches_that_differ_move_as_one_row(spark):
    prepare(spark)
    shared = _prose(100).split()
    texts = [" ".join(shared[:k] + [f"edit{k}"] + shared[k + 1:]) for k in range(0, 100, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = unit_dedup._recurring(docs, "doc_id", "text", 5, 15).filter(F.col("kind") == unit_dedup.RUN)
    got = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.greatest(F.size("runs"), F.lit(1))).alias("runs")).first()
    assert got.runs > 2 * got.rows


def test_all_entries_become_rows_in_one_step(spark):
    """Runs and whole entries go through one step and one window, and there are as many rows as runs and whole entries."""
    prepare(spark)
    shared = _prose(100).split()
    rows = {}
    for copies in (10, 20):
        texts = [" ".join(shared[:k] + [f"edit{k}"] + shared[k + 1:]) for k in range(0, 100, 100 // copies)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = unit_dedup._recurring(docs, "doc_id", "text", 5, 15).filter(F.col("kind") != unit_dedup.TEXT)
        each = unit_dedup._each(found)
        rows[copies] = each.count()
        assert rows[copies] == found.agg(F.sum(F.greatest(F.size("runs"), F.lit(1)))).first()[0]
        assert all(r.end > r.start for r in each.collect())
    assert rows[20] < 2.2 * rows[10]
    plan = unit_dedup.repeated_passages(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1


def test_by_name_and_by_digest_agree(spark, monkeypatch):
    """Passages of names that occur often (all names of a few rows do) and of others."""
    prepare(spark)
    mid, line = _prose(80), "one short line of six words"
    data = [(k, f"{_prose(9)} {' '.join(mid.split()[k:60 + 2 * k])} {_prose(9)}\n{line}" + " x y z" * k) for k in range(12)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    often = sorted(unit_dedup.repeated_passages(docs).collect())
    monkeypatch.setattr(unit_dedup, "HEAVY", 1)
    assert often and often == sorted(unit_dedup.repeated_passages(docs).collect())


def test_only_frequent_digests_are_named_and_once(spark):
    """A sketch made anew for each use may name other digests."""
    rows = spark.range(3000).select(F.when(F.col("id") % 50 == 0, F.lit(-1)).otherwise(F.col("id")).alias("d1"))
    named = unit_dedup._frequent(rows)
    assert [r.d1 for r in named.collect()] == [-1]
    assert "approx_top_k" not in named._jdf.queryExecution().toString()


def test_rows_meet_what_is_known_of_their_digest_once(spark):
    """A frequent digest of twice as many rows makes twice as many: each row goes through one join, which adds none."""
    for n in (1000, 2000):
        data = [(5 if k % 4 else k, k % 4 % 2, (7 * k) % n) for k in range(n)] + [(-k, 0, n + k // 2) for k in range(1, 9)] + [(-1, 0, -1)]
        rows = spark.createDataFrame(data, "d1 long, d2 long, place long")
        later = unit_dedup._later(rows, [F.col("place")], ["place"])
        groups = {}
        for d1, d2, place in data:
            groups.setdefault((d1, d2), []).append(place)
        want = sorted((*d, p, min(g), len(g)) for d, g in groups.items() if len(g) > 1 for p in g)
        got = later.select("d1", "d2", "place", "best.place", "group_size").collect()
        assert len(got) > 0.7 * n and sorted(map(tuple, got)) == want
        plan = later._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == plan.count("Join LeftOuter") == 1


def test_texts_of_one_id_rank_by_their_hash(spark):
    prepare(spark)
    mid = _prose(40)
    for i in (7, None):
        docs = spark.createDataFrame([(i, f"{_prose(20)} {mid} {_prose(20)}") for _ in range(40)], "doc_id long, text string")
        hashes = sorted(r.h for r in docs.select(F.xxhash64("text").alias("h")).collect())
        left = sorted(r.row_hash for r in unit_dedup.repeated_passages(docs).collect())
        assert left == hashes[1:]
