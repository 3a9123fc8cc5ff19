"""Ids of any type, null or repeated, in every operator and helper; closed syncmers against their definition."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from test_llm_ops import EDGES, SCHEMA, clashing, prepared

from tickforge.llm import (alignment, bpe, context_tree, divergence, exact_dedup, jaccard_join, lang_id, mixing, quality, sharding,
                           syncmers, unit_dedup)

BOTH = "a passage of some twenty words that stands in two documents so that the later one of them has to lose it whole"
ROWS = EDGES + [(None, "no id here at all, but some words to read", "en", "a", None), (None, "another text without an id", "en", "a", None),
                (30, "before " + BOTH, "en", "a", None), (31, BOTH + " after", "en", "b", None), (31, BOTH + " after", "en", "b", None)]


def _labels(docs):
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.sparkSession.createDataFrame([("1", 1, 0), ("9", 0, 1)], "d string, quality int, toxic int").select(
        F.col("d").cast(kind).alias("doc_id"), "quality", "toxic")


WAYS = {
    "classify": lambda d: quality.classify(d, _labels(d)), "keep_good": lambda d: quality.keep_good(d, _labels(d)),
    "identify": lang_id.identify, "near_components": jaccard_join.near_components, "drop_near_copies": jaccard_join.drop_near_copies,
    "score": context_tree.score, "repeated_units": unit_dedup.repeated_units, "repeated_passages": unit_dedup.repeated_passages,
    "remove_units": unit_dedup.remove_repeats, "remove_passages": lambda d: unit_dedup.remove_repeats(d, unit="passage"),
    "edited_likeness": syncmers.edited_likeness, "anchors": syncmers.anchors, "mix": mixing.mix, "repeat_rows": mixing.repeat_rows,
    "exact_dedup": exact_dedup.exact_dedup, "drop_copies": exact_dedup.drop_copies, "round_trip": bpe.round_trip, "shard": sharding.shard,
    "align": alignment.align, "divergence": divergence.divergence,
}


HELPERS = {"keep_good", "drop_near_copies", "repeated_passages", "remove_units", "remove_passages", "anchors", "repeat_rows", "drop_copies"}


@pytest.fixture(scope="module")
def rows(spark):
    return prepared(spark).createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def named(rows):
    return rows.withColumn("doc_id", F.format_string("id-%03d", "doc_id")).withColumn(
        "doc_id", F.when(F.col("doc_id") != "id-null", F.col("doc_id"))).cache()


@pytest.mark.parametrize("way", WAYS)
def test_string_null_and_repeated_ids(way, rows, named):
    """Ids as text give as many rows as whole numbers of the same order; empty tables and clashing names change nothing."""
    f = WAYS[way]
    got = f(named)
    kept = got.collect()
    if way != "repeat_rows":                      # the draw goes by hashes of the ids
        assert len(kept) == f(rows).count()
    if "doc_id" in got.columns:
        assert got.schema["doc_id"].dataType.simpleString() == "string"
    if way in HELPERS:                            # the others: test_llm_ops, test_align_search_audit
        assert f(named.filter("1 = 0")).count() == 0
        assert f(clashing(named)).count() == len(kept)


def test_passages_with_string_ids(named):
    got = [(r.doc_id, r.keep_id, r.n_words) for r in unit_dedup.repeated_passages(named).collect() if r.doc_id == "id-031"]
    assert sorted(got)[0][1] == "id-030" and max(n for _, _, n in got) >= 21
    left = [r.text for r in unit_dedup.remove_repeats(named, unit="passage").collect() if r.doc_id == "id-031"]
    assert all("twenty" not in t for t in left) and len(left) == 2


def test_null_ids_keep_their_good_rows(spark):
    good = [(k, f"a good text of its own number {k} with words to read", "en", "a", None) for k in range(20)]
    bad = [(100 + k, f"XX$$ BUY {k} NOW!!! ##", "en", "b", None) for k in range(20)]
    more = [(None, f"a good text of its own number {k} with words to read", "en", "a", None) for k in (40, 41, 42, 42)]
    docs = prepared(spark).createDataFrame(good + bad + more, SCHEMA)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(100 + k, 0, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    said = quality.classify(docs, labels).filter("keep AND doc_id IS NULL").count()
    assert said == 4 and quality.keep_good(docs, labels).filter("doc_id IS NULL").count() == 4


def test_shards_hold_every_row_once_and_every_column(spark):
    docs = prepared(spark).createDataFrame([(7, "x", 1, 2, 3), (7, "x", 1, 2, 3), (7, "y", 4, 5, 6), (None, None, 7, 8, 9)],
                                           "doc_id long, text string, _id int, shard int, slot int")
    out = os.path.join(tempfile.mkdtemp(prefix="shards-"), "t")
    sharding.write_shards(docs, out, shards=2)
    got = spark.read.parquet(out)
    assert set(got.columns) == {"doc_id", "text", "_id", "shard", "slot", "_shard", "_slot"}
    assert sorted(map(str, got.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert {r["_shard"] for r in got.collect()} == {0, 1}


# --- fingerprints --------------------------------------------------------------------------------------------------------


def _tokens(text):
    import re
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if any(len(w) > syncmers.LONG for w in words):
        return [c for w in words for c in (w if len(w) > syncmers.LONG else [w])]
    return list(" ".join(words)) if len(words) < syncmers.K else words


def test_closed_syncmers_by_definition(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choices(["ab", "cd", "ef", "gh", "ij", "kl"], k=rnd.randint(0, 60))) for _ in range(60)]
    texts += ["", " \n", "three short words", "日" * 10 + "本" * 30, "x" * 33 + " yes no", "".join(rnd.choices("日本語文字列", k=200))]
    df = prepared(spark).createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {}
    for r in syncmers.anchors(df).collect():
        found.setdefault(r.doc_id, []).append(r.position)
    # the hash of each run of S tokens, as the engine gives it
    runs = sorted({tuple(t[i:i + syncmers.S]) for t in map(_tokens, texts) for i in range(len(t) - syncmers.S + 1)})
    h = {r.k: r.h for r in spark.createDataFrame([(k, list(t)) for k, t in enumerate(runs)], "k int, t array<string>").select(
        "k", F.xxhash64(F.xxhash64(F.col("t")[0]), F.xxhash64(F.col("t")[1])).alias("h")).collect()}
    number = {t: h[k] for k, t in enumerate(runs)}
    for k, text in enumerate(texts):
        t = _tokens(text)
        s = [number[tuple(t[i:i + syncmers.S])] for i in range(len(t) - syncmers.S + 1)]
        wide = syncmers.K - syncmers.S + 1
        want = [i for i in range(len(t) - syncmers.K + 1) if min(s[i:i + wide]) in (s[i], s[i + wide - 1])]
        assert sorted(found.get(k, [])) == want, text


def _likeness(spark, a, b):
    df = prepared(spark).createDataFrame([(a, b)], "a string, b string")
    df = syncmers.with_fingerprint(syncmers.with_fingerprint(df, "a", "x"), "b", "y")
    return df.select(syncmers.likeness("x", "y").alias("l"), F.size("x").alias("n")).first()


def test_likeness_by_position(spark):
    rnd = random.Random(9)
    unspaced = "".join(rnd.choices([chr(0x4E00 + i) for i in range(500)], k=2000))
    assert _likeness(spark, unspaced, unspaced[:900] + "x" + unspaced[901:])["l"] > 0.95
    assert _likeness(spark, unspaced, unspaced[1000:])["l"] > 0.4                          # shifted: distances stay
    words = [f"w{rnd.randint(0, 5000)}" for _ in range(20000)]
    same = _likeness(spark, " ".join(words), " ".join(words))
    assert same["l"] == 1.0 and 400 < same["n"] < 900                                       # grows with the text
    half = _likeness(spark, " ".join(words), " ".join(words[:10000] + [f"v{i}" for i in range(10000)]))["l"]
    assert 0.25 < half < 0.42                                                               # a third of the elements of both
    blocks = [words[i:i + 100] for i in range(0, 2000, 100)]
    moved = " ".join(w for b in reversed(blocks) for w in b)
    assert _likeness(spark, " ".join(words[:2000]), moved)["l"] > 0.85                      # passages match wherever they stand
    shuffled = words[:2000]
    rnd.shuffle(shuffled)
    assert _likeness(spark, " ".join(words[:2000]), " ".join(shuffled))["l"] < 0.05
    assert _likeness(spark, "", "")["l"] == 1.0 and _likeness(spark, "", "a")["l"] == 0.0
    assert _likeness(spark, "one two three", "one two threes")["l"] > 0.5                   # few words: characters


def test_null_ids_are_spread_over_blocks(spark):
    rows = [(None, f"text number {i} " + "word " * 40, "en", "a", None) for i in range(400)] + [(i, "t", "en", "a", 1) for i in range(20)]
    df = prepared(spark).createDataFrame(rows, SCHEMA)
    blocks = syncmers.with_successor(df, "doc_id", "text", 8000).filter("halo = 0").groupBy("block").count().collect()
    assert len(blocks) > 5 and max(r["count"] for r in blocks) < 200
    got = syncmers.edited_likeness(df)
    assert got.count() == 420
