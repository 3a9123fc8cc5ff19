"""A training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  ``run`` writes
every stage's rows as Parquet under the shared checkpoint folder and rereads them as the next one's docs, so a lost
executor never costs more than one stage.

1. ``language``: rows whose text has no language (null, or no letter) go, and those whose language is not known: no language
   learned from the rows is likelier than all others together (calibrated score below ``KNOWN``).
2. ``exact_copies``: one row of each group of equal texts stays.
3. ``near_copies``: one document of each component of 5-word shingle sets with Jaccard >= 0.8 stays.
4. ``mixture``: rows are dropped or repeated so that sources meet their target words.
5. ``tokens``: every row is encoded and decoded; returns doc_id, n_tokens and the digests of ids and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import bpe, exact_dedup, jaccard_join, lang_id, mixing
from tickforge.llm.catalog import prepare as configured
from tickforge.llm.common import documents, written

#: Bytes of an Arrow batch: all stages use the same Python workers, which keep what the largest batch of any stage took.
BATCH_BYTES = 2 << 20
#: Least score of a known language.
KNOWN = 0.5


def prepare(spark: SparkSession) -> None:
    configured(spark, BATCH_BYTES)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lang_id.known_language(docs, least=KNOWN)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.repeat_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.round_trip(docs)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("mixture", mixture), ("tokens", tokens)]

#: Learned models, hashed samples and the tokenizer are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
