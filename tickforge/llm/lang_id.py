"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

* Features: character 1- to 3-grams of the whole lower-cased text, hashed into ``DIMS``
  buckets.  A text's value of a bucket is ``SCALE`` * share of its n-grams * idf.
* Idf: document frequencies of all training documents, counted map-side for each
  partition and summed by a shuffle (at most ``DIMS`` sums reach the driver).
* Fit: follow-the-regularised-leader with elastic-net penalties on a sample of about
  ``SAMPLE`` rows for each language, drawn by a hash of id and text.  The sample is dealt
  into ``SHARDS`` groups fitted in parallel; their weights are averaged.
* Calibration: one temperature, fitted on sampled rows that no shard saw.
* Prediction: every whole text in one pass without a shuffle; the weights (at most
  ``DIMS`` x languages numbers) are broadcast.

Texts that are null or have no letter are ``und`` with score 0, and so is every text
where there is nothing to learn from.  Null labels are not learned.  Ties between languages go to the
smaller name.  Long texts are processed in blocks.  Repeated rows get equal results;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import ftrl
from tickforge.llm.common import col, documents, free_name

DIMS, ORDERS, SCALE = 1 << 16, (1, 2, 3), 10.0
#: Rows for each language that the fit may see (on average, hash sample), and most languages.
SAMPLE, SHARDS, MAX_LANGUAGES = 2000, 4, 1000
UNKNOWN = "und"
BLOCK = 1 << 18


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fold(id_: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % parts


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.empty(0, np.uint16)
    h = np.full(n, 0x9E3779B1 * order & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h ^= codes[k:k + n]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    return (h >> np.uint32(16)).astype(np.uint16)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of a text in order, their shares)."""
    codes = _codes(text)
    parts = [buckets(codes, o) for o in ORDERS]
    total = sum(map(len, parts))
    if not total:
        return np.empty(0, np.int64), np.empty(0)
    idx, c = np.unique(np.concatenate(parts), return_counts=True)
    return idx.astype(np.int64), c / total


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Number of texts with each bucket, over all rows; the last entry counts the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen, n = np.zeros(DIMS, np.int64), np.zeros(DIMS, np.int32), 0
        part = np.zeros(DIMS, np.int32)
        for b in batches:
            for t in b.column(0):
                codes = _codes(t.as_py())
                for o in ORDERS:
                    seen[buckets(codes, o)] = 1
                part += seen
                seen[:] = 0
                n += 1
            df += part
            part[:] = 0
        at = np.flatnonzero(df)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, DIMS)), pa.array(np.append(df[at], n))],
                                             names=["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(DIMS + 1, np.int64)
    out[sums["bucket"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=np.int64)
    return out


class Model:
    """languages, weights times idf (DIMS x languages, float32) and the temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, heat: float):
        self.languages, self.weights, self.heat = languages, weights, heat

    def logits(self, text: str) -> np.ndarray:
        codes, n = _codes(text), 0
        z = np.zeros(len(self.languages))
        for o in ORDERS:
            for s in range(0, max(0, len(codes) - o + 1), BLOCK):
                h = buckets(codes[s:s + BLOCK + o - 1], o)
                z += self.weights[h].sum(axis=0, dtype=np.float64)
                n += len(h)
        return z * (SCALE / max(n, 1))


def train(labelled: DataFrame, text_col: str, lang_col: str, key: Column, sample: int = SAMPLE,
          shards: int = SHARDS) -> Model | None:
    """Fit on the rows of ``labelled``; ``key`` names a row for the hash sample."""
    rows = labelled.filter(col(lang_col).isNotNull() & has_letter(col(text_col))).select(
        col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"),
        F.xxhash64(key, col(text_col), F.lit(11)).alias("h"))
    counts = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if not counts:
        return None
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in counts)
    df = document_frequencies(rows.select("text"))
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1

    rate = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["count"])))])
    u = F.col("h").bitwiseAND((1 << 40) - 1) / F.lit(float(1 << 40))
    drawn = (rows.filter(u < rate[F.col("lang")])
             .withColumn("shard", (F.shiftright("h", 44).bitwiseAND(0xFFFF) % (shards + 1)).cast("int")))
    place = {g: k for k, g in enumerate(languages)}

    def fit_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h", kind="stable")
        x = []
        for t, g in zip(pdf["text"], pdf["lang"]):
            i, share = counted(t)
            x.append((i, SCALE * share * idf[i], place[g]))
        if pdf["shard"].iloc[0] == shards:     # kept from the fit: for the temperature
            return pd.DataFrame({"kind": 1, "i": [i for i, _, _ in x], "v": [v for _, v, _ in x],
                                 "y": [y for _, _, y in x]})
        w = ftrl.fit(x, DIMS, len(languages))
        at = np.flatnonzero(np.abs(w).sum(axis=1))
        return pd.DataFrame({"kind": 0, "i": [at], "v": [w[at].ravel()], "y": [len(x)]})

    got = (drawn.groupBy("shard")      # a bounded sample
           .applyInPandas(fit_shard, "kind int, i array<long>, v array<double>, y int").toPandas())
    weights, fits, held = np.zeros((DIMS, len(languages))), 0, []
    for kind, i, v, y in got.itertuples(index=False):
        if kind:
            held.append((np.asarray(i, np.int64), np.asarray(v, float), y))
        else:
            weights[np.asarray(i, np.int64)] += y * np.asarray(v, float).reshape(-1, len(languages))
            fits += y
    weights /= max(fits, 1)
    z = np.array([v @ weights[i] for i, v, _ in held]).reshape(-1, len(languages))
    heat = ftrl.temperature(z, np.array([y for _, _, y in held], dtype=int))
    return Model(languages, (weights * idf[:, None]).astype(np.float32), heat)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text",
            lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with predicted language and probability; columns of those names give way."""
    keep = [c for c in docs.columns if c.lower() not in (lang_col.lower(), score_col.lower()) or c == text_col]
    base = docs.select(*[col(c) for c in keep])
    if model is None:
        return base.withColumns({lang_col: F.lit(UNKNOWN), score_col: F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def scored(s: pd.Series) -> pd.DataFrame:
        m, lang, score = sent.value, [], []
        for t in s:
            if t is None:
                lang.append(UNKNOWN)
                score.append(0.0)
                continue
            p = ftrl.softmax(m.logits(t) / m.heat)
            k = int(p.argmax())
            lang.append(m.languages[k])
            score.append(float(min(1.0, p[k])))
        return pd.DataFrame({"lang": lang, "score": score})

    tmp = free_name(base, "_scored")
    return (base.withColumn(tmp, scored(F.when(has_letter(col(text_col)), col(text_col))))
            .select(*[col(c) for c in keep], col(tmp)["lang"].alias(lang_col), col(tmp)["score"].alias(score_col)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 5) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row, learned from the rows that are not held out."""
    model = train(docs.filter(fold(col(id_col), folds) != 0), text_col, lang_col, col(id_col))
    rows = docs.select(col(id_col).alias("id"), (fold(col(id_col), folds) == 0).alias("held_out"),
                       col(text_col).alias("text"))
    return predict(rows, model).select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")


def known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   least: float = 0.0) -> DataFrame:
    """Rows of ``docs`` whose text has a language (not ``und``) with a score of at least ``least``, learned from all rows."""
    model = train(docs, text_col, lang_col, col(id_col))
    if model is None:                   # nothing to learn from: only texts without a letter go
        return docs.filter(has_letter(col(text_col)))
    lang, score = free_name(docs, "_lang_pred"), free_name(docs, "_lang_score")
    return (predict(docs, model, text_col, lang, score)
            .filter((col(lang) != UNKNOWN) & (col(score) >= least)).select(*[col(c) for c in docs.columns]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


ORACLE_SQL = None
