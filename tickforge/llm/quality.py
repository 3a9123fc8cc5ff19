"""Quality classifier with a hierarchy of sites (empirical Bayes).

1. Document evidence.  Two logistic models (quality, toxic) over the distinct words of the whole text, without
   punctuation, hashed into ``DIMS`` buckets, and classes of a few shares (capitals, distinct words, marks, digits).
   Words also count by their first bytes.  A feature's value is its log ratio between the classes.  Fitted by follow-the-regularised-leader on a sample of about ``SAMPLE`` labelled rows for each
   (quality, toxic) cell; the labels are sampled first, so the texts are never shuffled.  Held-out sampled rows give
   each model's temperature.
2. Sites.  A document's site is a host and a path below it.  Over all documents, grouped
   sums of the quality evidence give each host a Beta posterior around the global mean and each path one around its
   host.  The strength of a prior (pseudo-documents) comes from the spread of the observed
   means by the method of moments, so sparse sites shrink to their host and the world.
3. Posterior.  A document's log odds are its evidence plus the log odds of its path, estimated
   without the document itself, minus those of the global mean.

``keep``: quality of at least 1/2 and toxic below 1/2.  Null and empty texts have
quality 0, toxic 0 and are not kept.  A null host or path is a site of its own.
Labels with nulls are not learned.  A model without rows of both classes answers with the class it
has seen (quality 1, toxic 0 if none).  Repeated rows count as evidence each; empty tables
give no rows.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import ftrl
from tickforge.llm.common import col, documents, free_name, written

DIMS, STATS = 1 << 18, 64
SAMPLE, HELD = 3000, 5            # one in HELD sampled rows is kept from the fit
EPOCHS, ALPHA, L1, L2, RARE = 5, 0.3, 0.1, 1.0, 5
PREFIX = 4
#: ASCII but letters and digits becomes a space.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
HEADS = ("quality", "toxic")
#: Pseudo-documents of a prior at least and at most.
WEAKEST, STRONGEST = 1.0, 1e6


def _stats(text: str) -> list[int]:
    """Classes of the shares of capitals, distinct words, marks and digits, of word length and of size."""
    n = max(1, len(text))
    words = text.split()
    letters = max(1, sum(map(len, words)))
    upper = sum(map(str.isupper, text)) / letters
    marks = sum(text.count(c) for c in "!?#*|&=<>{}") / n
    digits = sum(text.count(c) for c in "0123456789") / n
    distinct = len(set(words)) / max(1, len(words))
    cls = lambda v, *edges: int(np.searchsorted(edges, v))
    found = (cls(upper, .02, .05, .1, .2, .4), cls(distinct, .05, .1, .2, .3, .4, .5, .6), cls(marks, .001, .01, .05, .1),
             cls(digits, .01, .05, .2), cls(letters / max(1, len(words)), 2, 3, 4, 7, 10, 20),
             cls(len(words), 3, 10, 30, 100, 1000))
    return [DIMS + 8 * k + v for k, v in enumerate(found)]


def features(texts: list[str]) -> list[np.ndarray]:
    """Indices of the features each text has (all have value 1): its words, their first ``PREFIX`` bytes, its
    classes, and last the bias."""
    out = []
    for t in texts:
        words = set(t.lower().encode("utf-8", "replace").translate(_PLAIN).split())
        found = {crc32(w) % DIMS for w in words} | {crc32(p, 1) % DIMS for p in {w[:PREFIX] for w in words}}
        out.append(np.array([*sorted(found), *_stats(t), DIMS + STATS - 1], np.int64))
    return out


def log_ratios(x: list[np.ndarray], y: list[int]) -> np.ndarray:
    """Value of each feature: the smoothed log ratio of its shares among the rows of class 1 and of class 0 (0 below
    ``RARE`` rows; 1 for the bias)."""
    n = np.zeros((2, DIMS + STATS))
    for i, c in zip(x, y):
        n[c, i] += 1
    total = np.bincount(y, minlength=2)
    r = np.log((n[1] + 1) / (total[1] + 2)) - np.log((n[0] + 1) / (total[0] + 2))
    r[n.sum(axis=0) < RARE] = 0
    r[-1] = 1
    return r


def _seen(labels: DataFrame, head: str) -> float:
    top = labels.groupBy(head).count().orderBy(F.desc("count"), head).first()
    return float(top[head]) if top else float(head == "quality")


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE) -> dict:
    """Head -> (weights, temperature), or a constant probability where there is only one class."""
    known = labels.select(col(id_col).alias("lid"), *[col(h).cast("int").alias(h) for h in HEADS]).dropna()
    cells = known.groupBy(*HEADS).count().collect()            # four rows
    rate = F.lit(0.0)
    for r in cells:
        rate = F.when((F.col("quality") == r["quality"]) & (F.col("toxic") == r["toxic"]),
                      min(1.0, sample / r["count"])).otherwise(rate)
    h = F.xxhash64("lid", F.lit(17))
    drawn = known.withColumn("h", h).filter(h.bitwiseAND((1 << 40) - 1) / F.lit(float(1 << 40)) < rate)
    rows = (docs.select(col(id_col).alias("lid"), col(text_col).alias("text")).filter("text <> ''")
            .join(F.broadcast(drawn), "lid")          # about 4 * SAMPLE rows
            .withColumn("shard", (F.shiftright("h", 44).bitwiseAND(0xFFFF) % HELD).cast("int")).withColumn(
                "shard", F.when(F.col("shard") == 0, 1).otherwise(0)))

    def fit_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "text"], kind="stable")
        x = features(pdf["text"].tolist())
        if pdf["shard"].iloc[0] == 1:
            return pd.DataFrame({"kind": "held", "i": x, "v": [np.empty(0)] * len(x),
                                 **{k: pdf[k].to_numpy() for k in HEADS}})
        out = []
        for k in HEADS:
            y = pdf[k].tolist()
            ratio = log_ratios(x, y)
            w = ftrl.fit([(i, ratio[i], c) for i, c in zip(x, y)], DIMS + STATS, 2, epochs=EPOCHS, alpha=ALPHA, l1=L1, l2=L2)
            w = (w[:, 1] - w[:, 0]) * ratio
            at = np.flatnonzero(w)
            out.append((k, at, w[at], len(x), 0))
        return pd.DataFrame(out, columns=["kind", "i", "v", *HEADS])

    got = (rows.groupBy("shard").applyInPandas(       # a bounded sample
        fit_shard, "kind string, i array<long>, v array<double>, quality int, toxic int").toPandas())
    model = {}
    for k in HEADS:
        classes = {r[k] for r in cells}
        if len(classes) < 2 or not len(got[got["kind"] == k]):
            model[k] = float(classes.pop()) if len(classes) == 1 else _seen(known, k)
            continue
        w, n = np.zeros(DIMS + STATS), 0
        for i, v, m in got[got["kind"] == k][["i", "v", "quality"]].itertuples(index=False):
            w[np.asarray(i, np.int64)] += m * np.asarray(v, float)
            n += m
        w /= max(1, n)
        held = got[got["kind"] == "held"]
        z = np.array([[0.0, w[np.asarray(i, np.int64)].sum()] for i in held["i"]]).reshape(-1, 2)
        model[k] = (w.astype(np.float32), ftrl.temperature(z, held[k].to_numpy(dtype=int)))
    return model


def evidence(docs: DataFrame, model: dict, text_col: str) -> DataFrame:
    """``docs`` with zq and zt: log odds of quality and toxic of every whole text (null: no text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("zq double, zt double")
    def scored(s: pd.Series) -> pd.DataFrame:
        out, texts = {}, [t or "" for t in s]
        x = features(texts)
        for name, k in (("zq", "quality"), ("zt", "toxic")):
            m = sent.value[k]
            if isinstance(m, float):
                z = [20.0 if m >= 0.5 else -20.0] * len(x)
            else:
                z = [float(m[0][i].sum()) / m[1] for i in x]
            out[name] = [None if t == "" else min(30.0, max(-30.0, v)) for t, v in zip(texts, z)]
        return pd.DataFrame(out, dtype="float64")

    return docs.withColumn("_z", scored(col(text_col))).select("*", "_z.zq", "_z.zt").drop("_z")


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, n: str, s: str, center: Column, mean: float) -> float:
    """Pseudo-documents of the prior around ``center``, from the spread of the groups' means."""
    r = (groups.filter(F.col(n) > 0).withColumn("d", F.col(s) / F.col(n) - center)
         .agg(F.sum(F.col(n) * F.col("d") * F.col("d")).alias("q"), F.sum(n).alias("n"), F.sum(F.col(n) * F.col(n)).alias("n2"),
              F.count(F.lit(1)).alias("g")).first())
    if not r["g"] or r["g"] < 2:
        return STRONGEST
    within = mean * (1 - mean)
    scale = r["n"] - r["n2"] / r["n"]
    between = (r["q"] - (r["g"] - 1) * within) / scale if scale > 0 else 0.0
    if between <= 0:
        return STRONGEST
    return float(min(STRONGEST, max(WEAKEST, within / between - 1)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host: Column | None = None, path: Column | None = None, with_hash: bool = False) -> DataFrame:
    """(id, quality, toxic, site_quality, keep) of every row; host and path default to ``source`` and ``lang``.
    ``with_hash`` adds ``row_hash``, which tells rows of one id (or null) with different texts, hosts or paths apart."""
    model = train(docs, labels, id_col, text_col)
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = docs.select(col(id_col).alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
                       col(text_col).alias("text"), _row_name(host, path, text_col).alias("row_hash"))
    rows = written(evidence(rows, model, "text").drop("text").withColumn("p", 1 / (1 + F.exp(-F.col("zq")))), "evidence")

    paths = written(rows.groupBy("host", "path").agg(F.count("p").alias("n"), F.coalesce(F.sum("p"), F.lit(0.0)).alias("s")),
                    "paths")
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")), "hosts")
    world = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    mean = min(1 - 1e-6, max(1e-6, (world["s"] or 0.0) / world["n"])) if world["n"] else 0.5
    k_host = _strength(hosts, "hn", "hs", F.lit(mean), mean)
    named = hosts.select(F.col("host").alias("h"), "hn", "hs")
    sites = paths.join(named, paths["host"].eqNullSafe(named["h"])).drop("h")
    theta = (F.col("hs") + k_host * mean) / (F.col("hn") + k_host)
    k_path = _strength(sites, "n", "s", theta, mean)
    sites = written(sites.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "hn", "hs"), "sites")

    joined = rows.join(sites, rows["host"].eqNullSafe(sites["h"]) & rows["path"].eqNullSafe(sites["q"]))
    own, one = F.coalesce("p", F.lit(0.0)), F.col("p").isNotNull().cast("int")
    host_post = (F.col("hs") - own + k_host * mean) / (F.col("hn") - one + k_host)
    site = (F.col("s") - own + k_path * host_post) / (F.col("n") - one + k_path)
    site = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), site))
    z = F.col("zq") + _logit(F.col("site_quality")) - _logit(F.lit(mean))
    return (joined.withColumn("site_quality", site)
            .withColumn("quality", F.coalesce(1 / (1 + F.exp(-z)), F.lit(0.0)))
            .withColumn("toxic", F.coalesce(1 / (1 + F.exp(-F.col("zt"))), F.lit(0.0)))
            .select(F.col("id").alias(id_col), "quality", "toxic", "site_quality",
                    ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("keep"), *["row_hash"] * with_hash))


def _row_name(host: Column, path: Column, text_col: str) -> Column:
    return F.xxhash64(col(text_col), host.cast("string"), path.cast("string"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
              path: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, as often as they occur.  Rows are named by id, text, host and path, on which the
    decision rests (the model adds a row's own evidence out of its site's), so null or repeated ids lose nothing."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    kept = (classify(docs, labels, id_col, text_col, host, path, with_hash=True).filter("keep")
            .select(col(id_col).alias("_k_id"), F.col("row_hash").alias("_k_row")).distinct())
    name = free_name(docs, "_row_name")
    left = docs.withColumn(name, _row_name(host, path, text_col))
    return left.join(kept, left[id_col].eqNullSafe(kept["_k_id"]) & (left[name] == kept["_k_row"]), "left_semi").drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE_SQL = None
