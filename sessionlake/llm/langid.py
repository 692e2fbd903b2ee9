"""Language identification: TF-IDF of hashed character n-grams, sparse multinomial regression, calibrated.

Document frequencies are counted over all documents to learn from, in one pass: each task adds up its own and Spark
sums the buckets. The regression is fitted on a sample of about `train_docs` of them, in shards whose weights are
averaged; others of the sample, which no shard sees, set the temperature. Prediction is one pass over all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm import ftrl
from sessionlake.llm.common import sampled, stored

BUCKETS = 1 << 15
#: Any odd constants do.
ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint64)


@cache
def _letters() -> np.ndarray:
    """By code point: whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the 1- to 3-grams of a text's lower-cased letters, runs of anything else as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    codes = np.where(_letters()[codes.astype(np.int64)], codes, np.uint64(32))
    codes = np.concatenate([[np.uint64(32)], codes, [np.uint64(32)]])
    codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
    found = []
    for n in (1, 2, 3):
        h = np.zeros(len(codes) - n + 1, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(31) + codes[k : k + len(h)] * ODD[k]
        found.append((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)).astype(np.int64))
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def has_letters(text) -> bool:
    return isinstance(text, str) and any(c.isalpha() for c in text)


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of unit length."""
    buckets, counts = ngram_counts(text)
    values = (1 + np.log(counts)) * idf[buckets]
    return buckets, values / max(float(np.sqrt(values @ values)), 1e-12)


def held_out(id_col: str, fold: int = 2, folds: int = 4) -> Column:
    """Whether a document is not to be learnt from: crc32 of its id as text; a null id is not."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % folds == fold, F.lit(True))


def idf_of(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequencies of the buckets over all rows of texts (text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for t in batches:
            for text in t["text"]:
                if has_letters(text):
                    df[ngram_counts(text)[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(at, -1), "df": np.append(df[at], n)})

    rows = texts.mapInPandas(count, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()  # a row a bucket at most
    df, n = np.zeros(BUCKETS), 0
    for r in rows:
        if r.bucket < 0:
            n = r.df
        else:
            df[r.bucket] = r.df
    return np.log((1 + n) / (1 + df)) + 1


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = 6000, shards: int = 4) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): a row for each row of docs.

    Learns from the text and non-null lang of documents that are not held_out(); predictions read the text alone.
    lang_pred is `und` with score 0 if the text is null or has no letter, or if there is nothing to learn from. Repeated
    rows are predicted each, null ids are held out. An empty table gives no rows; no other column is read.
    `train_docs` bounds the documents that the regression is fitted on, in expectation; their choice is by hash, in
    equal parts of each language. Texts are read whole, in memory of a few times the longest one's size.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("held_out"))
    known = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counted)
    if not langs:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    idf = idf_of(known.select("text"))
    number = {x: i for i, x in enumerate(langs)}
    # each language has an equal part of the sample, a rare one all its documents
    quota = -(-train_docs // len(langs))
    share = reduce(lambda c, x: c.when(F.col("lang") == x, sampled(F.col("doc_id"), quota, counted[x])), langs, F.when(F.lit(False), F.lit(False)))
    shard = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(shards + 1)).cast("int")
    sample = stored(known.where(share).select("text", "lang", shard.alias("shard")))

    def fit(t: pd.DataFrame) -> pd.DataFrame:
        examples = [(*tfidf(x, idf), number[y]) for x, y in zip(t["text"], t["lang"], strict=True) if has_letters(x)]
        w = ftrl.trained(examples, BUCKETS, len(langs))
        at = np.flatnonzero(w.any(axis=1))
        return pd.DataFrame({"bucket": at, "w": list(w[at])})

    fitted = sample.where(F.col("shard") < shards).groupBy("shard").applyInPandas(fit, "bucket int, w array<double>")
    weights = np.zeros((BUCKETS, len(langs)))
    for r in fitted.select("bucket", F.posexplode("w").alias("k", "x")).groupBy("bucket", "k").agg(F.sum("x").alias("x")).collect():  # a row a weight at most
        weights[r.bucket, r.k] = r.x / shards

    def logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            kept = [(x, y) for x, y in zip(t["text"], t["lang"], strict=True) if has_letters(x)]
            yield pd.DataFrame({"z": [(v @ weights[b]).tolist() for b, v in (tfidf(x, idf) for x, _ in kept)], "y": [number[y] for _, y in kept]})

    calibration = sample.where(F.col("shard") == shards).select("text", "lang").mapInPandas(logits, "z array<double>, y int").collect()  # within train_docs
    temperature = ftrl.best_temperature(np.array([r.z for r in calibration]), np.array([r.y for r in calibration], dtype=int))

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            pred, score = [], []
            for x in s:
                if has_letters(x):
                    b, v = tfidf(x, idf)
                    p = ftrl.softmax(v @ weights[b] / temperature)
                    pred.append(langs[int(p.argmax())])
                    score.append(float(p.max()))
                else:
                    pred.append("und")
                    score.append(0.0)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    predicted = F.pandas_udf(predict, "lang_pred string, score double")
    return rows.select("doc_id", "held_out", predicted("text").alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
