"""Quality by hierarchical empirical Bayes over a document classifier, hosts and paths.

How much oftener a hashed word, a word's beginning or a trait of style is in one class is counted over all labelled
documents; a sparse logistic regression on these log ratios gives each document's evidence of being good and of being
toxic. Hosts and paths then have posteriors from grouped sums, combined before the shuffle: of the evidence of all their
documents, and of their labels, observed against what the evidence made expect. Both are shrunk, a host's toward the
global mean and a path's toward its host's; how much follows from how far hosts and paths spread beyond chance. A
document's posterior adds its path's shifts in log odds to its own evidence.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm import ftrl
from sessionlake.llm.common import broadcast_if_small, sampled, stored

BUCKETS = 1 << 17
STYLE = 64
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are features too: they tell forms of one word.
STEMS = (5, 6, 7)


@cache
def _kinds() -> np.ndarray:
    """By code point: 1 for a letter, 2 for white space, 4 for a digit, 8 for an upper-case letter; letters end at 0x32400."""
    tell = lambda c: c.isalpha() | c.isspace() << 1 | c.isdigit() << 2 | c.isupper() << 3
    return np.concatenate([np.array([tell(chr(i)) for i in range(0x32400)], dtype=np.uint8), np.zeros(0x110000 - 0x32400, dtype=np.uint8)])


def style(text: str) -> list[int]:
    """Numbers of the style features that hold: bins of shares of kinds of characters, of repeats and of length."""
    tokens, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(text))
    counts = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)], minlength=16)
    letters, spaces, digits, upper = (int(counts[np.arange(16) & bit > 0].sum()) for bit in (1, 2, 4, 8))
    marks = n - letters - spaces - digits
    ends = sum(not x[-1].isalnum() for x in tokens)
    shares = (
        marks / n, upper / max(1, letters), digits / n,
        1 - len({*lines}) / max(1, len(lines)), ends / max(1, len(tokens)), 1 - len({*tokens}) / max(1, len(tokens)),
        min(1.0, len(tokens) / 400), min(1.0, letters / max(1, len(tokens)) / 16),
    )
    return [8 * i + min(7, int(x * 8)) if i > 5 else 8 * i + bisect_left((0.01, 0.04, 0.07, 0.12, 0.2, 0.35, 0.6), x) for i, x in enumerate(shares)]


class Features:
    """The buckets of a text's style, its different words and their beginnings; of `told` buckets only, if given. Keeps those of words seen."""

    def __init__(self, told: np.ndarray | None = None):
        self.known: dict[str, tuple[int, ...]] = {}
        self.told = told

    def _of(self, word: str) -> tuple[int, ...]:
        parts = [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]
        rows = (STYLE + zlib.crc32(x.encode("utf-8", "surrogatepass")) % (BUCKETS - STYLE - 1) for x in parts)
        return tuple(k for k in rows if self.told is None or self.told[k])

    def __call__(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > 400_000:
            known.clear()
        rows: set[int] = set()
        for w in {*WORD.findall(text.lower())}:
            own = known.get(w)
            if own is None:
                own = known[w] = self._of(w)
            if own:
                rows.update(own)
        return np.array([*style(text), *rows], dtype=np.int64)


def weighed(rows: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that tell anything, each with its log ratio, and a constant."""
    values = ratios[rows]
    told = values != 0
    return np.append(rows[told], BUCKETS - 1), np.append(values[told], 1.0)


def log_ratios(labelled: DataFrame, targets: tuple[str, ...], least_docs: int = 4, shrink: float = 8.0, floor: float = 1.0) -> list[np.ndarray | None]:
    """For each target, by bucket: the log of its share among target = 1 over that among 0, from all labelled rows.

    Shrunk where few documents have the bucket, zero where it tells little; None for a target without both classes.
    """
    names = [f"{t}_{y}" for t in targets for y in (0, 1)]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, sums = Features(), np.zeros((BUCKETS, len(names)), dtype=np.int64)
        for t in batches:
            labels = t[list(targets)].to_numpy(dtype=float)
            for text, own in zip(t["text"], labels, strict=True):
                rows = np.append(features(text), BUCKETS - 1)
                for k, y in enumerate(own):
                    if y in (0, 1):
                        sums[rows, 2 * k + int(y)] += 1
        at = np.flatnonzero(sums.any(axis=1))
        yield pd.DataFrame({"bucket": at, **{n: sums[at, k] for k, n in enumerate(names)}})

    counted = labelled.select("text", *targets).mapInPandas(count, "bucket int, " + ", ".join(f"{n} long" for n in names))
    total = np.zeros((BUCKETS, len(names)))
    for r in counted.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).collect():  # a row a bucket at most
        total[r.bucket] = r[1:]
    out: list[np.ndarray | None] = []
    for k in range(len(targets)):
        no, yes = total[:, 2 * k], total[:, 2 * k + 1]
        if not no[-1] or not yes[-1]:
            out.append(None)
            continue
        ratio = np.log((yes + 0.5) / (yes[-1] + 1)) - np.log((no + 0.5) / (no[-1] + 1))
        n = yes + no
        shrunk = np.where(n >= least_docs, ratio * n / (n + shrink), 0.0)
        shrunk[np.abs(shrunk) < floor] = 0.0
        shrunk[:STYLE] = np.where(n[:STYLE] > 0, ratio[:STYLE], 0.0)
        out.append(shrunk)
    return out


def fitted(sample: DataFrame, target: str, ratios: np.ndarray | None) -> np.ndarray | None:
    """By bucket: what it adds to the log odds of target = 1, averaged over the sample's shards; None as in log_ratios()."""
    if ratios is None:
        return None

    def fit(t: pd.DataFrame) -> pd.DataFrame:
        features = Features(ratios)
        rows = [(*weighed(features(x), ratios), int(y)) for x, y in zip(t["text"], t[target], strict=True)]
        w = ftrl.trained(rows, BUCKETS, 2, epochs=4, alpha=0.3, l1=0.1, l2=0.5)
        odds = w[:, 1] - w[:, 0]
        at = np.flatnonzero(odds)
        return pd.DataFrame({"bucket": at, "w": odds[at]})

    known = sample.where(F.col(target).isin(0, 1))
    shards = max(1, known.select("shard").distinct().count())
    weights = np.zeros(BUCKETS)
    for r in known.groupBy("shard").applyInPandas(fit, "bucket int, w double").groupBy("bucket").agg(F.sum("w").alias("w")).collect():  # a row a bucket at most
        weights[r.bucket] = r.w / shards
    weights[:-1] *= ratios[:-1]
    return weights


def _strength(groups: DataFrame, total: str, size: str, toward: Column, within: float) -> float:
    """How many documents the prior of these groups is worth, by the method of moments: `total` is a group's sum of
    `size` documents, `toward` the mean that it is shrunk to."""
    g = groups.where(F.col(size) > 0)
    r = g.agg(F.sum(F.col(size) * F.pow(F.col(total) / F.col(size) - toward, 2)).alias("between"), F.sum(size).alias("n"), F.count("*").alias("k")).first()
    if not r["n"] or r["k"] < 2:
        return 1e6
    spread = (r["between"] - (r["k"] - 1) * within) / r["n"]
    return float(np.clip(within / spread - 1, 1.0, 1e6)) if spread > 0 else 1e6


def posteriors(rows: DataFrame, observed: str, expected: str | None = None) -> DataFrame:
    """(host, path, shift): the log odds by which a path differs, shrunk to its host's and that to the global mean.

    `observed` is a document's outcome, 0 to 1, null if unknown; its shift is against `expected`, what is held likely
    already, or against the global mean of the observed. Beta posteriors: with k documents' worth of prior a host's mean
    is (sum + k * global mean) / (n + k), and a path's likewise of its host's.
    """
    known = rows.where(F.col(observed).isNotNull())
    paths = stored(known.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(observed).cast("double").alias("s"), F.sum(expected or F.lit(0.0)).alias("e")))
    totals = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("e").alias("e")).first()
    clip = lambda x: float(np.clip(x, 1e-4, 1 - 1e-4))
    prior = clip((totals["s"] or 0.0) / (totals["n"] or 1))
    prior_e = clip((totals["e"] or 0.0) / (totals["n"] or 1)) if expected else prior
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum("e").alias("host_e")))
    k = _strength(hosts, "host_s", "host_n", F.lit(prior), prior * (1 - prior))
    mean = lambda s, n, k, toward: (F.col(s) + k * toward) / (F.col(n) + k)
    hosts = hosts.select(F.col("host").alias("__host"), mean("host_s", "host_n", k, F.lit(prior)).alias("mean_s"), mean("host_e", "host_n", k, F.lit(prior_e)).alias("mean_e"))
    met = stored(paths.join(broadcast_if_small(hosts), F.col("host").eqNullSafe(F.col("__host"))))
    k = _strength(met, "s", "n", F.col("mean_s"), prior * (1 - prior))
    odds = lambda x: F.log(F.least(F.greatest(x, F.lit(1e-4)), F.lit(1 - 1e-4))) - F.log(1 - F.least(F.greatest(x, F.lit(1e-4)), F.lit(1 - 1e-4)))
    against = odds(mean("e", "n", k, F.col("mean_e"))) if expected else F.lit(float(np.log(prior / (1 - prior))))
    return stored(met.select("host", "path", (odds(mean("s", "n", k, F.col("mean_s"))) - against).alias("shift")))


def _shifted(scores: DataFrame, shifts: DataFrame, column: str) -> DataFrame:
    """scores with the shift of their host and path, 0 if there is none, added to the log odds in column."""
    few = shifts.select(F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("shift").alias("__shift"))
    met = scores.join(broadcast_if_small(few), F.col("host").eqNullSafe(F.col("__host")) & F.col("path").eqNullSafe(F.col("__path")), "left")
    return met.withColumn(column, F.col(column) + F.coalesce("__shift", F.lit(0.0))).drop("__host", "__path", "__shift")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", train_docs: int = 8000, shards: int = 2, threshold: float = 0.5, toxic_threshold: float = 0.35) -> DataFrame:
    """(doc_id, text_hash, p_quality, p_toxic, rejected): a row for each row of docs.

    p_quality and p_toxic are posteriors; a document is rejected if p_quality is under `threshold`
    or p_toxic is at least `toxic_threshold`.
    labels hold `quality` and `toxic` as 0 or 1 by id; other values and null ids are left out. Where one class is
    missing, its evidence is even: p_quality 1, p_toxic 0. Null and empty texts are judged as empty. Null hosts and
    paths are groups of their own. Repeated rows are judged each. An empty table gives no rows.
    `train_docs` bounds the labelled documents that the classifier is fitted on, in expectation; their choice is by hash,
    in equal parts of each pair of labels. Texts are read whole, in memory of a few times the longest one's size.
    """
    targets = ("quality", "toxic")
    known = stored(labels.select(F.col(id_col).alias("__id"), *(F.col(t).cast("int").alias(t) for t in targets)).where("__id is not null").distinct())
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    labelled = stored(texts.join(broadcast_if_small(known), F.col("id") == F.col("__id")).select("id", "text", *targets))
    kinds = labelled.groupBy(*(F.when(F.col(t).isin(0, 1), F.col(t)).alias(t) for t in targets)).count().collect()  # nine at most
    quota = -(-train_docs // max(1, len(kinds)))
    same = lambda r: reduce(Column.__and__, (F.when(F.col(t).isin(0, 1), F.col(t)).eqNullSafe(F.lit(r[t])) for t in targets))
    picked = reduce(lambda c, r: c.when(same(r), sampled(F.col("id"), quota, r["count"])), kinds, F.when(F.lit(False), F.lit(False)))
    sample = stored(labelled.where(picked).select("text", *targets, F.pmod(F.xxhash64(F.lit(6), "id"), F.lit(shards)).alias("shard")))
    models = [fitted(sample, t, r) for t, r in zip(targets, log_ratios(labelled, targets), strict=True)]

    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features(reduce(np.logical_or, (w != 0 for w in models if w is not None), np.zeros(BUCKETS, dtype=bool)))
        for s in texts:
            rows = [features(x if isinstance(x, str) else "") for x in s]
            odds = [[float(w[b].sum() + w[-1]) for b in rows] if w is not None else [even] * len(rows) for w, even in zip(models, (20.0, -20.0), strict=True)]
            yield pd.DataFrame({"good": odds[0], "toxic": odds[1]})

    odds = F.pandas_udf(evidence, "good double, toxic double")
    p = lambda z: 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(host_col).alias("host"), F.col(path_col).alias("path"), odds(F.col(text_col)).alias("o"))
    out = stored(rows.select("doc_id", "text_hash", "host", "path", F.col("o.good").alias("quality"), F.col("o.toxic").alias("toxic")))
    for t in (t for t, w in zip(targets, models, strict=True) if w is not None):
        out = _shifted(out, posteriors(out.withColumn("p", p(F.col(t))), "p"), t)
        told = known.select("__id", F.when(F.col(t).isin(0, 1), F.col(t)).alias("y"))
        judged_before = out.select("doc_id", "host", "path", p(F.col(t)).alias("p")).join(broadcast_if_small(told), F.col("doc_id") == F.col("__id"))
        out = _shifted(out, posteriors(judged_before, "y", "p"), t)
    final = out.select("doc_id", "text_hash", p(F.col("quality")).alias("p_quality"), p(F.col("toxic")).alias("p_toxic"))
    return final.withColumn("rejected", (F.col("p_quality") < threshold) | (F.col("p_toxic") >= toxic_threshold))
