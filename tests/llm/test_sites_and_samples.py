"""Posteriors of sites against plain Python, and samples of totals of any size."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import langid, quality
from sessionlake.llm.common import sampled


def plain_shifts(rows):
    """{(host, path): shift} of (host, path, 0 or 1 or None): beta-binomial means, hosts toward all and paths toward hosts."""
    known = [r for r in rows if r[2] is not None]
    m = np.clip(np.mean([y for *_, y in known]), 1e-4, 1 - 1e-4)
    hosts, paths = defaultdict(list), defaultdict(list)
    for h, p, y in known:
        hosts[h].append(y)
        paths[h, p].append(y)

    def strength(groups, toward):
        n = sum(map(len, groups.values()))
        between = sum(len(g) * (np.mean(g) - toward[k]) ** 2 for k, g in groups.items())
        spread = (between - (len(groups) - 1) * m * (1 - m)) / n
        return float(np.clip(m * (1 - m) / spread - 1, 1, 1e6)) if spread > 0 else 1e6

    k = strength(hosts, dict.fromkeys(hosts, m))
    mean = {h: (sum(g) + k * m) / (len(g) + k) for h, g in hosts.items()}
    k = strength(paths, {(h, p): mean[h] for h, p in paths})
    odds = lambda x: float(np.log(np.clip(x, 1e-4, 1 - 1e-4) / (1 - np.clip(x, 1e-4, 1 - 1e-4))))
    return {key: odds((sum(g) + k * mean[key[0]]) / (len(g) + k)) - odds(m) for key, g in paths.items()}


def site_rows():
    rng = random.Random(6)
    rates = {"good": 0.95, "bad": 0.1, "mixed": 0.5, **{f"s{i}": 0.8 for i in range(8)}}
    rows = [(h, f"p{rng.randrange(3)}", int(rng.random() < rate)) for h, rate in rates.items() for _ in range(120)]
    return [*rows, ("tiny", "p", 0), (None, None, 1), (None, "p", 0), ("good", "p0", None)]


def test_posteriors_shrink_as_in_plain_python(spark):
    rows = site_rows()
    t = spark.createDataFrame(rows, "host string, path string, y int")
    got = {(r.host, r.path): r["shift"] for r in quality.posteriors(t, "y").collect()}
    want = plain_shifts(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert abs(got["tiny", "p"]) < abs(got["bad", "p0"]) and got["good", "p0"] > 0 > got["bad", "p0"]
    # evidence that already expects the labels leaves nothing to shift
    same = t.where("y is not null").withColumn("e", F.col("y").cast("double"))
    assert all(abs(r["shift"]) < 1e-9 for r in quality.posteriors(same, "y", "e").collect())


def test_sites_move_decisions_where_words_tell_nothing(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1200):
        host = ("fine", "foul", "even")[i % 3]
        y = int(rng.random() < {"fine": 0.97, "foul": 0.08, "even": 0.8}[host])
        rows.append((i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30)), host, "en"))
        labels.append((i, y, 0)) if i % 4 else None
    rows += [(5000, "alpha beta gamma", "sparse", "en"), (5001, "alpha beta", None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in quality.judged(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    share = lambda k: np.mean([got[i].rejected for i in range(k, 1200, 3)])
    assert share(0) < 0.1 and share(1) > 0.9 and share(2) < 0.2
    assert not got[5000].rejected and not got[5001].rejected


def test_samples_of_totals_of_any_size(spark):
    ids = spark.range(200_000)
    assert abs(ids.where(sampled(F.col("id"), 10, 100)).count() - 20_000) < 600
    assert abs(ids.where(sampled(F.col("id"), 6_000, 6 * 10**9 * 100)).count()) == 0 and ids.where(sampled(F.col("id"), 5, 5)).count() == 200_000
    # 64 bits: a quota of 6,000 of 10^13 documents still draws rows
    share = (6_000 << 64) // 10**13
    assert share > 10**10 and ids.where(sampled(F.col("id"), 10**9, 10**13)).count() in range(3, 60)


def test_a_rare_language_is_learnt_and_held_out_rows_are_right(spark):
    rng = random.Random(1)
    kinds = {"aa": ["the", "and", "thing", "over"], "bb": ["der", "und", "schön", "über"], "cc": ["kala", "vesi", "puu", "talo"]}
    of = lambda i: "cc" if i % 200 == 7 else ("aa", "bb")[i % 2]
    rows = [(i, " ".join(rng.choice(kinds[of(i)]) for _ in range(30)), of(i)) for i in range(4000)]
    rows.append((9000, "kala vesi " * 100_000, None))
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_docs=90).collect()}
    held = [i for i, _, _ in rows[:4000] if got[i].held_out]
    assert len(held) > 800 and sum(of(i) == "cc" for i in held) >= 2
    assert all(got[i].lang_pred == of(i) for i in held) and got[9000].lang_pred == "cc"
