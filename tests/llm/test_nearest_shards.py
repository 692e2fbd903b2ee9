"""Shards that a query's bound rules out aren't searched; what is found stays exact."""

import numpy as np
from pyspark.sql import functions as F

from sessionlake.llm import vptree


def test_pruned_search_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    v = centres[rng.integers(12, size=3000)] + 0.05 * rng.normal(size=(3000, 24))
    v[1000:2000] = v[7]  # a third of all rows
    t = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    asked = t.where("vec_id % 50 = 0")
    sent = {}
    real = vptree.allowed

    def counting(asked_rows, shards, factor):
        out = real(asked_rows, shards, factor)
        sent.update(pairs=out.count(), all=asked_rows.count() * (shards.count() - 1))
        return out

    monkeypatch.setattr(vptree, "allowed", counting)
    got = vptree.nearest(t, asked, shard_rows=120, block_rows=16).collect()
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in range(0, 3000, 50):
        s = unit @ unit[q]
        want = [i for _, i in sorted((-round(float(x), 12), i) for i, x in enumerate(s) if i != q)[:5]]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want
    assert len(got) == 300 and 0 < sent["pairs"] < 0.25 * sent["all"], sent


def test_few_vectors_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (100, [0.0, 3.0]), (150, [1.0]), (200, [1.0, 1.0, 1.0]), (201, [1.0, 1.0, 2.0])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in vptree.nearest(t, t.where("vec_id % 50 = 0")).collect()}
    assert got == {(0, 1): 50, (0, 2): 100, (50, 1): 0, (50, 2): 100, (100, 1): 0, (100, 2): 50, (200, 1): 201}


def test_trees_are_copied_once_for_a_shard_and_block(spark, monkeypatch):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(900, 8))
    t = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    counts = []
    real = vptree.blocks_of

    def counting(asked, block_rows):
        out = real(asked, block_rows)
        counts.append((asked.count(), asked.select("shard").distinct().count(), out.agg(F.sum("blocks")).first()[0], block_rows))
        return out

    monkeypatch.setattr(vptree, "blocks_of", counting)
    assert vptree.nearest(t, t.where("vec_id % 3 = 0"), shard_rows=60, block_rows=20).count() == 1500
    assert len(counts) == 2 and all(copies <= shards + asked / rows for asked, shards, copies, rows in counts), counts
