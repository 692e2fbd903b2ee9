"""Operator 13 against brute force in whole numbers: ties, equal vectors, other lengths, huge and unusable rows, many cells and small blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sessionlake.llm import voronoi


def brute(rows, anchor, positives=5, negatives=10, low=30, high=90):
    usable = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, label, tuple(math.floor(256 * x) for x in v))
        if row not in usable:
            usable.append(row)
    out = []
    for i, label, v in usable:
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), k, other == label) for k, other, w in usable if k != i and len(w) == len(v))
        for p, j, _ in [x for x in scored if x[2]][:positives]:
            found = [(s, k) for s, k, same in scored if not same and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(found, 1)]
    return sorted(out)


def made(rng, n, dim=6):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(centres)], rng.randrange(4)) for i in range(n)]
    rows += [(1000 + i, [0.5, 0.25, 0.0, -1.0, 1.0, 0.5], rng.randrange(4)) for i in range(60)]  # equal vectors, ties
    rows += [(2000 + i, [0.0] * dim, 1) for i in range(12)] + [(2100 + i, [rng.random() for _ in range(3)], i % 3) for i in range(30)]
    return rows + [(3000, None, 1), (3010, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (3020, [float("nan")] * dim, 1), (3030, [1.0] * dim, None), (3040, [float("inf")] * dim, 2), (None, [1.0] * dim, 1), (3050, [], 1), (3060, [], 2), rows[3], rows[3]]


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("how", [{}, {"cell_anchors": 3, "block": 25, "part": 4}])
def test_negatives_equal_brute_force(spark, how):
    rows = made(random.Random(5), 260)
    d = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "v": F.lit("x"), "rank": F.lit(0)})
    found = voronoi.hard_negatives(d.repartition(5), F.col("id") % 10 == 0, **how).collect()
    assert sorted(map(tuple, found)) == brute(rows, lambda i: i % 10 == 0)


def test_huge_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e7, 3e7, -2e7]) + rng.random() for _ in range(3)], i % 3) for i in range(40)] + [(50, [float(2**40)] * 3, 1), (60, [2.0**40, 2.0**39, 1.0], 2)]
    found = voronoi.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, cell_anchors=2).collect()
    top = 2**63 - 1
    want = [(*x[:4], min(x[4], top), min(x[5], top)) for x in brute(rows, lambda i: i % 10 == 0 and i < 50)]
    assert sorted(tuple(r) for r in found if r.anchor_id < 50 and r.positive_score < top) == [x for x in want if x[4] < top]


def test_far_cells_get_no_copies(spark):
    rng = random.Random(7)
    centres = [[60.0 if k == c else 0.0 for k in range(6)] for c in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.5) for x in centres[i % 6]], (i // 6) % 3) for i in range(600)]
    whole = voronoi.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label", 256)
    centre = voronoi.pivots(whole.where("id % 20 = 0"), 6)
    lift = whole.agg(F.max("square")).first()[0]
    placed = voronoi.in_cells(whole, centre, lift)
    spread = {c: placed.where(F.col("own") == c).agg(F.max("far")).first()[0] for c in range(3)}
    reach = {c: (0.5 * spread[c], 0.0, 1.2 * spread[c]) for c in spread}
    copies = voronoi.in_cells(whole, centre, lift, reach).select(F.sum(F.size("cells"))).first()[0]
    assert copies < 600  # of 600 rows and three cells to look from, fewer than a third of all copies


def test_empty_tables_and_lone_rows_give_none(spark):
    d = spark.createDataFrame([(100, [1.0, 0.0], 1), (7, [1.0, 0.0], 2)], SCHEMA)
    assert voronoi.hard_negatives(d.limit(0), F.col("id") % 100 == 0).count() == 0
    assert voronoi.hard_negatives(d, F.col("id") % 100 == 0).count() == 0
    assert voronoi.hard_negatives(d, F.col("id") == 5).count() == 0
