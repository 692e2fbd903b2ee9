"""Operator 12 against brute force: whole components and kept rows, with crowded lists, short and long texts, nulls and repeats."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sessionlake.llm import minhash


def shingles(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows):
    """{row index: smallest id reachable} and the sets."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [least.get(root(k)) if sets[k] else rows[k][0] for k in range(len(rows))], sets


def corpus(rng):
    word = lambda: f"w{rng.randrange(900)}"
    shared = [word() for _ in range(70)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "a b c d"), (7, "a b c d e"), (None, "a b c d e"), (None, "unlike all others of these"), (6, "a b c d")]
    for d in range(10, 150):
        base = [word() for _ in range(rng.choice([6, 12, 40, 120, 400]))]
        base[3:3] = shared if d % 3 == 0 else []
        for copy in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(rng.randrange(1 + len(text) // 14)):
                text[rng.randrange(len(text))] = word()
            rows.append((d * 10 + copy, " ".join(text).upper() if copy == 1 else "\t".join(text)))
    many = [word() for _ in range(300)]
    for k in range(120):
        text = list(many)
        for _ in range(k % 25):
            text[rng.randrange(300)] = word()
        rows.append((5000 + k, " ".join(text)))
    long = [word() for _ in range(20000)]
    return rows + [(9000, " ".join(long)), (9001, " ".join([*long[:15000], "x", *long[15001:]]))]


@pytest.mark.parametrize("block, hashes", [(minhash.BLOCK, minhash.HASHES), (7, 5000)])
def test_components_equal_brute_force(spark, block, hashes):
    rows = corpus(random.Random(12))
    expected, sets = brute(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "n": F.lit("x"), "value": F.lit(None).cast("long")})
    found = minhash.near_duplicates(d.repartition(6), block=block, hashes=hashes).collect()
    want = sorted((str(i), len(s), str(c), i == c) for (i, _), s, c in zip(rows, sets, expected, strict=True))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found) == want


def test_links_at_exactly_the_bound_are_found(spark):
    # another last word: 8 of 10 shingles in common, then 7 of 9
    a, b = [f"a{k}" for k in range(12)], [f"b{k}" for k in range(11)]
    rows = [(1, " ".join(a)), (2, " ".join([*a[:11], "x"])), (3, " ".join(b)), (4, " ".join([*b[:10], "x"]))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_rare_values_leave_out_lists_of_common_ones(spark):
    # ten nodes share three values alone, too few for a link: they are in no list; two more share four
    rows = [(k, 40, [1, 2, 3, *range(100 * k + 100, 100 * k + 113)]) for k in range(10)] + [(k, 40, [4, 5, 6, 7, *range(5000 + 100 * k, 5000 + 100 * k + 12)]) for k in (20, 21)]
    nodes = spark.createDataFrame(rows, "node long, n int, sketch array<long>")
    assert sorted((r.value, r.node) for r in minhash.inverted_lists(nodes).collect()) == [(4, 20), (4, 21)]


def test_kept_documents_and_empty_tables(spark):
    rows = [(3, "the same few words again"), (2, "the same few words again"), (1, None), (9, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    kept = minhash.kept_documents(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 9]
    assert minhash.near_duplicates(d.limit(0)).count() == 0
