"""Operator 11 against plain Python: every order, with copies, weak hashes, nulls, long texts and repeated rows."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from sessionlake.llm import audit


def plain(rows, labels):
    """{(part, order, step): counts} of (doc_id, text, lang) rows, by applying every order to every row."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, shapley = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        text, part = text or "", lang or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > least[text]}
        for order in permutations("ABCDE"):
            alive = True
            for step, f in enumerate(order, 1):
                c = out[part, "".join(order), step]
                c["redundant"] += fails[f] and not alive
                c["unique_fails"] += fails[f] and sum(fails.values()) == 1
                if alive and fails[f]:
                    alive = False
                    c["removed"] += 1
                    c["good_lost"] += i in good
                    c["toxic_lost"] += i in toxic
                    shapley[part, f] += 1
                c["kept"] += alive
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return {k: (*(c[n] for n in names), shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


def texts(rng):
    word = lambda: f"w{rng.randrange(3000)}"
    made = ["", None, " \n", "A B C", "$ only", "é" * 300, " ".join(["same"] * 150)]
    made += [" ".join(word() for _ in range(rng.choice([50, 99, 100, 130, 700]))) + rng.choice(["", " #", " ABCDEFGH" * 9]) for _ in range(25)]
    long = " ".join(word() for _ in range(9000))
    return made + [long, long[:-1] + "!", "x" * 128 + "a" * 1920, "x" * 128 + "b" * 1920]


@pytest.mark.parametrize("bits", [64, 2])
def test_every_order_equals_plain_python(spark, bits):
    rng = random.Random(3)
    pool = texts(rng)
    rows = [(rng.choice([None, *range(60)] if k % 9 == 0 else range(60)), rng.choice(pool), rng.choice(["en", "de", "", None])) for k in range(200)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(40)] + [(1, 1, 1), (1, 0, 0), (None, 1, 1), (999, 1, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"class": F.lit(1), "mask": F.lit("x"), "good": F.lit(2), "n": F.lit(0)})
    found = audit.audited(d.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(9)), bits=bits).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert got == plain(rows, labels) and len(found) == len(got) == 3 * 600


def test_refinement_drops_what_stands_alone(spark):
    rows = [(1, "a" * 5000), (2, "a" * 4999 + "b"), (3, "a" * 5000), (4, "c" * 5000), (5, "unlike"), (6, None), (7, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in audit.failures(d).collect() if r.mask & 16} == {3, 7}
    assert audit.failures(d).columns == ["doc_id", "part", "mask"]


def test_empty_tables_give_no_rows_and_no_labels_no_losses(spark):
    d = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audited(d.limit(0), none).count() == 0
    got = audit.audited(d, none).collect()
    assert len(got) == 600 and not any(r.good_lost or r.toxic_lost for r in got)
