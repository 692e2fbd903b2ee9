"""Every overlap that the similarity allows is found, whatever the item's length; broadcasts hold numbers only."""

import random
from itertools import combinations

from sessionlake.llm import decontam


def test_short_items_are_found_at_every_allowed_substitution(spark):
    rng = random.Random(3)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in (1, 2, 4, 5, 8, 9, 10, 11, 14, 15, 17, 19, 20)}
    docs, want = [], set()
    for n, item in items.items():
        allowed = n * 2 // 10
        sets = list(combinations(range(n), allowed))
        for gone in rng.sample(sets, 150) if len(sets) > 150 else sets:
            text = ["zz" if k in gone else t for k, t in enumerate(item)]
            want.add((len(docs), n, n - allowed))
            docs.append((len(docs), " ".join(["before"] * rng.randrange(3) + text + ["after"] * rng.randrange(3))))
        docs.append((len(docs), " ".join("zz" if k <= allowed else t for k, t in enumerate(item))))
    # the sets that three masks missed
    item = items[20]
    for gone in combinations(range(20), 4):
        if not any(not set(gone) & {p + s for p in m} for m in decontam.MASKS[:3] for s in range(20 - m[-1])):
            want.add((len(docs), 20, 16))
            docs.append((len(docs), " ".join("zz" if k in gone else t for k, t in enumerate(item))))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.matched) for r in decontam.overlaps(d, b).collect()} == want


def test_a_long_item_is_found_with_small_rows(spark):
    rng = random.Random(4)
    item = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    docs = [(1, " ".join(item)), (2, " ".join(item[5000:5030])), (3, " ".join(item[:15])), (4, "nothing")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.matched, r.compared) for r in decontam.overlaps(d, b, block_rows=15_000).collect()}
    assert got == {(1, 7, 20_000, 20_000), (2, 7, 30, 20_000)}


def test_many_seeds_take_one_pass(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 12, 40])))) for i in range(30)]
    docs = [(k, " ".join([*(word() for _ in range(30)), *items[k % 30][1].split(), *(word() for _ in range(30))])) for k in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/read_once")
    d, b = spark.read.parquet(f"{tmp_path}/read_once"), spark.createDataFrame(items, "item_id long, text string")
    scans = []
    real = decontam.stored

    def counting(df, *more):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("struct<doc_id:bigint,text:string>"))
        return real(df, *more)

    one = sorted(map(tuple, decontam.overlaps(d, b).collect()))
    monkeypatch.setattr(decontam, "stored", counting)
    assert sorted(map(tuple, decontam.overlaps(d, b, block_rows=10).collect())) == one and len(one) > 90
    assert sum(scans) == 1, scans


def test_items_of_few_tokens_may_be_left_out_and_cost_is_told(spark):
    d = spark.createDataFrame([(k, f"the answer is yes number {k}") for k in range(20)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "Yes"), (2, "number 7"), (3, "no")], "item_id long, text string")
    assert {(r.item_id, r.documents) for r in decontam.item_costs(d, b).collect()} == {(1, 20), (2, 1)}
    assert {r.doc_id for r in decontam.clean(d, b, least_tokens=2).collect()} == set(range(20)) - {7}
