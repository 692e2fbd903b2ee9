"""Assigned calls against brute force, and cited lines against a count for each line."""

import random
from itertools import groupby

from pyspark.sql import functions as F

from sessionlake.operators import assignment, coverage

SIDES = "session_id string, {} int, tool_ids array<string>, text string"


def brute(messages, calls):
    out = []
    for s in sorted({x[0] for x in messages + calls}, key=repr):
        own, used = sorted(c for c in calls if c[0] == s), set()
        ids = lambda x: {i for i in x[2] or [] if i}
        for m in sorted(m for m in messages if m[0] == s):
            free = [c for c in own if c[1] not in used]
            found = [c for c in free if ids(m) and ids(c) == ids(m)]
            rule = "TOOLS"
            if not ids(m):
                found, rule = [c for c in free if not ids(c) and (c[3] or "") == (m[3] or "")], "TEXT"
            if not found:
                found, rule = free, "NEXT"
            if found:
                used.add(found[0][1])
            out.append((s, m[1], found[0][1] if found else None, rule if found else None))
        out += [(s, None, c[1], None) for c in own if c[1] not in used]
    return sorted(out, key=repr)


def test_assignment_equals_brute_force(spark):
    rng = random.Random(2)
    side = lambda s: [(s, n, rng.choice([None, [], ["a"], ["a", "b", "a"], ["b", "a"], ["", None], ["c"]]), rng.choice(["x", "y", "", None])) for n in rng.sample(range(50), rng.randrange(12))]
    messages, calls = ([x for s in range(80) for x in side(f"s{s}")] for _ in range(2))
    many = [("hot", n, ["a"] if n % 3 else None, "x") for n in range(30000)]
    m = spark.createDataFrame(messages + many, SIDES.format("pos")).withColumn("rule", F.lit(1)).repartition(5)
    c = spark.createDataFrame(calls + many[::2], SIDES.format("call_no")).withColumn("tools", F.lit(1)).repartition(3)
    got = assignment.assigned_calls(m, c)
    found = [tuple(r) for r in got.where("session_id <> 'hot'").collect()]
    assert sorted(found, key=repr) == brute(messages, calls)
    hot = got.where("session_id = 'hot'").agg(F.count("call_no"), F.count_distinct("call_no"), F.count("pos")).first()
    assert tuple(hot) == (15000, 15000, 30000)
    assert assignment.assigned_calls(m.limit(0), c.limit(0)).count() == 0


def test_lines_equal_a_count_for_each(spark):
    rng = random.Random(3)
    returns = [(r, rng.choice([0, 1, 7, 40])) for r in range(60)] + [(None, 5)]
    ranges = [(rng.choice([None, *range(62)]), rng.choice([None, rng.randrange(-1, 42)]), rng.choice([None, rng.randrange(-1, 42)])) for _ in range(300)]
    ranges += ranges[:40]
    size, times = dict(returns), {r: [0] * n for r, n in returns}
    wrong = []
    for r, first, last in ranges:
        first, n = 1 if first is None else first, size.get(r) if r is not None else None
        end = n if last is None else last
        if n is None or not (1 <= first <= end <= n or (n == 0 and first == 1 and end == 0)):
            wrong.append((r, first, last, "RETURN_UNKNOWN" if n is None else "OUT_OF_BOUNDS"))
            continue
        for line in range(first, end + 1):
            times[r][line - 1] += 1
    want = []
    for r, own in times.items():
        if r is not None:
            for t, run in groupby(enumerate(own, 1), key=lambda x: x[1]):
                run = [x for x, _ in run]
                want += [(r, run[0], run[-1], t)] if t != 1 else []
    a = spark.createDataFrame(returns, "return_id int, line_count int").withColumn("at", F.lit(1))
    b = spark.createDataFrame(ranges, "return_id int, first int, last int").withColumn("part", F.lit("x"))
    for stretch in (4, coverage.STRETCH):
        assert sorted(tuple(r) for r in coverage.uneven_lines(a, b, stretch=stretch).collect()) == sorted(want)
    assert sorted(map(repr, map(tuple, coverage.range_errors(a, b).collect()))) == sorted(map(repr, wrong))
    assert coverage.uneven_lines(a.limit(0), b).count() == coverage.range_errors(a, b.limit(0)).count() == 0


def test_a_billion_lines_are_a_few_rows(spark):
    n = 10**9
    a = spark.createDataFrame([("r", n)], "return_id string, line_count long")
    b = spark.createDataFrame([("r", 1, 400_000_000), ("r", 400_000_001, 500_000_000), ("r", 450_000_000, 460_000_000), ("r", 700_000_000, None)], "return_id string, first long, last long")
    assert sorted(tuple(r) for r in coverage.uneven_lines(a, b).collect()) == [("r", 450_000_000, 460_000_000, 2), ("r", 500_000_001, 699_999_999, 0)]


def test_a_sweep_sorts_ends_once(spark):
    from sessionlake.operators import coverage

    a, b = spark.createDataFrame([("r", 60)], "return_id string, line_count long"), spark.createDataFrame([("r", 1, 40), ("r", 30, 60)], "return_id string, first long, last long")
    got = coverage.uneven_lines(a, b, stretch=16)
    assert [tuple(r) for r in got.collect()] == [("r", 30, 40, 2)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # sizes meet the ranges alone, in either use of the ends; the sweep meets its stretches
    assert plan.count("Join Inner") == 3
