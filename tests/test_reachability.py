"""What files need against a plain search, names against paths, listings."""

import random

from pyspark.sql import functions as F

from sessionlake.operators import reachability


def test_needed_files_equal_a_plain_search(spark):
    rng = random.Random(9)
    files = [(w, f"f{k}") for w in range(12) for k in range(15)] + [(99, "a"), (None, "x"), (1, None)]
    refs = [(w, f"f{rng.randrange(15)}", f"r{n}", [None, "none", f"f{rng.randrange(18)}", f"f{rng.randrange(15)}"][: rng.randrange(5)]) for w in range(12) for n in range(22)]
    refs += [(None, "x", "r", ["x"]), (1, None, "r", ["f1"]), (2, "f1", "empty", None)]
    entries = [(w, f"f{k}") for w in range(12) for k in range(3)] * 2 + [(99, "a"), (None, "x"), (1, None), (3, "gone")]
    f = spark.createDataFrame(files, "workspace_id int, path string").withColumn("target", F.lit(1))
    r = spark.createDataFrame(refs, "workspace_id int, path string, reference string, candidates array<string>").withColumn("_p", F.lit(1))
    found = reachability.resolved_references(r, f)
    there = set(files)
    want = {(w, p, x): next((c for c in cs or [] if c is not None and (w, c) in there and None not in (w, p)), None) for w, p, x, cs in refs}
    assert {(x.workspace_id, x.path, x.reference): x.target for x in found.collect()} == want
    edges = {}
    for (w, p, _), target in want.items():
        if None not in (w, p, target):
            edges.setdefault((w, p), set()).add(target)
    reached, lost = set(), set()
    for w, e in set(entries):
        if w is None or e is None:
            continue
        depth, last = {e: 0}, [e]
        while last:
            last = [t for t in {t for p in last for t in edges.get((w, p), ())} if t not in depth]
            depth.update(dict.fromkeys(last, max(depth.values()) + 1))
        reached |= {(w, e, p, d) for p, d in depth.items()}
        lost |= {(w, e, p, x) for (v, p, x), t in want.items() if v == w and p in depth and t is None}
    needed = reachability.needed_files(spark.createDataFrame(entries, "workspace_id int, path string").withColumn("entry", F.lit(0)), found)
    assert sorted(tuple(x) for x in needed.collect()) == sorted(reached)
    assert sorted(tuple(x) for x in reachability.open_references(needed, found).collect()) == sorted(lost)
    assert reachability.needed_files(f.limit(0), found).count() == 0


def test_a_hub_of_many_references(spark):
    refs = spark.range(300_000).selectExpr("1 AS workspace_id", "'hub' AS path", "concat('f', id) AS target").union(spark.range(300_000).selectExpr("1", "concat('f', id)", "'hub'"))
    needed = reachability.needed_files(spark.createDataFrame([(1, "hub"), (1, "f7")], "workspace_id int, path string"), refs)
    assert {(r.entry, r.depth): r.n for r in needed.groupBy("entry", "depth").agg(F.count("*").alias("n")).collect()} == {("hub", 0): 1, ("hub", 1): 300_000, ("f7", 0): 1, ("f7", 1): 1, ("f7", 2): 299_999}


def test_places_of_modules(spark):
    rows = [("a/b/c.py", "x.y", 0), ("a/b/c.py", "x", 1), ("a/b/c.py", "", 2), ("a/b/c.py", "x", 4), ("c.py", "x", 0)]
    t = spark.createDataFrame(rows, "path string, module string, level int")
    got = [r.c for r in t.select(reachability.module_candidates(F.col("path"), F.col("module"), F.col("level")).alias("c")).collect()]
    assert got == [["a/b/x/y.py", "a/b/x/y/__init__.py", "a/x/y.py", "a/x/y/__init__.py", "x/y.py", "x/y/__init__.py"], ["a/b/x.py", "a/b/x/__init__.py"], ["a/__init__.py"], [], ["x.py", "x/__init__.py"]]


def test_names_fit_no_path_one_or_many(spark):
    paths = [(1, p) for p in ("a/x.py", "b/x.py", "b/c/x.py", "y", "a/bx.py", "a/x.py")] + [(2, "a/x.py"), (None, "z"), (1, None)]
    names = [(1, n) for n in ("x.py", "b/x.py", "c/x.py", "a/x.py", "y", "bx.py", "/y", "q", "", None, "d/b/c/x.py")] + [(2, "x.py"), (3, "x.py"), (1, "x.py")]
    found = reachability.name_index(spark.createDataFrame(names, "workspace_id int, name string"), spark.createDataFrame(paths, "workspace_id int, path string"))
    want = {(w, n): [p for v, p in set(paths) if v == w and p is not None and f"/{p}".endswith(f"/{n}")] for w, n in names if n}
    want[1, "/y"] = []
    assert {(r.workspace_id, r.name): (r.paths_found, r.path) for r in found.collect()} == {k: (len(v), v[0] if len(v) == 1 else None) for k, v in want.items()}


def test_listings(spark):
    text = "src/:\ntotal 8\ndrwxr-xr-x  2 u g 4096 Jan  1 10:00 sub dir\r\n-rw-r--r--@ 1 u g 12 2024-01-01 10:00 a.py\nlrwxrwxrwx 1 u g 3 Jan 1 2024 l -> a.py\n\n./lib:\n.\n..\nb.py\nc/\nb.py"
    t = spark.createDataFrame([(1, 1, "top", text), (1, 2, None, "x y\n"), (1, 3, "t", None)], "workspace_id int, event_id int, folder string, text string")
    got = {(r.event_id, r.folder, r.name, r.is_folder) for r in reachability.listed_names(t).collect()}
    assert got == {(1, "src", "sub dir", True), (1, "src", "a.py", False), (1, "src", "l", False), (1, "lib", "b.py", False), (1, "lib", "c", True), (2, "", "x y", False)}
