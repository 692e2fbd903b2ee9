"""Every stage of the pipeline against brute force on small tables, and all of them together."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionlake.llm import decontam, simhash
from sessionlake.llm.common import scratch, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def kept(df):
    assert df.columns == corpus_pipeline.COLUMNS
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlaps(text, item, window=20, similarity=0.8):
    """Whether some window of an item's tokens, all of a shorter item, agrees with as many tokens of the text."""
    t, n = tokens(text), len(tokens(item))
    item, width = tokens(item), min(window, n)
    need = -(-width * 8 // 10)
    return n > 0 and any(sum(0 <= a + s + k < len(t) and t[a + s + k] == item[s + k] for k in range(width)) >= need for a in range(-n + 1, len(t)) for s in range(n - width + 1))


def test_all_overlaps_are_those_of_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 20, 24, 33])))) for k in range(12)]
    docs = []
    for k in range(80):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if k % 2:
            planted = rng.choice(items)[1].split()
            a = rng.randrange(len(planted))
            planted = planted[a // 2 :]
            for p in range(len(planted)):
                planted[p] = "zz" if rng.random() < 0.15 else planted[p]
            text[10:10] = planted
        docs.append((k, " ".join(text)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(d, b).collect()}
    want = {(i, j) for i, t in docs for j, x in items if overlaps(t, x)}
    assert got == want and len(want) > 15


def test_lines_of_the_stage(spark):
    long = [f"This line is long enough to be counted, number {k}" for k in range(4)]
    rows = [(k, "\n".join([long[k % 2], "own", long[2].upper() if k < 3 else long[3]]), "s") for k in range(12)] + [(None, long[0], "s"), (50, None, "s"), (51, "", "s")]
    where = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(line.strip()) >= 40:
                where.setdefault(line.strip().lower(), set()).add(i)
    gone = lambda i, line: i is not None and len(where.get(line.strip().lower(), ())) >= 5 and max(where[line.strip().lower()]) != i
    want = [(i, t if t is None else "\n".join(x for x in t.split("\n") if not gone(i, x))) for i, t, _ in rows]
    got = corpus_pipeline.drop_lines(spark, table(spark, rows).withColumn("kept_text", F.lit("clash")), "")
    assert kept(got) == sorted(want, key=repr) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())


def test_clean_stage_and_near_copies(spark, tmp_path):
    rng = random.Random(3)
    item = " ".join(f"i{k}" for k in range(25))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "a b " + item.upper(), "s"), (2, item[:30], "s"), (3, None, "s"), (None, item, "s"), (4, "", "s")]
    got = corpus_pipeline.decontaminate(spark, table(spark, rows).withColumn("item_id", F.lit(1)), str(tmp_path))
    assert kept(got) == sorted([(2, item[:30]), (3, None), (None, item), (4, "")], key=repr)
    # candidate search of near copies at exactly the similarity of the stage
    pairs, docs = [], []
    for k in range(250):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 160))]
        extra = (len(base) - 4) // 4
        docs += [(2 * k, " ".join(base), "s"), (2 * k + 1, " ".join(base + [f"x{rng.randrange(10**6)}" for _ in range(extra)]), "s")]
        n = len(base) - 4
        pairs.append((2 * k, n / (n + extra) >= 0.8))
    found = {r.doc_id: r.component_id for r in simhash.verified_duplicates(table(spark, docs)).collect()}
    near = [a for a, is_near in pairs if is_near]
    assert len(near) > 200 and sum(found[a + 1] == a for a in near) >= 0.98 * len(near) and all(found[a + 1] == a + 1 for a, is_near in pairs if not is_near)


def test_quality_stage(spark, tmp_path):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(40)) + "."
    rows = [(k, good() if k % 3 else good().upper().replace(" ", "!!! "), f"s{k % 2}") for k in range(300)] + [(400, None, None), (None, good(), "s0"), (401, "", "s1")]
    labels = [(k, int(k % 3 > 0), 0) for k in range(300) if k % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = kept(corpus_pipeline.keep_good(spark, table(spark, rows).withColumn("rejected", F.lit(True)), str(tmp_path)))
    ids = {i for i, _ in got}
    assert sum(k in ids for k in range(0, 300, 3)) <= 2 and sum(k in ids for k in range(300) if k % 3) >= 198 and None in ids
    assert kept(corpus_pipeline.keep_good(spark, table(spark, rows).limit(0), str(tmp_path))) == []


@pytest.mark.parametrize("empty", [False, True])
def test_all_stages(spark, tmp_path, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(5)
    item = " ".join(f"i{k}" for k in range(25))
    rows = [(k, " ".join(f"w{rng.randrange(10**4)}" for _ in range(60)), "s") for k in range(30)]
    rows += [(100, rows[0][1], "s"), (101, item + " end", "s"), (102, None, None)]
    if empty:
        rows = []
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 30, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows if i not in (100, 101)}
    assert {r.doc_id for r in got} == want.keys() and sum(r.length for r in got) == sum(map(len, want.values()))
    for r in got:
        own = want[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))


def test_what_a_scope_stored_is_deleted(spark):
    with scratch(spark):
        t = stored(spark.range(5))
        path = t.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert t.count() == 5
    import os

    assert not os.path.exists(path)
