import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import queries, suffixes


def brute(texts, length):
    where = {}
    raw = [(t or "").encode() for t in texts]
    for d, x in enumerate(raw):
        for i in range(len(x) - length + 1):
            where.setdefault(x[i : i + length], []).append((d, i))
    gone = [np.zeros(len(x), dtype=bool) for x in raw]
    for at in where.values():
        if len(at) > 1:
            for d, i in at:
                gone[d][i : i + length] = True
    return [(len(x), int(g.sum()), len(suffixes.runs(g)[0]), hashlib.sha256(bytes(np.frombuffer(x, dtype=np.uint8)[~g])).hexdigest()) for x, g in zip(raw, gone, strict=True)]


@pytest.mark.parametrize("seed", range(30))
def test_two_stage_sorting_marks_repeated_windows(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab\x00" if seed % 2 else b"abc") for _ in range(rng.randrange(6, 60))) for _ in range(6)] + [b"a" * 20, b"ab" * 9, b"cba" * 7]
    count = {}
    for t in texts:
        for i in range(len(t) - 5):
            count[t[i : i + 6]] = count.get(t[i : i + 6], 0) + 1
    assert [x.tolist() for x in suffixes.repeated_windows(texts, 6)] == [[count[t[i : i + 6]] > 1 for i in range(len(t) - 5)] for t in texts]


@pytest.mark.parametrize("most", [256, 2])
def test_repeated_passages(spark, most, monkeypatch):
    monkeypatch.setattr(suffixes.repeated_spans, "__defaults__", (*suffixes.repeated_spans.__defaults__[:-1], most))
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    shared = [text(rng.randrange(90, 260)) for _ in range(4)]
    texts = [text(rng.randrange(0, 300)) + (rng.choice(shared) if rng.random() < 0.7 else "") + text(rng.randrange(0, 300)) for _ in range(60)]
    texts += [texts[0], texts[1], None, "", "x" * 500, "xy" * 300, "short", text(300) * 2, texts[5][:-1] + "!", texts[5][:150] + "Z" + texts[5][150:]]
    texts += [text(40) + shared[1] + text(40) for _ in range(30)]
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("key", F.lit("x"))
    got = suffixes.drop_repeated_passages(t, length=100).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept")).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, 100)
    places = suffixes.drop_repeated_passages(t, length=100).select("doc_id", "n_removed", "n_spans", "kept", "removed").collect()
    for r in places:
        raw = (texts[r.doc_id] or "").encode()
        kept = b"".join(raw[a : x.a] for a, x in zip([0, *(x.b for x in r.removed)], r.removed, strict=False)) + raw[r.removed[-1].b if r.removed else 0 :]
        assert bytes(r.kept) == kept and sum(x.b - x.a for x in r.removed) == r.n_removed and len(r.removed) == r.n_spans
    assert suffixes.drop_repeated_passages(t.limit(0)).count() == 0
    twins = spark.createDataFrame([(None, "q" * 450), (None, "q" * 450)], "doc_id long, text string")
    assert [(r.doc_id, r.n_removed) for r in suffixes.drop_repeated_passages(twins).collect()] == [(None, 450)] * 2


def test_long_texts_are_cut_into_slabs(monkeypatch):
    monkeypatch.setattr(suffixes, "SLAB", 64)
    rng = random.Random(9)
    data = bytes(rng.choice(b"abcd") for _ in range(1000))
    rolling = suffixes.Rolling(64 + 40, suffixes.BASES[0])
    found = list(suffixes.segments(data, 40, rolling))
    assert sorted(i for s, n, *_ in found for i in range(s, s + n)) == list(range(961))


@pytest.mark.parametrize("seed", range(4))
def test_direct_sorting_and_common_prefixes(seed):
    rng = random.Random(seed)
    data = bytes(rng.choice(b"ab" if seed % 2 else b"abcdefgh") for _ in range(300)) + b"a" * 60 + b"abcdefghi" * 9
    c, padded = np.frombuffer(data, dtype=np.uint8), data + bytes(40)
    for length in (5, 8, 21, 40):
        order = suffixes.sorted_directly(c, np.arange(len(data)), length)
        keys = [padded[i : i + length] for i in order]
        assert keys == sorted(padded[i : i + length] for i in range(len(data)))
        shared = [next((k for k in range(length) if max(i, j) + k >= len(data) or data[i + k] != data[j + k]), length) for i, j in zip(order, order[1:], strict=False)]
        assert suffixes.common_prefixes(c, order, length).tolist() == shared
        some = np.random.default_rng(seed).permutation(order)[: len(order) // 2]
        shared = [next((k for k in range(length) if max(i, j) + k >= len(data) or data[i + k] != data[j + k]), length) for i, j in zip(some, some[1:], strict=False)]
        assert suffixes.common_prefixes(c, some, length).tolist() == shared


def test_passages_of_crowds_are_sorted_in_groups(spark):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    hot, near = text(150), text(95)
    ends = [text(20) for _ in range(9)]
    # one passage in 900 documents with different ends, one just too short to repeat but for some of its ends
    texts = [text(30) + hot[rng.randrange(40) :] + rng.choice(ends) + text(50) for _ in range(900)] + [text(60) + near + rng.choice(ends)[: rng.randrange(3, 20)] for _ in range(700)]
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixes.drop_repeated_passages(t, length=100).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept")).orderBy("doc_id").collect()
    want = brute(texts, 100)
    assert [tuple(r)[1:] for r in got] == want and sum(n > 0 for _, n, *_ in want) > 1200


def test_the_query_shows_the_text_that_stays(spark, tmp_path):
    rng = random.Random(11)
    text = lambda n, of="abcdefgh é": "".join(rng.choice(of) for _ in range(n))
    passage, odd = text(450), text(300, "é")
    # of the last two's second characters the last byte repeats, the first doesn't
    texts = [text(80) + passage + text(80), passage + text(30), text(500), None, "", "x" * 450, "x" * 450, "a\u0169" + odd + "b", "a\u0129" + odd + "c"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_suffix_array_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute(texts, 400)
    for r, t in zip(got, texts, strict=True):
        raw = (t or "").encode()
        kept = b"".join(raw[a : x.a] for a, x in zip([0, *(x.b for x in r.removed)], r.removed, strict=False)) + raw[r.removed[-1].b if r.removed else 0 :]
        assert r.kept_text == kept.decode(errors="replace") and r.kept_bytes == len(kept)
    assert got[2].kept_text == texts[2] and passage not in got[0].kept_text and [r.kept_text for r in got[3:]] == ["", "", "", "", "a\ufffdb", "a\ufffdc"]
