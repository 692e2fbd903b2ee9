"""Operators 1 to 6 against brute force, on small fixtures with nulls, empty tables, ties, repeats and extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import decontam, linededup, packing, simhash, vptree, warc


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_decontamination_finds_planted_overlaps_and_nothing_else(spark):
    rng = random.Random(1)
    items = [(i, " ".join(words(rng, 30))) for i in range(20)] + [(98, "too short"), (99, None), (100, "")]
    docs, expected = [(900, None), (901, ""), (None, "x")], set()
    for d in range(120):
        text = words(rng, 200)
        if d % 3 == 0:
            i = rng.randrange(20)
            planted = items[i][1].upper().split()
            for p in rng.sample(range(30), d % 4):
                planted[p] = "zz"
            text[50:50] = ", ".join(planted).split()
            expected.add((d, i))
        docs.append((d, "\n".join(text)))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.lit("clash")).withColumn("words", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.overlaps(d.union(d), b).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    assert all(r.compared == 30 and r.matched >= 24 for r in found)
    left = decontam.clean(d, b)
    assert left.columns == d.columns and {r.doc_id for r in left.collect()} == {x for x, _ in docs} - {x for x, _ in expected}
    blocks = decontam.overlaps(d, b, block_rows=500).collect()
    assert {(r.doc_id, r.item_id) for r in blocks} == expected
    assert decontam.overlaps(d.limit(0), b).count() == 0 and decontam.overlaps(d, b.limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    html = ["<p>" + "a" * 200, "short", None, "", "<p>é" * 60, "<b>\r\n\r\n</b>" * 30]
    rows = [(i, f"http://h/{i}", html[i % 6]) for i in range(60)] + [(None, None, html[0]), (3, "http://h/3", html[3]), (0, "http://h/0", html[0])]
    t = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    folder, got = warc.archived(t)
    got = got.collect()
    assert len(got) == len(rows) and all(r.problem is None for r in got)
    for r in got:
        payload = (html[r.page_id % 6] if r.page_id is not None else html[0]) or ""
        raw = payload.encode()
        first = r.page_id % 6 if r.page_id is not None else 0
        kind = "revisit" if len(raw) >= 100 and r.page_id != first else "response"
        assert (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) == (kind, first if kind == "revisit" else None, len(raw), hashlib.sha256(raw).hexdigest())
    whole = warc.read_archives(spark, folder)
    assert {bytes(r.payload) for r in whole.where("record_type = 'response'").collect()} == {(h or "").encode() for h in html}
    assert warc.archived(t.limit(0))[1].count() == 0


def test_damaged_archives_are_told(spark, tmp_path):
    rows = [(i, "u", "h", None, hashlib.sha256(b"x" * 300).hexdigest(), b"x" * 300) for i in range(5)]
    t = spark.createDataFrame(rows, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary").withColumn("record_type", F.lit("response"))
    warc.write_archives(t.coalesce(1), str(tmp_path / "w"), b"")
    (file,) = (tmp_path / "w").glob("part*")
    data = file.read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut/a").write_bytes(data[: len(data) // 2])
    found = warc.read_archives(spark, str(tmp_path / "cut")).collect()
    assert found[-1].problem.startswith("archive") and all(r.problem is None for r in found[:-1])
    record = warc._record(1, "u", "response", None, hashlib.sha256(b"y").hexdigest(), b"y")
    assert warc.parsed(record)["problem"] is None
    assert "digest" in warc.parsed(record.replace(b"\r\n\r\ny", b"\r\n\r\nz"))["problem"]
    assert "Content-Length" in warc.parsed(record + b"!")["problem"]
    assert warc.parsed(b"junk")["problem"] == "no WARC header"


def brute_cuts(ends, penalties, most):
    at, best = [0, *ends], {0: (0.0, [])}
    for j in range(1, len(at)):
        options = []
        for i in range(j):
            length = at[j] - at[i]
            if length <= most:
                pad = most - length
                if length in (most // 2, most // 4):
                    pad = min(pad, most / 16)
                options.append((best[i][0] + pad + penalties[j - 1], [*best[i][1], j - 1]))
        best[j] = min(options, key=lambda x: x[0])
    return best[len(ends)]


@pytest.mark.parametrize("seed", range(20))
def test_best_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    ends = sorted(rng.sample(range(1, 400), 40))
    ends = sorted({*ends, *range(30, ends[-1], 30)})
    penalties = [rng.choice([0.0, 1.0, 6.0]) for _ in ends]
    chosen = packing.best_cuts(ends, penalties, 64)
    at, cost = [0, *(ends[c] for c in chosen)], 0.0
    for a, b, c in zip(at, at[1:], chosen, strict=False):
        assert b - a <= 64
        cost += (min(64 - (b - a), 4.0) if b - a in (32, 16) else 64 - (b - a)) + penalties[c]
    assert chosen[-1] == len(ends) - 1 and cost == pytest.approx(brute_cuts(ends, penalties, 64)[0])


def test_packing_is_an_exact_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    texts = {i: ". ".join(" ".join(words(rng, rng.randrange(1, 40))) for _ in range(rng.randrange(0, 60))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "x" * 30_000}
    t = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = packing.packed(t.coalesce(2), block_tokens=20_000).collect()
    ids = {i: [*tokenizer.encode(x or "", add_special_tokens=False).ids, 0] for i, x in texts.items()}
    sequences: dict = {}
    for i, own in ids.items():
        pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1]) and sum(r.length for r in pieces) == len(own)
        for r in pieces:
            assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], dtype="<u4").tobytes())
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1])
        total = sum(n for _, n in own)
        assert total <= 1024
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    assert padding < 0.02 * sum(map(len, ids.values())) + 2 * 1024
    null = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r.doc_id for r in packing.packed(null.coalesce(1)).collect()] == [None, None]
    assert packing.packed(t.limit(0)).count() == 0


def test_nearest_is_exact_at_factor_one_and_close_above(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 16)).astype(np.float32)
    v[100:140] = v[0]
    rows = [(i, v[i].tolist()) for i in range(600)] + [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [None] * 16), (None, v[1].tolist()), (5, v[5].tolist()), (800, [1.0, 2.0])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1)).withColumn("id", F.lit("x"))
    asked = t.where("vec_id % 50 = 0")
    d = v.astype(np.float64)
    n = d / np.linalg.norm(d, axis=1, keepdims=True)
    truth = {}
    for q in range(0, 600, 50):
        s = np.array([np.dot(d[q], x) / (np.sqrt(np.dot(d[q], d[q])) * np.sqrt(np.dot(x, x))) for x in d])
        truth[q] = [i for _, i in sorted((-round(x, 12), i) for i, x in enumerate(s) if i != q)[:5]]
    for factor, least in ((1.0, 1.0), (1.5, 0.7)):
        got = vptree.nearest(t, asked, k=5, factor=factor, shard_rows=150).collect()
        own = {q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] for q in truth}
        hits = sum(len({*own[q]} & {*truth[q]}) for q in truth) / (5 * len(truth))
        assert hits >= least and (factor > 1 or own == truth)
        assert all(r.score == pytest.approx(float(n[r.query_id] @ n[r.vec_id])) for r in got)
    assert vptree.nearest(t.limit(0), asked).count() == 0 and vptree.nearest(t, asked.limit(0)).count() == 0


def brute_prints(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), seed=42) for i in range(max(1, len(w) - 2))]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def test_simhash_components(spark):
    rng = random.Random(5)
    texts = {}
    for i in range(40):
        base = words(rng, 150)
        texts[3 * i] = " ".join(base)
        base[rng.randrange(150)] = "Änder"
        texts[3 * i + 1] = "\t".join(base)
        base[rng.randrange(150)] = "more"
        texts[3 * i + 2] = " ".join(base)
    texts |= {500: None, 501: "", 502: " \n", 503: "one", 504: "ONE"}
    prints = {i: brute_prints(t) for i, t in texts.items()}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 3 and least[j] < least[i]:
                    least[i], changed = least[j], True
    t = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("fp", F.lit(1))
    got = simhash.near_duplicates(t).collect()
    assert {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in got} == {i: (prints[i], least[i]) for i in prints}
    assert simhash.near_duplicates(t.limit(0)).count() == 0


def test_line_dedup(spark):
    long = [f"  A line that is long enough to count number {i}\t" for i in range(6)]
    docs = [(i, "\n".join([long[i % 3], "short", *([long[4].upper()] if i < 5 else []), *([long[5]] if i < 4 else [])])) for i in range(20)]
    docs += [(90, None), (91, ""), (None, long[0]), (92, long[0] + "\n" + long[0])]
    t = spark.createDataFrame(docs, "doc_id long, text string").withColumn("pos", F.lit(1)).withColumn("n_lines", F.lit("clash"))
    got = {r.doc_id: r for r in linededup.drop_repeated_lines(t).collect()}
    key = lambda x: x.strip(" \t\r\v\f").lower()
    where: dict = {}
    for i, text in docs:
        for x in (text or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                where.setdefault(key(x), set()).add(i)
    hot = {k: max(v) for k, v in where.items() if len(v) >= 5}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or hot.get(key(x), i) == i]
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_text) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert linededup.drop_repeated_lines(t.limit(0)).count() == 0


def test_ids_are_those_of_the_tokenizers_file():
    import public_tokenizers

    fast = packing.Coder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = packing.Coder(public_tokenizers.path("byte_bpe_50k.json"))
    for x in ["a\n\n b  c\n d ", "  lead", "tail  ", "\n\n\nx\t  y", "é ü\n .. ?!", "it's  'quoted'\n 12 3", " ", "", "a<|endoftext|>b", "日本語 текст"]:
        assert fast(x) == plain(x)
