"""The pipeline's near copies are those of a verified similarity."""

import random

import pytest

import corpus_pipeline
from sessionlake.llm import simhash


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("shingle_block", [simhash.SHINGLES, 250])
def test_near_copies_are_verified(spark, shingle_block):
    rng = random.Random(5)
    texts, pairs = [], []
    for k in range(60):
        # a passage is shared: half of the pairs are near copies, half have a similarity of 0.5 to 0.75
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 200))]
        extra = round(len(base) * (rng.uniform(0.05, 0.2) if k % 2 else rng.uniform(0.4, 0.9)))
        pairs.append((len(texts), len(texts) + 1))
        texts += [base, base + [f"x{rng.randrange(10**6)}" for _ in range(extra)]]
    # many near copies of one text, and a repeated line that changes no set
    crowd = [f"c{k}" for k in range(100)]
    group = range(len(texts), len(texts) + 40)
    texts += [crowd[:100] + [f"tail{k}"] for k in group]
    texts += [crowd[:50], crowd[:50] + (["same"] * 10 + crowd[:50]) * 30]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.verified_duplicates(docs, shingles=shingle_block).collect()}
    want = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if shingles(texts[a]) & shingles(texts[b]) and jaccard(texts[a], texts[b]) >= 0.8:
                want = [want[b] if w == want[a] else w for w in want] if want[b] < want[a] else [want[a] if w == want[b] else w for w in want]
    assert got == dict(enumerate(want))
    assert sum(want[a] == want[b] for a, b in pairs) == 30 and len({want[k] for k in group}) == 1


def test_the_stage_keeps_documents_that_share_a_passage(spark):
    rng = random.Random(7)
    rows = []
    for k in range(40):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:225] + [f"x{rng.randrange(10**6)}" for _ in range(75)]))]
    rows += [(None, ""), (100, ""), (101, None), (102, "a b"), (103, "A  b"), (None, "a b")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == [*range(80), 100, 102]
