"""Held-out accuracy of the classifiers and hand-made pages for the extraction."""

import random

import numpy as np
from pyspark.sql import functions as F

from sessionlake.llm import ftrl, htmltext, langid, quality


def test_temperature_makes_labels_likeliest():
    z = np.array([[4.0, 0.0]] * 8 + [[0.0, 4.0]] * 2)
    t = ftrl.best_temperature(z, np.zeros(10, dtype=int))
    p = ftrl.softmax(z / t)[:8, 0].mean()
    assert 0.7 < p < 0.9 and ftrl.best_temperature(np.zeros((0, 2)), np.zeros(0, dtype=int)) == 1.0


def test_languages(spark):
    rng = random.Random(1)
    kinds = {"aa": ["the", "and", "thing", "over"], "bb": ["der", "und", "schön", "über"]}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(30)), k) for i in range(240) for k in [["aa", "bb"][i % 2]]]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 34!", None), (None, "the and the", "bb"), (903, "über und", None)]
    t = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1)).withColumn("p", F.lit(1))
    got = {r.doc_id: r for r in langid.identify(t).collect()}
    assert len(got) == len(rows) and all(got[i].lang_pred == k for i, _, k in rows[:240])
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"] and got[None].held_out
    assert langid.identify(t.limit(0)).count() == 0


def test_quality(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(40)) + "."
    rows, labels = [], []
    for i in range(300):
        text, q, x = good(), 1, 0
        if i % 5 == 0:
            text, q = text.upper().replace(" ", "!!! "), 0
        elif i % 7 == 0:
            text, x = text + " you vile wretch", 1
        rows.append((i, text, f"s{i % 3}", "en"))
        labels.append((i, q, x))
    rows += [(500, None, None, None), (501, "", "s0", None), (None, good(), "s1", "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("host", F.lit(1)).withColumn("y", F.lit(1))
    known = spark.createDataFrame([x for x in labels if x[0] % 2] + [x for x in labels if x[0] % 4 == 0] + [(None, 1, 0), (7, None, 5)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(d, known).collect()}
    assert len(got) == len(rows)
    wrong = sum(got[i].rejected != (q == 0 or x == 1) for i, q, x in labels)
    assert wrong <= 3
    assert quality.judged(d.limit(0), known).count() == 0
    assert not any(r.rejected for r in quality.judged(d, known.limit(0)).collect())


def test_pages(spark):
    page = lambda body: f"<html><head><title>T</title><style>x</style></head><body><nav><a>Menu</a></nav><div class='ad'>Buy</div>{body}<footer>&copy; x</footer></body></html>"
    rows = [
        (1, "http://a/1", page("<article><h1>Head</h1><p>One <b>bold</b>ly &amp; two<br>three<p>Four<script>no()</script><div class='comments'><p>Reader</p></div></article>"), "Head One boldly & two three Four"),
        (2, "http://a/2", None, ""), (3, None, "", ""), (4, "http://a/4", "plain  text &nbsp; here", "plain text here"),
        (5, "http://a/5", page("<div><p>No article &lt;here&gt;</p></div>"), "No article <here>"),
    ]
    rows += [(10 + i, f"http://b/{i}", page(f"<div class=x>Same on all</div><div><p>Own words {i}</p></div>"), f"Own words {i}") for i in range(8)]
    rows += [(30 + i, f"http://c/{i}", page("<article><p>A copied article</p></article>"), "A copied article") for i in range(8)]
    t = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").withColumn("row", F.lit(1)).withColumn("host", F.lit("h"))
    got = htmltext.extracted(t).collect()
    assert {r.page_id: (r.text, r.n_chars) for r in got} == {r[0]: (r[3], len(r[3])) for r in rows} and len(got) == len(rows)
    assert htmltext.extracted(t.limit(0)).count() == 0
