"""Templates of pages are counted over different pages; names alone delete nothing of an article."""

import pytest
from pyspark.sql import functions as F

from sessionlake.llm import htmltext


def run(spark, rows, **options):
    t = spark.createDataFrame([(k, u, h) for k, (u, h, _) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extracted(t, **options).collect()}
    assert got == {k: want for k, (_, _, want) in enumerate(rows)}


@pytest.mark.parametrize("most", [htmltext.TEMPLATES, 0])
def test_templates_are_counted_on_every_page(spark, most):
    # a notice as a plain paragraph inside the article
    rows = [(f"http://a/{i}", f"<body><article><h1>T{i}</h1><p>Own {i}</p><p>Sign up today</p></article></body>", f"T{i} Own {i}") for i in range(6)]
    # copies of a page, with wrappers, without article, and under changing adverts
    rows += [(f"http://b/{i}", "<body><div class=body><p>Copied text</p></div></body>", "Copied text") for i in range(8)]
    rows += [(f"http://b/{10 + i}", f"<body><div class=ad>Ad {i}</div><article><div class=body><p>Copied article</p></div></article></body>", "Copied article") for i in range(8)]
    # a section's template on a small share of a large host
    rows += [(f"http://c/{i}", f"<body>{'<div>Section box</div>' if i < 6 else ''}<p>Text {i}</p></body>", f"Text {i}") for i in range(100)]
    # a named part of articles goes when it recurs on two pages
    rows += [(f"http://d/{i}", f"<article><p>Own {i}</p><div class=promo>Buy this</div><p>See <span class=related>it {i}</span>.</p></article>", f"Own {i} See it {i}.") for i in range(2)]
    run(spark, rows, most_templates=most)


def test_names_alone_delete_no_article(spark):
    rows = [
        ("http://a/1", "<body><div class='has-sidebar no-header'><article><p>One</p></article></div></body>", "One"),
        ("http://a/2", "<body><form><div id='page-widget' class=widget><main><p>Two</p></main></div></form></body>", "Two"),
        ("http://a/3", "<article><header><h1>Three</h1></header><section id='related-work'><p>Work</p></section><section class=notice><p>Appeal</p></section></article>", "Three Work Appeal"),
        ("http://a/4", "<body><div class=sidebar><p>Links</p></div><p>Four</p><section class=comments><article class=comment><p>Me too</p></article></section></body>", "Four"),
    ]
    run(spark, rows)


LONG = "A long text of the page that goes on and on for a while. " * 3


def test_names_and_articles_are_votes(spark):
    rows = [
        ("http://b/1", f"<div id=content><p>{LONG}</p></div><div class=cards><article class=card><p>Teaser one</p></article><article class=card><p>Teaser two</p></article></div>", LONG.strip()),
        ("http://b/2", "<main><p>A</p></main><p>B</p>", "A B"),
        ("http://b/3", f"<body><div class=notice><p>{LONG}</p></div></body>", LONG.strip()),
        ("http://b/4", "<div class='content search'><p>Found this</p></div>", "Found this"),
        ("http://b/5", "<div id=related><p>All there is</p></div>", "All there is"),
        ("http://b/6", "<section class=social><p>Only this</p></section>", "Only this"),
        ("http://b/7", f"<form action=x><h1>T</h1><p>{LONG}</p><label>name</label><button>go</button></form>", f"T {LONG.strip()}"),
        ("http://b/8", f"<div class=sidebar><article class=card><p>Teaser</p></article></div><p>{LONG}</p>", LONG.strip()),
        ("http://b/9", f"<article><p>{LONG}</p></article><div class=ad>{LONG * 5}</div><p>by</p>", LONG.strip()),
        ("http://b/10", "<nav>a</nav><aside>what stands beside</aside>", "what stands beside"),
        ("http://b/11", "<nav>menus alone</nav><div class=comments>me too</div>", ""),
    ]
    run(spark, rows)


def test_shared_sentences_stay_and_recurring_notices_go(spark):
    # of 24 pages of a host, 8 share a heading and a sentence of their articles; 16 begin with the same notice and end with the same line, and all have a box
    rows = []
    for k in range(24):
        head = "<h1>News</h1>" if k % 3 == 0 else f"<h1>Title {k}</h1>"
        shared = "<p>As we said before.</p>" if k % 3 == 0 else ""
        notice, line = ("<p>This site moves soon.</p>", "<p>Write to us.</p>") if k % 3 else ("", "")
        text = f"<p>own {k} a</p>{shared}<p>own {k} b</p>"
        want = " ".join(x for x in ("News" if k % 3 == 0 else f"Title {k}", f"own {k} a", "As we said before." if shared else "", f"own {k} b") if x)
        rows.append((f"http://c/{k}", f"<article>{notice}{head}{text}<div><p>Box of the site</p></div>{line}</article>", want))
    run(spark, rows)
