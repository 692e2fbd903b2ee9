"""No string breaks the extraction, deep pages cost their length, and counting decides what neutral names hide."""

import random
import time

from pyspark.sql import functions as F

from sessionlake.llm import htmltext

BITS = ["<", ">", "</", "<!", "<![", "<![foo[bar]]>", "<!--", "-->", "<?", "&", "&#", "&#x110000;", "&#55296;", "&amp", ";", "\x00", "\ud800", "a", " ", "=", "'", '"', "<p>", "</p>", "<br/>", "<li>", "<td>", "<table>", "<article>", "</article>", "<script>", "</script>", "<title>", "</", "<a b=", "<div class=ad>", "</div>", "<option>", "<![CDATA[x]]>", "<!DOCTYPE", "]]>"]


def test_any_string_is_a_page():
    rng = random.Random(4)
    for _ in range(4000):
        htmltext._text("".join(rng.choice(BITS) for _ in range(rng.randrange(40))), "h", lambda keys: set(keys[::2].tolist()))


def test_malformed_and_deep_pages(spark):
    deep = "<div>" * 30_000 + "".join(f"<p>w{i}" for i in range(30_000))
    rows = [(1, "http://a/1", "<p>One</p><![foo[bar]]><p>Two</p>"), (2, "http://a/2", deep), (3, "http://a/3", "<p>x" * 3 + "</section>" * 50_000)]
    began = time.time()
    got = {r.page_id: r for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n_chars", F.lit("clash"))).collect()}
    assert got[1].text == "One Two" and got[2].text == " ".join(f"w{i}" for i in range(30_000)) and got[3].text == "x x x" and time.time() - began < 60


def brute_force(pages, least=5):
    """Texts of pages whose blocks are the leaves of nested (name, children) trees inside one article: subtrees on `least` different pages of their host go."""
    seen = {}

    def trees(node):
        if isinstance(node, str):
            return
        yield repr(node)
        for x in node[1]:
            yield from trees(x)

    for host, tree in pages:
        for t in {*trees(tree)}:
            seen.setdefault((host, t), set()).add(repr(tree))

    def text(host, node):
        if isinstance(node, str):
            return [node]
        # paragraphs of articles are templates at their place only, which none here has on half of a host's pages
        return [] if len(seen[host, repr(node)]) >= least and node[0] != "p" else [w for x in node[1] for w in text(host, x)]

    return [" ".join(w for x in tree[1] for w in text(host, x)) for host, tree in pages]


def test_counting_decides_inside_articles(spark):
    rng = random.Random(9)
    shared = {h: [("div", ["".join(rng.choice("abcdef") for _ in range(5)), ("p", [f"{h} box {k}"])]) for k in range(4)] for h in "xyz"}
    pages = []
    for i in range(90):
        host = rng.choice("xyz")
        parts = [("p", [f"own text {i} {k}"]) for k in range(2)] + rng.sample(shared[host], rng.randrange(3)) + [("div", [("p", [f"own {i}"]), ("p", [f"common end of {rng.randrange(12)}"])])]
        rng.shuffle(parts)
        pages.append((host, ("article", parts)))
    pages += [pages[0]] * 9
    html = lambda node: node if isinstance(node, str) else f"<{node[0]}>{''.join(map(html, node[1]))}</{node[0]}>"
    t = spark.createDataFrame([(i, f"http://{h}/{i}", html(tree)) for i, (h, tree) in enumerate(pages)], "page_id long, url string, html string")
    for most in (htmltext.TEMPLATES, 0):
        got = {r.page_id: r.text for r in htmltext.extracted(t, most_templates=most).collect()}
        assert got == dict(enumerate(brute_force(pages)))
    off = {r.page_id: r.text for r in htmltext.extracted(t, least_pages=10**9, least_named=10**9).collect()}
    assert sum(off[i] != got[i] for i in got) > 30
