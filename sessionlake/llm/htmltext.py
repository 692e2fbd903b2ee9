"""Main text of pages: site templates and page furniture removed, the main block chosen by counted evidence.

Each page is parsed into its blocks of text and the element subtrees that hold them. A subtree's hash is made of its own
names, its texts and the hashes of the subtrees in it, once when it ends, so a page costs its length however deep it is.
Spark counts on how many different pages of a host each subtree occurs, by hashes alone, and the subtrees that recur
there go when the pages are parsed again; texts are never shuffled. Copies of a page are one page, so what was copied is
no template. Inside articles a heading, a paragraph or an item counts together with its place only, and goes if it has that
place on a good part of the host's pages: a sentence that some pages share is no notice.

What recurs is gone before anything is chosen. Menus, asides, footers, dialogs, controls and readers' comments are no text
of the page; any other name that tells furniture, and an article or main element, is a vote: it counts by how much of
the text that is left it holds. So a notice or a form around the whole page is the page, and cards beside a long text
are not.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import broadcast_if_small, small, stored

# Fixed values of HTML: elements without end tags, elements that are blocks, those whose content is not shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
UNSEEN = {"script", "style", "title", "template", "noscript", "iframe", "object", "svg", "canvas", "audio", "video"}
#: Elements and whole names of class, id and role that tell page furniture: votes.
FURNITURE = {"header", "form"}
FURNITURE_WORDS = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "contentinfo", "cookie", "cookies", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget"}
#: Never the page's own text: controls, menus, and what readers wrote, which recurs nowhere.
CONTROLS = {"button", "select", "textarea", "label", "legend"}
MENUS = {"nav", "menu", "dialog"}
COMMENTS = {"comment", "comments"}
#: No text of the page unless it has no other.
BESIDE = {"aside", "footer"}
#: Template keys that are sent to every task at most: 16 MB, which pass the driver.
TEMPLATES = 2_000_000
#: Elements that hold a page or its text as a whole: no templates.
WHOLE = {"html", "head", "body", "main", "article"}
#: Inside articles: what is a template only at its place, and which of it may stand first or last on many pages without being one.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PLAIN = HEADINGS | {"p", "li", "dt", "dd", "td", "th", "caption", "figcaption", "summary", "pre", "blockquote", "address"}
#: A start tag of the first closes an open element of the second kind.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class _Element:
    __slots__ = ("dropped", "first", "gone", "hash", "holds", "in_article", "key", "keys", "last", "low", "main", "name", "named", "never", "parent", "placed", "size", "sure", "texts")

    def __init__(self, name, parent, shape, first=0, in_article=False, main=False, dropped=False, named=False, sure=False, never=False):
        self.name, self.parent, self.first, self.in_article, self.main = name, parent, first, in_article, main
        self.dropped, self.named, self.sure, self.never, self.low = dropped, named, sure, never, False
        self.holds = self.texts = self.gone = self.placed = False
        self.hash, self.key, self.keys, self.last, self.size = xxhash.xxh3_64(shape), 0, (), 0, 0


class Blocks(HTMLParser):
    """The shown blocks of a page as (text, the element around it, whether it goes on in the word before), and all elements, outer ones first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Element("", None, b"")
        self.stack, self.elements, self.open = [self.root], [self.root], Counter()
        self.pieces: list[str] = []
        self.blocks: list[tuple[str, _Element, bool]] = []
        self.glued = False

    def parse_marked_section(self, i, report=0):
        """As a comment, whatever it is: `<![` up to the next `>`."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _end_block(self, inline: bool = False) -> None:
        raw = "".join(self.pieces)
        text = " ".join(raw.split())
        self.pieces.clear()
        if text:
            around = self.stack[-1]
            self.blocks.append((text, around, self.glued and not raw[0].isspace()))
            around.hash.update(text.encode("utf-8", "surrogatepass") + b"\0")
            around.texts = True
            self.glued = inline and not raw[-1].isspace()
        elif raw or not inline:
            self.glued = False

    def _pop(self, k: int) -> None:
        """Closes the elements of the stack from k on; those with text go into the hashes around them."""
        for e in reversed(self.stack[k:]):
            self.open[e.name] -= 1
            e.key, e.last = e.hash.intdigest(), len(self.blocks)
            if e.texts:
                e.parent.hash.update(e.key.to_bytes(8, "little"))
                e.parent.texts = True
        del self.stack[k:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            if tag == "br":
                self.pieces.append(" " if not self.stack[-1].dropped else "")  # a line's end inside a block is white space
            else:
                self._end_block()
                if self.open["p"] and next(e for e in reversed(self.stack) if e.name in ("p", "article", "div", "section", "td", "li")).name == "p":
                    self._close("p")
            for name in CLOSES.get(tag, ()):
                if self.open[name] and next(e.name for e in reversed(self.stack) if e.name in (name, "ul", "ol", "dl", "table", "select")) == name:
                    self._close(name)
        if tag in VOID:
            return
        up = self.stack[-1]
        names = {w for k, v in attrs if k in ("class", "id", "role") and v for w in v.lower().split()}
        comments = bool(names & COMMENTS) and tag not in ("html", "body", "main")
        main = tag in ("article", "main") and not comments
        in_article = up.in_article or main
        never = comments or tag in CONTROLS or tag in MENUS
        sure = never or tag in BESIDE
        named = tag in FURNITURE or (tag not in ("html", "body", "article", "main") and bool(names & FURNITURE_WORDS))
        if (named or sure) and tag not in BLOCKS:
            self._end_block(inline=True)
        if main and not up.in_article:
            for e in reversed(self.stack):
                if e.holds:
                    break
                e.holds = True
        shape = f"{tag} {' '.join(sorted(names))}".encode("utf-8", "surrogatepass")
        # a heading of an article may stand in a header
        e = _Element(tag, up, shape, len(self.blocks), in_article, main and not up.in_article, up.dropped or tag in UNSEEN, named and not (tag == "header" and in_article and not names & FURNITURE_WORDS), sure, never)
        self.stack.append(e)
        self.elements.append(e)
        self.open[tag] += 1

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name == tag:
                self._end_block()
                self._pop(k)
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_block() if tag != "br" else self.pieces.append(" ")
        if tag in VOID or not self.open[tag]:
            return
        # an inline end tag does not close the block around it
        for k in range(len(self.stack) - 1, 0, -1):
            e = self.stack[k]
            if e.name == tag:
                if tag not in BLOCKS and any(x.named or x.sure for x in self.stack[k:]):
                    self._end_block(inline=True)
                self._pop(k)
                return
            if tag not in BLOCKS and e.name in BLOCKS:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if not self.stack[-1].dropped:
            self.pieces.append(data)


def _placed(e: _Element, texts: list[int], article: _Element) -> list[int]:
    """The keys of a plain element of an article: with the blocks before and after it, and as the first or last of all if it is no heading."""
    before = texts[e.first - 1] if e.first > article.first else 0
    after = texts[e.last] if e.last < article.last else 0
    keys = [xxhash.xxh3_64_intdigest(b"%d %d %d" % (e.key, before, after))]
    if e.name not in HEADINGS:
        keys += [xxhash.xxh3_64_intdigest(b"%d first" % e.key)] * (e.first == article.first) + [xxhash.xxh3_64_intdigest(b"%d last" % e.key)] * (e.last == article.last)
    return keys


def parsed(html: str, host: str = "") -> tuple[list[tuple[str, _Element, bool]], list[_Element]]:
    """(blocks, elements, outer ones first) of a page. An element's keys are those of its subtree on this host as it may
    recur, none where it can't be a template; odd where a name inside an article tells furniture."""
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser._end_block()
    parser._pop(1)
    salt = xxhash.xxh3_64_intdigest(host.encode("utf-8", "surrogatepass"))
    texts = [xxhash.xxh3_64_intdigest(b[0].encode("utf-8", "surrogatepass")) for b in parser.blocks]
    article = None
    for e in parser.elements[1:]:
        if e.main:
            article = e
        if not e.texts or e.name in WHOLE:
            continue
        if not e.in_article or e.named or e.sure:
            keys = [e.key]
        elif e.name in PLAIN:
            keys, e.placed = _placed(e, texts, article), True
        else:
            keys = [e.key] if e.name in BLOCKS else []
        e.keys = tuple((k ^ salt) - (1 << 63) & ~1 | (e.named and e.in_article) for k in keys)
    return parser.blocks, parser.elements


def chosen(blocks: list[tuple[str, _Element, bool]], elements: list[_Element], templates: set[int] | frozenset[int] = frozenset()) -> list[bool]:
    """Which blocks are the page's text, without the subtrees whose keys are templates."""

    def sized() -> int:
        """How much text that is left each element holds; all of it."""
        for e in elements:
            e.size = 0
        for text, e, _ in blocks:
            e.size += 0 if e.gone else len(text)
        for e in reversed(elements[1:]):
            e.parent.size += e.size
        return elements[0].size

    def settled(goes) -> list[bool]:
        for e in elements[1:]:
            e.gone = e.parent.gone or goes(e)
        return [not e.gone for _, e, _ in blocks]

    recurs = lambda e: any(k in templates for k in e.keys)
    left = settled(lambda e: e.sure or recurs(e))
    if not any(left):
        # an aside is the page's text if there is no other
        return settled(lambda e: e.never or recurs(e))
    total = sized()
    articles = [e for e in elements if e.main]
    # outermost elements that are named like furniture and hold no article that is a good part of the text
    named = []
    for e in elements[1:]:
        e.low = e.parent.low
        if e.named and not (e.low or e.gone or e.in_article or (e.holds and 4 * e.size >= total)):
            named.append(e)
            e.low = True
    # they go where there is text beside them, unless it is far less than theirs; that of an article has four votes
    other = total - sum(e.size for e in named) + 3 * sum(e.size for e in articles if not e.low)
    less = {id(e) for e in named if 4 * other >= e.size}
    voted = settled(lambda e: e.gone or id(e) in less)
    if not any(voted):
        voted = settled(lambda e: e.sure or recurs(e))
    total = sized()
    inside = sum(e.size for e in articles)
    outside = total - inside
    if inside and 2 * outside < inside:
        return [x and e.in_article for x, (_, e, _) in zip(voted, blocks, strict=True)]
    if outside > inside:
        # cards beside a text, each far shorter than it
        return settled(lambda e: e.gone or (e.main and 4 * e.size < outside))
    return voted


def _trees(html: pd.Series, host: pd.Series) -> pd.DataFrame:
    """The hash of each page's text without what is named furniture, its host's, and the keys of all its subtrees, those of plain elements of articles apart."""
    pages, hosts, trees, placed = [], [], [], []
    for page, name in zip(html, host, strict=True):
        blocks, elements = parsed(page, name) if isinstance(page, str) else ([], [])
        for e in elements[1:]:
            e.gone = e.parent.gone or e.sure or (e.named and not e.holds and not e.in_article)
        shown = [b for b in blocks if not b[1].gone] or blocks
        own = [b[0] for b in shown if b[1].in_article] or [b[0] for b in shown]
        pages.append(xxhash.xxh3_64_intdigest("\0".join(own).encode("utf-8", "surrogatepass")) - (1 << 63))
        hosts.append(xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) - (1 << 63))
        for out, plain in ((trees, False), (placed, True)):
            out.append(sorted({k for e in elements if e.placed == plain for k in e.keys}))
    return pd.DataFrame({"page": pages, "host": hosts, "trees": trees, "placed": placed})


def _text(html: str, host: str, among) -> str:
    """The chosen text without the subtrees whose keys are templates: `among` gives those of a sorted array of keys."""
    blocks, elements = parsed(html, host)
    if not blocks:
        return ""
    kept = chosen(blocks, elements, among(np.array(sorted({k for e in elements for k in e.keys}), dtype=np.int64)))
    out, before = [], False
    for (text, _, glued), x in zip(blocks, kept, strict=True):
        if x:
            out.append(("" if not out or (glued and before) else " ") + text)
        before = x
    return "".join(out)


def _cleaned(templates):
    """Of pages and hosts: their text without the subtrees of a broadcast sorted array."""

    def text(html: pd.Series, host: pd.Series) -> pd.Series:
        known = templates.value

        def among(keys: np.ndarray) -> set[int]:
            if not len(known):
                return set()
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            return set(keys[known[at] == keys].tolist())

        return pd.Series([_text(page, name, among) if isinstance(page, str) else "" for page, name in zip(html, host, strict=True)], dtype=object)

    return text


def _cleaned_each(html: pd.Series, host: pd.Series, gone: pd.Series) -> pd.Series:
    """As _cleaned(), of pages that bring the keys of their own templates."""
    return pd.Series([_text(page, name, lambda _, g=g: {*g} if g is not None else set()) if isinstance(page, str) else "" for page, name, g in zip(html, host, gone, strict=True)], dtype=object)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_pages: int = 5, least_named: int = 2, least_share: float = 0.5, most_templates: int = TEMPLATES) -> DataFrame:
    """(page_id, url, text, n_chars): a row for each row of pages.

    A subtree is a template if it recurs on at least `least_pages` different pages of its host, `least_named` where a
    name tells furniture inside an article; a plain element of an article only with the same blocks around it, or, if it
    is no heading, as the first or last of the article, and only on at least `least_share` of the host's different pages.
    Pages whose texts but furniture are equal are one page. Of what is left,
    text outside articles stays if it is at least half as much as theirs, and cards go beside a text four times as long.
    A page whose whole text stands in elements that are named like furniture has that text; one of menus, controls and
    readers' comments alone has none. Null and empty html has empty text. Rows with a null url share one host. Repeated
    rows are extracted each. An empty table gives no rows; other columns are not read. Any string is a page: what HTML
    does not know is a comment or text. A page costs its length, whatever its nesting.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("host", F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    trees = F.pandas_udf(_trees, "page bigint, host bigint, trees array<bigint>, placed array<bigint>")
    marked = lambda name, plain: F.transform(name, lambda t: F.struct(t.alias("tree"), F.lit(plain).alias("placed")))
    # numbers only, stored: what follows reads them more than once
    told = stored(rows.select(trees("html", "host").alias("p")).select("p.*"))
    # a page counts once for a tree; the hot trees of a hot host are dealt out by page before they are counted
    each = told.select("page", "host", F.explode(F.concat(marked("trees", False), marked("placed", True))).alias("t")).select("page", "host", "t.*").distinct()
    least = F.when(F.col("tree").bitwiseAND(F.lit(1)) == 1, least_named).otherwise(least_pages)
    counted = stored(each.groupBy("tree").agg(F.count("*").alias("n"), F.first("host").alias("host"), F.first("placed").alias("placed")).where(F.col("n") >= least))
    # pages of the hosts in question only
    asked = counted.where("placed").select("host").distinct()
    pages_of = told.select("host", "page").distinct().join(broadcast_if_small(stored(asked)), "host", "left_semi").groupBy("host").agg(F.count("*").alias("pages"))
    met = counted.join(broadcast_if_small(stored(pages_of)), "host", "left")
    recur = stored(met.where(~F.col("placed") | (F.col("n") >= least_share * F.col("pages"))).select("tree"))
    if small(recur, most_templates, 8 * most_templates):
        known = np.sort(recur.toPandas()["tree"].to_numpy(dtype=np.int64))
        text = F.pandas_udf(_cleaned(pages.sparkSession.sparkContext.broadcast(known)), "string")
        out = rows.select("page_id", "url", text("html", "host").alias("text"))
    else:
        met = rows.select("html", "host").distinct().select(F.xxhash64("html", "host").alias("of"), F.explode(F.concat(trees("html", "host")["trees"], trees("html", "host")["placed"])).alias("tree")).join(recur, "tree", "left_semi")
        gone = met.groupBy("of").agg(F.collect_set("tree").alias("gone"))
        text = F.pandas_udf(_cleaned_each, "string")
        out = rows.join(gone, F.xxhash64("html", "host") == F.col("of"), "left").select("page_id", "url", text("html", "host", "gone").alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
