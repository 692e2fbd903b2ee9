"""Benchmark decontamination by spaced seeds, by DataFrame functions only.

Text becomes lower-cased runs of letters and digits, each hashed once to a long. A mask is a fixed span of tokens of
which some positions are ignored; the kept tokens of every span of the benchmark and of every document are hashed and joined. Around a hit the
item is laid over the document: the overlap holds if enough of its tokens agree, so substituted words are tolerated.

Only the benchmark's seeds, rows of numbers, are broadcast, if they are `block_rows` at most. Beyond that the same one pass
over the documents sifts its hashes by a bit table of the seeds, of a fixed size, and what passes is shuffled to them. Hits
are combined to distinct diagonals of a document and an item, numbers again, before the tokens of the documents that
were hit and of the items are brought in, by a broadcast where these are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import BROADCAST_ROWS, broadcast_if_small, stored

#: 64-bit words of the bit table that sifts hashes where seeds are too many to be broadcast: 16 MB of rows.
SIEVE = 1 << 20
#: Kept positions of each mask. Different gaps, so that one substitution cannot hit all of them: of the 4,845 sets of
#: four substitutions in 20 tokens the first three leave 6 without a seed, and all four none.
MASKS = ((0, 1, 2, 4, 7, 8), (0, 2, 3, 5, 6, 8), (0, 1, 3, 4, 5, 9), (0, 1, 2, 3, 4, 5))


def tokens(text: Column) -> Column:
    """The lower-cased runs of letters and digits; null or none: an empty array."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _words(text: Column) -> Column:
    """tokens(), the cheaper way: separators at the ends go first, so no empty word arises but in an empty text."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[^\p{L}\p{N}]+"))


def _hashed(words: str) -> Column:
    """The hashes of an array's tokens; exploded from an array of one, so that each is computed once."""
    return F.explode(F.array(F.transform(words, lambda w: F.xxhash64(w))))


def _seed(words: str, at: Column, mask: int) -> Column:
    """The hash of what a mask keeps at a position; null where the span passes the end."""
    kept = [F.get(words, at + p) for p in MASKS[mask]]
    return F.when(at + MASKS[mask][-1] < F.size(words), F.xxhash64(F.lit(mask), *kept))


def _run(words: str, at: Column, length: int) -> Column:
    """The hash of so many tokens in a row; null where they pass the end."""
    return F.when(at + length <= F.size(words), F.xxhash64(F.lit(-length), *(F.get(words, at + p) for p in range(length))))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 20, similarity: float = 0.8, block_rows: int = BROADCAST_ROWS, least_tokens: int = 1) -> DataFrame:
    """(doc_id, item_id, matched, compared, similarity): a row for each document and item that overlap.

    An overlap is a window of `window` consecutive tokens of an item (all of a shorter one), laid over as many tokens
    of the document, of which a share of at least `similarity` agree, found around a seed hit. The row tells of the
    alignment with most agreeing tokens over the whole item: `matched` of `compared` (the item's tokens).

    Items of `window` tokens and more give the seeds of the masks at each position. A shorter item, of which e tokens may
    differ, gives e + 1 runs side by side, of which one is whole in any overlap; without any such e, the whole item.
    Windows and similarities for which the masks are not enough are searched by runs as well, at each position. Items of
    fewer than `least_tokens` tokens are left out: an answer of one word is in every document that holds the word.

    Very long texts and items cost their tokens: what meets is numbers, and only tokens beside a hit are compared.
    Null and empty texts have no tokens and overlap nothing. Rows with a null id are kept under null. Repeated rows
    count once. Empty tables give no rows; no other column is read.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), _words(F.col(item_text)).alias("item")).where(F.size("item") >= max(1, least_tokens)).distinct()
    items = stored(items.select(F.xxhash64("item_id", "item").alias("key"), "item_id", "item", F.size("item").alias("n")))
    width = F.least(F.col("n"), F.lit(window))
    need = F.ceil(width * similarity).cast("int")
    run = (width / (width - need + 1)).cast("int")
    masked = window >= 20 and similarity >= 0.8
    # e + 1 runs side by side if the item is one window, else runs from each position on
    sized = items.select("key", _hashed("item").alias("item"), "n", run.alias("run"), ((F.col("n") >= window) if masked else F.lit(False)).alias("long"), F.when(F.col("n") <= window, run).otherwise(1).alias("step"))
    runs = sorted(r.run for r in sized.where("not long").select("run").distinct().collect())
    any_long = bool(sized.where("long").limit(1).count())
    masks = [(m, _seed) for m in range(len(MASKS)) if any_long] + [(r, _run) for r in runs]

    def fits(size: int, of: object, j: Column) -> Column:
        return F.col("long") if of is _seed else ~F.col("long") & (F.col("run") == size) & (j % F.col("step") == 0)

    pairs = F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.array(*(F.struct(F.when(fits(k, of, j), of("item", j, k)).alias("h"), j.alias("j")) for k, of in masks)))), lambda s: s["h"].isNotNull())
    seeds = sized.select("key", "n", F.explode(pairs).alias("s")).select(F.col("s.h").alias("h"), "key", F.col("s.j").alias("j"), "n") if masks else sized.selectExpr("key AS h", "key", "n AS j", "n")
    seeds = stored(seeds)
    few = seeds.count() <= block_rows

    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), _words(F.col(text_col)).alias("words"))
    hashed = words.select("doc_id", "text_hash", _hashed("words").alias("hashed"))
    placed = hashed.select("doc_id", "text_hash", "hashed", F.explode(F.sequence(F.lit(0), F.greatest(F.size("hashed") - 1, F.lit(0)))).alias("i"))
    hashes = F.array(*(of("hashed", F.col("i"), k) for k, of in masks)) if masks else F.array().cast("array<bigint>")
    seeded = placed.select("doc_id", "text_hash", "i", F.explode(hashes).alias("h")).where("h is not null")

    if few:
        met = seeded.join(F.broadcast(seeds), "h")
    else:
        word, bit = F.col("h").bitwiseAND(F.lit(SIEVE - 1)), F.shiftright("h", SIEVE.bit_length() - 1).bitwiseAND(F.lit(63)).cast("int")
        sieve = stored(seeds.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
        # at most SIEVE rows, whatever the benchmark
        passed = seeded.withColumns({"word": word, "bit": bit}).join(F.broadcast(sieve), "word").where("shiftright(bits, bit) & 1 = 1")
        met = passed.select("doc_id", "text_hash", "i", "h").join(seeds, "h")
    hit = stored(met.select("doc_id", "text_hash", "key", "n", (F.col("i") - F.col("j")).alias("at")).distinct())
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__hash"), F.col(text_col).alias("__text"))
    met = rows.join(broadcast_if_small(hit), F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash")))
    # only the tokens on the diagonal go on; each explode keeps what it wraps from being computed anew at each position
    tokens_of = met.select("doc_id", "key", "n", "at", F.explode(F.array(_words(F.col("__text")))).alias("words"))
    cut = tokens_of.select("doc_id", "key", "at", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda x: F.get("words", F.col("at") + x)).alias("cut"))
    laid = cut.join(broadcast_if_small(items), "key")
    agree = laid.select("doc_id", "item_id", "n", F.explode(F.array(F.zip_with("item", "cut", lambda t, w: F.when(t == w, 1).otherwise(0)))).alias("agree"))
    total = F.aggregate("agree", F.lit(0), lambda a, x: a + x)
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.col("n") - width), lambda s: F.aggregate(F.slice("agree", s + 1, width), F.lit(0), lambda a, x: a + x)))
    found = agree.where(best >= need).select("doc_id", "item_id", total.alias("matched"), F.col("n").alias("compared"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "compared")).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.matched").cast("long").alias("matched"), F.col("best.compared").cast("long").alias("compared"), (F.col("best.matched") / F.col("best.compared")).alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that overlap no benchmark item; rows with a null id are kept. Columns are as given."""
    leaks = stored(overlaps(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("__leak")).distinct())
    return docs.join(leaks, docs[id_col] == leaks["__leak"], "left_anti")


def item_costs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(item_id, documents): how many documents clean() would take out for each item that any holds, so short or common items can be seen."""
    return overlaps(docs, benchmark, **options).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"))
