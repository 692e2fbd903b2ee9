"""How text filters interact: what each removes in every order, what it repeats, and its fair share of all removals.

Four filters judge a text alone; the fifth fails copies, found by partition refinement: rows are split by code-point
length, then by the hashes of successive blocks, and what stands alone is dropped after each split. The texts of the
classes that survive are compared in full, and every row but that of the least id is marked. Each row then has a mask
of the filters that it fails; masks are counted within each part, and all orders are read off these counts.

Only lengths, hashes and masks are shuffled, and the texts of surviving classes, which are grouped (equal ones combine
before the shuffle). A table of 64-bit classes meets the rows in joins, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import SPACES, broadcast_if_small, stored

#: Code points at which the blocks end whose hashes split classes, up to the longest string there is.
ENDS = [128 << 4 * k for k in range(6)] + [2**31 - 1]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The letters of the filters, each a bit of the mask.
LETTERS = "ABCDE"


def text_failures(text: Column) -> Column:
    """The mask of the filters A to D that a text fails: few words, few different words, many capitals, odd signs."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    different = F.size(F.array_distinct(words)).cast("long")
    capitals = (F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))).cast("long")
    fails = [F.size(words) < 100, 100 * different < 80 * F.size(words).cast("long"), 100 * capitals > 10 * F.char_length(text).cast("long"), text.rlike(r"[#$%&*|]")]
    return reduce(Column.__add__, (F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)))


def _blocks(text: Column) -> list[Column]:
    """The hash of each block of a text; null where the text has ended before."""
    starts = [0, *ENDS[:-1]]
    return [F.when((F.char_length(text) > a) | F.lit(a == 0), F.xxhash64(F.substring(text, a + 1, b - a))) for a, b in zip(starts, ENDS, strict=True)]


def _class(length: Column, hashes: list[Column], bits: int) -> Column:
    return F.shiftright(reduce(lambda c, h: F.xxhash64(c, h), hashes, F.xxhash64(length)), 64 - bits)


def surviving_classes(rows: DataFrame, bits: int = 64) -> DataFrame:
    """(class) of all blocks that more than one row (length, b0, b1, ...) shares, by refinement block after block."""
    blocks = [F.col(f"b{k}") for k in range(len(ENDS))]
    longest = rows.agg(F.max("length")).first()[0] or 0
    rounds = next(k + 1 for k, end in enumerate(ENDS) if end >= longest)
    alive = rows.select("length", *blocks[:rounds])
    for k in range(rounds + 1):
        split = alive.withColumn("class", _class(F.col("length"), blocks[:k], bits))
        shared = split.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
        alive = stored(split.join(broadcast_if_small(stored(shared)), "class", "left_semi").select("length", *blocks[k:rounds], *blocks[:k]))
    whole = _class(F.col("length"), [*blocks[:rounds], *(F.lit(None).cast("long") for _ in ENDS[rounds:])], bits)
    return alive.select(whole.alias("class")).distinct()


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", bits: int = 64) -> DataFrame:
    """(doc_id, part, mask) of every row: the filters that it fails, A as 1 to E as 16.

    E is failed by a row whose text a smaller id holds too, anywhere in the table. A null text counts as empty and a
    null part as an empty string. A null id has no order: such a row fails no E and makes no other fail it; equal rows
    that repeat an id do not either, while an id with several texts has each judged on its own. `bits` of the hashes
    are kept; classes are compared in full, so fewer only cost time. No rows: no rows; no other column is read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    blocks = _blocks(F.col("text"))
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    hashed = read.select("*", F.char_length("text").alias("length"), *(b.alias(f"b{k}") for k, b in enumerate(blocks)))
    named = hashed.withColumn("class", _class(F.col("length"), [F.col(f"b{k}") for k in range(len(ENDS))], bits))
    rows = stored(named.withColumn("mask", text_failures(F.col("text"))).drop("text"))
    classes = stored(surviving_classes(rows, bits))

    texts = named.select("doc_id", "part", "text", "class").join(broadcast_if_small(classes), "class", "left_semi")
    by_text = texts.groupBy("class", "text").agg(F.min("doc_id").alias("least"))
    least = stored(by_text.groupBy("class").agg(F.count("*").alias("texts"), F.min("least").alias("least")))
    several = least.where("texts > 1").select("class")
    is_copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    mask = (F.col("mask") + F.when(is_copy, 16).otherwise(0)).alias("mask")
    if several.isEmpty():
        return rows.join(broadcast_if_small(least), "class", "left").select("doc_id", "part", mask)
    # classes in which different texts met: their rows are told apart by the texts themselves
    alike = rows.join(broadcast_if_small(several), "class", "left_anti").join(broadcast_if_small(least), "class", "left").select("doc_id", "part", mask)
    met = texts.join(broadcast_if_small(several), "class", "left_semi")
    own = met.groupBy("class", "text").agg(F.min("doc_id").alias("least"))
    return alike.unionByName(met.join(own, ["class", "text"]).withColumn("mask", text_failures(F.col("text"))).select("doc_id", "part", mask))


def interactions(marked: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The report over rows (part, mask, good, toxic): for each part, order of the filters and step what the step does.

    Columns: part, filter_order, step, kept, removed, redundant (fails the step's filter, removed earlier),
    unique_fails (fails that filter alone), good_lost, toxic_lost, shapley (the filter's removals summed over all
    orders: a row that fails m filters is removed by each of them in 1/m of the orders). A part of no rows is absent.
    """
    n = len(letters)
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, f in enumerate(order):
            steps += [("".join(letters[x] for x in order), k + 1, m, 1 << f, before, factorial(n) // m.bit_count() if m >> f & 1 else 0) for m in range(1 << n)]
            before |= 1 << f
    table = marked.sparkSession.createDataFrame(steps, "filter_order string, step int, mask int, bit int, before int, share long")
    cells = marked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda x, where: F.sum(F.when(where, F.col(x)).otherwise(0)).cast("long")
    # the steps are a fixed number of rows: all orders of five filters with all masks are 19,200
    return cells.join(F.broadcast(table), "mask").groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"), total("n", fails & gone).alias("redundant"), total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"), total("toxic", fails & ~gone).alias("toxic_lost"), F.sum(F.col("n") * F.col("share")).cast("long").alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", bits: int = 64) -> DataFrame:
    """interactions() of the five filters over docs; labels (doc_id, quality, toxic) tell which losses hurt.

    A document is good or toxic if any of its labels is 1; without labels, or with null ones, it is neither.
    """
    marked = failures(docs, id_col, text_col, part_col, bits)
    told = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("doc_id is not null")
    known = stored(told.where("good or toxic"))
    return interactions(marked.join(broadcast_if_small(known), "doc_id", "left").select("part", "mask", "good", "toxic"))
