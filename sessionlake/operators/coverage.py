"""Lines of a return that are cited or left out: each must be so once. A sweep over the ends of ranges, no row for each line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lines of a stretch: within one, ends are summed up in order; over a return's stretches, sums are.
STRETCH = 1 << 20


def range_errors(returns: DataFrame, ranges: DataFrame, key: str = "return_id") -> DataFrame:
    """(key, first, last, code) of ranges that name no lines: RETURN_UNKNOWN, or OUT_OF_BOUNDS for one that begins before line 1, ends after
    the last line or before it begins. A null first is 1, a null last the return's last line; a return without lines takes 1 to 0."""
    met = ranges.select(key, F.coalesce("first", F.lit(1)).cast("long").alias("first"), F.col("last").cast("long").alias("last")).join(returns.select(F.col(key).alias("_k"), F.col("line_count").alias("_n")), F.col(key) == F.col("_k"), "left")
    last = F.coalesce("last", "_n")
    fits = ((F.col("first") >= 1) & (F.col("first") <= last) & (last <= F.col("_n"))) | ((F.col("_n") == 0) & (F.col("first") == 1) & (last == 0))
    return met.withColumn("code", F.when(F.col("_n").isNull(), "RETURN_UNKNOWN").when(~fits, "OUT_OF_BOUNDS")).where("code is not null").select(key, "first", "last", "code")


def uneven_lines(returns: DataFrame, ranges: DataFrame, key: str = "return_id", stretch: int = STRETCH) -> DataFrame:
    """(key, first, last, times): the longest runs of lines of returns (key, line_count) that ranges (key, first, last) hold another number of times than once.

    Ends are those of range_errors(), whose ranges count for nothing here; a return that no range names is one run of 0
    times, one without lines has none. Repeated ranges count each time; a null key holds nothing. Ends at one line are
    summed before they are shuffled, so a stretch that is swept has at most `stretch` rows, however many ranges there
    are; what it finds is put together in order of the return's lines.
    """
    sizes = returns.where(F.col(key).isNotNull() & (F.col("line_count") > 0)).groupBy(key).agg(F.max("line_count").cast("long").alias("_n"))
    met = ranges.select(key, F.coalesce("first", F.lit(1)).cast("long").alias("first"), F.col("last").cast("long").alias("last")).join(sizes, key)
    fine = met.withColumn("last", F.coalesce("last", "_n")).where("first >= 1 and first <= last and last <= _n")
    end = lambda at, delta: F.struct(at.cast("long").alias("at"), F.lit(delta).cast("long").alias("delta"))
    ends = fine.select(key, "_n", F.explode(F.array(end(F.col("first"), 1), end(F.col("last") + 1, -1))).alias("e"))
    # every return has an end at its first line and after its last one
    bounds = sizes.select(key, "_n", F.explode(F.array(end(F.lit(1), 0), end(F.col("_n") + 1, 0))).alias("e"))
    # _n is one for each key: it goes along, so that sizes need not be met again
    summed = ends.union(bounds).groupBy(key, "_n", F.col("e.at").alias("at")).agg(F.sum("e.delta").alias("delta")).withColumn("part", F.expr(f"at div {stretch}"))
    parts = summed.groupBy(key, "part").agg(F.sum("delta").alias("total"), F.min("at").alias("begins"))
    order = Window.partitionBy(key).orderBy("part")
    placed = parts.select(key, "part", F.coalesce(F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.lead("begins").over(order).alias("after"))
    # the sweep comes before the join, which finds its rows in the sweep's order: one sort for both
    inside = Window.partitionBy(key, "part").orderBy("at")
    swept = summed.select(key, "part", "_n", F.col("at").alias("first"), F.sum("delta").over(inside).alias("inner"), F.lead("at").over(inside).alias("next")).where(F.col("first") <= F.col("_n"))
    runs = swept.join(placed, [key, "part"]).select(key, "first", (F.col("base") + F.col("inner")).alias("times"), (F.coalesce("next", "after") - 1).alias("last"))
    # where one range ends and the next begins nothing changes: what only touches is one run
    whole = Window.partitionBy(key).orderBy("first")
    uneven = runs.where("times <> 1")
    begins = F.coalesce((F.lag("last").over(whole) + 1 != F.col("first")) | (F.lag("times").over(whole) != F.col("times")), F.lit(True))
    runs_of = uneven.select(key, "first", "last", "times", begins.alias("begins")).withColumn("run", F.count_if("begins").over(whole))
    return runs_of.groupBy(key, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.first("times").alias("times")).select(key, "first", "last", "times")
