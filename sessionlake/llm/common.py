"""What the operators of this subpackage share: the shared folder, size-checked broadcasts, connected components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlake.sources.storage import scratch, shared_folder, stored

__all__ = ["scratch", "shared_folder", "stored"]

#: What is broadcast at most: so many rows, and so many bytes of values in them.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 24 << 20
#: ASCII white space as in the contracts' [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def _width(field: T.StructField) -> Column:
    """About how many bytes a value has: numbers 8, strings their own, arrays 8 for each number in them."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        inner = field.dataType.elementType
        if isinstance(inner, T.StringType):
            return F.aggregate(F.coalesce(c, F.array().cast(field.dataType)), F.lit(16), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16)
        return F.greatest(F.size(c), F.lit(0)) * 8 * (len(inner.fields) if isinstance(inner, T.StructType) else 1) + 16
    return F.lit(8)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows and bytes of values; looks at no more rows than that."""
    r = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(reduce(Column.__add__, map(_width, df.schema.fields)).cast("long")), F.lit(0)).alias("size")).first()
    return r["n"] <= rows and r["size"] <= most_bytes


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its rows and bytes are within the bounds, else df as it is, for a shuffled join."""
    return F.broadcast(df) if small(df, rows) else df


def sampled(column: Column, quota: int, total: int) -> Column:
    """Whether a row is among about `quota` of `total`, by a 64-bit hash of column: exact for totals of any size."""
    bound = (min(quota, total) << 64) // max(1, total) - (1 << 63)
    return F.xxhash64(F.lit(quota), column) < F.lit(bound) if bound < 1 << 63 else F.lit(True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else kept; lower() does the same, and faster, where all bytes are ASCII."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def connected_components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) of the undirected edges (a, b): component is the smallest node reachable.

    Alternates large-star and small-star rounds; edges stay distributed, and each round is written to the
    shared folder. A node's neighbours meet only in a min(), which combines before the shuffle, and in an
    equi-join, whose skewed partitions adaptive execution splits. Self loops and repeated edges are harmless.
    Edges with a null end are left out. No edges: an empty result.
    """
    e = edges.select(F.col("a").alias("a"), F.col("b").alias("b")).where("a is not null and b is not null and a <> b")
    e = stored(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: every smaller neighbour of u, and u itself, goes to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        e = stored(
            large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        )
        now = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
