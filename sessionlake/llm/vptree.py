"""Nearest neighbours by cosine: a vantage-point tree for each shard of the vectors, queries sent where they may pay.

Trees work on unit vectors, where Euclidean distance is a metric and orders like the cosine. Equal vectors are one node
that lists its smallest ids. Vectors are dealt by the nearest of some reference vectors, and among those by how far it
is, into shards of about `shard_rows`; where too many are equally far, by hash. A query is searched in its own shard
first, and then in the shards whose range of distances from their reference vector lets the triangle inequality allow a
nearer one; inside a shard the tree prunes in the same way. `factor` divides the distance that must be bridged: 1 is
exact, larger values prune more.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import broadcast_if_small, stored

#: What rounding may take from a distance of unit vectors; subtrees within it are visited.
SLACK = 1e-7
#: Reference vectors at most, the vectors that they are chosen from, and bins of distance from one.
CELLS, SAMPLE, BINS = 1024, 2048, 1024


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>, dim) of the vectors that are neither null nor zero and hold only finite components."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).select("id", "v", F.size("v").alias("dim")).distinct()


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(h1, h2, dim, v, ids): each different vector once, with its `keep` smallest ids; limited before the shuffle."""
    order = Window.partitionBy("h1", "h2").orderBy("id")
    hashed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    few = hashed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return few.groupBy("h1", "h2").agg(F.first("dim").alias("dim"), F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))


def units(raw: np.ndarray) -> np.ndarray:
    unit = raw / np.abs(raw).max(axis=1, keepdims=True)
    return unit / np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]


class Tree:
    """A vantage-point tree over distinct vectors, as arrays."""

    def __init__(self, ids: list[np.ndarray], vectors: np.ndarray, leaf: int = 64, seed: int = 7):
        self.ids, self.raw, self.unit = ids, vectors, units(vectors)
        self.nodes: list[tuple] = []  # (vantage, radius, inside, outside) or (members,)
        self.root = self._build(np.arange(len(vectors)), leaf, np.random.default_rng(seed))

    def _build(self, rows: np.ndarray, leaf: int, rng) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= leaf:
            self.nodes[at] = (rows,)
            return at
        pick = rng.integers(len(rows))
        vantage, rest = rows[pick], np.delete(rows, pick)
        d = np.linalg.norm(self.unit[rest] - self.unit[vantage], axis=1)
        near = np.zeros(len(rest), dtype=bool)
        near[np.argsort(d, kind="stable")[: len(rest) // 2]] = True
        radius = float(d[near].max(initial=0.0))
        self.nodes[at] = (vantage, radius, self._build(rest[near], leaf, rng), self._build(rest[~near], leaf, rng))
        return at

    def search(self, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's index, id, score) of the k nearest of each query within its bound, itself left out, ties to smaller ids."""
        unit = units(queries)
        worst = bounds.copy()
        found: list[list[tuple[float, int]]] = [[] for _ in ids]  # (distance, node row)

        def meet(q: np.ndarray, rows: np.ndarray) -> None:
            d = np.sqrt(np.maximum(2 - 2 * (unit[q] @ self.unit[rows].T), 0))
            hit = d <= worst[q][:, None] + SLACK
            for x in np.flatnonzero(hit.any(axis=1)):
                own, me = found[q[x]], ids[q[x]]
                own.extend(zip(d[x, hit[x]].tolist(), rows[hit[x]].tolist(), strict=True))
                # the k-th distance counts an equal vector once for each of its ids but the query's own
                own.sort()
                seen = 0
                for far, row in own:
                    seen += int((self.ids[row] != me).sum())
                    if seen >= k:
                        worst[q[x]] = far
                        break
                found[q[x]] = [y for y in own if y[0] <= worst[q[x]] + SLACK]

        stack = [(self.root, np.arange(len(ids)), np.zeros(len(ids)))]
        while stack:
            at, q, bound = stack.pop()
            open_ = bound <= (worst[q] + SLACK) / factor  # what was found since may close a subtree
            q = q[open_]
            if not len(q):
                continue
            if len(self.nodes[at]) == 1:
                meet(q, self.nodes[at][0])
                continue
            vantage, radius, inside, outside = self.nodes[at]
            meet(q, np.array([vantage]))
            d = np.linalg.norm(unit[q] - self.unit[vantage], axis=1)
            near = d <= radius
            zero = np.zeros(len(q))
            # the nearer side is searched first: it is pushed last
            stack.append((outside, q[near], (radius - d)[near]))
            stack.append((inside, q[~near], (d - radius)[~near]))
            stack.append((inside, q[near], zero[near]))
            stack.append((outside, q[~near], zero[~near]))

        norm = lambda v: np.sqrt(np.einsum("ij,ij->i", v, v))
        out_q, out_id, out_s = [], [], []
        for x, own in enumerate(found):
            if not own:
                continue
            rows = np.array([row for _, row in own])
            a, b = np.repeat(queries[x : x + 1], len(rows), axis=0), self.raw[rows]
            scores = np.einsum("ij,ij->i", a, b) / (norm(a) * norm(b))
            best = sorted((-s, int(i)) for s, row in zip(scores.tolist(), rows.tolist(), strict=True) for i in self.ids[row] if i != ids[x])[:k]
            out_q += [x] * len(best)
            out_id += [i for _, i in best]
            out_s += [-s for s, _ in best]
        return np.array(out_q, dtype=np.int64), np.array(out_id, dtype=np.int64), np.array(out_s)


def references(rows: DataFrame, cells: int) -> dict[int, np.ndarray]:
    """Unit vectors far from each other, by dimension, of a sample of at most SAMPLE vectors chosen by hash."""
    sample = rows.orderBy("h1", "h2").select("dim", "v").limit(SAMPLE).collect()
    out = {}
    for dim in sorted({r.dim for r in sample}):
        unit = units(np.array([r.v for r in sample if r.dim == dim]))
        chosen, far = [0], np.linalg.norm(unit - unit[0], axis=1)
        while len(chosen) < min(cells, len(unit)) and far.max() > 1e-9:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(unit - unit[chosen[-1]], axis=1))
        out[dim] = unit[chosen]
    return out


def placed(rows: DataFrame, centres: dict[int, np.ndarray], every: bool = False) -> DataFrame:
    """rows with cell, the nearest reference vector, and far, its distance; with `every` also the distances of all.

    Dimensions that the sample lacks have cell -1, at distance 0.
    """

    def near(v: pd.Series, dim: pd.Series) -> pd.DataFrame:
        found = []
        for k, n in enumerate(dim.tolist()):
            if n in centres:
                d = np.linalg.norm(centres[n] - units(np.asarray(v.iloc[k], dtype=np.float64)[None]), axis=1)
                found.append((int(d.argmin()), float(d.min()), d.tolist() if every else None))
            else:
                found.append((-1, 0.0, [] if every else None))
        return pd.DataFrame(found, columns=["cell", "far", "all"])

    at = F.pandas_udf(near, "cell int, far double, all array<double>")
    return rows.withColumn("at", at("v", "dim")).select(*rows.columns, "at.cell", "at.far", *(["at.all"] if every else []))


def index(rows: DataFrame, centres: dict[int, np.ndarray], shard_rows: int = 4096) -> DataFrame:
    """(dim, cell, shard, least, most, tree binary): every row of distinct_vectors() in the tree of its shard; least and most are distances from the cell's reference vector."""
    at = stored(placed(rows, centres).withColumn("bin", F.least((F.col("far") * (BINS / 2)).cast("int"), F.lit(BINS - 1))))
    bins = at.groupBy("dim", "cell", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("dim", "cell").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    rings = stored(bins.select("dim", "cell", "bin", F.floor(F.coalesce(before, F.lit(0)) / shard_rows).alias("ring"), F.ceil(F.col("n") / shard_rows).alias("parts")))
    dealt = at.join(broadcast_if_small(rings), ["dim", "cell", "bin"]).withColumn("shard", F.xxhash64("dim", "cell", "ring", F.pmod("h2", F.col("parts"))))

    def build(t: pd.DataFrame) -> pd.DataFrame:
        tree = Tree([np.asarray(x) for x in t["ids"]], np.stack(t["v"].to_numpy()).astype(np.float64))
        one = t.iloc[:1][["dim", "cell", "shard"]]
        return one.assign(least=t["far"].min(), most=t["far"].max(), tree=[pickle.dumps(tree)])

    return stored(dealt.select("dim", "cell", "shard", "far", "v", "ids").groupBy("dim", "cell", "shard").applyInPandas(build, "dim int, cell int, shard long, least double, most double, tree binary"))


def blocks_of(asked: DataFrame, block_rows: int) -> DataFrame:
    """(shard, blocks): into how many blocks the queries of each shard are dealt, each with a copy of its tree."""
    return asked.groupBy("shard").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))


def _searched(trees: DataFrame, asked: DataFrame, k: int, factor: float, block_rows: int) -> DataFrame:
    """(query_id, h1, vec_id, score) of queries (id, h1, v, bound, shard): those of a shard in blocks of about `block_rows`."""
    sizes = broadcast_if_small(stored(blocks_of(asked, block_rows)))
    dealt = asked.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("id", "h1"), F.col("blocks")).cast("int"))
    meeting = trees.select("shard", "tree").join(sizes, "shard").select(F.col("shard").alias("at"), "tree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))

    def search(key: tuple, t: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(t):
            return pd.DataFrame({"query_id": [], "h1": [], "vec_id": [], "score": []})
        ids = q["id"].to_numpy()
        at, found, scores = pickle.loads(t["tree"].iloc[0]).search(ids, np.stack(q["v"].to_numpy()).astype(np.float64), q["bound"].to_numpy(), k, factor)
        return pd.DataFrame({"query_id": ids[at], "h1": q["h1"].to_numpy()[at], "vec_id": found, "score": scores})

    return meeting.groupBy("at", "part").cogroup(dealt.groupBy("shard", "block")).applyInPandas(search, "query_id long, h1 long, vec_id long, score double")


def allowed(asked: DataFrame, shards: DataFrame, factor: float) -> DataFrame:
    """(id, h1, v, bound, shard): the shards but a query's own that its bound leaves open, of the cells that it leaves open."""
    numbers = asked.select("id", "h1", "dim", "bound", "shard", F.posexplode("all").alias("cell", "far")).union(asked.select("id", "h1", "dim", "bound", "shard", F.lit(-1), F.lit(0.0)))
    gap = lambda least, most: F.greatest(F.col(least) - F.col("far"), F.col("far") - F.col(most), F.lit(0.0)) <= (F.col("bound") + SLACK) / factor
    # at most CELLS rows for each dimension
    cells = shards.groupBy("dim", "cell").agg(F.min("least").alias("inner"), F.max("most").alias("outer"))
    near = numbers.join(broadcast_if_small(cells), ["dim", "cell"]).where(gap("inner", "outer")).drop("inner", "outer")
    met = near.withColumnRenamed("shard", "own").join(broadcast_if_small(shards), ["dim", "cell"]).where("not shard <=> own")
    open_ = met.where(gap("least", "most")).select("id", "h1", "shard")
    return asked.select("id", "h1", "v", "bound").join(open_, ["id", "h1"])


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, factor: float = 1.0, shard_rows: int = 4096, block_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows nearest to each query by cosine, the query's own left out.

    Vectors null, zero or with null or non-finite components, and rows with a null id, take no part; vectors of
    different lengths are not compared. Repeated rows count once. Ties go to the smaller id. With factor 1 the
    result is exact. Fewer than k candidates: all of them. Empty tables give no rows; no other column is read.
    Any number of equal vectors is one node, with the k + 1 smallest ids.
    """
    rows = stored(distinct_vectors(usable(vectors, id_col, vector_col), k + 1))
    centres = references(rows, min(CELLS, max(1, -(-rows.count() // shard_rows))))
    trees = index(rows, centres, shard_rows)
    shards = stored(trees.drop("tree"))
    asked = usable(queries, id_col, vector_col).withColumn("h1", F.xxhash64("v"))
    asked = stored(placed(asked, centres, every=True))

    gap = F.greatest(F.col("least") - F.col("far"), F.col("far") - F.col("most"), F.lit(0.0))
    numbers = asked.select("id", "h1", "dim", "cell", "far").join(broadcast_if_small(shards), ["dim", "cell"], "left")
    own = numbers.groupBy("id", "h1").agg(F.min_by("shard", F.struct(gap, "shard")).alias("shard"))
    first = stored(asked.join(own, ["id", "h1"]).withColumn("bound", F.lit(float("inf"))))
    found = stored(_searched(trees, first.where("shard is not null"), k, factor, block_rows))
    order = Window.partitionBy("query_id", "h1").orderBy(F.desc("score"), "vec_id")
    last = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    bound = last.select(F.col("query_id").alias("id"), "h1", F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0))).alias("known"))
    bounded = first.drop("bound").join(bound, ["id", "h1"], "left").withColumn("bound", F.coalesce("known", F.lit(float("inf"))))
    others = _searched(trees, stored(allowed(bounded, shards, factor)), k, factor, block_rows)
    # equal ids with different vectors may meet more than once: the best counts
    best = found.union(others).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
