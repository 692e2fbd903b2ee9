"""Hard negatives by a distributed kNN join over Voronoi cells.

The inner product becomes a distance: a candidate c gets one component more, sqrt(M - |c|^2) for M the largest squared
norm, an anchor a gets 0 there, and |a - c|^2 = |a|^2 + M - 2 a.c. Anchors and candidates are assigned to the nearest of
some pivots. A cell's anchors are first joined with the candidates of the same cell; what they find bounds how far each
cell has to look, and a candidate of another cell is copied only to cells that it might serve: where its distance from
the pivot is, by the cell's radius, neither beyond that bound nor nearer than the scores asked for. Joins are local and
exact, in blocks of candidates and parts of anchors, so a crowded cell is many tasks. Positives come first; their scores
give the windows of scores in which negatives are looked for, by the same join.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import broadcast_if_small, stored

#: Pivots at most, and the anchors that they are chosen from.
CELLS, SAMPLE = 1024, 2048
#: Candidates and requests that meet in a task.
BLOCK, PART = 1024, 1024
#: Integers up to it are exact as double.
EXACT = 2**53


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v array<double>, dim, square): components x become floor(scale * x); rows that lack anything are left out."""
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * scale)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled.alias("s")).where("id is not null and label is not null and s is not null")
    rows = rows.where(F.forall("s", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    # doubles from 2^53 on are whole already
    whole = F.transform("s", lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select("id", "label", whole.alias("v")).distinct()
    rows = rows.select("*", F.size("v").alias("dim"), F.aggregate("v", F.lit(0.0), lambda n, x: n + x * x).alias("square"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    return rows.where(F.col("square") < float("inf"))


def _slack(lift: float) -> float:
    """What rounding may add to a distance between vectors of up to that squared norm."""
    return 1e-6 * (1 + lift**0.5)


def pivots(anchors: DataFrame, cells: int) -> dict[int, tuple[int, np.ndarray]]:
    """By dimension: the number of its first cell, and anchors far from each other of a sample of at most SAMPLE by hash."""
    sample = anchors.orderBy("h1", "h2").select("dim", "v").limit(SAMPLE).collect()
    out, first = {}, 0
    for dim in sorted({r.dim for r in sample}):
        own = np.array([r.v for r in sample if r.dim == dim], dtype=np.float64)
        chosen, far = [0], np.linalg.norm(own - own[0], axis=1)
        while len(chosen) < min(cells, len(own)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(own - own[chosen[-1]], axis=1))
        out[dim] = (first, own[chosen])
        first += len(chosen)
    return out


def in_cells(rows: DataFrame, centres: dict[int, tuple[int, np.ndarray]], lift: float | None, reach: dict[int, tuple[float, float, float]] | None = None) -> DataFrame:
    """rows with own, the nearest pivot's cell, and its distance far; candidates are lifted to the squared norm `lift`.

    With reach, cell: (radius, nearest, farthest) by cell, also `cells` and `fars` of all other cells that a row might
    serve. Dimensions that the sample lacks are one cell each, -1 - dim, at distance 0.
    """

    def place(v: pd.Series, square: pd.Series) -> pd.DataFrame:
        dims, squares = v.map(len).to_numpy(), square.to_numpy()
        own, far = -1 - dims, np.zeros(len(v))
        cells: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * len(v)
        fars: list[np.ndarray] = [np.zeros(0)] * len(v)
        for dim in np.unique(dims):
            if dim not in centres:
                continue
            at = np.flatnonzero(dims == dim)
            first, centre = centres[dim]
            m = np.stack(v.iloc[at].to_numpy()).astype(np.float64)
            top = squares[at] if lift is None else np.full(len(at), lift)
            d = np.sqrt(np.maximum(top[:, None] + (centre * centre).sum(axis=1) - 2 * m @ centre.T, 0))
            best = d.argmin(axis=1)
            own[at], far[at] = first + best, d[np.arange(len(at)), best]
            if reach:
                r = np.array([reach.get(first + k, (0.0, 0.0, -np.inf)) for k in range(len(centre))])
                slack = _slack(lift)
                open_ = (d - r[:, 0] <= r[:, 2] + slack) & (d + r[:, 0] >= r[:, 1] - slack)
                open_[np.arange(len(at)), best] = False
                for x, k in enumerate(at):
                    cells[k] = np.flatnonzero(open_[x]).astype(np.int32) + first
                    fars[k] = d[x, open_[x]]
        return pd.DataFrame({"own": own, "far": far, "cells": cells, "fars": fars})

    at = F.pandas_udf(place, "own int, far double, cells array<int>, fars array<double>")("v", "square")
    return rows.withColumn("at", at).select(*rows.columns, "at.own", "at.far", *(["at.cells", "at.fars"] if reach is not None else []))


def _best(requests: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
    """(rid, place, vec_id, score) of the k best candidates of each request within its window, ties to smaller ids."""
    columns = {"rid": [], "place": [], "vec_id": [], "score": []}
    if len(requests) and len(candidates):
        candidates = candidates.sort_values("id", kind="stable")
        ids, labels = candidates["id"].to_numpy(), candidates["label"].to_numpy()
        c = np.stack(candidates["v"].to_numpy()).astype(np.float64)
        a = np.stack(requests["v"].to_numpy()).astype(np.float64)
        exact = float(np.abs(a).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, a.shape[1]) < EXACT
        whole_c = None if exact else [[int(x) for x in row] for row in c]
        rid, place = requests["rid"].to_numpy(), requests["place"].to_numpy()
        own, label, k = requests["anchor_id"].to_numpy(), requests["label"].to_numpy(), requests["k"].to_numpy()
        same, low, high = requests["same"].to_numpy(), requests["low"].to_list(), requests["high"].to_list()
        none = lambda x: x is None or x != x
        for i in range(len(requests)):
            allowed = ((labels == label[i]) == same[i]) & (ids != own[i])
            if exact:
                s = c @ a[i]
                if not none(low[i]):
                    allowed &= (s >= low[i]) & (s <= high[i])
                at = np.flatnonzero(allowed)
                if len(at) > k[i]:
                    least = np.partition(s[at], len(at) - k[i])[len(at) - k[i]]
                    at = at[s[at] >= least]
                at = at[np.argsort(-s[at], kind="stable")][: k[i]]
                found = [(int(s[x]), ids[x]) for x in at]
            else:
                anchor = [int(x) for x in a[i]]
                scores = ((sum(x * y for x, y in zip(anchor, whole_c[x], strict=True)), x) for x in np.flatnonzero(allowed))
                found = heapq.nsmallest(int(k[i]), ((-s, ids[x]) for s, x in scores if none(low[i]) or low[i] <= s <= high[i]))
                found = [(-s, x) for s, x in found]
            columns["rid"] += [rid[i]] * len(found)
            columns["place"] += [place[i]] * len(found)
            columns["vec_id"] += [x for _, x in found]
            columns["score"] += [max(-(2**63), min(2**63 - 1, s)) for s, _ in found]
    return pd.DataFrame({x: np.array(v, dtype=np.int64) for x, v in columns.items()})


def _joined(requests: DataFrame, candidates: DataFrame, block: int, part: int) -> DataFrame:
    """The best of each request among the candidates of its (cell, tag), from each block of them."""
    asked = requests.groupBy("cell", "tag").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    held = candidates.groupBy("cell", "tag").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = broadcast_if_small(stored(asked.join(held, ["cell", "tag"])))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = F.pmod(F.xxhash64("rid", "place"), F.col("parts")).cast("int")
    left = requests.join(sizes, ["cell", "tag"]).select("cell", "tag", own.alias("part"), "rid", "place", "anchor_id", "label", "v", "low", "high", "k", "same", numbers("blocks").alias("block"))
    own = F.pmod(F.xxhash64("id", "h1"), F.col("blocks")).cast("int")
    right = candidates.join(sizes, ["cell", "tag"]).select("cell", "tag", own.alias("block"), "id", "label", "v", numbers("parts").alias("part"))
    key = ["cell", "tag", "part", "block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_best, "rid long, place long, vec_id long, score long")


def _least(found: DataFrame, requests: DataFrame) -> DataFrame:
    """(rid, place, rank, vec_id, score): the first k of each request."""
    order = Window.partitionBy("rid", "place").orderBy(F.desc("score"), "vec_id")
    k = requests.agg(F.max("k")).first()[0] or 0
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_in_windows(requests: DataFrame, candidates: DataFrame, centres: dict[int, tuple[int, np.ndarray]], lift: float, same: bool, block: int = BLOCK, part: int = PART) -> DataFrame:
    """(rid, place, rank, vec_id, score): the first k candidates of each request by score, then id.

    requests (rid, place, anchor_id, label, v, square, low, high, k) want candidates of the same label or, without
    `same`, of another one, with a score from low to high (null: any) and another id than theirs.
    candidates (id, label, v, square, h1, own), as in_cells() places them.
    """
    tag = lambda label: label if same else F.lit(0)
    asked = stored(in_cells(requests.withColumn("same", F.lit(same)), centres, None).withColumnRenamed("own", "cell").withColumn("tag", tag(F.col("label")).cast("long")))
    near = candidates.withColumn("tag", tag(F.col("label")).cast("long"))
    first = stored(_joined(asked, near.withColumnRenamed("own", "cell"), block, part))

    known = _least(first, requests).where(F.col("rank") == requests.agg(F.max("k")).first()[0]).select("rid", "place", F.col("score").alias("known"))
    # greatest() passes over nulls
    distance = lambda score: F.when(score.isNotNull(), F.sqrt(F.greatest(F.col("square") + F.lit(lift) - 2 * score, F.lit(0.0))))
    bound = F.greatest(F.col("known"), F.col("low")).cast("double")
    bounded = asked.join(known, ["rid", "place"], "left").select("cell", "tag", "far", F.coalesce(distance(bound), F.lit(float("inf"))).alias("to"), F.coalesce(distance(F.col("high").cast("double")), F.lit(0.0)).alias("from"))
    groups = stored(bounded.where("cell >= 0").groupBy("cell", "tag").agg(F.max("far").alias("radius"), F.min("from").alias("from"), F.max("to").alias("to")))
    # at most a row for each pivot
    reach = {r.cell: (r.radius, r["from"], r.to) for r in groups.groupBy("cell").agg(F.max("radius").alias("radius"), F.min("from").alias("from"), F.max("to").alias("to")).collect()}
    met = in_cells(near.drop("own"), centres, lift, reach).select("tag", "id", "label", "v", "h1", F.explode(F.arrays_zip("cells", "fars")).alias("x")).select("tag", "id", "label", "v", "h1", F.col("x.cells").alias("cell"), F.col("x.fars").alias("d"))
    slack = _slack(lift)
    open_ = (F.col("d") - F.col("radius") <= F.col("to") + slack) & (F.col("d") + F.col("radius") >= F.col("from") - slack)
    copied = met.join(broadcast_if_small(groups), ["cell", "tag"]).where(open_).select("cell", "tag", "id", "label", "v", "h1")
    return _least(first.union(_joined(asked, copied, block, part)), requests).select("rid", "place", "rank", "vec_id", "score")


def _share(score: str, percent: int, up: bool) -> Column:
    """The least whole number from `percent` of a score on, or the largest up to it, without leaving 64 bits."""
    rest = F.pmod(F.col(score), F.lit(100))
    part = F.ceil(percent * rest / 100) if up else F.floor(percent * rest / 100)
    return (F.expr(f"({score} - pmod({score}, 100)) div 100") * percent + part).cast("long")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: int = 256, cell_anchors: int = 64, block: int = BLOCK, part: int = PART,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are integer inner products of floor(scale * component). An anchor's positives are the best `positives` other
    rows of its label, ties to smaller ids; for each, negatives are the best `negatives` rows of other labels whose
    score is from `low` to `high` percent of the positive's. Fewer: all of them; none: no rows. is_anchor is a
    condition on columns `id` and `label` of the rows that take part.

    Rows with a null id, label or vector, or with components that are null or not finite when scaled, take no part, nor do those
    whose squared norm is beyond a double;
    vectors of other lengths have no score. Repeated equal rows count once; an id with several vectors or labels is as
    many rows, none of them a partner of another. Scores beyond 64 bits are ordered exactly, shown as the largest. Of
    equal vectors of a label only the ids that can be returned are kept, so any number of them is cheap. Pivots come from
    at most 2,048 anchors. Empty tables: no rows; columns that are not named are not read.
    """
    rows = stored(whole_vectors(vectors, id_col, vector_col, label_col, scale))
    anchors = stored(rows.where(is_anchor).withColumn("rid", F.xxhash64("id", "label", "h1", "h2")))
    centres = pivots(anchors, min(CELLS, max(1, -(-anchors.count() // cell_anchors))))
    lift = rows.agg(F.max("square")).first()[0] or 0.0
    twins = Window.partitionBy("h1", "h2", "label").orderBy("id")
    few = rows.withColumn("twin", F.row_number().over(twins)).where(F.col("twin") <= max(positives + 1, negatives + 1)).drop("twin")
    placed = stored(in_cells(few, centres, lift).drop("far"))

    nothing = F.lit(None).cast("long")
    asked = anchors.select("rid", F.lit(0).cast("long").alias("place"), F.col("id").alias("anchor_id"), "label", "v", "square", nothing.alias("low"), nothing.alias("high"), F.lit(positives).alias("k"))
    best = stored(best_in_windows(asked, placed, centres, lift, True, block, part).select("rid", F.col("rank").cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    windows = anchors.join(best, "rid").withColumns({"low": _share("positive_score", low, True), "high": _share("positive_score", high, False)}).where("low <= high")
    wanted = stored(windows.select("rid", "place", F.col("id").alias("anchor_id"), "label", "v", "square", "low", "high", F.lit(negatives).alias("k")))
    worst = best_in_windows(wanted, placed, centres, lift, False, block, part)
    told = reduce(lambda d, x: d.withColumnRenamed(*x), [("vec_id", "negative_id"), ("score", "negative_score")], worst)
    of_anchor = best.join(anchors.select("rid", F.col("id").alias("anchor_id")), "rid")
    return told.join(of_anchor, ["rid", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
