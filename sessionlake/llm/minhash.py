"""MinHash near-duplicates by bottom-k sketches from one hash function.

A sketch is the least k hashes of a document's set of word shingles. Documents of equal sets are one node. Inverted
lists of the first retained values say which nodes can overlap: a value that one node alone retains has no list, and a
node needs to be in the lists of all but its most frequent values only, as similar nodes share several. Nodes that lists
connect are compared in blocks: a pair's sketches give the sketch of their union and how much of it both retain, which
discards all but those that may be similar, and the sets of these decide. Sets are made again from the texts of nodes
in a list; a component of many blocks, or its lists, are dealt out in pairs of blocks, and pairs linked already
are not compared, so copies of one text cost little more than one comparison each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import broadcast_if_small, connected_components, stored
from sessionlake.llm.simhash import shingle_set, words_of

#: Hashes that a sketch retains; at a similarity of 0.8 both retain fewer than half of the union's with probability 1.9e-8 at most.
RETAINED = 64
#: Retained values with an inverted list, and how many of them similar nodes share: fewer at 0.8 with probability 2.5e-7 at most.
LISTED, SHARED = 16, 4
#: Nodes of a block, and hashes of their sets: two blocks meet in a task.
BLOCK, HASHES = 2048, 2_000_000


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, retained: int = RETAINED) -> DataFrame:
    """(doc_id, text_hash, node, n, sketch) of every row: node is a hash of its set of shingles, n the set's size."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    # the explode keeps the set from being computed anew for each column made of it
    sets = rows.select("doc_id", "text_hash", F.explode(F.array(shingle_set("words", shingle))).alias("set"))
    return sets.select("doc_id", "text_hash", F.xxhash64("set").alias("node"), F.size("set").alias("n"), F.slice("set", 1, retained).alias("sketch"))


def inverted_lists(nodes: DataFrame, listed: int = LISTED, shared: int = SHARED) -> DataFrame:
    """(value, node): nodes by those of their first `listed` values that a similar node must have one of.

    Of s values that other nodes retain too, any `shared` include one of the s - shared + 1 least frequent.
    """
    postings = nodes.select("node", "n", F.explode(F.slice("sketch", 1, listed)).alias("value"))
    often = postings.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    known = postings.join(often, "value").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "value"))).alias("values"))
    spare = F.size("values") - F.least(F.lit(shared), F.col("n")) + 1
    return known.where(spare >= 1).select("node", F.explode(F.slice("values", 1, spare)).alias("v")).select("v.value", "node")


def _blocks(group: list[str], members: DataFrame, block: int, hashes: int) -> DataFrame:
    held = members.groupBy(*group).agg(F.count("*").alias("members"), F.sum("n").alias("held")).where("members > 1")
    return held.select(*group, F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("held") / hashes)).cast("int").alias("blocks"))


def _similar(retained: int, percent: int):
    """Of one pair of blocks with their sets: links of at least that similarity, as a forest."""

    def union_share(own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the sketches of the unions of `own` with each of others: values that both retain, and all."""
        both = np.sort(np.concatenate([np.broadcast_to(own, others.shape), others], axis=1), axis=1)
        again = np.zeros(both.shape, dtype=bool)
        again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] >= 0)
        place = np.cumsum((both >= 0) & ~again, axis=1)
        return ((place <= retained) & again).sum(axis=1), np.minimum(place[:, -1], retained)

    def links(t: pd.DataFrame) -> pd.DataFrame:
        t = t.drop_duplicates("node").sort_values(["n", "node"]).reset_index(drop=True)
        node, side, n = t["node"].to_numpy(), t["side"].to_numpy(), t["n"].to_numpy().astype(np.int64)
        ends = np.cumsum(n)
        # codes keep the order of hashes, so a set's first codes are its sketch
        _, codes = np.unique(np.concatenate([np.asarray(s, dtype=np.int64) for s in t["set"]]), return_inverse=True)
        sketch = np.full((len(t), retained), -1, dtype=np.int64)
        for i in range(len(t)):
            sketch[i, : min(n[i], retained)] = codes[ends[i] - n[i] : ends[i]][:retained]
        mark, label, out = np.zeros(codes.max(initial=0) + 2, dtype=bool), np.arange(len(t)), []
        for i in range(len(t) - 1):
            # by size: sets beyond the last are too large for any of this size
            last = np.searchsorted(n, 100 * n[i] // percent, side="right")
            j = np.arange(i + 1, last)
            # blocks of a group meet in pairs: each block with itself once, and each two of them once
            j = j[((side[j] != side[i]) | (side[i] == 2)) & (label[j] != label[i])]
            if not len(j):
                continue
            mark[sketch[i, : min(n[i], retained)]] = True
            both = mark[sketch[j]].sum(axis=1)  # -1 is the last mark, never set
            mark[sketch[i, : min(n[i], retained)]] = False
            j = j[2 * both >= np.minimum(retained, n[j])]
            own = codes[ends[i] - n[i] : ends[i]]
            mark[own] = True
            while len(j):
                some = j[:256]
                shared, all_ = union_share(sketch[i], sketch[some])
                some = some[2 * shared >= all_]
                for k in some:
                    if label[k] != label[i]:
                        common = int(np.count_nonzero(mark[codes[ends[k] - n[k] : ends[k]]]))
                        if 100 * common >= percent * (int(n[k]) + int(n[i]) - common):
                            label[label == label[k]] = label[i]
                            out.append((node[i], node[k]))
                j = j[256:]
                j = j[label[j] != label[i]]
            mark[own] = False
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 80, block: int = BLOCK, hashes: int = HASHES) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row.

    Links are pairs of rows whose sets of word shingles have 100 * intersection >= percent * union, decided on the full
    sets of 64-bit hashes. The sketches lose a link of exactly 0.8 with probability 2.7e-7 at most, and none between
    sets of up to 16 shingles; `percent` below 80 loses more. component_id is the smallest id reachable, itself included;
    kept tells whether it is the row's own. A text of fewer words than a shingle is one shingle; one without words, or
    null, has no shingle, is linked with nothing and is kept. Rows with a null id link others and belong to their
    component; where no id is in a component it is null, and all its rows are kept. Repeated rows stay, each a row.
    Long texts are long sets: a task holds two blocks of `hashes` hashes and a set each. No rows: no rows; columns
    that are not named are not read.
    """
    prints = stored(sketches(docs, id_col, text_col, shingle))
    nodes = stored(prints.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("from"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    listed = stored(inverted_lists(nodes))
    leaders = listed.groupBy("value").agg(F.min("node").alias("leader"), F.count("*").alias("members")).where("members > 1").select("value", "leader")
    met = connected_components(listed.join(leaders, "value").select(F.col("leader").alias("a"), F.col("node").alias("b")))
    member = stored(nodes.select("node", "n").join(met, "node"))

    sized = stored(_blocks(["component"], member, block, hashes))
    # a component of more blocks than a node has lists is compared list by list
    whole = member.join(sized.where(F.col("blocks") <= LISTED), "component").select(F.lit(0).alias("kind"), F.col("component").alias("key"), "node", "n", "blocks")
    crowded = stored(listed.join(member.join(sized.where(F.col("blocks") > LISTED), "component").select("node", "n"), "node"))
    parts = crowded.join(_blocks(["value"], crowded, block, hashes), "value").select(F.lit(1).alias("kind"), F.col("value").alias("key"), "node", "n", "blocks")
    every = stored(whole.union(parts))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = every.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    dealt = dealt.select("kind", "key", "node", "n", F.least("own", "other").alias("block_i"), F.greatest("own", "other").alias("block_j"), side.alias("side"))

    wanted = stored(nodes.join(every.select("node").distinct(), "node").select("node", F.col("from.doc_id").alias("of_id"), F.col("from.text_hash").alias("of_hash")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    held = rows.join(broadcast_if_small(wanted), rows["doc_id"].eqNullSafe(F.col("of_id")) & (rows["text_hash"] == F.col("of_hash"))).select("node", words_of(F.col("text")).alias("words"))
    full = held.select("node", shingle_set("words", shingle).alias("set")).join(broadcast_if_small(dealt), "node")
    linked = full.groupBy("kind", "key", "block_i", "block_j").applyInPandas(_similar(RETAINED, percent), "a long, b long")

    moved = nodes.select("node", "first_id").join(connected_components(linked), "node")
    least = moved.groupBy("component").agg(F.min("first_id").alias("least_id"))
    moved = stored(moved.join(least, "component").select("node", "least_id"))
    of_node = nodes.select("node", "first_id").join(moved, "node", "left").select("node", F.coalesce("least_id", "first_id").alias("component_id"))
    found = prints.drop("sketch").join(of_node, "node", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return found.select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without the near copies: the rows that near_duplicates() keeps, with all their columns."""
    gone = near_duplicates(docs, id_col, text_col, **how).where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__hash"))
    return docs.join(broadcast_if_small(stored(gone)), same, "left_anti")
