"""SimHash near-duplicates: fingerprints by Spark's own functions, links by pivot distance tables.

Fingerprints: each word shingle is hashed by XXH64 inside generated code, and the 64 bit counts of a document are
kept as 32 sums of two 32-bit lanes, which combine before the shuffle; texts are never shuffled.

Links: two fingerprints within `distance` bits agree on at least two of `distance` + 2 bands of bits, so those that
share two bands meet in an equi-join key. There a pair is discarded if their precomputed Hamming distances to the
reference fingerprints (pivots) differ by more than `distance` in any coordinate (triangle inequality); the survivors
are verified. Equal fingerprints count once. A bucket gives at most a spanning forest of its links, as only the
components are asked for; a large bucket is dealt out in pairs of blocks, so no task holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import SPACES, ascii_lower, broadcast_if_small, connected_components, stored

#: Reference fingerprints: any fixed set does; these come from a multiplicative sequence.
PIVOTS = [(i * 0x9E3779B97F4A7C15 ^ (i << 29) * 0xBF58476D1CE4E5B9) & (2**64 - 1) for i in range(1, 17)]
#: Members of a bucket that one task compares with as many others.
BLOCK = 2048
#: Shingle hashes of a block of verified documents: 16 MB.
SHINGLES = 2_000_000


def _mixed(k: int) -> int:
    return ((k + 1) * 0x94D049BB133111EB ^ (k + 77) * 0x9E3779B97F4A7C15 << 13) & (2**64 - 1)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text with A-Z lower-cased; empty or null: no words."""
    trimmed = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, minima: int = 0) -> DataFrame:
    """(doc_id, text_hash, fingerprint long) of every distinct (id, text); with `minima` also that many least shingle
    hashes m0, m1, ..., each under another permutation.

    Null and empty texts have no shingle and fingerprint 0; shorter texts than a shingle are one shingle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    each = rows.select("doc_id", "text_hash", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - shingle, F.lit(0)))).alias("i"))
    hashed = each.select("doc_id", "text_hash", (F.size("words") > 0).alias("any"), F.xxhash64(F.concat_ws(" ", *(F.get("words", F.col("i") + k) for k in range(shingle)))).alias("h"))
    lanes = [F.sum(F.when(F.col("any"), F.shiftrightunsigned("h", j).bitwiseAND(F.lit(0x0000000100000001)))).alias(f"s{j}") for j in range(32)]
    counted = hashed.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), *lanes, *(F.min(F.col("h").bitwiseXOR(F.lit(_signed(_mixed(k))))).alias(f"m{k}") for k in range(minima)))

    def bit(j: int) -> Column:
        count = F.shiftrightunsigned(f"s{j % 32}", 32) if j >= 32 else F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(2 * count > F.col("n"), F.lit(_signed(1 << j))).otherwise(F.lit(0))

    return counted.select("doc_id", "text_hash", reduce(lambda a, b: a.bitwiseOR(b), (bit(j) for j in range(64))).cast("long").alias("fingerprint"), *(f"m{k}" for k in range(minima)))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


KEY = ["combo", "bits", "block_i", "block_j"]
#: Rows that a task works on at once; whole blocks, so a block more at most.
CHUNK = 250_000


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by KEY set together to about CHUNK rows, cut between keys."""
    held: list[pd.DataFrame] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= CHUNK:
            t = pd.concat(held, ignore_index=True)
            keys = t[KEY].to_numpy()
            cut = len(t) - 1 - int((keys != keys[-1]).any(axis=1)[::-1].argmax()) if (keys[0] != keys[-1]).any() else -1
            if cut >= 0:
                yield t.iloc[: cut + 1]
            held = [t.iloc[cut + 1 :]]
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def _forest(distance: int):
    """Of rows sorted by bucket: links of each bucket's members, as a forest."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in _chunks(batches):
            yield linked(t)

    def linked(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values([*KEY, "fp"], kind="stable").reset_index(drop=True)
        fp, side = t["fp"].to_numpy(), t["side"].to_numpy()
        keys = t[KEY].to_numpy()
        run = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))])
        table = np.stack([t["pivots_a"].to_numpy(), t["pivots_b"].to_numpy()], axis=1).view(np.uint8).astype(np.int16)
        parent = np.arange(len(fp))

        def root(x: np.ndarray) -> np.ndarray:
            while not np.array_equal(y := parent[x], x):
                x = y
            return x

        at, shift, out_a, out_b = np.arange(len(fp)), 0, [], []
        while True:
            shift += 1
            at = at[at + shift < len(fp)]
            at = at[run[at] == run[at + shift]]
            if not len(at):
                break
            # a bucket dealt out in blocks compares each pair of blocks, and each block with itself, once
            i = at[(side[at] != side[at + shift]) | (side[at] == 2)]
            i = i[fp[i] != fp[i + shift]]
            i = i[np.abs(table[i] - table[i + shift]).max(axis=1, initial=0) <= distance]
            i = i[_popcount(fp[i] ^ fp[i + shift]) <= distance]
            if len(i):
                i = i[root(i) != root(i + shift)]
            for a, b in zip(i.tolist(), (i + shift).tolist(), strict=True):
                ra, rb = int(root(np.array([a]))[0]), int(root(np.array([b]))[0])
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    out_a.append(fp[a])
                    out_b.append(fp[b])
        return pd.DataFrame({"a": np.array(out_a, dtype=np.int64), "b": np.array(out_b, dtype=np.int64)})

    return links


def links(distinct: DataFrame, distance: int = 3, block: int = BLOCK, keys: DataFrame | None = None) -> DataFrame:
    """(a, b) links between the distinct fingerprints in column fp that give the same components as all links.

    keys (fp, combo, bits): those with an equal (combo, bits) meet, in place of those that share two bands.
    """
    bands = distance + 2
    cuts = [64 * k // bands for k in range(bands + 1)]
    masks = [sum(1 << b for x in pair for b in range(cuts[x], cuts[x + 1])) for pair in combinations(range(bands), 2)]
    packed = [reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("long"), 8 * k) for k, p in enumerate(half))) for half in (PIVOTS[:8], PIVOTS[8:])]
    tabled = distinct.select("fp", packed[0].alias("pivots_a"), packed[1].alias("pivots_b"))
    if keys is not None:
        keyed = keys.join(tabled, "fp")
    else:
        keyed = tabled.select("*", F.explode(F.array(*(F.struct(F.lit(c).alias("combo"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for c, m in enumerate(masks)))).alias("k")).select("fp", "pivots_a", "pivots_b", "k.combo", "k.bits")
    sizes = keyed.groupBy("combo", "bits").agg(F.count("*").alias("members")).where("members > 1")
    met = keyed.join(sizes, ["combo", "bits"]).withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = met.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("combo", "bits", "fp", "pivots_a", "pivots_b", F.least("own", "other").alias("block_i"), F.greatest("own", "other").alias("block_j"), F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    return dealt.repartition(*KEY).sortWithinPartitions(*KEY).mapInPandas(_forest(distance), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, pairs: int = 0) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id) of every distinct (id, text).

    Without `pairs` all links are found, which suits a few bits. For larger distances fingerprints meet if their texts
    share two least shingle hashes in one of `pairs` pairs of permutations: texts of Jaccard similarity s miss each
    other with probability (1 - s * s) ** pairs.

    component_id is the smallest id reachable over links of at most `distance` bits, itself included. Rows with a
    null id have a fingerprint and a component, whose id others give (null if none). Repeated equal rows count
    once; an id with several texts has a row for each. An empty table gives no rows; other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, 2 * pairs))
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("fingerprint", "fp"))
    keys = None
    if pairs:
        met = F.array(*(F.struct(F.lit(k).alias("combo"), F.xxhash64(f"m{2 * k}", f"m{2 * k + 1}").alias("bits")) for k in range(pairs)))
        keys = prints.select(F.col("fingerprint").alias("fp"), F.explode(met).alias("k")).select("fp", "k.combo", "k.bits").distinct()
    nodes = connected_components(links(distinct, distance, keys=keys))
    linked = distinct.join(nodes, distinct["fp"] == nodes["node"])
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    moved = linked.select("fp", "component").join(least, "component").select("fp", "least_id")
    of_print = distinct.join(moved, "fp", "left").select(F.col("fp").alias("fingerprint"), F.coalesce(F.least("least_id", "first_id"), "first_id").alias("component_id"))
    return prints.join(of_print, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id")


def shingle_set(words: str, shingle: int) -> Column:
    """The sorted distinct hashes of the word shingles in an array column of words; no words: an empty array."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - shingle, F.lit(0)))
    each = F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(words, i + k) for k in range(shingle)))))
    return F.when(F.size(words) > 0, F.sort_array(F.array_distinct(each))).otherwise(F.array().cast("array<bigint>"))


def set_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, minima: int) -> DataFrame:
    """(doc_id, text_hash, node, n, fp, m0, ...) of every distinct (id, text): as fingerprints(), each different shingle
    counted once. node is a hash of the set, n its size."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    # each explode keeps what it wraps from being computed anew for each shingle
    sets = rows.select("doc_id", "text_hash", F.explode(F.array(shingle_set("words", shingle))).alias("set"))
    sized = sets.select("doc_id", "text_hash", F.explode(F.array(F.struct(F.xxhash64("set").alias("node"), F.size("set").alias("n"), "set"))).alias("s"))
    hashed = sized.select("doc_id", "text_hash", "s.node", "s.n", F.explode_outer("s.set").alias("h"))
    lanes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(0x0000000100000001))).alias(f"s{j}") for j in range(32)]
    least = [F.min(F.col("h").bitwiseXOR(F.lit(_signed(_mixed(k))))).alias(f"m{k}") for k in range(minima)]
    counted = hashed.groupBy("doc_id", "text_hash", "node", "n").agg(F.count("*").alias("rows"), *lanes, *least)

    def bit(j: int) -> Column:
        count = F.shiftrightunsigned(f"s{j % 32}", 32) if j >= 32 else F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(2 * count > F.col("rows"), F.lit(_signed(1 << j))).otherwise(F.lit(0))

    return counted.select("doc_id", "text_hash", "node", "n", reduce(lambda a, b: a.bitwiseOR(b), (bit(j) for j in range(64))).cast("long").alias("fp"), *(f"m{k}" for k in range(minima)))


def _verified(distance: int, similarity: float):
    """Of one bucket's members with their shingle sets: links of at least that Jaccard similarity, as a forest."""

    def links(t: pd.DataFrame) -> pd.DataFrame:
        t = t.drop_duplicates("node").reset_index(drop=True)
        node, fp, side, n = t["node"].to_numpy(), t["fp"].to_numpy(), t["side"].to_numpy(), t["n"].to_numpy()
        _, codes = np.unique(np.concatenate([np.asarray(s, dtype=np.int64) for s in t["set"]]), return_inverse=True)
        ends = np.cumsum(n)
        label, mark, out = np.arange(len(t)), np.zeros(codes.max(initial=0) + 1, dtype=bool), []
        for i in range(len(t) - 1):
            j = np.arange(i + 1, len(t))
            # a bucket dealt out in blocks compares each pair of blocks, and each block with itself, once
            j = j[((side[j] != side[i]) | (side[i] == 2)) & (label[j] != label[i])]
            j = j[_popcount(fp[j] ^ fp[i]) <= distance]
            j = j[np.minimum(n[j], n[i]) >= similarity * np.maximum(n[j], n[i]) - 1e-9]
            own = codes[ends[i] - n[i] : ends[i]]
            mark[own] = True
            while len(j):
                some = j[:64]
                shared = np.array([np.count_nonzero(mark[codes[ends[k] - n[k] : ends[k]]]) for k in some])
                for k in some[shared >= similarity * (n[some] + n[i] - shared) - 1e-9]:
                    if label[k] != label[i]:
                        label[label == label[k]] = label[i]
                        out.append((node[i], node[k]))
                j = j[64:]
                j = j[label[j] != label[i]]
            mark[own] = False
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def verified_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, distance: int = 28, pairs: int = 10, similarity: float = 0.8, shingles: int = SHINGLES) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id) as near_duplicates(), over links of exact similarity.

    A link is a Jaccard similarity of at least `similarity` of the sets of word shingles. Fingerprints and shared minima
    only find candidates: components over them tell which documents may meet. The sets, hashes only, are made of these
    documents alone and are sent once for each block of a component, or for each shared pair of minima where a component
    has more blocks than there are pairs; no task holds more than two blocks of `shingles` hashes and a document each.
    Texts without words are copies of each other.
    """
    prints = stored(set_fingerprints(docs, id_col, text_col, shingle, 2 * pairs))
    minima = [F.min(f"m{k}").alias(f"m{k}") for k in range(2 * pairs)]
    nodes = stored(prints.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("from"), F.min("n").alias("n"), F.min("fp").alias("fp"), *minima))
    met = F.array(*(F.struct(F.lit(k).alias("combo"), F.xxhash64(f"m{2 * k}", f"m{2 * k + 1}").alias("bits")) for k in range(pairs)))
    keys = nodes.where("n > 0").select("node", "fp", "n", F.explode(met).alias("k")).select("node", "fp", "n", "k.combo", "k.bits")
    candidates = connected_components(links(nodes.where("n > 0").select("fp").distinct(), distance, keys=keys.select("fp", "combo", "bits").distinct()))
    member = nodes.where("n > 0").select("node", "fp", "n").join(candidates.withColumnRenamed("node", "fp"), "fp", "left")
    member = stored(member.select("node", "fp", "n", F.coalesce("component", "fp").alias("component")))

    def blocks_of(group: list[str], t: DataFrame) -> DataFrame:
        held = t.groupBy(*group).agg(F.count("*").alias("members"), F.sum("n").alias("held")).where("members > 1")
        return held.select(*group, F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("held") / shingles)).cast("int").alias("blocks"))

    sized = stored(blocks_of(["component"], member))
    whole = member.join(sized.where(F.col("blocks") <= pairs), "component").select(F.lit(-1).alias("combo"), F.col("component").alias("bits"), "node", "fp", "n", "blocks")
    crowded = keys.join(member.join(sized.where(F.col("blocks") > pairs), "component").select("node"), "node", "left_semi")
    parts = crowded.join(blocks_of(["combo", "bits"], crowded), ["combo", "bits"]).select("combo", "bits", "node", "fp", "n", "blocks")
    every = stored(whole.union(parts))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = every.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("combo", "bits", "node", "fp", "n", F.least("own", "other").alias("block_i"), F.greatest("own", "other").alias("block_j"), F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    wanted = stored(nodes.join(every.select("node").distinct(), "node").select("node", F.col("from.doc_id").alias("of_id"), F.col("from.text_hash").alias("of_hash")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    held = rows.join(broadcast_if_small(wanted), rows["doc_id"].eqNullSafe(F.col("of_id")) & (rows["text_hash"] == F.col("of_hash"))).select("node", words_of(F.col("text")).alias("words"))
    held = held.select("node", shingle_set("words", shingle).alias("set"))
    full = held.join(broadcast_if_small(dealt), "node").select("combo", "bits", "block_i", "block_j", "node", "fp", "n", "side", "set")
    linked = full.groupBy("combo", "bits", "block_i", "block_j").applyInPandas(_verified(distance, similarity), "a long, b long")

    found = connected_components(linked)
    moved = nodes.select("node", "first_id").join(found, "node")
    least = moved.groupBy("component").agg(F.min("first_id").alias("least_id"))
    moved = moved.join(least, "component").select("node", "least_id")
    of_node = nodes.select("node", "first_id").join(moved, "node", "left").select("node", F.coalesce("least_id", "first_id").alias("component_id"))
    return prints.join(of_node, "node").select("doc_id", "text_hash", F.col("fp").alias("fingerprint"), "component_id")
