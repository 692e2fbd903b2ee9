"""Removal of byte passages that occur anywhere else, by suffix arrays over groups that can share a passage.

1. Every window of `length` bytes is keyed by the least hash of the k-grams in it, a function of its bytes alone, so
   equal windows share their key wherever they are. Neighbouring windows with one key are one segment.
2. Segments whose key occurs once are unique. Equal segments are told by their hash and go on as one of them.
3. The texts of what is left meet by key. Each group's suffixes are sorted in two stages: those smaller than their
   successors directly, the others induced from them by one scan over the buckets of first bytes. Then the common
   prefixes of neighbours in that order are computed; `length` bytes and more mark repeated windows.
A key with more than `most` different segments is divided before that, so no task holds it: its windows are cut into
cells by their distance from the key's k-gram, and cells meet again only where the bytes that all windows of a cell hold
are the same. Cells that are equal as a whole are told by hash, as equal segments are. Cells that many others may share
windows with are cut smaller, at last to single windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import broadcast_if_small, stored

#: Any odd constants do: bases of the rolling hashes and a mixing factor.
BASES, MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), 0xBF58476D1CE4E5B9
SLAB, GRAM = 1 << 19, 32


class Rolling:
    """Hashes of all substrings of one length of a byte array, mod 2^64, vectorised over slabs of bounded size."""

    def __init__(self, most: int, base: int):
        b = np.full(most + 1, base, dtype=np.uint64)
        b[0] = 1
        self.up = np.cumprod(b, dtype=np.uint64)
        b[1:] = pow(base, -1, 2**64)
        self.down = np.cumprod(b, dtype=np.uint64)

    def __call__(self, data: np.ndarray, size: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        h = (sums[size:] - sums[:-size]) * self.down[: len(data) - size + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(MIX)
        return h ^ (h >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(h) - width + 1
    padded = np.full(-(-len(h) // width) * width, np.iinfo(h.dtype).max, dtype=h.dtype)
    padded[: len(h)] = h
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: bytes, length: int, rolling: Rolling) -> Iterator[tuple[int, int, int, int, bool]]:
    """(first window, windows, key, hash of the segment's bytes, whether its key occurs twice in it)."""
    gram = min(GRAM, length)
    width = length - gram + 1
    view, array = memoryview(data), np.frombuffer(data, dtype=np.uint8)
    for base in range(0, len(data) - length + 1, SLAB):
        h = rolling(array[base : base + SLAB + length - 1], gram)
        least = sliding_min(h, width)
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [len(least)]])
        for s, e, v in zip(starts.tolist(), ends.tolist(), least[starts], strict=True):
            # a long run has its key every few bytes: in pieces it stays small
            for a in range(s, e, 4096):
                b = min(e, a + 4096)
                twice = int(np.count_nonzero(h[a : b - 1 + width] == v)) > 1
                yield base + a, b - a, int(v.view(np.int64)), xxhash.xxh3_64_intdigest(view[base + a : base + b - 1 + length]) - (1 << 63), twice


def sorted_directly(c: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Suffixes in order of their first `length` bytes; bucket by bucket of the first byte, so few keys are held at once."""
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([c, np.zeros(length, dtype=c.dtype)]), length)
    at = at[np.argsort(c[at], kind="stable")]
    cuts = np.flatnonzero(np.diff(c[at])) + 1
    out = []
    for part in np.split(at, cuts):
        keys = np.ascontiguousarray(windows[part]).view(f"S{length}").ravel()
        out.append(part[np.argsort(keys, kind="stable")])
    return np.concatenate(out) if out else at


def common_prefixes(c: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """How many bytes each suffix of an order shares with the next, `most` at most.

    In order of positions: where a suffix's neighbour moves on with it, it shares one byte less than the one before.
    So bytes are compared only where such a run begins, to where it could matter.
    """
    if len(order) < 2:
        return np.zeros(0, dtype=np.int64)
    by = np.argsort(order[:-1], kind="stable")
    i, j = order[:-1][by], order[1:][by]
    begins = np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)])
    first = np.flatnonzero(begins)
    need = np.diff(np.append(first, len(i))) + most
    padded = np.concatenate([c, np.zeros(8, dtype=c.dtype)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    word = lambda at: np.ascontiguousarray(words[at]).view(">u8").ravel()
    shared, live, depth = np.zeros(len(first), dtype=np.int64), np.arange(len(first)), 0
    while len(live):
        a, b = i[first[live]] + depth, j[first[live]] + depth
        inside = np.maximum(a, b) < len(c)
        live, a, b = live[inside], a[inside], b[inside]
        x = word(a) ^ word(b)
        same = sum((x < (1 << 8 * k)).astype(np.int64) for k in range(8))
        shared[live] = depth + np.minimum(same, len(c) - np.maximum(a, b))
        depth += 8
        live = live[(same == 8) & (need[live] > depth)]
    run = np.cumsum(begins) - 1
    out = np.empty(len(i), dtype=np.int64)
    out[by] = np.clip(shared[run] - (i - i[first[run]]), 0, most)
    return out


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Of each text, which of its windows of `length` bytes start anywhere else among the texts, as booleans.

    A suffix array of the texts set end to end, limited to suffixes that start a window or that such a one is induced
    from. Suffixes are told apart by at least `length` bytes.
    """
    data = b"".join(texts) + b"\x00\xff"
    c = np.frombuffer(data, dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    firsts = ends - np.array([len(t) for t in texts])
    windows = ends - firsts - length + 1
    # smaller than its successor: decided by the next byte that differs
    differs = np.flatnonzero(c[1:] != c[:-1])
    smaller = (c[:-1] < c[1:])[differs[np.searchsorted(differs, np.arange(len(c) - 1))]]
    direct_at = np.flatnonzero(smaller)
    # windows, and what follows the last of a text up to the next directly sorted suffix
    stops = direct_at[np.searchsorted(direct_at, firsts + windows - 1)]

    def covered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        steps = np.zeros(len(c) + 1, dtype=np.int64)
        np.add.at(steps, a, 1)
        np.add.at(steps, b, -1)
        return np.cumsum(steps)[: len(c)] > 0

    needed, starts = covered(firsts, stops + 1)[: len(c) - 1], covered(firsts, firsts + windows)
    direct = sorted_directly(c, np.flatnonzero(needed & smaller), length)
    cuts = np.searchsorted(c[direct], np.arange(257))
    induced = (needed & ~smaller).tobytes()

    buckets: list[list[int]] = [[] for _ in range(256)]
    order: list[int] = []
    for x in range(256):
        bucket = buckets[x]
        for part in (bucket, direct[cuts[x] : cuts[x + 1]].tolist()):  # the first grows while it is scanned
            for i in part:
                if i and induced[i - 1]:
                    buckets[data[i - 1]].append(i - 1)
            order += part
    suffixes = np.array(order, dtype=np.int64)
    suffixes = suffixes[starts[suffixes]]
    same = np.flatnonzero(common_prefixes(c, suffixes, length) >= length)
    marked = np.zeros(len(c), dtype=bool)
    marked[suffixes[same]] = marked[suffixes[same + 1]] = True
    return [marked[a : a + n] for a, n in zip(firsts.tolist(), windows.tolist(), strict=True)]


def runs(marks: np.ndarray) -> tuple[list[int], list[int]]:
    """First and past-the-last indexes of the runs of True."""
    steps = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist()


SPANS = "array<struct<a:int,b:int>>"


def _sorted_groups(length: int, together: int = 1 << 18):
    """Of rows sorted by group (g1, g2): the repeated windows of each piece, as spans of windows of its segment.

    Whole groups are sorted together up to so many bytes: equal windows are always of one group.
    """

    def repeated(rows: list[tuple[int, int, int, bytes]]) -> pd.DataFrame:
        marks = repeated_windows([x[-1] for x in rows], length)
        out = [(key, seg, [{"a": base + a, "b": base + b} for a, b in zip(*runs(m), strict=True)]) for (key, seg, base, _), m in zip(rows, marks, strict=True) if m.any()]
        return pd.DataFrame(out, columns=["key", "seg", "r"])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows, held = None, [], 0
        for t in batches:
            for g1, g2, key, seg, base, piece in zip(*(t[c].tolist() for c in ("g1", "g2", "key", "seg", "base")), t["piece"], strict=True):
                if held >= together and (g1, g2) != at:
                    yield repeated(rows)
                    rows, held = [], 0
                at = g1, g2
                rows.append((key, seg, base, bytes(piece)))
                held += len(piece)
        if rows:
            yield repeated(rows)

    return work


def _divided(crowd: DataFrame, length: int, most: int, sizes: tuple[int, ...] = (64, 16, 4, 1)) -> tuple[list[DataFrame], list[DataFrame]]:
    """Of segments whose key is too common to be sorted in one task: ([(key, seg, r)] of what repeats as a whole, [(g1,
    g2, key, seg, base, piece)] of what is left to be sorted, at most `most` pieces in a group).

    Windows are dealt into cells by their distance from the key's k-gram, so equal windows are in cells of one place
    whose common bytes are equal. Of equal cells, which Spark counts by 128-bit hashes with partial sums, all repeat and
    one goes on.
    """
    gram, done, groups = min(GRAM, length), [], []

    def cells(size: int):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rolling = Rolling(4096 + 2 * length, BASES[0])
            columns = ["key", "seg", "r", "w1", "w2", "c1", "c2"]
            for t in batches:
                out = []
                for key, seg, n, piece, own in zip(t["key"].tolist(), t["seg"].tolist(), t["n"].tolist(), t["piece"], t["parts"], strict=True):
                    text = bytes(piece)
                    at = np.flatnonzero(rolling(np.frombuffer(text, dtype=np.uint8), gram).view(np.int64) == key)
                    kinds: dict[tuple, list[dict]] = {}  # a text that repeats itself has few of them
                    for part in own if own is not None else [{"a": 0, "b": n}]:
                        a, end = part["a"], part["b"]
                        while a < end:
                            origin = int(at[np.searchsorted(at, a)])  # the first place of the key in the window
                            cell = a - (a - origin) % size
                            b = min(end, cell + size, origin + 1)
                            mark = f"{key} {origin - cell} {size} ".encode()
                            w = xxhash.xxh3_128_intdigest(mark + f"{a - cell} {b - a} ".encode() + text[a : b - 1 + length])
                            c = xxhash.xxh3_128_intdigest(mark + text[cell + size - 1 : cell + length])
                            kinds.setdefault((w, c), []).append({"a": a, "b": b})
                            a = b
                    out += [(key, seg, r, *((x & (2**64 - 1)) - 2**63 for x in (w, w >> 64, c, c >> 64))) for (w, c), r in kinds.items()]
                    if len(out) > 20_000:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=columns)

        return work

    left = crowd.withColumn("parts", F.lit(None).cast(SPANS))
    for size in sizes:
        found = stored(left.mapInPandas(cells(size), f"key long, seg long, r {SPANS}, w1 long, w2 long, c1 long, c2 long"))
        first = F.struct("key", "seg", F.col("r")[0]["a"].alias("a"), F.col("r")[0]["b"].alias("b"))
        equal = stored(found.groupBy("w1", "w2", "c1", "c2").agg(F.sum(F.size("r")).alias("all"), F.min(first).alias("one")))
        same = equal.where("all > 1").select("w1", "w2")
        done.append(found.join(broadcast_if_small(same), ["w1", "w2"], "left_semi").select("key", "seg", "r"))
        if size == 1:
            break
        common = stored(equal.groupBy("c1", "c2").agg(F.count("*").alias("kinds")).where("kinds > 1"))
        others = equal.join(broadcast_if_small(common), ["c1", "c2"]).select("c1", "c2", "kinds", "one.*")

        def parts(which: str, item: Column, others: DataFrame = others) -> DataFrame:
            return crowd.join(others.where(which).groupBy("key", "seg").agg(F.collect_list(item).alias("parts")), ["key", "seg"])  # of one segment

        ready = parts(f"kinds <= {most}", F.struct("c1", "c2", "a", "b")).select("key", "seg", "piece", F.explode("parts").alias("p"))
        cut = F.expr(f"substring(piece, p.a + 1, p.b - p.a - 1 + {length})")
        groups.append(ready.select(F.col("p.c1").alias("g1"), F.col("p.c2").alias("g2"), "key", "seg", F.col("p.a").alias("base"), cut.alias("piece")))
        left = parts(f"kinds > {most}", F.struct("a", "b"))
    return done, groups


def _joined(spans: str, kind: str) -> Column:
    """Spans (a, b past the last) in order of a, those that touch or overlap as one; null: none."""
    none = F.array().cast(f"array<struct<a:{kind},b:{kind}>>")
    last = lambda acc: F.get(acc, F.size(acc) - 1)

    def step(acc: Column, x: Column) -> Column:
        longer = F.struct(last(acc)["a"].alias("a"), F.greatest(last(acc)["b"], x["b"]).alias("b"))
        touches = (F.size(acc) > 0) & (x["a"] <= last(acc)["b"])
        return F.when(touches, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.coalesce(F.col(spans), none), none, step)


def repeated_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = 400, most: int = 256) -> tuple[DataFrame, DataFrame]:
    """((h1, h2) of texts that occur more than once, (h1, h2, spans array<struct<a, b>>) of the others).

    h1 and h2 hash a text. Spans are runs of windows that start elsewhere: bytes a to b, past the last, may touch.
    """
    hashed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.octet_length("text") >= length)
    hashed = hashed.select("id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    copied = stored(hashed.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("id").alias("first_id")).where("copies > 1").select("h1", "h2", "first_id"))
    once = copied.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "first_id", F.lit(True).alias("copied"))
    texts = hashed.join(broadcast_if_small(once), (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left").where(F.col("copied").isNull() | F.col("id").eqNullSafe(F.col("first_id"))).select("h1", "h2", F.encode("text", "UTF-8").alias("text"))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolling = Rolling(SLAB + length, BASES[0])
        columns = ["h1", "h2", "s", "n", "key", "seg", "twice"]
        for t in batches:
            out = []
            for h1, h2, text in zip(t["h1"].tolist(), t["h2"].tolist(), t["text"], strict=True):
                out += [(h1, h2, *x) for x in segments(bytes(text), length, rolling)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    marks = stored(texts.mapInPandas(mark, "h1 long, h2 long, s long, n int, key long, seg long, twice boolean"))
    keys = stored(marks.groupBy("key").agg(F.count("*").alias("all"), F.max("twice").alias("any_twice")).where("all > 1 or any_twice").select("key"))
    shared = stored(marks.join(broadcast_if_small(keys), "key", "left_semi"))
    different = shared.groupBy("key", "seg").agg(F.count("*").alias("copies"), F.max("twice").alias("twice"), F.min(F.struct("h1", "h2", "s", "n")).alias("one"))
    different = stored(different.select("key", "seg", "copies", "twice", "one.*"))
    groups = different.groupBy("key").agg(F.count("*").alias("members"), F.max("twice").alias("any_twice")).where("members > 1 or any_twice")
    unsure = stored(different.join(broadcast_if_small(stored(groups)), "key").select("key", "seg", "h1", "h2", "s", "n", "members"))
    per_text = unsure.groupBy("h1", "h2").agg(F.collect_list(F.struct("key", "seg", "s", "n", "members")).alias("pieces")).select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), "pieces")
    met = texts.join(broadcast_if_small(stored(per_text)), (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2"))).select("text", F.explode("pieces").alias("p"))
    pieces = stored(met.select("p.key", "p.seg", "p.n", "p.members", F.expr(f"substring(text, int(p.s) + 1, p.n - 1 + {length})").alias("piece")))

    done, groups = _divided(stored(pieces.where(F.col("members") > most).select("key", "seg", "n", "piece")), length, most)
    few = pieces.where(F.col("members") <= most).select(F.col("key").alias("g1"), F.lit(0).cast("long").alias("g2"), "key", "seg", F.lit(0).alias("base"), "piece")
    every = reduce(DataFrame.union, groups, few).repartition("g1", "g2").sortWithinPartitions("g1", "g2")
    found = every.mapInPandas(_sorted_groups(length), f"key long, seg long, r {SPANS}")
    parts = reduce(DataFrame.union, done, found).groupBy("key", "seg").agg(F.sort_array(F.flatten(F.collect_list("r"))).alias("r"))
    parts = parts.select("key", "seg", _joined("r", "int").alias("r"))
    whole = different.where("copies > 1").select("key", "seg", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("r"))
    repeated = stored(parts.union(whole))
    spans = shared.join(repeated, ["key", "seg"]).select("h1", "h2", "s", F.explode("r").alias("r"))
    spans = spans.select("h1", "h2", F.struct((F.col("s") + F.col("r.a")).alias("a"), (F.col("s") + F.col("r.b") - 1 + length).alias("b")).alias("span"))
    return copied.select("h1", "h2"), stored(spans.groupBy("h1", "h2").agg(F.sort_array(F.collect_set("span")).alias("spans")))


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary, removed array<struct<a, b>>): a row for each row of docs.

    Removed is each byte covered by a string of `length` bytes that also starts anywhere else, in the same text too;
    strings are judged on the input. Null texts are empty. Texts that occur twice or more go as a whole if they have
    `length` bytes; repeated rows are such texts. Null ids are kept. Kept bytes may end inside a character. An empty
    table gives no rows; other columns are not read. removed holds the runs of removed bytes, a to b, past the last.
    """
    copied, spans = repeated_spans(docs, text_col, id_col, length)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(text, "UTF-8").alias("bytes"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    twice = copied.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.lit(True).alias("copied"))
    spanned = spans.select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), "spans")
    met = rows.join(broadcast_if_small(twice), (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    few = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("n")).first()["n"] <= 500_000
    met = met.join(F.broadcast(spanned) if few else spanned, (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")), "left")
    n = F.octet_length("bytes").cast("long")
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    gone = F.when(F.col("copied"), F.array(F.struct(F.lit(0).cast("long").alias("a"), n.alias("b")))).when(F.col("spans").isNull(), none).otherwise(_joined("spans", "bigint"))
    gone = met.select("doc_id", "bytes", gone.alias("gone"))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("gone", lambda x: x["b"]))
    ends = F.concat(F.transform("gone", lambda x: x["a"]), F.array(n))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substring(F.col("bytes"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))
    hexed = F.unhex(F.concat_ws("", F.transform(kept, F.hex)))
    removed = F.aggregate("gone", F.lit(0).cast("long"), lambda acc, x: acc + x["b"] - x["a"])
    return gone.select("doc_id", n.alias("n_bytes"), removed.alias("n_removed"), F.size("gone").cast("long").alias("n_spans"), F.when(F.size("gone") == 0, F.col("bytes")).otherwise(hexed).alias("kept"), F.col("gone").alias("removed"))
