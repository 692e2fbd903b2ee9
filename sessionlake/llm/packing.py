"""Packing of tokenized documents into windows, in order, by dynamic programming over cut candidates.

Each task packs the rows of its own scan split in their order; nothing is shuffled and nothing is gathered. Cuts are
candidates at document ends (free), sentence ends and, at a higher price, every `grain` tokens. The cheapest cuts are
f(j) = min over windows (i, j] of f(i) + padding + penalty(j); as padding is linear in both ends, the minimum over the
reachable i slides forward and a monotone queue yields it in constant time.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_cuts(ends: list[int], penalties: list[float], most: int) -> list[int]:
    """Indexes of the chosen cuts among increasing positions `ends` (from 0 on; the last one is chosen).

    Minimises, over windows of at most `most`, the sum of (most - length), or 0 at a power of two, and of the
    penalties of the cuts. No two neighbouring positions may be further apart than `most`.
    """
    n = len(ends)
    cost, back = [0.0] * (n + 1), [0] * (n + 1)
    at = [0, *ends]
    keys = [0.0] * (n + 1)  # f(i) + position(i), what a window from i costs but for its end
    queue: deque[int] = deque([0])
    place = {0: 0}
    half, quarter = most // 2, most // 4
    for j in range(1, n + 1):
        p = at[j]
        while at[queue[0]] < p - most:
            queue.popleft()
        i = queue[0]
        least = keys[i] + most - p
        for width in (half, quarter):  # windows that need no padding though they aren't full
            k = place.get(p - width)
            if k is not None and cost[k] + most / 16 < least:  # a sequence of its own is worth something too
                least, i = cost[k] + most / 16, k
        cost[j], back[j] = least + penalties[j - 1], i
        key = keys[j] = cost[j] + p
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
        place[p] = j
    chosen, j = [], n
    while j:
        chosen.append(j - 1)
        j = back[j]
    return chosen[::-1]


def _sentence_ends(tokenizer) -> np.ndarray:
    """By id: whether the token ends in a full stop, question or exclamation mark, or holds a line feed."""
    table = np.zeros(max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1, dtype=bool)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        table[i] = token[-1:] in (".", "!", "?") or "Ċ" in token
    return table


class Coder:
    """Ids as the tokenizers file gives them; by its ranks in tiktoken, several times as fast, where these are given too."""

    def __init__(self, tokenizer_file: str, ranks_file: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(tokenizer_file), None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if ranks_file:
            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        """The ids of tokenizer.encode(text, add_special_tokens=False)."""
        if self.fast is None or any(x in text for x in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def packed(docs: DataFrame, tokenizer_file: str | None = None, ranks_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0, sentence_penalty: float = 1.0, grain: int = 16, grain_penalty: float = 6.0, block_tokens: int = 200_000) -> DataFrame:
    """PIECES: every document's ids, then `end_id`, laid in order into windows of at most `window` tokens.

    tokenizer_file: a tokenizers file on every machine, ranks_file: the same byte-level BPE as tiktoken ranks, if any;
    by default the public one of 50k ids. Null and
    empty texts have no ids but `end_id`. Null ids stay null, repeated rows are packed each. Very long texts are cut
    into as many pieces as they need. An empty table gives no rows; no other column is read.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        coder = Coder(tokenizer_file, ranks_file) if tokenizer_file else Coder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
        sentence = _sentence_ends(coder.tokenizer)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        waiting: list[tuple[object, int, int, np.ndarray]] = []  # (doc id, start, tokens of the document, ids from start on)
        held = 0

        def flush(last: bool) -> pd.DataFrame | None:
            nonlocal waiting, held, sequence
            if not waiting:
                return None
            ids = np.concatenate([w[3] for w in waiting])
            doc_ends = np.cumsum([len(w[3]) for w in waiting])
            price = np.full(len(ids) + 1, -1.0)
            price[grain : len(ids) + 1 : grain] = grain_penalty
            price[1:][sentence[np.minimum(ids, len(sentence) - 1)]] = sentence_penalty
            price[doc_ends] = 0.0
            at = np.flatnonzero(price >= 0)
            cuts = at[best_cuts(at.tolist(), price[at].tolist(), window)]
            if not last:  # what lies near the end may be cut better with what follows
                cuts = cuts[cuts <= len(ids) - 8 * window]
            starts = np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts
            end = int(cuts[-1]) if len(cuts) else 0
            # pieces: between the neighbouring ends of windows and documents
            doc_starts = doc_ends - np.array([len(w[3]) for w in waiting])
            bounds = np.unique(np.concatenate([starts, doc_starts[doc_starts < end], [end]])) if end else np.array([0])
            a, b = bounds[:-1], bounds[1:]
            doc = np.searchsorted(doc_ends, a, side="right")
            seq = np.searchsorted(cuts, a, side="right")
            first = np.array([w[1] for w in waiting])
            out = pd.DataFrame({
                "doc_id": pd.array([waiting[d][0] for d in doc], dtype="Int64"), "start": first[doc] + a - doc_starts[doc], "length": b - a,
                "ids_crc32": [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(a.tolist(), b.tolist(), strict=True)],
                "doc_tokens": [waiting[d][2] for d in doc], "sequence_id": sequence + seq, "offset": a - (starts[seq] if len(cuts) else 0),
            })
            sequence += len(cuts)
            rest = []
            for w, s, e in zip(waiting, doc_starts.tolist(), doc_ends.tolist(), strict=True):
                if e > end:
                    skip = max(0, end - s)
                    rest.append((w[0], w[1] + skip, w[2], w[3][skip:]))
            waiting, held = rest, sum(len(w[3]) for w in rest)
            return out

        for t in batches:
            for doc, text in zip(t["doc_id"], t["text"], strict=True):
                ids = np.array([*coder(text), end_id] if isinstance(text, str) else [end_id], dtype=np.int64)
                waiting.append((int(doc) if isinstance(doc, str) else None, 0, len(ids), ids))
                held += len(ids)
                if held >= block_tokens:
                    out = flush(False)
                    if out is not None and len(out):
                        yield out
        out = flush(True)
        if out is not None:
            yield out

    # ids as text: a null id would turn a pandas column of longs into floats
    return docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(pack, PIECES)
