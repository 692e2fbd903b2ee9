"""SHA-256 of long contents: a digest is one chain over its bytes, so tasks take turns and pass on the chain's state."""

from __future__ import annotations

import _hashlib
import ctypes
import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.sources.storage import shared_folder, stored

#: Bytes of a content that one task takes in its turn.
SEGMENT = 256 << 20


@cache
def _library() -> ctypes.CDLL | None:
    """The library behind hashlib, whose SHA-256 has its state in the caller's memory; None if it lacks these functions."""
    try:
        found = ctypes.CDLL(_hashlib.__file__)
        found.SHA256_Init.argtypes, found.SHA256_Update.argtypes, found.SHA256_Final.argtypes = [ctypes.c_char_p], [ctypes.c_char_p, ctypes.c_char_p, ctypes.c_size_t], [ctypes.c_char_p, ctypes.c_char_p]
        return found
    except (AttributeError, OSError):
        return None


class Sha256:
    """As hashlib's, but `state` is bytes with which another process goes on; without the library there is no state."""

    def __init__(self, state: bytes | None = None) -> None:
        self.lib, self.own = _library(), None
        if self.lib is None:
            if state is not None:
                raise ValueError("the library behind hashlib cannot go on with a state")
            self.own = hashlib.sha256()
            return
        # SHA256_CTX has 112 bytes
        self.memory = ctypes.create_string_buffer(state or b"", 128)
        if state is None:
            self.lib.SHA256_Init(self.memory)

    def update(self, data: bytes) -> None:
        if self.own is not None:
            self.own.update(data)
        else:
            self.lib.SHA256_Update(self.memory, data, len(data))

    @property
    def state(self) -> bytes | None:
        return None if self.own is not None else self.memory.raw

    def hexdigest(self) -> str:
        if self.own is not None:
            return self.own.hexdigest()
        out = ctypes.create_string_buffer(32)
        self.lib.SHA256_Final(out, ctypes.create_string_buffer(self.memory.raw, 128))
        return out.raw.hex()


def _continued(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces in order of whole and place, before them the state that is there: the state and the digest so far of each whole."""
    columns = ["whole", "state", "sha256"]
    held, running = None, None
    for batch in batches:
        out, parts = [], []
        for whole, data, state in zip(batch["whole"], batch["bytes"], batch["state"], strict=True):
            if held is None or held[0] != whole:
                if held:
                    running.update(b"".join(parts))
                    out.append((held[0], running.state, running.hexdigest()))
                held, running, parts = (whole,), Sha256(state), []
            if data is not None:
                parts.append(data)
        if held:
            running.update(b"".join(parts))
        yield pd.DataFrame(out, columns=columns)
    if held:
        yield pd.DataFrame([(held[0], running.state, running.hexdigest())], columns=columns)


def chained_digests(pieces: DataFrame) -> DataFrame:
    """(whole, sha256, size) of pieces (whole, at, bytes), which are without gaps in order of their places.

    Pieces are stored by the segment of SEGMENT bytes in which they begin. In each round a task takes a whole's next
    segment and goes on from the state that the round before has written, so a task reads a segment of a whole, and there
    are as many rounds, one after the other, as the longest whole has segments: the chain itself allows no less.
    """
    spark = pieces.sparkSession
    kind, folder, states = dict(pieces.dtypes)["whole"], shared_folder(spark), shared_folder(spark)
    number = F.floor(F.col("at") / SEGMENT) if _library() else F.lit(0)
    pieces.select("whole", "at", "bytes", F.octet_length("bytes").cast("long").alias("length"), number.cast("int").alias("round")).write.partitionBy("round").parquet(folder)
    kept = spark.read.schema(f"whole {kind}, at long, bytes binary, length long, round int").parquet(folder)
    ends = stored(kept.groupBy(F.col("whole").alias("_w")).agg(F.max("round").alias("last"), F.max(F.col("at") + F.col("length")).alias("size")))
    rounds = ends.agg(F.max("last")).first()[0]
    if rounds is None:
        return spark.createDataFrame([], f"whole {kind}, sha256 string, size long")
    known = f"whole {kind}, state binary, sha256 string"
    same = F.col("whole").eqNullSafe(F.col("_w"))
    for k in range(rounds + 1):
        rows = kept.where(F.col("round") == k).select("whole", "at", "bytes", F.lit(None).cast("binary").alias("state"))
        if k:
            before = spark.read.schema(known).parquet(f"{states}/round={k - 1}").join(ends.where(F.col("last") >= k), same)
            rows = rows.union(before.select("whole", F.lit(-1).cast("long"), F.lit(None).cast("binary"), "state"))
        rows.repartition("whole").sortWithinPartitions("whole", "at").mapInPandas(_continued, known).write.parquet(f"{states}/round={k}")
    found = spark.read.schema(f"{known}, round int").parquet(states)
    return found.join(ends, same & (F.col("round") == F.col("last"))).select("whole", "sha256", "size")
