"""Captured streams: events framed from byte chunks with state, messages folded from events, open ledgers, progress snapshots."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FRAME_END = re.compile(rb"\r?\n\r?\n")
EVENTS = "exchange_id string, sequence long, event string, id string, data string, raw_size long, unterminated boolean"


def event_fields(frame: bytes) -> tuple[str | None, str | None, str | None]:
    """(event, id, data) of a frame's lines: comments go, one space after the colon goes, data lines are joined by line feeds."""
    fields: dict[bytes, bytes | None] = {b"event": None, b"id": None}
    data = []
    for line in frame.splitlines():
        name, colon, value = line.partition(b":")
        value = value[1:] if colon and value.startswith(b" ") else value
        if name == b"data":
            data.append(value)
        elif name in fields:
            fields[name] = value
    text = [None if v is None else v.decode("utf-8", "replace") for v in (fields[b"event"], fields[b"id"])]
    return text[0], text[1], b"\n".join(data).decode("utf-8", "replace") if any(data) else None


def _framed(key: str | None, buffer: bytes, sequence: int, ended: bool) -> tuple[list[tuple], bytes, int]:
    """The events that a response's bytes complete, what is left of them, and the next event's number."""
    out = []
    frames = FRAME_END.split(buffer)
    rest = frames.pop()
    for frame, tail in [*((f, False) for f in frames), *([(rest, True)] if ended and rest else [])]:
        if frame:
            out.append((key, sequence, *event_fields(frame), len(frame), tail))
            sequence += 1
    return out, b"" if ended else rest, sequence


def _framed_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks in order of exchange and place: many responses a batch; one that goes on in the next leaves its bytes and number."""
    columns = [c.split()[0] for c in EVENTS.split(", ")]
    held, buffer, sequence, ended, parts = None, b"", 0, False, []
    for batch in batches:
        out = []
        for key, chunk, last in zip(batch["exchange_id"], batch["chunk"], batch["last"], strict=True):
            if held is None or held[0] != key:
                out += _framed(held[0], buffer + b"".join(parts), sequence, ended)[0] if held else []
                held, buffer, sequence, ended, parts = (key,), b"", 0, False, []
            if chunk is not None:
                parts.append(chunk)
            ended = ended or bool(last)
        if held:
            found, buffer, sequence = _framed(held[0], buffer + b"".join(parts), sequence, False)
            out, parts = out + found, []
        yield pd.DataFrame(out, columns=columns)
    if held:
        yield pd.DataFrame(_framed(held[0], buffer, sequence, ended)[0], columns=columns)


def _first_events(raw: pd.Series) -> pd.DataFrame:
    none = (None, None, None)
    read = lambda x: none if x is None else next((event_fields(f) for f in FRAME_END.split(x) if f), none)
    return pd.DataFrame([read(x) for x in raw], columns=["event", "id", "data"])


def first_event(raw: Column) -> Column:
    """The first event (event, id, data) of bytes that are read alone; all null where there is none."""
    return F.pandas_udf(_first_events, "event string, id string, data string")(raw)


def sse_events(chunks: DataFrame) -> DataFrame:
    """(exchange_id, sequence, event, id, data, raw_size, unterminated) of byte chunks (exchange_id, pos, chunk, last) of a batch or a stream.

    A frame ends with an empty line, which may be cut anywhere; what follows the last one comes out, marked, with the chunk
    that is `last`. On a stream the bytes that are left and the next number are an exchange's state; a trigger brings an
    exchange's chunks in their order. A response's chunks are one task's, other exchanges' are not; a batch's chunks pass
    tasks in order, so a response costs its bytes, no call of its own.
    """
    columns = [c.split()[0] for c in EVENTS.split(", ")]
    if not chunks.isStreaming:
        rows = chunks.select(F.col("exchange_id").cast("string").alias("exchange_id"), "pos", "chunk", F.coalesce("last", F.lit(False)).alias("last"))
        return rows.repartition("exchange_id").sortWithinPartitions("exchange_id", F.asc_nulls_last("pos")).mapInPandas(_framed_in_order, EVENTS)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        buffer, sequence = state.get if state.exists else (b"", 0)
        new = pd.concat(list(parts)).sort_values("pos")
        buffer = bytes(buffer) + b"".join(bytes(c) for c in new["chunk"] if c is not None)
        out, buffer, sequence = _framed(key[0], buffer, sequence, bool(new["last"].fillna(False).any()))
        state.update((buffer, sequence))
        yield pd.DataFrame(out, columns=columns)

    return chunks.groupBy("exchange_id").applyInPandasWithState(step, EVENTS, "buffer binary, sequence long", "append", GroupStateTimeout.NoTimeout)


def _at(path: str) -> Column:
    return F.get_json_object("data", path)


# Kinds of deltas with the field that holds their part.
DELTAS = {"text": ("text_delta", "$.delta.text"), "thinking": ("thinking_delta", "$.delta.thinking"), "signature": ("signature_delta", "$.delta.signature"), "input_json": ("input_json_delta", "$.delta.partial_json")}
USAGE = ["input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens"]


def folded_blocks(events: DataFrame) -> DataFrame:
    """(exchange_id, index, type, text, thinking, signature, input, input_json_incomplete) of events' content blocks: parts in order of events.

    Input that is no JSON is null, its text then stands in input_json_incomplete. A block's parts are one response's.
    """
    kind = F.coalesce(_at("$.type"), F.col("event"))
    rows = events.withColumn("kind", kind).where(F.col("kind").isin("content_block_start", "content_block_delta"))
    start = F.col("kind") == "content_block_start"
    part = lambda name: F.when(start & F.lit(name != "input_json"), _at(f"$.content_block.{name}")).when(_at("$.delta.type") == DELTAS[name][0], F.coalesce(_at(DELTAS[name][1]), F.lit("")))
    placed = rows.select("exchange_id", "sequence", F.coalesce(_at("$.index").cast("int"), F.lit(0)).alias("index"), F.when(start, _at("$.content_block.type")).alias("type"), *(part(n).alias(n) for n in DELTAS))
    listed = lambda n: F.sort_array(F.collect_list(F.when(F.col(n).isNotNull(), F.struct("sequence", n))))[n]
    joined = lambda n: F.when(F.size(listed(n)) > 0, F.array_join(listed(n), "")).alias(n)
    sums = placed.groupBy("exchange_id", "index").agg(F.min_by("type", F.when(F.col("type").isNotNull(), F.col("sequence"))).alias("type"), *map(joined, DELTAS))
    shown = F.coalesce("type", F.when(F.col("text").isNotNull(), "text").when(F.col("thinking").isNotNull(), "thinking"))
    tool = F.col("type") == "tool_use"
    valid = F.try_parse_json("input_json").isNotNull()
    return sums.select("exchange_id", "index", shown.alias("type"), "text", "thinking", "signature", F.when(tool & valid, F.col("input_json")).alias("input"), F.when(tool & ~valid, F.col("input_json")).alias("input_json_incomplete"))


def folded_messages(events: DataFrame) -> DataFrame:
    """(exchange_id, model, stop_reason, usage fields, complete): the last known value of each; complete once a stop event came. Works on streams in update mode."""
    kind = F.coalesce(_at("$.type"), F.col("event"))
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("sequence")))
    usage = lambda u: F.coalesce(_at(f"$.usage.{u}"), _at(f"$.message.usage.{u}")).cast("long")
    known = [last(F.coalesce(_at("$.message.model"), _at("$.delta.model"))).alias("model"), last(F.coalesce(_at("$.delta.stop_reason"), _at("$.message.stop_reason"))).alias("stop_reason"), *(last(usage(u)).alias(u) for u in USAGE)]
    return events.groupBy("exchange_id").agg(*known, F.max(F.coalesce(kind == "message_stop", F.lit(False))).alias("complete"))


# Events that close a request for a sandbox, and those that end a sandbox.
RESOLVING, ENDING = ["created", "create_failed", "create_cancelled_without_sandbox"], ["killed", "kill_not_found"]


def ledger_entries(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """(kind, id, opened, closed) of a ledger's lines: a `sandbox` opens when created and closes when it ends, an `operation` opens when
    requested and closes when resolved; other lines that are no entry of version 1 are `malformed`."""
    get = lambda p: F.get_json_object(raw, p)
    sound = F.coalesce(get("$.schema_version") == "1", F.lit(False))
    event, sandbox, operation = get("$.event"), get("$.sandbox_id"), get("$.create_operation_id")
    one = lambda kind, key, opened, closed: F.struct(F.lit(kind).alias("kind"), key.alias("id"), F.coalesce(opened, F.lit(False)).alias("opened"), F.coalesce(closed, F.lit(False)).alias("closed"))
    found = F.array(one("sandbox", sandbox, event == "created", event.isin(ENDING)), one("operation", operation, event == "create_requested", event.isin(RESOLVING)))
    known = F.filter(found, lambda x: x["id"].isNotNull() & (x["id"] != "") & (x["opened"] | x["closed"]))
    bad = F.array(one("malformed", F.col(raw), F.lit(True), F.lit(False)))
    return lines.select(F.explode(F.when(sound, known).otherwise(bad)).alias("e")).select("e.*")


def open_entries(entries: DataFrame) -> DataFrame:
    """(kind, id) that opened and did not close. On a stream, in update mode, each change of (kind, id, open) comes out instead, as an entry may close later."""
    sums = entries.groupBy("kind", "id").agg((F.max("opened") & ~F.max("closed")).alias("open"))
    return sums if entries.isStreaming else sums.where("open").select("kind", "id")


#: Runs of a level that are merged into one of the next.
FAN_OUT = 4


def _runs(batches: int) -> list[tuple[int, int, int]]:
    """(level, first, past the last) of the runs that hold so many batches: FAN_OUT to the level batches each, older ones first."""
    out, at, level = [], 0, 0
    while FAN_OUT ** (level + 1) <= batches:
        level += 1
    for k in range(level, -1, -1):
        size = FAN_OUT**k
        while batches - at >= size:
            out.append((k, at, at + size))
            at += size
    return out


def _run_path(folder: str, run: tuple[int, int, int]) -> str:
    return f"{folder}/{run[0]}-{run[1]}-{run[2]}"


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_key").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "_key")), "_order").alias("u")).select("_key", "u.*")


def progress_snapshots(updates: DataFrame, folder: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that keeps the last update of each key, for snapshot() to read; of equal orders the later batch counts.

    A batch writes a run of its own keys. Runs are merged by FAN_OUT into one of the next level, so an update is written a
    logarithmic number of times and a batch costs its rows, not all keys. Which runs there are follows from the number of
    batches alone: a batch that is run again writes the same runs, and skips merges that were finished. Runs that a batch
    merged are deleted by the next one, so the last snapshot can be read meanwhile.
    """

    def there(spark: SparkSession, path: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()), at

    def finished(spark: SparkSession, path: str) -> bool:
        fs, at = there(spark, f"{path}/_SUCCESS")
        return fs.exists(at)

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # what the batch before merged goes now
        for level in range(1, 64):
            size = FAN_OUT**level
            if number % size or not number:
                break
            for k in range(FAN_OUT):
                fs, at = there(spark, _run_path(folder, (level - 1, number - size + k * size // FAN_OUT, number - size + (k + 1) * size // FAN_OUT)))
                fs.delete(at, True)
        rows = batch.withColumns({"_key": F.col(key), "_order": F.struct(F.col(order), F.lit(number))})
        _latest(rows).write.mode("overwrite").parquet(_run_path(folder, (0, number, number + 1)))
        done = number + 1
        for level in range(1, 64):
            size = FAN_OUT**level
            if done % size:
                break
            parts = [_run_path(folder, (level - 1, done - size + k * size // FAN_OUT, done - size + (k + 1) * size // FAN_OUT)) for k in range(FAN_OUT)]
            target = _run_path(folder, (level, done - size, done))
            if not finished(spark, target):
                _latest(spark.read.parquet(*parts)).write.mode("overwrite").parquet(target)

    return updates.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def snapshot(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """The last update of each key after batch `number`, the last one, of progress_snapshots()."""
    return _latest(spark.read.parquet(*(_run_path(folder, r) for r in _runs(number + 1)))).drop("_key", "_order")
