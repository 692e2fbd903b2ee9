"""Captured records, checked by parsing them again: bodies are decoded, framed and folded, and what comes out is held against what was recorded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions.values import json_value
from sessionlake.operators.artifacts import body_errors
from sessionlake.sources.storage import stored
from sessionlake.streaming.captures import USAGE, first_event, folded_blocks, folded_messages, sse_events

BASE64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
#: What is compared of an event, of a content block and of a message.
EVENT, BLOCK, MESSAGE = ["event", "id", "data"], ["type", "text", "thinking", "signature", "input"], ["model", "stop_reason", *USAGE]


def _bytes(raw_base64: Column) -> Column:
    return F.when(raw_base64.rlike(BASE64), F.unbase64(raw_base64))


def _found(rows: DataFrame, at: Column, code: str | Column, field: str | Column = "") -> DataFrame:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select("exchange_id", at.cast("long").alias("at"), text(code).alias("code"), text(field).alias("field"))


def _unlike(rows: DataFrame, at: Column, code: str, fields: list[str], left: str, right: str) -> DataFrame:
    """A row for each field in which two structs of a row differ, null-safely."""
    names = F.array_compact(F.array(*(F.when(~F.col(f"{left}.{f}").eqNullSafe(F.col(f"{right}.{f}")), F.lit(f)) for f in fields)))
    return _found(rows.withColumn("_f", F.explode(names)), at, code, F.col("_f"))


def recorded_blocks(exchanges: DataFrame) -> DataFrame:
    """(exchange_id, index, type, text, thinking, signature, input) of the content of recorded messages (exchange_id, message as JSON)."""
    v = json_value(F.col("message"))
    items = F.when(F.startswith(F.schema_of_variant(F.try_variant_get(v, "$.content", "variant")), F.lit("ARRAY")), F.try_variant_get(v, "$.content", "array<variant>"))
    each = exchanges.select("exchange_id", F.posexplode(items).alias("index", "b"))
    string = lambda f: F.try_variant_get("b", f"$.{f}", "string").alias(f)
    return each.select("exchange_id", "index", *map(string, BLOCK[:-1]), F.to_json(F.try_variant_get("b", "$.input", "variant")).alias("input"))


def record_errors(exchanges: DataFrame, frames: DataFrame) -> DataFrame:
    """(exchange_id, at, code, field) of what recorded exchanges and events of streams don't agree in; at is an event's or block's place, null for a whole exchange.

    exchanges (exchange_id, status, complete, streaming, event_count, message, raw_base64, raw_sha256, raw_size_bytes) hold the
    response's bytes and the message that was made of them, as JSON; frames (exchange_id, sequence, event, id, data, raw_base64,
    raw_sha256, raw_size_bytes) hold each event's bytes and what was read from them. Responses that did not stream have no frames to check.

    Of bodies and frames: BODY_BASE64_INVALID, BODY_SIZE_MISMATCH, BODY_HASH_MISMATCH, and FRAME_... likewise. Of frames: FRAME_FIELD_MISMATCH
    (a field is not what the bytes say; unreadable bytes say nothing), FRAME_SEQUENCE (numbers are not 0, 1, 2 and so on), FRAME_COUNT
    (another number than the exchange tells), EXCHANGE_UNKNOWN. Of bodies read again: BODY_FRAME_COUNT, BODY_FRAME_MISMATCH (an event is another than
    the frame of its place), EVENT_TYPE_MISMATCH (name and type of an event differ), STOP_MISSING and COMPLETE_MISMATCH (of status 200),
    MESSAGE_MISMATCH and BLOCK_MISMATCH (a field of the message, or of a content block, is another than the one folded from the events).
    EXCHANGE_REPEATED where an id is not unique; its rows are checked one by one against the same frames. A null id is no exchange.
    """
    exchanges, frames = exchanges.where("exchange_id is not null"), frames.where("exchange_id is not null")
    streamed = exchanges.where("streaming")
    none = F.lit(None).cast("long")
    renamed = lambda kind: F.replace("code", F.lit("BODY_"), F.lit(f"{kind}_"))
    keyed = frames.withColumn("_key", F.struct("exchange_id", "sequence"))
    bad_frames = body_errors(keyed, "_key").select(F.col("_key.exchange_id").alias("exchange_id"), F.col("_key.sequence").alias("sequence"), "code")
    out = [_found(body_errors(exchanges), none, F.col("code")), _found(bad_frames, F.col("sequence"), renamed("FRAME"))]
    out.append(_found(exchanges.groupBy("exchange_id").count().where("count > 1"), none, "EXCHANGE_REPEATED"))

    # each frame's bytes, read alone: no shuffle, as no other frame is needed
    chunk = lambda rows, key: rows.select(key.alias("exchange_id"), F.lit(0).cast("long").alias("pos"), _bytes(F.col("raw_base64")).alias("chunk"), F.lit(True).alias("last")).where("chunk is not null")
    told = frames.select("exchange_id", "sequence", F.struct(*EVENT).alias("told"), _bytes(F.col("raw_base64")).alias("_raw"))
    out.append(_unlike(told.where("_raw is not null").withColumn("read", first_event("_raw")), F.col("sequence"), "FRAME_FIELD_MISMATCH", EVENT, "told", "read"))
    counts = frames.groupBy("exchange_id").agg(F.count("*").alias("n"), F.min("sequence").alias("low"), F.max("sequence").alias("high"), F.count_distinct("sequence").alias("different"))
    met = streamed.select("exchange_id", "event_count").join(counts, "exchange_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    out.append(_found(met.where("n > 0 and not (low = 0 and high = n - 1 and different = n)"), none, "FRAME_SEQUENCE"))
    out.append(_found(met.where(~F.col("event_count").eqNullSafe(F.col("n"))), none, "FRAME_COUNT"))
    out.append(_found(counts.join(exchanges, "exchange_id", "left_anti"), none, "EXCHANGE_UNKNOWN"))

    # the bodies, framed and folded
    bodies = streamed.dropDuplicates(["exchange_id"])
    events = stored(sse_events(chunk(bodies, F.col("exchange_id").cast("string"))))
    read = events.select("exchange_id", "sequence", F.struct(*EVENT).alias("read"))
    known = told.select(F.col("exchange_id").cast("string").alias("exchange_id"), "sequence", "told").join(bodies.select(F.col("exchange_id").cast("string").alias("exchange_id")), "exchange_id", "left_semi")
    sizes = read.groupBy("exchange_id").agg(F.count("*").alias("events")).join(known.groupBy("exchange_id").agg(F.count("*").alias("frames")), "exchange_id", "full_outer")
    out.append(_found(sizes.where("not events <=> frames"), none, "BODY_FRAME_COUNT"))
    both = read.join(known, ["exchange_id", "sequence"])
    out.append(_unlike(both, F.col("sequence"), "BODY_FRAME_MISMATCH", EVENT, "read", "told"))
    kind = F.get_json_object("data", "$.type")
    out.append(_found(events.where(kind.isNotNull() & F.col("event").isNotNull() & (kind != F.col("event"))), F.col("sequence"), "EVENT_TYPE_MISMATCH"))
    stops = events.groupBy("exchange_id").agg(F.max(F.coalesce((kind == "message_stop") & F.coalesce(F.col("event") == "message_stop", F.lit(True)), F.lit(False))).alias("stopped"))
    ended = bodies.select(F.col("exchange_id").cast("string").alias("exchange_id"), "status", "complete").where("status = 200").join(stops, "exchange_id", "left").withColumn("stopped", F.coalesce("stopped", F.lit(False)))
    out.append(_found(ended.where("complete and not stopped"), none, "STOP_MISSING"))
    out.append(_found(ended.where("not complete <=> stopped"), none, "COMPLETE_MISMATCH"))

    v = json_value(F.col("message"))
    field = lambda p, t: F.try_variant_get(v, p, t)
    kept = bodies.select(F.col("exchange_id").cast("string").alias("exchange_id"), F.struct(field("$.model", "string").alias("model"), field("$.stop_reason", "string").alias("stop_reason"), *(field(f"$.usage.{u}", "long").alias(u) for u in USAGE)).alias("told"))
    folded = folded_messages(events).select("exchange_id", F.struct(*MESSAGE).alias("read"))
    out.append(_unlike(kept.join(folded, "exchange_id", "left"), none, "MESSAGE_MISMATCH", MESSAGE, "told", "read"))
    have = recorded_blocks(bodies.withColumn("exchange_id", F.col("exchange_id").cast("string"))).select("exchange_id", "index", F.struct(*BLOCK).alias("told"))
    made = folded_blocks(events).withColumn("input", F.to_json(F.try_parse_json("input"))).select("exchange_id", "index", F.struct(*BLOCK).alias("read"))
    out.append(_unlike(have.join(made, ["exchange_id", "index"], "full_outer"), F.col("index"), "BLOCK_MISMATCH", BLOCK, "told", "read"))
    key = dict(exchanges.dtypes)["exchange_id"]
    return reduce(DataFrame.union, (x.withColumn("exchange_id", F.col("exchange_id").cast(key)) for x in out))
