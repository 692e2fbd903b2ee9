"""Queries of captured streams over the driver's tables and their SQL; conversations stand in for responses, events for ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.streaming import captures


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


def _events(spark, sf_dir):
    """Each turn is a response: a start, its text in pieces of 40 characters, its usage and, mostly, a stop."""
    c = _table(spark, sf_dir, "conversations", "concat(conv_id, '-', turn) AS exchange_id", "conv_id", "turn", "text", "CAST(ceil(char_length(text) / 40.0D) AS INT) AS n").where("text is not null")
    json = lambda x: F.substring(F.to_json(F.array(x)), 2, 100_000)
    quoted = lambda x: F.substring(json(x), F.lit(1), F.char_length(json(x)) - 1)
    part = lambda k: F.concat(F.lit('{"type":"content_block_delta","index":'), k % 2, F.lit(',"delta":{"type":"text_delta","text":'), quoted(F.substring(F.col("text"), k * 40 + 1, F.lit(40))), F.lit("}}"))
    deltas = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.col("n") - 1), part)).otherwise(F.array().cast("array<string>"))
    start = F.concat(F.lit('{"type":"message_start","message":{"model":"m'), F.col("turn") % 3, F.lit('","usage":{"input_tokens":'), F.col("conv_id"), F.lit("}}}"))
    end = F.concat(F.lit('{"type":"message_delta","delta":{"stop_reason":"end"},"usage":{"output_tokens":'), F.col("n"), F.lit("}}"))
    stop = F.when(F.col("conv_id") % 5 > 0, F.array(F.lit('{"type":"message_stop"}'))).otherwise(F.array().cast("array<string>"))
    every = F.concat(F.array(start), deltas, F.array(end), stop)
    return c.select("exchange_id", F.posexplode(every).alias("sequence", "data")).withColumn("event", F.lit(None).cast("string"))


def sse_blocks(spark, sf_dir):
    return captures.folded_blocks(_events(spark, sf_dir)).select("exchange_id", "index", "type", "text")


def sse_messages(spark, sf_dir):
    return captures.folded_messages(_events(spark, sf_dir)).select("exchange_id", "model", "stop_reason", "input_tokens", "output_tokens", "complete")


def sse_frames(spark, sf_dir):
    """The responses as bytes, cut into chunks of 64, framed again and folded."""
    e = _events(spark, sf_dir)
    frame = F.concat(F.lit("event: e\ndata: "), F.col("data"), F.when(F.col("sequence") % 2 == 0, F.lit("\r\n\r\n")).otherwise(F.lit("\n\n")))
    whole = e.groupBy("exchange_id").agg(F.encode(F.concat(F.lit(": ping\n\n"), F.array_join(F.sort_array(F.collect_list(F.struct("sequence", frame.alias("f"))))["f"], ""), F.lit("data: tail")), "UTF-8").alias("raw"))
    n = F.ceil(F.octet_length("raw") / 64).cast("int")
    cut = whole.select("exchange_id", "raw", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("pos"))
    chunks = cut.select("exchange_id", "pos", F.expr("substring(raw, pos * 64 + 1, 64)").alias("chunk"), (F.col("pos") == F.col("n") - 1).alias("last"))
    return captures.folded_blocks(captures.sse_events(chunks).where("not unterminated")).select("exchange_id", "index", "type", "text")


def ledger_closure(spark, sf_dir):
    event = "element_at(array('create_requested', 'created', 'killed', 'create_failed', 'kill_not_found', 'noted'), CAST(event_id % 6 AS INT) + 1)"
    lines = _table(spark, sf_dir, "events", f"CASE WHEN event_id % 101 = 0 THEN concat('broken ', event_id) ELSE concat('{{\"schema_version\":', CASE WHEN event_id % 103 = 0 THEN 2 ELSE 1 END, ',\"event\":\"', {event}, '\",\"sandbox_id\":\"s', event_id div 7, '\",\"create_operation_id\":\"o', event_id div 5, '\"}}') END AS raw")
    return captures.open_entries(captures.ledger_entries(lines))


QUERIES = {f.__name__: f for f in (sse_blocks, sse_messages, sse_frames, ledger_closure)}

_BLOCKS = """
WITH c AS (SELECT concat(conv_id, '-', turn) AS exchange_id, text, CAST(ceil(length(text) / 40) AS INTEGER) AS n FROM conversations WHERE text IS NOT NULL), p AS (SELECT exchange_id, k, substr(text, CAST(k * 40 + 1 AS BIGINT), 40) AS part FROM c, range(0, 4000) r(k) WHERE k < n)
SELECT exchange_id, CAST(k % 2 AS INTEGER) AS index, 'text' AS type, string_agg(part, '' ORDER BY k) AS text FROM p GROUP BY exchange_id, k % 2"""

ORACLE_SQL = {
    "sse_blocks": _BLOCKS,
    "sse_frames": _BLOCKS,
    "sse_messages": "SELECT concat(conv_id, '-', turn) AS exchange_id, concat('m', turn % 3) AS model, 'end' AS stop_reason, conv_id AS input_tokens, CAST(ceil(length(text) / 40) AS BIGINT) AS output_tokens, conv_id % 5 > 0 AS complete FROM conversations WHERE text IS NOT NULL",
    "ledger_closure": """
WITH e AS (SELECT event_id, ['create_requested', 'created', 'killed', 'create_failed', 'kill_not_found', 'noted'][event_id % 6 + 1] AS ev, concat('s', event_id // 7) AS s, concat('o', event_id // 5) AS o FROM events WHERE event_id % 101 > 0 AND event_id % 103 > 0)
SELECT 'sandbox' AS kind, s AS id FROM e GROUP BY s HAVING bool_or(ev = 'created') AND NOT bool_or(ev IN ('killed', 'kill_not_found')) UNION ALL SELECT 'operation', o FROM e GROUP BY o HAVING bool_or(ev = 'create_requested') AND NOT bool_or(ev IN ('created', 'create_failed'))
UNION ALL SELECT 'malformed', CASE WHEN event_id % 101 = 0 THEN concat('broken ', event_id) ELSE concat('{"schema_version":2,"event":"', ['create_requested', 'created', 'killed', 'create_failed', 'kill_not_found', 'noted'][event_id % 6 + 1], '","sandbox_id":"s', event_id // 7, '","create_operation_id":"o', event_id // 5, '"}') END FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0""",
}
