"""Queries of captured records over the driver's tables and their SQL: replies of conversations as streams that were recorded, some of them wrongly."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.plans.captures import _events
from sessionlake.sources.storage import stored
from sessionlake.streaming import records


def record_errors(spark, sf_dir):
    """By a reply's number the record has a wrong hash, size, event, number of events, text, model, or one frame less, or says that it is complete though it is not."""
    n = F.regexp_extract("exchange_id", "-([0-9]+)$", 1).cast("int") + F.regexp_extract("exchange_id", "^([0-9]+)", 1).cast("int") * 8
    e = _events(spark, sf_dir).withColumns({"n": n, "event": F.get_json_object("data", "$.type")})
    e = e.withColumn("raw", F.encode(F.concat(F.lit("event: "), "event", F.lit("\ndata: "), "data", F.lit("\n\n")), "UTF-8"))
    wrong = lambda k: F.col("n") % 23 == k
    e = stored(e)
    frames = e.withColumns({"raw_base64": F.regexp_replace(F.base64("raw"), r"\s", ""), "raw_sha256": F.sha2("raw", 256), "raw_size_bytes": F.octet_length("raw") + F.when(wrong(1) & (F.col("sequence") == 0), 1).otherwise(0), "id": F.lit(None).cast("string"), "sequence": F.col("sequence").cast("long")})
    frames = frames.withColumn("event", F.when(wrong(2) & (F.col("sequence") == 1), "ping").otherwise(F.col("event"))).where(~(wrong(3) & (F.col("sequence") == 1)))
    whole = e.groupBy("exchange_id", "n").agg(F.sort_array(F.collect_list(F.struct("sequence", F.hex("raw").alias("h"))))["h"].alias("h"), F.count("*").alias("events"), F.count_if(F.col("event") == "content_block_delta").alias("pieces"), F.count_if(F.col("event") == "message_stop").alias("stops"))
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("concat(conv_id, '-', turn) AS exchange_id", "text", "conv_id", "turn").where("text is not null")
    rows = whole.withColumn("raw", F.unhex(F.array_join("h", ""))).join(said, "exchange_id")
    piece = lambda k: F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.col("pieces").cast("int")), lambda i: (i % 2 == k) & (i < F.col("pieces"))), lambda i: F.substring(F.col("text"), i * 40 + 1, F.lit(40))), "")
    block = lambda k: F.struct(F.lit("text").alias("type"), F.concat(piece(k), F.when(wrong(5) & F.lit(k == 0), "!").otherwise("")).alias("text"))
    content = F.slice(F.array(block(0), block(1)), 1, F.least(F.col("pieces").cast("int"), F.lit(2)))
    usage = F.struct(F.col("conv_id").alias("input_tokens"), F.col("pieces").alias("output_tokens"))
    message = F.to_json(F.struct(F.when(wrong(6), "other").otherwise(F.concat(F.lit("m"), F.col("turn") % 3)).alias("model"), F.lit("end").alias("stop_reason"), usage.alias("usage"), content.alias("content")))
    exchanges = rows.select("exchange_id", F.lit(200).alias("status"), ((F.col("stops") > 0) | wrong(7)).alias("complete"), F.lit(True).alias("streaming"), (F.col("events") - F.when(wrong(4), 1).otherwise(0) - F.when(wrong(3) & (F.col("events") > 1), 1).otherwise(0)).alias("event_count"), message.alias("message"), F.regexp_replace(F.base64("raw"), r"\s", "").alias("raw_base64"), F.when(wrong(8), F.sha2(F.lit("x"), 256)).otherwise(F.sha2("raw", 256)).alias("raw_sha256"), F.octet_length("raw").alias("raw_size_bytes"))
    return records.record_errors(stored(exchanges), stored(frames)).select("exchange_id", F.coalesce("at", F.lit(-1).cast("long")).alias("at"), "code", "field")


QUERIES = {"record_errors": record_errors}

ORACLE_SQL = {
    "record_errors": """
WITH c AS (
  SELECT concat(conv_id, '-', turn) AS exchange_id, (conv_id * 8 + turn) % 23 AS w, conv_id, CAST(ceil(length(text) / 40) AS INTEGER) AS pieces FROM conversations WHERE text IS NOT NULL
), e AS (
  SELECT *, pieces + 2 + CASE WHEN conv_id % 5 > 0 THEN 1 ELSE 0 END AS events FROM c
)
SELECT exchange_id, 0 AS at, 'FRAME_SIZE_MISMATCH' AS code, '' AS field FROM e WHERE w = 1
UNION ALL SELECT exchange_id, 1, unnest(['FRAME_FIELD_MISMATCH', 'BODY_FRAME_MISMATCH']), 'event' FROM e WHERE w = 2
UNION ALL SELECT exchange_id, -1, unnest(['FRAME_SEQUENCE', 'BODY_FRAME_COUNT']), '' FROM e WHERE w = 3
UNION ALL SELECT exchange_id, -1, 'FRAME_COUNT', '' FROM e WHERE w = 4
UNION ALL SELECT exchange_id, 0, 'BLOCK_MISMATCH', 'text' FROM e WHERE w = 5 AND pieces > 0
UNION ALL SELECT exchange_id, -1, 'MESSAGE_MISMATCH', 'model' FROM e WHERE w = 6
UNION ALL SELECT exchange_id, -1, unnest(['STOP_MISSING', 'COMPLETE_MISMATCH']), '' FROM e WHERE w = 7 AND conv_id % 5 = 0
UNION ALL SELECT exchange_id, -1, 'BODY_HASH_MISMATCH', '' FROM e WHERE w = 8""",
}
