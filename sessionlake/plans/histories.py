"""Queries of histories over the driver's tables and their SQL: every reply of a conversation is a captured call, whose request holds what was said before.

Faults lie in the requests, by number of the conversation: the last call of every third one is compacted, that of others
lacks the first reply, and in every seventh the first call failed, though later requests show its reply.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionlake.operators import histories

MARKS = histories.Summaries(("[EARLIER TURNS]",), "[END OF EARLIER TURNS]")


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


def _calls(spark, sf_dir):
    said = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "coalesce(text, '') AS text").where("role in ('user', 'assistant')")
    order = Window.partitionBy("conv_id").orderBy("turn")
    earlier = F.collect_list(F.struct("turn", "role", "text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = said.withColumns({"earlier": earlier, "k": F.count_if(F.col("role") == "assistant").over(order), "n": F.count_if(F.col("role") == "assistant").over(Window.partitionBy("conv_id"))}).where("role = 'assistant'")
    rows = rows.withColumn("replies", F.expr("filter(earlier, x -> x.role = 'assistant')"))
    summary = f"struct(-1L AS turn, 'user' AS role, '{MARKS.starts[0]} of conversation {MARKS.end}' AS text)"
    shown = F.expr(f"CASE WHEN conv_id % 3 = 0 AND k = n AND n > 2 THEN concat(slice(earlier, 1, 1), array({summary}), filter(earlier, x -> x.turn >= element_at(replies, -1).turn)) WHEN conv_id % 5 = 1 AND k = n AND n > 1 THEN filter(earlier, x -> x.turn <> replies[0].turn) ELSE earlier END")
    message = lambda role, text: F.struct(role.alias("role"), F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("content"))
    request = F.to_json(F.struct(F.transform("shown", lambda m: message(m["role"], m["text"])).alias("messages"), F.array(F.struct(F.lit("read").alias("name"))).alias("tools")))
    failed = (F.col("conv_id") % 7 == 2) & (F.col("k") == 1)
    response = F.to_json(F.struct(F.lit("message").alias("type"), F.lit("assistant").alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.col("text"), F.lit("x").alias("signature"))).alias("content")))
    told = rows.withColumn("shown", shown)
    return told.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("call_no"), request.alias("request"), response.alias("response"), F.when(failed, 500).otherwise(200).alias("status"), F.lit(True).alias("complete"), F.lit(None).cast("string").alias("error_code"))


def compaction_windows(spark, sf_dir):
    found = histories.compaction_windows(_calls(spark, sf_dir), MARKS)
    return found.select("session_id", "call_no", F.array_join("retained", ",").alias("retained"), F.array_join("compacted", ",").alias("compacted"))


def history_errors(spark, sf_dir):
    """The session's own messages are the conversation without system texts."""
    own = _table(spark, sf_dir, "conversations", "conv_id AS session_id", "turn AS pos", "to_json(named_struct('role', role, 'content', coalesce(text, ''))) AS message", "role").where("role in ('user', 'assistant')")
    return histories.history_errors(_calls(spark, sf_dir), MARKS, own.drop("role")).withColumn("call_no", F.coalesce("call_no", F.lit(-1).cast("long")))


QUERIES = {f.__name__: f for f in (compaction_windows, history_errors)}

_CALLS = """
WITH said AS (
  SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant')
), placed AS (
  SELECT conv_id, turn, role, count(CASE WHEN role = 'assistant' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(CASE WHEN role = 'assistant' THEN 1 END) OVER (PARTITION BY conv_id) AS n FROM said
), lists AS (
  SELECT conv_id, list(turn ORDER BY turn) AS turns, list(turn ORDER BY turn) FILTER (role = 'assistant') AS replies FROM said GROUP BY conv_id
), calls AS (
  SELECT p.conv_id, p.turn, p.k, p.n, NOT (p.conv_id % 7 = 2 AND p.k = 1) AS ok, list_filter(l.turns, lambda x: x < p.turn) AS earlier, list_filter(l.replies, lambda x: x < p.turn) AS replies, l.turns, l.replies AS every
  FROM placed p JOIN lists l USING (conv_id) WHERE p.role = 'assistant'
), shown AS (
  SELECT *, conv_id % 3 = 0 AND k = n AND n > 2 AS cut,
         CASE WHEN conv_id % 3 = 0 AND k = n AND n > 2 THEN list_concat([earlier[1], -1], list_filter(earlier, lambda x: x >= replies[-1])) WHEN conv_id % 5 = 1 AND k = n AND n > 1 THEN list_filter(earlier, lambda x: x <> replies[1]) ELSE earlier END AS request,
         list_filter(replies, lambda x: NOT (conv_id % 7 = 2 AND x = replies[1])) AS visible
  FROM calls
), seen AS (
  SELECT *, CASE WHEN ok THEN list_append(request, turn) ELSE request END AS after, list_filter(request, lambda x: list_contains(replies, x)) AS sent FROM shown
), led AS (
  SELECT *, lag(request) OVER (PARTITION BY conv_id ORDER BY turn) AS former, lag(after) OVER (PARTITION BY conv_id ORDER BY turn) AS grown FROM seen
), folded AS (
  SELECT *, coalesce(cut AND len(visible) > len(sent) AND len(former) > 0 AND former[1] = request[1] AND len(request) < len(former) + 2 AND sent[-1] = visible[-1], false) AS compacts FROM led
)"""

ORACLE_SQL = {
    "compaction_windows": f"{_CALLS} SELECT conv_id AS session_id, turn AS call_no, array_to_string(sent, ',') AS retained, array_to_string(list_filter(visible, lambda x: NOT list_contains(sent, x)), ',') AS compacted FROM folded WHERE compacts",
    "history_errors": f"""{_CALLS}, gone AS (
  SELECT conv_id, unnest(list_filter(visible, lambda x: NOT list_contains(sent, x))) AS turn FROM folded WHERE compacts
), turned AS (
  SELECT f.*, f.ok AND g.turn IS NULL AS told, max(CASE WHEN compacts THEN f.turn END) OVER (PARTITION BY f.conv_id) AS boundary FROM folded f LEFT JOIN gone g ON f.conv_id = g.conv_id AND f.turn = g.turn
), numbered AS (
  SELECT *, coalesce(sum(CAST(told AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM turned
), ended AS (
  SELECT *, CASE WHEN ok THEN list_position(turns, every[CAST(before AS INTEGER) + 1]) ELSE coalesce(list_position(turns, every[CAST(before AS INTEGER) + 1]) - 1, len(turns)) END AS ends FROM numbered
)
SELECT conv_id AS session_id, turn AS call_no, 'RESPONSE_HISTORY' AS code FROM folded WHERE sent <> CASE WHEN compacts THEN sent ELSE visible END
UNION ALL SELECT conv_id, turn, 'REQUEST_HISTORY' FROM folded WHERE grown IS NOT NULL AND NOT compacts AND request[1:len(grown)] <> grown
UNION ALL SELECT conv_id, -1, 'ASSISTANT_COUNT' FROM turned GROUP BY conv_id HAVING sum(CAST(told AS INTEGER)) <> any_value(len(every))
UNION ALL SELECT conv_id, turn, 'TRANSCRIPT_PREFIX' FROM ended WHERE (boundary IS NULL OR turn >= boundary) AND coalesce(turns[1:ends] <> after, true)""",
}
