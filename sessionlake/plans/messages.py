"""Queries of the message operators over the driver's tables and their SQL; conversations and events stand in for sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import messages, sessions


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _messages(spark, sf_dir):
    """conversations with content in four forms of JSON: a string, blocks, an object and a list of strings."""
    quoted = F.to_json(F.array("text"))
    string = F.expr("substring(to_json(array(text)), 2, char_length(to_json(array(text))) - 2)")
    blocks = F.to_json(F.array(F.struct(F.lit("text").alias("type"), "text")))
    form = F.when(F.col("turn") % 4 == 0, string).when(F.col("turn") % 4 == 1, blocks).when(F.col("turn") % 4 == 2, F.to_json(F.struct(F.col("text").alias("value")))).otherwise(quoted)
    role = F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") == 0), "system").otherwise(F.col("role"))
    return _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("session_id"), F.col("turn").alias("pos"), role.alias("role"), "text", form.alias("content"))


def message_texts(spark, sf_dir):
    return _messages(spark, sf_dir).select("session_id", "pos", messages.message_text(F.col("content")).alias("text"))


def indexed_messages(spark, sf_dir):
    one = F.to_json(F.struct("role", F.col("text").alias("content")))
    raw = F.concat(F.lit('{"id": 1, "messages": ['), F.array_join(F.sort_array(F.collect_list(F.struct("pos", one.alias("m"))))["m"], ", "), F.lit("]}"))
    whole = _messages(spark, sf_dir).groupBy("session_id").agg(raw.alias("raw"))
    return messages.indexed_messages(whole).select("session_id", F.col("pos").cast("long").alias("pos"), "role", messages.message_text(F.col("content")).alias("text"))


def result_blocks(spark, sf_dir):
    return messages.result_blocks(_messages(spark, sf_dir)).withColumn("index", F.col("index").cast("int"))


def user_records(spark, sf_dir):
    return messages.user_records(_messages(spark, sf_dir))


def task_user_records(spark, sf_dir):
    tasks = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("session_id")).distinct().select(
        "session_id", (F.col("session_id") % 7).alias("task_id"), F.expr("CASE WHEN session_id % 5 = 0 THEN array(1L) ELSE array(0L, 2L, 2L, 90L) END").alias("message_indices"), F.array(F.lit(" one \n"), F.lit(" "), F.lit("two")).alias("user_texts")
    )
    return messages.task_user_records(tasks, _messages(spark, sf_dir))


def shared_context(spark, sf_dir):
    return messages.shared_context(_messages(spark, sf_dir)).select("session_id", "pos", "role")


def truncated_spans(spark, sf_dir):
    return sessions.request_spans(_messages(spark, sf_dir)).where("truncated_target").select("session_id", "span_no", "message_start", "message_end")


def span_ids(spark, sf_dir):
    return messages.span_ids(_messages(spark, sf_dir).withColumn("message", F.to_json(F.struct("pos", "role"))))


def _calls(spark, sf_dir):
    text = F.expr("CASE event_id % 6 WHEN 0 THEN concat('  Error: ', props) WHEN 1 THEN ' ' WHEN 2 THEN props WHEN 3 THEN concat('read ', event_type) WHEN 4 THEN '{broken' ELSE NULL END")
    status = F.expr("CASE event_id % 5 WHEN 0 THEN 'Failed' WHEN 1 THEN 'ok' WHEN 2 THEN '' END")
    name = F.expr("CASE event_id % 4 WHEN 0 THEN 'Write_File' WHEN 1 THEN 'fs_list_dir' WHEN 2 THEN 'grep' ELSE 'run' END")
    call_id = F.when(F.col("event_id") % 7 > 0, F.col("event_type")).when(F.col("event_id") % 2 == 0, "")
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), F.col("event_id").alias("pos"), call_id.alias("call_id"), F.expr("CASE WHEN event_id % 9 = 0 THEN true WHEN event_id % 9 = 1 THEN NULL ELSE false END").alias("pending"), text.alias("text"), status.alias("status"), name.alias("name"))


def timeline_evidence(spark, sf_dir):
    return messages.timeline_evidence(_calls(spark, sf_dir)).select("session_id", "pos", "evidence_ref_id")


def captured_evidence(spark, sf_dir):
    return messages.captured_evidence(_calls(spark, sf_dir)).select("session_id", "pos", "evidence_ref_id")


def canonical_evidence(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").selectExpr("event_id AS id", "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN event_type END AS evidence_ref_id", "CASE WHEN event_id % 4 > 0 THEN props END AS evidence_id", "nullif(event_type, 'click') AS source_id", "CASE WHEN event_id % 5 > 0 THEN concat('e', event_id) END AS event_id")
    return messages.canonical_evidence(rows).select("id", "evidence_ref_id", "source_id")


def located_refs(spark, sf_dir):
    return messages.located_refs(_table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), F.when(F.col("event_id") % 11 == 0, "").otherwise(F.col("props")).alias("evidence_ref_id")))


def usable_results(spark, sf_dir):
    c = _calls(spark, sf_dir)
    return c.select("pos", messages.usable_result(F.col("text"), F.col("status"), F.col("pending"), F.col("pos") % 13 == 0, F.lit(None).cast("boolean")).alias("usable"))


def result_shapes(spark, sf_dir):
    return _calls(spark, sf_dir).select("pos", messages.result_shape(F.col("name"), F.col("text"), F.col("pending")).alias("shape"))


def final_responses(spark, sf_dir):
    m = _messages(spark, sf_dir).withColumn("text", F.when(F.col("session_id") % 5 == 0, F.lit(" \n")).otherwise(F.col("text")))
    return messages.final_responses(m)


def distinct_tasks(spark, sf_dir):
    m = _messages(spark, sf_dir).where("role = 'user'").select((F.col("session_id") % 10).alias("workspace"), (F.col("session_id") * 1000 + F.col("pos")).alias("pos"), F.when(F.col("pos") % 4 == 2, F.translate(F.substring("text", 1, 45), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(F.substring("text", 1, 45)).alias("task"))
    return messages.distinct_tasks(m, "workspace")


def text_windows(spark, sf_dir):
    w = messages.text_window(F.col("text"), (F.col("doc_id") % 500 - 20).cast("int"), F.lit(200), 150)
    return _table(spark, sf_dir, "documents").where("text is not null").select("doc_id", w.alias("w")).select("doc_id", "w.chunk", "w.total_chars", "w.next_offset")


def segmentation_errors(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumnRenamed("user_id", "session_id").withColumnRenamed("event_type", "span_id")
    given = e.where("event_id % 23 < 3").select("session_id", "span_id", F.when(F.col("event_id") % 23 < 2, F.col("event_id") % 3).alias("task_no"))
    return messages.segmentation_errors(given, e.where("event_id % 3 = 0").select("session_id", "span_id"))


def evidence_scope_errors(spark, sf_dir):
    e = _table(spark, sf_dir, "events").selectExpr("user_id AS session_id", "event_type AS span_id", "event_id % 5 AS task_no", "event_id", "event_id % 40 AS message_index")
    return messages.evidence_scope_errors(e.where("event_id % 29 < 2"), e.where("event_id % 4 = 0").select("session_id", "span_id", "task_no"), e.where("event_id % 7 = 1").select("session_id", "span_id", "message_index"))


def obligation_errors(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").selectExpr("o_custkey AS task_id", "o_orderkey AS pos", "CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE o_orderpriority END AS id", "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS text", "CASE o_orderkey % 4 WHEN 0 THEN array() ELSE array(o_orderstatus, CASE WHEN o_orderkey % 4 = 1 THEN 'X' ELSE 'F' END) END AS refs")
    known = _table(spark, sf_dir, "orders").selectExpr("o_custkey AS task_id", "o_orderstatus AS ref")
    return messages.obligation_errors(o, known)


QUERIES = {
    f.__name__: f
    for f in (
        message_texts, indexed_messages, result_blocks, user_records, task_user_records, shared_context, truncated_spans, span_ids, timeline_evidence, captured_evidence, canonical_evidence, located_refs,
        usable_results, result_shapes, final_responses, distinct_tasks, text_windows, segmentation_errors, evidence_scope_errors, obligation_errors,
    )
}

_M = "m AS (SELECT conv_id AS session_id, turn AS pos, CASE WHEN conv_id % 3 = 0 AND turn = 0 THEN 'system' ELSE role END AS role, text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS bare FROM conversations)"
_C = """c AS (SELECT user_id AS session_id, event_id AS pos, CASE WHEN event_id % 7 > 0 THEN event_type WHEN event_id % 2 = 0 THEN '' END AS call_id, CASE WHEN event_id % 9 = 0 THEN true WHEN event_id % 9 = 1 THEN NULL ELSE false END AS pending,
 CASE event_id % 6 WHEN 0 THEN '  Error: ' || props WHEN 1 THEN ' ' WHEN 2 THEN props WHEN 3 THEN 'read ' || event_type WHEN 4 THEN '{broken' ELSE NULL END AS text,
 CASE event_id % 5 WHEN 0 THEN 'Failed' WHEN 1 THEN 'ok' WHEN 2 THEN '' END AS status, CASE event_id % 4 WHEN 0 THEN 'Write_File' WHEN 1 THEN 'fs_list_dir' WHEN 2 THEN 'grep' ELSE 'run' END AS name FROM events)"""

ORACLE_SQL = {
    "message_texts": f"WITH {_M} SELECT session_id, pos, bare AS text FROM m",
    "indexed_messages": f"WITH {_M} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY pos) - 1 AS pos, role, bare AS text FROM m",
    "result_blocks": "SELECT conv_id AS session_id, turn AS pos, CAST(0 AS INTEGER) AS index, text FROM conversations",
    "user_records": f"WITH {_M} SELECT session_id, concat('user:', pos) AS id, pos AS message_index, bare AS text FROM m WHERE role = 'user' AND bare <> ''",
    "task_user_records": f"""
WITH {_M}, r AS (SELECT session_id, session_id % 7 AS task_id, concat('user:', pos) AS id, pos AS message_index, bare AS text FROM m WHERE role = 'user' AND bare <> '' AND CASE WHEN session_id % 5 = 0 THEN pos = 1 ELSE pos IN (0, 2, 90) END)
SELECT * FROM r UNION ALL SELECT s.session_id, s.session_id % 7, concat('user:task:', k), NULL, CASE k WHEN 0 THEN 'one' ELSE 'two' END FROM (SELECT DISTINCT session_id FROM m) s, range(0, 2) t(k) WHERE s.session_id NOT IN (SELECT session_id FROM r)""",
    "shared_context": f"WITH {_M} SELECT session_id, pos, role FROM m WHERE NOT EXISTS (SELECT 1 FROM m u WHERE u.session_id = m.session_id AND u.role = 'user' AND u.pos <= m.pos)",
    "truncated_spans": f"""
WITH {_M}, s AS (SELECT session_id, pos AS message_start, row_number() OVER (PARTITION BY session_id ORDER BY pos) AS span_no, lead(pos) OVER (PARTITION BY session_id ORDER BY pos) AS next
 FROM m WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM m p WHERE p.session_id = m.session_id AND p.pos = m.pos - 1 AND p.role = 'user'))
SELECT session_id, CAST(span_no AS INTEGER) AS span_no, message_start, coalesce(next, (SELECT max(pos) + 1 FROM m WHERE m.session_id = s.session_id)) AS message_end FROM s
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.session_id = s.session_id AND m.role = 'assistant' AND m.pos >= message_start AND (next IS NULL OR m.pos < next))""",
    "span_ids": f"""
WITH {_M}, s AS (SELECT session_id, pos AS a, row_number() OVER (PARTITION BY session_id ORDER BY pos) AS span_no, lead(pos) OVER (PARTITION BY session_id ORDER BY pos) AS next
 FROM m WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM m p WHERE p.session_id = m.session_id AND p.pos = m.pos - 1 AND p.role = 'user')),
t AS (SELECT s.session_id, span_no, a, max(m.pos) + 1 AS b, string_agg(concat('{{"pos":', m.pos, ',"role":"', m.role, '"}}'), ', ' ORDER BY m.pos) AS x FROM s JOIN m ON m.session_id = s.session_id AND m.pos >= a AND (next IS NULL OR m.pos < next) GROUP BY ALL)
SELECT session_id, CAST(span_no AS INTEGER) AS span_no, 'span_' || substr(sha256(concat('{{"end": ', b, ', "messages": [', x, '], "start": ', a, '}}')), 1, 16) AS span_id FROM t""",
    "timeline_evidence": f"""
WITH {_C}, r AS (SELECT *, CASE WHEN coalesce(call_id, '') = '' THEN concat('timeline:', pos) ELSE call_id END AS ref FROM c WHERE pending IS NOT TRUE), f AS (SELECT session_id, ref, min(pos) AS first_pos FROM r GROUP BY ALL)
SELECT session_id, pos, CASE WHEN pos = first_pos THEN ref ELSE concat(ref, '@', pos) END AS evidence_ref_id FROM r JOIN f USING (session_id, ref)""",
    "captured_evidence": f"WITH {_C} SELECT session_id, pos, concat('captured:', pos) AS evidence_ref_id FROM c WHERE pending IS NOT TRUE",
    "canonical_evidence": """
WITH r AS (SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN event_type END AS a, CASE WHEN event_id % 4 > 0 THEN props END AS b, nullif(event_type, 'click') AS c, CASE WHEN event_id % 5 > 0 THEN concat('e', event_id) END AS d FROM events)
SELECT id, CASE WHEN coalesce(a, '') = '' AND b IS NOT NULL THEN b ELSE a END AS evidence_ref_id, CASE WHEN coalesce(c, '') = '' AND d IS NOT NULL THEN d ELSE c END AS source_id FROM r""",
    "located_refs": "WITH r AS (SELECT user_id AS session_id, props AS evidence_ref_id FROM events WHERE event_id % 11 <> 0) SELECT * FROM r GROUP BY ALL HAVING count(*) = 1",
    "usable_results": f"WITH {_C} SELECT pos, NOT (pending IS TRUE OR pos % 13 = 0 OR coalesce(status, '') = 'Failed' OR coalesce(text, '') LIKE '%Error:%') AS usable FROM c",
    "result_shapes": f"""
WITH {_C} SELECT pos, CASE WHEN pending IS TRUE THEN 'pending' WHEN coalesce(text, '') ILIKE '%error%' THEN 'error' WHEN name = 'Write_File' THEN 'wrote' WHEN name IN ('fs_list_dir', 'grep') THEN 'listed'
 WHEN trim(coalesce(text, '')) = '' THEN 'empty' WHEN text LIKE '{{"%' THEN 'json' ELSE 'text' END AS shape FROM c""",
    "final_responses": f"""
WITH {_M}, l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY CASE WHEN role IN ('assistant', 'tool', 'user') THEN pos END DESC NULLS LAST) = 1),
s AS (SELECT *, CASE WHEN role NOT IN ('assistant', 'tool', 'user') THEN 'FINAL_RESPONSE_MISSING' WHEN role <> 'assistant' THEN 'FINAL_RESPONSE_NOT_TERMINAL' WHEN session_id % 5 = 0 OR bare = '' THEN 'FINAL_RESPONSE_MISSING' ELSE 'OK' END AS status FROM l)
SELECT session_id, status, CASE WHEN status = 'OK' THEN pos END AS message_index, CASE WHEN status = 'OK' THEN text END AS response FROM s""",
    "distinct_tasks": f"""
WITH {_M}, t AS (SELECT session_id % 10 AS workspace, session_id * 1000 + pos AS pos, trim(regexp_replace(CASE WHEN pos % 4 = 2 THEN translate(substr(text, 1, 45), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE substr(text, 1, 45) END, '\\s+', ' ', 'g')) AS task FROM m WHERE role = 'user')
SELECT workspace, pos, task FROM t WHERE length(task) >= 40 QUALIFY row_number() OVER (PARTITION BY workspace, lower(task) ORDER BY pos) = 1""",
    "text_windows": """
WITH d AS (SELECT doc_id, text, greatest(CAST(doc_id % 500 - 20 AS INTEGER), 0) AS a, CAST(length(text) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, substr(text, a + 1, 150) AS chunk, n AS total_chars, CASE WHEN a + 150 < n THEN a + 150 END AS next_offset FROM d""",
    "segmentation_errors": """
WITH k AS (SELECT DISTINCT user_id AS session_id, event_type AS span_id FROM events WHERE event_id % 3 = 0), g AS (SELECT user_id AS session_id, event_type AS span_id, event_id % 23 = 2 AS context FROM events WHERE event_id % 23 < 3)
SELECT session_id, CASE WHEN context THEN 'UNKNOWN_CONTEXT_SPAN' ELSE 'UNKNOWN_SPAN' END AS code, span_id FROM g WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.session_id = g.session_id AND k.span_id = g.span_id)
UNION ALL SELECT session_id, 'UNASSIGNED_SPAN', span_id FROM k WHERE NOT EXISTS (SELECT 1 FROM g WHERE k.session_id = g.session_id AND k.span_id = g.span_id)
UNION ALL SELECT session_id, CASE WHEN context THEN 'SPAN_OVERLAP_CONTEXT' ELSE 'SPAN_OVERLAP' END, span_id FROM g QUALIFY row_number() OVER (PARTITION BY session_id, span_id ORDER BY context) > 1""",
    "evidence_scope_errors": """
WITH o AS (SELECT DISTINCT a.user_id AS session_id, a.event_id % 5 AS task_no, u.event_id % 40 AS i FROM events a JOIN events u ON a.user_id = u.user_id AND a.event_type = u.event_type AND a.event_id % 4 = 0 AND u.event_id % 7 = 1),
n AS (SELECT DISTINCT user_id AS session_id, event_id % 5 AS task_no, event_id % 40 AS i FROM events WHERE event_id % 29 < 2)
SELECT DISTINCT session_id, task_no, 'EVIDENCE_SCOPE_MISMATCH' AS code FROM (SELECT session_id, task_no FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT session_id, task_no FROM o WHERE (session_id, task_no) NOT IN (SELECT (session_id, task_no) FROM n))""",
    "obligation_errors": """
WITH o AS (SELECT o_custkey AS task_id, o_orderkey AS pos, CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE o_orderpriority END AS id, o_orderkey % 5 = 0 AS no_text, o_orderkey % 4 AS form FROM orders),
b AS (SELECT *, id = ' ' OR row_number() OVER (PARTITION BY task_id, id ORDER BY pos) > 1 AS bad FROM o)
SELECT task_id, pos, 'OBLIGATION_ID_INVALID' AS code FROM b WHERE bad UNION ALL SELECT task_id, pos, 'OBLIGATION_TEXT_REQUIRED' FROM b WHERE NOT bad AND no_text
UNION ALL SELECT task_id, pos, 'OBLIGATION_EVIDENCE_REQUIRED' FROM b WHERE NOT bad AND (form IN (0, 1) OR task_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'))""",
}
