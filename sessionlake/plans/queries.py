"""Queries over the driver's tables and their SQL; tables stand in for session logs where these have no counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import text as texts
from sessionlake.operators import evidence, sessions

CAPABILITY_CELL = "CASE WHEN quality = 0 AND toxic = 1 THEN 'lacking_failed' WHEN quality = 0 THEN 'present_failed' WHEN toxic = 1 THEN 'lacking_passed' ELSE 'present_passed' END"
EVENT_OPS = "CASE WHEN event_id % 11 = 0 THEN 'write' WHEN event_id % 13 = 0 THEN 'unknown' ELSE 'read' END"
REPORT = """
  SELECT o_orderkey AS report_id, o_custkey AS ingest_pos, CASE o_orderstatus WHEN 'F' THEN 'ELIGIBLE' WHEN 'O' THEN 'REVIEW' END AS decision,
         CASE WHEN o_orderkey % 3 = 0 THEN 'FAILURE' WHEN o_orderkey % 3 = 1 THEN 'SUCCESS' END AS outcome, CASE WHEN o_orderkey % 5 = 0 THEN 'HIGH' ELSE 'LOW' END AS recoverability,
         CASE WHEN o_orderkey % 11 = 0 THEN 'PLAN_EXECUTION_FAILURE' WHEN o_orderkey % 11 = 1 THEN 'INCONCLUSIVE' END AS failure, o_custkey % 4 AS rubric_total, o_orderkey % 7 AS evidence_count, o_totalprice AS confidence FROM orders
"""
CANDIDATE = """
  SELECT o_orderkey AS candidate_id, CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'INCONCLUSIVE' ELSE 'FAIL' END AS verifier_status,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 0.5 WHEN o_orderkey % 103 = 0 THEN 1.5 ELSE 1.0 END AS reward, CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE 0.75 + (o_orderkey % 4) / 8.0 END AS task_confidence, 0.9 AS environment_confidence,
         0.6 + (o_custkey % 5) / 10.0 AS trajectory_quality, CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE o_custkey % 6 = 1 END AS solution_leakage, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 7 <> 1 END AS reproducible FROM orders
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, table: str, query: str) -> DataFrame:
    return spark.sql(query.replace(f"FROM {table}", "FROM {t}"), t=_table(spark, sf_dir, table))


def session_spans(spark, sf_dir):
    return sessions.request_spans(_table(spark, sf_dir, "conversations"), "conv_id", "turn")


def previous_replies(spark, sf_dir):
    return sessions.previous_replies(_table(spark, sf_dir, "conversations"), "conv_id", "turn").select("conv_id", "turn", "reply_pos")


def _calls(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("session_id"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 2 == 0, "call").otherwise("result").alias("kind"), F.col("event_type").alias("call_id"), F.expr("event_id div 100").alias("span_no"))


def call_states(spark, sf_dir):
    return sessions.matched_calls(_calls(spark, sf_dir)).select("event_id", "state")


def linkage_errors(spark, sf_dir):
    return sessions.linkage_errors(_calls(spark, sf_dir)).select("event_id", "code", "call_pos")


def line_inventory(spark, sf_dir):
    return sessions.lines_of(_table(spark, sf_dir, "documents"), "doc_id")


def line_ranges(spark, sf_dir):
    return sessions.line_ranges(_table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 100).alias("path"), F.col("l_partkey").alias("line")))


def replayed_files(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    ops = e.select(F.col("user_id").alias("session_id"), F.col("event_type").alias("path"), F.col("event_id").alias("pos"), F.expr(EVENT_OPS).alias("kind"), (F.col("event_id") % 2 == 0).alias("may_mutate"), F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("content"))
    return sessions.first_observations(ops)


def usage_totals(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_id") % 17 > 0, F.col("event_id")).alias("tokens"))
    return e.groupBy("user_id").agg(sessions.strict_sum(F.col("tokens")).alias("strict_tokens"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("known_tokens"))


def review_queue(spark, sf_dir):
    reports = _sql(spark, sf_dir, "orders", REPORT)
    return evidence.review_queue(reports, 4000, failure="failure").select("report_id", "decision_rank", "outcome_rank", "recoverability_rank", "weight")


def curation_gate(spark, sf_dir):
    return evidence.curated(_sql(spark, sf_dir, "orders", CANDIDATE)).select("candidate_id", "eligibility", F.array_join("rejection_reasons", ",").alias("reasons"), F.array_join("input_errors", ",").alias("input_errors"), F.size("selection_reasons").alias("passes"))


def curation_metrics(spark, sf_dir):
    return evidence.curation_metrics(evidence.curated(_sql(spark, sf_dir, "orders", CANDIDATE)))


def _capabilities(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    cells = labels.join(docs, "doc_id").select((F.col("doc_id") % 3).alias("run"), F.col("lang").alias("capability"), F.expr(CAPABILITY_CELL).alias("cell"), F.col("doc_id").alias("trajectory_id"))
    outcome = F.when(F.col("doc_id") % 10 == 9, "UNKNOWN").when(F.col("quality") == 0, "FAILURE").otherwise("SUCCESS")
    return evidence.capability_metrics(cells, labels.select(F.col("doc_id").alias("trajectory_id"), outcome.alias("outcome")).where("trajectory_id % 10 <> 8"))


def capability_metrics(spark, sf_dir):
    return _capabilities(spark, sf_dir)


def selected_capabilities(spark, sf_dir):
    return evidence.selected_capabilities(_capabilities(spark, sf_dir), 3, rho=0.01, delta=0.0, least=2)


def stage_funnel(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "READY").when(F.col("o_orderkey") % 4 > 0, "REVIEW")
    return evidence.stage_funnel(o.select(F.col("o_orderkey").alias("task_id"), F.col("o_orderpriority").alias("stage"), status.alias("status")))


def boundary_mismatches(spark, sf_dir):
    return evidence.boundary_mismatches(_table(spark, sf_dir, "orders").selectExpr("o_custkey AS key"), _table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS key"), "key")


def workspace_profiles(spark, sf_dir):
    folder = F.when(F.col("doc_id") % 13 == 0, "tests").otherwise("src")
    files = _table(spark, sf_dir, "documents").select("source", F.concat_ws("/", folder, F.concat("doc_id", F.lit("."), "lang")).alias("path"), "text")
    out = texts.workspace_profiles(files, "source")
    return out.select("source", "files", F.array_join("languages", ",").alias("languages"), "tokens", F.array_join("capabilities", ",").alias("capabilities"))


def secret_findings(spark, sf_dir):
    return texts.secret_findings(_table(spark, sf_dir, "documents"), "doc_id", detectors=texts.secret_detectors(names=("token",)))


QUERIES = {
    f.__name__: f
    for f in (session_spans, previous_replies, call_states, linkage_errors, line_inventory, line_ranges, replayed_files, usage_totals, review_queue, curation_gate, curation_metrics, capability_metrics, selected_capabilities, stage_funnel, boundary_mismatches, workspace_profiles, secret_findings)
}

_CALLS = "calls AS (SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN 'call' ELSE 'result' END AS kind, event_type, event_id // 100 AS span_no FROM events)"
_GATED = f"""
g AS (SELECT *, list_filter([CASE WHEN verifier_status NOT IN ('PASS', 'INCONCLUSIVE') THEN 'VERIFIER_NOT_PASS' END, CASE WHEN reward < 1.0 THEN 'REWARD_BELOW_THRESHOLD' END, CASE WHEN task_confidence < 0.8 THEN 'TASK_CONFIDENCE_LOW' END,
        CASE WHEN environment_confidence < 0.8 THEN 'ENVIRONMENT_CONFIDENCE_LOW' END, CASE WHEN trajectory_quality < 0.7 THEN 'TRAJECTORY_QUALITY_LOW' END, CASE WHEN solution_leakage THEN 'SOLUTION_LEAKAGE' END, CASE WHEN NOT reproducible THEN 'NOT_REPRODUCIBLE' END], lambda x: x IS NOT NULL) AS rejects,
      list_filter([CASE WHEN verifier_status = 'INCONCLUSIVE' THEN 'VERIFIER_UNVERIFIED' END, CASE WHEN reward IS NULL THEN 'REWARD_UNVERIFIED' END, CASE WHEN solution_leakage IS NULL THEN 'SOLUTION_LEAKAGE_UNVERIFIED' END, CASE WHEN reproducible IS NULL THEN 'REPRODUCIBILITY_UNVERIFIED' END], lambda x: x IS NOT NULL) AS reviews
      FROM ({CANDIDATE})),
i AS (SELECT *, concat_ws(',', CASE WHEN task_confidence IS NULL THEN 'TASK_CONFIDENCE_INVALID' END, CASE WHEN reward > 1 THEN 'REWARD_INVALID' END) AS input_errors FROM g),
e AS (SELECT candidate_id, input_errors, CASE WHEN input_errors <> '' THEN NULL WHEN len(rejects) > 0 THEN 'REJECT' WHEN len(reviews) > 0 THEN 'REVIEW' ELSE 'ELIGIBLE' END AS eligibility,
      CASE WHEN input_errors <> '' THEN '' ELSE array_to_string(CASE WHEN len(rejects) > 0 THEN rejects ELSE reviews END, ',') END AS reasons FROM i)
"""
_METRICS = f"""
t AS (SELECT count(*) FILTER (quality = 0) AS failures FROM labels WHERE doc_id % 10 < 8),
c AS (SELECT doc_id % 3 AS run, lang AS capability, {CAPABILITY_CELL} AS cell, doc_id AS trajectory_id FROM labels JOIN documents USING (doc_id) WHERE doc_id % 10 < 8),
s AS (SELECT run, capability, count(DISTINCT trajectory_id) FILTER (cell = 'lacking_failed') AS lacking_failed, count(DISTINCT trajectory_id) FILTER (cell = 'present_failed') AS present_failed,
      count(DISTINCT trajectory_id) FILTER (cell = 'lacking_passed') AS lacking_passed, count(DISTINCT trajectory_id) FILTER (cell = 'present_passed') AS present_passed FROM c GROUP BY ALL),
m AS (SELECT *, lacking_failed / failures AS coverage, coalesce(lacking_failed / nullif(lacking_failed + present_failed, 0), 0.0) AS error_rate_failed, coalesce(lacking_passed / nullif(lacking_passed + present_passed, 0), 0.0) AS error_rate_success FROM s, t)
"""

ORACLE_SQL = {
    "session_spans": """
WITH f AS (SELECT *, CASE WHEN role = 'user' AND coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') <> 'user' THEN 1 ELSE 0 END AS starts FROM conversations),
n AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS INTEGER) AS span_no FROM f)
SELECT conv_id, span_no, min(turn) AS message_start, max(turn) + 1 AS message_end, count(*) FILTER (role = 'user') AS user_messages, count(*) FILTER (role = 'assistant') = 0 AS truncated_target
FROM n WHERE span_no > 0 GROUP BY conv_id, span_no""",
    "previous_replies": "SELECT u.conv_id, u.turn, (SELECT max(a.turn) FROM conversations a WHERE a.conv_id = u.conv_id AND a.turn < u.turn AND a.role = 'assistant' AND trim(coalesce(a.text, '')) <> '') AS reply_pos FROM conversations u WHERE role = 'user'",
    "call_states": f"""
WITH {_CALLS}, w AS (SELECT *, lag(kind) OVER o AS before, lead(kind) OVER o AS after FROM calls WINDOW o AS (PARTITION BY user_id, event_type ORDER BY event_id))
SELECT event_id, CASE WHEN kind = 'result' AND before = 'call' OR kind = 'call' AND after = 'result' THEN 'matched' WHEN kind = 'call' THEN 'pending' ELSE 'orphan' END AS state FROM w""",
    "linkage_errors": f"""
WITH {_CALLS}, w AS (SELECT r.event_id, r.span_no, max(c.event_id) AS call_pos FROM calls r LEFT JOIN calls c ON c.kind = 'call' AND c.user_id = r.user_id AND c.event_type = r.event_type AND c.event_id < r.event_id WHERE r.kind = 'result' GROUP BY ALL)
SELECT event_id, CASE WHEN call_pos IS NULL THEN 'orphan_tool_result' ELSE 'tool_link_crosses_span' END AS code, call_pos FROM w WHERE call_pos IS NULL OR call_pos // 100 <> span_no""",
    "line_inventory": """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, len(parts) AS n, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_number FROM s),
r AS (SELECT doc_id, line_number, CASE WHEN line_number < n THEN line || chr(10) ELSE line END AS raw FROM l)
SELECT doc_id, CAST(line_number AS INTEGER) AS line_number, sha256(raw) AS line_sha256, CAST(coalesce(sum(strlen(raw)) OVER (PARTITION BY doc_id ORDER BY line_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset, CAST(strlen(raw) AS BIGINT) AS byte_length
FROM r WHERE raw <> ''""",
    "line_ranges": """
WITH d AS (SELECT DISTINCT l_orderkey % 100 AS path, l_partkey AS line FROM lineitem), i AS (SELECT *, line - row_number() OVER (PARTITION BY path ORDER BY line) AS island FROM d)
SELECT path, min(line) AS first, max(line) AS last FROM i GROUP BY path, island""",
    "replayed_files": f"""
WITH o AS (SELECT user_id AS session_id, event_type AS path, event_id AS pos, {EVENT_OPS} AS kind, event_id % 2 = 0 AS may_mutate, CASE WHEN event_id % 3 > 0 THEN props END AS content FROM events),
u AS (SELECT session_id, min(pos) AS u FROM o WHERE kind = 'unknown' AND may_mutate GROUP BY session_id), w AS (SELECT session_id, path, min(pos) AS w FROM o WHERE kind = 'write' GROUP BY ALL),
r AS (SELECT o.*, coalesce(pos > w, false) AS late, NOT coalesce(pos > w, false) AND coalesce(pos > u, false) AS unparsed FROM o LEFT JOIN u USING (session_id) LEFT JOIN w USING (session_id, path) WHERE kind = 'read')
SELECT session_id, path, arg_min(content, pos) FILTER (NOT late AND NOT unparsed AND content IS NOT NULL) AS observed, min(pos) FILTER (NOT late AND NOT unparsed AND content IS NOT NULL) AS observed_pos,
       count(*) FILTER (NOT late AND NOT unparsed) AS trusted_reads, count(*) FILTER (late) AS after_write, count(*) FILTER (unparsed) AS after_unparsed FROM r GROUP BY session_id, path""",
    "usage_totals": "SELECT user_id, CAST(CASE WHEN count(CASE WHEN event_id % 17 > 0 THEN 1 END) = count(*) THEN sum(event_id) END AS BIGINT) AS strict_tokens, CAST(coalesce(sum(CASE WHEN event_id % 17 > 0 THEN event_id END), 0) AS BIGINT) AS known_tokens FROM events GROUP BY user_id",
    "review_queue": f"""
WITH d AS (SELECT *, coalesce(failure, 'INCONCLUSIVE') <> 'INCONCLUSIVE' AS failed FROM ({REPORT}))
SELECT report_id, CASE WHEN decision = 'ELIGIBLE' THEN 4 WHEN decision = 'REVIEW' OR failed THEN 3 ELSE 2 END AS decision_rank, CASE WHEN outcome = 'FAILURE' THEN 3 WHEN outcome = 'SUCCESS' THEN 0 WHEN failed THEN 3 ELSE 1 END AS outcome_rank,
       CASE recoverability WHEN 'HIGH' THEN 3 ELSE 1 END AS recoverability_rank, CASE WHEN rubric_total = 0 THEN evidence_count ELSE rubric_total END + confidence AS weight
FROM d ORDER BY 2 DESC, 3 DESC, 4 DESC, 5 DESC, CAST(report_id AS VARCHAR) DESC LIMIT 4000""",
    "curation_gate": f"WITH {_GATED} SELECT candidate_id, eligibility, reasons, input_errors, CAST(CASE WHEN eligibility = 'ELIGIBLE' THEN 5 ELSE 0 END AS INTEGER) AS passes FROM e",
    "curation_metrics": f"WITH {_GATED} SELECT count(*) AS input_count, count(*) FILTER (eligibility = 'ELIGIBLE') AS eligible_count, count(*) FILTER (eligibility = 'REVIEW') AS review_count, count(*) FILTER (eligibility = 'REJECT') AS reject_count, count(*) FILTER (eligibility = 'ELIGIBLE') / count(*) AS eligibility_rate, count(*) FILTER (eligibility = 'REVIEW') / count(*) AS review_rate FROM e",
    "capability_metrics": f"WITH {_METRICS} SELECT run, capability, lacking_failed, present_failed, lacking_passed, present_passed, coverage, error_rate_failed, error_rate_success, error_rate_failed - error_rate_success AS contrastive_gap FROM m",
    "selected_capabilities": f"WITH {_METRICS} SELECT capability, sum(coverage) / 3 AS coverage, sum(error_rate_failed - error_rate_success) / 3 AS contrastive_gap, count(*) FILTER (coverage >= 0.01 AND error_rate_failed - error_rate_success >= 0) AS pass_count, CASE WHEN count(DISTINCT run) < 3 THEN 'INCOMPLETE_RUNS' WHEN count(*) FILTER (coverage >= 0.01 AND error_rate_failed - error_rate_success >= 0) >= 2 THEN 'SELECTED' ELSE 'REJECTED' END AS status, count(*) FILTER (coverage >= 0.01 AND error_rate_failed - error_rate_success >= 0) / 3 AS consistency_ratio FROM m GROUP BY capability",
    "stage_funnel": "WITH s AS (SELECT o_orderpriority AS stage, CASE WHEN o_orderstatus = 'F' THEN 'READY' WHEN o_orderkey % 4 > 0 THEN 'REVIEW' ELSE 'NOT_RUN' END AS status FROM orders) SELECT stage, count(*) AS tasks, count(*) FILTER (status = 'READY') AS ready, count(*) FILTER (status = 'REVIEW') AS review, count(*) FILTER (status = 'NOT_RUN') AS not_run FROM s GROUP BY stage",
    "boundary_mismatches": "WITH a AS (SELECT DISTINCT o_custkey AS key FROM orders), b AS (SELECT DISTINCT l_partkey AS key FROM lineitem) SELECT key, 'left_only' AS side FROM a WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, 'right_only' FROM b WHERE key NOT IN (SELECT key FROM a)",
    "workspace_profiles": f"""
WITH f AS (SELECT * FROM documents WHERE doc_id % 13 <> 0), t AS (SELECT DISTINCT source, unnest(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_]{{2,}}'), lambda x: lower(x))) AS token FROM f),
c AS (SELECT source, count(*) AS tokens, coalesce(string_agg(token, ',' ORDER BY token) FILTER (token IN ('{"', '".join(texts.MARKERS)}')), '') AS capabilities FROM t GROUP BY source)
SELECT d.source, d.files, d.languages, coalesce(c.tokens, 0) AS tokens, coalesce(c.capabilities, '') AS capabilities
FROM (SELECT source, count(DISTINCT doc_id) AS files, string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages FROM f GROUP BY source) d LEFT JOIN c USING (source)""",
    # one value at a time: what precedes it tells its line
    "secret_findings": r"""
WITH RECURSIVE v AS (SELECT doc_id, m, regexp_extract(m, '"([0-9A-Za-z]{8,})"', 1) AS value FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)\btoken\s*=\s*"[0-9a-z]{8,}"')) AS m FROM documents)),
w AS (SELECT DISTINCT v.doc_id, v.m, v.value, d.text FROM v JOIN documents d USING (doc_id)),
a AS (SELECT doc_id, m, value, string_split(text, m) AS parts FROM w),
l AS (SELECT doc_id, value, m, k, list_reduce(list_transform(parts[1:k], lambda x: length(x) - length(replace(x, chr(10), ''))), lambda x, y: x + y) + (k - 1) * (length(m) - length(replace(m, chr(10), ''))) + 1 AS line FROM a, range(1, 2000) r(k) WHERE k < len(parts))
SELECT DISTINCT doc_id, CAST(line AS INTEGER) AS line, 'assigned_value' AS detector, sha256(value) AS match_sha256 FROM l""",
}
