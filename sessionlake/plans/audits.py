"""Queries of the audits over the driver's tables and their SQL; orders, lines and events stand in for runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import audits, sessions

TRIAL_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'FAIL' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'INFRA_ERROR' ELSE 'INCONCLUSIVE' END END"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger_audit(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    return audits.ledger_gaps(e.select(F.expr("event_id div 3").alias("operation_id"), F.expr("CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'terminal' END").alias("event")))


def retry_superseded(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("event_id").alias("started"), (F.col("event_id") + F.col("event_id") % 50).alias("finished"), (F.col("event_id") % 3 > 0).alias("ok"))
    e = e.withColumn("finished", F.when(F.col("event_id") % 41 > 0, F.col("finished")))
    return audits.superseded_failures(e, ["user_id", "event_type"], "event_id", "event_id", "started", "finished").select("event_id", "superseded_by")


def _lines(spark, sf_dir):
    text = F.when(F.col("l_orderkey") % 7 == 0, F.col("l_partkey").cast("string")).otherwise(F.lit("x"))
    total = F.when(F.col("l_orderkey") % 5 == 0, F.col("l_orderkey") % 4 + 1).when(F.col("l_linenumber") % 2 == 1, F.lit(7)).when(F.col("l_orderkey") % 3 == 0, F.lit(6)).cast("int")
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("line"), text.alias("text"), total.alias("total"))


def segment_merge(spark, sf_dir):
    return audits.merged_reads(_lines(spark, sf_dir))


def missing_ranges(spark, sf_dir):
    total = F.when(F.col("path") % 4 == 0, F.lit(9)).when(F.col("path") % 4 == 1, 8 + F.col("line") % 2).when(F.col("path") % 4 == 2, F.lit(3))
    return audits.missing_ranges(_lines(spark, sf_dir).withColumn("total", total.cast("int")))


def workspace_mode(spark, sf_dir):
    return audits.most_common_value(_table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


def _trials(spark, sf_dir):
    tokens, seconds = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_custkey") % 100)
    return _table(spark, sf_dir, "orders").select("o_orderpriority", F.expr(TRIAL_STATUS).alias("status"), tokens.alias("tokens"), seconds.alias("seconds"))


def rollout_metrics(spark, sf_dir):
    return audits.rollout_metrics(_trials(spark, sf_dir))


def quality_gate(spark, sf_dir):
    gated = audits.quality_gate(audits.rollout_metrics(_trials(spark, sf_dir), ["o_orderpriority"]), 300)
    return gated.select("o_orderpriority", "trials", "gate", F.array_join("reasons", ",").alias("reasons"))


def requirement_ledger(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return audits.latest_by_key(o, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


def retained_sessions(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    return audits.verified_sessions(o.select(F.col("o_custkey").alias("session_id"), F.expr("o_orderkey % 8").alias("round_index"), F.expr(TRIAL_STATUS).alias("status")))


def red_checks(spark, sf_dir):
    kind = "CASE l_returnflag WHEN 'A' THEN 'oracle_pass' WHEN 'N' THEN 'nop_fail' ELSE 'mutation_fail' END"
    cases = _table(spark, sf_dir, "lineitem").select(F.expr("l_orderkey").alias("task_id"), F.expr(kind).alias("kind"), F.lit("F").alias("expected"), F.when(F.col("l_quantity") > 5, "F").alias("observed"))
    return audits.red_check(cases).withColumn("missing", F.array_join("missing", ","))


def step_validation(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    return audits.step_errors(c.select("conv_id", "turn", F.when(F.col("turn") % 4 < 3, F.col("turn") + 1).cast("int").alias("step_id")), "conv_id", "turn")


def reason_counts(spark, sf_dir):
    return audits.reason_counts(_table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


def source_coverage(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("source", F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
    declared = docs.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    declared = declared.select("source", F.when(F.char_length("source") % 2 == 0, F.col("n")).otherwise(F.lit(-1)).alias("records"), "bytes")
    return audits.coverage(docs, declared, size="size")


def duplicate_lines(spark, sf_dir):
    return audits.duplicate_lines(sessions.lines_of(_table(spark, sf_dir, "documents"), "doc_id"))


def path_ancestors(spark, sf_dir):
    path = F.regexp_replace("url", "^[a-z]+://", "")
    return _table(spark, sf_dir, "pages").select(F.explode(audits.ancestors(path)).alias("folder")).groupBy("folder").agg(F.count("*").alias("pages"))


def safe_paths(spark, sf_dir):
    path = F.regexp_replace("url", "^https?://[^/]*/", "")
    return _table(spark, sf_dir, "pages").select("page_id", audits.safe_relative_path(path).alias("safe"))


QUERIES = {
    f.__name__: f
    for f in (ledger_audit, retry_superseded, segment_merge, missing_ranges, workspace_mode, rollout_metrics, quality_gate, requirement_ledger, retained_sessions, red_checks, step_validation, reason_counts, source_coverage, duplicate_lines, path_ancestors, safe_paths)
}

_LINES = "lines AS (SELECT l_orderkey AS path, l_linenumber AS line, CASE WHEN l_orderkey % 7 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE 'x' END AS text, CASE WHEN l_orderkey % 5 = 0 THEN l_orderkey % 4 + 1 WHEN l_linenumber % 2 = 1 THEN 7 WHEN l_orderkey % 3 = 0 THEN 6 END AS total FROM lineitem)"
_TRIALS = f"trials AS (SELECT o_orderpriority, {TRIAL_STATUS} AS status, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS tokens, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey % 100 END AS seconds FROM orders)"

ORACLE_SQL = {
    "ledger_audit": """
WITH s AS (SELECT event_id // 3 AS operation_id, count(*) FILTER (event_type = 'signup') AS created, count(*) FILTER (event_type = 'purchase') AS terminal FROM events GROUP BY ALL)
SELECT *, CASE WHEN created > 0 THEN 'not_terminated' ELSE 'terminal_without_creation' END AS code FROM s WHERE (created > 0) <> (terminal > 0)""",
    "retry_superseded": """
WITH n AS (SELECT f.event_id, f.event_id % 41 > 0 AS timed, f.event_id + f.event_id % 50 AS finished, (SELECT min(s.event_id) FROM events s WHERE s.user_id = f.user_id AND s.event_type = f.event_type AND s.event_id % 3 > 0 AND s.event_id % 41 > 0 AND s.event_id > f.event_id) AS next
FROM events f WHERE f.event_id % 3 = 0) SELECT event_id, CASE WHEN timed AND finished <= next THEN next END AS superseded_by FROM n""",
    "segment_merge": f"""
WITH {_LINES}, n AS (SELECT path, line, min(text) AS text, count(DISTINCT text) AS texts, min(total) AS least, max(total) AS most FROM lines GROUP BY ALL),
p AS (SELECT path, CASE WHEN max(texts) > 1 THEN 'CONFLICT' WHEN min(least) <> max(most) THEN 'TOTAL_CONFLICT' WHEN max(line) > max(most) THEN 'RANGE_MISMATCH' WHEN list_sort(list(line)) = range(1, CAST(max(most) AS INTEGER) + 1) THEN 'COMPLETE' ELSE 'PARTIAL' END AS status,
 count(line) AS lines, string_agg(text || chr(10), '' ORDER BY line) AS content FROM n GROUP BY path)
SELECT path, status, lines, CASE WHEN status = 'COMPLETE' THEN content END AS content FROM p""",
    "missing_ranges": """
WITH seen AS (SELECT DISTINCT l_orderkey AS path, l_linenumber AS line FROM lineitem), p AS (SELECT path, max(line) AS last, path % 4 = 1 AND count(DISTINCT line % 2) > 1 AS torn, CASE path % 4 WHEN 0 THEN 9 WHEN 1 THEN 8 + min(line % 2) WHEN 2 THEN 3 END AS total FROM seen GROUP BY path),
m AS (SELECT path, k FROM p, range(1, 10) r(k) WHERE NOT torn AND total >= last AND k <= total AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.path = p.path AND s.line = k)),
i AS (SELECT *, k - row_number() OVER (PARTITION BY path ORDER BY k) AS island FROM m)
SELECT path, min(k) AS first, max(k) AS last FROM i GROUP BY path, island UNION ALL SELECT path, NULL, NULL FROM p WHERE total IS NULL""",
    "workspace_mode": """
WITH c AS (SELECT user_id, event_type, count(*) AS uses, min(event_id) AS first_id FROM events WHERE event_type IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type, uses FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY uses DESC, first_id) = 1""",
    "rollout_metrics": f"""
WITH {_TRIALS} SELECT count(*) AS trials, count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'FAIL') AS fail, count(*) FILTER (status = 'INFRA_ERROR') AS infra_error, count(*) FILTER (status = 'INCONCLUSIVE') AS inconclusive,
       count(*) FILTER (status = 'PASS') / count(*) AS pass_rate, CAST(sum(tokens) AS BIGINT) AS tokens, avg(seconds) AS mean_seconds FROM trials""",
    "quality_gate": f"""
WITH {_TRIALS}, s AS (SELECT o_orderpriority, count(*) AS trials, count(*) FILTER (status = 'INFRA_ERROR') AS infra, count(*) FILTER (status = 'INCONCLUSIVE') AS unsure FROM trials GROUP BY ALL),
r AS (SELECT *, concat_ws(',', CASE WHEN trials <> 300 THEN 'TRIAL_COUNT_MISMATCH' END, CASE WHEN infra > 0 THEN 'INFRA_ERRORS' END, CASE WHEN unsure > 0 THEN 'INCONCLUSIVE_TRIALS' END) AS reasons FROM s)
SELECT o_orderpriority, trials, CASE WHEN reasons = '' THEN 'PASS' ELSE 'REVIEW' END AS gate, reasons FROM r""",
    "requirement_ledger": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "retained_sessions": f"""
WITH r AS (SELECT o_custkey AS session_id, o_orderkey % 8 AS k, {TRIAL_STATUS} AS status FROM orders)
SELECT session_id, count(*) AS rounds, count(*) FILTER (status = 'PASS') AS passed, list_sort(list(k)) = range(0, count(*)) AND count(*) FILTER (status = 'PASS') >= 2 AS retained FROM r GROUP BY session_id""",
    "red_checks": """
WITH s AS (SELECT l_orderkey AS task_id, count(*) AS cases, count(*) FILTER (l_quantity <= 5) AS wrong,
  concat_ws(',', CASE WHEN NOT bool_or(l_returnflag = 'A') THEN 'oracle_pass' END, CASE WHEN NOT bool_or(l_returnflag = 'N') THEN 'nop_fail' END, CASE WHEN NOT bool_or(l_returnflag NOT IN ('A', 'N')) THEN 'mutation_fail' END) AS missing FROM lineitem GROUP BY ALL)
SELECT *, wrong = 0 AND missing = '' AS passed FROM s""",
    "step_validation": "SELECT conv_id, turn, CAST(CASE WHEN turn % 4 < 3 THEN turn + 1 END AS INTEGER) AS step_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS expected FROM conversations QUALIFY step_id IS DISTINCT FROM expected",
    "reason_counts": "SELECT o_orderpriority, count(DISTINCT o_custkey) AS tasks FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL",
    "source_coverage": "SELECT source, count(*) AS records, CAST(sum(strlen(coalesce(text, ''))) AS BIGINT) AS bytes, CASE WHEN length(source) % 2 = 0 THEN 'READY' ELSE 'PARTIAL_SOURCE' END AS status FROM documents GROUP BY source",
    "duplicate_lines": """
WITH s AS (SELECT string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), l AS (SELECT len(parts) AS n, unnest(parts) AS line, generate_subscripts(parts, 1) AS k FROM s),
r AS (SELECT CASE WHEN k < n THEN line || chr(10) ELSE line END AS raw FROM l)
SELECT count(*) AS lines, count(DISTINCT raw) AS distinct_lines, count(*) - count(DISTINCT raw) AS duplicates FROM r WHERE raw <> ''""",
    "path_ancestors": """
WITH p AS (SELECT string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS parts FROM pages), a AS (SELECT array_to_string(parts[1:k], '/') AS folder FROM p, unnest(range(1, len(parts))) t(k))
SELECT folder, count(*) AS pages FROM a GROUP BY folder""",
    "safe_paths": r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://[^/]*/', '') AS path FROM pages)
SELECT page_id, coalesce(path <> '' AND NOT list_has_any(string_split(path, '/'), ['', '.', '..']) AND NOT contains(path, '\'), false) AS safe FROM p""",
}
