"""Queries of the gates over the driver's tables and their SQL; orders, lines and events stand in for tasks, trials and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import audits, evidence, gates

_joined = lambda c: F.array_join(c, ",")


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


TRIAL = [
    "o_orderkey AS trial_id", "o_custkey AS job_id", "CASE o_orderkey % 6 WHEN 0 THEN 'AgentTimeoutError' WHEN 1 THEN '' WHEN 2 THEN 'OSError' END AS exception", "CASE o_orderstatus WHEN 'F' THEN 1.0D WHEN 'O' THEN 0.0D END AS reward",
    "CASE o_orderkey % 5 WHEN 0 THEN 'TASK_PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'PASS' WHEN 3 THEN 'TASK_FAIL' END AS verdict",
]


def trial_statuses(spark, sf_dir):
    return _table(spark, sf_dir, "orders", *TRIAL).select("trial_id", gates.trial_status(F.col("exception"), F.col("reward"), F.col("verdict")).alias("status"))


WORDS = "CASE o_orderkey % 9 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'budget timeout' WHEN 2 THEN 'max_tokens' WHEN 3 THEN 'agent_error' WHEN 4 THEN 'infra_verifier' WHEN 5 THEN 'environment_error infra_agent' ELSE 'done' END"


def explicit_states(spark, sf_dir):
    o = _table(spark, sf_dir, "orders", "o_orderkey AS trial_id", f"array('ok', {WORDS}) AS words", "CASE o_orderkey % 4 WHEN 0 THEN false WHEN 1 THEN true END AS cleanup")
    return o.select("trial_id", gates.explicit_state(F.col("words"), F.col("cleanup")).alias("state"))


ERRORS = "CASE o_orderkey % 8 WHEN 0 THEN 'SECRET_LEAK' WHEN 1 THEN 'ARTIFACT_HASH_MISMATCH' WHEN 2 THEN 'VERDICT_NOT_OBJECT' WHEN 3 THEN 'SOMETHING' WHEN 4 THEN 'WORKSPACE_BINDING_INVALID' END"


def certified_trials(spark, sf_dir):
    o = _table(spark, sf_dir, "orders", "o_orderkey AS trial_id", "CASE WHEN o_custkey % 7 = 0 THEN 'CANCELLED' END AS explicit_status", "CASE o_custkey % 11 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS metadata_ok", f"array_compact(array({ERRORS})) AS errors", "CASE o_orderstatus WHEN 'F' THEN 1.0D WHEN 'O' THEN 0.5D END AS reward", "o_custkey % 5 > 0 AS checks_ok")
    return gates.certified(o).select("trial_id", "status", "certified", "task_passed")


def _jobs(spark, sf_dir):
    return _table(spark, sf_dir, "customer", "c_custkey AS job_id", "CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 13 AS BIGINT) END AS expected_trials", "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN c_custkey % 2 = 0 END AS cleanup_ok", "CASE WHEN c_custkey % 4 > 0 THEN true END AS gate_ok")


def _trials(spark, sf_dir):
    return _table(spark, sf_dir, "orders", "o_custkey AS job_id", "concat('t', o_orderkey) AS trial_name", "CASE WHEN o_orderkey % 10 > 0 THEN 'PASS' ELSE 'TIMEOUT' END AS status", "CASE WHEN o_orderkey % 31 > 0 THEN 1.0D END AS reward", "o_orderkey % 37 > 0 AS trajectory_present", "true AS manifest_present", "CASE WHEN o_orderkey % 41 > 0 THEN true ELSE false END AS content_valid", "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS tokens", "CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey % 100 AS DOUBLE) END AS seconds")


def padded_trials(spark, sf_dir):
    return audits.padded_trials(_trials(spark, sf_dir), _jobs(spark, sf_dir)).select("job_id", "trial_name", "status", "error_code")


def job_gates(spark, sf_dir):
    gated = audits.job_gate(audits.job_metrics(_trials(spark, sf_dir)).join(_jobs(spark, sf_dir), "job_id"))
    return gated.select("job_id", "trials", "completed", "pass_rate", "trajectory_rate", "tokens", "mean_seconds", "ok", _joined("reasons").alias("reasons"))


def reproducibility(spark, sf_dir):
    trials = _trials(spark, sf_dir).where("job_id % 3 > 0").withColumns({"status": F.lit("PASS"), "reward": F.when(F.col("reward").isNotNull() | (F.col("job_id") % 2 == 0), 1.0)})
    return gates.reproducibility(_jobs(spark, sf_dir), trials)


def first_values(spark, sf_dir):
    o = _table(spark, sf_dir, "orders", "o_orderkey AS id", "CASE o_orderkey % 3 WHEN 0 THEN '{\"x\": 1}' WHEN 1 THEN concat('{\"a\": ', o_custkey, '}') END AS one", "CASE o_orderkey % 4 WHEN 0 THEN '{\"b\": null}' WHEN 1 THEN concat('{\"b\": ', o_orderkey, ', \"a\": true}') ELSE '[1]' END AS two")
    return o.select("id", gates.first_present([F.col("one"), F.col("two")], ("a", "b")).alias("value"))


def overall_statuses(spark, sf_dir):
    return evidence.overall_status(_table(spark, sf_dir, "orders", "o_custkey AS task_group", "CASE WHEN o_custkey % 5 = 0 OR o_orderkey % 3 = 0 THEN 'ELIGIBLE' WHEN o_orderstatus = 'O' AND o_custkey % 5 > 1 THEN 'PENDING' ELSE 'REJECT' END AS eligibility").where("task_group % 7 <> 1 or eligibility <> 'ELIGIBLE'"), "task_group")


def label_partition_errors(spark, sf_dir):
    e = _table(spark, sf_dir, "events", "event_id % 3 AS run", "event_type AS capability", "'present_failed' AS cell", "event_id % 500 AS trajectory_id").distinct()
    cells = e.where("not (run = 0 and capability = 'view')").union(e.where("run = 1 and capability = 'error' and trajectory_id < 9"))
    outcomes = _table(spark, sf_dir, "events", "event_id % 500 AS trajectory_id").distinct().selectExpr("trajectory_id", "CASE WHEN trajectory_id % 100 = 99 THEN 'UNKNOWN' WHEN trajectory_id % 2 = 0 THEN 'SUCCESS' ELSE 'FAILURE' END AS outcome")
    return evidence.label_partition_errors(cells.where("trajectory_id % 100 <> 99 or capability <> 'click'"), outcomes)


def failed_examples(spark, sf_dir):
    cells = _table(spark, sf_dir, "events", "event_type AS capability", "CASE WHEN event_id % 4 = 0 THEN 'lacking_failed' ELSE 'NA' END AS cell", "event_id % 300 AS trajectory_id")
    out = evidence.failed_examples(cells)
    return out.select("capability", _joined(F.col("examples").cast("array<string>")).alias("examples"))


PATHS = "concat_ws('/', o_orderpriority, o_orderstatus, o_orderkey % 5)"


def unknown_initial_states(spark, sf_dir):
    partial = _table(spark, sf_dir, "orders", "o_custkey AS task_id", f"CASE WHEN o_orderkey % 6 > 0 THEN {PATHS} END AS path", "CASE o_orderkey % 3 WHEN 0 THEN 'unparsed_mutation_scope' WHEN 1 THEN 'read_after_unparsed_mutation' ELSE 'partial_read_range' END AS reason", "o_orderkey AS source_event_id")
    required = _table(spark, sf_dir, "orders", "o_custkey AS task_id", f"CASE WHEN o_orderkey % 4 = 0 THEN concat(o_orderpriority, '/') ELSE {PATHS} END AS path").where("task_id % 3 > 0")
    trusted = _table(spark, sf_dir, "orders", "o_custkey AS task_id", f"{PATHS} AS path", "o_orderkey").where("o_orderkey % 7 = 0").select("task_id", "path").distinct()
    return gates.unknown_initial_states(partial, required, trusted)


def task_outlook(spark, sf_dir):
    errors = "CASE c_custkey % 9 WHEN 0 THEN array('MODEL_TIMEOUT:x') WHEN 1 THEN array('INVALID_JSON', 'OTHER') WHEN 2 THEN array('OTHER') WHEN 3 THEN NULL ELSE array() END"
    tasks = _table(spark, sf_dir, "customer", "c_custkey AS task_id", f"CAST({errors} AS ARRAY<STRING>) AS errors", "CASE WHEN c_custkey % 10 = 0 THEN true END AS pending", "CASE WHEN c_custkey % 11 = 0 THEN 'INSUFFICIENT' WHEN c_custkey % 11 = 1 THEN NULL ELSE 'SUFFICIENT' END AS label")
    blockers = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "CASE WHEN o_orderkey % 5 = 0 THEN 'UNKNOWN_INITIAL_STATE_UNSCOPED' ELSE 'MISSING' END AS code", "o_orderkey % 5 > 0 AND o_custkey % 4 = 0 AS confirmed").where("task_id % 3 = 0")
    return gates.task_outlook(tasks, blockers)


def support_routes(spark, sf_dir):
    tasks = _table(spark, sf_dir, "customer", "c_custkey AS task_id", "CASE c_custkey % 5 WHEN 0 THEN 'retrieval' WHEN 1 THEN 'terminal' END AS domain")
    files = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "concat(o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '.PY' WHEN 1 THEN '.txt' WHEN 2 THEN '/.hpp' ELSE '.Tsx' END) AS path").where("task_id % 4 > 0")
    return gates.support_routes(tasks, files)


def integrity_errors(spark, sf_dir):
    issues = _table(spark, sf_dir, "orders", "o_custkey % 50 AS report_id", "o_orderkey % 97 AS issue_id", "concat('p', o_orderkey % 97) AS path").distinct()
    given = _table(spark, sf_dir, "events", "user_id % 50 AS report_id", "event_id AS pos", "event_id % 101 AS issue_id", "concat('p', event_id % 101 + CASE WHEN event_id % 7 = 6 THEN 1 ELSE 0 END) AS path", "CASE event_type WHEN 'view' THEN 'IRRELEVANT' WHEN 'click' THEN 'GAP' WHEN 'error' THEN 'UNSURE' ELSE 'BASELINE_TASK_DEFECT' END AS classification", "CASE WHEN event_id % 7 = 5 THEN ' ' ELSE 'r' END AS reason")
    return gates.integrity_errors(issues, given)


def _scoped(spark, sf_dir):
    status = "CASE WHEN o_orderkey % 3 = 0 THEN 'BLOCKED' ELSE 'READY' END"
    scope = "CASE o_orderkey % 6 WHEN 0 THEN 'OUT_OF_SCOPE' WHEN 3 THEN 'NEEDS_REVIEW' WHEN 5 THEN NULL ELSE 'IN_SCOPE' END"
    tasks = _table(spark, sf_dir, "orders", "o_custkey AS session_id", "o_orderkey AS task_id", f"{status} AS status", "CASE WHEN o_orderkey % 3 = 0 THEN 'intent' END AS stopped_at", f"CASE WHEN o_orderkey % 3 = 0 THEN array(concat('DELIVERY_SCOPE_', {scope})) ELSE CAST(array() AS ARRAY<STRING>) END AS errors", f"{scope} AS scope_status", "CASE WHEN o_orderkey % 31 = 0 THEN ' ' ELSE 'why' END AS scope_reason", "array(concat('user:', o_orderkey % 5)) AS scope_refs", "array(o_orderkey % 5, o_orderkey % 4) AS message_indices", "CAST(o_custkey % 3 AS INT) AS exit_code")
    users = _table(spark, sf_dir, "customer", "c_custkey AS session_id", "explode(array(0L, 2L, 4L)) AS message_index")
    return gates.delivery_scopes(tasks, users)


def delivery_scopes(spark, sf_dir):
    return _scoped(spark, sf_dir).select("task_id", "scope")


def task_outcomes(spark, sf_dir):
    return gates.task_outcomes(_scoped(spark, sf_dir))


def requirement_coverage(spark, sf_dir):
    obligations = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderpriority AS obligation_id").distinct()
    given = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderkey AS pos", "CASE WHEN o_orderkey % 13 = 0 THEN 'none' ELSE o_orderpriority END AS obligation_id", "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'r' END AS reason", "CASE WHEN o_orderkey % 7 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE array(o_orderstatus, o_orderstatus) END AS refs").where("pos % 3 > 0")
    ref = lambda k: _table(spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderstatus AS ref", "o_orderkey").where(f"o_orderkey % 5 < {k}")
    return gates.requirement_coverage_errors(obligations, given, ref(4), ref(2))


def excluded_captures(spark, sf_dir):
    records = _table(spark, sf_dir, "events", "user_id AS session_id", "event_id AS event_index", "array(props, event_type) AS texts", "event_id % 9 = 0 AS pending")
    given = _table(spark, sf_dir, "events", "user_id AS session_id", "event_id AS pos", "event_id - event_id % 4 + CASE WHEN event_id % 50 = 1 THEN 100000 ELSE 0 END AS event_index", "CASE event_id % 3 WHEN 0 THEN 'task_answer' WHEN 1 THEN 'post_task_state' ELSE 'history' END AS kind", "CASE WHEN event_id % 7 = 0 THEN '' ELSE 'why' END AS reason", "CASE WHEN event_id % 5 = 0 THEN 'absent' ELSE substr(event_type, 2, 2) END AS quote").where("pos % 2 = 0 or pos % 50 = 1")
    return gates.excluded_captures(given, records).select("pos", "code")


def verified_obligations(spark, sf_dir):
    receipts = _table(spark, sf_dir, "lineitem", "l_orderkey AS task_id", "l_linenumber AS trial_id", "CAST(l_quantity AS BIGINT) % 4 AS obligation_id").where("trial_id <= 3")
    obligations = _table(spark, sf_dir, "orders", "o_orderkey AS task_id", "explode(array(0L, 1L)) AS obligation_id")
    expected = _table(spark, sf_dir, "orders", "o_orderkey AS task_id", "o_orderkey % 3 + 1 AS expected_trials").where("task_id % 10 > 0")
    return gates.verified_obligations(receipts, obligations, expected)


def acceptance(spark, sf_dir):
    rollouts = _table(spark, sf_dir, "orders", "o_orderkey AS task_id", "CASE WHEN o_orderkey % 4 = 0 THEN array('TRIAL_COUNT_MISMATCH', 'ROLLOUT_NOT_PASSED') ELSE CAST(array() AS ARRAY<STRING>) END AS gate_reasons", "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' END AS execution_status", "o_orderkey % 5 > 0 AS rollout_passed", "CASE o_orderkey % 6 WHEN 0 THEN false WHEN 1 THEN true END AS verifier_enabled")
    pending = _table(spark, sf_dir, "lineitem", "l_orderkey AS task_id", "CASE l_returnflag WHEN 'A' THEN 'FILE' ELSE 'NON_FILE' END AS kind", "l_quantity").where("l_quantity < 4")
    return gates.acceptance(rollouts, pending).withColumn("errors", _joined("errors"))


def trial_bindings(spark, sf_dir):
    slots = _table(spark, sf_dir, "orders", "o_custkey AS plan_id", "concat('/', o_orderkey % 30) AS task_path", "concat('h', CASE WHEN o_custkey % 20 = 0 THEN o_orderkey % 2 ELSE 0 END) AS contract_sha256")
    trials = _table(spark, sf_dir, "orders", "o_custkey AS plan_id", "o_orderkey AS trial_id", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('/', o_orderkey % 31) END AS task_path")
    return gates.trial_binding_errors(trials, slots)


def semantic_receipts(spark, sf_dir):
    checks = _table(spark, sf_dir, "orders", "o_orderkey AS trial_id", "explode(array(1L, 2L)) AS obligation_id")
    receipts = _table(spark, sf_dir, "orders", "o_orderkey AS trial_id", "explode(CASE o_orderkey % 9 WHEN 0 THEN array(1L) WHEN 1 THEN array(1L, 1L, 2L) WHEN 2 THEN array(1L, 2L, 3L) ELSE array(1L, 2L) END) AS obligation_id").selectExpr("*", "trial_id % 11 > 0 AS covered", "CASE WHEN trial_id % 13 = 0 THEN ' ' ELSE 'r' END AS reason")
    proof = receipts.distinct().where("(trial_id + obligation_id) % 7 > 0").selectExpr("trial_id", "obligation_id", "1 AS pos", "CASE WHEN trial_id % 5 = 0 THEN 'initial' ELSE 'final' END AS side", "concat('f', trial_id % 4) AS path", "CASE WHEN trial_id % 10 = 3 THEN 'nowhere' ELSE 'abc' END AS quote", "trial_id % 4 = 2 AS absent")
    files = _table(spark, sf_dir, "orders", "o_orderkey AS trial_id", "explode(array(named_struct('side', 'initial', 'path', 'f0'), named_struct('side', 'final', 'path', 'f0'), named_struct('side', 'final', 'path', 'f1'), named_struct('side', 'initial', 'path', 'f2'))) AS f").selectExpr("trial_id", "f.side", "f.path", "concat('xx abc ', f.path) AS content")
    return gates.semantic_receipt_errors(receipts, proof, checks, files)


def selected_candidates(spark, sf_dir):
    candidates = _table(spark, sf_dir, "events", "user_id AS task_id", "event_id AS index", "CASE event_type WHEN 'view' THEN 'READY' WHEN 'click' THEN 'ENVIRONMENT_NOT_READY' ELSE 'REVIEW' END AS decision", "CASE WHEN event_id % 3 = 0 THEN 'INFRA_ERROR' END AS environment_status", "CASE WHEN event_id % 5 > 0 THEN event_id % 4 / 4.0D END AS confidence", "CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 6 AS INT) END AS uncertainties")
    judges = _table(spark, sf_dir, "events", "user_id AS task_id", "event_id AS index", "CASE WHEN value < 10 THEN 'SUFFICIENT' ELSE 'INSUFFICIENT' END AS label", "CASE WHEN event_id % 10 > 0 THEN 'READY' END AS judge_decision").where("index % 8 > 0")
    return gates.selected_candidates(candidates, judges)


def environment_bindings(spark, sf_dir):
    obligations = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderpriority AS obligation_id")
    b = _table(
        spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderkey AS pos", "CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE o_orderpriority END AS obligation_id", "CASE o_orderstatus WHEN 'F' THEN 'FILE' WHEN 'O' THEN 'NON_FILE' ELSE 'ODD' END AS verifier_kind",
        "CASE o_orderkey % 4 WHEN 0 THEN array('a', 'b') WHEN 1 THEN array('a') WHEN 2 THEN CAST(array() AS ARRAY<STRING>) END AS required", "CASE WHEN o_orderkey % 3 = 0 THEN array('a') END AS initial",
        "CASE o_orderkey % 5 WHEN 0 THEN array('b') WHEN 1 THEN array('a') END AS outputs", "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'seen' END AS observable",
    ).where("pos % 3 <> 1")
    return gates.binding_errors(b, obligations)


def execution_blockers(spark, sf_dir):
    e = _table(spark, sf_dir, "customer", "c_custkey AS task_id", "CASE c_custkey % 4 WHEN 0 THEN 'READY' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'READY' END AS status", "CASE WHEN c_custkey % 3 = 0 THEN 'PROBED' END AS execution_readiness", "CASE WHEN c_custkey % 5 = 0 THEN array('LOAD_FAILED', '', 'LOAD_FAILED') END AS execution_errors", "CAST(c_custkey % 2 AS INT) AS probes")
    return gates.execution_blockers(e).withColumn("blockers", _joined("blockers"))


QUERIES = {
    f.__name__: f
    for f in (
        trial_statuses, explicit_states, certified_trials, padded_trials, job_gates, reproducibility, first_values, overall_statuses, label_partition_errors, failed_examples, unknown_initial_states, task_outlook, support_routes,
        integrity_errors, delivery_scopes, task_outcomes, requirement_coverage, excluded_captures, verified_obligations, acceptance, trial_bindings, semantic_receipts, selected_candidates, environment_bindings, execution_blockers,
    )
}

_JOBS = "j AS (SELECT c_custkey AS job_id, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 13 END AS expected, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN c_custkey % 2 = 0 END AS cleanup_ok, c_custkey % 4 > 0 AS gate_known FROM customer)"
_SQL_PATHS = "concat(o_orderpriority, '/', o_orderstatus, '/', o_orderkey % 5)"
_SCOPES = """t AS (SELECT o_custkey AS session_id, o_orderkey AS task_id, o_orderkey % 3 = 0 AS blocked, CASE o_orderkey % 6 WHEN 0 THEN 'OUT_OF_SCOPE' WHEN 3 THEN 'NEEDS_REVIEW' WHEN 5 THEN NULL ELSE 'IN_SCOPE' END AS scope_status, o_custkey % 3 AS exit_code FROM orders),
s AS (SELECT *, CASE WHEN task_id % 31 > 0 AND task_id % 5 IN (0, 2, 4) THEN scope_status END AS scope FROM t)"""

ORACLE_SQL = {
    "trial_statuses": """SELECT o_orderkey AS trial_id, CASE WHEN o_orderkey % 6 = 0 THEN 'TIMEOUT' WHEN o_orderkey % 6 < 3 THEN 'INFRA_ERROR' WHEN o_orderstatus = 'F' AND o_orderkey % 5 IN (0, 2) THEN 'PASS' WHEN o_orderstatus = 'O' AND o_orderkey % 5 IN (1, 3) THEN 'FAIL' ELSE 'INCONCLUSIVE' END AS status FROM orders""",
    "explicit_states": """SELECT o_orderkey AS trial_id, CASE o_orderkey % 9 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'INFRA_TIMEOUT' WHEN 2 THEN 'TASK_BUDGET_EXHAUSTED' WHEN 3 THEN 'INFRA_AGENT' WHEN 4 THEN 'INFRA_VERIFIER' WHEN 5 THEN 'INFRA_ENVIRONMENT' ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'CLEANUP_UNVERIFIABLE' END END AS state FROM orders""",
    "certified_trials": """
WITH s AS (SELECT *, o_orderkey % 8 AS e, CASE WHEN o_custkey % 7 = 0 THEN 'CANCELLED' WHEN o_custkey % 11 < 2 OR o_orderkey % 8 = 4 THEN 'INFRA_ENVIRONMENT' WHEN o_orderkey % 8 = 0 THEN 'INFRA_CAPTURE' WHEN o_orderkey % 8 = 1 THEN 'INFRA_AGENT'
 WHEN o_orderkey % 8 = 2 OR o_orderstatus NOT IN ('F', 'O') THEN 'INFRA_VERIFIER' WHEN o_orderkey % 8 = 3 THEN 'INFRA_CAPTURE' WHEN o_orderstatus = 'F' THEN 'TASK_PASS' ELSE 'TASK_FAIL' END AS status FROM orders)
SELECT o_orderkey AS trial_id, status, status LIKE 'TASK_%' AND e > 4 AND o_custkey % 5 > 0 AS certified, CASE status WHEN 'TASK_PASS' THEN true WHEN 'TASK_FAIL' THEN false END AS task_passed FROM s""",
    "padded_trials": f"""
WITH {_JOBS} SELECT o_custkey AS job_id, concat('t', o_orderkey) AS trial_name, CASE WHEN o_orderkey % 10 > 0 THEN 'PASS' ELSE 'TIMEOUT' END AS status, NULL AS error_code FROM orders
UNION ALL SELECT job_id, printf('missing-trial-%03d', k), 'INFRA_ERROR', 'TRIAL_RESULT_MISSING' FROM j, range(1, 14) r(k) WHERE k <= expected - (SELECT count(*) FROM orders WHERE o_custkey = job_id)""",
    "job_gates": f"""
WITH {_JOBS}, s AS (SELECT o_custkey AS job_id, count(*) AS trials, count(*) FILTER (o_orderkey % 10 > 0) AS completed, count(*) FILTER (o_orderkey % 37 > 0) AS traj, count(*) FILTER (o_orderkey % 41 = 0) AS invalid, CAST(coalesce(sum(CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END), 0) AS BIGINT) AS tokens,
 avg(CASE WHEN o_orderkey % 4 > 0 THEN o_custkey % 100 END) AS mean_seconds FROM orders GROUP BY ALL),
r AS (SELECT *, concat_ws(',', CASE WHEN trials <> expected THEN 'TRIAL_COUNT_MISMATCH' END, CASE WHEN completed <> trials THEN 'TRIAL_INCOMPLETE_OR_INFRA_ERROR' END, CASE WHEN cleanup_ok IS NOT TRUE THEN 'SANDBOX_CLEANUP_UNCONFIRMED' END, CASE WHEN traj <> trials THEN 'TRAJECTORY_MISSING' END, CASE WHEN invalid > 0 THEN 'TRAJECTORY_OR_ARTIFACT_CONTENT_INVALID' END) AS reasons FROM s JOIN j USING (job_id))
SELECT job_id, trials, completed, completed / trials AS pass_rate, traj / trials AS trajectory_rate, tokens, mean_seconds, reasons = '' AS ok, reasons FROM r""",
    "reproducibility": f"""
WITH {_JOBS}, s AS (SELECT o_custkey AS job_id, count(*) AS n, count(*) FILTER (o_custkey % 2 = 1 AND o_orderkey % 31 = 0) AS unknown, count(*) FILTER (o_orderkey % 37 = 0 OR o_orderkey % 41 = 0) AS bad FROM orders WHERE o_custkey % 3 > 0 GROUP BY ALL)
SELECT job_id, CASE WHEN expected IS NULL OR coalesce(unknown, 0) > 0 THEN NULL WHEN coalesce(n, 0) <> expected THEN false WHEN NOT gate_known OR cleanup_ok IS NULL THEN NULL ELSE cleanup_ok AND coalesce(bad, 0) = 0 END AS reproducible FROM j LEFT JOIN s USING (job_id)""",
    "first_values": "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 4 = 0 THEN 'null' WHEN o_orderkey % 4 = 1 THEN 'true' END AS value FROM orders",
    "overall_statuses": """
WITH t AS (SELECT o_custkey AS task_group, o_custkey % 5 = 0 OR o_orderkey % 3 = 0 AS good, o_orderstatus = 'O' AND o_custkey % 5 > 1 AS open FROM orders), k AS (SELECT * FROM t WHERE task_group % 7 <> 1 OR NOT good)
SELECT task_group, CASE WHEN bool_and(good) THEN 'ELIGIBLE' WHEN bool_or(open AND NOT good) AND NOT bool_or(good) THEN 'PENDING' ELSE 'REVIEW' END AS status FROM k GROUP BY ALL""",
    "label_partition_errors": """
WITH e AS (SELECT DISTINCT event_id % 3 AS run, event_type AS capability, event_id % 500 AS id FROM events), o AS (SELECT DISTINCT id FROM e WHERE id % 100 <> 99),
c AS (SELECT * FROM e WHERE NOT (run = 0 AND capability = 'view') AND (id % 100 <> 99 OR capability <> 'click')), g AS (SELECT DISTINCT run, capability FROM c),
s AS (SELECT run, capability, (SELECT count(*) FROM c WHERE c.run = g.run AND c.capability = g.capability AND run = 1 AND capability = 'error' AND id < 9) AS twice, (SELECT count(*) FROM c WHERE c.run = g.run AND c.capability = g.capability AND id % 100 = 99) AS untrusted,
 (SELECT count(*) FROM o WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.run = g.run AND c.capability = g.capability AND c.id = o.id)) AS missing FROM g)
SELECT run, capability, CASE WHEN twice > 0 THEN 'LABEL_LIST_OVERLAP' WHEN untrusted > 0 THEN 'UNTRUSTED_OUTCOME_LABEL' ELSE 'LABEL_PARTITION_INCOMPLETE' END AS code, CASE WHEN twice > 0 THEN twice WHEN untrusted > 0 THEN untrusted ELSE missing END AS ids FROM s WHERE twice + untrusted + missing > 0""",
    "failed_examples": """
WITH d AS (SELECT DISTINCT event_type AS capability, event_id % 300 AS id FROM events WHERE event_id % 4 = 0) SELECT capability, array_to_string(list_sort(list(id))[1:8], ',') AS examples FROM d GROUP BY capability""",
    "unknown_initial_states": f"""
WITH p AS (SELECT o_custkey AS task_id, CASE WHEN o_orderkey % 6 > 0 THEN {_SQL_PATHS} END AS path, o_orderkey AS source_event_id FROM orders WHERE o_orderkey % 3 < 2), r AS (SELECT DISTINCT o_custkey AS task_id, CASE WHEN o_orderkey % 4 = 0 THEN concat(o_orderpriority, '/') ELSE {_SQL_PATHS} END AS path FROM orders WHERE o_custkey % 3 > 0),
t AS (SELECT DISTINCT o_custkey AS task_id, {_SQL_PATHS} AS path FROM orders WHERE o_orderkey % 7 = 0)
SELECT task_id, CASE WHEN path IS NULL THEN 'UNKNOWN_INITIAL_STATE_UNSCOPED' ELSE 'UNKNOWN_INITIAL_STATE' END AS code, path, source_event_id FROM p
WHERE EXISTS (SELECT 1 FROM r WHERE r.task_id = p.task_id AND (p.path IS NULL OR p.path = r.path OR r.path LIKE '%/' AND starts_with(p.path, r.path))) AND NOT EXISTS (SELECT 1 FROM t WHERE t.task_id = p.task_id AND t.path = p.path)""",
    "task_outlook": """
WITH b AS (SELECT o_custkey AS task_id, count(*) AS n, count(*) FILTER (o_orderkey % 5 > 0 AND o_custkey % 4 = 0) AS sure, count(*) FILTER (o_orderkey % 5 = 0) AS loose FROM orders WHERE o_custkey % 3 = 0 GROUP BY ALL)
SELECT c_custkey AS task_id, CASE WHEN c_custkey % 9 = 0 THEN 'INFRA_ERROR' WHEN sure > 0 THEN 'SKIPPED' WHEN c_custkey % 9 = 1 THEN 'PIPELINE_ERROR' WHEN c_custkey % 10 = 0 OR loose > 0 OR c_custkey % 9 = 2 OR c_custkey % 11 = 0 THEN 'REVIEW' ELSE 'READY' END AS status, coalesce(n, 0) AS blockers
FROM customer LEFT JOIN b ON task_id = c_custkey""",
    "support_routes": """
WITH f AS (SELECT o_custkey AS task_id, count(*) AS n, count(*) FILTER (o_orderkey % 4 IN (0, 3)) AS s FROM orders WHERE o_custkey % 4 > 0 GROUP BY ALL), t AS (SELECT c_custkey AS task_id, c_custkey % 5 = 0 AS r, coalesce(n, 0) AS files, coalesce(s, 0) AS source_files FROM customer LEFT JOIN f ON task_id = c_custkey)
SELECT task_id, CASE WHEN r THEN 'RETRIEVAL_UNSUPPORTED' WHEN files > 0 THEN 'TERMINAL_FILE' ELSE 'DEFAULT_EMPTY' END AS route, CASE WHEN r THEN 'NONE' WHEN files > 0 THEN 'REPLAYED' ELSE 'DEFAULT_EMPTY' END AS env_origin, NOT r AS allow_completion, files, source_files, files >= 5 OR source_files >= 2 AS terminal_batch_hint FROM t""",
    "integrity_errors": """
WITH i AS (SELECT DISTINCT o_custkey % 50 AS report_id, o_orderkey % 97 AS issue_id FROM orders), g AS (SELECT user_id % 50 AS report_id, event_id AS pos, event_id % 101 AS issue_id, event_id % 7 AS n, event_type AS flag FROM events),
k AS (SELECT g.*, row_number() OVER (PARTITION BY report_id, issue_id ORDER BY pos) AS turn FROM g JOIN i USING (report_id, issue_id)),
c AS (SELECT report_id, issue_id, CASE WHEN turn > 1 THEN 'INTEGRITY_CLASSIFICATION_DUPLICATE' WHEN n IN (5, 6) OR flag = 'error' THEN 'INTEGRITY_CLASSIFICATION_INVALID' WHEN flag = 'click' THEN 'WORKSPACE_GAP' END AS code FROM k)
SELECT * FROM c WHERE code IS NOT NULL UNION ALL SELECT report_id, issue_id, 'INTEGRITY_ISSUE_UNKNOWN' FROM g WHERE (report_id, issue_id) NOT IN (SELECT (report_id, issue_id) FROM i)
UNION ALL SELECT report_id, issue_id, 'INTEGRITY_ISSUE_UNCLASSIFIED' FROM i WHERE (report_id, issue_id) NOT IN (SELECT (report_id, issue_id) FROM c WHERE code IS NULL OR code = 'WORKSPACE_GAP')""",
    "delivery_scopes": f"WITH {_SCOPES} SELECT task_id, scope FROM s",
    "task_outcomes": f"""
WITH {_SCOPES}, o AS (SELECT session_id, CASE WHEN scope IN ('OUT_OF_SCOPE', 'NEEDS_REVIEW') AND exit_code = 2 THEN scope WHEN exit_code IN (0, 2) AND NOT blocked AND (scope_status IS NULL OR scope = 'IN_SCOPE') THEN 'COMPLETED' ELSE 'ISSUE' END AS outcome FROM s)
SELECT session_id, count(*) FILTER (outcome = 'COMPLETED') AS completed, count(*) FILTER (outcome = 'OUT_OF_SCOPE') AS out_of_scope, count(*) FILTER (outcome = 'NEEDS_REVIEW') AS needs_review, count(*) FILTER (outcome = 'ISSUE') AS issues FROM o GROUP BY ALL""",
    "requirement_coverage": """
WITH k AS (SELECT DISTINCT o_custkey AS task_id, o_orderpriority AS obligation_id FROM orders), g AS (SELECT o_custkey AS task_id, o_orderkey AS pos, CASE WHEN o_orderkey % 13 = 0 THEN 'none' ELSE o_orderpriority END AS obligation_id, o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 AS empty, o_orderstatus AS ref FROM orders WHERE o_orderkey % 3 > 0),
m AS (SELECT *, obligation_id = 'none' OR row_number() OVER (PARTITION BY task_id, obligation_id ORDER BY pos) > 1 AS bad FROM g), d AS (SELECT DISTINCT o_custkey AS task_id, o_orderstatus AS ref FROM orders WHERE o_orderkey % 5 < 4), r AS (SELECT DISTINCT o_custkey AS task_id, o_orderstatus AS ref FROM orders WHERE o_orderkey % 5 < 2)
SELECT task_id, obligation_id, CASE WHEN bad THEN 'OBLIGATION_UNKNOWN_OR_REPEATED' WHEN empty THEN 'REASON_OR_REFS_MISSING' WHEN (task_id, ref) NOT IN (SELECT (task_id, ref) FROM d) THEN 'REF_NOT_DELIVERED' ELSE 'REF_NOT_READ' END AS code FROM m WHERE bad OR empty OR (task_id, ref) NOT IN (SELECT (task_id, ref) FROM r)
UNION ALL SELECT task_id, obligation_id, 'OBLIGATION_NOT_COVERED' FROM k WHERE (task_id, obligation_id) NOT IN (SELECT (task_id, obligation_id) FROM m WHERE NOT bad)""",
    "excluded_captures": """
WITH x AS (SELECT user_id, event_id AS pos, event_id - event_id % 4 + CASE WHEN event_id % 50 = 1 THEN 100000 ELSE 0 END AS spot, event_id % 3 AS kind, event_id % 7 = 0 AS no_reason, CASE WHEN event_id % 5 = 0 THEN 'absent' ELSE substr(event_type, 2, 2) END AS quote FROM events WHERE event_id % 2 = 0 OR event_id % 50 = 1),
m AS (SELECT x.*, r.event_id IS NULL AS unknown, r.event_id % 9 = 0 AS pending, contains(r.props, quote) OR contains(r.event_type, quote) AS found, row_number() OVER (PARTITION BY x.user_id, spot ORDER BY pos) > 1 AS again FROM x LEFT JOIN events r ON r.user_id = x.user_id AND r.event_id = spot)
SELECT pos, CASE WHEN unknown OR again OR no_reason THEN 'EXCLUSION_INVALID' WHEN NOT pending AND (kind = 2 OR NOT found) THEN 'EXCLUSION_WITHOUT_QUOTE' END AS code FROM m""",
    "verified_obligations": """
WITH n AS (SELECT l_orderkey AS task_id, CAST(l_quantity AS BIGINT) % 4 AS obligation_id, count(DISTINCT l_linenumber) AS n FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL), b AS (SELECT o_orderkey AS task_id, k AS obligation_id FROM orders, range(0, 2) r(k))
SELECT b.task_id, b.obligation_id, coalesce(b.task_id % 10 > 0 AND n = b.task_id % 3 + 1, false) AS verified FROM b LEFT JOIN n ON n.task_id = b.task_id AND n.obligation_id = b.obligation_id""",
    "acceptance": """
WITH p AS (SELECT l_orderkey AS task_id, bool_or(l_returnflag = 'A') AS f, bool_or(l_returnflag <> 'A') AS nf FROM lineitem WHERE l_quantity < 4 GROUP BY ALL), s AS (SELECT o_orderkey AS task_id, o_orderkey % 6 <> 0 AS on_, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'UNKNOWN' END AS x, coalesce(f, false) AS f, coalesce(nf, false) AS nf FROM orders LEFT JOIN p ON p.task_id = o_orderkey),
e AS (SELECT *, concat_ws(',', CASE WHEN task_id % 4 = 0 THEN 'TRIAL_COUNT_MISMATCH,ROLLOUT_NOT_PASSED' END, CASE WHEN x <> 'COMPLETED' THEN 'EXECUTION_NOT_COMPLETED:' || x END, CASE WHEN on_ AND task_id % 5 = 0 AND task_id % 4 > 0 THEN 'ROLLOUT_NOT_PASSED' END, CASE WHEN on_ AND nf THEN 'NON_FILE_RESPONSE_UNVERIFIED' END, CASE WHEN on_ AND f THEN 'FILE_SEMANTIC_UNVERIFIED' END) AS errors FROM s)
SELECT task_id, CASE WHEN NOT on_ THEN 'NOT_ASSESSED' WHEN errors = '' THEN 'PASS' ELSE 'REVIEW' END AS status, errors FROM e""",
    "trial_bindings": """
WITH s AS (SELECT DISTINCT o_custkey AS plan_id, concat('/', o_orderkey % 30) AS task_path FROM orders), t AS (SELECT o_custkey AS plan_id, o_orderkey AS trial_id, CASE WHEN o_orderkey % 17 > 0 THEN concat('/', o_orderkey % 31) END AS task_path FROM orders),
m AS (SELECT t.*, s.plan_id IS NULL AS unknown, row_number() OVER (PARTITION BY t.plan_id, t.task_path ORDER BY trial_id) > 1 AS again FROM t LEFT JOIN s USING (plan_id, task_path))
SELECT plan_id, trial_id, CASE WHEN task_path IS NULL THEN 'TASK_PATH_MISSING' WHEN unknown THEN 'TASK_PATH_UNKNOWN' ELSE 'TASK_PATH_REPEATED' END AS code FROM m WHERE task_path IS NULL OR unknown OR again
UNION ALL SELECT o_custkey, NULL, 'CONTRACTS_DIFFER' FROM orders WHERE o_custkey % 20 = 0 GROUP BY o_custkey HAVING count(DISTINCT o_orderkey % 2) > 1""",
    "semantic_receipts": """
WITH b AS (SELECT o_orderkey AS trial_id, k AS obligation_id, CASE o_orderkey % 9 WHEN 0 THEN k = 1 WHEN 2 THEN true ELSE k < 3 END AS given FROM orders, range(1, 4) r(k)), c AS (SELECT *, (trial_id + obligation_id) % 7 > 0 AS proof, trial_id % 5 > 0 AS fin, trial_id % 4 AS f FROM b WHERE obligation_id < 3 OR given),
d AS (SELECT *, CASE WHEN f = 2 THEN fin ELSE trial_id % 10 <> 3 AND (f = 0 OR f = 1 AND fin) END AS valid FROM c),
s AS (SELECT trial_id, obligation_id, CASE WHEN obligation_id = 3 OR NOT given OR trial_id % 9 = 1 AND obligation_id = 1 THEN 'OBLIGATIONS_MISMATCH' WHEN trial_id % 11 = 0 THEN 'NOT_ACCEPTED' WHEN trial_id % 13 = 0 OR NOT proof THEN 'EVIDENCE_MISSING' WHEN NOT valid THEN 'EVIDENCE_INVALID' WHEN NOT fin THEN 'FINAL_EVIDENCE_MISSING' END AS code FROM d)
SELECT * FROM s WHERE code IS NOT NULL""",
    "selected_candidates": """
WITH c AS (SELECT user_id AS task_id, event_id AS index, event_id % 8 > 0 AND value < 10 AND event_id % 10 > 0 AND (event_type = 'view' OR event_type = 'click' AND event_id % 3 > 0) AS good, CASE WHEN event_id % 5 > 0 THEN event_id % 4 / 4 ELSE 0 END AS confidence, CASE WHEN event_id % 7 > 0 THEN event_id % 6 ELSE 0 END AS unsure FROM events),
b AS (SELECT task_id, index FROM c WHERE good QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY confidence DESC, unsure, index) = 1)
SELECT c.task_id, any_value(b.index) AS selected, count(*) FILTER (good) AS eligible, count(*) FILTER (NOT good) AS rejected FROM c LEFT JOIN b USING (task_id) GROUP BY c.task_id""",
    "environment_bindings": """
WITH b AS (SELECT o_custkey AS task_id, o_orderkey AS pos, CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE o_orderpriority END AS obligation_id, o_orderstatus AS st, CASE o_orderkey % 4 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN ['a'] WHEN 2 THEN [] END AS req, CASE WHEN o_orderkey % 3 = 0 THEN ['a'] END AS ini, CASE o_orderkey % 5 WHEN 0 THEN ['b'] WHEN 1 THEN ['a'] ELSE [] END AS outs FROM orders WHERE o_orderkey % 3 <> 1),
p AS (SELECT *, coalesce(ini, list_filter(coalesce(req, []), lambda x: NOT list_contains(outs, x))) AS i2 FROM b), q AS (SELECT *, list_sort(list_distinct(list_concat(i2, outs))) AS bb FROM p), v AS (SELECT *, obligation_id <> 'none' AND st IN ('F', 'O') AS valid, list_sort(list_distinct(coalesce(req, bb))) AS r2 FROM q),
w AS (SELECT *, valid AND row_number() OVER (PARTITION BY task_id, obligation_id, valid ORDER BY pos) > 1 AS again FROM v)
SELECT task_id, obligation_id, CASE WHEN obligation_id = 'none' THEN 'BINDING_OBLIGATION_UNKNOWN' ELSE 'BINDING_VERIFIER_KIND_INVALID' END AS code FROM w WHERE NOT valid
UNION ALL SELECT task_id, obligation_id, 'BINDING_PATH_UNION_MISMATCH' FROM w WHERE valid AND r2 <> bb UNION ALL SELECT task_id, obligation_id, 'BINDING_PATH_ROLE_CONFLICT' FROM w WHERE valid AND list_has_any(i2, outs)
UNION ALL SELECT task_id, obligation_id, 'BINDING_TASK_OUTCOME_REQUIRED' FROM w WHERE valid AND st = 'F' AND pos % 7 = 0 UNION ALL SELECT task_id, obligation_id, 'BINDING_FILE_PATHS_REQUIRED' FROM w WHERE valid AND st = 'F' AND len(r2) = 0
UNION ALL SELECT task_id, obligation_id, 'BINDING_OBLIGATION_DUPLICATE' FROM w WHERE again
UNION ALL SELECT DISTINCT o_custkey, o_orderpriority, 'BINDING_REQUIRED' FROM orders WHERE (o_custkey, o_orderpriority) NOT IN (SELECT (task_id, obligation_id) FROM w WHERE valid)""",
    "execution_blockers": """
SELECT c_custkey AS task_id, CASE WHEN c_custkey % 4 = 3 THEN 'ENVIRONMENT_CONTRACT_MISSING' ELSE concat_ws(',', CASE WHEN c_custkey % 4 = 1 THEN 'ENVIRONMENT_CONTEXT_REVIEW' END, CASE WHEN c_custkey % 3 > 0 THEN 'ENVIRONMENT_EXECUTION_UNREADY' END, CASE WHEN c_custkey % 5 = 0 THEN 'LOAD_FAILED' END, CASE WHEN c_custkey % 2 = 0 THEN 'ENVIRONMENT_PROBES_REQUIRED' END) END AS blockers FROM customer""",
}
