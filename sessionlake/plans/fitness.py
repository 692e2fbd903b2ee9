"""Queries of environments and their fit over the driver's tables and their SQL: a customer is a task, its orders are files and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import fitness


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


def environment_contracts(spark, sf_dir):
    """By number a task's workspace is gone or changed, its reset ran once, its probe failed, a check lacks its reason or is missing."""
    k = "c_custkey"
    environments = _table(spark, sf_dir, "customer", f"{k} AS task_id", f"CASE {k} % 7 WHEN 0 THEN 'SKIPPED' WHEN 1 THEN 'REVIEW' ELSE 'READY' END AS status", f"CASE WHEN {k} % 11 = 0 THEN array('E') END AS errors", f"CASE WHEN {k} % 13 > 0 THEN 'w' END AS workspace_sha256", f"CASE WHEN {k} % 17 = 0 THEN 'v' WHEN {k} % 17 < 9 THEN 'w' END AS expected_sha256")
    checks = _table(spark, sf_dir, "customer", f"{k} AS task_id", "explode(array('load', 'reset', 'dependency')) AS kind").selectExpr("task_id", "0 AS pos", "CASE WHEN task_id % 19 = 0 AND kind = 'load' THEN 'reset' ELSE kind END AS kind", "array(kind) AS probe_ids", "CASE WHEN task_id % 23 = 0 AND kind = 'dependency' THEN ' ' ELSE 'why' END AS reason")
    # the repeated reset of a task comes last
    checks = checks.withColumn("pos", F.when((F.col("kind") == "reset") & (F.col("probe_ids")[0] == "load"), 1).otherwise(0))
    run = "named_struct('exit_code', 0, 'timed_out', false, 'after_sha256', 'w')"
    probes = _table(spark, sf_dir, "customer", f"{k} AS task_id", "explode(array('load', 'reset', 'dependency')) AS probe_id").selectExpr("task_id", "probe_id", "probe_id AS purpose", "CASE WHEN task_id % 29 = 0 AND probe_id = 'load' THEN 'FAIL' ELSE 'PASS' END AS status", "true AS unchanged", "true AS reproducible", "'w' AS before_sha256", "'w' AS after_sha256", f"CASE WHEN probe_id = 'reset' AND task_id % 31 > 0 THEN array({run}, {run}) ELSE array({run}) END AS executions")
    out = fitness.environment_contracts(environments, checks, probes)
    return out.select("task_id", "status", F.array_join("context_errors", ",").alias("context_errors"), "execution_readiness", F.array_join("execution_errors", ",").alias("execution_errors"), "probes")


def static_fits(spark, sf_dir):
    """An item binds a file and a folder of its order."""
    bindings = _table(spark, sf_dir, "lineitem", "l_orderkey AS task_id", "l_linenumber AS obligation_id", "array(concat('f', l_partkey % 3), concat('d', l_suppkey % 2, '/')) AS paths")
    files = _table(spark, sf_dir, "orders", "o_orderkey AS task_id", "explode(array(concat('f', o_custkey % 3), 'f2', concat('d', o_custkey % 3, '/x'))) AS path")
    return fitness.static_fit(bindings, files).withColumn("missing", F.array_join("missing", ","))


QUERIES = {f.__name__: f for f in (environment_contracts, static_fits)}

ORACLE_SQL = {
    "environment_contracts": """
WITH t AS (
  SELECT c_custkey AS k, CASE c_custkey % 7 WHEN 0 THEN 'SKIPPED' WHEN 1 THEN 'REVIEW' ELSE 'READY' END AS s, c_custkey % 13 = 0 AS gone, c_custkey % 17 = 0 OR c_custkey % 13 = 0 AND c_custkey % 17 < 9 AS changed FROM customer
), e AS (
  SELECT k, s, gone, changed, list_sort(list_filter([CASE WHEN k % 11 = 0 THEN 'E' END, CASE WHEN gone THEN 'WORKSPACE_NOT_FOUND' END, CASE WHEN changed THEN 'ENVIRONMENT_CHANGED_AFTER_SUFFICIENCY' END], lambda x: x IS NOT NULL)) AS context,
    CASE WHEN s = 'SKIPPED' THEN [] ELSE list_sort(list_filter([CASE WHEN k % 19 = 0 THEN 'ENVIRONMENT_CHECK_KIND_INVALID' END, CASE WHEN k % 19 = 0 THEN 'ENVIRONMENT_PROBES_REQUIRED' END, CASE WHEN k % 23 = 0 THEN 'ENVIRONMENT_CHECK_EVIDENCE_REQUIRED:dependency' END,
      CASE WHEN k % 29 = 0 AND k % 19 > 0 THEN 'ENVIRONMENT_PROBE_NOT_PASS:load' END, CASE WHEN gone AND k % 19 > 0 AND k % 29 > 0 THEN 'ENVIRONMENT_PROBE_RECEIPT_INVALID:load' END, CASE WHEN gone OR k % 31 = 0 THEN 'ENVIRONMENT_PROBE_RECEIPT_INVALID:reset' END,
      CASE WHEN gone AND k % 23 > 0 THEN 'ENVIRONMENT_PROBE_RECEIPT_INVALID:dependency' END], lambda x: x IS NOT NULL)) END AS execution FROM t
), d AS (
  SELECT *, CASE WHEN gone OR changed THEN 'PIPELINE_ERROR' WHEN s = 'READY' AND len(context) > 0 THEN 'REVIEW' ELSE s END AS status FROM e
)
SELECT k AS task_id, status, array_to_string(context, ',') AS context_errors, CASE WHEN status IN ('SKIPPED', 'PIPELINE_ERROR') THEN 'NOT_APPLICABLE' WHEN len(execution) > 0 THEN 'FAILED' ELSE 'PROBED' END AS execution_readiness, array_to_string(execution, ',') AS execution_errors, 3 AS probes FROM d""",
    "static_fits": """
WITH b AS (
  SELECT l_orderkey AS task_id, l_linenumber AS obligation_id, unnest([concat('f', l_partkey % 3), concat('d', l_suppkey % 2, '/')]) AS path FROM lineitem
), f AS (
  SELECT o_orderkey AS task_id, unnest([concat('f', o_custkey % 3), 'f2', concat('d', o_custkey % 3, '/x')]) AS path FROM orders
), m AS (
  SELECT DISTINCT * FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.task_id = b.task_id AND (f.path = b.path OR b.path LIKE '%/' AND starts_with(f.path, b.path)))
), g AS (
  SELECT task_id, obligation_id, string_agg(path, ',' ORDER BY path) AS missing FROM m GROUP BY ALL
)
SELECT DISTINCT b.task_id, b.obligation_id, CASE WHEN g.missing IS NULL THEN 'SATISFIED' ELSE 'UNSATISFIED' END AS status, coalesce(g.missing, '') AS missing FROM b LEFT JOIN g ON g.task_id = b.task_id AND g.obligation_id = b.obligation_id""",
}
