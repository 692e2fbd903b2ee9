"""Queries of the replay over the driver's tables and their SQL; events stand in for file operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import replay


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


# sessions are an eighth of a day of a user, so that an early unknown step does not close them all
OPS = [
    "user_id * 100000 + event_id div 100 AS session_id", "event_id AS pos", "CASE WHEN event_id % 7 = 0 THEN 'write' WHEN event_id % 23 = 0 THEN 'unknown' WHEN event_id % 5 = 0 THEN 'absent' ELSE 'read' END AS kind",
    "CASE WHEN event_id % 3 > 0 OR event_id % 2 = 0 THEN event_type END AS path", "CASE WHEN event_id % 4 > 0 THEN props END AS content", "CASE WHEN event_id % 6 = 1 THEN true WHEN event_id % 6 = 2 THEN false END AS partial", "CASE WHEN event_id % 46 = 0 THEN false END AS may_mutate",
]


def _ops(spark, sf_dir, span=2000):
    return _table(spark, sf_dir, "events", f"user_id * 100000 + event_id div {span} AS session_id", *OPS[1:])


def replay_evidence(spark, sf_dir):
    return replay.replay_evidence(_ops(spark, sf_dir))


def withheld_changes(spark, sf_dir):
    return replay.withheld_changes(_ops(spark, sf_dir))


def prior_observations(spark, sf_dir):
    ops = _ops(spark, sf_dir).withColumn("returned_pos", F.when(F.col("pos") % 13 > 0, F.col("pos") + F.col("pos") % 40))
    starts = ops.select("session_id", (F.col("session_id") % 100000 * 2000 + 1500).alias("task_start")).distinct()
    return replay.prior_observations(ops, starts)


def stage_one_files(spark, sf_dir):
    kind = "CASE WHEN event_id % 97 = 0 THEN 'shell' WHEN event_id % 83 = 0 THEN 'write' WHEN event_id % 2 = 0 THEN 'read' ELSE 'result' END AS kind"
    e = _table(spark, sf_dir, "events", "user_id % 40 AS session_id", "event_id AS pos", kind, "event_type AS call_id", "CASE WHEN event_id % 10 > 0 THEN concat('f', event_id % 9) END AS path", "CASE WHEN event_id % 14 = 0 THEN true END AS partial", "CASE WHEN event_id % 11 > 0 THEN props END AS text")
    return replay.stage_one_files(e)


def exposure_argmax(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents", "doc_id % 97 AS trajectory_id", "text AS content")
    trajectories = _table(spark, sf_dir, "documents", "doc_id % 97 AS trajectory_id", "concat('r', doc_id % 97 % 5) AS repository", "CASE WHEN doc_id % 97 % 7 > 0 THEN concat('c', doc_id % 97 % 3) ELSE '' END AS base_commit").distinct()
    return replay.most_exposed(trajectories, docs, ["repository", "base_commit"])


def file_overlay(spark, sf_dir):
    old = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderpriority AS path", "o_orderkey").groupBy("task_id", "path").agg(F.min("o_orderkey").cast("string").alias("content"), F.when(F.count("*") > 1, "PARTIAL").otherwise("COMPLETE").alias("completeness"))
    new = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE concat('new', o_orderkey % 3) END AS path", "o_orderkey").where("o_orderkey % 4 < 2").groupBy("task_id", "path").agg(F.max("o_orderkey").alias("k"))
    return replay.overlay(old, new.selectExpr("task_id", "path", "concat('n', k) AS content", "CASE k % 3 WHEN 0 THEN 'SYNTHETIC_STUB' WHEN 1 THEN 'odd' END AS kind"))


def common_folders(spark, sf_dir):
    p = _table(spark, sf_dir, "orders", "o_custkey AS session_id", "CASE o_custkey % 5 WHEN 0 THEN concat('/w/', o_orderpriority, '/', o_orderkey % 3, '/f') WHEN 1 THEN concat('/w/p/', o_orderkey % 3, '/f') WHEN 2 THEN concat('C:\\\\w\\\\p\\\\q', o_orderkey % 2, '/', o_orderkey) WHEN 3 THEN concat('w/p/', o_orderkey) ELSE concat('/w/p/q/r', o_orderkey % 2, '/s/', o_orderkey) END AS path")
    return replay.common_folder(p)


def numbering_resets(spark, sf_dir):
    e = _table(spark, sf_dir, "events", "event_id AS pos", "CASE event_id % 5 WHEN 0 THEN array(1, 2, 3, 4, 5, 6) WHEN 1 THEN array(1, 2, 3, 2, 5, 6) WHEN 2 THEN array(1, 2, 1) WHEN 3 THEN array(1, 1, 2, 3, 4, 9, 7) END AS numbers")
    return e.select("pos", replay.numbering_resets(F.col("numbers")).alias("reset"))


def completion_holes(spark, sf_dir):
    c = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "CASE WHEN o_orderkey % 9 = 0 THEN 'd/' ELSE o_orderpriority END AS path", "CASE o_orderkey % 4 WHEN 0 THEN 'PARTIAL' WHEN 1 THEN 'MISSING_BODY' WHEN 2 THEN 'SUPPORT' ELSE 'STUB' END AS kind")
    return replay.completion_holes(c, _table(spark, sf_dir, "orders", "o_custkey AS task_id", "o_orderpriority AS path", "o_orderkey").where("o_orderkey % 10 = 0"))


def capture_repairs(spark, sf_dir):
    o = _table(spark, sf_dir, "part", "p_partkey AS capture_id", "CASE p_partkey % 7 WHEN 0 THEN 'a\r\nbb cc' WHEN 1 THEN 'x x' WHEN 2 THEN 'abcdef' WHEN 3 THEN 'aaa' WHEN 4 THEN 'gone' WHEN 5 THEN NULL ELSE 'same' END AS text")
    r = o.where("capture_id % 7 < 6").selectExpr("capture_id", "explode(CASE capture_id % 7 WHEN 0 THEN array(struct('bb', '1', 'r'), struct('a\n', '2', 'r')) WHEN 1 THEN array(struct('x', 'y', 'r')) WHEN 2 THEN array(struct('abc', '1', 'r'), struct('cd', '2', 'r')) WHEN 3 THEN array(struct('aa', 'b', 'r')) WHEN 4 THEN array(struct('gone', '', CASE WHEN capture_id % 2 = 0 THEN ' ' ELSE 'r' END)) ELSE array(struct('a', 'b', 'r')) END) AS s")
    return replay.repaired_captures(o, r.selectExpr("capture_id", "s.col1 AS old_text", "s.col2 AS new_text", "s.col3 AS reason"))


QUERIES = {f.__name__: f for f in (replay_evidence, withheld_changes, prior_observations, stage_one_files, exposure_argmax, file_overlay, common_folders, numbering_resets, completion_holes, capture_repairs)}

_OPS = """o AS (SELECT user_id * 100000 + event_id // 2000 AS session_id, event_id AS pos, CASE WHEN event_id % 7 = 0 THEN 'write' WHEN event_id % 23 = 0 THEN 'unknown' WHEN event_id % 5 = 0 THEN 'absent' ELSE 'read' END AS kind, CASE WHEN event_id % 3 > 0 OR event_id % 2 = 0 THEN event_type END AS path,
 CASE WHEN event_id % 4 > 0 THEN props END AS content, event_id % 6 = 1 AS partial, event_id % 46 > 0 AS may_mutate FROM events)"""
_MARKED = f"""{_OPS}, m AS (SELECT o.*, EXISTS (SELECT 1 FROM o w WHERE w.session_id = o.session_id AND w.path = o.path AND w.kind = 'write' AND w.pos < o.pos) AS mutated, EXISTS (SELECT 1 FROM o u WHERE u.session_id = o.session_id AND u.kind = 'unknown' AND u.may_mutate AND u.pos < o.pos) AS doubted FROM o),
t AS (SELECT m.*, EXISTS (SELECT 1 FROM m r WHERE r.session_id = m.session_id AND r.path = m.path AND r.kind = 'read' AND r.content IS NOT NULL AND NOT r.mutated AND NOT r.doubted AND r.pos < m.pos) AS seen FROM m)"""

ORACLE_SQL = {
    "replay_evidence": f"""
WITH {_MARKED}, e AS (SELECT session_id, pos, path, CASE WHEN kind = 'unknown' THEN CASE WHEN NOT may_mutate THEN 'unparsed_readonly' WHEN path IS NULL THEN 'unparsed_mutation_unscoped' ELSE 'unparsed_mutation_scope' END WHEN kind = 'write' THEN CASE WHEN seen THEN 'modified_after_observation' END
 WHEN path IS NULL THEN NULL WHEN mutated THEN 'read_after_first_mutation' WHEN doubted THEN 'read_after_unparsed_mutation' WHEN seen THEN NULL WHEN kind = 'absent' THEN 'initial_read_not_found' WHEN content IS NULL THEN 'read_result_missing' WHEN partial THEN 'partial_read_range' END AS reason FROM t)
SELECT session_id, pos, CASE WHEN reason <> 'unparsed_readonly' THEN path END AS path, reason FROM e WHERE reason IS NOT NULL""",
    "withheld_changes": f"WITH {_MARKED} SELECT session_id, pos, path, CASE WHEN seen THEN 'withheld_change' ELSE 'agent_created_file' END AS classification, content AS final_content FROM t WHERE kind = 'write' AND path IS NOT NULL",
    "prior_observations": f"""
WITH {_OPS}, p AS (SELECT *, session_id % 100000 * 2000 + 1500 AS start FROM o), q AS (SELECT * FROM p WHERE pos < start AND pos % 13 > 0 AND pos + pos % 40 < start)
SELECT session_id, pos, path, kind, NOT EXISTS (SELECT 1 FROM q x WHERE x.session_id = q.session_id AND x.pos >= q.pos AND (x.kind = 'unknown' AND x.may_mutate OR x.path IS NOT DISTINCT FROM q.path AND (x.kind = 'write' OR x.kind = 'absent' AND (x.pos > q.pos OR q.kind = 'read')))) AS valid FROM q WHERE kind IN ('read', 'absent')""",
    "stage_one_files": """
WITH e AS (SELECT user_id % 40 AS session_id, event_id AS pos, CASE WHEN event_id % 97 = 0 THEN 'shell' WHEN event_id % 83 = 0 THEN 'write' WHEN event_id % 2 = 0 THEN 'read' ELSE 'result' END AS kind, event_type AS call_id, CASE WHEN event_id % 10 > 0 THEN concat('f', event_id % 9) END AS path, event_id % 14 = 0 AS partial, CASE WHEN event_id % 11 > 0 THEN props END AS text FROM events),
b AS (SELECT session_id, min(pos) AS barrier FROM e WHERE kind IN ('shell', 'write') GROUP BY ALL), r AS (SELECT e.* FROM e LEFT JOIN b USING (session_id) WHERE kind = 'read' AND path IS NOT NULL AND (barrier IS NULL OR pos < barrier)),
a AS (SELECT s.session_id, s.pos, s.text, (SELECT max(r.pos) FROM r WHERE r.session_id = s.session_id AND r.call_id = s.call_id AND r.pos < s.pos) AS call, (SELECT max(x.pos) FROM e x WHERE x.kind = 'result' AND x.session_id = s.session_id AND x.call_id = s.call_id AND x.pos < s.pos) AS before FROM e s WHERE s.kind = 'result'),
k AS (SELECT a.session_id, r.path, a.text AS content, r.pos AS source_pos, a.pos FROM a JOIN r ON r.pos = a.call AND r.session_id = a.session_id WHERE NOT r.partial AND a.text IS NOT NULL AND (a.before IS NULL OR a.before < a.call) QUALIFY row_number() OVER (PARTITION BY a.session_id, r.path ORDER BY a.pos) = 1)
SELECT session_id, path, content, source_pos, CASE WHEN EXISTS (SELECT 1 FROM e w WHERE w.kind = 'write' AND w.session_id = k.session_id AND w.path = k.path AND w.pos > k.pos) THEN 'PARTIAL' ELSE 'COMPLETE' END AS completeness FROM k""",
    "exposure_argmax": """
WITH f AS (SELECT doc_id % 97 AS trajectory_id, count(*) AS files, CAST(sum(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) END) AS BIGINT) AS lines, CAST(sum(strlen(coalesce(text, ''))) AS BIGINT) AS bytes FROM documents GROUP BY ALL)
SELECT concat('r', trajectory_id % 5) AS repository, concat('c', trajectory_id % 3) AS base_commit, trajectory_id, files, lines, bytes FROM f WHERE trajectory_id % 7 > 0 QUALIFY row_number() OVER (PARTITION BY trajectory_id % 5, trajectory_id % 3 ORDER BY files DESC, lines DESC, bytes DESC, trajectory_id DESC) = 1""",
    "file_overlay": """
WITH a AS (SELECT o_custkey AS task_id, o_orderpriority AS path, CAST(min(o_orderkey) AS VARCHAR) AS content, CASE WHEN count(*) > 1 THEN 'PARTIAL' ELSE 'COMPLETE' END AS c FROM orders GROUP BY ALL), b AS (SELECT o_custkey AS task_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE concat('new', o_orderkey % 3) END AS path, max(o_orderkey) AS k FROM orders WHERE o_orderkey % 4 < 2 GROUP BY ALL)
SELECT task_id, path, concat('n', k) AS content, CASE WHEN k % 3 = 0 THEN 'SYNTHETIC_STUB' ELSE 'MODEL_COMPLETED' END AS kind, c AS replay_completeness FROM b LEFT JOIN a USING (task_id, path)
UNION ALL SELECT task_id, path, content, 'REPLAYED', c FROM a WHERE (task_id, path) NOT IN (SELECT (task_id, path) FROM b)""",
    "common_folders": """
WITH n AS (SELECT o_custkey AS session_id, count(DISTINCT o_orderpriority) AS p, count(DISTINCT concat(o_orderpriority, o_orderkey % 3)) AS pk, count(DISTINCT o_orderkey % 3) AS k3, count(DISTINCT o_orderkey % 2) AS k2, min(o_orderpriority) AS one FROM orders GROUP BY ALL)
SELECT session_id, CASE session_id % 5 WHEN 0 THEN concat('/w/', one) WHEN 1 THEN '/w/p' WHEN 2 THEN 'C:/w/p' ELSE '/w/p/q' END AS folder FROM n WHERE CASE session_id % 5 WHEN 0 THEN p = 1 AND pk > 1 WHEN 1 THEN k3 > 1 WHEN 2 THEN k2 > 1 WHEN 4 THEN k2 > 1 ELSE false END""",
    "numbering_resets": "SELECT event_id AS pos, event_id % 5 IN (1, 3) AS reset FROM events",
    "completion_holes": """
WITH c AS (SELECT o_custkey AS task_id, o_orderpriority AS path, min(o_orderkey % 4) AS k FROM orders WHERE o_orderkey % 9 > 0 GROUP BY ALL)
SELECT task_id, path, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = task_id AND o_orderpriority = path AND o_orderkey % 10 = 0) THEN 'ABSENT' ELSE ['PARTIAL', 'MISSING_BODY', 'SUPPORT', 'STUB'][k + 1] END AS kind FROM c""",
    "capture_repairs": """
SELECT p_partkey AS capture_id, CASE p_partkey % 7 WHEN 0 THEN '21 cc' WHEN 6 THEN 'same' END AS repaired, CASE p_partkey % 7 WHEN 1 THEN 'CAPTURE_REPAIR_OLD_TEXT_NOT_UNIQUE' WHEN 2 THEN 'CAPTURE_REPAIR_OVERLAP' WHEN 3 THEN 'CAPTURE_REPAIR_OLD_TEXT_NOT_UNIQUE'
 WHEN 4 THEN CASE WHEN p_partkey % 2 = 0 THEN 'CAPTURE_REPAIRS_INVALID' ELSE 'CAPTURE_REPAIR_EMPTY_RESULT' END WHEN 5 THEN 'CAPTURE_REPAIR_REQUIRES_OBSERVATION' END AS code FROM part""",
}
