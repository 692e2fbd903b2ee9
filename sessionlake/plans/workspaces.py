"""Queries of workspaces and outputs over the driver's tables and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import workspaces
from sessionlake.plans.artifacts import _table
from sessionlake.sources.storage import shared_folder, stored


#: Suites of a run.
SUITES = 100


def test_results(spark, sf_dir):
    """Result files of test runs, written and read back: a supplier is a suite, a run has SUITES of them at most and one file, as files cost more than what is in them."""
    case = "concat('<testcase name=\"t', l_linenumber, '\" classname=\"c', l_orderkey, '\">', CASE l_orderkey % 5 WHEN 0 THEN '<failure message=\"bad\"> deep </failure>' WHEN 1 THEN '<error message=\"broke\"/><failure>x</failure>' WHEN 2 THEN '<skipped/>' ELSE '' END, '</testcase>')"
    rows = _table(spark, sf_dir, "lineitem", "l_suppkey", f"{case} AS c").groupBy("l_suppkey").agg(F.concat(F.lit("<testsuite>"), F.array_join(F.collect_list("c"), ""), F.lit("</testsuite>")).alias("suite"))
    # a file has one root: what follows its end is not read
    runs = rows.groupBy(F.floor(F.col("l_suppkey") / SUITES).alias("run")).agg(F.concat(F.lit("<testsuites>"), F.array_join(F.collect_list("suite"), ""), F.lit("</testsuites>")).alias("value"))
    folder = shared_folder(spark)
    runs.write.partitionBy("run").text(folder)
    return workspaces.test_results(spark, folder)


def unwrapped_outputs(spark, sf_dir):
    head = "CASE event_id % 5 WHEN 0 THEN 'Exit code: 0\\nWall time: 1.5 seconds\\nTotal output lines: 3\\nOutput:\\n' WHEN 1 THEN 'Script failed\\r\\nWall time 2s\\r\\nOutput:\\r\\nExit code: 1\\nWall time: 1\\nWarning: w\\nOutput:\\n' WHEN 2 THEN 'Exit code: 0\\nOutput:\\n' ELSE '' END"
    return _table(spark, sf_dir, "events", "event_id", f"concat({head}, props) AS t").select("event_id", workspaces.unwrapped_output(F.col("t")).alias("text"))


def result_segments(spark, sf_dir):
    t = "CASE event_id % 5 WHEN 0 THEN concat('x\\n--- result 1 ---\\n', props, '\\n--- result 2 ---\\n\\nb') WHEN 1 THEN '--- 1 ---\\na\\n--- 2 ---\\n--- 3 ---\\nc' WHEN 2 THEN '--- 1 ---\\na' WHEN 3 THEN '--- 2 ---\\na\\n--- 1 ---' ELSE props END AS t"
    return _table(spark, sf_dir, "events", "event_id", t).select("event_id", F.array_join(workspaces.result_segments(F.col("t")), "|").alias("segments"))


def numbered_ranges(spark, sf_dir):
    t = "concat_ws('\\n', 'head', concat(event_id, ': a'), concat('  ', event_id + 1, ': b'), concat(event_id + 2 + event_id % 2, ': c'), CASE WHEN event_id % 3 = 0 THEN 'gap' ELSE concat(event_id + 3, '\\td') END, concat(event_id + 4, '\\te'), concat(event_id + 9, ': f')) AS text"
    return workspaces.numbered_ranges(_table(spark, sf_dir, "events", "event_id", t), "event_id")


NAMES = ["a.py", "src/x", "path.c", "myVal.c", "x.d.ts", "a.b.c", "1.2.3", "10.1234/x", "a..b", "$HOME/x", "", "plain", "w\\\\y", "z.txt (missing)", "toolongending.abcdefghi"]


def file_names(spark, sf_dir):
    names = ", ".join(f"'{n}'" for n in NAMES)
    return _table(spark, sf_dir, "events", "event_id", f"element_at(array({names}), CAST(event_id % {len(NAMES)} AS INT) + 1) AS n").select("event_id", workspaces.looks_like_file(F.col("n")).alias("is_file"))


def missing_includes(spark, sf_dir):
    text = "concat('<m><include file=\"../m/', o_orderkey % 7, '.xml\"/> <INCLUDE a=\"1\" file = ''sub/', o_orderkey % 3, '.xml''/><include file=\"/abs.xml\"/><include file=\"../../up.xml\"/></m>') AS text"
    files = _table(spark, sf_dir, "orders", "o_custkey AS task_id", "concat('m/', o_orderkey % 5, CASE WHEN o_orderkey % 11 = 0 THEN '.txt' ELSE '.xml' END) AS path", text, "o_orderkey")
    once = files.groupBy("task_id", "path").agg(F.min_by("text", "o_orderkey").alias("text"))
    return workspaces.missing_includes(once).distinct()


def completion_errors(spark, sf_dir):
    path = "CASE o_orderkey % 10 WHEN 0 THEN 'readme.md' WHEN 1 THEN '../x' WHEN 2 THEN concat('d/', o_orderpriority) ELSE concat('f', o_orderkey % 6) END"
    content = "CASE o_orderkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN concat('def value_one(): return ', o_orderstatus, ' alpha beta gamma') WHEN 2 THEN NULL ELSE concat('body ', o_orderkey) END"
    # dealt out before they are sorted, so a task that reads orders holds none, and written once, as the operator reads them four times
    rows = _table(spark, sf_dir, "orders", "o_custkey AS task_id", f"{path} AS path", f"{content} AS content", "o_orderkey").repartition("task_id", "path")
    files = stored(rows.groupBy("task_id", "path").agg(F.min_by("content", "o_orderkey").alias("content"))).withColumn("is_stub", F.lit(None).cast("boolean"))
    required = _table(spark, sf_dir, "customer", "c_custkey AS task_id", "explode(array('f1', 'f3', '2-HIGH', 'readme.md')) AS path")
    observed = _table(spark, sf_dir, "customer", "c_custkey AS task_id", "concat('f', c_custkey % 6) AS path")
    changes = _table(spark, sf_dir, "customer", "c_custkey AS task_id", "'value_one alpha beta gamma delta_x' AS final_content").where("task_id % 3 = 0")
    return workspaces.completion_errors(files, required, observed, changes)


def context_errors(spark, sf_dir):
    messages = _table(spark, sf_dir, "conversations", "conv_id AS session_id", "turn AS message_index", "CASE WHEN turn = 0 AND conv_id % 2 = 0 THEN 'system' ELSE role END AS role", "CASE WHEN conv_id % 11 = 0 THEN ' ' ELSE text END AS text")
    tasks = _table(spark, sf_dir, "conversations", "conv_id AS session_id", "turn AS message_index").where("message_index >= 2")
    refs = _table(spark, sf_dir, "conversations", "conv_id AS session_id", "turn AS pos", "(turn * 7 + conv_id) % 5 AS message_index", "CAST(turn - turn % 2 AS BIGINT) AS used_by", "CASE (conv_id + turn) % 4 WHEN 0 THEN substr(text, 1, 3) WHEN 1 THEN 'nowhere at all' END AS quote")
    return workspaces.context_errors(refs, messages, tasks).select("session_id", "pos", "code")


def set_digest(spark, sf_dir):
    """The same digest for the same rows in any order: of all documents' texts, and of the same texts in halves."""
    d = _table(spark, sf_dir, "documents", "doc_id", "sha2(coalesce(text, ''), 256) AS row_sha256")
    again = d.orderBy(F.desc("doc_id")).repartition(7)
    both = workspaces.set_digest(d).union(workspaces.set_digest(again))
    return both.agg(F.max("rows").alias("rows"), (F.min("set_sha256") == F.max("set_sha256")).alias("same"), F.char_length(F.max("set_sha256")).alias("digits"))


QUERIES = {f.__name__: f for f in (test_results, unwrapped_outputs, result_segments, numbered_ranges, file_names, missing_includes, completion_errors, context_errors, set_digest)}

ORACLE_SQL = {
    "test_results": "SELECT concat('t', l_linenumber) AS name, concat('c', l_orderkey) AS classname, CASE l_orderkey % 5 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'ERROR' WHEN 2 THEN 'SKIPPED' ELSE 'PASS' END AS status, CASE l_orderkey % 5 WHEN 0 THEN 'deep' WHEN 1 THEN 'broke' END AS message FROM lineitem",
    "unwrapped_outputs": "SELECT event_id, CASE WHEN event_id % 5 = 2 THEN concat('Exit code: 0', chr(10), 'Output:', chr(10), props) ELSE props END AS text FROM events",
    "result_segments": "SELECT event_id, CASE event_id % 5 WHEN 0 THEN concat(props, chr(10), '|b') WHEN 1 THEN concat('a', chr(10), '||c') END AS segments FROM events",
    "numbered_ranges": """
WITH e AS (SELECT event_id AS k, event_id % 2 = 0 AS three, event_id % 3 > 0 AS d FROM events)
SELECT k AS event_id, 2 AS start_line, CASE WHEN three THEN 4 ELSE 3 END AS end_line, CAST(k AS INTEGER) AS first_number, ': ' AS separator FROM e UNION ALL SELECT k, 4, 4, CAST(k + 3 AS INTEGER), ': ' FROM e WHERE NOT three
UNION ALL SELECT k, CASE WHEN d THEN 5 ELSE 6 END, 6, CAST(CASE WHEN d THEN k + 3 ELSE k + 4 END AS INTEGER), chr(9) FROM e UNION ALL SELECT k, 7, 7, CAST(k + 9 AS INTEGER), ': ' FROM e""",
    "file_names": "SELECT event_id, event_id % 15 IN (0, 1, 4, 12, 13) AS is_file FROM events",
    "missing_includes": """
WITH f AS (SELECT o_custkey AS task_id, concat('m/', o_orderkey % 5, CASE WHEN o_orderkey % 11 = 0 THEN '.txt' ELSE '.xml' END) AS path, min(o_orderkey) AS k FROM orders GROUP BY ALL)
SELECT task_id, path, concat('../m/', k % 7, '.xml') AS reference FROM f WHERE path LIKE '%.xml' AND (task_id, concat('m/', k % 7, '.xml')) NOT IN (SELECT (task_id, path) FROM f)
UNION ALL SELECT task_id, path, concat('sub/', k % 3, '.xml') FROM f WHERE path LIKE '%.xml' UNION ALL SELECT task_id, path, '../../up.xml' FROM f WHERE path LIKE '%.xml'""",
    "completion_errors": """
WITH f AS (SELECT o_custkey AS task_id, CASE o_orderkey % 10 WHEN 0 THEN 'readme.md' WHEN 1 THEN '../x' WHEN 2 THEN concat('d/', o_orderpriority) ELSE concat('f', o_orderkey % 6) END AS path, min(o_orderkey) AS any_key, min(o_orderkey) FILTER (o_orderkey % 4 <> 2) AS k FROM orders GROUP BY ALL),
g AS (SELECT task_id, path, any_key % 4 IN (0, 2) AS empty, any_key % 4 = 1 AS code FROM f), r AS (SELECT c_custkey AS task_id, p AS path, concat('f', c_custkey % 6) AS seen FROM customer, (VALUES ('f1'), ('f3'), ('2-HIGH'), ('readme.md')) v(p))
SELECT task_id, path, 'PATH_UNSAFE' AS code FROM g WHERE path = '../x' UNION ALL SELECT task_id, path, 'SOLUTION_LEAKAGE' FROM g WHERE code AND task_id % 3 = 0
UNION ALL SELECT task_id, path, 'BINDING_PATH_STUB_ONLY' FROM g WHERE empty AND (path IN ('f1', 'f3') OR path = 'd/2-HIGH') AND path <> concat('f', task_id % 6)
UNION ALL SELECT task_id, path, 'BINDING_PATH_MISSING' FROM r WHERE path <> seen AND (task_id, path) NOT IN (SELECT (task_id, path) FROM g)""",
    "context_errors": """
WITH m AS (SELECT conv_id AS s, turn AS i, CASE WHEN turn = 0 AND conv_id % 2 = 0 THEN 'system' ELSE role END AS role, CASE WHEN conv_id % 11 = 0 THEN ' ' ELSE text END AS text FROM conversations), u AS (SELECT s, i FROM m WHERE i >= 2 AND role = 'user'),
r AS (SELECT conv_id AS s, turn AS pos, (turn * 7 + conv_id) % 5 AS i, turn - turn % 2 AS u, CASE (conv_id + turn) % 4 WHEN 0 THEN substr(text, 1, 3) WHEN 1 THEN 'nowhere at all' END AS quote FROM conversations),
x AS (SELECT r.*, m.role, m.text, (SELECT min(i) FROM u WHERE u.s = r.s) AS first, EXISTS (SELECT 1 FROM u WHERE u.s = r.s AND u.i = r.u) AS known, row_number() OVER (PARTITION BY r.s, r.i, r.u, r.quote ORDER BY pos) > 1 AS again FROM r LEFT JOIN m ON m.s = r.s AND m.i = r.i)
SELECT s AS session_id, pos, CASE WHEN NOT known OR role IS NULL OR i > u AND role NOT IN ('assistant', 'tool') THEN 'CONTEXT_REFERENCE_INVALID' WHEN role <> 'user' AND i >= first AND NOT (role IN ('assistant', 'tool') AND quote IS NOT NULL) THEN 'CONTEXT_AFTER_TASK_START' WHEN role = 'system' AND quote IS NULL THEN 'CONTEXT_QUOTE_REQUIRED'
 WHEN quote IS NOT NULL AND (trim(quote) = '' OR NOT contains(text, quote)) THEN 'CONTEXT_QUOTE_NOT_FOUND' WHEN quote IS NULL AND trim(text) = '' THEN 'CONTEXT_EMPTY' WHEN again THEN 'CONTEXT_REPEATED' END AS code FROM x""",
    "set_digest": "SELECT count(*) AS rows, true AS same, CAST(64 AS INTEGER) AS digits FROM documents",
}
