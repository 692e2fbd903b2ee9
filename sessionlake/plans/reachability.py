"""Queries of references between files over the driver's tables and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import reachability


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


REFERENCE = "concat(event_id * 31 % 90, '.py') AS target"


def _references(spark, sf_dir):
    """A workspace's files are 90 at most; an event refers from one to another of its workspace, if that is there."""
    rows = _table(spark, sf_dir, "events", "user_id % 50 AS workspace_id", "concat(event_id % 83, '.py') AS path", "concat('r', event_id * 31 % 90) AS reference", f"array(concat('lib/', event_id), {REFERENCE.split(' AS ')[0]}) AS candidates")
    return reachability.resolved_references(rows, rows.select("workspace_id", "path"))


def needed_files(spark, sf_dir):
    entries = _table(spark, sf_dir, "events", "user_id % 50 AS workspace_id", "concat(user_id % 7, '.py') AS path")
    return reachability.needed_files(entries, _references(spark, sf_dir)).withColumn("depth", F.col("depth").cast("long"))


def open_references(spark, sf_dir):
    entries = _table(spark, sf_dir, "events", "user_id % 50 AS workspace_id", "concat(user_id % 7, '.py') AS path")
    references = _references(spark, sf_dir)
    return reachability.open_references(reachability.needed_files(entries, references), references)


def name_index(spark, sf_dir):
    """An order is a file of its customer's workspace, in one folder of three; items name files with and without their folder."""
    paths = _table(spark, sf_dir, "orders", "o_custkey % 300 AS workspace_id", "concat('d', o_orderkey % 3, '/e', o_orderkey % 2, '/f', o_orderkey % 40) AS path")
    names = _table(spark, sf_dir, "lineitem", "l_suppkey % 300 AS workspace_id", "concat(CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN concat('e', l_partkey % 2, '/') ELSE concat('d', l_partkey % 4, '/e', l_partkey % 2, '/') END, 'f', l_partkey % 45) AS name")
    return reachability.name_index(names, paths)


def listed_names(spark, sf_dir):
    """What listings of customers printed: long lines, links, headings of folders, plain names."""
    text = "concat('total ', c_custkey, '\n', CASE c_custkey % 4 WHEN 0 THEN concat('drwxr-xr-x 2 u g 40 Jan 1 10:00 ', c_mktsegment, '\n-rw-r--r-- 1 u g 9 Jan 1 2024 ', c_name, ' x') WHEN 1 THEN concat('./', c_mktsegment, ':\n', c_name, '\n..') WHEN 2 THEN concat('lrwxrwxrwx 1 u g 3 Jan 1 10:00 ', c_name, ' -> /', c_mktsegment) ELSE concat('./', c_name, '/\n\n', c_mktsegment) END) AS text"
    return reachability.listed_names(_table(spark, sf_dir, "customer", "c_nationkey AS workspace_id", "c_custkey AS event_id", "'top' AS folder", text))


QUERIES = {f.__name__: f for f in (needed_files, open_references, name_index, listed_names)}

_REACHED = """
WITH RECURSIVE r AS (
  SELECT DISTINCT user_id % 50 AS workspace_id, concat(event_id % 83, '.py') AS path, concat('r', event_id * 31 % 90) AS reference, concat(event_id * 31 % 90, '.py') AS target FROM events
), here AS (
  SELECT DISTINCT workspace_id, path FROM r
), edges AS (
  SELECT DISTINCT r.workspace_id, r.path, r.target FROM r JOIN here h ON h.workspace_id = r.workspace_id AND h.path = r.target
), reached AS (
  SELECT DISTINCT user_id % 50 AS workspace_id, concat(user_id % 7, '.py') AS entry, concat(user_id % 7, '.py') AS path, CAST(0 AS BIGINT) AS depth FROM events
  UNION
  SELECT x.workspace_id, x.entry, e.target, x.depth + 1 FROM reached x JOIN edges e ON e.workspace_id = x.workspace_id AND e.path = x.path WHERE x.depth < 40
), needed AS (
  SELECT workspace_id, entry, path, min(depth) AS depth FROM reached GROUP BY workspace_id, entry, path
)"""

ORACLE_SQL = {
    "needed_files": f"{_REACHED} SELECT * FROM needed",
    "open_references": f"{_REACHED} SELECT DISTINCT n.workspace_id, n.entry, n.path, r.reference FROM needed n JOIN r ON r.workspace_id = n.workspace_id AND r.path = n.path WHERE NOT EXISTS (SELECT 1 FROM here h WHERE h.workspace_id = r.workspace_id AND h.path = r.target)",
    "name_index": """
WITH p AS (
  SELECT DISTINCT o_custkey % 300 AS workspace_id, concat('d', o_orderkey % 3, '/e', o_orderkey % 2, '/f', o_orderkey % 40) AS path FROM orders
), n AS (
  SELECT DISTINCT l_suppkey % 300 AS workspace_id, concat(CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN concat('e', l_partkey % 2, '/') ELSE concat('d', l_partkey % 4, '/e', l_partkey % 2, '/') END, 'f', l_partkey % 45) AS name FROM lineitem
)
SELECT n.workspace_id, n.name, count(p.path) AS paths_found, CASE WHEN count(p.path) = 1 THEN min(p.path) END AS path
FROM n LEFT JOIN p ON p.workspace_id = n.workspace_id AND ends_with('/' || p.path, '/' || n.name) GROUP BY n.workspace_id, n.name""",
    "listed_names": """
WITH c AS (SELECT c_nationkey AS workspace_id, c_custkey AS event_id, c_custkey % 4 AS k, c_name AS n, c_mktsegment AS s FROM customer)
SELECT workspace_id, event_id, 'top' AS folder, s AS name, k = 0 AS is_folder FROM c WHERE k IN (0, 3)
UNION ALL SELECT workspace_id, event_id, 'top', CASE WHEN k = 0 THEN n || ' x' ELSE n END, k = 3 FROM c WHERE k <> 1
UNION ALL SELECT workspace_id, event_id, s, n, false FROM c WHERE k = 1""",
}
