"""Queries of assigned calls and cited lines over the driver's tables and their SQL."""

from __future__ import annotations

from sessionlake.operators import assignment, coverage


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


#: Of an event, as a message and as a call: a tool id or none, and a text.
MESSAGE = "CASE WHEN event_id % 5 < 3 THEN event_type END AS tool, CAST(event_id % 7 % 3 AS STRING) AS said"
CALL = "CASE WHEN event_id % 4 < 2 THEN event_type END AS tool, CAST(event_id % 3 AS STRING) AS said"


def assigned_calls(spark, sf_dir):
    side = lambda number, what: _table(spark, sf_dir, "events", "concat(user_id, '-', event_id div 40) AS session_id", f"event_id AS {number}", *(x.strip() for x in what.split(", "))).selectExpr("session_id", number, "array(tool) AS tool_ids", "said AS text")
    return assignment.assigned_calls(side("pos", MESSAGE), side("call_no", CALL)).selectExpr("session_id", "coalesce(pos, -1L) AS pos", "coalesce(call_no, -1L) AS call_no", "coalesce(rule, '') AS rule")


def uneven_lines(spark, sf_dir):
    """An order is a return of 60 lines, its items are ranges."""
    returns = _table(spark, sf_dir, "orders", "o_orderkey AS return_id", "60L AS line_count")
    ranges = _table(spark, sf_dir, "lineitem", "l_orderkey AS return_id", "l_linenumber * 8 - 7 AS first", "l_linenumber * 8 - 9 + CAST(l_quantity / 4 AS INT) AS last")
    return coverage.uneven_lines(returns, ranges, stretch=16)


def range_errors(spark, sf_dir):
    returns = _table(spark, sf_dir, "orders", "o_orderkey AS return_id", "60L AS line_count")
    ranges = _table(spark, sf_dir, "lineitem", "l_orderkey * 2 - l_linenumber AS return_id", "l_linenumber * 8 - 7 AS first", "l_linenumber * 8 - 9 + CAST(l_quantity / 4 AS INT) AS last")
    return coverage.range_errors(returns, ranges)


QUERIES = {f.__name__: f for f in (assigned_calls, uneven_lines, range_errors)}

ORACLE_SQL = {
    "assigned_calls": """
WITH RECURSIVE e AS (
  SELECT concat(user_id, '-', event_id // 40) AS session_id, event_id, CASE WHEN event_id % 5 < 3 THEN event_type END AS m_tool, event_id % 7 % 3 AS m_said, CASE WHEN event_id % 4 < 2 THEN event_type END AS c_tool, event_id % 3 AS c_said FROM events
), s AS (
  SELECT session_id, list(event_id ORDER BY event_id) AS pos, list({'tool': m_tool, 'said': m_said} ORDER BY event_id) AS messages, list({'no': event_id, 'tool': c_tool, 'said': c_said} ORDER BY event_id) AS calls FROM e GROUP BY session_id
), r AS (
  SELECT session_id, pos, messages, calls, CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS picked FROM s
  UNION ALL
  SELECT session_id, pos, messages, calls, step + 1,
         list_append(picked, coalesce(list_filter(calls, lambda c: NOT list_contains(picked, c.no) AND c.tool = messages[step + 1].tool)[1].no,
                                      list_filter(calls, lambda c: NOT list_contains(picked, c.no) AND messages[step + 1].tool IS NULL AND c.tool IS NULL AND c.said = messages[step + 1].said)[1].no,
                                      list_filter(calls, lambda c: NOT list_contains(picked, c.no))[1].no))
  FROM r WHERE step < len(pos)
), done AS (
  SELECT session_id, unnest(pos) AS pos, unnest(picked) AS call_no, unnest(messages) AS m FROM r WHERE step = len(pos)
)
SELECT d.session_id, d.pos, d.call_no, CASE WHEN d.m.tool = e.c_tool THEN 'TOOLS' WHEN d.m.tool IS NULL AND e.c_tool IS NULL AND d.m.said = e.c_said THEN 'TEXT' ELSE 'NEXT' END AS rule FROM done d JOIN e ON e.event_id = d.call_no AND e.session_id = d.session_id""",
    "uneven_lines": """
WITH r AS (
  SELECT l_orderkey AS return_id, l_linenumber * 8 - 7 AS first, l_linenumber * 8 - 9 + CAST(trunc(l_quantity / 4) AS INTEGER) AS last FROM lineitem
), fine AS (
  SELECT * FROM r WHERE first >= 1 AND first <= last AND last <= 60
), lines AS (
  SELECT o_orderkey AS return_id, unnest(range(1, 61)) AS line FROM orders
), counted AS (
  SELECT l.return_id, l.line, count(f.return_id) AS times FROM lines l LEFT JOIN fine f ON f.return_id = l.return_id AND l.line BETWEEN f.first AND f.last GROUP BY l.return_id, l.line
), islands AS (
  SELECT *, line - row_number() OVER (PARTITION BY return_id, times ORDER BY line) AS island FROM counted WHERE times <> 1
)
SELECT return_id, min(line) AS first, max(line) AS last, times FROM islands GROUP BY return_id, times, island""",
    "range_errors": """
WITH r AS (SELECT l_orderkey * 2 - l_linenumber AS return_id, CAST(l_linenumber * 8 - 7 AS BIGINT) AS first, CAST(l_linenumber * 8 - 9 + CAST(trunc(l_quantity / 4) AS INTEGER) AS BIGINT) AS last FROM lineitem)
SELECT return_id, first, last, CASE WHEN o_orderkey IS NULL THEN 'RETURN_UNKNOWN' ELSE 'OUT_OF_BOUNDS' END AS code FROM r LEFT JOIN orders ON o_orderkey = return_id WHERE o_orderkey IS NULL OR first < 1 OR first > last OR last > 60""",
}
