"""Queries of the text functions over the driver's tables and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.functions import text as texts


def _table(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*columns or "*")


def gap_pairs(spark, sf_dir):
    markers = "array('api', 'cli', 'client', 'config', 'database', 'export', 'import', 'parser', 'server', 'transform')"
    # bits of a number are put together in the hash table itself, sets of words would be sorted beyond 128 workspaces
    marks = _table(spark, sf_dir, "lineitem", "l_suppkey AS workspace_id", "CASE WHEN l_orderkey % 400 = 0 THEN shiftleft(1, CAST(l_partkey % 10 AS INT)) END AS m").groupBy("workspace_id").agg(F.bit_or("m").alias("m"))
    profiles = marks.selectExpr("workspace_id", f"filter({markers}, (x, i) -> getbit(m, i) = 1) AS capabilities")
    return texts.gap_pairs(profiles, least=2, separator=",")


def known_secrets(spark, sf_dir):
    return texts.known_secrets(_table(spark, sf_dir, "documents", "doc_id AS path", "text"), ["the and", "", "des la", "und der"])


def scrubbed_texts(spark, sf_dir):
    return _table(spark, sf_dir, "events", "event_id", "concat('key=', event_type, ' ', props) AS t").select("event_id", texts.scrubbed(F.col("t"), ["view", "vie", "click", ""]).alias("text"))


def header_redaction(spark, sf_dir):
    h = _table(spark, sf_dir, "events", "event_id", "map('Authorization', 'a', 'X-Api-Key', 'b', 'Accept', props, concat('X-', event_type), 'd') AS headers")
    return h.select("event_id", F.array_join(F.array_sort(F.transform(F.map_entries(texts.without_credentials(F.col("headers"))), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";").alias("headers"))


def elided_secrets(spark, sf_dir):
    value = "CASE event_id % 5 WHEN 0 THEN concat('tok', event_id % 90, 'abc...', 'end', event_id % 7) WHEN 1 THEN concat('tok', event_id % 90, 'abcdefend', event_id % 7) WHEN 2 THEN concat('to...', event_id % 7) WHEN 3 THEN concat('tok', event_id % 90, '...end...', event_id % 7) ELSE concat('tok', event_id % 90, 'ab...', 'end', event_id % 7) END AS value"
    findings = _table(spark, sf_dir, "events", "event_id AS path", "CASE WHEN event_id % 2 = 0 THEN 'header' ELSE 'env' END AS detector", value)
    originals = _table(spark, sf_dir, "events", "'header' AS detector", "concat('tok', event_id % 80, 'abcdefend', event_id % 5) AS value").distinct()
    return texts.elided_matches(findings, originals).select("path", "allowed")


def leaked_solutions(spark, sf_dir):
    """Documents that hold an item of the benchmark, or most of its tokens."""
    bodies = _table(spark, sf_dir, "documents", "lang AS task_id", "doc_id AS path", "text")
    items = _table(spark, sf_dir, "benchmark", "item_id", "text", "explode(array('de', 'en', 'es', 'fr')) AS task_id")
    short = F.when(F.col("item_id") % 4 == 0, F.substring("text", 1, 12)).otherwise(F.col("text"))
    return texts.leaked_solutions(bodies, items.select("task_id", short.alias("final_content")))


QUERIES = {f.__name__: f for f in (gap_pairs, known_secrets, scrubbed_texts, header_redaction, elided_secrets, leaked_solutions)}

ORACLE_SQL = {
    "gap_pairs": """
WITH c AS (SELECT DISTINCT l_suppkey AS w, ['api', 'cli', 'client', 'config', 'database', 'export', 'import', 'parser', 'server', 'transform'][l_partkey % 10 + 1] AS m FROM lineitem WHERE l_orderkey % 400 = 0), w AS (SELECT DISTINCT l_suppkey AS w FROM lineitem),
g AS (SELECT c.w AS reference, t.w AS target, string_agg(m, ',' ORDER BY m) AS gap, count(*) AS n FROM c, w t WHERE t.w <> c.w AND NOT EXISTS (SELECT 1 FROM c x WHERE x.w = t.w AND x.m = c.m) GROUP BY ALL) SELECT reference, target, gap FROM g WHERE n >= 2""",
    "known_secrets": "SELECT doc_id AS path FROM documents WHERE contains(text, 'the and') OR contains(text, 'des la') OR contains(text, 'und der')",
    "scrubbed_texts": "SELECT event_id, concat('key=', CASE WHEN event_type IN ('view', 'click') THEN '[credential]' ELSE event_type END, ' ', props) AS text FROM events",
    "header_redaction": "SELECT event_id, concat('Accept=', props, ';X-', event_type, '=d') AS headers FROM events",
    "elided_secrets": """
WITH o AS (SELECT DISTINCT event_id % 80 AS a, event_id % 5 AS b FROM events), f AS (SELECT event_id, event_id % 2 = 0 AS header, event_id % 5 AS form, event_id % 90 AS a, event_id % 7 AS b FROM events)
SELECT event_id AS path, header AND form IN (0, 1, 4) AND EXISTS (SELECT 1 FROM o WHERE o.a = f.a AND o.b = f.b) AS allowed FROM f""",
    "leaked_solutions": """
WITH i AS (SELECT CASE WHEN item_id % 4 = 0 THEN substr(text, 1, 12) ELSE text END AS t FROM benchmark), k AS (SELECT t, list_distinct(list_transform(regexp_extract_all(t, '[A-Za-z_][A-Za-z0-9_]{2,}'), lambda x: lower(x))) AS w FROM i WHERE t <> ''),
d AS (SELECT doc_id, lang, text, list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z_][A-Za-z0-9_]{2,}'), lambda x: lower(x))) AS w FROM documents WHERE text IS NOT NULL AND lang IN ('de', 'en', 'es', 'fr'))
SELECT DISTINCT lang AS task_id, doc_id AS path FROM d, k WHERE contains(d.text, k.t) OR len(k.w) >= 4 AND len(list_intersect(k.w, d.w)) / len(k.w) >= 0.8""",
}
