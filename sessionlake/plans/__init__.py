"""Queries over the driver's tables and their SQL, by name."""

from sessionlake.plans import artifacts, assignment, audits, captures, fitness, gates, histories, messages, queries, reachability, records, replay, texts, trials, workspaces

_MODULES = (queries, audits, messages, gates, replay, artifacts, texts, captures, workspaces, histories, assignment, trials, records, reachability, fitness)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
