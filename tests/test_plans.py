"""Every query against its SQL, and what the driver's tables cannot exercise on small fixtures."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sessionlake.functions import text as texts
from sessionlake.operators import artifacts, audits, evidence, messages, sessions
from sessionlake.plans import ORACLE_SQL, QUERIES
from sessionlake.sources import session_files

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations labels pages benchmark".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([round(r[k], 9) if isinstance(r[k], float) else r[k] for k in order]) for r in rows)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), columns)


def test_calls_and_results(spark):
    rows = [(1, 1, "call", "a"), (1, 2, "call", "a"), (1, 3, "result", "a"), (1, 4, "result", "a"), (1, 5, "call", ""), (1, 6, "result", ""), (1, 7, "call", None), (1, 8, "result", "b")]
    t = spark.createDataFrame(rows, "session_id long, pos int, kind string, call_id string").withColumn("span_no", F.col("pos") / 4)
    got = {r.pos: r.state for r in sessions.matched_calls(t).collect()}
    assert got == {1: "pending", 2: "matched", 3: "matched", 4: "orphan", 5: "pending", 6: "orphan", 7: "pending", 8: "orphan"}
    assert {r.pos: (r.code, r.call_pos) for r in sessions.linkage_errors(t).where("call_id <> ''").collect()} == {3: ("tool_link_crosses_span", 2), 4: ("tool_link_crosses_span", 2), 8: ("orphan_tool_result", None)}


def test_spans_join_neighbouring_users(spark):
    rows = [(1, k, r) for k, r in enumerate(["system", "user", "user", "assistant", "tool", "user"])]
    got = sessions.request_spans(spark.createDataFrame(rows, "session_id long, pos int, role string")).orderBy("span_no").collect()
    assert [(r.message_start, r.message_end, r.user_messages, r.truncated_target) for r in got] == [(1, 5, 2, False), (5, 6, 1, True)]


def test_secrets_are_hashed_with_their_line(spark):
    rows = [("f", "a\nsk-" + "x" * 20 + "\nauthorization: Bearer abcdefgh1\nMY_API_KEY=redacted\nMY_API_KEY='12345678'\ntask-" + "y" * 20), ("g", None), ("h", 'x token = "0123abcd" tokens = "0123abcd" api-key: short')]
    t = spark.createDataFrame(rows, "path string, text string")
    found = texts.secret_findings(t, detectors=texts.secret_detectors(variable_prefixes=("MY",), names=("token",))).collect()
    assert sorted((r.path, r.line, r.detector) for r in found) == [("f", 2, "token_prefix"), ("f", 3, "auth_header_value"), ("f", 5, "credential_env_value"), ("h", 1, "assigned_value")]


def test_queue_keeps_the_first_of_a_key(spark):
    t = spark.createDataFrame([("a", 2, "ELIGIBLE", "FAILURE", "HIGH", 1, 0, 0.5), ("a", 1, "REJECT", None, None, 0, 2, None), ("", 3, "ELIGIBLE", "FAILURE", "HIGH", 9, 0, 1.0), ("b", 4, "DEFER", "SUCCESS", "LOW", 3, 0, 0.0)], "report_id string, ingest_pos int, decision string, outcome string, recoverability string, rubric_total int, evidence_count int, confidence double")
    assert [(r.report_id, r.weight, r.decision_rank, r.outcome_rank) for r in evidence.review_queue(t, 5).collect()] == [("b", 3.0, 2, 0), ("a", 2.0, 0, 1)]
    with pytest.raises(ValueError):
        evidence.review_queue(t, 0)


def test_coverage_of_declared_sources(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 4), ("b", 1), (None, 2)], "source string, bytes long")
    declared = spark.createDataFrame([("a", 2, 7), ("b", 2, 1), ("c", 0, 0), (None, 1, 2)], "source string, records long, bytes long")
    assert {r.source: r.status for r in audits.coverage(rows, declared).collect()} == {"a": "READY", "b": "PARTIAL_SOURCE", "c": "READY", None: "READY"}


def test_paths_and_gaps(spark):
    t = spark.createDataFrame([("a/b/c",), ("../x",), ("/x",), ("",), (None,), ("a\\b",), ("x",)], "p string")
    got = [(r.safe, r.up) for r in t.select(audits.safe_relative_path(F.col("p")).alias("safe"), audits.ancestors(F.col("p")).alias("up")).collect()]
    assert got == [(True, ["a", "a/b"]), (False, [".."]), (False, [""]), (False, []), (False, None), (False, []), (True, [])]
    lines = spark.createDataFrame([("f", 2, 6), ("f", 2, 6), ("f", 5, 6)], "path string, line int, total int")
    assert sorted((r.first, r.last) for r in audits.missing_ranges(lines).collect()) == [(1, 1), (3, 4), (6, 6)]


def test_audits_of_empty_tables(spark):
    none = spark.createDataFrame([], "path string, line int, text string, total int, status string, tokens long, seconds double")
    assert audits.merged_reads(none).count() == audits.missing_ranges(none).count() == 0
    r = audits.rollout_metrics(none).first()
    assert (r.trials, r.pass_rate, r.tokens, r.mean_seconds) == (0, 0.0, 0, None)


def test_partial_reads(spark):
    rows = [("a", 1, "x", 2), ("a", 2, "y", None), ("b", 1, "x", 1), ("b", 3, "z", 1), ("c", 1, "x", None), ("d", 1, "x", 1), ("d", 1, "y", 1), ("e", 1, "x", 1), ("e", 1, "x", 2)]
    t = spark.createDataFrame(rows, "path string, line int, text string, total int")
    assert {r.path: (r.status, r.content) for r in audits.merged_reads(t).collect()} == {"a": ("COMPLETE", "x\ny\n"), "b": ("RANGE_MISMATCH", None), "c": ("PARTIAL", None), "d": ("CONFLICT", None), "e": ("TOTAL_CONFLICT", None)}
    assert sorted(((r.path, r.first, r.last) for r in audits.missing_ranges(t).collect()), key=repr) == [("c", None, None)]


def test_a_failure_needs_the_next_success_in_the_log(spark):
    rows = [(1, "k", 0, 5, False), (2, "k", 3, 9, True), (3, "k", 10, 12, True), (4, "k", 11, 12, False), (5, "k", 12, 13, True), (6, "k", None, None, False), (7, "j", 0, 1, False)]
    t = spark.createDataFrame(rows, "exchange_id int, key string, started_at int, finished_at int, ok boolean").withColumn("log_pos", F.col("exchange_id"))
    assert {r.exchange_id: r.superseded_by for r in audits.superseded_failures(t, ["key"]).collect()} == {1: None, 4: 5, 6: None, 7: None}


def test_message_contents(spark):
    rows = ['"  plain "', '["a", {"text": "b"}, {"text": "", "value": "c"}, {"text": 3}, 4, null]', '{"value": "v", "text": "t"}', '{"value": null, "text": "t"}', "null", "7", "broken", None]
    t = spark.createDataFrame([(1, k, c) for k, c in enumerate(rows)], "session_id int, pos int, content string")
    assert [r.t for r in t.orderBy("pos").select(messages.message_text(F.col("content")).alias("t")).collect()] == ["plain", "abc", "v", "t", "", "", "", ""]
    blocks = spark.createDataFrame([(1, 0, '["  x ", {"type": "image", "text": "no"}, {"type": "text", "value": " y"}, {"text": "", "value": "z"}, 5]')], t.schema)
    assert [(r["index"], r.text) for r in messages.result_blocks(blocks).orderBy("index").collect()] == [(0, "  x "), (1, None), (2, " y"), (3, ""), (4, None)]


def test_large_and_odd_session_files(spark, tmp_path):
    raw = "".join(f'{{"messages": [], "k": {k}}}\n' for k in range(5000)) + "tail"
    (tmp_path / "a.jsonl").write_text(raw)
    (tmp_path / "b.jsonl").write_bytes(b'{"messages": []}\r\n\n[1]\n{"messages": {}}\n{"messages": []} x\n')
    (tmp_path / "c.jsonl").write_bytes(b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = session_files.session_inventory(session_files.file_lines(spark, str(tmp_path), str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    import hashlib

    a = sorted((r for r in got if r.source == "a.jsonl"), key=lambda r: r.line_number)
    lines = raw.encode().splitlines(keepends=True)
    offsets = [0]
    for x in lines:
        offsets.append(offsets[-1] + len(x))
    assert [(r.line_number, r.byte_offset, r.byte_length, r.line_sha256) for r in a] == [(k + 1, offsets[k], len(x), hashlib.sha256(x).hexdigest()) for k, x in enumerate(lines)]
    b = {r.line_number: (r.error, r.byte_length) for r in got if r.source == "b.jsonl"}
    assert b == {1: (None, 18), 2: ("INVALID_JSON", 1), 3: ("INVALID_SESSION", 4), 4: ("INVALID_SESSION", 17), 5: ("INVALID_JSON", 19)}


def test_trees_and_slices(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x").write_bytes(b"1")
    (tmp_path / "y").write_bytes(b"2")
    files = session_files.tree_files(spark, str(tmp_path))
    import hashlib

    want = hashlib.sha256(b"d/x\0" + hashlib.sha256(b"1").digest() + b"y\0" + hashlib.sha256(b"2").digest()).hexdigest()
    assert session_files.tree_digests(files.withColumn("tree", F.lit(1))).first().digest == want
    with pytest.raises(ValueError):
        artifacts.selected_slice(files, ["path"], -1)


def test_slices_without_a_limit(spark):
    t = spark.createDataFrame([(k * 7 % 101, str(k)) for k in range(101)] + [(None, "x")], "a int, _part string").repartition(6)
    for offset in (0, 1, 50, 102, 500):
        got = [r.a for r in artifacts.selected_slice(t, ["a"], offset).collect()]
        assert got == [None, *range(101)][offset:]


def test_pairs_of_a_common_kind_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(texts, "BLOCK", 3, raising=False)
    kinds = [["api", "cli", "export"], [], ["api"], None]
    rows = [(k, kinds[0 if k < 20 else 1 if k < 40 else 2 + k % 2]) for k in range(46)]
    got = texts.gap_pairs(spark.createDataFrame(rows, "workspace_id long, capabilities array<string>"), least=2).withColumn("task", F.spark_partition_id()).collect()
    want = [(a, b, sorted(set(x or []) - set(y or []))) for a, x in rows for b, y in rows if a != b and len(set(x or []) - set(y or [])) >= 2]
    assert sorted((r.reference, r.target, r.gap) for r in got) == sorted(want)
    assert len({r.task for r in got}) > 4


def test_pairs_are_made_as_they_are_read(spark):
    """The first pair is given out before more than a block of one reference's is made; gaps are joined once for two kinds."""
    rows = [(k, ["cli", "api"] if k % 2 else ["export"]) for k in range(600)]
    profiles = spark.createDataFrame(rows, "workspace_id long, capabilities array<string>")
    numbered = texts.gap_pairs(profiles, least=2).withColumn("n", F.monotonically_increasing_id() % (1 << 33))
    first = numbered.select("reference", "target", F.when(F.col("n") > texts.BLOCK, F.raise_error(F.lit("pairs are held"))).alias("held"))
    assert first.take(1)[0].reference % 2 == 1
    got = texts.gap_pairs(profiles, least=2, separator=",")
    assert got.dtypes[-1] == ("gap", "string") and {tuple(r) for r in got.groupBy("gap").count().collect()} == {("api,cli", 90000)}
    plan = QUERIES["gap_pairs"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan[: plan.index("explode(")]


def test_suites_share_result_files(spark, monkeypatch):
    from sessionlake.plans import workspaces

    suppliers = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_suppkey").distinct().count()
    assert len(QUERIES["test_results"](spark, DATA).inputFiles()) < suppliers
    monkeypatch.setattr(workspaces, "SUITES", 1)
    assert len(QUERIES["test_results"](spark, DATA).inputFiles()) == suppliers


def test_completed_workspaces_broadcast_no_lists(spark):
    """What is small compressed may be large in memory: lists are told apart in a sort. Nulls are no files."""
    from sessionlake.operators import workspaces

    rows = lambda *r: spark.createDataFrame(list(r), "task_id long, path string")
    bodies = [(1, "a.py", " "), (1, "d/b.py", None), (1, "d/c.py", None), (1, "/x", "body"), (1, None, None), (None, "a.py", None), (2, "s.py", "ab cde fgh alpha beta gamma"), (2, "t.py", "alpha x"), (3, "u.py", "say q z")]
    files = spark.createDataFrame([(*b, None) for b in bodies], "task_id long, path string, content string, is_stub boolean")
    required = rows((1, "a.py"), (1, "b.py"), (1, "c.py"), (1, "c.py"), (1, None), (None, "a.py"), (4, "w"), (4, "w"))
    observed = rows((1, "d/c.py"), (4, "v"), (None, "b.py"), (1, None))
    changes = spark.createDataFrame([(2, "cde fgh alpha beta gamma"), (3, "q z"), (None, "cde fgh alpha beta gamma")], "task_id long, final_content string")
    found = workspaces.completion_errors(files, required, observed, changes)
    stub, lost = "BINDING_PATH_STUB_ONLY", "BINDING_PATH_MISSING"
    want = [(1, "/x", "PATH_UNSAFE"), (1, "a.py", stub), (1, "d/b.py", stub), (2, "s.py", "SOLUTION_LEAKAGE"), (3, "u.py", "SOLUTION_LEAKAGE"), (1, "b.py", lost), (1, "c.py", lost), (1, None, lost), (None, "a.py", lost), (4, "w", lost)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    stubs = workspaces.stub_errors(files, required, observed)
    assert sorted(map(tuple, stubs.collect())) == [w for w in want if w[2] == stub]
    assert "Broadcast" not in stubs._jdf.queryExecution().executedPlan().toString()
