"""Fit of tasks: each fault of an answer has its code, partial cover is told, and what an agent decided must follow."""

from pyspark.sql import functions as F

from sessionlake.operators import fitness


def test_answers_and_decisions(spark):
    ok = {"status": " satisfied ", "reason": "r", "paths": ["f"], "probe_ids": None, "conflict_kind": None, "repairable": None}
    conflict = {**ok, "status": "UNSATISFIED", "paths": None, "probe_ids": ["bad"], "conflict_kind": "CONTRADICTION", "repairable": False}
    cases = {
        "fine": ([("a", ok), ("b", {**ok, "paths": ["d/"]})], "READY_ORIGINAL", [], "READY_ORIGINAL"),
        "free": ([("a", ok), ("b", {**ok, "paths": None})], "READY_ORIGINAL", [], "READY_ORIGINAL"),
        "bare": ([("a", {**ok, "paths": []}), ("b", ok)], "READY_ORIGINAL", ["TASK_FIT_EVIDENCE_REQUIRED:a"], "REVIEW_TASK_FIT"),
        "path": ([("a", {**ok, "paths": ["f", "g"]}), ("b", ok)], "READY_ORIGINAL", ["TASK_FIT_PATH_UNKNOWN:a"], "REVIEW_TASK_FIT"),
        "probe": ([("a", {**ok, "probe_ids": ["none"]}), ("b", ok)], "READY_ORIGINAL", ["TASK_FIT_PROBE_UNKNOWN:a"], "REVIEW_TASK_FIT"),
        "part": ([("a", ok)], "READY_ORIGINAL", ["TASK_FIT_OBLIGATION_COVERAGE"], "REVIEW_TASK_FIT"),
        "odd": ([("a", ok), ("b", ok), ("c", ok), ("a", ok)], "READY_ORIGINAL", ["TASK_FIT_OBLIGATION_INVALID"], "REVIEW_TASK_FIT"),
        "word": ([("a", {**ok, "status": "MAYBE", "reason": " "}), ("b", ok)], "READY_ORIGINAL", ["TASK_FIT_REASON_REQUIRED:a", "TASK_FIT_STATUS_INVALID:a"], "REVIEW_TASK_FIT"),
        "shown": ([("a", conflict), ("b", ok)], " incompatible", [], "INCOMPATIBLE"),
        "weak": ([("a", {**conflict, "probe_ids": ["good"]}), ("b", {**conflict, "repairable": None})], "INCOMPATIBLE", ["TASK_CONFLICT_UNCONFIRMED:a", "TASK_CONFLICT_UNCONFIRMED:b"], "REVIEW_TASK_FIT"),
        "open": ([("a", ok), ("b", {**ok, "status": "unknown"})], "READY_ORIGINAL", ["TASK_FIT_UNKNOWN:b"], "REVIEW_TASK_FIT"),
        "clash": ([("a", ok), ("b", ok)], "INCOMPATIBLE", ["TASK_FIT_DECISION_CONFLICT"], "REVIEW_TASK_FIT"),
        "blocked": ([], None, [], "REVIEW"),
    }
    names = ["status", "reason", "paths", "probe_ids", "conflict_kind", "repairable"]
    answers = spark.createDataFrame([(t, k, o, *(a[n] for n in names)) for t, (rows, *_) in cases.items() for k, (o, a) in enumerate(rows)], "task_id string, pos int, obligation_id string, status string, reason string, paths array<string>, probe_ids array<string>, conflict_kind string, repairable boolean").withColumn("_known", F.lit("clash"))
    obligations = spark.createDataFrame([(t, o) for t in cases if t != "blocked" for o in "ab"], "task_id string, obligation_id string")
    bindings = spark.createDataFrame([(t, "a", ["f"]) for t in cases] + [(t, "b", []) for t in cases], "task_id string, obligation_id string, paths array<string>")
    files = spark.createDataFrame([(t, p) for t in cases for p in ("f", "d/x")], "task_id string, path string")
    probes = spark.createDataFrame([(t, *p) for t in cases for p in (("bad", "task_conflict", "FAIL", True, True), ("good", "task_conflict", "PASS", True, True))], "task_id string, probe_id string, purpose string, status string, unchanged boolean, reproducible boolean")
    errors = fitness.fit_errors(answers, obligations, bindings, files, probes)
    tasks = spark.createDataFrame([(t, "REVIEW" if t == "blocked" else "READY", d) for t, (_, d, _, _) in cases.items()], "task_id string, status string, decision string")
    got = {r.task_id: (r.errors, r.decision) for r in fitness.task_fits(tasks, answers, errors).collect()}
    assert got == {t: (e, d) for t, (_, _, e, d) in cases.items()}


def test_a_context_and_its_readiness_are_two_results(spark):
    run = lambda n=1, **more: [{"exit_code": 0, "timed_out": False, "after_sha256": "w", **more}] * n
    e = spark.createDataFrame([("t", "READY", None, "w", "w"), ("none", "READY", None, "w", None), ("gone", "READY", ["X"], None, "w")], "task_id string, status string, errors array<string>, workspace_sha256 string, expected_sha256 string")
    c = spark.createDataFrame([("t", 0, "load", ["l"], "r"), ("t", 1, "reset", ["s"], "r"), ("t", 2, "dependency", ["l", "no"], "r"), ("t", 3, "other", ["l"], "r"), ("t", 4, None, None, None)], "task_id string, pos int, kind string, probe_ids array<string>, reason string")
    p = spark.createDataFrame([("t", "l", "load", "PASS", True, None, "w", "w", run(exit_code=1)), ("t", "s", "reset", "PASS", True, True, "w", "w", run(2))], "task_id string, probe_id string, purpose string, status string, unchanged boolean, reproducible boolean, before_sha256 string, after_sha256 string, executions array<struct<exit_code:int,timed_out:boolean,after_sha256:string>>")
    got = {r.task_id: (r.status, r.context_errors, r.execution_readiness, r.execution_errors, r.probes) for r in fitness.environment_contracts(e, c, p).collect()}
    assert got["t"] == ("READY", [], "FAILED", ["ENVIRONMENT_CHECK_KIND_INVALID", "ENVIRONMENT_PROBE_NOT_PASS:dependency", "ENVIRONMENT_PROBE_RECEIPT_INVALID:load"], 2)
    assert got["none"] == ("READY", [], "FAILED", ["ENVIRONMENT_PROBES_REQUIRED"], 0)
    assert got["gone"][:3] == ("PIPELINE_ERROR", ["ENVIRONMENT_CHANGED_AFTER_SUFFICIENCY", "WORKSPACE_NOT_FOUND", "X"], "NOT_APPLICABLE")
    assert fitness.environment_contracts(e.limit(0), c, p).count() == 0
