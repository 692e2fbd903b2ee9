"""Trials as folders: a code for each file that is missing, unreadable or contradicts another."""

import copy
import hashlib
import json

from sessionlake.sources import trials

LAYOUT = trials.Layout(
    {"result": "result\\.json", "trajectory": "agent/trajectory\\.full\\.json", "steps": "agent/trajectory\\.json", "task": "agent/task-input\\.json", "manifest": "agent/workspace\\.json"},
    {"exchanges": "agent/exchanges\\.jsonl", "events": "agent/sse\\.jsonl", "session": "agent/session\\.jsonl"}, "full-v1",
)
PATHS = {"result": "result.json", "trajectory": "agent/trajectory.full.json", "steps": "agent/trajectory.json", "task": "agent/task-input.json", "manifest": "agent/workspace.json", "exchanges": "agent/exchanges.jsonl", "events": "agent/sse.jsonl", "session": "agent/session.jsonl"}


def sound():
    files = [{"path": "a.py", "sha256": "1"}, {"path": "b/c", "sha256": "2"}]
    task = {"instruction": "do it\n", "workspace": {"files": files}}
    use, answer = {"type": "tool_use", "id": "t1", "name": "read", "input": {}}, {"type": "text", "text": "done"}
    calls = [
        {"request": {"messages": [{"role": "user", "content": "do it"}]}, "response": {"content": [use], "stop_reason": "tool_use"}},
        {"request": {"messages": [{"role": "user", "content": [{"type": "tool_result", "tool_use_id": "t1", "content": "x"}]}]}, "response": {"content": [answer, answer], "stop_reason": "end_turn"}},
    ]
    return {
        "result": {"finished_at": "2026-01-01", "exception_info": None, "verifier_result": {"rewards": {}}}, "trajectory": {"schema_version": "full-v1", "model": "m", "calls": calls, "task_input": task}, "steps": {"steps": []},
        "task": {"workspace": {"files": files}, "instruction": "do it\n"}, "manifest": {"files": files[::-1]}, "exchanges": [{"n": 1}, {"n": 2}], "events": [], "session": [{"role": "user"}],
    }


def cases():
    def changed(*path, to):
        t = sound()
        at = t
        for p in path[:-1]:
            at = at[p]
        at[path[-1]] = to
        return t

    last = ("trajectory", "calls", 1, "response")
    yield "sound", sound(), []
    for k in PATHS:
        yield f"no-{k}", {x: v for x, v in sound().items() if x != k}, [f"FILE_MISSING:{k}"]
        if k not in ("exchanges", "events", "session"):
            yield f"list-{k}", {**sound(), k: [1]}, [f"FILE_UNREADABLE:{k}"]
    yield "bytes", {**sound(), "session": b"\xff"}, ["FILE_UNREADABLE:session"]
    yield "line", {**sound(), "events": b'{"a":1}\n\n[1]\n'}, ["FILE_UNREADABLE:events"]
    yield "blank", {**sound(), "steps": b""}, ["FILE_UNREADABLE:steps"]
    yield "failed", changed("result", "exception_info", to={"exception_type": "X"}), ["TRIAL_NOT_COMPLETED"]
    yield "open", changed("result", "finished_at", to=None), ["TRIAL_NOT_COMPLETED"]
    yield "graded", changed("result", "verifier_result", "rewards", to={"task": 1}), ["GRADER_PRESENT"]
    yield "schema", changed("trajectory", "schema_version", to="v2"), ["TRAJECTORY_SCHEMA_INVALID"]
    yield "input", changed("task", "instruction", to="other"), ["CAPTURE_BINDING_MISMATCH:task"]
    yield "calls", changed("exchanges", to=[{"n": 1}]), ["CAPTURE_BINDING_MISMATCH:calls"]
    yield "files", changed("manifest", "files", to=[]), ["CAPTURE_BINDING_MISMATCH:files"]
    yield "result", changed("trajectory", "calls", 1, "request", "messages", to=[]), ["TOOL_RESULT_MISSING:t1"]
    yield "again", changed("trajectory", "calls", 0, "response", "content", to=[{"type": "tool_use", "id": "t1"}] * 2), ["TOOL_CALL_ID_INVALID"]
    yield "cut", changed(*last, "stop_reason", to="max_tokens"), ["FINAL_RESPONSE_TRUNCATED"]
    yield "pending", changed(*last, "content", to=[{"type": "text", "text": "x"}, {"type": "tool_use", "id": "t2"}]), ["TOOL_RESULT_MISSING:t2", "FINAL_RESPONSE_PENDING_TOOL"]
    yield "paused", changed(*last, "stop_reason", to="pause_turn"), ["FINAL_RESPONSE_INCOMPLETE"]
    yield "empty", changed(*last, "content", to=[{"type": "text", "text": " \n"}]), ["FINAL_RESPONSE_EMPTY"]
    none = copy.deepcopy(sound())
    none["trajectory"]["calls"], none["exchanges"] = [], []
    yield "none", none, ["MODEL_CALLS_MISSING"]


def raw(kind, value):
    if isinstance(value, bytes):
        return value
    return b"".join(json.dumps(x).encode() + b"\n" for x in value) if kind in LAYOUT.logs and isinstance(value, list) else json.dumps(value).encode()


def test_each_fault_has_its_code(spark, tmp_path):
    want, hashes = {}, {}
    for name, files, codes in cases():
        want[name] = codes
        for kind, value in files.items():
            path = tmp_path / name / PATHS[kind]
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(raw(kind, value))
            hashes[name, kind] = hashlib.sha256(raw(kind, value)).hexdigest()
        (tmp_path / name / "agent" / "other.log").write_text("not looked at")
    (tmp_path / "stray.json").write_text("{}")
    found = trials.trials(trials.evidence_files(spark, str(tmp_path), LAYOUT), LAYOUT)
    got = {r.trial: r for r in trials.trial_report(found, LAYOUT).collect()}
    assert {n: r.codes for n, r in got.items()} == want
    assert {(n, k): h for n, r in got.items() for k, h in r.receipt.items()} == hashes
    r = got["sound"]
    assert (r.answer, r.model, r.stop_reason, r.tool_calls, r.completed) == ("done\ndone", "m", "end_turn", 1, True) and not got["cut"].completed
    files = {"a.py": "1", "b/c": "2"}
    tasks = spark.createDataFrame([("sound", "do it\n", files), ("schema", "do that", {"a.py": "1"}), ("gone", "x", {})], "trial string, instruction string, files map<string,string>")
    told = {r.trial: r.codes for r in trials.trial_report(found, LAYOUT, tasks).collect()}
    assert told["sound"] == [] and told["gone"] == ["TRIAL_MISSING"] and told["cut"] == ["FINAL_RESPONSE_TRUNCATED", "TASK_UNKNOWN"]
    assert told["schema"] == ["TRAJECTORY_SCHEMA_INVALID", "TASK_INSTRUCTION_MISMATCH", "INITIAL_WORKSPACE_MISMATCH"]


def test_bundles_hold_what_folders_hold(spark, tmp_path):
    rows = [(f"{name}/{PATHS[kind]}", raw(kind, value)) for name, files, _ in cases() for kind, value in files.items()] + [("stray.json", b"{}"), ("sound/agent/other.log", b"")]
    trials.bundled(spark.createDataFrame(rows, "file string, content binary").coalesce(1), f"{tmp_path}/bundles")
    found = trials.trials(trials.bundled_evidence(spark, f"{tmp_path}/bundles", LAYOUT), LAYOUT)
    got = {r.trial: (r.codes, len(r.receipt)) for r in trials.trial_report(found, LAYOUT).collect()}
    assert got == {name: (codes, len(files)) for name, files, codes in cases()}


def test_trials_share_files(spark):
    from sessionlake.plans import QUERIES

    data = "/root/testdata/sf0.001"
    report = QUERIES["trial_reports"](spark, data)
    assert len(report.inputFiles()) < spark.read.parquet(f"{data}/supplier.parquet").count()
    assert report.count() == spark.read.parquet(f"{data}/supplier.parquet").count()
