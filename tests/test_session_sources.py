"""Sources as files: what counts as JSON, digests of whole files, empty files, odd names."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sessionlake.sources import session_files

LINES = [
    '{"messages":[]}', '{"messages":[],"messages":3}', '{"messages":3,"messages":[1]}', '{"messages":3,"messages":"[1]"}', '{"messages":[NaN,Infinity,-Infinity]}', '{"messages":[INF]}', '{"messages":[+Infinity]}',
    '{"messages":[-INF]}', '{"messages":["INF +Infinity \\" INF"]}', '{"messages":[]} x', '{"messages":[]},{"messages":[]}', "[1]", '"s"', "3", "NaN", "null", "", " ", "{'messages':[]}", '{"messages":[01]}',
    '{"messages":["\t"]}', "{messages:[]}", '{"messages":[1,]}', '{"messages":[]}\r', "1],[2", '1},{"v":2', '{"messages":"[1]"}', '{"messages":"[1]","x":NaN}', '{"messages":null}', '{"a":{"messages":[]}}', '{"messages":[1e999]}',
    '{"messages":["\\ud800"]}', '{"messages":[-NaN]}', '{"messages":[.5]}', '{"messages":["\\x"]}', '﻿{"messages":[]}', '{"messages":[]} ', '{"messages":[]}//c', '{"messages":[123456789012345678901234567890]}', "[[NaN]]", '{"messages":{}}',
]


def told(raw):
    try:
        value = json.loads(raw)
    except (UnicodeDecodeError, json.JSONDecodeError):
        return "INVALID_JSON"
    return None if isinstance(value, dict) and isinstance(value.get("messages"), list) else "INVALID_SESSION"


def test_validity_is_that_of_a_lenient_parser(spark):
    t = spark.createDataFrame([(k, x) for k, x in enumerate(LINES)], "k int, raw string")
    got = {r.k: r.e for r in t.select("k", session_files.session_validity(F.col("raw")).alias("e")).collect()}
    assert {LINES[k]: e for k, e in got.items()} == {x: told(x.encode()) for x in LINES}


def test_bytes_that_are_no_text(spark, tmp_path):
    raw = b'{"messages":["\xff"]}\n{"messages":[]}\n\x80'
    (tmp_path / "a").write_bytes(raw)
    lines = session_files.file_lines(spark, str(tmp_path), str(tmp_path))
    got = {r.line_number: r for r in session_files.session_inventory(lines).collect()}
    assert [got[n].error for n in (1, 2, 3)] == ["INVALID_JSON", None, "INVALID_JSON"]
    assert [got[n].line_sha256 for n in (1, 2, 3)] == [hashlib.sha256(x).hexdigest() for x in raw.splitlines(keepends=True)]


@pytest.mark.parametrize("split", [3000, 1 << 20])
def test_a_source_s_digest_does_not_depend_on_its_splits(spark, tmp_path, split):
    files = {"a": b"".join(b'{"messages": [%d]}\n' % k for k in range(4000)) + b"tail", "b": b"\n\n", "c": b"", "d": b"x\r\n"}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        inventory = session_files.session_inventory(session_files.file_lines(spark, str(tmp_path), str(tmp_path)))
        declared = spark.createDataFrame([(n, x.count(b"\n") + (x[-1:] not in (b"", b"\n")), len(x), hashlib.sha256(x + b"!" * (n == "d")).hexdigest()) for n, x in files.items()], "source string, records long, bytes long, sha256 string")
        got = {r.source: (r.status, r.errors, r.sha256) for r in session_files.source_summary(inventory, declared).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {n: ("READY" if n != "d" else "PARTIAL_SOURCE", "" if n != "d" else "SOURCE_COVERAGE_MISMATCH:sha256", hashlib.sha256(x).hexdigest()) for n, x in files.items()}


def test_trees_hold_empty_files(spark, tmp_path):
    (tmp_path / "d e").mkdir()
    files = {"d e/x%20y": b"", "d e/a+b": b"1", "z": b"", "é": b"22"}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    found = session_files.tree_files(spark, str(tmp_path))
    assert {r.path: (r.sha256, r["size"]) for r in found.collect()} == {n: (hashlib.sha256(x).hexdigest(), len(x)) for n, x in files.items()}


def test_a_digest_goes_on_in_another_process():
    from sessionlake.sources.digests import Sha256

    data, state, got = bytes(range(256)) * 3, None, []
    for k in range(0, len(data), 77):
        running = Sha256(state)
        running.update(data[k : k + 77])
        state = running.state
        got.append(running.hexdigest())
    assert got == [hashlib.sha256(data[: k + 77]).hexdigest() for k in range(0, len(data), 77)]


@pytest.mark.parametrize("segment", [50, 1 << 20])
def test_a_long_file_is_digested_in_turns(spark, tmp_path, monkeypatch, segment):
    from sessionlake.sources import digests

    monkeypatch.setattr(digests, "SEGMENT", segment)
    monkeypatch.setattr(session_files, "WHOLE", 40)
    files = {"t/a": b"x" * 39 + b"\n", "t/b": b"", "t/c": b"".join(b"%d\n" % k for k in range(60)) + b"\xff", "t/d": b"\n\n", "u+/a b": b"\n" * 41, "u+/c": b"z" * 41, "v/é": b"", "w": b"\r\n" * 30}
    for name, raw in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        each = {r.path: (r.sha256, r["size"]) for r in session_files.tree_files(spark, str(tmp_path)).collect()}
        joined = {r.path: (r.sha256, r["size"]) for r in session_files.tree_files(spark, str(tmp_path), lambda path: F.substring_index(path, "/", 1)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    told = lambda x: (hashlib.sha256(x).hexdigest(), len(x))
    assert each == {n: told(x) for n, x in files.items()}
    tops = {n.split("/")[0] for n in files}
    assert joined == {t: told(b"".join(files[n] for n in sorted(files) if n.split("/")[0] == t)) for t in tops}


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_a_root_may_name_its_file_system(spark, tmp_path, prefix):
    (tmp_path / "d e").mkdir()
    (tmp_path / "d e" / "x").write_bytes(b"1")
    (tmp_path / "y").write_bytes(b"")
    found = session_files.tree_files(spark, f"{prefix}{tmp_path}")
    assert {r.path: r["size"] for r in found.collect()} == {"d e/x": 1, "y": 0}
