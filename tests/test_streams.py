"""Streams against batches: events framed with state over many triggers, ledgers, progress."""

import random

import pytest
from pyspark.sql import functions as F

from sessionlake.streaming import captures

RAW = {
    "a": b"event: message_start\ndata: {\"type\":\"message_start\"}\n\n: ping\n\ndata: {\"type\":\"content_block_start\",\"index\":0,\"content_block\":{\"type\":\"tool_use\"}}\r\n\r\nid: 7\ndata: {\"type\":\"content_block_delta\",\"index\":0,\"delta\":{\"type\":\"input_json_delta\",\"partial_json\":\"{\\\"x\\\":\"}}\n\n"
    b"data: {\"type\":\"content_block_delta\",\"index\":0,\"delta\":{\"type\":\"input_json_delta\",\"partial_json\":\"1}\"}}\n\nevent: message_stop\ndata: {}\n\n",
    "b": b"data: one\ndata: two\n\ndata: cut",
}


def chunks(size):
    rows = [(key, k, raw[k * size : (k + 1) * size], (k + 1) * size >= len(raw)) for key, raw in RAW.items() for k in range(-(-len(raw) // size))]
    return sorted(rows, key=lambda r: r[1])


SCHEMA = "exchange_id string, pos long, chunk binary, last boolean"


@pytest.mark.parametrize("size", [1, 3, 500])
def test_frames_do_not_depend_on_how_bytes_are_cut(spark, size):
    got = {(r.exchange_id, r.sequence): (r.event, r.id, r.data, r.unterminated) for r in captures.sse_events(spark.createDataFrame(chunks(size), SCHEMA)).collect()}
    assert got["b", 0] == (None, None, "one\ntwo", False) and got["b", 1] == (None, None, "cut", True) and len(got) == 8
    assert got["a", 0][0] == "message_start" and got["a", 1] == (None, None, None, False) and got["a", 3][1] == "7" and got["a", 5] == ("message_stop", None, "{}", False)


def test_a_stream_gives_the_events_and_messages_of_a_batch(spark, tmp_path):
    rows = chunks(10)
    for k in range(4):
        spark.createDataFrame(rows[len(rows) * k // 4 : len(rows) * (k + 1) // 4], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = captures.sse_events(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(180)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    got = spark.read.parquet(f"{tmp_path}/out")
    batch = captures.sse_events(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect())) or {tuple(map(str, r)) for r in got.collect()} == {tuple(map(str, r)) for r in batch.collect()}
    (block,) = captures.folded_blocks(got).where("exchange_id = 'a'").collect()
    assert (block.type, block.input, block.input_json_incomplete) == ("tool_use", '{"x":1}', None)
    assert {r.exchange_id: r.complete for r in captures.folded_messages(got).collect()} == {"a": True, "b": False}


def test_an_open_ledger_closes_later(spark, tmp_path):
    line = lambda event, k: (f'{{"schema_version":1,"event":"{event}","sandbox_id":"s{k}","create_operation_id":"o{k}"}}',)
    first, second = [line("create_requested", 1), line("created", 1), line("created", 2), ("no json",)], [line("killed", 1), line("create_requested", 3)]
    for k, rows in enumerate((first, second)):
        spark.createDataFrame(rows, "raw string").coalesce(1).write.text(f"{tmp_path}/in/{k}")
    batch = captures.open_entries(captures.ledger_entries(spark.createDataFrame(first + second, "raw string")))
    assert {(r.kind, r.id) for r in batch.collect()} == {("sandbox", "s2"), ("operation", "o3"), ("malformed", "no json")}
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_path}/in/*").select(F.col("value").alias("raw"))
    seen = []
    query = captures.open_entries(captures.ledger_entries(stream)).writeStream.outputMode("update").foreachBatch(lambda t, n: seen.append({(r.kind, r.id): r.open for r in t.collect()})).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    query.awaitTermination(180)
    last = {k: v for batch in seen for k, v in batch.items()}
    assert {k for k, open_ in last.items() if open_} == {("sandbox", "s2"), ("operation", "o3"), ("malformed", "no json")} and last["sandbox", "s1"] is False


def test_progress_keeps_the_last_update(spark, tmp_path):
    schema = "session_id long, at long, status string"
    for k, rows in enumerate(([(1, 1, "RUNNING"), (2, 1, "RUNNING")], [(1, 2, "DONE"), (3, 2, "RUNNING")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    captures.progress_snapshots(stream, f"{tmp_path}/snap", "session_id", "at", f"{tmp_path}/check").awaitTermination(180)
    assert {r.session_id: r.status for r in captures.snapshot(spark, f"{tmp_path}/snap", 1).collect()} == {1: "DONE", 2: "RUNNING", 3: "RUNNING"}


def test_a_batch_costs_its_rows_and_a_restart_changes_nothing(spark, tmp_path):
    from pathlib import Path

    schema, rng, last, count = "session_id long, at long, status string", random.Random(4), {}, 11
    sizes = [400] + [3] * (count - 1)
    folder = Path(tmp_path) / "snap"

    def feed(k):
        rows = [(key, rng.randrange(4), f"s{k}") for key in (range(400) if k == 0 else rng.sample(range(500), sizes[k]))]
        for key, at, status in rows:
            if key not in last or at >= last[key][0]:
                last[key] = (at, status)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        query = captures.progress_snapshots(stream, str(folder), "session_id", "at", f"{tmp_path}/check")
        query.awaitTermination(180)
        assert query.exception() is None

    for k in range(count):
        feed(k)
        if k in (4, 10):
            run()  # stopped and started again in between
    got = {r.session_id: (r["at"], r.status) for r in captures.snapshot(spark, str(folder), count - 1).collect()}
    assert got == last
    held = {tuple(map(int, p.name.split("-"))) for p in folder.iterdir() if p.is_dir()}
    assert set(captures._runs(count)) <= held and len(held) <= len(captures._runs(count)) + 2 * captures.FAN_OUT
    small = [spark.read.parquet(str(folder / f"{a}-{b}-{c}")).count() for a, b, c in captures._runs(count) if b >= 8]
    assert small and max(small) <= 3 * captures.FAN_OUT


@pytest.mark.parametrize("batches", [1, 4, 5, 16, 23, 64])
def test_runs_hold_each_batch_once(batches):
    runs = captures._runs(batches)
    assert [x for _, a, b in runs for x in range(a, b)] == list(range(batches))


def test_a_batch_needs_no_call_for_each_response(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [*chunks(4), (None, 1, b"\n\ndata: y", True), (None, 0, b"data: x", None), (None, None, None, None), ("c", 0, b"data: open", False)]
        events = captures.sse_events(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert "FlatMapGroupsInPandas" not in events._jdf.queryExecution().executedPlan().toString()
        got = {(r.exchange_id, r.sequence): (r.data, r.raw_size, r.unterminated) for r in events.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(key, r.sequence): (r.data, r.raw_size, r.unterminated) for key in RAW for r in captures.sse_events(spark.createDataFrame([(key, 0, RAW[key], True)], SCHEMA)).collect()}
    assert got == {**want, (None, 0): ("x", 7, False), (None, 1): ("y", 7, True)}
