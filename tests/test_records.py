"""Captured records against their own bytes: what the driver's tables cannot exercise."""

import base64
import hashlib
import json

from sessionlake.streaming import records

EXCHANGE = "exchange_id string, status int, complete boolean, streaming boolean, event_count long, message string, raw_base64 string, raw_sha256 string, raw_size_bytes long"
FRAME = "exchange_id string, sequence long, event string, id string, data string, raw_base64 string, raw_sha256 string, raw_size_bytes long"


def body(raw):
    return base64.b64encode(raw).decode(), hashlib.sha256(raw).hexdigest(), len(raw)


def events():
    yield {"type": "message_start", "message": {"model": "m", "usage": {"input_tokens": 3}}}
    yield {"type": "content_block_start", "index": 0, "content_block": {"type": "thinking", "thinking": ""}}
    yield {"type": "content_block_delta", "index": 0, "delta": {"type": "thinking_delta", "thinking": "hm"}}
    yield {"type": "content_block_delta", "index": 0, "delta": {"type": "signature_delta", "signature": "s"}}
    yield {"type": "content_block_start", "index": 1, "content_block": {"type": "tool_use", "id": "t"}}
    yield {"type": "content_block_delta", "index": 1, "delta": {"type": "input_json_delta", "partial_json": '{"b": 1,'}}
    yield {"type": "content_block_delta", "index": 1, "delta": {"type": "input_json_delta", "partial_json": ' "a": [2]}'}}
    yield {"type": "message_delta", "delta": {"stop_reason": "tool_use"}, "usage": {"output_tokens": 9}}
    yield {"type": "message_stop"}


MESSAGE = {"model": "m", "stop_reason": "tool_use", "usage": {"output_tokens": 9, "input_tokens": 3}, "content": [{"type": "thinking", "thinking": "hm", "signature": "s"}, {"type": "tool_use", "id": "t", "input": {"a": [2], "b": 1}}]}


def record(key, message=MESSAGE, **more):
    raws = [f"event: {e['type']}\ndata: {json.dumps(e)}\n\n".encode() for e in events()]
    frames = [[key, k, e["type"], None, json.dumps(e), *body(r)] for k, (e, r) in enumerate(zip(events(), raws))]
    names = [x.split()[0] for x in EXCHANGE.split(", ")]
    row = dict(zip(names, (key, 200, True, True, len(frames), json.dumps(message), *body(b"".join(raws)))))
    return [*({**row, **more}[n] for n in names)], frames


def test_each_disagreement_has_its_code(spark):
    rows, frames, want = [], [], {}

    def case(key, expected, change=None, **more):
        row, own = record(key, **more)
        if change:
            change(row, own)
        rows.append(row)
        frames.extend(own)
        want[key] = expected

    case("sound", [])
    case("whole", [(None, "COMPLETE_MISMATCH", "")], complete=None)
    case("base64", [(None, "BODY_BASE64_INVALID", ""), (None, "BODY_FRAME_COUNT", ""), (None, "STOP_MISSING", ""), (None, "COMPLETE_MISMATCH", ""), (0, "BLOCK_MISMATCH", "type"), (0, "BLOCK_MISMATCH", "thinking"), (0, "BLOCK_MISMATCH", "signature"), (1, "BLOCK_MISMATCH", "type"), (1, "BLOCK_MISMATCH", "input"), *((None, "MESSAGE_MISMATCH", f) for f in ("model", "stop_reason", "input_tokens", "output_tokens"))], raw_base64="a=b")
    case("size", [(None, "BODY_SIZE_MISMATCH", "")], raw_size_bytes=1)
    case("hash", [(2, "FRAME_HASH_MISMATCH", "")], lambda row, own: own[2].__setitem__(6, "x"))
    case("frame", [(3, "FRAME_BASE64_INVALID", "")], lambda row, own: own[3].__setitem__(5, None))
    case("read", [(4, "FRAME_FIELD_MISMATCH", "id"), (4, "BODY_FRAME_MISMATCH", "id")], lambda row, own: own[4].__setitem__(3, "7"))
    case("number", [(None, "FRAME_SEQUENCE", "")], lambda row, own: own[8].__setitem__(1, 9))
    case("count", [(None, "FRAME_COUNT", "")], event_count=None)
    case("input", [(1, "BLOCK_MISMATCH", "input")], message={**MESSAGE, "content": [MESSAGE["content"][0], {"type": "tool_use", "input": {"a": [3], "b": 1}}]})
    case("short", [(1, "BLOCK_MISMATCH", "type"), (1, "BLOCK_MISMATCH", "input")], message={**MESSAGE, "content": MESSAGE["content"][:1]})
    case("usage", [(None, "MESSAGE_MISMATCH", "output_tokens")], message={**MESSAGE, "usage": {"input_tokens": 3}})
    case("plain", [], lambda row, own: own.clear(), streaming=False, event_count=0)
    rows.append(rows[0])
    want["sound"] = [(None, "EXCHANGE_REPEATED", "")]
    lost = record("lost")[1][:1]
    want["lost"] = [(None, "EXCHANGE_UNKNOWN", "")]
    e, f = spark.createDataFrame(rows, EXCHANGE), spark.createDataFrame([*frames, *lost, [None, 0, *[None] * 6]], FRAME)
    got = {}
    for r in records.record_errors(e, f).collect():
        got.setdefault(r.exchange_id, []).append((r.at, r.code, r.field))
    assert {k: sorted(v, key=repr) for k, v in got.items()} == {k: sorted(v, key=repr) for k, v in want.items() if v}
    assert records.record_errors(e.limit(0), f.limit(0)).count() == 0


def test_repeated_frames_are_read_alone(spark):
    (row, own), (_, other) = record("twice"), record("twice")
    other[0][2:5] = ["ping", "4", "{}"]
    other[0][5:] = body(b"event: ping\nid: 4\ndata: {}\n\n")
    found = records.record_errors(spark.createDataFrame([row], EXCHANGE), spark.createDataFrame([*own, other[0]], FRAME))
    assert not found.where("code = 'FRAME_FIELD_MISMATCH'").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan
