"""Messages of sessions: their text, what users asked, evidence of calls, the final reply.

A message is a row (session, pos, role, content); content is JSON text: a string, a list of blocks or an object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions.values import json_value
from sessionlake.operators.sessions import numbered_spans

# Blocks that are text, statuses of failed calls, how failed results begin, names of calls that write or list.
TEXT_TYPES = ["text", "input_text", "output_text"]
FAILED = ["error", "failed", "failure", "cancelled", "timeout", "cleared"]
ERROR_STARTS = ["error:", "file not found:", "command failed", "traceback", "<tool_use_error>", "[tool result content cleared]"]
ERROR_WORDS = ["error", "traceback", "exception", "failed"]
LISTINGS = ["ls", "dir", "glob", "grep", "rg", "find", "list_dir", "get-childitem"]
WRITES = ["write", "write_file", "write_text", "edit", "str_replace", "create_file", "apply_patch"]


def stripped(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _string(v: Column, path: str = "$") -> Column:
    """The JSON string at a path; null for anything else."""
    inner = F.try_variant_get(v, path, "variant")
    return F.when(_kind(inner) == "STRING", F.try_variant_get(v, path, "string"))


def _first_string(v: Column, one: str, other: str) -> Column:
    """The string in field `one`, that in `other` where `one` is missing, null, empty, zero or false."""
    inner = F.try_variant_get(v, f"$.{one}", "variant")
    nothing = F.coalesce(F.to_json(inner).isin("null", '""', "false", "0", "[]", "{}"), F.lit(True))
    return F.when(nothing, _string(v, f"$.{other}")).otherwise(_string(v, f"$.{one}"))


def message_text(content: Column) -> Column:
    """A message's text: a string, the texts of a list's blocks in a row, or an object's value; empty, never null, without any."""
    v = F.try_parse_json(content)
    block = lambda x: F.coalesce(_string(x), F.when(_kind(x).startswith("OBJECT"), _first_string(x, "text", "value")), F.lit(""))
    blocks = F.array_join(F.transform(F.try_variant_get(v, "$", "array<variant>"), block), "")
    text = F.when(_kind(v) == "STRING", _string(v)).when(_kind(v).startswith("ARRAY"), blocks).when(_kind(v).startswith("OBJECT"), _first_string(v, "value", "text"))
    return F.coalesce(stripped(text), F.lit(""))


def indexed_messages(sessions: DataFrame, session: str = "session_id", raw: str = "raw") -> DataFrame:
    """(session, pos, role, content, message) of sessions as JSON text: a row for each of `messages`; other sessions give none."""
    messages = F.try_variant_get(F.try_parse_json(F.col(raw)), "$.messages", "array<variant>")
    each = sessions.select(session, F.posexplode(messages).alias("pos", "v"))
    content = F.to_json(F.try_variant_get("v", "$.content", "variant"))
    return each.select(session, "pos", _string(F.col("v"), "$.role").alias("role"), content.alias("content"), F.to_json("v").alias("message"))


def result_blocks(messages: DataFrame, session: str = "session_id", pos: str = "pos", content: str = "content") -> DataFrame:
    """(session, pos, index, text) of each slot of a message's content; white space is kept, slots that are no text have null."""
    v = F.try_parse_json(F.col(content))
    slots = F.when(_kind(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(F.to_json(v) != "null", F.array(v))
    each = messages.select(session, pos, F.posexplode(slots).alias("index", "v"))
    kind = F.try_variant_get("v", "$.type", "variant")
    textual = kind.isNull() | (F.to_json(kind) == "null") | F.try_variant_get("v", "$.type", "string").isin(TEXT_TYPES)
    fields = F.when(_kind(F.col("v")).startswith("OBJECT") & textual, F.coalesce(_string(F.col("v"), "$.text"), _string(F.col("v"), "$.value")))
    return each.select(session, pos, "index", F.coalesce(_string(F.col("v")), fields).alias("text"))


def user_records(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role", text: str = "text") -> DataFrame:
    """(session, id, message_index, text) of user messages that say anything."""
    found = messages.where(F.col(role) == "user").select(session, F.concat(F.lit("user:"), F.col(pos)).alias("id"), F.col(pos).alias("message_index"), stripped(F.col(text)).alias("text"))
    return found.where("text <> ''")


def task_user_records(tasks: DataFrame, messages: DataFrame, session: str = "session_id", task: str = "task_id") -> DataFrame:
    """(session, task, id, message_index, text): the user messages that a task names in message_indices, each once; its user_texts if there are none."""
    named = tasks.select(session, task, F.explode("message_indices").alias("message_index")).distinct()
    found = named.join(user_records(messages, session), [session, "message_index"]).select(session, task, "id", "message_index", "text")
    bare = tasks.join(found.select(session, task).distinct(), [session, task], "left_anti")
    texts = F.filter(F.transform("user_texts", stripped), lambda x: x != "")
    other = bare.select(session, task, F.posexplode(texts).alias("k", "text"))
    return found.union(other.select(session, task, F.concat(F.lit("user:task:"), F.col("k")), F.lit(None).cast(found.schema["message_index"].dataType), "text"))


def shared_context(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role") -> DataFrame:
    """The messages before a session's first user message."""
    return numbered_spans(messages, session, pos, role).where("span_no = 0").drop("span_no")


def span_ids(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role", message: str = "message") -> DataFrame:
    """(session, span_no, span_id): a hash of where a request's messages begin and end and of their JSON texts (keys sorted)."""
    spans = numbered_spans(messages, session, pos, role).where("span_no > 0").groupBy(session, "span_no")
    sums = spans.agg(F.min(pos).alias("start"), (F.max(pos) + 1).alias("end"), F.sort_array(F.collect_list(F.struct(pos, message)))[message].alias("texts"))
    whole = F.concat(F.lit('{"end": '), F.col("end"), F.lit(', "messages": ['), F.array_join("texts", ", "), F.lit('], "start": '), F.col("start"), F.lit("}"))
    return sums.select(session, "span_no", F.concat(F.lit("span_"), F.substring(F.sha2(F.encode(whole, "UTF-8"), 256), 1, 16)).alias("span_id"))


def timeline_evidence(events: DataFrame, session: str = "session_id", pos: str = "pos", call_id: str = "call_id", pending: str = "pending") -> DataFrame:
    """The calls that returned, with evidence_ref_id: the call's id, `timeline:` and its position without one, `@` and the position added to repeats."""
    known = events.where(~F.coalesce(F.col(pending), F.lit(False)))
    ref = F.coalesce(F.nullif(F.col(call_id).cast("string"), F.lit("")), F.concat(F.lit("timeline:"), F.col(pos)))
    again = F.row_number().over(Window.partitionBy(session, "_ref").orderBy(pos)) > 1
    return known.withColumn("_ref", ref).withColumn("evidence_ref_id", F.when(again, F.concat("_ref", F.lit("@"), F.col(pos))).otherwise(F.col("_ref"))).drop("_ref")


def captured_evidence(events: DataFrame, pos: str = "pos", pending: str = "pending") -> DataFrame:
    """The calls that returned, with evidence_ref_id `captured:` and their position."""
    return events.where(~F.coalesce(F.col(pending), F.lit(False))).withColumn("evidence_ref_id", F.concat(F.lit("captured:"), F.col(pos)))


def canonical_evidence(evidence: DataFrame) -> DataFrame:
    """evidence_ref_id and source_id filled from evidence_id and event_id where they are null or empty."""
    fill = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), F.col(b), F.col(a))
    return evidence.withColumns({"evidence_ref_id": fill("evidence_ref_id", "evidence_id"), "source_id": fill("source_id", "event_id")})


def located_refs(evidence: DataFrame, session: str = "session_id", ref: str = "evidence_ref_id") -> DataFrame:
    """(session, ref) of the references that stand for one piece of evidence."""
    return evidence.where(F.coalesce(F.col(ref), F.lit("")) != "").groupBy(session, ref).count().where("count = 1").select(session, ref)


def usable_result(text: Column, status: Column, pending: Column, is_error: Column, cleared: Column) -> Column:
    """Whether a call's result tells of the environment: returned, not failed, and not beginning like an error."""
    start = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+", ""))
    begins = F.exists(F.array(*map(F.lit, ERROR_STARTS)), lambda x: F.startswith(start, x))
    flagged = F.coalesce(pending, F.lit(False)) | F.coalesce(is_error, F.lit(False)) | F.coalesce(cleared, F.lit(False))
    return ~(flagged | F.lower(F.coalesce(status, F.lit(""))).isin(FAILED) | begins)


def result_shape(name: Column, text: Column, pending: Column) -> Column:
    """pending, error, wrote, listed, empty, json or text: what kind of result a call gave."""
    low, key, bare = F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(name, F.lit(""))), stripped(F.coalesce(text, F.lit("")))
    is_json = F.substring(bare, 1, 1).isin("{", "[") & json_value(bare).isNotNull()
    shape = F.when(F.coalesce(pending, F.lit(False)), "pending").when(F.exists(F.array(*map(F.lit, ERROR_WORDS)), lambda x: F.contains(low, x)), "error")
    return shape.when(key.isin(WRITES), "wrote").when(key.isin(LISTINGS) | key.endswith("list_dir"), "listed").when(bare == "", "empty").when(is_json, "json").otherwise("text")


def final_responses(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role", text: str = "text") -> DataFrame:
    """(session, status, message_index, response): the last of assistant, tool and user messages must be an assistant's with text."""
    turn = F.when(F.col(role).isin("assistant", "tool", "user"), F.col(pos))
    last = messages.groupBy(session).agg(F.max_by(F.struct(F.col(role).alias("role"), F.col(pos).alias("pos"), F.col(text).alias("text")), turn).alias("m"))
    blank = F.coalesce(stripped(F.col("m.text")), F.lit("")) == ""
    status = F.when(F.col("m").isNull(), "FINAL_RESPONSE_MISSING").when(F.col("m.role") != "assistant", "FINAL_RESPONSE_NOT_TERMINAL").when(blank, "FINAL_RESPONSE_MISSING").otherwise("OK")
    kept = lambda c: F.when(F.col("status") == "OK", F.col(c))
    return last.withColumn("status", status).select(session, "status", kept("m.pos").alias("message_index"), kept("m.text").alias("response"))


def normalized_task(task: Column, least: int = 40) -> Column:
    """A task's text with each run of white space as one space; null where that is shorter than `least`."""
    text = F.regexp_replace(stripped(task), r"(?U)\s+", " ")
    return F.when(F.char_length(text) >= least, text)


def distinct_tasks(tasks: DataFrame, group: str, task: str = "task", pos: str = "pos", least: int = 40) -> DataFrame:
    """(group, pos, task): the normalised tasks of a group, of those that differ in case only the first."""
    known = tasks.select(group, pos, normalized_task(F.col(task), least).alias(task)).where(F.col(task).isNotNull())
    return known.groupBy(group, F.lower(task).alias("_low")).agg(F.min_by(F.struct(pos, task), pos).alias("t")).select(group, f"t.{pos}", f"t.{task}")


def text_window(text: Column, offset: Column, limit: Column, most: int = 8000) -> Column:
    """struct(chunk, total_chars, next_offset): so many characters from an offset on, `most` at most; next_offset is null at the end."""
    start, size = F.greatest(offset, F.lit(0)), F.greatest(F.lit(1), F.least(limit, F.lit(most)))
    total = F.char_length(text)
    end = F.least(start + size, total)
    return F.struct(F.substring(text, start + 1, size).alias("chunk"), total.alias("total_chars"), F.when(end < total, end).alias("next_offset"))


def segmentation_errors(assignments: DataFrame, spans: DataFrame, session: str = "session_id", span: str = "span_id", task: str = "task_no") -> DataFrame:
    """(session, code, span): what keeps an assignment of spans to tasks, or with a null task to the context, from covering each span once.

    UNKNOWN_SPAN and UNKNOWN_CONTEXT_SPAN for each assignment of a span that isn't there, SPAN_OVERLAP for each further
    one of a span to a task, SPAN_OVERLAP_CONTEXT where it is context too, UNASSIGNED_SPAN for spans left out.
    """
    known = spans.select(session, span).distinct().withColumns({"known": F.lit(1), "in_task": F.lit(0), "in_context": F.lit(0)})
    given = assignments.select(session, span, F.lit(0).alias("known"), F.col(task).isNotNull().cast("int").alias("in_task"), F.col(task).isNull().cast("int").alias("in_context"))
    sums = known.union(given).groupBy(session, span).agg(*(F.sum(c).alias(c) for c in ("known", "in_task", "in_context")))
    repeat = lambda code, n: F.array_repeat(F.lit(code), F.greatest(n, F.lit(0)).cast("int"))
    absent = F.when(F.col("known") == 0, 1).otherwise(0)
    context_overlaps = F.when(F.col("in_task") > 0, F.col("in_context")).otherwise(F.col("in_context") - 1)
    codes = F.concat(
        repeat("UNKNOWN_SPAN", absent * F.col("in_task")), repeat("UNKNOWN_CONTEXT_SPAN", absent * F.col("in_context")), repeat("SPAN_OVERLAP", F.col("in_task") - 1),
        repeat("SPAN_OVERLAP_CONTEXT", context_overlaps), repeat("UNASSIGNED_SPAN", F.when(F.col("in_task") + F.col("in_context") == 0, 1).otherwise(0)),
    )
    return sums.select(session, F.explode(codes).alias("code"), span)


def evidence_scope_errors(evidence: DataFrame, assignments: DataFrame, users: DataFrame, session: str = "session_id", task: str = "task_no", span: str = "span_id", index: str = "message_index") -> DataFrame:
    """(session, task, code): tasks whose evidence names a message that is no user message of their spans, or that have such messages and name none."""
    own = assignments.where(F.col(task).isNotNull()).join(users.select(session, span, index), [session, span]).select(session, task, index).distinct().withColumn("_own", F.lit(1))
    named = evidence.select(session, task, index).distinct().withColumn("_named", F.lit(1))
    sums = own.join(named, [session, task, index], "full").groupBy(session, task)
    both = sums.agg(F.count_if(F.col("_own").isNull()).alias("outside"), F.count("_own").alias("own"), F.count("_named").alias("named"))
    return both.where("outside > 0 or own > 0 and named = 0").select(session, task, F.lit("EVIDENCE_SCOPE_MISMATCH").alias("code"))


def obligation_errors(obligations: DataFrame, known: DataFrame, task: str = "task_id", pos: str = "pos", key: str = "id", text: str = "text", refs: str = "refs", ref: str = "ref") -> DataFrame:
    """(task, pos, code) of obligations (task, pos, key, text, refs array): no or a repeated key, no text, no or unknown evidence; known holds (task, ref)."""
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    again = F.row_number().over(Window.partitionBy(task, key).orderBy(pos)) > 1
    unknown = obligations.select(task, pos, F.explode(refs).alias(ref)).join(known.select(task, ref).distinct(), [task, ref], "left_anti").select(F.col(task).alias("_t"), F.col(pos).alias("_p")).distinct()
    marked = obligations.withColumn("_bad", blank(key) | again).join(unknown, (F.col(task) == F.col("_t")) & (F.col(pos) == F.col("_p")), "left")
    no_ref = F.col("_p").isNotNull() | (F.coalesce(F.size(refs), F.lit(-1)) <= 0)
    codes = F.when(F.col("_bad"), F.array(F.lit("OBLIGATION_ID_INVALID"))).otherwise(F.array_compact(F.array(F.when(blank(text), "OBLIGATION_TEXT_REQUIRED"), F.when(no_ref, "OBLIGATION_EVIDENCE_REQUIRED"))))
    return marked.select(task, pos, F.explode(codes).alias("code"))
