"""Trials as folders, or many of them in bundles: each kind of evidence file is found by its place, checked, and one row a trial holds them all.

Layouts belong to the harness that ran the trials, so places are patterns that the caller gives. A file is a row until
its kind is known; a trial's row holds the texts of its JSON files and, of logs, only what is counted in them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions.values import json_value
from sessionlake.sources.session_files import below, decoded, listed_files

# Why a model stopped that was cut off, and that it had more to say.
CUT_OFF, UNFINISHED = ("max_tokens", "length", "model_context_window_exceeded"), ("pause_turn", "tool_use")


@dataclass(frozen=True)
class Layout:
    """Where a trial's files are: patterns of whole paths below its folder. `objects` hold one JSON object, `logs` one a line.

    The kinds `result`, `trajectory`, `task` and `manifest` among the objects and `exchanges` among the logs are bound to
    each other; any others are only read. schema is what the trajectory says of itself.
    """

    objects: dict[str, str]
    logs: dict[str, str] = field(default_factory=dict)
    schema: str | None = None


def _is(v: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit(kind)), F.lit(False))


def _items(v: Column, path: str) -> Column:
    return F.when(_is(v, path, "ARRAY"), F.try_variant_get(v, path, "array<variant>")).otherwise(F.array().cast("array<variant>"))


def _string(v: Column, path: str) -> Column:
    return F.when(_is(v, path, "STRING"), F.try_variant_get(v, path, "string"))


def evidence_files(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    """evidence() of the files of trials <folder>/<trial>/...; Spark's readers pass over empty files: what is listed and not read is one.

    Each file is listed and opened for itself, which costs more than what is in it: many trials are better kept in bundles.
    """
    read = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(folder).select(below(folder, "path").alias("file"), "content")
    listed = listed_files(spark, folder).select(below(folder, decoded("path")).alias("file"))
    return evidence(listed.join(read, "file", "left").withColumn("content", F.coalesce("content", F.lit(b""))), layout)


def bundled(files: DataFrame, folder: str) -> None:
    """Writes files (file: <trial>/<path>, content) as bundles, Parquet files that hold many trials each."""
    files.select("file", "content").write.parquet(folder)


def bundled_evidence(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    """evidence() of the trials in a folder of bundles."""
    return evidence(spark.read.schema("file string, content binary").parquet(folder), layout)


def evidence(files: DataFrame, layout: Layout) -> DataFrame:
    """(trial, kind, sha256, readable, records, value) of all files (file: <trial>/<path>, content) that the layout knows.

    readable tells whether an object file holds one JSON object, or each line of a log that isn't blank does; records
    counts these lines. value is an object's text. An empty file is unreadable as an object and a log of no records. Of
    several files of a kind and trial the first by path counts.
    """
    inside = F.regexp_replace("file", "^[^/]+/", "")
    kind = F.coalesce(*(F.when(inside.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in {**layout.objects, **layout.logs}.items()))
    known = files.withColumn("kind", kind).where("kind is not null and file like '%/%'").select(F.substring_index("file", "/", 1).alias("trial"), "kind", "file", "content")
    one = known.groupBy("trial", "kind").agg(F.min_by("content", "file").alias("content"))
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s", " ")) != "")
    is_object = lambda t: _is(json_value(t), "$", "OBJECT")
    is_log = F.col("kind").isin(*layout.logs) if layout.logs else F.lit(False)
    readable = F.when(is_log, text.isNotNull() & F.forall(lines, is_object)).otherwise(text.isNotNull() & is_object(text))
    return one.select("trial", "kind", F.sha2("content", 256).alias("sha256"), F.coalesce(readable, F.lit(False)).alias("readable"), F.when(is_log, F.size(lines)).cast("long").alias("records"), F.when(~is_log, text).alias("value"))


def trials(files: DataFrame, layout: Layout) -> DataFrame:
    """A row for each trial of evidence_files(): trial, a struct (sha256, readable, records, value) of each kind, null where it has no such file, and receipt, a map of kinds to hashes."""
    held = F.struct("sha256", "readable", "records", "value")
    kinds = [*layout.objects, *layout.logs]
    receipt = F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "sha256")))).alias("receipt")
    return files.groupBy("trial").agg(*(F.max(F.when(F.col("kind") == k, held)).alias(k) for k in kinds), receipt)


def _spoken(content: Column) -> Column:
    texts = F.filter(F.transform(content, lambda b: F.when(_string(b, "$.type") == "text", _string(b, "$.text"))), lambda t: t.isNotNull())
    return F.array_join(texts, "\n")


def trial_report(found: DataFrame, layout: Layout, tasks: DataFrame | None = None) -> DataFrame:
    """(trial, answer, model, stop_reason, tool_calls, receipt, codes, completed) of trials(): what a trial's files say, and all that speaks against it.

    Codes, in this order: FILE_MISSING:kind and FILE_UNREADABLE:kind; TRIAL_NOT_COMPLETED (an exception, or no end), GRADER_PRESENT
    (rewards although nobody assessed it), TRAJECTORY_SCHEMA_INVALID, CAPTURE_BINDING_MISMATCH:task, :calls and :files (the trajectory
    tells of another task input, number of exchanges or first workspace than the files), MODEL_CALLS_MISSING, TOOL_CALL_ID_INVALID (none or
    repeated), TOOL_RESULT_MISSING:id, and of the last reply FINAL_RESPONSE_TRUNCATED, _PENDING_TOOL, _INCOMPLETE and _EMPTY.
    With tasks (trial, instruction, files map of paths to hashes) also TASK_UNKNOWN, TASK_INSTRUCTION_MISMATCH and INITIAL_WORKSPACE_MISMATCH,
    and tasks without a folder come with TRIAL_MISSING. A kind that the layout lacks, or cannot be read, is bound to nothing.
    """
    parsed = {k: json_value(F.when(F.col(f"{k}.readable"), F.col(f"{k}.value"))) if k in layout.objects else F.lit(None).cast("variant") for k in ("result", "trajectory", "task", "manifest")}
    rows = found.withColumns({f"_{k}": v for k, v in parsed.items()})
    result, full, task, manifest = (F.col(f"_{k}") for k in parsed)
    calls = _items(full, "$.calls")
    uses = lambda c: F.transform(F.filter(_items(c, "$.response.content"), lambda b: _string(b, "$.type") == "tool_use"), lambda b: F.coalesce(_string(b, "$.id"), F.lit("")))
    results = lambda c: F.flatten(F.transform(_items(c, "$.request.messages"), lambda m: F.transform(F.filter(_items(m, "$.content"), lambda b: _string(b, "$.type") == "tool_result"), lambda b: F.coalesce(_string(b, "$.tool_use_id"), F.lit("")))))
    files_of = lambda v, path: F.transform(F.array_sort(F.transform(_items(v, path), lambda f: F.concat_ws("\0", F.coalesce(_string(f, "$.path"), F.lit("")), F.coalesce(_string(f, "$.sha256"), F.lit(""))))), lambda x: x)
    rows = rows.withColumns({"_calls": F.size(calls), "_used": F.flatten(F.transform(calls, uses)), "_given": F.flatten(F.transform(calls, results)), "_last": F.try_element_at(calls, F.lit(-1)), "_files": files_of(full, "$.task_input.workspace.files"), "_listed": files_of(manifest, "$.files")})
    last = F.col("_last")
    content, stop = _items(last, "$.response.content"), _string(last, "$.response.stop_reason")
    rows = rows.withColumns({"answer": F.coalesce(_spoken(content), F.lit("")), "stop_reason": stop, "_pending": F.exists(content, lambda b: _string(b, "$.type") == "tool_use")})
    code = lambda condition, name: F.when(F.coalesce(condition, F.lit(False)), F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    kinds = [*layout.objects, *layout.logs]
    codes = [code(F.col(k).isNull(), f"FILE_MISSING:{k}") for k in kinds] + [code(~F.col(f"{k}.readable"), f"FILE_UNREADABLE:{k}") for k in kinds]
    something = lambda v, p: ~(F.try_variant_get(v, p, "variant").isNull() | _is(v, p, "VOID") | F.to_json(F.try_variant_get(v, p, "variant")).isin("{}", "[]", '""', "false", "0"))
    codes += [code(result.isNotNull() & (something(result, "$.exception_info") | ~something(result, "$.finished_at")), "TRIAL_NOT_COMPLETED"), code(something(result, "$.verifier_result.rewards"), "GRADER_PRESENT")]
    if layout.schema is not None:
        codes.append(code(full.isNotNull() & ~_string(full, "$.schema_version").eqNullSafe(F.lit(layout.schema)), "TRAJECTORY_SCHEMA_INVALID"))
    codes.append(code(full.isNotNull() & task.isNotNull() & ~F.to_json(F.try_variant_get(full, "$.task_input", "variant")).eqNullSafe(F.to_json(task)), "CAPTURE_BINDING_MISMATCH:task"))
    if "exchanges" in layout.logs:
        codes.append(code(full.isNotNull() & F.col("exchanges.readable") & (F.col("exchanges.records") != F.col("_calls")), "CAPTURE_BINDING_MISMATCH:calls"))
    codes += [
        code(full.isNotNull() & manifest.isNotNull() & (F.col("_files") != F.col("_listed")), "CAPTURE_BINDING_MISMATCH:files"), code(full.isNotNull() & (F.col("_calls") == 0), "MODEL_CALLS_MISSING"),
        code(F.array_contains("_used", "") | (F.size(F.array_distinct("_used")) < F.size("_used")), "TOOL_CALL_ID_INVALID"),
        F.transform(F.filter(F.array_except("_used", "_given"), lambda x: x != ""), lambda x: F.concat(F.lit("TOOL_RESULT_MISSING:"), x)),
        code(stop.isin(*CUT_OFF), "FINAL_RESPONSE_TRUNCATED"), code(F.col("_pending"), "FINAL_RESPONSE_PENDING_TOOL"), code(stop.isin(*UNFINISHED), "FINAL_RESPONSE_INCOMPLETE"),
        code((F.col("_calls") > 0) & (F.trim(F.regexp_replace("answer", r"(?U)\s", " ")) == ""), "FINAL_RESPONSE_EMPTY"),
    ]
    if tasks is not None:
        wanted = F.transform(F.array_sort(F.map_entries("_wanted")), lambda e: F.concat_ws("\0", e["key"], e["value"]))
        rows = rows.join(tasks.select("trial", F.col("instruction").alias("_instruction"), F.col("files").alias("_wanted"), F.lit(True).alias("_told")), "trial", "full_outer")
        told = F.col("_told") & full.isNotNull()
        codes = [code(F.col("receipt").isNull(), "TRIAL_MISSING"), *(F.when(F.col("receipt").isNotNull(), c).otherwise(F.array().cast("array<string>")) for c in codes)]
        codes += [code(F.col("_told").isNull(), "TASK_UNKNOWN"), code(told & ~_string(full, "$.task_input.instruction").eqNullSafe(F.col("_instruction")), "TASK_INSTRUCTION_MISMATCH"), code(told & (F.col("_files") != F.coalesce(wanted, F.array().cast("array<string>"))), "INITIAL_WORKSPACE_MISMATCH")]
    every = reduce(lambda a, b: F.concat(a, F.coalesce(b, F.array().cast("array<string>"))), codes, F.array().cast("array<string>"))
    return rows.withColumn("codes", every).select("trial", "answer", _string(full, "$.model").alias("model"), "stop_reason", F.size(F.array_distinct("_used")).alias("tool_calls"), "receipt", "codes", (F.size("codes") == 0).alias("completed"))
