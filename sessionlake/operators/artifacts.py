"""Files against what was declared or collected of them, identifiers, captured bodies, rewards, and the checks of judgements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.messages import stripped
from sessionlake.sources.storage import stored


def _codes(*codes: Column) -> Column:
    return F.array_compact(F.array(*codes))


def _code(condition: Column, name: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(name))


def changed_files(before: DataFrame, after: DataFrame, group: str = "task_id", path: str = "path", sha256: str = "sha256") -> DataFrame:
    """(group, path, initial_sha256, final_sha256) of files that differ or are on one side only."""
    a, b = before.select(group, path, F.col(sha256).alias("initial_sha256")), after.select(group, path, F.col(sha256).alias("final_sha256"))
    return a.join(b, [group, path], "full").where(~F.col("initial_sha256").eqNullSafe(F.col("final_sha256")))


def manifest_errors(manifest: DataFrame, files: DataFrame, group: str = "trial_id", path: str = "path") -> DataFrame:
    """(group, path, code) of a manifest (group, path, size, sha256) against files: unsafe paths, files missing or not listed, other sizes or hashes."""
    listed = manifest.select(group, path, F.col("size").alias("_size"), F.col("sha256").alias("_sha"), F.lit(True).alias("_listed"))
    met = listed.join(files.select(group, path, "size", "sha256", F.lit(True).alias("_there")), [group, path], "full")
    # Codes, in this order.
    code = F.when(F.col("_listed").isNull(), "ARTIFACT_NOT_LISTED").when(F.startswith(path, F.lit("/")), "ARTIFACT_PATH_ABSOLUTE").when(F.array_contains(F.split(path, "/", -1), ".."), "ARTIFACT_PATH_TRAVERSAL")
    code = code.when(F.col("_there").isNull(), "ARTIFACT_FILE_MISSING").when(~F.col("_size").eqNullSafe(F.col("size")), "ARTIFACT_SIZE_MISMATCH").when(~F.col("_sha").eqNullSafe(F.col("sha256")), "ARTIFACT_HASH_MISMATCH")
    return met.withColumn("code", code).where("code is not null").select(group, path, "code")


def boundary_report(ids: DataFrame, session: str = "session_id", key: str = "id", boundaries: tuple[str, ...] = ("capture", "session", "final")) -> DataFrame:
    """(session, code, boundary, id) of ids (session, boundary, kind call or result, id) over boundaries that follow each other.

    MISSING_TOOL_RESULT and ORPHAN_TOOL_RESULT within a boundary, LEFT_ONLY and RIGHT_ONLY for calls of a boundary and
    the one before (named left:right). One grouping by id.
    """
    has = lambda b, k: F.max((F.col("boundary") == b) & (F.col("kind") == k))
    sums = ids.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").groupBy(session, key).agg(*(has(b, k).alias(f"{b}_{k}") for b in boundaries for k in ("call", "result")))
    found = [F.when(F.col(f"{b}_{x}") & ~F.col(f"{b}_{y}"), F.struct(F.lit(code).alias("code"), F.lit(b).alias("boundary"))) for b in boundaries for x, y, code in (("call", "result", "MISSING_TOOL_RESULT"), ("result", "call", "ORPHAN_TOOL_RESULT"))]
    found += [F.when(F.col(f"{x}_call") & ~F.col(f"{y}_call"), F.struct(F.lit(code).alias("code"), F.lit(f"{a}:{b}").alias("boundary"))) for a, b in zip(boundaries, boundaries[1:], strict=False) for x, y, code in ((a, b, "LEFT_ONLY"), (b, a, "RIGHT_ONLY"))]
    return sums.select(session, key, F.explode(_codes(*found)).alias("f")).select(session, "f.code", "f.boundary", key)


def repeated_ids(ids: DataFrame, session: str = "session_id", key: str = "id", pos: str = "pos") -> DataFrame:
    """(session, boundary, id, pos) of calls whose id a call of the boundary had before; results that are sent again are none."""
    calls = ids.where((F.col("kind") == "call") & (F.coalesce(F.col(key).cast("string"), F.lit("")) != ""))
    again = F.row_number().over(Window.partitionBy(session, "boundary", key).orderBy(pos)) > 1
    return calls.withColumn("_again", again).where("_again").select(session, "boundary", key, pos)


def harness_drift(calls: DataFrame, session: str = "session_id", pos: str = "pos") -> DataFrame:
    """(session, pos) of calls (system_sha256, tools_sha256, has_tools, uses_tools, complete) whose prompt or tools differ from the session's first; a complete last call without any tools is exempt."""
    ends = calls.groupBy(F.col(session).alias("_s")).agg(F.min_by(F.struct("system_sha256", "tools_sha256"), pos).alias("_first"), F.max(pos).alias("_last"))
    met = calls.join(ends, F.col(session) == F.col("_s"))
    exempt = (F.col(pos) == F.col("_last")) & ~F.col("has_tools") & ~F.col("uses_tools") & F.col("complete")
    same = F.col("system_sha256").eqNullSafe(F.col("_first.system_sha256")) & F.col("tools_sha256").eqNullSafe(F.col("_first.tools_sha256"))
    return met.where(~exempt & ~same).select(session, pos)


def paired_by_ordinal(left: DataFrame, right: DataFrame, group: str = "session_id", pos: str = "pos") -> DataFrame:
    """(group, ordinal from 0, left_pos, right_pos): the k-th row of one side with the k-th of the other, as far as the shorter goes."""
    numbered = lambda t, name: t.select(group, (F.row_number().over(Window.partitionBy(group).orderBy(pos)) - 1).alias("ordinal"), F.col(pos).alias(name))
    return numbered(left, "left_pos").join(numbered(right, "right_pos"), [group, "ordinal"])


def prompt_tokens(fresh: Column, created: Column, cached: Column) -> Column:
    """Input, cache creation and cache read tokens together; null if one is unknown."""
    return fresh + created + cached


def batch_status(results: DataFrame) -> DataFrame:
    """(status, sessions): how many sessions ended how; a null status is UNKNOWN."""
    return results.groupBy(F.coalesce("status", F.lit("UNKNOWN")).alias("status")).agg(F.count("*").alias("sessions"))


def selected_slice(rows: DataFrame, order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """The rows from an offset on in an order, `limit` at most if given; rows of equal order come in any.

    Without a limit rows are dealt out by ranges of the order, and a range's first number is the count of those before it.
    """
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("offset and limit must not be negative")
    if limit is not None:
        return rows.orderBy(*order).offset(offset).limit(limit)
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    # the number within a range is the lower 33 bits
    part = F.shiftright("_at", 33)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_part", before.alias("_before"))
    met = ranged.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return met.where(F.col("_before") + F.col("_at").bitwiseAND(F.lit(2**33 - 1)) >= offset).select(*rows.columns).orderBy(*order)


def seeded_choice(rows: DataFrame, group: str, key: str, seed: str) -> DataFrame:
    """(group, key): one row of each group, chosen by a hash of seed and key; the same for a seed, and even over keys."""
    draw = F.struct(F.sha2(F.encode(F.concat_ws(":", F.lit(seed), F.col(group), F.col(key)), "UTF-8"), 256), key)
    return rows.groupBy(group).agg(F.min_by(key, draw).alias(key))


def topic_cards(names: DataFrame, group: str = "task_id", kind: str = "kind", name: str = "name", caps: tuple[tuple[str, int], ...] = (("directories", 24), ("names", 40), ("topics", 20))) -> DataFrame:
    """(group, directories, names, topics): of each kind the first names in order, each once, as many as its cap."""
    once = names.select(group, kind, name).distinct()
    rank = once.withColumn("_k", F.row_number().over(Window.partitionBy(group, kind).orderBy(name)))
    return rank.groupBy(group).agg(*(F.sort_array(F.collect_list(F.when((F.col(kind) == k) & (F.col("_k") <= n), F.col(name)))).alias(k) for k, n in caps))


def diagnosis_coverage(checks: DataFrame, events: DataFrame, run: str = "run_id", statuses: tuple[str, ...] = ("PASS", "FAIL", "UNCLEAR", "NOT_RUN", "ERROR")) -> DataFrame:
    """(run, checked, a count for each status, event_count, event_coverage): coverage is the share of a run's different events that have evidence, by rows of events (run, event_id, evidence array)."""
    by_status = checks.groupBy(F.col(run).alias("_r")).agg(F.count("*").alias("_checked"), *(F.count_if(F.col("status") == s).alias(f"_{s.lower()}") for s in statuses))
    told = F.when(F.size("evidence") > 0, F.col("event_id"))
    covered = events.groupBy(run).agg(F.count("*").alias("event_count"), (F.count_distinct(told) / F.count("*")).alias("event_coverage"))
    met = covered.join(by_status, F.col(run) == F.col("_r"), "left")
    zero = lambda c: F.coalesce(f"_{c}", F.lit(0)).alias(c)
    return met.select(run, zero("checked"), *(zero(s.lower()) for s in statuses), "event_count", "event_coverage")


NUL = "\x00"


def record_id(dataset: Column, dataset_sha256: Column, line_number: Column, line_sha256: Column) -> Column:
    """The identity of a source record: SHA-256 of a version, the dataset, its hash, the line's number and hash, with NULs between."""
    return F.sha2(F.encode(F.concat_ws(NUL, F.lit("source-record-v1"), dataset, dataset_sha256, line_number.cast("string"), line_sha256), "UTF-8"), 256)


def stable_id(namespace: str, canonical_json: Column) -> Column:
    """SHA-256 of a namespace, a NUL and a canonical JSON text."""
    return F.sha2(F.encode(F.concat(F.lit(namespace + NUL), canonical_json), "UTF-8"), 256)


def raw_task_id(source_sha256: Column, span_ids: Column) -> Column:
    """`rawtask_` and 16 digits of the SHA-256 of a source's hash and an array of spans."""
    return F.concat(F.lit("rawtask_"), F.substring(F.sha2(F.encode(F.concat(source_sha256, F.lit("|"), F.array_join(span_ids, "|")), "UTF-8"), 256), 1, 16))


def blob_id(content: Column) -> Column:
    """The SHA-1 that version control gives a file's bytes."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(content).cast("string"), F.lit(NUL)), "UTF-8"), content.cast("binary")))


def media_kind(content: Column) -> Column:
    """image/jpeg, image/png or application/pdf by how bytes begin and end; null for anything else, for none and for more than 32,000,000 bytes."""
    # What such files begin and end with.
    at = lambda start, n: F.hex(F.substring(content, start, n))
    jpeg, png = (at(1, 3) == "FFD8FF") & (at(-2, 2) == "FFD9"), (at(1, 8) == "89504E470D0A1A0A") & (at(-12, 12) == "0000000049454E44AE426082")
    kind = F.when(jpeg, "image/jpeg").when(png, "image/png").when(at(1, 5) == "255044462D", "application/pdf")
    return F.when(F.octet_length(content).between(1, 32_000_000), kind)


def body_errors(bodies: DataFrame, key: str = "exchange_id") -> DataFrame:
    """(key, code) of captured bodies (key, raw_base64, raw_sha256, raw_size_bytes): not Base64, another size or another hash."""
    raw = F.when(F.col("raw_base64").rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"), F.unbase64("raw_base64"))
    code = F.when(raw.isNull(), "BODY_BASE64_INVALID").when(~F.col("raw_size_bytes").eqNullSafe(F.octet_length(raw)), "BODY_SIZE_MISMATCH").when(~F.col("raw_sha256").eqNullSafe(F.sha2(raw, 256)), "BODY_HASH_MISMATCH")
    return bodies.withColumn("code", code).where("code is not null").select(key, "code")


def reward_errors(trials: DataFrame, key: str = "trial_id") -> DataFrame:
    """(key, code) of trials (key, rewards map of numbers, verdict_status, verdict_schema, reason_code, has_details): the reward is exactly `task` in 0 to 1, and the verdict agrees with it."""
    values, task = F.map_values("rewards"), F.try_element_at("rewards", F.lit("task"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    none = F.coalesce(F.size("rewards"), F.lit(0)) <= 0
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    formal = ~F.coalesce(F.col("verdict_status").isin("TASK_PASS", "TASK_FAIL"), F.lit(False))
    # Codes, in this order.
    codes = _codes(
        _code(none, "REWARD_NOT_FLAT_OBJECT"), _code(~none & (F.array_sort(F.map_keys("rewards")) != F.array(F.lit("task"))), "REWARD_CRITERIA_MISMATCH"), _code(F.exists(values, lambda v: v.isNull()), "REWARD_NON_NUMERIC"),
        _code(F.exists(values, lambda v: v.isNotNull() & ~finite(v)), "REWARD_NON_FINITE"), _code(F.exists(values, lambda v: finite(v) & ~v.between(0, 1)), "REWARD_OUT_OF_RANGE"), _code(~none & task.isNull(), "REWARD_TASK_MISSING"),
        _code(blank("verdict_schema"), "VERDICT_SCHEMA_INVALID"), _code(formal, "VERDICT_STATUS_INVALID"), _code(~formal & task.isNotNull() & ((task >= 1.0) != (F.col("verdict_status") == "TASK_PASS")), "REWARD_VERDICT_MISMATCH"),
        _code(blank("reason_code"), "VERDICT_REASON_CODE_INVALID"), _code(~F.coalesce("has_details", F.lit(False)), "VERDICT_DETAILS_INVALID"),
    )
    return trials.select(key, F.explode(codes).alias("code"))


def rubric_errors(criteria: DataFrame, group: str = "rubric_id", pos: str = "pos") -> DataFrame:
    """(group, pos, code) of criteria (group, pos, id, weight, description, verifier), and with a null pos (group, WEIGHTS_NOT_ONE): weights add up to 1 within 1e-12."""
    again = F.row_number().over(Window.partitionBy(group, "id").orderBy(pos)) > 1
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    weight = F.col("weight").cast("double")
    unsafe = F.startswith("verifier", F.lit("/")) | F.array_contains(F.split("verifier", "/", -1), "..")
    codes = _codes(_code(~F.coalesce(F.col("id").rlike("^[A-Za-z0-9_.-]+$"), F.lit(False)) | again, "CRITERION_ID_INVALID"), _code(weight.isNull() | F.isnan(weight) | ~((weight > 0) & (weight <= 1)), "CRITERION_WEIGHT_INVALID"), _code(blank("description"), "CRITERION_DESCRIPTION_EMPTY"), _code(blank("verifier") | unsafe, "CRITERION_VERIFIER_UNSAFE"))
    own = criteria.withColumn("_codes", codes).select(group, pos, F.explode("_codes").alias("code"))
    sums = criteria.groupBy(group).agg(F.sum(weight).alias("w")).where(~F.coalesce(F.abs(F.col("w") - 1) <= 1e-12, F.lit(False)))
    return own.union(sums.select(group, F.lit(None).cast(criteria.schema[pos].dataType), F.lit("WEIGHTS_NOT_ONE")))


# What a judgement may say, and what it rates from 0 to 3.
OUTCOMES = ["SUCCESS", "FAILURE", "INCOMPLETE", "UNCERTAIN"]
DECISIONS = ["ELIGIBLE", "REVIEW", "DEFER", "REJECT"]
ROUTES = ["ELIGIBLE_CODE_FILE", "ELIGIBLE_RETRIEVAL", "NEEDS_MANUAL_REVIEW", "DEFERRED", "REJECTED"]
FAILURES = [
    "TASK_INTENT_MISALIGNMENT", "UNDERSPECIFIED_INTENT", "INVALID_TOOL_INVOCATION", "TOOL_OUTPUT_MISINTERPRETATION", "PLAN_EXECUTION_FAILURE", "ENVIRONMENT_CONTEXT_GAP", "STATE_MUTATION_FAILURE", "EXTERNAL_DEPENDENCY_FAILURE",
    "VERIFIER_OR_TERMINATION_FAILURE", "SYSTEM_FAILURE", "USER_INTERRUPTION", "INCONCLUSIVE",
]
LAYERS = ["TASK", "ENVIRONMENT", "SOLVER", "VERIFIER", "SYSTEM", "USER", "UNCLEAR"]
RECOVERABILITIES = ["HIGH", "MEDIUM", "LOW", "NOT_RECOVERABLE", "UNKNOWN"]
CHECK_KINDS, CHECK_RESULTS = ["STATIC", "DYNAMIC"], ["PASS", "FAIL", "UNCLEAR", "NOT_RUN", "ERROR"]
RATINGS = ["task_identifiability", "failure_evidence", "initial_environment_visibility", "environment_completion_value", "verifier_constructability", "episode_boundary_confidence", "privacy_processability", "estimated_cost"]


def _not_in(column: str, values: list[str]) -> Column:
    return ~F.coalesce(F.col(column).isin(values), F.lit(False))


def _not_share(column: Column) -> Column:
    return ~F.coalesce(column.cast("double").between(0, 1), F.lit(False))


def judgement_errors(judgements: DataFrame, refs: DataFrame, events: DataFrame, key: str = "report_id", work: str = "WORK") -> DataFrame:
    """judgements with errors array, status (COMPLETE or REVIEW) and final_decision: any error sends a judgement to review.

    Judgements hold outcome, decision, primary_failure, failure_layer, recoverability, needs (boolean), critical_step,
    critical_event_ids and evidence_ref_ids arrays, goal, ratings map, confidence; refs (key, ref) and events (key, event)
    are what they may refer to. `work` is the caller's word for what a failure may need, in the codes about `needs`.
    """
    c = F.col

    def strangers(array: str, known: DataFrame, name: str, mark: str) -> DataFrame:
        named = judgements.select(key, F.explode(array).alias(name)).join(known.select(key, name).distinct(), [key, name], "left_anti")
        return named.groupBy(F.col(key).alias(f"_{mark}")).agg(F.count("*").alias(f"_n{mark}"))

    met = judgements
    for array, known, name, mark in (("critical_event_ids", events, "event", "e"), ("evidence_ref_ids", refs, "ref", "r")):
        met = met.join(strangers(array, known, name, mark), F.col(key) == F.col(f"_{mark}"), "left")
    count = F.coalesce(F.size("evidence_ref_ids"), F.lit(0))
    located = F.greatest(count, F.lit(0)) > F.coalesce("_nr", F.lit(0))
    outcome, decision = F.when(_not_in("outcome", OUTCOMES), "UNCERTAIN").otherwise(c("outcome")), F.when(_not_in("decision", DECISIONS), "REVIEW").otherwise(c("decision"))
    failure = F.when(_not_in("primary_failure", FAILURES), "INCONCLUSIVE").otherwise(c("primary_failure"))
    unsure, success, lost = outcome == "UNCERTAIN", outcome == "SUCCESS", outcome.isin("FAILURE", "INCOMPLETE")
    eligible_without = lost & (decision == "ELIGIBLE") & ~c("needs").eqNullSafe(F.lit(True))
    rated = lambda r: F.try_element_at("ratings", F.lit(r))
    # Codes, in this order.
    errors = _codes(
        _code(_not_in("outcome", OUTCOMES), "OUTCOME_INVALID"), _code(_not_in("decision", DECISIONS), "DECISION_INVALID"), _code(_not_in("primary_failure", FAILURES), "PRIMARY_FAILURE_INVALID"),
        _code(_not_in("failure_layer", LAYERS), "FAILURE_LAYER_INVALID"), _code(_not_in("recoverability", RECOVERABILITIES), "RECOVERABILITY_INVALID"), _code(c("critical_step") < 0, "CRITICAL_STEP_INVALID"),
        _code(c("_ne") > 0, "UNKNOWN_CRITICAL_EVENT_ID"), _code(F.coalesce(stripped(c("goal")), F.lit("")) == "", "USER_INTENT_GOAL_MISSING"), _code(c("_nr") > 0, "UNKNOWN_EVIDENCE_REF"),
        _code((decision == "ELIGIBLE") & ~located, "ELIGIBLE_REQUIRES_EVIDENCE"), _code(lost & ~located, "NON_SUCCESS_REQUIRES_EVIDENCE"),
        *(_code(~F.coalesce(rated(r).between(0, 3), F.lit(False)), f"RUBRIC_{r.upper()}_INVALID") for r in RATINGS), _code(_not_share(c("confidence")), "CONFIDENCE_INVALID"),
        _code(unsure & c("needs").isNotNull(), f"UNCERTAIN_NEEDS_{work}_MUST_BE_NULL"), _code(unsure & (decision != "REVIEW"), "UNCERTAIN_DECISION_MUST_BE_REVIEW"), _code(unsure & (failure != "INCONCLUSIVE"), "UNCERTAIN_FAILURE_MUST_BE_INCONCLUSIVE"),
        _code(success & ~c("needs").eqNullSafe(F.lit(False)), f"SUCCESS_NEEDS_{work}_MUST_BE_FALSE"), _code(success & (failure != "INCONCLUSIVE"), "SUCCESS_FAILURE_MUST_BE_INCONCLUSIVE"),
        _code(eligible_without, f"ELIGIBLE_FAILURE_NEEDS_{work}_MUST_BE_TRUE"), _code(lost & decision.isin("REVIEW", "DEFER") & (c("needs") == F.lit(False)), f"UNCERTAIN_{work}_DECISION"),
    )
    out = met.withColumn("errors", errors)
    good = F.size("errors") == 0
    return out.withColumns({"status": F.when(good, "COMPLETE").otherwise("REVIEW"), "final_decision": F.when(good, c("decision")).otherwise("REVIEW")}).drop("_e", "_ne", "_r", "_nr")


def gate_errors(gates: DataFrame, key: str = "report_id") -> DataFrame:
    """(key, code) of gates (key, decision, route, ratings map, review_required, confidence)."""
    rated = lambda r: _code(~F.coalesce(F.try_element_at("ratings", F.lit(r)).between(0, 3), F.lit(False)), f"{r.upper()}_INVALID")
    codes = _codes(_code(_not_in("decision", DECISIONS), "DECISION_INVALID"), _code(_not_in("route", ROUTES), "ROUTE_INVALID"), *map(rated, RATINGS), _code(F.col("review_required").isNull(), "REVIEW_REQUIRED_INVALID"), _code(_not_share(F.col("confidence")), "CONFIDENCE_INVALID"))
    return gates.select(key, F.explode(codes).alias("code"))


def report_errors(reports: DataFrame, key: str = "report_id") -> DataFrame:
    """(key, code) of failure reports (key, primary_failure, failure_layer, recoverability, attribution map of shares, confidence, primary_step)."""
    kinds = F.forall(F.map_keys("attribution"), lambda k: k.isin([*LAYERS[:-1], "UNKNOWN"]))
    shares = F.forall(F.map_values("attribution"), lambda v: F.coalesce(v.between(0, 1), F.lit(False)))
    codes = _codes(
        _code(_not_in("primary_failure", FAILURES), "PRIMARY_FAILURE_INVALID"), _code(_not_in("failure_layer", LAYERS), "FAILURE_LAYER_INVALID"), _code(_not_in("recoverability", RECOVERABILITIES), "RECOVERABILITY_INVALID"),
        _code(~(kinds & shares), "ATTRIBUTION_INVALID"), _code(_not_share(F.col("confidence")), "CONFIDENCE_INVALID"), _code(F.col("primary_step") < 0, "PRIMARY_STEP_INVALID"),
    )
    return reports.select(key, F.explode(codes).alias("code"))


def check_errors(checks: DataFrame, key: str = "check_id") -> DataFrame:
    """(key, code) of invariant checks (key, kind, result, error_code): closed kinds and results, and an error code just with ERROR."""
    has = F.coalesce("error_code", F.lit("")) != ""
    codes = _codes(_code(_not_in("kind", CHECK_KINDS), "KIND_INVALID"), _code(_not_in("result", CHECK_RESULTS), "RESULT_INVALID"), _code((F.col("result") == "ERROR") & ~has, "ERROR_CODE_REQUIRED"), _code((F.col("result") != "ERROR") & F.col("error_code").isNotNull(), "ERROR_CODE_UNEXPECTED"))
    return checks.select(key, F.explode(codes).alias("code"))


def pair_errors(pairs: DataFrame, obligations: DataFrame, key: str = "task_id") -> DataFrame:
    """(key, code) of task and environment pairs (key, source_task_id, intent_status, instruction, objective, origin, counts map, refs map, workspace_ref)
    and obligations (key, id, refs array): a READY task has texts and obligations with their own ids and user evidence, others no instruction; counts are not negative, refs relative."""
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    bad_ref = (F.coalesce(F.size("refs"), F.lit(-1)) <= 0) | F.exists("refs", lambda r: ~F.coalesce(F.startswith(r, F.lit("user:")), F.lit(False)))
    sums = obligations.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"), F.count_distinct("id").alias("_ids"), F.count_if(blank("id")).alias("_blank"), F.count_if(F.coalesce(bad_ref, F.lit(True))).alias("_bad"))
    met = pairs.join(sums, F.col(key) == F.col("_k"), "left")
    ready = F.col("intent_status") == "READY"
    unsafe = lambda r: r.isNotNull() & ((r == "") | F.contains(r, F.lit("\\")) | F.startswith(r, F.lit("/")) | F.array_contains(F.split(r, "/", -1), ".."))
    codes = _codes(
        _code(blank(key) if dict(pairs.dtypes)[key] == "string" else F.col(key).isNull(), "TASK_ID_MISSING"), _code(~F.col("source_task_id").eqNullSafe(F.col(key)), "SOURCE_TASK_MISMATCH"), _code(ready & (blank("instruction") | blank("objective")), "READY_TEXT_MISSING"),
        _code(ready & (F.coalesce("_n", F.lit(0)) == 0), "READY_OBLIGATIONS_MISSING"), _code(ready & (F.col("_bad") > 0), "OBLIGATION_EVIDENCE_INVALID"), _code(ready & ((F.col("_ids") < F.col("_n")) | (F.col("_blank") > 0)), "OBLIGATION_IDS_INVALID"),
        _code(~F.coalesce(ready, F.lit(False)) & F.col("instruction").isNotNull(), "INSTRUCTION_UNEXPECTED"), _code(_not_in("origin", ["REPLAYED", "DEFAULT_EMPTY", "NONE"]), "ORIGIN_INVALID"),
        _code(F.exists(F.map_values("counts"), lambda v: v.isNull() | (v < 0)), "COUNT_INVALID"), _code(F.exists(F.map_values("refs"), unsafe), "REF_UNSAFE"), _code((F.col("origin") == "NONE") & F.col("workspace_ref").isNotNull(), "WORKSPACE_UNEXPECTED"),
    )
    return met.select(key, F.explode(codes).alias("code"))


# Four policies for paths, for four uses; each gives the path that may be used, or null.


def portable_path(path: Column) -> Column:
    """With slashes for backslashes: relative, no `..`, no drive, no NUL; `.` and empty parts go."""
    parts = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1), lambda x: ~x.isin("", "."))
    bad = F.startswith(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/")) | F.contains(path, F.lit(NUL)) | F.array_contains(parts, "..") | (F.size(parts) == 0) | F.contains(F.get(parts, F.lit(0)), F.lit(":"))
    return F.when(~bad, F.array_join(parts, "/"))


def public_path(path: Column) -> Column:
    """As portable_path(), and in no folder of solutions, environments, hidden controls or version control, nor in tests/control."""
    safe = portable_path(path)
    parts = F.split(safe, "/")
    control = F.exists(F.arrays_zip(parts.alias("a"), F.slice(parts, 2, F.size(parts)).alias("b")), lambda x: (x["a"] == "tests") & (x["b"] == "control"))
    hidden = F.arrays_overlap(parts, F.array(*map(F.lit, ("solution", "environment", "hidden_control", ".git")))) | F.coalesce(control, F.lit(False))
    return F.when(~hidden, safe)


def remote_path(path: Column) -> Column:
    """Absolute, without `..` and NUL."""
    bad = ~F.startswith(path, F.lit("/")) | F.contains(path, F.lit(NUL)) | F.array_contains(F.split(path, "/", -1), "..")
    return F.when(~bad, path)


def workspace_path(path: Column, workdir: Column) -> Column:
    """A path as seen from a working directory: drive, home and user folders go, options and variables are none, and neither is the directory itself or a path with `..`."""
    unix = lambda c: F.regexp_replace(F.regexp_replace(F.replace(F.trim(c), F.lit("\\"), F.lit("/")), "^[A-Za-z]:/", ""), "^~/", "")
    raw, root = unix(path), F.regexp_replace(unix(workdir), "/+$", "")
    inside = F.when(F.startswith(raw, F.concat(root, F.lit("/"))), F.substr(raw, F.char_length(root) + 2)).when(F.startswith(raw, F.concat(F.lit("/"), root, F.lit("/"))), F.substr(raw, F.char_length(root) + 3))
    bare = F.coalesce(F.when(F.coalesce(root, F.lit("")) != "", inside), raw)
    parts = F.filter(F.split(bare, "/", -1), lambda x: ~x.isin("", "."))
    home = F.startswith(bare, F.lit("/")) & (F.size(parts) >= 3) & F.get(parts, F.lit(0)).isin("Users", "home")
    left = F.when(home, F.slice(parts, 3, F.size(parts))).otherwise(parts)
    bad = (raw == "") | F.startswith(raw, F.lit("-")) | F.startswith(raw, F.lit("$")) | F.coalesce((raw == root) & (root != ""), F.lit(False)) | (F.size(left) == 0) | F.array_contains(left, "..")
    return F.when(~bad, F.array_join(left, "/"))


def binding_path(path: Column) -> Column:
    """A path of a binding: workspace_path() without trailing `;` and `,`, a slash at its end kept; null for a URI."""
    text = F.regexp_replace(F.trim(F.replace(path, F.lit("\\"), F.lit("/"))), "[;,]+$", "")
    safe = workspace_path(F.regexp_replace(text, "/+$", ""), F.lit(None).cast("string"))
    return F.when((text == "") | text.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), None).when(F.endswith(text, F.lit("/")), F.concat(safe, F.lit("/"))).otherwise(safe)


def missing_paths(required: DataFrame, present: DataFrame, group: str = "task_id", path: str = "path") -> DataFrame:
    """required (group, path) that are not present: a file must be there itself, a folder (ending in a slash) itself or anything in it."""
    parts = F.split(path, "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    seen = present.select(group, F.explode(F.flatten(F.array(F.array(F.col(path)), F.transform(above, lambda a: F.concat(a, F.lit("/")))))).alias(path)).distinct()
    return required.join(seen, [group, path], "left_anti")
