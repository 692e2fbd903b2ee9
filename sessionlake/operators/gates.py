"""Gates over trials and tasks: statuses, acceptance, certification, outlook, routes and bindings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.messages import stripped

# Errors by prefix, in order of precedence, what missing assets are called, and endings of source files.
INFRA_PREFIXES = [
    "SANDBOX_INIT", "SANDBOX_CLEANUP", "CONTAINER_CLEANUP_ERROR", "MODEL_CONNECTION_ERROR", "MODEL_TIMEOUT", "MODEL_API_FAILED", "READ_ONLY_SETUP_FAILED", "INFRA_ERROR",
]
PIPELINE_PREFIXES = [
    "INVALID_", "INTEGRITY_ISSUE_UNKNOWN", "INTEGRITY_CLASSIFICATION_INVALID", "INTEGRITY_CLASSIFICATIONS_INVALID", "INTEGRITY_CLASSIFICATION_DUPLICATE", "INTEGRITY_ISSUE_UNCLASSIFIED", "INVALID_JSON", "AGENT_INCOMPLETE",
    "MODEL_OUTPUT_INVALID", "MALFORMED_", "JUDGE_WORKSPACE_WRITEABLE", "TASK_NOT_EXECUTABLE", "PROTECTED_FILE_OVERWRITE", "VERIFIER_INPUT_PROTECTION_FAILED", "TOOL_NOT_ALLOWED", "REAL_PROBE_REQUIRED",
]
UNKNOWN_STATE_REASONS = ["read_after_unparsed_mutation", "unparsed_mutation_scope", "unparsed_mutation_unscoped"]
FINISHED = ["READY", "READY_VARIANT", "ENVIRONMENT_READY", "ROLLOUT_COMPLETED"]


def _code(condition: Column, name: str | Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(name) if isinstance(name, str) else name)


def _codes(*codes: Column) -> Column:
    return F.array_compact(F.array(*codes))


def _blank(column: str | Column) -> Column:
    return F.coalesce(stripped(F.col(column) if isinstance(column, str) else column), F.lit("")) == ""


def _among(prefixes: list[str], errors: Column) -> Column:
    return F.exists(errors, lambda e: reduce(Column.__or__, (F.startswith(e, F.lit(p)) for p in prefixes)))


def trial_status(exception_type: Column, reward: Column, verdict: Column) -> Column:
    """TIMEOUT or INFRA_ERROR where an exception's type (empty for an unnamed one) is known, PASS and FAIL where reward and verdict agree, else INCONCLUSIVE."""
    status = F.when(F.contains(exception_type, F.lit("Timeout")), "TIMEOUT").when(exception_type.isNotNull(), "INFRA_ERROR")
    return status.when((reward == 1.0) & verdict.isin("TASK_PASS", "PASS"), "PASS").when((reward == 0.0) & verdict.isin("TASK_FAIL", "FAIL"), "FAIL").otherwise("INCONCLUSIVE")


def explicit_state(words: Column, cleanup_verified: Column) -> Column:
    """The state that an array of status words names, the first of these that occurs; else whether clean-up is denied, else null."""
    state = F.upper(F.array_join(words, " "))
    has = lambda *parts: reduce(Column.__or__, (F.contains(state, F.lit(p)) for p in parts))
    # Words and states, in order of precedence.
    found = F.when(has("CANCEL"), "CANCELLED").when(has("TIMEOUT"), "INFRA_TIMEOUT").when(has("BUDGET", "MAX_TOKEN"), "TASK_BUDGET_EXHAUSTED").when(has("CLEANUP_UNVERIFIABLE"), "CLEANUP_UNVERIFIABLE")
    found = found.when(has("INFRA_ENVIRONMENT", "ENVIRONMENT_ERROR"), "INFRA_ENVIRONMENT").when(has("INFRA_AGENT", "AGENT_ERROR"), "INFRA_AGENT").when(has("INFRA_VERIFIER", "VERIFIER_ERROR"), "INFRA_VERIFIER")
    return found.when(cleanup_verified == F.lit(False), "CLEANUP_UNVERIFIABLE")


# Which part of a trial an error code tells of, in order of precedence.
CAPTURE_CODES = [
    "SECRET_LEAK", "CAPTURE_FILES_MISSING", "CAPTURE_RECORDS_INVALID", "MODEL_EXCHANGE_MISSING", "INCOMPLETE_MODEL_EXCHANGE", "TASK_INPUT_INVALID", "FULL_TRAJECTORY_INVALID", "PROJECTION_FRESH_RECOMPUTE_MISMATCH", "RECONCILIATION_FRESH_RECOMPUTE_MISMATCH",
    "EVIDENCE_FRESH_RECOMPUTE_FAILED", "PROJECTION_FAILED", "PROJECTION_HASH_MISMATCH", "RECONCILIATION_FAILED", "RECONCILIATION_HASH_MISMATCH",
]
AGENT_CODES = [
    "AGENT_FILES_MISSING", "ARTIFACT_MANIFEST_MISSING", "ARTIFACT_MANIFEST_INVALID", "ARTIFACT_MANIFEST_NOT_OBJECT", "ARTIFACT_MANIFEST_EMPTY", "ARTIFACT_ENTRY_SHAPE", "ARTIFACT_PATH_ABSOLUTE", "ARTIFACT_PATH_TRAVERSAL",
    "ARTIFACT_SYMLINK", "ARTIFACT_HARDLINK", "ARTIFACT_FILE_MISSING", "ARTIFACT_HASH_MISMATCH", "ARTIFACT_SIZE_MISMATCH",
]
VERIFIER_CODES = [
    "VERIFIER_FILES_MISSING", "VERIFIER_JSON_INVALID", "REWARD_NOT_FLAT_OBJECT", "REWARD_NON_NUMERIC", "REWARD_NON_FINITE", "REWARD_OUT_OF_RANGE", "REWARD_TASK_MISSING", "REWARD_CRITERIA_MISMATCH", "REWARD_VERDICT_MISMATCH",
    "VERDICT_NOT_OBJECT", "VERDICT_SCHEMA_INVALID", "VERDICT_STATUS_INVALID", "VERDICT_REASON_CODE_INVALID", "VERDICT_DETAILS_INVALID", "EVALUATION_CONTRACT_VERDICT_SHAPE", "EVALUATION_CONTRACT_MISSING",
    "EVALUATION_CONTRACT_TASK_BUNDLE_MISSING", "EVALUATION_CONTRACT_SOURCE_INCOMPLETE", "EVALUATION_CONTRACT_MISMATCH",
]


def certified(trials: DataFrame, capture_codes: tuple[str, ...] = ()) -> DataFrame:
    """trials (explicit_status, metadata_ok, errors array, reward, checks_ok) with status, certified and task_passed.

    An explicit status counts first, then metadata and bindings, capture, agent and verifier errors, a missing reward,
    any other error, and the reward last. Certified needs a task outcome, no errors and all checks. Codes of capture errors
    that name an agent or a format are the caller's, in `capture_codes`.
    """
    of = lambda codes: F.arrays_overlap(F.coalesce("errors", F.array().cast("array<string>")), F.array(*map(F.lit, codes)))
    c = F.col
    status = F.when(c("explicit_status").isNotNull(), c("explicit_status")).when(~F.coalesce("metadata_ok", F.lit(False)) | of(["WORKSPACE_BINDING_INVALID"]), "INFRA_ENVIRONMENT")
    status = status.when(of([*CAPTURE_CODES, *capture_codes]), "INFRA_CAPTURE").when(of(AGENT_CODES), "INFRA_AGENT").when(of(VERIFIER_CODES) | c("reward").isNull(), "INFRA_VERIFIER")
    status = status.when(F.size("errors") > 0, "INFRA_CAPTURE").when(c("reward") >= 1.0, "TASK_PASS").otherwise("TASK_FAIL")
    outcome = c("status").isin("TASK_PASS", "TASK_FAIL")
    whole = outcome & (F.coalesce(F.size("errors"), F.lit(0)) <= 0) & F.coalesce("checks_ok", F.lit(False))
    return trials.withColumn("status", status).withColumns({"certified": whole, "task_passed": F.when(outcome, c("status") == "TASK_PASS")})


def reproducibility(jobs: DataFrame, trials: DataFrame, job: str = "job_id") -> DataFrame:
    """(job, reproducible): null where the expected count or anything of a trial is unknown, false where the trials are
    not as many as expected, null again where gate or clean-up are unknown, else whether all that passed."""
    fields = ("status", "reward", "trajectory_present", "manifest_present", "content_valid")
    unknown = reduce(Column.__or__, (F.col(f).isNull() for f in fields))
    good = (F.col("status") == "PASS") & (F.col("reward") == 1.0) & F.col("trajectory_present") & F.col("manifest_present") & F.col("content_valid")
    sums = trials.groupBy(F.col(job).alias("_job")).agg(F.count("*").alias("n"), F.count_if(unknown).alias("unknown"), F.count_if(~F.coalesce(good, F.lit(False))).alias("bad"))
    met = jobs.join(sums, F.col(job) == F.col("_job"), "left")
    n = F.coalesce("n", F.lit(0))
    value = F.when(F.col("expected_trials").isNull() | (F.coalesce("unknown", F.lit(0)) > 0), None).when(n != F.col("expected_trials"), False)
    value = value.when(F.col("gate_ok").isNull() | F.col("cleanup_ok").isNull(), None).otherwise(F.col("gate_ok") & F.col("cleanup_ok") & (F.coalesce("bad", F.lit(0)) == 0))
    return met.select(job, value.cast("boolean").alias("reproducible"))


def first_present(objects: list[Column], keys: tuple[str, ...]) -> Column:
    """The value as JSON text of the first key that the first object (JSON text) with any of them holds, be it null; null if none holds one."""
    found = [F.get_json_object(o, f"$.{k}") for o in objects for k in keys]
    there = [F.array_contains(F.json_object_keys(o), k) for o in objects for k in keys]
    return reduce(lambda rest, x: F.when(F.coalesce(x[0], F.lit(False)), F.coalesce(x[1], F.lit("null"))).otherwise(rest), reversed(list(zip(there, found, strict=True))), F.lit(None).cast("string"))


def unknown_initial_states(partial: DataFrame, required: DataFrame, trusted: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, code, path, source_event_id) of evidence (task, path, reason, source_event_id) after unknown writes.

    UNKNOWN_INITIAL_STATE where a required path, or one below a required folder (ending in a slash), has no trusted
    complete file; UNKNOWN_INITIAL_STATE_UNSCOPED where the evidence has no path and the task requires any.
    """
    doubtful = partial.where(F.col("reason").isin(UNKNOWN_STATE_REASONS))
    located = doubtful.where("path is not null").join(trusted.select(task, "path"), [task, "path"], "left_anti")
    # a path meets the required ones among itself and the folders above it, in an equi-join
    parts = F.split("path", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.when(k == F.size(parts), F.col("path")).otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))))
    need = required.select(task, F.col("path").alias("_need")).distinct()
    met = located.withColumn("_need", F.explode(above)).join(need, [task, "_need"], "left_semi").drop("_need").distinct()
    loose = doubtful.where("path is null").join(need.select(task).distinct(), task, "left_semi")
    out = lambda t, code: t.select(task, F.lit(code).alias("code"), "path", "source_event_id")
    return out(met, "UNKNOWN_INITIAL_STATE").union(out(loose, "UNKNOWN_INITIAL_STATE_UNSCOPED"))


def task_outlook(tasks: DataFrame, blockers: DataFrame, task: str = "task_id", infra_prefixes: tuple[str, ...] = (), skipped: str = "SKIPPED") -> DataFrame:
    """(task, status, blockers) of tasks (task, errors array, pending, label) and blockers (task, code, confirmed).

    INFRA_ERROR, then `skipped` for any confirmed blocker, PIPELINE_ERROR, REVIEW for anything pending,
    unscoped, erroneous or insufficient, else READY. Prefixes of failures that name an agent are the caller's.
    """
    sums = blockers.groupBy(F.col(task).alias("_t")).agg(F.count("*").alias("n"), F.count_if("confirmed").alias("sure"), F.count_if(F.col("code") == "UNKNOWN_INITIAL_STATE_UNSCOPED").alias("loose"))
    met = tasks.join(sums, F.col(task) == F.col("_t"), "left")
    errors = F.coalesce("errors", F.array().cast("array<string>"))
    more = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    status = F.when(_among([*INFRA_PREFIXES, *infra_prefixes], errors), "INFRA_ERROR").when(more("sure"), skipped).when(_among(PIPELINE_PREFIXES, errors), "PIPELINE_ERROR")
    open_ = F.coalesce("pending", F.lit(False)) | more("loose") | (F.size(errors) > 0) | F.coalesce(F.col("label").isin("INSUFFICIENT", "UNKNOWN"), F.lit(False))
    return met.select(task, status.when(open_, "REVIEW").otherwise("READY").alias("status"), F.coalesce("n", F.lit(0)).alias("blockers"))


def support_routes(tasks: DataFrame, files: DataFrame, task: str = "task_id", endings: tuple[str, ...] = ("py", "js", "jsx", "ts", "tsx", "java", "go", "rs", "c", "cc", "cpp", "h", "hpp")) -> DataFrame:
    """(task, route, env_origin, allow_completion, files, source_files, terminal_batch_hint) of tasks (task, domain) and replayed files (task, path). A name that is nothing but an ending is no source."""
    source = F.lower("path").rlike(rf"[^/][.](?:{'|'.join(endings)})$")
    sums = files.groupBy(F.col(task).alias("_t")).agg(F.count("*").alias("_n"), F.count_if(source).alias("_s"))
    met = tasks.join(sums, F.col(task) == F.col("_t"), "left").withColumns({"files": F.coalesce("_n", F.lit(0)), "source_files": F.coalesce("_s", F.lit(0))})
    retrieval = F.coalesce(F.col("domain") == "retrieval", F.lit(False))
    pick = lambda a, b, c: F.when(retrieval, a).when(F.col("files") > 0, b).otherwise(c)
    hint = (F.col("files") >= 5) | (F.col("source_files") >= 2)
    return met.select(task, pick("RETRIEVAL_UNSUPPORTED", "TERMINAL_FILE", "DEFAULT_EMPTY").alias("route"), pick("NONE", "REPLAYED", "DEFAULT_EMPTY").alias("env_origin"), (~retrieval).alias("allow_completion"), "files", "source_files", hint.alias("terminal_batch_hint"))


def integrity_errors(issues: DataFrame, classifications: DataFrame, report: str = "report_id", issue: str = "issue_id", pos: str = "pos", gap: str = "GAP") -> DataFrame:
    """(report, issue, code) of classifications (report, pos, issue, path, classification, reason) against issues (report, issue, path):
    unknown, repeated, invalid ones, gaps they find (`gap` is the caller's word for one), and issues left without a valid one."""
    # Classes, and codes below.
    classes = ["BASELINE_TASK_DEFECT", gap, "IRRELEVANT"]
    given = classifications.withColumn("_again", F.row_number().over(Window.partitionBy(report, issue).orderBy(pos)) > 1)
    known = issues.select(F.col(report).alias("_r"), F.col(issue).alias("_i"), F.col("path").alias("_path"))
    met = given.join(known, (F.col(report) == F.col("_r")) & (F.col(issue) == F.col("_i")), "left")
    sound = F.col("path").eqNullSafe(F.col("_path")) & F.coalesce(F.col("classification").isin(classes), F.lit(False)) & ~_blank("reason")
    code = F.when(F.col("_r").isNull(), "INTEGRITY_ISSUE_UNKNOWN").when(F.col("_again"), "INTEGRITY_CLASSIFICATION_DUPLICATE").when(~sound, "INTEGRITY_CLASSIFICATION_INVALID").when(F.col("classification") == gap, f"WORKSPACE_{gap}")
    told = met.withColumn("code", code)
    settled = told.where(F.col("code").isNull() | (F.col("code") == f"WORKSPACE_{gap}")).select(report, issue).distinct()
    left = issues.join(settled, [report, issue], "left_anti").select(report, issue, F.lit("INTEGRITY_ISSUE_UNCLASSIFIED").alias("code"))
    return told.where("code is not null").select(report, issue, "code").union(left)


def delivery_scopes(tasks: DataFrame, users: DataFrame, session: str = "session_id", task: str = "task_id") -> DataFrame:
    """tasks (session, task, status, stopped_at, errors array, scope_status, scope_reason, scope_refs array, message_indices array) with scope:
    the scope status if it is sound and all its references are user messages of the task (users holds session, message_index), else null."""
    named = tasks.select(session, task, F.explode(F.array_distinct("scope_refs")).alias("ref"))
    own = tasks.select(session, task, F.explode(F.array_distinct("message_indices")).alias("message_index")).join(users.select(session, "message_index").distinct(), [session, "message_index"])
    foreign = named.join(own.select(session, task, F.concat(F.lit("user:"), "message_index").alias("ref")), [session, task, "ref"], "left_anti").select(session, task).distinct().withColumn("_foreign", F.lit(True))
    blocked = (F.col("status") == "BLOCKED") & (F.col("stopped_at") == "intent") & (F.array_join("errors", "\n") == F.concat(F.lit("DELIVERY_SCOPE_"), "scope_status"))
    sound = F.col("scope_status").isin("IN_SCOPE", "OUT_OF_SCOPE", "NEEDS_REVIEW") & ~_blank("scope_reason") & (F.size("scope_refs") > 0) & F.col("_foreign").isNull() & ((F.col("scope_status") == "IN_SCOPE") | blocked)
    return tasks.join(foreign, [session, task], "left").withColumn("scope", F.when(F.coalesce(sound, F.lit(False)), F.col("scope_status"))).drop("_foreign")


def task_outcomes(scoped: DataFrame, group: str = "session_id", exit_code: str = "exit_code") -> DataFrame:
    """(group, completed, out_of_scope, needs_review, issues) of delivery_scopes() with an exit code: completed says that processing ended, not that an answer is right."""
    done = F.col(exit_code).isin(0, 2) & F.col("status").isin(FINISHED) & (F.coalesce(F.size("errors"), F.lit(0)) <= 0) & (F.col("scope_status").isNull() | F.coalesce(F.col("scope") == "IN_SCOPE", F.lit(False)))
    out = F.when(F.col("scope").isin("OUT_OF_SCOPE", "NEEDS_REVIEW") & (F.col(exit_code) == 2), F.col("scope")).when(F.coalesce(done, F.lit(False)), "COMPLETED").otherwise("ISSUE")
    count = lambda name: F.count_if(F.col("outcome") == name).alias({"ISSUE": "issues"}.get(name, name.lower()))
    return scoped.withColumn("outcome", out).groupBy(group).agg(*map(count, ("COMPLETED", "OUT_OF_SCOPE", "NEEDS_REVIEW", "ISSUE")))


def requirement_coverage_errors(obligations: DataFrame, coverage: DataFrame, delivered: DataFrame, read: DataFrame, task: str = "task_id", key: str = "obligation_id", pos: str = "pos") -> DataFrame:
    """(task, obligation, code) of coverage (task, pos, obligation, reason, refs array): unknown or repeated obligations, no reason or
    references, references not delivered or not read ((task, ref) each), and obligations left out."""
    known = obligations.select(task, key).distinct()
    again = F.row_number().over(Window.partitionBy(task, key).orderBy(pos)) > 1
    met = coverage.withColumn("_again", again).join(known.withColumn("_known", F.lit(True)), [task, key], "left")
    bad = F.col("_known").isNull() | F.col("_again")
    empty = _blank("reason") | (F.coalesce(F.size("refs"), F.lit(-1)) <= 0)
    told = met.withColumn("code", F.when(bad, "OBLIGATION_UNKNOWN_OR_REPEATED").when(empty, "REASON_OR_REFS_MISSING"))
    refs = told.where("code is null").select(task, key, F.explode(F.array_distinct("refs")).alias("ref"))
    given, seen = (t.select(task, "ref").distinct().withColumn(name, F.lit(True)) for t, name in ((delivered, "_given"), (read, "_seen")))
    unread = refs.join(given, [task, "ref"], "left").join(seen, [task, "ref"], "left")
    by_ref = unread.withColumn("code", F.when(F.col("_given").isNull(), "REF_NOT_DELIVERED").when(F.col("_seen").isNull(), "REF_NOT_READ")).where("code is not null").select(task, key, "code")
    left = known.join(told.where(~bad).select(task, key), [task, key], "left_anti").select(task, key, F.lit("OBLIGATION_NOT_COVERED").alias("code"))
    return told.where("code is not null").select(task, key, "code").union(by_ref).union(left)


def excluded_captures(exclusions: DataFrame, records: DataFrame, session: str = "session_id", event: str = "event_index", pos: str = "pos") -> DataFrame:
    """exclusions (session, pos, event, kind, reason, quote) with code, null for a sound one: the event must exist once among the
    exclusions, have a reason, and if it returned, a closed kind and a quote that stands in its texts (records: session, event, texts array)."""
    again = F.row_number().over(Window.partitionBy(session, event).orderBy(pos)) > 1
    met = exclusions.withColumn("_again", again).join(records.select(session, event, F.col("texts").alias("_texts"), F.col("pending").alias("_pending")), [session, event], "left")
    quoted = F.exists("_texts", lambda t: F.contains(t, F.col("quote"))) & ~_blank("quote")
    code = F.when(F.col("_pending").isNull() | F.col("_again") | _blank("reason"), "EXCLUSION_INVALID")
    code = code.when(~F.col("_pending") & ~F.coalesce(F.col("kind").isin("task_answer", "post_task_state") & quoted, F.lit(False)), "EXCLUSION_WITHOUT_QUOTE")
    return met.withColumn("code", code).drop("_again", "_texts", "_pending")


def verified_obligations(receipts: DataFrame, obligations: DataFrame, expected: DataFrame, task: str = "task_id", trial: str = "trial_id", key: str = "obligation_id") -> DataFrame:
    """obligations with verified: whether the receipts (task, trial, obligation) of every expected trial (task, expected_trials) verify them."""
    sums = receipts.groupBy(task, key).agg(F.count_distinct(trial).alias("_n"))
    met = obligations.join(sums, [task, key], "left").join(expected.select(task, F.col("expected_trials").alias("_all")), task, "left")
    return met.withColumn("verified", F.coalesce(F.col("_n") == F.col("_all"), F.lit(False))).drop("_n", "_all")


def acceptance(rollouts: DataFrame, pending: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, status, errors) of rollouts (task, gate_reasons array, execution_status, rollout_passed, verifier_enabled) and unverified obligations (task, kind).

    NOT_ASSESSED without a verifier; PASS without any error; else REVIEW. Errors keep their order, each once.
    """
    sums = pending.groupBy(F.col(task).alias("_t")).agg(F.count_if(F.col("kind") == "NON_FILE").alias("_other"), F.count_if(F.col("kind") == "FILE").alias("_files"))
    met = rollouts.join(sums, F.col(task) == F.col("_t"), "left")
    on = F.coalesce("verifier_enabled", F.lit(True))
    more = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    codes = _codes(
        _code(F.coalesce("execution_status", F.lit("UNKNOWN")) != "COMPLETED", F.concat(F.lit("EXECUTION_NOT_COMPLETED:"), F.coalesce("execution_status", F.lit("UNKNOWN")))),
        _code(on & ~F.coalesce("rollout_passed", F.lit(False)), "ROLLOUT_NOT_PASSED"), _code(on & more("_other"), "NON_FILE_RESPONSE_UNVERIFIED"), _code(on & more("_files"), "FILE_SEMANTIC_UNVERIFIED"),
    )
    errors = F.array_distinct(F.concat(F.coalesce("gate_reasons", F.array().cast("array<string>")), codes))
    return met.select(task, F.when(~on, "NOT_ASSESSED").when(F.size(errors) == 0, "PASS").otherwise("REVIEW").alias("status"), errors.alias("errors"))


def trial_binding_errors(trials: DataFrame, slots: DataFrame, plan: str = "plan_id", trial: str = "trial_id", path: str = "task_path", contract: str = "contract_sha256") -> DataFrame:
    """(plan, trial, code) of trials (plan, trial, path): no absolute path, a path that is no slot of the plan (plan, path, contract), a slot used before; and (plan, null, CONTRACTS_DIFFER)."""
    known = slots.select(plan, path).distinct().withColumn("_known", F.lit(True))
    again = F.row_number().over(Window.partitionBy(plan, path).orderBy(trial)) > 1
    met = trials.withColumn("_again", again).join(known, [plan, path], "left")
    code = F.when(~F.coalesce(F.startswith(path, F.lit("/")), F.lit(False)), "TASK_PATH_MISSING").when(F.col("_known").isNull(), "TASK_PATH_UNKNOWN").when(F.col("_again"), "TASK_PATH_REPEATED")
    differ = slots.groupBy(plan).agg(F.count_distinct(contract).alias("n")).where("n > 1").select(plan, F.lit(None).cast(trials.schema[trial].dataType).alias(trial), F.lit("CONTRACTS_DIFFER").alias("code"))
    return met.withColumn("code", code).where("code is not null").select(plan, trial, "code").union(differ)


def semantic_receipt_errors(receipts: DataFrame, evidence: DataFrame, checks: DataFrame, files: DataFrame, trial: str = "trial_id", key: str = "obligation_id") -> DataFrame:
    """(trial, obligation, code) of receipts (trial, obligation, covered, reason) with evidence (trial, obligation, pos, side, path, quote, absent).

    The obligations must be the checks' (trial, obligation), each once, all covered, with a reason and evidence: a quote
    that the file (trial, side, path, content) holds, or a file of the initial side that is absent in the final one.
    Some evidence must be of the final side.
    """
    counted = receipts.groupBy(trial, key).agg(F.count("*").alias("n"), F.min(F.coalesce("covered", F.lit(False))).alias("covered"), F.max(_blank("reason")).alias("blank"))
    met = checks.select(trial, key).distinct().withColumn("_check", F.lit(True)).join(counted, [trial, key], "full")
    proof = evidence.join(files.select(trial, "side", "path", "content"), [trial, "side", "path"], "left")
    first = files.where("side = 'initial'").select(trial, "path").distinct().withColumn("_initial", F.lit(True))
    proof = proof.join(first, [trial, "path"], "left")
    gone = (F.col("side") == "final") & F.col("_initial").isNotNull() & F.col("content").isNull()
    valid = F.when(F.coalesce("absent", F.lit(False)), gone).otherwise(~_blank("quote") & F.contains(F.col("content"), F.col("quote")))
    proved = proof.groupBy(F.col(trial).alias("_t"), F.col(key).alias("_k")).agg(F.count_if(~F.coalesce(valid, F.lit(False))).alias("bad"), F.count_if(F.coalesce(valid, F.lit(False)) & (F.col("side") == "final")).alias("final"))
    all_ = met.join(proved, (F.col(trial) == F.col("_t")) & (F.col(key) == F.col("_k")), "left")
    code = F.when(F.col("_check").isNull() | F.col("n").isNull() | (F.col("n") > 1), "OBLIGATIONS_MISMATCH").when(~F.col("covered"), "NOT_ACCEPTED").when(F.col("blank") | F.col("_t").isNull(), "EVIDENCE_MISSING")
    code = code.when(F.col("bad") > 0, "EVIDENCE_INVALID").when(F.col("final") == 0, "FINAL_EVIDENCE_MISSING")
    return all_.withColumn("code", code).where("code is not null").select(trial, key, "code")


def selected_candidates(candidates: DataFrame, judges: DataFrame, group: str = "task_id", index: str = "index") -> DataFrame:
    """(group, selected, eligible, rejected): of candidates that are READY and judged SUFFICIENT and READY, that of most confidence, fewest uncertainties and lowest index.

    Candidates hold decision, environment_status, confidence and uncertainties (a count), judges label and judge_decision;
    one without a judge is not sufficient. ENVIRONMENT_NOT_READY counts as READY unless the environment itself failed.
    """
    met = candidates.join(judges.select(group, index, "label", "judge_decision"), [group, index], "left")
    failed = (F.col("decision") == "ENVIRONMENT_NOT_READY") & F.col("environment_status").isin("INFRA_ERROR", "PIPELINE_ERROR")
    ready = F.col("decision").isin("READY", "ENVIRONMENT_NOT_READY") & ~F.coalesce(failed, F.lit(False))
    good = F.coalesce(ready & (F.col("label") == "SUFFICIENT") & (F.col("judge_decision") == "READY"), F.lit(False))
    order = F.struct(F.coalesce("confidence", F.lit(0.0)).alias("c"), -F.coalesce("uncertainties", F.lit(0)), -F.col(index))
    return met.groupBy(group).agg(F.max_by(index, F.when(good, order)).alias("selected"), F.count_if(good).alias("eligible"), F.count_if(~good).alias("rejected"))


def binding_errors(bindings: DataFrame, obligations: DataFrame, task: str = "task_id", key: str = "obligation_id", pos: str = "pos") -> DataFrame:
    """(task, obligation, code) of bindings (task, pos, obligation, verifier_kind, required, initial and outputs arrays of paths, observable).

    Null initial paths are the required ones that are no outputs, null required ones initial and outputs together.
    """
    kinds = F.col("verifier_kind").isin("FILE", "NON_FILE")
    outputs = F.coalesce("outputs", F.array().cast("array<string>"))
    initial = F.coalesce("initial", F.array_except(F.coalesce("required", F.array().cast("array<string>")), outputs))
    required = F.coalesce("required", F.array_union(initial, outputs))
    same = F.array_sort(F.array_distinct(required)) == F.array_sort(F.array_union(initial, outputs))
    file = F.col("verifier_kind") == "FILE"
    known = obligations.select(task, key).distinct().withColumn("_known", F.lit(True))
    met = bindings.join(known, [task, key], "left")
    valid = F.col("_known").isNotNull() & F.coalesce(kinds, F.lit(False))
    again = F.row_number().over(Window.partitionBy(task, key, "_valid").orderBy(pos)) > 1
    ranked = met.withColumn("_valid", valid).withColumn("_again", F.col("_valid") & again)
    codes = F.when(F.col("_known").isNull(), F.array(F.lit("BINDING_OBLIGATION_UNKNOWN"))).when(~F.col("_valid"), F.array(F.lit("BINDING_VERIFIER_KIND_INVALID"))).otherwise(_codes(
        _code(~same, "BINDING_PATH_UNION_MISMATCH"), _code(F.arrays_overlap(initial, outputs), "BINDING_PATH_ROLE_CONFLICT"), _code(file & _blank("observable"), "BINDING_TASK_OUTCOME_REQUIRED"),
        _code(file & (F.size(required) == 0), "BINDING_FILE_PATHS_REQUIRED"), _code(F.col("_again"), "BINDING_OBLIGATION_DUPLICATE"),
    ))
    left = known.select(task, key).join(ranked.where("_valid").select(task, key), [task, key], "left_anti").select(task, key, F.lit("BINDING_REQUIRED").alias("code"))
    return ranked.select(task, key, F.explode(codes).alias("code")).union(left)


def execution_blockers(environments: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, blockers) of environments (task, status, execution_readiness, execution_errors array, probes): what stands against a real run, each once; a null status is a missing contract."""
    c = F.col
    own = F.filter(F.coalesce("execution_errors", F.array().cast("array<string>")), lambda e: F.coalesce(e, F.lit("")) != "")
    found = F.concat(
        _codes(_code(c("status") != "READY", F.concat(F.lit("ENVIRONMENT_CONTEXT_"), c("status"))), _code(~c("execution_readiness").eqNullSafe(F.lit("PROBED")), "ENVIRONMENT_EXECUTION_UNREADY")), own,
        _codes(_code(F.coalesce("probes", F.lit(0)) <= 0, "ENVIRONMENT_PROBES_REQUIRED")),
    )
    return environments.select(task, F.when(c("status").isNull(), F.array(F.lit("ENVIRONMENT_CONTRACT_MISSING"))).otherwise(F.array_distinct(found)).alias("blockers"))
