"""Whether an environment is fit for its task: the contract of what was probed in it, and how its files and probes cover the task's obligations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.artifacts import missing_paths

# What is probed of an environment, and kinds of answers about an obligation.
KINDS = ["load", "reset", "dependency"]
ANSWERS = ["SATISFIED", "UNSATISFIED", "UNKNOWN"]


def _code(condition: Column, name: str | Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(name) if isinstance(name, str) else name)


def _listed(rows: DataFrame, task: str, name: str) -> DataFrame:
    """The different codes of each task, in order."""
    return rows.groupBy(F.col(task).alias(f"_{name}")).agg(F.array_sort(F.collect_set("code")).alias(name))


def probe_errors(environments: DataFrame, checks: DataFrame, probes: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, code) of what the checks of an environment don't prove.

    environments (task, workspace_sha256), checks (task, pos, kind, probe_ids, reason) and probes (task, probe_id, purpose, status,
    unchanged, reproducible, before_sha256, after_sha256, executions array of exit_code, timed_out, after_sha256). A kind is
    known and comes once; its evidence is named with a reason; each probe passed for that kind, left everything as it was
    (and can be repeated, for a reset), and ran once, twice for a reset, without fault. All kinds are checked.
    """
    turn = F.row_number().over(Window.partitionBy(task, "kind").orderBy("pos"))
    probes = probes.select(task, "probe_id", "purpose", "status", "unchanged", "reproducible", "before_sha256", "after_sha256", "executions")
    given = checks.select(task, "pos", "kind", "probe_ids", "reason").withColumns({"_turn": turn, "_known": F.coalesce(F.col("kind").isin(KINDS), F.lit(False))})
    sound = given.where("_known and _turn = 1")
    named = (F.coalesce(F.size("probe_ids"), F.lit(0)) > 0) & (F.trim(F.coalesce("reason", F.lit(""))) != "")
    odd = given.where("not _known or _turn > 1").select(task, F.lit("ENVIRONMENT_CHECK_KIND_INVALID").alias("code"))
    bare = sound.where(~named).select(task, F.concat(F.lit("ENVIRONMENT_CHECK_EVIDENCE_REQUIRED:"), "kind").alias("code"))
    each = sound.where(named).select(task, "kind", F.explode("probe_ids").alias("probe_id"))
    met = each.join(probes.withColumn("_there", F.lit(True)), [task, "probe_id"], "left").join(environments.select(task, F.col("workspace_sha256").alias("_now")), task)
    passed = F.col("_there") & F.col("purpose").eqNullSafe(F.col("kind")) & (F.col("status") == "PASS") & F.col("unchanged") & ((F.col("kind") != "reset") | F.col("reproducible"))
    ran = F.forall("executions", lambda x: F.coalesce((x["exit_code"] == 0) & ~x["timed_out"] & (x["after_sha256"] == F.col("_now")), F.lit(False)))
    receipt = (F.col("before_sha256") == F.col("_now")) & (F.col("after_sha256") == F.col("_now")) & (F.size("executions") == F.when(F.col("kind") == "reset", 2).otherwise(1)) & ran
    code = F.when(~F.coalesce(passed, F.lit(False)), "ENVIRONMENT_PROBE_NOT_PASS:").when(~F.coalesce(receipt, F.lit(False)), "ENVIRONMENT_PROBE_RECEIPT_INVALID:")
    failed = met.select(task, F.concat(code, "kind").alias("code")).where("code is not null")
    covered = sound.groupBy(task).agg(F.count_distinct("kind").alias("_kinds"))
    lacking = environments.select(task).join(covered, task, "left").where(F.coalesce("_kinds", F.lit(0)) < len(KINDS)).select(task, F.lit("ENVIRONMENT_PROBES_REQUIRED").alias("code"))
    return odd.union(bare).union(failed).union(lacking).distinct()


def environment_contracts(environments: DataFrame, checks: DataFrame, probes: DataFrame, task: str = "task_id", final: tuple[str, ...] = ("SKIPPED", "INFRA_ERROR")) -> DataFrame:
    """(task, status, context_errors, execution_readiness, execution_errors, probes) of environments (task, status, errors, workspace_sha256, expected_sha256).

    The context's status and the readiness to run are two results: a failed probe is no fault of the context. A workspace
    that is gone (null hash), or changed since it was judged, is a PIPELINE_ERROR; READY with other errors is REVIEW. Of
    a status in `final` no probes are asked for. execution_readiness is NOT_APPLICABLE there and for pipeline errors,
    else PROBED, or FAILED if anything stands against it, a check that is missing too.
    """
    asked = environments.where(~F.coalesce(F.col("status").isin(*final), F.lit(False)))
    failed = _listed(probe_errors(asked, checks.join(asked.select(task), task, "left_semi"), probes, task), task, "failed")
    counted = probes.groupBy(F.col(task).alias("_p")).agg(F.count("*").alias("_n"))
    met = environments.join(failed, F.col(task) == F.col("_failed"), "left").join(counted, F.col(task) == F.col("_p"), "left")
    gone, changed = F.col("workspace_sha256").isNull(), F.col("expected_sha256").isNotNull() & ~F.col("expected_sha256").eqNullSafe(F.col("workspace_sha256"))
    none = F.array().cast("array<string>")
    errors = F.array_sort(F.array_distinct(F.concat(F.coalesce("errors", none), F.array_compact(F.array(_code(gone, "WORKSPACE_NOT_FOUND"), _code(changed, "ENVIRONMENT_CHANGED_AFTER_SUFFICIENCY"))))))
    status = F.when(gone | changed, "PIPELINE_ERROR").when((F.col("status") == "READY") & (F.size(errors) > 0), "REVIEW").otherwise(F.col("status"))
    out = met.select(task, status.alias("status"), errors.alias("context_errors"), F.coalesce("failed", none).alias("execution_errors"), F.coalesce("_n", F.lit(0)).alias("probes"))
    ready = F.when(F.col("status").isin(*final, "PIPELINE_ERROR"), "NOT_APPLICABLE").when(F.size("execution_errors") > 0, "FAILED").otherwise("PROBED")
    return out.select(task, "status", "context_errors", ready.alias("execution_readiness"), "execution_errors", "probes")


def static_fit(bindings: DataFrame, files: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, obligation_id, status, missing) of bindings (task, obligation_id, paths): SATISFIED if all its paths are among files (task, path), else UNSATISFIED with those that are not."""
    each = bindings.select(task, "obligation_id", F.explode("paths").alias("path")).where("path is not null")
    lost = missing_paths(each.select(task, "path").distinct(), files, task)
    missing = each.join(lost, [task, "path"]).groupBy(task, "obligation_id").agg(F.array_sort(F.collect_set("path")).alias("missing"))
    met = bindings.select(task, "obligation_id").distinct().join(missing, [task, "obligation_id"], "left")
    return met.select(task, "obligation_id", F.when(F.col("missing").isNull(), "SATISFIED").otherwise("UNSATISFIED").alias("status"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))


def fit_errors(answers: DataFrame, obligations: DataFrame, bindings: DataFrame, files: DataFrame, probes: DataFrame, task: str = "task_id", conflicts: tuple[str, ...] = ("CONTRADICTION", "UNAVAILABLE")) -> DataFrame:
    """(task, code) of answers (task, pos, obligation_id, status, reason, paths, probe_ids, conflict_kind, repairable) that don't cover the obligations (task, obligation_id).

    An answer is about an obligation, the first about it; its status is known and has a reason; if the obligation binds paths,
    it names paths or probes; these exist; and a conflict is of a known kind, beyond repair, and shown by a probe that failed for
    it, can be repeated and left everything as it was. conflict kinds are the caller's. All obligations have an answer.
    """
    turn = F.row_number().over(Window.partitionBy(task, "obligation_id").orderBy("pos"))
    known = obligations.select(task, "obligation_id").distinct().withColumn("_known", F.lit(True))
    bound = bindings.where(F.size("paths") > 0).select(task, "obligation_id").distinct().withColumn("_bound", F.lit(True))
    probes = probes.select(task, "probe_id", "purpose", "status", "unchanged", "reproducible")
    rows = answers.select(task, "pos", "obligation_id", "status", "reason", "paths", "probe_ids", "conflict_kind", "repairable").withColumn("_turn", turn).join(known, [task, "obligation_id"], "left").join(bound, [task, "obligation_id"], "left")
    strange = rows.where("_known is null or _turn > 1").select(task, F.lit("TASK_FIT_OBLIGATION_INVALID").alias("code"))
    own = rows.where("_known and _turn = 1").withColumn("status", F.upper(F.trim("status")))
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    bare = F.col("_bound").isNotNull() & (size("paths") + size("probe_ids") == 0)
    tell = lambda name: F.concat(F.lit(f"TASK_FIT_{name}:"), "obligation_id")
    codes = F.array_compact(F.array(_code(~F.coalesce(F.col("status").isin(ANSWERS), F.lit(False)), tell("STATUS_INVALID")), _code(F.trim(F.coalesce("reason", F.lit(""))) == "", tell("REASON_REQUIRED")), _code(bare, tell("EVIDENCE_REQUIRED"))))
    told = own.select(task, F.explode(codes).alias("code"))
    rest = own.where(~bare)
    named = rest.select(task, "obligation_id", F.explode("paths").alias("path"))
    lost = named.join(missing_paths(named.select(task, "path").distinct(), files, task), [task, "path"]).select(task, tell("PATH_UNKNOWN").alias("code"))
    refs = rest.select(task, "obligation_id", "status", F.explode("probe_ids").alias("probe_id"))
    unknown = refs.join(probes, [task, "probe_id"], "left_anti").select(task, tell("PROBE_UNKNOWN").alias("code"))
    shows = (F.col("purpose") == "task_conflict") & (F.col("_result") == "FAIL") & F.col("reproducible") & F.col("unchanged")
    proof = refs.join(probes.withColumnRenamed("status", "_result"), [task, "probe_id"]).where(shows).select(task, "obligation_id").distinct().withColumn("_shown", F.lit(True))
    against = rest.where("status = 'UNSATISFIED'").join(proof, [task, "obligation_id"], "left")
    sure = F.coalesce(F.col("conflict_kind").isin(*conflicts) & ~F.col("repairable") & F.col("_shown"), F.lit(False))
    weak = against.where(~sure).select(task, F.concat(F.lit("TASK_CONFLICT_UNCONFIRMED:"), "obligation_id").alias("code"))
    left = known.join(own.select(task, "obligation_id"), [task, "obligation_id"], "left_anti").select(task, F.lit("TASK_FIT_OBLIGATION_COVERAGE").alias("code"))
    return strange.union(told).union(lost).union(unknown).union(weak).union(left).distinct()


def task_fits(tasks: DataFrame, answers: DataFrame, errors: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, decision, errors) of tasks (task, status, decision), the context's status and what the agent decided.

    A context that isn't READY decides itself. Any of fit_errors() leaves REVIEW_TASK_FIT, and so does an answer UNKNOWN,
    each named; otherwise READY_ORIGINAL needs all answers SATISFIED and INCOMPATIBLE one UNSATISFIED, as the agent said.
    """
    named = _listed(errors, task, "errors")
    said = answers.groupBy(F.col(task).alias("_a")).agg(F.collect_set(F.upper(F.trim("status"))).alias("_all"), F.array_sort(F.collect_set(F.when(F.upper(F.trim("status")) == "UNKNOWN", F.concat(F.lit("TASK_FIT_UNKNOWN:"), "obligation_id")))).alias("_open"))
    met = tasks.join(named, F.col(task) == F.col("_errors"), "left").join(said, F.col(task) == F.col("_a"), "left")
    none = F.array().cast("array<string>")
    ready = F.coalesce(F.col("status") == "READY", F.lit(False))
    wanted = F.upper(F.trim("decision"))
    clean = ready & (F.size(F.coalesce("errors", none)) == 0) & (F.size(F.coalesce("_open", none)) == 0)
    original = clean & F.coalesce((wanted == "READY_ORIGINAL") & (F.col("_all") == F.array(F.lit("SATISFIED"))), F.lit(False))
    against = clean & F.coalesce((wanted == "INCOMPATIBLE") & F.array_contains("_all", "UNSATISFIED"), F.lit(False))
    decision = F.when(~ready, F.col("status")).when(original, "READY_ORIGINAL").when(against, "INCOMPATIBLE").otherwise("REVIEW_TASK_FIT")
    own = F.when(~ready, none).when(F.size(F.coalesce("errors", none)) > 0, F.col("errors")).when(F.size(F.coalesce("_open", none)) > 0, F.col("_open")).when(original | against, none).otherwise(F.array(F.lit("TASK_FIT_DECISION_CONFLICT")))
    return met.select(task, decision.alias("decision"), own.alias("errors"))
