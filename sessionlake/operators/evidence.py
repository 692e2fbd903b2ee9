"""Gates, queues and metrics over evidence: curation, capability contrast, review ranking, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What ranks a row for review.
DECISION_RANKS = {"ELIGIBLE": 4, "REVIEW": 3, "DEFER": 2, "REJECT": 0}
OUTCOME_RANKS = {"FAILURE": 3, "INCOMPLETE": 3, "UNCERTAIN": 1, "SUCCESS": 0}
RECOVERABILITY_RANKS = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}


def _rank(column: str, ranks: dict[str, int], other: int) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in ranks.items():
        out = F.coalesce(out, F.when(F.col(column) == name, F.lit(rank)))
    return F.coalesce(out, F.lit(other))


def review_queue(reports: DataFrame, limit: int, keys: tuple[str, ...] = ("report_id",), ingest: str = "ingest_pos", failure: str | None = None) -> DataFrame:
    """The `limit` reports that rank first, each key once (the earliest ingested); reports without any key are left out.

    The key is the first of `keys` that is neither null nor empty. Ranked by decision, outcome, recoverability, rubric
    total (evidence and targets where that is 0) plus confidence, key. A null decision is REVIEW and a null outcome
    FAILURE if the column `failure` names one, else DEFER and UNCERTAIN.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    key = F.coalesce(*(F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys))
    known = reports.withColumn("_key", key).where("_key is not null")
    once = known.withColumn("_first", F.row_number().over(Window.partitionBy("_key").orderBy(ingest))).where("_first = 1").drop("_first")
    failed = F.coalesce(F.col(failure), F.lit("INCONCLUSIVE")) != "INCONCLUSIVE" if failure else F.lit(False)
    once = once.withColumns({"_decision": F.coalesce("decision", F.when(failed, "REVIEW").otherwise("DEFER")), "_outcome": F.coalesce("outcome", F.when(failed, "FAILURE").otherwise("UNCERTAIN"))})
    weight = F.when(F.coalesce(F.col("rubric_total"), F.lit(0)) == 0, F.col("evidence_count")).otherwise(F.col("rubric_total")) + F.coalesce("confidence", F.lit(0.0))
    ranked = once.withColumns({"decision_rank": _rank("_decision", DECISION_RANKS, 1), "outcome_rank": _rank("_outcome", OUTCOME_RANKS, 0), "recoverability_rank": _rank("recoverability", RECOVERABILITY_RANKS, 0), "weight": weight})
    return ranked.orderBy(*(F.desc(c) for c in ("decision_rank", "outcome_rank", "recoverability_rank", "weight", "_key"))).limit(limit).drop("_key", "_decision", "_outcome")


# What an eligible candidate has passed, and what is wrong with one that can't be judged.
PASSES = ["VERIFIER_PASS", "REWARD_PASS", "CONFIDENCE_PASS", "LEAKAGE_CHECK_PASS", "REPRODUCIBLE"]


def curated(candidates: DataFrame, task: float = 0.8, environment: float = 0.8, quality: float = 0.7, reward: float = 1.0, ids: tuple[str, ...] = ("candidate_id",)) -> DataFrame:
    """candidates with eligibility, rejection_reasons, selection_reasons and input_errors.

    Hard failures reject, missing evidence asks for review. A candidate without one of its ids, a confidence or the
    quality, or with a reward outside 0 to 1, has input_errors and no eligibility.
    """
    code = lambda condition, name: F.when(F.coalesce(condition, F.lit(False)), F.lit(name))
    c = F.col
    numbers = ("task_confidence", "environment_confidence", "trajectory_quality")
    finite = lambda n: ~(c(n).isNull() | F.isnan(c(n).cast("double")) | (F.abs(c(n).cast("double")) == float("inf")))
    absent = [*(code(F.coalesce(c(i).cast("string"), F.lit("")) == "", f"{i.upper()}_MISSING") for i in (*ids, "verifier_status")), *(code(~finite(n), f"{n.upper()}_INVALID") for n in numbers)]
    wrong = F.array_compact(F.array(*absent, code(c("reward").isNotNull() & ~c("reward").cast("double").between(0, 1), "REWARD_INVALID")))
    # Reason codes, in this order.
    rejects = F.array_compact(F.array(
        code(~c("verifier_status").isin("PASS", "INCONCLUSIVE"), "VERIFIER_NOT_PASS"), code(c("reward") < reward, "REWARD_BELOW_THRESHOLD"), code(c("task_confidence") < task, "TASK_CONFIDENCE_LOW"),
        code(c("environment_confidence") < environment, "ENVIRONMENT_CONFIDENCE_LOW"), code(c("trajectory_quality") < quality, "TRAJECTORY_QUALITY_LOW"), code(c("solution_leakage"), "SOLUTION_LEAKAGE"), code(~c("reproducible"), "NOT_REPRODUCIBLE"),
    ))
    reviews = F.array_compact(F.array(
        code(c("verifier_status") == "INCONCLUSIVE", "VERIFIER_UNVERIFIED"), code(c("reward").isNull(), "REWARD_UNVERIFIED"), code(c("solution_leakage").isNull(), "SOLUTION_LEAKAGE_UNVERIFIED"), code(c("reproducible").isNull(), "REPRODUCIBILITY_UNVERIFIED"),
    ))
    all_ = candidates.withColumns({"input_errors": wrong, "_rejects": rejects, "_reviews": reviews})
    eligibility = F.when(F.size("input_errors") > 0, None).when(F.size("_rejects") > 0, "REJECT").when(F.size("_reviews") > 0, "REVIEW").otherwise("ELIGIBLE")
    none = F.array().cast("array<string>")
    against = F.when(c("eligibility") == "REJECT", c("_rejects")).when(c("eligibility") == "REVIEW", c("_reviews")).otherwise(none)
    passes = F.when(c("eligibility") == "ELIGIBLE", F.array(*map(F.lit, PASSES))).otherwise(none)
    return all_.withColumn("eligibility", eligibility).withColumns({"rejection_reasons": against, "selection_reasons": passes}).drop("_rejects", "_reviews")


def overall_status(tasks: DataFrame, group: str) -> DataFrame:
    """(group, status): ELIGIBLE if all its tasks are, PENDING if some are and none is ELIGIBLE, else REVIEW."""
    n = tasks.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col("eligibility") == "ELIGIBLE").alias("eligible"), F.count_if(F.col("eligibility") == "PENDING").alias("pending"))
    status = F.when(F.col("eligible") == F.col("n"), "ELIGIBLE").when((F.col("pending") > 0) & (F.col("eligible") == 0), "PENDING").otherwise("REVIEW")
    return n.select(group, status.alias("status"))


def curation_metrics(gated: DataFrame) -> DataFrame:
    """One row: counts by eligibility and rates, 0 without input."""
    n = F.count("*")
    share = lambda name: F.coalesce(F.count_if(F.col("eligibility") == name) / F.nullif(n, F.lit(0)), F.lit(0.0))
    return gated.agg(n.alias("input_count"), *(F.count_if(F.col("eligibility") == x).alias(f"{x.lower()}_count") for x in ("ELIGIBLE", "REVIEW", "REJECT")), share("ELIGIBLE").alias("eligibility_rate"), share("REVIEW").alias("review_rate"))


def label_partition_errors(cells: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(run, capability, code, ids): labels that don't cover the trajectories of known outcome exactly once; the first of
    LABEL_LIST_OVERLAP (an id twice), UNTRUSTED_OUTCOME_LABEL, LABEL_PARTITION_INCOMPLETE (missing or unknown ids)."""
    trust = outcomes.select(F.col("trajectory_id").alias("_id"), F.col("outcome").isin("SUCCESS", "FAILURE").alias("_trusted")).distinct()
    total = trust.agg(F.count_if("_trusted").alias("_total"))
    once = cells.groupBy("run", "capability", "trajectory_id").agg(F.count("*").alias("n"))
    met = once.join(trust, F.col("trajectory_id") == F.col("_id"), "left").groupBy("run", "capability")
    sums = met.agg(F.count_if(F.col("n") > 1).alias("twice"), F.count_if(~F.col("_trusted")).alias("untrusted"), F.count_if(F.col("_id").isNull()).alias("extra"), F.count_if("_trusted").alias("there"))
    all_ = sums.join(F.broadcast(total), how="cross").withColumn("missing", F.col("_total") - F.col("there"))  # one row: the total
    code = F.when(F.col("twice") > 0, "LABEL_LIST_OVERLAP").when(F.col("untrusted") > 0, "UNTRUSTED_OUTCOME_LABEL").when((F.col("missing") > 0) | (F.col("extra") > 0), "LABEL_PARTITION_INCOMPLETE")
    ids = F.when(F.col("twice") > 0, F.col("twice")).when(F.col("untrusted") > 0, F.col("untrusted")).otherwise(F.col("missing") + F.col("extra"))
    return all_.select("run", "capability", code.alias("code"), ids.alias("ids")).where("code is not null")


def capability_metrics(cells: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(run, capability, counts, coverage, error rates, contrastive_gap) of (run, capability, cell, trajectory_id).

    Only trajectories of outcome SUCCESS or FAILURE count (see label_partition_errors()), each once in a cell; coverage
    is the share of all failures that lack the capability; error rates leave out cells that don't apply and are 0
    without any. No rows where either outcome is missing.
    """
    known = outcomes.where(F.col("outcome").isin("SUCCESS", "FAILURE")).select("trajectory_id", "outcome").distinct()
    trusted = known.agg(F.count_if(F.col("outcome") == "FAILURE").alias("failures"), F.count_if(F.col("outcome") == "SUCCESS").alias("successes"))
    count = lambda name: F.count_distinct(F.when(F.col("cell") == name, F.col("trajectory_id")))
    labelled = cells.join(known.select("trajectory_id"), "trajectory_id", "left_semi")
    sums = labelled.groupBy("run", "capability").agg(*(count(x).alias(x) for x in ("lacking_failed", "present_failed", "lacking_passed", "present_passed")))
    rate = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)), F.lit(0.0))
    met = sums.join(F.broadcast(trusted), how="cross").where("failures > 0 and successes > 0")  # one row: totals
    rates = met.withColumns({"coverage": F.col("lacking_failed") / F.col("failures"), "error_rate_failed": rate("lacking_failed", "present_failed"), "error_rate_success": rate("lacking_passed", "present_passed")})
    return rates.withColumn("contrastive_gap", F.col("error_rate_failed") - F.col("error_rate_success")).drop("failures", "successes")


def selected_capabilities(metrics: DataFrame, runs: int, rho: float = 0.1, delta: float = 0.2, least: int | None = None) -> DataFrame:
    """(capability, coverage, contrastive_gap, pass_count, consistency_ratio, status): averages over runs, SELECTED if at
    least `least` runs pass both thresholds. A capability that a run lacks is INCOMPLETE_RUNS; no metrics, no rows."""
    passes = F.count_if((F.col("coverage") >= rho) & (F.col("contrastive_gap") >= delta))
    out = metrics.groupBy("capability").agg((F.sum("coverage") / runs).alias("coverage"), (F.sum("contrastive_gap") / runs).alias("contrastive_gap"), passes.alias("pass_count"), F.count_distinct("run").alias("_runs"))
    status = F.when(F.col("_runs") < runs, "INCOMPLETE_RUNS").when(F.col("pass_count") >= (least or runs), "SELECTED").otherwise("REJECTED")
    return out.withColumns({"consistency_ratio": F.col("pass_count") / runs, "status": status}).drop("_runs")


def failed_examples(cells: DataFrame, most: int = 8) -> DataFrame:
    """(capability, examples): the first `most` ids, sorted, that failed without it in any run."""
    ids = cells.where("cell = 'lacking_failed'").select("capability", "trajectory_id").distinct()
    rank = F.row_number().over(Window.partitionBy("capability").orderBy("trajectory_id"))
    return ids.withColumn("_k", rank).where(F.col("_k") <= most).groupBy("capability").agg(F.sort_array(F.collect_list("trajectory_id")).alias("examples"))


def stage_funnel(stages: DataFrame) -> DataFrame:
    """(stage, tasks, ready, review, not_run) of (task_id, stage, status); a null status was not run."""
    status = F.coalesce("status", F.lit("NOT_RUN"))
    return stages.groupBy("stage").agg(F.count("*").alias("tasks"), F.count_if(status.isin("READY", "READY_VARIANT")).alias("ready"), F.count_if(status == "REVIEW").alias("review"), F.count_if(status == "NOT_RUN").alias("not_run"))


def boundary_mismatches(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of the distinct keys that only one side has."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(True)), right.select(key).distinct().withColumn("_r", F.lit(True))
    return a.join(b, key, "full").where("_l is null or _r is null").select(key, F.when(F.col("_r").isNull(), "left_only").otherwise("right_only").alias("side"))
