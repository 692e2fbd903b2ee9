"""Audits of runs: ledgers, retries, partial reads, rollouts, rounds, steps and paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ledger_gaps(ledger: DataFrame, key: str = "operation_id", event: str = "event") -> DataFrame:
    """(key, created, terminal, code) of the operations that are not closed or that end without a creation; one pass over the ledger. Null keys are left out."""
    sums = ledger.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_if(F.col(event) == "created").alias("created"), F.count_if(F.col(event) == "terminal").alias("terminal"))
    code = F.when((F.col("created") > 0) & (F.col("terminal") == 0), "not_terminated").when((F.col("created") == 0) & (F.col("terminal") > 0), "terminal_without_creation")
    return sums.withColumn("code", code).where("code is not null")


def superseded_failures(exchanges: DataFrame, identity: list[str], key: str = "exchange_id", order: str = "log_pos", started: str = "started_at", finished: str = "finished_at", ok: str = "ok") -> DataFrame:
    """Each failed exchange with superseded_by: the next success of the same identity in log order, if it starts when the failure has ended or later; else null.

    Exchanges without both times, or that end before they start, take no part. One running value over each identity in descending order.
    """
    timed = F.coalesce(F.col(finished) >= F.col(started), F.lit(False))
    after = Window.partitionBy(*identity).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    success = F.last(F.when(F.col(ok) & timed, F.struct(F.col(started).alias("at"), F.col(key).alias("key"))), ignorenulls=True).over(after)
    found = exchanges.withColumn("_next", success).where(~F.coalesce(F.col(ok), F.lit(False)))
    return found.withColumn("superseded_by", F.when(timed & (F.col(finished) <= F.col("_next.at")), F.col("_next.key"))).drop("_next")


def merged_reads(lines: DataFrame, path: str = "path", number: str = "line", text: str = "text", total: str = "total", valid: str | None = None) -> DataFrame:
    """(path, status, lines, content) of partial reads: COMPLETE where lines 1 to the known total are there, else PARTIAL.

    RANGE_MISMATCH where a read's range was wrong or a line lies past the total, CONFLICT where a line has two texts,
    TOTAL_CONFLICT where two totals are known. Content ends every line with a line feed and is null unless COMPLETE.
    Repeated reads of equal text count once; reads that know no total leave it to the others.
    """
    wrong = F.max(~F.coalesce(F.col(valid), F.lit(True))) if valid else F.lit(False)
    once = lines.groupBy(path, number).agg(F.min(text).alias("text"), F.count_distinct(text).alias("texts"), F.min(total).alias("least"), F.max(total).alias("most"), wrong.alias("wrong"))
    whole = once.groupBy(path).agg(
        F.max("texts").alias("texts"), F.min("least").alias("least"), F.max("most").alias("most"), F.max("wrong").alias("wrong"), F.count(number).alias("lines"), F.min(number).alias("first"),
        F.max(number).alias("last"), F.sort_array(F.collect_list(F.struct(number, "text"))).alias("all"),
    )
    complete = (F.col("first") == 1) & (F.col("last") == F.col("most")) & (F.col("lines") == F.col("most"))
    status = F.when(F.col("wrong"), "RANGE_MISMATCH").when(F.col("texts") > 1, "CONFLICT").when(F.col("least") < F.col("most"), "TOTAL_CONFLICT").when(F.col("last") > F.col("most"), "RANGE_MISMATCH")
    status = status.when(F.coalesce(complete, F.lit(False)), "COMPLETE").otherwise("PARTIAL")
    content = F.concat(F.array_join(F.transform("all.text", lambda x: F.concat(x, F.lit("\n"))), ""))
    return whole.withColumn("status", status).select(path, "status", "lines", F.when(F.col("status") == "COMPLETE", content).alias("content"))


def missing_ranges(lines: DataFrame, path: str = "path", number: str = "line", total: str = "total") -> DataFrame:
    """(path, first, last) of the lines from 1 to total that no row has: before the first, between neighbours, after the last.

    One row with nulls for a path whose total no row knows: what is missing there isn't known. Paths with two totals or
    with a line past the total have none.
    """
    seen = lines.where(f"{number} is not null").groupBy(path, number).agg(F.max(total).alias("_high"), F.min(total).alias("_low"))
    every, order = Window.partitionBy(path), Window.partitionBy(path).orderBy(number)
    placed = seen.withColumns({"_before": F.coalesce(F.lag(number).over(order), F.lit(0)), "_next": F.lead(number).over(order), "_most": F.max("_high").over(every), "_least": F.min("_low").over(every), "_last": F.max(number).over(every)})
    sound = placed.where(F.col("_most").isNull() | (F.col("_most") == F.col("_least")) & (F.col("_last") <= F.col("_most")))
    gap = lambda a, b: F.struct(a.cast("long").alias("first"), b.cast("long").alias("last"))
    gaps = F.filter(F.array(gap(F.col("_before") + 1, F.col(number) - 1), gap(F.col(number) + 1, F.when(F.col("_next").isNull(), F.col("_most")))), lambda g: g["first"] <= g["last"])
    unknown = F.array(gap(F.lit(None), F.lit(None)))
    shown = F.when(F.col("_most").isNotNull(), gaps).when(F.col("_next").isNull(), unknown)
    return sound.select(path, F.explode(shown).alias("gap")).select(path, "gap.first", "gap.last")


def most_common_value(rows: DataFrame, group: str, value: str, pos: str = "pos") -> DataFrame:
    """(group, value, uses): the most common non-null value, of equal ones that which came first."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("uses"), F.min(pos).alias("_first"))
    return counts.groupBy(group).agg(F.max_by(F.struct(value, "uses"), F.struct("uses", -F.col("_first"))).alias("m")).select(group, f"m.{value}", "m.uses")


def rollout_metrics(trials: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts by status, pass rate (0 without trials), tokens known (0 if none) and mean seconds (null if none), over all trials or by group."""
    n = F.count("*")
    rate = F.coalesce(F.count_if(F.col("status") == "PASS") / F.nullif(n, F.lit(0)), F.lit(0.0))
    sums = [F.count_if(F.col("status") == x).alias(x.lower()) for x in ("PASS", "FAIL", "INFRA_ERROR", "INCONCLUSIVE")]
    return trials.groupBy(*(by or [])).agg(n.alias("trials"), *sums, rate.alias("pass_rate"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.avg("seconds").alias("mean_seconds"))


def padded_trials(trials: DataFrame, expected: DataFrame, job: str = "job_id") -> DataFrame:
    """trials with a row of status INFRA_ERROR and error_code TRIAL_RESULT_MISSING for each that (job, expected_trials) has too few of."""
    counted = expected.join(trials.groupBy(job).agg(F.count("*").alias("_n")), job, "left")
    short = F.col("expected_trials") - F.coalesce("_n", F.lit(0))
    missing = counted.where(short > 0).select(job, F.explode(F.sequence(F.lit(1), short.cast("int"))).alias("_k"))
    missing = missing.select(job, F.format_string("missing-trial-%03d", "_k").alias("trial_name"), F.lit("INFRA_ERROR").alias("status"), F.lit("TRIAL_RESULT_MISSING").alias("error_code"))
    return trials.unionByName(missing, allowMissingColumns=True)


def job_metrics(trials: DataFrame, job: str = "job_id") -> DataFrame:
    """(job, trials, completed, passed, rates, tokens, mean_seconds): PASS, FAIL and COMPLETED are complete; tokens are those known, mean_seconds is null without any."""
    n = F.count("*")
    yes = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    sums = trials.groupBy(job).agg(
        n.alias("trials"), F.count_if(F.col("status").isin("PASS", "FAIL", "COMPLETED")).alias("completed"), F.count_if(F.col("status") == "PASS").alias("passed"), yes("trajectory_present").alias("trajectories"),
        yes("manifest_present").alias("manifests"), F.count_if(F.col("content_valid") == F.lit(False)).alias("invalid"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.avg("seconds").alias("mean_seconds"),
    )
    return sums.withColumns({f"{a}_rate": F.col(b) / F.col("trials") for a, b in (("completion", "completed"), ("pass", "passed"), ("trajectory", "trajectories"), ("manifest", "manifests"))})


def job_gate(metrics: DataFrame, expected: str = "expected_trials", cleanup: str = "cleanup_ok") -> DataFrame:
    """metrics (of job_metrics(), with `expected` trials, null for any number, and `cleanup`) with reasons array and ok."""
    code = lambda condition, name: F.when(F.coalesce(condition, F.lit(False)), F.lit(name))
    # The reasons, in this order.
    reasons = F.array_compact(F.array(
        code(F.col("trials") == 0, "NO_TRIAL_RESULTS"), code(F.col("trials") != F.col(expected), "TRIAL_COUNT_MISMATCH"), code(F.col("completed") != F.col("trials"), "TRIAL_INCOMPLETE_OR_INFRA_ERROR"),
        code(~F.coalesce(F.col(cleanup), F.lit(False)), "SANDBOX_CLEANUP_UNCONFIRMED"), code(F.col("manifests") != F.col("trials"), "ARTIFACT_MANIFEST_MISSING"), code(F.col("trajectories") != F.col("trials"), "TRAJECTORY_MISSING"),
        code(F.col("invalid") > 0, "TRAJECTORY_OR_ARTIFACT_CONTENT_INVALID"),
    ))
    return metrics.withColumn("reasons", reasons).withColumn("ok", F.size("reasons") == 0)


def quality_gate(metrics: DataFrame, expected: int) -> DataFrame:
    """metrics with gate (PASS or REVIEW) and its reasons: trials missing, infrastructure errors, inconclusive trials."""
    code = lambda condition, name: F.when(condition, F.lit(name))
    reasons = F.array_compact(F.array(code(F.col("trials") != expected, "TRIAL_COUNT_MISMATCH"), code(F.col("infra_error") > 0, "INFRA_ERRORS"), code(F.col("inconclusive") > 0, "INCONCLUSIVE_TRIALS")))
    return metrics.withColumn("reasons", reasons).withColumn("gate", F.when(F.size("reasons") == 0, "PASS").otherwise("REVIEW"))


def latest_by_key(updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last update of each key; combines before the shuffle. Null keys are left out."""
    return updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*updates.columns), F.struct(*order)).alias("u")).select("u.*")


def verified_sessions(rounds: DataFrame, session: str = "session_id", number: str = "round_index", status: str = "status", least: int = 2) -> DataFrame:
    """(session, rounds, passed, retained): retained if at least `least` rounds pass and rounds are numbered from 0 without gaps or repeats."""
    sums = rounds.groupBy(session).agg(F.count("*").alias("rounds"), F.count_if(F.col(status) == "PASS").alias("passed"), F.min(number).alias("_first"), F.max(number).alias("_last"), F.count_distinct(number).alias("_n"))
    whole = (F.col("_first") == 0) & (F.col("_last") == F.col("rounds") - 1) & (F.col("_n") == F.col("rounds"))
    return sums.select(session, "rounds", "passed", (F.coalesce(whole, F.lit(False)) & (F.col("passed") >= least)).alias("retained"))


def red_check(cases: DataFrame, group: str = "task_id", required: tuple[str, ...] = ("oracle_pass", "nop_fail", "mutation_fail")) -> DataFrame:
    """(group, cases, wrong, missing array, passed) of (group, kind, expected, observed): all as expected, and every required kind there."""
    sums = cases.groupBy(group).agg(F.count("*").alias("cases"), F.count_if(~F.col("expected").eqNullSafe(F.col("observed"))).alias("wrong"), F.collect_set("kind").alias("_kinds"))
    missing = F.array_except(F.array(*map(F.lit, required)), "_kinds")
    return sums.withColumn("missing", missing).withColumn("passed", (F.col("wrong") == 0) & (F.size("missing") == 0)).drop("_kinds")


def step_errors(steps: DataFrame, trajectory: str = "trajectory_id", pos: str = "pos", step: str = "step_id") -> DataFrame:
    """(trajectory, pos, step, expected) of the steps that are not numbered from 1 in order of position."""
    expected = F.row_number().over(Window.partitionBy(trajectory).orderBy(pos))
    return steps.withColumn("expected", expected).where(~F.col("expected").eqNullSafe(F.col(step))).select(trajectory, pos, step, "expected")


def reason_counts(reasons: DataFrame, task: str = "task_id", reason: str = "reason") -> DataFrame:
    """(reason, tasks): how many tasks give a reason; a task counts once."""
    return reasons.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count_distinct(task).alias("tasks"))


def coverage(rows: DataFrame, expected: DataFrame, source: str = "source", size: str = "bytes") -> DataFrame:
    """(source, records, bytes, status) of what was declared (source, records, bytes): READY if both agree, else PARTIAL_SOURCE; one row for each declared source."""
    found = rows.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_records"), F.sum(size).alias("_bytes"))
    met = expected.join(found, F.col(source).eqNullSafe(F.col("_source")), "left")
    records, n = F.coalesce("_records", F.lit(0)), F.coalesce("_bytes", F.lit(0))
    same = F.col("records").eqNullSafe(records) & F.col("bytes").eqNullSafe(n)
    return met.select(source, records.alias("records"), n.alias("bytes"), F.when(same, "READY").otherwise("PARTIAL_SOURCE").alias("status"))


def duplicate_lines(lines: DataFrame, digest: str = "line_sha256") -> DataFrame:
    """One row: rows, distinct digests and duplicates over all sources."""
    return lines.groupBy(digest).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), F.count("*").alias("distinct_lines"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def safe_relative_path(path: Column) -> Column:
    """Whether a path is relative, not empty, and has no part that is empty, a dot or two dots, no backslash and no NUL; null: false."""
    parts = F.split(path, "/", -1)
    bad = F.exists(parts, lambda x: x.isin("", ".", ".."))
    return F.coalesce((path != "") & ~bad & ~path.contains("\\") & ~path.contains("\u0000"), F.lit(False))


def ancestors(path: Column) -> Column:
    """The directories above a path, from the top; none for a bare name, null for null."""
    parts = F.split(path, "/", -1)
    return F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x, i: F.array_join(F.slice(parts, 1, i + 1), "/"))
