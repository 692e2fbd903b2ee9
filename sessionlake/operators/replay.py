"""Replay of file operations: what each file held before a session changed it, what is doubtful, and what was withheld.

An operation is a row (session, pos, kind, path, content, partial, may_mutate) of kind read, absent, write or unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def marked_ops(ops: DataFrame, session: str = "session_id", pos: str = "pos", path: str = "path") -> DataFrame:
    """ops with mutated (a write to the path lies before), doubted (an unknown step that may change files lies before), trusted (a read
    with neither) and first_seen, the position of the path's first trusted read with content."""
    per_path, per_session = Window.partitionBy(session, path), Window.partitionBy(session)
    first_write = F.min(F.when(F.col("kind") == "write", F.col(pos))).over(per_path)
    # one position a session, brought to its operations by a join: a session may be long
    first_unknown = ops.where((F.col("kind") == "unknown") & F.coalesce("may_mutate", F.lit(True))).groupBy(F.col(session).alias("_s")).agg(F.min(pos).alias("_unknown"))
    met = ops.withColumn("_write", first_write).join(first_unknown, F.col(session) == F.col("_s"), "left")
    later = lambda c: F.coalesce(F.col(pos) > F.col(c), F.lit(False))
    told = met.withColumns({"mutated": later("_write"), "doubted": later("_unknown")})
    told = told.withColumn("trusted", F.col("kind").isin("read", "absent") & ~F.col("mutated") & ~F.col("doubted"))
    seen = F.min(F.when(F.col("trusted") & (F.col("kind") == "read") & F.col("content").isNotNull(), F.col(pos))).over(per_path)
    return told.withColumn("first_seen", seen).drop("_s", "_write", "_unknown")


def replay_evidence(ops: DataFrame, session: str = "session_id", pos: str = "pos", path: str = "path") -> DataFrame:
    """(session, pos, path, reason) of operations that prove less than a file's first content."""
    m = marked_ops(ops, session, pos, path)
    kind, seen = F.col("kind"), F.coalesce(F.col("first_seen") < F.col(pos), F.lit(False))
    # The reasons.
    unknown = F.when(~F.coalesce("may_mutate", F.lit(True)), "unparsed_readonly").when(F.col(path).isNull(), "unparsed_mutation_unscoped").otherwise("unparsed_mutation_scope")
    look = F.when(F.col("mutated"), "read_after_first_mutation").when(F.col("doubted"), "read_after_unparsed_mutation")
    look = look.when((kind == "absent") & ~seen, "initial_read_not_found").when((kind == "read") & ~seen & F.col("content").isNull(), "read_result_missing").when((kind == "read") & ~seen & F.coalesce("partial", F.lit(False)), "partial_read_range")
    reason = F.when(kind == "unknown", unknown).when((kind == "write") & seen & F.col(path).isNotNull(), "modified_after_observation").when(kind.isin("read", "absent") & F.col(path).isNotNull(), look)
    shown = F.when(reason != "unparsed_readonly", F.col(path))
    return m.withColumn("reason", reason).where("reason is not null").select(session, pos, shown.alias(path), "reason")


def withheld_changes(ops: DataFrame, session: str = "session_id", pos: str = "pos", path: str = "path") -> DataFrame:
    """(session, pos, path, classification, final_content) of writes: withheld_change if the file was observed before, else agent_created_file."""
    m = marked_ops(ops, session, pos, path).where((F.col("kind") == "write") & F.col(path).isNotNull())
    observed = F.coalesce(F.col("first_seen") < F.col(pos), F.lit(False))
    return m.select(session, pos, path, F.when(observed, "withheld_change").otherwise("agent_created_file").alias("classification"), F.col("content").alias("final_content"))


def prior_observations(ops: DataFrame, starts: DataFrame, session: str = "session_id", pos: str = "pos", path: str = "path", returned: str = "returned_pos") -> DataFrame:
    """(session, pos, path, kind, valid) of reads and absences of earlier tasks: those submitted and returned before the task's start
    (session, task_start). Valid after the last unknown step and the last write to the path, and after the last absence (at it, for an absence)."""
    prior = ops.join(starts, session).where((F.col(pos) < F.col("task_start")) & (F.col(returned) < F.col("task_start")))
    barrier = prior.where((F.col("kind") == "unknown") & F.coalesce("may_mutate", F.lit(True))).groupBy(F.col(session).alias("_s")).agg(F.max(pos).alias("_unknown"))
    last = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col(pos))).over(Window.partitionBy(session, path)), F.lit(-1))
    met = prior.withColumns({"_write": last("write"), "_absent": last("absent")}).join(barrier, F.col(session) == F.col("_s"), "left")
    fresh = F.col(pos) > F.greatest(F.coalesce("_unknown", F.lit(-1)), "_write")
    valid = fresh & F.when(F.col("kind") == "absent", F.col(pos) >= F.col("_absent")).otherwise(F.col(pos) > F.col("_absent"))
    return met.where(F.col("kind").isin("read", "absent")).select(session, pos, path, "kind", valid.alias("valid"))


def stage_one_files(events: DataFrame, session: str = "session_id", pos: str = "pos", path: str = "path") -> DataFrame:
    """(session, path, content, source_pos, completeness) of events (session, pos, kind, call_id, path, partial, text) of kind read, write, shell or result.

    The first result of a whole read that was called before the session's first write or shell step; PARTIAL if a later
    write changes the file. A result answers the last such read of its call's id that is still open.
    """
    first = F.min(F.when(F.col("kind").isin("write", "shell"), F.col(pos)))
    barrier = events.groupBy(F.col(session).alias("_s")).agg(first.alias("_barrier"))
    met = events.join(barrier, F.col(session) == F.col("_s"))
    open_ = (F.col("kind") == "read") & F.col(path).isNotNull() & F.coalesce(F.col(pos) < F.col("_barrier"), F.lit(True))
    turn = Window.partitionBy(session, "call_id").orderBy(pos)
    asked = F.lag(F.when(open_, F.struct(F.col(path).alias("path"), F.col(pos).alias("pos"), F.coalesce("partial", F.lit(False)).alias("partial")))).over(turn)
    answers = met.where(open_ | (F.col("kind") == "result")).withColumn("_call", asked).where((F.col("kind") == "result") & F.col("_call").isNotNull() & ~F.col("_call.partial") & F.col("text").isNotNull())
    seen = answers.groupBy(session, F.col("_call.path").alias(path)).agg(F.min_by("text", pos).alias("content"), F.min_by("_call.pos", pos).alias("source_pos"), F.min(pos).alias("_seen"))
    writes = events.where("kind = 'write'").groupBy(F.col(session).alias("_ws"), F.col(path).alias("_wp")).agg(F.max(pos).alias("_last"))
    out = seen.join(writes, (F.col(session) == F.col("_ws")) & (F.col(path) == F.col("_wp")), "left")
    return out.select(session, path, "content", "source_pos", F.when(F.col("_last") > F.col("_seen"), "PARTIAL").otherwise("COMPLETE").alias("completeness"))


def most_exposed(trajectories: DataFrame, files: DataFrame, identity: list[str], key: str = "trajectory_id", content: str = "content") -> DataFrame:
    """(identity, key, files, lines, bytes): of each identity the trajectory that shows most files, then lines, bytes and the largest key. Identities with an empty part are left out."""
    text = F.coalesce(F.col(content), F.lit(""))
    lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + (text != "").cast("int")
    sums = files.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("files"), F.sum(lines).alias("lines"), F.sum(F.octet_length(text)).alias("bytes"))
    met = trajectories.join(sums, F.col(key) == F.col("_k"), "left").select(*identity, key, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("files", "lines", "bytes")))
    for c in identity:
        met = met.where(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    best = met.groupBy(*identity).agg(F.max(F.struct("files", "lines", "bytes", key)).alias("b"))
    return best.select(*identity, f"b.{key}", "b.files", "b.lines", "b.bytes")


def overlay(replayed: DataFrame, completed: DataFrame, group: str = "task_id", path: str = "path", content: str = "content") -> DataFrame:
    """(group, path, content, kind, replay_completeness): all files, those of completed (with kind) in place of replayed ones (with completeness), which keep what is known of their replay."""
    left = replayed.select(group, path, F.col(content).alias("_old"), F.col("completeness").alias("replay_completeness"), F.lit(True).alias("_replayed"))
    right = completed.select(group, path, F.col(content).alias("_new"), F.when(F.col("kind").isin("MODEL_COMPLETED", "SYNTHETIC_STUB", "NEIGHBOR"), F.col("kind")).otherwise("MODEL_COMPLETED").alias("_kind"))
    met = left.join(right, [group, path], "full")
    return met.select(group, path, F.when(F.col("_kind").isNotNull(), F.col("_new")).otherwise(F.col("_old")).alias("content"), F.coalesce("_kind", F.lit("REPLAYED")).alias("kind"), "replay_completeness")


def common_folder(paths: DataFrame, group: str = "session_id", path: str = "path") -> DataFrame:
    """(group, folder): what the folders of all absolute paths of a group, with a drive or without, have in common; needs two different folders, and two parts in common.

    The common beginning of a set is that of its least and its greatest member, so two partial aggregates are enough.
    """
    parts = F.split(F.replace(F.col(path), F.lit("\\"), F.lit("/")), "/", -1)
    folders = paths.where(F.replace(F.col(path), F.lit("\\"), F.lit("/")).rlike("^(?:[A-Za-z]:)?/")).select(group, F.slice(parts, 1, F.size(parts) - 1).alias("f")).where(F.size("f") > 1)
    ends = folders.groupBy(group).agg(F.min("f").alias("a"), F.max("f").alias("b"))
    same = F.filter(F.sequence(F.lit(1), F.least(F.size("a"), F.size("b"))), lambda k: F.slice("a", 1, k) == F.slice("b", 1, k))
    n = F.coalesce(F.array_max(same), F.lit(0))
    return ends.where(F.col("a") != F.col("b")).where(n >= 3).select(group, F.array_join(F.slice("a", 1, n), "/").alias("folder"))


def numbering_resets(numbers: Column) -> Column:
    """Whether line numbers, six or more, step back anywhere: then they come from several readings."""
    back = F.exists(F.arrays_zip(F.slice(numbers, 1, F.greatest(F.size(numbers) - 1, F.lit(0))).alias("a"), F.slice(numbers, 2, F.greatest(F.size(numbers) - 1, F.lit(0))).alias("b")), lambda x: x["b"] < x["a"])
    return F.coalesce((F.size(numbers) >= 6) & back, F.lit(False))


def completion_holes(candidates: DataFrame, absent: DataFrame, group: str = "task_id", path: str = "path") -> DataFrame:
    """(group, path, kind) of candidates (group, path, kind): PARTIAL before MISSING_BODY, SUPPORT and STUB, one for each path; ABSENT where the first read did not find it. Folders have none."""
    rank = F.array_position(F.array(*map(F.lit, ("PARTIAL", "MISSING_BODY", "SUPPORT", "STUB"))), F.col("kind"))
    first = candidates.where(~F.endswith(path, F.lit("/"))).groupBy(group, path).agg(F.min_by("kind", rank).alias("kind"))
    gone = absent.select(group, path).distinct().withColumn("_absent", F.lit(True))
    return first.join(gone, [group, path], "left").select(group, path, F.when(F.col("_absent"), "ABSENT").otherwise(F.col("kind")).alias("kind"))


def repaired_captures(originals: DataFrame, repairs: DataFrame, group: str = "capture_id", text: str = "text") -> DataFrame:
    """(group, repaired, code) of originals with their repairs (group, old_text, new_text, reason): each old text must stand once in the
    original, and no two may overlap; all are applied to the original's own positions. CRLF is LF. code is null for a sound result."""
    unix = lambda c: F.replace(F.col(c), F.lit("\r\n"), F.lit("\n"))
    listed = repairs.groupBy(group).agg(F.collect_list(F.struct(unix("old_text").alias("old"), unix("new_text").alias("new"), (F.trim(F.coalesce("reason", F.lit(""))) == "").alias("blank"))).alias("r"))  # of one capture
    met = originals.select(group, unix(text).alias("t")).join(listed, group, "left")
    bad = F.exists("r", lambda x: x["old"].isNull() | (x["old"] == "") | x["new"].isNull() | x["blank"])
    at = lambda x: F.position(x["old"], F.col("t"))
    # a second occurrence may overlap the first: it is looked for one character on
    once = F.forall("r", lambda x: (at(x) > 0) & (F.position(x["old"], F.substring(F.col("t"), at(x) + 1, F.char_length("t"))) == 0))
    spans = F.array_sort(F.transform("r", lambda x: F.struct(at(x).alias("a"), (at(x) + F.char_length(x["old"])).alias("b"), x["new"].alias("new"))))
    placed = met.withColumns({"bad": F.coalesce(bad, F.lit(False)), "once": F.coalesce(once, F.lit(True))}).withColumn("s", F.when(~F.col("bad") & F.col("once") & F.col("t").isNotNull(), F.coalesce(spans, F.array().cast("array<struct<a:int,b:int,new:string>>"))))
    none = F.struct(F.lit(1).alias("at"), F.substring("t", 1, 0).alias("text"), F.lit(False).alias("overlap"))
    step = lambda acc, x: F.struct(x["b"].alias("at"), F.concat(acc["text"], F.substring(F.col("t"), acc["at"], x["a"] - acc["at"]), x["new"]).alias("text"), (acc["overlap"] | (x["a"] < acc["at"])).alias("overlap"))
    done = placed.withColumn("d", F.aggregate("s", none, step)).withColumn("whole", F.concat("d.text", F.substring(F.col("t"), F.col("d.at"), F.char_length("t"))))
    # Codes, in this order.
    code = F.when(F.col("bad"), "CAPTURE_REPAIRS_INVALID").when(F.col("t").isNull() & F.col("r").isNotNull(), "CAPTURE_REPAIR_REQUIRES_OBSERVATION").when(~F.col("once"), "CAPTURE_REPAIR_OLD_TEXT_NOT_UNIQUE")
    code = code.when(F.col("d.overlap"), "CAPTURE_REPAIR_OVERLAP").when(F.col("r").isNotNull() & (F.col("whole") == ""), "CAPTURE_REPAIR_EMPTY_RESULT")
    return done.withColumn("code", code).select(group, F.when(F.col("code").isNull(), F.col("whole")).alias("repaired"), "code")
