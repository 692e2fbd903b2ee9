"""Session operators over message tables: request spans, replies, calls with their results, line inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered_spans(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role") -> DataFrame:
    """messages with span_no: 0 before the first user message, then one more at each user message that follows another role."""
    order = Window.partitionBy(session).orderBy(pos)
    starts = (F.col(role) == "user") & ~F.lag(role).over(order).eqNullSafe(F.lit("user"))
    return messages.withColumn("span_no", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))


def request_spans(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role") -> DataFrame:
    """(session, span_no, message_start, message_end past the last, user_messages, truncated_target) of each request."""
    spans = numbered_spans(messages, session, pos, role).where("span_no > 0").groupBy(session, "span_no")
    return spans.agg(F.min(pos).alias("message_start"), (F.max(pos) + 1).alias("message_end"), F.count_if(F.col(role) == "user").alias("user_messages"), (F.count_if(F.col(role) == "assistant") == 0).alias("truncated_target"))


def previous_replies(messages: DataFrame, session: str = "session_id", pos: str = "pos", role: str = "role", text: str = "text") -> DataFrame:
    """Each user message with the position of the last non-empty assistant reply before it, null if none."""
    before = Window.partitionBy(session).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    reply = F.when((F.col(role) == "assistant") & (F.trim(F.coalesce(F.col(text), F.lit(""))) != ""), F.col(pos))
    return messages.withColumn("reply_pos", F.last(reply, ignorenulls=True).over(before)).where(F.col(role) == "user")


def matched_calls(events: DataFrame, session: str = "session_id", pos: str = "pos", kind: str = "kind", call_id: str = "call_id") -> DataFrame:
    """events with state: matched, pending (a call without a result) or orphan (a result without a call).

    A result matches the call before it of the same id if nothing of that id lies between; a repeated call leaves the
    earlier one pending, a second result is an orphan. Events with a null or empty id never match.
    """
    order = Window.partitionBy(session, call_id).orderBy(pos)
    named = F.coalesce(F.col(call_id).cast("string"), F.lit("")) != ""
    pairs = named & F.when(F.col(kind) == "result", F.lag(kind).over(order) == "call").otherwise(F.lead(kind).over(order) == "result")
    return events.withColumn("state", F.when(F.coalesce(pairs, F.lit(False)), "matched").when(F.col(kind) == "call", "pending").otherwise("orphan"))


def linkage_errors(events: DataFrame, session: str = "session_id", pos: str = "pos", kind: str = "kind", call_id: str = "call_id", span: str = "span_no") -> DataFrame:
    """Results whose last call of that id is missing (orphan_tool_result) or in another span (tool_link_crosses_span)."""
    before = Window.partitionBy(session, call_id).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    call = F.last(F.when(F.col(kind) == "call", F.struct(F.col(pos).alias("pos"), F.col(span).alias("span"))), ignorenulls=True).over(before)
    found = events.withColumn("call", call).where((F.col(kind) == "result") & F.col(call_id).isNotNull())
    code = F.when(F.col("call").isNull(), "orphan_tool_result").when(~F.col("call.span").eqNullSafe(F.col(span)), "tool_link_crosses_span")
    return found.withColumn("code", code).where("code is not null").withColumn("call_pos", F.col("call.pos")).drop("call")


def lines_of(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, line_number from 1, line_sha256, byte_offset, byte_length): line feeds are part of their lines; a null or empty text has none."""
    # what stands beside a generator is computed for each of its rows: the text is split once, before
    split = docs.select(F.col(source), F.explode(F.array(F.split(F.col(text), "\n", -1))).alias("pieces"))
    rows = split.select(source, F.size("pieces").alias("n"), F.posexplode("pieces").alias("at", "line"))
    raw = rows.withColumn("raw", F.encode(F.when(F.col("at") < F.col("n") - 1, F.concat("line", F.lit("\n"))).otherwise(F.col("line")), "UTF-8")).where(F.octet_length("raw") > 0)
    # hashes and lengths meet, not lines
    told = raw.select(source, "at", F.sha2("raw", 256).alias("line_sha256"), F.octet_length("raw").cast("long").alias("byte_length"))
    before = Window.partitionBy(source).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return told.select(source, (F.col("at") + 1).alias("line_number"), "line_sha256", F.coalesce(F.sum("byte_length").over(before), F.lit(0)).cast("long").alias("byte_offset"), "byte_length")


def line_ranges(lines: DataFrame, group: str = "path", number: str = "line") -> DataFrame:
    """(group, first, last) of the runs of consecutive numbers; repeats count once."""
    island = F.col(number) - F.row_number().over(Window.partitionBy(group).orderBy(number))
    return lines.select(group, number).distinct().withColumn("island", island).groupBy(group, "island").agg(F.min(number).alias("first"), F.max(number).alias("last")).drop("island")


def first_observations(ops: DataFrame, session: str = "session_id", path: str = "path", pos: str = "pos", kind: str = "kind", mutates: str = "may_mutate", content: str = "content") -> DataFrame:
    """(session, path, observed, observed_pos, trusted_reads, after_write, after_unparsed): what each file held at first.

    A read is trusted unless it follows a write to its path or, failing that, an unknown step of the session that may
    change files. Observed is the content of the earliest trusted read that has any.
    """
    session_bar = ops.where((F.col(kind) == "unknown") & F.col(mutates)).groupBy(F.col(session).alias("_s")).agg(F.min(pos).alias("unparsed_pos"))
    path_bar = F.min(F.when(F.col(kind) == "write", F.col(pos))).over(Window.partitionBy(session, path))
    reads = ops.withColumn("write_pos", path_bar).where(F.col(kind) == "read").join(session_bar, F.col(session) == F.col("_s"), "left")
    late = F.col(pos) > F.col("write_pos")
    unparsed = ~F.coalesce(late, F.lit(False)) & F.coalesce(F.col(pos) > F.col("unparsed_pos"), F.lit(False))
    trusted = ~F.coalesce(late, F.lit(False)) & ~unparsed
    with_text = F.when(trusted & F.col(content).isNotNull(), F.col(pos))
    return reads.groupBy(session, path).agg(F.min_by(content, with_text).alias("observed"), F.min(with_text).alias("observed_pos"), F.count_if(trusted).alias("trusted_reads"), F.count_if(late).alias("after_write"), F.count_if(unparsed).alias("after_unparsed"))


def strict_sum(column: Column) -> Column:
    """The sum if there are rows and none is null, else null."""
    return F.when((F.count(column) == F.count("*")) & (F.count("*") > 0), F.sum(column))
