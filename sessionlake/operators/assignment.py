"""Which captured call stands behind which message of an assistant: a greedy assignment in order, each call used once."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digests(tool_ids: str, text: str) -> tuple[Column, Column]:
    """Of a side: its set of tool ids, 0 without any, and its text; without nulls, which pandas would turn into doubles."""
    ids = F.array_sort(F.array_distinct(F.filter(F.coalesce(tool_ids, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")))
    return F.when(F.size(ids) > 0, F.xxhash64(ids)).otherwise(F.lit(0).cast("long")).alias("tools"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("said")


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of session, calls before messages, and number."""
    session: tuple | None = None
    unused: dict[int, None] = {}
    by_tools: dict[int, deque] = defaultdict(deque)
    by_text: dict[int, deque] = defaultdict(deque)

    def first(queue: deque) -> int | None:
        while queue and queue[0] not in unused:
            queue.popleft()
        return queue[0] if queue else None

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"session_id": [x[0] for x in out], "pos": pd.array([x[1] for x in out], dtype="Int64"), "call_no": pd.array([x[2] for x in out], dtype="Int64"), "rule": pd.array([x[3] for x in out], dtype="string")})

    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if session is None or session[0] != row.session_id:
                out += [(session[0], None, n, None) for n in unused] if session else []
                session, unused = (row.session_id,), {}
                by_tools.clear()
                by_text.clear()
            if not row.is_message:
                unused[row.number] = None
                (by_tools[row.tools] if row.tools else by_text[row.said]).append(row.number)
                continue
            found, rule = first(by_tools[row.tools]) if row.tools else first(by_text[row.said]), "TOOLS" if row.tools else "TEXT"
            if found is None and unused:
                found, rule = next(iter(unused)), "NEXT"
            unused.pop(found, None)
            out.append((session[0], row.number, found, rule if found is not None else None))
        if out:
            yield frame(out)
    if session and unused:
        yield frame([(session[0], None, n, None) for n in unused])


def assigned_calls(messages: DataFrame, calls: DataFrame) -> DataFrame:
    """(session_id, pos, call_no, rule) of messages (session_id, pos, tool_ids, text) and calls (session_id, call_no, tool_ids, text).

    Messages come in order of pos. Each takes the first call not taken before that has the same set of tool ids (TOOLS);
    without tool ids, the first without any that says the same (TEXT); where none does, the first that is left (NEXT).
    A message beyond the calls has a null call and rule; a call that no message took has a null pos and rule. Null and
    empty ids count as none, a null text as empty. Positions and numbers are whole, not null, and differ within a session;
    a null session is a session. A session's rows stream through one task, which holds the digests of its calls.
    """
    side = lambda t, number, is_message: t.select("session_id", F.lit(is_message).alias("is_message"), F.col(number).cast("long").alias("number"), *_digests("tool_ids", "text"))
    rows = side(calls, "call_no", False).unionByName(side(messages, "pos", True)).repartition("session_id").sortWithinPartitions("session_id", "is_message", "number")
    return rows.mapInPandas(_fold, f"session_id {dict(rows.dtypes)['session_id']}, pos long, call_no long, rule string")
