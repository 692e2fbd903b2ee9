"""Workspaces and outputs: test results, wrapped and segmented outputs, numbered ranges, file names, includes, stubs, restored context, set digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.functions.text import leaked_solutions
from sessionlake.operators.messages import stripped


def test_results(spark: SparkSession, path: str) -> DataFrame:
    """(name, classname, status, message) of the testcase elements of JUnit files: ERROR before FAIL before SKIPPED before PASS; message is the element's text or its attribute."""
    part = "struct<_VALUE:string,_message:string>"
    read = spark.read.format("xml").option("rowTag", "testcase").schema(f"_name string, _classname string, error {part}, failure {part}, skipped {part}").load(path)
    kinds = (("error", "ERROR"), ("failure", "FAIL"), ("skipped", "SKIPPED"))
    status = reduce(lambda rest, k: F.when(F.col(k[0]).isNotNull(), k[1]).otherwise(rest), reversed(kinds), F.lit("PASS"))
    said = lambda k: F.coalesce(F.nullif(stripped(F.col(f"{k}._VALUE")), F.lit("")), stripped(F.col(f"{k}._message")), F.lit(""))
    told = F.coalesce(*(F.when(F.col(k).isNotNull(), said(k)) for k, _ in kinds))
    return read.select(F.coalesce("_name", F.lit("")).alias("name"), F.coalesce("_classname", F.lit("")).alias("classname"), status.alias("status"), F.nullif(told, F.lit("")).alias("message"))


# How the lines begin that are put before a command's output, each with the letter of its kind; heads are made of them in this order.
HEAD_LINES = [("script completed", "s"), ("script failed", "s"), ("exit code:", "s"), ("wall time", "t"), ("total output lines:", "n"), ("warning:", "n"), ("output:", "o")]


def unwrapped_output(text: Column) -> Column:
    """A command's output without the heads put before it, however many: a status, a time, notes or none, and the word that the output follows.

    Each line becomes the letter of its kind, `x` if it has none; heads are read off the letters, and as many lines go.
    """
    lines = F.split(text, "\n", -1)

    def kind(line: Column) -> Column:
        low = F.lower(F.regexp_replace(line, "\r$", ""))
        rest = lambda start: F.trim(F.substring(low, len(start) + 1, 2**31 - 1))
        whole = {"s": lambda start: (rest(start) == "") if start[-1] != ":" else rest(start).rlike("^[0-9]+$"), "t": lambda start: F.char_length(low) > len(start), "n": lambda start: F.lit(True), "o": lambda start: low == start}
        return F.coalesce(*(F.when(F.startswith(low, F.lit(start)) & whole[k](start), k) for start, k in HEAD_LINES), F.lit("x"))

    # the last piece has no line's end, so it is output
    letters = F.array_join(F.transform(F.slice(lines, 1, F.size(lines) - 1), kind), "")
    heads = F.char_length(F.regexp_extract(letters, "^(?:stn*o)+", 0))
    return F.array_join(F.slice(lines, heads + 1, F.size(lines)), "\n")


def result_segments(text: Column) -> Column:
    """The bodies after the marks `--- result 1 ---` or `--- 1 ---` at a line's beginning, two or more and numbered from 1 without gaps; else null. What stands on a mark's line begins its body."""
    mark = r"(?mi)^---[ \t]*(?:result[ \t]+)?([0-9]{1,9})[ \t]*---[ \t]*"
    numbers = F.transform(F.regexp_extract_all(text, F.lit(mark), F.lit(1)), lambda x: x.cast("int"))
    n = F.size(numbers)
    bodies = F.transform(F.slice(F.split(text, mark, -1), 2, F.greatest(n, F.lit(1))), lambda x: F.regexp_replace(x, r"\A[\r\n]+", ""))
    return F.when((n >= 2) & (numbers == F.sequence(F.lit(1), F.greatest(n, F.lit(1)))), bodies)


def numbered_ranges(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, start_line, end_line, first_number, separator) of runs of lines that begin with numbers one after another and the same separator (a tab or a colon and a space)."""
    head = r"^[ \t]*([0-9]{1,9})(\t|: )"
    lines = texts.select(key, F.posexplode(F.split(text, "\r?\n", -1)).alias("i", "line")).where(F.col("line").rlike(head))
    known = lines.select(key, (F.col("i") + 1).alias("i"), F.regexp_extract("line", head, 1).cast("int").alias("n"), F.regexp_extract("line", head, 2).alias("separator")).withColumn("step", F.col("n") - F.col("i"))
    island = F.col("i") - F.row_number().over(Window.partitionBy(key, "separator", "step").orderBy("i"))
    return known.withColumn("island", island).groupBy(key, "separator", "step", "island").agg(F.min("i").alias("start_line"), F.max("i").alias("end_line"), F.min("n").alias("first_number")).select(key, "start_line", "end_line", "first_number", "separator")


# Endings of two parts that files have, and members of variables that look like files.
DOUBLE_ENDINGS = ["d.ts", "min.js", "spec.ts", "test.ts", "test.js", "mod.c"]
MEMBERS = ["name.c", "path.c", "value.c", "v2.c", "v3.c"]
#: What words with dots and slashes are that are no files: a table of kinds, each as a pattern of the part that tells it.
NO_FILES = {
    "variable or range": r"[$]|[.]{2}",  # $HOME/x, 3..9
    "version": r"(?:^|/)[0-9]+(?:[.][0-9]+){1,3}[A-Za-z]?(?:/|$)",  # 1.2.3, lib/2.0b
    "number of a publication": r"(?:^|/)[0-9]{2}[.][0-9]{4}",  # 10.1234/x
    "member": rf"(?i)(?:^|/)(?:{'|'.join(m.replace('.', '[.]') for m in MEMBERS)})$",  # path.c
    "member in humps": r"(?:^|/)[a-z]\w*[A-Z]\w*[.]c$",  # myVal.c
    "chain of members": rf"(?i)(?:^|/)(?![^/]*[.](?:{'|'.join(e.replace('.', '[.]') for e in DOUBLE_ENDINGS)})$)[^/.]*[.][^/.]*[.][^/]*$",  # a.b.c, but not x.d.ts
}


def looks_like_file(name: Column) -> Column:
    """Whether a word may be a file's name: it has a short ending or a folder, and is nothing of NO_FILES. Slashes may lean either way; a remark that the file is missing is no part of it."""
    word = F.trim(F.translate(F.replace(name, F.lit(" (missing)"), F.lit("")), "\\", "/"))
    other = reduce(Column.__or__, (word.rlike(pattern) for pattern in NO_FILES.values()))
    return F.coalesce((F.contains(word, F.lit("/")) | word.rlike("[.][A-Za-z0-9]{1,8}$")) & ~other, F.lit(False))


def resolved(folder: Column, reference: Column) -> Column:
    """A relative reference as seen from a folder, with `.` and `..` resolved; null if it leaves the top."""
    parts = F.filter(F.split(F.concat_ws("/", folder, reference), "/", -1), lambda x: ~x.isin("", "."))
    start = F.struct(F.array().cast("array<string>").alias("p"), F.lit(True).alias("ok"))
    up = lambda acc: F.struct(F.slice(acc["p"], 1, F.greatest(F.size(acc["p"]) - 1, F.lit(0))).alias("p"), (acc["ok"] & (F.size(acc["p"]) > 0)).alias("ok"))
    done = F.aggregate(parts, start, lambda acc, x: F.when(x == "..", up(acc)).otherwise(F.struct(F.concat(acc["p"], F.array(x)).alias("p"), acc["ok"].alias("ok"))))
    return F.when(done["ok"], F.array_join(done["p"], "/"))


def missing_includes(files: DataFrame, group: str = "task_id", path: str = "path", text: str = "text") -> DataFrame:
    """(group, path, reference) of what XML files include (an element `include` with `file`) that their workspace lacks; absolute and variable references are left out."""
    # the attributes of each such element, by name; values may stand in either kind of quotes
    tags = files.where(F.endswith(F.lower(path), F.lit(".xml"))).select(group, path, F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?i)<include(\s[^<>]*)>"), F.lit(1))).alias("_tag"))
    part = lambda k: F.regexp_extract_all("_tag", F.lit(r"""([\w:.-]+)\s*=\s*("[^"]*"|'[^']*')"""), F.lit(k))
    attributes = tags.select(group, path, F.explode(F.arrays_zip(part(1).alias("name"), part(2).alias("value"))).alias("_a"))
    named = attributes.where(F.lower("_a.name") == "file").select(group, path, F.trim(F.expr("substring(_a.value, 2, char_length(_a.value) - 2)")).alias("reference"))
    named = named.where((F.col("reference") != "") & ~F.startswith("reference", F.lit("/")) & ~F.startswith("reference", F.lit("$")))
    parts = F.split(path, "/", -1)
    target = named.withColumn("_target", resolved(F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"), F.col("reference")))
    there = files.select(F.col(group).alias("_g"), F.col(path).alias("_p")).distinct()
    return target.join(there, (F.col(group) == F.col("_g")) & (F.col("_target") == F.col("_p")), "left_anti").select(group, path, "reference")


# Files that support a project, whose bodies may be made up.
SUPPORT_FILES = ["readme.md", "license", "makefile", "requirements.txt", "package.json", "pyproject.toml", "setup.py", "dockerfile", ".gitignore"]


def _marked(rows: DataFrame, group: str, path: str, bit: int) -> DataFrame:
    return rows.select(group, path, F.lit(bit).alias("_mark"))


def stub_errors(candidates: DataFrame, named: DataFrame, observed: DataFrame, group: str = "task_id", path: str = "path", content: str = "content", stub: str = "is_stub") -> DataFrame:
    """(group, path, code BINDING_PATH_STUB_ONLY) of candidate files without a body of their own (null, blank or `stub`) whose path is required, or whose
    path or name was listed (named: group, path), and whose body nobody observed. Logs and support files may be empty."""
    name = F.element_at(F.split(path, "/"), -1)
    empty = candidates.where(F.coalesce(stripped(F.col(content)), F.lit("")).eqNullSafe("") | F.coalesce(stub, F.lit(False)))
    real = empty.where(~F.lower(name).isin(SUPPORT_FILES) & ~F.endswith(F.lower(name), F.lit(".lock")) & ~F.endswith(F.lower(name), F.lit(".log")))
    either = real.select(group, path, F.explode(F.array_distinct(F.array(F.col(path), name))).alias("_as"))
    # names beside what they may be, sorted once: no join, so none that broadcasts lists by their compressed size
    lists = _marked(named, group, path, 1).union(_marked(observed, group, path, 2)).select(group, F.col(path).alias("_as"), F.lit(None).cast("string").alias(path), "_mark")
    told = either.select(group, "_as", path, F.lit(0).alias("_mark")).union(lists.dropna(subset=[group, "_as"]))
    marks = told.withColumn("_mark", F.bit_or("_mark").over(Window.partitionBy(group, "_as"))).where(F.col(path).isNotNull())
    found = marks.where("_mark > 0").groupBy(group, path).agg(F.bit_or("_mark").alias("_mark"))
    return found.where("_mark = 1").select(group, path, F.lit("BINDING_PATH_STUB_ONLY").alias("code"))


def completion_errors(candidates: DataFrame, required: DataFrame, observed: DataFrame, changes: DataFrame, group: str = "task_id", path: str = "path") -> DataFrame:
    """(group, path, code) of what keeps completed workspaces from being used: stubs, leaked solutions, required files that neither candidate nor observation has, and files outside the workspace."""
    unsafe = candidates.where(F.startswith(path, F.lit("/")) | F.array_contains(F.split(path, "/", -1), "..")).select(group, path, F.lit("PATH_UNSAFE").alias("code"))
    stubs = stub_errors(candidates, required, observed, group, path)
    leaks = leaked_solutions(candidates, changes, group, path, "content").select(group, path, F.lit("SOLUTION_LEAKAGE").alias("code"))
    # a null is no file that is there
    there = _marked(candidates, group, path, 2).union(_marked(observed, group, path, 2)).dropna(subset=[group, path])
    marks = _marked(required, group, path, 1).union(there).repartition(group, path)
    first = F.row_number().over(Window.partitionBy(group, path).orderBy(F.desc("_mark")))
    missing = marks.withColumn("_first", first).where("_first = 1 and _mark = 1").select(group, path, F.lit("BINDING_PATH_MISSING").alias("code"))
    return reduce(DataFrame.union, (stubs, leaks, missing), unsafe)


def context_errors(references: DataFrame, messages: DataFrame, tasks: DataFrame, session: str = "session_id", pos: str = "pos") -> DataFrame:
    """references (session, pos, message_index, used_by, quote) with code, null for sound ones: messages (session, message_index, role, text), tasks (session, message_index of its users).

    A message may be used by a user message of the task that follows it; later ones only if assistant's or tool's, in a
    quote; system messages in a quote. Quotes stand in the text; each reference once.
    """
    users = messages.where("role = 'user'").join(tasks.select(session, "message_index").distinct(), [session, "message_index"], "left_semi").select(F.col(session).alias("_us"), F.col("message_index").alias("_user"))
    first = users.groupBy(F.col("_us").alias("_fs")).agg(F.min("_user").alias("_first"))
    met = references.join(messages.select(session, "message_index", "role", "text"), [session, "message_index"], "left").join(users, (F.col(session) == F.col("_us")) & (F.col("used_by") == F.col("_user")), "left")
    all_ = met.join(first, F.col(session) == F.col("_fs"), "left")
    role, quoted = F.col("role"), F.col("quote").isNotNull()
    again = F.row_number().over(Window.partitionBy(session, "message_index", "used_by", "quote").orderBy(pos)) > 1
    later = F.col("message_index") >= F.col("_first")
    invalid = F.col("_user").isNull() | ~F.coalesce(role.isin("system", "developer", "user", "assistant", "tool"), F.lit(False)) | ((F.col("message_index") > F.col("used_by")) & ~role.isin("assistant", "tool"))
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    code = F.when(invalid, "CONTEXT_REFERENCE_INVALID").when((role != "user") & later & ~(role.isin("assistant", "tool") & quoted), "CONTEXT_AFTER_TASK_START").when(role.isin("system", "developer") & ~quoted, "CONTEXT_QUOTE_REQUIRED")
    code = code.when(quoted & (blank("quote") | ~F.coalesce(F.contains("text", F.col("quote")), F.lit(False))), "CONTEXT_QUOTE_NOT_FOUND").when(~quoted & blank("text"), "CONTEXT_EMPTY").when(F.col("_again"), "CONTEXT_REPEATED")
    return all_.withColumn("_again", again).withColumn("code", code).select(*references.columns, "code")


def set_digest(rows: DataFrame, digest: str = "row_sha256") -> DataFrame:
    """One row: rows, set_sha256. The digest of a multiset of row hashes in any order: the hashes' eight words are summed, by partial sums, and the sums hashed."""
    word = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("decimal(38,0)")
    sums = rows.agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(word(k)), F.lit(0).cast("decimal(38,0)")).alias(f"w{k}") for k in range(8)))
    return sums.select("rows", F.sha2(F.encode(F.concat_ws(",", *(F.col(f"w{k}").cast("string") for k in range(8))), "UTF-8"), 256).alias("set_sha256"))


def publish_once(rows: DataFrame, path: str) -> None:
    """Writes a batch to a new folder; fails where there is one already. Spark's committer shows all of it or nothing."""
    rows.write.mode("errorifexists").parquet(path)
