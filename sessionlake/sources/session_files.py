"""Session logs as files: lines with their place, hash and validity; look-ups, coverage, inventories, review inputs.

Files are read by Spark's text source with a line feed as separator, so a large one is many splits. A line's number and
byte offset are prefix sums in two levels: within its split, and over the splits of its file, which are few.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.functions.values import has_list, is_json, json_value
from sessionlake.sources.digests import chained_digests
from sessionlake.sources.storage import stored

#: Files of more bytes are read by splits.
WHOLE = 32 << 20
#: Bytes of a piece of a file, about.
PIECE = 1 << 20


def file_lines(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """(source, line_number from 1, raw, line_sha256, byte_offset, byte_length) of all lines of text files; the line feed is part of a line.

    source is the path below `root`, the whole path without one. Empty files have no lines. raw is the line's text
    without its line feed; a carriage return is kept. Numbers fit any size of file; a line must fit one row.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    rows = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))
    rows = rows.withColumn("bytes", F.octet_length("raw").cast("long") + 1)
    inside = Window.partitionBy("file", "block").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumns({"in_block": F.row_number().over(inside), "before": F.coalesce(F.sum("bytes").over(upto), F.lit(0))})
    blocks = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(F.col("file").alias("f"), F.col("block").alias("k"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b0"))
    met = placed.join(starts, (F.col("file") == F.col("f")) & (F.col("block") == F.col("k")))
    offset = F.col("b0") + F.col("before")
    # the last line of a file may have no line feed: then one byte more was counted than the file has
    length = F.least(F.col("bytes"), F.col("size") - offset)
    # the bytes as they are: encode() would mend what is no UTF-8
    own = F.col("raw").cast("binary")
    raw = F.when(length == F.col("bytes"), F.concat(own, F.unhex(F.lit("0A")))).otherwise(own)
    source = below(root, "file") if root else F.col("file")
    return met.select(source.alias("source"), (F.col("n0") + F.col("in_block")).cast("long").alias("line_number"), "raw", F.sha2(raw, 256).alias("line_sha256"), offset.cast("long").alias("byte_offset"), length.cast("long").alias("byte_length"))


def session_validity(raw: Column) -> Column:
    """INVALID_JSON or INVALID_SESSION for a line that is no JSON, or no object with a list of messages; null for a sound one.

    Keys may repeat, the last one counts, and NaN and infinities are numbers. Bytes that are no UTF-8 are no JSON.
    """
    start = F.substring(F.regexp_replace(raw, r"^\ufeff?[ \t\r\n]*", ""), 1, 1)
    sound = (start == "{") & has_list(raw, "messages")
    return F.when(~F.is_valid_utf8(raw) | ~is_json(raw), "INVALID_JSON").when(~F.coalesce(sound, F.lit(False)), "INVALID_SESSION")


def session_inventory(lines: DataFrame, rubric: str = "source") -> DataFrame:
    """lines (of file_lines()) with session_id, label, input_status (PENDING or INVALID_INPUT) and error; ids come from source, number and hash."""
    identity = F.concat_ws(":", F.col(rubric), F.col("line_number"), F.col("line_sha256"))
    error = session_validity(F.col("raw"))
    named = {"session_id": F.concat(F.lit("session_"), F.substring(F.sha2(F.encode(identity, "UTF-8"), 256), 1, 24)), "label": F.format_string("%s-l%06d", F.lower(rubric), "line_number"), "error": error}
    return lines.withColumns(named).withColumn("input_status", F.when(F.col("error").isNull(), "PENDING").otherwise("INVALID_INPUT"))


def source_digests(lines: DataFrame, source: str = "source") -> DataFrame:
    """(source, sha256) of the whole files behind file_lines(): lines go on where those before them ended, as in chained_digests()."""
    own = F.col("raw").cast("binary")
    whole = F.when(F.col("byte_length") > F.octet_length(own), F.concat(own, F.unhex(F.lit("0A")))).otherwise(own)
    return chained_digests(lines.select(F.col(source).alias("whole"), F.col("byte_offset").alias("at"), whole.alias("bytes"))).select(F.col("whole").alias(source), "sha256")


def source_summary(inventory: DataFrame, declared: DataFrame, source: str = "source") -> DataFrame:
    """(source, records, bytes, sha256, valid, invalid, duplicates, errors, status) for each declared source (source, records, bytes, sha256): duplicates are
    lines that stand before in any source, in order of source and line; errors name what differs from the declaration. An absent source is an empty one."""
    first = F.min(F.struct(source, "line_number")).over(Window.partitionBy("line_sha256"))
    told = inventory.withColumn("_again", first != F.struct(source, "line_number"))
    sums = told.groupBy(F.col(source).alias("_s")).agg(F.count("*").alias("_n"), F.sum("byte_length").alias("_b"), F.count_if(F.col("input_status") == "PENDING").alias("_ok"), F.count_if("_again").alias("_dup"))
    digests = source_digests(inventory, source).select(F.col(source).alias("_d"), F.col("sha256").alias("_h"))
    names = {"records": "_records", "bytes": "_bytes", "sha256": "_sha256"}
    met = declared.withColumnsRenamed(names).join(sums, F.col(source) == F.col("_s"), "left").join(digests, F.col(source) == F.col("_d"), "left")
    n = {"records": "_n", "bytes": "_b", "valid": "_ok", "duplicates": "_dup"}
    out = met.withColumns({k: F.coalesce(v, F.lit(0)) for k, v in n.items()}).withColumn("sha256", F.coalesce("_h", F.sha2(F.lit(b""), 256)))
    wrong = lambda k: F.when(~F.col(k).eqNullSafe(F.col(f"_{k}")), F.lit(f"SOURCE_COVERAGE_MISMATCH:{k}"))
    errors = F.array_compact(F.array(*map(wrong, names)))
    return out.select(source, "records", "bytes", "sha256", "valid", (F.col("records") - F.col("valid")).alias("invalid"), "duplicates", F.array_join(errors, ",").alias("errors"), F.when(F.size(errors) == 0, "READY").otherwise("PARTIAL_SOURCE").alias("status"))


def looked_up(wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """wanted (source, line_number, line_sha256 or null) with raw and status: FOUND, LINE_MISSING or HASH_MISMATCH; raw only if FOUND."""
    have = lines.select(F.col("source").alias("_s"), F.col("line_number").alias("_n"), F.col("line_sha256").alias("_h"), "raw")
    met = wanted.join(have, (F.col("source") == F.col("_s")) & (F.col("line_number") == F.col("_n")), "left")
    status = F.when(F.col("_h").isNull(), "LINE_MISSING").when(F.coalesce("line_sha256", "_h") != F.col("_h"), "HASH_MISMATCH").otherwise("FOUND")
    return met.withColumn("status", status).withColumn("raw", F.when(F.col("status") == "FOUND", F.col("raw"))).drop("_s", "_n", "_h")


def inventory_errors(inventory: DataFrame, pending: int | None = None) -> DataFrame:
    """(session_id, code) of what forbids a batch: sessions not PENDING, fields missing, ids with a path or repeated, and with a null id a count other than `pending`."""
    fields = ("session_id", "source", "line_number", "line_sha256")
    missing = F.exists(F.array(*(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields)), lambda x: x == "")
    path = F.contains("session_id", F.lit("/")) | F.col("session_id").isin(".", "..")
    codes = F.array_compact(F.array(F.when(~F.col("input_status").eqNullSafe(F.lit("PENDING")), "NOT_PENDING"), F.when(missing, "FIELD_MISSING"), F.when(path, "SESSION_ID_IS_PATH")))
    own = inventory.select("session_id", F.explode(codes).alias("code"))
    again = inventory.groupBy("session_id").count().where("count > 1").select("session_id", F.lit("SESSION_ID_REPEATED").alias("code"))
    total = inventory.agg(F.count("*").alias("n")).where(F.lit(pending is not None) & (F.col("n") != F.lit(pending or 0))).select(F.lit(None).cast("string").alias("session_id"), F.lit("COUNT_MISMATCH").alias("code"))
    return own.union(again).union(total)


def json_objects(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """lines that aren't blank, with status OK, NOT_JSON or NOT_OBJECT."""
    v = json_value(F.col(raw))
    status = F.when(v.isNull(), "NOT_JSON").when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "NOT_OBJECT").otherwise("OK")
    return lines.where(F.trim(F.regexp_replace(raw, r"(?U)\s", " ")) != "").withColumn("status", status)


def evidence_records(documents: DataFrame, key: str = "source", raw: str = "raw") -> DataFrame:
    """(key, pos, record) of JSON texts: the objects of a list, of the first list among messages, events and exchanges, or the object itself; other texts give none."""
    v = json_value(F.col(raw))
    items = lambda path: F.try_variant_get(v, path, "array<variant>")
    listed = lambda path: F.when(F.startswith(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("ARRAY")), items(path))
    own = F.when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.array(v))
    found = F.coalesce(listed("$"), listed("$.messages"), listed("$.events"), listed("$.exchanges"), own)
    objects = F.filter(found, lambda x: F.startswith(F.schema_of_variant(x), F.lit("OBJECT")))
    return documents.select(key, F.posexplode(objects).alias("pos", "v")).select(key, "pos", F.to_json("v").alias("record"))


def trial_results(spark: SparkSession, folder: str) -> DataFrame:
    """(trial_name, raw) of <folder>/<trial>/result.json files, whole; their fields are taken from the JSON text where needed."""
    read = spark.read.option("wholetext", "true").text(f"{folder.rstrip('/')}/*/result.json")
    return read.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("trial_name"), F.col("value").alias("raw"))


def trial_fields(results: DataFrame) -> DataFrame:
    """(trial_name, exception_type, reward, seconds) of trial_results(): exception_type is empty for one without a name, reward that of the task, seconds from start to end, 0 at least."""
    get = lambda p: F.get_json_object("raw", p)
    exception = F.when(get("$.exception_info").isNotNull(), F.coalesce(get("$.exception_info.exception_type"), F.lit("")))
    return results.select("trial_name", exception.alias("exception_type"), get("$.verifier_result.rewards.task").try_cast("double").alias("reward"), duration_seconds(get("$.started_at"), get("$.finished_at"), get("$.elapsed_s").try_cast("double")).alias("seconds"))


def duration_seconds(started: Column, finished: Column, elapsed: Column) -> Column:
    """Seconds between two ISO times, 0 at least; null if one is malformed; `elapsed` where one is missing."""
    at = lambda c: F.try_to_timestamp(F.replace(c, F.lit("T"), F.lit(" "))).cast("double")
    return F.when(started.isNotNull() & finished.isNotNull(), F.greatest(F.lit(0.0), at(finished) - at(started)) + F.when(at(started).isNotNull() & at(finished).isNotNull(), 0.0)).otherwise(elapsed)


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path) of all files of a folder, empty ones too, as Spark lists them: the driver holds the names, as for any scan."""
    found = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(root).inputFiles()
    return spark.createDataFrame([(p,) for p in found], "path string")


def below(root: str, path: str | Column) -> Column:
    """A path below root; whether and how either names its file system does not matter."""
    return F.substring_index(path, re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "", root).rstrip("/") + "/", -1)


def decoded(path: str) -> Column:
    """A name as it is: in lists of files it is escaped as in an address."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of splits, in their order, as pieces: (file, size, block, inside, bytes), each line with a line feed; inside is the piece's place in its split."""
    key, inside, held, n = None, 0, [], 0
    for batch in batches:
        out = []
        for *own, value in batch.itertuples(index=False):
            if own != key or n >= PIECE:
                out += [(*key, inside, b"".join(held))] if held else []
                key, inside, held, n = own, inside + n if own == key else 0, [], 0
            held += (value, b"\n")
            n += len(value) + 1
        yield pd.DataFrame(out, columns=["file", "size", "block", "inside", "bytes"])
    if held:
        yield pd.DataFrame([(*key, inside, b"".join(held))], columns=["file", "size", "block", "inside", "bytes"])


def _long_files(spark: SparkSession, root: str) -> DataFrame:
    """(path below root, at, bytes) of files of more than WHOLE bytes: they are read by splits and stored as pieces, so no task reads more than its splits. A line must fit one row."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root).where(F.col("_metadata.file_size") > WHOLE)
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    packed = stored(rows.mapInPandas(_packed, "file string, size long, block long, inside long, bytes binary").withColumn("length", F.octet_length("bytes").cast("long")))
    blocks = packed.groupBy(F.col("file").alias("_f"), F.col("block").alias("_k")).agg(F.sum("length").alias("_b"))
    earlier = Window.partitionBy("_f").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_f", "_k", F.coalesce(F.sum("_b").over(earlier), F.lit(0)).alias("_b0"))
    at = (F.col("_b0") + F.col("inside")).cast("long")
    # behind a last line without a line feed one was put
    own = F.substring("bytes", F.lit(1), F.least(F.col("length"), F.col("size") - at).cast("int"))
    met = packed.join(F.broadcast(starts), (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_k")))
    return met.select(below(root, decoded("file")).alias("path"), at.alias("at"), own.alias("bytes"))


def tree_files(spark: SparkSession, root: str, whole: Callable[[Column], Column] | None = None) -> DataFrame:
    """(path below root, sha256, size) of all files of a folder. Spark's readers pass over empty files: what is listed and not read is one.

    With `whole`, files to whose paths it gives the same value are the parts of one, in order of paths, and path is that
    value. However long a file is, a task reads a split or a segment of it: see chained_digests().
    """
    read = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(root)
    small = read.where(F.col("length") <= WHOLE)
    long = None if read.where(F.col("length") > WHOLE).select("length").isEmpty() else _long_files(spark, root)
    names = read.select(below(root, "path").alias("path"), F.col("length").alias("size"))
    listed = listed_files(spark, root).select(below(root, decoded("path")).alias("path"))
    if whole is None:
        full = small.select(below(root, "path").alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
        if long is not None:
            full = full.union(chained_digests(long.withColumnRenamed("path", "whole")).withColumnRenamed("whole", "path"))
    else:
        slices = F.transform(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / PIECE).cast("int")), lambda k: F.struct((k.cast("long") * PIECE).alias("at"), F.substring("content", k * PIECE + 1, F.lit(PIECE)).alias("bytes")))
        pieces = small.select(below(root, "path").alias("path"), F.explode(slices).alias("s")).select("path", "s.at", "s.bytes")
        pieces = pieces if long is None else pieces.union(long)
        before = Window.partitionBy("whole").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        parts = names.select(F.col("path").alias("_p"), whole(F.col("path")).alias("whole"), "size", "path").withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).select("_p", "whole", "start")
        # the driver lists the files, so the list fits one task, and the bytes stay where they are read
        placed = pieces.join(F.broadcast(parts), F.col("path") == F.col("_p")).select("whole", (F.col("start") + F.col("at")).alias("at"), "bytes")
        full = chained_digests(placed).withColumnRenamed("whole", "path")
        names, listed = (t.select(whole(F.col("path")).alias("path")).distinct() for t in (names, listed))
    empty = listed.join(names.select("path"), "path", "left_anti").select("path", F.sha2(F.lit(b""), 256).alias("sha256"), F.lit(0).cast("long").alias("size"))
    return full.union(empty)


def tree_digests(files: DataFrame, group: str = "tree", path: str = "path", sha256: str = "sha256") -> DataFrame:
    """(group, digest): SHA-256 over each file's path, a NUL and the bytes of its hash, in order of paths; one row of hashes for each tree."""
    entry = F.concat(F.encode(path, "UTF-8"), F.unhex(F.lit("00")), F.unhex(sha256))
    sums = files.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(F.encode(path, "UTF-8").alias("p"), F.hex(entry).alias("e"))))["e"].alias("e"))
    return sums.select(group, F.sha2(F.unhex(F.array_join("e", "")), 256).alias("digest"))


def collected_files(files: DataFrame, kept: DataFrame, group: str = "workspace_id", path: str = "path") -> DataFrame:
    """files with excluded: the reason why the collection leaves a file out, PYTHON_VENV (a folder with pyvenv.cfg) or PYTHON_BYTECODE_CACHE, null if it stays.

    A folder stays if one of the kept paths (group, path, output) is it or lies in it, or, for outputs, holds it.
    """
    parts = F.split(path, "/", -1)
    folders = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    above = F.when(F.size(parts) > 1, folders).otherwise(F.array().cast("array<string>"))
    venvs = files.where(F.col(path).endswith("/pyvenv.cfg")).select(group, F.regexp_replace(path, "/pyvenv.cfg$", "").alias("folder"), F.lit("PYTHON_VENV").alias("reason"))
    each = files.select(group, path, F.explode(above).alias("folder"))
    caches = each.where(F.element_at(F.split("folder", "/"), -1) == "__pycache__").select(group, "folder", F.lit("PYTHON_BYTECODE_CACHE").alias("reason"))
    marked = venvs.union(caches).groupBy(group, "folder").agg(F.max("reason").alias("reason"))
    # kept paths protect themselves and the folders above them; outputs also what lies in them
    own = F.concat(F.split("_k", "/", -1), F.array().cast("array<string>"))
    up = F.transform(F.sequence(F.lit(1), F.size(own)), lambda k: F.array_join(F.slice(own, 1, k), "/"))
    named = kept.select(group, F.regexp_replace(path, "/$", "").alias("_k"), "output")
    safe = named.select(group, F.explode(up).alias("folder")).distinct()
    inside = marked.select(group, "folder", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("folder", "/"))), lambda k: F.array_join(F.slice(F.split("folder", "/"), 1, k), "/"))).alias("_k"))
    covered = inside.join(named.where("output").select(group, "_k").distinct(), [group, "_k"], "left_semi").select(group, "folder")
    gone = marked.join(safe.union(covered).distinct(), [group, "folder"], "left_anti")
    # the outermost folder that is left out decides
    reasons = each.join(gone, [group, "folder"]).groupBy(group, path).agg(F.min_by("reason", F.char_length("folder")).alias("excluded"))
    return files.join(reasons, [group, path], "left")
