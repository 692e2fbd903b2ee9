"""Text functions: identifier tokens, workspace profiles, secret findings."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that mark a capability, placeholders that are no secrets, folders that are no workspace files.
MARKERS = ["api", "cli", "client", "config", "database", "export", "import", "parser", "server", "transform"]
PLACEHOLDERS = ["local-noauth", "<redacted>", "redacted", "null", "none"]
HIDDEN_FOLDERS = [".git", "tests", "solution", "hidden_control"]


def secret_detectors(token_prefixes: tuple[str, ...] = ("sk-",), variable_prefixes: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(detector, pattern whose first group is the value).

    | found | not found |
    | --- | --- |
    | sk-AbCdEf012345 (a prefix and 12 more letters, digits, _ or -) | task-AbCdEf012345, sk-short |
    | X-Api-Key: 0123abcd, "authorization" = "Bearer ab.cd/ef+gh" | api-key: short |
    | PREFIX_API_KEY=0123abcd, for given prefixes of variables | OTHER_API_KEY=0123abcd |
    | token = "0123abcd", for given names | tokens = "0123abcd" |
    """
    quoted = lambda words: "|".join(re.escape(w) for w in words)
    out = [("auth_header_value", r"(?i)\b(?:(?:x-)?api-key|authorization)\b[\"']?\s*[=:]\s*[\"']?(?:bearer\s+)?([\w.+/=-]{8,})")]
    if token_prefixes:
        out.insert(0, ("token_prefix", rf"(?:^|[^0-9A-Za-z])((?:{quoted(token_prefixes)})[\w-]{{12,}})"))
    if variable_prefixes:
        out.append(("credential_env_value", rf"(?i)(?:{quoted(variable_prefixes)})_(?:\w*_)?KEY\s*=\s*[\"']?([^\s\"']{{8,}})"))
    if names:
        out.append(("assigned_value", rf"(?i)\b(?:{quoted(names)})\s*=\s*[\"']([0-9a-z]{{8,}})[\"']"))
    return out


def identifier_tokens(text: Column) -> Column:
    """The different lower-cased identifiers of three or more characters, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z][A-Za-z0-9_]{2,}"), F.lit(0)), F.lower)))


def workspace_profiles(files: DataFrame, workspace: str = "workspace_id", path: str = "path", text: str = "text", chars: int | None = None) -> DataFrame:
    """(workspace, files, languages, tokens, capabilities): how many files, their name extensions, different tokens, and which markers are among them.

    Files in hidden folders don't count. With `chars` only so many characters of each file are read. Tokens become
    different ones of a workspace first, in partial sums, and are counted after.
    """
    hidden = F.exists(F.split(F.col(path).cast("string"), "/"), lambda x: x.isin(HIDDEN_FOLDERS))
    own = files.where(~F.coalesce(hidden, F.lit(False)))
    name = F.element_at(F.split(F.col(path).cast("string"), "/"), -1)
    ending = F.when(F.contains(F.col(path).cast("string"), F.lit(".")), F.element_at(F.split(F.col(path).cast("string"), "[.]"), -1)).otherwise(F.lit(None).cast("string"))
    counted = own.groupBy(workspace).agg(F.count_distinct(path).alias("files"), F.array_sort(F.collect_set(F.when(name.isNotNull(), ending))).alias("languages"))
    read = F.substring(F.col(text), 1, chars) if chars else F.col(text)
    found = F.regexp_extract_all(read, F.lit("[A-Za-z][A-Za-z0-9_]{2,}"), F.lit(0))
    token = own.select(workspace, F.explode(F.array_distinct(F.transform(found, F.lower))).alias("token")).distinct()
    sums = token.groupBy(F.col(workspace).alias("_w")).agg(F.count("*").alias("tokens"), F.array_sort(F.collect_set(F.when(F.col("token").isin(MARKERS), F.col("token")))).alias("capabilities"))
    met = counted.join(sums, F.col(workspace).eqNullSafe(F.col("_w")), "left")
    none = F.array().cast("array<string>")
    return met.select(workspace, "files", "languages", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("capabilities", none).alias("capabilities"))


#: Members of a kind that are paired at once.
BLOCK = 1024


def gap_pairs(profiles: DataFrame, workspace: str = "workspace_id", capabilities: str = "capabilities", least: int = 2, separator: str | None = None) -> DataFrame:
    """(reference, target, gap): ordered pairs of workspaces where the reference has `least` capabilities or more that the target lacks.

    Workspaces are few kinds: they are paired by their sets of markers, at most 2 to the number of MARKERS. A kind's members
    are dealt into blocks of about BLOCK, and pairs of blocks to all tasks: however common a kind is, no task holds more
    of it than two blocks at once. All pairs come out, so rows grow with the square of the workspaces. With a separator gaps
    are texts, joined once for two kinds: what is computed of the array after is computed for each pair.
    """
    if least < 1:
        raise ValueError("least must be positive")
    kind = profiles.select(F.col(workspace).alias("id"), F.array_join(F.array_sort(F.array_intersect(F.coalesce(capabilities, F.array().cast("array<string>")), F.array(*map(F.lit, MARKERS)))), ",").alias("kind"))
    blocks = kind.groupBy("kind").agg(F.ceil(F.count("*") / BLOCK).alias("_n"))
    marked = blocks.select(F.col("kind").alias("a"), F.explode(F.split("kind", ",")).alias("marker")).where("marker <> ''")
    # of each marker, the kinds that lack it: both sides are bounded by the number of marker sets
    lacks = blocks.select(F.col("kind").alias("b"), F.explode(F.array_except(F.array(*map(F.lit, MARKERS)), F.split("kind", ","))).alias("marker"))
    gaps = marked.join(lacks, "marker").groupBy("a", "b").agg(F.array_sort(F.collect_set("marker")).alias("gap")).where(F.size("gap") >= least)
    if separator is not None:
        gaps = gaps.withColumn("gap", F.array_join("gap", separator))
    dealt = kind.join(F.broadcast(blocks), "kind").groupBy("kind", F.pmod(F.xxhash64("id"), "_n").alias("block")).agg(F.collect_list("id").alias("ids"))
    side = lambda k, ids: dealt.select(F.col("kind").alias(k), F.col("block").alias(f"_{k}"), F.col("ids").alias(ids))
    numbers = lambda k: F.broadcast(blocks.select(F.col("kind").alias(k), F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias(f"_{k}")))
    # blocks are joined by kind and number, so a common kind isn't one task's
    met = gaps.join(numbers("a"), "a").join(side("a", "_references"), ["a", "_a"]).join(numbers("b"), "b").join(side("b", "_targets"), ["b", "_b"])
    # a number of its own keeps few bytes, of which many rows are made, from being put into few tasks
    tasks = int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = met.repartition(tasks, "a", "_a", "b", "_b").select("gap", "_targets", F.explode("_references").alias("reference"))
    # generated code holds all rows that come of one row before the first goes on: coalesce ends it, so that this is a block, not two multiplied
    return each.coalesce(tasks).select("reference", F.explode("_targets").alias("target"), "gap").where("reference <> target")


def secret_findings(files: DataFrame, path: str = "path", text: str = "text", detectors: list[tuple[str, str]] | None = None) -> DataFrame:
    """(path, line, detector, match_sha256), each once; values never leave the expression that hashes them."""

    def of(detector: str, pattern: str) -> DataFrame:
        # a match may pass a line's end, so lines are counted in what precedes it
        values = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
        parts = F.split(F.regexp_replace(F.col(text), pattern, "\u0001"), "\u0001", -1)
        found = files.where(F.col(text).rlike(pattern)).select(path, F.posexplode(values).alias("k", "value"), parts.alias("parts"), F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1)).alias("whole"))
        feeds = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.size(F.split(x, "\n", -1)) - 1)
        # a match may begin with the character before the value
        begins = F.startswith(F.element_at("whole", F.col("k") + 1), F.lit("\n")).cast("int")
        line = 1 + feeds(F.slice("parts", 1, F.col("k") + 1)) + feeds(F.slice("whole", 1, F.col("k"))) + begins
        real = found.where(~F.exists(F.array(*map(F.lit, PLACEHOLDERS)), lambda x: F.startswith(F.lower("value"), x)))
        return real.select(path, line.cast("int").alias("line"), F.lit(detector).alias("detector"), F.sha2(F.encode("value", "UTF-8"), 256).alias("match_sha256"))

    return reduce(DataFrame.union, (of(*d) for d in detectors or secret_detectors())).distinct()


def known_secrets(files: DataFrame, secrets: list[str], path: str = "path", text: str = "text") -> DataFrame:
    """(path): files that hold one of the given secrets; few and known to the caller, they go into the plan."""
    hit = reduce(Column.__or__, (F.contains(F.col(text), F.lit(s)) for s in secrets if s), F.lit(False))
    return files.where(hit).select(path)


def scrubbed(text: Column, secrets: list[str], mark: str = "[credential]") -> Column:
    """The text with each of the secrets, longer ones first, replaced."""
    return reduce(lambda t, s: F.replace(t, F.lit(s), F.lit(mark)), sorted({s for s in secrets if s}, key=lambda s: (-len(s), s)), text)


# Headers that hold credentials.
CREDENTIAL_HEADERS = ["authorization", "proxy-authorization", "x-api-key", "api-key", "cookie", "set-cookie"]


def without_credentials(headers: Column) -> Column:
    """A map of headers without those that hold credentials, whatever their case."""
    return F.map_filter(headers, lambda name, _: ~F.lower(name).isin(CREDENTIAL_HEADERS))


def elided_matches(findings: DataFrame, originals: DataFrame, file: str = "path") -> DataFrame:
    """findings (file, detector, value) with allowed: the value stands in the originals (detector, value), or is such a value shortened to a start, `...` and an end of eight characters or more together."""
    exact = originals.select(F.col("detector").alias("_d"), F.col("value").alias("_v")).distinct()
    pieces = F.split("value", r"\.\.\.", -1)
    ends = findings.withColumns({"_pre": F.element_at(pieces, 1), "_post": F.element_at(pieces, -1), "_n": F.size(pieces)})
    fit = (F.col("_n") == 2) & (F.col("_pre") != "") & (F.col("_post") != "") & (F.char_length("_pre") + F.char_length("_post") >= 8)
    short = ends.where(fit).select("detector", "value", "_pre", "_post").distinct()
    # originals meet by detector and their first four characters, so no finding meets them all
    head = lambda c: F.substring(c, 1, F.least(F.char_length(c), F.lit(4)))
    sized = short.withColumns({"_head": head("_pre"), "_k": F.least(F.char_length("_pre"), F.lit(4))})
    keys = exact.select("_d", "_v", F.explode(F.array(*(F.struct(F.lit(k).alias("_kk"), F.substring("_v", 1, k).alias("_h")) for k in (1, 2, 3, 4)))).alias("x")).select("_d", "_v", "x._kk", "x._h")
    met = sized.join(keys, (F.col("detector") == F.col("_d")) & (F.col("_k") == F.col("_kk")) & (F.col("_head") == F.col("_h")))
    good = F.startswith("_v", "_pre") & F.endswith("_v", "_post") & (F.char_length("_v") > F.char_length("_pre") + F.char_length("_post"))
    allowed = exact.union(met.where(good).select("detector", "value")).distinct().withColumn("_ok", F.lit(True))
    out = findings.join(allowed, (findings["detector"] == F.col("_d")) & (findings["value"] == F.col("_v")), "left")
    return out.select(*(findings[c] for c in findings.columns), F.coalesce("_ok", F.lit(False)).alias("allowed"))


def leaked_solutions(bodies: DataFrame, changes: DataFrame, group: str = "task_id", path: str = "path", text: str = "text", final: str = "final_content", least: int = 4, share: float = 0.8) -> DataFrame:
    """(group, path) of bodies that hold the final content of a withheld change of their group, or a share of its tokens.

    Content that a body holds verbatim shares all its tokens but the first and the last, which may go on there. So of a
    change's n different tokens (three characters or more) a body shares at least m, the lesser of the share and n - 2, and
    with it one of the n - m + 1 that the fewest bodies of the group hold: only these meet the bodies in a join, and the
    pairs that they make are verified. Changes of fewer than `least` tokens are looked for in each body of the group at once.
    Null groups, texts and contents leak nothing.
    """
    tokens = lambda c: F.array_distinct(F.transform(F.regexp_extract_all(F.col(c), F.lit("[A-Za-z_][A-Za-z0-9_]{2,}"), F.lit(0)), F.lower))
    held = changes.where(F.coalesce(F.col(final), F.lit("")) != "").select(group, F.col(final).alias("_f"), F.xxhash64(final).alias("_c"), F.size(tokens(final)).alias("_n"), tokens(final).alias("_t")).dropDuplicates([group, "_c"])
    large = held.where(F.col("_n") >= least)
    own = large.select(group, "_c", "_n", F.explode("_t").alias("_w"))
    words = bodies.select(group, path, F.explode(tokens(text)).alias("_w"))
    often = words.join(own.select(group, "_w").distinct(), [group, "_w"], "left_semi").groupBy(group, "_w").agg(F.count("*").alias("_often"))
    rank = F.row_number().over(Window.partitionBy(group, "_c").orderBy(F.coalesce("_often", F.lit(0)), "_w"))
    needed = F.greatest(F.least(F.ceil(F.col("_n") * share), F.col("_n") - 2), F.lit(1))
    rare = own.join(often, [group, "_w"], "left").withColumn("_rank", rank).where(F.col("_rank") <= F.col("_n") - needed + 1)
    pairs = words.join(rare.where("_often is not null").select(group, "_w", "_c"), [group, "_w"]).select(group, path, "_c").distinct()
    met = pairs.join(large, [group, "_c"]).join(bodies.select(group, path, text), [group, path])
    shared = F.size(F.array_intersect(tokens(text), "_t"))
    leaks = met.where((shared / F.col("_n") >= share) | F.contains(F.col(text), F.col("_f"))).select(group, path)
    short = held.where(F.col("_n") < least).groupBy(group).agg(F.collect_list("_f").alias("_short"))
    every = bodies.join(short, group).where(F.exists("_short", lambda f: F.contains(F.col(text), f))).select(group, path)
    return leaks.union(every).distinct()
