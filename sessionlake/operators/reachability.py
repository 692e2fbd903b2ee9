"""Which files a file needs: references resolved against the files there are, and all that can be reached from each entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.sources.storage import shared_folder, stored


def module_candidates(path: Column, module: Column, level: Column) -> Column:
    """The places, best first, where a module of dotted name may be that a file imports: from each folder above the file, the nearest first,
    or, for a relative import of some level, from the file's own folder (1) or one above (2, 3, ...) alone. A module is a file or a package."""
    folders = F.slice(F.split(path, "/", -1), 1, F.size(F.split(path, "/", -1)) - 1)
    up = lambda n: F.array_join(F.slice(folders, 1, n), "/")
    depth = F.size(folders)
    bases = F.when(level > 0, F.when(level - 1 <= depth, F.array(up(depth - level + 1)))).otherwise(F.transform(F.sequence(F.lit(0), depth), lambda k: up(depth - k)))
    name = F.replace(F.coalesce(module, F.lit("")), F.lit("."), F.lit("/"))
    whole = lambda base: F.concat_ws("/", F.nullif(base, F.lit("")), F.nullif(name, F.lit("")))
    init = lambda base: F.concat_ws("/", F.nullif(whole(base), F.lit("")), F.lit("__init__.py"))
    # a relative import without a name is of the package itself
    each = lambda base: F.when(name != "", F.array(F.concat(whole(base), F.lit(".py")), init(base))).otherwise(F.array(init(base)))
    return F.coalesce(F.flatten(F.transform(bases, each)), F.array().cast("array<string>"))


def resolved_references(references: DataFrame, files: DataFrame, group: str = "workspace_id") -> DataFrame:
    """references (group, path, reference, candidates) with target: the first candidate that is one of files (group, path), null if none is, or if group or path is null."""
    there = files.select(F.col(group).alias("_g"), F.col("path").alias("_p")).distinct()
    each = references.select(group, "path", "reference", F.posexplode("candidates").alias("_at", "_c"))
    found = each.join(there, (F.col(group) == F.col("_g")) & (F.col("_c") == F.col("_p"))).groupBy(group, "path", "reference").agg(F.min_by("_c", "_at").alias("target"))
    return references.select(group, "path", "reference").distinct().join(found, [group, "path", "reference"], "left")


def needed_files(entries: DataFrame, references: DataFrame, group: str = "workspace_id") -> DataFrame:
    """(group, entry, path, depth): all files that each entry (group, path) needs by references (group, path, target), itself at depth 0, by the fewest steps.

    Breadth first: each round joins what the last one found with the references and keeps what no round found before, so
    cycles end, and a file of a million references, or one that a million entries need, is rows of an equi-join. Rounds
    are as many as the longest way has steps; each is written to the shared folder. Null groups, paths and targets reach nothing.
    """
    spark = entries.sparkSession
    edges = stored(references.where(F.col(group).isNotNull() & F.col("path").isNotNull() & F.col("target").isNotNull()).select(group, "path", "target").distinct())
    columns = [group, "entry", "path"]
    last = entries.where(F.col(group).isNotNull() & F.col("path").isNotNull()).select(group, F.col("path").alias("entry"), "path").distinct()
    schema, rounds = last.withColumn("depth", F.lit(0)).schema, []
    while True:
        folder = shared_folder(spark)
        last.withColumn("depth", F.lit(len(rounds))).write.parquet(folder)
        now = spark.read.schema(schema).parquet(folder)
        if rounds and now.isEmpty():
            return spark.read.schema(schema).parquet(*rounds)
        rounds.append(folder)
        reached = now.join(edges, [group, "path"]).select(group, "entry", F.col("target").alias("path")).distinct()
        last = reached.join(spark.read.schema(schema).parquet(*rounds).select(*columns), columns, "left_anti")


def open_references(needed: DataFrame, references: DataFrame, group: str = "workspace_id") -> DataFrame:
    """(group, entry, path, reference) of needed_files() that hold a reference without a target: what an entry would lack."""
    lost = references.where("target is null").select(group, "path", "reference").distinct()
    return needed.select(group, "entry", "path").join(lost, [group, "path"]).select(group, "entry", "path", "reference")


def name_index(names: DataFrame, paths: DataFrame, group: str = "workspace_id") -> DataFrame:
    """names (group, name) with paths_found, how many different paths (group, path) end in the name, and path, the only one, null if there are none or many.

    A name may have folders in it; it ends a path at a folder's border. Each path is indexed by its last part, and names by
    theirs; what meets there is counted before anything is listed, so a name that fits a million paths is one row.
    """
    last = lambda c: F.element_at(F.split(c, "/", -1), -1)
    wanted = names.select(group, "name").where(F.col("name").isNotNull() & (F.col("name") != "")).distinct().withColumn("_last", last(F.col("name")))
    index = paths.select(group, "path").where("path is not null").distinct().withColumn("_last", last(F.col("path")))
    # names without a folder are answered by counts alone
    bare = index.groupBy(group, "_last").agg(F.count("*").alias("_n"), F.min("path").alias("_one"))
    plain = wanted.where(F.col("name") == F.col("_last")).join(bare, [group, "_last"], "left").select(group, "name", "_n", "_one")
    # others meet the paths that end in all of them, by as many parts as the name has
    parts = lambda c: F.split(c, "/", -1)
    sizes = wanted.where(F.col("name") != F.col("_last")).select(group, "_last", F.size(parts(F.col("name"))).alias("_size")).distinct()
    ends = index.join(sizes, [group, "_last"]).where(F.size(parts(F.col("path"))) >= F.col("_size"))
    tails = ends.select(group, F.array_join(F.slice(parts(F.col("path")), -F.col("_size"), F.col("_size")), "/").alias("name"), "path")
    counted = tails.groupBy(group, "name").agg(F.count("*").alias("_n"), F.min("path").alias("_one"))
    deep = wanted.where(F.col("name") != F.col("_last")).join(counted, [group, "name"], "left").select(group, "name", "_n", "_one")
    every = plain.unionByName(deep)
    return every.select(group, "name", F.coalesce("_n", F.lit(0)).alias("paths_found"), F.when(F.col("_n") == 1, F.col("_one")).alias("path"))


def listed_names(listings: DataFrame, group: str = "workspace_id") -> DataFrame:
    """(group, event_id, folder, name, is_folder) of listings (group, event_id, folder, text): the names on the lines of what a listing printed, in any of three shapes.

    A long line ends in its name after mode, links, owners, size and time, a link's before ` -> `; `total N`, `.` and `..` are no names.
    A line that ends in a colon is the folder of those that follow. Other lines are names, or paths, themselves; a slash at the end marks a folder.
    """
    lines = listings.select(group, "event_id", F.coalesce("folder", F.lit("")).alias("folder"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\r?\n")).alias("_at", "_line"))
    # How a long listing's line begins.
    long = r"^([-dlbcps])[-rwxsStT]{9}[.+@]?\s+\d+\s+\S+\s+\S+\s+\d+\s+\S+\s+\S+(?:\s+\d[\d:]+)?\s(.*)$"
    head = F.regexp_extract("_line", r"^(.+):$", 1)
    order = Window.partitionBy(group, "event_id").orderBy("_at")
    rows = lines.withColumn("_folder", F.last(F.when(head != "", F.regexp_replace(head, r"^\./|/$", "")), True).over(order)).where((head == "") & (F.trim("_line") != "") & ~F.col("_line").rlike(r"^total \d+$"))
    mode, own = F.regexp_extract("_line", long, 1), F.regexp_extract("_line", long, 2)
    named = F.when(mode == "l", F.regexp_replace(own, " -> .*$", "")).when(mode != "", own).otherwise(F.trim("_line"))
    rows = rows.withColumns({"name": F.regexp_replace(F.regexp_replace(named, r"^\./", ""), "/+$", ""), "is_folder": (mode == "d") | ((mode == "") & named.endswith("/"))})
    return rows.where(~F.col("name").isin("", ".", "..")).select(group, "event_id", F.coalesce("_folder", "folder").alias("folder"), "name", "is_folder").distinct()
