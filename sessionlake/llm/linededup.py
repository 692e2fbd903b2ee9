"""Line dedup over levelled sorted runs of line hashes, by DataFrame functions only.

A run is a table of (h1, h2, docs, last_id), a row for each distinct line key, bucketed and sorted by the 128-bit
hash. Each new batch of documents merge-anti-joins the runs to find the keys that no run holds, and is added as a
run of its own: new keys with the largest id that holds them, known keys with what the batch adds to their count.
As the runs and the batch are bucketed alike, these joins need no shuffle of the runs. When a level has `fan_out`
runs they are compacted into one run of the next level, so that a key is rewritten a logarithmic number of times.
Batches come in descending order of id: a key's last document is in the batch where the anti-join first finds it new.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm.common import SPACES, ascii_lower, broadcast_if_small, shared_folder, small, stored


class LineRuns:
    """Levelled sorted runs in the shared folder; `buckets` is the number of hash buckets of each run."""

    def __init__(self, spark: SparkSession, fan_out: int = 2, buckets: int | None = None):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder, self.levels = shared_folder(spark), [[]]

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        columns = run.select("h1", "h2", F.col("docs").cast("long"), F.col("last_id").cast("long")).repartition(self.buckets, "h1", "h2")
        columns.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    @property
    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of keys (h1, h2, ...) that no run holds: one merge-anti-join for each run."""
        return reduce(lambda left, run: left.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti"), self.runs, keys)

    def add(self, batch: DataFrame) -> None:
        """Adds a batch (h1, h2, docs, last_id), one row a key, as a run of its own; compacts full levels."""
        batch = batch.repartition(self.buckets, "h1", "h2")
        new = self.unseen(batch).select("h1", "h2", F.lit(True).alias("new"))
        own = batch.join(new, ["h1", "h2"], "left").select("h1", "h2", "docs", F.when(F.col("new"), F.col("last_id")).alias("last_id"))
        self.levels[0].append(self._write(own))
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            merged = self._merged([self.spark.table(name) for name in self.levels[level]])
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(merged))
            for name in self.levels[level]:
                self.spark.sql(f"drop table {name}")
            self.levels[level] = []
            level += 1

    def close(self) -> None:
        """Takes the runs out of the catalog."""
        for level in self.levels:
            for name in level:
                self.spark.sql(f"drop table {name}")
        self.levels = [[]]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, runs).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last_id").alias("last_id"))

    def totals(self) -> DataFrame:
        """(h1, h2, docs, last_id) over all runs."""
        return self._merged(self.runs)


def line_key(line: Column) -> Column:
    """The line with all of [\\x20\\x09-\\x0D] stripped at both ends and A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def split_lines(text: Column) -> Column:
    """The pieces between line feeds; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5, batches: int = 4, fan_out: int = 2) -> DataFrame:
    """docs with n_lines long, n_dropped long and kept_text in place of columns of these names, if any.

    Keys of at least `least_chars` code points found in at least `least_docs` documents (distinct ids) lose all
    their lines except in the largest id that holds them. Rows with a null id are not counted and keep all lines.
    Repeated rows and ids count as one document, and each row is returned. An empty table gives no rows. A very long
    text is split where it is read; only hashes of its lines and numbers of those dropped leave its task.
    """
    given, spark = docs, docs.sparkSession
    key = F.col("key")
    # the text's hash once, below the generator
    hashed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text")).where("id is not null")
    lines = hashed.select("id", "text_hash", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    long = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length(key) >= least_chars)
    keys = stored(long.select("id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))

    ends = keys.agg(F.min("id").cast("decimal(38,0)").alias("lo"), F.max("id").cast("decimal(38,0)").alias("hi")).first()
    runs = LineRuns(spark, fan_out)
    if ends["hi"] is not None:
        width = int(ends["hi"] - ends["lo"]) // batches + 1
        for k in range(batches):
            top = int(ends["hi"]) - k * width
            batch = keys.where((F.col("id") <= top) & (F.col("id") > top - width))
            runs.add(batch.groupBy("h1", "h2").agg(F.countDistinct("id").alias("docs"), F.max("id").alias("last_id")))
        hot = stored(runs.totals().where(F.col("docs") >= least_docs).select("h1", "h2", "last_id"))
        runs.close()
        dropped = keys.join(broadcast_if_small(hot), ["h1", "h2"]).where("last_id <> id")
    else:
        dropped = keys.where("false")
    gone = dropped.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone")).select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("gone").alias("__gone"))

    lined = given.withColumn("__text_hash", F.xxhash64(F.col(text_col)))
    gone = stored(gone)
    # numbers of the documents that lose a line; beyond the bound all texts are shuffled
    met = lined.join(F.broadcast(gone) if small(gone) else gone.hint("shuffle_hash"), (F.col("__id") == lined[id_col]) & (F.col("__hash") == lined["__text_hash"]), "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    stay = F.filter(split_lines(text), lambda line, i: ~F.array_contains("__gone", i))
    values = {"n_lines": F.size(split_lines(text)).cast("long"), "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"), "kept_text": F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(stay, "\n"))}
    kept = [c for c in given.columns if c not in values]
    return met.select(*(given[c] for c in kept), *(v.alias(c) for c, v in values.items()))
