"""The corpus pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import decontam, linededup, packing, quality, simhash
from sessionlake.llm.common import broadcast_if_small, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows of these (doc_id, text_hash); null ids are ids here."""
    gone = stored(gone.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__hash"])
    return docs.join(broadcast_if_small(gone), same, "left_anti")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject."""
    found = quality.judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, found.where("rejected")).select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share but for the last; a null text stays null."""
    kept = linededup.drop_repeated_lines(docs.select(COLUMNS))
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return kept.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id.

    Near copies have sets of five-word shingles of a Jaccard similarity of at least 0.8, each link verified. Candidates
    differ by at most 28 of 64 bits: texts of 0.8 differ by 9.7 on average (12 where they have four and five shingles),
    and by more than 28 with a probability of about 1 in a million at most. Documents without an id go if their group
    has one with an id.
    """
    found = simhash.verified_duplicates(docs, shingle=5, distance=28, pairs=10, similarity=0.8)
    return _without(docs, found.where("component_id is not null and not doc_id <=> component_id")).select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result stored in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs) if k + 1 < len(STAGES) else docs
    return docs
