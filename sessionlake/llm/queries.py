"""The queries over the driver's tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import audit, decontam, htmltext, langid, linededup, minhash, packing, quality, simhash, suffixes, voronoi, vptree, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap: doc_id, item_id, matched, compared, similarity."""
    return decontam.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=20, similarity=0.8)


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as written to Zstandard WARC archives and read back."""
    return warc.archived(_table(spark, sf_dir, "pages"), least_bytes=100)[1]


def op3_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in windows of at most 1024 tokens."""
    return packing.packed(_table(spark, sf_dir, "documents"), window=1024, end_id=0)


def op4_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, among all others; factor 1: exact."""
    vectors = _table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5, factor=1.0)


def op5_simhash_pivot_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id reachable over links of at most 3 bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, dropped lines and the digest of what stays."""
    kept = linededup.drop_repeated_lines(_table(spark, sf_dir, "documents"), least_chars=40, least_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language, learnt from the folds that are not held out."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes, removed bytes and runs, the digest, text and size of what stays, and where the runs are; passages of 400 bytes.

    The digest is that of the bytes; in the text, what is left of a character cut in two is U+FFFD.
    """
    kept = suffixes.drop_repeated_passages(_table(spark, sf_dir, "documents"), length=400)
    text, size = F.make_valid_utf8(F.col("kept").cast("string")), F.col("n_bytes") - F.col("n_removed")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("kept_text"), size.alias("kept_bytes"), "removed")


def op9_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's posteriors of being good and of being toxic, and whether it is rejected."""
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select("doc_id", "p_quality", "p_toxic", "rejected")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return htmltext.extracted(_table(spark, sf_dir, "pages"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters does at every step of all their orders, for each language."""
    return audit.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_bottom_sketch_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of 4-word shingles, the smallest doc_id reachable over links of 0.8, and whether it is its own."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80).drop("text_hash")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every vector whose id is divisible by 100, for each of its positives; every seventh label is moved by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return voronoi.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), hot AS (
  SELECT key, max(doc_id) AS last_id FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(h.last_id <> l.doc_id, false) AS gone FROM lines l LEFT JOIN hot h ON l.key = h.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP2_SQL = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, url, CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CAST(NULL AS VARCHAR) AS problem
FROM f
"""

OP4_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents
), f AS (
  SELECT doc_id, part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words), 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text),
                        regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS k
), orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), steps AS (
  SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), told AS (
  SELECT part, list_aggregate(list_transform(o, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') AS filter_order, step, o[step] AS filter, n, good, toxic, fails[o[step]] AS failed,
         len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) = 1 AS alone
  FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, filter, sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN failed AND alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN failed AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""

OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 3, 1) + 1), lambda i: array_to_string(words[i:i + 3], ' '))) AS shingles FROM w WHERE len(words) > 0
), distinct_sets AS (
  SELECT min(doc_id) AS first_id, shingles FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s) GROUP BY shingles
), each AS (
  SELECT first_id, len(shingles) AS n, unnest(shingles) AS shingle FROM distinct_sets
), links AS (
  SELECT a.first_id AS a, b.first_id AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.first_id <> b.first_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.first_id, b.first_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT first_id AS node, first_id AS id FROM distinct_sets
  UNION
  SELECT r.node, l.b FROM reached r JOIN links l ON r.id = l.a
), least AS (
  SELECT node, min(id) AS component_id FROM reached GROUP BY node
), of_doc AS (
  SELECT s.doc_id, len(s.shingles) AS n, l.component_id FROM s JOIN distinct_sets d ON list_sort(s.shingles) = d.shingles JOIN least l ON l.node = d.first_id
)
SELECT d.doc_id, CAST(coalesce(o.n, 0) AS BIGINT) AS n_shingles, coalesce(o.component_id, d.doc_id) AS component_id, coalesce(o.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN of_doc o USING (doc_id)
"""

OP13_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same) WHERE place <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

QUERIES = {
    "op1_spaced_seed_decontamination": op1_spaced_seed_decontamination,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_window_packing": op3_window_packing,
    "op4_vp_tree_search": op4_vp_tree_search,
    "op5_simhash_pivot_components": op5_simhash_pivot_components,
    "op6_line_dedup": op6_line_dedup,
    "op7_language_id": op7_language_id,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_quality_bayes": op9_quality_bayes,
    "op10_html_extraction": op10_html_extraction,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_bottom_sketch_components": op12_bottom_sketch_components,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL = {
    "op2_warc_round_trip": OP2_SQL,
    "op4_vp_tree_search": OP4_SQL,
    "op6_line_dedup": OP6_SQL,
    "op11_filter_interactions": OP11_SQL,
    "op12_bottom_sketch_components": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
