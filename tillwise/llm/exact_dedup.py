"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

Spark's approx_top_k is a frequent-items sketch of the Misra-Gries family: it keeps bounded counters,
merges them, and cannot miss a digest with more than its share of rows. Its candidates are counted exactly;
those with many copies (at most BUCKETS * PER_BUCKET rows, so a bounded broadcast) settle their rows
on the map side. All other digests are shuffled in the ordinary way, in groups that cannot be hot.

Null texts count as empty, and all empty texts are equal. A group keeps its smallest doc_id; null ids
come last. Rows that repeat both doc_id and text are one document: kept or dropped alike in the
report, one of them stays in drop_copies. An empty table gives an empty result. Other columns are ignored
by the report and carried through by drop_copies.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import durable, table

BUCKETS = 64
PER_BUCKET = 32
COUNTERS = 1024
HEAVY_COPIES = 64


def normalised(text: Column) -> Column:
    """Each run of white space as one blank; a lone blank is left as it is."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]{2,}|[\\x09-\\x0D]", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def heavy_digests(digests: DataFrame) -> DataFrame:
    """digest, keep_id, group_size of the digests with at least HEAVY_COPIES rows, exactly counted."""
    candidates = (
        digests.groupBy(F.pmod(F.crc32("digest"), F.lit(BUCKETS)).alias("bucket"))
        .agg(F.expr(f"approx_top_k(digest, {PER_BUCKET}, {COUNTERS})").alias("top"))
        .select(F.explode("top").alias("t"))
        .where(F.col("t.count") >= HEAVY_COPIES)
        .select(F.col("t.item").alias("digest"))
    )
    return (
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") >= HEAVY_COPIES)
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept for each row of docs."""
    digests = durable(docs.select("doc_id", text_digest(F.col("text")).alias("digest")))
    heavy = durable(heavy_digests(digests))
    settled = digests.join(F.broadcast(heavy), "digest").select("doc_id", "digest", "keep_id", "group_size")
    group = Window.partitionBy("digest")
    others = digests.join(F.broadcast(heavy), "digest", "left_anti").select(
        "doc_id",
        "digest",
        F.min("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
    )
    return settled.unionByName(others).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    own = "_digest_of_text"
    marked = docs.withColumn(own, text_digest(F.col("text")))
    dropped = exact_dedup(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias("_dropped_id"), F.col("digest").alias("_dropped_digest")
    )
    rest = marked.join(
        dropped,
        marked["doc_id"].eqNullSafe(dropped["_dropped_id"]) & (marked[own] == dropped["_dropped_digest"]),
        "left_anti",
    )
    turn = Window.partitionBy("doc_id", own).orderBy(F.lit(1))
    return rest.withColumn("_turn", F.row_number().over(turn)).where("_turn = 1").drop(own, "_turn")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""
