"""The trie of all conversation prefixes, with totals of every subtree rolled up in bands of depths.

A node is a distinct sequence of the first d turns (role and text) of some conversations, its members. Turns are
numbered, and prefixes get 128-bit keys (running exclusive-or of hashes of depth and turn), in pieces of a
conversation, so that a conversation of any length is spread over tasks. A node explodes its own numbers only
to itself and its ancestors in its band of BAND depths. The tops of the bands (depths divisible by BAND) form
a trie BAND times as flat, rolled up in the same way; their completed totals then go to the ancestors in the band
above. So a trie of depth D takes about log D rounds, and a node explodes to at most BAND + 1 rows in each.

Turns are ordered by number, null first; turns of one number by a hash of role and text. Equal rows are turns of
their own. Null roles and texts are empty. Rows without conv_id belong to no conversation and take no part. A
conversation without turns after the rebuild ends at the root. An empty table gives an empty result. Other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import durable, table

FAMILY = 5  # conversations that share the first turns of one of them
HEADS = 9  # they share fewer turns than this
BAND = 16
PIECE = 4096  # depths of a conversation handled together; a multiple of BAND
IDS = 4096  # conversation ids of a range hashed together
KEY = ["depth", "k1", "k2"]


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("bigint")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, bytes of the text, and two hashes of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.octet_length(text).cast("bigint").alias("bytes"), digest.alias("digest")
    )
    return rows.select("conv_id", "turn", "bytes", _half(F.col("digest"), 1).alias("d1"), _half(F.col("digest"), 17).alias("d2"))


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, part, place in the part, bytes, d1, d2: the turns in order, dealt to parts by ranges of that order."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2"), F.col("row")]
    parts = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return parts.withColumn("part", F.spark_partition_id()).select("conv_id", "part", place.cast("bigint").alias("place"), "bytes", "d1", "d2")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, depth, bytes, d1, d2, end: the turns of the rebuilt conversations, each also with a row of depth 0."""
    own = durable(numbered(turns))
    parts = own.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = durable(parts.withColumn("before", before))
    conversations = parts.groupBy("conv_id").agg(F.sum("n").alias("n")).select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"),
        F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).alias("shared"),
    )
    first = conversations.select(F.col("conv_id").alias("family"), F.col("n").alias("first_n"))
    sized = conversations.join(first, "family", "left").withColumn("head", F.least("shared", F.coalesce("first_n", F.lit(0))))
    sized = durable(sized.withColumn("total", F.col("head") + F.greatest(F.col("n") - F.col("shared"), F.lit(0))))

    placed = own.join(parts.select("conv_id", "part", "before"), ["conv_id", "part"]).withColumn("place", F.col("before") + F.col("place"))
    leading = placed.where((F.col("place") < HEADS) & (F.col("conv_id") % FAMILY == 0))
    heads = sized.join(leading.withColumnRenamed("conv_id", "family"), "family").where("place <= head")
    # the sizes meet the turns by conversation and part, so that a long conversation stays dealt out
    known = parts.join(sized.select("conv_id", "shared", "head", "total"), "conv_id").select("conv_id", "part", "before", "shared", "head", "total")
    tails = own.join(known, ["conv_id", "part"]).withColumn("place", F.col("before") + F.col("place")).where("place > shared")

    def rows(df: DataFrame, depth: Column, *rest: Column | str) -> DataFrame:
        return df.select("conv_id", depth.cast("bigint").alias("depth"), *rest, (depth == F.col("total")).alias("end"))

    roots = rows(sized, F.lit(0), *(F.lit(0).cast("bigint").alias(c) for c in ("bytes", "d1", "d2")))
    return roots.unionByName(rows(heads, F.col("place"), "bytes", "d1", "d2")).unionByName(
        rows(tails, F.col("head") + F.col("place") - F.col("shared"), "bytes", "d1", "d2")
    )


def in_pieces(rows: DataFrame) -> DataFrame:
    """Each row with its piece of the conversation; the first row of a piece also ends the piece before."""
    piece = F.expr(f"depth div {PIECE}")
    both = F.when((F.col("depth") > 0) & (F.col("depth") % PIECE == 0), F.array(piece - 1, piece)).otherwise(F.array(piece))
    return rows.withColumn("piece", F.explode(both))


def once(rows: DataFrame) -> DataFrame:
    """One row of those that in_pieces makes of a row: the one with the rows before it in its piece."""
    return rows.where(F.col("piece") == F.expr(f"greatest(depth - 1, 0) div {PIECE}"))


def with_keys(rows: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2, bytes, end: equal keys at equal sequences of turns."""
    piece = Window.partitionBy("conv_id", "piece").orderBy("depth")
    hashed = in_pieces(rows).select(
        "conv_id", "depth", "piece", "bytes", "end", *(F.when(F.col("depth") > 0, F.xxhash64("depth", d)).otherwise(F.lit(0)).alias(k) for d, k in (("d1", "k1"), ("d2", "k2")))
    )
    inside = durable(hashed.withColumns({k: F.expr(f"bit_xor({k})").over(piece) for k in ("k1", "k2")}))
    # what the pieces before amount to; most conversations have one piece only
    upto = Window.partitionBy("conv_id").orderBy("piece")
    earlier = inside.where(F.col("depth") % PIECE == PIECE - 1).select(
        "conv_id", (F.col("piece") + 1).alias("piece"), *(F.expr(f"bit_xor({k})").over(upto).alias(f"before_{k}") for k in ("k1", "k2"))
    )
    joined = once(inside).join(earlier, ["conv_id", "piece"], "left")
    keys = [F.col(k).bitwiseXOR(F.coalesce(F.col(f"before_{k}"), F.lit(0))).alias(k) for k in ("k1", "k2")]
    return joined.select("conv_id", "depth", *keys, "bytes", "end")


def with_paths(rows: DataFrame) -> DataFrame:
    """Each row with the keys above it: down from the top of its band or, of a top, from the top before."""
    above = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(-BAND, -1)
    seen = in_pieces(rows).withColumn("path", F.collect_list(F.struct(*KEY)).over(above))
    wanted = F.expr(f"CAST(if(depth % {BAND} = 0, least(depth, {BAND}), depth % {BAND}) AS int)")
    last = F.slice("path", F.size("path") - wanted + 1, wanted)
    return once(seen.withColumn("path", last)).drop("piece")


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rolled_up(rows: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """depth, k1, k2, leaves, saved: sums over the subtree of each node.

    rows: conv_id and the keys of every member; nodes: keys, path, leaves and saved of each node itself.
    """
    own = F.array(F.struct(*KEY))
    to = F.when(F.col("depth") % BAND == 0, own).otherwise(F.concat(own, F.col("path")))
    inside = durable(summed(nodes.select(F.explode(to).alias("at"), "leaves", "saved").select("at.*", "leaves", "saved")))
    if deepest < BAND:
        return inside
    top = F.col("depth") % BAND == 0
    flat = F.expr(f"depth div {BAND}").alias("depth")
    members = durable(with_paths(rows.where(top).select("conv_id", flat, "k1", "k2")))
    tops = members.groupBy(*KEY).agg(F.min_by("path", "conv_id").alias("path"))
    complete = rolled_up(
        members.drop("path"), tops.join(inside.where(top).select(flat, "k1", "k2", "leaves", "saved"), KEY), deepest // BAND
    ).withColumn("depth", F.col("depth") * BAND)
    above = nodes.where(top & (F.col("depth") > 0)).select(*KEY, "path").join(complete, KEY)
    carried = above.select(F.explode("path").alias("at"), "leaves", "saved").select("at.*", "leaves", "saved")
    return durable(summed(inside.unionByName(carried)))


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple] = []
        for *own, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece"))):
            if own == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256()
            state.update(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*KEY, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], [*KEY, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256: the ids of each node are joined by ranges of ids, the ranges hashed one after another."""
    joined = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")  # at most one id a number of the range
    pieces = ends.groupBy(*KEY, F.expr(f"conv_id div {IDS}").alias("range")).agg(joined.alias("piece"))
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "range")
    return ordered.mapInArrow(_stream_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node, as described in the query."""
    rows = durable(with_paths(durable(with_keys(durable(rebuilt(turn_rows(conversations)))))))
    met = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.min_by("path", "conv_id").alias("path")
    )
    met = durable(met.withColumn("parent", F.when(F.col("depth") > 0, F.element_at("path", -1))))
    children = met.where("depth > 0").groupBy(*(F.col(f"parent.{k}").alias(k) for k in KEY)).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = durable(
        met.join(children, KEY, "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
        .withColumn("leaves", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    )
    deepest = nodes.agg(F.max("depth")).head()[0] or 0
    totals = rolled_up(rows.select("conv_id", *KEY), nodes.select(*KEY, "path", "leaves", "saved"), deepest)
    # a node with very many children makes this join uneven; adaptive execution splits it
    parents = nodes.select(*(F.col(k).alias(f"parent_{k}") for k in KEY), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.drop("leaves", "saved").join(
        parents, (F.col("parent.depth") == F.col("parent_depth")) & (F.col("parent.k1") == F.col("parent_k1")) & (F.col("parent.k2") == F.col("parent_k2")), "left"
    )
    digests = end_digests(rows.where("end").select("conv_id", *KEY))
    return (
        named.join(totals, KEY)
        .join(digests, KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = rf"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, c - c % {FAMILY} AS family, xor(4294967295::UBIGINT,
    list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda ch: ord(ch)::UBIGINT), lambda s, b:
      list_reduce(range(8)::UBIGINT[], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)), xor(s, b)), 4294967295::UBIGINT)) % {HEADS} AS h
  FROM (SELECT DISTINCT c FROM own)
), sized AS (
  SELECT conv.c, family, h, least(h, coalesce(n, 0)) AS head FROM conv LEFT JOIN (SELECT c AS family, count(*) AS n FROM own GROUP BY c) USING (family)
), turns AS (
  SELECT s.c, place AS d, role, text FROM sized s JOIN own o ON o.c = s.family AND o.place <= s.head
  UNION ALL
  SELECT s.c, place - h + head, role, text FROM sized s JOIN own o ON o.c = s.c AND o.place > s.h
), prefixes AS (
  SELECT c, d, strlen(text) AS bytes, string_agg(sha256(concat(length(role), ':', role, text)), '') OVER (PARTITION BY c ORDER BY d) AS k FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM sized
), met AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefixes GROUP BY k, d
), pairs AS (
  SELECT m.k, m.conv_id, p.k AS above, p.d AS above_d, m.d - p.d AS up, m.n_convs, m.bytes FROM met m JOIN prefixes p ON p.c = m.conv_id AND p.d <= m.d
), children AS (
  SELECT above AS k, count(*) AS n_children FROM pairs WHERE up = 1 GROUP BY above
), totals AS (
  SELECT above AS k, count(*) FILTER (children.k IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM pairs LEFT JOIN children USING (k) GROUP BY above
), ends AS (
  SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM prefixes WHERE (c, d) IN (SELECT (c, max(d)) FROM prefixes GROUP BY c) GROUP BY k
)
SELECT met.conv_id, met.d::BIGINT AS depth, p.conv_id AS parent_conv_id, met.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM met JOIN totals USING (k) LEFT JOIN children USING (k) LEFT JOIN ends USING (k)
LEFT JOIN pairs ON pairs.k = met.k AND pairs.up = 1 LEFT JOIN met p ON p.k = pairs.above
"""
