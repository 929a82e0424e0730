"""Hard negatives by best-first search of sort-tile-recursive packed R-trees.

All rows are indexed: dealt by ranges of label and first coordinate into shards of at most SHARD_ROWS rows, each packed into
a tree whose leaves hold LEAF rows and whose inner nodes hold FANOUT nodes. A node's box holds the least and the
largest value of every coordinate, and of the label, so for an anchor it bounds every inner product below. A queue opens
nodes from the highest bound down; a node is passed over if its products cannot meet a score window, or lie strictly below
the k-th best found (an equal score may still win by its id). The anchors, in blocks of at most ANCHOR_ROWS, meet every
shard; the best of all shards are ranked by anchor. The search is exact: no cap but the ranks that are asked for.

Components are the floor of 256 times the value, scores whole numbers (beyond the range of a long: its ends). Shorter
vectors go on with zeros. Rows with a null id, label or vector or a null or non-finite component take no part. Rows that
repeat an id are rows of their own, anchors too. Of equal scores the smaller id comes first. An anchor without other rows of
its label has no positives, so no rows. Empty tables give an empty result. Other columns are ignored.
"""

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import durable, table

SCALE = 256
ANCHORS = 100  # rows whose id this divides are anchors
MOVED, LABELS = 7, 10  # rows whose id the first divides take the next of so many labels
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90  # of the positive's score
SHARD_ROWS = 8192
ANCHOR_ROWS = 4096
LEAF = 128
FANOUT = 8
TILED = 3  # coordinates that a shard is tiled by, after the label

_ENDS = np.iinfo(np.int64)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """row, vec_id, label, vector of the rows that take part."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    label = F.col("label").cast("bigint")
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & good).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("bigint"),
        F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        vector.alias("vector"),
    )


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, shorter ones filled with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def tiled(points: np.ndarray, rows: np.ndarray, coordinates: list[int]) -> Iterator[np.ndarray]:
    """The rows in tiles of at most LEAF: slabs along the first coordinate, each cut along the next ones."""
    rows = rows[np.argsort(points[rows, coordinates[0]], kind="stable")]
    leaves = -(-len(rows) // LEAF)
    slabs = leaves if len(coordinates) == 1 else int(np.ceil(leaves ** (1 / len(coordinates))))
    size = -(-leaves // max(slabs, 1)) * LEAF
    for i in range(0, len(rows), max(size, 1)):
        if size <= LEAF:
            yield rows[i : i + size]
        else:
            yield from tiled(points, rows[i : i + size], coordinates[1:])


class Tree:
    """Boxes of all nodes, leaves first, the root last. The first column of a box is the label."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        points = np.column_stack((labels, vectors.astype(np.int64, copy=False)))
        spread = points[:, 1:].max(0) - points[:, 1:].min(0).astype(float) if points.shape[1] > 1 else np.empty(0)
        widest = [0, *(1 + np.argsort(-spread, kind="stable")[:TILED]).tolist()]
        tiles = list(tiled(points, np.arange(len(ids)), widest))
        order = np.concatenate(tiles)
        self.ids, self.rows, self.labels, self.vectors = ids[order], rows[order], labels[order], vectors[order]
        cuts = np.cumsum([0, *(len(t) for t in tiles)])
        # bounds of what a node holds: rows for leaves, nodes of the level below for others
        self.first, self.last, self.leaves = list(cuts[:-1]), list(cuts[1:]), len(tiles)
        low, high = (f.reduceat(points[order], cuts[:-1]) for f in (np.minimum, np.maximum))
        lows, highs, start = [low], [high], 0
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            self.first += list(start + at)
            self.last += list(start + np.minimum(at + FANOUT, len(low)))
            start += len(low)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            lows.append(low)
            highs.append(high)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest inner product that each anchor can have in each node."""
        low, high, up, down = (x.astype(anchors.dtype).T for x in (self.low[:, 1:], self.high[:, 1:], *_signed(anchors)))
        return up.T @ low + down.T @ high, up.T @ high + down.T @ low


def _signed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(x, 0), np.minimum(x, 0)


def exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """The matrices, filled to one width, as numbers whose inner products are exact."""
    width = max(m.shape[1] for m in matrices)
    most = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in matrices]
    bound = max(most, default=0) ** 2 * max(width, 1)
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object
    return [np.pad(m, ((0, 0), (0, width - m.shape[1]))).astype(kind) for m in matrices]


def best_first(
    tree: Tree, vectors: np.ndarray, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, wanted_node: Callable[[int], bool],
    wanted_rows: Callable[[slice], np.ndarray], windows: list[tuple[int, int]], k: int,
) -> list[list[tuple[int, int, int]]]:
    """For each window of scores the k best (-score, id, row) of the wanted rows within it.

    least and most: the anchor's bounds of each node.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in windows]
    floors = [low for low, _ in windows]  # a window takes no score below
    root = len(tree.first) - 1
    queue = [(-most[root], root)]
    while queue and -queue[0][0] >= min(floors):
        bound, node = heapq.heappop(queue)
        open_ = [i for i, (_, high) in enumerate(windows) if -bound >= floors[i] and least[node] <= high]
        if not open_ or not wanted_node(node):
            continue
        if node >= tree.leaves:
            for child in range(tree.first[node], tree.last[node]):
                heapq.heappush(queue, (-most[child], child))
            continue
        here = slice(tree.first[node], tree.last[node])
        scores = vectors[here] @ anchor
        free = wanted_rows(here)
        for i in open_:
            hits = np.flatnonzero(free & (scores >= floors[i]) & (scores <= windows[i][1]))
            if len(hits):
                at = hits + here.start
                found[i] = heapq.nsmallest(k, [*found[i], *zip((-scores[hits]).tolist(), tree.ids[at].tolist(), tree.rows[at].tolist())])
                if len(found[i]) == k:
                    floors[i] = max(windows[i][0], -found[i][-1][0])
    return found


def _number(x: float | int) -> int:
    return min(max(int(x), _ENDS.min), _ENDS.max)


def _packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    vectors = matrix(rows.column("vector").combine_chunks())
    most = max(-int(vectors.min(initial=0)), int(vectors.max(initial=0)) + 1)
    vectors = vectors.astype(next(t for t in ("int16", "int32", "int64") if most <= np.iinfo(t).max or t == "int64"))
    shard = {"part": rows.column("part")[0].as_py(), "n": rows.num_rows, "kind": vectors.dtype.name, "vectors": vectors.tobytes()}
    shard |= {out: rows.column(c).to_numpy().tobytes() for out, c in (("ids", "vec_id"), ("rows", "row"), ("labels", "label"))}
    return pa.RecordBatch.from_pylist([shard], SHARD)


def pack_shards(shard_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows as they come, shard_rows of them together, in the order of their ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        room = shard_rows
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, room))
                room -= held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if not room:
                    yield _packed(held)
                    held, room = [], shard_rows
        if held:
            yield _packed(held)

    return run


SHARD = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("kind", pa.string()), *((c, pa.binary()) for c in ("ids", "rows", "labels", "vectors"))])
_SHARD_TYPE = "part int, n int, kind string, ids binary, rows binary, labels binary, vectors binary"


def indexed(rows: DataFrame, n_rows: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The shards of all rows; part numbers the ranges they come from."""
    parts = max(1, -(-n_rows // shard_rows))
    first = F.coalesce(F.try_element_at("vector", F.lit(1)), F.lit(0))
    dealt = rows.withColumn("first", first).repartitionByRange(parts, "label", "first", "row").withColumn("part", F.spark_partition_id())
    return dealt.sortWithinPartitions("label", "first", "row").select("part", "row", "vec_id", "label", "vector").mapInArrow(pack_shards(shard_rows), _SHARD_TYPE)


def in_blocks(anchors: DataFrame, blocks: int) -> DataFrame:
    """One row for each block of anchors: arrays of their columns."""
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    each = F.struct(*anchors.columns)
    return anchors.groupBy(block.alias("block")).agg(F.collect_list(each).alias("anchors")).drop("block")


def met(blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """Each block beside each shard."""
    parts = 1 + (shards.agg(F.max("part")).head()[0] or 0)
    tasks = min(parts, 20_000)
    everywhere = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return everywhere.repartition(tasks, "part").join(shards.repartition(tasks, "part"), "part")


def _searched(search: Callable[[Tree, np.ndarray, np.ndarray, pa.StructArray], Iterator[tuple]], names: list[str]):
    """Runs a search on each pair of a block and a shard. It takes tree, rows and anchors as exact numbers, and the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i]  # noqa: B023, E731
                ids, rows, labels = (np.frombuffer(get(c).as_py(), np.int64) for c in ("ids", "rows", "labels"))
                tree = Tree(ids, rows, labels, np.frombuffer(get("vectors").as_py(), get("kind").as_py()).reshape(len(ids), -1))
                anchors = get("anchors").values
                vectors, queries = exact(tree.vectors, matrix(anchors.field("vector")))
                if tree.low.shape[1] <= vectors.shape[1]:  # the boxes of shorter vectors
                    wider = ((0, 0), (0, vectors.shape[1] + 1 - tree.low.shape[1]))
                    tree.low, tree.high = np.pad(tree.low, wider), np.pad(tree.high, wider)
                out = list(search(tree, vectors, queries, anchors))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return run


def find_positives(tree: Tree, vectors: np.ndarray, queries: np.ndarray, anchors: pa.StructArray) -> Iterator[tuple]:
    least, most = tree.bounds(queries)
    whole = [(_ENDS.min, _ENDS.max)] if queries.dtype != object else [(-(1 << 200), 1 << 200)]
    for i, (row, vec_id, label) in enumerate(zip(*(anchors.field(c).to_pylist() for c in ("row", "vec_id", "label")))):
        best = best_first(
            tree, vectors, queries[i], least[i], most[i], lambda node: tree.low[node, 0] <= label <= tree.high[node, 0],
            lambda here: (tree.labels[here] == label) & (tree.rows[here] != row), whole, POSITIVES,
        )[0]
        yield from ((row, vec_id, r, p, _number(-s)) for s, p, r in best)


def find_negatives(tree: Tree, vectors: np.ndarray, queries: np.ndarray, anchors: pa.StructArray) -> Iterator[tuple]:
    least, most = tree.bounds(queries)
    for i, (row, label, positives) in enumerate(zip(*(anchors.field(c).to_pylist() for c in ("row", "label", "positives")))):
        windows = [(-(-LEAST_PERCENT * p["positive_score"] // 100), MOST_PERCENT * p["positive_score"] // 100) for p in positives]
        best = best_first(
            tree, vectors, queries[i], least[i], most[i], lambda node: tree.low[node, 0] != label or tree.high[node, 0] != label,
            lambda here: tree.labels[here] != label, windows, NEGATIVES,
        )
        for p, hits in zip(positives, best):
            yield from ((row, p["positive_row"], r, n, _number(-s)) for s, n, r in hits)


def ranked(df: DataFrame, group: list[str], score: str, ident: str, row: str, most: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), ident, row)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(embeddings: DataFrame, shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    shard_rows and anchor_rows bound what one search holds; results do not depend on them.
    """
    rows = durable(whole_vectors(embeddings))
    anchors = rows.where(F.col("vec_id") % ANCHORS == 0)
    blocks = max(1, -(-anchors.count() // anchor_rows))
    shards = durable(indexed(rows, rows.count(), shard_rows))

    names = ["row", "vec_id", "positive_row", "positive_id", "positive_score"]
    kinds = ", ".join(f"{n} bigint" for n in names)
    near = met(in_blocks(anchors, blocks), shards).mapInArrow(_searched(find_positives, names), kinds)
    positives = durable(ranked(durable(near), ["row"], "positive_score", "positive_id", "positive_row", POSITIVES).drop("rank"))

    beside = positives.groupBy("row").agg(F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))
    names = ["row", "positive_row", "negative_row", "negative_id", "negative_score"]
    kinds = ", ".join(f"{n} bigint" for n in names)
    hard = met(in_blocks(anchors.join(beside, "row"), blocks), shards).mapInArrow(_searched(find_negatives, names), kinds)
    best = ranked(durable(hard), ["row", "positive_row"], "negative_score", "negative_id", "negative_row", NEGATIVES)
    return best.join(positives, ["row", "positive_row"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS nr, vec_id, CASE WHEN vec_id % {MOVED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.nr AS anchor, a.vec_id AS anchor_id, b.nr AS other, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.nr <> b.nr WHERE a.vec_id % {ANCHORS} = 0
), positive AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS place FROM pairs WHERE same) WHERE place <= {POSITIVES}
), negative AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id)::INTEGER AS rank
  FROM positive p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
    AND {LEAST_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {MOST_PERCENT} * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= {NEGATIVES}
"""
