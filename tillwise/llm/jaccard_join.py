"""N-gram Jaccard self-join by parity sketches, and the components of its links.

A document's set holds the fingerprints of its distinct shingles. A sketch has parts, and each shingle is XORed
into one of them, so shingles that two sets share cancel out and the number of parts that differ (the Hamming
distance) is at most the size of their symmetric difference. Sets of similarity t and sizes up to s differ in at most
d = 2s(1 - t)/(1 + t) shingles; so if more than d parts of one of them hold a shingle, the two are equal in a part that
does. Sketches are joined on these parts, per size band. A set that fills no more than d parts goes on with the parts of
another sketch, and so on until one is full enough: linked sets then meet in the first sketch that is full enough for either.
A band also takes in the smaller sets of the bands below, as far as they can be partners. A sketch of SKETCH_BITS
parity bits, whose Hamming distance has the same bound, rejects most candidates that
are equal in a part by chance, before any set is fetched.

Equal sets become one class first. In a part with few classes all pairs are candidates; in a crowded one, all are compared
with one centre, and the rest only across components, where the distances to the centre leave a link
possible (Jaccard distance is a metric). Candidates that pass the sketch are verified on the whole sets, so links
between classes are exact but for 64-bit fingerprints; pairs that components make superfluous are never made.

Null and empty texts have no shingles and link with nothing; fewer words than a shingle has are one shingle. Repeated rows and
ids are rows of their own: a row is told by its doc_id and a hash of its text. A null doc_id names a component only if it has
no other id. Other columns are ignored, or carried through by `one_of_each`. Texts are read whole. The words of a shingle
and the least similarity, at least 0.7, are arguments; both default to those of the query.
"""

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import SLICE_BYTES, durable, slices, table
from tillwise.llm.hashing import mix, word_hashes

SHINGLE = 3
LEAST = Fraction(9, 10)  # the least similarity
CROWDED = 12
SKETCHES = 64  # that a set may go on to; one that fills none of them would meet all such sets of its band
SKETCH_BITS = 1024
BROADCAST_ROWS = 500_000  # of five numbers each
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def band_starts(most: int = 1 << 40) -> list[int]:
    """Smallest set size of each band: every size at first, then a quarter more each."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return out


_BANDS = np.array(band_starts())


def shingle_sets(texts: list[str | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted fingerprints of the distinct shingles of each text."""
    words, bounds = word_hashes(texts)
    if len(words) >= shingle:
        place = [np.uint64(pow(int(_P[0]), i + 1, 1 << 64)) for i in range(shingle)]
        joined = mix(sum(words[i : len(words) - shingle + 1 + i] * place[i] for i in range(shingle)))
    else:
        joined = np.empty(0, np.uint64)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(joined[a : b - shingle + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for i in range(a, b):
                short = mix(short * _P[3] + words[i : i + 1])
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _sketch(at: np.ndarray, codes: np.ndarray, parts: int) -> np.ndarray:
    out = np.zeros(parts, np.uint64)
    np.bitwise_xor.at(out, at, codes)
    return out


@lru_cache(maxsize=4096)
def part_counts(band: int, least: Fraction) -> tuple[int, int]:
    """The most that linked sets of a band differ by, and as many parts as sets of the band usually fill more of."""
    over, under = least.as_integer_ratio()
    smallest, largest = int(_BANDS[band]), int(_BANDS[band + 1]) - 1
    differ = 2 * largest * (under - over) // (under + over)
    parts = differ + 1
    while True:
        empty = parts * math.exp(-0.9 * smallest / parts)  # expected in a set somewhat smaller than the band
        wanted = differ + 1 + math.ceil(empty + 2.5 * math.sqrt(empty))
        if wanted <= parts or parts > 2 * (differ + 1):
            return differ, parts
        parts += 1


def part_keys(hashes: np.ndarray, least: Fraction = LEAST) -> np.ndarray:
    """Keys of the parts of a set's sketches: in its own band, and in the next ones where partners may be."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    over, under = least.as_integer_ratio()
    j = int(np.searchsorted(_BANDS, n, "right")) - 1
    codes = mix(hashes ^ _P[1])
    out = []
    while under * n >= over * int(_BANDS[j]):
        differ, parts = part_counts(j, least)
        for sketch in range(SKETCHES if differ else 0):  # without a difference only equal sets link
            place = np.arange(parts, dtype=np.uint64) + np.uint64(j << 40 | sketch << 32)
            spread = mix(hashes + _P[2] * np.uint64(sketch)) if sketch else hashes
            at = (spread % np.uint64(parts)).view(np.int64)
            filled = np.bincount(at, minlength=parts) > 0
            keys = mix(mix(_sketch(at, codes, parts) + _P[0]) ^ place * _P[1])
            out.append(keys[filled].view(np.int64))
            if np.count_nonzero(filled) > differ:
                break
        else:
            if differ:
                out.append(np.array([j], np.int64))
        j += 1
    return np.concatenate(out) if out else np.empty(0, np.int64)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """SKETCH_BITS parity bits of a set."""
    odd = np.bincount((hashes >> np.uint64(40)).view(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate([a.view(np.int64) for a in arrays]) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _print(sets: list[np.ndarray], salt: np.uint64) -> pa.Array:
    return pa.array(np.array([mix(s ^ salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64))


def signatures(docs: DataFrame, shingle: int, least: Fraction) -> DataFrame:
    """doc_id, text_key, n, print1, print2 (of the whole set), keys and sketch."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES // 4):
            sets = shingle_sets(batch.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _print(sets, _P[2]),
                    _print(sets, _P[3]),
                    _lists([part_keys(s, least) for s in sets]),
                    _lists([parity_sketch(s) for s in sets]),
                ],
                ["doc_id", "text_key", *_SET, "keys", "sketch"],
            )

    schema = f"doc_id {id_type}, text_key bigint, n bigint, print1 bigint, print2 bigint, keys array<bigint>, sketch array<bigint>"
    return docs.select("doc_id", "text", text_key()).mapInArrow(run, schema)


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


_SET = ["n", "print1", "print2"]


def fetched_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node and hashes of each wanted class (own_id, node, n, print1, print2), from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES // 4):
            sets = shingle_sets(batch.column("text").to_pylist(), shingle)
            same = pc.and_(pc.equal(_print(sets, _P[2]), batch.column("print1")), pc.equal(_print(sets, _P[3]), batch.column("print2")))
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(sets)], ["node", "hashes"]).filter(same)

    texts = docs.select("doc_id", "text").join(small(wanted), F.col("doc_id").eqNullSafe(F.col("own_id")))
    sets = durable(texts.select("node", "text", "print1", "print2").mapInArrow(run, "node bigint, hashes array<bigint>"))
    # rows that repeat a doc_id and its text give their class more than once
    return sets if sets.count() == wanted.count() else durable(sets.dropDuplicates(["node"]))


def hamming(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, d: t + d)


def may_link(x: Column, y: Column, sizes: Column, least: Fraction) -> Column:
    """Whether two sketches leave a link possible between sets of these sizes together."""
    over, under = least.as_integer_ratio()
    return (under + over) * hamming(x, y) <= (under - over) * sizes


def verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, shingle: int, least: Fraction) -> DataFrame:
    """a, b, low and high (bounds of the Jaccard distance) and linked of each pair."""
    slim = lambda x: rows.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    sizes = F.col("na") + F.col("nb")
    near = durable(
        pairs.join(slim("a"), "a").join(slim("b"), "b").withColumn("differ", hamming(F.col("sa"), F.col("sb"))).select(
            "a", "b", (2 * F.col("differ") / (sizes + F.col("differ"))).alias("low"),
            may_link(F.col("sa"), F.col("sb"), sizes, least).alias("open"),
        )
    )
    to_check = near.where("open").select("a", "b")
    nodes = durable(to_check.select(F.col("a").alias("node")).union(to_check.select("b")).distinct())
    sets = fetched_sets(docs, durable(rows.join(nodes, "node", "left_semi").select(F.col("doc_id").alias("own_id"), "node", *_SET)), shingle)
    both = (
        to_check.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
        .withColumn("shared", F.size(F.array_intersect("ha", "hb")))
    )
    union = F.size("ha") + F.size("hb") - F.col("shared")
    distance = 1 - F.col("shared") / union
    exact = both.select("a", "b", distance.alias("low"), distance.alias("high"), (least.denominator * F.col("shared") >= least.numerator * union).alias("linked"))
    far = near.where("not open").select("a", "b", "low", F.lit(1.0).alias("high"), F.lit(False).alias("linked"))
    return durable(exact.unionByName(far))


def components(links: DataFrame) -> DataFrame:
    """node and comp (its smallest reachable node) of all nodes of links (a, b).

    Every node takes the smallest label around it, then the label of its label, until nothing changes.
    """
    edges = durable(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")).select(F.col("a").alias("node"), "comp"))
    while True:
        around = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("low"))
        lower = around.select(F.col("a").alias("node"), "low").join(labels, "node").select("node", F.least("low", "comp").alias("low"), "comp")
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("further"))
        new = durable(lower.join(jump, "low", "left").select("node", F.least("low", F.coalesce("further", "low")).alias("comp"), F.col("comp").alias("old")))
        labels = new.select("node", "comp")
        if new.where("comp != old").isEmpty():
            return labels


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def linked_rows(docs: DataFrame, shingle: int, least: Fraction) -> DataFrame:
    """doc_id, text_key, node, n, comp (the same for rows of a component) and component_id of each row of docs."""
    rows = durable(signatures(docs, shingle, least).withColumn("node", F.monotonically_increasing_id()))
    classes = durable(
        rows.where("n > 0").groupBy(*_SET).agg(F.min("node").alias("node"), F.min("doc_id").alias("class_id"))
    )
    spare = durable(rows.where("n > 0").select("node").join(classes.select("node"), "node", "left_anti"))
    keyed = rows.join(small(spare), "node", "left_anti").select("node", F.explode("keys").alias("key"))
    # most keys occur once: the others are found and written first, so that only they hold rows together
    size = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    parts = durable(keyed.join(size, "key"))
    few, crowds = parts.where(F.col("size") <= CROWDED), parts.where(F.col("size") > CROWDED)
    # the class that is in most crowds is the most typical one, and links with most of the others
    typical = crowds.groupBy("node").agg(F.count(F.lit(1)).alias("crowds"))
    centres = crowds.join(typical, "node").groupBy("key").agg(F.max(F.struct("crowds", -F.col("node")))["col2"].alias("centre"))
    many = durable(crowds.join(centres.select("key", (-F.col("centre")).alias("centre")), "key"))
    within = few.alias("x").join(few.alias("y"), "key").where("x.node < y.node").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    star = many.where("node != centre").select(*_pair(F.col("centre"), F.col("node")))
    first = verified(within.unionByName(star).distinct(), rows, docs, shingle, least)
    comps = components(first.where("linked"))

    # crowded parts: classes outside the centre's component against all that may still link with them
    comp_of = lambda frame, name, out: frame.join(
        comps.select(F.col("node").alias(name), F.col("comp").alias(out)), name, "left"
    ).withColumn(out, F.coalesce(out, name))
    known = many.select("*", *_pair(F.col("centre"), F.col("node"))).join(first.drop("linked"), ["a", "b"], "left").na.fill(0.0, ["low", "high"])
    placed = comp_of(comp_of(known, "node", "comp"), "centre", "main").select("key", "node", "comp", "main", "low", "high")
    open_keys = durable(placed.where("comp != main").select("key").distinct())
    placed = durable(placed.join(open_keys, "key", "left_semi").join(rows.select("node", "n", "sketch"), "node"))
    outside = placed.where("comp != main")
    reach = float(1 - least) + 1e-9
    second = durable(
        outside.alias("x")
        .join(placed.alias("y"), "key")
        .where(
            (F.col("x.comp") != F.col("y.comp"))
            & (F.col("x.low") - F.col("y.high") <= reach)
            & (F.col("y.low") - F.col("x.high") <= reach)
            & may_link(F.col("x.sketch"), F.col("y.sketch"), F.col("x.n") + F.col("y.n"), least)
        )
        .select(*_pair(F.col("x.node"), F.col("y.node")))
        .distinct()
        .join(first.select("a", "b"), ["a", "b"], "left_anti")
    )
    links = first.where("linked")
    if not second.isEmpty():
        links = links.unionByName(verified(second, rows, docs, shingle, least).where("linked"))
        comps = components(links)
    named = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    whole = named.join(lowest, "comp").select(*_SET, "comp", "component_id")
    return rows.select("doc_id", "text_key", "node", *_SET).join(whole, _SET, "left").select(
        "doc_id", "text_key", "node", "n", F.coalesce("comp", "node").alias("comp"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, least: Fraction = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs; shingle in words, least is the similarity of a link."""
    return linked_rows(docs, shingle, least).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, least: Fraction = LEAST) -> DataFrame:
    """The rows of docs, with all columns, that stay: of each component the one with the least doc_id, null last.

    Of rows with this doc_id the one with the least hash of its text stays, of equal rows one.
    """
    rows = durable(linked_rows(docs, shingle, least))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "node")
    stays = rows.groupBy("comp").agg(F.min(first)["node"].alias("stays"))
    judged = rows.join(stays, "comp").select("doc_id", "text_key", (F.col("node") == F.col("stays")).alias("kept"))
    # by id and text: rows that all go, and rows of which one stays
    met = judged.groupBy("doc_id", "text_key").agg(F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("kept < n")
    met = durable(met.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), F.col("kept").alias("_kept")))
    own = docs.withColumn("_key", text_key())
    same = own["doc_id"].eqNullSafe(F.col("_id")) & (own["_key"] == F.col("_text"))
    rest = own.join(met.where("_kept = 0"), same, "left_anti")
    again = met.where("_kept > 0")
    if not again.isEmpty():
        turn = Window.partitionBy("doc_id", "_key").orderBy(F.lit(1))
        one = rest.join(again, same, "left_semi").withColumn("_turn", F.row_number().over(turn)).where("_turn = 1").drop("_turn")
        rest = rest.join(again, same, "left_anti").unionByName(one)
    return rest.drop("_key")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
