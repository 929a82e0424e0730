"""Katz backoff language model of word pairs, and its log probability of every text.

A count r up to K is discounted by Good and Turing's estimate, and a count above K loses what a count of K
loses, so every context keeps mass for words that it has not shown (Katz leaves these counts whole, which leaves
some contexts nothing to back off with). The kept mass goes to the other words in proportion to their own
probability: the backoff weight is (mass kept) / (1 - probability of the words shown), exactly normalised. The lower
order is the discounted unigram, whose kept mass goes to one class of unknown words. A token's probability is looked up
recursively: the pair if it was seen, else the weight of its context times the token's own probability; an
unseen context has weight 1.

Tables: unigram counts and contexts (backoff weights) are written as Parquet tables. Pair counts are far more than texts
allow to keep beside them: blocks of texts send their distinct pairs, with the documents they stand in, to shards by
the second word (frequent words are split by pair). There the counts are summed and go back to the blocks, where each
document's score is summed. What travels is a fixed number of bytes a token at most, whatever the number of shards.
All sums follow the corpus; no task holds more than a shard or a block.

Null and empty texts are one end token. Rows that repeat doc_id and text get the same score, each counted
in training. A null doc_id counts as the text "null" for the split. An empty table gives an empty result. Other
columns are ignored. Words are 64-bit fingerprints.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import durable, slices, table
from tillwise.llm.hashing import mix, word_hashes

K = 5
SHARD_TOKENS = 1_000_000
# a block of texts: about so many bytes, at most so many documents (twice the number of one is a smallint)
BLOCK_BYTES, BLOCK_DOCS = 5 << 20, 16_000
START, END = np.uint64(0x5F3759DF5F3759DF), np.uint64(0x2545F4914F6CDD1D)


def good_turing(n: list[int]) -> list[float]:
    """Amounts that counts 1 to K lose, from the number of types with counts 1 to K + 1.

    Where the estimate is no discount (it loses nothing or all), the count loses n1 / (n1 + 2 n2), at most half.
    """
    n1, n2 = n[0], n[1]
    plain = min(0.5, n1 / (n1 + 2 * n2)) if n1 else 0.5
    common = (K + 1) * n[K] / n1 if n1 else 1.0
    out = []
    for r in range(1, K + 1):
        turing = (r + 1) * n[r] / n[r - 1] if n[r - 1] else 0.0
        d = (turing / r - common) / (1 - common) if common != 1 else 0.0
        out.append(r * (1 - d) if 0 < d < 1 else plain)
    return out


def lost(counts: np.ndarray, amounts: list[float]) -> np.ndarray:
    """What each count loses."""
    return np.array([0.0, *amounts])[np.minimum(counts, K)]


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and token of every position of all texts, and the text it stands in."""
    words, bounds = word_hashes(texts)
    size = np.diff(bounds) + 1
    ends = np.cumsum(size) - 1
    token = np.empty(int(size.sum()), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[is_end], token[~is_end] = END, words
    context = np.concatenate(([START], token[:-1]))
    context[ends[:-1] + 1] = START
    return context, token, np.repeat(np.arange(len(texts)), size)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Contexts, tokens and their documents, keys and training marks of blocks of about BLOCK_BYTES of texts.

    Words are hashed slice by slice, which takes many times a slice's bytes; a block is three numbers a token.
    """

    def block() -> tuple:
        context, token, doc = (np.concatenate(x) for x in zip(*held))
        held.clear()
        return context, token, doc, np.concatenate(keys), np.concatenate(marks)

    held, keys, marks, size, docs = [], [], [], 0, 0
    for batch in (x.slice(k, BLOCK_DOCS) for x in slices(batches) for k in range(0, x.num_rows, BLOCK_DOCS)):
        if held and (size >= BLOCK_BYTES or docs + batch.num_rows > BLOCK_DOCS):
            yield block()
            keys, marks, size, docs = [], [], 0, 0
        texts = batch.column("text").to_pylist()
        context, token, doc = tokens(texts)
        held.append((context, token, (doc + docs).astype(np.int32)))
        keys.append(batch.column("key").to_numpy())
        marks.append(batch.column("training").to_numpy(zero_copy_only=False).astype(bool))
        docs += len(texts)
        size += sum(len(t or "") for t in texts)
    if held:
        yield block()


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def unigrams(keyed: DataFrame) -> DataFrame:
    """word and c, its count among training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, token, doc, _, marks in _blocks(batches):
            word, c = np.unique(token[marks[doc]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(word)), pa.array(c.astype(np.int64))], ["word", "c"])

    rows = keyed.select("text", "key", "training").mapInArrow(run, "word bigint, c bigint")
    return durable(rows.groupBy("word").agg(F.sum("c").alias("c")))


_PAIRS = "shard int, block bigint, w array<bigint>, w_len array<int>, u array<bigint>, u_len array<smallint>, doc array<smallint>, n array<int>, keys array<bigint>"


def pair_blocks(keyed: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Of each block and shard, the distinct pairs by word and context, and the documents they stand in.

    A document is its number in the block, twice, plus one if it is for training. One row of a block has the documents' keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the same again when a lost task runs anew: a partition of the scan has the same rows in the same order
        block = TaskContext.get().partitionId() << 32
        for u, w, doc, keys, marks in _blocks(batches):
            block += 1
            by_pair = np.isin(w, hot)
            shard = (np.where(by_pair, mix(u ^ mix(w)), mix(w)) % np.uint64(shards)).astype(np.int32)
            # documents ascend already, and both sorts keep the order of equals
            order = np.lexsort((u, w))
            order = order[np.argsort(shard[order], kind="stable")]
            u, w, doc, shard = u[order], w[order], doc[order], shard[order]
            new_shard = np.concatenate(([True], shard[1:] != shard[:-1]))
            new_w = new_shard | np.concatenate(([True], w[1:] != w[:-1]))
            new_u = new_w | np.concatenate(([True], u[1:] != u[:-1]))
            new_doc = new_u | np.concatenate(([True], doc[1:] != doc[:-1]))
            posts = np.flatnonzero(new_doc)
            n = np.diff(np.append(posts, len(doc)))
            pair_at = np.flatnonzero(new_u[posts])
            word_at = np.flatnonzero(new_w[posts][pair_at])
            bounds = [*np.flatnonzero(new_shard[posts][pair_at][word_at]), len(word_at)]
            pair_ends, post_ends = np.append(word_at, len(pair_at)), np.append(pair_at, len(posts))
            doc, u, w, shard = doc[posts] * 2 + marks[doc[posts]], u[posts], w[posts], shard[posts]
            for a, b in zip(bounds[:-1], bounds[1:]):
                pa_, pb = int(pair_ends[a]), int(pair_ends[b])
                da, db = int(post_ends[pa_]), int(post_ends[pb])
                row = [
                    _signed(w[pair_at[word_at[a:b]]]), np.diff(pair_ends[a : b + 1]), _signed(u[pair_at[pa_:pb]]),
                    np.diff(post_ends[pa_ : pb + 1]), doc[da:db], n[da:db], keys if a == 0 else keys[:0],
                ]
                names, kinds = zip(*(x.split(" ") for x in _PAIRS.split(", ")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[da])], pa.int32()), pa.array([block], pa.int64()), *(_lists(v, [0, len(v)], k) for v, k in zip(row, kinds[2:]))],
                    list(names),
                )

    return keyed.select("text", "key", "training").mapInArrow(run, _PAIRS)


_KINDS = {"array<bigint>": np.int64, "array<int>": np.int32, "array<smallint>": np.int16, "array<double>": np.float64, "array<boolean>": bool}


def _lists(values: np.ndarray, ends, kind: str) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.asarray(values).astype(_KINDS[kind], copy=False)))


def _ends(lists: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, lists)])


def _flat(rows: pa.Table, names: list[str]) -> dict[str, list[np.ndarray]]:
    return {c: [x.values.to_numpy(zero_copy_only=False) for x in rows.column(c).combine_chunks()] for c in names}


class Shard:
    """The pairs of one shard: word, context and training count of each, and where they stand in the blocks' rows."""

    def __init__(self, rows: pa.Table):
        lists = _flat(rows, ["w", "w_len", "u", "u_len", "doc", "n", "keys"])
        self.ends = {c: _ends(x) for c, x in lists.items()}
        self.flat = flat = {c: np.concatenate(x) for c, x in lists.items()}
        w = np.repeat(flat["w"], flat["w_len"]).view(np.uint64)
        u = flat["u"].view(np.uint64)
        order = np.lexsort((u, w))
        w, u = w[order], u[order]
        first = np.concatenate(([True], (w[1:] != w[:-1]) | (u[1:] != u[:-1])))
        self.w, self.u = w[first], u[first]
        self.pair = np.empty(len(w), np.int32)
        self.pair[order] = np.cumsum(first) - 1
        self.post = np.repeat(self.pair, flat["u_len"])
        self.c = np.bincount(self.post, flat["n"] * (flat["doc"] & 1), len(self.w)).astype(np.int64)
        del order, first, lists
        pa.default_memory_pool().release_unused()

    def word_counts(self, hot: np.ndarray, hot_c: np.ndarray) -> np.ndarray:
        """Training count of each pair's word."""
        first = np.flatnonzero(np.concatenate(([True], self.w[1:] != self.w[:-1])))
        out = np.repeat(np.add.reduceat(self.c, first), np.diff(np.append(first, len(self.w))))
        if len(hot):
            at = np.minimum(np.searchsorted(hot, self.w), len(hot) - 1)
            out = np.where(hot[at] == self.w, hot_c[at], out)
        return out


def counts_of_counts(blocks: DataFrame) -> list[int]:
    """Number of pairs with training counts 1 to K + 1."""

    def run(rows: pa.Table) -> pa.Table:
        n = np.bincount(np.minimum(Shard(rows).c, K + 2), minlength=K + 3)[1 : K + 2]
        return pa.table({"r": np.arange(1, K + 2), "types": n})

    # written, so that the shuffled pairs are gone before `shard_sums` shuffles them again
    found = durable(blocks.groupBy("shard").applyInArrow(run, "r bigint, types bigint"))
    got = {r["r"]: r["types"] for r in found.groupBy("r").agg(F.sum("types").alias("types")).collect()}
    return [got.get(r, 0) for r in range(1, K + 2)]


_SHARD_OUT = {
    "w_len": "array<int>", "is_end": "array<boolean>", "word_c": "array<bigint>", "u_len": "array<smallint>", "pair_c": "array<bigint>",
    "doc": "array<smallint>", "n": "array<int>", "keys": "array<bigint>", "new_u": "array<bigint>", "new_doc": "array<smallint>", "new_n": "array<int>",
    "context": "array<bigint>", "lost": "array<double>", "shown": "array<double>",
}


def _own(c_w: np.ndarray, known: dict) -> np.ndarray:
    """Discounted probability of words with these counts by themselves."""
    return np.where(c_w > 0, (c_w - lost(c_w, known["word_lost"])) / max(known["total"], 1), known["unknown"])


def shard_sums(blocks: DataFrame, known: dict) -> DataFrame:
    """Each block's part of a shard with the counts of its words and pairs, and its pairs not seen in training;
    one row of a shard has the shard's parts of the contexts."""

    def run(rows: pa.Table) -> pa.Table:
        s = Shard(rows)
        c_w = s.word_counts(known["hot"], known["hot_c"])
        flat, ends, seen = s.flat, s.ends, s.c > 0
        at_word = s.pair[np.cumsum(flat["w_len"]) - flat["w_len"]]
        new = ~seen[s.post]
        new_ends = np.concatenate(([0], np.cumsum(new)))[ends["doc"]]
        u, at = s.u[seen], np.argsort(s.u[seen], kind="stable")
        u = u[at]
        first = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))) if len(u) else np.empty(0, np.int64)
        add = (lambda x: np.add.reduceat(x[seen][at], first)) if len(u) else (lambda x: np.empty(0))
        once = [0] + [len(first)] * len(rows)
        values = {
            "w_len": (flat["w_len"], ends["w"]), "is_end": (s.w[at_word] == END, ends["w"]), "word_c": (c_w[at_word], ends["w"]),
            "u_len": (flat["u_len"], ends["u"]), "pair_c": (s.c[s.pair], ends["u"]),
            "doc": (flat["doc"] >> 1, ends["doc"]), "n": (flat["n"], ends["doc"]), "keys": (flat["keys"], ends["keys"]),
            "new_u": (_signed(s.u[s.post[new]]), new_ends), "new_doc": (flat["doc"][new] >> 1, new_ends), "new_n": (flat["n"][new], new_ends),
            "context": (_signed(u[first]), once), "lost": (add(lost(s.c, known["pair_lost"])), once), "shown": (add(_own(c_w, known)), once),
        }
        return pa.table({"block": rows.column("block"), **{c: _lists(*values[c], kind) for c, kind in _SHARD_OUT.items()}})

    return durable(blocks.groupBy("shard").applyInArrow(run, "block bigint, " + ", ".join(f"{k} {v}" for k, v in _SHARD_OUT.items())))


_OWN = "block bigint, doc int, key bigint, n_tokens bigint, n_known bigint, base double, score double"


def block_sums(sums: DataFrame, known: dict) -> DataFrame:
    """Of each document, by block and number, the sums over its tokens, without what unseen pairs get from their contexts."""

    def run(rows: pa.Table) -> pa.Table:
        x = {c: np.concatenate(v) for c, v in _flat(rows, ["w_len", "is_end", "word_c", "u_len", "pair_c", "doc", "n", "keys"]).items()}
        c_w, is_end = np.repeat(x["word_c"], x["w_len"]), np.repeat(x["is_end"].astype(bool), x["w_len"])
        c = x["pair_c"]
        term = np.log10(np.where(c > 0, c - lost(c, known["pair_lost"]), _own(c_w, known)))
        # the token is also the context of the next position, whose seen pairs are divided by its count
        term -= np.where(~is_end & (c_w > 0), np.log10(np.maximum(c_w, 1)), 0.0)
        base = np.log10((c_w + 0.1) / (known["total"] + 0.1 * (known["types"] + 1)))
        docs = len(x["keys"])
        pa.default_memory_pool().release_unused()
        add = lambda v: np.bincount(x["doc"], x["n"] * np.repeat(v, x["u_len"]), docs)
        whole = lambda v: add(v).astype(np.int64)
        return pa.table({
            "block": np.full(docs, rows.column("block")[0].as_py(), np.int64), "doc": np.arange(docs, dtype=np.int32), "key": x["keys"],
            "n_tokens": whole(np.ones(len(c))), "n_known": whole(c_w > 0), "base": add(base), "score": add(term),
        })

    parts = sums.select("block", "w_len", "is_end", "word_c", "u_len", "pair_c", "doc", "n", "keys")
    return parts.groupBy("block").applyInArrow(run, _OWN)


def _rows(sums: DataFrame, names: list[str], *also: str) -> DataFrame:
    return sums.select(*also, F.explode(F.arrays_zip(*names)).alias("x")).select(*also, "x.*")


def katz_scores(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score and score of each row of docs."""
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text", *(F.col(c).isNull() for c in ("doc_id", "text"))).alias("key"), training.alias("training"))
    words = unigrams(keyed)
    classes = [F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, K + 2)]
    total, types, texts, *n = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.col("word") == int(_signed(np.array([END]))[0]), F.col("c"))), F.lit(0)), *classes
    ).first()
    shards = max(1, math.ceil(total / SHARD_TOKENS))
    # words too frequent for one shard: fewer than 4 * shards
    found = sorted((np.uint64(r["word"] % (1 << 64)), r["c"]) for r in words.where(F.col("c") > total / (4 * shards)).collect())
    word_lost = good_turing(n)
    gone = words.agg(F.sum(F.element_at(F.array(*[F.lit(x) for x in word_lost]), F.least("c", F.lit(K)).cast("int")))).first()[0]
    known = {
        "hot": np.array([w for w, _ in found], np.uint64), "hot_c": np.array([c for _, c in found], np.int64),
        "total": total, "types": types, "word_lost": word_lost, "unknown": gone / total if total else 1.0,
    }
    blocks = pair_blocks(keyed, shards, known["hot"])
    known["pair_lost"] = good_turing(counts_of_counts(blocks))
    sums = shard_sums(blocks, known)
    parts = _rows(sums, ["context", "lost", "shown"]).groupBy("context").agg(F.sum("lost").alias("lost"), F.sum("shown").alias("shown"))
    count = F.when(F.col("context") == int(_signed(np.array([START]))[0]), F.lit(texts)).otherwise(F.col("c"))
    contexts = durable(
        parts.join(words.withColumnRenamed("word", "context"), "context", "left").select(
            "context", count.alias("c"), (F.col("lost") / (1 - F.col("shown"))).alias("spread"), (F.col("lost") / count / (1 - F.col("shown"))).alias("weight")
        )
    )
    backed = (
        _rows(sums, ["new_u", "new_doc", "new_n"], "block")
        .join(contexts.select(F.col("context").alias("new_u"), F.log10("spread").alias("bonus")), "new_u")
        .select("block", F.col("new_doc").cast("int").alias("doc"), (F.col("new_n") * F.col("bonus")).alias("score"))
    )
    own = block_sums(sums, known).unionByName(backed, allowMissingColumns=True).groupBy("block", "doc").agg(
        F.max("key").alias("key"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score"))
    )
    # rows that repeat id and text have one key and equal sums
    each = own.groupBy("key").agg(F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("n_known"), F.avg("base").alias("base"), F.avg("score").alias("score"))
    opening = F.lit(-math.log10(texts) if texts else 0.0)
    return keyed.select("doc_id", "training", "key").join(each, "key").select(
        "doc_id", "training", "n_tokens", "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("score") + opening).alias("score"),
    )


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 10 != 0
    scores = katz_scores(table(spark, sf_dir, "documents"), training)
    return scores.withColumn("held_out", ~F.col("training")).drop("training")
