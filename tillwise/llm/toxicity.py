"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

Two words are alike as far as they share three-letter subsequences, where a subsequence counts LAMBDA to the
power of the stretch it takes, up to SPAN letters: letters between them, as in "id.i-ot", only lower its weight.
Landmark words stand for all others (Nyström), so the trained machine is one weight per subsequence, and
a word costs a few table lookups whatever the number of landmarks. A document scores by its worst word, where
letters that stand alone one after another ("i d i o t") also count as one word.

Training is multiple-instance: a toxic document's label says that some of its words are toxic, so each round
takes the highest-scoring words of the toxic documents (three each, later one) as positives and all kinds of words of clean ones as
negatives. Labels of at most SAMPLE_TOXIC and SAMPLE_CLEAN documents (the smallest hashes of doc_id) are used; a third
of them is kept out of the machine and fits the probability.

One row per row of the input; repeated rows and ids are scored each on its own. Null texts count as
empty: they have no words, and score as low as a document can. Without a label of either kind every score
is 0. Other columns of the input are never read. Texts are scored whole.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import SLICE_BYTES, slices, table

SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 3000
LANDMARKS = 128
SPAN, LAMBDA = 6, 0.6
THRESHOLD = 0.3
_SLOTS = 1 << 17
_WIDTH = 24
_STEP = 16
_AT_ONCE = 8_000  # words whose subsequences are held together
_GAPS = [(a, b, LAMBDA ** (b + 1 - 3)) for b in range(2, SPAN) for a in range(1, b)]
_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_] ){2,}[^\W\d_](?!\S)")


def words_of(text: str | None) -> set[str]:
    """Distinct words in lower case without marks around them, and runs of single letters as words."""
    lower = (text or "").lower()
    words = {w.strip(_TRIM) for w in set(lower.split())}
    words.update(m[0].replace(" ", "") for m in _SPACED.finditer(lower))
    words.discard("")
    return words


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of fixed-width stretches, 0 where a word has ended, and the word of each stretch."""
    parts, owner = [], []
    for i, w in enumerate(words):
        w = f"^{w}$"
        for at in range(0, max(1, len(w) - _WIDTH + _STEP), _STEP):
            parts.append(w[at : at + _WIDTH])
            owner.append(i)
    raw = np.array(parts, dtype=f"<U{_WIDTH}")
    return raw.view(np.uint32).reshape(len(parts), _WIDTH), np.array(owner, np.int64)


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slot of each subsequence of each stretch, and its weight, 0 beyond the word's end."""
    mixed = codes * np.uint32(0x9E3779B1)
    for a, b, weight in _GAPS:
        n = _WIDTH - b
        h = mixed[:, :n] ^ (mixed[:, a : a + n] << np.uint32(5)) * np.uint32(0x85EBCA77) ^ (mixed[:, b:] >> np.uint32(3)) * np.uint32(0xC2B2AE3D)
        yield (h ^ h >> np.uint32(15)) & np.uint32(_SLOTS - 1), np.where(codes[:, b:] > 0, np.float32(weight), np.float32(0))


def _scale(codes: np.ndarray) -> np.ndarray:
    return 1 / np.sqrt(np.maximum(1, (codes > 0).sum(1) - 2)).astype(np.float32)


@dataclass
class Model:
    """Weight of each subsequence, the machine's offset, and slope and offset of the probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: list[str]) -> np.ndarray:
        if len(words) > _AT_ONCE:
            return np.concatenate([self.margins(words[i : i + _AT_ONCE]) for i in range(0, len(words), _AT_ONCE)])
        if not words:
            return np.empty(0, np.float32)
        codes, owner = _letters(words)
        total = np.zeros(len(codes), np.float32)
        for slot, weight in _subsequences(codes):
            total += (self.weights[slot] * weight).sum(1)
        out = np.full(len(words), -np.inf, np.float32)
        np.maximum.at(out, owner, total * _scale(codes))
        return out + np.float32(self.bias)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


FLOOR = -3.0


def document_margins(model: Model, texts: list[str | None]) -> np.ndarray:
    """The highest margin among a text's words, at least FLOOR."""
    if sum(len(t or "") for t in texts) > 2 * SLICE_BYTES and len(texts) > 1:
        half = len(texts) // 2
        return np.concatenate([document_margins(model, texts[:half]), document_margins(model, texts[half:])])
    sets = [words_of(t) for t in texts]
    words = list(set().union(*sets))
    known = dict(zip(words, model.margins(words).tolist()))
    return np.array([max(map(known.__getitem__, s), default=FLOOR) for s in sets]).clip(min=FLOOR)


def _kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel values of words against the landmarks' feature table; the closest stretch of a long word counts."""
    out = np.full((len(words), landmarks.shape[1]), -np.inf, np.float32)
    for at in range(0, len(words), 256):
        codes, owner = _letters(words[at : at + 256])
        total = np.zeros((len(codes), landmarks.shape[1]), np.float32)
        for slot, weight in _subsequences(codes):
            total += np.einsum("nwl,nw->nl", landmarks[slot], weight, optimize=False)
        np.maximum.at(out, owner + at, total * _scale(codes)[:, None])
    return out


def _features(words: list[str]) -> np.ndarray:
    """Table of subsequence weights, one column per word."""
    out = np.zeros((_SLOTS, len(words)), np.float32)
    codes, owner = _letters(words)
    scale = _scale(codes)
    for slot, weight in _subsequences(codes):
        np.add.at(out, (slot, owner[:, None]), weight * scale[:, None])
    return out


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Linear support vector machine with squared hinge loss by Newton steps; the last weight is the offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([*np.ones(x.shape[1] - 1), 1e-6])
    for _ in range(20):
        active = y * (x @ w) < 1
        xa = x[active]
        ca = cost[active][:, None]
        new = np.linalg.solve((xa * ca).T @ xa / len(x) + penalty, (xa * ca).T @ y[active] / len(x))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    z = np.stack([x, np.ones_like(x)], 1)
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        b = b + np.linalg.solve(h, z.T @ (t - p) - 1e-3 * b)
    return max(float(b[0]), 1e-3), float(b[1])


def train(texts: list[str | None], toxic: list[int], rounds: int = 5) -> Model:
    """The machine, from labelled texts in an order that has nothing to do with their labels."""
    y = np.array(toxic)
    if not (y == 1).any() or not (y == 0).any():
        return Model(np.zeros(_SLOTS, np.float32), 0.0, 1.0, -30.0)
    part = np.arange(len(y)) % 3 == 2
    if min((y[~part] == 1).sum(), (y[part] == 1).sum(), (y[part] == 0).sum()) == 0:
        part = np.zeros(len(y), bool)
    dirty, clean = Counter(), Counter()
    bags = []
    for t, label, out in zip(texts, toxic, part):
        if not out:
            words = words_of(t)
            (dirty if label else clean).update(words)
            if label:
                bags.append(words)
    suspects = [[w for w in words if w not in clean] or list(words) for words in bags]
    del bags
    pool = sorted({w for s in suspects for w in s}, key=lambda w: (-dirty[w], w))
    common = sorted(clean, key=lambda w: (-clean[w], w))
    step = max(1, len(common) // 6000)
    plain = common[:1500] + common[1500::step]
    marks = pool[: LANDMARKS // 2] + common[: LANDMARKS - min(len(pool), LANDMARKS // 2)]
    table_ = _features(marks)
    inner = _kernel(marks, table_).astype(np.float64)
    inner = (inner + inner.T) / 2
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-3 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # K_ll to the power -1/2, in its main directions
    score = {w: float(dirty[w]) for w in pool}
    plain_x = _kernel(plain, table_) @ root
    taken, model = plain, Model(np.zeros(_SLOTS, np.float32), 0.0, 1.0, 0.0)
    for turn in range(rounds):
        positive = sorted({w for s in suspects for w in sorted(s, key=lambda w: (-score[w], w))[: 3 if turn < 2 else 1] if score[w] > (1 if turn == 0 else 0)})
        if not positive:
            positive = pool[:50]
        x = np.vstack([_kernel(positive, table_) @ root, plain_x])
        label = np.array([1.0] * len(positive) + [-1.0] * len(taken))
        cost = np.where(label > 0, 0.5 * len(label) / len(positive), 1.0)
        w = _machine(x, label, np.minimum(cost, 20.0))
        model = Model(table_ @ (root @ w[:-1]).astype(np.float32), float(w[-1]), 1.0, 0.0)
        score = dict(zip(pool, model.margins(pool).tolist()))
        if turn < rounds - 1:  # the clean words that still look worst join the negatives
            worst = np.argsort(-model.margins(common), kind="stable")[:1500]
            used = set(taken)
            more = [common[i] for i in worst if common[i] not in used]
            taken = taken + more
            plain_x = np.vstack([plain_x, _kernel(more, table_) @ root]) if more else plain_x
    held = part if part.any() else ~part
    margins = document_margins(model, [t for t, out in zip(texts, held) if out])
    model.slope, model.offset = _logistic(margins, y[held].astype(float))
    return model


def sample(docs: DataFrame, labels: DataFrame, toxic: int, most: int) -> DataFrame:
    """At most `most` labelled texts of one kind, by the hash of their doc_id."""
    wanted = labels.where(F.col("toxic") == toxic).select("doc_id").dropna().distinct()
    chosen = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("toxic", F.lit(toxic))


def train_on_tables(docs: DataFrame, labels: DataFrame) -> Model:
    """docs and labels hold training rows only."""
    both = sample(docs, labels, 1, SAMPLE_TOXIC).unionByName(sample(docs, labels, 0, SAMPLE_CLEAN))
    rows = both.select("text", "toxic", F.xxhash64(F.lit(7), "doc_id").alias("order")).collect()
    rows.sort(key=lambda r: (r["order"], r["text"] or ""))
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, 0 to 1, of each row of docs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # _SLOTS weights, half a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = document_margins(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(found))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, that score below the threshold, each judged by its own text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = document_margins(shared.value, batch.column("text").to_pylist())
            yield batch.filter(pa.array(shared.value.score(found) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; a null id counts as the text "null"."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % 4 == 2


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    return train_on_tables(docs.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, trained(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
