"""Benchmark decontamination by template canonicalisation.

A text becomes a template: numbers, names (capitalised words inside a sentence) and units (after a number)
are typed placeholders, neighbouring placeholders of one type are one slot, all else are lower-case words. A
capitalised word that opens a sentence may be either, so windows over such a word are made both ways.
Windows of WINDOW template words are joined by hash with those of the benchmark (an item with fewer words
is one window). Windows whose places in document and item are shifted against each other by amounts within one band
of BAND tokens (bands overlap by half) form an alignment, so a word put in, left out or replaced costs the windows
over it only. A document is contaminated by an item if the windows of an alignment cover at least COVERAGE of the item's
tokens, and LEAST_TOKENS of them or all, and the slots are consistent: the same value of the item always stands for the
same value of the document, and different ones for different ones. So a question that only got other numbers or names
is found as well. Slots with a word that opens a sentence are no evidence against, as it may be no name.

An item of fewer than ITEM_WORDS plain words can't be told from ordinary text and is not looked for.

One row per row of the documents. Rows that share a doc_id are one document: contaminated if one of them is. Null and
empty texts have no windows; items without words match nothing; repeated items are items of their own, and rows
that share an item_id are told apart by their text. An empty benchmark contaminates nothing. Other columns are
ignored, or carried through by `clean_documents`. Texts are read whole.
"""

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import Memo, durable, slices, table, without_ids

WINDOW = 5
BAND = 16
COVERAGE = 0.5
LEAST_TOKENS = 8
ITEM_WORDS = 4
WIDTHS = range(ITEM_WORDS, WINDOW + 1)
BROADCAST_WINDOWS = 1_000_000
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds"
    " oz ounce ounces ton tons tonne tonnes ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes"
    " h hr hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur"
    " mph kmh hz khz mhz ghz kb mb gb tb w kw v volt volts watt watts degree degrees".split()
)
_TOKENS = re.compile(r"\w+|[.!?\n]")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
# kinds of tokens, the low three bits of a token's code
_END, _WORD, _CAPITAL, _UNIT, _NUMBER, _NAME = range(6)


def _code(token: str) -> int:
    """Hash of a token, with its kind in the low bits."""
    low = token.lower()
    if token in ".!?\n":
        kind = _END
    elif low[0].isdigit():
        kind = _NUMBER
    elif low in UNITS:
        kind = _UNIT
    else:
        kind = _CAPITAL if token[0].isupper() else _WORD
    return xxhash.xxh64_intdigest(low) >> 3 << 3 | kind


@lru_cache(maxsize=1)
def _codes() -> Memo:
    return Memo(_code)


class Tokens(NamedTuple):
    """Words and numbers of some texts: kind, hash, whether a capitalised word opens a sentence, text and place in it."""

    kind: np.ndarray
    value: np.ndarray
    opening: np.ndarray
    text: np.ndarray
    at: np.ndarray


class Template(NamedTuple):
    """Template words: hash, kind, whether a word that opens a sentence is in it, and its tokens as bounds."""

    words: np.ndarray
    kinds: np.ndarray
    unsure: np.ndarray
    bounds: np.ndarray


class Windows(NamedTuple):
    """Windows of one width: hash, and number of the first template word."""

    form: Template
    width: int
    hashes: np.ndarray
    first: np.ndarray


def tokens(texts: list[str | None]) -> Tokens:
    code_of = _codes().__getitem__
    parts = [np.fromiter(map(code_of, _TOKENS.findall(t)) if t else (), np.uint64) for t in texts]
    codes = np.concatenate([np.empty(0, np.uint64), *parts])
    sizes = np.array([len(x) for x in parts], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    kind, value = (codes & np.uint64(7)).astype(np.int8), codes >> np.uint64(3)
    before = np.concatenate(([np.int8(_END)], kind[:-1]))[: len(kind)]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = _END
    opening = (kind == _CAPITAL) & (before == _END)
    kind[(kind == _UNIT) & (before != _NUMBER)] = _WORD
    real = kind != _END
    kind, value, opening, text = kind[real], value[real], opening[real], text[real]
    starts = np.searchsorted(text, np.arange(len(texts)))
    return Tokens(kind, value, opening, text, np.arange(len(text)) - starts[text])


def template(found: Tokens, names: bool) -> Template:
    """Template words of the texts; words that open sentences are names or plain words."""
    kind = np.where(found.kind == _CAPITAL, np.where(found.opening & (not names), _WORD, _NAME), found.kind)
    new = np.ones(len(kind), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] < _UNIT) | (found.text[1:] != found.text[:-1])
    starts = np.flatnonzero(new)
    kinds = kind[starts]
    words = np.where(kinds >= _UNIT, kinds.astype(np.uint64), found.value[starts])
    unsure = np.add.reduceat(found.opening.astype(np.int64), starts) > 0 if len(starts) else np.empty(0, bool)
    return Template(words, kinds, unsure, np.append(starts, len(kind)))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out ^ words[i : i + n]) * _PRIME
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def windows(found: Tokens, widths: Iterable[int], whole: bool = False) -> list[Windows]:
    """Windows inside the texts, both ways; with `whole` those of full width, or a shorter text as one window."""
    out = []
    for names in (False, True):
        form = template(found, names)
        text = found.text[form.bounds[:-1]]
        length = np.bincount(text) if len(text) else text
        for width in widths:
            hashes = window_hashes(form.words, width)
            n = len(hashes)
            good = text[:n] == text[len(text) - n :]
            if names:  # the others were made the first way
                unsure = np.concatenate(([0], np.cumsum(form.unsure)))
                good &= unsure[width:] > unsure[: max(0, len(unsure) - width)] if n else good
            if whole and n:
                good &= np.minimum(length[text[:n]], WINDOW) == width
            first = np.flatnonzero(good)
            out.append(Windows(form, width, hashes[first], first))
    return out


@lru_cache(maxsize=8)
def _one(text: str) -> Tokens:
    return tokens([text])


@lru_cache(maxsize=256)
def _item_windows(text: str) -> tuple[list[Windows], dict[int, list[tuple[int, int]]]]:
    """Windows of an item, and by hash the numbers of the set and window."""
    made, by_hash = windows(_one(text), WIDTHS, whole=True), {}
    for k, w in enumerate(made):
        for j, h in enumerate(w.hashes.tolist()):
            by_hash.setdefault(h, []).append((k, j))
    return made, by_hash


def consistent(document: str, item: str, low: int) -> tuple[int, bool]:
    """Number of slots the two share at shifts of the band from `low`, and whether they stand for one another one to one."""
    d, t = _one(document), _one(item)
    item_sets, by_hash = _item_windows(item)
    a, b = max(0, low - BAND), low + 2 * BAND + len(t.at)
    d = Tokens(*(x[a:b] for x in d))
    hits: dict[tuple[int, int], list[tuple[int, Template, int]]] = {}
    for w in windows(d, sorted({x.width for x in item_sets if len(x.first)})):
        for j in np.flatnonzero(np.isin(w.hashes, np.fromiter(by_hash, np.int64))):
            for k, i in by_hash[int(w.hashes[j])]:
                if item_sets[k].width == w.width:
                    form = item_sets[k].form
                    shift = int(d.at[w.form.bounds[w.first[j]]] - t.at[form.bounds[item_sets[k].first[i]]])
                    if low <= shift < low + BAND:
                        hits.setdefault((k, i), []).append((shift, w.form, int(w.first[j])))
    if not hits:
        return 0, True
    usual = Counter(h[0] for found in hits.values() for h in found).most_common()
    usual = min(s for s, n in usual if n == usual[0][1])
    there: dict = {}
    back: dict = {}
    seen = set()
    for (k, i), found in hits.items():
        _, form, at = min(found, key=lambda h: (abs(h[0] - usual), h[0], h[2]))
        own, first = item_sets[k].form, int(item_sets[k].first[i])
        for x, y in zip(range(first, first + item_sets[k].width), range(at, at + item_sets[k].width)):
            if own.kinds[x] < _UNIT or own.unsure[x] or form.unsure[y]:
                continue
            one = int(own.kinds[x]), t.value[own.bounds[x] : own.bounds[x + 1]].tobytes()
            other = int(form.kinds[y]), d.value[form.bounds[y] : form.bounds[y + 1]].tobytes()
            seen.add(int(own.bounds[x]))
            if there.setdefault(one, other) != other or back.setdefault(other, one) != one:
                return len(seen), False
    return len(seen), True


def _windows(texts: DataFrame, widths: Iterable[int], whole: bool) -> DataFrame:
    """id and, of each text, its numbers of tokens and plain words, and hash and first token of its windows; with `whole` also the token behind them and their width."""
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = tokens(batch.column("text").to_pylist())
            n = batch.num_rows
            sets = windows(found, widths, whole)
            first = np.concatenate([w.form.bounds[w.first] for w in sets])
            last = np.concatenate([w.form.bounds[w.first + w.width] - 1 for w in sets])
            text = found.text[first]
            order = np.argsort(text, kind="stable")
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n)))), pa.int32())
            lists = [np.concatenate([w.hashes for w in sets]), found.at[first].astype(np.int32), (found.at[last] + 1).astype(np.int32),
                     np.concatenate([np.full(len(w.first), w.width, np.int32) for w in sets])]
            plain = found.text[(found.kind == _WORD) | found.opening]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(np.bincount(x, minlength=n), pa.int32()) for x in (found.text, plain)),
                 *(pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (lists if whole else lists[:2]))],
                ["id", "n_tokens", "n_plain", "hash", "at", "upto", "width"][: 7 if whole else 5],
            )

    more = ", upto array<int>, width array<int>" if whole else ""
    return texts.select("id", "text").mapInArrow(run, f"id {id_type}, n_tokens int, n_plain int, hash array<bigint>, at array<int>{more}")


def _covered(parts: str) -> str:
    """Number of tokens in the union of the spans (at, upto), which are in order."""
    step = "(a, x) -> struct(a.n + greatest(0, x.upto - greatest(x.at, a.upto)) AS n, greatest(a.upto, x.upto) AS upto)"
    return f"aggregate({parts}, struct(0 AS n, 0 AS upto), {step}, a -> a.n)"


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage, n_slots of each contaminated document and the items found in it, one row an alignment."""
    items = durable(
        benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct().withColumn("id", F.monotonically_increasing_id())
    )
    # templates that are shorter than ITEM_WORDS, as their names lie side by side, have no windows
    made = _windows(items, WIDTHS, whole=True).where(F.col("n_plain") >= ITEM_WORDS)
    own = durable(made.select(F.col("id").alias("item"), "n_tokens", F.explode(F.arrays_zip("hash", "at", "upto", "width")).alias("w")).select("item", "n_tokens", "w.*"))
    count = own.count()
    own = F.broadcast(own) if count <= BROADCAST_WINDOWS else own
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    seen = _windows(texts, items_widths(own), whole=False).select("id", F.explode(F.arrays_zip("hash", F.col("at").alias("pos"))).alias("w")).select("id", "w.*")
    shift = F.col("pos") - F.col("at")
    bands = F.array(*(F.floor((shift + by) / BAND) * BAND - by for by in (0, BAND // 2)))  # even and odd halves never meet
    aligned = (
        seen.join(own, "hash")
        .select("id", "item", "n_tokens", F.struct("at", "upto").alias("part"), F.explode(bands).alias("low"))
        .groupBy("id", "item", "low")
        .agg(F.sort_array(F.collect_set("part")).alias("parts"), F.first("n_tokens").alias("n_tokens"))
        .withColumn("covered", F.expr(_covered("parts")))
        .where((F.col("covered") >= COVERAGE * F.col("n_tokens")) & (F.col("covered") >= F.least("n_tokens", F.lit(LEAST_TOKENS))))
        .select("id", "item", "low", (F.col("covered") / F.col("n_tokens")).alias("coverage"))
    )
    aligned = durable(aligned.join(items.withColumnRenamed("id", "item").withColumnRenamed("text", "item_text"), "item"))
    wanted = docs.select("doc_id", "text").join(aligned, F.col("doc_id").eqNullSafe(F.col("id")))
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "item_text", "low")))
            found = [consistent(t or "", i, s) for t, i, s in rows]
            good = pa.array([ok for _, ok in found], pa.bool_())
            kept = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), batch.column("coverage"), pa.array([n for n, _ in found], pa.int32())],
                ["doc_id", "item_id", "coverage", "n_slots"],
            )
            yield kept.filter(good)

    return wanted.select("doc_id", "text", "item_id", "item_text", "low", "coverage").mapInArrow(
        check, f"doc_id {id_type}, item_id {item_type}, coverage double, n_slots int"
    )


def items_widths(own: DataFrame) -> list[int]:
    """Widths that the items' windows have, of those in WIDTHS."""
    return [r["width"] for r in own.select("width").distinct().sort("width").collect()] or [WINDOW]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, items (sorted) and coverage of the contaminated documents."""
    return matches(docs, benchmark).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage"), F.max("n_slots").alias("n_slots")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that hold no benchmark item."""
    return without_ids(docs, matches(docs, benchmark).select("doc_id"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = durable(contaminated(docs, table(spark, sf_dir, "benchmark"))).withColumnRenamed("doc_id", "_id")
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id",
        F.col("coverage").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
        "items",
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )
