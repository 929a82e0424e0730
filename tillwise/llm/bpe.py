"""BPE encoding and decoding with a given vocabulary file.

A word's symbols form a doubly linked list. A priority queue holds the ranks of the possible merges;
an entry whose symbols have changed since is stale and is skipped. Decoding concatenates vocabulary strings.

Rows: one per document, in no order; repeated rows and ids are encoded each on its own. A null text
counts as empty and gives no ids. Other columns of the input are ignored. Texts of any length are
encoded whole: the work runs piece by piece between blanks, which no token crosses.
"""

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import Memo, slices, table


# an id and the place of a symbol in its word, packed beside an id or a rank into one integer
ID_BITS, PLACE_BITS = 32, 40
PLACES = (1 << PLACE_BITS) - 1


class Recent(Memo):
    """A bounded cache in two generations: when the younger is full it becomes the older one, so entries in use stay."""

    def __init__(self, compute, most: int = 250_000):
        super().__init__(compute, most)
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    return [chr(x) for _, x in sorted([*((b, b) for b in shown), *((b, 256 + i) for i, b in enumerate(hidden))])]


class WordBpe:
    """A lower-casing BPE vocabulary with word ends, read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"] is not None:
            raise ValueError(f"{path}: a BPE vocabulary with word ends and no decoder is expected")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        # by pair of ids, the rank of its merge; by rank, the id that it makes
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.vocab[left] << ID_BITS | self.vocab[right]] = rank
            self.made.append(self.vocab[left + right])
        letters = byte_letters()
        # None where the vocabulary lacks the letter of a byte
        self.inner = [self.vocab.get(x) for x in letters]
        self.final = [self.vocab.get(x + self.suffix) for x in letters]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.word_ids = Recent(self.encode_word)
        self.piece_ids = Recent(lambda piece: array("i", self.encode_piece(piece)).tobytes())

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token: merge by rank, leftmost first among equals.

        A queue entry is the rank and the place of a pair; it is stale once another pair, or none, begins there.
        """
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        n = len(ids)
        rank_of, made = self.ranks.get, self.made
        # rank of the pair that begins at each place now
        rank = [rank_of(a << ID_BITS | b) for a, b in zip(ids, ids[1:])]
        queue = [r << PLACE_BITS | i for i, r in enumerate(rank) if r is not None]
        if not queue:
            return ids
        heapq.heapify(queue)
        rank.append(None)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = heapq.heappop(queue)
            left = entry & PLACES
            if rank[left] != entry >> PLACE_BITS:
                continue  # stale
            right = after[left]
            merged = ids[left] = made[entry >> PLACE_BITS]
            rank[right], ids[right] = None, None
            further = after[left] = after[right]
            if further < n:
                before[further] = left
                r = rank[left] = rank_of(merged << ID_BITS | ids[further])
                if r is not None:
                    heapq.heappush(queue, r << PLACE_BITS | left)
            else:
                rank[left] = None
            nearer = before[left]
            if nearer >= 0:
                r = rank[nearer] = rank_of(ids[nearer] << ID_BITS | merged)
                if r is not None:
                    heapq.heappush(queue, r << PLACE_BITS | nearer)
        return [i for i in ids if i is not None]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of a stretch of text that starts and ends at blanks or the text's ends."""
        out: list[int] = []
        for part in self.marks.split(piece) if self.marks and "<" in piece else (piece,):
            if part in self.special:
                out.append(self.special[part])
                continue
            # letter by letter, so a final sigma stays a plain one
            plain = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.words.findall(plain):
                out += self.word_ids[word]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        # a line feed parts words as a blank does
        pieces = (text or "").replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.piece_ids.__getitem__, pieces)), "<i4")

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings joined by blanks, as is usual where a file names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """Loaded once per Python worker; the file must be on every worker."""
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (text made from these ids) of each row of docs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in slices(batches):
            ids = [vocab.encode(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype="<i4")
            flat = np.concatenate(ids) if ids else np.empty(0, "<i4")
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            decoded = pa.array([vocab.decode(x.tolist()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), listed, decoded], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(table(spark, sf_dir, "documents"), word_vocabulary()))
