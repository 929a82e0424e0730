"""Token-id files with Re-Pair grammar compression.

Texts are encoded, a closing id is appended to each, and the ids are laid out in ascending doc_id order in
shards of bounded size. In each shard, frequent neighbouring ids are replaced by nonterminals, round by
round: a round takes every pair that is frequent enough, the more frequent one where two overlap, and never
joins ids of two documents. Rules are thus at most 2^ROUNDS ids long. A shard stores the rules, the expansion length of each rule, the symbols and
where each document's symbols start, so any stretch of ids can be decoded without the rest (`read_ids`).

Shards are binary values of a Parquet table, so writing and reading survive lost executors and reach any
store that Spark reaches. Documents with equal doc_id follow one another by text; null ids come first; null
texts count as empty and give the closing id only; an empty table gives no shards. Other columns are ignored.
"""

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.bpe import byte_letters
from tillwise.llm.common import Memo, durable, slices, table

END_ID = 2
SHARD_IDS = 1 << 20
LEAST_COUNT = 24
ROUNDS = 5
_SLOTS = 18
_MAGIC = b"RPR1"
_HEAD = struct.Struct("<4sIIIIQ")
# between two visible characters around one blank no pre-token continues
_CUT = re.compile(r"(?<=\S)(?= \S)")
# marks that, at the end of a piece, are one pre-token of their own after letters
_TAIL = ".,;:!?#$%&*+-/=@^_~()[]{}"


class ByteBpe:
    """Ids of whole texts by the tokenizers library, remembered by stretches that no token crosses."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.letters = byte_letters()
        self.stretches = Memo(self._stretch, 100_000)
        self.spaced = Memo(self._spaced, 1_500_000)
        self.lines = Memo(self._line, 300_000)

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _stretch(self, text: str) -> bytes:
        return self._pack(self.library.encode(text, add_special_tokens=False).ids)

    def _piece(self, blank: str, piece: str, known: Memo) -> bytes:
        """Ids of a piece without white space at its ends, after a blank or nothing."""
        word = piece.rstrip(_TAIL)
        if not word.isalpha():
            return self._stretch(blank + piece)
        if len(word) < len(piece):
            return known[word] + self.stretches[piece[len(word) :]]
        # a blank and letters are one pre-token: only the library's model is needed
        shown = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return self._pack([t.id for t in self.library.model.tokenize(self.letters[32] + shown if blank else shown)])

    def _line(self, piece: str) -> bytes:
        """Ids of a piece at the start of a line."""
        return self._piece("", piece, self.lines)

    def _spaced(self, piece: str) -> bytes | None:
        """Ids of a blank and a piece; None where the piece alone does not decide them."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        first, *others = piece.split("\n")
        # one line end between visible characters is a pre-token of its own
        if others and not first[-1:].isspace() and all(x and not x[0].isspace() and not x[-1].isspace() for x in others):
            end = self.stretches["\n"]
            return self.spaced[first] + b"".join(end + self.lines[x] for x in others)
        return self._piece(" ", piece, self.spaced)

    def encode(self, text: str | None) -> np.ndarray:
        first, *pieces = (text or "").split(" ")
        try:
            packed = b"".join(map(self.spaced.__getitem__, pieces))
            head = b"" if not first else self.stretches[first]
            if first and first[-1].isspace():
                raise TypeError
        except TypeError:  # several blanks in a row
            return np.frombuffer(b"".join(map(self.stretches.__getitem__, _CUT.split(text))), self.dtype)
        return np.frombuffer(head + packed, self.dtype)


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def _chosen(rank: np.ndarray) -> np.ndarray:
    """Positions to replace: the pair with the higher rank than both neighbours; every second one of equal runs."""
    padded = np.concatenate(([0], rank, [0]))
    at = np.flatnonzero((rank > 0) & (rank >= padded[:-2]) & (rank >= padded[2:]))
    if not len(at):
        return at
    run = np.cumsum(np.diff(at, prepend=at[0] - 2) > 1)
    first = at[np.searchsorted(run, run)]
    return at[(at - first) % 2 == 0]


def compress(ids: np.ndarray, starts: np.ndarray, terminals: int, least: int = LEAST_COUNT, rounds: int = ROUNDS):
    """Symbols, symbol start of each document, and the rules (left, right) of the ids of one shard."""
    symbols, starts = ids.astype(np.int64), starts.astype(np.int64)
    rules: list[np.ndarray] = []
    top, slots = terminals, 1 << _SLOTS
    for turn in range(rounds):
        if len(symbols) < 2:
            break
        pair = (symbols[:-1] << 32) | symbols[1:]
        slot = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn) >> np.uint64(64 - _SLOTS)).view(np.int64)
        slot[starts[1:] - 1] = slots  # a pair across two documents
        full = np.bincount(slot, minlength=slots + 1) >= least
        full[slots] = False
        at = np.flatnonzero(full[slot])
        pair, slot = pair[at], slot[at]
        owner = np.zeros(slots, np.int64)
        owner[slot] = pair
        mine = owner[slot] == pair  # another pair in a taken slot waits for a later round
        at, slot = at[mine], slot[mine]
        counts = np.bincount(slot, minlength=slots)
        frequent = np.flatnonzero(counts >= least)
        if not len(frequent):
            break
        frequent = frequent[np.lexsort((owner[frequent], counts[frequent]))]
        place = np.zeros(slots, np.int32)
        place[frequent] = np.arange(1, len(frequent) + 1)
        rank = np.zeros(len(symbols) - 1, np.int32)
        rank[at] = place[slot]
        at = _chosen(rank)
        chosen = rank[at]
        number = np.zeros(len(frequent) + 1, np.int64)
        number[chosen] = 1
        used = np.flatnonzero(number)
        number[used] = np.arange(top, top + len(used))
        rules.append(owner[frequent[used - 1]])
        top += len(used)
        symbols[at] = number[chosen]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        starts = starts - np.searchsorted(at + 1, starts)
        symbols = symbols[keep]
    packed = np.concatenate(rules) if rules else np.empty(0, np.int64)
    return symbols.astype("<u4"), starts.astype("<u4"), np.stack([packed >> 32, packed & 0xFFFFFFFF], 1).astype("<u4")


def _planes(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T).tobytes(), 1)


def _from_planes(data: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), "u1").reshape(4, n).T).view("<u4").reshape(n)


def write_shard(ids: np.ndarray, starts: np.ndarray, terminals: int) -> bytes:
    """One shard's file: head, then rules, expansion lengths, document starts and symbols."""
    symbols, starts, rules = compress(ids, starts, terminals)
    lengths = np.ones(terminals + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[terminals + i] = lengths[a] + lengths[b]
    parts = [_planes(rules.ravel()), _planes(lengths[terminals:]), _planes(starts), _planes(symbols)]
    head = _HEAD.pack(_MAGIC, terminals, len(rules), len(starts), len(symbols), len(ids))
    return head + b"".join(struct.pack("<I", len(p)) + p for p in parts)


class Shard:
    """A shard's file, opened for reading."""

    def __init__(self, data: bytes):
        magic, self.terminals, n_rules, n_docs, n_symbols, self.n_ids = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        at, parts = _HEAD.size, []
        for _ in range(4):
            (n,) = struct.unpack_from("<I", data, at)
            parts.append(data[at + 4 : at + 4 + n])
            at += 4 + n
        self.rules = _from_planes(parts[0], 2 * n_rules).reshape(-1, 2)
        self.lengths = np.concatenate((np.ones(self.terminals, np.int64), _from_planes(parts[1], n_rules)))
        # the ids behind each rule, one rule after another; a rule uses earlier ones only
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.empty(int(self.lengths.sum()), np.uint32)
        self.flat[: self.terminals] = np.arange(self.terminals)
        where, size = self.offsets.tolist(), self.lengths.tolist()
        for i, (a, b) in enumerate(self.rules.tolist(), self.terminals):
            at, middle = where[i], where[i] + size[a]
            self.flat[at:middle] = self.flat[where[a] : where[a] + size[a]]
            self.flat[middle : at + size[i]] = self.flat[where[b] : where[b] + size[b]]
        self.starts = np.append(_from_planes(parts[2], n_docs), np.uint32(n_symbols)).astype(np.int64)
        self.symbols = _from_planes(parts[3], n_symbols)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self.lengths[symbols]
        ends = np.cumsum(size)
        shift = np.repeat(self.offsets[symbols] - ends + size, size)
        shift += np.arange(len(shift))
        return self.flat[shift]

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.starts[i] : self.starts[i + 1]])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each document ends among them."""
        sums = np.concatenate(([0], np.cumsum(self.lengths[self.symbols])))
        return self.expand(self.symbols), sums[self.starts[1:]]

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at positions start to stop of the shard, from the symbols that cover them only."""
        sums = np.concatenate(([0], np.cumsum(self.lengths[self.symbols])))
        first = int(np.searchsorted(sums, start, "right")) - 1
        last = int(np.searchsorted(sums, stop, "left"))
        return self.expand(self.symbols[first:last])[start - sums[first] : stop - sums[first]]


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """The written shards: part (task), seq (in the task), before (ids of the task's earlier shards), n_ids,
    first_id, doc_ids, data."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab = byte_vocabulary(path)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        terminals = 1 << 16 if vocab.dtype == "<u2" else 1 << 20
        held: list[np.ndarray] = []
        names: list = []
        size = 0
        end = np.array([end_id], vocab.dtype)

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            starts = np.cumsum([0, *map(len, held[:-1])])
            row = [part, seq, before, len(ids), names[0], names, write_shard(ids, starts, terminals)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), kind, pa.list_(kind), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, kinds)],
                ["part", "seq", "before", "n_ids", "first_id", "doc_ids", "data"],
            )

        for batch in slices(batches):
            kind = batch.column("doc_id").type
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.concatenate((vocab.encode(text), end))
                if held and size + len(ids) > shard_ids:
                    yield flush()
                    seq, before, size = seq + 1, before + size, 0
                    held.clear()
                    names = []
                held.append(ids)
                names.append(name)
                size += len(ids)
        if held:
            yield flush()

    order = ["doc_id", F.xxhash64("text")]
    schema = f"part int, seq int, before bigint, n_ids bigint, first_id {id_type}, doc_ids array<{id_type}>, data binary"
    return durable(
        docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions("doc_id", "text").mapInArrow(run, schema)
    )


def read_token_files(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the shards.

    What stands before a task's ids is summed over tasks, not documents.
    """
    id_type = shards.schema["first_id"].dataType.simpleString()
    tasks = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # tasks of a range sort are numbered in order of their ids
    base = tasks.select(
        "part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                shard = Shard(row.column("data")[0].as_py())
                ids, ends = shard.documents()
                raw = memoryview(ids.astype("<u4").tobytes())
                starts = np.concatenate(([0], ends[:-1]))
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("doc_ids").flatten(),
                        pa.array(starts + row.column("first")[0].as_py()),
                        pa.array(ends - starts),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = shards.join(base, "part").select("doc_ids", "data", (F.col("base") + F.col("before")).alias("first"))
    return placed.mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
