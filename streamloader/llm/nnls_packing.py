"""Best-fit packing by non-negative least squares over length patterns.

The histogram of piece lengths is all that the plan needs.  Patterns of one, two or three lengths that fill a
sequence exactly are enumerated, their repeat counts are fitted to the histogram by non-negative least
squares and rounded down, again on what is left; the residual lengths are packed best-fit-decreasing, many
equal pieces at a time.  The plan's size depends on the sequence length, not on the number of pieces.
Each piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from streamloader.llm.common import columns, cut, small_batches

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
SEPARATOR = 1
# Three-length patterns enumerated for each longest member; two-length ones are all taken.
TRIPLES = 16
ROUNDS = 4
STEPS = 200
# Words and parts of words that a worker remembers, and the bytes of the longest one it does.
REMEMBERED = 600_000
LONGEST_WORD = 64


@cache
def tokenizer(path: str = TOKENIZER) -> Tokenizer:
    return Tokenizer.from_file(path)


# A word of these characters only is unchanged by normalisation but for its case, and its parts are found here;
# any other word goes through the whole tokenizer.  Fixed: the tokenizer's own split, for these characters.
_PLAIN = re.compile(r"[\x21-\x7e\xa1-\xff]+")
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|\n|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾\n]+")


class WordIds(dict):
    """Ids of texts, word by word: the tokenizer drops white space and merges nothing across it.

    Words are remembered, and the parts of words as words of their own, which they are: one table holds both.  A text is then
    one pass of look-ups.  When the table is full, its older half goes, but for what is asked for again.  Texts that spell one
    of the tokenizer's own marks go to it whole, as marks are cut out before words are.
    """

    def __init__(self, path: str = TOKENIZER) -> None:
        super().__init__()
        self.older: dict = {}
        self.tokenizer = tokenizer(path)
        self.model = self.tokenizer.model
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spelled(chr(c))[0][0] for c in (*range(0x21, 0x7F), *range(0xA1, 0x100))}
        self.marks = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    @property
    def parts(self) -> WordIds:
        """Where the parts of words are remembered."""
        return self

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.find(word)
        if len(word) <= LONGEST_WORD:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def find(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text):
            return self._ids(text)
        parts = _PART.findall(text.lower())
        if parts == [text]:
            return array("I", [t.id for t in self.model.tokenize(text.translate(self.spelling))]).tobytes()
        return b"".join([self[part.encode()] for part in parts])

    def encode(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            text = text or b""
            if b"<|" in text and any(mark in text.lower() for mark in self.marks):
                yield self._ids(text.decode("utf-8", "replace"))
            else:
                yield b"".join(map(self.__getitem__, text.split()))


@cache
def word_ids(path: str = TOKENIZER) -> WordIds:
    return WordIds(path)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenised documents cut to at most `capacity` ids; each piece knows its rank by length in its input split."""
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        seen = [0] * (capacity + 1)
        end = array("I", [SEPARATOR]).tobytes()
        for batch in batches:
            rows = []
            keys, bodies = columns(batch, "doc_id", "body")
            for key, ids in zip(keys, word_ids().encode(bodies), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    size = len(own) // 4
                    rows.append((key, piece, at // 4, size, zlib.crc32(own), part, seen[size]))
                    seen[size] += 1
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PIECES.split(", ")])

    return chosen.mapInArrow(run, PIECES)


def patterns(histogram: np.ndarray, triples: int = TRIPLES) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to the capacity and occur in the histogram."""
    full = len(histogram) - 1
    there = np.flatnonzero(histogram > 0)
    there = there[there > 0]
    has = histogram > 0
    found = [np.array([[full, 0, 0]])] if has[full] else []
    pairs = there[(there * 2 >= full) & (there < full)]
    pairs = pairs[has[full - pairs]]
    found.append(np.stack([pairs, full - pairs, np.zeros_like(pairs)], axis=1))
    for a in there[there * 3 >= full]:
        rest = full - a
        low, high = np.searchsorted(there, [(rest + 1) // 2, min(a, rest - 1) + 1])
        b = there[low:high]
        b = b[has[rest - b]]
        if len(b) > triples:
            b = b[np.linspace(0, len(b) - 1, triples).astype(int)]
        found.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
    return np.concatenate(found)


def repeat_counts(rows: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares fit of the patterns' repeats to the histogram, by multiplicative updates.

    Lengths weigh in the fit by their size, as short pieces left over are packed easily.
    """
    size = len(histogram)
    weight = np.arange(size) / (size - 1)
    weight[0] = 0
    target = histogram * weight**2
    x = np.full(len(rows), histogram.sum() / max(1, len(rows)))
    gain = target[rows].sum(axis=1)
    for _ in range(steps):
        fitted = sum(np.bincount(rows[:, k], weights=x, minlength=size) for k in range(3)) * weight**2
        x *= gain / np.maximum(fitted[rows].sum(axis=1), 1e-12)
    return x


class Plan:
    """Runs of equal pieces: the pieces of `length` with ranks from `rank` on go `each` to a sequence from
    `sequence` on, side by side from `offset`."""

    def __init__(self, histogram: np.ndarray) -> None:
        self.capacity = len(histogram) - 1
        self.left = histogram.astype(np.int64).copy()
        self.used = np.zeros_like(self.left)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self._fit()
        self._best_fit()
        runs = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 5)
        self.table = runs
        self.keys = runs[:, 0] << 44 | runs[:, 1]

    def _put(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), sequence, each, offset))
        self.used[length] += count
        self.left[length] -= count

    def _fit(self) -> None:
        for _ in range(ROUNDS):
            rows = patterns(self.left)
            if not len(rows):
                return
            repeats = repeat_counts(rows, self.left)
            order = np.argsort(-repeats, kind="stable")
            placed = 0
            for (a, b, c), x in zip(rows[order].tolist(), np.floor(repeats[order]).tolist(), strict=True):
                if x < 1:
                    break
                need = {k: (a, b, c).count(k) for k in (a, b, c) if k}
                times = int(min(x, *(self.left[k] // n for k, n in need.items())))
                if times:
                    offset = 0
                    for length, n in need.items():
                        self._put(length, times * n, self.sequences, n, offset)
                        offset += length * n
                    self.sequences += times
                    placed += times
            if not placed:
                return

    def _best_fit(self) -> None:
        """Longest first, each piece into the fullest open sequence that holds it."""
        free: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]
        open_ = np.zeros(self.capacity + 1, dtype=bool)
        for length in range(self.capacity, 0, -1):
            while (count := int(self.left[length])) > 0:
                room = length + int(np.argmax(open_[length:]))
                if open_[room]:
                    first, many = free[room].pop()
                    open_[room] = bool(free[room])
                else:
                    room = self.capacity
                    each = room // length
                    first, many = self.sequences, -(-count // each)
                    self.sequences += many
                each = room // length
                taken = min(many, -(-count // each))
                if taken < many:
                    free[room].append((first + taken, many - taken))
                    open_[room] = True
                offset = self.capacity - room
                self._put(length, min(count, taken * each), first, each, offset)
                whole, rest = divmod(min(count, taken * each), each)
                for start, n, held in ((first, whole, each), (first + whole, int(rest > 0), rest)):
                    gap = room - held * length
                    if n and gap:
                        free[gap].append((start, n))
                        open_[gap] = True

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank."""
        run = self.table[np.searchsorted(self.keys, length << 44 | rank, side="right") - 1]
        step, within = np.divmod(rank - run[:, 1], run[:, 3])
        return run[:, 2] + step, run[:, 4] + within * length


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Null and empty texts are the separator alone.  Only documents beyond `capacity` are cut.  Repeated rows
    are packed as rows of their own; an empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, id_col, text_col, capacity))
    counts = cut_up.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = cut(
        counts.selectExpr("length", "part", "n", "sum(n) over (partition by length order by part rows unbounded preceding) - n as base")
    )
    # At most one row for each possible length.
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in totals:
        histogram[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(Plan(histogram))
    ranked = cut_up.join(counts.select("length", "part", "base"), ["length", "part"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("base") + F.col("rank")).alias("rank")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.value.place(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            arrays = [batch.column(k) for k in range(5)] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
