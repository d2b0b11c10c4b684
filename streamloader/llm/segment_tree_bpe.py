"""Byte-level BPE with a segment tree over byte positions.

A piece starts as one token per byte.  A leaf holds the rank of the pair that starts there, a node the
leftmost minimum below it, so the root names the next merge.  A merge changes the pairs of the merged
token and of its live left neighbour and kills that of its right half: three point updates, each along one path.
Short pieces are merged together, one tree per row of an array; long ones have a tree of their own.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import columns, small_batches

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Pieces up to this many bytes are merged in arrays, longer ones each by itself.
SHORT = 64
# Encoded pieces that a worker remembers, and the longest one it does.
REMEMBERED = 600_000
NO_PAIR = np.int64(1) << 40


class Vocabulary:
    """Token bytes by id, and the ranks of all pairs of tokens whose concatenation is a token."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = dict(zip(self.ids.values(), self.ids, strict=True))
        self.bytes_to_id = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs = {
            (left, right): rank
            for token, rank in self.ids.items()
            for k in range(1, len(token))
            if (left := self.ids.get(token[:k])) is not None and (right := self.ids.get(token[k:])) is not None
        }
        keys = np.array([left << 32 | right for left, right in self.pairs], dtype=np.int64)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = np.array(list(self.pairs.values()), dtype=np.int64)[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, `NO_PAIR` where the two do not merge."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._ranks[at], NO_PAIR)


@cache
def vocabulary(path: str = RANKS) -> Vocabulary:
    return Vocabulary(path)


@cache
def splitter() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


def merge_short(pieces: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """Token ids of pieces of at least one and at most `SHORT` bytes, all merged at once."""
    longest = max(map(len, pieces))
    width = max(2, 1 << (longest - 1).bit_length())
    count = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(count, width)
    token = vocab.bytes_to_id[flat]
    place = np.arange(width)
    live = place < sizes[:, None]
    after = np.where(place + 1 < sizes[:, None], place + 1, width)
    before = np.broadcast_to(place - 1, (count, width)).copy()
    # A node holds rank * width + position: its minimum is the lowest rank, and of equals the leftmost.
    tree = np.full((count, 2 * width), NO_PAIR)
    ranks = vocab.rank(token[:, :-1], token[:, 1:])
    tree[:, width:-1] = np.where(live[:, 1:] & (ranks < NO_PAIR), ranks * width + place[:-1], NO_PAIR)
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    rows = np.flatnonzero(tree[:, 1] < NO_PAIR)
    while len(rows):
        best = tree[rows, 1]
        at = best % width
        gone = after[rows, at]
        token[rows, at] = best // width
        live[rows, gone] = False
        right = after[rows, gone]
        after[rows, at] = right
        tree[rows, width + gone] = NO_PAIR
        has = right < width
        before[rows[has], right[has]] = at[has]
        left = before[rows, at]
        # New pairs: the merged token with its right neighbour, and its left neighbour with it.
        starts = np.concatenate((at[has], left[left >= 0]))
        ends = np.concatenate((right[has], at[left >= 0]))
        of = np.concatenate((rows[has], rows[left >= 0]))
        rank = vocab.rank(token[of, starts], token[of, ends])
        tree[rows[~has], width + at[~has]] = NO_PAIR
        tree[of, width + starts] = np.where(rank < NO_PAIR, rank * width + starts, NO_PAIR)
        paths = np.concatenate((rows, rows, rows[left >= 0]))
        node = np.concatenate((at, gone, left[left >= 0])) + width
        while node[0] > 1:
            node >>= 1
            tree[paths, node] = np.minimum(tree[paths, 2 * node], tree[paths, 2 * node + 1])
        rows = rows[tree[rows, 1] < NO_PAIR]
    kept = token[live].tolist()
    stops = np.cumsum(live.sum(axis=1)).tolist()
    return [kept[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


def merge_long(piece: bytes, vocab: Vocabulary) -> list[int]:
    """Token ids of one piece of any length; each merge takes time logarithmic in it."""
    size = len(piece)
    width = max(2, 1 << (size - 1).bit_length())
    token = vocab.bytes_to_id[np.frombuffer(piece, dtype=np.uint8)]
    none = int(NO_PAIR)
    leaves = np.full(width, NO_PAIR)
    ranks = vocab.rank(token[:-1], token[1:])
    leaves[: size - 1] = np.where(ranks < NO_PAIR, ranks * width + np.arange(size - 1), NO_PAIR)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = [none, *np.concatenate(levels[::-1]).tolist()]
    token = token.tolist()
    live = bytearray(b"\1" * size)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))

    def put(at: int, value: int) -> None:
        node = at + width
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            low = a if a < b else b
            if tree[node] == low:
                return
            tree[node] = low
            node >>= 1

    def pair(at: int) -> int:
        rank = vocab.pairs.get((token[at], token[after[at]])) if after[at] < size else None
        return none if rank is None else rank * width + at

    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone = after[at]
        token[at] = rank
        live[gone] = 0
        after[at] = after[gone]
        if after[at] < size:
            before[after[at]] = at
        put(gone, none)
        put(at, pair(at))
        if before[at] >= 0:
            put(before[at], pair(before[at]))
    return [t for t, alive in zip(token, live, strict=True) if alive]


def encode_pieces(pieces: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """Token ids of each piece, whole tokens at once, the others by merges."""
    out: list[list[int] | None] = [[vocab.ids[p]] if p in vocab.ids else None for p in pieces]
    by_width: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        if out[k] is None:
            if len(piece) > SHORT:
                out[k] = merge_long(piece, vocab)
            else:
                by_width.setdefault((len(piece) - 1).bit_length(), []).append(k)
    for places in by_width.values():
        for k, ids in zip(places, merge_short([pieces[k] for k in places], vocab), strict=True):
            out[k] = ids
    return out


class Codec:
    """Encodes texts piece by piece and decodes ids, remembering a bounded number of pieces."""

    def __init__(self, path: str = RANKS) -> None:
        self.vocab = vocabulary(path)
        # Of a piece: the number of its ids, their decimal form, and the bytes that they decode to.
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def decode(self, ids: Iterable[int]) -> bytes:
        tokens = self.vocab.tokens
        return b"".join([tokens[i] for i in ids])

    def encoded(self, texts: Iterable[str | None]) -> Iterator[list[tuple[int, str, bytes]]]:
        """The remembered form of each text's pieces."""
        split = splitter().findall
        pieces = [split(t or "") for t in texts]
        distinct = set().union(*pieces)
        new = list(distinct.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(distinct)
        for piece, ids in zip(new, encode_pieces([p.encode() for p in new], self.vocab), strict=True):
            self.known[piece] = len(ids), " ".join(map(str, ids)), self.decode(ids)
        known = self.known
        for own in pieces:
            yield [known[p] for p in own]

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        return [[int(i) for _, decimals, _ in own for i in decimals.split()] for own in self.encoded(texts)]


@cache
def codec(path: str = RANKS) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """(doc_id, ids array<int>); null and empty texts have no ids."""
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies = columns(batch, "doc_id", "body")
            found = pa.array(codec(ranks).encode_batch(bodies), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), found], ["doc_id", "ids"])

    return chosen.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, decoded binary) of rows (doc_id, ids); null ids decode to nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = columns(batch, "doc_id", "ids")
            out = pa.array([codec(ranks).decode(i or ()) for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), out], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode every whole text in one pass.

    Null and empty texts have no tokens and the digests of nothing.  Every row gives a row, repeated or
    not, also with a null id; an empty table gives none; further columns are not read.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        for batch in batches:
            keys, bodies = columns(batch, "doc_id", "body")
            counts, ids_digests, text_digests = [], [], []
            for pieces in own.encoded(bodies):
                sizes, decimals, decoded = zip(*pieces, strict=True) if pieces else ((), (), ())
                counts.append(sum(sizes))
                ids_digests.append(hashlib.sha256(" ".join(decimals).encode()).hexdigest())
                text_digests.append(hashlib.sha256(b"".join(decoded)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return chosen.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
