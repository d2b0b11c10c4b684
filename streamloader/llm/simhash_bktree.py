"""SimHash near-duplicates: word-shingle fingerprints, linked through BK-trees of fingerprint shards.

A fingerprint pair within `RADIUS` = 2 of 64 bits differs in at most two of four 16-bit blocks, so it
agrees on two of them.  Each fingerprint is therefore filed under its six pairs of blocks; a shard
is what shares one such 32-bit key, and every link lies whole in some shard.  A shard's members form a
BK-tree (children keyed by the integer distance to the parent); a search walks only the edges within
the radius.  Trees hold at most `TREE_NODES` fingerprints: a larger shard is split into several trees, and its
fingerprints are sent to each of them.  Queries travel to the trees; sending every tree everywhere would
ship all fingerprints to every executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from streamloader.llm.common import columns, cut, small_batches
from streamloader.llm.components import components

WORDS = 3
RADIUS = 2
SEED = 42
BLOCK_PAIRS = tuple(combinations(range(4), 2))
TREE_NODES = 4096
# Hashes whose bits are counted at once; longer documents take several rounds.
CHUNK = 1 << 16


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Hashes of the runs of `words` words, repeated ones too; a shorter text is one run."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, dtype="<u8")
    flat = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(words, len(tokens))
    bounds = zip(starts[: len(tokens) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(flat[s:e], SEED) for s, e in bounds], dtype="<u8")


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    return fingerprint_of(shingle_hashes(text, words))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash; a bit is set when more than half of the shingles' hashes have it."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp long) of every row, whole texts; null and wordless texts have fingerprint zero."""
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies = columns(batch, "doc_id", "body")
            found = pa.array([fingerprint(b, words) for b in bodies], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), found], ["doc_id", "fp"])

    return chosen.mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Fingerprints by Hamming distance; no two nodes are equal."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        new = len(self.values)
        at = 0
        while new:
            apart = (self.values[at] ^ value).bit_count()
            if apart == 0:
                return
            below = self.children[at].get(apart)
            if below is None:
                self.children[at][apart] = new
                break
            at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        found = []
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            apart = (self.values[at] ^ value).bit_count()
            if apart <= radius:
                found.append(self.values[at])
            todo += [child for edge, child in self.children[at].items() if apart - radius <= edge <= apart + radius]
        return found


def _shard_links(members: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the tree's members and the queries.

    Keeping only links that join two parts loses no component, and bounds the rows by the fingerprints.
    """
    mask = (1 << 64) - 1
    tree = BKTree()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    links = []

    def search(value: int) -> None:
        for other in tree.within(value & mask, radius):
            left, right = root(value & mask), root(other)
            if left != right:
                parent[left] = right
                links.append((value, other - (1 << 64) if other >> 63 else other))

    for value in members:
        search(value)
        tree.add(value & mask)
    for value in queries:
        search(value)
    return links


def links(prints: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Distinct fingerprints (fp) to links (a, b) that connect all pairs within `radius` <= 2 bits."""
    if radius > RADIUS:
        raise ValueError("the block pairs cover at most two differing bits")
    block = [F.shiftrightunsigned(F.col("fp"), 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = [
        F.shiftleft(F.lit(k).cast("long"), 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j])
        for k, (i, j) in enumerate(BLOCK_PAIRS)
    ]
    filed = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    # Only shards beyond one tree are listed, so the list stays below rows / tree_nodes.
    large = filed.groupBy("key").count().where(F.col("count") > tree_nodes).select(
        "key", F.ceil(F.col("count") / tree_nodes).cast("int").alias("trees")
    )
    placed = filed.join(large, "key", "left").select(
        "key", "fp", F.coalesce("trees", F.lit(1)).alias("trees")
    ).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    # Trees above a fingerprint's own one: each pair of trees then meets once.
    sent = placed.select("key", "fp", "own", F.explode(F.sequence("own", F.col("trees") - 1)).alias("tree"))
    dealt = sent.repartition("key", "tree").sortWithinPartitions("key", "tree")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        for batch in batches:
            rows = tuple(batch.column(i).to_numpy() for i in range(4))
            if held is not None:
                rows = tuple(np.concatenate(pair) for pair in zip(held, rows, strict=True))
            if not len(rows[0]):
                continue
            # The last shard may go on in the next batch.
            last = (rows[0] != rows[0][-1]) | (rows[3] != rows[3][-1])
            done = int(last.nonzero()[0][-1]) + 1 if last.any() else 0
            held = tuple(r[done:] for r in rows)
            yield from walk(tuple(r[:done] for r in rows))
        if held is not None:
            yield from walk(held)

    def walk(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        key, fp, own, tree = rows
        if len(key) < 2:
            return
        edges = np.flatnonzero((key[1:] != key[:-1]) | (tree[1:] != tree[:-1])) + 1
        starts = np.concatenate(([0], edges))
        ends = np.concatenate((edges, [len(key)]))
        found: list[tuple[int, int]] = []
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            home = own[s:e] == tree[s]
            found += _shard_links(fp[s:e][home].tolist(), fp[s:e][~home].tolist(), radius)
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.select("key", "fp", "own", "tree").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable), kept.

    Null texts and texts without words have fingerprint zero and link like any other.  Repeated rows and
    equal texts share a fingerprint; copies are never expanded into pairs.  Rows with a null id belong to
    their component (null if no other id is in it) and are kept.  An empty table gives no rows; further
    columns are not read.
    """
    prints = cut(fingerprints(docs, id_col, text_col, words))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(classes.select("fp"))).toDF("fp", "root")
    rooted = classes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select(
        "fp", "component_id"
    )
    return prints.join(named, "fp").select(
        "doc_id", "fp", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
