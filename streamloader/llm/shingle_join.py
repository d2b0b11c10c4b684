"""Near-duplicates by the similarity of their word-shingle sets: SimHash and MinHash bands propose, the sets themselves decide.

Each distinct text has the SimHash fingerprint of its shingles, and operator 7's BK-trees link the fingerprints within two bits.
That finds copies with hardly an edit; two sets at similarity 0.8 differ in some ten bits.  For these each distinct text is filed under `BANDS` keys, each the hash of `ROWS` minima of its shingles.  Two sets with Jaccard
similarity s share a key with probability 1 - (1 - s**ROWS)**BANDS: at s = 0.8 all but 3 in a million pairs do, above
fewer still.  Texts under one key are tied to the key's smallest text, so rows stay linear in a key's texts, and a key
that very many share is reduced before it is shuffled.

What is tied forms candidate groups, and only inside them are texts compared, each pair of sets exactly and texts that
are connected already not again.  A large group is cut into blocks.  Texts meet in their block first; then a few texts of
every part that came out meet; where a group is still in parts, the texts outside its largest part visit every block.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from streamloader.llm.common import columns, cut, discard, forget_shuffles, release, scratch_path, small_batches
from streamloader.llm.components import components
from streamloader.llm.simhash_bktree import fingerprint_of, links, shingle_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
SEED = 11
# Shingles whose minima are taken at once.
CHUNK = 4096
# Texts and bytes of one block of a large group, and texts of a part that meet those of other parts first.
BLOCK_TEXTS = 512
BLOCK_BYTES = 8 << 20
REPRESENTATIVES = 8
# Shingles under which a text is first compared with the last one seen.
LOOKED_AT = 4
# Classes that a task remembers, to file repeated texts once.
SEEN = 500_000

_random = np.random.default_rng(SEED)
_FLIPS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(text, words).view(np.int64))


def band_keys(found: np.ndarray) -> list[int]:
    """The keys of a set; texts without words share theirs."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), CHUNK):
        mixed = (found[at : at + CHUNK].view(np.uint64)[:, None] ^ _FLIPS) * _FACTORS
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0))
    own = least.tobytes()
    hashes = [xxh64_intdigest(own[8 * ROWS * b : 8 * ROWS * (b + 1)], b) for b in range(BANDS)]
    return [h - (1 << 64) if h >> 63 else h for h in hashes]


def prefix(found: np.ndarray, similarity: float) -> np.ndarray:
    """The smallest shingles, of which a similar set shares one; texts without words share the shingle zero."""
    if not len(found):
        return np.zeros(1, dtype=np.int64)
    return found[: len(found) - math.ceil(similarity * len(found) - 1e-9) + 1]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= similarity * (len(a) + len(b) - shared) - 1e-9


def group_links(sets: list[np.ndarray], parts: list[int], own: list[int], similarity: float) -> list[tuple[int, int]]:
    """The parts that similar sets connect with a part of a smaller label: (label, smallest label reached).

    Pairs of one block (`own`) were compared before, unless all are of one block.
    """
    sizes, block, part = np.array([len(s) for s in sets]), np.array(own), np.array(parts)
    across = len(set(own)) > 1
    filed: dict[int, list[int]] = {}

    def tie(x: int, y: int) -> bool:
        if part[x] == part[y] or across and block[x] == block[y] or sizes[y] < similarity * sizes[x] - 1e-9:
            return False
        if not similar(sets[x], sets[y], similarity):
            return False
        part[part == max(part[x], part[y])] = min(part[x], part[y])
        return True

    order = np.argsort(sizes, kind="stable")
    for place, x in enumerate(order.tolist()):
        keys = prefix(sets[x], similarity).tolist()
        # Most copies are like the text last seen under a key; what is then in one part needs no more comparing.
        for k in keys[:LOOKED_AT]:
            if filed.get(k) and tie(x, filed[k][-1]):
                break
        if (part[order[:place]] != part[x]).any():
            for y in sorted(set().union(*[filed[k] for k in keys if k in filed]), reverse=True):
                tie(x, y)
        for k in keys:
            filed.setdefault(k, []).append(x)
    return sorted({(a, b) for a, b in zip(parts, part.tolist(), strict=True) if a != b})


def fingerprint_ties(prints: DataFrame) -> DataFrame:
    """Texts (h, fp) to (a, b): texts of one fingerprint to the smallest of them, those of linked fingerprints to each other."""
    classes = cut(prints.groupBy("fp").agg(F.min("h").alias("first")))
    equal = prints.join(classes, "fp").where("h <> first").select(F.col("h").alias("a"), F.col("first").alias("b"))
    one, two = classes.toDF("a", "h1"), classes.toDF("b", "h2")
    near = links(classes.select("fp")).join(one, "a").join(two, "b").select(F.col("h1").alias("a"), F.col("h2").alias("b"))
    tied = cut(equal.union(near))
    release(classes)
    return tied


def candidates(rows: DataFrame, words: int) -> DataFrame:
    """(a, b): texts (by h) of near fingerprints, and each text that shares a band with others with the smallest of those."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, texts, prints = [], [], []
            for h, body in zip(*columns(batch, "h", "body"), strict=True):
                if h not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(h)
                    hashes = shingle_hashes(body, words)
                    # A text's first row carries its fingerprint.
                    keys += band_keys(np.unique(hashes.view(np.int64)))
                    texts += [h] * BANDS
                    prints += [fingerprint_of(hashes)] + [None] * (BANDS - 1)
            arrays = [pa.array(values, pa.int64()) for values in (keys, texts, prints)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "h", "fp"])

    spark = rows.sparkSession
    path = scratch_path(spark, "bands")
    rows.select("h", "body").mapInArrow(run, "key long, h long, fp long").write.parquet(path)
    filed = spark.read.schema("key long, h long, fp long").parquet(path)
    near = fingerprint_ties(filed.where("fp is not null").select("h", "fp"))
    least = filed.groupBy("key").agg(F.min("h").alias("b"), F.max("h").alias("most")).where("b <> most").select("key", "b")
    banded = filed.join(least, "key").where("h <> b").select(F.col("h").alias("a"), "b")
    tied = cut(banded.union(near).distinct())
    release(near)
    discard(spark, path)
    forget_shuffles(spark)
    return tied


def _compared(dealt: DataFrame, words: int, similarity: float) -> DataFrame:
    """Texts (root, i, j, own, part, h, body), dealt by (root, i, j), to (of, to): parts that similar texts among those that meet
    connect, each with the smallest label it is connected with there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        held: list[tuple[int, int, np.ndarray]] = []

        def closed() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                own, parts, sets = zip(*held, strict=True)
                found = group_links(list(sets), list(parts), list(own), similarity)
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], pa.int64()) for n in (0, 1)], ["of", "to"])
            held.clear()

        for batch in batches:
            for root, i, j, own, part, body in zip(*columns(batch, "root", "i", "j", "own", "part", "body"), strict=True):
                if (root, i, j) != current:
                    yield from closed()
                    current = (root, i, j)
                held.append((own, part, shingle_set(body, words)))
        yield from closed()

    sent = dealt.select("root", "i", "j", "own", "part", "body")
    return sent.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(run, "of long, to long")


def roots_of(rows: DataFrame, classes: DataFrame, words: int, similarity: float, block_texts: int) -> DataFrame:
    """Rows (doc_id, h, body) and classes (h, first_id, bytes) to (of, to) of the texts that are similar to a smaller one (by h)."""
    tied = candidates(rows, words)
    grouped = cut(components(tied).toDF("h", "root").join(classes, "h"))
    release(tied)
    enough = F.greatest(F.ceil(F.count("*") / block_texts), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int")
    blocks = grouped.groupBy("root").agg(enough.alias("blocks"))
    named = grouped.join(blocks, "root").select(F.col("h").alias("of"), "root", "blocks", F.col("first_id").alias("first"))
    # The text of a class is that of its smallest id, so copies do not travel.
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("h"), "blocks")).otherwise(0).cast("int")
    one = rows.join(named, (rows["h"] == named["of"]) & rows["doc_id"].eqNullSafe(named["first"])).withColumn("own", own)
    path = scratch_path(rows.sparkSession, "candidates")
    one.select("root", "blocks", "own", "h", "body").dropDuplicates(["h"]).write.parquet(path)
    release(grouped)
    held = rows.sparkSession.read.parquet(path)
    # A text is in one block, so what its block says of it is all there is, and no rounds of `components` are needed.
    roots = cut(_compared(held.withColumns({"i": F.col("own"), "j": F.col("own"), "part": F.col("h")}), words, similarity))
    large = held.where("blocks > 1")
    if not large.isEmpty():
        # A few texts of each part meet those of other parts, many blocks' at a time; all those of a part meet in one place.
        place = F.row_number().over(Window.partitionBy("root", "own", "part").orderBy("h"))
        few = _parts(large, roots).withColumn("place", place).where(F.col("place") <= REPRESENTATIVES)
        bucket = F.pmod(F.xxhash64("part"), F.ceil(F.col("blocks") / 16)).cast("int")
        roots = _tied(roots, cut(_compared(few.withColumns({"i": bucket, "j": F.lit(0), "own": F.lit(0)}), words, similarity)))
        # Here a part is in several places.
        met = _compared(_still_apart(_parts(large, roots), block_texts), words, similarity)
        roots = _tied(roots, components(met.toDF("a", "b")))
    discard(rows.sparkSession, path)
    return roots


def _tied(roots: DataFrame, more: DataFrame) -> DataFrame:
    """Texts whose part is tied to a smaller label follow it, and so does the text that the part is named after."""
    labels = more.toDF("label", "least").where("label <> least")
    followed = roots.join(labels, F.col("to") == F.col("label"), "left").select("of", F.coalesce("least", "to").alias("to"))
    moved = cut(followed.union(labels))
    release(roots, more)
    return moved


def _still_apart(parted: DataFrame, block_texts: int) -> DataFrame:
    """Texts of groups in parts, dealt so that each pair of different parts and blocks meets.

    Texts outside their group's largest part visit every block, a chunk of them at a time; all others stay in their block.
    """
    sizes = parted.groupBy("root", "part").agg(F.count("*").alias("n"))
    chunks = F.ceil((F.sum("n") - F.max("n")) / block_texts).cast("int").alias("chunks")
    groups = sizes.groupBy("root").agg(F.max_by("part", F.struct("n", "part")).alias("main"), chunks).where("chunks > 0")
    apart = parted.join(groups, "root")
    home = apart.withColumn("j", F.explode(F.expr("sequence(0, chunks - 1)"))).withColumn("i", F.col("own"))
    chunk = F.pmod(F.xxhash64("h"), "chunks").cast("int")
    away = apart.where("part <> main").withColumn("j", chunk).withColumn("i", F.explode(F.expr("sequence(0, blocks - 1)")))
    # Visitors count as one block: two of them meet where one is at home.
    away = away.where("i <> own").withColumn("own", F.lit(-1))
    names = ["root", "i", "j", "own", "part", "h", "body"]
    return home.select(*names).union(away.select(*names))


def _parts(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """The texts with the part of their group that the links found so far connect."""
    return texts.join(roots, F.col("h") == F.col("of"), "left").withColumn("part", F.coalesce("to", "h")).drop("of", "to")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b"")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY,
    block_texts: int = BLOCK_TEXTS,
) -> DataFrame:
    """One row per document: doc_id, h (hash of its text), component_id (smallest doc_id reachable), kept.

    Documents link whose sets of `words`-word shingles (lower-cased, split at white space; shorter texts are one
    shingle) have Jaccard similarity >= `similarity`; texts without words, null ones too, link with each other.  Of the texts that
    share a component's smallest id, one is kept.  Rows with a null id belong to their component (null if no other id is in it)
    and are kept.  Repeated rows are one text.  An empty table gives no rows; further columns are not read.
    """
    if not 0 < similarity <= 1:
        raise ValueError("the similarity is above zero and at most one")
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("h"), body.alias("body"))
    classes = cut(rows.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.max(F.octet_length("body")).cast("long").alias("bytes")))
    roots = roots_of(rows, classes, words, similarity, block_texts)
    rooted = cut(classes.join(roots, F.col("h") == F.col("of"), "left").select("h", "first_id", F.coalesce("to", "h").alias("root")))
    release(classes, roots)
    first = F.min(F.when(F.col("first_id").isNotNull(), F.struct("first_id", "h"))).alias("first")
    named = rooted.join(rooted.groupBy("root").agg(first), "root").select(F.col("h").alias("of"), "first")
    return rows.select("doc_id", "h").join(named, F.col("h") == F.col("of")).select(
        "doc_id", "h", F.col("first.first_id").alias("component_id"),
        F.when(F.col("doc_id").isNull(), True)
        .otherwise((F.col("doc_id") == F.col("first.first_id")) & (F.col("h") == F.col("first.h")))
        .alias("kept"),
    )
