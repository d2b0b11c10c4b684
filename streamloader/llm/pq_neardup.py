"""Embedding near-duplicates by product quantisation.

Equal vectors of a label form one class, searched once.  A class lies in the inverted list of its nearest coarse
centroid; what remains of it is coded as one byte for each subspace.  A query's inner product with a
coded vector is a sum of table look-ups, exact up to the vector's coding error, which is stored: a
candidate whose product plus error reaches the threshold is compared exactly, and no other can reach it.

A query visits the lists that may hold a partner: unit vectors with cosine >= t are at most d = sqrt(2 - 2t)
apart, so a list is skipped if the query is more than d beyond the list's radius, or more than d behind the plane
halfway between its own centroid and the list's.  No pair is missed.  Each pair of lists is visited from the lower one.
Centroids and codes are fitted on a bounded sample; every vector is indexed and all searches are whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import cut, hash_sample
from streamloader.llm.components import components

THRESHOLD = 0.93
SUBSPACES = 8
CODES = 256
# Inverted lists: about the root of the largest label's classes, and at most this many.
MAX_LISTS = 4096
# Classes that centroids and codes are fitted on, for each list; at most SAMPLE_PER_LIST * MAX_LISTS in all.
SAMPLE_PER_LIST = 32
LEAST_SAMPLE = 4096
KMEANS_ROUNDS = 12
SEED = 3
# Rows of the table of long lists that may be broadcast; a longer table is joined by a shuffle.
BROADCAST_ROWS = 100_000
# Classes of a list that meet their queries in one task; longer lists are cut into several blocks.
BLOCK = 2048
QUERY_CHUNK = 256


def kmeans(points: np.ndarray, k: int, seed: int = SEED) -> np.ndarray:
    """At most k centroids; empty ones keep their place."""
    rng = np.random.default_rng(seed)
    k = min(k, len(points))
    centres = points[rng.choice(len(points), k, replace=False)].astype(np.float64)
    for _ in range(KMEANS_ROUNDS):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=k)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int64)
    for at in range(0, len(points), 4096):
        out[at : at + 4096] = squared_distances(points[at : at + 4096], centres).argmin(axis=1)
    return out


class Quantiser:
    """Coarse centroids and, for each subspace, the code words of residuals."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> None:
        self.centres = kmeans(sample, lists)
        residual = sample - self.centres[nearest(sample, self.centres)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.words = [kmeans(residual[:, p], codes, SEED + 1 + k) for k, p in enumerate(self.parts)]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, code and coding error of unit vectors."""
        home = nearest(unit, self.centres)
        residual = unit - self.centres[home]
        codes = np.empty((len(unit), len(self.parts)), dtype=np.uint8)
        for k, p in enumerate(self.parts):
            codes[:, k] = nearest(residual[:, p], self.words[k])
            residual[:, p] -= self.words[k][codes[:, k]]
        return home, codes, np.sqrt((residual**2).sum(axis=1))

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """Inner products of each query with each code word."""
        return [queries[:, p] @ self.words[k].T for k, p in enumerate(self.parts)]

    def probes(self, unit: np.ndarray, home: np.ndarray, radius: np.ndarray, apart_most: float) -> np.ndarray:
        """Which lists each query must visit, of those after its own one."""
        away = squared_distances(unit, self.centres)
        apart = np.sqrt(np.maximum(squared_distances(self.centres, self.centres), 0))
        own = away[np.arange(len(unit)), home]
        # 1e-6 is beyond any rounding of the distances.
        beside = away - own[:, None] <= 2 * apart_most * apart[home] + 1e-6
        within = np.sqrt(np.maximum(away, 0)) <= apart_most + radius + 1e-6
        return beside & within & (np.arange(len(self.centres)) > home[:, None])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component first: squares of very large or small ones would leave the range.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, k1, k2) with null keys where a vector links with nothing, and classes (id, label, m, vec).

    A class is what shares label and vector, named by its smallest id; `label` is the label's text and the vector's length,
    as vectors of different lengths link no more than those of different labels.  A vector is fit for comparison
    if it has an id, a label, a direction and only finite components.  Double components stay so.
    """
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() == "double"
    vec = F.col("embedding").cast("array<double>" if wide else "array<float>")
    plain = vectors.select("vec_id", F.concat_ws("/", F.col("label").cast("string"), F.size(vec).cast("string")).alias("label"), F.col("label").isNotNull().alias("labelled"), vec.alias("vec"))
    fit = (
        F.col("vec_id").isNotNull()
        & F.col("labelled")
        & F.col("vec").isNotNull()
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    keyed = plain.withColumn("fit", F.coalesce(fit, F.lit(False)))
    keyed = keyed.select(
        "vec_id", "label", "vec", "fit",
        F.when(F.col("fit"), F.xxhash64("label", "vec")).alias("k1"),
        F.when(F.col("fit"), F.xxhash64(F.lit(SEED), "vec", "label")).alias("k2"),
    )
    grouped = keyed.where("fit").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("id"), F.first("label").alias("label"), F.count("*").alias("m"), F.first("vec").alias("vec")
    )
    return keyed.select("vec_id", "k1", "k2"), grouped


class _Run:
    """One block of one list: its classes, what their queries found so far, and a forest of the links."""

    def __init__(self, quantiser: Quantiser, threshold: float, cell: int, ids, weights, vectors, codes, errors) -> None:
        self.quantiser, self.threshold = quantiser, threshold
        self.ids, self.weights, self.unit = ids, weights, _unit(vectors)
        self.codes, self.errors, self.centre = codes, errors, quantiser.centres[cell]
        self.found = np.zeros(len(ids), dtype=np.int64)
        self.part = np.arange(len(ids))
        self.links: list[tuple[int, int]] = []

    def linked(self, queries: np.ndarray) -> np.ndarray:
        """Which classes each query links with: look-up distances first, exact ones for what may pass."""
        near = (queries @ self.centre)[:, None] + self.errors
        for k, table in enumerate(self.quantiser.tables(queries)):
            near += table[:, self.codes[:, k]]
        row, col = np.nonzero(near >= self.threshold - 1e-6)
        out = np.zeros(near.shape, dtype=bool)
        for at in range(0, len(row), 1 << 17):
            r, c = row[at : at + (1 << 17)], col[at : at + (1 << 17)]
            out[r, c] = np.einsum("ij,ij->i", queries[r], self.unit[c]) >= self.threshold
        return out

    def _join(self, of: int, hits: np.ndarray) -> None:
        """Tie a query to one class of each part that it meets, which become one part."""
        parts, first = np.unique(self.part[hits], return_index=True)
        self.links += [(of, int(self.ids[hits[k]])) for k in first if self.ids[hits[k]] != of]
        if len(parts) > 1:
            self.part[np.isin(self.part, parts)] = parts[0]

    def inside(self) -> None:
        """The block's own classes against each other."""
        for at in range(0, len(self.ids), QUERY_CHUNK):
            hits = self.linked(self.unit[at : at + QUERY_CHUNK])
            hits[np.arange(len(hits)), np.arange(at, at + len(hits))] = False
            self.found[at : at + len(hits)] += hits @ self.weights
            for k in np.flatnonzero(hits.any(axis=1)).tolist():
                self._join(int(self.ids[at + k]), np.append(np.flatnonzero(hits[k]), at + k))

    def outside(self, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Queries from elsewhere: returns what each found."""
        out = np.zeros(len(ids), dtype=np.int64)
        unit = _unit(vectors)
        for at in range(0, len(ids), QUERY_CHUNK):
            hits = self.linked(unit[at : at + QUERY_CHUNK])
            out[at : at + len(hits)] = hits @ self.weights
            self.found += weights[at : at + len(hits)] @ hits
            for k in np.flatnonzero(hits.any(axis=1)).tolist():
                self._join(int(ids[at + k]), np.flatnonzero(hits[k]))
        return out


def _place(grouped: DataFrame, quantiser: Quantiser, radius: np.ndarray | None, threshold: float) -> DataFrame:
    """Classes with list, code and coding error, and with the lists to visit once the radii are known."""
    shared = grouped.sparkSession.sparkContext.broadcast((quantiser, radius))
    apart_most = math.sqrt(2 - 2 * threshold)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, radii = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unit(_matrix(batch.column(2)))
            for at in range(0, len(vectors), 1024):
                unit = vectors[at : at + 1024]
                home, codes, errors = own.encode(unit)
                away = np.sqrt(np.maximum(((unit - own.centres[home]) ** 2).sum(axis=1), 0))
                if radii is None:
                    visits = [[]] * len(unit)
                else:
                    visits = [np.flatnonzero(v).tolist() for v in own.probes(unit, home, radii, apart_most)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(at, len(unit)) for k in (0, 1, 2, 3)),
                        pa.array(home, pa.int32()),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(errors),
                        pa.array(away),
                        pa.array(visits, pa.list_(pa.int32())),
                    ],
                    ["id", "m", "vec", "label", "cell", "code", "err", "away", "probes"],
                )

    label = grouped.schema["label"].dataType.simpleString()
    vec = grouped.schema["vec"].dataType.simpleString()
    schema = f"id long, m long, vec {vec}, label {label}, cell int, code binary, err double, away double, probes array<int>"
    return grouped.select("id", "m", "vec", "label").mapInArrow(run, schema)


def _search(placed: DataFrame, quantiser: Quantiser, threshold: float, block: int) -> DataFrame:
    """(id, n, other): what each class found, as weights; and the links of a forest, as pairs with n null."""
    shared = placed.sparkSession.sparkContext.broadcast(quantiser)
    # Only lists beyond one block are named, so at most rows / block of them.
    large = cut(
        placed.groupBy("label", "cell").count().where(F.col("count") > block).select(
            "label", "cell", F.ceil(F.col("count") / block).cast("int").alias("blocks")
        )
    )
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    blocked = placed.join(large, ["label", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    members = blocked.select("label", "cell", "block", F.lit(0).alias("role"), "id", "m", "vec", "code", "err")
    queries = blocked.select("label", "id", "m", "vec", F.explode("probes").alias("cell")).join(large, ["label", "cell"], "left")
    queries = queries.select("label", "cell", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"), "id", "m", "vec")
    inner = blocked.where("block + 1 < blocks").select(
        "label", "cell", F.explode(F.expr("sequence(block + 1, blocks - 1)")).alias("block"), "id", "m", "vec"
    )
    sent = queries.unionByName(inner).withColumn("role", F.lit(1)).withColumn("code", F.lit(None).cast("binary")).withColumn("err", F.lit(0.0))
    dealt = members.unionByName(sent).withColumn("key", F.xxhash64("label", "cell", "block")).repartition("key").sortWithinPartitions("key", "label", "cell", "block", "role")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        parts: list[tuple] = []

        def out(ids, counts, links) -> pa.RecordBatch:
            a, b = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*ids, *a], pa.int64()),
                    pa.array([*counts, *[None] * len(a)], pa.int64()),
                    pa.array([*[None] * len(ids), *b], pa.int64()),
                ],
                ["id", "n", "other"],
            )

        def opened() -> _Run:
            ids, weights, vectors, codes, errors = (np.concatenate(x) for x in zip(*parts, strict=True))
            made = _Run(shared.value, threshold, current[1], ids, weights, vectors, codes, errors)
            parts.clear()
            made.inside()
            return made

        def closed() -> Iterator[pa.RecordBatch]:
            if held or parts:
                done = held or opened()
                yield out(done.ids.tolist(), done.found.tolist(), done.links)

        for batch in batches:
            if not batch.num_rows:
                continue
            label, cell, block_of, role = (batch.column(k).to_pylist() for k in range(4))
            ids, weights = (batch.column(k).to_numpy() for k in (4, 5))
            vectors, errors = _matrix(batch.column(6)), batch.column(8).to_numpy()
            codes = batch.column(7).to_pylist()
            marks = list(zip(label, cell, block_of, role, strict=True))
            edges = [0, *[k for k in range(1, len(marks)) if marks[k] != marks[k - 1]], len(marks)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if marks[s][:3] != current:
                    yield from closed()
                    current, held = marks[s][:3], None
                if marks[s][3] == 0:
                    code = np.frombuffer(b"".join(codes[s:e]), dtype=np.uint8).reshape(e - s, -1)
                    parts.append((ids[s:e], weights[s:e], vectors[s:e], code, errors[s:e]))
                elif held or parts:
                    # A block that has queries but no members finds nothing.
                    held = held or opened()
                    yield out(ids[s:e].tolist(), held.outside(ids[s:e], weights[s:e], vectors[s:e]).tolist(), [])
        yield from closed()

    chosen = dealt.select("label", "cell", "block", "role", "id", "m", "vec", "code", "err")
    return chosen.mapInArrow(run, "id long, n long, other long")


def _found(grouped: DataFrame, threshold: float, max_lists: int, block: int) -> DataFrame:
    """(id, n, other) of classes with vectors of one length: what `_search` finds under a quantiser of their own."""
    most = grouped.groupBy("label").count().agg(F.max("count")).first()[0]
    lists = max(1, min(max_lists, math.isqrt(most)))
    drawn = hash_sample(grouped.select("id", "vec"), "id", max(LEAST_SAMPLE, SAMPLE_PER_LIST * lists), SEED)
    sample = np.array([r["vec"] for r in drawn.select("vec").collect()], dtype=np.float64)
    quantiser = Quantiser(_unit(sample), lists)
    radius = np.zeros(len(quantiser.centres))
    for row in _place(grouped, quantiser, None, threshold).groupBy("cell").agg(F.max("away").alias("away")).collect():
        radius[row["cell"]] = row["away"]
    placed = cut(_place(grouped, quantiser, radius, threshold))
    return cut(_search(placed, quantiser, threshold, block))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, max_lists: int = MAX_LISTS, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link within a label and a length.  Vectors unfit for comparison (see `classes_of`) and those with a null label
    link with nothing and are components of their own; a null id is kept, its component is null.  Repeated
    rows are vectors of their own that link with each other.  An empty table gives no rows; further columns are not read.
    """
    keyed, grouped = classes_of(vectors)
    grouped = cut(grouped)
    # Lengths in powers of two, of which there are few; within one vectors are filled up with zeros, which change no cosine.
    power = F.ceil(F.log2(F.size("vec"))).cast("int")
    sizes = grouped.groupBy(power.alias("power")).agg(F.max(F.size("vec")).alias("size")).orderBy("power").collect()
    found = None
    for row in sizes:
        filled = F.concat("vec", F.array_repeat(F.lit(0).cast(grouped.schema["vec"].dataType.elementType), row["size"] - F.size("vec")))
        own = _found(grouped.where(power == row["power"]).withColumn("vec", filled), threshold, max_lists, block)
        found = own if found is None else found.unionByName(own)
    if found is None:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found.where("n is not null").groupBy("id").agg(F.sum("n").alias("found"))
    roots = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    per_class = (
        grouped.select("k1", "k2", "id", "m")
        .join(counts, "id")
        .join(roots, "id", "left")
        .select("k1", "k2", (F.col("m") - 1 + F.col("found")).alias("links"), F.coalesce("root", "id").alias("component"))
    )
    return keyed.join(per_class, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
    )
