"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are labels; every other text is unlabelled, toxic or not.  With class prior p and
the sigmoid loss, the risk of a classifier g is

    p * R+(positives)  +  max(0, R-(unlabelled) - p * R-(positives))

where the second term, an estimate of the risk on clean documents, may not go below zero: when it does,
the step goes back up instead (the non-negative correction).  Features are the presence of words and of
words' beginnings; the classifier is linear and trained with numpy.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import column, columns, cut, fold, hash_sample, small_batches

FOLDS = 5
HELD_OUT = 0
# The classifier is fitted on at most this many labelled positives and unlabelled documents, drawn by a hash of the id.
MAX_POSITIVE = 4000
MAX_UNLABELLED = 8000
MAX_FEATURES = 1500
# Documents of the sample that must share a feature, and how many standard errors apart its shares among
# positives and unlabelled documents must be: of some 100,000 features, few pass by chance.
SUPPORT = 5
LEAST_Z = 4.0
PREFIXES = range(3, 9)
EPOCHS = 300
RATE = 0.05
DECAY = 1e-4
# Words whose features a worker remembers.
REMEMBERED = 400_000
SAMPLE_SEED = 11

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features_of(word: str) -> list[str]:
    """The word itself, marked, and its beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if k <= len(word))]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    prior: float

    def __post_init__(self) -> None:
        self.plain: set[str] = set()
        self.telling: dict[str, list[str]] = {}

    def margin(self, text: str | None) -> float:
        words = set(words_of(text))
        present: set[str] = set()
        for word in words.difference(self.plain):
            own = self.telling.get(word)
            if own is None:
                own = [f for f in features_of(word) if f in self.weights]
                if len(self.plain) + len(self.telling) > REMEMBERED:
                    self.plain, self.telling = set(), {}
                if own:
                    self.telling[word] = own
                else:
                    self.plain.add(word)
            present.update(own)
        return self.bias + sum(self.weights[f] for f in sorted(present))


def nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier under the non-negative risk, by Adam on all rows."""
    size = positive.shape[1]
    w = np.zeros(size + 1, dtype=np.float32)
    w[-1] = -1
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, epochs + 1):
        # The loss of margin z is s(-z); its slope is -s(z) s(-z).
        p = 1 / (1 + np.exp(-np.clip(positive @ w[:-1] + w[-1], -30, 30)))
        u = 1 / (1 + np.exp(-np.clip(unlabelled @ w[:-1] + w[-1], -30, 30)))
        slope_p, slope_u = p * (1 - p) / max(1, len(p)), u * (1 - u) / max(1, len(u))
        clean = (u.mean() if len(u) else 0.0) - prior * (p.mean() if len(p) else 0.0)
        if clean >= 0:
            on_p, on_u = -2 * prior * slope_p, slope_u
        else:
            on_p, on_u = prior * slope_p, -slope_u
        grad = np.append(on_p @ positive + on_u @ unlabelled, on_p.sum() + on_u.sum()).astype(np.float32)
        grad[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1].astype(float), float(w[-1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(F.col(doc_id), FOLDS) == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(body, positive) rows to fit on, and the class prior.

    Positives are confirmed toxic documents, the unlabelled ones come from all documents; both from the
    learning folds and by the smallest hashes of their ids.  The prior is the toxic share of the labels.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    ids = docs.where(F.col("doc_id").isNotNull()).where(~held_out()).select("doc_id")
    there = known.where("toxic = 1").join(ids, "doc_id", "left_semi").select("doc_id")
    positive = hash_sample(there, "doc_id", MAX_POSITIVE, SAMPLE_SEED)
    unlabelled = hash_sample(ids, "doc_id", MAX_UNLABELLED, SAMPLE_SEED)
    chosen = cut(
        positive.select("doc_id", F.lit(True).alias("positive")).union(unlabelled.distinct().select("doc_id", F.lit(False)))
    )
    # At most MAX_POSITIVE + MAX_UNLABELLED ids.
    return docs.select("doc_id", F.col("text").alias("body")).join(F.broadcast(chosen), "doc_id").select("body", "positive"), share


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Features that tell positives from unlabelled documents, and their weights."""
    small_batches(docs.sparkSession)
    rows, prior = sample(docs, labels)
    rows = cut(rows)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for body, positive in zip(*columns(batch, "body", "positive"), strict=True):
                seen[positive].update({f for w in set(words_of(body)) for f in features_of(w)})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()), pa.array([seen[0][f] for f in names], pa.int64())],
            ["feature", "p", "u"],
        )

    sizes = {r["positive"]: r["count"] for r in rows.groupBy("positive").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return Model({}, -1.0, prior)
    found = rows.mapInArrow(count, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    gap = F.col("p") / n_p - F.col("u") / n_u
    pooled = (F.col("p") + F.col("u") + 1) / (n_p + n_u)
    z = F.abs(gap) / F.sqrt(pooled * (1 / n_p + 1 / n_u))
    best = found.where((F.col("p") + F.col("u") >= SUPPORT) & (z >= LEAST_Z)).orderBy(z.desc(), "feature").limit(MAX_FEATURES)
    names = [r["feature"] for r in best.select("feature").collect()]
    index = {f: k for k, f in enumerate(names)}

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, positive = columns(batch, "body", "positive")
            hits = [sorted({index[f] for w in set(words_of(b)) for f in features_of(w) if f in index}) for b in bodies]
            yield pa.RecordBatch.from_arrays([pa.array(positive, pa.bool_()), pa.array(hits, pa.list_(pa.int32()))], ["positive", "hits"])

    marked = rows.mapInArrow(mark, "positive boolean, hits array<int>").toPandas()
    matrices = []
    for side in (True, False):
        hits = sorted(map(tuple, marked.loc[marked["positive"] == side, "hits"]))
        matrix = np.zeros((len(hits), len(names)), dtype=np.float32)
        for row, own in zip(matrix, hits, strict=True):
            row[list(own)] = 1
        matrices.append(matrix)
    weights, bias = nnpu(*matrices, prior)
    return Model(dict(zip(names, weights.tolist(), strict=True)), bias, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every whole text; null and empty texts score by the bias alone.

    Repeated rows score alike; an empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.prior))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            margins = np.array([own.margin(t) for t in column(batch, "body")], dtype=float)
            scores = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return chosen.mapInArrow(run, "doc_id long, score double, predicted int")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns (of which `text` is one)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.prior))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([own.margin(t) < 0 for t in column(batch, "text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of the held-out fold are never read."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
