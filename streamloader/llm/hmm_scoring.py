"""Hidden Markov language model: Baum-Welch across partitions, exact likelihoods by the scaled forward recursion.

Tokens are lower-cased words and one end per text.  The `TOP` most frequent words are emitted by the hidden
states themselves; all others are emitted as a class (of their last two bytes) and then drawn from
the class by their smoothed corpus frequency:

    P(word | state) = P(class | state) * (c(word) + 0.5) / (C(class) + 0.5 * (V(class) + 1))

so every text has a probability, and the states' tables stay the same size whatever the corpus.  Counts
come from every training text.  The `HEAD` most frequent words and their counts are broadcast; rarer words meet
their counts in a join.  EM takes all training texts in each of its passes, their expected counts summed over partitions:
the first passes slice by slice, the model moving on after each (stepwise EM), the last one at once (Baum-Welch).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import columns, cut, discard, fold, scratch_path, small_batches

FOLDS = 5
HELD_OUT = 1
STATES = 8
TOP = 32_768
HEAD = 200_000
CLASSES = 1024
# Bins of counts for each factor e.
BINS = 64
# Passes over all training texts, and the slices of each.  The model moves on after every slice; a pass in one slice is a
# Baum-Welch round.
PASSES = (16, 8, 1)
# The weight of a slice's counts falls by this power of the steps taken.
FORGET = 0.6
SEED = 7
# Expected counts that each state's table has from the corpus frequencies before it sees any text.
PRIOR = 50.0
# Words a task counts, and tokens it takes through the recursions, at once.
HELD_WORDS = 400_000
EM_TOKENS = 1_500_000
SCORE_TOKENS = 3_000_000
SMOOTH = 0.5

END_SYMBOL = 0


def tokens_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(F.col(doc_id), FOLDS) == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, c): occurrences in all given texts (body binary); the null word counts the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            (bodies,) = columns(batch, "body")
            for body in bodies:
                counts.update(tokens_of(body))
            counts[None] += len(bodies)
            if len(counts) > HELD_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
                counts = Counter()
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])

    return docs.select("body").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Bounded tables: the head's words, counts and symbols, and the totals of classes and corpus.

    Symbols are the end, the `top` words, the classes.
    """

    def __init__(
        self, head: list[tuple[bytes, int]], class_c: np.ndarray, class_v: np.ndarray, tokens: int, types: int, texts: int, top: int
    ) -> None:
        self.top = top
        self.rank = {w: k for k, (w, _) in enumerate(head)}
        self.count = np.array([c for _, c in head], dtype=np.int64)
        self.symbol = np.array([1 + k if k < top else 1 + top + class_of(w) for k, (w, _) in enumerate(head)], dtype=np.uint16)
        self.tokens, self.types, self.texts = tokens, types, texts
        self.total = math.log10(tokens + SMOOTH * (types + 1))
        self.class_log = np.log10(class_c + SMOOTH * (class_v + 1))
        share = np.full(1 + top + CLASSES, SMOOTH)
        share[END_SYMBOL] += texts
        share[1 : 1 + min(top, len(head))] += self.count[:top]
        share[1 + top :] += class_c
        self.share = share / share.sum()


def vocabulary(counts: DataFrame, head_words: int = HEAD, top: int = TOP) -> Vocabulary:
    if not top <= head_words:
        raise ValueError("the top words are part of the head")
    words = counts.where("word is not null").withColumn("bin", F.floor(F.ln("c") * BINS).cast("int"))
    # The head are the words above some count; counts are compared by bins, of which there are few.
    floor, size = 0, 0
    for row in words.groupBy("bin").count().orderBy(F.desc("bin")).collect():
        size += row["count"]
        if size > head_words:
            floor = row["bin"] + 1
            break
    found = words.where(F.col("bin") >= floor).select("word", "c").collect()
    head = sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda wc: (-wc[1], wc[0]))
    total = counts.agg(
        F.sum("c").alias("tokens"), F.count("*").alias("types"), F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("texts")
    ).first()
    # Words after the top ones by (count, word) belong to their classes.
    class_c, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    below = words.where(F.col("bin") < floor)
    if len(head) > top:
        last, least = head[top - 1]
        below = words.where((F.col("c") < least) | ((F.col("c") == least) & (F.col("word") > F.lit(last))))
    of = (F.crc32(F.expr("substring(word, -2, 2)")) % CLASSES).alias("class")
    for row in below.groupBy(of).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        class_c[row["class"]], class_v[row["class"]] = row["c"], row["v"]
    # Corpora without any text still count one type, the end.
    return Vocabulary(head, class_c, class_v, total["tokens"] or 0, max(1, total["types"]), total["texts"] or 0, top)


ENCODED = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, "
    "symbols binary, rare array<struct<word:binary,n:int>>"
)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each text as symbols, with the parts of its scores that the head decides, and its rarer words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), rare_type]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        context = TaskContext.get()
        row_id = (context.partitionId() if context else 0) << 40
        get = own.rank.get
        logs = np.log10(own.count + SMOOTH)
        for batch in batches:
            rows = []
            for key, held, body in zip(*columns(batch, "doc_id", "held_out", "body"), strict=True):
                words = tokens_of(body)
                rank = np.array([get(w, -1) for w in words], dtype=np.int64)
                seen = rank >= 0
                symbols = np.zeros(len(words) + 1, dtype="<u2")
                symbols[:-1][seen] = own.symbol[rank[seen]]
                absent = np.flatnonzero(~seen).tolist()
                symbols[absent] = [1 + own.top + class_of(words[k]) for k in absent]
                known = logs[rank[seen]]
                end = math.log10(own.texts + SMOOTH)
                inner = known[rank[seen] >= own.top].sum() - own.class_log[symbols[symbols > own.top].astype(np.int64) - 1 - own.top].sum()
                rare = [{"word": w, "n": n} for w, n in Counter([words[k] for k in absent]).items()]
                rows.append(
                    (row_id, key, held, len(symbols), int(seen.sum()) + (own.texts > 0), known.sum() + end - len(symbols) * own.total,
                     inner, symbols.tobytes(), rare)
                )
                row_id += 1
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ENCODED.split(", ")])

    return docs.mapInArrow(run, ENCODED)


class Hmm:
    """Start, transition and emission probabilities; emission has a row per symbol."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def random(cls, share: np.ndarray, states: int = STATES, seed: int = SEED) -> Hmm:
        """States that tend to stay, with the corpus frequencies bent at random."""
        emit = share[:, None] * np.random.default_rng(seed).gamma(1.0, 1.0, (len(share), states))
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Hmm:
        """The maximising step, with a prior that leaves no symbol and no move impossible."""
        emit = emit + PRIOR * share[:, None]
        move, start = move + 0.1, start + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def by_time(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, first those at time 0, then at time 1, longer texts first within a time.

    Also the text of each symbol, the first place of each time, and how many texts each time has.
    """
    sizes = np.array([len(t) for t in texts])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    first = np.concatenate(([0], np.cumsum(alive)[:-1]))
    time = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = first[time] + np.repeat(np.arange(len(sizes)), sizes)
    flat = np.empty(len(place), dtype=np.int64)
    flat[place] = np.concatenate([texts[k] for k in order])
    of = np.empty(len(place), dtype=np.int64)
    of[place] = np.repeat(order, sizes)
    return flat, of, first, alive


def log10_likelihoods(texts: list[np.ndarray], model: Hmm) -> np.ndarray:
    """log10 P(symbols) of each text (each has its end), by the forward recursion scaled at every step."""
    flat, of, first, alive = by_time(texts)
    scale = np.empty(len(flat))
    now = None
    for at, n in zip(first.tolist(), alive.tolist(), strict=True):
        seen = model.emit[flat[at : at + n]]
        now = seen * (model.start if now is None else now[:n] @ model.move)
        total = now.sum(axis=1)
        scale[at : at + n] = total
        now /= total[:, None]
    return np.bincount(of, weights=np.log10(scale), minlength=len(texts))


def expected_counts(texts: list[np.ndarray], model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of the texts under the model: forward, then backward."""
    flat, _, first, alive = by_time(texts)
    states = len(model.start)
    seen = model.emit.astype(np.float32)[flat]
    move = model.move.astype(np.float32)
    forward = np.empty_like(seen)
    scale = np.empty((len(flat), 1), dtype=np.float32)
    spans = [(a, a + n) for a, n in zip(first.tolist(), alive.tolist(), strict=True)]
    before = None
    for a, b in spans:
        now = seen[a:b] * (model.start.astype(np.float32) if before is None else before[: b - a] @ move)
        scale[a:b] = now.sum(axis=1, keepdims=True)
        now /= scale[a:b]
        forward[a:b] = before = now
    moved = np.zeros((states, states))
    later = np.ones((0, states), dtype=np.float32)
    for k in range(len(spans) - 1, -1, -1):
        a, b = spans[k]
        backward = np.ones((b - a, states), dtype=np.float32)
        if len(later):
            # `later` holds emission times backward over scale of the texts that go on.
            backward[: len(later)] = later @ move.T
            moved += forward[a : a + len(later)].T @ later
        later = seen[a:b] * backward / scale[a:b]
        forward[a:b] *= backward
    moved *= model.move
    emitted = np.stack([np.bincount(flat, weights=forward[:, k], minlength=len(model.emit)) for k in range(states)], axis=1)
    return forward[: alive[0]].sum(axis=0).astype(float), moved, emitted


def _buffered(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows (row_id, symbols) gathered up to about `most` symbols."""
    ids: list[int] = []
    texts: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for key, symbols in zip(*columns(batch, "row_id", "symbols"), strict=True):
            ids.append(key)
            texts.append(np.frombuffer(symbols, dtype="<u2").astype(np.int64))
            held += len(texts[-1])
            if held >= most:
                yield ids, texts
                ids, texts, held = [], [], 0
    if texts:
        yield ids, texts


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def corpus_counts(encoded: DataFrame, model: Hmm) -> Counts | None:
    """Expected starts, moves and emissions of all given texts: counted per partition, summed by symbol.  None without texts."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)
    names = [f"s{k}" for k in range(states)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, texts in _buffered(batches, EM_TOKENS):
            found = expected_counts(texts, shared.value)
            total = found if total is None else tuple(a + b for a, b in zip(total, found, strict=True))
        if total is not None:
            start, move, emit = total
            there = np.flatnonzero(emit.sum(axis=1))
            # Negative symbols carry the moves from each state, then the starts.
            symbol = np.concatenate((there, -1 - np.arange(states), [-1 - states]))
            values = np.concatenate((emit[there], move, start[None, :])).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(symbol), *(pa.array(values[:, k]) for k in range(states))], ["symbol", *names])

    partial = encoded.select("row_id", "symbols").mapInArrow(run, "symbol long, " + ", ".join(f"{n} float" for n in names))
    # At most one row for each symbol and state.
    sums = partial.groupBy("symbol").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    shared.destroy()
    if sums.empty:
        return None
    values, symbol = sums[names].to_numpy(float), sums["symbol"].to_numpy(int)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    emit[symbol[symbol >= 0]] = values[symbol >= 0]
    for k, row in zip(symbol[symbol < 0], values[symbol < 0], strict=True):
        if k == -1 - states:
            start = row
        else:
            move[-1 - k] = row
    return start, move, emit


def train(encoded: DataFrame, share: np.ndarray, states: int = STATES, passes: tuple[int, ...] = PASSES) -> Hmm:
    """The model of all texts of `encoded`: each pass takes every text once, in as many slices as `passes` says.

    A slice's counts stand for the whole corpus, times the slices; they are mixed with those before, of which less and less is
    forgotten.  A pass in one slice takes its own counts alone.  The symbols are filed by the finest slices, so a slice
    reads what it takes instead of the whole table.
    """
    model, held, steps = Hmm.random(share, states), None, 0
    spark, finest = encoded.sparkSession, max(passes, default=1)
    path, filed = None, encoded

    def own(slices: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED), "row_id"), F.lit(slices))

    if finest > 1:
        path = scratch_path(spark, "slices")
        encoded.select("row_id", "symbols", own(finest).cast("int").alias("slice")).write.partitionBy("slice").parquet(path)
        filed = spark.read.schema("row_id long, symbols binary, slice int").parquet(path)
    for slices in passes:
        of = own(slices) if finest % slices else F.pmod("slice", F.lit(slices))
        for k in range(slices):
            found = corpus_counts(filed.where(of == k) if slices > 1 else encoded, model)
            if found is None:
                continue
            steps += 1
            new = 1.0 if held is None or slices == 1 else steps**-FORGET
            held = tuple(new * slices * b + (1 - new) * a for a, b in zip(held or found, found, strict=True))
            model = Hmm.from_counts(*held, share)
        if held is None:
            break
    if path:
        discard(spark, path)
    return model


def likelihoods(encoded: DataFrame, model: Hmm) -> DataFrame:
    """(row_id, path): log10 likelihood of each text's symbols."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _buffered(batches, SCORE_TOKENS):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(log10_likelihoods(texts, shared.value))], ["row_id", "path"])

    return encoded.select("row_id", "symbols").mapInArrow(run, "row_id long, path double")


def rare_parts(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """(row_id, rare_log, rare_known): what the words outside the head add to a text's scores."""
    words = encoded.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.word", "r.n")
    met = words.join(counts.where("word is not null"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    return met.groupBy("row_id").agg(
        F.sum(F.col("n") * F.log10(c + SMOOTH)).alias("rare_log"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, head: int = HEAD, top: int = TOP) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    Null and empty texts are their end alone.  Texts of the held-out fold add nothing to any count; repeated
    rows count each.  An empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body")).withColumn("held_out", held_out())
    counts = cut(word_counts(rows.where(~F.col("held_out"))))
    vocab = vocabulary(counts, head, top)
    path = path or scratch_path(spark, "encoded")
    encode(rows, vocab).write.parquet(path)
    encoded = spark.read.schema(ENCODED).parquet(path)
    model = train(encoded.where(~F.col("held_out")), vocab.share)
    both = likelihoods(encoded, model).join(rare_parts(encoded, counts), "row_id", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    scored = encoded.drop("symbols", "rare").join(both, "row_id")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log).alias("base_score"),
        (F.col("path") + F.col("inner") + rare_log).alias("score"),
    )
