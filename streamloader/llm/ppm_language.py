"""Language identification by prediction by partial matching.

Each language has a context tree of bytes: how often each byte followed each context of up to `ORDER` bytes.
A byte's code length is read off the longest context that has seen it; every longer one on the way
costs an escape, d / (n + d) of a context seen n times with d different successors (method C), and
a byte no context knows is coded uniformly.  Words are coded one by one, contexts starting at the word's
start, so that a word's code length is a constant of the frozen statistics.  The language with the
shortest code wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import column, columns, cut, fold, small_batches

ORDER = 3
FOLDS = 4
HELD_OUT = 2
UNDETERMINED = "und"
# Leaves of all trees together.  Beyond it the rarest go first, and their context then escapes instead.
MAX_LEAVES = 1_000_000
# Bins of counts for each factor e.
BINS = 64
# Words a task counts, or remembers the code lengths of, before it starts anew.
HELD_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """ORDER + 1 bytes up to each byte of each word and its end, as big-endian numbers; and starts of words."""
    pad = b" " * ORDER
    coded = [w.encode() for w in words]
    flat = np.frombuffer(pad + b"".join([w + b" " + pad for w in coded]), dtype=np.uint8).astype(np.int64)
    code = np.zeros(len(flat) - ORDER, dtype=np.int64)
    for k in range(ORDER + 1):
        code = code << 8 | flat[k : k + len(code)]
    sizes = np.array([len(w) + 1 for w in coded], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    # Positions of the bytes of word j: its own ones shifted by the padding of the words before it.
    keep = np.arange(sizes.sum()) + np.repeat(np.arange(len(coded)) * ORDER, sizes)
    return code[keep], starts


def leaf_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each gram occurs in the texts of a language; null languages do not count."""
    small_batches(docs.sparkSession)
    chosen = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("body")
    )

    def flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            if own:
                code, starts = grams(list(own))
                weight = np.repeat(np.fromiter(own.values(), np.int64), np.diff([*starts, len(code)]))
                found, where = np.unique(code, return_inverse=True)
                n = np.bincount(where, weights=weight).astype(np.int64)
                names = pa.array([lang] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(found), pa.array(n)], ["lang", "gram", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(*columns(batch, "lang", "body"), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield from flush(counts)
                counts = {}
        yield from flush(counts)

    return chosen.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen context trees of all languages; code lengths in bits."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> None:
        self.langs = langs
        self.levels = []
        for own in range(len(langs)):
            mine = lang == own
            levels = []
            for order in range(ORDER, -1, -1):
                codes, where = np.unique(gram[mine] & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
                counts = np.bincount(where, weights=n[mine], minlength=len(codes))
                contexts, of = np.unique(codes >> 8, return_inverse=True)
                total = np.bincount(of, weights=counts, minlength=len(contexts))
                kinds = np.bincount(of, minlength=len(contexts)).astype(float)
                levels.append((codes, counts, contexts, total, kinds))
            self.levels.append(levels)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram: one row per gram, one column per language."""
        out = np.zeros((len(codes), len(self.langs)))
        for own, levels in enumerate(self.levels):
            open_ = np.arange(len(codes))
            for order, (grams_, counts, contexts, total, kinds) in zip(range(ORDER, -1, -1), levels, strict=True):
                if not len(grams_) or not len(open_):
                    continue
                wanted = codes[open_] & ((1 << 8 * (order + 1)) - 1)
                at = np.minimum(np.searchsorted(contexts, wanted >> 8), len(contexts) - 1)
                seen = contexts[at] == wanted >> 8
                room = total[at] + kinds[at]
                leaf = np.minimum(np.searchsorted(grams_, wanted), len(grams_) - 1)
                hit = grams_[leaf] == wanted
                out[open_[hit], own] -= np.log2(counts[leaf[hit]] / room[hit])
                miss = seen & ~hit
                out[open_[miss], own] -= np.log2(kinds[at[miss]] / room[miss])
                open_ = open_[~hit]
            out[open_, own] += 8
        return out

    def word_bits(self, words: list[str]) -> np.ndarray:
        """Code length of each word and its end under each language."""
        if not words:
            return np.zeros((0, len(self.langs)))
        code, starts = grams(words)
        distinct, where = np.unique(code, return_inverse=True)
        return np.add.reduceat(self.bits(distinct)[where], starts, axis=0)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_leaves: int = MAX_LEAVES) -> Trees:
    """Trees learned from all given documents, of at most `max_leaves` leaves together."""
    counts = cut(leaf_counts(docs, text_col, lang_col)).withColumn("bin", F.floor(F.ln("n") * BINS).cast("int"))
    # How many leaves have counts in each bin, of which there are few, decides the lowest bin that stays.
    floor, size = 0, 0
    for row in counts.groupBy("bin").count().orderBy(F.desc("bin")).collect():
        size += row["count"]
        if size > max_leaves:
            floor = row["bin"] + 1
            break
    rows = counts.where(F.col("bin") >= floor).drop("bin").toPandas().sort_values(["lang", "gram"])
    langs = sorted(rows["lang"].unique())
    index = {name: k for k, name in enumerate(langs)}
    return Trees(langs, rows["lang"].map(index).to_numpy(np.int64), rows["gram"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))


class Judge:
    """Scores texts under frozen trees, remembering a bounded number of words' code lengths."""

    def __init__(self, trees: Trees) -> None:
        self.trees = trees
        self.known: dict[str, int] = {}
        self.lengths = np.zeros((0, len(trees.langs)))

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        own = [words_of(text) for text in texts]
        distinct = set().union(*own)
        new = list(distinct.difference(self.known))
        if len(self.known) + len(new) > HELD_WORDS:
            self.known, self.lengths, new = {}, self.lengths[:0], list(distinct)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.lengths = np.concatenate((self.lengths, self.trees.word_bits(new)))
        names, scores = [], []
        for words in own:
            if not words or not self.trees.langs:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            total = self.lengths[[self.known[w] for w in words]].sum(axis=0)
            best = int(total.argmin())
            names.append(self.trees.langs[best])
            scores.append(float(1 / np.exp2(np.maximum(total[best] - total, -1000)).sum()))
        return names, scores


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the language whose trees code the whole text in fewest bits.

    `score` is its share of 2^-bits over all languages.  A null text, a text without letters and any text
    under a model without languages is `und` with score 0; equal code lengths go to the first name.
    Repeated rows are scored alike; an empty table gives no rows; further columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value).judge
        for batch in batches:
            names, scores = judge(column(batch, "body"))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return chosen.mapInArrow(run, "doc_id long, lang_pred string, score double")


def reject(docs: DataFrame, trees: Trees, share: float) -> DataFrame:
    """The rows whose text has a language with a score of at least `share`, with all their columns (of which `text` is one)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value).judge
        for batch in batches:
            names, scores = judge(column(batch, "text"))
            yield batch.filter(pa.array([n != UNDETERMINED and s >= share for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(fold(F.col(doc_id), FOLDS) == HELD_OUT, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from those not held out."""
    trees = fit(docs.where(~held_out()))
    return identify(docs, trees).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
