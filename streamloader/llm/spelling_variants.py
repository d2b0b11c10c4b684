"""Spelling variants: words one edit apart, found through PartEnum signatures of their letter multisets.

A word is the binary vector of its letters and how many times each occurs: (letter, occurrence) is a dimension.  One
replaced letter changes two dimensions, an inserted or deleted one changes one, so near words have Hamming distance at
most two.  The dimensions are dealt to `PARTS` parts; two vectors within distance two are equal on all parts but two, so
they agree on the signature that leaves out the right two.  Every word is filed under one signature for each two parts left out.

Anagrams have equal vectors, and there are many.  Signatures therefore also hold what the order of the letters allows:
one edit leaves the first half of a word's letters as they are, or the last half, counted by the shorter word.
Words under one signature are joined and verified in the join, so only pairs one edit apart leave it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from streamloader.llm.common import columns, cut, release, small_batches

LEAST_LETTERS = 5
LEAST_COUNT = 3
# A form is at least this many times as frequent as the word.
FACTOR = 2
# One run in so many, by a hash of the document and the run, loses a letter.
DAMAGED = 97
PARTS = 3
APART = 2
# Words that a task counts before it hands them on.
HELD = 200_000
# Occurrences of a letter whose parts are balanced by frequency; later ones, of odd words only, are dealt by a rule.
BALANCED = 8
# Form links double in frequency, so 64 hops would pass any count; each round doubles the hops.
MAX_ROUNDS = 8

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def runs_of(text: bytes | None) -> Counter[str]:
    """Runs of letters in a UTF-8 text, A to Z lower-cased, with their counts."""
    return Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))) if text else Counter()


def written(doc_id: int | None, run: str) -> str:
    """The run as the document is taken to write it: some lose a letter.  A null id counts as an empty one."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least `LEAST_LETTERS` code points with at least `least` occurrences in all texts."""
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, body in zip(*columns(batch, "doc_id", "body"), strict=True):
                for own, n in runs_of(body).items():
                    word = written(doc_id, own)
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
                if len(held) >= HELD:
                    yield counted()
        yield counted()

    return chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def dimensions(word: str) -> Iterator[tuple[str, int]]:
    seen: dict[str, int] = {}
    for letter in word:
        seen[letter] = seen.get(letter, -1) + 1
        yield letter, seen[letter]


def learn_parts(words: DataFrame, parts: int) -> dict[tuple[str, int], int]:
    """Dimensions dealt to parts, the commonest first, each to the part with least to hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for (word,) in zip(*columns(batch, "word"), strict=True):
                found.update(d for d in dimensions(word) if d[1] < BALANCED)
        letters, nth = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(letters, pa.string()), pa.array(nth, pa.int32()), pa.array(found.values(), pa.int64())], ["letter", "nth", "n"]
        )

    counted = words.select("word").mapInArrow(run, "letter string, nth int, n long").groupBy("letter", "nth").agg(F.sum("n").alias("n"))
    # At most BALANCED rows for each letter of the alphabet.
    rows = sorted(counted.collect(), key=lambda r: (-r["n"], r["letter"], r["nth"]))
    load, dealt = [0] * parts, {}
    for r in rows:
        part = load.index(min(load))
        dealt[r["letter"], r["nth"]] = part
        load[part] += r["n"]
    return dealt


def signatures(word: str, dealt: dict[tuple[str, int], int], parts: int) -> Iterator[tuple[int, bool]]:
    """(signature, longer): what the word shares with near words of its own length or above, and with shorter ones."""
    own: list[list[str]] = [[] for _ in range(parts)]
    for letter, nth in sorted(dimensions(word)):
        part = dealt.get((letter, nth))
        own[(ord(letter) + nth) % parts if part is None else part].append(letter)
    for out in combinations(range(parts), APART):
        kept = "/".join("".join(own[p]) for p in range(parts) if p not in out)
        for longer in (False, True):
            shorter = len(word) - longer
            half = shorter // 2
            for side, fixed in (("<", word[:half]), (">", word[len(word) - shorter + half :])):
                key = f"{out}{shorter}{side}{fixed}:{kept}".encode()
                h = xxh64_intdigest(key)
                yield h - (1 << 64) if h >> 63 else h, longer


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, n) to (a, n_a, b, n_b): each pair of words one edit apart, once."""
    if parts <= APART:
        raise ValueError(f"more than {APART} parts are needed")
    dealt = words.sparkSession.sparkContext.broadcast(learn_parts(words, parts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(s, longer, w, n) for w, n in zip(*columns(batch, "word", "n"), strict=True) for s, longer in signatures(w, dealt.value, parts)]
            if out:
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.bool_(), pa.string(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["signature", "longer", "word", "n"])

    filed = words.select("word", "n").mapInArrow(run, "signature long, longer boolean, word string, n long")
    a = filed.where("not longer").select("signature", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = filed.select("signature", "longer", F.col("word").alias("b"), F.col("n").alias("n_b"))
    # The shorter word is a; of two words of one length, the smaller one.
    in_turn = F.col("longer") | (F.col("a") < F.col("b"))
    met = a.join(b, (a["signature"] == b["signature"]) & in_turn & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def follow(links: DataFrame) -> DataFrame:
    """(word, form) links to (word, root): the last word of each chain.  Frequencies grow along a chain, so it ends."""
    state = cut(links.select("word", F.col("form").alias("root")))
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        release(state)
        state = moved
        if state.where("moved").isEmpty():
            return state.select("word", "root")
    raise RuntimeError(f"chains of forms did not end in {MAX_ROUNDS} rounds")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary.

    Near words are one inserted, deleted or replaced code point apart.  A form is the most frequent near word (of equally
    frequent ones the smallest) if it is at least `FACTOR` times as frequent; `root` follows forms to the last one.  Null and
    empty texts have no words; a null id counts as an empty one; repeated rows count each time; an empty table gives
    no rows; further columns are not read.
    """
    words = cut(vocabulary(docs, id_col, text_col))
    pairs = near_pairs(words, parts)
    sides = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                              F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    both = pairs.select(sides.alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= FACTOR * F.col("n")
    judged = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ))
    release(words)
    roots = follow(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
