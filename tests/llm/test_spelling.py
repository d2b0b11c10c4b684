"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from helpers import SCHEMA, frame, texts

from streamloader.llm import spelling_variants

LETTERS = "abcdeéÀÿ"


def one_apart(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def is_letter(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if is_letter(c):
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
                counts[word] += len(word) >= 5
                run = ""
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if own and counts[best] >= 2 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def found(df, **how):
    rows = [tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in spelling_variants.variants(df, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def edited(rng, word):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(LETTERS) + word[at:], word[:at] + rng.choice(LETTERS) + word[at + 1 :]])


def test_equals_all_pairs_on_words_of_few_letters(spark):
    """Many anagrams, chains of forms, equal counts; every near pair is found, whatever the edit and its place."""
    rng = random.Random(4)
    stems = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(5, 11))) for _ in range(40)]
    words = [*stems, *(edited(rng, w) for w in stems for _ in range(6))]
    words += [edited(rng, w) for w in words]
    rows = [" ".join(rng.choice(words).upper() if rng.random() < 0.1 else rng.choice(words) for _ in range(80)) for _ in range(60)]
    df = frame(spark, [*rows, " ".join(stems * 12)])
    expected = brute(plain(df))
    assert sum(r[2] for r in expected) > 200 and any(r[3] and r[5] != r[3] for r in expected)
    assert found(df) == expected
    assert found(df, parts=5) == expected


def test_odd_texts_nulls_repeats_and_clashing_columns(spark):
    """Null and empty texts, null ids, other scripts, one run of 30,000 letters, repeated rows."""
    df = frame(spark, [*texts(), *["straße Straße strasse straßen"] * 9, *["x" * 30_000] * 3, *["x" * 29_999] * 3])
    got = found(df.withColumnRenamed("c", "word").withColumnRenamed("fp", "n"))
    assert got == brute(plain(df)) and any(len(r[0]) > 29_000 and r[2] for r in got)


def test_one_run_in_97_loses_a_letter():
    hit = [k for k in range(2000) if spelling_variants.written(k, "straße") != "straße"]
    assert hit == [k for k in range(2000) if zlib.crc32(f"{k}:straße".encode()) % 97 == 0]
    assert all(len(spelling_variants.written(k, "straße")) == 5 for k in hit)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == set()


def test_too_few_parts(spark):
    with pytest.raises(ValueError):
        spelling_variants.near_pairs(spark.createDataFrame([], "word string, n long"), parts=2)
