"""Texts that try an operator: nulls, empty and odd texts, copies, long ones; and rows made of them."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        *[T.StructField(n, T.StringType()) for n in ("body", "rank", "bucket", "fp", "c", "spans", "record", "words")],
    ]
)

ODD = [
    None, "", " ", "\n\n", "a", "...", "12 34", "one two", "One TWO three", "one two three",
    "日本語 のテキスト 🙂", "a\x0bb\x0cc\td\r\ne", "x" * 5000, "é" * 300, "I'll don't 'S <|endoftext|>", "   wide",
]


def sentence(rng: random.Random, words: int, vocabulary: str = "the of and river stone light cold") -> str:
    return " ".join(rng.choice(vocabulary.split()) for _ in range(words))


def texts(seed: int = 1, many: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    made = [sentence(rng, rng.randint(1, 120)) for _ in range(many)]
    made += [made[0]] * 5 + [sentence(rng, 30_000)]
    return ODD + made + ODD[:4]


def frame(spark, rows: list[str | None], langs: list[str | None] | None = None, parts: int = 3):
    """Documents with the given texts; one null id and one repeated row among them."""
    langs = langs or ["en", None, "de"]
    made = [(k, t, langs[k % len(langs)], f"s{k % 2}" if k % 5 else None, None, *["x"] * 8) for k, t in enumerate(rows)]
    if made:
        made += [(None, *made[-1][1:]), made[0]]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
