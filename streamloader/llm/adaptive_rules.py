"""Quality rules whose thresholds are read off the data: quantile sketches per language and source.

Every statistic is a DataFrame expression.  A sketch is a histogram over logarithmic bins: a value x > 0 falls
into bin ceil(ln(x) / ln(GAMMA)), so any quantile is known to within a relative error of (GAMMA - 1) / 2,
and sketches merge by adding counts.  Its size depends on the range of the values, not on the rows.  A
group's thresholds lie beyond its quartiles by `FENCE` times their distance in log space, so what is usual in a
language and source passes there.  Groups below `LEAST_ROWS` rows use the sketch merged over all groups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import cut

SHINGLE = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GAMMA = 1.02
FENCE = 3.0
# The least distance of a fence from the quartiles, in log space: groups of equal values keep some room.
SLACK = math.log(2)
LEAST_ROWS = 50
# Added to every ratio before its logarithm.  Most documents have no symbols, repeats or repeated lines; where the
# quartiles are zero, the fence then stands at this ratio.
OFFSET = 0.25
# Signals, and whether a value may be too low or too high.
SIGNALS = {
    "word_length": (True, True),
    "symbols": (False, True),
    "dup_lines": (False, True),
    "repeats": (False, True),
}
SPACE = " \\t\\n\\u000B\\u000C\\r"
SYMBOLS = "#*$%&|<>"


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang, source and the base counters of every whole text; a null text has no words.

    Words are runs of anything but the six ASCII white-space characters.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = docs.select(F.col(id_col).alias("doc_id"), "lang", "source", text.alias("body")).withColumn(
        "words", F.expr(r"filter(split(body, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    )
    windows = F.expr(
        f"""case when size(words) >= {SHINGLE} then
              transform(sequence(1, size(words) - {SHINGLE - 1}), i -> xxhash64(slice(words, i, {SHINGLE})))
            else cast(array() as array<bigint>) end"""
    )
    lines = F.expr(r"filter(split(body, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')")
    listed = start.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.expr(f"cast(char_length(translate(body, '{SPACE}', '')) as long)").alias("word_chars"),
        F.expr(f"cast(char_length(body) - char_length(translate(body, '{SYMBOLS}', '')) as long)").alias("n_symbols"),
        lines.alias("lines"),
        windows.alias("windows"),
    )
    # Sorted by hash, equal windows are neighbours; documents without any have nothing to sort.
    tagged = listed.withColumn(
        "tagged",
        F.expr(
            """case when size(windows) > size(array_distinct(windows))
                 then sort_array(transform(windows, (h, i) -> struct(h as h, i as i))) end"""
        ),
    )
    placed = tagged.withColumn(
        "places",
        F.expr(
            """sort_array(transform(filter(transform(tagged, (w, k) -> struct(w.i as i,
                 (k > 0 and get(tagged, k - 1).h = w.h) or (k + 1 < size(tagged) and get(tagged, k + 1).h = w.h) as twice)),
               w -> w.twice), w -> w.i))"""
        ),
    )
    # The union of the windows that occur twice, from left to right.
    covered = F.expr(
        f"""coalesce(aggregate(places, named_struct('upto', 0, 'n', 0L),
              (a, p) -> named_struct('upto', p + {SHINGLE}, 'n', a.n + {SHINGLE} - greatest(a.upto - p, 0)),
              a -> a.n), 0L)"""
    )
    return placed.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _signals() -> dict[str, Column]:
    """Each signal as a ratio above zero; null where the document has no words."""
    words = F.nullif(F.col("n_words"), F.lit(0))
    ratio = {
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)),
        "repeats": F.col("n_repeat_words") / words,
    }
    return {name: value + OFFSET for name, value in ratio.items()}


def _bin(value: Column) -> Column:
    return F.ceil(F.ln(value) / math.log(GAMMA)).cast("int")


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, signal, bin, n): the quantile sketch of each signal in each group; merge by adding n."""
    pairs = [F.struct(F.lit(name).alias("signal"), _bin(value).alias("bin")) for name, value in _signals().items()]
    each = stats.select("lang", "source", F.explode(F.array(*pairs)).alias("s")).select("lang", "source", "s.*")
    return each.where("bin is not null").groupBy("lang", "source", "signal", "bin").agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Lowest and highest usual bin of each signal, from the quartiles of a sketch summed over `keys`."""
    merged = sketch.groupBy(*keys, "signal", "bin").agg(F.sum("n").alias("n"))
    over = ", ".join([*keys, "signal"])
    ranked = merged.selectExpr(
        *keys, "signal", "bin",
        f"sum(n) over (partition by {over} order by bin rows unbounded preceding) as upto",
        f"sum(n) over (partition by {over}) as total",
    )
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bin"))) for k in (1, 3)]
    room = math.ceil(SLACK / math.log(GAMMA))
    reach = F.greatest((F.col("q3") - F.col("q1")) * F.lit(FENCE), F.lit(float(room)))
    return (
        ranked.groupBy(*keys, "signal")
        .agg(quartile[0].alias("q1"), quartile[1].alias("q3"), F.max("total").alias("total"))
        .select(*keys, "signal", "total", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, <signal>_low, <signal>_high): one row per group; null groups are groups like others."""
    own = _fences(sketch, ["lang", "source"])
    whole = _fences(sketch, []).select("signal", F.col("low").alias("all_low"), F.col("high").alias("all_high"))
    chosen = own.join(F.broadcast(whole), "signal").select(
        "lang", "source", "signal",
        *[
            F.when(F.col("total") >= LEAST_ROWS, F.col(side)).otherwise(F.col(f"all_{side}")).alias(side)
            for side in ("low", "high")
        ],
    )
    wide = [
        F.max(F.when(F.col("signal") == name, F.col(side))).alias(f"{name}_{side}")
        for name in SIGNALS
        for side in ("low", "high")
    ]
    return chosen.groupBy("lang", "source").agg(*wide)


def verdicts(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """The statistics with base_failed and kept; a signal that is null or has no threshold passes."""
    limits = limits.withColumnRenamed("lang", "of_lang").withColumnRenamed("source", "of_source")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    odd = F.lit(False)
    for name, value in _signals().items():
        for side, counts in zip(("low", "high"), SIGNALS[name], strict=True):
            if counts:
                edge = F.col(f"{name}_{side}")
                beyond = _bin(value) < edge if side == "low" else _bin(value) > edge
                odd = odd | F.coalesce(beyond, F.lit(False))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return stats.join(limits, same, "left").select(*stats.columns, failed.alias("base_failed"), (~failed & ~odd).alias("kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its statistics, base_failed, and kept.

    Null and empty texts have no words and fail; null languages and sources form groups of their own;
    repeated rows are judged alike and count each; an empty table gives no rows; further columns are not read.
    """
    stats = cut(statistics(docs, id_col, text_col))
    return verdicts(stats, thresholds(cut(sketches(stats))))
