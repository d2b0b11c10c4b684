"""Text quality by a sparse ensemble of rules.

Texts become a row of statistics, by column expressions.  On a bounded sample of labelled rows, small boosted trees are
grown; every path from a root to a node below it is a rule, a conjunction of bounds on statistics.  Logistic weights
with a lasso penalty are fitted to the rules, which leaves most at zero, and the rest are compiled into one column
expression.  Scoring is a projection of the scan: nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloader.llm.common import cut, fold, hash_sample, release

FOLDS = 5
HELD_OUT = 0
# The ensemble is fitted on at most this many labelled documents, drawn by a hash of the id.
MAX_LABELLED = 10_000
SAMPLE_SEED = 12
THRESHOLD = 0.3

TREES = 24
DEPTH = 3
RATE = 0.3
# Thresholds tried for a statistic, and rows that a node has at least.
CUTS = 32
LEAST_ROWS = 5
# Penalties tried, as shares of the one that leaves no rule; the one that explains a fifth of the sample best is taken.
PENALTIES = (0.3, 0.1, 0.03, 0.01, 0.003, 0.001)
STEPS = 600

STATISTICS = (
    "n_words", "word_length", "distinct_words", "repeated_words", "distinct_lines", "line_words",
    "symbols", "bars", "exclamations", "stops", "capitals", "digits",
)
# Characters counted for a statistic, per word.
_COUNTED = {"symbols": "[#*$%&<>]", "bars": r"\|", "exclamations": "!", "stops": "[.,;:?]", "capitals": "[A-ZÀ-Þ]", "digits": "[0-9]"}

Condition = tuple[str, bool, float]
Rule = tuple[Condition, ...]


def statistics(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns of `keep` and the statistics of each whole text; a null text counts as an empty one."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = [f"kept_{k}" for k in range(len(keep))]
    kept = [F.col(c).alias(n) for c, n in zip(keep, names, strict=True)]
    found = docs.select(*kept, body.alias("body")).select(
        *names, F.regexp_extract_all("body", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
        F.split("body", "\n").alias("lines"), F.length("body").alias("chars"),
        *[F.regexp_count("body", F.lit(p)).alias(s) for s, p in _COUNTED.items()],
    )
    many = F.size("words")
    same = F.filter(F.arrays_zip(F.slice("words", 2, F.greatest(many, F.lit(1))).alias("a"), F.col("words").alias("b")), lambda p: p["a"] == p["b"])
    counted = found.select(
        *names, many.alias("many"), F.size(F.array_distinct("words")).alias("distinct"), F.size(same).alias("same"),
        F.size("lines").alias("n_lines"), F.size(F.array_distinct("lines")).alias("own_lines"), "chars", *_COUNTED,
    )
    per_word = F.greatest(F.col("many"), F.lit(1))
    made = {
        "n_words": F.col("many"),
        "word_length": (F.col("chars") + 1) / per_word,
        "distinct_words": F.col("distinct") / per_word,
        "repeated_words": F.col("same") / per_word,
        "distinct_lines": F.col("own_lines") / F.col("n_lines"),
        "line_words": F.col("many") / F.col("n_lines"),
        **{s: F.col(s) / per_word for s in _COUNTED},
    }
    originals = [F.col(n).alias(c) for n, c in zip(names, keep, strict=True)]
    return counted.select(*originals, *[made[s].cast("double").alias(s) for s in STATISTICS])


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights; the score is the logistic function of their sum."""

    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        margin = reduce(lambda total, c: total + c, [F.when(_holds(r), w).otherwise(0.0) for r, w in zip(self.rules, self.weights, strict=True)], F.lit(self.bias))
        return 1 / (1 + F.exp(-margin))

    def margins(self, values: np.ndarray) -> np.ndarray:
        return self.bias + satisfied(self.rules, values) @ np.array(self.weights, dtype=float)


def _holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(s) > t if above else F.col(s) <= t for s, above, t in rule])


def satisfied(rules: tuple[Rule, ...], values: np.ndarray) -> np.ndarray:
    """Rows by rules: 1 where the row of statistics meets the rule."""
    out = np.ones((len(values), len(rules)))
    for k, rule in enumerate(rules):
        for s, above, t in rule:
            own = values[:, STATISTICS.index(s)]
            out[:, k] *= own > t if above else own <= t
    return out


def _best_cut(values: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> tuple[float, int, float]:
    """(gain, statistic, threshold) of the best split of a node's rows."""
    best = (1e-6, -1, 0.0)
    whole = slope.sum() ** 2 / (curve.sum() + 1)
    for s, tried in enumerate(cuts):
        if not len(tried):
            continue
        at = np.searchsorted(tried, values[:, s])
        n, g, h = (np.bincount(at, w, len(tried) + 1).cumsum()[:-1] for w in (None, slope, curve))
        gain = g**2 / (h + 1) + (slope.sum() - g) ** 2 / (curve.sum() - h + 1) - whole
        gain[(n < LEAST_ROWS) | (len(values) - n < LEAST_ROWS)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), s, float(tried[k]))
    return best


def _tighter(rule: Rule, new: Condition) -> Rule:
    """The conjunction of a rule and a bound; of two bounds on one side of a statistic the tighter one is kept."""
    bounds = {(s, above): t for s, above, t in rule}
    s, above, t = new
    old = bounds.get((s, above), t)
    bounds[s, above] = max(old, t) if above else min(old, t)
    return tuple(sorted((s, above, t) for (s, above), t in bounds.items()))


def tree_paths(values: np.ndarray, labels: np.ndarray) -> tuple[Rule, ...]:
    """The distinct paths of trees boosted on the logistic loss, each from a root to a node below it."""
    levels = np.linspace(0, 1, CUTS + 2)[1:-1]
    cuts = [np.unique(np.quantile(values[:, s], levels, method="lower")) for s in range(values.shape[1])]
    # Rare but telling values lie beyond the quantiles of a statistic that is mostly zero.
    cuts = [np.unique(np.concatenate([c, np.quantile(v[v > 0], levels, method="lower")])) if (v := values[:, s]).max() > 0 else c for s, c in enumerate(cuts)]
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(labels), np.log(share / (1 - share)))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = labels - p, p * (1 - p)
        todo: list[tuple[np.ndarray, Rule]] = [(np.arange(len(labels)), ())]
        while todo:
            rows, rule = todo.pop()
            gain, s, t = _best_cut(values[rows], cuts, slope[rows], curve[rows]) if len(rule) < DEPTH else (0, -1, 0.0)
            if s < 0:
                margin[rows] += RATE * slope[rows].sum() / (curve[rows].sum() + 1)
                continue
            over = values[rows, s] > t
            for above, own in ((True, rows[over]), (False, rows[~over])):
                path = _tighter(rule, (STATISTICS[s], above, t))
                found[path] = None
                todo.append((own, path))
    return tuple(found)


def lasso_logistic(rows: np.ndarray, labels: np.ndarray, penalty: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the mean logistic loss plus `penalty` times the weights' absolute sum.

    Accelerated proximal gradient steps; the bias is not penalised.
    """
    n, size = rows.shape
    x = np.column_stack([rows, np.ones(n)])
    pace = 4 * n / max(1e-12, np.linalg.norm(x, 2) ** 2)
    w = np.zeros(size + 1)
    ahead, speed = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - pace * (x.T @ (p - labels)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - pace * penalty, 0)
        if (ahead - new) @ (new - w) > 0:
            speed = 1.0
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead, w, speed = new + (speed - 1) / faster * (new - w), new, faster
    return w[:-1], float(w[-1])


def log_loss(margin: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - labels * margin))


def ensemble(values: np.ndarray, labels: np.ndarray) -> Ensemble:
    """Rules and weights for rows of statistics and 0/1 labels; without both labels, the smoothed share alone."""
    rules = tree_paths(values, labels) if 0 < labels.sum() < len(labels) else ()
    if not rules:
        return Ensemble((), (), float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))))
    rows = satisfied(rules, values)
    most = np.abs(rows.T @ (labels - labels.mean())).max() / len(labels)
    tests = np.arange(len(labels)) % FOLDS == 0
    losses = []
    for share in PENALTIES:
        w, b = lasso_logistic(rows[~tests], labels[~tests], share * most)
        losses.append((log_loss(rows[tests] @ w + b, labels[tests]), -share))
    w, b = lasso_logistic(rows, labels, -min(losses)[1] * most)
    kept = np.flatnonzero(w)
    return Ensemble(tuple(rules[k] for k in kept), tuple(w[kept].tolist()), b)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(F.col(doc_id), FOLDS) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Ensemble:
    """An ensemble for `labels.quality`, from at most `most` documents outside the held-out fold.

    Ids are drawn once each; of rows that share an id one takes part, and of its labels the largest.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    chosen = cut(hash_sample(known.join(ids, "doc_id", "left_semi"), "doc_id", most, SAMPLE_SEED))
    # At most `most` ids.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.withColumnRenamed("doc_id", "id")), F.col("doc_id") == F.col("id")).select("doc_id", "text", "quality")
    found = statistics(rows, "doc_id", "quality").groupBy("doc_id", "quality").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    sample = sorted(tuple(r) for r in found.select("doc_id", "quality", *[f"s.{s}" for s in STATISTICS]).collect())
    release(chosen)
    values = np.array([r[2:] for r in sample], dtype=float).reshape(-1, len(STATISTICS))
    return ensemble(values, np.array([float(r[1] == 1) for r in sample]))


def score(docs: DataFrame, model: Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every whole text, by column expressions alone.

    Null texts score as empty ones, by the rules that hold for no words; repeated rows score alike; an empty table gives
    no rows; further columns are not read.
    """
    scored = statistics(docs, "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of the held-out fold are never read."""
    return score(docs, fit(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
