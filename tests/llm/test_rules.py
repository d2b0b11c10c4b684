"""The rule ensemble: statistics, tree paths, lasso weights and the compiled score against plain Python."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from helpers import SCHEMA, frame, sentence, texts

from streamloader.llm import rule_ensemble as rules
from streamloader.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def plain_statistics(text):
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    n = max(1, len(words))
    counted = {"symbols": "#*$%&<>", "bars": "|", "exclamations": "!", "stops": ".,;:?", "digits": "0123456789"}
    return {
        "n_words": len(words),
        "word_length": (len(text) + 1) / n,
        "distinct_words": len(set(words)) / n,
        "repeated_words": sum(a == b for a, b in zip(words, words[1:])) / n,
        "distinct_lines": len(set(lines)) / len(lines),
        "line_words": len(words) / len(lines),
        "capitals": sum("A" <= c <= "Z" or "À" <= c <= "Þ" for c in text) / n,
        **{s: sum(c in own for c in text) / n for s, own in counted.items()},
    }


def test_statistics(spark):
    """Null, empty and very long texts, repeated rows and columns whose names the operator uses."""
    rows = [*texts(), "A! b| #c# 12,5\n\nÉa Éa éa.", "| a | b |\n| a | b |\n"]
    df = frame(spark, rows).withColumnRenamed("c", "n_words").withColumnRenamed("fp", "chars")
    found = rules.statistics(df, "doc_id", "text").collect()
    assert len(found) == df.count()
    for r in found:
        own = plain_statistics(r["text"])
        assert {s: r[s] for s in rules.STATISTICS} == pytest.approx(own), r["text"]


def labelled(seed=3, many=600):
    rng = np.random.default_rng(seed)
    values = rng.random((many, len(rules.STATISTICS)))
    odds = np.where((values[:, 2] > 0.6) & (values[:, 4] <= 0.5), 3.0, -2.0)
    return values, (rng.random(many) < 1 / (1 + np.exp(-odds))).astype(float)


def test_paths_are_conjunctions_that_split_the_rows():
    values, labels = labelled()
    paths = rules.tree_paths(values, labels)
    assert len(set(paths)) == len(paths) and all(1 <= len(p) <= 2 * rules.DEPTH for p in paths)
    marks = rules.satisfied(paths, values)
    for k, path in enumerate(paths):
        plain = [all((row[rules.STATISTICS.index(s)] > t) == above for s, above, t in path) for row in values]
        assert marks[:, k].tolist() == plain
        assert rules.LEAST_ROWS <= sum(plain) < len(values)
    # The planted conjunction is among them, to within a threshold's step.
    assert any({(s, above) for s, above, _ in p} == {("distinct_words", True), ("distinct_lines", False)} and 
               all(abs(t - (0.6 if above else 0.5)) < 0.06 for _, above, t in p) for p in paths)


def test_lasso_weights_meet_the_optimality_conditions():
    """At the minimum the slope of the loss is within the penalty at a zero weight, and equals it against the sign of any other."""
    values, labels = labelled()
    rows = rules.satisfied(rules.tree_paths(values, labels), values)
    w, b = rules.lasso_logistic(rows, labels, 0.01, steps=20_000)
    slope = rows.T @ (1 / (1 + np.exp(-(rows @ w + b))) - labels) / len(labels)
    assert 0 < np.count_nonzero(w) < len(w) / 2
    assert np.abs(slope[w == 0]).max() <= 0.01 + 1e-6
    assert slope[w != 0] == pytest.approx(-0.01 * np.sign(w[w != 0]), abs=1e-6)
    assert abs(np.mean(1 / (1 + np.exp(-(rows @ w + b))) - labels)) < 1e-6


def test_compiled_score_equals_plain_evaluation(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    model = rules.fit(docs, labels)
    assert 0 < len(model.rules) < 200
    known = {r["doc_id"]: r["text"] for r in docs.collect()}
    scored = rules.score(docs, model).collect()
    assert len(scored) == len(known)
    for r in scored:
        own = plain_statistics(known[r["doc_id"]])
        margin = model.bias + sum(w for rule, w in zip(model.rules, model.weights) if all((own[s] > t) == above for s, above, t in rule))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-9)
        assert r["predicted"] == (r["score"] >= 0.3)


def test_held_out_labels_are_foretold_and_never_read(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    flipped = labels.withColumn("quality", (1 - labels["quality"])).where(rules.held_out()).unionByName(labels.where(~rules.held_out()))
    assert rules.fit(docs, flipped) == rules.fit(docs, labels)
    scored = rules.quality(docs, labels).where("held_out").join(labels.where("quality is not null"), "doc_id").collect()
    good, bad = ([r["score"] for r in scored if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_repeated_ids_and_labels_stay_within_the_bound(spark):
    """Copies of an id take one place in the sample; of its labels the largest counts."""
    rows = [(k % 50, f"{'good words here' if k % 2 else '## || ##'} {k % 50}", "en", "s", 1, *["x"] * 8) for k in range(400)]
    labels = spark.createDataFrame([(k % 50, k % 2) for k in range(100)] + [(None, 1), (3, None)], "doc_id long, quality int")
    drawn = []
    grown, rules.ensemble = rules.ensemble, lambda values, y: drawn.append((len(values), y)) or rules.Ensemble((), (), 0.0)
    try:
        rules.fit(spark.createDataFrame(rows, SCHEMA), labels, most=20)
    finally:
        rules.ensemble = grown
    assert drawn[0][0] == 20


def test_one_label_no_labels_and_empty_tables(spark):
    docs = frame(spark, texts())
    for made, above in (([(k, 1) for k in range(40)], True), ([(k, 0) for k in range(40)], False), ([], True)):
        out = rules.quality(docs, spark.createDataFrame(made, "doc_id long, quality int"))
        scores = {r["score"] for r in out.collect()}
        assert len(scores) == 1 and (scores.pop() >= 0.5) == above
    assert rules.quality(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int")).collect() == []
