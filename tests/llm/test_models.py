"""Language model, language identification, toxicity and the pipeline."""

from __future__ import annotations

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import frame, sentence, texts
from pyspark.sql import functions as F

import corpus_pipeline
from streamloader.llm import hmm_scoring, nnpu_toxicity, ppm_language
from streamloader.llm.common import shared_dir, table

SF_DIR = "/root/testdata/sf0.01"


def small_model(states=3, symbols=5):
    rng = np.random.default_rng(1)
    emit = rng.random((symbols, states))
    return hmm_scoring.Hmm(np.array([0.5, 0.3, 0.2]), rng.dirichlet(np.ones(states), states), emit / emit.sum(axis=0))


def path_sums(text, model):
    """Likelihood and expected counts by listing all state paths."""
    states = range(len(model.start))
    total, start = 0.0, np.zeros(len(states))
    move, emit = np.zeros_like(model.move), np.zeros_like(model.emit)
    for path in itertools.product(states, repeat=len(text)):
        p = model.start[path[0]] * model.emit[text[0], path[0]]
        for a, b, s in zip(path, path[1:], text[1:]):
            p *= model.move[a, b] * model.emit[s, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
        for s, k in zip(text, path, strict=True):
            emit[s, k] += p
    return total, start / total, move / total, emit / total


def test_forward_and_expected_counts_equal_sums_over_paths():
    model = small_model()
    rows = [np.array(t) for t in ([0], [1, 2, 0], [3, 3, 4, 1, 2, 0], [4, 0], [2, 2, 2, 2, 0], [1, 2, 0])]
    sums = [path_sums(t, model) for t in rows]
    assert hmm_scoring.log10_likelihoods(rows, model) == pytest.approx([math.log10(s[0]) for s in sums])
    for found, part in zip(hmm_scoring.expected_counts(rows, model), (1, 2, 3), strict=True):
        assert found == pytest.approx(sum(s[part] for s in sums), rel=1e-4, abs=1e-5)


def test_long_text_does_not_underflow():
    model = small_model()
    text = np.random.default_rng(2).integers(0, 5, 30_000)
    assert -60_000 < hmm_scoring.log10_likelihoods([text], model)[0] < -10_000


def brute_base(rows):
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 if k is not None else False for k in rows}
    split = {k: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None] for k, t in rows.items()}
    return held, split


@pytest.mark.parametrize(("head", "top"), [(hmm_scoring.HEAD, hmm_scoring.TOP), (4, 2)])
def test_scores_of_a_small_corpus(spark, head, top):
    """Also with a head of four words, where the other words meet their counts in the join."""
    rows = dict(enumerate(texts()))
    df = frame(spark, list(rows.values()))
    found = hmm_scoring.score(df, head=head, top=top).collect()
    held, split = brute_base(rows)
    counts = Counter()
    for k, own in split.items():
        for _ in range(0 if held[k] else 1 + (k == 0)):
            counts.update(own)
    counts.update(split[len(rows) - 1])  # the row with a null id
    n, v = sum(counts.values()), len(counts)
    for r in found:
        if r.doc_id is not None:
            own = split[r.doc_id]
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
            assert r.n_known == sum(counts[w] > 0 for w in own)
            assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
            assert -math.inf < r.score < 0
    assert len(found) == len(rows) + 2
    assert hmm_scoring.score(df.limit(0)).count() == 0


def test_states_beat_the_unigram_on_held_out_texts(spark):
    total = hmm_scoring.score(table(spark, SF_DIR, "documents")).where("held_out").selectExpr("sum(score)", "sum(base_score)", "sum(n_tokens)").first()
    assert total[0] / total[2] > total[1] / total[2] + 0.2


def test_every_pass_takes_every_text_once(spark, monkeypatch):
    taken, counts = [], hmm_scoring.corpus_counts

    def counted(encoded, model):
        taken.append([r.row_id for r in encoded.select("row_id").collect()])
        return counts(encoded, model)

    monkeypatch.setattr(hmm_scoring, "corpus_counts", counted)
    symbols = np.array([1, 2, 3, 0], dtype="<u2").tobytes()
    rows = spark.createDataFrame([(k, symbols) for k in range(700)], "row_id long, symbols binary")
    hmm_scoring.train(rows, np.full(5, 0.2), passes=(3, 1))
    assert len(taken) == 4 and sorted(itertools.chain(*taken[:3])) == sorted(taken[3]) == list(range(700))


def test_a_slice_reads_its_own_files_only(spark, monkeypatch, tmp_path):
    read, counts = [], hmm_scoring.corpus_counts

    def counted(encoded, model):
        read.append({r[0] for r in encoded.select(F.input_file_name()).collect()})
        return counts(encoded, model)

    monkeypatch.setattr(hmm_scoring, "corpus_counts", counted)
    symbols = np.array([1, 2, 3, 0], dtype="<u2").tobytes()
    spark.createDataFrame([(k, symbols) for k in range(400)], "row_id long, symbols binary").coalesce(1).write.parquet(str(tmp_path / "texts"))
    hmm_scoring.train(spark.read.parquet(str(tmp_path / "texts")), np.full(5, 0.2), passes=(4, 2, 1))
    first, second = read[:4], read[4:6]
    assert all(first) and not any(a & b for a, b in itertools.combinations(first, 2))
    assert not second[0] & second[1] and second[0] | second[1] == set().union(*first)


def brute_bits(word, leaves):
    """Code length of a word and its end from raw counts, byte by byte."""
    coded = b"   " + word.encode() + b" "
    bits = 0.0
    for k in range(3, len(coded)):
        for order in range(3, -1, -1):
            context, byte = coded[k - order : k], coded[k]
            followers = leaves[order][context]
            if byte in followers:
                bits -= math.log2(followers[byte] / (sum(followers.values()) + len(followers)))
                break
            if followers:
                bits -= math.log2(len(followers) / (sum(followers.values()) + len(followers)))
        else:
            bits += 8
    return bits


def test_code_lengths_equal_a_plain_tree(spark):
    corpus = {"en": ["the river stone stone", "light, the 12 Light"], "xx": ["éà éàé ñu"]}
    rows = [(t, lang) for lang, own in corpus.items() for t in own] + [("lost", None), (None, "en")]
    trees = ppm_language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert trees.langs == ["en", "xx"]
    words = ["the", "stone", "zebra", "éà", "lightly", "日本"]
    for own, lang in enumerate(trees.langs):
        leaves = [defaultdict(Counter) for _ in range(4)]
        for text in corpus[lang]:
            for word in re.findall(r"[^\W\d_]+", text.lower()):
                coded = b"   " + word.encode() + b" "
                for k in range(3, len(coded)):
                    for order in range(4):
                        leaves[order][coded[k - order : k]][coded[k]] += 1
        assert trees.word_bits(words)[:, own] == pytest.approx([brute_bits(w, leaves) for w in words])


def test_trees_stay_within_their_bound(spark):
    docs = table(spark, SF_DIR, "documents")
    trees = ppm_language.fit(docs, max_leaves=500)
    assert 0 < sum(len(levels[0][0]) for levels in trees.levels) <= 500
    found = ppm_language.identify(docs, trees).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() > 0.9 * found.count()


def test_languages_of_odd_texts(spark):
    rows = ["the river and the stone"] * 9 + ["der fluss und der stein"] * 9 + [None, "", "12 #", "the stone 9", "Der Stein!"]
    df = frame(spark, rows, ["en"] * 9 + ["de"] * 9 + ["en"] * 5)
    found = {r.doc_id: r for r in ppm_language.predict(df).collect() if r.doc_id is not None}
    assert [found[k].lang_pred for k in range(18, 23)] == ["und", "und", "und", "en", "de"]
    assert [found[k].score for k in range(18, 21)] == [0, 0, 0] and all(0 <= r.score <= 1 for r in found.values())
    assert {r.lang_pred for r in ppm_language.predict(df.withColumn("lang", df.lang.substr(9, 1)).where("false")).collect()} == set()
    none = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in ppm_language.predict(none).collect()} == {("und", 0.0)}


def test_language_accuracy_on_held_out_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    joined = ppm_language.predict(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert joined.where("lang = lang_pred").count() >= 0.99 * joined.count() > 0


def test_nnpu_learns_from_positives_and_a_mixture():
    rng = np.random.default_rng(4)
    clean = (rng.random((900, 20)) < 0.3).astype(np.float32)
    toxic = (rng.random((300, 20)) < 0.3).astype(np.float32)
    clean[:, :3], toxic[:, :3] = 0, 1
    w, b = nnpu_toxicity.nnpu(toxic[:200], np.concatenate((clean, toxic[200:])), prior=0.1)
    assert ((toxic @ w + b) > 0).all() and ((clean @ w + b) < 0).all()


def test_toxicity_of_odd_texts_and_missing_labels(spark):
    rng = random.Random(3)
    rows = [sentence(rng, 30) + (" vile slur" if k % 4 == 0 else "") for k in range(200)] + [None, "", "vile slur", "Vile, slur!"]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(k, None, int(k % 4 == 0)) for k in range(200)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in nnpu_toxicity.toxicity(df, labels).collect() if r.doc_id is not None}
    assert all(found[k].predicted == (k % 4 == 0) for k in range(200))
    assert [found[k].predicted for k in range(200, 204)] == [0, 0, 1, 1]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert {r.predicted for r in nnpu_toxicity.toxicity(df, labels.limit(0)).collect()} == {0}
    assert nnpu_toxicity.toxicity(df.limit(0), labels).count() == 0


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (table(spark, SF_DIR.replace("0.01", "0.1"), t) for t in ("documents", "labels"))
    rows = nnpu_toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    wins = [p.score > n.score for p in rows for n in rows if p.toxic == 1 and n.toxic == 0]
    assert sum(wins) / len(wins) > 0.95


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert after.columns == list(corpus_pipeline.COLUMNS) and 0.8 * docs.count() < after.count() <= docs.count()
            assert after.select("doc_id").distinct().count() == after.count()
            docs = after
        if name == "simhash_near_dedup":
            assert after.select("text").distinct().count() == after.count()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_of_odd_and_no_documents(spark):
    for df in (frame(spark, texts()), frame(spark, texts()).limit(0)):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
        assert docs.columns[:3] == ["doc_id", "piece", "start"]


def test_pipeline_run_leaves_only_its_result(spark):
    shared = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() > 0 and result.where("length > 4096").count() == 0
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(shared)) - before if "-" in n and not os.path.isdir(f"{shared}/{n}/rdd-0")}
    assert {n for n in left if n.startswith(("pipeline", "scanned"))} == {"pipeline-packing"}
