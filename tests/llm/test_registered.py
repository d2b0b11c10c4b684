"""Every registered query of the training-data operators, run once on small tables, with its contract checked."""

from __future__ import annotations

import hashlib
import os
import re
import zlib

import numpy as np
import pytest

from streamloader.llm import nnpu_toxicity
from streamloader.llm.common import table
from streamloader.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

COLUMNS = {
    "op1_nnls_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_disclosure": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3_bucket_shuffle": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_adaptive_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_hmm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6_pq_neardup": "vec_id n_links component_id kept",
    "op7_simhash_bktree": "doc_id fingerprint component_id",
    "op8_segment_tree_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_ppm_language": "doc_id held_out lang_pred score",
    "op10_nnpu_toxicity": "doc_id held_out score predicted",
    "op11_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_rule_ensemble": "doc_id held_out score predicted",
    "op13_spelling_variants": "word form root n n_near form_n",
}


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op2_disclosure", "op3_bucket_shuffle"}))
def test_query_returns_its_contract(spark, documents, name):
    df = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    rows = df.collect()
    if name == "op6_pq_neardup":
        assert len(rows) == table(spark, SF_DIR, "embeddings").count()
    elif name == "op13_spelling_variants":
        assert rows and all(len(r["word"]) >= 5 and r["n"] >= 3 for r in rows)
    elif name != "op1_nnls_packing":
        assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for fold, of in (("op5", (5, 1)), ("op9", (4, 2)), ("op10", (5, 0)), ("op12", (5, 0))):
        if name.startswith(f"{fold}_"):
            assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of[0] == of[1]) for r in rows)
    if "predicted" in df.columns:
        least = 0.3 if name.startswith("op12") else 0.5
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= least) for r in rows)


def test_shuffled_rows_and_their_places(spark, documents):
    rows = QUERIES["op3_bucket_shuffle"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    shards: dict[int, list[int]] = {k: [] for k in range(40)}
    for r in rows:
        body = (documents[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 16, zlib.crc32(body), "rows", None)
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    sizes = [len(slots) for slots in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))] != sorted(documents)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    found = []
    for rank, (kind, (pattern, holds)) in enumerate(KINDS.items()):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if holds(m[0])]
    return [s for _, _, s in sorted(found)]


def test_base_spans_and_their_digest(spark, documents):
    rows = QUERIES["op2_disclosure"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    seen = 0
    for r in rows:
        base = base_spans(documents[r["doc_id"]])
        seen += len(base)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(f"{k}:") for s in base) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if s in set(base)] == base
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
    assert seen > 10


def test_positive_unlabelled_risk_against_a_plain_loop():
    """Each step follows the slope of the risk, taken numerically, or backs out where the clean part is below zero."""
    rng = np.random.default_rng(6)
    positive, unlabelled = (rng.random((9, 3)) < 0.7).astype(np.float32), (rng.random((14, 3)) < 0.3).astype(np.float32)
    turned = []
    for prior in (0.1, 0.45, 0.9):

        def loss(z):
            return 1 / (1 + np.exp(z))

        def parts(w):
            z_p, z_u = positive.astype(float) @ w[:-1] + w[-1], unlabelled.astype(float) @ w[:-1] + w[-1]
            toxic = prior * sum(loss(z) for z in z_p) / len(z_p)
            return toxic, sum(loss(-z) for z in z_u) / len(z_u) - prior * sum(loss(-z) for z in z_p) / len(z_p)

        w, first, second = np.array([0.0, 0.0, 0.0, -1.0]), np.zeros(4), np.zeros(4)
        for step in range(1, 41):
            held = parts(w)[1] >= 0
            turned.append(held)

            def risk(v, held=held):
                toxic, clean = parts(v)
                return toxic + clean if held else -clean

            slope = np.array([(risk(w + d) - risk(w - d)) / 2e-6 for d in np.eye(4) * 1e-6])
            slope[:-1] += nnpu_toxicity.DECAY * w[:-1]
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            w = w - nnpu_toxicity.RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = nnpu_toxicity.nnpu(positive, unlabelled, prior, epochs=40)
        assert np.append(weights, bias) == pytest.approx(w, abs=2e-3)
    assert set(turned) == {True, False}
