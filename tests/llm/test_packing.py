"""Packing: ids against the tokenizer, plans against their invariants and bounds."""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pytest
from helpers import ODD, frame, texts
from tokenizers import Tokenizer

from streamloader.llm import nnls_packing as op


PLAIN = Tokenizer.from_file(op.TOKENIZER)


def whole_ids(text):
    """By the tokenizer as its file has it."""
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, op.SEPARATOR]


def test_words_give_the_ids_of_whole_texts():
    extra = ["ΣΑΣ ΟΔΟΣ x", "İstanbul ǅ ﬁ", "́a é ̧́", "Ünïcode² ½ µm ªº ÿÿ", "a\x1cb\x85c", "l'été d'un naïf's 'LL"]
    for text in [*ODD, *extra]:
        found = b"".join(op.WordIds().encode([text.encode() if text else None]))
        assert array("I", found).tolist() == whole_ids(text)[:-1], text


def test_marks_of_the_tokenizer_are_single_ids():
    for text in ("a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|>", "A<|ENDOFTEXT|>b <| x", "<|endoftext|"):
        found = next(op.WordIds().encode([text.encode()]))
        assert array("I", found).tolist() == whole_ids(text)[:-1], text
    assert len(whole_ids("a <|endoftext|> b")) == 4


def test_small_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 6)
    words, rows = op.WordIds(), [t.encode() for t in texts() if t] * 2
    assert [array("I", i).tolist() for i in words.encode(rows)] == [whole_ids(t.decode())[:-1] for t in rows]
    assert max(len(words), len(words.older), len(words.parts)) <= 4


def test_words_and_their_parts_share_one_bound(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 100)
    words, rows = op.WordIds(), [f"x{'ab'[k % 2]}{'c' * (k % 7)}{'d' * (k // 7)}.".encode() for k in range(190)]
    assert [array("I", i).tolist() for i in words.encode(rows)] == [whole_ids(t.decode())[:-1] for t in rows]
    held = {id(t): len(t) for t in (words, words.older, words.parts, words.parts.older)}
    assert sum(held.values()) <= 100


@pytest.mark.parametrize(
    "lengths",
    [
        [1], [4096] * 3, [7] * 1000, [2100, 4000] * 50, list(range(1, 4097)),
        np.random.default_rng(1).integers(1, 60, 4000).tolist(),
        np.random.default_rng(2).integers(1000, 1500, 3000).tolist(),
        np.random.default_rng(3).gamma(2, 300, 20000).astype(int).clip(1, 4096).tolist(),
    ],
)
def test_plan_places_every_piece_once_and_wastes_little(lengths):
    histogram = np.bincount(lengths, minlength=4097)
    plan = op.Plan(histogram)
    placed = []
    for length in np.flatnonzero(histogram):
        n = histogram[length]
        sequence, offset = plan.place(np.full(n, length), np.arange(n))
        placed += zip(sequence.tolist(), offset.tolist(), [int(length)] * n, strict=True)
    at = {}
    for sequence, offset, length in sorted(placed):
        assert offset == at.get(sequence, 0)
        at[sequence] = offset + length
    assert max(at.values()) <= 4096 and sorted(at) == list(range(plan.sequences))
    assert plan.sequences <= first_fit_decreasing(lengths) * 1.01 + 1


def first_fit_decreasing(lengths):
    rooms = np.full(len(lengths), 4096)
    for length in sorted(lengths, reverse=True):
        rooms[int(np.argmax(rooms >= length))] -= length
    return int((rooms < 4096).sum())


def test_patterns_fill_the_sequence():
    histogram = np.zeros(101, dtype=int)
    histogram[[100, 60, 40, 30, 10]] = 5
    rows = {tuple(r) for r in op.patterns(histogram).tolist()}
    assert {(100, 0, 0), (60, 40, 0), (60, 30, 10), (40, 30, 30)} <= rows and all(sum(r) == 100 for r in rows)


def test_pack_cuts_only_long_documents(spark):
    found = op.pack(frame(spark, texts())).collect()
    by_text = {}
    for k, text in enumerate(texts()):
        by_text[k] = whole_ids(text)
    by_text[None] = by_text[len(texts()) - 1]
    seen, ends = {}, {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        own = by_text[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(array("I", own).tobytes()) == r.ids_crc32 and len(own) == r.length
        assert r.length == 4096 or r.start + r.length == len(by_text[r.doc_id])
        assert r.offset == ends.get(r.sequence_id, 0) and r.offset + r.length <= 4096
        ends[r.sequence_id] = r.offset + r.length
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    twice = {0: 2}
    assert seen == {k: len(v) * twice.get(k, 1) for k, v in by_text.items()}
    assert len(ends) <= sum(seen.values()) / 4096 * 1.02 + 2
    assert op.pack(frame(spark, texts()).limit(0)).count() == 0
