"""The manifest against trees built in plain Python."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from helpers import SCHEMA, frame, texts

from streamloader.llm import merkle_manifest


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(hashes):
    return [digest(*hashes[k : k + 3]) for k in range(0, len(hashes), 3)]


def climbed(hashes, at, folded):
    """Root, folded root and siblings of one leaf of a tree."""
    proof = []
    while len(hashes) > 1:
        run = at - at % 3
        before, after = hashes[run:at], hashes[at + 1 : run + 3]
        proof += before + after
        folded = digest(*before, folded, *after)
        hashes, at = up(hashes), at // 3
    return hashes[0], folded, proof


def brute(rows):
    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = digest(*map(field, (doc_id, source, lang, n_chars, text)))
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        broken = digest(*map(field, (doc_id, source, lang, n_chars, text.replace("\n", "")))) if hit else leaf
        trees[source].append(((doc_id is not None, doc_id, leaf), doc_id, leaf, broken))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for own in trees.values():
        own.sort(key=lambda r: (r[0][0], r[0][1] or 0, r[0][2]))
    tops = [climbed([r[2] for r in trees[s]], 0, "")[0] for s in order]
    out = []
    for rank, s in enumerate(order):
        hashes = [r[2] for r in trees[s]]
        for at, (_, doc_id, leaf, broken) in enumerate(trees[s]):
            subroot, folded, low = climbed(hashes, at, broken)
            root, folded, high = climbed(tops, rank, folded)
            out.append((doc_id, leaf, subroot, root, "".join(low + high), folded, folded == root))
    return out


def found(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified")
    return [tuple(r[n].hex() if isinstance(r[n], (bytes, bytearray)) else r[n] for n in names) for r in merkle_manifest.manifest(df).collect()]


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_equals_plain_trees_with_nulls_repeats_and_clashing_columns(spark):
    """Null ids, sources and texts, repeated rows, a very long text, columns with names that the operator uses."""
    df = frame(spark, texts() + [f"{k}\n{k}" for k in range(8)]).withColumnRenamed("body", "tree").withColumnRenamed("c", "pos").withColumnRenamed("fp", "leaf")
    got = found(df)
    assert Counter(got) == Counter(brute(plain(df)))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("many, sources", [(1, 1), (82, 1), (400, 3), (95, 95)])
def test_every_shape_of_tree(spark, many, sources):
    """Lone leaves, runs of one at the end of a level, blocks that are full, and more sources than a block has places."""
    rows = [(k * 7 % many, f"a{k}\nb", "en", f"s{k % sources}", k, *["x"] * 8) for k in range(many)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(found(df)) == Counter(brute(plain(df)))


def test_hot_block_is_salted(spark, monkeypatch):
    """With few leaves to a join key, blocks near the root are stored many times, and the proofs stay the same."""
    df = spark.createDataFrame([(k, f"t\n{k}", None, "hot" if k % 9 else f"s{k}", 1, *["x"] * 8) for k in range(400)], SCHEMA)
    expected = Counter(brute(plain(df)))
    monkeypatch.setattr(merkle_manifest, "SMALL", 0)
    monkeypatch.setattr(merkle_manifest, "SPREAD", 5)
    assert Counter(found(df)) == expected
    monkeypatch.setattr(merkle_manifest, "SMALL", 1)
    assert Counter(found(df)) == expected


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
