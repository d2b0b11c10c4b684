"""SimHash and product quantisation against all pairs, on small tables."""

from __future__ import annotations

import os
import random
import re
from itertools import combinations

import numpy as np
import xxhash
from helpers import frame, sentence, texts

import corpus_pipeline
from streamloader.llm import pq_neardup, shingle_join, simhash_bktree
from streamloader.llm.common import shared_dir, temporary
from streamloader.llm.components import components


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(ids, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark):
    rng = random.Random(4)
    base = sentence(rng, 400)
    near = [base.replace(" ", "  ", k).upper() if k % 2 else f"{base} word{k}" for k in range(12)]
    rows = texts() + near + ["", None]
    df = frame(spark, rows)
    found = {r.doc_id: r for r in simhash_bktree.near_duplicates(df).collect() if r.doc_id is not None}
    prints = {k: brute_print(t) for k, t in enumerate(rows)}
    assert {k: r.fp % (1 << 64) for k, r in found.items()} == prints
    wanted = brute_components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {k: r.component_id for k, r in found.items()} == wanted
    assert all(r.kept == (r.component_id == k) for k, r in found.items())
    assert simhash_bktree.near_duplicates(df.limit(0)).count() == 0


def test_bk_tree_finds_what_a_scan_finds():
    rng = random.Random(5)
    values = {rng.getrandbits(12) for _ in range(600)}
    tree = simhash_bktree.BKTree()
    for v in [*values, *list(values)[:9]]:
        tree.add(v)
    for _ in range(50):
        q = rng.getrandbits(12)
        assert sorted(tree.within(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)


def test_links_of_shards_cut_into_many_trees(spark):
    """Many fingerprints share blocks, and trees hold three only."""
    rng = random.Random(6)
    prints = sorted({rng.choice([0, 7 << 40, -1 << 50]) ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)) for _ in range(150)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(3)
    links = simhash_bktree.links(df, tree_nodes=3)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in links.collect())
    found = {r.id: r.root for r in components(links).collect()}
    wanted = brute_components(prints, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    assert {p: found.get(p, p) for p in prints} == wanted


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 30)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (5, 4)], "a long, b long").repartition(4)
    found = {r.id: r.root for r in components(df).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}
    assert components(df.limit(0)).count() == 0


def vectors_of(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, label int, m string, cell string, code string, links string"
    ).repartition(3)


def test_product_quantisation_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 12))
    made = [(centres[k % 6] + rng.normal(size=12) * (0.05 + 0.3 * (k % 4))).astype(float).tolist() for k in range(260)]
    made += [made[3], made[3], [2 * x for x in made[4]], [1e-30 * x for x in made[5]]]
    odd = [None, [0.0] * 12, [float("nan")] * 12, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, []]
    rows = [(k, v, k % 3 if k % 17 else None, *["x"] * 4) for k, v in enumerate(made + odd)]
    rows += [(None, made[0], 0, *["x"] * 4), (1, *rows[1][1:])]
    fit = {}
    for k, (i, v, label, *_) in enumerate(rows):
        if i is not None and label is not None and v and len(v) == 12 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            single = np.array(v, dtype=np.float32).astype(float)
            fit[k] = (label, single / np.linalg.norm(single), i)

    def linked(a, b):
        return fit[a][0] == fit[b][0] and fit[a][1] @ fit[b][1] >= 0.93

    links = {k: sum(linked(k, j) for j in fit if j != k) for k in fit}
    roots = brute_components(list(fit), linked)
    least = {}
    for k in fit:
        least[roots[k]] = min(least.get(roots[k], fit[k][2]), fit[k][2])
    wanted = sorted((i, links.get(k, 0), least[roots[k]] if k in fit else i) for k, (i, *_) in enumerate(rows) if i is not None)
    df = vectors_of(spark, rows)
    for block in (2048, 7):
        found = pq_neardup.near_duplicates(df, block=block).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id is not None) == wanted
        assert [(r.n_links, r.component_id, r.kept) for r in found if r.vec_id is None] == [(0, None, True)]
    assert pq_neardup.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_every_length_and_doubles(spark):
    """Lengths one, two, three and nine beside each other, doubles that as floats would be equal, labels as text."""
    rng = np.random.default_rng(10)
    made = [rng.normal(size=size).tolist() for size in (3, 2, 9, 1, 2, 3, 3) for _ in range(24)]
    made += [made[1], [3 * x for x in made[30]], [1.0, 0.0], [1.0, 0.0, 0.0], [0.93, (1 - 0.93**2) ** 0.5], [0.93, (1 - 0.93**2) ** 0.5 + 1e-12]]
    rows = [(k, v, f"l{k % 2}") for k, v in enumerate(made)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    unit = [np.array(v) / np.linalg.norm(v) for v in made]

    def linked(a, b):
        return a % 2 == b % 2 and len(made[a]) == len(made[b]) and unit[a] @ unit[b] >= 0.93

    roots = brute_components(range(len(made)), linked)
    wanted = {k: (sum(linked(k, j) for j in range(len(made)) if j != k), roots[k]) for k in range(len(made))}
    found = pq_neardup.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == wanted


def test_no_pair_across_wide_lists_is_missed(spark):
    """Vectors in two dimensions: differences of near copies lie along the normals of the planes between lists."""
    rng = np.random.default_rng(9)
    made = rng.normal(size=(300, 2)).astype(np.float32)
    unit = made.astype(float) / np.linalg.norm(made.astype(float), axis=1)[:, None]
    wanted = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    df = vectors_of(spark, [(k, v.tolist(), 0, *["x"] * 4) for k, v in enumerate(made)])
    for max_lists in (6, 8, 10):
        found = {r.vec_id: r.n_links for r in pq_neardup.near_duplicates(df, max_lists=max_lists).collect()}
        assert [found[k] for k in range(len(made))] == wanted.tolist()


def shingles_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_links_edited_copies_like_all_pairs(spark):
    """Copies with some words replaced, on both sides of similarity 0.8, beside a passage that many texts share."""
    rng = random.Random(12)
    many = " ".join(f"w{k}" for k in range(500))
    passage = sentence(rng, 40, many)
    rows = texts(many=15)
    for k in range(16):
        base = sentence(rng, rng.choice([40, 100, 400]), many).split()
        rows.append(" ".join(base))
        for _ in range(5):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, len(copy) * rng.randint(1, 5) // 100)):
                copy[at] = f"new{rng.random()}"
            rows.append(" ".join(copy) + (f" {passage}" if k % 4 == 0 else ""))
    sets = [shingles_of(t) for t in rows]

    def linked(a, b):
        union = len(sets[a] | sets[b])
        return not union or len(sets[a] & sets[b]) * 5 >= union * 4

    wanted = brute_components(range(len(rows)), linked)
    df = frame(spark, rows)
    for block_texts in (shingle_join.BLOCK_TEXTS, 3):
        found = shingle_join.near_duplicates(df, block_texts=block_texts).collect()
        assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == wanted
        assert all(r.kept == (r.component_id == r.doc_id) for r in found if r.doc_id is not None)
        assert len(found) == df.count() and shingle_join.near_duplicates(df.limit(0)).count() == 0
    left = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect() if r.doc_id is not None}
    assert left == set(wanted.values())


def test_what_meets_in_one_place_needs_no_rounds(spark, monkeypatch):
    """Links inside blocks, and between parts that meet in one place, are joined there; rounds over the table have a task a partition each."""
    rng = random.Random(13)
    base = sentence(rng, 300, " ".join(f"w{k}" for k in range(400))).split()
    rows = [" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(20)] + ["other words", None]
    called = []
    monkeypatch.setattr(shingle_join, "components", lambda links: called.append(links) or components(links))
    found = shingle_join.near_duplicates(frame(spark, rows), block_texts=3).collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == {k: 0 if k < 20 else k for k in range(22)}
    assert len(called) == 2


def test_parts_take_the_smallest_label_they_reach():
    sets = [np.arange(k, k + 40) for k in (0, 1, 2, 500, 501, 900)]
    assert shingle_join.group_links(sets, [7, 3, 5, 9, 8, 1], [0] * 6, 0.8) == [(5, 3), (7, 3), (9, 8)]
    # Texts of one block were compared before.
    assert shingle_join.group_links(sets, [7, 3, 5, 9, 8, 1], [0, 0, 1, 0, 0, 0], 0.8) == [(5, 3), (7, 3)]


def test_bands_find_pairs_at_the_threshold():
    """Of 3,000 pairs of sets at similarity 0.8 none is missed; of unrelated sets hardly one is proposed."""
    rng = np.random.default_rng(5)
    missed = proposed = 0
    for _ in range(3000):
        made = rng.integers(-(1 << 63), 1 << 63, 120)
        a, b, other = np.sort(made[:90]), np.sort(made[10:100]), np.sort(made[100:])
        assert len(np.intersect1d(a, b)) * 5 == len(np.union1d(a, b)) * 4
        keys = set(shingle_join.band_keys(a))
        missed += not keys & set(shingle_join.band_keys(b))
        proposed += bool(keys & set(shingle_join.band_keys(other)))
    assert missed == 0 and proposed == 0


def test_different_texts_of_one_id_and_copies_of_one_text(spark):
    """A repeated row leaves one row; two texts of one id that are not similar both stay; null ids stay."""
    one, two = (sentence(random.Random(k), 60, " ".join(f"w{k}{j}" for j in range(300))) for k in (1, 2))
    df = spark.createDataFrame([(1, one), (1, one), (1, two), (2, two), (None, one), (None, one)], "doc_id long, text string")
    df = df.selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    left = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, df, "").collect()), key=repr)
    assert left == sorted([(1, one), (1, two), (None, one), (None, one)], key=repr)


def test_no_checkpoint_outlives_its_scope(spark):
    df = frame(spark, texts(many=20))
    folder = shared_dir(spark)

    def parts():
        return {f"{d}/{n}" for d, names, _ in os.walk(folder) for n in names if n.startswith("rdd-")}

    before = parts()
    with temporary(spark):
        corpus_pipeline.near_dedup(spark, df, "").collect()
        assert parts() != before
    assert parts() == before


def test_fingerprints_propose_pairs_for_the_stage(spark, monkeypatch):
    """Fingerprints within two bits are tied; the stage asks for those of every text and lets the sets decide."""
    prints = [(1, 0b1011), (2, 0b1011), (3, 0b1000), (4, 1 << 40), (5, -1), (6, -1 ^ 1 << 62)]
    tied = shingle_join.fingerprint_ties(spark.createDataFrame(prints, "h long, fp long")).collect()
    assert {frozenset(r) for r in tied} == {frozenset(p) for p in ((1, 2), (1, 3), (3, 4), (5, 6))}
    asked, ties = [], shingle_join.fingerprint_ties

    def unlike(found):
        asked.extend(r.fp for r in found.collect())
        ties(found)
        # All texts as one candidate group: what is not similar stays all the same.
        return shingle_join.cut(found.selectExpr("h AS a", "min(h) OVER () AS b"))

    monkeypatch.setattr(shingle_join, "fingerprint_ties", unlike)
    one, two = (sentence(random.Random(k), 60, " ".join(f"w{k}{j}" for j in range(300))) for k in (1, 2))
    rows = [one, one + " more", two, None]
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect()} == {None, 0, 2, 3}
    assert set(asked) == {simhash_bktree.fingerprint((t or "").encode(), 5) for t in rows}
