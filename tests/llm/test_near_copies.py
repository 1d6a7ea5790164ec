from __future__ import annotations

import random

import numpy as np
import pytest

from tests.conftest import DATA
from tests.llm.conftest import plan_of, rows_by
from userlake.llm import components, near_copies, simhash
from userlake.llm.near_copies import band_keys, keep_one_of_each, near_copy_groups, shingle_hashes
from userlake.llm.simhash import bits_of_majority


def slow_shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def similar(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b) > 0


def slow_groups(texts):
    """doc -> smallest doc reachable over pairs of texts that share four fifths of their shingles."""
    sets = {i: slow_shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = list(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            small, large = sorted((len(sets[i]), len(sets[j])))
            if 10 * small >= 8 * large and similar(sets[i], sets[j]):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = slow_groups({r.doc_id: r.text for r in docs.collect()})
    got = rows_by(near_copy_groups(docs))
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(want)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_near_copies_of_many_texts_are_found(spark, documents):
    """Texts of 80 to 400 words with one edit in 40 words: recall against brute force, and nothing beyond it."""
    rng = random.Random(3)
    texts = []
    for k in range(60):
        words = [f"t{k}w{rng.randrange(300)}" for _ in range(rng.randrange(80, 400))]
        texts += [" ".join(words), edited(rng, words, len(words) // 40), edited(rng, words, len(words) // 40), edited(rng, words, len(words) // 8)]
    want = slow_groups(dict(enumerate(texts)))
    got = {i: r.component_id for i, r in rows_by(near_copy_groups(documents(*texts))).items()}
    pairs = [(i, j) for i in got for j in range(i) if want[i] == want[j]]
    found = sum(got[i] == got[j] for i, j in pairs)
    assert len(pairs) >= 60 and found >= 0.95 * len(pairs)
    assert all(want[i] == want[g] for i, g in got.items())


def test_one_group_of_very_many_near_copies(spark, documents):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    texts = [edited(rng, words, 1) for _ in range(400)] + [" ".join(words)] * 200 + [f"other {i} text of its own here" for i in range(50)]
    got = rows_by(near_copy_groups(documents(*texts)))
    assert {got[i].component_id for i in range(600)} == {0}
    assert [got[i].component_id for i in range(600, 650)] == list(range(600, 650))


def test_candidates_grow_with_the_nodes_only(spark):
    """A band that all nodes share makes three candidates of each."""
    nodes = spark.createDataFrame([(i, [7]) for i in range(1000)], "node bigint, bands array<bigint>")
    pairs = near_copies.band_candidates(nodes)
    assert pairs.count() <= 3000 and {r.v for r in pairs.collect()} >= {0}


def test_odd_rows(spark, documents):
    texts = [None, "", " \n", "one", "ONE", "a b c d", "a b c d e", "a b c d e " * 4000, "A b  c d e " * 4000]
    df = documents(*texts)
    for name in ("fp", "node", "bands", "component_id"):
        df = df.selectExpr("*", f"'x' AS {name}")
    got = {i: r.component_id for i, r in rows_by(near_copy_groups(df)).items()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 7}
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3, 5, 6, 7]


def test_repeated_rows_null_ids_and_an_empty_table(documents):
    df = documents("b c d e f", "b c d e f", "x y z v w").selectExpr("nullif(doc_id, 2) AS doc_id", "text", "lang", "source", "n_chars")
    other = df.where("doc_id = 0").selectExpr("doc_id", "'a b c d e' AS text", "lang", "source", "n_chars")
    kept = keep_one_of_each(df.unionByName(df).unionByName(other))
    # Two rows without an id stay; of the rows of document 0 that with the smallest text.
    assert sorted((r.doc_id is None, r.text) for r in kept.collect()) == [(False, "a b c d e"), (True, "x y z v w"), (True, "x y z v w")]
    assert keep_one_of_each(df.limit(0)).collect() == near_copy_groups(df.limit(0)).collect() == []


@pytest.mark.parametrize("similarity", [0.8, 0.9])
def test_pairs_share_a_band(similarity):
    rng = np.random.default_rng(int(100 * similarity))
    shared = 0
    for _ in range(200):
        both = rng.integers(0, 2**63, int(200 * similarity), dtype=np.uint64)
        rest = rng.integers(0, 2**63, 200 - len(both), dtype=np.uint64)
        half = len(rest) // 2
        a, b = np.concatenate([both, rest[:half]]), np.concatenate([both, rest[half:]])
        shared += bool(set(band_keys(np.unique(a))) & set(band_keys(np.unique(b))))
    assert shared >= 0.97 * 200


def test_bands_of_long_texts_are_those_of_their_parts():
    text = " ".join(f"w{i}" for i in range(30_000))
    assert len(band_keys(np.unique(shingle_hashes(text)))) == near_copies.BANDS and band_keys(np.empty(0, np.uint64)) == []


def crowded_texts(seed, count):
    """Texts of one origin that mostly differ in over a fifth of their shingles, and of each a second of another fifth."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(count):
        first = edited(rng, words, rng.randrange(1, 4)).split()
        texts += [" ".join(first), edited(rng, first, 1)]
    return texts


def groups_over_bands(texts):
    """doc -> smallest doc reachable over all pairs that share a band or a fingerprint and four fifths of their shingles."""
    hashes = {i: shingle_hashes(t) for i, t in enumerate(texts)}
    sets = {i: set(h.tolist()) for i, h in hashes.items()}
    bands = {i: {*band_keys(np.unique(h)), ("fp", bits_of_majority(h))} for i, h in hashes.items()}
    label = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            if label[i] != label[j] and bands[i] & bands[j] and similar(sets[i], sets[j]):
                a, b = label[i], label[j]
                label.update({k: min(a, b) for k, x in label.items() if x == max(a, b)})
    return label


def test_no_pair_of_a_crowded_band_is_dropped(spark, documents):
    """Bands of very many nodes, few of which are near-copies of the three that all are compared with."""
    texts = crowded_texts(5, 500)
    got = {i: r.component_id for i, r in rows_by(near_copy_groups(documents(*texts))).items()}
    assert got == groups_over_bands(texts)


def test_the_rest_of_a_band_is_compared_whole(spark):
    """One band of 600 nodes in 300 pairs, 200 of another component: links of all pairs, none within a component."""
    sets = [(i, [1000 * (i // 2) + k + (i % 2) for k in range(30)]) for i in range(600)] + [(i, [-i]) for i in range(600, 800)]
    nodes = spark.createDataFrame([(i, [7, 7, 8]) for i, _ in sets], "node bigint, bands array<bigint>")
    shingles = spark.createDataFrame(sets, "node bigint, shingles array<bigint>")
    labels = spark.createDataFrame([(i, 600) for i in range(600, 800)] + [(0, 0), (1, 0)], "node bigint, component bigint")
    compared = {r.other for r in near_copies.with_stars(nodes.selectExpr("node", "explode(bands) AS key")).selectExpr("explode(others) AS other").collect()}
    links = {(min(r), max(r)) for r in near_copies.rest_links(nodes, labels, shingles).collect()}
    # The three of band 7 and of band 8 were compared with all of them before.
    want = {(i, i + 1) for i in range(2, 600, 2)}
    assert links <= want and all(compared & set(pair) for pair in want - links)


def test_what_grows_with_the_documents_is_never_broadcast(documents, plans):
    made = plans(near_copies, simhash, components)
    words = " ".join(f"w{k}" for k in range(60))
    made.append(plan_of(keep_one_of_each(documents(words, words, f"{words} x", "other words"))))
    assert sum(plan.count("SortMergeJoin") for plan in made) >= 20  # candidates, sets, links, rest, stars, results
    assert not any("Broadcast" in plan for plan in made)
