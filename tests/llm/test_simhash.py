from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.conftest import plan_of, rows_by
from userlake.llm import components as component_links, simhash
from userlake.llm.components import components
from userlake.llm.queries import registered


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w.decode() for w in lowered.encode().split()]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 0))] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """doc -> smallest doc reachable over links of two bits at most."""
    ids, values = list(prints), np.array(list(prints.values()), np.uint64)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 2):
            a, b = root(i), root(ids[j])
            label[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_whole_table_equals_brute_force(spark):
    prints = {r.doc_id: slow_fingerprint(r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = rows_by(registered()["op3_simhash"](spark, DATA))
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)
    assert len(set(brute_components(prints).values())) < len(prints)


def clusters(count, seed):
    choose, prints = random.Random(seed), {}
    while len(prints) < count:
        value = choose.getrandbits(64)
        for _ in range(choose.randrange(1, 40)):
            prints[len(prints)] = value
            value ^= 1 << choose.randrange(64)
            if choose.random() < 0.5:
                value ^= 1 << choose.randrange(64)
    return prints


def test_links_connect_exactly_what_is_within_two_bits(spark):
    for seed, limit in ((1, 64), (2, 3), (3, 0)):
        prints = {p: i for i, p in reversed(clusters(150, seed).items())}
        prints = {i: p for p, i in prints.items()}
        signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
        links = simhash.fingerprint_links(spark.createDataFrame(signed, "node bigint, fp bigint"), limit)
        for r in links.collect():
            assert (prints[r.u] ^ prints[r.v]).bit_count() <= 2
        got = {i: i for i in prints} | {r.node: r.component for r in components(links).collect()}
        assert got == brute_components(prints)


def test_odd_texts(documents):
    texts = [None, "", " \n ", "one", "ONE", "one two", "one\ttwo", "É é", "é É", "a b c " * 30_000, "A b  c " * 30_000]
    df = documents(*texts).withColumn("fp", F.lit("x")).withColumn("node", F.lit(1))
    got = rows_by(simhash.near_duplicates(df))
    assert [int(got[i].fingerprint, 16) for i in range(len(texts))] == [slow_fingerprint(t) for t in texts]
    assert [got[i].component_id for i in (0, 1, 2, 3, 4, 5, 6, 9, 10)] == [0, 0, 0, 3, 3, 5, 5, 9, 9]
    assert got[0].fingerprint == "0" * 16
    kept = simhash.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in got.values()})


def test_repeated_rows_null_ids_and_an_empty_table(spark, documents):
    df = documents("a b c d", "a b c d", "x y z").withColumn("doc_id", F.expr("nullif(doc_id, 2)"))
    df = df.unionByName(df)
    got = simhash.near_duplicates(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0) for r in got) == [
        (False, 0, 0), (False, 0, 0), (False, 1, 0), (False, 1, 0), (True, 0, 0), (True, 0, 0)
    ]
    assert sorted(r.text for r in simhash.keep_one_of_each(df).collect()) == ["a b c d", "x y z", "x y z"]
    assert simhash.near_duplicates(df.limit(0)).collect() == simhash.keep_one_of_each(df.limit(0)).collect() == []
    assert components(spark.createDataFrame([(1, 1)], "u bigint, v bigint")).collect() == []


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "u bigint, v bigint")
    assert {r.component for r in components(links).collect()} == {0}


def test_what_grows_with_the_documents_is_never_broadcast(documents, plans):
    """Spark sizes a table too low after an explode, so what it would broadcast of a small input it may of a large one."""
    made = plans(simhash, component_links)
    made.append(plan_of(simhash.near_duplicates(documents("a b c d", "a b c d", "x y z"))))
    assert sum(plan.count("SortMergeJoin") for plan in made) >= 7  # variants, both kinds of links, stars, results
    assert not any("Broadcast" in plan for plan in made)
