from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from userlake.llm.filter_audit import A, B, C, D, E, audit_filters, changes_of_text, count_documents, failed_filters

DOCUMENTS = "doc_id bigint, text string, lang string"
LABELS = "doc_id bigint, quality int, toxic int"
ORDERS = ["".join(p) for p in permutations("ABCDE")]


def slow_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        (A if len(words) < 100 else 0)
        | (B if 100 * len(set(words)) < 80 * len(words) else 0)
        | (C if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else 0)
        | (D if re.search(r"[#$%&*|]", text) else 0)
    )


def brute(docs, labels):
    """Run every order document by document."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, tox in labels if tox == 1 and i is not None}
    masks = []
    for doc_id, text, lang in docs:
        text = text or ""
        repeat = any((t or "") == text and i is not None and doc_id is not None and i < doc_id for i, t, _ in docs)
        masks.append((lang or "", slow_mask(text) | (E if repeat else 0), doc_id in good, doc_id in toxic))
    out = {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        shapley = Counter()
        for order in ORDERS:
            alive = list(mine)
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                gone = [m for m in alive if m[1] & bit]
                alive = [m for m in alive if not m[1] & bit]
                shapley[name] += len(gone)
                out[part, order, step] = [
                    len(alive), len(gone), sum(1 for m in mine if m[1] & bit) - len(gone),
                    sum(1 for m in mine if m[1] == bit), sum(m[2] for m in gone), sum(m[3] for m in gone),
                ]
        for order in ORDERS:
            for step, name in enumerate(order, 1):
                out[part, order, step].append(shapley[name])
    return out


def rows_of(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in df.collect()}


def texts(rng):
    prose = " ".join(f"word{rng.randrange(500)}" for _ in range(150))
    return [None, "", "short", prose, prose + " #", "Aa " * 200, "SHOUT " * 30, " ".join(f"w{i}" for i in range(120)), "é" * 300]


def random_documents(seed, n=120):
    rng = random.Random(seed)
    pool = texts(rng)
    docs = [(rng.randrange(n) if rng.random() < 0.9 else None, rng.choice(pool), rng.choice(["en", "de", None])) for _ in range(n)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)] + [(2, 1, 1), (None, 1, 1)]
    return docs + docs[:3], labels


def write_files(spark, docs, folder, pieces, schema=DOCUMENTS):
    """One file for each piece, in the given order of arrival."""
    for k in range(pieces):
        spark.createDataFrame(docs[k::pieces], schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.mark.parametrize("seed,pieces,micro_batches", [(1, 1, 4), (2, 6, 3), (3, 4, 4)])
def test_equals_brute_force(spark, tmp_path, seed, pieces, micro_batches):
    docs, labels = random_documents(seed)
    folder = write_files(spark, docs, str(tmp_path / "documents.parquet"), pieces)
    found = audit_filters(spark, folder, spark.createDataFrame(labels, LABELS), micro_batches)
    assert rows_of(found) == brute(docs, labels)


def test_smaller_id_in_a_later_batch_retracts_the_first(spark, tmp_path):
    # Ids that a double cannot tell apart.
    docs = [(2**60 + i, "same text", "en" if i % 2 else "de") for i in (9, 7, 8, 3, 5, 1)] + [(None, "other", None)]
    folder = write_files(spark, docs, str(tmp_path / "documents.parquet"), len(docs))
    counters = count_documents(spark, folder, spark.createDataFrame([], LABELS), micro_batches=len(docs))
    have = {(r["part"], r["mask"]): r["n"] for r in counters.collect() if r["n"]}
    assert have == {("en", A | E): 4, ("en", A): 1, ("de", A | E): 1, ("", A): 1}


def test_many_copies_in_many_partitions(spark, tmp_path):
    docs = [(i, "copy", "en") for i in range(400)] + [(1000 + i, f"other {i}", "en") for i in range(100)]
    folder = str(tmp_path / "documents.parquet")
    spark.createDataFrame(docs, DOCUMENTS).repartition(16).write.parquet(folder)
    have = {r["mask"]: r["n"] for r in count_documents(spark, folder, spark.createDataFrame([], LABELS)).collect() if r["n"]}
    assert have == {A: 101, A | E: 399}


def test_empty_table_and_further_columns(spark, tmp_path):
    wide = DOCUMENTS + ", part string, mask int, good string, n int, text_key string"
    labels = spark.createDataFrame([(1, 1, 0, "x")], LABELS + ", part string")
    spark.createDataFrame([], wide).write.parquet(str(tmp_path / "none"))
    assert audit_filters(spark, str(tmp_path / "none"), labels).count() == 0
    docs = [(1, "a b", "en"), (2, "a b", "en"), (None, "a b", None)]
    folder = write_files(spark, [(*d, "p", 1, "g", 2, "k") for d in docs], str(tmp_path / "some"), 1, wide)
    assert rows_of(audit_filters(spark, folder, labels)) == brute(docs, [(1, 1, 0)])


@pytest.mark.parametrize("seed", range(5))
def test_changes_sum_to_the_final_counts_in_any_order(seed):
    rng = random.Random(seed)
    arrivals = [(False, rng.randrange(6), rng.choice("pq"), A, rng.random() < 0.5, False, rng.randrange(1, 4)) for _ in range(12)]
    state, total = None, Counter()
    while arrivals:
        batch, arrivals = arrivals[:3], arrivals[3:]
        state, changes = changes_of_text(state, batch)
        for *what, n in changes:
            total[tuple(what)] += n
    rng = random.Random(seed)
    arrivals = [(False, rng.randrange(6), rng.choice("pq"), A, rng.random() < 0.5, False, rng.randrange(1, 4)) for _ in range(12)]
    least, want = min(a[1] for a in arrivals), Counter()
    for _, doc_id, part, mask, good, toxic, n in arrivals:
        want[part, mask if doc_id == least else mask | E, good, toxic] += n
    assert +total == want and not -total


@pytest.mark.parametrize("text", ["", "  \x1c\x85 a", "ÀÉ A" * 9, "a b " * 120, "x" * 300_000, "A|b"])
def test_masks_of_odd_texts(text):
    assert failed_filters(text) == slow_mask(text)
