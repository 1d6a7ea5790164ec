from __future__ import annotations

import math
import random
import time

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import DATA
from userlake.llm import decontaminate as dc
from userlake.llm.queries import registered

ITEMS = "item_id bigint, text string"


def brute(docs, items):
    """doc, item -> item words in windows that are equal in enough places, at any alignment."""
    out, number = {}, {}
    code = lambda ws: np.array([number.setdefault(w, len(number)) for w in ws], np.int64)
    cut = [(i, code(dc.words(t))) for i, t in items]
    for d, text in docs:
        edge = np.full(13, -1)
        ws = np.concatenate([edge, code(dc.words(text)), edge])
        for i, its in cut:
            if len(its) < 5:
                continue
            width = min(13, len(its))
            equal = ws[:, None] == its[None, :]
            rows, columns = len(ws) - width + 1, len(its) - width + 1
            same = sum(equal[k : k + rows, k : k + columns].astype(np.int8) for k in range(width))
            starts = np.flatnonzero((same >= math.ceil(0.8 * width)).any(axis=0))
            if len(starts):
                out[d, i] = (len({q + k for q in starts.tolist() for k in range(width)}), len(its))
    return out


def pairs(df):
    rows = df.collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id): (r.matched_words, r.item_words) for r in rows}


def test_random_texts_equal_brute_force(spark, documents):
    choose = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of"] * 20
    make = lambda n: [choose.choice(vocabulary) for _ in range(n)]
    items = [make(choose.choice([3, 5, 6, 9, 12, 13, 14, 30])) for _ in range(25)]
    docs = []
    for _ in range(60):
        text = make(choose.randrange(60))
        if choose.random() < 0.7:
            item = list(choose.choice(items))
            item = item[choose.randrange(3) :]
            for _ in range(choose.randrange(4)):
                item[choose.randrange(len(item))] = "x"
            at = choose.randrange(len(text) + 1)
            text[at:at] = item
        docs.append(" ".join(text).title())
    bench = spark.createDataFrame([(i, ", ".join(x)) for i, x in enumerate(items)], ITEMS)
    want = brute(list(enumerate(docs)), [(i, " ".join(x)) for i, x in enumerate(items)])
    assert len(want) > 20 and pairs(dc.find_matches(documents(*docs), bench)) == want
    clean = {r.doc_id for r in dc.drop_contaminated(documents(*docs), bench).collect()}
    assert clean == set(range(60)) - {d for d, _ in want}


def test_whole_table_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = pairs(registered()["op7_decontaminate"](spark, DATA))
    assert got and got == brute(docs, items)


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    whole = pairs(dc.find_matches(docs, bench))
    monkeypatch.setattr(dc, "TOGETHER", 300)
    monkeypatch.setattr(dc, "HITS_TOGETHER", 7)
    assert len(list(dc.blocks(bench, 1000))) > 3
    blocks = dc.blocks
    monkeypatch.setattr(dc, "blocks", lambda b: blocks(b, 1000))
    assert pairs(dc.find_matches(docs, bench)) == whole


def test_odd_rows(spark, documents):
    passage = "alpha beta gamma delta epsilon zeta"
    df = documents(None, "", "alpha", passage, f"x {passage} y", "b " * 20_000 + passage)
    df = df.withColumn("item_id", F.lit("clash")).unionByName(df.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("bigint")).withColumn("item_id", F.lit("clash")))
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (4, "alpha beta"), (None, passage)], ITEMS)
    rows = dc.find_matches(df, bench).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in rows) == [(d, 1) for d in (-1, -1, 3, 3, 4, 4, 5, 5)]
    assert {r.first_word for r in rows if r.doc_id == 5} == {20_000}
    kept = dc.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]
    assert dc.find_matches(df, bench.limit(0)).collect() == [] and dc.drop_contaminated(df, bench.limit(0)).count() == 7
    assert dc.find_matches(df.limit(0), bench).collect() == []


def test_an_item_without_id_contaminates_as_any_other(spark, documents):
    passage = "alpha beta gamma delta epsilon zeta"
    df = documents(f"x {passage} y", "eta theta iota kappa lambda", "clean words of no item at all")
    bench = spark.createDataFrame([(None, passage), (1, "eta theta iota kappa lambda")], ITEMS)
    assert [r.doc_id for r in dc.drop_contaminated(df, bench).collect()] == [2]
    assert [(r.doc_id, r.item_id) for r in dc.find_matches(df, bench).collect()] == [(1, 1)]


def test_repeated_words_and_periods_equal_brute_force(spark, documents):
    """Texts and items of one word, of short periods and of runs among other words."""
    docs = ["a " * 60, "a b " * 40, "a b c " * 30, "x " * 9 + "a " * 14 + "y " * 9, "a " * 12, "a a b " * 20, "b " * 25 + "a b " * 10]
    items = ["a " * 30, "a b " * 12, "b " * 13, "a " * 9 + "b " * 9, "a a b c " * 5, "a " * 6]
    bench = spark.createDataFrame(list(enumerate(items)), ITEMS)
    want = brute(list(enumerate(docs)), list(enumerate(items)))
    assert len(want) == 9 and pairs(dc.find_matches(documents(*docs), bench)) == want


def test_very_long_texts_of_one_word():
    finder = dc.Search(dc.Benchmark([(1, ["0"] * 1000), (2, ["0", "1"] * 200)]))
    start = time.monotonic()
    rows = finder.matches(["0 " * 200_000, "0 1 " * 100_000, "2 " * 1000 + "0 " * 100])
    assert time.monotonic() - start < 20
    assert {(d, i): (n, place) for d, i, n, _, place in rows} == {
        (0, 1): (1000, 0), (1, 2): (400, 0), (2, 1): (1000, 998)
    }
