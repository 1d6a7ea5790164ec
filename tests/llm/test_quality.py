from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_by
from userlake.llm import quality


def brute(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def texts():
    choose = random.Random(5)
    yield from [None, "", " \t\n", "one", "one two", "a b c a b c", "a a a a a", "x\x0by\x0cz\r\nx y z", "    é # *"]
    yield "l one\nl one\n \nl one\n\n"
    yield "w" * 5000 + " " + "v " * 3000
    for n in (5, 40, 300):
        yield " ".join(choose.choice("abcd") for _ in range(n))


def test_figures_equal_brute_force(documents):
    given = list(texts())
    got = rows_by(quality.with_metrics(documents(*given)))
    assert [tuple(got[i][m] for m in quality.METRICS) for i in range(len(given))] == [brute(t) for t in given]


def test_windows_of_equal_hash_are_told_apart(documents, monkeypatch):
    monkeypatch.setattr(quality, "_hash_of", lambda key: F.lit(0).cast("bigint"))
    given = list(texts())
    got = rows_by(quality.with_metrics(documents(*given)))
    assert [got[i]["n_repeat_words"] for i in range(len(given))] == [brute(t)[-1] for t in given]


def test_a_failing_host_takes_its_documents_along(spark, documents):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [("short", "bad")] * 30 + [(good, "bad")] + [(good, f"h{i % 5}") for i in range(50)] + [("x", None), (good, None)]
    got = rows_by(quality.judge(documents(*rows)))
    assert not got[30]["base_failed"] and not got[30]["kept"]
    assert all(got[i]["kept"] for i in range(31, 81))
    assert not got[81]["kept"] and got[82]["kept"]
    kept = quality.keep_good(documents(*rows).withColumn("n_words", F.lit(7)).withColumn("_host", F.lit("x")))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(31, 81), 82]
    assert {(r.n_words, r._host) for r in kept.collect()} == {(7, "x")}
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "_host"]


def test_an_empty_table_and_repeated_rows(documents):
    assert quality.judge(documents("x").limit(0)).collect() == []
    assert quality.keep_good(documents("x").limit(0)).collect() == []
    twice = documents("x", "y").withColumn("doc_id", F.lit(1).cast("bigint"))
    assert quality.judge(twice).count() == 2


@pytest.mark.parametrize("rates", [[], [(5, 5)], [(10, 0), (10, 10)], [(10, 2), (1000, 200)]])
def test_prior_is_always_proper(spark, rates):
    hosts = spark.createDataFrame([(str(i), n, f) for i, (n, f) in enumerate(rates)], "host string, n bigint, failed bigint")
    prior = quality.fit_prior(hosts)
    assert prior.alpha >= 0 and prior.beta >= 0 and prior.alpha + prior.beta > 0


def test_hosts_of_one_document_are_shrunk(documents):
    """One in eight of a thousand small hosts fails: neither these nor a host with two failures of three fall."""
    good = " ".join(f"w{i}" for i in range(60))
    rows = [("x" if i % 8 == 0 else good, f"one{i}") for i in range(1000)] + [("x", "small"), ("x", "small"), (good, "small")]
    rows += [("x", "large")] * 90 + [(good, "large")] * 10
    got = rows_by(quality.judge(documents(*rows)))
    assert got[1002]["kept"] and not got[1001]["kept"]
    assert not any(got[i]["kept"] for i in range(1003, 1103))
    assert all(got[i]["kept"] == (i % 8 != 0) for i in range(1000))


@pytest.mark.parametrize("bad", [" #### " * 3, "\nsame line" * 40])
def test_each_rule_can_reject_a_host(documents, bad):
    """Documents that pass the base rules, of a host that is full of symbols or of repeated lines."""
    words = [" ".join(f"w{k}x{i}" for i in range(100)) for k in range(60)]
    rows = [(f"{w}{bad}", "bad") for w in words[:20]] + [(w, "bad") for w in words[20:22]] + [(w, f"h{k % 4}") for k, w in enumerate(words[22:])]
    got = rows_by(quality.judge(documents(*rows)))
    assert not any(got[i]["kept"] for i in range(22)) and not got[20]["base_failed"]
    assert all(got[i]["kept"] for i in range(22, 60))


def test_even_hosts_and_wide_hosts(spark):
    def prior(rates):
        return quality.fit_prior(spark.createDataFrame(rates, "host string, n bigint, failed bigint"))

    even = prior([(str(i), 100, 20) for i in range(50)])
    wide = prior([(str(i), 100, 95 if i % 2 else 5) for i in range(50)])
    assert even.alpha + even.beta == quality.MAX_STRENGTH and wide.alpha + wide.beta < 2
