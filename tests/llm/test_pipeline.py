"""The pipeline held against the brute-force versions of its stages, one after the other."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import DATA
from tests.llm import test_decontaminate, test_near_copies, test_quality, test_sanitise
from tests.llm.conftest import rows_by
from userlake.llm.queries import BYTE_BPE, registered


def slow_rewrite(texts):
    for text, (spans, extra) in zip(texts, test_sanitise.slow_all(texts)):
        cover = sorted(
            [(s, e, f"[{k}]") for k, found in spans.items() for s, e, _ in found]
            + [(s, e, "" if gone else "[term]") for s, e, gone in extra]
        )
        merged = []
        for s, e, label in cover:
            if merged and merged[-1][1] > s:
                merged[-1] = (merged[-1][0], max(e, merged[-1][1]), merged[-1][2])
            else:
                merged.append((s, e, label))
        for s, e, label in reversed(merged):
            text = text[:s] + label + text[e:]
        yield text


def slow_pipeline(rows, items):
    def passes(text):
        n, *_, repeats = test_quality.brute(text)
        return n >= 50 and 100 * repeats <= 50 * n

    texts = {r.doc_id: r.text for r in rows if passes(r.text)}  # no host of these data fails
    first = test_near_copies.slow_groups(dict(sorted(texts.items())))
    texts = {i: t for i, t in sorted(texts.items()) if first[i] == i}
    bad = {d for d, _ in test_decontaminate.brute(list(texts.items()), items)}
    kept = {i: t for i, t in texts.items() if i not in bad}
    return dict(zip(kept, slow_rewrite(list(kept.values()))))


def test_whole_pipeline_equals_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = slow_pipeline(rows, items)
    got = rows_by(registered()["pipeline"](spark, DATA))
    library = Tokenizer.from_file(BYTE_BPE)
    assert {i: r.text for i, r in got.items()} == want and 0 < len(want) < len(rows)
    for r in got.values():
        assert r.token_ids == library.encode(r.text, add_special_tokens=False).ids and r.n_chars == len(r.text)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_keeps_columns_and_takes_odd_rows(spark, documents, name, stage):
    good = " ".join(f"w{i}" for i in range(60))
    df = documents(None, "", good, good, f"{good} me@x.org", "x " * 5000).withColumn("_text", F.lit("a")).withColumn("fp", F.lit(2))
    df = df.unionByName(df.withColumn("doc_id", F.lit(None).cast("bigint")))
    for given in (df, df.limit(0)):
        out = stage(spark, given, DATA)
        assert out.columns[: len(df.columns)] == df.columns
        assert out.columns == df.columns or (name, stage) == corpus_pipeline.STAGES[-1]
        assert [f.dataType for f in out.schema][: len(df.columns)] == [f.dataType for f in df.schema]
        assert out.count() <= given.count()
