from __future__ import annotations

import pytest

from userlake.llm import common

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of the given texts: a text, or a text and its source."""

    def make(*texts, source="host"):
        rows = []
        for i, text in enumerate(texts):
            text, where = text if isinstance(text, tuple) else (text, source)
            rows.append((i, text, "en", where, len(text or "")))
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture
def plans(monkeypatch):
    """The plans of all that the given modules store, in order."""

    def watch(*modules):
        made = []

        def stored(df, purpose):
            made.append(plan_of(df))
            return common.stored(df, purpose)

        for module in modules:
            monkeypatch.setattr(module, "stored", stored)
        return made

    return watch


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_by(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}
