from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from userlake.llm import licenses
from userlake.llm.queries import registered

FILES = "file_id bigint, path string, text string, license string"
MIT, APACHE = (licenses.TEMPLATES[n][0] for n in ("MIT", "Apache-2.0"))


def slow_scan(text, total, frequency):
    """Every unit against every template, by dense vectors."""
    known = licenses.vocabulary()
    weigh = lambda t: math.log((total + 1) / ((frequency.get(t, 0) if t in known else 0) + 1)) + 1
    best = (0.0, None)
    for unit in licenses.units(text or ""):
        a = Counter(licenses.terms(unit))
        for name in sorted(licenses.TEMPLATES):
            for wording in licenses.TEMPLATES[name]:
                b = Counter(licenses.terms(wording))
                dot = sum(a[t] * b[t] * weigh(t) ** 2 for t in a)
                size = math.sqrt(sum((n * weigh(t)) ** 2 for t, n in a.items()) * sum((n * weigh(t)) ** 2 for t, n in b.items()))
                if size and dot / size > best[0] + 1e-9:
                    best = (dot / size, name)
    return best if best[0] >= licenses.MIN_COSINE else (None, None)


def test_whole_table_equals_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    frequency = Counter(t for r in rows for t in set(licenses.terms(r.text or "")))
    got = {r.doc_id: r for r in registered()["op10_licenses"](spark, DATA).collect()}
    assert len(got) == len(rows)
    for r in rows:
        score, name = slow_scan(r.text, len(rows), frequency)
        assert (got[r.doc_id].license if got[r.doc_id].origin == "own" else None) == name
        assert got[r.doc_id].cosine == (score if score is None else pytest.approx(score))
    assert {r.license for r in got.values()} > {None}


def test_nearest_directory_above_speaks_for_a_file(spark):
    rows = [
        (1, "/a/LICENSE", MIT), (2, "/a/b/x", "prose"), (3, "/a/b/c/LICENSE", APACHE), (4, "/a/b/c/d/y", "prose"),
        (5, "/z/q", "prose"), (6, "/a/b/own", f"some prose here\n{APACHE}\nand more"), (7, None, "prose"), (8, "top", "prose"),
        (9, "/ab/x", "prose"), (10, "/a/LICENSE.2", APACHE), (11, "/a/b/c/d/y", None), (12, "/a/b/c/d/y", ""), (None, "/a/n", "p"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], FILES)
    got = {r.file_id: (r.license, r.origin, r.from_directory) for r in licenses.scan_licenses(df.unionByName(df.where("file_id = 2"))).collect()}
    assert got[1] == ("MIT", "own", None) and got[3] == got[6] == got[10] == ("Apache-2.0", "own", None)
    assert got[4] == got[11] == got[12] == ("Apache-2.0", "inherited", "/a/b/c")
    assert got[2][1:] == got[None][1:] == ("inherited", "/a") and got[5] == got[7] == got[8] == got[9] == (None, None, None)
    assert licenses.scan_licenses(df.limit(0)).collect() == []


def test_whole_licence_files_speak_for_their_directories(spark):
    texts = {name: text for name, (text,) in licenses.whole_texts().items()}
    agpl = texts["GPL-3.0"].replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1).replace("29 June", "19 November", 1)
    texts["AGPL-3.0"] = agpl.replace("GNU General Public License as", "GNU Affero General Public License as")
    rows = []
    for k, (name, text) in enumerate(sorted(texts.items())):
        rows += [(2 * k, f"/{name}/doc", f"Copyright (c) 2020 Some Body and others\n\n{text}"), (2 * k + 1, f"/{name}/src/x", "prose")]
    prose = " ".join(f"word{i}" for i in range(300))
    rows += [(900, "/n/COPYING", f"{MIT}\n{prose}"), (901, "/n/x", "prose"), (902, "/o/notes", f"{MIT}\n{prose}"), (903, "/o/x", "prose")]
    rows += [(1000 + i, f"/p/{i}", f"plain prose of file {i} with the words of a text") for i in range(60)]
    got = {r.file_id: r for r in licenses.scan_licenses(spark.createDataFrame([(*r, "") for r in rows], FILES)).collect()}
    for k, name in enumerate(sorted(texts)):
        assert (got[2 * k].license, got[2 * k].origin, got[2 * k].is_license_file) == (name, "own", True)
        assert (got[2 * k + 1].license, got[2 * k + 1].from_directory) == (name, f"/{name}")
    assert (got[901].license, got[902].license, got[903].license) == ("MIT", "MIT", None)


def test_wordings_find_themselves_and_prose_finds_nothing():
    matcher = licenses.Matcher(1000, {"the": 900, "license": 20, "under": 300})
    for name, wordings in licenses.TEMPLATES.items():
        for wording in wordings:
            assert matcher.scan(f"A line of prose.\n\n{wording.upper()}\n\nAnother line.")[:1] == (name,)
            assert matcher.scan(wording)[2]
    assert matcher.scan("the licensed driver went under the bridge, version of the free work") == (None, None, False)
    assert matcher.scan("word " * 50_000 + "\nReleased under the MIT License.") == ("MIT", pytest.approx(1.0), False)


def test_telling_terms_lose_nothing():
    matcher = licenses.Matcher(500, {"the": 400, "under": 100, "license": 50})
    for _, vector in matcher.vectors:
        rest = math.sqrt(sum(v * v for t, v in vector.items() if t not in matcher.telling))
        assert rest < licenses.MIN_COSINE


def test_documents_become_files(documents):
    rows = licenses.document_files(documents(("x", "a/b"), ("y", None)).withColumn("path", F.lit("clash"))).collect()
    assert [r.path for r in rows] == ["/a_b/en/0", "/unknown/en/1"]
