from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from userlake.llm import warc

PAGES = "page_id bigint, url string, html string, payload string"


def base32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out, seen = [], set()
    for page, _, html, *_ in rows:
        data, one = (html or "").encode(), first.get(html or "")
        response = one is None or (page == one and (page, html or "") not in seen)
        seen.add((page, html or ""))
        out.append((page, len(data), base32(data), "response" if response else "revisit", None if response else one))
    return sorted(out, key=str)


def test_pages_come_back(spark, tmp_path):
    choose = random.Random(4)
    texts = ["", None, "<p>a</p>", "é🦆\r\n\r\nWARC/1.1\r\n", "x" * 300_000, "\x00\x01"]
    rows = [(i, f"http://h/{i}", choose.choice(texts), "clash") for i in range(60)]
    rows += [(3, "http://h/3", rows[3][2], "clash"), (None, None, "<p>a</p>", ""), (None, "u\r\nWARC-Type: fake", "alone", "")]
    out = warc.archive_pages(spark.createDataFrame(rows, PAGES), str(tmp_path / "a"))
    assert sorted(map(tuple, warc.digests(out).collect()), key=str) == brute(rows)
    want = {(p, (h or "").encode()) for p, _, h, _ in rows}
    got = {(r.record_id, r.target_uri): r.payload for r in out.where("record_type = 'response'").collect()}
    assert all((int(i[9:]) if i != "urn:page:" else None, bytes(p)) in want for (i, _), p in got.items())
    assert ("urn:page:", "u%0D%0AWARC-Type: fake") in got


def test_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], PAGES)
    assert warc.digests(warc.archive_pages(empty, str(tmp_path / "a"))).collect() == []


def test_predicates_reach_the_reader_and_payloads_can_be_left_out(spark, tmp_path):
    rows = [(i, f"http://h/{i % 3}", f"page {i % 5}", "") for i in range(50)]
    out = warc.archive_pages(spark.createDataFrame(rows, PAGES), str(tmp_path / "a"))
    some = out.where("record_type = 'revisit' AND target_uri IN ('http://h/1', 'http://h/2') AND payload_length > 2")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "record_type#" in plan and "= revisit" not in plan.split("Filter")[-1].split("\n")[0]
    assert some.count() == sum(1 for i, *_ in rows if i >= 5 and i % 3)
    heads = warc.read_archive(spark, str(tmp_path / "a"), payload=False)
    assert heads.where("payload IS NOT NULL").count() == 0 and heads.count() == 50


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    records = [
        {"record_id": f"r{i}", "record_type": "response", "target_uri": None, "date": None, "payload_digest": None,
         "refers_to": None, "payload_length": None, "payload": bytes(random.Random(i).randbytes(200_000))}
        for i in range(20)
    ]
    file = tmp_path / "x.warc.gz"
    file.write_bytes(b"".join(warc.gzip_member(warc.record_bytes(r)) for r in records))
    reader = warc.WarcReader(str(file), True)
    assert list(reader.pushFilters([warc.EqualTo(("record_id",), "r7")])) == []
    asked = []
    grow = warc.Record._grow
    monkeypatch.setattr(warc.Record, "_grow", lambda self, n: asked.append(n) or grow(self, n))
    (batch,) = reader.read(reader.partitions()[0])
    assert batch.to_pylist()[0]["payload"] == records[7]["payload"]
    assert sum(n for n in asked if n > 4096) < 2_000_000


@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, warc.gzip_member])
def test_archives_of_other_writers(tmp_path, pack):
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:x:{}>\r\nWARC-Target-URI: http://a\r\n b\r\nContent-Length: {}\r\n\r\n"
    blocks = [b"", b"plain\r\n\r\nbody", b"z" * 100_000, "é".encode() * 5000]
    data = b"".join(
        pack(head.format("resource" if i % 2 else "warcinfo", i, len(b)).encode() + b + b"\r\n\r\n")
        for i, b in enumerate(blocks)
    )
    (tmp_path / "one.warc").write_bytes(data)
    for wanted in (None, "warcinfo"):
        reader = warc.WarcReader(str(tmp_path), True)
        if wanted:
            assert list(reader.pushFilters([warc.EqualTo(("record_type",), wanted)])) == []
        rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
        keep = [i for i in range(4) if not wanted or i % 2 == 0]
        assert [(r["record_id"], r["payload"]) for r in rows] == [(f"urn:x:{i}", blocks[i]) for i in keep]
        assert rows[0]["target_uri"] == "http://a b"


def test_a_broken_archive_is_an_error(tmp_path):
    (tmp_path / "one.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 50\r\n\r\nshort")
    reader = warc.WarcReader(str(tmp_path), True)
    with pytest.raises(ValueError, match="one.warc"):
        list(reader.read(reader.partitions()[0]))


def test_files_and_stretches_are_bounded_and_uncommitted_files_do_not_count(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 40_000)
    monkeypatch.setattr(warc, "SPLIT_BYTES", 9_000)
    rows = [(i, None, random.Random(i).randbytes(1500).hex(), "") for i in range(100)]
    path = str(tmp_path / "a")
    warc.archive_pages(spark.createDataFrame(rows, PAGES).repartition(2), path)
    reader = warc.WarcReader(path, True)
    parts = reader.partitions()
    (tmp_path / "a" / "left.warc.gz").write_bytes(b"junk")
    assert len(parts) > 10 and len({p.file for p in parts}) > 2
    seen = [r["record_id"] for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(seen) == sorted(f"urn:page:{i}" for i in range(100))
    assert warc.digests(warc.read_archive(spark, path)).count() == 100


def test_digest_letters(spark):
    df = spark.range(20).select(F.sha1(F.col("id").cast("string")).alias("h"), F.col("id").cast("string").alias("s"))
    assert all(r.b == base32(r.s.encode()) for r in df.select("s", warc.base32_of_hex(F.col("h")).alias("b")).collect())
