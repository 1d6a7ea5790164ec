"""Spans, disclosing terms and rewritten texts held against plain Python by the stated rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.conftest import plan_of, rows_by
from userlake.llm import sanitise
from userlake.llm.queries import registered

STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = re.compile(r"(?<![^\W_]|[@._%+-])[^\W\d_]{3,}(?![^\W_]|[@_%+])")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def valid(kind, value):
    digits = "".join(c for c in value if c in "0123456789")
    return {
        "email": True,
        "ip": all(int(x) <= 255 for x in value.split(".")) if kind == "ip" else True,
        "card": 13 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def slow_base(text):
    return {
        kind: [(m.start(), m.end(), m[0]) for m in re.finditer(p, text or "") if valid(kind, m[0])]
        for kind, p in STATED.items()
    }


def listed(spans):
    return ",".join(f"{kind}:{s}:{e}" for kind in STATED for s, e, *_ in spans[kind])


def entity(kind, value):
    return kind + ":" + {"email": value.lower(), "ip": value}.get(kind, re.sub("[^0-9]", "", value))


def near(text, s, e):
    left, right = text[max(s - 160, 0) : s], text[e : e + 160]
    before = WORD.findall(re.sub(r"^\S*", "", left, count=1))[-8:]
    after = WORD.findall(re.sub(r"\S*$", "", right, count=1))[:8]
    return [w.lower() for w in before + after]


def slow_terms(texts):
    """(entity, term) -> removed, by counting."""
    surroundings, both, sizes, frequency = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for doc, text in enumerate(texts):
        for w in WORD.findall((text or "").lower()):
            frequency[w].add(doc)
        for kind, spans in slow_base(text).items():
            for s, e, value in spans:
                c, terms = entity(kind, value), near(text, s, e)
                sizes[c].add(doc)
                for t in set(terms):
                    surroundings[c, t].add(" ".join(terms))
                    both[c, t].add(doc)
    out, total = {}, len(texts)
    for (c, t), seen in surroundings.items():
        n = len(sizes[c])
        if len(seen) >= 3 and n < total and frequency[t]:
            share = math.log(total * len(both[c, t]) / (len(frequency[t]) * n)) / math.log(total / n)
            if share >= 0.8:
                out[c, t] = share >= 0.95
    return out


def slow_all(texts):
    terms = slow_terms(texts)
    for text in texts:
        spans = slow_base(text)
        here = {entity(k, v) for k, found in spans.items() for _, _, v in found}
        taken = [(s, e) for found in spans.values() for s, e, _ in found]
        extra = []
        for m in WORD.finditer(text or ""):
            told = [gone for (c, t), gone in terms.items() if c in here and t == m[0].lower()]
            if told and not any(s < m.end() and m.start() < e for s, e in taken):
                extra.append((m.start(), m.end(), any(told)))
        yield spans, extra


def check(rows, texts):
    for i, (spans, extra) in enumerate(slow_all(texts)):
        row, base = rows[i], listed(spans)
        assert [row[f"n_{k}"] for k in STATED] == [len(spans[k]) for k in STATED]
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert row.spans == ",".join(filter(None, [base, *(f"term:{s}:{e}" for s, e, _ in extra)]))


ODD = [
    None, "", "a@b.c", "x@y", "a@b.c_d@e.f.g", "..@-.-", "a@b.c@d.e", "é.x@y.z", "🦆 me@site.org 🦆",
    "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.4", "0001.002.3.255", "1.2.3", "999.1.1.1.1.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111 1111 1111", "0000000000000", "12345678901234567890",
    "+1 (017) 555-7713", "+1 234", "+12345678901234567", "++1 (017) 555-7713.", "+4111111111111111", "4111 1111 1111 1111+1 017 555 7713",
]


def contacts():
    """A nickname that stands for a mail address in several surroundings, and words that do not."""
    choose = random.Random(7)
    common = [f"word{chr(97 + i)}" for i in range(26)]
    texts = []
    for i in range(80):
        body = " ".join(choose.choices([re.sub(r"\d", "", w) for w in common], k=40))
        if i % 8 == 0:
            body += f" Zorbax writes as jo.doe@mail.example.org {choose.choice(common)}x now and then today"
        if i % 8 == 1:
            body += f" ask Often Quux at +1 (017) 555-{7700 + i} " + " ".join(choose.choices(common, k=3))
        texts.append(body)
    texts += [texts[1]] * 5 + [texts[0] + " zorbax again, ZORBAX."]
    return texts


def test_odd_texts(documents):
    texts = ODD + ["a" * 3000 + " " + "1" * 3000 + " " + "1-" * 3000 + "@" + "a." * 3000 + "+1" + "." * 3000]
    check(rows_by(sanitise.digests(sanitise.all_spans(documents(*texts)))), texts)


def test_random_texts(documents):
    choose = random.Random(9)
    pieces = ["1", "23", "256", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "é", "🦆", "_", "%", "4111", "1111"]
    texts = ["".join(choose.choices(pieces, k=choose.randrange(60))) for _ in range(400)]
    check(rows_by(sanitise.digests(sanitise.all_spans(documents(*texts)))), texts)


def test_terms_that_tell_are_found(documents):
    texts = contacts()
    assert ("email:jo.doe@mail.example.org", "zorbax") in slow_terms(texts)
    rows = rows_by(sanitise.digests(sanitise.all_spans(documents(*texts))))
    check(rows, texts)
    assert rows[len(texts) - 1].n_terms >= 3
    assert all(rows[i].spans == "" for i in range(80) if i % 8 > 1)


def test_whole_table_equals_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]
    check(rows_by(registered()["op5_sanitise"](spark, DATA)), texts)


def test_texts_are_rewritten(documents):
    texts = [*ODD, *contacts()]
    df = documents(*texts).withColumn("_text", F.lit("clash")).withColumn("spans", F.lit(1))
    out = sanitise.sanitised(df)
    assert out.columns == df.columns and out.schema["n_chars"] == df.schema["n_chars"]
    rows = rows_by(out)
    for i, (spans, extra) in enumerate(slow_all(texts)):
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
        want, at = "", 0
        for s, e, label in merged:
            want, at = want + texts[i][at:s] + label, e
        want = texts[i] if not merged else want + texts[i][at:]
        assert rows[i].text == want and rows[i]["spans"] == 1
        assert rows[i].n_chars == len(want or "")


def test_repeated_rows_null_ids_and_an_empty_table(documents):
    texts = contacts()
    df = documents(*texts).withColumn("doc_id", F.expr("CASE WHEN doc_id < 4 THEN NULL WHEN doc_id < 20 THEN 7 ELSE doc_id END"))
    df = df.unionByName(df.where("doc_id = 40"))
    assert sanitise.digests(sanitise.all_spans(df)).count() == sanitise.sanitised(df).count() == len(texts) + 1
    assert sanitise.sanitised(df.limit(0)).collect() == []
    assert sanitise.digests(sanitise.all_spans(df.limit(0))).collect() == []


@pytest.mark.parametrize("count", [1, 3])
def test_an_entity_in_every_document_tells_nothing(documents, count):
    texts = ["mail Zorbax at jo@x.org please"] * count
    check(rows_by(sanitise.digests(sanitise.all_spans(documents(*texts)))), texts)


def test_terms_of_all_mentions_are_never_broadcast(documents, plans):
    """Mentions and terms are exploded, which Spark takes no account of when it sizes a table."""
    found, told = plans(sanitise), documents(*contacts())
    sanitise.all_spans(told)
    assert len(found) == 2 and found[1].count("SortMergeJoin") == 3 and "Broadcast" not in found[1]
    rows = sanitise.stored(sanitise.found(told), "rows")
    terms = sanitise.stored(sanitise.disclosing_terms(told, rows), "terms")
    assert "SortMergeJoin [entity" in plan_of(sanitise.term_spans(told, rows, terms))
