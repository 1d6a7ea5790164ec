from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from userlake.llm.divergence import Skyband, leading_terms, source_divergence, terms_of

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def slow_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text)]


def brute(rows, min_documents, k):
    """The contract, term by term in Python numbers."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source, terms = lang or "", source or "", slow_terms(text or "")
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: {t for t, n in docs[lang].items() if n >= min_documents} for lang, _ in groups}
    out = []

    def share(count, size, v):
        return 1 + 1_000_000_000 * (count + 5) // (size + 5 * v)

    for lang, source in groups:
        terms, v = kept[lang], len(kept[lang])
        sizes = {s: sum(counts[g, s][t] for t in terms) for g, s in groups if g == lang}
        whole = Counter()
        for s in sizes:
            whole.update({t: counts[lang, s][t] for t in terms})
        found = []
        for other in sizes:
            if other != source:
                value = sum(
                    abs(share(counts[lang, source][t], sizes[source], v) - share(counts[lang, other][t], sizes[other], v))
                    for t in terms
                )
                found.append(("pair", other, value))
        for t in terms:
            ahead = share(counts[lang, source][t], sizes[source], v) - share(whole[t], sum(sizes.values()), v)
            if counts[lang, source][t] and ahead > 0:
                found.append(("term", t, ahead))
        for part in ("pair", "term"):
            ranked = sorted((f for f in found if f[0] == part), key=lambda f: (-f[2], f[1].encode()))
            out += [
                (lang, source, part, item, value, rank)
                for rank, (_, item, value) in enumerate(ranked, 1)
                if part == "pair" or rank <= k
            ]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def random_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "été", "naïve", "x", "Ünit", "漢字", "zeta", "Omega"] + [f"w{c}" for c in "abcdefghij"]
    rows = []
    for i in range(n):
        # One source holds a third of all rows; some texts, languages and sources are missing.
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "É", None])
        k = rng.randrange(1, len(words))
        text = rng.choice([None, "", "1234 _ -"]) if rng.random() < 0.1 else " ".join(rng.choices(words[:k] * 3 + words, k=rng.randrange(1, 40)))
        rows.append((i if rng.random() < 0.95 else None, text, rng.choice(["en", "de", None]), source))
    return rows + rows[:5]


@pytest.mark.parametrize("seed,min_documents,k", [(1, 5, 50), (2, 30, 3), (3, 1, 4)])
def test_equals_brute_force(spark, seed, min_documents, k):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(source_divergence(df, min_documents, k)) == brute(rows, min_documents, k)


def test_languages_without_kept_terms_have_distances_of_zero(spark):
    rows = [(1, "one two", "en", "a"), (2, "three", "en", "b"), (3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(source_divergence(df)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_empty_table_and_further_columns(spark):
    wide = SCHEMA + ", term string, n bigint, p bigint, rank int, size string"
    assert source_divergence(spark.createDataFrame([], wide)).count() == 0
    rows = [(i, "same words here", "en", "ab"[i % 2]) for i in range(6)]
    df = spark.createDataFrame([(*r, "x", 7, 7, 7, "y") for r in rows], wide)
    assert rows_of(source_divergence(df, 2, 5)) == brute(rows, 2, 5)


def test_very_long_text_and_term(spark):
    rows = [(i, "é" * 200_000 + " " + "word " * 100_000, "en", "ab"[i % 2]) for i in range(4)]
    assert rows_of(source_divergence(spark.createDataFrame(rows, SCHEMA), 2, 5)) == brute(rows, 2, 5)


def test_terms_keep_other_letters():
    text = "Ab1c Été_ÉTÉ\x00Z q"
    assert [t.decode() for t in terms_of(text)] == slow_terms(text)


@pytest.mark.parametrize("seed", range(4))
def test_skyband_keeps_what_fewer_than_k_dominate(seed):
    rng = np.random.default_rng(seed)
    n, total, k = rng.integers(1, 12, 1500), rng.integers(1, 12, 1500), 5
    dominated = [int(((n[:i] >= n[i]) & (total[:i] <= total[i])).sum()) for i in range(len(n))]
    band = Skyband(k)
    stays = np.concatenate([band.keep(n[:700], total[:700]), band.keep(n[700:], total[700:])])
    assert stays.tolist() == [d < k for d in dominated]


def test_leading_terms_do_not_depend_on_partitions(spark):
    rng = random.Random(5)
    kept = [("en", f"s{s}", f"t{t:03}", rng.randrange(1, 9), 40 + t % 7) for s in range(3) for t in range(400)]
    sizes = [("en", f"s{s}", 500, 400, 9000, 400, 1) for s in range(3)]
    sized = spark.createDataFrame(
        sizes, "lang string, source string, size bigint, n_terms bigint, lang_size bigint, lang_terms bigint, absent bigint"
    )
    df = spark.createDataFrame(kept, "lang string, source string, term string, n bigint, total bigint")
    found = [sorted(map(tuple, leading_terms(df.repartition(p), sized, 20).collect())) for p in (1, 9)]
    assert found[0] == found[1] and len(found[0]) == 60
