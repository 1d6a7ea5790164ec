"""Token counts and codes held against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import struct

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import DATA
from tests.llm.conftest import rows_by
from userlake.llm import bpe_codec, token_counts
from userlake.llm.pretokens import PreTokens
from userlake.llm.queries import BYTE_BPE, registered

TEXTS = [
    None, "", " ", "a", "  two  spaces\n\n x \t y", "don't 'twas I'll\t's ''s !'re '", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b<|endof",
    "naïve café über straße ñandú ½ ² x₁ Ⅷ ٣٤", "日本語 テスト 🦆🦆 \U0001f468‍\U0001f469", "࢏ ՘ ₝₏ new letters", "\x1c\x1d\x1e\x1f x\x85y\xa0z",
    "x" * 3000 + " " * 500 + "1" * 200, "_snake_case __x__ #*$%&|<>", "word " * 3000, "�​",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def merges():
    return bpe_codec.Merges(BYTE_BPE)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def check_rows(texts, counts, codes, library):
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert counts[i]["n_tokens"] == codes[i]["n_tokens"] == len(ids)
        assert counts[i]["n_bytes"] == len((text or "").encode())
        assert counts[i]["over_limit"] == (len(ids) > 1024)
        assert codes[i]["ids_sha256"] == sha(struct.pack(f"<{len(ids)}I", *ids))
        assert codes[i]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False).encode())


def test_odd_texts(documents, library):
    df = documents(*TEXTS).withColumn("n_tokens", F.lit(0)).withColumn("token_ids", F.lit("x"))
    counts = rows_by(token_counts.count_tokens(df, BYTE_BPE))
    check_rows(TEXTS, counts, rows_by(bpe_codec.digest_codes(df, BYTE_BPE)), library)
    coded = bpe_codec.with_codes(df, BYTE_BPE)
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "token_ids"]
    for i, row in rows_by(coded).items():
        assert row.token_ids == library.encode(TEXTS[i] or "", add_special_tokens=False).ids and row.text == TEXTS[i]


def test_whole_table(spark, library):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    queries = registered()
    counts = rows_by(queries["op1_token_counts"](spark, DATA))
    codes = rows_by(queries["op9_bpe_codec"](spark, DATA))
    assert len(counts) == len(codes) == len(rows)
    check_rows([r.text for r in rows], counts, codes, library)


def test_empty_table_and_repeated_rows(documents):
    assert token_counts.count_tokens(documents("x").limit(0), BYTE_BPE).collect() == []
    assert bpe_codec.digest_codes(documents("x").limit(0), BYTE_BPE).collect() == []
    assert bpe_codec.with_codes(documents("x").limit(0), BYTE_BPE).collect() == []
    twice = documents("x", "x").withColumn("doc_id", F.lit(1).cast("bigint"))
    assert token_counts.count_tokens(twice, BYTE_BPE).count() == bpe_codec.with_codes(twice, BYTE_BPE).count() == 2


def test_whole_tokens_encode_alone_as_one(library):
    whole = sorted(token_counts.whole_tokens(BYTE_BPE))
    assert len(whole) > 40_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(whole, add_special_tokens=False))


def test_splitting_equals_the_library():
    parts, choose = PreTokens(BYTE_BPE), random.Random(1)
    letters = ["a", "'s", "'", "ll", " ", "\n", "\t", "1", "²", "é", "日", "!", "_", "࢏", "\x1c", "\x85", "ͅ", "Ⅷ", "'re"]
    for _ in range(3000):
        text = "".join(choose.choices(letters, k=choose.randrange(12)))
        assert parts.split(text) == parts.by_library(text)


def test_compatibility_of_pairs_equals_merging(merges):
    choose, tokens = random.Random(2), list(merges.proposed.values())
    short = [t for t in tokens if len(merges.bytes_of[t]) <= 3]
    pairs = [(choose.choice(short), choose.choice(short)) for _ in range(15_000)]
    pairs += [(choose.choice(tokens), choose.choice(tokens)) for _ in range(5_000)]
    letters = [merges.byte_id[b] for b in b"ae -=*"]
    runs = [t for t in tokens if set(merges.bytes_of[t]) <= set(b"ae -=*")]
    pairs += [(a, b) for a in runs[:120] for b in runs[:120]] + [(a, b) for a in letters for b in letters]
    import numpy as np

    left, right = np.array(pairs).T
    want = [merges.merge(merges.bytes_of[a] + merges.bytes_of[b]) == [a, b] for a, b in pairs]
    assert merges.compatible(left, right).tolist() == want


def test_short_and_long_merging_agree_and_blocks_keep_all(merges):
    choose = random.Random(3)
    for _ in range(300):
        piece = bytes(choose.choices(b"aetn s-=\xc3\xa9", k=choose.randrange(1, 120)))
        assert merges._merge_short(piece) == merges._merge_long(piece) == merges.encode_pieces([piece])[0]
    texts = ["x" * choose.randrange(9) for _ in range(200)]
    assert [t for block in bpe_codec.in_blocks(texts, 20) for t in block] == texts


def test_remembered_pieces_are_forgotten_without_harm(merges, monkeypatch):
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 10)
    encoder = bpe_codec.Encoder(BYTE_BPE, merges)
    texts = [f"word{i} and {i}" for i in range(60)]
    assert [encoder.decode(c) for c in encoder.encode_all(texts[:30]) + encoder.encode_all(texts[30:])] == texts
