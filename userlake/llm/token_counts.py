"""Token counts of texts under a byte-level BPE vocabulary.

Which vocabulary strings encode alone as one token is settled once, on the
driver; a pre-token among them counts one without any merging. The rest is
merged by the tokenizer's own model, each distinct pre-token once a task.

Defined cases: a null text is empty and has no tokens; special strings inside
a text are special tokens, one each; repeated rows are counted each; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.llm.pretokens import PreTokens

OVER_LIMIT = 1024
# Distinct pre-tokens a task remembers before it starts anew.
REMEMBERED = 1 << 19


def whole_tokens(file: str) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and encode alone as one token."""
    parts = PreTokens(file)
    # Ids that stand for part of a character decode to the replacement character and drop out.
    texts = [
        text
        for number in range(parts.tokenizer.get_vocab_size(with_added_tokens=False))
        if "�" not in (text := parts.tokenizer.decode([number], skip_special_tokens=False))
        and text not in parts.specials
        and parts.by_library(text) == [text]
    ]
    encoded = parts.tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(text for text, e in zip(texts, encoded) if len(e.ids) == 1)


class Counts(dict):
    """Pre-token -> number of tokens; whole tokens are there from the start."""

    def __init__(self, whole: Iterable[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole = dict(self)

    def learn(self, pieces: Iterable[str], tokenizer) -> None:
        """Merge those of the pieces that are not known."""
        unknown = [p for p in set(pieces) if p not in self]
        if len(self) - len(self.whole) + len(unknown) > REMEMBERED:
            self.clear()
            self.update(self.whole)
            unknown = [p for p in set(pieces) if p not in self]
        encoded = tokenizer.encode_batch(unknown, add_special_tokens=False)
        self.update(zip(unknown, (len(e.ids) for e in encoded)))


def count_tokens(documents: DataFrame, file: str, text: str = "text", over: int = OVER_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each document."""
    spark = documents.sparkSession
    whole = spark.sparkContext.broadcast(whole_tokens(file))  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, counts = PreTokens(file), Counts(whole.value)
        for batch in batches:
            totals = []
            for value in batch.column("text"):
                stretches, specials = parts.segments(value.as_py())
                total = len(specials)
                for stretch in stretches:
                    pieces = parts.split(stretch)
                    try:
                        total += sum(map(counts.__getitem__, pieces))
                    except KeyError:
                        counts.learn(pieces, parts.tokenizer)
                        total += sum(map(counts.__getitem__, pieces))
                totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    whole_text = F.coalesce(F.col(text), F.lit(""))
    return (
        documents.select("doc_id", F.octet_length(whole_text).cast("bigint").alias("n_bytes"), whole_text.alias("text"))
        .mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
        .withColumn("over_limit", F.col("n_tokens") > over)
    )
