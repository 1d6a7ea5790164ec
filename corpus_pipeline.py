"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
with all columns; what one stage returns is written as Parquet and read again
as the next one's documents. The last adds the token ids of the texts.

Defined cases: a null or blank text fails the quality rules, so later stages
never meet one from `run`, though each takes them; rows without doc_id are no
copies of others and stay; of rows of one doc_id one stays; an empty table
gives an empty result; texts of any length are taken whole; further columns are
kept, but for `token_ids`, which the last stage adds.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from userlake.llm import bpe_codec, decontaminate, near_copies, quality, sanitise
from userlake.llm.common import importable_on_workers, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from hosts that are not rejected."""
    return quality.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with four fifths of their five-word shingles in common that with the smallest doc_id."""
    importable_on_workers(spark)
    return near_copies.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    importable_on_workers(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data and disclosing terms in their texts are replaced."""
    return sanitise.sanitised(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the token ids of their texts, from which the texts can be decoded."""
    importable_on_workers(spark)
    return bpe_codec.with_codes(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("bpe encoding", bpe_encoding),
]

# The stages take fingerprints and merges, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
