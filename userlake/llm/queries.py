"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from userlake.llm import (
    bpe_codec, chat, decontaminate, divergence, filter_audit, licenses, metric_tree, quality, repeats, sanitise, simhash,
    token_counts, warc,
)
from userlake.llm.common import importable_on_workers, table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), BYTE_BPE)


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = chat.with_hostile_conversation(table(spark, folder, "conversations"))
    return chat.digests(chat.format_conversations(conversations))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("source")


def op5_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    return sanitise.digests(sanitise.all_spans(table(spark, folder, "documents")))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digests(warc.archive_pages(table(spark, folder, "pages")))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.without_repeats(table(spark, folder, "documents")))


def op9_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.digest_codes(table(spark, folder, "documents"), BYTE_BPE)


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    files = licenses.document_files(table(spark, folder, "documents"))
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_filters(spark, f"{folder}/documents.parquet", table(spark, folder, "labels"))


def op12_metric_search(spark: SparkSession, folder: str) -> DataFrame:
    return metric_tree.nearest_vectors(table(spark, folder, "embeddings"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_format": op2_chat_format,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_sanitise": op5_sanitise,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_repeats": op8_repeats,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_licenses": op10_licenses,
    "op11_filter_audit": op11_filter_audit,
    "op12_metric_search": op12_metric_search,
    "op13_divergence": op13_divergence,
    "pipeline": corpus_pipeline.run,
}


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable_on_workers(spark)
        return query(spark, folder)

    return run


def registered() -> dict[str, Query]:
    return {name: _ready(query) for name, query in QUERIES.items()}
