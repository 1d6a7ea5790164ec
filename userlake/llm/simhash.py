"""Near-duplicates by SimHash fingerprints that differ in two bits at most.

A fingerprint is cut into two halves, so that of two fingerprints within two
bits one half differs by one bit at most. Each half is indexed under 32
variants, each with another bit left out; equal variants are joined and the
whole fingerprints compared. Only distinct fingerprints are indexed, so exact
copies make no pairs. A variant that very many distinct fingerprints share is
taken further: its members are indexed under variants of the whole fingerprint
with two bits left out, whose members are all within two bits of each other and
are linked to the smallest, without pairs.

Defined cases: a null or blank text has the fingerprint zero, linked as any
other; a text of fewer than three words has one shingle, all of it; doc_id
names a document, so rows of one doc_id are repeats of it; a row without doc_id
makes no links and gets the component of its fingerprint, or null; an empty
table gives an empty result; further columns are ignored or kept as stated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from userlake.llm.common import by_merge, stored
from userlake.llm.components import components

SEED = 42
SHINGLE = 3
HALF_BITS = 32
MAX_BITS = 2
# Distinct fingerprints that may share a variant and still be compared with each other.
BUCKET_LIMIT = 64


def fingerprint(text: str | None) -> int:
    """A bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    count = max(len(words) - SHINGLE + 1, 1)
    return bits_of_majority(np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count))


def bits_of_majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of 64-bit hashes; zero without any."""
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and `fp`, the fingerprint as a signed number."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py()) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return documents.select("doc_id", F.col(text).alias("text")).mapInArrow(compute, "doc_id bigint, fp bigint")


def half_variants(nodes: DataFrame) -> DataFrame:
    """Each node under the 64 variants of its halves: `key` holds the half, the bit left out and the other bits."""
    index = F.explode(F.sequence(F.lit(0), F.lit(2 * HALF_BITS - 1)))
    cut = nodes.withColumn("i", index)
    half = F.when(F.col("i") < HALF_BITS, F.col("fp").bitwiseAND(F.lit((1 << HALF_BITS) - 1))).otherwise(
        F.shiftrightunsigned("fp", HALF_BITS)
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("i", F.lit(HALF_BITS)))
    other = half.bitwiseAND(F.bitwise_not(bit))
    return cut.select("node", "fp", "i", F.shiftleft(F.col("i").cast("bigint"), HALF_BITS).bitwiseOR(other).alias("key"))


def _within(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS


def compared_links(members: DataFrame) -> DataFrame:
    """Links between members of one variant, each pair compared in full."""
    one = members.select("key", F.col("node").alias("u"), F.col("fp").alias("a"))
    two = members.select("key", F.col("node").alias("v"), F.col("fp").alias("b"))
    near = (one["key"] == two["key"]) & (F.col("u") < F.col("v")) & _within(F.col("a"), F.col("b"))
    return one.join(by_merge(two), near).select("u", "v")


def star_links(members: DataFrame) -> DataFrame:
    """Links for members (node, fp, i) of crowded variants, without pairs.

    A pair in a variant differs in the bit left out and one of the other half,
    or in two bits of the other half; each has a variant with those two left out.
    """
    place = F.col("i").cast("bigint")
    other = F.when(place < HALF_BITS, F.sequence(F.lit(HALF_BITS), F.lit(2 * HALF_BITS - 1))).otherwise(
        F.sequence(F.lit(0), F.lit(HALF_BITS - 1))
    )
    one_each = members.select("node", "fp", "i", F.explode(other).alias("j"))
    halves = members.select("node", "fp", (F.col("i") < HALF_BITS).alias("low"), other.alias("other")).distinct()
    two_other = halves.select("node", "fp", F.explode("other").alias("i"), "other").select(
        "node", "fp", "i", F.explode("other").alias("j")
    ).where("i < j")
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(c)) for c in ("i", "j")]
    variants = (
        one_each.select("node", "fp", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
        .unionByName(two_other)
        .distinct()
        .select(
            "node", "i", "j", F.col("fp").bitwiseAND(F.bitwise_not(bits[0].bitwiseOR(bits[1]))).alias("rest")
        )
    )
    key = ["i", "j", "rest"]
    least = variants.groupBy(*key).agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    return variants.join(by_merge(least), key).where("node <> v").select(F.col("node").alias("u"), "v").distinct()


def fingerprint_links(nodes: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (u, v) that connect all of the distinct fingerprints (node, fp) within two bits of each other.

    Each node becomes 64 rows, so the nodes are dealt to as many tasks as the
    variants need, not to the few that their own size would.
    """
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = half_variants(nodes.repartition(tasks, "node"))
    shared = variants.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(variants.join(by_merge(shared), "key"), "variants")
    return compared_links(members.where(F.col("n") <= limit)).unionByName(star_links(members.where(F.col("n") > limit)))


def near_duplicates(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id of each document."""
    prints = stored(fingerprints(documents, text), "fingerprints")
    nodes = prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    labels = components(fingerprint_links(nodes))
    found = nodes.join(by_merge(labels), "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(by_merge(found), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents, of each component that with the smallest doc_id; of repeated rows one stays.

    The list of those that stay grows with the documents, so it is always
    merged, never broadcast, and the texts move once at every size.
    """
    labels = stored(near_duplicates(documents.select("doc_id", "text")).select("doc_id", "component_id"), "components")
    first = labels.where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    named = documents.where(F.col("doc_id").isNotNull())
    kept = named.join(first.hint("merge"), named["doc_id"] == first["id"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(documents.where(F.col("doc_id").isNull()))
