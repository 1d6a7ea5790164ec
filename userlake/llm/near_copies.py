"""Documents that share four fifths of their five-word shingles, one kept of each group.

SimHash alone does not find them: two texts at that similarity differ in some
ten of 64 bits, a distance at which nearly all texts meet some other. So two
searches name candidates, and only what the shingles themselves confirm is a
link:

* fingerprints of five-word shingles within two bits of each other, by the
  operator of `simhash`;
* bands of a MinHash signature: BANDS keys of BAND_ROWS minima each, of which a
  pair with similarity s shares at least one with probability
  1 - (1 - s^BAND_ROWS)^BANDS, 0.995 at 0.8 and more above.

Documents with one set of shingles are one node, and a fingerprint is one more
band of its nodes. Each node of a band is first compared with three of them, the
smallest, and the first and the last by a hash, so that a band with very many
near-copies makes three candidates of each. Links are the edges of components.
Then comes the rest: where the other nodes of a band still lie in several
components, all pairs of nodes of different components are compared, dealt in
blocks to as many tasks as they need. So each pair that shares a band is
compared, or was of one group before.

Defined cases: as in `simhash`; a text of fewer than five words has one
shingle, all of it; texts without words are copies of each other.
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
from userlake.llm.simhash import SEED, bits_of_majority, fingerprint_links

SHINGLE = 5
MIN_PERCENT = 80
BANDS = 13
BAND_ROWS = 5
# Shingles whose minima are taken at once.
CHUNK = 1 << 13
# Copies of a band's three nodes, so that a band with very many nodes is joined in as many tasks.
LOTS = 8
# Nodes of a band that meet as many others in one cell of the rest.
BLOCK = 256

_numbers = np.random.default_rng(7)
_FACTORS = _numbers.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _numbers.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)

SIGNED = "doc_id bigint, fp bigint, shingles_key bigint, bands array<bigint>"


def shingle_hashes(text: str | None) -> np.ndarray:
    """The hashes of a text's shingles, repeats included; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - SHINGLE + 1)


def band_keys(distinct: np.ndarray) -> list[int]:
    """The keys of the bands of a set of shingles; none for an empty set."""
    if not len(distinct):
        return []
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(distinct), CHUNK):
        mixed = distinct[at : at + CHUNK, None] * _FACTORS + _ADDED
        # The high bits of a product depend on all bits of its factors; the low ones do not.
        np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return [
        int(np.uint64(xxh64_intdigest(rows[band].tobytes(), band)).view(np.int64)) for band in range(BANDS)
    ]


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint, digest of the set of shingles, and bands of each document."""
    for batch in batches:
        prints, keys, bands = [], [], []
        for text in batch.column("text"):
            hashes = shingle_hashes(text.as_py())
            distinct = np.unique(hashes)
            prints.append(bits_of_majority(hashes))
            keys.append(xxh64_intdigest(distinct.tobytes(), SEED))
            bands.append(band_keys(distinct))
        columns = [
            batch.column("doc_id"),
            pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(np.array(keys, np.uint64).view(np.int64)),
            pa.array(bands, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "shingles_key", "bands"])


def with_stars(keyed: DataFrame) -> DataFrame:
    """The rows (node, key) of bands with several, and the band's count `n` and three nodes `others`."""
    by_hash = F.struct(F.xxhash64("node", "key").alias("h"), "node")
    chosen = (
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("node").alias("a"), F.min(by_hash).alias("b"), F.max(by_hash).alias("c"))
        .where("n > 1")
        .select(
            "key", "n", F.array_distinct(F.array("a", "b.node", "c.node")).alias("others"),
            F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))).alias("lot"),
        )
    )
    dealt = keyed.withColumn("lot", F.pmod(F.xxhash64("node"), F.lit(LOTS)).cast("int"))
    return dealt.join(by_merge(chosen), ["key", "lot"]).select("node", "key", "n", "others")


def band_candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v, of nodes (node, bands): each node with three of each of its bands; `rest_links` takes the others."""
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    met = with_stars(keyed).select("node", F.explode("others").alias("other"))
    return met.where("node <> other").select(
        F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")
    ).distinct()


def rest_members(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes (node, component, places) that other components share a band with, without the three that all were compared with.

    A place is such a band: its key, the blocks `few` that the nodes of all
    components but its largest take, the blocks `many` of the largest, and the
    node's own, the few counted before the many.
    """
    keyed = nodes.select("node", F.explode("bands").alias("key")).distinct()
    others = with_stars(keyed).where((F.col("n") > F.size("others") + 1) & ~F.array_contains("others", F.col("node")))
    members = stored(
        others.select("node", "key").join(by_merge(labels), "node", "left").select(
            "node", "key", F.coalesce("component", "node").alias("component")
        ),
        "near-members",
    )
    largest = F.max(F.struct("m", "component"))
    bands = (
        members.groupBy("key", "component").agg(F.count("*").alias("m"))
        .groupBy("key").agg(F.sum("m").alias("n"), largest.alias("top"))
        .where("n > top.m")
        .select(
            "key", F.col("top.component").alias("top"),
            F.ceil((F.col("n") - F.col("top.m")) / BLOCK).alias("few"), F.ceil(F.col("top.m") / BLOCK).alias("many"),
        )
    )
    dealt = F.xxhash64("node")
    block = F.when(F.col("component") == F.col("top"), F.col("few") + F.pmod(dealt, F.col("many"))).otherwise(
        F.pmod(dealt, F.col("few"))
    )
    return members.join(by_merge(bands), "key").groupBy("node", "component").agg(
        F.collect_list(F.struct("key", "few", "many", block.alias("block"))).alias("places")
    )


def rest_links(nodes: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) of nodes (node, bands) that lie in different components (node, component) and share a band.

    A cell of a band is two of its blocks, the first not of the largest
    component, so cells hold few pairs of one component and at most BLOCK nodes
    on average on either side. A pair is compared in the first of its bands only.
    """
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = stored(
        rest_members(nodes, labels).join(by_merge(sets), "node").select(
            "node", "component", F.col("places.key").alias("keys"), "shingles", "places"
        ),
        "near-places",
    )
    placed = members.select("node", "component", "keys", "shingles", F.explode("places").alias("p")).select("*", "p.*").drop("p", "places")
    zero = F.lit(0).cast("bigint")
    one = placed.where("block < few").withColumn("i", F.col("block")).select(
        "key", "i", F.explode(F.sequence("block", F.col("few") + F.col("many") - 1)).alias("j"),
        F.col("node").alias("u"), F.col("component").alias("cu"), F.col("keys").alias("ku"), F.col("shingles").alias("a"),
    )
    two = placed.withColumn("j", F.col("block")).select(
        "key", F.explode(F.sequence(zero, F.least("block", F.col("few") - 1))).alias("i"), "j",
        F.col("node").alias("v"), F.col("component").alias("cv"), F.col("keys").alias("kv"), F.col("shingles").alias("b"),
    )
    # A cell is little to read and much to compare, so cells are not gathered by their bytes.
    cells = one.repartition(tasks, "key", "i", "j").join(by_merge(two.repartition(tasks, "key", "i", "j")), ["key", "i", "j"])
    met = cells.where(
        (F.col("cu") != F.col("cv"))
        & ((F.col("i") < F.col("j")) | (F.col("u") < F.col("v")))
        & (100 * F.least(F.size("a"), F.size("b")) >= MIN_PERCENT * F.greatest(F.size("a"), F.size("b")))
        & (F.col("key") == F.array_min(F.array_intersect("ku", "kv")))
        & similar(F.col("a"), F.col("b"))
    )
    return met.select("u", "v").distinct()


def fingerprint_candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v, of nodes (node, fp) whose fingerprints are equal or within two bits."""
    first = stored(nodes.groupBy("fp").agg(F.min("node").alias("first")), "near-fingerprints")
    equal = nodes.join(by_merge(first), "fp").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    close = fingerprint_links(first.select(F.col("first").alias("node"), "fp"))
    return equal.unionByName(close.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of each text."""
    for batch in batches:
        sets = [np.unique(shingle_hashes(text.as_py())).view(np.int64) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def sets_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The shingles (node, shingles) of the texts (node, text) of nodes in pairs (u, v); no others are read again."""
    named = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).distinct().withColumnRenamed("u", "node")
    return stored(
        texts.join(by_merge(named), "node", "left_semi").select("node", "text").mapInArrow(shingle_sets, "node bigint, shingles array<bigint>"),
        "near-shingles",
    )


def similar(a: Column, b: Column) -> Column:
    """Whether two sets of shingles have the similarity."""
    return (100 + MIN_PERCENT) * F.size(F.array_intersect(a, b)) >= MIN_PERCENT * (F.size(a) + F.size(b))


def confirmed_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (u, v) of nodes those whose sets (node, shingles) have the similarity.

    A node in very many pairs is `v` in them, and adaptive execution splits the
    join on it.
    """
    larger = pairs.join(by_merge(sets.withColumnsRenamed({"node": "u", "shingles": "a"})), "u")
    whole = larger.join(by_merge(sets.withColumnsRenamed({"node": "v", "shingles": "b"})), "v")
    return whole.where(similar(F.col("a"), F.col("b"))).select("u", "v")


def near_copy_groups(documents: DataFrame) -> DataFrame:
    """doc_id and component_id, the smallest doc_id of its group, of each document that has a doc_id."""
    texts = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    signed = stored(texts.mapInArrow(signatures, SIGNED), "near-signatures")
    # Rows of one shingle set, and repeated rows of one doc_id with whatever texts, are linked to a node each.
    nodes = stored(
        signed.groupBy("shingles_key").agg(
            F.min(F.struct("doc_id", "fp", "bands")).alias("first")
        ).select(
            "shingles_key", F.col("first.doc_id").alias("node"), "first.fp",
            F.array_append("first.bands", F.xxhash64(F.lit("fp"), "first.fp")).alias("bands"),
        ),
        "near-nodes",
    )
    pairs = stored(
        band_candidates(nodes).unionByName(fingerprint_candidates(nodes.select("node", "fp"))).where("u <> v").distinct(),
        "near-pairs",
    )
    sets = sets_of(pairs, texts.withColumnRenamed("doc_id", "node"))
    links = confirmed_links(pairs, sets)
    copies = signed.join(by_merge(nodes.select("shingles_key", "node")), "shingles_key").where("doc_id <> node").select(
        F.col("doc_id").alias("u"), F.col("node").alias("v")
    )
    labels = components(links.unionByName(copies))
    rest = rest_links(nodes, labels, sets)
    labels = components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(rest))
    ids = signed.select("doc_id").distinct()
    return ids.join(by_merge(labels), F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents, of each group that with the smallest doc_id; of rows of one doc_id that with the smallest text.

    The list of those that stay grows with the documents, so it is always
    merged, never broadcast, and the texts move once at every size. Rows
    without doc_id stay.
    """
    labels = stored(near_copy_groups(documents), "near-groups")
    first = labels.where("doc_id = component_id").select(F.col("doc_id").alias("id"))
    named = documents.where(F.col("doc_id").isNotNull())
    kept = named.join(first.hint("merge"), named["doc_id"] == first["id"], "left_semi")
    whole = F.struct("text", *[c for c in documents.columns if c != "text"])
    one_each = kept.groupBy(F.col("doc_id").alias("_id")).agg(F.min(whole).alias("_row")).select("_row.*")
    return one_each.select(*documents.columns).unionByName(documents.where(F.col("doc_id").isNull()))
