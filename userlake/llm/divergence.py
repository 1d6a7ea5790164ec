"""How the sources of a language differ in their vocabulary.

A language keeps the terms that enough of its documents hold. Each (lang,
source) group, and each language as a whole, gives every kept term a smoothed
share in billionths, in whole numbers. Two reports follow: for each group its
distance to every other source of the language, and the terms that it uses more
than the language does.

The leading terms are found by dominance. Whatever the totals turn out to be, a
term with at least the group count, at most the language count and an earlier
spelling ranks before another; so a term behind k such terms cannot be among
the first k. Each partition keeps the terms with fewer than k of those (its
skyband), the skybands of a group are merged shard by shard, and only what is
left is ranked by its value.

The distance of two groups sums over all kept terms, also those that neither
holds, without a row for every term and pair. With p(t) the share of a term and
p0 that of an absent one, the sum over the terms of g of |p_g(t) - p0_s| follows
from running sums over the distinct shares of g; a term that both hold adds
what these sums got wrong about it, gathered in arrays; terms of neither count
times |p0_g - p0_s|. A group of N occurrences has at most sqrt(2N) distinct
shares.

Defined cases: null text, lang or source count as the empty string, as which
they form languages and groups of their own; a repeated row is a further
document; a group without terms takes part with a count of zero; a language
without kept terms has distances of zero and no terms; an empty table gives an
empty result; a text or a term may have any length; further columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from userlake.llm.common import stored

MIN_DOCUMENTS = 30
LEADING = 50
SCALE = 1_000_000_000
SMOOTHING = 5
# Counts of a task are passed on when they hold this many entries or come from this many bytes of text.
HELD_ENTRIES = 400_000
HELD_BYTES = 128 << 20
# Shards in which the skybands of one group are merged.
MERGE_SHARDS = 16
# Dominance is counted for this many terms at once.
BLOCK = 512
# Pairs of sources that are summed at once; sums of so many corrections are exact in a double.
PAIRS_AT_ONCE = 1 << 20

COUNTED = "lang string, source string, term string, n bigint, docs bigint"
CANDIDATE = "lang string, source string, term string, n bigint, total bigint"
OVERLAP = "lang string, low string, high string, shared bigint, correction bigint"

# A-Z become a-z, every other ASCII character that is no letter parts terms; bytes of other characters stay.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode().translate(_LETTERS).split()


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, summed over the documents of a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def release() -> Iterator[pa.RecordBatch]:
        for (lang, source), (seen, docs) in held.items():
            terms = list(seen)
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": [lang] * len(part),
                        "source": [source] * len(part),
                        "term": [t.decode() for t in part],
                        "n": [seen[t] for t in part],
                        "docs": [docs[t] for t in part],
                    }
                )
        held.clear()

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")))
        for lang, source, text in rows:
            terms = terms_of(text)
            seen, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen.update(terms)
            docs.update(set(terms))
            size += len(text)
        if size > HELD_BYTES or sum(len(seen) for seen, _ in held.values()) > HELD_ENTRIES:
            yield from release()
            size = 0
    yield from release()


def kept_counts(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """lang, source, term, n, total (of the language) and `head`, true in one row of each term, for the kept terms.

    Tasks sum their own documents first, so that a hot source or a common term
    sends one row from each task.
    """
    blank = F.lit("")
    texts = documents.select(*[F.coalesce(F.col(c), blank).alias(c) for c in ("lang", "source", "text")])
    term = W.partitionBy("lang", "term")
    counts = (
        texts.mapInArrow(count_terms, COUNTED)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    marked = counts.select(
        "lang", "source", "term", "n",
        F.sum("n").over(term).alias("total"),
        F.sum("docs").over(term).alias("_docs"),
        (F.col("source") == F.min("source").over(term)).alias("head"),
    )
    return marked.where(F.col("_docs") >= min_documents).drop("_docs")


def _share(count: Column, size: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (size + 5 * terms)); the product is made in decimals, as it may pass a long."""
    wide = "decimal(20,0)"
    above = (count + SMOOTHING).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    below = (size + SMOOTHING * terms).cast(wide)
    return F.when(terms > 0, 1 + F.call_function("div", above, below))


def group_sizes(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """Each occurring group with its occurrences and terms, those of its language, and the share of an absent term."""
    blank = F.lit("")
    groups = documents.select(*[F.coalesce(F.col(c), blank).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("n_terms"))
    whole = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_size"), F.sum(F.col("head").cast("bigint")).alias("lang_terms")
    )
    sized = groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    zero = F.lit(0).cast("bigint")
    filled = sized.select(
        "lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("size", "n_terms", "lang_size", "lang_terms")]
    )
    return filled.withColumn("absent", _share(zero, F.col("size"), F.col("lang_terms")))


# ---------------------------------------------------------------- leading terms


class Skyband:
    """Of the terms of one group, given in order of spelling, those dominated by fewer than k."""

    def __init__(self, k: int):
        self.k = k
        self.n = np.empty(0, np.int64)
        self.total = np.empty(0, np.int64)

    def keep(self, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Which of the next terms stay.

        Only terms that stayed need to be counted: of the terms that dominate
        one, the first k in order of spelling are dominated by fewer than k.
        """
        stays = np.empty(len(n), bool)
        for at in range(0, len(n), BLOCK):
            c, t = n[at : at + BLOCK], total[at : at + BLOCK]
            behind = np.tril((c[None, :] >= c[:, None]) & (t[None, :] <= t[:, None]), -1).sum(1)
            for old in range(0, len(self.n), 1 << 14):
                ahead_n, ahead_t = self.n[old : old + (1 << 14)], self.total[old : old + (1 << 14)]
                behind += ((ahead_n >= c[:, None]) & (ahead_t <= t[:, None])).sum(1)
            good = behind < self.k
            stays[at : at + BLOCK] = good
            self.n, self.total = np.append(self.n, c[good]), np.append(self.total, t[good])
        return stays


def _runs(*columns: pa.Array) -> list[tuple[int, int]]:
    """Begin and end of each run of equal rows."""
    n = len(columns[0])
    if n == 0:
        return []
    changed = np.zeros(n, bool)
    changed[0] = True
    for column in columns:
        codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(changed)
    return list(zip(starts.tolist(), [*starts[1:].tolist(), n]))


def skyband(k: int):
    """The skyband of each group, over rows sorted by group and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, None
        for batch in batches:
            n, total = (batch.column(c).to_numpy() for c in ("n", "total"))
            stays = np.empty(len(n), bool)
            for begin, end in _runs(batch.column("lang"), batch.column("source")):
                here = (batch.column("lang")[begin].as_py(), batch.column("source")[begin].as_py())
                if here != group:
                    group, band = here, Skyband(k)
                stays[begin:end] = band.keep(n[begin:end], total[begin:end])
            yield batch.filter(pa.array(stays))

    return run


def leading_terms(kept: DataFrame, sizes: DataFrame, k: int = LEADING) -> DataFrame:
    """lang, source, item, value (how far the share is above that of the language) and rank of the first k terms of each group."""
    order = ["lang", "source", "term"]
    rows = kept.select("lang", "source", "term", "n", "total")
    local = rows.sortWithinPartitions(*order).mapInArrow(skyband(k), CANDIDATE)
    shard = F.pmod(F.xxhash64("term"), F.lit(MERGE_SHARDS))
    merged = (
        local.repartition("lang", "source", shard).sortWithinPartitions(*order).mapInArrow(skyband(k), CANDIDATE)
    )
    shares = merged.join(sizes, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        _share(F.col("n"), F.col("size"), F.col("lang_terms")).alias("_own"),
        _share(F.col("total"), F.col("lang_size"), F.col("lang_terms")).alias("_lang"),
    )
    ahead = shares.where(F.col("_own") > F.col("_lang"))
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        ahead.select("lang", "source", "item", (F.col("_own") - F.col("_lang")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= k)
    )


# ---------------------------------------------------------------- distances of groups


def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the pairs of sources that share terms: how many, and what to add to the sums over absent shares.

    Rows come sorted by lang, term and source. Pairs are summed in arrays of
    bounded size; no row is made for a pair of one term.
    """
    sums: dict[tuple[str, str, str], list[int]] = {}

    def add(lang: str, names: list[str], code: np.ndarray, p: np.ndarray, p0: np.ndarray, left, right) -> None:
        low, high = code[left], code[right]
        a, b, a0, b0 = p[left], p[right], p0[left], p0[right]
        wrong = np.abs(a - b) - np.abs(a - b0) - np.abs(a0 - b)
        pairs, at = np.unique(low * len(names) + high, return_inverse=True)
        counts = np.bincount(at, minlength=len(pairs))
        totals = np.bincount(at, weights=wrong, minlength=len(pairs))
        for pair, n, total in zip(pairs.tolist(), counts.tolist(), totals.tolist()):
            entry = sums.setdefault((lang, names[pair // len(names)], names[pair % len(names)]), [0, 0])
            entry[0] += n
            entry[1] += int(total)

    def digest(table: pa.RecordBatch) -> None:
        for begin, end in _runs(table.column("lang")):
            part = table.slice(begin, end - begin)
            lang = part.column("lang")[0].as_py()
            spelled = part.column("source").dictionary_encode()
            names = spelled.dictionary.to_pylist()
            order = np.argsort(np.array(names, dtype=object), kind="stable")
            place = np.empty(len(names), np.int64)
            place[order] = np.arange(len(names))
            names = [names[i] for i in order]
            code = place[spelled.indices.to_numpy(zero_copy_only=False)]
            p, p0 = part.column("p").to_numpy(), part.column("absent").to_numpy()
            runs = np.array(_runs(part.column("term")), np.int64)
            first = np.repeat(runs[:, 0], runs[:, 1] - runs[:, 0])
            before = np.arange(len(code)) - first  # rows of the term ahead of each row
            ends = np.cumsum(before)
            at = 0
            while at < len(code):
                done = ends[at - 1] if at else 0
                stop = max(int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")), at + 1)
                right = np.repeat(np.arange(at, stop), before[at:stop])
                if len(right):
                    offset = np.arange(len(right)) - np.repeat(ends[at:stop] - before[at:stop] - done, before[at:stop])
                    add(lang, names, code, p, p0, first[right] + offset, right)
                at = stop

    def release() -> Iterator[pa.RecordBatch]:
        keys, values = list(sums), list(sums.values())
        if keys:
            lang, low, high = zip(*keys)
            shared, wrong = zip(*values)
            yield pa.RecordBatch.from_pydict(
                {"lang": lang, "low": low, "high": high, "shared": shared, "correction": wrong}
            )
        sums.clear()

    tail: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if tail is not None:
            table = pa.concat_tables([tail, table]).combine_chunks()
        if table.num_rows == 0:
            continue
        whole = table.combine_chunks().to_batches()[0]
        last = _runs(whole.column("lang"), whole.column("term"))[-1][0]  # the last term may go on
        tail = pa.Table.from_batches([whole.slice(last)])
        if last:
            digest(whole.slice(0, last))
        if len(sums) > HELD_ENTRIES:
            yield from release()
    if tail is not None and tail.num_rows:
        digest(tail.combine_chunks().to_batches()[0])
    yield from release()


def _absent_sums(shares: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each group and other source: the sum over the group's terms of |p - share of a term absent from the other|."""
    points = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m")).withColumn("other", F.lit(None).cast("string"))
    asked = pairs.select("lang", "source", F.col("other_absent").alias("p"), F.lit(0).cast("bigint").alias("m"), "other")
    group = W.partitionBy("lang", "source")
    upto = group.orderBy("p").rangeBetween(W.unboundedPreceding, W.currentRow)
    weight = F.col("m") * F.col("p")
    summed = points.unionByName(asked).select(
        "lang", "source", "other", "p",
        F.sum("m").over(upto).alias("n_below"), F.sum(weight).over(upto).alias("below"),
        F.sum("m").over(group).alias("n_all"), F.sum(weight).over(group).alias("all"),
    )
    above = F.col("all") - F.col("below") - F.col("p") * (F.col("n_all") - F.col("n_below"))
    return summed.where(F.col("other").isNotNull()).select(
        "lang", "source", "other", (F.col("p") * F.col("n_below") - F.col("below") + above).alias("apart")
    )


def source_distances(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language), value and rank."""
    shares = kept.join(sizes, ["lang", "source"]).select(
        "lang", "term", "source", "absent", _share(F.col("n"), F.col("size"), F.col("lang_terms")).alias("p")
    )
    other = sizes.select("lang", F.col("source").alias("other"), F.col("absent").alias("other_absent"), F.col("n_terms").alias("other_terms"))
    pairs = sizes.join(other, "lang").where(F.col("source") != F.col("other"))
    apart = _absent_sums(shares, pairs.where(F.col("lang_terms") > 0))
    shared = (
        shares.repartition("lang", "term")
        .sortWithinPartitions("lang", "term", "source")
        .mapInArrow(overlaps, OVERLAP)
        .groupBy("lang", "low", "high")
        .agg(F.sum("shared").alias("shared"), F.sum("correction").alias("correction"))
    )
    back = apart.select("lang", F.col("source").alias("high"), F.col("other").alias("low"), F.col("apart").alias("back"))
    zero = F.lit(0).cast("bigint")
    neither = F.col("lang_terms") - F.col("n_terms") - F.col("other_terms") + F.coalesce(F.col("shared"), zero)
    value = (
        F.col("apart") + F.col("back") + F.coalesce(F.col("correction"), zero)
        + neither * F.abs(F.col("absent") - F.col("other_absent"))
    )
    summed = (
        pairs.where(F.col("source") < F.col("other"))
        .withColumnsRenamed({"source": "low", "other": "high"})
        .join(apart.withColumnsRenamed({"source": "low", "other": "high"}), ["lang", "low", "high"], "left")
        .join(back, ["lang", "low", "high"], "left")
        .join(shared, ["lang", "low", "high"], "left")
        .select("lang", "low", "high", F.when(F.col("lang_terms") > 0, value).otherwise(zero).alias("value"))
    )
    ways = F.array(
        F.struct(F.col("low").alias("source"), F.col("high").alias("item")),
        F.struct(F.col("high").alias("source"), F.col("low").alias("item")),
    )
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        summed.select("lang", F.inline(ways), "value")
        .select("lang", "source", "item", "value", F.row_number().over(by_value).alias("rank"))
    )


def source_divergence(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, k: int = LEADING) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank, as described above."""
    kept = stored(kept_counts(documents, min_documents), "divergence-counts")
    sizes = stored(group_sizes(documents, kept), "divergence-sizes")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_distances(kept, sizes).withColumn("part", F.lit("pair")).select(*columns)
    terms = leading_terms(kept, sizes, k).withColumn("part", F.lit("term")).select(*columns)
    return pairs.unionByName(terms)
