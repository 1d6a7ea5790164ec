"""Benchmark decontamination with spaced seeds.

An overlap of at least five aligned words of which four fifths are equal holds
a window of five words with one substitution at most. Fixed masks ignore one
word of such a window each, so one of the hashes under the masks is equal in
benchmark and document. Around each hit the words are compared along the
alignment: a passage is reported when `WINDOW` words in a row (all words of a
shorter item) are equal in at least `MIN_EQUAL` of their places.

The benchmark is taken in blocks of bounded size, each sent to all tasks, and
every document is held against every block; nothing is shuffled. Words are runs
of letters and digits in lower case.

Defined cases: a null or empty text matches nothing; an item of fewer than five
words is not searched for; repeated items are reported each; an item without
item_id contaminates documents as any other, but has no name to be reported
under; repeated rows and rows without doc_id are judged each; empty tables give
an empty result, or all documents as clean; further columns are ignored or kept
as stated; texts are searched whole, and words that repeat, in a text as in an
item, cost what their distinct surroundings do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MASKS = ("1111", "10111", "11011", "11101")
SEED_SPAN = 5
WINDOW = 13
MIN_EQUAL = 0.8
# Words before a hit at which a window that holds its seed can begin.
REACH = WINDOW - SEED_SPAN
# Characters of benchmark text in a block, and words of documents searched together.
BLOCK_CHARS = 8 << 20
TOGETHER = 1 << 19
HITS_TOGETHER = 1 << 17
FILTER_BITS = 22

_WORD = re.compile(r"[^\W_]+")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)

MATCH_SCHEMA = "doc_id bigint, item_id bigint, matched_words bigint, item_words bigint, first_word bigint"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def seeds(codes: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a mask's windows whose words are all known (not 0)."""
    offsets = [k for k, c in enumerate(mask) if c == "1"]
    count = len(codes) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = codes != 0
    whole = np.logical_and.reduce([known[o : o + count] for o in offsets])
    at = np.flatnonzero(whole)
    value = np.zeros(len(at), np.uint64)
    for o, factor in zip(offsets, _FACTORS):
        value = (value ^ codes[at + o]) * factor
        value ^= value >> np.uint64(29)
    return at, value


def first_of_each_surroundings(
    codes: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray, at: np.ndarray
) -> np.ndarray:
    """Of ascending places those whose surroundings no earlier one of their document has, looked at in portions.

    What is verified around a place depends on the words within its reach
    alone, so a page of one repeated word, or of any period, is a few places.
    """
    steps, kept = np.arange(-REACH, WINDOW), []
    for first in range(0, len(at), HITS_TOGETHER):
        here = at[first : first + HITS_TOGETHER, None] + steps
        doc = owner[at[first : first + HITS_TOGETHER]]
        inside = (here >= start[doc][:, None]) & (here < end[doc][:, None])
        around = np.where(inside, codes[np.where(inside, here, 0)], 0)
        rows = np.ascontiguousarray(np.concatenate([doc[:, None].astype(np.uint64), around.astype(np.uint64)], axis=1))
        whole = rows.view(np.dtype((np.void, rows.shape[1] * 8))).reshape(-1)
        kept.append(first + np.sort(np.unique(whole, return_index=True)[1]))
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


class Benchmark:
    """A block of items as codes in one array, and their seeds."""

    def __init__(self, items: list[tuple[int | None, list[str]]]):
        self.ids = [i for i, _ in items]
        self.codes_of: dict[str, int] = {}
        number = self.codes_of.setdefault
        flat = [number(w, len(self.codes_of) + 1) for _, ws in items for w in ws]
        self.codes = np.array(flat, np.uint64)
        lengths = np.array([len(ws) for _, ws in items], np.int64)
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        self.owner = np.repeat(np.arange(len(items)), lengths)
        self.window = np.minimum(lengths, WINDOW)
        self.needed = np.array([math.ceil(MIN_EQUAL * n) for n in self.window.tolist()], np.int64)
        self.index = [self._sorted(mask) for mask in MASKS]

    def _sorted(self, mask: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, value = seeds(self.codes, mask)
        inside = self.owner[at] == self.owner[at + len(mask) - 1]
        at, value = at[inside], value[inside]
        order = np.argsort(value, kind="stable")
        present = np.zeros(1 << FILTER_BITS, bool)
        present[(value >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return value[order], at[order], present


class Search:
    """Matches of documents with one block."""

    def __init__(self, block: Benchmark):
        self.block = block
        self.lookup = block.codes_of.get

    def hits(
        self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in documents and in the block whose seeds are equal, in bounded portions."""
        for mask, (values, places, present) in zip(MASKS, self.block.index):
            at, value = seeds(codes, mask)
            likely = present[(value >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            at, value = at[likely], value[likely]
            inside = owner[at] == owner[at + len(mask) - 1]
            at, value = at[inside], value[inside]
            low, high = np.searchsorted(values, value, "left"), np.searchsorted(values, value, "right")
            found = np.flatnonzero(high > low)
            found = found[first_of_each_surroundings(codes, start, end, owner, at[found])]
            at, low, many = at[found], low[found], (high - low)[found]
            ends = np.cumsum(many)
            for first in range(0, int(ends[-1]) if len(ends) else 0, HITS_TOGETHER):
                rank = np.arange(first, min(first + HITS_TOGETHER, int(ends[-1])))
                k = np.searchsorted(ends, rank, "right")
                yield at[k], places[low[k] + rank - (ends[k] - many[k])]

    def verified(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Rows (document, item, place in block, place in documents) of verified windows.

        Of the windows of one document that are equal to one place of the block
        only the first is kept, after each portion.
        """
        block, rows = self.block, np.zeros((0, 4), np.int64)
        steps = np.arange(-REACH, WINDOW)
        for p, q in self.hits(codes, start, end, owner):
            item, doc = block.owner[q], owner[p]
            width, needed = block.window[item], block.needed[item]
            there, here = q[:, None] + steps, p[:, None] + steps
            in_item = (there >= block.start[item][:, None]) & (there < block.end[item][:, None])
            in_doc = (here >= start[doc][:, None]) & (here < end[doc][:, None])
            both = in_item & in_doc
            equal = both & (
                codes[np.where(both, here, 0)] == block.codes[np.where(both, there, 0)]
            )
            total = np.concatenate([np.zeros((len(p), 1), np.int64), np.cumsum(equal, axis=1)], axis=1)
            hit = np.arange(len(p))
            found = [rows]
            for first in range(REACH + 1):
                begin = q + steps[first]
                last = np.minimum(first + width, len(steps))
                good = (
                    (begin >= block.start[item]) & (begin + width <= block.end[item])
                    & (total[hit, last] - total[hit, first] >= needed) & (first + width <= len(steps))
                )
                found.append(np.stack([doc[good], item[good], begin[good], p[good] + steps[first]], axis=1))
            rows = np.concatenate(found)
            rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 0]))]
            other = np.any(rows[1:, [0, 2]] != rows[:-1, [0, 2]], axis=1)
            rows = rows[np.concatenate([[True], other])] if len(rows) else rows
        return rows

    def matches(self, texts: list[str | None]) -> list[tuple[int, int | None, int, int, int]]:
        """(text, item, words of the item found, words of the item, first word in the text) of each match."""
        cut = [words(t) for t in texts]
        lengths = np.array([len(ws) for ws in cut], np.int64)
        codes = np.fromiter(map(self.lookup, chain.from_iterable(cut), repeat(0)), np.uint64, int(lengths.sum()))
        end = np.cumsum(lengths)
        start = end - lengths
        rows = self.verified(codes, start, end, np.repeat(np.arange(len(cut)), lengths))
        if not len(rows):
            return []
        pairs, inverse = np.unique(rows[:, :2], axis=0, return_inverse=True)
        found = np.zeros(len(pairs), np.int64)
        # Words of the item in the windows: each window adds what the one before it does not reach.
        width = self.block.window[rows[:, 1]]
        new = width.copy()
        follows = np.all(rows[1:, :2] == rows[:-1, :2], axis=1)
        new[1:] = np.where(follows, np.minimum(width[1:], rows[1:, 2] - rows[:-1, 2]), width[1:])
        np.add.at(found, inverse.reshape(-1), new)
        opening = np.full(len(pairs), np.iinfo(np.int64).max)
        np.minimum.at(opening, inverse.reshape(-1), rows[:, 3])
        block = self.block
        return [
            (int(d), block.ids[i], int(n), int(block.end[i] - block.start[i]), max(int(o - start[d]), 0))
            for (d, i), n, o in zip(pairs.tolist(), found.tolist(), opening.tolist())
        ]


def portions(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """First row and texts of runs of rows whose texts are searched together."""
    first, texts, size = 0, [], 0
    for row, value in enumerate(column):
        text = value.as_py()
        texts.append(text)
        size += len(text or "") // 6
        if size >= TOGETHER:
            yield first, texts
            first, texts, size = row + 1, [], 0
    if texts:
        yield first, texts


def blocks(benchmark: DataFrame, size: int = BLOCK_CHARS) -> Iterator[Benchmark]:
    """The benchmark in blocks of bounded text, passed through the driver one at a time; one at least."""
    items, chars = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        cut = words(row["text"])
        if len(cut) < SEED_SPAN:
            continue
        items.append((row["item_id"], cut))
        chars += len(row["text"])
        if chars >= size:
            yield Benchmark(items)
            items, chars = [], 0
    if items:
        yield Benchmark(items)


def find_matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that share a passage: nothing for clean documents."""
    context = documents.sparkSession.sparkContext
    benchmark = benchmark.where("item_id IS NOT NULL")
    given, found = documents.select("doc_id", "text"), None
    for block in blocks(benchmark):
        shared = context.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Search(shared.value)
            for batch in batches:
                ids = batch.column("doc_id")
                for first, texts in portions(batch.column("text")):
                    rows = finder.matches(texts)
                    if rows:
                        doc, *rest = (pa.array(c, pa.int64()) for c in zip(*rows))
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pc.add(doc, first)), *rest],
                            ["doc_id", "item_id", "matched_words", "item_words", "first_word"],
                        )

        part = given.mapInArrow(search, MATCH_SCHEMA)
        found = part if found is None else found.unionByName(part)
    return documents.sparkSession.createDataFrame([], MATCH_SCHEMA) if found is None else found


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no passage with the benchmark, with all their columns."""
    context, place = documents.sparkSession.sparkContext, documents.columns.index("text")
    for block in blocks(benchmark):
        shared = context.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Search(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in portions(batch.column(place)):
                    keep[[first + row[0] for row in finder.matches(texts)]] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
