"""Byte-level BPE encoding by speculation, and decoding.

Greedy longest match proposes tokens for each distinct pre-token. A proposal
whose tokens each encode to themselves is what merging would give exactly when
no merge crosses a boundary between two neighbours, and whether one does shows
from those two tokens alone. All neighbours of a batch are checked together in
arrays; only pre-tokens with a failing pair are merged step by step.

Defined cases: a null text is empty and has no tokens; special strings inside
a text are special tokens; repeated rows are encoded each; an empty table gives
an empty result; further columns are ignored or kept as stated by the function.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from userlake.llm.pretokens import PreTokens

# Distinct pre-tokens a task remembers before it starts anew.
REMEMBERED = 1 << 19
_NEVER = np.int64(1) << 40
# Up to this many bytes a scan for the lowest rank beats a heap.
SHORT = 48


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of the vocabulary stands for: printable Latin-1 for itself, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The vocabulary and merges of a byte-level BPE file."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            description = json.load(source)
        symbols = byte_of_symbol()
        spell = lambda token: bytes(symbols[c] for c in token)
        vocabulary = {token: i for token, i in description["model"]["vocab"].items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in description["model"]["merges"]]
        size = max([*vocabulary.values(), *(t["id"] for t in description["added_tokens"])]) + 1
        self.size = size
        self.bytes_of: list[bytes] = [b""] * size
        for token in description["added_tokens"]:
            self.bytes_of[token["id"]] = token["content"].encode()
        added = {token["content"] for token in description["added_tokens"]}
        for token, number in vocabulary.items():
            if token not in added:
                self.bytes_of[number] = spell(token)
        self.byte_id = [0] * 256
        for symbol, byte in symbols.items():
            self.byte_id[byte] = vocabulary[symbol]
        self.rank_of_pair: dict[tuple[int, int], tuple[int, int]] = {}
        # Of each token the rank of the merge that makes it, and its two parts.
        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        for rank, (a, b) in enumerate(merges):
            pair, made = (vocabulary[a], vocabulary[b]), vocabulary[a + b]
            self.rank_of_pair[pair] = (rank, made)
            if self.rank[made] < 0:
                self.rank[made], (self.left[made], self.right[made]) = rank, pair
        keys = np.array([a * size + b for a, b in self.rank_of_pair], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.rank_of_pair.values()], np.int64)[order]
        # Tokens that merging their own bytes gives back: only these are proposed.
        self.proposed = {
            spelled: number
            for number, spelled in enumerate(self.bytes_of)
            if spelled and (len(spelled) == 1 or self.rank[number] >= 0) and self.merge(spelled) == [number]
        }
        # Lengths of the longest proposed tokens by their first two bytes.
        self.longest: dict[bytes, int] = {}
        for spelled in self.proposed:
            start = spelled[:2]
            self.longest[start] = max(self.longest.get(start, 1), len(spelled))

    def merge(self, piece: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        return self._merge_short(piece) if len(piece) <= SHORT else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        rank_of, never = self.rank_of_pair.get, (int(_NEVER), 0)
        ids = [self.byte_id[b] for b in piece]
        ranks = [rank_of(pair, never) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is never:
                break
            i = ranks.index(best)
            ids[i] = best[1]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), never)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), never)
        return ids

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = [self.byte_id[b] for b in piece]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        pairs = self.rank_of_pair
        heap = [
            (pairs[pair][0], i, pair) for i in range(len(ids) - 1) if (pair := (ids[i], ids[i + 1])) in pairs
        ]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = pairs[pair][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := (ids[a], ids[b])) in pairs:
                    heapq.heappush(heap, (pairs[new][0], a, new))
        return [x for x in ids if x >= 0]

    def propose(self, piece: bytes) -> list[int]:
        """Greedy longest match."""
        ids, i, n, known, longest = [], 0, len(piece), self.proposed, self.longest
        while i < n:
            for j in range(min(n, i + longest.get(piece[i : i + 2], 1)), i, -1):
                found = known.get(piece[i:j])
                if found is not None:
                    ids.append(found)
                    i = j
                    break
        return ids

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the merges of pairs; those that do not merge rank beyond all."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the boundary between two tokens, pair by pair.

        Goes back in time: of the two parts that touch at the boundary the one
        made last, the right one among equals, is undone. At each state a merge
        of the touching parts crosses if it comes before the left part is merged
        into its token, and not after the right one is.
        """
        good = np.ones(len(left), bool)
        at = np.arange(len(left))
        a, b = left.astype(np.int64), right.astype(np.int64)
        left_until, right_until = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(at):
            m = self.ranks_of(a, b)
            crosses = (m < left_until) & (m <= right_until) & (m < _NEVER)
            good[at[crosses]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            stay = ~crosses & ((rank_a >= 0) | (rank_b >= 0))
            undo_left = rank_a > rank_b
            left_until = np.where(undo_left, rank_a, left_until)[stay]
            right_until = np.where(undo_left, right_until, rank_b)[stay]
            a = np.where(undo_left, self.right[a], a)[stay]
            b = np.where(undo_left, b, self.left[b])[stay]
            at = at[stay]
        return good

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Speculate on all pieces, check all neighbours together, merge what fails."""
        proposals = [self.propose(p) for p in pieces]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((x for p in proposals for x in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(proposals)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        good = self.compatible(flat[inner], flat[inner + 1])
        for i in np.unique(owner[inner[~good]]).tolist():
            proposals[i] = self.merge(pieces[i])
        return proposals

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Encoder:
    """Encodes texts within one task; ids are little-endian unsigned 32-bit."""

    def __init__(self, file: str, merges: Merges):
        self.parts, self.merges = PreTokens(file), merges
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        unknown = [p for p in set(pieces) if p not in self.known]
        if len(self.known) + len(unknown) > REMEMBERED:
            self.known.clear()
            unknown = list(set(pieces))
        ids = self.merges.encode_pieces([p.encode() for p in unknown])
        self.known.update((p, np.array(x, "<u4").tobytes()) for p, x in zip(unknown, ids))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the unknown pre-tokens of all of them are proposed and checked together."""
        cut = []
        for text in texts:
            stretches, specials = self.parts.segments(text)
            cut.append(([self.parts.split(s) for s in stretches], specials))
        self.learn({p for stretches, _ in cut for s in stretches for p in s})
        out = []
        for stretches, specials in cut:
            blobs = [b"".join(map(self.known.__getitem__, s)) for s in stretches]
            marks = [np.array([self.parts.specials[s]], "<u4").tobytes() for s in specials]
            out.append(b"".join(x for pair in zip(blobs, [*marks, b""]) for x in pair))
        return out

    def decode(self, ids: bytes) -> str:
        return self.merges.decode(np.frombuffer(ids, "<u4").tolist())


# Characters of text that are encoded together.
TOGETHER = 1 << 20


def in_blocks(values: Iterable[str], size: int = TOGETHER) -> Iterator[list[str]]:
    block, total = [], 0
    for value in values:
        block.append(value)
        total += len(value)
        if total >= size:
            yield block
            block, total = [], 0
    if block:
        yield block


def _whole(text: str):
    return F.coalesce(F.col(text), F.lit(""))


def digest_codes(documents: DataFrame, file: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    merges = documents.sparkSession.sparkContext.broadcast(Merges(file))  # bounded by the vocabulary

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file, merges.value)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            counts, ids, decoded = [], [], []
            for block in in_blocks(x.as_py() for x in batch.column("text")):
                for code in encoder.encode_all(block):
                    counts.append(len(code) // 4)
                    ids.append(sha(code))
                    decoded.append(sha(encoder.decode(code).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select("doc_id", _whole(text).alias("text")).mapInArrow(
        digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def with_codes(documents: DataFrame, file: str, text: str = "text", codes: str = "token_ids") -> DataFrame:
    """All columns of the documents and the token ids of their texts; `codes` replaces a column of that name."""
    merges = documents.sparkSession.sparkContext.broadcast(Merges(file))  # bounded by the vocabulary
    kept = documents.drop(codes)
    place = kept.columns.index(text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file, merges.value)
        for batch in batches:
            ids, ends = [], [0]
            for block in in_blocks(x.as_py() or "" for x in batch.column(place)):
                for code in encoder.encode_all(block):
                    ids.append(code)
                    ends.append(ends[-1] + len(code) // 4)
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], [*batch.schema.names, codes]
            )

    schema = StructType([*kept.schema.fields, StructField(codes, ArrayType(IntegerType()))])
    return kept.mapInArrow(encode, schema)
