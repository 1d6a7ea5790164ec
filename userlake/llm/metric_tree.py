"""Exact search for the largest inner products with a paged metric tree.

The largest inner products become the nearest neighbours of a metric space: a
vector x gets the further coordinate sqrt(M - |x|^2), M being the largest
squared length, and a query gets zero there, so that the squared distance is
|q|^2 + M - 2 <q, x>.

The tree has three levels. The root holds routing vectors from a sample of at
most PIVOTS rows, each with its covering radius; each of them has as many nodes
of about NODE_ROWS rows as its rows need, so that copies of one vector do not
meet in one task. A node is a set of pages; each page has its own routing
vector, a covering radius, the distance to the root's vector, and its entries
with their distance to the page's vector. Pages are rows of a stored table.

A query starts in the node that holds it. Its k-th best score bounds the
distance; routing vectors farther away than bound and covering radius are left
out with all their nodes, the others are asked. In a node the pages are taken
in order of their nearest possible entry until that lies beyond the bound.
Stored distances come first: by the triangle inequality the distance to the
root's vector can settle a page, and that to the page's vector an entry, before
either is computed. Bounds have a margin for rounding and keep ties; scores are
exact whole numbers, so the result is that of a full comparison.

Queries and nodes meet in blocks of bounded size. Only the sample of routing
vectors reaches the driver.

Defined cases: a null vector and one with a null or non-finite component take
no part; vectors of different length have no score with each other, those of
length zero score 0; a row without vec_id is found but does not ask, and comes
last among ties; of rows with one vec_id each is a row of its own, ties among
them are settled by their place in the table; scores beyond a long stay at its
end; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from userlake.llm.common import stored

SCALE = 64
TOP = 20
# A row asks if its vec_id is divisible by this.
EVERY = 20
# Routing vectors of the root, and rows for which one more is taken.
PIVOTS = 256
ROWS_PER_PIVOT = 2048
NODE_ROWS = 8192
PAGE_ROWS = 128
QUERY_BLOCK = 2048
# Part of the largest distance by which bounds are widened, against rounding.
MARGIN = 1e-6

LOWEST = -(2**63) + 1
CELL = ["dim", "pivot", "chunk"]
VECTOR = "vec_id bigint, dim int, data binary, length2 double"
ASSIGNED = "uid bigint, vec_id bigint, dim int, data binary, pivot int, distance double"
PAGE = (
    "dim int, pivot int, chunk int, page int, routing binary, radius double, to_pivot double,"
    " vec_ids array<bigint>, uids array<bigint>, distances array<double>, entries array<binary>"
)
FOUND = "query bigint, query_id bigint, vec_id bigint, uid bigint, score bigint"


# ---------------------------------------------------------------- vectors


def pack(vector: np.ndarray) -> bytes:
    """A vector of whole numbers in the narrowest type that holds it."""
    reach = np.abs(vector).max(initial=0)
    width = np.int8 if reach < 1 << 7 else np.int16 if reach < 1 << 15 else np.int32 if reach < 1 << 31 else np.float64
    return vector.astype(width).tobytes()


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    """Packed vectors of one length as the rows of a matrix."""
    kinds = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}
    if dim == 0 or not packed:
        return np.zeros((len(packed), dim))
    if len({len(p) for p in packed}) == 1:
        return np.frombuffer(b"".join(packed), kinds[len(packed[0]) // dim]).reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(p, kinds[len(p) // dim]).astype(np.float64) for p in packed])


def scale_vectors(scale: float):
    """Whole numbers floor(scale * x) of each vector that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, data, lengths = [], [], [], []
            for vec_id, vector in zip(batch.column("vec_id"), batch.column("embedding")):
                if not vector.is_valid or vector.values.null_count:
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    whole = np.nan_to_num(np.floor(scale * x))
                    lengths.append(float(whole @ whole))
                ids.append(vec_id.as_py())
                dims.append(len(x))
                data.append(pack(whole))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(data, pa.binary()), pa.array(lengths, pa.float64())],
                ["vec_id", "dim", "data", "length2"],
            )

    return run


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products as whole numbers."""
    reach = queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0)
    if reach < 2**53:  # every partial sum is a whole number that a double holds
        return (queries @ vectors.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in vectors]
    scores = [[sum(int(a) * b for a, b in zip(q, x)) for x in whole] for q in queries]
    return np.array([[min(max(s, LOWEST), 2**63 - 1) for s in row] for row in scores], np.int64)


@dataclass(frozen=True)
class Space:
    """The metric: `longest2` is the largest squared length of all vectors."""

    longest2: float

    def _further(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest2 - np.einsum("ij,ij->i", x, x), 0))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of vectors of the table."""
        with np.errstate(all="ignore"):
            return np.sqrt(np.maximum(2 * (self.longest2 - a @ b.T - np.outer(self._further(a), self._further(b))), 0))

    def from_queries(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return np.sqrt(np.maximum(np.einsum("ij,ij->i", q, q)[:, None] + self.longest2 - 2 * (q @ x.T), 0))

    def reach(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance of each query to a vector of that score, widened; endless without a score."""
        with np.errstate(all="ignore"):
            far2 = np.einsum("ij,ij->i", q, q) + self.longest2
            reach = np.sqrt(np.maximum(far2 - 2 * score.astype(np.float64), 0)) + MARGIN * np.sqrt(far2)
        return np.where((score == LOWEST) | ~np.isfinite(reach), np.inf, reach)


# ---------------------------------------------------------------- index


@dataclass(frozen=True)
class Root:
    """Routing vectors of the root: place -> vector, for each vector length."""

    space: Space
    places: dict[int, list[int]]
    vectors: dict[int, np.ndarray]


def sample_root(vectors: DataFrame, pivots: int, rows_per_pivot: int) -> Root:
    """Routing vectors: distinct ones among the first rows by a hash, at most `pivots` of them; they pass the driver."""
    n, longest2 = vectors.agg(F.count("*"), F.max("length2")).first()
    wanted = min(pivots, -(-n // rows_per_pivot))
    rows = vectors.select("dim", "data").orderBy(F.xxhash64("uid"), "uid").limit(wanted).collect()
    places: dict[int, list[int]] = {}
    chosen: dict[int, list[bytes]] = {}
    for place, (dim, data) in enumerate(sorted({(r["dim"], bytes(r["data"])) for r in rows})):
        places.setdefault(dim, []).append(place)
        chosen.setdefault(dim, []).append(data)
    return Root(Space(longest2 or 0.0), places, {dim: unpack(data, dim) for dim, data in chosen.items()})


def assign(root: Root):
    """Each vector with its nearest routing vector of the root; -1 if there is none of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            pivot, distance = np.full(len(dims), -1, np.int32), np.zeros(len(dims))
            for dim in set(dims.tolist()) & set(root.places):
                at = np.flatnonzero(dims == dim)
                x = unpack(batch.column("data").take(pa.array(at)).to_pylist(), dim)
                far = np.nan_to_num(root.space.between(x, root.vectors[dim]), nan=np.inf)
                nearest = far.argmin(axis=1)
                pivot[at] = np.array(root.places[dim], np.int32)[nearest]
                distance[at] = far[np.arange(len(at)), nearest]
            columns = [batch.column(c) for c in ("uid", "vec_id", "dim", "data")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pivot), pa.array(distance)], ["uid", "vec_id", "dim", "data", "pivot", "distance"]
            )

    return run


def build_pages(root: Root, page_rows: int):
    """The pages of a node: entries with the nearest of the page vectors, in rings of like distance."""

    def run(key: tuple, node: pa.Table) -> pa.Table:
        dim, pivot, chunk = (k.as_py() for k in key)
        node = node.sort_by("uid")
        x = unpack(node.column("data").to_pylist(), dim)
        shuffled = np.random.default_rng(0).permutation(len(x))
        routing = x[shuffled[: -(-len(x) // page_rows)]]
        far = np.nan_to_num(root.space.between(x, routing), nan=np.inf)
        nearest = far.argmin(axis=1)
        own = far[np.arange(len(x)), nearest]
        to_pivot = np.full(len(routing), np.nan)
        if pivot >= 0:
            parent = root.vectors[dim][[root.places[dim].index(pivot)]]
            to_pivot = root.space.between(routing, parent)[:, 0]
        order = np.lexsort((own, nearest))
        rows = []
        for r in range(len(routing)):
            members = order[np.searchsorted(nearest[order], r) : np.searchsorted(nearest[order], r, "right")]
            for at in range(0, len(members), page_rows):
                part = members[at : at + page_rows]
                picked = node.take(pa.array(part))
                rows.append(
                    {
                        "dim": dim, "pivot": pivot, "chunk": chunk, "page": len(rows), "routing": pack(routing[r]),
                        "radius": float(own[part].max()), "to_pivot": float(to_pivot[r]),
                        "vec_ids": picked.column("vec_id").to_pylist(), "uids": picked.column("uid").to_pylist(),
                        "distances": own[part].tolist(), "entries": picked.column("data").to_pylist(),
                    }
                )
        return pa.Table.from_pylist(rows, PAGE_ARROW)

    return run


PAGE_ARROW = pa.schema(
    [
        ("dim", pa.int32()), ("pivot", pa.int32()), ("chunk", pa.int32()), ("page", pa.int32()),
        ("routing", pa.binary()), ("radius", pa.float64()), ("to_pivot", pa.float64()),
        ("vec_ids", pa.list_(pa.int64())), ("uids", pa.list_(pa.int64())),
        ("distances", pa.list_(pa.float64())), ("entries", pa.list_(pa.binary())),
    ]
)


# ---------------------------------------------------------------- search in a node


@dataclass
class Page:
    routing: np.ndarray
    radius: float
    to_pivot: float
    first: int  # place of its first entry among those of the node
    vectors: np.ndarray
    distances: np.ndarray


class Node:
    """The pages of a node and what identifies their entries."""

    def __init__(self, pages: pa.Table, dim: int):
        self.pages: list[Page] = []
        ids, uids = [], []
        for row in pages.to_pylist():
            routing = unpack([row["routing"]], dim)[0]
            vectors = unpack(row["entries"], dim)
            self.pages.append(
                Page(routing, row["radius"], row["to_pivot"], len(ids), vectors, np.array(row["distances"]))
            )
            ids += row["vec_ids"]
            uids += row["uids"]
        self.vec_ids = ids
        self.uids = np.array(uids, np.int64)
        self.unnamed = np.array([i is None for i in ids], bool)
        self.order_ids = np.array([0 if i is None else i for i in ids], np.int64)


@dataclass
class Best:
    """Best entries of each query, by query, score, vec_id and place in the table."""

    query: np.ndarray
    score: np.ndarray
    entry: np.ndarray
    computed: int  # scores that were computed


def search_node(
    node: Node, space: Space, pivot: np.ndarray | None, queries: np.ndarray, own: np.ndarray, known: np.ndarray, k: int
) -> Best:
    """Best-first search of a block of queries in one node.

    `own` is the row that asks, which does not count; `known` a score that k
    rows elsewhere have, or LOWEST; entries below it are not looked for.
    """
    pages = node.pages
    radius = np.array([p.radius for p in pages])
    lower = np.full((len(queries), len(pages)), -np.inf)
    floor = known.copy()
    reach = space.reach(queries, floor)
    if pivot is not None:  # what the stored distance to the parent tells before any distance is computed
        apart = np.abs(space.from_queries(queries, pivot[None, :]) - np.array([p.to_pivot for p in pages]))
        lower = np.nan_to_num(apart - radius, nan=-np.inf)
    asked = ~(lower > reach[:, None])
    some = np.flatnonzero(asked.any(axis=0))
    distance = np.full(lower.shape, np.nan)
    if len(some):
        distance[:, some] = space.from_queries(queries, np.stack([pages[i].routing for i in some]))
        lower[:, some] = np.fmax(lower[:, some], distance[:, some] - radius[some])
    visits = np.argsort(lower, axis=1, kind="stable")
    best = Best(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 0)
    active = np.arange(len(queries))
    for turn in range(len(pages)):
        page_of = visits[active, turn]
        near = ~(lower[active, page_of] > reach[active])
        active, page_of = active[near], page_of[near]
        if not len(active):
            break
        hits = [(best.query, best.score, best.entry)]
        order = np.argsort(page_of, kind="stable")
        cuts = np.flatnonzero(np.diff(page_of[order])) + 1
        for members in np.split(order, cuts):
            here, page = active[members], pages[page_of[members[0]]]
            spread = np.abs(distance[here, page_of[members[0]]][:, None] - page.distances)
            open_to = ~(spread > reach[here][:, None])
            columns = np.flatnonzero(open_to.any(axis=0))
            scores = exact_scores(queries[here], page.vectors[columns])
            best.computed += scores.size
            entry = page.first + columns
            good = (scores >= floor[here][:, None]) & (node.uids[entry][None, :] != own[here][:, None])
            row, column = np.nonzero(good)
            hits.append((here[row], scores[row, column], entry[column]))
        query, score, entry = (np.concatenate(part) for part in zip(*hits))
        order = np.lexsort((node.uids[entry], node.order_ids[entry], node.unnamed[entry], -score, query))
        query, score, entry = query[order], score[order], entry[order]
        starts = np.searchsorted(query, query)
        place = np.arange(len(query)) - starts
        stays = place < k
        best.query, best.score, best.entry = query[stays], score[stays], entry[stays]
        full = place == k - 1
        floor[query[full]] = np.maximum(floor[query[full]], score[full])
        reach = space.reach(queries, floor)
    return best


def search(root: Root, k: int):
    """The best entries of a node for the queries of a block."""

    def run(key: tuple, pages: pa.Table, asks: pa.Table) -> pa.Table:
        dim, pivot = key[0].as_py(), key[1].as_py()
        if not pages.num_rows or not asks.num_rows:
            return pa.Table.from_pylist([], FOUND_ARROW)
        node = Node(pages, dim)
        parent = root.vectors[dim][root.places[dim].index(pivot)] if pivot >= 0 else None
        own = asks.column("query").to_numpy()
        known = asks.column("bound").fill_null(LOWEST).to_numpy().astype(np.int64)
        best = search_node(node, root.space, parent, unpack(asks.column("data").to_pylist(), dim), own, known, k)
        return pa.Table.from_arrays(
            [
                pa.array(own[best.query]), asks.column("query_id").take(pa.array(best.query)).combine_chunks(),
                pa.array([node.vec_ids[e] for e in best.entry.tolist()], pa.int64()),
                pa.array(node.uids[best.entry]), pa.array(best.score),
            ],
            schema=FOUND_ARROW,
        )

    return run


FOUND_ARROW = pa.schema([(c, pa.int64()) for c in ("query", "query_id", "vec_id", "uid", "score")])


# ---------------------------------------------------------------- distributed search


@dataclass(frozen=True)
class MetricTree:
    """The stored index: `rows` are all vectors with their node, `nodes` the routing vectors' sizes, `pages` the nodes."""

    root: Root
    rows: DataFrame
    nodes: DataFrame
    pages: DataFrame


def build_tree(
    embeddings: DataFrame, scale: float = SCALE, pivots: int = PIVOTS, rows_per_pivot: int = ROWS_PER_PIVOT,
    node_rows: int = NODE_ROWS, page_rows: int = PAGE_ROWS,
) -> MetricTree:
    """Index every vector of `embeddings` (vec_id, embedding)."""
    scaled = embeddings.select("vec_id", "embedding").mapInArrow(scale_vectors(scale), VECTOR)
    vectors = stored(scaled.withColumn("uid", F.monotonically_increasing_id()), "metric-vectors")
    root = sample_root(vectors, pivots, rows_per_pivot)
    assigned = stored(
        vectors.select("uid", "vec_id", "dim", "data").mapInArrow(assign(root), ASSIGNED), "metric-assigned"
    )
    nodes = stored(
        assigned.groupBy("dim", "pivot").agg(
            F.max("distance").alias("radius"), F.ceil(F.count("*") / node_rows).cast("int").alias("chunks")
        ),
        "metric-nodes",
    )
    chunk = F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int").alias("chunk")
    rows = assigned.join(nodes, ["dim", "pivot"]).select("uid", "vec_id", "dim", "data", "pivot", chunk)
    pages = stored(rows.groupBy(*CELL).applyInArrow(build_pages(root, page_rows), PAGE), "metric-pages")
    return MetricTree(root, rows, nodes, pages)


def _ask(tree: MetricTree, asks: DataFrame, k: int, block: int) -> DataFrame:
    """Each query asked in its node; asks (query, query_id, dim, data, bound, pivot, chunk) meet the node in blocks."""
    blocks = asks.groupBy(*CELL).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = asks.join(blocks, CELL).withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
    pages = tree.pages.join(blocks, CELL).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = [*CELL, "block"]
    left = pages.drop("blocks").groupBy(*cell)
    return left.cogroup(dealt.drop("blocks").groupBy(*cell)).applyInArrow(search(tree.root, k), FOUND)


def open_pivots(root: Root, radii: dict[int, float]):
    """For each query the routing vectors of the root whose vectors may be within its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            bound = batch.column("bound").fill_null(LOWEST).to_numpy(zero_copy_only=False).astype(np.int64)
            opened: list[list[int]] = [[-1] for _ in dims]
            for dim in set(dims.tolist()) & set(root.places):
                at = np.flatnonzero(dims == dim)
                q = unpack(batch.column("data").take(pa.array(at)).to_pylist(), dim)
                radius = np.array([radii.get(place, -np.inf) for place in root.places[dim]])
                beyond = root.space.from_queries(q, root.vectors[dim]) - radius > root.space.reach(q, bound[at])[:, None]
                places = np.array(root.places[dim])
                for i, closed in zip(at.tolist(), beyond):
                    opened[i] = places[~closed].tolist()
            columns = [batch.column(c) for c in ("query", "query_id", "dim", "data", "bound", "home_pivot", "home_chunk")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(opened, pa.list_(pa.int32()))],
                ["query", "query_id", "dim", "data", "bound", "home_pivot", "home_chunk", "pivots"],
            )

    return run


def search_tree(tree: MetricTree, queries: DataFrame, k: int = TOP, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows for `queries`, which are rows of the tree."""
    asks = queries.select("dim", "pivot", "chunk", F.col("uid").alias("query"), F.col("vec_id").alias("query_id"), "data")
    at_home = stored(_ask(tree, asks.withColumn("bound", F.lit(None).cast("bigint")), k, block), "metric-home")
    bounds = at_home.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    told = asks.withColumnsRenamed({"pivot": "home_pivot", "chunk": "home_chunk"}).join(bounds, "query", "left")
    told = told.select("query", "query_id", "dim", "data", "bound", "home_pivot", "home_chunk")
    known = tree.nodes.where(F.col("pivot") >= 0).select("pivot", "radius").collect()  # at most PIVOTS rows
    routed = told.mapInArrow(
        open_pivots(tree.root, {r["pivot"]: r["radius"] for r in known}),
        "query bigint, query_id bigint, dim int, data binary, bound bigint, home_pivot int, home_chunk int, pivots array<int>",
    )
    spread = (
        routed.withColumn("pivot", F.explode("pivots"))
        .drop("pivots")
        .join(tree.nodes.select("dim", "pivot", "chunks"), ["dim", "pivot"])
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .where((F.col("pivot") != F.col("home_pivot")) | (F.col("chunk") != F.col("home_chunk")))
        .drop("chunks", "home_pivot", "home_chunk")
    )
    away = _ask(tree, stored(spread, "metric-asks"), k, block)
    best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    ranked = at_home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_vectors(embeddings: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """The search of `search_tree` for the rows whose vec_id is divisible by `every`."""
    tree = build_tree(embeddings)
    queries = stored(tree.rows.where(F.col("vec_id") % every == 0), "metric-queries")
    return search_tree(tree, queries, k)
