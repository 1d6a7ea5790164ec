from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from userlake.llm import metric_tree
from userlake.llm.metric_tree import LOWEST, Node, Space, build_pages, build_tree, pack, search_node, search_tree, unpack

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, every, k):
    """Full comparison in Python numbers; the place among the rows stands in for the place in the table."""
    whole = []
    for place, (vec_id, vector) in enumerate(rows):
        if vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            whole.append((place, vec_id, [int(np.floor(64 * float(np.float32(x)))) for x in vector]))
    out = []
    for place, query, q in whole:
        if query is None or query % every:
            continue
        scores = [
            (-sum(a * b for a, b in zip(q, x)), vec_id is None, vec_id or 0, vec_id)
            for other, vec_id, x in whole
            if other != place and len(x) == len(q)
        ]
        out += [(query, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, every=5, k=4, block=16, schema=SCHEMA, **sizes):
    tree = build_tree(spark.createDataFrame(rows, schema).repartition(3), **sizes)
    queries = tree.rows.where(f"vec_id % {every} = 0")
    result = search_tree(tree, queries, k, block).select("query_id", "rank", "vec_id", "score")
    return sorted(map(tuple, result.collect()), key=str)


def clustered(seed, n=300, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] * 2 + rng.normal(size=dim) * 0.2).tolist()) for i in range(n)]


SMALL = {"pivots": 6, "rows_per_pivot": 20, "node_rows": 40, "page_rows": 8}


@pytest.mark.parametrize("sizes", [SMALL, {**SMALL, "pivots": 1}, {}])
def test_equals_full_comparison(spark, sizes):
    rows = clustered(1)
    assert found(spark, rows, **sizes) == brute(rows, 5, 4)


def test_ties_copies_and_one_hot_vector(spark):
    # A third of all rows are one vector, many others tie on a coarse grid.
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 == 0 else rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(240)]
    assert found(spark, rows, **SMALL) == brute(rows, 5, 4)


def test_odd_rows(spark):
    rows = clustered(3, 60, 3)
    rows += [(None, [9.0, 9.0, 9.0]), (100, None), (105, [1.0, None, 2.0]), (110, [float("nan"), 0.0, 0.0]), (115, [float("inf"), 0.0, 0.0])]
    rows += [(120, []), (125, []), (130, [1.0, 2.0]), (131, [3.0, 4.0]), (135, [1.0]), (140, [0.0, 0.0, 0.0])]
    assert found(spark, rows, **SMALL) == brute(rows, 5, 4)


def test_repeated_rows_find_each_other(spark):
    rows = [(5, [1.0, 2.0]), (5, [1.0, 2.0]), (7, [0.5, 0.5])]
    assert found(spark, rows, **SMALL) == brute(rows, 5, 4)


def test_very_large_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, -1e30]), (2, [-1e30, 1.0]), (3, [1e5, 1e5]), (5, [3.0, 4.0])]
    top = [r for r in found(spark, rows, k=2, **SMALL) if r[0] == 5]
    assert [r[2] for r in sorted(top, key=lambda r: r[1])] == [0, 3]


def test_fewer_rows_than_asked_empty_table_and_further_columns(spark):
    rows = [(0, [1.0, 1.0]), (1, [2.0, 0.0])]
    assert found(spark, rows, k=20, **SMALL) == [(0, 1, 1, 8192)]
    wide = SCHEMA + ", dim int, data string, uid string, query int"
    assert found(spark, [(*r, 1, "x", "y", 2) for r in rows], k=20, schema=wide, **SMALL) == [(0, 1, 1, 8192)]
    assert found(spark, [], **SMALL) == []


def test_long_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5000).tolist()) for i in range(12)]
    assert found(spark, rows, **SMALL) == brute(rows, 5, 4)


@pytest.mark.parametrize("vector", [[0, 127, -127], [128, 0, 0], [40000, -3, 2], [2.0**40, 1, 0]])
def test_packing_is_exact(vector):
    assert unpack([pack(np.array(vector, float))], 3)[0].tolist() == vector


def node_of(x, page_rows=16):
    longest2 = float((x * x).sum(1).max())
    root = metric_tree.Root(Space(longest2), {x.shape[1]: [0]}, {x.shape[1]: x[:1]})
    table = pa.table(
        {"uid": np.arange(len(x)), "vec_id": np.arange(len(x)), "data": [pack(v) for v in x]},
    )
    key = tuple(pa.scalar(v, pa.int32()) for v in (x.shape[1], 0, 0))
    return Node(build_pages(root, page_rows)(key, table), x.shape[1]), root


def test_bounds_avoid_most_computations_on_clustered_vectors():
    rng = np.random.default_rng(5)
    x = np.floor((np.repeat(rng.normal(size=(40, 12)), 50, axis=0) + rng.normal(size=(2000, 12)) * 0.02) * 64)
    node, root = node_of(x, 50)
    queries = x[::50]
    best = search_node(node, root.space, x[0], queries, np.arange(0, 2000, 50), np.full(40, LOWEST), 5)
    assert best.computed < 0.3 * len(queries) * len(x)
    scores = queries @ x.T
    scores[np.arange(40), np.arange(0, 2000, 50)] = -np.inf
    want = np.sort(scores, axis=1)[:, ::-1][:, :5]
    assert np.array_equal(best.score.reshape(40, 5), want.astype(np.int64))


def test_a_known_bound_keeps_ties_and_drops_the_rest():
    x = np.floor(np.random.default_rng(6).normal(size=(400, 6)) * 64)
    node, root = node_of(x)
    scores = x[:10] @ x.T
    scores[np.arange(10), np.arange(10)] = -np.inf
    known = np.sort(scores, axis=1)[:, -3].astype(np.int64)
    best = search_node(node, root.space, x[0], x[:10], np.arange(10), known, 20)
    assert np.bincount(best.query).tolist() == [3] * 10


def test_covering_radii_and_parent_distances_hold():
    x = np.floor(np.random.default_rng(7).normal(size=(300, 5)) * 64)
    node, root = node_of(x)
    for page in node.pages:
        apart = root.space.between(page.routing[None, :], page.vectors)[0]
        assert np.allclose(apart, page.distances, atol=1e-4) and page.distances.max() <= page.radius + 1e-9
        assert abs(root.space.between(page.routing[None, :], x[:1])[0, 0] - page.to_pivot) < 1e-4
