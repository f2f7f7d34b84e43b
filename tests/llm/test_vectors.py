"""Vector searches against brute force, with odd rows."""

import math
import random

import numpy as np
import pytest

from logforge.llm import ann, exact_topk, queries
from logforge.llm.vectors import best_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, v string, buckets string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def odd_rows(n=400, dim=6, seed=4, step=1):
    rng = random.Random(seed)
    rows = [(i * step, [rng.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    same = rows[7][1]
    rows += [(10_000 + i, same) for i in range(60)]  # one vector many times
    rows += [(None, same), (20_000, None), (20_100, [1.0, None] + [0.0] * (dim - 2)), (20_200, [math.nan] * dim),
             (20_300, [math.inf] * dim), (20_400, [0.0] * dim), (20_500, [1.0] * (dim - 1)), (20_600, [0.5] * (dim - 1)),
             (20_700, []), (20_600, [0.5] * (dim - 1))]
    # Ids with several vectors, some of them queries; equal rows more often than any query has room for.
    rows += [(100, [0.9] * dim), (100, [0.1] * dim), (3, [-0.9] * dim), (5, [0.8] * dim), (5, [0.7] * dim)]
    rows += [(9, [0.95] * dim)] * 30 + [(200, [0.3] * dim)] * 3
    return rows


def valid(rows, nonzero):
    """Rows that take part: (id, vector), as often as they are there."""
    out = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (nonzero and not any(v)):
            continue
        out.append((i, tuple(float(np.float32(x)) for x in v)))
    return out


def brute(vectors, every, k, product):
    """Best pairs of each query id with rows of other ids."""
    pairs = {}
    for q, v in vectors:
        if q % every == 0:
            found = pairs.setdefault(q, [])
            found += [(-product(v, w), i) for i, w in vectors if i != q and len(w) == len(v)]
    return sorted((q, r + 1, i, -s) for q, found in pairs.items() for r, (s, i) in enumerate(sorted(found)[:k]))


@pytest.mark.parametrize("block, cell", [(256, 32), (16, 2)])
def test_exact_top_k(spark, monkeypatch, block, cell):
    monkeypatch.setattr(exact_topk, "BLOCK", block)
    monkeypatch.setattr(exact_topk, "CELL_BLOCKS", cell)
    monkeypatch.setattr(exact_topk, "CHUNK_QUERIES", 3)
    rows = odd_rows()
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v in valid(rows, False)]
    found = exact_topk.exact_top_k(table(spark, rows), every=100, k=10)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
    assert got == brute(vectors, 100, 10, lambda a, b: sum(x * y for x, y in zip(a, b)))


def test_blocks_are_pruned():
    """Blocks whose bounds fall below the kth score are not scored."""
    rng = np.random.default_rng(0)
    query = np.array([[100, 50, -20]])
    blocks, scored = [], []

    class Watched(np.ndarray):
        pass

    for b in range(20):
        rows = rng.integers(0, 10, (32, 3)) + (20 - b) * 50
        blocks.append((np.arange(b * 32, b * 32 + 32), rows, rows.max(axis=0), rows.min(axis=0)))
    original = exact_topk._products

    def watched(left, right):
        scored.append(right.shape)
        return original(left, right)

    exact_topk._products = watched
    try:
        _, scores, ids = exact_topk.search_blocks(np.array([-1]), query, blocks, 5)
    finally:
        exact_topk._products = original
    whole = np.concatenate([b[1] for b in blocks]) @ query[0]
    assert sorted(scores.tolist(), reverse=True) == sorted(whole.tolist(), reverse=True)[:5]
    assert sum(shape == (32, 3) for shape in scored) < 10


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_topk.exact_top_k(empty).count() == 0
    assert ann.nearest(empty).count() == 0
    nothing = table(spark, [(1, [1.0]), (None, [2.0]), (20, None)])
    assert exact_topk.exact_top_k(nothing).count() == 0 and ann.nearest(nothing).count() == 0


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def test_nearest_scores_order_and_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_ROWS", 50)
    monkeypatch.setattr(ann, "CELL_ROWS", 200)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 9)
    rows = odd_rows(1500)
    vectors = valid(rows, True)
    found = ann.nearest(table(spark, rows), every=20, k=20)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    known = {}
    for i, v in vectors:
        known.setdefault(i, []).append(v)
    got, want = {}, {}
    for r in found.collect():
        assert any(r["score"] == dot(a, b) for a in known[r["query_id"]] for b in known[r["vec_id"]])
        got.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    for q, _, i, score in brute(vectors, 20, 20, dot):
        want.setdefault(q, []).append((-score, i))
    assert set(got) == set(want)
    hits = 0
    for q, rows_of_q in got.items():
        rows_of_q.sort()
        assert [r for r, _, _ in rows_of_q] == list(range(1, len(want[q]) + 1))
        assert [x[1:] for x in rows_of_q] == sorted(x[1:] for x in rows_of_q)
        left = list(want[q])
        for x in rows_of_q:
            if x[1:] in left:
                left.remove(x[1:])
                hits += 1
    assert hits / sum(map(len, want.values())) >= 0.9


def test_ties_go_to_smaller_ids(spark):
    """More equal scores than a query has room for: of one vector, and of many different ones."""
    one = [(i, [1.0, 0.0]) for i in range(400)]
    found = ann.nearest(table(spark, one), every=500, k=20).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == list(range(1, 21))
    many = [(0, [1.0, 0.0, 0.0])] + [(400 - i, [1.0, math.cos(i) / 9, math.sin(i) / 9]) for i in range(399)]
    found = ann.nearest(table(spark, many), every=500, k=20).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(i, 1.0) for i in range(2, 22)]


def test_repeated_ids_as_in_sql(spark):
    import duckdb

    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.25, 0.0]), (2, [0.1, 0.0]), (2, [0.1, 0.0]), (100, [0.0, 1.0]), (100, [0.3, 0.3])]
    embeddings = table(spark, rows).select("vec_id", "embedding").toPandas()  # noqa: F841 - read by duckdb
    want = duckdb.sql(queries.ORACLES["op3_exact_topk"]).fetchall()
    columns = [d[0] for d in duckdb.sql(queries.ORACLES["op3_exact_topk"]).description]
    got = exact_topk.exact_top_k(table(spark, rows)).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert (0, 1, 1, 524288) in [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got]


def test_few_candidates_are_all_found(spark):
    rows = [(i * 20, [math.cos(i), math.sin(i), 0.01 * i]) for i in range(9)]
    found = ann.nearest(table(spark, rows), every=20, k=20).collect()
    assert len(found) == 9 * 8


def test_bands_of_norms(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) * 10.0 ** (i % 4)).tolist()) for i in range(600)]
    vectors = valid(rows, True)
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(table(spark, rows)).collect()}
    want = {(q, i) for q, _, i, _ in brute(vectors, 20, 20, dot)}
    assert len(got & want) / len(want) >= 0.9


def test_best_k_breaks_ties_by_id():
    queries, scores, ids = best_k(
        np.array([1, 0, 1, 1]), np.array([5, 1, 5, 7]), np.array([9, 3, 2, 4]), 2)
    assert list(zip(queries, scores, ids)) == [(0, 1, 3), (1, 7, 4), (1, 5, 2)]
