"""Exact top-k inner products over integer vectors, pruned block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.llm.vectors import best_k, each_time, matrix, ranked, slot, spread, valid_vectors
from logforge.session import staged

SCALE = 1024
#: Vectors of a block; blocks and queries that one task holds at a time.
BLOCK = 256
CELL_BLOCKS = 32
CHUNK_QUERIES = 2_048
LEAST = np.iinfo(np.int64).min

BLOCKS = "block long, dim int, ids array<long>, forward array<long>, high array<long>, low array<long>"


def build_blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of consecutive vec_ids: forward index, and each term's maximum and minimum.

    A term is a component; its weight in a block is bounded by the block's largest value
    for queries where it is positive and by the smallest where it is negative.
    """

    def emit(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([ids[0]], pa.int64()), pa.array([rows.shape[1]], pa.int32()),
            pa.array([ids]), pa.array([rows.ravel()], pa.list_(pa.int64())),
            pa.array([rows.max(axis=0)], pa.list_(pa.int64())),
            pa.array([rows.min(axis=0)], pa.list_(pa.int64()))],
            ["block", "dim", "ids", "forward", "high", "low"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, rows = waiting.setdefault(len(row), ([], []))
                ids.append(key)
                rows.append(row)
                if len(ids) == BLOCK:
                    yield emit(np.array(ids), np.array(rows, np.int64).reshape(BLOCK, -1))
                    waiting[len(row)] = ([], [])
        for ids, rows in waiting.values():
            if ids:
                yield emit(np.array(ids), np.array(rows, np.int64).reshape(len(ids), -1))

    return vectors.mapInArrow(cut, BLOCKS)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of integers: through doubles wherever those are exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0))
    if most * left.shape[1] < 2.0**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def search_blocks(
    query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of queries, scores, ids): the k best of each query over ``blocks``.

    ``blocks`` holds (ids, forward, high, low). A query's bound for a block is the sum over
    terms of the largest product possible in it. Each query visits blocks from the highest
    bound down, and stops when a bound falls below its kth score (equal bounds may still
    bring a smaller id). Queries that are at the same block are scored together.
    """
    high = np.stack([b[2] for b in blocks])
    low = np.stack([b[3] for b in blocks])
    bounds = _products(np.maximum(queries, 0), high) + _products(np.minimum(queries, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(len(queries), LEAST)
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    active = np.arange(len(queries))
    for step in range(len(blocks)):
        turn = order[active, step]
        going = bounds[active, turn] >= kth[active]
        active, turn = active[going], turn[going]
        if not len(active):
            break
        found = [held]
        for block in np.unique(turn):
            visitors = active[turn == block]
            ids, forward = blocks[block][:2]
            scores = _products(queries[visitors], forward)
            fits = (scores >= kth[visitors][:, None]) & (ids[None, :] != query_ids[visitors][:, None])
            at, place = np.nonzero(fits)
            found.append((visitors[at], scores[at, place], ids[place]))
        held = best_k(*[np.concatenate([f[i] for f in found]) for i in range(3)], k)
        ends = np.flatnonzero(np.append(held[0][1:] != held[0][:-1], True)) if len(held[0]) else []
        full = np.bincount(held[0], minlength=len(queries)) >= k
        last = np.full(len(queries), LEAST)
        last[held[0][ends]] = held[1][ends]
        kth = np.where(full, last, LEAST)
    return held


def exact_top_k(table: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k highest integer inner products of each query, ties to smaller vec_id.

    Components become floor(1024 * x). Queries are the vec_ids divisible by ``every``;
    candidates are all other ids with a vector of the same length. Columns: query_id, rank
    (from 1), vec_id, score. Scores are exact 64-bit integers (beyond that they wrap).

    Rows without id or vector, or with null or non-finite components, take no part. Rows that
    repeat an id are candidates of their own, equal ones, too; queries that share an id have
    one ranking, of all their pairs. Other columns are ignored; an empty table gives no rows.
    Queries in chunks meet blocks in cells, each pair of a chunk and a
    cell in one task of bounded size; only the k best of each query leave it.
    """
    v = F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("long"))
    rows = each_time(valid_vectors(table, copies=k))
    # Blocks are ranges of ids; one id with many vectors is split by these.
    rows = rows.repartitionByRange("vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id")
    vectors = rows.select("vec_id", v.alias("v"))
    blocks = staged(build_blocks(vectors), "blocks")
    queries = staged(vectors.filter(F.col("vec_id") % every == 0), "queries")
    cells = -(-blocks.count() // CELL_BLOCKS) or 1
    chunks = -(-queries.count() // CHUNK_QUERIES) or 1

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        dims = np.array([len(x) for x in left.column("v").to_pylist()])
        for dim in np.unique(right.column("dim").to_numpy()):
            mine = left.filter(pa.array(dims == dim))
            theirs = right.filter(pa.array(right.column("dim").to_numpy() == dim))
            if not mine.num_rows:
                continue
            parts = [[np.array(x, np.int64) for x in theirs.column(c).to_pylist()]
                     for c in ("ids", "forward", "high", "low")]
            held = [(i, f.reshape(len(i), -1), h, w) for i, f, h, w in zip(*parts)]
            ids = mine.column("vec_id").to_numpy()
            at, scores, found = search_blocks(ids, matrix(mine.column("v"), int(dim), np.int64), held, k)
            out.append((ids[at], scores, found))
        return pa.table({
            name: np.concatenate([o[i] for o in out])
            for i, name in enumerate(("query_id", "score", "vec_id"))})

    left = spread(queries.withColumn("chunk", slot(F.col("vec_id"), chunks)), "cell", cells)
    right = spread(blocks.withColumn("cell", slot(F.col("block"), cells)), "chunk", chunks)
    found = left.groupBy("chunk", "cell").cogroup(right.groupBy("chunk", "cell")).applyInArrow(
        search, "query_id long, score long, vec_id long")
    return ranked(found, k)
