"""Approximate nearest neighbours: multiprobe p-stable hashing, reranked exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logforge.llm.vectors import each_time, matrix, ranked, slot, spread, valid_vectors
from logforge.session import staged

TABLES = 2
FUNCTIONS = 6
#: Width of a bucket, in units of the scaled vectors (whose length is 1).
WIDTH = 2.0
SEED = 8
#: The number of probes is fitted on at most so many vectors, to this recall.
SAMPLE = 8_192
SAMPLE_QUERIES = 256
GOAL = 0.95
#: Vectors and queries that one task holds; vectors of a bucket that stay together.
CELL_ROWS = 1 << 15
CHUNK_QUERIES = 1 << 13
BUCKET_ROWS = 1 << 12

#: All perturbations of a bucket by -1, 0 or 1 in each function.
SHIFTS = np.array(list(product((-1, 0, 1), repeat=FUNCTIONS)))


@dataclass
class Hashing:
    """Hash functions per vector length, norm bands and the number of probes per table.

    Largest inner product becomes smallest distance by scaling a vector to at most length 1
    and completing it to length 1 with one more component; a query is scaled to length 1 and
    completed with zero. Norms are cut into bands (ascending upper ends), each an index of
    its own with its own scale, so a few long vectors don't press all others together.
    """

    bands: list[float]
    probes: int = len(SHIFTS)
    drawn: dict = field(default_factory=dict)

    def functions(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        if dim not in self.drawn:
            rng = np.random.default_rng([SEED, dim])
            self.drawn[dim] = (
                rng.standard_normal((dim + 1, TABLES * FUNCTIONS)),
                rng.uniform(0, WIDTH, TABLES * FUNCTIONS))
        return self.drawn[dim]

    def _places(self, scaled: np.ndarray, extra: np.ndarray) -> np.ndarray:
        a, b = self.functions(scaled.shape[1])
        return ((scaled @ a[:-1] + extra[:, None] * a[-1] + b) / WIDTH).reshape(
            len(scaled), TABLES, FUNCTIONS)

    @staticmethod
    def _keys(corners: np.ndarray, table: int, band, dim: int) -> np.ndarray:
        """64-bit bucket keys of integer corners (last axis: functions)."""
        key = np.full(corners.shape[:-1], table * 1_000_003 + dim * 8_191, np.int64)
        with np.errstate(over="ignore"):
            for part in [np.broadcast_to(np.asarray(band), key.shape),
                         *np.moveaxis(corners, -1, 0).astype(np.int64)]:
                key = key * np.int64(6364136223846793005) + part + np.int64(1442695040888963407)
                key ^= key >> np.int64(29)
        return key

    def band_of(self, norms: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.bands, norms), len(self.bands) - 1)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, tables): the bucket of each vector in its band."""
        peak = np.abs(vectors).max(axis=1)
        norms = peak * np.linalg.norm(vectors / peak[:, None], axis=1)
        band = self.band_of(norms)
        scaled = vectors / np.maximum(np.array(self.bands)[band], norms)[:, None]
        extra = np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(axis=1)))
        corners = np.floor(self._places(scaled, extra))
        return np.stack(
            [self._keys(corners[:, t], t, band, vectors.shape[1]) for t in range(TABLES)], axis=1)

    def probed(self, queries: np.ndarray) -> np.ndarray:
        """(queries, tables, bands, probes): buckets by falling chance of holding a neighbour.

        A neighbour falls into the bucket next door the likelier, the nearer the query lies to
        that edge: a perturbation's score is the sum of the squared distances to the edges it
        crosses, and the least scores are probed first.
        """
        peak = np.abs(queries).max(axis=1)[:, None]
        scaled = queries / peak
        scaled = scaled / np.linalg.norm(scaled, axis=1)[:, None]
        places = self._places(scaled, np.zeros(len(queries)))
        corners = np.floor(places)
        off = places - corners
        out = np.empty((len(queries), TABLES, len(self.bands), self.probes), np.int64)
        for t in range(TABLES):
            down, up = off[:, t] ** 2, (1 - off[:, t]) ** 2
            cost = down @ (SHIFTS == -1).T + up @ (SHIFTS == 1).T
            best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
            near = corners[:, t][:, None, :] + SHIFTS[best]
            for band in range(len(self.bands)):
                out[:, t, band] = self._keys(near, t, band, queries.shape[1])
        return out


def fit(vectors: DataFrame, k: int) -> Hashing:
    """Bands from the norms of all vectors, the number of probes from a bounded sample.

    The sample is searched by brute force and by probing; the fewest probes that find GOAL of
    the true neighbours are taken. Neighbours are further away in a sample than among all
    vectors, so the recall on all is, if anything, higher.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    ends = vectors.agg(F.percentile_approx(norm, [0.25, 0.5, 0.75, 1.0], 1000)).first()[0] or [1.0]
    bands = []
    for end in sorted(ends):
        if bands and end < 1.2 * bands[-1]:
            bands[-1] = end
        else:
            bands.append(end)
    hashing = Hashing([min(max(b, 1e-300), 1e300) for b in bands])
    rows = vectors.orderBy(F.xxhash64("vid", F.lit(SEED)), "vid").limit(SAMPLE).select("v").collect()
    if not rows:
        return hashing
    common = max({len(r[0]) for r in rows}, key=[len(r[0]) for r in rows].count)
    points = np.array([r[0] for r in rows if len(r[0]) == common])
    asked = points[:SAMPLE_QUERIES]
    scores = asked @ points.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    true = np.argsort(-scores, axis=1)[:, : min(k, len(points) - 1)]
    if not true.size:
        return hashing
    homes, probed = hashing.buckets(points), hashing.probed(asked)
    first = np.full(true.shape, len(SHIFTS))
    for i in range(len(asked)):
        for t in range(TABLES):
            for band in range(len(bands)):
                at = {int(b): n for n, b in reversed(list(enumerate(probed[i, t, band])))}
                found = [at.get(int(b), len(SHIFTS)) for b in homes[true[i], t]]
                first[i] = np.minimum(first[i], found)
    wanted = np.sort(first.ravel())[int(np.ceil(GOAL * first.size)) - 1]
    hashing.probes = int(min(wanted + 1, len(SHIFTS)))
    return hashing


def _distinct(valid: DataFrame, k: int) -> DataFrame:
    """(vid, key, ids, v) for each distinct vector; ids are its 2 k smallest, vid the smallest, key
    its hash.

    No query can have a further one among its k nearest: at least k smaller ids of the same
    vector come first, or these are k rows of the query's own id.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = each_time(valid).withColumn("place", place).filter(F.col("place") <= 2 * k)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("vid"), F.xxhash64("v").alias("key"), "ids", "v")


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Row of each element, and the elements, of a list column."""
    whole = column.combine_chunks()
    lengths = whole.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(whole)), lengths), whole.flatten().to_numpy(zero_copy_only=False)


def nearest(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k nearest found for each query, nearest first, ties to smaller vec_id.

    Nearest means the largest inner product in double precision, summed from the first
    component on. Queries are the vec_ids divisible by ``every``; candidates all other ids with
    a vector of the same length. A query that finds fewer than k candidates by probing is
    compared with all. Columns: query_id, rank (from 1), vec_id, score.

    Rows without id or vector, zero vectors and vectors with null or non-finite components take
    no part. Rows that repeat an id are candidates of their own, equal ones, too; queries that
    share an id have one ranking, of all their pairs. Other columns are ignored; an empty table
    gives no rows. Every vector is indexed, in buckets split by a hash
    where they are large, and tasks hold cells of bounded size.
    """
    valid = staged(valid_vectors(table, nonzero=True, copies=k), "valid")
    vectors = staged(_distinct(valid, k), "vectors")
    # A query is a row: those that share an id are told apart by their vectors.
    own = F.xxhash64("vec_id", "v").alias("qid")
    queries = staged(valid.filter(F.col("vec_id") % every == 0).select(
        own, F.col("vec_id").alias("query_id"), "v", "times"), "queries")
    hashing = fit(vectors, k)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _by_length(batch, lambda m: hashing.buckets(m), "buckets")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _by_length(
                batch, lambda m: hashing.probed(m).reshape(len(m), -1), "buckets")

    homes = vectors.mapInArrow(
        index, "vid long, key long, ids array<long>, v array<double>, buckets array<long>")
    homes = staged(homes.select("vid", "key", "ids", "v", F.explode("buckets").alias("bucket")), "homes")
    sizes = staged(homes.groupBy("bucket").count().select(
        F.col("bucket").alias("b"), (F.floor(F.col("count") / BUCKET_ROWS) + 1).alias("parts")), "sizes")
    cells = homes.count() // CELL_ROWS + 1
    chunks = queries.count() // CHUNK_QUERIES + 1

    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    right = homes.join(sizes, homes["bucket"] == sizes["b"]).select(
        "key", "ids", "v", "bucket", slot(F.struct("bucket", part), cells).alias("cell"))
    probes = queries.select("qid", "v").mapInArrow(probe, "qid long, v array<double>, buckets array<long>")
    probes = probes.select("qid", F.explode(F.array_distinct("buckets")).alias("bucket"))
    probes = probes.join(sizes, probes["bucket"] == sizes["b"]).select(
        "qid", "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    probes = probes.select("qid", "bucket", slot(F.struct("bucket", "part"), cells).alias("cell"))
    # A query has at most probes * tables * bands buckets, so its list per cell is short.
    probes = probes.groupBy("qid", "cell").agg(F.collect_set("bucket").alias("buckets"))
    left = probes.join(queries, "qid").withColumn("chunk", slot(F.col("qid"), chunks))
    kind = "qid long, score double, vec_id long, key long, spot long"
    search = _search(k)
    right = right.select("key", "ids", "v", "bucket", "cell")
    found = left.groupBy("chunk", "cell").cogroup(
        spread(right, "chunk", chunks).groupBy("chunk", "cell")).applyInArrow(search, kind)
    # A vector is met in each table; ``spot`` tells the rows of one vector apart.
    pair = ["qid", "vec_id", "key", "spot"]
    found = staged(found.dropDuplicates(pair), "found")
    enough = found.groupBy("qid").count().filter(F.col("count") >= k).select(F.col("qid").alias("done"))
    short = staged(queries.join(enough, queries["qid"] == enough["done"], "left_anti"), "short")
    if not short.isEmpty():
        all_cells = vectors.count() // CELL_ROWS + 1
        every_one = F.lit(0).cast("long")
        left = spread(short.withColumns({
            "chunk": slot(F.col("qid"), chunks), "buckets": F.array(every_one)}), "cell", all_cells)
        whole = vectors.select(
            "key", "ids", "v", every_one.alias("bucket"), slot(F.col("key"), all_cells).alias("cell"))
        more = left.groupBy("chunk", "cell").cogroup(
            spread(whole, "chunk", chunks).groupBy("chunk", "cell")).applyInArrow(search, kind)
        found = found.union(more).dropDuplicates(pair)
    return ranked(each_time(found.join(queries.select("qid", "query_id", "times"), "qid")), k)


def _by_length(batch: pa.RecordBatch, apply, name: str) -> Iterator[pa.RecordBatch]:
    """The batch with a list column ``apply`` (matrix of ``v``), by groups of equal length."""
    lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        same = batch.filter(pa.array(lengths == dim))
        for at in range(0, same.num_rows, 1024):
            some = same.slice(at, 1024)
            rows = np.asarray(apply(matrix(pa.chunked_array([some.column("v")]), int(dim))))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(list(rows), pa.list_(pa.int64()))], [*some.schema.names, name])


def _search(k: int):
    """The function of one cell: queries with the buckets they probe, vectors with theirs."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        out = [(none, np.zeros(0), none, none, none)]
        if left.num_rows and right.num_rows:
            mine = left.column("v").combine_chunks().value_lengths().to_numpy()
            theirs = right.column("v").combine_chunks().value_lengths().to_numpy()
            for dim in np.intersect1d(mine, theirs):
                out.append(_cell(
                    left.filter(pa.array(mine == dim)), right.filter(pa.array(theirs == dim)),
                    int(dim), k))
        return pa.table({
            name: np.concatenate([o[i] for o in out])
            for i, name in enumerate(("qid", "score", "vec_id", "key", "spot"))})

    return search


def _exact(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component on."""
    total = np.zeros(len(queries))
    for i in range(queries.shape[1]):
        total += queries[:, i] * points[:, i]
    return total


def _cell(left: pa.Table, right: pa.Table, dim: int, k: int):
    """The k best rows of each query in a cell: key of the query, score, vec_id, vector, place in its ids.

    Matrix products choose what may be among the k best, up to their rounding; these are
    scored exactly, and of equal scores the smaller ids stay.
    """
    queries, points = matrix(left.column("v"), dim), matrix(right.column("v"), dim)
    qid, own = left.column("qid").to_numpy(), left.column("query_id").to_numpy()
    keys = right.column("key").to_numpy()
    # Each vector's smallest id, and its smallest other one, if it has one.
    row, every = _lists(right.column("ids"))
    first = every[np.searchsorted(row, np.arange(len(points)))]
    other, at = np.unique(row[every != first[row]], return_index=True)
    second, some_other = first.copy(), np.zeros(len(points), bool)
    second[other], some_other[other] = every[every != first[row]][at], True
    with np.errstate(over="ignore"):
        slack = dim * 2.0**-50 * np.linalg.norm(queries, axis=1) * np.linalg.norm(points, axis=1).max(initial=0.0)
    slack = np.where(np.isfinite(slack), slack, np.inf)
    asker, asked = _lists(left.column("buckets"))
    by_bucket = np.argsort(right.column("bucket").to_numpy(), kind="stable")
    homes = right.column("bucket").to_numpy()[by_bucket]
    order = np.argsort(asked, kind="stable")
    asker, asked = asker[order], asked[order]
    kth = np.full(len(qid), -np.inf)
    none = np.zeros(0, np.int64)
    held = (none, np.zeros(0), none)

    def settle(pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """The k best vectors of each query, of those held and some more."""
        who, place, rough = (np.concatenate([p[i] for p in pairs]) for i in range(3))
        # A vector is in a bucket of each table: so many pairs hold k of them, and what is below
        # the last of these by more than rounding is none of the k best.
        order = np.lexsort((-rough, who))
        who, place, rough = who[order], place[order], rough[order]
        starts = np.flatnonzero(np.append(True, who[1:] != who[:-1])[: len(who)])
        counts = np.diff(np.append(starts, len(who)))
        enough = counts >= TABLES * k
        least = np.full(len(starts), -np.inf)
        least[enough] = rough[starts[enough] + TABLES * k - 1]
        near = ~(rough < np.repeat(least, counts) - 2 * slack[who])
        who, place = who[near], place[near]
        scores = np.concatenate([held[1], _exact(queries[who], points[place])])
        who, place = np.concatenate([held[0], who]), np.concatenate([held[2], place])
        # One vector may be met in several buckets.
        order = np.lexsort((keys[place], who))
        who, place, scores = who[order], place[order], scores[order]
        new = np.append(True, (who[1:] != who[:-1]) | (keys[place][1:] != keys[place][:-1]))[: len(who)]
        who, place, scores = who[new], place[new], scores[new]
        lowest = np.where(first[place] != own[who], first[place], second[place])
        order = np.lexsort((lowest, -scores, who))
        who, place, scores = who[order], place[order], scores[order]
        starts = np.flatnonzero(np.append(True, who[1:] != who[:-1])[: len(who)])
        rank = np.arange(len(who)) - np.repeat(starts, np.diff(np.append(starts, len(who))))
        last = rank == k - 1
        kth[who[last]] = scores[last]
        return who[rank < k], scores[rank < k], place[rank < k]

    names, starts = np.unique(homes, return_index=True)
    ends = np.append(starts[1:], len(homes))
    nothing = (none, none, np.zeros(0))
    waiting, size = [nothing], 0
    for name, begin, end in zip(names, starts, ends):
        who = asker[np.searchsorted(asked, name) : np.searchsorted(asked, name, side="right")]
        there = by_bucket[begin:end]
        for some in np.array_split(who, len(who) // 512 + 1):
            if not len(some):
                continue
            scores = queries[some] @ points[there].T
            usable = (first[there][None, :] != own[some][:, None]) | some_other[there][None, :]
            at, place = np.nonzero(usable & ~(scores < (kth[some] - slack[some])[:, None]))
            waiting.append((some[at], there[place], scores[at, place]))
            size += len(at)
            if size > 1 << 18:
                held = settle(waiting)
                waiting, size = [nothing], 0
    who, scores, place = settle(waiting)
    row, vec = _lists(right.column("ids").take(pa.array(place)))
    spot = np.arange(len(row)) - np.searchsorted(row, row)
    who, scores, key = who[row], scores[row], keys[place][row]
    mine = vec != own[who]
    who, scores, vec, key, spot = who[mine], scores[mine], vec[mine], key[mine], spot[mine]
    order = np.lexsort((spot, key, vec, -scores, who))
    who, scores, vec, key, spot = (x[order] for x in (who, scores, vec, key, spot))
    starts = np.flatnonzero(np.append(True, who[1:] != who[:-1])[: len(who)])
    rank = np.arange(len(who)) - np.repeat(starts, np.diff(np.append(starts, len(who))))
    best = rank < k
    return qid[who[best]], scores[best], vec[best], key[best], spot[best]
