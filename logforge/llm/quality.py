"""Quality classifier: ordinal cumulative-link regression on hashed text features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm import hashed
from logforge.llm.common import free, text_udf, whole_text
from logforge.session import staged

#: The model is fitted on at most this many rated documents, chosen by a hash of their id.
SAMPLE = 12_000
#: Lexical features that take part, those most associated with the grade.
LEXICAL_KEPT = 4_096
WIDTH = hashed.LEXICAL + hashed.SHAPES
KEEP = 0.5


def held_out(doc_id: Column) -> Column:
    """The third of the ids that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def rated_sample(docs: DataFrame, ratings: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, grade) of at most ``size`` rated ids that are not held out.

    ``ratings`` has doc_id and grade (int); of repeated ids the least grade counts, rows with a
    null in either are left out. Of documents that repeat an id the least text is taken. The
    chosen ids are at most ``size`` rows, so they are broadcast.
    """
    known = ratings.filter("doc_id is not null and grade is not null").filter(
        ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = staged(known.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(size), "rated")
    chosen = chosen.select(F.col("doc_id").alias("rated_id"), "grade")
    met = docs.select("doc_id", whole_text().alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("rated_id"))
    return staged(met.groupBy("doc_id", "grade").agg(F.min("text").alias("text")), "rated_texts")


def lexical_counts(sample: DataFrame, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents per grade, and (buckets, grades): in how many of them each feature occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((grades, hashed.LEXICAL), np.int32)
        for batch in batches:
            texts, marks = batch.column("text").to_pylist(), batch.column("grade").to_numpy()
            for rows, buckets in hashed.lexical(texts):
                pairs = np.unique(rows.astype(np.int64) * hashed.LEXICAL + buckets)
                np.add.at(totals, (marks[pairs // hashed.LEXICAL], pairs % hashed.LEXICAL), 1)
        found = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), *[pa.array(t[found], pa.int64()) for t in totals]],
            ["bucket", *[f"n{g}" for g in range(grades)]])

    names = [f"n{g}" for g in range(grades)]
    kind = "bucket long, " + ", ".join(f"{n} long" for n in names)
    summed = sample.select("text", "grade").mapInArrow(count, kind).groupBy("bucket").agg(
        *[F.sum(n).alias(n) for n in names])
    sizes = {r["grade"]: r["count"] for r in sample.groupBy("grade").count().collect()}
    seen = summed.filter(" + ".join(names) + " >= 3").toArrow()
    counts = np.zeros((hashed.LEXICAL, grades))
    at = seen.column("bucket").to_numpy()
    for grade, name in enumerate(names):
        counts[at, grade] = seen.column(name).to_numpy()
    return np.array([sizes.get(g, 0) for g in range(grades)], float), counts


def associated(sizes: np.ndarray, counts: np.ndarray, kept: int = LEXICAL_KEPT) -> np.ndarray:
    """The features whose documents' grades are furthest from what their number makes likely.

    The score is the deviation of the grade sum from its mean, in standard deviations.
    Features of more than a tenth of the documents speak of length, not content: left out.
    """
    grades = np.arange(len(sizes))
    share = sizes / max(sizes.sum(), 1)
    mean = grades @ share
    spread = max(float(((grades - mean) ** 2) @ share), 1e-9)
    n = counts.sum(axis=1)
    score = np.abs(counts @ grades - n * mean) / np.sqrt(np.maximum(n, 1) * spread)
    score[n > max(sizes.sum() / 10, 30)] = 0.0
    best = np.argsort(-score, kind="stable")[:kept]
    return np.sort(best[score[best] > 4])


def features(
    texts: list[str], lexical_kept: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, values), ordered by row: presence of the kept lexical features, and the
    square roots of the shape features' rates, after the lexical columns."""
    found = []
    for rows, buckets in hashed.lexical(texts):
        hit = lexical_kept[buckets]
        keys = np.unique(rows[hit].astype(np.int64) * WIDTH + buckets[hit])
        found.append((keys, np.ones(len(keys))))
    for rows, buckets, counts in hashed.shapes(texts):
        found.append((rows.astype(np.int64) * WIDTH + hashed.LEXICAL + buckets, counts.astype(float)))
    keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    values = np.bincount(back, np.concatenate([v for _, v in found]), len(keys))
    rows, columns = keys // WIDTH, keys % WIDTH
    shape = columns >= hashed.LEXICAL
    values[~shape] = 1.0
    size = np.ones(len(texts))
    total = shape & (columns == hashed.LEXICAL)
    size[rows[total]] = np.maximum(values[total], 1.0)
    values[shape] = np.sqrt(values[shape] / size[rows[shape]])
    values[total] = 0.0
    return rows, columns, values


def fit_cumulative_link(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray,
    levels: int, width: int, penalty: float = 1e-5, steps: int = 600,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds: P(grade <= k) = sigmoid(threshold[k] - weights . x).

    Full-batch gradient steps (Adam) on the mean log likelihood with a squared penalty. The
    gaps between thresholds are exponentials, so their order holds at every step.
    """
    n = max(len(grades), 1)
    used, at = np.unique(columns, return_inverse=True)
    below = np.array([(grades <= k).sum() for k in range(levels - 1)])
    start = np.log((below + 0.5) / (n - below + 0.5))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    theta = np.concatenate([np.zeros(len(used)), start[:1], gaps])
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def thresholds(t):
        return t[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(t[len(used) + 1 :]))])

    def squash(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        weights, cuts = theta[: len(used)], thresholds(theta)
        latent = np.bincount(rows, values * weights[at], n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        with np.errstate(over="ignore"):
            upper = squash(edges[grades + 1] - latent)
            lower = squash(edges[grades] - latent)
        upper[grades == levels - 1], lower[grades == 0] = 1.0, 0.0
        mass = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        slope = np.zeros_like(theta)
        pull = (d_upper - d_lower) / n
        slope[: len(used)] = np.bincount(at, values * pull[rows], len(used)) + penalty * weights
        by_cut = np.array([
            (d_lower[grades == k + 1].sum() - d_upper[grades == k].sum()) / n
            for k in range(levels - 1)])
        slope[len(used)] = by_cut.sum()
        for k in range(1, levels - 1):
            slope[len(used) + k] = by_cut[k:].sum() * np.exp(theta[len(used) + k])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))
        theta = theta - rate * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(width, np.float32)
    weights[used] = theta[: len(used)]
    return weights, thresholds(theta)


class OrdinalModel:
    """Fitted weights (one array over all buckets) and thresholds."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray, kept: np.ndarray):
        self.weights, self.cuts, self.kept = weights, cuts, kept

    @classmethod
    def fit(cls, docs: DataFrame, ratings: DataFrame, levels: int, size: int = SAMPLE):
        """Fit on ``rated_sample``; without any rated document every grade is equally likely."""
        sample = rated_sample(docs, ratings, size)
        sizes, counts = lexical_counts(sample, levels)
        kept = np.zeros(hashed.LEXICAL, bool)
        kept[associated(sizes, counts)] = True

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                rows, columns, values = features(texts, kept)
                offsets = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
                columns = pa.ListArray.from_arrays(offsets, pa.array(columns.astype(np.int32)))
                values = pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grade"), columns, values], ["grade", "columns", "values"])

        table = sample.select(F.col("grade").cast("int"), "text").mapInArrow(
            emit, "grade int, columns array<int>, values array<float>").toArrow()
        lists = table.column("columns").combine_chunks()
        rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        weights, cuts = fit_cumulative_link(
            rows, lists.flatten().to_numpy(), table.column("values").combine_chunks().flatten().to_numpy(),
            table.column("grade").to_numpy(), levels, WIDTH)
        return cls(weights, cuts, kept)

    def latent(self, texts: list[str]) -> np.ndarray:
        rows, columns, values = features(texts, self.kept)
        return np.bincount(rows, values * self.weights[columns], len(texts))

    def tails(self, texts: list[str]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... as columns."""
        z = np.clip(self.cuts[None, :] - self.latent(texts)[:, None], -40, 40)
        return 1 / (1 + np.exp(z))


def tails(spark, model: OrdinalModel, text: Column) -> Column:
    """array<double> of P(grade >= k). The model, a few MB of fixed size, is broadcast."""
    shared = spark.sparkContext.broadcast((model.weights, model.cuts, model.kept))

    def per_batch(texts: list[str]) -> pa.Array:
        out = np.zeros((len(texts), len(shared.value[1])))
        for begin, end in hashed.groups(texts):
            out[begin:end] = OrdinalModel(*shared.value).tails(texts[begin:end])
        offsets = np.arange(0, out.size + 1, max(out.shape[1], 1), dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return text_udf(T.ArrayType(T.DoubleType()), per_batch)(text)


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 bad, 1 well written but toxic, 2 well written and clean."""
    good = F.col("quality") > 0
    return labels.select("doc_id", F.when(~good, 0).when(F.col("toxic") > 0, 1).otherwise(2)
                         .cast("int").alias("grade")).filter(F.col("grade").isNotNull())


def rate(docs: DataFrame, ratings: DataFrame, levels: int = 3, size: int = SAMPLE) -> DataFrame:
    """``docs`` with expected_grade, tail_probability (P(grade >= 1)), top_probability (of the
    best grade) and keep.

    Columns of ``docs`` with these names are replaced. ``ratings`` has doc_id and grade, from 0
    to levels - 1; held-out ids are never learned from. Null and empty texts have no features
    and get the probabilities of latent value 0. Rows that repeat get equal results, texts of
    any length are read whole, and an empty table gives no rows. A document is kept from a tail
    probability of KEEP on.
    """
    model = OrdinalModel.fit(docs, ratings, levels, size)
    name = free(docs, "tails")
    found = docs.select("*", tails(docs.sparkSession, model, whole_text()).alias(name))
    tail = F.element_at(name, 1)
    added = {
        "expected_grade": F.aggregate(name, F.lit(0.0), lambda a, x: a + x),
        "tail_probability": tail, "top_probability": F.element_at(name, -1), "keep": tail >= KEEP}
    return found.withColumns(added).drop(name)
