"""Embedding whitening by polarisation: covariances from exact variances of sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.llm.vectors import matrix
from logforge.session import staged

#: Rows squared at a time: sums of this many products of two digits fit a long.
BLOCK = 1 << 12
DIGIT = 24
LIMB = 32
FITS = 1 << 61
DECIMALS = pa.decimal128(38, 0)


def whole_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, x array<bigint>) of vectors without null or non-finite entries:
    floor(scale * entry); what no long holds becomes the nearest one."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))
    return table.filter(v.isNotNull() & ~odd).select("vec_id", x.alias("x"))


def square_sums(w: np.ndarray) -> np.ndarray:
    """Exact sums of squares down each column, as Python integers; BLOCK rows at most.

    Longs are split into digits of DIGIT bits (the last one signed), so that products of
    two digits can be added in longs.
    """
    if w.dtype == object:
        return (w * w).sum(axis=0)
    digits = []
    while w.size and max(int(w.max()), -int(w.min())) >= 1 << DIGIT:
        digits.append(w & ((1 << DIGIT) - 1))
        w = w >> DIGIT
    digits.append(w)
    total = np.zeros(w.shape[1], object)
    for i, a in enumerate(digits):
        for j in range(i, len(digits)):
            part = np.einsum("ij,ij->j", a, digits[j]).astype(object)
            total += part << (DIGIT * (i + j) + (i != j))
    return total


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums down each column, as Python integers; BLOCK rows at most."""
    digit = (1 << DIGIT) - 1
    return ((x >> DIGIT).sum(axis=0).astype(object) << DIGIT) + (x & digit).sum(axis=0).astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, in longs where they (and sums of two) fit, else in Python integers."""
    most = max((abs(int(s)) for s in sums), default=0)
    largest = max(int(x.max()), -int(x.min())) if x.size else 0
    if n * largest + most < FITS:
        return n * x - np.array([int(s) for s in sums], np.int64)
    return n * x.astype(object) - sums


def exact_totals(
    fit: DataFrame, width: int, places: int, block: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Totals of ``places`` Python integers that ``block`` gives for blocks of vectors.

    Each task adds up its blocks, and passes on one row per place and limb of LIMB bits, so
    that Spark's sums of longs are exact whatever the size. What reaches the driver is bounded by
    the number of places.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, object)
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column(0)]), width, np.int64)
            for at in range(0, len(x), BLOCK):
                total += block(x[at : at + BLOCK])
        rows = []
        for place, value in enumerate(total):
            sign, value, limb = (-1 if value < 0 else 1), abs(int(value)), 0
            while value:
                rows.append((place, limb, sign * (value & ((1 << LIMB) - 1))))
                value, limb = value >> LIMB, limb + 1
        columns = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in columns], ["place", "limb", "part"])

    parts = fit.select("x").mapInArrow(task, "place long, limb long, part long")
    total = np.zeros(places, object)
    for place, limb, part in parts.groupBy("place", "limb").agg(F.sum("part")).collect():
        total[place] += part << (LIMB * limb)
    return total


def pair_squares(y: np.ndarray) -> np.ndarray:
    """Sums of squares of every dimension and of every sum of two: rows of the upper triangle."""
    rows = []
    for i in range(y.shape[1]):
        w = y[:, i:] + y[:, i : i + 1]
        w[:, 0] = y[:, i]
        rows.append(square_sums(w))
    return np.concatenate(rows)


def covariance(squares: np.ndarray, width: int, n: int) -> np.ndarray:
    """The covariances (divisor n) from ``pair_squares`` of the values n * x - S.

    (a + b)**2 - a**2 - b**2 = 2ab, so each is half a difference of exact sums; it is rounded once.
    """
    upper = np.zeros((width, width), object)
    upper[np.triu_indices(width)] = squares
    own, out = upper.diagonal(), np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            products = int(own[i]) if i == j else (int(upper[i, j]) - int(own[i]) - int(own[j])) // 2
            out[i, j] = out[j, i] = products / n**3
    return out


def components(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and unit eigenvectors in columns; the largest
    entry of each is positive."""
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(peak < 0, -1.0, 1.0)


def _projected(n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray):
    """Column function: vector → (deviation, whitened values)."""
    solid = values > len(sums) * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    kind = pa.struct([("deviation", DECIMALS), ("whitened", pa.list_(pa.float64()))])

    @F.arrow_udf("struct<deviation: decimal(38,0), whitened: array<double>>")
    def project(x: pa.Array) -> pa.Array:
        rows = matrix(pa.chunked_array([x]), len(sums), np.int64)
        out = []
        for at in range(0, len(rows), BLOCK):
            y = centred(rows[at : at + BLOCK], n, sums)
            flat = (y / n).astype(np.float64) @ vectors
            flat = np.where(solid, flat / np.sqrt(np.where(solid, values, 1.0)), np.nan)
            apart = sum(square_sums(y[:, k : k + BLOCK].T) for k in range(0, y.shape[1], BLOCK))
            out += [
                {"deviation": Decimal(int(d)) if d < 10**38 else None,
                 "whitened": [None if np.isnan(v) else v for v in row]}
                for d, row in zip(apart, flat.tolist())]
        return pa.array(out, kind)

    return project


def whiten(table: DataFrame, most: int = 4, scale: int = 256) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors become integers (``whole_vectors``); null vectors and those with null or non-finite entries
    are left out. The fit list is each distinct integer vector once: n of them with sums S. One
    pass adds up S, a second one the squares of n * x - S of every dimension and of every sum
    of two dimensions, in integers of any size. Differences of these variances are the
    covariances; their eigenvectors are the components, the largest first, ``most`` of them (or
    as many as dimensions).

    ``deviation`` is decimal(38, 0), exact, null if larger. ``whitened`` and ``explained`` are
    null for a component without variance. ``identity_error`` is measured on the whitened fit
    list. Rows that repeat, share an id or have none are each returned. If vectors differ in
    length, those of the commonest one (ties: the longest) among the distinct ones take part.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = staged(whole_vectors(table, scale), "whole")
    fit = staged(rows.select("x").distinct(), "fit")
    sizes = fit.groupBy(F.size("x").alias("width")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    width, n = (first["width"], first["count"]) if first else (0, 0)
    if not width:
        return rows.limit(0).select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"),
            F.lit(None).cast("decimal(38,0)").alias("deviation"),
            *[F.lit(None).cast("double").alias(c) for c in ("whitened", "explained", "identity_error")])
    fits: Column = F.size("x") == width
    rows, fit = rows.filter(fits), fit.filter(fits)
    sums = exact_totals(fit, width, width, column_sums)
    squares = exact_totals(
        fit, width, width * (width + 1) // 2, lambda x: pair_squares(centred(x, n, sums)))
    cov = covariance(squares, width, n)
    values, vectors = components(cov, most)
    project = _projected(n, sums, values, vectors)
    error = identity_error(fit.select(project("x")["whitened"].alias("w")), len(values))
    total = float(np.trace(cov))
    shares = [float(v) / total if total > 0 else None for v in values]
    done = rows.withColumn("p", project("x")).select(
        "vec_id", F.col("p.deviation").alias("deviation"), F.posexplode("p.whitened").alias("at", "whitened"))
    return done.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(F.array(*[F.lit(s).cast("double") for s in shares]), "at").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def identity_error(whitened: DataFrame, count: int) -> float | None:
    """Largest distance of the covariance of array column ``w`` from the identity; components
    without variance do not count."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = whitened.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) for i, j in pairs]).first()
    off = [abs(c - (i == j)) for (i, j), c in zip(pairs, found) if c is not None]
    return max(off, default=None)
