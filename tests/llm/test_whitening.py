"""Whitening against numpy and fractions."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logforge.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n string, deviation string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, *["clash"] * 4) for i, v in vectors], SCHEMA)


def by_numpy(vectors, most=4):
    x = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, mean = len(fit), fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    flat = (x - mean) @ axes / np.sqrt(values)
    return n, ((n * x - fit.sum(axis=0)) ** 2).sum(axis=1), flat, values / np.trace(cov)


def test_as_numpy(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.5, 0.2]).tolist()
    given_rows = [*enumerate(vectors), (7, vectors[7]), (None, vectors[8]), (301, None),
                  (302, [None] * 6), (303, [float("nan")] + [0.0] * 5), (304, [float("inf")] * 6)]
    table(spark, given_rows).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = queries.QUERIES["op12_whitening"](spark, str(tmp_path)).collect()
    n, deviations, flat, shares = by_numpy(vectors)
    assert len(rows) == 4 * 302 and {r["n"] for r in rows} == {n}
    signs = {}
    for r in rows:
        i = 8 if r["vec_id"] is None else r["vec_id"]
        k = r["component"] - 1
        assert int(r["deviation"]) == int(deviations[i])
        assert r["explained"] == pytest.approx(shares[k], rel=1e-9)
        sign = signs.setdefault(k, np.sign(r["whitened"] * flat[i, k]))
        assert sign * r["whitened"] == pytest.approx(flat[i, k], abs=1e-8)
        assert r["identity_error"] < 1e-9


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 5), st.integers(1, 6), st.integers(0, 2**62), st.randoms(use_true_random=False))
def test_sums_are_exact(rows, width, most, random):
    x = [[random.randint(-most, most) for _ in range(width)] for _ in range(rows)]
    m = np.array(x, np.int64)
    assert whitening.column_sums(m).tolist() == [sum(c) for c in zip(*x)]
    sums = whitening.column_sums(m)
    y = whitening.centred(m, rows, sums)
    exact = [[rows * v - s for v, s in zip(row, sums)] for row in x]
    assert y.tolist() == exact
    cov = whitening.covariance(whitening.pair_squares(y), width, rows)
    for i in range(width):
        for j in range(width):
            want = Fraction(sum(r[i] * r[j] for r in exact), rows**3)
            assert cov[i, j] == pytest.approx(float(want), rel=1e-14)


def test_odd_tables(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, []), (2, None)])).count() == 0
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["deviation"] == 0 for r in one)
    # One direction varies: the other has no variance and no value.
    line = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert max(r["identity_error"] for r in line) < 1e-9
    # Vectors of another length than most take no part; huge entries stay finite.
    mixed = table(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0]), (4, [1e30, -1e30])])
    rows = whitening.whiten(mixed).collect()
    assert {r["vec_id"] for r in rows} == {1, 2, 4}
    assert all(r["whitened"] is None or np.isfinite(r["whitened"]) for r in rows)


def test_many_vectors_in_tasks(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(9000, 3)) * 100).tolist()
    made = whitening.whiten(table(spark, list(enumerate(vectors))).repartition(4)).collect()
    _, deviations, _, _ = by_numpy(vectors)
    assert all(int(r["deviation"]) == int(deviations[r["vec_id"]]) for r in made)
