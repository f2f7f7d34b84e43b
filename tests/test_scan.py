"""Chunks by sketches, and the tree over chunks."""

import random
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logforge.operators import batching, ordering
from logforge.operators.batching import effect_of, pack_batches
from logforge.operators.filters import stride_sample
from logforge.operators.ordering import chunked
from logforge.operators.scan import prefix_scan, sweep_up

SIZES = st.lists(st.integers(0, 60), min_size=1, max_size=25)


def follow(sizes, carry, target):
    """Batches closed and bytes left open, record by record."""
    closed = 0
    for size in sizes:
        if carry + size > target:
            carry, closed = size, closed + 1
        else:
            carry += size
    return closed, carry


@settings(max_examples=300, deadline=None)
@given(st.lists(SIZES, min_size=1, max_size=6), st.integers(1, 100), st.integers(0, 130))
def test_effects_compose(parts, target, carry):
    effects = [batching.Effect(**effect_of(np.array(p), target).merged(target)) for p in parts]
    whole = effects[0]
    for other in effects[1:]:
        whole = whole.then(other, target)
    closed, left = whole.apply(np.array([carry]), target)
    assert (closed[0], left[0]) == follow(sum(parts, []), carry, target)
    grouped = effects[-1]
    for other in reversed(effects[:-1]):
        grouped = other.then(grouped, target)
    assert grouped.apply(np.array([carry]), target) == (closed, left)


def test_no_step_holds_more_than_its_fan_in(spark):
    rows = [("hot", i, 1 + i % 7) for i in range(500)] + [("b", 3, 5), (None, -40, 2)]
    leaves = spark.createDataFrame(rows, "unit string, _chunk long, n long").select(
        "unit", "_chunk", F.struct("n").alias("_f"))
    combine = lambda fs: F.struct(F.aggregate(fs, F.lit(0).cast("long"), lambda a, f: a + f["n"]).alias("n"))
    hand = lambda fs, state: F.transform(
        fs, lambda f, i: state + F.aggregate(F.slice(fs, 1, i), F.lit(0).cast("long"), lambda a, g: a + g["n"]))
    rounds, low = sweep_up(leaves, ["unit"], combine, 4)
    assert low == -40 and len(rounds) == 5
    for r in rounds:
        assert r.agg(F.max(F.size("_children"))).first()[0] <= 4
    got = prefix_scan(leaves, ["unit"], combine, lambda f: F.lit(0).cast("long"), hand, 4).collect()
    want, total = {("b", 3): 0, (None, -40): 0}, 0
    for unit, chunk, n in rows[:500]:
        want[unit, chunk], total = total, total + n
    assert {(r["unit"], r["_chunk"]): r["_state"] for r in got} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "unit string, at long, id long, size long")
    for order in (["id"], ["at", "id"]):
        assert pack_batches(df, ["unit"], order, "size").count() == 0
        assert stride_sample(df, 3, ["unit"], order).count() == 0


@pytest.mark.parametrize("span", [1, 40])
def test_chunks_of_skewed_units_are_small(spark, span):
    rng = random.Random(5)
    rows = [("hot", 10**15 + rng.randint(0, 900), i, 3) for i in range(4000)]
    rows += [("same", 7, i, 3) for i in range(1500)]
    rows += [(f"u{i % 50}", rng.randint(0, 10**18), i, 3) for i in range(1000)]
    rows += [(None, None, i, 3) for i in range(300)]
    df = spark.createDataFrame(rows, "unit string, at long, id long, size long").repartition(6)
    cut = chunked(df, ["unit"], ["at", "id"], None, span).collect()
    sizes: dict = {}
    for r in cut:
        sizes[r["unit"], r["_chunk"]] = sizes.get((r["unit"], r["_chunk"]), 0) + 1
    assert max(sizes.values()) <= ordering.LARGE * span
    by_unit: dict = {}
    for r in cut:
        key = (-1 if r["at"] is None else r["at"], r["id"])
        by_unit.setdefault(r["unit"], []).append((key, r["_chunk"]))
    for pairs in by_unit.values():
        chunks = [c for _, c in sorted(pairs)]
        assert chunks == sorted(chunks)


def test_packing_across_rounds(spark, monkeypatch):
    from logforge.operators import scan

    monkeypatch.setattr(scan, "FAN_IN", 3)
    rng = random.Random(8)
    rows = [("hot", rng.randint(0, 50), i, rng.choice([0, 1, 30, 500])) for i in range(1200)]
    df = spark.createDataFrame(rows, "unit string, at long, id long, size long")
    packed = pack_batches(df, ["unit"], ["at", "id"], "size", target=400, overhead=5, span=4)
    held, batch, want = None, 0, {}
    for _, _, key, size in sorted(rows):
        if held is not None and held + size + 5 > 400:
            batch, held = batch + 1, size + 5
        else:
            held = size + 5 + (held or 0)
        want[key] = batch
    assert {r["id"]: r["batch_id"] for r in packed.collect()} == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(SIZES, min_size=1, max_size=5), min_size=1, max_size=5), st.integers(0, 100))
def test_effects_of_many_chunks_at_once(groups, target):
    # Each chunk took a millisecond of Python, however short it was.
    def rows(effects):
        return pa.array([{k: v if isinstance(v, int) else list(v) for k, v in e.items()} for e in effects], batching._SUMMARIES)

    single = [[batching.Effect(**effect_of(np.array(p), target).merged(target)) for p in g] for g in groups]
    sizes = pa.array([[7]] + [p for g in groups for p in g], pa.list_(pa.int64()))[1:]
    many = batching.Effects.of_sizes(sizes, target)
    assert many.rows().equals(rows([e.merged(target) for g in single for e in g]))
    nested = pa.ListArray.from_arrays(np.cumsum([0, *map(len, groups)]).astype(np.int32), many.rows())
    whole = [reduce(lambda a, b: a.then(b, target), g).merged(target) for g in single]
    assert batching._combined(target).func(nested).equals(rows(whole))


def test_short_spans_need_no_sketches(spark, monkeypatch):
    # Every unit was sketched and its bounds written, pass after pass, to cut it into chunks of a few rows.
    rows = [(i % 7, i // 20 % 5, i, 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "unit long, at long, id long, size long")
    monkeypatch.setattr(ordering, "staged", lambda *_: 1 / 0)
    assert {r["count"] for r in chunked(df, ["unit"], ["at", "id"], None, 5).groupBy("unit", "_chunk").count().collect()} <= set(range(1, 6))


@pytest.mark.parametrize("short", [True, False])
def test_sketches_and_ranks_together(spark, monkeypatch, short):
    monkeypatch.setattr(ordering, "SPAN", 30)
    test_chunks_of_skewed_units_are_small(spark, 4 if short else 40)
    test_packing_across_rounds(spark, monkeypatch)
