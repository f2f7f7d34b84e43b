"""Packing records into size-bounded batches, in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.functions.text import not_blank
from logforge.operators.framing import kept_records
from logforge.operators.joins import join_on
from logforge.operators.ordering import SPAN, chunked, ordered_position
from logforge.operators.rows import unfold
from logforge.operators.scan import prefix_scan
from logforge.session import staged

# Default batch target, and the bytes added for each record.
BATCH_TARGET = 4 * 1024 * 1024
RECORD_OVERHEAD = 200

LONGS = T.ArrayType(T.LongType())
SUMMARY = T.StructType([
    T.StructField("first", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("prefix", LONGS),
    T.StructField("closed", LONGS),
    T.StructField("carry", LONGS),
])
STATE = T.StructType([T.StructField("carry", T.LongType()), T.StructField("base", T.LongType())])
_SUMMARIES = pa.struct([
    ("first", pa.int64()), ("total", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("prefix", "closed", "carry")]])
_STATES = pa.list_(pa.struct([("carry", pa.int64()), ("base", pa.int64())]))


@dataclass
class Effect:
    """What consecutive records do to any number of bytes already in the open batch.

    If the open batch holds ``c`` bytes, the first record with ``prefix > target - c`` starts a
    new batch; from there on the cuts depend on nothing before. So each possible first
    cut is followed once, giving the batches ``closed`` and the bytes left open (``carry``). Of
    neighbours with one outcome the last stands for all. ``first`` is the size of the first record.
    """

    first: int
    total: int
    prefix: np.ndarray
    closed: np.ndarray
    carry: np.ndarray

    def merged(self, target: int) -> dict:
        """As a row: without outcomes that repeat, and none behind the first certain cut."""
        count = int(np.searchsorted(self.prefix, target, side="right")) + 1
        prefix, closed, carry = self.prefix[:count], self.closed[:count], self.carry[:count]
        last = np.append((closed[1:] != closed[:-1]) | (carry[1:] != carry[:-1]), True)[: len(prefix)]
        return {
            "first": self.first, "total": self.total, "prefix": prefix[last], "closed": closed[last],
            "carry": carry[last]}

    def apply(self, carry: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
        """(batches closed, bytes left open) for each number of open bytes."""
        through = carry + self.total <= target
        hit = np.minimum(np.searchsorted(self.prefix, target - carry, side="right"), len(self.prefix) - 1)
        return np.where(through, 0, self.closed[hit]), np.where(through, carry + self.total, self.carry[hit])

    def then(self, other: Effect, target: int) -> Effect:
        """The effect of these records and then the others."""
        closed, carry = other.apply(self.carry, target)
        out = Effect(
            self.first, self.total + other.total,
            np.concatenate([self.prefix, self.total + other.prefix]),
            np.concatenate([self.closed + closed, other.closed]), np.concatenate([carry, other.carry]))
        return Effect(**out.merged(target))


def effect_of(sizes: np.ndarray, target: int) -> Effect:
    """The effect of records of these sizes (at least one)."""
    sums = np.cumsum(sizes)
    before = sums - sizes
    count = int(np.searchsorted(sums, target, side="right")) + 1
    first = np.arange(min(count, len(sizes)))
    closed = np.ones(len(first), dtype=np.int64)
    at = first.copy()
    while True:
        nxt = np.maximum(np.searchsorted(sums, before[at] + target, side="right"), at + 1)
        inside = nxt < len(sizes)
        if not inside.any():
            break
        closed += inside
        at = np.where(inside, nxt, at)
    return Effect(int(sizes[0]), int(sums[-1]), sums[first], closed, sums[-1] - before[at])


# The same for many chunks at once: one after the other they cost a millisecond each, however short
# they are. ``owner`` is the place of the chunk that an outcome or a record belongs to.


def _stretches(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i]`` and the numbers after it, ``count[i]`` in all, for each i."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + count, count)


@dataclass
class Effects:
    """Effects of many chunks; outcomes lie one after the other, ``owner`` never decreases."""

    first: np.ndarray
    total: np.ndarray
    owner: np.ndarray
    prefix: np.ndarray
    closed: np.ndarray
    carry: np.ndarray

    @classmethod
    def of_sizes(cls, sizes: pa.ListArray, target: int) -> Effects:
        """``effect_of`` of each list (none is empty)."""
        flat, low, high = _flat(sizes)
        sums = np.cumsum(flat)
        before = sums - flat
        count = np.minimum(np.searchsorted(sums, before[low] + target, side="right") + 1, high) - low
        count = np.maximum(count, 1)
        owner, first = np.repeat(np.arange(len(low)), count), _stretches(low, count)
        closed, at, stop = np.ones(len(first), dtype=np.int64), first.copy(), high[owner]
        open_ = np.arange(len(first))
        while len(open_):
            nxt = np.maximum(np.searchsorted(sums, before[at[open_]] + target, side="right"), at[open_] + 1)
            inside = nxt < stop[open_]
            open_ = open_[inside]
            closed[open_] += 1
            at[open_] = nxt[inside]
        total = sums[high - 1] - before[low]
        out = cls(flat[low], total, owner, sums[first] - before[low][owner], closed, sums[stop - 1] - before[at])
        return out.merged(target)

    @classmethod
    def of_rows(cls, rows: pa.StructArray) -> Effects:
        lists = [_flat(rows.field(c)) for c in ("prefix", "closed", "carry")]
        _, low, high = lists[0]
        first, total = (np.asarray(rows.field(c)) for c in ("first", "total"))
        return cls(first, total, np.repeat(np.arange(len(low)), high - low), *[flat for flat, _, _ in lists])

    def rows(self) -> pa.StructArray:
        ends = np.searchsorted(self.owner, np.arange(len(self.first) + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in (self.prefix, self.closed, self.carry)]
        return pa.StructArray.from_arrays([pa.array(self.first), pa.array(self.total), *lists], fields=list(_SUMMARIES))

    def take(self, places: np.ndarray) -> Effects:
        low = np.searchsorted(self.owner, places)
        count = np.searchsorted(self.owner, places, side="right") - low
        at = _stretches(low, count)
        return Effects(
            self.first[places], self.total[places], np.repeat(np.arange(len(places)), count),
            self.prefix[at], self.closed[at], self.carry[at])

    def merged(self, target: int) -> Effects:
        new = np.append(True, self.owner[1:] != self.owner[:-1])[: len(self.owner)]
        kept = new | np.append(True, self.prefix[:-1] <= target)[: len(new)]
        owner, prefix, closed, carry = (c[kept] for c in (self.owner, self.prefix, self.closed, self.carry))
        last = (owner[1:] != owner[:-1]) | (closed[1:] != closed[:-1]) | (carry[1:] != carry[:-1])
        last = np.append(last, True)[: len(owner)]
        return Effects(self.first, self.total, owner[last], prefix[last], closed[last], carry[last])

    def apply(self, owner: np.ndarray, carry: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
        """(batches closed, bytes left open) of the chunks ``owner``, each for a number of open bytes."""
        most = int(self.prefix.max(initial=0))
        low, high = np.searchsorted(self.owner, owner), np.searchsorted(self.owner, owner, side="right")
        wanted = np.clip(target - carry, -1, most) + owner * (most + 2)
        hit = np.searchsorted(self.prefix + self.owner * (most + 2), wanted, side="right")
        hit = np.minimum(np.maximum(hit, low), high - 1)
        through = carry + self.total[owner] <= target
        return np.where(through, 0, self.closed[hit]), np.where(through, carry + self.total[owner], self.carry[hit])

    def then(self, other: Effects, target: int) -> Effects:
        closed, carry = other.apply(self.owner, self.carry, target)
        owner = np.concatenate([self.owner, other.owner])
        order = np.argsort(owner, kind="stable")
        columns = [
            owner, np.concatenate([self.prefix, self.total[other.owner] + other.prefix]),
            np.concatenate([self.closed + closed, other.closed]), np.concatenate([carry, other.carry])]
        return Effects(self.first, self.total + other.total, *[c[order] for c in columns]).merged(target)

    def replaced(self, places: np.ndarray, others: Effects) -> Effects:
        """These, but for the chunks ``places`` the others."""
        rest = np.setdiff1d(np.arange(len(self.first)), places, assume_unique=True)
        mine, names = self.take(rest), np.concatenate([rest, places])
        owner = names[np.concatenate([mine.owner, others.owner + len(rest)])]
        order, back = np.argsort(owner, kind="stable"), np.argsort(names)
        first, total = (np.concatenate([getattr(mine, c), getattr(others, c)])[back] for c in ("first", "total"))
        lists = [np.concatenate([getattr(mine, c), getattr(others, c)])[order] for c in ("prefix", "closed", "carry")]
        return Effects(first, total, owner[order], *lists)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of all lists, and where each list begins and ends in them."""
    ends = np.asarray(lists.offsets).astype(np.int64)
    return np.asarray(lists.values)[ends[0] : ends[-1]], ends[:-1] - ends[0], ends[1:] - ends[0]


def _summary(sizes: Column, target: int) -> Column:
    @F.arrow_udf(SUMMARY)
    def summarise(rows: pa.Array) -> pa.Array:
        return Effects.of_sizes(rows, target).rows()

    return summarise(sizes)


def _combined(target: int) -> Callable[[Column], Column]:
    @F.arrow_udf(SUMMARY)
    def combine(rows: pa.Array) -> pa.Array:
        _, low, high = _flat(rows)
        effects = Effects.of_rows(rows.flatten())
        out = effects.take(low)
        for step in range(1, int((high - low).max(initial=0))):
            more = np.flatnonzero(high - low > step)
            out = out.replaced(more, out.take(more).then(effects.take(low[more] + step), target))
        return out.rows()

    return combine


def _handed(target: int) -> Callable[[Column, Column], Column]:
    """States before each of some consecutive chunks."""

    @F.arrow_udf(T.ArrayType(STATE))
    def hand_down(rows: pa.Array, states: pa.Array) -> pa.Array:
        _, low, high = _flat(rows)
        effects = Effects.of_rows(rows.flatten())
        now = np.arange(len(low))
        carry, base = (np.array(states.field(c)) for c in ("carry", "base"))
        given = np.zeros((2, len(effects.first)), dtype=np.int64)
        for step in range(int((high - low).max(initial=0))):
            now = now[high[now] - low[now] > step]
            at = low[now] + step
            given[0, at], given[1, at] = carry[now], base[now]
            closed, carry[now] = effects.apply(at, carry[now], target)
            base[now] += closed
        held = pa.StructArray.from_arrays([pa.array(c) for c in given], fields=list(_STATES.value_type))
        return pa.ListArray.from_arrays(np.append(low, len(effects.first)).astype(np.int32), held)

    return hand_down


def _cuts(target: int):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def cuts(sizes: pa.Array, carry: pa.Array) -> pa.Array:
        flat, low, high = _flat(sizes)
        sums = np.cumsum(flat)
        now = np.arange(len(low))
        limit = sums[low] - flat[low] + target - np.asarray(carry)
        at, owners, places = low, [], []
        while len(now):
            at = np.maximum(np.searchsorted(sums, limit, side="right"), at)
            inside = at < high[now]
            now, at = now[inside], at[inside]
            owners.append(now)
            places.append(at - low[now])
            limit, at = sums[at] - flat[at] + target, at + 1
        owner = np.concatenate([*owners, np.arange(0)])
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(len(low) + 1)).astype(np.int32)
        found = np.concatenate([*places, np.arange(0)])[order]
        return pa.ListArray.from_arrays(ends, pa.array(found.astype(np.int32)))

    return cuts


def pack_batches(
    df: DataFrame,
    unit: list[str],
    order: list[str],
    size: str,
    target: int = BATCH_TARGET,
    overhead: int = RECORD_OVERHEAD,
    chunk: Column | str | None = None,
    span: int = SPAN,
    out: str = "batch_id",
) -> DataFrame:
    """Greedy packing along ``order`` within ``unit``: a record opens a new batch when the
    open one would pass ``target`` bytes; a record over the target is alone.

    The fold is sequential, yet no unit is handled as a whole: the effect of each chunk is
    found in parallel from its sizes only, effects are combined in a tree, and each record finds
    its batch from the few batch starts of its own chunk. ``order`` is unique within a unit;
    rows that share it share a batch.
    """
    df = chunked(df, unit, order, chunk, span).withColumn("_at", F.struct(*order))
    sized = F.struct(F.col("_at").alias("at"), (F.col(size) + overhead).cast("bigint").alias("size"))
    chunks = (
        df.select(*unit, "_chunk", sized.alias("_row"))
        .groupBy(*unit, "_chunk")
        .agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
        .select(*unit, "_chunk", F.col("_rows.at").alias("_ats"), F.col("_rows.size").alias("_sizes"))
    )
    chunks = staged(chunks.withColumn("_f", _summary(F.col("_sizes"), target)), "chunks")
    # An oversized first record has no open batch to close.
    states = prefix_scan(
        chunks.select(*unit, "_chunk", "_f"), unit, _combined(target),
        lambda f: F.struct(
            F.lit(0).cast("bigint").alias("carry"),
            F.when(f["first"] > target, -1).otherwise(0).cast("bigint").alias("base")),
        _handed(target))
    starts = join_on(chunks.drop("_f"), states, [*unit, "_chunk"]).select(
        *unit,
        "_chunk",
        F.col("_state.base").alias("_base"),
        F.transform(_cuts(target)("_sizes", "_state.carry"), lambda i: F.get("_ats", i)).alias("_starts"),
    )
    passed = F.size(F.filter("_starts", lambda s: s <= F.col("_at")))
    # Rows move to their chunk's starts. Were the starts broadcast, each row would be read back where it was
    # mapped, and all that is done to it later would take place in as many tasks as the input has row groups.
    return (
        join_on(df, starts.hint("merge"), [*unit, "_chunk"])
        .withColumn(out, F.col("_base") + passed)
        .drop("_chunk", "_at", "_base", "_starts")
    )


def pack_objects(
    df: DataFrame,
    block: str | None = None,
    sample: int = 1,
    target: int = BATCH_TARGET,
    overhead: int = RECORD_OVERHEAD,
) -> DataFrame:
    """``explode_records`` (blank records dropped) with ``batch_id``, for rows that each
    hold a whole unit in ``records``.

    The unit is packed where it was framed: nothing is shuffled, and no Python is needed. (A
    function in Python would make Spark write out all columns between it and the one that inflates the
    objects anew wherever they are named.)
    """
    numbered = F.transform(
        kept_records(block, sample), lambda r, i: F.struct(i.cast("bigint").alias("pos"), r.alias("log"))
    )
    rest = [c for c in df.columns if c not in ("records", "pos", "log")]
    df = df.withColumn("_rows", F.filter(numbered, lambda r: not_blank(r["log"])))
    nothing = F.struct(
        F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("held"), F.array().cast("array<int>").alias("starts"))

    def add(state: Column, row: Column) -> Column:
        # Only where a batch starts is noted, so states stay short.
        size = (F.octet_length(row["log"]) + overhead).cast("bigint")
        opens = (state["n"] > 0) & (state["held"] + size > target)
        return F.struct(
            (state["n"] + 1).alias("n"), (F.when(opens, F.lit(0)).otherwise(state["held"]) + size).alias("held"),
            F.when(opens, F.array_append(state["starts"], state["n"])).otherwise(state["starts"]).alias("starts"))

    df = df.withColumn("_starts", F.aggregate("_rows", nothing, add, lambda state: F.concat(F.array(F.lit(0)), state["starts"])))

    def batch(start: Column, number: Column) -> Column:
        stop = F.coalesce(F.get("_starts", number + 1), F.size("_rows"))
        return F.transform(F.slice("_rows", start + 1, stop - start), lambda r: F.struct(
            r["pos"].alias("pos"), r["log"].alias("log"), number.cast("bigint").alias("batch_id")))

    items = F.flatten(F.transform("_starts", batch))
    return unfold(df, rest, items, "_item", "_n").select(*rest, "_item.pos", "_item.log", "_item.batch_id")


def pack_in_order(
    df: DataFrame,
    unit: str,
    size: str,
    target: int = BATCH_TARGET,
    overhead: int = RECORD_OVERHEAD,
    out: str = "batch_id",
) -> DataFrame:
    """``pack_batches`` for rows that lie unit by unit, in order, in their partitions, as those of an
    event do from where it was unfolded until something is shuffled.

    Nothing is moved: units and sizes visit Python, and what the open batch holds is carried from
    one Arrow batch to the next. Rows without a size are left out, with a NULL batch.
    """

    @F.arrow_udf(T.LongType())
    def running(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        now, held, batch = None, None, 0
        for units, sizes in parts:
            out = []
            for name, bytes_ in zip(units.to_pylist(), sizes.to_pylist()):
                if bytes_ is None:
                    out.append(None)
                    continue
                if name != now or held is None:
                    now, held, batch = name, bytes_, 0
                elif held + bytes_ > target:
                    held, batch = bytes_, batch + 1
                else:
                    held += bytes_
                out.append(batch)
            yield pa.array(out, pa.int64())

    sizes = (F.col(size) + overhead).cast("bigint")
    return df.withColumn(out, running.asNondeterministic()(F.col(unit).cast("string"), sizes))


def single_batches(
    df: DataFrame,
    unit: list[str],
    order: list[str],
    chunk: Column | str | None = None,
    span: int = SPAN,
    out: str = "batch_id",
) -> DataFrame:
    """Unbatched mode: every row is its own batch."""
    return ordered_position(df, unit, order, chunk, span, out)


def split_by_size(
    df: DataFrame,
    batch: list[str],
    order: list[str],
    limit: int,
    size: str,
    group: list[str],
    request_overhead: int = 20,
    group_overhead: int = 200,
    out: str = "request_id",
) -> DataFrame:
    """Halve each batch until every request fits ``limit`` bytes, keeping the order.

    A request costs ``request_overhead``, its records, and ``group_overhead`` for each
    distinct ``group`` value (a resource) in it. ``request_id`` is NULL for the whole batch
    when a single record cannot fit: then nothing of the batch may be sent. A batch is
    bounded by ``pack_batches``, so collecting its sizes is too.
    """

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def halve(sizes: pa.Array, groups: pa.Array) -> pa.Array:
        out = []
        for size_row, group_row in zip(sizes, groups):
            labels = np.asarray(group_row.values)
            sums = np.concatenate([[0], np.cumsum(np.asarray(size_row.values))])
            starts, pending = [], [(0, len(labels))]
            while pending:
                low, high = pending.pop()
                cost = request_overhead + sums[high] - sums[low]
                cost += group_overhead * len(np.unique(labels[low:high]))
                if cost <= limit:
                    starts.append(low)
                elif high - low == 1:
                    starts = None
                    break
                else:
                    middle = low + (high - low) // 2
                    pending += [(middle, high), (low, middle)]
            out.append(starts)
        return pa.array(out, pa.list_(pa.int32()))

    df = df.withColumn("_at", F.struct(*order))
    row = F.struct(
        F.col("_at").alias("at"), F.col(size).cast("bigint").alias("size"), F.struct(*group).alias("group")
    )
    # Groups are numbered by their place among the batch's distinct ones: no hash can collide.
    known = F.array_distinct("_rows.group")
    numbers = F.transform("_rows.group", lambda g: F.array_position(known, g))
    starts = (
        df.select(*batch, row.alias("_row"))
        .groupBy(*batch)
        .agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
        .withColumn("_first", halve("_rows.size", numbers))
        .select(*batch, F.transform("_first", lambda i: F.get("_rows.at", i)).alias("_starts"))
    )
    passed = F.size(F.filter("_starts", lambda s: s <= F.col("_at"))) - 1
    return (
        join_on(df, starts, batch)
        .withColumn(out, F.when(F.col("_starts").isNotNull(), passed))
        .drop("_at", "_starts")
    )
