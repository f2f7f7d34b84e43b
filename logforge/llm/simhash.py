"""SimHash near-duplicates by multi-index hashing over distinct fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm.common import free, fresh_key, text_udf, whole_text
from logforge.llm.components import connected_components
from logforge.session import staged

SHINGLE = 3
SEED = 42
RADIUS = 2
HALF = 32
LOW = (1 << HALF) - 1
#: A bucket with more distinct fingerprints than this is not paired up; see ``_links``.
CROWDED = 512


def _hashes(text: str) -> np.ndarray:
    """Hashes of all word shingles; bytes.lower and bytes.split know ASCII only."""
    words = text.encode().lower().split()
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    pairs = zip(starts[: len(last)].tolist(), last.tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(last))


def fingerprint_of(text: str) -> int:
    """The 64 majority bits as a signed integer; 0 without words."""
    hashes = _hashes(text)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int(bits.view(">i8")[0])


def _fingerprints(texts: list[str]) -> pa.Array:
    return pa.array([fingerprint_of(t) for t in texts], pa.int64())


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column as a long."""
    return text_udf(T.LongType(), _fingerprints)(text)


def _ball(least: int, most: int) -> Column:
    """All masks over 32 bits with ``least`` to ``most`` (at most 2) bits set, as an array."""
    one = "transform(sequence(0, 31), i -> shiftleft(1L, i))"
    two = ("flatten(transform(sequence(0, 30), i -> transform(sequence(i + 1, 31), "
           "j -> shiftleft(1L, i) | shiftleft(1L, j))))")
    return F.expr(f"concat({', '.join(['array(0L)', one, two][least:most + 1])})")


def _links(classes: DataFrame) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints that differ in 1 or 2 bits, each at least once.

    Two segments of 32 bits: either the high halves differ in at most one bit, which the
    ball of radius 1 around the high half finds in its table, or they differ in two and the
    low halves are equal. Of two high halves that differ in one bit, only the one with the
    zero there probes. Where a bucket is crowded (a large group of near copies), its visitors
    do not meet its members one by one; they enumerate the ball in the other half too and
    look the complete fingerprints up, at a cost that does not grow with the bucket.
    """
    base = classes.select(
        "fp",
        F.shiftrightunsigned("fp", HALF).alias("high"),
        F.col("fp").bitwiseAND(F.lit(LOW)).alias("low"),
    )
    member = base.select(F.col("fp").alias("other"))
    pairs = []
    for half, masks in (
        ("high", _ball(0, 1)),
        ("low", _ball(0, 0)),
    ):
        crowded = base.groupBy(half).count().filter(F.col("count") > CROWDED)
        crowded = crowded.select(F.col(half).alias("busy"))
        probes = base.select("fp", half, F.explode(masks).alias("mask"))
        probes = probes.filter(F.col(half).bitwiseAND(F.col("mask")) == 0)
        probes = probes.select("fp", "mask", (F.col(half).bitwiseXOR(F.col("mask"))).alias("key"))
        probes = probes.join(crowded, F.col("key") == F.col("busy"), "left")
        table = base.select(F.col("fp").alias("other"), F.col(half).alias("at"))
        calm = probes.filter("busy is null").select("fp", "key")
        met = calm.join(table, calm["key"] == table["at"]).select("fp", "other")
        pairs.append(met.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS))
        hot = probes.filter("busy is not null")
        if half == "high":
            inside = F.when(F.col("mask") == 0, _ball(1, 2)).otherwise(_ball(0, 1))
            whole = F.col("fp").bitwiseXOR(F.shiftleft("mask", HALF)).bitwiseXOR(F.col("inner"))
        else:
            inside = _ball(2, 2)
            whole = F.col("fp").bitwiseXOR(F.shiftleft("inner", HALF))
        hot = hot.select("fp", "mask", F.explode(inside).alias("inner"))
        hot = hot.select("fp", whole.alias("wanted"))
        pairs.append(hot.join(member, hot["wanted"] == member["other"]).select("fp", "other"))
    union = pairs[0]
    for more in pairs[1:]:
        union = union.union(more)
    return union.filter("fp != other").select(F.col("fp").alias("u"), F.col("other").alias("v"))


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with root, a fingerprint naming the component, and
    component_id, its smallest doc_id."""
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = staged(connected_components(_links(classes)), "roots")
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    leaders = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    leaders = leaders.select(fresh_key(F.col("root")).alias("lead"), "component_id")
    found = staged(
        named.join(leaders, named["root"] == leaders["lead"])
        .select(F.col("fp").alias("of"), "root", "component_id"), "components")
    return rows.join(found, rows["fp"] == found["of"]).drop("of")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint and component: doc_id, fp, component_id.

    Null or blank texts have fingerprint zero and link like any other. Rows that repeat a
    doc_id each keep their row. A null doc_id never names a component unless all ids of the
    component are null; then component_id is null. Other columns are ignored. An empty table
    gives an empty result.
    """
    rows = staged(docs.select("doc_id", fingerprint(whole_text()).alias("fp")), "fingerprints")
    return _grouped(rows).select("doc_id", "fp", "component_id")


def fingerprint_text(fp: Column) -> Column:
    """Sixteen lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest doc_id (null last).

    Ties, rows that repeat an id, go by a hash of all columns; of rows alike in all columns
    one stays. All columns are kept as they are.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = staged(docs.select(
        "doc_id", fingerprint(whole_text()).alias("fp"), content.alias("content")), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    chosen = _grouped(rows).groupBy("root", rank.alias("rank")).agg(F.count(F.lit(1)).alias("n"))
    chosen = chosen.groupBy("root").agg(F.min(F.struct("rank", "n")).alias("best"))
    at, copies, row = (free(docs, name) for name in ("at", "copies", "row"))
    chosen = staged(chosen.select(
        F.col("best.rank.content").alias(at), F.col("best.n").alias(copies),
        F.col("best.rank.doc_id").alias(row)), "chosen")
    kept = docs.join(
        chosen, (content == chosen[at]) & docs["doc_id"].eqNullSafe(chosen[row]), "inner")
    once = kept.filter(F.col(copies) == 1).select(docs.columns)
    more = kept.filter(F.col(copies) > 1).select(docs.columns).dropDuplicates()
    return once.union(more)
