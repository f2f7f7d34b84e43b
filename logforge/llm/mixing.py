"""Mixing sources to target weights: raking of token weights, then calibrated sampling."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm import hashed
from logforge.llm.common import free, text_udf, whole_text
from logforge.session import staged

#: Topics are centres of hashed word counts, fitted on all documents in at most PASSES passes.
TOPICS = 12
PASSES = 20
DIMENSIONS = 1 << 10
#: Vectors and centres are whole numbers, lengths about FINE and SHARP: sums and products of
#: them in float64 are exact, so results do not depend on the order or size of batches.
FINE = 1 << 12
SHARP = 1 << 20
#: Up to so many (source, language, topic) cells are raked by the driver, more by Spark.
DRIVER_CELLS = 1 << 17
SEED = 20
SWEEPS = 200


def word_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and vectors of damped hashed word counts, in whole numbers."""
    counts = np.zeros((len(texts), DIMENSIONS), np.float32)
    flat = counts.reshape(-1)
    for rows, words in hashed.word_buckets(texts):
        at = rows * DIMENSIONS + (words >> np.uint64(40)).astype(np.int64) % DIMENSIONS
        found, n = np.unique(at, return_counts=True)
        flat[found] += n
    totals = counts.sum(axis=1, dtype=np.float64).astype(np.int64)
    np.log1p(counts, out=counts)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    return totals, np.rint(counts * FINE).astype(np.float64)


FEATURES = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("v", T.BinaryType())])


def _features(texts: list[str]) -> pa.Array:
    """struct(tokens, v): v holds the vector's filled places and their values, as 16 bit pairs."""
    totals, cells = np.zeros(len(texts), np.int64), []
    for at in range(0, len(texts), 512):
        n, vectors = word_vectors(texts[at : at + 512])
        totals[at : at + 512] = n
        rows, places = np.nonzero(vectors)
        pairs = np.column_stack([places, vectors[rows, places]]).astype(np.uint16)
        bounds = np.searchsorted(rows, np.arange(len(vectors) + 1))
        cells += [pairs[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.StructArray.from_arrays([pa.array(totals), pa.array(cells, pa.binary())], FEATURES.fieldNames())


def _dense(cells: list[bytes]) -> np.ndarray:
    """The vectors of ``_features`` again."""
    pairs = np.frombuffer(b"".join(cells), np.uint16).reshape(-1, 2)
    rows = np.repeat(np.arange(len(cells)), [len(c) // 4 for c in cells])
    out = np.zeros((len(cells), DIMENSIONS))
    out[rows, pairs[:, 0]] = pairs[:, 1]
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(mix, vectors) of up to 512 documents at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield part.column("mix").to_numpy(), _dense(part.column("v").to_pylist())


def _unit(vector: np.ndarray) -> np.ndarray:
    return np.rint(vector * (SHARP / np.linalg.norm(vector)))


def _first_centres(docs: DataFrame, topics: int) -> np.ndarray:
    """k-means++ over all documents: a pass per centre draws one by its squared distance.

    The draw is a race by a hash of the text, so copies of a text count once.
    """
    centres = np.zeros((0, DIMENSIONS))
    while len(centres) < topics:
        known = centres

        def fastest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = (np.inf, 0, b"")
            for mix, vectors in _vectors(batches):
                far = np.ones(len(mix))
                if len(known):
                    lengths = np.sqrt((vectors * vectors).sum(axis=1))
                    far = 2 - 2 * (vectors @ known.T).max(axis=1) / (lengths * SHARP)
                u = ((mix.view(np.uint64) >> np.uint64(11)) + 0.5) / float(1 << 53)
                time = np.where(far > 1e-4, -np.log(u) / np.maximum(far, 1e-4), np.inf)
                i = np.lexsort((mix, time))[0]
                if time[i] < np.inf:
                    best = min(best, (float(time[i]), int(mix[i]), vectors[i].astype(np.uint16).tobytes()))
            if best[0] < np.inf:
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in best], ["time", "mix", "v"])

        won = docs.mapInArrow(fastest, "time double, mix long, v binary").orderBy("time", "mix", "v").first()
        if won is None:
            break
        centres = np.vstack([centres, _unit(np.frombuffer(won["v"], np.uint16).astype(float))])
    return centres


def fit_topics(docs: DataFrame, topics: int = TOPICS) -> np.ndarray:
    """Centres by spherical k-means over all ``docs``, a table of (v, mix) with words in each.

    Every pass assigns all documents in tasks, and Spark sums the vectors of each centre.
    """
    centres = _first_centres(docs, topics)
    for _ in range(PASSES if len(centres) else 0):
        known = centres

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(known.shape)
            for _, vectors in _vectors(batches):
                best = (vectors @ known.T).argmax(axis=1)
                total += (best == np.arange(len(known))[:, None]).astype(float) @ vectors
            flat = total.ravel().astype(np.int64)
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["at", "n"])

        found = docs.mapInArrow(sums, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        total = np.zeros(centres.size)
        total[found.column("at").to_numpy()] = found.column("n").to_numpy()
        total = total.reshape(centres.shape)
        centres = np.stack([_unit(t) if t.any() else c for t, c in zip(total, centres)])
        if (centres == known).all():
            break
    return centres


def topic_of(spark, centres: np.ndarray, v: Column) -> Column:
    """The nearest centre of a vector of ``_features`` (-1 without words)."""
    shared = spark.sparkContext.broadcast(centres)

    @F.arrow_udf(T.IntegerType())
    def nearest(cells: pa.Array) -> pa.Array:
        best = np.full(len(cells), -1, np.int32)
        for at in range(0, len(cells), 512):
            some = cells.slice(at, 512).to_pylist()
            if len(shared.value):
                near = (_dense(some) @ shared.value.T).argmax(axis=1)
                best[at : at + 512] = np.where([len(c) > 0 for c in some], near, -1)
        return pa.array(best)

    return nearest(v)


KIND = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("topic", T.IntegerType())])


def tokens_and_topic(spark, centres: np.ndarray, text: Column) -> Column:
    """struct(tokens, topic): words of the whole text and its nearest centre (-1 without words)."""
    shared = spark.sparkContext.broadcast(centres)

    def per_batch(texts: list[str]) -> pa.Array:
        totals, best = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int32)
        for at in range(0, len(texts), 512):
            n, vectors = word_vectors(texts[at : at + 512])
            totals[at : at + 512] = n
            if len(shared.value):
                near = (vectors @ shared.value.T).argmax(axis=1)
                best[at : at + 512] = np.where(n > 0, near, -1)
        return pa.StructArray.from_arrays([pa.array(totals), pa.array(best)], KIND.fieldNames())

    return text_udf(KIND, per_batch)(text)


def _marked(name: str) -> Column:
    """A value of a margin column; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def rake_cells(
    keys: list[np.ndarray], cells: np.ndarray, targets: list[np.ndarray], total: float, sweeps: int
) -> np.ndarray:
    """Cell weights with the target margins: iterative proportional fitting with a ceiling.

    ``cells`` holds the available tokens, ``keys`` the value of each cell on every axis. Each
    sweep scales every axis to its target share of ``total``; a cell never gets more than it
    has, so a document is never wanted more than once, and what a full cell cannot give falls
    to its neighbours in later sweeps. Margins that the data cannot meet end as near as the
    ceilings let them.
    """
    weights = cells * (total / max(cells.sum(), 1e-9))
    # Only margins with data take part; their shares are made to sum to one.
    shares = [np.where(np.bincount(k, cells, len(t)) > 0, t, 0.0) for k, t in zip(keys, targets)]
    shares = [share / max(share.sum(), 1e-12) for share in shares]
    for _ in range(sweeps):
        before = weights
        for key, share in zip(keys, shares):
            have = np.bincount(key, weights, len(share))
            factor = np.divide(total * share, have, out=np.zeros_like(have), where=have > 0)
            weights = np.minimum(weights * factor[key], cells)
        if np.abs(weights - before).sum() <= 1e-9 * total:
            break
    return weights


def rake(
    cells: np.ndarray, targets: list[np.ndarray], total: float, sweeps: int = SWEEPS
) -> np.ndarray:
    """``rake_cells`` of a full table of cells, one array axis per margin."""
    keys = list(np.indices(cells.shape).reshape(cells.ndim, -1))
    return rake_cells(keys, cells.ravel(), targets, total, sweeps).reshape(cells.shape)


AXES = ("s", "l", "topic")


def _with_shares(cells: DataFrame, given: list[Mapping[str, float] | None], damps: list[float]) -> DataFrame:
    """``cells`` with the target share of each cell's value on every axis, as share_<axis>."""
    spark = cells.sparkSession
    out = cells
    for axis, targets, damp in zip(AXES, given, damps):
        have = cells.groupBy(axis).agg(F.sum("tokens").cast("double").alias("have"))
        share = F.pow("have", F.lit(damp))
        if targets:
            wanted = spark.createDataFrame(
                [("null" if v is None else f"={v}", float(n)) for v, n in targets.items()],
                f"{axis} string, wanted double")
            absent = [r[0] for r in wanted.join(have, axis, "left_anti").select(axis).collect()]
            if absent:
                raise ValueError(f"targets for values without any tokens: {sorted(absent)}")
            have = have.join(wanted, axis, "left")
            share = F.coalesce("wanted", F.lit(0.0))
        margin = have.select(axis, share.alias(f"share_{axis}"))
        full = margin.agg(F.sum(f"share_{axis}")).first()[0]
        out = out.join(margin.withColumn(f"share_{axis}", F.col(f"share_{axis}") / max(full, 1e-12)), axis)
    return staged(out, "shares")


def _rake_here(cells: DataFrame, total: float) -> DataFrame:
    """Cells and their weights, raked by the driver."""
    table = cells.toArrow()
    keys, targets = [], []
    for axis in AXES:
        key = table.column(axis).combine_chunks().dictionary_encode()
        keys.append(key.indices.to_numpy())
        target = np.zeros(len(key.dictionary))
        target[keys[-1]] = table.column(f"share_{axis}").to_numpy()
        targets.append(target)
    weights = rake_cells(keys, table.column("tokens").to_numpy().astype(float), targets, total, SWEEPS)
    done = table.select([*AXES, "tokens"]).append_column("raked", pa.array(weights))
    return staged(cells.sparkSession.createDataFrame(done), "raked")


def _rake_tables(cells: DataFrame, total: float) -> DataFrame:
    """The same by Spark: each sweep joins every axis with the factors of its values."""
    tokens = cells.agg(F.sum("tokens")).first()[0]
    now = cells.withColumn("raked", F.col("tokens") * F.lit(total / tokens))
    for _ in range(SWEEPS):
        before = now.withColumn("old", F.col("raked"))
        for axis in AXES:
            factors = before.groupBy(axis).agg(
                F.sum("raked").alias("have"), F.max(f"share_{axis}").alias("share")).select(
                axis, F.when(F.col("have") > 0, F.lit(total) * F.col("share") / F.col("have"))
                .otherwise(F.lit(0.0)).alias("factor"))
            before = before.join(staged(factors, "factors"), axis).withColumn(
                "raked", F.least(F.col("raked") * F.col("factor"), F.col("tokens").cast("double"))).drop("factor")
        now = staged(before, "sweep")
        moved = now.agg(F.sum(F.abs(F.col("raked") - F.col("old")))).first()[0]
        now = now.drop("old")
        if moved <= 1e-9 * total:
            break
    return now


def mix(
    docs: DataFrame,
    keep: float = 0.5,
    power: float = 0.7,
    source_targets: Mapping[str, float] | None = None,
    language_targets: Mapping[str, float] | None = None,
    topic_power: float = 0.9,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with tokens, topic, weight and kept: a sample near the target margins.

    Token weights of (source, language, topic) cells are raked so that each margin gets its
    target share of keep * all tokens. A share is given by value (null as None; values that are
    not given get nothing, a given value without any tokens is an error, but for a table without
    any tokens), or it is the token share damped by ``power`` (below 1 small values gain). Every
    value is a margin of its own, however many there are: cells are a Spark table, raked by the
    driver up to DRIVER_CELLS rows, else by joins. ``weight`` is the probability of each document
    of a cell, weight of the cell / its tokens, at most 1. A document stays if a hash of its id and text
    (the same in every run) falls below it.

    Null sources and languages are a value of their own; null and empty texts have no tokens,
    topic -1 and weight ``keep``. Rows that repeat id and text stay or go together. Columns of
    ``docs`` named as an added one are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    # Vectors instead of texts, for the passes that follow.
    full = docs.select(
        _marked("source").alias("s"), _marked("lang").alias("l"),
        text_udf(FEATURES, _features)(whole_text()).alias("f"), F.xxhash64(whole_text(), F.lit(SEED)).alias("mix"))
    full = staged(full.select("s", "l", "f.*", "mix"), "vectors").filter("tokens > 0")
    centres = fit_topics(full.select("v", "mix"))
    name, src, lan, hsh = (free(docs, n) for n in ("topical", "src", "lan", "hsh"))
    marked = docs.select("*", tokens_and_topic(spark, centres, whole_text()).alias(name))
    marked = marked.withColumns({
        src: _marked("source"), lan: _marked("lang"),
        hsh: F.xxhash64("doc_id", whole_text(), F.lit(seed))})
    tokens, topic = F.col(f"{name}.tokens"), F.col(f"{name}.topic")

    # One row per (source, language, topic).
    full = full.select("s", "l", "tokens", topic_of(spark, centres, F.col("v")).alias("topic"))
    full = staged(full.groupBy("s", "l", "topic").agg(F.sum("tokens").alias("tokens")), "margins")

    count, have = full.agg(F.count("*"), F.sum("tokens")).first()
    raked = full.withColumn("raked", F.lit(0.0))
    if count:
        cells = _with_shares(
            full, [source_targets, language_targets, None], [power, power, topic_power])
        raked = (_rake_here if count <= DRIVER_CELLS else _rake_tables)(cells, keep * have)
    si, li, ti, chance = (free(marked, n) for n in ("si", "li", "ti", "chance"))
    table = raked.select(
        F.col("s").alias(si), F.col("l").alias(li), F.col("topic").alias(ti),
        (F.col("raked") / F.col("tokens")).alias(chance))
    met = marked.join(
        table, (F.col(src) == table[si]) & (F.col(lan) == table[li]) & (topic == table[ti]), "left")
    weight = F.when(tokens > 0, F.coalesce(F.col(chance), F.lit(0.0))).otherwise(F.lit(keep))
    draw = F.shiftrightunsigned(hsh, 11) / float(1 << 53)
    return met.withColumns({
        "tokens": tokens, "topic": topic, "weight": weight, "kept": draw < weight,
    }).drop(name, src, lan, hsh, si, li, ti, chance)
