"""Order inside a unit without putting a whole unit into one task.

A unit (object, topic partition, user …) may hold a third of all rows. Ordered work is
therefore cut into chunks of the order key; each chunk is small, and only one short row
per chunk is combined along the unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.operators.joins import join_on
from logforge.session import staged

SPAN = 1 << 16
#: A chunk of more than this many spans is cut again.
LARGE = 4
#: Parts that one sketch can cut a chunk into, and its accuracy: ranks are off by 0.1 %.
PARTS = 512
SKETCH = 4096
#: Bounds are searched in two steps, among blocks and inside one.
BLOCK = 24


def chunked(
    df: DataFrame, unit: list[str], order: list[str], chunk: Column | str | None = None, span: int = SPAN
) -> DataFrame:
    """``df`` with ``_chunk``, a whole number that never decreases along ``order`` in a unit.

    A single integer column is a dense position: it is divided by ``span``. Other orders, by
    time or by several columns, are cut where each unit's own rows lie: a mergeable
    quantile sketch per unit gives bounds of its first column, and chunks that are still large are
    cut again, by their own sketches; where the first column has one value only, by the second
    column, and so on. A pass cuts a chunk into up to ``PARTS`` parts, so few passes do for any
    number of rows, and chunks stay below ``LARGE`` spans whatever the size of a unit. Each
    pass reads ``df`` once and writes the bounds, which are a small share of it.

    Spans shorter than ``SPAN`` would need a sketch, and bounds, for every few rows: there the
    sketches cut until ``SPAN`` would be met, and parts of that size are cut by the rank of their rows.
    """
    if chunk is not None:
        return df.withColumn("_chunk", F.col(chunk) if isinstance(chunk, str) else chunk)
    key = order_key(df, order[0])
    if len(order) == 1 and isinstance(df.schema[order[0]].dataType, T.IntegralType):
        return df.withColumn("_chunk", F.floor(key / F.lit(span)).cast("bigint"))
    keys = [order_key(df, name) for name in order]
    df, most = sketched(df.withColumn("_chunk", F.lit(0).cast("bigint")), unit, keys, max(span, SPAN))
    if span >= SPAN:
        return df
    # Ranks begin at 1; of equal rows, which stay together, the first counts.
    at = F.rank().over(Window.partitionBy(*unit, "_chunk").orderBy(*order)) - 1
    part = F.floor(at / F.lit(span)).cast("bigint")
    return df.withColumn("_part", part).withColumn(
        "_chunk", F.col("_chunk") * (most // span + 1) + F.col("_part") if most else F.col("_part")).drop("_part")


def sketched(df: DataFrame, unit: list[str], keys: list[Column], span: int) -> tuple[DataFrame, int]:
    """``df`` cut by sketches, and the rows of its largest chunk; 0 if no unit had to be cut."""
    by, cut = 0, False
    largest = lambda: df.groupBy(*unit, "_chunk").count().agg(F.max("count")).first()[0] or 0
    if largest() <= LARGE * span:
        return df, 0
    while True:
        bounds = staged(sketched_bounds(df, unit, keys, by, span), "bounds")
        most, first = bounds.agg(F.max("_count"), F.min("_by")).first()
        if first is None:
            return df, largest() if cut else 0
        if most is not None:
            df, cut = cut_at(df, unit, keys[by], bounds.filter(F.col("_count").isNotNull()), most), True
        else:
            by = first


def sketched_bounds(df: DataFrame, unit: list[str], keys: list[Column], by: int, span: int) -> DataFrame:
    """``unit, _chunk, _by`` of the large chunks, where ``_by`` is the place of the first order
    column with more than one value in a chunk (those without any are left out).

    Those to be cut by column ``by`` have the bounds, in ``_blocks``, and their ``_count``.
    """
    size = df.groupBy(*unit, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_bigint(keys[by], F.lit(SKETCH)).alias("_sketch"),
        *[(F.min(key) < F.max(key)).alias(f"_varies{i}") for i, key in enumerate(keys)])
    first = F.lit(None).cast("int")
    for i in reversed(range(len(keys))):
        first = F.when(F.col(f"_varies{i}"), i).otherwise(first)
    large = size.withColumn("_by", first).filter((F.col("_n") > LARGE * span) & F.col("_by").isNotNull())
    ranks = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    parts = F.least(F.ceil(F.col("_n") / span), F.lit(PARTS))
    chosen = F.transform(
        F.sequence(F.lit(1), (parts - 1).cast("int")),
        lambda i: F.element_at("_all", F.greatest(F.floor(i * PARTS / parts), F.lit(1)).cast("int")))
    large = large.withColumn("_all", F.kll_sketch_get_quantile_bigint("_sketch", ranks))
    large = large.withColumn("_bounds", F.when(F.col("_by") == by, F.array_sort(F.array_distinct(chosen))))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_bounds") - 1) / BLOCK).cast("int")),
        lambda b: F.slice("_bounds", b * BLOCK + 1, BLOCK))
    return large.select(
        *unit, "_chunk", "_by", F.when(F.col("_by") == by, blocks).alias("_blocks"),
        F.when(F.col("_by") == by, F.size("_bounds").cast("bigint")).alias("_count"))


def cut_at(df: DataFrame, unit: list[str], key: Column, bounds: DataFrame, most: int) -> DataFrame:
    """Chunks cut at their bounds (``most`` at most): between two bounds is a part, and at each
    one another."""
    columns = df.columns
    df = join_on(df, bounds.select(*unit, "_chunk", "_blocks"), [*unit, "_chunk"], "left").withColumn("_key", key)
    before = F.size(F.filter("_blocks", lambda b: F.element_at(b, -1) < F.col("_key")))
    df = df.withColumn("_before", before).withColumn("_block", F.get("_blocks", "_before"))
    inside = F.when(F.col("_block").isNotNull(), F.size(F.filter("_block", lambda b: b < F.col("_key"))))
    below = F.least(F.col("_before") * BLOCK + F.coalesce(inside, F.lit(0)), F.lit(most))
    at = F.coalesce(F.array_contains("_block", F.col("_key")), F.lit(False)).cast("int")
    part = F.when(F.col("_blocks").isNull(), 0).otherwise(2 * below + at)
    return df.withColumn("_chunk", F.col("_chunk") * (2 * most + 1) + part).select(*columns)


def order_key(df: DataFrame, name: str) -> Column:
    """An order column as a number; nulls come first."""
    kind, key = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        key = F.unix_micros(key)
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"give chunk= to order by {name!r} of type {kind.simpleString()}")
    return F.coalesce(key.cast("bigint"), F.lit(-(1 << 63)))


def ordered_position(
    df: DataFrame,
    unit: list[str],
    order: list[str],
    chunk: Column | str | None = None,
    span: int = SPAN,
    out: str = "position",
) -> DataFrame:
    """Exact 0-based row number within ``unit`` along ``order`` (unique inside a unit)."""
    df = chunked(df, unit, order, chunk, span)
    counts = df.groupBy(*unit, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*unit).orderBy("_chunk")
    before = F.sum("_n").over(along) - F.col("_n")
    offsets = counts.select(*unit, "_chunk", before.alias("_before"))
    inside = Window.partitionBy(*unit, "_chunk").orderBy(*order)
    return (
        join_on(df, offsets, [*unit, "_chunk"])
        .withColumn(out, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_before")
    )
