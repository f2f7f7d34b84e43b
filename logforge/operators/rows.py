"""Unfolding arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(df: DataFrame, keep: list, items: Column | str, out: str, pos: str = "_pos") -> DataFrame:
    """One row per array element: ``keep``, ``pos`` (BIGINT), ``out``; none for NULL or empty.

    A plain ``explode`` makes Spark test ``size(items) > 0`` in a filter below it, and push
    that filter, with the whole expression of ``items``, through all projections: parsing
    and splitting would run twice. The outer form has no such filter.
    """
    df = df.select(*keep, F.posexplode_outer(items).alias(pos, out)).filter(F.col(pos).isNotNull())
    return df.withColumn(pos, F.col(pos).cast("bigint"))
