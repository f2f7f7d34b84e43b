"""Row filters, systematic sampling, size gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.naming import java_pattern
from logforge.functions.text import not_blank
from logforge.operators.joins import join_on
from logforge.operators.ordering import SPAN, ordered_position


def block_pattern(df: DataFrame, pattern: str | None, log: str = "log") -> DataFrame:
    """Drop records that match anywhere; an empty pattern keeps all."""
    return df.filter(~F.col(log).rlike(java_pattern(pattern))) if pattern else df


def drop_blank(df: DataFrame, log: str = "log") -> DataFrame:
    return df.filter(not_blank(F.col(log)))


def stride_sample(
    df: DataFrame,
    every: int,
    unit: list[str],
    order: list[str],
    chunk: Column | str | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Keep rows 0, N, 2N … of each unit. Run it after ``block_pattern`` and before
    ``drop_blank``: blank records count."""
    if every < 1:
        raise ValueError("every must be at least 1")
    if every == 1:
        return df
    df = ordered_position(df, unit, order, chunk, span, out="_position")
    return df.filter(F.col("_position") % every == 0).drop("_position")


def filter_metrics(
    df: DataFrame,
    rules: DataFrame,
    include: bool,
    namespace: str = "namespace",
    metric: str = "metric_name",
) -> DataFrame:
    """Keep (or drop) metrics named by ``rules(namespace, metric_name)``; a rule without a
    metric name stands for its whole namespace."""
    rules = rules.select(
        F.col("namespace").alias("_ns"), F.col("metric_name").alias("_metric")
    ).distinct()
    keep = (F.col(namespace) == F.col("_ns")) & F.coalesce(F.col(metric) == F.col("_metric"), F.col("_metric").isNull())
    return df.join(rules, keep, "left_semi" if include else "left_anti")


def size_gate(df: DataFrame, limit: int, size: str, batch: list[str]) -> DataFrame:
    """Add ``oversized`` (this record is over the limit) and ``sendable`` (no record of its
    batch is): one record too big holds its whole batch back."""
    df = df.withColumn("oversized", F.col(size) > limit)
    bad = df.filter("oversized").select(*batch).distinct().withColumn("_bad", F.lit(True))
    return join_on(df, bad, batch, "left").withColumn("sendable", F.col("_bad").isNull()).drop("_bad")
