"""Log-group tags: latest, or as they were known at the time of the record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logforge.operators.body import TAGS
from logforge.operators.joins import join_on


def join_group_tags(
    df: DataFrame,
    tags: DataFrame,
    ttl_seconds: int | None = None,
    group: str = "log_group",
    ts: str = "ts",
) -> DataFrame:
    """Left-join ``tags(log_group, tags, fetched_at)`` and put them into ``meta['cw.tags']``.

    Without ``ttl_seconds``, or with 0 (nothing is remembered), the latest snapshot of a group
    counts. With it, a record gets
    the latest snapshot not after its ``ts`` and younger than the time to live. Empty tags,
    or none, leave ``meta`` as it is.

    The as-of join is an equi-join: a snapshot is valid for at most one time to live, so it
    meets at most two time buckets of that width. Buckets also spread a hot group.
    """
    tags = tags.select(F.col("log_group").alias("_group"), "tags", "fetched_at")
    if not ttl_seconds:
        latest = tags.groupBy("_group").agg(F.max_by("tags", "fetched_at").alias("_tags"))
        df = df.withColumn("_group", F.col(group))
        df = join_on(df, latest, ["_group"], "left").drop("_group")
    else:
        ttl = ttl_seconds * 1_000_000
        later = Window.partitionBy("_group").orderBy("_from")
        spans = (
            tags.withColumn("_from", F.unix_micros("fetched_at"))
            .groupBy("_group", "_from")
            .agg(F.max_by("tags", "_from").alias("_tags"))
            .withColumn("_to", F.least(F.lead("_from").over(later), F.col("_from") + ttl))
        )
        buckets = F.sequence(F.floor(F.col("_from") / ttl), F.floor((F.col("_to") - 1) / ttl))
        spans = spans.select(F.col("_group").alias("_g"), "_from", "_to", "_tags", F.explode(buckets).alias("_bucket"))
        now = F.unix_micros(F.col(ts))
        df = df.join(
            spans,
            (F.col(group) == F.col("_g"))
            & (F.floor(now / F.lit(ttl)) == F.col("_bucket"))
            & (now >= F.col("_from"))
            & (now < F.col("_to")),
            "left",
        ).drop("_g", "_from", "_to", "_bucket")
    some = F.col("_tags").isNotNull() & (F.size("_tags") > 0)
    meta = F.coalesce(F.col("meta"), F.create_map().cast("map<string,string>"))
    with_tags = F.map_concat(meta, F.create_map(F.lit(TAGS), F.to_json("_tags")))
    return df.withColumn("meta", F.when(some, with_tags).otherwise(F.col("meta"))).drop("_tags")
