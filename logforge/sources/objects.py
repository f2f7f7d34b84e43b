"""Objects (files) as rows of bytes, their text, and paths from notifications."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.functions.text import gunzip, gunzip_or_raw, object_key, utf8_or_null
from logforge.operators.rows import unfold

NOTIFICATION_SCHEMA = """Records array<struct<eventSource string, eventName string,
    s3 struct<bucket struct<name string>, object struct<key string>>>>"""


def read_objects(
    spark: SparkSession,
    paths: str | list[str],
    prefix: str | None = None,
    suffix: str | None = None,
) -> DataFrame:
    """Whole objects: ``unit`` (path), ``content``, ``length``, ``meta`` (bucket and key).

    ``prefix`` / ``suffix`` select object keys, as a source notification filter does. The
    suffix goes to the listing as a glob, so other objects are never opened; give the
    prefix's folder in ``paths`` to bound the listing itself.
    """
    reader = spark.read.format("binaryFile")
    if suffix and "/" not in suffix:
        reader = reader.option("pathGlobFilter", "*" + re.sub(r"([*?{}\[\]\\])", r"\\\1", suffix))
    df = reader.load(paths)
    bucket, key = split_path(F.col("path"))
    df = df.select(F.col("path").alias("unit"), "content", "length", bucket.alias("bucket"), key.alias("key"))
    return select_keys(df, prefix, suffix).select(
        "unit", "content", "length", object_meta(F.col("bucket"), F.col("key")).alias("meta")
    )


def split_path(path: Column) -> tuple[Column, Column]:
    """Bucket and key of an object's address."""
    pattern = r"^[a-z0-9]+:/{1,2}([^/]*)/+(.*)$"
    return F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)


def object_meta(bucket: Column, key: Column) -> Column:
    return F.create_map(F.lit("s3.bucket"), bucket, F.lit("s3.object.key"), key)


def select_keys(df: DataFrame, prefix: str | None, suffix: str | None, key: str = "key") -> DataFrame:
    if prefix:
        df = df.filter(F.col(key).startswith(prefix))
    if suffix:
        df = df.filter(F.col(key).endswith(suffix))
    return df


def decode_objects(df: DataFrame, compression: str = "auto_ext") -> DataFrame:
    """``content`` → ``text`` plus ``error`` (NULL when fine).

    ``auto_ext`` inflates keys ending in ``.gz``, ``gzip`` always, ``sniff`` tries and
    otherwise keeps the bytes. Rows with an error are for a quarantine table.
    """
    raw = F.col("content")
    if compression == "auto_ext":
        named = F.col("unit").endswith(".gz")
        data = F.when(named, gunzip(F.when(named, raw))).otherwise(raw)
    elif compression == "gzip":
        data = gunzip(raw)
    elif compression == "sniff":
        data = gunzip_or_raw(raw)
    else:
        raise ValueError(f"unknown compression {compression!r}")
    df = df.withColumn("_data", data).withColumn("text", utf8_or_null(F.col("_data")))
    error = F.when(F.col("_data").isNull(), "nothing could be decompressed").when(
        F.col("text").isNull(), "not UTF-8"
    )
    return df.withColumn("error", error).drop("_data", "content")


def read_lines(spark: SparkSession, paths: str | list[str], separator: str = "\n") -> DataFrame:
    """Uncompressed objects of any size, split by a literal separator while reading.

    A file is read by many tasks. ``block`` (start of the file split) and ``seq`` order
    the lines of one ``unit``; pass them as ``chunk`` and ``order`` to the ordered operators.
    ``size`` is the file's.
    """
    df = spark.read.option("lineSep", separator).text(paths)
    return df.select(
        F.col("_metadata.file_path").alias("unit"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("log"),
        F.col("_metadata.file_size").alias("size"),
    )


def notifications_to_paths(df: DataFrame, event: str = "event") -> DataFrame:
    """Object-created notifications (JSON text) → ``bucket``, ``key``, one row per record."""
    records = F.from_json(F.col(event), NOTIFICATION_SCHEMA).getField("Records")
    rest = [c for c in df.columns if c != event]
    return unfold(df, rest, records, "_r").select(
        *rest,
        F.col("_r.s3.bucket.name").alias("bucket"),
        object_key(F.col("_r.s3.object.key")).alias("key"),
    )
