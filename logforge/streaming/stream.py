"""The same operators on streams: each micro-batch is shipped as one finite set of units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logforge.sources.events import kafka_values
from logforge.sources.objects import object_meta, split_path


def ship_stream(
    stream: DataFrame,
    ship: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Run ``ship`` on every micro-batch and write its result under ``path``.

    Ordered operators (packing, sampling of row tables, grouping) need a finite frame, so
    they run inside ``foreachBatch``. Each batch overwrites its own folder: a batch that is
    repeated after a failure replaces what it wrote before.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        ship(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_kafka_stream(
    spark: SparkSession, servers: str, topics: str | list[str], pattern: bool = False, **options: str
) -> DataFrame:
    """Kafka topics as log rows ``unit, pos, log, meta, error, ts``; a unit is a topic
    partition. With ``pattern``, ``topics`` is a regular expression of topic names. Needs the
    Kafka connector on the class path."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribePattern" if pattern else "subscribe", names)
    return kafka_rows(reader.options(**options).load())


def kafka_rows(rows: DataFrame) -> DataFrame:
    """Rows as the Kafka source gives them (binary ``value``) → log rows."""
    rows = rows.filter("value IS NOT NULL").select(
        F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("unit"),
        F.col("offset").alias("pos"),
        F.col("timestamp").alias("ts"),
        "topic",
        "value",
    )
    return kafka_values(rows).drop("topic", "value")


def read_object_stream(spark: SparkSession, path: str, glob: str | None = None, per_trigger: int = 1000) -> DataFrame:
    """New objects of a folder as ``unit, content, length, meta``, for ``decode_objects``."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    bucket, key = split_path(F.col("path"))
    return reader.load(path).select(
        F.col("path").alias("unit"), "content", "length", object_meta(bucket, key).alias("meta"))
