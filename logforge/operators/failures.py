"""Failure routing: retry table, dead-letter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.sources.events import classify_events, read_cloudwatch
from logforge.sources.objects import NOTIFICATION_SCHEMA

# Default attempts and delay (seconds).
RETRY_LIMIT = 3
RETRY_DELAY = 900


def route_failures(df: DataFrame, limit: int = RETRY_LIMIT, delay_seconds: int = RETRY_DELAY) -> DataFrame:
    """Failed units ``(…, from_retry, retry, error, ts)`` → plus ``route``, ``retry``,
    ``last_error``, ``not_before``.

    A first failure enters the retry table with counter 0. A unit read from there goes back
    with the counter raised, until it has reached the limit; then it is ``dead``. A missing
    or unreadable counter counts as 0.
    """
    counter = F.coalesce(F.col("retry").cast("string").try_cast("int"), F.lit(0))
    again = F.coalesce("from_retry", F.lit(False))
    dead = again & (counter >= limit)
    return df.withColumns({
        "route": F.when(dead, "dead").otherwise("retry"),
        "retry": F.when(~again, 0).when(dead, counter).otherwise(counter + 1),
        "last_error": F.col("error"),
        "not_before": F.when(~dead, F.timestamp_micros(F.unix_micros("ts") + delay_seconds * 1_000_000)),
    }).drop("error", "from_retry")


def due(retries: DataFrame, now: Column) -> DataFrame:
    """Rows of the retry table whose delay is over."""
    return retries.filter(F.col("not_before") <= now)


def dead_objects(df: DataFrame, prefix: str, event: str = "event", ts: str = "ts") -> DataFrame:
    """Add ``object_path`` and ``data`` of dead events.

    The name is the MD5 of the event; under its log group and stream for subscriptions; the
    object's own bucket and key for notifications whose object (column ``content``, if
    there is one) could be read, and then the object is what is stored.
    """
    df = classify_events(df, event)
    digest = F.concat(F.md5(F.col(event)), F.lit(".json"))
    df = read_cloudwatch(df.withColumn("_raw", F.col(event)), "_raw")
    record = F.get(F.from_json(F.col(event), NOTIFICATION_SCHEMA).getField("Records"), F.lit(0)).getField("s3")
    content = F.col("content") if "content" in df.columns else F.lit(None).cast("binary")
    readable = (F.col("event_kind") == "S3") & content.isNotNull()
    name = (
        F.when(readable, F.concat_ws("/", record["bucket"]["name"], record["object"]["key"]))
        .when(F.col("payload").isNotNull(), F.concat_ws("/", F.col("payload.logGroup"), F.col("payload.logStream"), digest))
        .otherwise(digest)
    )
    path = F.concat_ws("/", F.lit(prefix.rstrip("/")), F.lit("failed-events"), F.date_format(ts, "yyyy/MM/dd/HH"), name)
    return df.withColumns({
        "object_path": path,
        "data": F.when(readable, content).otherwise(F.encode(F.col(event), "UTF-8")),
    }).drop("payload")


def store_dead(df: DataFrame, path: str, ts: str = "ts", run: str | None = None) -> None:
    """Add dead events to a table partitioned by day and hour.

    With ``run``, a name for what is stored now, the rows get a folder of their own below
    ``path``, which storing them again replaces; without, they are appended.

    Rows are brought together by hour for few files; a hot hour is split again by size.
    """
    (
        df.withColumn("dt", F.date_format(ts, "yyyy-MM-dd"))
        .withColumn("hour", F.date_format(ts, "HH"))
        .hint("rebalance", F.col("dt"), F.col("hour"))
        .write.mode("append" if run is None else "overwrite")
        .partitionBy("dt", "hour")
        .parquet(path if run is None else f"{path.rstrip('/')}/run={run}")
    )
