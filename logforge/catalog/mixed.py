"""Queries: events of all kinds in one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.catalog.framing import write_objects
from logforge.catalog.registry import Tables, query
from logforge.functions.text import gzip
from logforge.plans.config import LogConfig
from logforge.plans.route import route_events as route, ship_events as ship
from logforge.session import work_dir

KINDS = 10


def wrapped(*fields: Column) -> Column:
    """An event with one record."""
    return F.to_json(F.struct(F.array(F.struct(*fields)).alias("Records")))


def mixed_events(t: Tables) -> DataFrame:
    """An event of each kind in turn around the text of a row: ``unit``, ``event``."""
    props, number = F.col("props"), F.col("event_id").cast("string")
    case = F.col("event_id") % KINDS
    notice = wrapped(F.struct(
        F.struct(F.lit("b").alias("name")).alias("bucket"),
        F.struct(F.concat(F.lit("shard+"), (F.floor(F.col("event_id") / KINDS) % 8).cast("string")).alias("key")).alias("object"),
    ).alias("s3"))
    topic = wrapped(F.lit("aws:sns").alias("EventSource"), F.struct(props.alias("Message")).alias("Sns"))
    scan = F.to_json(F.struct(F.lit("scan").alias("id"), F.struct(
        F.col("event_type").alias("repository-name"), F.lit("d").alias("image-digest")).alias("detail")))
    entry = F.struct(number.alias("id"), F.lit(0).cast("bigint").alias("timestamp"), props.alias("message"))
    payload = F.to_json(F.struct(
        F.lit("1").alias("owner"), F.concat(F.lit("/ev/"), "event_type").alias("logGroup"), F.lit("s").alias("logStream"),
        F.lit("DATA_MESSAGE").alias("messageType"), F.array(F.lit("f")).alias("subscriptionFilters"),
        F.array(entry, entry).alias("logEvents")))
    zipped = F.base64(gzip(F.when(case.isin(3, 9), F.encode(payload, "UTF-8"))))
    subscription = F.to_json(F.struct(F.struct(zipped.alias("data")).alias("awslogs")))
    plain = F.base64(F.encode(props, "UTF-8"))
    stream = wrapped(number.alias("eventID"), F.struct(
        F.when(F.col("event_id") % 40 == 4, "%%%").otherwise(plain).alias("data")).alias("kinesis"))
    queued = wrapped(F.lit("m").alias("messageId"), topic.alias("body"))
    delivery = F.to_json(F.struct(F.lit("i").alias("invocationId"), F.array(F.struct(
        F.lit("1").alias("recordId"), F.lit("eA==").alias("data"))).alias("records")))
    kafka = F.to_json(F.struct(F.lit("aws:kafka").alias("eventSource"), F.create_map(
        F.lit("t-0"), F.array(F.struct(F.lit("t").alias("topic"), props.alias("value")))).alias("records")))
    broken = F.concat(F.lit("{broken "), props)
    event = F.coalesce(*[F.when(case == i, e) for i, e in enumerate(
        [notice, topic, scan, subscription, stream, queued, delivery, kafka, broken, wrapped(
            F.lit("q").alias("messageId"), subscription.alias("body"))])])
    return t("events").select(F.col("event_id").alias("unit"), event.alias("event"))


def image_findings(t: Tables) -> DataFrame:
    """Findings of all images but one: ``signup`` has none."""
    finding = F.struct(
        F.concat(F.lit("CVE-"), "event_type").alias("name"), F.lit("u").alias("uri"), F.lit("HIGH").alias("severity"),
        F.array(F.struct(F.lit("package_name").alias("key"), F.lit("p").alias("value"))).alias("attributes"))
    images = t("events").filter("event_type <> 'signup'").select("event_type").distinct()
    return images.select(
        F.col("event_type").alias("repository"), F.lit("d").alias("image_digest"), F.array(finding).alias("findings"),
        F.lit(None).cast("map<string,bigint>").alias("severity_counts"))


ROUTED_SQL = f"""
WITH e AS (SELECT event_id AS unit, event_id % {KINDS} AS k, event_id // {KINDS} % 8 AS shard, event_type, props FROM events),
routed AS (
  SELECT unit, 'S3' AS kind, 0 AS pos, NULL AS log, NULL AS error, shard FROM e WHERE k = 0
  UNION ALL SELECT unit, 'Sns', 0, props, NULL, NULL FROM e WHERE k IN (1, 5)
  UNION ALL SELECT unit, 'EcrScan', 0, CASE WHEN event_type <> 'signup' THEN 'CVE-' || event_type END,
    CASE WHEN event_type = 'signup' THEN 'no scan findings' END, NULL FROM e WHERE k = 2
  UNION ALL SELECT unit, 'CloudWatch', n, props, NULL, NULL FROM e, (SELECT 0 AS n UNION ALL SELECT 1) WHERE k IN (3, 9)
  UNION ALL SELECT unit, 'Kinesis', 0, CASE WHEN unit % 40 <> 4 THEN props END,
    CASE WHEN unit % 40 = 4 THEN 'not base64' END, NULL FROM e WHERE k = 4
  UNION ALL SELECT unit, 'Firehose', 0, NULL, 'delivery-stream events carry no logs', NULL FROM e WHERE k = 6
  UNION ALL SELECT unit, 'Kafka', 0, props, NULL, NULL FROM e WHERE k = 7
  UNION ALL SELECT unit, 'unsupported', 0, NULL, 'unsupported event', NULL FROM e WHERE k = 8)
"""


def shown_log(log: Column) -> Column:
    """A scan's record by its name, other logs as they are."""
    name = F.get_json_object(log, "$.findings.details.name")
    return F.when(F.col("event_kind") == "EcrScan", name).otherwise(log)


@query(ROUTED_SQL + """
SELECT unit, kind, CAST(pos AS BIGINT) AS pos, log, error, 'shard ' || shard AS key FROM routed
""")
def route_events(t: Tables) -> DataFrame:
    rows = route(mixed_events(t), LogConfig("S3"), image_findings(t))
    return rows.select(
        "unit", F.col("event_kind").alias("kind"), "pos", shown_log(F.col("log")).alias("log"), "error", "key")


@query(ROUTED_SQL + """
, objects AS (SELECT shard, n, 'line ' || n || ' of ' || shard || ': ' || count(*) AS log
  FROM e, (SELECT unnest(range(3)) AS n) WHERE k = 0 GROUP BY shard, n),
sent AS (
  SELECT r.unit, kind, o.log, CASE WHEN r.shard = 5 THEN 'missing' END AS error, CASE WHEN r.shard <> 5 THEN 'b' END AS subsystem
  FROM routed r LEFT JOIN objects o ON o.shard = r.shard AND r.shard <> 5 WHERE kind = 'S3'
  UNION ALL
  SELECT unit, kind, log, error, CASE WHEN error IS NOT NULL THEN NULL
    WHEN kind = 'CloudWatch' THEN '/ev/' || event_type ELSE 'NO SUBSYSTEM NAME' END
  FROM routed JOIN e USING (unit) WHERE kind <> 'S3')
SELECT unit, kind, log, error, subsystem, CASE WHEN error IS NULL THEN 'app' END AS application,
  CASE WHEN error IS NULL THEN CAST(0 AS BIGINT) END AS batch_id FROM sent
""")
def ship_events(t: Tables) -> DataFrame:
    # Seven shards of objects lie where notifications say; the sixth is missing.
    root = work_dir(t.spark, "shards")
    shard = F.floor(F.col("event_id") / KINDS) % 8
    counts = t("events").filter(F.col("event_id") % KINDS == 0).groupBy(shard.alias("shard")).count()
    number = F.col("shard").cast("string")
    lines = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda n: F.concat(
        F.lit("line "), n.cast("string"), F.lit(" of "), number, F.lit(": "), F.col("count").cast("string")))
    content = F.encode(F.array_join(lines, "\n"), "UTF-8")
    objects = counts.select(F.concat(F.lit("shard "), number).alias("key"), content.alias("content"))
    write_objects(objects.filter("key <> 'shard 5'"), root)
    cfg = LogConfig("S3", application="app", batch_target=100_000)
    rows = ship(mixed_events(t), cfg, image_findings(t), address=root + "/{bucket}/{key}")
    error = F.when(F.contains("error", F.lit("FileNotFound")), "missing").otherwise(F.col("error"))
    return rows.select(
        F.substring_index("unit", "#", 1).cast("bigint").alias("unit"), F.col("event_kind").alias("kind"),
        shown_log(F.col("log")).alias("log"), error.alias("error"), "application", "subsystem", "batch_id")
