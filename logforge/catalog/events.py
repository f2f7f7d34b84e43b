"""Queries: event kinds, envelopes, subscription and stream records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.catalog.registry import Tables, query
from logforge.functions.text import gzip
from logforge.operators import framing
from logforge.operators.failures import dead_objects, route_failures
from logforge.plans.config import LogConfig
from logforge.plans.ship import frame_source
from logforge.sources import events as src
from logforge.sources.objects import notifications_to_paths as paths_of


def subscription_events(t: Tables) -> DataFrame:
    """Conversations as log subscriptions: a payload holds up to 64 turns."""
    entry = F.struct(F.col("turn").cast("string").alias("id"), F.col("turn").alias("timestamp"), F.col("text").alias("message"))
    df = t("conversations").groupBy("conv_id", F.floor(F.col("turn") / 64).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("turn", entry.alias("entry")))).alias("rows")
    )
    payload = F.struct(
        F.lit("1234").alias("owner"),
        F.concat(F.lit("/chat/"), (F.col("conv_id") % 4).cast("string")).alias("logGroup"),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("logStream"),
        F.lit("DATA_MESSAGE").alias("messageType"),
        F.array(F.lit("all")).alias("subscriptionFilters"),
        F.transform("rows", lambda r: r["entry"]).alias("logEvents"),
    )
    data = F.base64(gzip(F.encode(F.to_json(payload), "UTF-8")))
    event = F.to_json(F.struct(F.struct(data.alias("data")).alias("awslogs")))
    return df.select("conv_id", "block", event.alias("event"))


SUBSCRIPTION_SQL = """
SELECT conv_id, CAST(turn // 64 AS BIGINT) AS block, '/chat/' || (conv_id % 4) AS log_group,
  'conv-' || conv_id AS log_stream, '1234' AS owner,
  row_number() OVER (PARTITION BY conv_id, turn // 64 ORDER BY turn) - 1 AS pos, text AS log
FROM conversations
"""


def _subscription_rows(df: DataFrame) -> DataFrame:
    meta = {"log_group": "cw.log.group", "log_stream": "cw.log.stream", "owner": "cw.owner"}
    named = [F.try_element_at("meta", F.lit(key)).alias(name) for name, key in meta.items()]
    return df.select("conv_id", "block", *named, "pos", "log")


@query(SUBSCRIPTION_SQL)
def frame_cloudwatch(t: Tables) -> DataFrame:
    df = framing.frame_cloudwatch(src.read_cloudwatch(subscription_events(t)))
    return _subscription_rows(framing.explode_records(df))


@query(SUBSCRIPTION_SQL + " WHERE regexp_matches('conv-' || conv_id, '^conv-[0-9]*[02468]$')")
def stream_filter(t: Tables) -> DataFrame:
    payloads = src.read_cloudwatch(subscription_events(t))
    df = framing.frame_cloudwatch(payloads, stream_filter="^conv-[0-9]*[02468]$")
    return _subscription_rows(framing.explode_records(df))


@query(SUBSCRIPTION_SQL + " WHERE conv_id % 4 IN (1, 3) OR conv_id % 4 = 2")
def select_groups(t: Tables) -> DataFrame:
    # Two groups by name, others by the beginning of theirs.
    payloads = src.select_groups(src.read_cloudwatch(subscription_events(t)), ["/chat/1", "/chat/3", "/none"], ["/chat/2", "/x"])
    return _subscription_rows(framing.explode_records(framing.frame_cloudwatch(payloads)))


# Record events are rebuilt from the events table, a block of consecutive ids at a time.


def record_events(df: DataFrame, block: int, record: Column) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("event_id", F.to_json(record).alias("r"))))
    df = df.groupBy(F.floor(F.col("event_id") / block).alias("unit")).agg(rows.alias("rows"))
    records = F.array_join(F.transform("rows", lambda r: r["r"]), ",")
    return df.select("unit", F.concat(F.lit('{"Records":['), records, F.lit("]}")).alias("event"))


def event_id_text() -> Column:
    return F.col("event_id").cast("string")


@query("""
SELECT CAST(event_id // 50 AS BIGINT) AS unit, CAST(event_id AS VARCHAR) AS id, 0 AS pos, props AS log,
  CASE WHEN event_id % 4 = 0 THEN '/ev/' || event_type END AS log_group FROM events WHERE event_id % 4 <> 3
UNION ALL
SELECT CAST(event_id // 50 AS BIGINT), CAST(event_id AS VARCHAR), 1, event_type, '/ev/' || event_type
FROM events WHERE event_id % 4 = 0
""")
def kinesis_records(t: Tables) -> DataFrame:
    # Subscription payload, plain text, gzip text, bytes that are no UTF-8.
    def entry(text: str) -> Column:
        return F.struct(event_id_text().alias("id"), F.lit(0).cast("bigint").alias("timestamp"), F.col(text).alias("message"))

    payload = F.to_json(F.struct(
        F.lit("1").alias("owner"), F.concat(F.lit("/ev/"), "event_type").alias("logGroup"), F.lit("s").alias("logStream"),
        F.lit("DATA_MESSAGE").alias("messageType"), F.array(F.lit("f")).alias("subscriptionFilters"),
        F.array(entry("props"), entry("event_type")).alias("logEvents"),
    ))
    case = F.col("event_id") % 4
    text = F.when(case == 0, payload).otherwise(F.col("props"))
    raw = F.encode(text, "UTF-8")
    data = F.when(case == 3, F.unhex(F.lit("FF00"))).when(case == 1, raw)
    sent = t("events").withColumn("data", F.coalesce(data, gzip(F.when(case.isin(0, 2), raw))))
    record = F.struct(
        event_id_text().alias("eventID"), F.lit("put").alias("eventName"), F.lit("aws:kinesis").alias("eventSource"),
        F.concat(F.lit("arn:"), "event_type").alias("eventSourceARN"),
        F.struct(F.base64("data").alias("data")).alias("kinesis"),
    )
    df = record_events(sent, 50, record)
    logs = frame_source(src.read_kinesis_records(df), LogConfig("Kinesis"))
    return logs.select(
        "unit", F.try_element_at("meta", F.lit("kinesis.event.id")).alias("id"), F.col("pos").cast("int").alias("pos"), "log",
        F.try_element_at("meta", F.lit("cw.log.group")).alias("log_group"),
    )


@query("""
SELECT event_id // 10 AS unit, 'm' || event_id AS id, 'aws:sqs' AS source, props AS log,
  CASE WHEN event_id % 3 = 0 THEN event_id % 5 ELSE 0 END AS retry
FROM events WHERE event_type <> 'view'
""")
def sqs_messages(t: Tables) -> DataFrame:
    # Views have no body; a third of the messages carry a readable attempt counter.
    counter = F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 5).cast("string")).when(F.col("event_id") % 3 == 1, "x")
    attribute = F.struct(counter.alias("stringValue"), F.lit("String").alias("dataType"))
    record = F.struct(
        F.concat(F.lit("m"), event_id_text()).alias("messageId"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("body"),
        F.lit("aws:sqs").alias("eventSource"),
        F.when(counter.isNotNull(), F.create_map(F.lit("retry"), attribute)).alias("messageAttributes"),
    )
    rows = src.read_sqs_messages(record_events(t("events"), 10, record))
    return rows.select(
        "unit", F.try_element_at("meta", F.lit("sqs.event.id")).alias("id"),
        F.try_element_at("meta", F.lit("sqs.event.source")).alias("source"), "log", F.col("retry").cast("bigint").alias("retry"),
    )


@query("SELECT event_id // 10 AS unit, event_id % 10 AS pos, event_type || ' ' || props AS log FROM events")
def sns_messages(t: Tables) -> DataFrame:
    record = F.struct(
        F.lit("aws:sns").alias("EventSource"),
        F.struct(event_id_text().alias("MessageId"), F.concat_ws(" ", "event_type", "props").alias("Message")).alias("Sns"),
    )
    return src.read_sns_messages(record_events(t("events"), 10, record)).select("unit", "pos", "log")


@query("""
SELECT event_id // 100 AS unit, event_type AS topic, event_id AS pos,
  CASE WHEN event_id % 3 = 1 THEN props ELSE event_type || ' ' || props END AS log
FROM events WHERE event_id % 7 <> 0
""")
def kafka_records(t: Tables) -> DataFrame:
    # Base64 and plain values, every seventh one null.
    text = F.concat_ws(" ", "event_type", "props")
    value = F.when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.base64(F.encode(text, "UTF-8")))
    record = F.struct(
        F.col("event_type").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.when(F.col("event_id") % 7 != 0, value).alias("value"),
    )
    unit = F.floor(F.col("event_id") / 100).alias("unit")
    parts = t("events").groupBy(unit, "event_type").agg(F.collect_list(record).alias("rows"))
    df = parts.groupBy("unit").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat("event_type", F.lit("-0")), "rows"))).alias("records")
    )
    df = df.select("unit", F.to_json(F.struct(F.lit("aws:kafka").alias("eventSource"), "records")).alias("event"))
    rows = src.read_kafka_records(df).filter(F.col("error").isNull())
    return rows.select("unit", F.try_element_at("meta", F.lit("kafka.topic")).alias("topic"), "pos", "log")


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN md5(md5(text) || '!') ELSE md5(text) END AS digest FROM documents
""")
def base64_decode(t: Tables) -> DataFrame:
    # Two thirds of the values are base64, the rest plain (with a character base64 lacks).
    value = F.when(F.col("doc_id") % 3 == 1, F.concat(F.md5("text"), F.lit("!"))).otherwise(
        F.translate(F.base64(F.encode("text", "UTF-8")), "\r\n", "")
    )
    df = t("documents").select("doc_id", F.lit("docs").alias("topic"), value.alias("value"))
    return src.kafka_values(df).select("doc_id", F.md5("log").alias("digest"))


def kinds(props: Column) -> list[Column]:
    """Sample events of every kind around one text."""
    quoted = F.to_json(F.struct(props.alias("body")))

    def build(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    return [
        build('{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"k"}},"note":', quoted, "}]}"),
        build('{"Records":[{"EventSource":"aws:sns","Sns":{"Message":"m","data":', quoted, "}}]}"),
        build('{"detail-type":"scan","detail":{"repository-name":"r","note":', quoted, "}}"),
        build('{"awslogs":{"data":"x"},"note":', quoted, "}"),
        build('{"Records":[{"kinesis":{"data":"eA=="},"note":', quoted, "}]}"),
        build('{"Records":[{"messageId":"1","attributes":', quoted, "}]}"),
        build('{"invocationId":"i","records":[{"recordId":"1","data":"eA==","note":', quoted, "}]}"),
        build('{"records":{"t-0":[', quoted, "]}}"),
        build('{"records":{},"note":', quoted, "}"),
        build("not json ", props),
    ]


@query("""
SELECT event_id % 3 AS kind, CASE event_id % 3 WHEN 1 THEN 'not base64' WHEN 2 THEN 'not UTF-8' END AS error,
  event_id % 3 = 0 AS shipped, count(*) AS n FROM events GROUP BY ALL
""")
def bad_base64(t: Tables) -> DataFrame:
    # Stream records: text, data that is no base64, bytes that are no text. No row is lost.
    kind = F.col("event_id") % 3
    data = F.when(kind == 0, F.base64(F.encode("props", "UTF-8"))).when(kind == 1, F.lit("%%% no base64 %%%")).otherwise(
        F.base64(F.unhex(F.lit("FFFE00"))))
    record = F.struct(F.col("event_id").cast("string").alias("eventID"), F.struct(data.alias("data")).alias("kinesis"))
    df = t("events").select(kind.alias("kind"), F.to_json(F.struct(F.array(record).alias("Records"))).alias("event"))
    df = src.read_kinesis_records(df)
    return df.groupBy("kind", "error", F.col("text").isNotNull().alias("shipped")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id % 3 AS kind, count(*) AS n, count(*) AS stored FROM events GROUP BY ALL
""")
def dead_malformed(t: Tables) -> DataFrame:
    # Dead-lettering takes the very events that nothing else could read.
    kind = F.col("event_id") % 3
    event = F.when(kind == 0, F.lit('{"awslogs":{"data":"%%%"}}')).when(kind == 1, F.lit('{"awslogs":{"data":"H4sIAP//"}}')).otherwise(
        F.concat(F.lit("{broken "), "props"))
    df = t("events").select(kind.alias("kind"), event.alias("event"), F.col("ts").cast("timestamp").alias("ts"))
    dead = dead_objects(df, "dead")
    stored = (F.col("data") == F.encode("event", "UTF-8")) & F.col("object_path").endswith(".json")
    return dead.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(stored).alias("stored"))


@query("""
SELECT event_id, event_id % 4 AS tries, CASE WHEN event_id % 4 = 3 THEN 'dead' ELSE 'retry' END AS route,
  CAST(CASE event_id % 4 WHEN 0 THEN 0 WHEN 3 THEN 3 ELSE event_id % 4 + 1 END AS INTEGER) AS retry,
  'm-' || event_id AS message_id FROM events
""")
def retry_cycle(t: Tables) -> DataFrame:
    # Queue messages, first from the source queue, then from the retry queue with their
    # counter; all of them fail (again) and are routed by the context the envelope had.
    tries = F.col("event_id") % 4
    attributes = F.when(tries > 0, F.create_map(F.lit("retry"), F.struct(
        F.when(tries == 3, "3").otherwise(tries.cast("string")).alias("stringValue"), F.lit("Number").alias("dataType"))))
    record = F.struct(
        F.concat(F.lit("m-"), event_id_text()).alias("messageId"), F.col("props").alias("body"), F.lit("aws:sqs").alias("eventSource"),
        F.when(tries == 0, "arn:aws:sqs:eu:1:in").otherwise("arn:aws:sqs:eu:1:retry").alias("eventSourceARN"),
        attributes.alias("messageAttributes"))
    df = t("events").select("event_id", tries.alias("tries"), F.col("ts").cast("timestamp").alias("ts"),
                            F.to_json(F.struct(F.array(record).alias("Records"))).alias("event"))
    df = src.with_retry_context(df, "arn:aws:sqs:eu:1:retry").withColumn("error", F.lit("failed"))
    return route_failures(df).select("event_id", "tries", "route", "retry", "message_id")


@query("""
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'S3' WHEN 1 THEN 'Sns' WHEN 2 THEN 'EcrScan' WHEN 3 THEN 'CloudWatch'
  WHEN 4 THEN 'Kinesis' WHEN 5 THEN 'Sqs' WHEN 6 THEN 'Firehose' WHEN 7 THEN 'Kafka' ELSE 'unsupported' END AS event_kind
FROM events
""")
def classify_events(t: Tables) -> DataFrame:
    case = F.col("event_id") % 10
    event = F.coalesce(*[F.when(case == i, text) for i, text in enumerate(kinds(F.col("props")))])
    df = t("events").select("event_id", event.alias("event"))
    return src.classify_events(df).select("event_id", "event_kind")


@query("""
SELECT event_id, CASE event_id % 5 WHEN 2 THEN 'Sns' ELSE 'S3' END AS event_kind,
  CASE event_id % 5 WHEN 2 THEN NULL ELSE event_type || '/' || event_id END AS key
FROM events
""")
def unwrap_envelopes(t: Tables) -> DataFrame:
    # Notification; in a queue message; in a topic in a queue message; plain topic text; five deep.
    notice = F.to_json(F.struct(F.array(F.struct(
        F.lit("ObjectCreated:Put").alias("eventName"),
        F.struct(
            F.struct(F.lit("b").alias("name")).alias("bucket"),
            F.struct(F.concat_ws("/", "event_type", event_id_text()).alias("key")).alias("object"),
        ).alias("s3"),
    )).alias("Records")))

    def topic(text: Column) -> Column:
        return F.to_json(F.struct(F.array(F.struct(
            F.lit("aws:sns").alias("EventSource"), F.struct(text.alias("Message")).alias("Sns"))).alias("Records")))

    def queue(text: Column) -> Column:
        return F.to_json(F.struct(F.array(F.struct(F.lit("1").alias("messageId"), text.alias("body"))).alias("Records")))

    case = F.col("event_id") % 5
    deep = queue(queue(queue(queue(topic(notice)))))
    event = (
        F.when(case == 0, notice).when(case == 1, queue(notice)).when(case == 2, queue(topic(F.col("props"))))
        .when(case == 3, deep)
        .otherwise(queue(topic(notice)))
    )
    df = src.unwrap_envelopes(t("events").select("event_id", event.alias("event")))
    key = F.get_json_object("event", "$.Records[0].s3.object.key")
    return df.select("event_id", "event_kind", key.alias("key"))


@query("""
SELECT page_id, n, 'bucket-' || n AS bucket, url || ' +' || page_id AS key
FROM pages, (SELECT 1 AS n UNION ALL SELECT 2)
""")
def notifications_to_paths(t: Tables) -> DataFrame:
    # Two records per notification; keys come percent-encoded with + for blanks.
    def record(n: int) -> Column:
        key = F.url_encode(F.concat(F.col("url"), F.lit(" +"), F.col("page_id").cast("string")))
        return F.struct(F.struct(
            F.struct(F.lit(f"bucket-{n}").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
        ).alias("s3"))

    event = F.to_json(F.struct(F.array(record(1), record(2)).alias("Records")))
    df = paths_of(t("pages").select("page_id", event.alias("event")))
    return df.select("page_id", F.substr("bucket", F.lit(8)).cast("int").alias("n"), "bucket", "key")
