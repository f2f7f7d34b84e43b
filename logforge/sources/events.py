"""Incoming events as JSON text: kinds, envelopes, and the records inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.functions.text import base64_bytes, base64_or_raw, gunzip_or_raw, strict_object, utf8_or_null
from logforge.operators.joins import join_on
from logforge.operators.rows import unfold
from logforge.session import staged
from logforge.sources.objects import NOTIFICATION_SCHEMA

ATTRIBUTE = "struct<stringValue string, dataType string>"
SQS_SCHEMA = f"""Records array<struct<messageId string, body string, eventSource string,
    eventSourceARN string, messageAttributes map<string,{ATTRIBUTE}>>>"""
SNS_SCHEMA = "Records array<struct<EventSource string, Sns struct<MessageId string, TopicArn string, Message string>>>"
KINESIS_SCHEMA = """Records array<struct<eventID string, eventName string, eventSource string,
    eventSourceARN string, kinesis struct<data string>>>"""
KAFKA_SCHEMA = """eventSource string, records map<string,
    array<struct<topic string, partition int, offset bigint, key string, value string>>>"""
CLOUDWATCH_SCHEMA = """owner string, logGroup string, logStream string, messageType string,
    subscriptionFilters array<string>,
    logEvents array<struct<id string, timestamp bigint, message string>>"""


SCAN_SCHEMA = """id string, source string, detail struct<`repository-name` string,
    `image-digest` string, `image-tags` array<string>>"""
FIREHOSE_SCHEMA = "records array<struct<recordId string, data string>>"


def event_kind(event: Column) -> Column:
    """Kind of one event; the order matters because the shapes overlap."""

    def has(path: str) -> Column:
        return F.try_variant_get(event, path, "variant").isNotNull()

    def typed(path: str, prefix: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(event, path, "variant")).startswith(prefix)

    records = F.try_variant_get(event, "$.records", "map<string,variant>")
    return (
        F.when(has("$.Records[0].s3") | (typed("$.Records", "ARRAY") & ~has("$.Records[0]")), "S3")
        .when(has("$.Records[0].Sns"), "Sns")
        .when(has("$.detail['repository-name']") | has("$.detail['finding-severity-counts']"), "EcrScan")
        .when(has("$.awslogs.data"), "CloudWatch")
        .when(has("$.Records[0].kinesis"), "Kinesis")
        .when(has("$.Records[0].messageId") | has("$.Records[0].body"), "Sqs")
        .when(typed("$.records", "ARRAY"), "Firehose")
        .when(typed("$.records", "OBJECT") & (F.size(records) > 0), "Kafka")
        .otherwise("unsupported")
    )


def classify_events(df: DataFrame, event: str = "event", known: Column | None = None) -> DataFrame:
    """Add ``event_kind``; text that fits nothing becomes ``unsupported`` (quarantine).

    Events with a ``known`` kind keep it and are not parsed.
    """
    text = F.col(event) if known is None else F.when(known.isNull(), F.col(event))
    df = df.withColumn("_event", F.try_parse_json(text))
    kind = event_kind(F.col("_event"))
    return df.withColumn("event_kind", kind if known is None else F.coalesce(known, kind)).drop("_event")


def unwrap_envelopes(df: DataFrame, event: str = "event", depth: int = 3) -> DataFrame:
    """Replace queue messages and notification topics by the event they carry, however deep.

    One narrow pass per level; after ``depth`` passes the rows are written out and passes go
    on while any row is still an envelope. Topic messages that carry no object notification
    stay as they are (they are log text), as does anything that is no envelope. A stream
    cannot be looked at while it is planned; there a row that is an envelope after ``depth``
    levels gets ``error``, for the quarantine.

    With a column ``message_id``, ``source_arn`` and ``retry`` (see ``with_retry_context``)
    those of the outermost message are kept.
    """
    df = _unwrap_levels(df, event, depth)
    if df.isStreaming:
        kept = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
        deep = (F.col("event_kind") == "Sqs") | ((F.col("event_kind") == "Sns") & _notices(event))
        return df.withColumn("error", F.coalesce(kept, F.when(deep, "nested too deep")))
    while True:
        df = staged(df, "unwrapped")
        deep = (F.col("event_kind") == "Sqs") | ((F.col("event_kind") == "Sns") & _notices(event))
        if df.filter(deep & ~_text_messages(event)).isEmpty():
            return df
        df = _unwrap_levels(df.drop("event_kind"), event, 1)


def _text_messages(event: str) -> Column:
    """A queue event none of whose bodies can be unwrapped further."""
    bodies = F.transform(F.from_json(F.col(event), SQS_SCHEMA).getField("Records"), lambda r: r["body"])
    return (F.col("event_kind") == "Sqs") & ~F.coalesce(F.exists(bodies, lambda b: b.isNotNull()), F.lit(False))


def _notices(event: str) -> Column:
    """Whether all messages of a topic event are object notifications."""
    messages = F.transform(F.from_json(F.col(event), SNS_SCHEMA).getField("Records"), lambda r: r["Sns"]["Message"])
    return F.forall(
        messages,
        lambda m: F.get(F.from_json(m, NOTIFICATION_SCHEMA).getField("Records"), F.lit(0)).getField("s3").isNotNull(),
    )


def with_retry_context(df: DataFrame, retry_arn: str | None = None, event: str = "event") -> DataFrame:
    """Add ``message_id``, ``source_arn``, ``retry`` and ``from_retry`` of queue events, one row per
    message: each row gets an event with that message alone.

    ``from_retry`` says that the message came from the queue ``retry_arn``; ``retry`` is its
    attempt counter as text. Other events have NULL and false. Use it before
    ``unwrap_envelopes``, whose rows keep the columns, and ``route_failures`` after.
    """
    df = classify_events(df, event)
    records = F.from_json(F.col(event), SQS_SCHEMA).getField("Records")
    none = F.lit(None).cast(records_type())
    rest = [c for c in df.columns if c not in (event, "event_kind", "message_id", "source_arn", "retry", "from_retry")]
    one = F.when(F.col("event_kind") == "Sqs", records).otherwise(F.array(none))
    df = unfold(df.withColumn("_old", F.col(event)), [*rest, "_old"], one, "_r").drop("_pos")
    text = F.to_json(F.struct(F.array("_r").alias("Records")))
    arn = F.col("_r.eventSourceARN")
    return df.select(
        *rest,
        F.when(F.col("_r").isNotNull(), text).otherwise(F.col("_old")).alias(event),
        F.col("_r.messageId").alias("message_id"),
        arn.alias("source_arn"),
        F.try_element_at("_r.messageAttributes", F.lit("retry")).getField("stringValue").alias("retry"),
        F.coalesce(arn == F.lit(retry_arn), F.lit(False)).alias("from_retry"),
    )


def records_type() -> str:
    """The type of one queue record."""
    return SQS_SCHEMA.split("array<", 1)[1].rsplit(">", 1)[0]


def _unwrap_levels(df: DataFrame, event: str, depth: int) -> DataFrame:
    df = classify_events(df, event)
    for _ in range(depth):
        bodies = F.transform(F.from_json(F.col(event), SQS_SCHEMA).getField("Records"), lambda r: r["body"])
        messages = F.transform(F.from_json(F.col(event), SNS_SCHEMA).getField("Records"), lambda r: r["Sns"]["Message"])
        # What was no envelope keeps its kind; what came out of one is another event.
        def unwrapped(text: Column, kind: Column | None = None) -> Column:
            kind = F.lit(None).cast("string") if kind is None else kind
            return F.struct(text.alias("text"), kind.alias("kind"))

        inner = (
            F.when(F.col("event_kind") == "Sqs", F.transform(F.filter(bodies, lambda b: b.isNotNull()), lambda b: unwrapped(b)))
            .when((F.col("event_kind") == "Sns") & _notices(event), F.transform(messages, lambda m: unwrapped(m)))
            .otherwise(F.array(unwrapped(F.col(event), F.col("event_kind"))))
        )
        rest = [c for c in df.columns if c not in (event, "event_kind")]
        df = unfold(df, rest, inner, "_inner").select(*rest, F.col("_inner.text").alias(event), F.col("_inner.kind").alias("_kind"))
        df = classify_events(df, event, F.col("_kind")).drop("_kind")
    return df


def _explode_records(df: DataFrame, event: str, schema: str) -> DataFrame:
    records = F.from_json(F.col(event), schema).getField("Records")
    rest = [c for c in df.columns if c not in (event, "pos")]
    return unfold(df, rest, records, "r", "pos")


def read_sqs_messages(df: DataFrame, event: str = "event") -> DataFrame:
    """Text messages of a queue, one log each; ``retry`` is the attempt counter."""
    rest = [c for c in df.columns if c not in (event, "pos")]
    retry = F.try_element_at("r.messageAttributes", F.lit("retry")).getField("stringValue")
    return (
        _explode_records(df, event, SQS_SCHEMA)
        .filter(F.col("r.body").isNotNull())
        .select(
            *rest,
            "pos",
            F.col("r.body").alias("log"),
            F.create_map(
                F.lit("sqs.event.id"), F.col("r.messageId"), F.lit("sqs.event.source"), F.col("r.eventSource")
            ).alias("meta"),
            F.coalesce(retry.try_cast("int"), F.lit(0)).alias("retry"),
        )
    )


def read_sns_messages(df: DataFrame, event: str = "event") -> DataFrame:
    """Text messages of a topic, one log each."""
    rest = [c for c in df.columns if c not in (event, "pos")]
    return _explode_records(df, event, SNS_SCHEMA).select(
        *rest, "pos", F.col("r.Sns.Message").alias("log"), F.lit(None).cast("map<string,string>").alias("meta")
    )


def read_kafka_records(df: DataFrame, event: str = "event") -> DataFrame:
    """Records of all topic partitions; values are strict base64 or plain text.

    Null values are dropped; a value that is not UTF-8 keeps its row with ``log`` NULL
    and ``error`` set.
    """
    rest = [c for c in df.columns if c not in (event, "pos")]
    records = F.flatten(F.map_values(F.from_json(F.col(event), KAFKA_SCHEMA).getField("records")))
    df = unfold(df, rest, records, "r").filter(F.col("r.value").isNotNull())
    return kafka_values(
        df.select(*rest, "r.topic", "r.partition", F.col("r.offset").alias("pos"), "r.value")
    ).drop("topic", "value")


def kafka_values(df: DataFrame) -> DataFrame:
    """``topic``, ``value`` → ``log``, ``meta``, ``error``; ``value`` is text, or the bytes of a
    ``readStream`` row, which must be UTF-8 before they are looked at as text."""
    text = F.col("value")
    if isinstance(df.schema["value"].dataType, T.BinaryType):
        text = utf8_or_null(text)
    df = df.withColumn("log", utf8_or_null(base64_or_raw(text)))
    return df.withColumn("meta", F.create_map(F.lit("kafka.topic"), F.col("topic"))).withColumn(
        "error", F.when(F.col("log").isNull(), "not UTF-8")
    )


def read_cloudwatch(df: DataFrame, event: str = "event") -> DataFrame:
    """Subscription events: base64 gzip payload → ``payload`` struct."""
    data = F.from_json(F.col(event), "awslogs struct<data string>").getField("awslogs").getField("data")
    rest = [c for c in df.columns if c not in (event, "error")]
    # Each step is a column of its own: within one expression every use of the text would inflate it anew.
    df = df.select(*rest, data.alias("_coded")).withColumn("_raw", base64_bytes(F.col("_coded")))
    df = df.withColumn("_inflated", gunzip_or_raw(F.col("_raw"))).withColumn("_text", utf8_or_null(F.col("_inflated")))
    error = F.when(F.col("_coded").isNotNull() & F.col("_raw").isNull(), "not base64").when(
        F.col("_coded").isNotNull() & F.col("_text").isNull(), "not UTF-8")
    df = df.withColumn("_parsed", F.from_json(F.col("_text"), CLOUDWATCH_SCHEMA))
    payload = cloudwatch_payload(F.col("_text"), F.col("_parsed"))
    return df.select(*rest, payload.alias("payload"), error.alias("error"))


def select_groups(df: DataFrame, names: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """Subscriptions (rows with ``payload``) of several log groups: those named, and those whose name
    begins with one of ``prefixes``. Without either all are kept; other rows stay."""
    if not names and not prefixes:
        return df
    group = F.col("payload.logGroup")
    kept = group.isin(list(names or []))
    for prefix in prefixes or []:
        kept = kept | group.startswith(prefix)
    return df.filter(group.isNull() | kept)


def cloudwatch_payload(text: Column, payload: Column | None = None) -> Column:
    """Parsed subscription payload, NULL when the text is none."""
    payload = F.from_json(text, CLOUDWATCH_SCHEMA) if payload is None else payload
    needed = ["owner", "logGroup", "logStream", "messageType", "subscriptionFilters", "logEvents"]
    whole = payload.getField(needed[0]).isNotNull()
    for name in needed[1:]:
        whole = whole & payload.getField(name).isNotNull()
    return F.when(whole & strict_object(text), payload)


def read_kinesis_records(df: DataFrame, event: str = "event") -> DataFrame:
    """Stream records: inflated or raw, as ``text`` and, where it is one, ``payload``.

    ``text`` is NULL for data that is not UTF-8; such records, and empty ones, give no logs.
    """
    rest = [c for c in df.columns if c not in (event, "pos")]
    df = _explode_records(df, event, KINESIS_SCHEMA)
    df = df.select(
        *rest,
        "pos",
        F.create_map(
            *[x for name, field in KINESIS_META.items() for x in (F.lit(name), F.col(f"r.{field}"))]
        ).alias("meta"),
        F.col("r.kinesis.data").alias("_text"),
        base64_bytes(F.col("r.kinesis.data")).alias("_data"),
    )
    df = df.withColumn("text", utf8_or_null(gunzip_or_raw(F.col("_data"))))
    error = F.when(F.col("_text").isNotNull() & F.col("_data").isNull(), "not base64").when(
        F.col("_data").isNotNull() & F.col("text").isNull(), "not UTF-8")
    df = df.withColumn("error", error).drop("_data", "_text")
    return df.withColumn("payload", cloudwatch_payload(F.col("text")))


def read_scan_events(df: DataFrame, findings: DataFrame, event: str = "event") -> DataFrame:
    """Image-scan events joined to ``findings(repository, image_digest, findings,
    severity_counts)``, ready for ``frame_scan_findings``; ``error`` where there are none."""
    rest = [c for c in df.columns if c != event]
    parsed = F.from_json(F.col(event), SCAN_SCHEMA)
    detail = parsed.getField("detail")
    df = df.select(
        *rest,
        F.coalesce(detail.getField("repository-name"), F.lit("")).alias("repository"),
        F.coalesce(detail.getField("image-digest"), F.lit("")).alias("image_digest"),
        detail.getField("image-tags").alias("image_tags"),
        F.create_map(
            F.lit("ecr.scan.id"), parsed.getField("id"), F.lit("ecr.scan.source"), parsed.getField("source")
        ).alias("meta"),
    )
    df = join_on(df, findings, ["repository", "image_digest"], "left")
    return df.withColumn("error", F.when(F.col("findings").isNull(), "no scan findings"))


def read_delivery_records(df: DataFrame, event: str = "event") -> DataFrame:
    """Delivery-stream events → ``record_id`` (position), ``record``, ``data`` bytes, for
    ``split_messages``; ``data`` is NULL where it is not base64, which the splitter reports."""
    rest = [c for c in df.columns if c != event]
    records = F.from_json(F.col(event), FIREHOSE_SCHEMA).getField("records")
    df = unfold(df, rest, records, "_r", "record_id")
    return df.select(*rest, "record_id", F.col("_r.recordId").alias("record"), base64_bytes(F.col("_r.data")).alias("data"))


# Metadata keys of stream records.
KINESIS_META = {
    "kinesis.event.id": "eventID",
    "kinesis.event.name": "eventName",
    "kinesis.event.source": "eventSource",
    "kinesis.event.source_arn": "eventSourceARN",
}
