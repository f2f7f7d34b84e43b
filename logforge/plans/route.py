"""Events of all kinds in one table: each kind to its framer, all that cannot be shipped to quarantine."""

from __future__ import annotations

from collections.abc import Callable
from typing import BinaryIO

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.naming import NO_APPLICATION, NO_SUBSYSTEM, java_pattern
from logforge.functions.text import (
    base64_bytes,
    base64_or_raw,
    gunzip_or_raw,
    not_blank,
    object_key,
    utf8_or_null,
    with_json,
)
from logforge.operators import framing
from logforge.operators.batching import pack_batches, pack_in_order
from logforge.operators.body import build_body, name_records
from logforge.operators.filters import drop_blank
from logforge.operators.joins import join_on
from logforge.operators.rows import unfold
from logforge.operators.transform import transform_records
from logforge.plans.config import OBJECT_SOURCES, LogConfig
from logforge.plans.ship import frame_object_lines
from logforge.session import staged
from logforge.sources import events as src
from logforge.sources.objects import NOTIFICATION_SCHEMA, object_meta
from logforge.sources.paths import object_address, open_path, read_paths

#: What an event holds: some text in a coding, an object's place, or a scanned image.
ITEM = {
    "record": "bigint", "value": "string", "coding": "string", "meta": "map<string,string>",
    "bucket": "string", "key": "string", "repository": "string", "image_digest": "string",
    "image_tags": "array<string>", "error": "string"}
#: Salts that keep rows without an image apart in the join to findings.
SALTS = 1 << 10


def item(**given: Column) -> Column:
    """One item; what is not given is NULL."""
    return F.struct(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in ITEM.items()])


def event_items(event: Column, kind: Column, texts: bool) -> Column:
    """The items of an event by its kind; ``texts`` says that queue messages are logs themselves."""

    def records(schema: str) -> Column:
        return F.from_json(event, schema).getField("Records")

    def each(rows: Column, build: Callable[[Column, Column], Column]) -> Column:
        return F.transform(rows, build)

    def failed(error: str) -> Column:
        return F.array(item(record=F.lit(0), error=F.lit(error)))

    notices = each(records(NOTIFICATION_SCHEMA), lambda r, i: item(
        record=i, bucket=r["s3"]["bucket"]["name"], key=object_key(r["s3"]["object"]["key"]),
        meta=object_meta(r["s3"]["bucket"]["name"], object_key(r["s3"]["object"]["key"]))))
    topics = each(records(src.SNS_SCHEMA), lambda r, i: item(record=i, value=r["Sns"]["Message"], coding=F.lit("text")))
    queued = each(records(src.SQS_SCHEMA), lambda r, i: item(
        record=i, value=r["body"], coding=F.lit("text"),
        meta=F.create_map(F.lit("sqs.event.id"), r["messageId"], F.lit("sqs.event.source"), r["eventSource"])))
    stream = each(records(src.KINESIS_SCHEMA), lambda r, i: item(
        record=i, value=r["kinesis"]["data"], coding=F.lit("packed"),
        meta=F.create_map(*[x for n, field in src.KINESIS_META.items() for x in (F.lit(n), r[field])])))
    data = F.from_json(event, "awslogs struct<data string>").getField("awslogs").getField("data")
    topic_rows = F.flatten(F.map_values(F.from_json(event, src.KAFKA_SCHEMA).getField("records")))
    topic_rows = each(topic_rows, lambda r, i: item(
        record=i, value=r["value"], coding=F.lit("either"), meta=F.create_map(F.lit("kafka.topic"), r["topic"])))
    scan = F.from_json(event, src.SCAN_SCHEMA)
    detail = scan.getField("detail")
    image = F.array(item(
        record=F.lit(0), coding=F.lit("scan"), repository=F.coalesce(detail.getField("repository-name"), F.lit("")),
        image_digest=F.coalesce(detail.getField("image-digest"), F.lit("")), image_tags=detail.getField("image-tags"),
        meta=F.create_map(F.lit("ecr.scan.id"), scan.getField("id"), F.lit("ecr.scan.source"), scan.getField("source"))))
    out = (
        F.when(kind == "S3", notices).when(kind == "Sns", topics).when(kind == "Kinesis", stream)
        .when(kind == "CloudWatch", F.array(item(record=F.lit(0), value=data, coding=F.lit("packed"))))
        .when(kind == "Kafka", topic_rows).when(kind == "EcrScan", image)
        .when(kind == "Firehose", failed("delivery-stream events carry no logs")))
    nested = queued if texts else F.filter(queued, lambda r: r["value"].isNull())
    out = out.when(kind == "Sqs", nested)
    return out.otherwise(failed("unsupported event"))


def route_events(
    df: DataFrame, cfg: LogConfig, findings: DataFrame | None = None, event: str = "event", depth: int = 3
) -> DataFrame:
    """Events (JSON text) → rows ``event_kind, record, pos, log, meta, bucket, key, error``.

    One pass over the table, whatever kinds it mixes: an event is classified, unwrapped, cut into
    its items, decoded and framed in its own task; only ``findings``, if there are any, are joined
    to scans before. The rows of an event lie together, in order. A row is a log; or an object to be read (``bucket``, ``key``, no ``log``); or, with
    ``error``, something for the quarantine: unknown events and delivery-stream ones, texts that
    are not base64 or not UTF-8, subscriptions without a payload, scans without findings, envelopes
    deeper than ``depth``. Queue messages are logs if ``cfg.integration`` is ``Sqs``, else
    envelopes. The stream filter, blocking and sampling apply as in ``frame_source``.
    """
    texts = cfg.integration == "Sqs"
    df = df.drop("event_kind", "record", "pos", "log", "meta", "bucket", "key", "error")
    df = src.classify_events(df, event) if texts else src._unwrap_levels(df, event, depth)
    rest = [c for c in df.columns if c not in (event, "event_kind")]
    scans = ["findings", "severity_counts"] if findings is not None else []
    if findings is not None:
        df = _join_findings(df.drop(*scans), findings, event)
        rest = [c for c in rest if c not in scans]
    kind = F.col("event_kind")
    deep = (kind == "Sqs") | ((kind == "Sns") & src._notices(event))
    items = event_items(F.col(event), kind, texts)
    if not texts:
        items = F.when(deep & ~src._text_messages(event), F.array(
            item(record=F.lit(0), error=F.lit("nested too deep")))).otherwise(items)
    df = unfold(df, [*rest, *scans, "event_kind"], items, "_item").drop("_pos")
    # Messages without text are no records.
    missing = F.col("coding").isin("text", "either") & F.col("value").isNull()
    df = df.select(*rest, *scans, "event_kind", "_item.*").filter(~F.coalesce(missing, F.lit(False)))
    packed = F.col("coding") == "packed"
    df = df.withColumn("_data", F.when(packed, base64_bytes(F.col("value"))).when(
        F.col("coding") == "either", base64_or_raw(F.col("value"))))
    df = df.withColumn("_content", gunzip_or_raw(F.when(packed, F.col("_data"))))
    df = df.withColumn("_text", utf8_or_null(F.coalesce(F.col("_content"), F.col("_data"))))
    payload = F.when(packed, src.cloudwatch_payload(F.col("_text")))
    df = df.withColumn("payload", payload)
    error = F.coalesce(
        F.col("error"),
        F.when(F.col("value").isNotNull() & packed & F.col("_data").isNull(), "not base64"),
        F.when(F.col("_data").isNotNull() & F.col("_text").isNull(), "not UTF-8"),
        F.when((kind == "CloudWatch") & F.col("payload").isNull(), "no subscription payload"))
    df = df.withColumn("error", error)
    stream = F.col("payload.logStream")
    if cfg.stream_filter.strip():
        kept = stream.rlike(java_pattern(cfg.stream_filter))
        df = df.filter(F.col("payload").isNull() | kept)
    names = F.create_map(
        F.lit("cw.log.group"), F.col("payload.logGroup"), F.lit("cw.log.stream"), stream,
        F.lit("cw.owner"), F.col("payload.owner"))
    none = F.create_map().cast("map<string,string>")
    meta = F.when(F.col("payload").isNotNull(), F.map_concat(F.coalesce("meta", none), names)).otherwise(F.col("meta"))
    df = df.withColumn("meta", meta).withColumn("records", F.col("payload.logEvents.message"))
    subscribed = framing.kept_records(cfg.block, cfg.sample)
    single = F.coalesce(F.col("_text"), F.when(F.col("coding") == "text", F.col("value")))
    blank = (F.col("coding") == "packed") & (single == "")
    df = df.withColumn("records", F.when(F.col("payload").isNotNull(), subscribed).when(
        single.isNotNull() & ~blank, F.array(single)))
    df = df.drop("payload", "value", "_data", "_content", "_text")
    df = _scan_records(df, findings is not None)
    keep = F.col("error").isNotNull() | (kind == "S3")
    rows = F.when(keep, F.array(F.lit(None).cast("string"))).otherwise(F.col("records"))
    out = [*rest, "event_kind", "record", "meta", "bucket", "key", "error"]
    return unfold(df, out, rows, "log", "pos").select(*rest, "event_kind", "record", "pos", "log", "meta", "bucket", "key", "error")


def _join_findings(df: DataFrame, findings: DataFrame, event: str) -> DataFrame:
    """Scan events with ``findings`` and ``severity_counts`` of their image, other events with NULL.

    Events are joined while they are one row each, so what they hold stays together.
    """
    detail = F.from_json(F.col(event), src.SCAN_SCHEMA).getField("detail")
    scan = F.col("event_kind") == "EcrScan"
    # Events that are no scans meet nothing; salted, they do not gather in one partition.
    salt = F.concat(F.lit("\u0000"), (F.monotonically_increasing_id() % SALTS).cast("string"))
    repository = F.when(scan, F.coalesce(detail.getField("repository-name"), F.lit(""))).otherwise(salt)
    df = df.withColumns({
        "_repository": repository, "_digest": F.when(scan, F.coalesce(detail.getField("image-digest"), F.lit("")))})
    found = findings.select(
        F.col("repository").alias("_repository"), F.col("image_digest").alias("_digest"), "findings", "severity_counts")
    return join_on(df, found, ["_repository", "_digest"], "left").drop("_repository", "_digest")


def _scan_records(df: DataFrame, joined: bool) -> DataFrame:
    """``records`` and ``error`` of scans."""
    scan = F.coalesce(F.col("coding") == "scan", F.lit(False))
    if not joined:
        df = df.withColumn("error", F.when(scan, "no scan findings").otherwise(F.col("error")))
        return df.drop("coding", "repository", "image_digest", "image_tags")
    names = ("repository", "image_digest", "image_tags", "findings", "severity_counts", "coding", "records")
    columns = [c for c in df.columns if c not in names]
    missing = scan & F.col("findings").isNull()
    df = df.withColumn("error", F.when(missing, "no scan findings").otherwise(F.col("error")))
    df = framing.frame_scan_findings(df.withColumn("_scan", scan).withColumnRenamed("records", "_records"))
    return df.select(*columns, F.when(F.col("_scan"), F.col("records")).otherwise(F.col("_records")).alias("records"))


def ship_events(
    df: DataFrame,
    cfg: LogConfig,
    findings: DataFrame | None = None,
    event: str = "event",
    address: str = "s3a://{bucket}/{key}",
    opener: Callable[[str], BinaryIO] = open_path,
) -> DataFrame:
    """Mixed events (``unit`` and their JSON text) → packed, named logs, and the quarantine.

    As ``ship_logs`` for every kind at once; objects that notifications name are read by the
    tasks (``address``: where they lie) and framed by ``cfg.integration``. Rows with ``error``
    are the quarantine: they have no ``batch_id``. A unit is an event; each object of it is one,
    too, named after the event and its address. The events are read once, and so is each object.
    """
    routed = route_events(df, cfg, findings, event)
    routed = routed.filter(F.col("log").isNull() | not_blank(F.col("log")))
    if cfg.transform is not None:
        routed = transform_records(routed, cfg.transform)
        routed = routed.filter(F.col("log").isNull() | not_blank(F.col("log")))
    # An event is packed where it was unfolded.
    routed = pack_in_order(
        routed.withColumn("log_bytes", F.octet_length("log")), "unit", "log_bytes", cfg.batch_target, cfg.record_overhead)
    routed = staged(routed, "routed")
    logs = routed.filter("log is not null")
    failed = [routed.filter("error is not null")]
    made = ("log_bytes", "batch_id", "transform_seq", "transform_error")
    objects = routed.filter("event_kind = 'S3' and error is null").drop("log", "pos", "error", *made)
    if cfg.integration not in OBJECT_SOURCES:
        failed.append(objects.withColumn("error", F.lit(f"objects do not match integration {cfg.integration}")))
        named = _named(logs, cfg)
    else:
        path = object_address(F.col("bucket"), F.col("key"), address)
        unit = F.concat_ws("#", F.col("unit").cast("string"), F.col("record").cast("string"), path)
        # A JSON array has no lines: then the whole text is one.
        separator = "\0" if cfg.integration == "CloudTrail" else "\n"
        lines = read_paths(
            objects.withColumns({"path": path, "unit": unit}), compression=cfg.compression, separator=separator, opener=opener)
        lines = staged(lines.drop("path"), "lines")
        failed.append(lines.filter("error is not null").drop("block", "seq", "log"))
        good = lines.filter("error is null").drop("error")
        if separator == "\0":
            framed = framing.frame_json_array(good.drop("block", "seq").withColumnRenamed("log", "text"))
            framed = framing.explode_records(framed.drop("text"), cfg.block, cfg.sample).withColumn("block", F.lit(0))
        else:
            framed = frame_object_lines(good, cfg)
        framed = _packed(framed, cfg, "block").drop("block")
        logs = logs.withColumn("unit", F.col("unit").cast("string"))
        named = _named(logs.unionByName(framed, allowMissingColumns=True), cfg)
    for rows in failed:
        named = named.unionByName(rows.withColumn("unit", F.col("unit").cast("string")), allowMissingColumns=True)
    return named


def _packed(df: DataFrame, cfg: LogConfig, chunk: str) -> DataFrame:
    """Records of objects, packed in order."""
    df, order = drop_blank(df), ["pos"]
    if cfg.transform is not None:
        df = staged(drop_blank(transform_records(df, cfg.transform)), "transformed")
        order = [*order, "transform_seq"]
    df = df.withColumn("log_bytes", F.octet_length("log"))
    return pack_batches(df, ["unit"], order, "log_bytes", cfg.batch_target, cfg.record_overhead, chunk=chunk)


def _named(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Names by the kind of each row, severity and body."""
    bucket = F.when(F.col("event_kind") == "S3", F.try_element_at("meta", F.lit("s3.bucket")))
    group = F.when(F.col("event_kind") == "CloudWatch", F.try_element_at("meta", F.lit("cw.log.group")))
    application: str | Column = cfg.application if cfg.application is not None else F.coalesce(bucket, F.lit(NO_APPLICATION))
    subsystem: str | Column = cfg.subsystem if cfg.subsystem else F.coalesce(
        group, bucket if cfg.subsystem is None else F.lit(cfg.subsystem), F.lit(NO_SUBSYSTEM))
    df = name_records(with_json(df), application, subsystem, cfg.detect_severity)
    df = build_body(df, cfg.add_metadata, cfg.labels).drop("_json")
    return df if "ts" in df.columns else df.withColumn("ts", F.current_timestamp())
