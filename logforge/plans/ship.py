"""Pipelines: from framed sources to batched, export-ready tables."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.naming import NO_APPLICATION, NO_SUBSYSTEM, java_pattern
from logforge.functions.text import with_json
from logforge.operators import framing
from logforge.operators.association import associate_tags, require_inventory, with_sets
from logforge.operators.batching import pack_batches, pack_objects, single_batches
from logforge.operators.body import build_body, name_records
from logforge.operators.filters import block_pattern, drop_blank, stride_sample
from logforge.operators.lines import delimited_lines, multiline_records
from logforge.operators.lookup import join_group_tags
from logforge.operators.metrics import (
    decode_metrics,
    encode_metrics,
    explode_points,
    finish_points,
    flatten_points,
    merge_payloads,
    metric_identity,
    rebuild_payload,
    split_messages,
)
from logforge.operators.transform import transform_records
from logforge.plans.config import OBJECT_SOURCES, LogConfig, MetricConfig
from logforge.session import staged
from logforge.sources.objects import object_meta, split_path


def frame_source(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Rows of a source → ``unit, (record,) pos, log, meta``.

    Objects come with ``unit, text, meta``; subscriptions with ``payload``; stream records
    with ``text`` and ``payload``; queue, topic and Kafka messages with ``log`` already.
    Blocking and sampling apply to objects, their lines and subscriptions only. Lines of
    objects read one by one (``read_lines``: ``unit, block, seq, log``) are records already.
    Rows without the columns of the configured integration give nothing but a warning here;
    ``failed_rows`` reports each of them.
    """
    kind = cfg.integration
    # Rows with an error have no text, and so no records; ``failed_rows`` tells of them.
    df = df.drop("error")
    if kind in OBJECT_SOURCES and _are_lines(df):
        return frame_object_lines(df, cfg)
    for name in _needed(kind):
        if name not in df.columns:
            warnings.warn(f"rows do not match integration {kind}: no column {name!r}", stacklevel=2)
            empty = df.filter(F.lit(False))
            return empty.select("unit", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("pos", "bigint"), ("log", "string"), ("meta", "map<string,string>"))])
    if kind in OBJECT_SOURCES:
        return framing.explode_records(frame_objects(df, cfg), cfg.block, cfg.sample)
    if kind == "CloudWatch":
        df = framing.frame_cloudwatch(df, cfg.stream_filter)
        return framing.explode_records(df, cfg.block, cfg.sample)
    if kind == "EcrScan":
        return framing.explode_records(framing.frame_scan_findings(df))
    if kind == "Kinesis":
        return frame_stream_records(df, cfg)
    return df


def _needed(kind: str) -> list[str]:
    need = {"CloudWatch": ["payload"], "Kinesis": ["text", "payload"], "EcrScan": ["findings"]}
    return need.get(kind, ["text"] if kind in OBJECT_SOURCES else ["log"])


def _are_lines(df: DataFrame) -> bool:
    return "text" not in df.columns and {"log", "block", "seq"} <= set(df.columns)


def frame_object_lines(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Lines of objects (``read_lines``, ``read_paths``), framed, blocked and sampled as whole objects
    are; ``seq`` becomes ``pos``."""
    if cfg.integration == "CloudTrail":
        raise ValueError("a JSON array has no lines; give whole objects")
    df = df.filter(F.col("log").isNotNull())
    if "meta" not in df.columns:
        df = df.withColumn("meta", object_meta(*split_path(F.col("unit"))))
    if cfg.integration != "S3":
        delimiter = {"CloudFront": "\t", "VpcFlow": " "}.get(cfg.integration, cfg.delimiter)
        spaces = r"\s+" if cfg.integration == "VpcFlow" else None
        header = None if cfg.integration == "VpcFlow" else cfg.header or None
        df = delimited_lines(df, delimiter, header, spaces)
    elif cfg.newline_pattern != LogConfig.newline_pattern:
        df = multiline_records(df, cfg.newline_pattern)
    if cfg.block:
        df = block_pattern(df, cfg.block)
    if cfg.sample > 1:
        df = stride_sample(df, cfg.sample, ["unit"], ["seq"], chunk="block")
    return df.withColumnRenamed("seq", "pos")


def failed_rows(df: DataFrame, cfg: LogConfig | None = None) -> DataFrame:
    """``unit, error`` of the rows of a source that cannot be shipped: undecodable objects and
    payloads, events of no known kind, and, given ``cfg``, all rows if they do not match its
    integration. Route them with ``route_failures`` beside ``ship_logs``."""
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    if "event_kind" in df.columns:
        error = F.coalesce(error, F.when(F.col("event_kind") == "unsupported", "unsupported event"))
    if cfg is not None and not (cfg.integration in OBJECT_SOURCES and _are_lines(df)):
        missing = [name for name in _needed(cfg.integration) if name not in df.columns]
        if missing:
            error = F.coalesce(error, F.lit(f"rows do not match integration {cfg.integration}: no {missing[0]}"))
    return df.select("unit", error.alias("error")).filter(F.col("error").isNotNull())


def frame_objects(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Whole objects → their ``records``, one row per object."""
    if cfg.integration == "S3":
        df = framing.frame_lines(df, cfg.newline_pattern)
    elif cfg.integration == "S3Csv":
        df = framing.frame_delimited(df, cfg.delimiter, cfg.header or None)
    elif cfg.integration == "CloudFront":
        df = framing.frame_delimited(df, "\t", cfg.header or None)
    elif cfg.integration == "VpcFlow":
        df = framing.frame_vpc_flow(df)
    else:
        df = framing.frame_json_array(df)
    return df.drop("text", "error")


def frame_stream_records(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Stream records: subscription payloads are unfolded, other text is one log."""
    payload = F.col("payload")
    if cfg.stream_filter.strip():
        kept = F.col("payload.logStream").rlike(java_pattern(cfg.stream_filter))
        df = df.filter(payload.isNull() | kept)
    names = F.create_map(
        F.lit("cw.log.group"), F.col("payload.logGroup"),
        F.lit("cw.log.stream"), F.col("payload.logStream"),
        F.lit("cw.owner"), F.col("payload.owner"),
    )
    messages = F.col("payload.logEvents.message")
    if cfg.block:
        messages = F.filter(messages, lambda m: ~m.rlike(java_pattern(cfg.block)))
    if cfg.sample > 1:
        messages = F.filter(messages, lambda m, i: i % cfg.sample == 0)
    df = df.withColumns({
        "meta": F.when(payload.isNotNull(), F.map_concat("meta", names)).otherwise(F.col("meta")),
        "records": F.when(payload.isNotNull(), messages).when(F.col("text") != "", F.array("text")),
    })
    return framing.explode_records(df.drop("text", "payload"))


def _source_names(cfg: LogConfig) -> tuple[str | Column, str | Column]:
    application: str | Column | None = cfg.application
    subsystem: str | Column | None = cfg.subsystem
    if cfg.integration in OBJECT_SOURCES:
        bucket = F.try_element_at("meta", F.lit("s3.bucket"))
        application = bucket if application is None else application
        subsystem = bucket if subsystem is None else subsystem
    if cfg.integration == "CloudWatch" and not subsystem:
        subsystem = F.try_element_at("meta", F.lit("cw.log.group"))
    return (
        NO_APPLICATION if application is None else application,
        NO_SUBSYSTEM if subsystem is None else subsystem,
    )


def project_logs(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Names, severity and body of framed records."""
    application, subsystem = _source_names(cfg)
    df = with_json(df)
    df = name_records(df, application, subsystem, cfg.detect_severity)
    return build_body(df, cfg.add_metadata, cfg.labels).drop("_json")


def ship_logs(df: DataFrame, cfg: LogConfig, group_tags: DataFrame | None = None) -> DataFrame:
    """Source rows → ``unit, batch_id, …, application, subsystem, severity, body, ts``.

    Frame, block, sample, drop blanks, transform, drop blanks, pack per unit, project.
    ``ts`` is the processing time unless the source brings its own.
    """
    in_place = cfg.transform is None and (
        cfg.integration in OBJECT_SOURCES and "text" in df.columns
        or cfg.integration == "CloudWatch" and "payload" in df.columns and "pos" not in df.columns)
    if in_place:
        # An object, or a subscription, is one row until it is unfolded: it is packed there, without
        # a shuffle.
        if cfg.integration == "CloudWatch":
            df = framing.frame_cloudwatch(df.drop("error"), cfg.stream_filter)
        else:
            df = frame_objects(df, cfg)
        df = pack_objects(df, cfg.block, cfg.sample, cfg.batch_target, cfg.record_overhead)
    else:
        lines = cfg.integration in OBJECT_SOURCES and _are_lines(df)
        df = drop_blank(frame_source(df, cfg))
        order = [c for c in ("record", "pos") if c in df.columns]
        if not order:
            raise ValueError("rows have neither record nor pos to be packed in order by")
        if cfg.transform is not None:
            df = drop_blank(transform_records(df, cfg.transform))
            order.append("transform_seq")
            df = staged(df, "transformed")
        df = df.withColumn("log_bytes", F.octet_length("log"))
        chunk = "block" if lines else None
        df = pack_batches(df, ["unit"], order, "log_bytes", cfg.batch_target, cfg.record_overhead, chunk=chunk)
    if group_tags is not None:
        df = df.withColumn("_log_group", F.try_element_at("meta", F.lit("cw.log.group")))
        df = join_group_tags(df, group_tags, group="_log_group").drop("_log_group")
    df = project_logs(df, cfg)
    return df if "ts" in df.columns else df.withColumn("ts", F.current_timestamp())


#: Bytes of messages that an Arrow batch may come from, and the rows it has at least and at most.
TOGETHER, LEAST_ROWS, MOST_ROWS = 1 << 27, 16, 4096


def identified_points(
    df: DataFrame, cfg: MetricConfig, index: DataFrame | None = None, registry: DataFrame | None = None
) -> DataFrame:
    """Points with flattened dimensions and, where there is an index, what tags are found by."""
    df = flatten_points(df)
    if index is None:
        return df
    return with_sets(require_inventory(metric_identity(df), index, registry, cfg.on_missing_inventory))


def enrich_points(
    df: DataFrame, cfg: MetricConfig, index: DataFrame | None = None, registry: DataFrame | None = None
) -> DataFrame:
    """Identified points, written out as association reads them twice → resource tags, labels, names."""
    if index is not None:
        df = associate_tags(df, index, registry).drop("dims", "namespace", "metric_name", "arn")
    return finish_points(df, cfg.application, cfg.subsystem, cfg.labels).drop("tags")


def ship_metrics(
    df: DataFrame,
    cfg: MetricConfig,
    index: DataFrame | None = None,
    registry: DataFrame | None = None,
    unit: list[str] | None = None,
) -> DataFrame:
    """Binary records ``(unit…, record_id BIGINT, data)`` → requests per batch:
    ``resource_metrics``, ``message`` (bytes). Malformed records stop the job, as their
    unit must not be sent in part."""
    if not unit:
        # No global unit, which would be one long sequence: each record is its own.
        unit = ["unit"]
        df = df.withColumn("unit", F.col("record_id").cast("string"))
    messages = split_messages(df).withColumn("_size", F.octet_length("message"))
    points = explode_points(decode_metrics(messages))
    # The test is part of a key: a filter would be pushed below the decoding, which would then take place twice.
    stop = F.raise_error(F.concat(F.lit("bad metrics record: "), F.col("error"))).cast("int")
    points = points.withColumn("msg_idx", F.when(F.col("error").isNotNull(), stop).otherwise(F.col("msg_idx")))
    # Decoded once: association reads the points twice.
    points = staged(identified_points(points.drop("error"), cfg, index, registry), "points")
    largest = points.agg(F.max("_size")).first()[0] or 1
    keys, order = [*unit, "record_id", "msg_idx"], ["record_id", "msg_idx"]
    messages = rebuild_payload(enrich_points(points, cfg, index, registry), keys, together=True)
    messages = encode_metrics(messages, together=True).select(*keys, "message")
    rows = min(max(TOGETHER // largest, LEAST_ROWS), MOST_ROWS)
    messages = staged(messages.withColumn("bytes", F.octet_length("message")), "messages", rows)
    if cfg.batching:
        batched = pack_batches(messages, unit, order, "bytes", cfg.batch_target, overhead=0)
    else:
        batched = single_batches(messages, unit, order)
    return merge_payloads(batched, [*unit, "batch_id"], order, "message")
