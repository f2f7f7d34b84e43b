"""Names, severity and the JSON body of each record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.naming import (
    UNKNOWN_APPLICATION,
    UNKNOWN_SUBSYSTEM,
    resolve_name,
    severity,
)
from logforge.functions.text import json_quote, with_json

# Metadata keys that may be copied into the body, and older names for some.
METADATA_KEYS = [
    "s3.object.key", "s3.bucket",
    "cw.log.group", "cw.log.stream", "cw.owner",
    "kinesis.event.id", "kinesis.event.name", "kinesis.event.source", "kinesis.event.source_arn",
    "kafka.topic",
    "ecr.scan.id", "ecr.scan.source",
    "sqs.event.source", "sqs.event.id",
]
METADATA_ALIASES = {
    "stream_name": "cw.log.stream",
    "loggroup_name": "cw.log.group",
    "bucket_name": "s3.bucket",
    "key_name": "s3.object.key",
    "topic_name": "kafka.topic",
}
TAGS = "cw.tags"


def _selected(add_metadata: list[str]) -> dict[str, str]:
    known = {key: key for key in METADATA_KEYS} | METADATA_ALIASES
    return {key: known[key] for key in dict.fromkeys(add_metadata) if key in known}


def build_body(
    df: DataFrame,
    add_metadata: list[str] | None = None,
    labels: dict[str, str] | None = None,
    log: str = "log",
    meta: str = "meta",
    out: str = "body",
) -> DataFrame:
    """JSON text of the exported body.

    With selected metadata or labels: ``{"message": …, key: value, …}`` and the group tags
    if any. Otherwise tags go to ``{"text": …}`` for text, into an object, or beside
    ``message`` for other JSON. Without all of these the value itself. JSON records are
    spliced in as they are, so numbers keep their exact text.
    """
    fresh = "_json" not in df.columns
    if fresh:
        df = with_json(df, log)
    labels = dict(labels or {})
    meta_col = F.col(meta)
    text = F.col(log)
    is_json = F.col("_json").isNotNull()
    value = F.when(is_json, text).otherwise(json_quote(text))

    chosen = {k: v for k, v in _selected(add_metadata or []).items() if k not in labels}
    selected = [F.try_element_at(meta_col, F.lit(source)) for source in _selected(add_metadata or []).values()]
    has_meta = F.lit(bool(labels))
    for item in selected:
        has_meta = has_meta | item.isNotNull()

    # The group tags of a record are JSON text in its metadata; broken text counts as none.
    tags = F.try_element_at(meta_col, F.lit(TAGS))
    tags = F.when(F.try_parse_json(tags).isNotNull(), tags)
    tags_member = F.concat(F.lit(f'"{TAGS}":'), tags)

    message = json_quote(F.lit(labels.pop("message"))) if "message" in labels else value
    fields = [F.try_element_at(meta_col, F.lit(source)).alias(key) for key, source in chosen.items()]
    fields += [F.lit(text_value).alias(key) for key, text_value in labels.items() if key != TAGS]
    extra = F.lit("")
    if fields:
        inner = F.to_json(F.struct(*fields))
        inner = F.substr(inner, F.lit(2), F.length(inner) - 2)
        extra = F.when(inner == "", "").otherwise(F.concat(F.lit(","), inner))
    own_tags = json_quote(F.lit(labels[TAGS])) if TAGS in labels else F.lit(None).cast("string")
    last = F.coalesce(tags_member, F.concat(F.lit(f'"{TAGS}":'), own_tags))
    last = F.coalesce(F.concat(F.lit(","), last), F.lit(""))
    enveloped = F.concat(F.lit('{"message":'), message, extra, last, F.lit("}"))

    kind = F.schema_of_variant(F.try_variant_get(F.col("_json"), "$[0]", "variant"))
    head = F.regexp_replace(text, r"\}\s*$", "")
    comma = F.when(head.rlike(r"^\s*\{\s*$"), "").otherwise(",")
    members = F.try_variant_get(F.col("_json"), "$[0]", "map<string,variant>")
    others = F.map_filter(members, lambda k, _: k != TAGS)
    replaced = F.to_json(F.map_concat(others, F.create_map(F.lit(TAGS), F.try_parse_json(tags))))
    tagged = (
        # An object with tags of its own gets these in their place, not a second member.
        F.when(F.map_contains_key(members, TAGS), replaced)
        .when(kind.startswith("OBJECT"), F.concat(head, comma, tags_member, F.lit("}")))
        .when(F.coalesce(kind == "STRING", F.lit(True)), F.concat(F.lit('{"text":'), value, F.lit(","), tags_member, F.lit("}")))
        .otherwise(F.concat(F.lit('{"message":'), value, F.lit(","), tags_member, F.lit("}")))
    )
    body = F.when(has_meta, enveloped).when(tags.isNotNull(), tagged).otherwise(value)
    df = df.withColumn(out, body)
    return df.drop("_json") if fresh else df


def name_records(
    df: DataFrame,
    application: str | Column,
    subsystem: str | Column,
    detect_severity: bool = True,
    log: str = "log",
    meta: str = "meta",
) -> DataFrame:
    """Add ``application``, ``subsystem``, ``severity``. A name is a configured text (see
    ``resolve_name``) or a column, such as the bucket, that is used as it stands."""
    fresh = "_json" not in df.columns
    if fresh:
        df = with_json(df, log)

    def named(name: str | Column, unknown: str) -> Column:
        if isinstance(name, Column):
            return name
        return resolve_name(name, unknown, F.col(log), F.col("_json"), F.col(meta))

    df = df.withColumns({
        "application": named(application, UNKNOWN_APPLICATION),
        "subsystem": named(subsystem, UNKNOWN_SUBSYSTEM),
        "severity": severity(F.col(log), detect_severity),
    })
    return df.drop("_json") if fresh else df
