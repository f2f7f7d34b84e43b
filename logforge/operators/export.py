"""Export payloads: per-batch JSON requests, batch statistics, delivery outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.naming import severity_number
from logforge.functions.otlp import to_any_value
from logforge.functions.text import json_quote

# Resource attribute names.
APPLICATION_KEY = "cx.application.name"
SUBSYSTEM_KEY = "cx.subsystem.name"


def _ordered_texts(df: DataFrame, by: list[str], order: list[str], text: Column, out: str) -> DataFrame:
    """Texts of a group joined by commas, in order. Groups lie inside a size-bounded batch."""
    held = F.struct(F.struct(*order).alias("at"), text.alias("text"))
    rows = F.sort_array(F.collect_list(held))
    return df.groupBy(*by).agg(F.array_join(F.transform(rows, lambda r: r["text"]), ",").alias(out), F.count(F.lit(1)).alias("_n"))


def to_singles(df: DataFrame, batch: list[str], order: list[str], ts: str = "ts") -> DataFrame:
    """One flat request per batch: ``payload``, ``records``."""
    entry = F.concat(
        F.lit('{"applicationName":'), json_quote(F.col("application")),
        F.lit(',"subsystemName":'), json_quote(F.col("subsystem")),
        F.lit(',"computerName":null,"severity":"'), F.col("severity"),
        F.lit('","body":'), F.col("body"),
        F.lit(',"timestamp":'), F.unix_millis(F.col(ts)).cast("string"),
        F.lit(',"className":null,"methodName":null,"threadId":null,"category":null}'),
    )
    df = _ordered_texts(df, batch, order, entry, "_entries")
    payload = F.concat(F.lit('{"entries":['), F.col("_entries"), F.lit("]}"))
    return df.select(*batch, payload.alias("payload"), F.col("_n").alias("records"))


def otlp_record(ts: str = "ts", record_attributes: dict[str, str] | None = None) -> Column:
    """JSON text of one OTLP log record; both times are the given one, in nanoseconds."""
    nanos = (F.unix_micros(F.col(ts)) * 1000).cast("string")
    attributes = F.lit("")
    if record_attributes:
        pairs = [
            F.concat(F.lit('{"key":'), json_quote(F.lit(k)), F.lit(',"value":{"stringValue":'), json_quote(F.lit(v)), F.lit("}}"))
            for k, v in record_attributes.items()
        ]
        attributes = F.concat(F.lit(',"attributes":['), F.concat_ws(",", *pairs), F.lit("]"))
    return F.concat(
        F.lit('{"timeUnixNano":"'), nanos, F.lit('","observedTimeUnixNano":"'), nanos,
        F.lit('","severityNumber":'), severity_number(F.col("severity")).cast("string"),
        F.lit(',"severityText":"'), F.col("severity"),
        F.lit('","body":'), to_any_value(F.col("body")),
        attributes,
        F.lit("}"),
    )


def group_resources(
    df: DataFrame,
    batch: list[str],
    order: list[str],
    ts: str = "ts",
    record_attributes: dict[str, str] | None = None,
) -> DataFrame:
    """Per batch and (application, subsystem): ``resource_logs`` JSON, ``records``.

    Records keep their order. Rows are moved by batch, once; ``to_resource_logs`` regroups
    them where they are.
    """
    df = df.withColumn("_record", otlp_record(ts, record_attributes)).repartition(*batch)
    by = [*batch, "application", "subsystem"]
    df = _ordered_texts(df, by, order, F.col("_record"), "_records")

    def pair(key: str, value: str) -> Column:
        return F.concat(F.lit(f'{{"key":"{key}","value":{{"stringValue":'), json_quote(F.col(value)), F.lit("}}"))

    text = F.concat(
        F.lit('{"resource":{"attributes":['), pair(APPLICATION_KEY, "application"), F.lit(","),
        pair(SUBSYSTEM_KEY, "subsystem"), F.lit(']},"scopeLogs":[{"scope":{"name":"logforge"},"logRecords":['),
        F.col("_records"), F.lit("]}]}"),
    )
    return df.select(*by, text.alias("resource_logs"), F.col("_n").alias("records"))


def to_resource_logs(
    df: DataFrame,
    batch: list[str],
    order: list[str],
    ts: str = "ts",
    record_attributes: dict[str, str] | None = None,
) -> DataFrame:
    """One grouped request per batch: ``payload``, ``resources``, ``records``; resources
    come in (application, subsystem) order."""
    groups = group_resources(df, batch, order, ts, record_attributes)
    held = F.struct("application", "subsystem", "resource_logs")
    rows = F.sort_array(F.collect_list(held))
    joined = F.array_join(F.transform(rows, lambda r: r["resource_logs"]), ",")
    payload = F.concat(F.lit('{"resourceLogs":['), joined, F.lit("]}"))
    return groups.groupBy(*batch).agg(
        payload.alias("payload"), F.count(F.lit(1)).alias("resources"), F.sum("records").alias("records")
    )


def batch_stats(df: DataFrame, batch: list[str], size: str) -> DataFrame:
    """Records and bytes of each batch."""
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col(size).cast("bigint")).alias("bytes")
    )


def unit_stats(stats: DataFrame, unit: list[str]) -> DataFrame:
    """Batches, records and the whole mean of records per batch, from ``batch_stats``."""
    return stats.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("records").alias("records"),
        F.floor(F.sum("records") / F.count(F.lit(1))).alias("mean_records"),
    )


def delivery_outcome(attempts: DataFrame, unit: list[str], batch: str = "batch_id") -> DataFrame:
    """``attempts(unit…, batch_id, attempt, status, rejected, message_present)`` → one row
    per unit: it is delivered when every batch has an attempt with status ``ok`` and no
    rejected record. A message without rejections is only a warning."""
    ok = (F.col("status") == "ok") & (F.coalesce("rejected", F.lit(0)) == 0)
    ok = F.coalesce(ok, F.lit(False))
    batches = attempts.groupBy(*unit, batch).agg(
        F.bool_or(ok).alias("ok"),
        F.bool_or(ok & F.coalesce("message_present", F.lit(False))).alias("warned"),
        F.count(F.lit(1)).alias("attempts"),
    )
    return batches.groupBy(*unit).agg(
        F.bool_and("ok").alias("delivered"),
        F.count(F.lit(1)).alias("batches"),
        F.count_if(~F.col("ok")).alias("failed_batches"),
        F.count_if("warned").alias("warnings"),
        F.sum("attempts").alias("attempts"),
    )
