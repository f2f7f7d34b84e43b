"""Metric messages, points and attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from logforge.functions import otlp

VALUE_TYPE = from_arrow_type(otlp.VALUE)
ATTRIBUTES_TYPE = from_arrow_type(otlp.ATTRIBUTES)

# Attribute keys with a meaning of their own.
DIMENSIONS = "Dimensions"
NAMESPACE = "Namespace"
METRIC_NAME = "MetricName"
APPLICATION_KEY = "cx.application.name"
SUBSYSTEM_KEY = "cx.subsystem.name"
RESERVED_PREFIX = "cx."


def split_messages(df: DataFrame, data: str = "data") -> DataFrame:
    """Binary records → one row per length-prefixed message: ``msg_idx``, ``message``.

    A record with a bad prefix keeps one row with ``error`` set and no message.
    """
    rest = [c for c in df.columns if c != data]
    df = df.withColumn("_messages", otlp.split_delimited(F.col(data)))
    df = df.withColumn("error", F.when(F.col("_messages").isNull(), "bad length-delimited data"))
    found = F.coalesce("_messages", F.array(F.lit(None).cast("binary")))
    return df.select(*rest, "error", F.posexplode(found).alias("msg_idx", "message"))


def join_messages(df: DataFrame, keys: list[str], order: str = "msg_idx", message: str = "message") -> DataFrame:
    """Inverse of ``split_messages``: records of a source are small, so groups are too."""
    rows = F.sort_array(F.collect_list(F.struct(order, message)))
    return df.groupBy(*keys).agg(rows.alias("_rows")).select(
        *keys, otlp.join_delimited(F.col(f"_rows.{message}")).alias("data")
    )


def decode_metrics(df: DataFrame, message: str = "message") -> DataFrame:
    """``message`` bytes → ``resource_metrics``; malformed messages get ``error``."""
    df = df.withColumn("resource_metrics", otlp.decode_request(F.col(message)))
    bad = F.col(message).isNotNull() & F.col("resource_metrics").isNull()
    known = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.withColumn("error", F.when(bad, "bad metrics message").otherwise(known)).drop(message)


def encode_metrics(df: DataFrame, out: str = "message", together: bool = False) -> DataFrame:
    """``resource_metrics`` → ``message`` bytes; with ``together``, those of an Arrow batch at once, for
    rows that are staged with a number of rows to a batch."""
    encode = otlp.encode_together if together else otlp.encode_request
    return df.withColumn(out, encode(F.col("resource_metrics")))


LEVELS = ["rm_idx", "sm_idx", "m_idx", "dp_idx"]


def explode_points(df: DataFrame) -> DataFrame:
    """``resource_metrics`` → one row per data point, with its position on each level.

    Levels without children keep one row with NULL positions below them.
    """
    keys = [c for c in df.columns if c != "resource_metrics"]
    df = df.select(*keys, F.posexplode_outer("resource_metrics").alias("rm_idx", "_rm"))
    df = df.select(
        *keys, "rm_idx", F.col("_rm.rest").alias("rm_rest"),
        F.posexplode_outer("_rm.scope_metrics").alias("sm_idx", "_sm"),
    )
    df = df.select(
        *keys, "rm_idx", "rm_rest", "sm_idx", F.col("_sm.rest").alias("sm_rest"),
        F.posexplode_outer("_sm.metrics").alias("m_idx", "_m"),
    )
    return df.select(
        *keys, "rm_idx", "rm_rest", "sm_idx", "sm_rest", "m_idx",
        F.col("_m.name").alias("name"), F.col("_m.unit").alias("metric_unit"), F.col("_m.kind").alias("kind"),
        F.col("_m.data_rest").alias("data_rest"), F.col("_m.rest").alias("m_rest"),
        F.posexplode_outer("_m.data_points").alias("dp_idx", "_p"),
    ).select(
        *keys, "rm_idx", "rm_rest", "sm_idx", "sm_rest", "m_idx", "name", "metric_unit", "kind", "data_rest", "m_rest",
        "dp_idx", F.col("_p.attributes").alias("attributes"), F.col("_p.count").alias("count"),
        F.col("_p.sum").alias("sum"), F.col("_p.rest").alias("dp_rest"),
    )


def rebuild_payload(df: DataFrame, keys: list[str], together: bool = False) -> DataFrame:
    """Inverse of ``explode_points``. ``keys`` name one message, which is bounded; the rows
    move once and are sorted once, and all four levels are regrouped where they are.

    With ``together``, the messages of an Arrow batch are regrouped at once, as ``encode_metrics`` has it.
    """
    if together:
        rows = F.sort_array(F.collect_list(F.struct(*[F.col(name) for name in otlp.FLAT.names])))
        df = df.repartition(*keys).sortWithinPartitions(*keys).groupBy(*keys).agg(rows.alias("_rows"))
        return df.select(*keys, otlp.regroup_together(F.col("_rows")).alias("resource_metrics"))

    def level(df: DataFrame, by: list[str], index: str, item: Column, out: str) -> DataFrame:
        held = F.struct(F.col(index).alias("at"), item.alias("item"))
        items = F.sort_array(F.collect_list(F.when(F.col(index).isNotNull(), held)))
        return df.sortWithinPartitions(*by).groupBy(*by).agg(F.transform(items, lambda r: r["item"]).alias(out))

    def struct(kind, *columns: Column) -> Column:
        return F.struct(*columns).cast(from_arrow_type(kind))

    col = F.col
    scope = [*keys, "rm_idx", "rm_rest", "sm_idx", "sm_rest"]
    metric = [*scope, "m_idx", "name", "metric_unit", "kind", "data_rest", "m_rest"]
    # Only the first of the sorts sorts anything; Spark drops the others, as each level leaves its rows in order.
    df = df.repartition(*keys)
    point = struct(
        otlp.POINT, col("attributes").alias("attributes"), col("count").alias("count"), col("sum").alias("sum"), col("dp_rest").alias("rest")
    )
    df = level(df, metric, "dp_idx", point, "data_points")
    item = struct(
        otlp.METRIC, col("name").alias("name"), col("metric_unit").alias("unit"), col("kind").alias("kind"),
        col("data_points").alias("data_points"), col("data_rest").alias("data_rest"), col("m_rest").alias("rest"),
    )
    df = level(df, scope, "m_idx", item, "metrics")
    item = struct(otlp.SCOPE, col("metrics").alias("metrics"), col("sm_rest").alias("rest"))
    df = level(df, [*keys, "rm_idx", "rm_rest"], "sm_idx", item, "scope_metrics")
    item = struct(otlp.RESOURCE, col("scope_metrics").alias("scope_metrics"), col("rm_rest").alias("rest"))
    return level(df, keys, "rm_idx", item, "resource_metrics")


def merge_payloads(df: DataFrame, batch: list[str], order: list[str], message: str | None = None) -> DataFrame:
    """One request per batch holding the resources of all its messages, in order.

    With ``message``, the column of their bytes, also the bytes of the request: those of its
    messages one after the other, as the wire format merges what is repeated. Rows that have only
    the bytes move as such, and their resources are decoded from the request's, if anybody wants them. Batches are
    bounded by ``pack_batches``. Rows that lie by batch, in order, are neither moved nor sorted.
    """
    items = {"resource_metrics": F.col("resource_metrics")} if "resource_metrics" in df.columns else {}
    if message:
        items[message] = F.col(message).cast("string")
    held = F.struct(F.struct(*order).alias("at"), *[item.alias(name) for name, item in items.items()])
    rows = F.sort_array(F.collect_list(held))
    df = df.repartition(*batch).sortWithinPartitions(*batch).groupBy(*batch).agg(rows.alias("_rows"))
    columns = {name: F.flatten(f"_rows.{name}") for name in items if name != message}
    if message:
        columns[message] = F.array_join(f"_rows.{message}", "").cast("binary")
    df = df.select(*batch, *[column.alias(name) for name, column in columns.items()])
    if "resource_metrics" in columns:
        return df
    return df.select(*batch, otlp.decode_request(F.col(message)).alias("resource_metrics"), message)


def batch_totals(df: DataFrame, keys: list[str], message: str | None = None) -> DataFrame:
    """Resources, scopes, metrics (and bytes) of each payload."""
    resources = F.col("resource_metrics")
    scopes = F.flatten(F.transform(resources, lambda r: r["scope_metrics"]))
    metrics = F.flatten(F.transform(scopes, lambda s: s["metrics"]))
    columns = [
        F.size(resources).alias("resource_metrics"),
        F.size(scopes).alias("scope_metrics"),
        F.size(metrics).alias("metrics"),
    ]
    if message:
        columns.append(F.octet_length(message).alias("bytes"))
    return df.select(*keys, *columns)


# Attributes: a list of pairs that may repeat a key, so never a map.


def attribute(key: str | Column, text: str | Column) -> Column:
    """A string attribute."""
    key = F.lit(key) if isinstance(key, str) else key
    text = F.lit(text) if isinstance(text, str) else text
    return F.struct(key.alias("key"), _value({"stringValue": text}).alias("value"))


def _value(present: dict[str, Column]) -> Column:
    """A full attribute value with some of its fields set."""
    return F.struct(*[
        present.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in VALUE_TYPE.fields
    ])


def _plain_digits(text: Column) -> Column:
    """``1.25E-5`` → ``0.0000125``, ``-1.0E20`` → ``-100000000000000000000``."""
    sign = F.when(text.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(text, "E", 1), r"[-.]", ""), "0+$", "")
    power = F.substring_index(text, "E", -1).cast("int")
    # Shortest digits of a double are at most 17, so none of them stands behind the point here.
    large = F.rpad(digits, power + 1, F.lit("0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    middle = F.concat(F.substr(digits, F.lit(1), power + 1), F.lit("."), F.substr(digits, power + 2))
    shown = F.when(power < 0, small).when(F.length(digits) > power + 1, middle).otherwise(large)
    return F.concat(sign, shown)


def value_text(value: Column) -> Column:
    """Text of a scalar value, ``""`` for lists; whole doubles print without a fraction, and
    large or small ones without an exponent."""
    number = value["doubleValue"]
    whole = (number == F.floor(number)) & (F.abs(number) < 1e18)
    short = number.cast("string")
    return F.coalesce(
        value["stringValue"],
        value["intValue"].cast("string"),
        F.when(whole, number.cast("bigint").cast("string"))
        .when(F.contains(short, F.lit("E")), _plain_digits(short))
        .otherwise(short),
        value["boolValue"].cast("string"),
        F.lit(""),
    )


def flatten_dimensions(attributes: Column) -> Column:
    """Remove ``Dimensions`` and append the pairs it held."""

    def widen(pair: Column) -> Column:
        scalars = ["stringValue", "boolValue", "intValue", "doubleValue", "raw"]
        value = _value({name: pair["value"][name] for name in scalars})
        return F.struct(pair["key"].alias("key"), value.alias("value"))

    held = F.filter(attributes, lambda a: (a["key"] == DIMENSIONS) & a["value"]["kvlistValue"].isNotNull())
    pairs = F.flatten(F.transform(held, lambda a: F.transform(a["value"]["kvlistValue"]["values"], widen)))
    return F.concat(F.filter(attributes, lambda a: a["key"] != DIMENSIONS), pairs)


def labels_of(labels: dict[str, str]) -> Column:
    if not labels:
        return F.array().cast(ATTRIBUTES_TYPE)
    return F.array(*[attribute(k, v) for k, v in labels.items()])


def metric_identity(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Add ``namespace``, ``metric_name`` (last of each) and ``dims``, the other attributes
    as text pairs."""
    attrs = F.col(attributes)

    def last(key: str) -> Column:
        found = F.filter(attrs, lambda a: a["key"] == key)
        return F.coalesce(value_text(F.try_element_at(found, F.lit(-1))["value"]), F.lit(""))

    dims = F.transform(
        F.filter(
            attrs,
            lambda a: ~a["key"].isin(METRIC_NAME, NAMESPACE, DIMENSIONS) & ~F.startswith(a["key"], F.lit(RESERVED_PREFIX)),
        ),
        lambda a: F.struct(a["key"].alias("key"), value_text(a["value"]).alias("value")),
    )
    return df.withColumns({"namespace": last(NAMESPACE), "metric_name": last(METRIC_NAME), "dims": dims})


def finish_points(
    df: DataFrame,
    application: str,
    subsystem: str,
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """Clear units; on summary points append, in this order, tags (column ``tags``, if
    there), static labels, application and subsystem."""
    attrs = [F.col("attributes")]
    if "tags" in df.columns:
        attrs.append(
            F.coalesce(F.transform("tags", lambda t: attribute(t["key"], t["value"])), F.array().cast(ATTRIBUTES_TYPE))
        )
    attrs.append(labels_of(labels or {}))
    attrs.append(labels_of({APPLICATION_KEY: application, SUBSYSTEM_KEY: subsystem}))
    summary = F.col("kind") == "summary"
    df = df.withColumn("attributes", F.when(summary, F.concat(*attrs)).otherwise(F.col("attributes")))
    return df.withColumn("metric_unit", F.when(F.col("metric_unit").isNotNull(), ""))


def flatten_points(df: DataFrame) -> DataFrame:
    """``flatten_dimensions`` on summary points; other kinds pass through."""
    flat = F.when(F.col("kind") == "summary", flatten_dimensions(F.col("attributes")))
    return df.withColumn("attributes", F.coalesce(flat, F.col("attributes")))


def acknowledge(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The answer to each input record, by its id: accepted here, so dropped there."""
    return df.select(*(keys or ["record_id"]), F.lit("Dropped").alias("result"), "data")
