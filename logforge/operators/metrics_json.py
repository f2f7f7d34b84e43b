"""Metric messages in their JSON form, as the same nested columns that the binary form gives."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from logforge.functions import otlp
from logforge.functions.text import json_quote, whole_object

# Fixed values (public names of the OTLP JSON form): the kinds of data, and the members of each
# level that travel along untouched.
KINDS = {
    "gauge": "gauge", "sum": "sum", "histogram": "histogram",
    "exponentialHistogram": "exponential_histogram", "summary": "summary"}
RESOURCE_REST = "resource variant, schemaUrl string"
SCOPE_REST = "scope variant, schemaUrl string"
METRIC_REST = "description string, metadata variant"
DATA_REST = "aggregationTemporality variant, isMonotonic boolean"
POINT_REST = """startTimeUnixNano string, timeUnixNano string, flags bigint, exemplars variant,
    asInt string, asDouble string, min string, max string, bucketCounts variant, explicitBounds variant,
    quantileValues variant, scale int, zeroCount string, zeroThreshold string, positive variant, negative variant"""
SCALAR = "stringValue string, boolValue boolean, intValue string, doubleValue string, bytesValue string"
DEEPER = f"{SCALAR}, arrayValue variant, kvlistValue variant"
VALUE = f"""struct<{SCALAR}, arrayValue struct<values array<struct<{DEEPER}>>>,
    kvlistValue struct<values array<struct<key string, value struct<{DEEPER}>>>>>"""
POINT = f"struct<attributes array<struct<key string, value {VALUE}>>, count string, sum string, {POINT_REST}>"
METRIC = ", ".join(
    ["name string", "unit string", METRIC_REST, *[f"{k} struct<dataPoints array<{POINT}>, {DATA_REST}>" for k in KINDS]])
SCHEMA = f"""resourceMetrics array<struct<scopeMetrics array<struct<metrics array<struct<{METRIC}>>,
    {SCOPE_REST}>>, {RESOURCE_REST}>>"""


def _rest(row: Column, members: str) -> Column:
    """The other members of a level as JSON bytes, NULL if there are none."""
    names = [part.split()[0] for part in members.replace("\n", " ").split(",")]
    text = F.to_json(F.struct(*[row[n].alias(n) for n in names]))
    # Mostly there are none: the text is made only where it holds something.
    some = reduce(lambda a, b: a | b, [row[n].isNotNull() for n in names])
    return F.when(some, F.when(text != "{}", F.encode(text, "UTF-8")))


def _scalars(value: Column) -> list[Column]:
    return [
        value["stringValue"].alias("stringValue"), value["boolValue"].alias("boolValue"),
        value["intValue"].try_cast("bigint").alias("intValue"),
        value["doubleValue"].try_cast("double").alias("doubleValue")]


def _deep(value: Column) -> Column:
    """Whether a value inside a list is more than a scalar."""
    return value["bytesValue"].isNotNull() | value["arrayValue"].isNotNull() | value["kvlistValue"].isNotNull()


def _raw(value: Column) -> Column:
    return F.encode(F.to_json(value), "UTF-8")


def _value(value: Column) -> Column:
    """A parsed value as the binary form's column; what that does not hold whole is JSON in ``raw``."""
    items, pairs = value["arrayValue"]["values"], value["kvlistValue"]["values"]
    flat = ~F.coalesce(F.exists(items, _deep), F.lit(False))
    listed = F.when(value["arrayValue"].isNotNull() & flat, F.struct(
        F.transform(F.coalesce(items, F.array()), lambda v: F.struct(*_scalars(v))).alias("values")))
    held = F.when(value["kvlistValue"].isNotNull(), F.struct(F.transform(
        F.coalesce(pairs, F.array()), lambda p: F.struct(p["key"].alias("key"), F.struct(
            *_scalars(p["value"]), F.when(_deep(p["value"]), _raw(p["value"])).alias("raw")).alias("value"))).alias("values")))
    raw = F.when(value["bytesValue"].isNotNull() | ~flat, _raw(value))
    return F.struct(*_scalars(value), listed.alias("arrayValue"), held.alias("kvlistValue"), raw.alias("raw"))


def decode_metrics_json(df: DataFrame, message: str = "message") -> DataFrame:
    """``message`` JSON text → ``resource_metrics``, as ``decode_metrics`` does for the binary form, for
    ``explode_points`` and all that follows; text that is no such message gets ``error``.

    Members that the operators do not touch are kept as JSON bytes in the ``rest`` columns, so these
    rows are written back by ``encode_metrics_json``, not by the binary encoder.
    """
    parsed = F.from_json(F.col(message), SCHEMA)["resourceMetrics"]

    def point(p: Column) -> Column:
        attributes = F.transform(p["attributes"], lambda a: F.struct(a["key"].alias("key"), _value(a["value"]).alias("value")))
        return F.struct(
            F.coalesce(attributes, F.array().cast(from_arrow_type(otlp.ATTRIBUTES))).alias("attributes"),
            p["count"].try_cast("bigint").alias("count"), p["sum"].try_cast("double").alias("sum"),
            _rest(p, POINT_REST).alias("rest"))

    def metric(m: Column) -> Column:
        kind, points, rest = F.lit(None).cast("string"), F.lit(None), F.lit(None).cast("binary")
        for name, known in KINDS.items():
            kind = F.coalesce(kind, F.when(m[name].isNotNull(), known))
        points = F.coalesce(*[F.when(m[name].isNotNull(), m[name]["dataPoints"]) for name in KINDS])
        for name in KINDS:
            rest = F.coalesce(rest, F.when(m[name].isNotNull(), _rest(m[name], DATA_REST)))
        return F.struct(
            m["name"].alias("name"), m["unit"].alias("unit"), kind.alias("kind"),
            F.transform(F.coalesce(points, F.array()), point).alias("data_points"), rest.alias("data_rest"),
            _rest(m, METRIC_REST).alias("rest"))

    def scope(s: Column) -> Column:
        return F.struct(
            F.transform(F.coalesce(s["metrics"], F.array()), metric).alias("metrics"), _rest(s, SCOPE_REST).alias("rest"))

    def resource(r: Column) -> Column:
        return F.struct(
            F.transform(F.coalesce(r["scopeMetrics"], F.array()), scope).alias("scope_metrics"),
            _rest(r, RESOURCE_REST).alias("rest"))

    # The whole text, read twice without building anything of it.
    good = whole_object(F.col(message))
    levels = F.transform(F.coalesce(parsed, F.array()), resource).cast(from_arrow_type(otlp.RESOURCES))
    df = df.withColumn("resource_metrics", F.when(good, levels))
    bad = F.col(message).isNotNull() & F.col("resource_metrics").isNull()
    known = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.withColumn("error", F.when(bad, "bad metrics message").otherwise(known)).drop(message)


def _members(*parts: Column) -> Column:
    """A JSON object of those members that are there."""
    if len(parts) == 1:
        return F.concat(F.lit("{"), F.coalesce(parts[0], F.lit("")), F.lit("}"))
    return F.concat(F.lit("{"), F.array_join(F.array(*parts), ","), F.lit("}"))


def _member(name: str, text: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), text)


def _inside(rest: Column) -> Column:
    """Members of a ``rest``, without their braces."""
    text = F.decode(rest, "UTF-8")
    return F.substr(text, F.lit(2), F.char_length(text) - 2)


def _list(items: Column, build: Callable[[Column], Column]) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, build), ","), F.lit("]"))


def _number(value: Column) -> Column:
    """A double: numbers JSON has none for are texts."""
    plain = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.substr(plain, F.lit(6), F.char_length(plain) - 6))


def _scalar_text(value: Column) -> list[Column]:
    return [
        _member("stringValue", json_quote(value["stringValue"])), _member("boolValue", value["boolValue"].cast("string")),
        _member("intValue", F.concat(F.lit('"'), value["intValue"].cast("string"), F.lit('"'))),
        _member("doubleValue", _number(value["doubleValue"]))]


def _only_text(value: Column, *others: str) -> Column:
    """Whether a value is a text and nothing else, as most are: these need no list of members."""
    none = [value[name].isNull() for name in ("boolValue", "intValue", "doubleValue", "raw", *others)]
    return reduce(lambda a, b: a & b, none, value["stringValue"].isNotNull())


def _value_text(value: Column) -> Column:
    text = _members(_member("stringValue", json_quote(value["stringValue"])))

    def inner(held: Column) -> Column:
        plain = _members(_member("stringValue", json_quote(held["stringValue"])))
        whole = F.coalesce(F.decode(held["raw"], "UTF-8"), _members(*_scalar_text(held)))
        return F.when(_only_text(held), plain).otherwise(whole)

    listed = F.when(value["arrayValue"].isNotNull(), _member(
        "arrayValue", _members(_member("values", _list(value["arrayValue"]["values"], lambda v: _members(*_scalar_text(v)))))))
    held = F.when(value["kvlistValue"].isNotNull(), _member("kvlistValue", _members(_member("values", _list(
        value["kvlistValue"]["values"],
        lambda p: _members(_member("key", json_quote(p["key"])), _member("value", inner(p["value"]))))))))
    whole = F.coalesce(F.decode(value["raw"], "UTF-8"), _members(*_scalar_text(value), listed, held))
    return F.when(_only_text(value, "arrayValue", "kvlistValue"), text).otherwise(whole)


def encode_metrics_json(df: DataFrame, out: str = "message") -> DataFrame:
    """``resource_metrics`` as ``decode_metrics_json`` gives them, or without ``rest``, → JSON text."""

    def point(p: Column) -> Column:
        attributes = _list(p["attributes"], lambda a: _members(
            _member("key", json_quote(a["key"])), _member("value", _value_text(a["value"]))))
        return _members(
            _member("attributes", attributes),
            _member("count", F.concat(F.lit('"'), p["count"].cast("string"), F.lit('"'))),
            _member("sum", _number(p["sum"])), _inside(p["rest"]))

    def metric(m: Column) -> Column:
        data = _members(_member("dataPoints", _list(m["data_points"], point)), _inside(m["data_rest"]))
        kinds = [F.when(m["kind"] == known, _member(name, data)) for name, known in KINDS.items()]
        return _members(
            _member("name", json_quote(m["name"])), _member("unit", json_quote(m["unit"])), F.coalesce(*kinds), _inside(m["rest"]))

    def scope(s: Column) -> Column:
        return _members(_member("metrics", _list(s["metrics"], metric)), _inside(s["rest"]))

    def resource(r: Column) -> Column:
        return _members(_member("scopeMetrics", _list(r["scope_metrics"], scope)), _inside(r["rest"]))

    return df.withColumn(out, _members(_member("resourceMetrics", _list(F.col("resource_metrics"), resource))))
