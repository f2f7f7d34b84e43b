"""Queries: metric messages, points, attributes, association, inventories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from logforge.catalog.registry import Tables, query
from logforge.functions import otlp
from logforge.operators import association as assoc
from logforge.operators import metrics as ops
from logforge.operators import metrics_json
from logforge.operators.batching import pack_batches
from logforge.operators.filters import filter_metrics
from logforge.plans.config import MetricConfig
from logforge.plans.ship import ship_metrics as ship
from logforge.session import staged
from logforge.sources.events import read_delivery_records

# A line item is a data point. Its line number picks the namespace.
NAMESPACES = ["AWS/EC2", "Shop/Parts", "AWS/AmazonMQ", "Unknown/Space"]


def dimension(key: str, text: Column) -> Column:
    scalar = F.struct(
        text.alias("stringValue"), F.lit(None).cast("boolean").alias("boolValue"),
        F.lit(None).cast("bigint").alias("intValue"), F.lit(None).cast("double").alias("doubleValue"),
        F.lit(None).cast("binary").alias("raw"),
    )
    return F.struct(F.lit(key).alias("key"), scalar.alias("value"))


def line_attributes(line: Callable[[str], Column]) -> Column:
    """Attributes of a line item's point; ``line`` gives its columns by name."""
    supplier, part = line("l_suppkey").cast("string"), line("l_partkey").cast("string")
    case = line("l_linenumber") % 4
    broker = F.concat(F.lit("b"), supplier, F.lit("-"), (line("l_linenumber") % 3 + 1).cast("string"))
    dims = (
        F.when(case == 0, F.array(dimension("InstanceId", F.concat(F.lit("i-"), supplier)), dimension("Zone", F.lit("z"))))
        .when(case == 1, F.array(dimension("PartId", part), dimension("Supplier Id", supplier)))
        .when(case == 2, F.array(dimension("Broker", broker)))
        .otherwise(F.array(dimension("InstanceId", F.concat(F.lit("i-"), supplier))))
    )
    held = ops._value({"kvlistValue": F.struct(dims.alias("values"))})
    namespace = F.get(F.array(*[F.lit(n) for n in NAMESPACES]), case)
    return F.array(
        ops.attribute("MetricName", F.concat(F.lit("m-"), line("l_returnflag"))),
        F.struct(F.lit("Dimensions").alias("key"), held.alias("value")),
        ops.attribute("Namespace", namespace),
    )


def line_kind(flag: Column) -> Column:
    return F.when(flag == "R", "gauge").otherwise("summary")


def line_points(t: Tables) -> DataFrame:
    """Points with ``MetricName``, ``Namespace`` and a ``Dimensions`` list."""
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity",
        line_kind(F.col("l_returnflag")).alias("kind"), F.lit("Count").alias("metric_unit"),
        line_attributes(F.col).cast(ops.ATTRIBUTES_TYPE).alias("attributes"),
    )


NAMESPACE_SQL = "CASE l_linenumber % 4 WHEN 0 THEN 'AWS/EC2' WHEN 1 THEN 'Shop/Parts' WHEN 2 THEN 'AWS/AmazonMQ' ELSE 'Unknown/Space' END"
KEYS_SQL = """CASE l_linenumber % 4 WHEN 0 THEN 'InstanceId,Zone' WHEN 1 THEN 'PartId,Supplier Id'
  WHEN 2 THEN 'Broker' ELSE 'InstanceId' END"""
FIRST_SQL = """CASE l_linenumber % 4 WHEN 0 THEN 'i-' || l_suppkey WHEN 1 THEN CAST(l_partkey AS VARCHAR)
  WHEN 2 THEN 'b' || l_suppkey || '-' || (l_linenumber % 3 + 1) ELSE 'i-' || l_suppkey END"""


def attribute_keys(column: str = "attributes") -> Column:
    return F.array_join(F.transform(column, lambda a: a["key"]), ",")


@query(f"""
SELECT CASE WHEN l_returnflag = 'R' THEN 'MetricName,Dimensions,Namespace' ELSE 'MetricName,Namespace,' || {KEYS_SQL} END AS keys,
  CASE WHEN l_returnflag <> 'R' THEN {FIRST_SQL} END AS first_value, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def flatten_dimensions(t: Tables) -> DataFrame:
    df = ops.flatten_points(line_points(t))
    first = F.get("attributes", F.lit(2))["value"]["stringValue"]
    df = df.select(attribute_keys().alias("keys"), F.when(F.col("kind") == "summary", first).alias("first_value"))
    return df.groupBy("keys", "first_value").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT {NAMESPACE_SQL} AS namespace, 'm-' || l_returnflag AS metric_name,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE {KEYS_SQL} END AS dim_keys,
  CASE WHEN l_returnflag <> 'R' THEN {FIRST_SQL} END AS first_value, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def metric_identity(t: Tables) -> DataFrame:
    # Gauges keep their dimensions folded up, so they have no pairs of their own.
    df = ops.metric_identity(ops.flatten_points(line_points(t)))
    df = df.select(
        "namespace", "metric_name", F.array_join(F.transform("dims", lambda d: d["key"]), ",").alias("dim_keys"),
        F.get("dims", F.lit(0))["value"].alias("first_value"),
    )
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT CASE WHEN l_returnflag = 'R' THEN 'MetricName,Dimensions,Namespace'
  ELSE 'MetricName,Namespace,' || {KEYS_SQL} || ',env,team,cx.application.name,cx.subsystem.name' END AS keys,
  CASE WHEN l_returnflag <> 'R' THEN 'sub' END AS last_value, '' AS unit, count(*) AS n FROM lineitem GROUP BY ALL
""")
def add_labels(t: Tables) -> DataFrame:
    df = ops.finish_points(ops.flatten_points(line_points(t)), "app", "sub", {"env": "prod", "team": "x"})
    last = F.element_at("attributes", -1)["value"]["stringValue"]
    df = df.select(attribute_keys().alias("keys"), F.when(F.col("kind") == "summary", last).alias("last_value"), F.col("metric_unit").alias("unit"))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {NAMESPACE_SQL} AS namespace, count(*) AS points, 0 AS tagged FROM lineitem GROUP BY ALL")
def missing_inventory(t: Tables) -> DataFrame:
    # Of the inventory only one namespace's resources are there, and none that a point names: the
    # points of the others go on without tags.
    registry = assoc.load_registry(t.spark, REGISTRY)
    strangers = resources(t).filter("resource_type = 'mq:broker'").withColumn("arn", F.concat("arn", F.lit(":not:ours")))
    index = assoc.build_associations(strangers, registry)
    points = line_points(t).withColumn("attributes", ops.flatten_dimensions(F.col("attributes")))
    points = assoc.require_inventory(ops.metric_identity(points).select("namespace", "dims"), index, registry, "skip")
    tagged = F.count_if(F.size("tags") > 0).cast("int").alias("tagged")
    return assoc.associate_tags(points, index, registry).groupBy("namespace").agg(F.count(F.lit(1)).alias("points"), tagged)


RULES_SQL = """(l_returnflag = 'A' AND l_linenumber % 4 = 0) OR l_linenumber % 4 = 2"""


def metric_rules(t: Tables) -> DataFrame:
    # One metric of one namespace, and all metrics of another; read off the data.
    seen = t("lineitem").select("l_linenumber", "l_returnflag").distinct()
    namespace = F.get(F.array(*[F.lit(n) for n in NAMESPACES]), F.col("l_linenumber") % 4)
    rules = seen.filter("(l_linenumber % 4 = 0 AND l_returnflag = 'A') OR l_linenumber % 4 = 2")
    metric = F.when(F.col("l_linenumber") % 4 == 0, F.concat(F.lit("m-"), "l_returnflag"))
    return rules.select(namespace.alias("namespace"), metric.alias("metric_name"))


def _filtered(t: Tables, include: bool) -> DataFrame:
    namespace = F.get(F.array(*[F.lit(n) for n in NAMESPACES]), F.col("l_linenumber") % 4)
    df = t("lineitem").select(namespace.alias("namespace"), F.concat(F.lit("m-"), "l_returnflag").alias("metric_name"), "l_orderkey")
    df = filter_metrics(df, metric_rules(t), include)
    return df.groupBy("namespace", "metric_name").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


FILTERED_SQL = f"""
SELECT {NAMESPACE_SQL} AS namespace, 'm-' || l_returnflag AS metric_name, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys
FROM lineitem WHERE {{where}} GROUP BY ALL
"""


@query(FILTERED_SQL.format(where=RULES_SQL))
def filter_metrics_include(t: Tables) -> DataFrame:
    return _filtered(t, True)


@query(FILTERED_SQL.format(where=f"NOT ({RULES_SQL})"))
def filter_metrics_exclude(t: Tables) -> DataFrame:
    return _filtered(t, False)


# Inventory: instances and brokers are suppliers, parts are parts, and pairs of both.

REGISTRY = [
    {"namespace": "AWS/EC2", "resource_types": ["ec2:instance"], "arn_patterns": [assoc.whole_arn("ec2", "instance/(?P<InstanceId>i-[0-9a-z]+)")]},
    {
        "namespace": "Shop/Parts",
        "resource_types": ["shop"],
        "arn_patterns": [
            r":part/(?P<PartId>[0-9]+)$",
            r"[bad",
            r":pair/(?P<PartId>[0-9]+)/(?P<Supplier_Id>[0-9]+)$",
        ],
    },
    {"namespace": "AWS/AmazonMQ", "resource_types": ["mq"], "arn_patterns": [assoc.whole_arn("mq", "broker:(?P<Broker>[^:]+):[^:]+")]},
    {"namespace": "Empty/Space", "resource_types": [], "arn_patterns": []},
]


def resources(t: Tables) -> DataFrame:
    def rows(df: DataFrame, arn: Column, kind: str, tag: Column, pos: Column) -> DataFrame:
        tags = F.array(F.struct(F.lit("Team").alias("key"), tag.alias("value")))
        return df.select(arn.alias("arn"), F.lit(kind).alias("resource_type"), tags.alias("tags"), pos.alias("pos"))

    s, p = F.col("s_suppkey").cast("string"), F.col("p_partkey").cast("string")
    supplier, part = t("supplier"), t("part")
    pairs = t("lineitem").select("l_partkey", "l_suppkey").filter("(l_partkey + l_suppkey) % 5 = 0").distinct()
    pair = F.concat_ws("/", F.lit("arn:aws:shop:eu:1:pair"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return (
        rows(supplier.filter("s_suppkey % 2 = 0"), F.concat(F.lit("arn:aws:ec2:eu:1:instance/i-"), s), "ec2:instance",
             F.concat(F.lit("ec2-"), s), F.col("s_suppkey"))
        # The same broker name twice: the later one counts.
        .unionByName(rows(supplier.filter("s_suppkey % 3 = 0"), F.concat(F.lit("arn:aws:mq:eu:1:broker:b"), s, F.lit(":one")), "mq:broker",
                          F.lit("old"), F.col("s_suppkey")))
        .unionByName(rows(supplier.filter("s_suppkey % 3 = 0"), F.concat(F.lit("arn:aws:mq:eu:1:broker:b"), s, F.lit(":two")), "mq:broker",
                          F.concat(F.lit("mq-"), s), F.col("s_suppkey") + 1_000_000))
        .unionByName(rows(part.filter("p_partkey % 2 = 0"), F.concat(F.lit("arn:aws:shop:eu:1:part/"), p), "shop:part",
                          F.concat(F.lit("part-"), p), F.col("p_partkey")))
        .unionByName(rows(pairs, pair, "shop:pair", F.concat(F.lit("pair-"), F.col("l_partkey").cast("string")), F.col("l_partkey")))
    )


TEAM_SQL = """CASE
  WHEN l_linenumber % 4 = 0 AND l_suppkey % 2 = 0 THEN 'ec2-' || l_suppkey
  WHEN l_linenumber % 4 = 2 AND l_suppkey % 3 = 0 THEN 'mq-' || l_suppkey
  WHEN l_linenumber % 4 = 1 AND (l_partkey + l_suppkey) % 5 = 0 THEN 'pair-' || l_partkey
  WHEN l_linenumber % 4 = 1 AND l_partkey % 2 = 0 THEN 'part-' || l_partkey END"""


@query(f"SELECT {NAMESPACE_SQL} AS namespace, {TEAM_SQL} AS team, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem GROUP BY ALL")
def associate_tags(t: Tables) -> DataFrame:
    registry = assoc.load_registry(t.spark, REGISTRY)
    index = assoc.build_associations(resources(t), registry)
    points = line_points(t).withColumn("attributes", ops.flatten_dimensions(F.col("attributes")))
    points = ops.metric_identity(points).select("l_orderkey", "namespace", "dims")
    df = assoc.associate_tags(points, index, registry)
    team = F.get("tags", F.lit(0))["value"].alias("team")
    return df.groupBy("namespace", team).agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query("""
SELECT 'AWS/EC2' AS namespace, 0 AS pattern_idx, 'i-' || s_suppkey AS key, 'arn:aws:ec2:eu:1:instance/i-' || s_suppkey AS arn
FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL
SELECT 'AWS/AmazonMQ', 0, 'b' || s_suppkey, 'arn:aws:mq:eu:1:broker:b' || s_suppkey || ':two' FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL
SELECT 'Shop/Parts', 0, CAST(p_partkey AS VARCHAR), 'arn:aws:shop:eu:1:part/' || p_partkey FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT DISTINCT 'Shop/Parts', 1, l_partkey || ',' || l_suppkey, 'arn:aws:shop:eu:1:pair/' || l_partkey || '/' || l_suppkey
FROM lineitem WHERE (l_partkey + l_suppkey) % 5 = 0
""")
def build_associations(t: Tables) -> DataFrame:
    index = assoc.build_associations(resources(t), assoc.load_registry(t.spark, REGISTRY))
    return index.select("namespace", "pattern_idx", F.array_join("key", ",").alias("key"), "arn")


@query("""
SELECT s_suppkey AS supplier, s_name AS team, 'ec2:instance' AS resource_type,
  s_suppkey // 40 * 2147483648 + row_number() OVER (PARTITION BY s_suppkey // 40 ORDER BY s_suppkey) - 1 AS pos
FROM supplier WHERE s_suppkey % 2 = 0
""")
def load_inventory(t: Tables) -> DataFrame:
    # Exported pages of 40 suppliers; odd ones are volumes, which nobody asked for.
    arn = F.concat(
        F.lit("arn:aws:ec2:eu:1:"), F.when(F.col("s_suppkey") % 2 == 0, "instance/i-").otherwise("volume/v-"),
        F.col("s_suppkey").cast("string"),
    )
    item = F.struct(
        (F.col("s_suppkey") % 2).alias("odd"), F.col("s_suppkey").alias("n"), arn.alias("ResourceARN"),
        F.array(F.struct(F.lit("Team").alias("Key"), F.col("s_name").alias("Value"))).alias("Tags"),
    )
    pages = t("supplier").groupBy(F.floor(F.col("s_suppkey") / 40).alias("page_no")).agg(
        F.sort_array(F.collect_list(item)).alias("ResourceTagMappingList")
    )
    pages = pages.select("page_no", F.to_json(F.struct("ResourceTagMappingList")).alias("page"))
    df = assoc.load_inventory(pages, ["ec2:instance"])
    return df.select(
        F.regexp_extract("arn", "([0-9]+)$", 1).cast("bigint").alias("supplier"), F.get("tags", F.lit(0))["value"].alias("team"),
        "resource_type", "pos",
    )


SNAPSHOT_SQL = """
WITH latest AS (SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY 1)
SELECT o_orderkey FROM orders JOIN latest USING (o_custkey) WHERE o_orderdate = newest {fresh}
"""


def snapshots(t: Tables, allow_stale: bool) -> DataFrame:
    # Orders stand for inventory rows, their customer for the namespace.
    df = t("orders").select("o_orderkey", F.col("o_custkey").alias("namespace"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"))
    now = F.lit("2001-06-01 00:00:00").cast("timestamp")
    return assoc.pick_snapshot(df, now, ttl_seconds=90 * 86400, allow_stale=allow_stale).select("o_orderkey")


@query(SNAPSHOT_SQL.format(fresh="AND epoch(TIMESTAMP '2001-06-01') - epoch(newest) < 90 * 86400"))
def pick_snapshot(t: Tables) -> DataFrame:
    return snapshots(t, allow_stale=False)


@query(SNAPSHOT_SQL.format(fresh=""))
def pick_snapshot_stale(t: Tables) -> DataFrame:
    return snapshots(t, allow_stale=True)


# Messages: one per order and supplier, with a metric for each of its line items.


def line_payloads(t: Tables, by: dict[str, Column] | None = None) -> DataFrame:
    """Messages in order; with ``by``, columns of ``record_id`` and ``msg_idx``, they lie together by those."""
    # Line items move as they are, four short columns; their metrics are built behind the shuffle, row by row,
    # as what is inside a list is not compiled.
    df = t("lineitem").withColumnsRenamed({"l_orderkey": "record_id", "l_suppkey": "msg_idx"})
    keys = [*dict.fromkeys([*(by or {}), "record_id", "msg_idx"])]
    df = df.withColumns(by or {}).select(*keys, "l_linenumber", "l_partkey", "l_returnflag")
    df = df.repartition(*(by or keys)).sortWithinPartitions(*keys)
    empty = F.lit(None).cast("binary")
    attributes = line_attributes(lambda name: F.col("msg_idx" if name == "l_suppkey" else name))
    point = F.struct(
        attributes.alias("attributes"), F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("double").alias("sum"),
        empty.alias("rest"),
    )
    metric = F.struct(
        F.concat(F.lit("m-"), "l_returnflag").alias("name"), F.lit("Count").alias("unit"),
        line_kind(F.col("l_returnflag")).alias("kind"), F.array(point).alias("data_points"),
        empty.alias("data_rest"), empty.alias("rest"),
    )
    line = F.struct(F.struct("l_linenumber", "l_partkey", "l_returnflag").alias("at"), metric.alias("metric"))
    df = df.select(*keys, line.alias("line")).groupBy(*keys).agg(F.sort_array(F.collect_list("line")).alias("lines"))
    scope = F.struct(F.col("lines.metric").alias("metrics"), empty.alias("rest"))
    resource = F.struct(F.array(scope).alias("scope_metrics"), empty.alias("rest"))
    return df.select(*keys, F.array(resource).cast(from_arrow_type(otlp.RESOURCES)).alias("resource_metrics"))


def line_records(t: Tables) -> DataFrame:
    """Binary records: the messages of an order and 32 suppliers, length-prefixed."""
    # Messages lie by record and are joined where they are.
    by = {"record_id": F.col("record_id"), "part": F.floor(F.col("msg_idx") / 32)}
    return ops.join_messages(ops.encode_metrics(line_payloads(t, by)).drop("resource_metrics"), [*by])


POINTS_SQL = f"""
SELECT l_orderkey AS record_id, 'm-' || l_returnflag AS name,
  CASE WHEN l_returnflag = 'R' THEN 'gauge' ELSE 'summary' END AS kind, {FIRST_SQL} AS first_value, count(*) AS n
FROM lineitem GROUP BY ALL
"""


@query(POINTS_SQL)
def decode_metrics(t: Tables) -> DataFrame:
    return first_dimensions(ops.explode_points(ops.decode_metrics(ops.split_messages(line_records(t)))))


@query(POINTS_SQL)
def decode_metrics_json(t: Tables) -> DataFrame:
    # The same messages in their JSON form, without Python.
    payloads = metrics_json.encode_metrics_json(line_payloads(t)).drop("resource_metrics")
    messages = staged(payloads, "json-messages")
    return first_dimensions(ops.explode_points(metrics_json.decode_metrics_json(messages)))


def first_dimensions(df: DataFrame) -> DataFrame:
    """Points by record, name, kind and the first of their dimensions."""
    dims = F.get(F.filter("attributes", lambda a: a["key"] == "Dimensions"), F.lit(0))["value"]["kvlistValue"]["values"]
    df = df.select("record_id", "name", "kind", F.get(dims, F.lit(0))["value"]["stringValue"].alias("first_value"))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT l_orderkey AS record_id, l_suppkey // 32 AS part,
  row_number() OVER (PARTITION BY l_orderkey, l_suppkey // 32 ORDER BY l_suppkey) - 1 AS msg_idx, count(*) AS metrics
FROM lineitem GROUP BY l_orderkey, l_suppkey
""")
def split_messages(t: Tables) -> DataFrame:
    df = ops.decode_metrics(ops.split_messages(line_records(t)))
    return ops.batch_totals(df, ["record_id", "part", "msg_idx"]).select(
        "record_id", "part", F.col("msg_idx").cast("bigint").alias("msg_idx"), F.col("metrics").cast("bigint").alias("metrics")
    )


def _wired(df: DataFrame, tag: str | Column, name: str = "value") -> DataFrame:
    """Column ``name`` as one length-prefixed field, under 128 bytes.

    Each field is a projection of its own: within one expression, fields in fields would double
    it at each level.
    """
    held, tag = F.col(name), F.lit(tag) if isinstance(tag, str) else tag
    return df.withColumn(name, F.concat(F.unhex(tag), F.unhex(F.lpad(F.hex(F.octet_length(held)), 2, "0")), held))


def _nested(df: DataFrame, listed: Column, paired: Column) -> DataFrame:
    """``value`` in a list where ``listed``, in a pair of key ``k`` where ``paired``."""
    df = df.withColumn("_plain", F.when(~listed & ~paired, F.col("value")))
    key = F.unhex(F.lit("0A016B"))
    pair = _wired(df.withColumn("_pair", F.col("value")), "12", "_pair")
    df = _wired(pair.withColumn("value", F.when(paired, F.concat(key, "_pair")).otherwise(F.col("value"))), "0A")
    df = _wired(df, F.when(paired, "32").otherwise("2A"))
    return df.withColumn("value", F.coalesce("_plain", "value")).drop("_plain", "_pair")


@query("""
SELECT l_linenumber % 5 AS kind, CASE WHEN l_returnflag = 'R' THEN 'gauge' ELSE 'summary' END AS point_kind,
  count(*) AS n, count(*) AS same_message, count(*) AS same_value FROM lineitem GROUP BY ALL
""")
def metric_value_kinds(t: Tables) -> DataFrame:
    # Attribute values that are bytes, or nested twice, survive decoding and encoding whole,
    # also where Dimensions are flattened.
    kind = F.col("l_linenumber") % 5
    rows = line_points(t).select(kind.alias("kind"), "l_orderkey", "l_partkey", "l_suppkey", F.col("kind").alias("point_kind"))
    texts, kind = F.col("kind").isin(1, 4), F.col("kind")
    text = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"))
    held = F.when(texts, text).otherwise(F.col("l_suppkey").cast("string")).cast("binary")
    rows = _wired(rows.select("kind", "point_kind", held.alias("value")), F.when(texts, "0A").otherwise("3A"))
    rows = _nested(rows, kind.isin(1, 3, 4), kind == 2)
    rows = _nested(rows, kind == 1, kind.isin(2, 4))
    value = F.col("value")
    point = F.struct(
        F.array(ops.attribute("n", F.lit("x")), F.struct(F.lit("v").alias("key"), ops._value({"raw": value}).alias("value"))).alias("attributes"),
        F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("double").alias("sum"), F.lit(None).cast("binary").alias("rest"),
    )
    empty = F.lit(None).cast("binary")
    metric = F.struct(
        F.lit("m").alias("name"), F.lit("u").alias("unit"), F.col("point_kind").alias("kind"), F.array(point).alias("data_points"),
        empty.alias("data_rest"), empty.alias("rest"),
    )
    resource = F.struct(F.array(F.struct(F.array(metric).alias("metrics"), empty.alias("rest"))).alias("scope_metrics"), empty.alias("rest"))
    df = rows.select("kind", "point_kind", "value",
                     F.array(resource).cast(from_arrow_type(otlp.RESOURCES)).alias("resource_metrics"))
    df = df.withColumn("message", otlp.encode_request(F.col("resource_metrics")))
    df = df.withColumn("again", otlp.decode_request(F.col("message")))
    held = F.col("again")[0]["scope_metrics"][0]["metrics"][0]["data_points"][0]["attributes"][1]["value"]["raw"]
    df = df.withColumns({"held": held, "back": otlp.encode_request(F.col("again"))})
    return df.groupBy("kind", "point_kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("back") == F.col("message")).alias("same_message"),
        F.count_if(F.col("held") == F.col("value")).alias("same_value"),
    )


@query("SELECT count(*) AS messages, count(*) AS same FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)")
def rebuild_payload(t: Tables) -> DataFrame:
    # Taking payloads apart and putting them together again gives the same payloads.
    df = line_payloads(t)
    again = ops.rebuild_payload(ops.explode_points(df), ["record_id", "msg_idx"])
    again = again.withColumnRenamed("resource_metrics", "again")
    both = df.join(again, ["record_id", "msg_idx"], "full")
    same = F.to_json("resource_metrics") == F.to_json("again")
    return both.agg(F.count(F.lit(1)).alias("messages"), F.count_if(same).alias("same"))


@query("""
SELECT CAST(l_orderkey // 16 AS BIGINT) AS batch, l_suppkey // 32 AS part, count(DISTINCT (l_orderkey, l_suppkey)) AS resource_metrics,
  count(DISTINCT (l_orderkey, l_suppkey)) AS scope_metrics, count(*) AS metrics FROM lineitem GROUP BY ALL
""")
def metric_batch_totals(t: Tables) -> DataFrame:
    keys = {"batch": F.floor(F.col("record_id") / 16), "part": F.floor(F.col("msg_idx") / 32)}
    merged = ops.merge_payloads(line_payloads(t, keys), ["batch", "part"], ["record_id", "msg_idx"])
    df = ops.batch_totals(merged, ["batch", "part"])
    return df.select("batch", "part", *[F.col(c).cast("bigint").alias(c) for c in ("resource_metrics", "scope_metrics", "metrics")])


@query("""
WITH RECURSIVE m AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS size FROM lineitem GROUP BY ALL),
numbered AS (SELECT l_orderkey // 64 AS unit, l_orderkey AS a, l_suppkey AS b, CAST(size AS BIGINT) AS size,
    row_number() OVER (PARTITION BY l_orderkey // 64 ORDER BY l_orderkey, l_suppkey) AS n FROM m),
packed AS (
  SELECT unit, a, b, n, size AS held, CAST(0 AS BIGINT) AS batch_id FROM numbered WHERE n = 1
  UNION ALL
  SELECT r.unit, r.a, r.b, r.n, CASE WHEN p.held + r.size <= 120 THEN p.held + r.size ELSE r.size END,
    CASE WHEN p.held + r.size <= 120 THEN p.batch_id ELSE p.batch_id + 1 END
  FROM packed p JOIN numbered r ON r.unit = p.unit AND r.n = p.n + 1)
SELECT a AS orderkey, b AS suppkey, CAST(unit AS BIGINT) AS unit, batch_id FROM packed
""")
def pack_metric_batches(t: Tables) -> DataFrame:
    # Messages are packed by their own size alone; one over the target goes by itself.
    df = t("lineitem").groupBy(F.col("l_orderkey").alias("orderkey"), F.col("l_suppkey").alias("suppkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("size")
    )
    df = df.withColumn("unit", F.floor(F.col("orderkey") / 64))
    return pack_batches(df, ["unit"], ["orderkey", "suppkey"], "size", 120, overhead=0, span=8).select(
        "orderkey", "suppkey", "unit", "batch_id"
    )


@query("""
SELECT l_orderkey AS record_id, 'Dropped' AS result, l_suppkey // 32 AS part, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS messages
FROM lineitem GROUP BY l_orderkey, l_suppkey // 32
""")
def acknowledge(t: Tables) -> DataFrame:
    acks = ops.acknowledge(line_records(t), ["record_id", "part"])
    return acks.select("record_id", "result", "part", F.size(otlp.split_delimited(F.col("data"))).cast("bigint").alias("messages"))


SHIPPED_SQL = f"""
SELECT CASE WHEN l_returnflag <> 'R' THEN {TEAM_SQL} END AS team,
  CASE WHEN l_returnflag = 'R' THEN 'Namespace' ELSE 'cx.subsystem.name' END AS last_key, '' AS unit, count(*) AS points
FROM lineitem GROUP BY ALL
"""


def shipped_points(t: Tables, batching: bool) -> DataFrame:
    registry = assoc.load_registry(t.spark, REGISTRY)
    index = assoc.build_associations(resources(t), registry)
    cfg = MetricConfig("app", "sub", {"env": "prod"}, batching=batching, batch_target=20_000)
    sent = line_records(t).withColumn("unit", F.floor(F.col("record_id") / 512))
    return ship(sent, cfg, index, registry, ["unit", "part"])


@query(SHIPPED_SQL)
def ship_metrics(t: Tables) -> DataFrame:
    df = ops.explode_points(ops.decode_metrics(shipped_points(t, True).select("batch_id", "message")))
    team = F.get(F.filter("attributes", lambda a: a["key"] == "Team"), F.lit(0))["value"]["stringValue"]
    df = df.select(team.alias("team"), F.element_at("attributes", -1)["key"].alias("last_key"), F.col("metric_unit").alias("unit"))
    return df.groupBy("team", "last_key", "unit").agg(F.count(F.lit(1)).alias("points"))


@query("SELECT CAST(l_orderkey // 512 AS BIGINT) AS unit, count(DISTINCT (l_orderkey, l_suppkey)) AS requests FROM lineitem GROUP BY 1")
def ship_metrics_unbatched(t: Tables) -> DataFrame:
    return shipped_points(t, False).groupBy("unit").agg(F.count(F.lit(1)).alias("requests"))


@query("""
SELECT l_orderkey // 16 AS unit, l_suppkey // 32 AS part, count(DISTINCT l_orderkey) AS records, count(DISTINCT (l_orderkey, l_suppkey)) AS messages
FROM lineitem GROUP BY ALL
""")
def delivery_records(t: Tables) -> DataFrame:
    # Records as they come: base64 inside the event of a delivery stream.
    record = F.struct(F.col("record_id").cast("string").alias("recordId"), F.base64("data").alias("data"))
    df = line_records(t).groupBy(F.floor(F.col("record_id") / 16).alias("unit"), "part").agg(F.collect_list(record).alias("records"))
    df = df.select("unit", "part", F.to_json(F.struct(F.lit("i").alias("invocationId"), "records")).alias("event"))
    df = ops.split_messages(read_delivery_records(df))
    return df.groupBy("unit", "part").agg(
        F.count_distinct("record").alias("records"), F.count(F.lit(1)).alias("messages")
    )
