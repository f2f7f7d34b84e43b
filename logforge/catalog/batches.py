"""Queries: packing, requests, payloads, statistics, failures, whole log pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.catalog.framing import LINES_SQL, NOT_BLANK_SQL
from logforge.catalog.records import EVENT_LOG_SQL, SEVERITY_SQL, event_log
from logforge.catalog.registry import Tables, query
from logforge.functions import otlp
from logforge.functions.text import json_quote, with_json
from logforge.operators import batching, export, failures, framing
from logforge.operators.body import build_body, name_records
from logforge.operators.filters import block_pattern, drop_blank, size_gate as gate
from logforge.catalog.events import subscription_events
from logforge.plans.config import LogConfig
from logforge.plans.deliver import deliver, file_sink
from logforge.plans.ship import failed_rows, ship_logs
from logforge.plans.sink import read_delivered, send_requests
from logforge.session import staged, work_dir
from logforge.sources.events import read_cloudwatch
from logforge.sources.objects import decode_objects, object_meta
from logforge.streaming.stream import ship_stream

TARGET = 2000
OVERHEAD = 200


def sized_events(t: Tables, *more: str) -> DataFrame:
    # Every 37th record alone is over the target.
    size = F.when(F.col("event_id") % 37 == 0, 3000).otherwise(F.octet_length("props") + F.octet_length("event_type"))
    return t("events").select("event_id", "user_id", "event_type", "props", *more, size.cast("bigint").alias("size"))


def packed_cte(target: int) -> str:
    """Greedy packing of ``numbered(unit, k, n, size)`` as a recursive query."""
    return f"""packed AS (
  SELECT unit, k, n, CAST(size AS BIGINT) AS held, CAST(0 AS BIGINT) AS batch_id FROM numbered WHERE n = 1
  UNION ALL
  SELECT r.unit, r.k, r.n, CAST(CASE WHEN p.held + r.size <= {target} THEN p.held + r.size ELSE r.size END AS BIGINT),
    CAST(CASE WHEN p.held + r.size <= {target} THEN p.batch_id ELSE p.batch_id + 1 END AS BIGINT)
  FROM packed p JOIN numbered r ON r.unit = p.unit AND r.n = p.n + 1)
"""


SIZE_SQL = "(CASE WHEN event_id % 37 = 0 THEN 3000 ELSE octet_length(encode(props)) + octet_length(encode(event_type)) END)"
PACK_EVENTS_SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT user_id AS unit, event_id AS k, {SIZE_SQL} + {OVERHEAD} AS size,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
{packed_cte(TARGET)}"""


def packed_events(t: Tables) -> DataFrame:
    return batching.pack_batches(sized_events(t), ["user_id"], ["event_id"], "size", TARGET, OVERHEAD)


@query(PACK_EVENTS_SQL + "SELECT unit AS user_id, k AS event_id, batch_id FROM packed")
def pack_batches(t: Tables) -> DataFrame:
    return packed_events(t).select("user_id", "event_id", "batch_id")


@query(f"""
WITH RECURSIVE numbered AS (
  SELECT 'all' AS unit, event_id AS k, {SIZE_SQL} + {OVERHEAD} AS size, row_number() OVER (ORDER BY event_id) AS n FROM events),
{packed_cte(20_000)}
SELECT k AS event_id, batch_id FROM packed
""")
def pack_batches_hot_unit(t: Tables) -> DataFrame:
    # One unit holds all rows: it is packed exactly, in chunks of 512 keys.
    df = sized_events(t).withColumn("unit", F.lit("all"))
    df = batching.pack_batches(df, ["unit"], ["event_id"], "size", 20_000, OVERHEAD, span=512)
    return df.select("event_id", "batch_id")


@query(f"""
WITH RECURSIVE numbered AS (
  SELECT event_type AS unit, event_id AS k, {SIZE_SQL} + {OVERHEAD} AS size,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
{packed_cte(TARGET)}
SELECT unit AS event_type, k AS event_id, batch_id FROM packed
""")
def pack_batches_by_time(t: Tables) -> DataFrame:
    # A few large units in time order: each is cut where its own rows lie.
    df = sized_events(t, "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    df = batching.pack_batches(df, ["event_type"], ["ts", "event_id"], "size", TARGET, OVERHEAD, span=128)
    return df.select("event_type", "event_id", "batch_id")


@query(PACK_EVENTS_SQL + f"""
SELECT unit AS user_id, batch_id, count(*) AS records, CAST(sum(size - {OVERHEAD}) AS BIGINT) AS bytes
FROM packed JOIN (SELECT unit, k, size FROM numbered) USING (unit, k) GROUP BY ALL
""")
def batch_stats(t: Tables) -> DataFrame:
    return export.batch_stats(packed_events(t), ["user_id", "batch_id"], "size")


@query(PACK_EVENTS_SQL + """
SELECT unit AS user_id, CAST(max(batch_id) + 1 AS BIGINT) AS batches, count(*) AS records,
  CAST(count(*) // (max(batch_id) + 1) AS BIGINT) AS mean_records FROM packed GROUP BY unit
""")
def unit_stats(t: Tables) -> DataFrame:
    stats = export.batch_stats(packed_events(t), ["user_id", "batch_id"], "size")
    return export.unit_stats(stats, ["user_id"])


@query("WITH RECURSIVE " + LINES_SQL.strip().removeprefix("WITH ") + f"""
, numbered AS (SELECT source AS unit, doc_id * 1000000 + pos AS k, octet_length(encode(line)) + 200 AS size,
    row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) AS n FROM lines JOIN documents USING (doc_id)),
{packed_cte(64 * 1024)}
SELECT unit AS source, batch_id, count(*) AS records, min(k) AS first_key FROM packed GROUP BY ALL
""")
def pack_lines(t: Tables) -> DataFrame:
    # All lines of a source as one unit, ordered by document and place in it.
    df = t("documents").select("source", "doc_id", "text")
    rows = framing.explode_records(framing.frame_lines(df).drop("text")).withColumn("bytes", F.octet_length("log"))
    df = batching.pack_batches(rows.drop("log"), ["source"], ["doc_id", "pos"], "bytes", 64 * 1024, span=256)
    return df.groupBy("source", "batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.min(F.col("doc_id") * 1_000_000 + F.col("pos")).alias("first_key")
    )


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS batch_id FROM events")
def single_batches(t: Tables) -> DataFrame:
    df = t("events").select("user_id", "event_id")
    return batching.single_batches(df, ["user_id"], ["event_id"])


def halving_inputs(t: Tables) -> DataFrame:
    # A batch holds up to 64 consecutive events of a user.
    return sized_events(t).withColumn("batch", F.floor(F.col("event_id") / 640))


@query("""
WITH RECURSIVE numbered AS (
  SELECT user_id, event_id // 640 AS batch, event_id, event_type, {size} AS size,
    row_number() OVER (PARTITION BY user_id, event_id // 640 ORDER BY event_id) - 1 AS n FROM events),
whole AS (SELECT user_id, batch, 0 AS low, count(*) AS high FROM numbered GROUP BY ALL),
parts AS (
  SELECT user_id, batch, low, high,
    (SELECT 20 + sum(size) + 200 * count(DISTINCT event_type) FROM numbered x
      WHERE x.user_id = w.user_id AND x.batch = w.batch AND n >= low AND n < high) AS cost FROM whole w
  UNION ALL
  SELECT s.user_id, s.batch, s.low, s.high,
    (SELECT 20 + sum(size) + 200 * count(DISTINCT event_type) FROM numbered x
      WHERE x.user_id = s.user_id AND x.batch = s.batch AND n >= s.low AND n < s.high) AS cost
  FROM (SELECT user_id, batch, CASE side WHEN 0 THEN low ELSE low + (high - low) // 2 END AS low,
          CASE side WHEN 0 THEN low + (high - low) // 2 ELSE high END AS high
        FROM parts, (SELECT 0 AS side UNION ALL SELECT 1) WHERE cost > 900 AND high - low > 1) s)
SELECT n.user_id, n.event_id, CASE WHEN bad.batch IS NULL THEN CAST(r.request_id AS INTEGER) END AS request_id
FROM numbered n
JOIN (SELECT user_id, batch, low, high, row_number() OVER (PARTITION BY user_id, batch ORDER BY low) - 1 AS request_id
      FROM parts WHERE cost <= 900 OR high - low = 1) r
  ON r.user_id = n.user_id AND r.batch = n.batch AND n.n >= r.low AND n.n < r.high
LEFT JOIN (SELECT DISTINCT user_id, batch FROM parts WHERE cost > 900 AND high - low = 1) bad
  ON bad.user_id = n.user_id AND bad.batch = n.batch
""".replace("{size}", SIZE_SQL))
def split_by_size(t: Tables) -> DataFrame:
    df = batching.split_by_size(
        halving_inputs(t), ["user_id", "batch"], ["event_id"], 900, "size", ["event_type"]
    )
    return df.select("user_id", "event_id", "request_id")


@query(f"""
WITH s AS (SELECT event_id, user_id, event_id // 640 AS batch, {SIZE_SQL} AS size FROM events)
SELECT event_id, size > 2900 AS oversized, max(size) OVER (PARTITION BY user_id, batch) <= 2900 AS sendable FROM s
""")
def size_gate(t: Tables) -> DataFrame:
    df = gate(halving_inputs(t), 2900, "size", ["user_id", "batch"])
    return df.select("event_id", "oversized", "sendable")


# Payloads: events packed per user; the names come from the event.


def projected_events(t: Tables) -> DataFrame:
    rows = sized_events(t, "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    df = batching.pack_batches(rows, ["user_id"], ["event_id"], "size", TARGET, OVERHEAD)
    df = df.withColumn("log", F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(event_log()))
    meta = F.create_map(F.lit("event.type"), F.col("event_type"), F.lit("user"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")))
    df = name_records(df.withColumn("meta", meta), "{{ event.type }}", "{{ user }}")
    return build_body(df)


PROJECTED_SQL = PACK_EVENTS_SQL + f"""
, e AS (SELECT event_id, user_id, event_type, ts, CASE WHEN event_id % 2 = 0 THEN props ELSE {EVENT_LOG_SQL} END AS log FROM events),
p AS (SELECT unit AS user_id, batch_id, event_id, event_type AS application, 'u' || (user_id % 3) AS subsystem,
  {SEVERITY_SQL} AS severity, log, ts FROM packed JOIN e ON event_id = k)
"""


@query(PROJECTED_SQL + """
SELECT user_id, batch_id, count(*) AS records, count(*) AS entries,
  arg_min(severity, event_id) AS first_severity, arg_max(application, event_id) AS last_application,
  CAST(arg_min(epoch_us(ts) // 1000, event_id) AS VARCHAR) AS first_timestamp FROM p GROUP BY user_id, batch_id
""")
def to_singles(t: Tables) -> DataFrame:
    df = export.to_singles(projected_events(t), ["user_id", "batch_id"], ["event_id"])
    entries = F.from_json("payload", "entries array<struct<applicationName string, severity string, timestamp string>>").getField("entries")
    return df.select(
        "user_id", "batch_id", "records", F.size(entries).cast("bigint").alias("entries"),
        F.get(entries, F.lit(0))["severity"].alias("first_severity"),
        F.element_at(entries, -1)["applicationName"].alias("last_application"),
        F.get(entries, F.lit(0))["timestamp"].alias("first_timestamp"),
    )


@query(PROJECTED_SQL + """
SELECT user_id, batch_id, application, subsystem, count(*) AS records,
  CAST(arg_min(epoch_us(ts), event_id) * 1000 AS VARCHAR) AS first_nanos, arg_max(severity, event_id) AS last_severity
FROM p GROUP BY ALL
""")
def group_resources(t: Tables) -> DataFrame:
    df = export.group_resources(projected_events(t), ["user_id", "batch_id"], ["event_id"])
    schema = "scopeLogs array<struct<logRecords array<struct<timeUnixNano string, severityText string>>>>"
    records = F.get(F.from_json("resource_logs", schema).getField("scopeLogs"), F.lit(0))["logRecords"]
    return df.select(
        "user_id", "batch_id", "application", "subsystem", "records",
        F.get(records, F.lit(0))["timeUnixNano"].alias("first_nanos"),
        F.element_at(records, -1)["severityText"].alias("last_severity"),
    )


@query(PROJECTED_SQL + """
SELECT user_id, batch_id, count(DISTINCT application) AS resources, CAST(count(*) AS BIGINT) AS records,
  min(application) AS first_application, 'lab' AS attribute FROM p GROUP BY user_id, batch_id
""")
def to_resource_logs(t: Tables) -> DataFrame:
    df = export.to_resource_logs(
        projected_events(t), ["user_id", "batch_id"], ["event_id"], record_attributes={"site": "lab"}
    )
    value = "struct<stringValue string>"
    schema = f"""resourceLogs array<struct<resource struct<attributes array<struct<key string, value {value}>>>,
        scopeLogs array<struct<logRecords array<struct<attributes array<struct<key string, value {value}>>>>>>>>"""
    first = F.get(F.from_json("payload", schema).getField("resourceLogs"), F.lit(0))
    record = F.get(F.get(first["scopeLogs"], F.lit(0))["logRecords"], F.lit(0))
    return df.select(
        "user_id", "batch_id", "resources", "records",
        F.get(first["resource"]["attributes"], F.lit(0))["value"]["stringValue"].alias("first_application"),
        F.get(record["attributes"], F.lit(0))["value"]["stringValue"].alias("attribute"),
    )


# Grouping whole documents: one resource per batch, or one per record.

GROUPED_SQL = f"""
WITH RECURSIVE numbered AS (SELECT source AS unit, doc_id AS k, octet_length(encode(text)) + 200 AS size,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
{packed_cte(64 * 1024)}
SELECT unit AS source, batch_id, {{resources}} AS resources, CAST(count(*) AS BIGINT) AS records FROM packed GROUP BY unit, batch_id
"""


def grouped_documents(t: Tables, application: Column) -> DataFrame:
    df = t("documents").select("source", "doc_id", "text", F.octet_length("text").alias("bytes"))
    df = batching.pack_batches(df, ["source"], ["doc_id"], "bytes", 64 * 1024)
    df = df.select(
        "source", "batch_id", "doc_id", application.alias("application"), F.lit("docs").alias("subsystem"),
        F.lit("Info").alias("severity"), json_quote(F.col("text")).alias("body"), F.timestamp_micros("doc_id").alias("ts"),
    )
    return export.to_resource_logs(df, ["source", "batch_id"], ["doc_id"]).drop("payload")


@query(GROUPED_SQL.format(resources="CAST(1 AS BIGINT)"))
def group_one_resource(t: Tables) -> DataFrame:
    return grouped_documents(t, F.lit("all"))


@query(GROUPED_SQL.format(resources="count(*)"))
def group_many_resources(t: Tables) -> DataFrame:
    return grouped_documents(t, F.col("doc_id").cast("string"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN json_extract_string(props, '$.k') END AS kv_int,
  CASE event_id % 4 WHEN 1 THEN event_type END AS text, CASE event_id % 4 WHEN 2 THEN CAST(event_id AS VARCHAR) END AS int,
  CASE event_id % 4 WHEN 3 THEN 'null' END AS first, CASE event_id % 4 WHEN 3 THEN '18446744073709551615' END AS huge,
  CASE event_id % 4 WHEN 3 THEN 'true' END AS flag, CASE event_id % 4 WHEN 3 THEN '2.5' END AS float FROM events
""")
def to_any_value(t: Tables) -> DataFrame:
    case = F.col("event_id") % 4
    body = (
        F.when(case == 0, F.col("props")).when(case == 1, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .when(case == 2, F.col("event_id").cast("string")).otherwise(F.lit("[null, 18446744073709551615, true, 2.5]"))
    )
    df = t("events").select("event_id", otlp.to_any_value(body).alias("v"))
    paths = {
        "kv_int": "$.kvlistValue.values[0].value.intValue", "text": "$.stringValue", "int": "$.intValue",
        "first": "$.arrayValue.values[0].stringValue", "huge": "$.arrayValue.values[1].stringValue",
        "flag": "$.arrayValue.values[2].boolValue", "float": "$.arrayValue.values[3].doubleValue",
    }
    return df.select("event_id", *[F.get_json_object("v", p).alias(n) for n, p in paths.items()])


# Failures and outcomes: an order is a unit, its lines are the batches sent.


@query("""
WITH b AS (SELECT l_orderkey AS unit, l_linenumber AS batch_id, count(*) AS attempts,
    bool_or(l_returnflag <> 'R' AND l_quantity < 48) AS ok,
    bool_or(l_returnflag <> 'R' AND l_quantity < 48 AND l_discount > 0.05) AS warned FROM lineitem GROUP BY ALL)
SELECT unit, bool_and(ok) AS delivered, count(*) AS batches, count(*) FILTER (NOT ok) AS failed_batches,
  count(*) FILTER (warned) AS warnings, CAST(sum(attempts) AS BIGINT) AS attempts FROM b GROUP BY unit
""")
def delivery_outcome(t: Tables) -> DataFrame:
    attempts = t("lineitem").select(
        F.col("l_orderkey").alias("unit"), F.col("l_linenumber").alias("batch_id"), F.lit(1).alias("attempt"),
        F.when(F.col("l_returnflag") == "R", "unavailable").otherwise("ok").alias("status"),
        F.when(F.col("l_quantity") >= 48, 1).alias("rejected"), (F.col("l_discount") > 0.05).alias("message_present"),
    )
    return export.delivery_outcome(attempts, ["unit"])


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 1 AND event_id % 6 >= 3 THEN 'dead' ELSE 'retry' END AS route,
  CAST(CASE WHEN event_id % 2 = 0 THEN 0 WHEN event_id % 6 >= 3 THEN event_id % 6 ELSE event_id % 6 + 1 END AS INTEGER) AS retry,
  event_type AS last_error,
  CASE WHEN NOT (event_id % 2 = 1 AND event_id % 6 >= 3) THEN epoch_us(ts) + 900000000 END AS not_before
FROM events
""")
def route_failures(t: Tables) -> DataFrame:
    df = t("events").select(
        "event_id", (F.col("event_id") % 2 == 1).alias("from_retry"), (F.col("event_id") % 6).cast("string").alias("retry"),
        F.col("event_type").alias("error"), F.col("ts").cast("timestamp").alias("ts"),
    )
    df = failures.route_failures(df)
    return df.select("event_id", "route", "retry", "last_error", F.unix_micros("not_before").alias("not_before"))


@query("""
SELECT event_id FROM events
WHERE NOT (event_id % 2 = 1 AND event_id % 6 >= 3)
  AND epoch_us(ts) + 900000000 <= epoch_us(TIMESTAMP '2024-01-10 00:00:00')
""")
def due_retries(t: Tables) -> DataFrame:
    # Failures are written to a retry table, the dead ones left out; the next run reads what
    # is due.
    df = t("events").select(
        "event_id", (F.col("event_id") % 2 == 1).alias("from_retry"), (F.col("event_id") % 6).cast("string").alias("retry"),
        F.lit("failed").alias("error"), F.col("ts").cast("timestamp").alias("ts"),
    )
    path = work_dir(t.spark, "retry")
    failures.route_failures(df).filter("route = 'retry'").write.parquet(path)
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return failures.due(t.spark.read.parquet(path), now).select("event_id")


@query("""
SELECT event_id, 'dead/failed-events/' || strftime(to_timestamp(epoch_us(ts) // 1000000 // 21600 * 21600), '%Y/%m/%d/%H') || '/' || CASE event_id % 3
    WHEN 0 THEN 'bucket/' || event_type || '+' || event_id ELSE md5(event) || '.json' END AS object_path,
  CASE event_id % 3 WHEN 0 THEN md5(props) ELSE md5(event) END AS digest
FROM (SELECT *, CASE event_id % 3 WHEN 1 THEN props ELSE
  '{"Records":[{"s3":{"bucket":{"name":"bucket"},"object":{"key":"' || event_type || '+' || event_id || '"}}}]}' END AS event FROM events)
""")
def store_dead(t: Tables) -> DataFrame:
    # Notifications with a readable object, other events, notifications whose object is gone.
    # They died in a run that takes place every six hours.
    run = F.timestamp_seconds(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 21_600_000_000) * 21_600)
    notice = F.concat(
        F.lit('{"Records":[{"s3":{"bucket":{"name":"bucket"},"object":{"key":"'), "event_type", F.lit("+"),
        F.col("event_id").cast("string"), F.lit('"}}}]}'),
    )
    df = t("events").select(
        "event_id", run.alias("ts"),
        F.when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(notice).alias("event"),
        F.when(F.col("event_id") % 3 == 0, F.encode("props", "UTF-8")).alias("content"),
    )
    path = work_dir(t.spark, "dead")
    failures.store_dead(failures.dead_objects(df, "dead"), path)
    stored = t.spark.read.parquet(path)
    return stored.select("event_id", "object_path", F.md5("data").alias("digest"))


@query(PACK_EVENTS_SQL + """
SELECT unit AS user_id, true AS delivered, CAST(max(batch_id) + 1 AS BIGINT) AS batches FROM packed GROUP BY unit
""")
def deliver_requests(t: Tables) -> DataFrame:
    requests = export.to_singles(projected_events(t), ["user_id", "batch_id"], ["event_id"])
    sink = file_sink(work_dir(t.spark, "requests"), ["user_id", "batch_id"], parallelism=4)
    return deliver(requests, sink, ["user_id"]).select("user_id", "delivered", "batches")


@query(PACK_EVENTS_SQL + """
SELECT unit AS user_id, true AS delivered, CAST(max(batch_id) + 1 AS BIGINT) AS batches,
  CAST(max(batch_id) + 1 AS BIGINT) AS copies, count(*) AS records FROM packed GROUP BY unit
""")
def deliver_source(t: Tables) -> DataFrame:
    # Requests are sent by a data source, a third of them once more: one copy of each is left.
    keys = ["user_id", "batch_id"]
    requests = staged(export.to_singles(projected_events(t), keys, ["event_id"]), "requests")
    path = work_dir(t.spark, "sent")
    outcome = deliver(requests, lambda df: send_requests(df, path, keys), ["user_id"])
    send_requests(requests.filter("user_id % 3 = 0"), path, keys)
    stored = read_delivered(t.spark, path, requests, keys).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("records").alias("records"))
    return outcome.select("user_id", "delivered", "batches").join(stored, "user_id")


# Whole pipelines.


def log_rows(t: Tables) -> DataFrame:
    log = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    meta = F.create_map(F.lit("kafka.topic"), F.col("event_type"))
    return t("events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("unit"), F.col("event_id").alias("pos"),
        log.alias("log"), meta.alias("meta"),
    )


LOG_COUNTS_SQL = """
SELECT event_type AS application, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS subsystem,
  CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Info' END AS severity, count(*) AS records,
  count(*) AS with_topic, CAST(sum(user_id) AS BIGINT) AS users
FROM events WHERE event_type <> 'signup' GROUP BY ALL
"""


@query(LOG_COUNTS_SQL)
def log_counts(t: Tables) -> DataFrame:
    """Flagship: records → filter → names, severity → body → counts per resource."""
    df = drop_blank(block_pattern(log_rows(t), '"event_type":"signup"'))
    parity = F.when(F.regexp_extract("unit", "([0-9]+)$", 1).cast("bigint") % 2 == 0, "even").otherwise("odd")
    df = with_json(df.withColumn("parity", parity))
    df = name_records(df, "{{ $.event_type }}", F.col("parity"))
    df = build_body(df, ["topic_name"], {"env": "prod"})
    return df.groupBy("application", "subsystem", "severity").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.get_json_object("body", "$.topic_name") == F.col("application")).alias("with_topic"),
        F.sum(F.get_json_object("body", "$.message.user_id").cast("bigint")).alias("users"),
    )


SHIP_SQL = LINES_SQL + f"""
, open AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n FROM lines
  WHERE NOT regexp_matches(line, 'token = ')),
sent AS (SELECT doc_id, n // 2 AS pos, line AS log FROM open WHERE n % 2 = 0 AND {NOT_BLANK_SQL})
"""


def shipped_documents(t: Tables, **settings) -> DataFrame:
    key = F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".log"))
    df = t("documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("unit"), "text", object_meta(F.col("source"), key).alias("meta")
    )
    cfg = LogConfig(
        "S3", subsystem="{{ s3.object.key | r'in/([0-9]+)' }}", block="token = ", sample=2,
        add_metadata=["s3.bucket"], batch_target=4000, **settings,
    )
    return ship_logs(df, cfg)


@query("""
SELECT doc_id % 4 AS kind, CASE doc_id % 4 WHEN 0 THEN 'nothing could be decompressed' ELSE 'not UTF-8' END AS error, count(*) AS n
FROM documents WHERE doc_id % 4 < 2 GROUP BY ALL
""")
def ship_failures(t: Tables) -> DataFrame:
    # Broken compression, bytes that are not UTF-8, and objects that are fine.
    raw, kind = F.encode("text", "UTF-8"), F.col("doc_id") % 4
    content = F.when(kind == 0, F.concat(F.unhex(F.lit("1F8B0800")), F.unhex(F.lit("FFFF")))).when(
        kind == 1, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    name = F.concat(F.lit("o"), F.col("doc_id").cast("string"), F.when(kind == 0, ".gz").otherwise(".log"))
    objects = decode_objects(t("documents").select(name.alias("unit"), content.alias("content")))
    failed = failed_rows(objects)
    number = F.regexp_extract("unit", "[0-9]+", 0).cast("bigint")
    return failed.groupBy((number % 4).alias("kind"), "error").agg(F.count(F.lit(1)).alias("n"))


@query(SHIP_SQL + f"""
SELECT doc_id, {SEVERITY_SQL} AS severity, source AS application, CAST(doc_id AS VARCHAR) AS subsystem,
  md5(log) AS message, source AS bucket FROM sent JOIN documents USING (doc_id)
""")
def ship_lines(t: Tables) -> DataFrame:
    # Lines of objects, as they are read one by one, give what whole objects give.
    key = F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".log"))
    lines = t("documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("unit"), object_meta(F.col("source"), key).alias("meta"),
        F.posexplode(F.split("text", "\n")).alias("seq", "log"),
    )
    lines = lines.select("*", F.floor(F.col("seq") / 16).alias("block"))
    cfg = LogConfig(
        "S3", subsystem="{{ s3.object.key | r'in/([0-9]+)' }}", block="token = ", sample=2,
        add_metadata=["s3.bucket"], batch_target=4000,
    )
    return ship_logs(lines, cfg).select(
        "doc_id", "severity", "application", "subsystem", F.md5(F.get_json_object("body", "$.message")).alias("message"),
        F.get_json_object("body", "$['s3.bucket']").alias("bucket"),
    )


@query(SHIP_SQL + f"""
SELECT doc_id, pos, {SEVERITY_SQL} AS severity, source AS application, CAST(doc_id AS VARCHAR) AS subsystem,
  md5(log) AS message, source AS bucket FROM sent JOIN documents USING (doc_id)
""")
def ship_objects(t: Tables) -> DataFrame:
    return shipped_documents(t).select(
        "doc_id", "pos", "severity", "application", "subsystem", F.md5(F.get_json_object("body", "$.message")).alias("message"),
        F.get_json_object("body", "$['s3.bucket']").alias("bucket"),
    )


@query(SHIP_SQL.replace("WITH pieces", "WITH RECURSIVE pieces") + f"""
, numbered AS (SELECT doc_id AS unit, pos AS k, octet_length(encode(log)) + 200 AS size,
    row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM sent),
{packed_cte(4000)}
SELECT unit AS doc_id, batch_id, count(*) AS records, min(k) AS first_pos FROM packed GROUP BY ALL
""")
def ship_batches(t: Tables) -> DataFrame:
    return shipped_documents(t).groupBy("doc_id", "batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.min("pos").alias("first_pos")
    )


@query(SHIP_SQL + """
SELECT doc_id, count(*) + count(*) FILTER (len(log) > 100) AS records FROM sent GROUP BY doc_id
""")
def ship_transformed(t: Tables) -> DataFrame:
    # A user's function writes long records twice.
    def fn(event):
        return [event, {"long": event}] if isinstance(event, str) and len(event) > 100 else [event]

    return shipped_documents(t, transform=fn).groupBy("doc_id").agg(F.count(F.lit(1)).alias("records"))


@query(f"""
WITH l AS (SELECT user_id, event_id, event_type, {SEVERITY_SQL} AS severity FROM
  (SELECT user_id, event_id, event_type, to_json({{'event_type': event_type, 'props': props}}) AS log FROM events))
SELECT 'user-' || user_id AS unit, event_type AS application, severity, count(*) AS records FROM l GROUP BY ALL
""")
def stream_ship(t: Tables) -> DataFrame:
    # The event table as a file stream, in three micro-batches; each is packed and written once. A unit lies in
    # one file, and a micro-batch has a file for each core.
    source = work_dir(t.spark, "stream-in")
    files = t.spark.sparkContext.defaultParallelism
    log_rows(t).repartition(3 * files, "unit").write.parquet(source)
    schema = t.spark.read.parquet(source).schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    cfg = LogConfig("Kafka", application="{{ kafka.topic }}", subsystem="events", batch_target=20_000)
    out = work_dir(t.spark, "stream-out")
    run = ship_stream(stream, lambda df: ship_logs(df, cfg), out, work_dir(t.spark, "stream-checkpoint"))
    run.awaitTermination()
    return t.spark.read.parquet(out).groupBy("unit", "application", "severity").agg(F.count(F.lit(1)).alias("records"))


@query("""
SELECT conv_id, turn, '/chat/' || (conv_id % 4) AS subsystem, md5(text) AS text,
  n_name AS nation, 'shop' AS application
FROM conversations LEFT JOIN nation ON n_nationkey = conv_id % 4
""")
def ship_subscriptions(t: Tables) -> DataFrame:
    tags = t("nation").select(
        F.concat(F.lit("/chat/"), F.col("n_nationkey").cast("string")).alias("log_group"),
        F.create_map(F.lit("nation"), F.col("n_name")).alias("tags"), F.timestamp_micros(F.lit(0)).alias("fetched_at"),
    )
    df = read_cloudwatch(subscription_events(t)).withColumn("unit", F.concat_ws("/", F.col("conv_id").cast("string"), F.col("block").cast("string")))
    df = ship_logs(df, LogConfig("CloudWatch", application="shop", batch_target=4000), tags)
    text = F.when(F.startswith("body", F.lit('"')), F.get_json_object(F.concat(F.lit('{"text":'), "body", F.lit("}")), "$.text"))
    return df.select(
        "conv_id", (F.col("block") * 64 + F.col("pos")).alias("turn"), "subsystem", "application",
        F.md5(F.coalesce(text, F.get_json_object("body", "$.text"))).alias("text"),
        F.get_json_object("body", "$['cw.tags'].nation").alias("nation"),
    )
