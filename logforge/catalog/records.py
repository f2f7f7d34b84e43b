"""Queries: names, severity, bodies, labels, transforms, group tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.catalog.framing import LINES_SQL, NOT_BLANK_SQL, documents
from logforge.catalog.registry import Tables, query
from logforge.functions import labels as label_functions
from logforge.functions.naming import severity as severity_of
from logforge.functions.naming import severity_number
from logforge.functions.text import json_at, with_json
from logforge.operators import body as bodies
from logforge.operators import framing
from logforge.operators import transform as transforms
from logforge.operators.filters import drop_blank
from logforge.operators.lookup import join_group_tags as join_tags
from logforge.operators.table_function import register_transforms

# A log text per event: every eighth kind of wording, then the JSON properties.
WORDS = ["WARNING", "Trace", "DEBUG info", "PANIC", "all fine", "Verbose debug", "warn: error", "Critical"]
EVENT_LOG_SQL = "(CASE event_id % 8 {} END || ' ' || event_type || ' ' || props)".format(
    " ".join(f"WHEN {i} THEN '{word}'" for i, word in enumerate(WORDS))
)
SEVERITY_SQL = """CASE
  WHEN contains(lower(log), 'fatal') OR contains(lower(log), 'panic') OR contains(lower(log), 'critical') THEN 'Critical'
  WHEN contains(lower(log), 'error') THEN 'Error' WHEN contains(lower(log), 'warn') THEN 'Warn'
  WHEN contains(lower(log), 'info') THEN 'Info'
  WHEN contains(lower(log), 'verbose') OR contains(lower(log), 'trace') THEN 'Verbose'
  WHEN contains(lower(log), 'debug') THEN 'Debug' ELSE 'Info' END"""


def event_log() -> Column:
    """The log text of an event."""
    word = F.get(F.array(*[F.lit(w) for w in WORDS]), (F.col("event_id") % 8).cast("int"))
    return F.concat_ws(" ", word, "event_type", "props")


def event_logs(t: Tables) -> DataFrame:
    return t("events").select("event_id", "event_type", event_log().alias("log"))


@query(f"""
SELECT event_id, severity, CASE severity WHEN 'Critical' THEN 21 WHEN 'Error' THEN 17 WHEN 'Warn' THEN 13
  WHEN 'Info' THEN 9 WHEN 'Debug' THEN 5 ELSE 1 END AS number
FROM (SELECT event_id, {SEVERITY_SQL} AS severity FROM (SELECT event_id, {EVENT_LOG_SQL} AS log FROM events))
""")
def severity(t: Tables) -> DataFrame:
    df = event_logs(t).select("event_id", severity_of(F.col("log")).alias("severity"))
    return df.withColumn("number", severity_number(F.col("severity")))


@query(LINES_SQL + f"""
SELECT doc_id, {SEVERITY_SQL} AS severity, count(*) AS n
FROM (SELECT doc_id, line AS log FROM lines WHERE {NOT_BLANK_SQL}) GROUP BY ALL
""")
def severity_lines(t: Tables) -> DataFrame:
    rows = drop_blank(framing.explode_records(framing.frame_lines(documents(t)).drop("text")))
    rows = rows.select("doc_id", severity_of(F.col("log")).alias("severity"))
    return rows.groupBy("doc_id", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, 'Info' AS severity FROM events")
def severity_off(t: Tables) -> DataFrame:
    return event_logs(t).select("event_id", severity_of(F.col("log"), detect=False).alias("severity"))


@query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'k' WHEN 4 THEN 'k' ELSE json_extract_string(props, '$.k') END AS bare,
  CASE event_id % 5 WHEN 0 THEN 'unknown-subsystem' WHEN 4 THEN 'unknown-subsystem'
    WHEN 3 THEN 'true' ELSE event_type END AS nested
FROM events
""")
def json_name(t: Tables) -> DataFrame:
    # Objects; trailing text makes a record no JSON; arrays have no names.
    def build(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    k = F.get_json_object("props", "$.k")
    case = F.col("event_id") % 5
    log = (
        F.when(case == 0, build(F.col("props"), " tail"))
        .when(case == 4, build("[", F.col("props"), "]"))
        .when(case == 3, build('{"k":', k, ',"a":{"type":true}}'))
        .otherwise(build('{"k":"', k, '","a":{"type":"', F.col("event_type"), '"}} '))
    )
    df = t("events").select("event_id", log.alias("log"), F.create_map().cast("map<string,string>").alias("meta"))
    df = bodies.name_records(df, "k", "{{ $.a.type }}")
    return df.select("event_id", F.col("application").alias("bare"), F.col("subsystem").alias("nested"))


HOST = r"https?://(?:m\.|blog\.)([^/?#]+)|https?://([^/?#]+)"


@query(rf"""
SELECT page_id,
  coalesce(nullif(regexp_extract(url, '{HOST}', 1), ''), nullif(regexp_extract(url, '{HOST}', 2), ''), url) AS application,
  CASE WHEN page_id % 3 = 0 THEN 'unknown-subsystem' ELSE 'page ' || page_id END AS subsystem
FROM pages
""")
def resolve_name(t: Tables) -> DataFrame:
    number = F.concat(F.lit("page "), F.col("page_id").cast("string"))
    meta = F.create_map(
        F.lit("page.url"), F.col("url"), F.lit("page.id"), F.when(F.col("page_id") % 3 != 0, number)
    )
    df = t("pages").select("page_id", F.col("html").alias("log"), meta.alias("meta"))
    df = bodies.name_records(df, f"{{{{ page.url | r'{HOST}' }}}}", "{{page.id}}")
    return df.select("page_id", "application", "subsystem")


@query("SELECT page_id, url AS no_match, 'my-app' AS plain, '{{ Bad Key }} x' AS half, 'unknown-application' AS broken FROM pages")
def resolve_name_fallback(t: Tables) -> DataFrame:
    df = t("pages").select(
        "page_id", F.col("html").alias("log"), F.create_map(F.lit("page.url"), F.col("url")).alias("meta")
    )
    for out, name in {
        "no_match": "{{ page.url | r'ftp://(.*)' }}", "plain": "my-app", "half": "{{ Bad Key }} x", "broken": "{{ Bad Key }}",
    }.items():
        df = bodies.name_records(df, name, "").withColumnRenamed("application", out).drop("subsystem", "severity")
    return df.select("page_id", "no_match", "plain", "half", "broken")


@query("""
SELECT c_custkey, c_name AS name, c_mktsegment || '=' || c_nationkey AS segment, '' AS empty, 3 AS labels
FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT c_custkey, c_name, c_mktsegment || '=' || c_nationkey, NULL, 2 FROM customer WHERE c_custkey % 2 = 1
""")
def parse_labels(t: Tables) -> DataFrame:
    # Blanks around, a value with "=", a part without it, an empty key, a repeated key.
    text = F.concat(
        F.lit(" name = old , name= "), "c_name", F.lit(" ,,flag, =x,segment="), "c_mktsegment", F.lit("="),
        F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, ",empty= ").otherwise(""),
    )
    df = t("customer").select("c_custkey", label_functions.parse_labels(text).alias("m"))
    return df.select(
        "c_custkey", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("name", "segment", "empty")],
        F.size("m").alias("labels"),
    )


# Five kinds of records, by id: object, text, array, number, object again; tags on some.
BODY_CASES = {
    "both": (["event.type", "sqs.event.id", "stream_name"], {"env": "prod", "team": "a=b"}),
    "plain": ([], {}),
}


def body_records(t: Tables) -> DataFrame:
    case = F.col("event_id") % 5
    log = (
        F.when(case == 0, F.col("props")).when(case == 1, F.concat(F.col("event_type"), F.lit(' said "hi"\n')))
        .when(case == 2, F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]")))
        .when(case == 3, F.col("event_id").cast("string")).otherwise(F.lit(" { } "))
    )
    tags = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("event_type").alias("type"))))
    pairs = F.map_filter(
        F.create_map(
            F.lit("sqs.event.id"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("m"), F.col("event_id").cast("string"))),
            F.lit("cw.log.stream"), F.lit(None).cast("string"), F.lit("cw.tags"), tags,
        ),
        lambda k, v: v.isNotNull(),
    )
    return t("events").select("event_id", log.alias("log"), pairs.alias("meta"))


def body_fields(df: DataFrame) -> DataFrame:
    paths = {
        "k": "$.k", "message_k": "$.message.k", "message": "$.message", "text": "$.text", "tag": "$['cw.tags'].type",
        "id": "$['sqs.event.id']", "env": "$.env", "team": "$.team", "first": "$[0]", "message_first": "$.message[0]",
    }
    df = df.select(
        "event_id", "body", *[F.get_json_object("body", p).alias(n) for n, p in paths.items()]
    )
    whole = F.when(~F.startswith(F.trim("body"), F.lit("{")), F.col("body"))
    message = F.when(F.col("message").rlike(r"^[\[{]"), None).otherwise(F.col("message"))
    return df.withColumn("whole", F.when(~whole.startswith("["), whole)).withColumn("message", message).drop("body")


BODY_SQL = """
SELECT event_id, {k} AS k, {message_k} AS message_k, {message} AS message, {text} AS text,
  CASE WHEN event_id % 2 = 0 THEN event_type END AS tag, {id} AS id, {env} AS env, {team} AS team,
  {first} AS first, {message_first} AS message_first, {whole} AS whole FROM events
"""
NONE = "CAST(NULL AS VARCHAR)"
SAID = "event_type || ' said \"hi\"' || chr(10)"


@query(BODY_SQL.format(
    k=NONE, message_k="CASE WHEN event_id % 5 = 0 THEN json_extract_string(props, '$.k') END",
    message=f"CASE event_id % 5 WHEN 1 THEN {SAID} WHEN 3 THEN CAST(event_id AS VARCHAR) END", text=NONE,
    id="CASE WHEN event_id % 3 = 0 THEN 'm' || event_id END", env="'prod'", team="'a=b'", first=NONE,
    message_first="CASE WHEN event_id % 5 = 2 THEN CAST(event_id AS VARCHAR) END", whole=NONE,
))
def build_body(t: Tables) -> DataFrame:
    keys, labels = BODY_CASES["both"]
    return body_fields(bodies.build_body(body_records(t), keys, labels))


@query(BODY_SQL.format(
    k="CASE WHEN event_id % 5 = 0 THEN json_extract_string(props, '$.k') END", message_k=NONE,
    message="CASE WHEN event_id % 10 = 8 THEN CAST(event_id AS VARCHAR) END",
    text=f"CASE WHEN event_id % 10 = 6 THEN {SAID} END", id=NONE, env=NONE, team=NONE,
    first="CASE WHEN event_id % 10 = 7 THEN CAST(event_id AS VARCHAR) END",
    message_first="CASE WHEN event_id % 10 = 2 THEN CAST(event_id AS VARCHAR) END",
    whole="""CASE event_id % 10 WHEN 3 THEN CAST(event_id AS VARCHAR)
      WHEN 1 THEN '"' || event_type || ' said \\"hi\\"\\n"' END""",
))
def build_body_tags_only(t: Tables) -> DataFrame:
    return body_fields(bodies.build_body(body_records(t)))


# Transforms: JSON records that hold an array of events of one user.


def nested_records(t: Tables) -> DataFrame:
    item = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("level"), F.lit("x").alias("msg")
    )
    df = t("events").groupBy("user_id", F.floor(F.col("event_id") / 64).alias("block")).agg(
        F.sort_array(F.collect_list(item)).alias("logs"), F.min("event_id").alias("low")
    )
    case = F.col("user_id") % 4
    text = F.to_json(F.struct("logs"))
    log = (
        F.when(case == 0, F.to_json(F.struct(F.col("low").alias("logs"))))
        .when(case == 1, F.concat(F.lit("text "), F.col("low").cast("string"))).otherwise(text)
    )
    return df.select("user_id", "block", log.alias("log"))


def nested_fields(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id", "block", F.col("transform_seq").cast("bigint").alias("seq"),
        F.get_json_object("log", "$.id").cast("bigint").alias("id"), F.get_json_object("log", "$.level").alias("level"),
        F.when(F.col("user_id") % 4 == 1, F.col("log")).alias("text"),
        F.get_json_object("log", "$.logs").cast("bigint").alias("whole"),
    )


NESTED_SQL = """
SELECT user_id, CAST(event_id // 64 AS BIGINT) AS block,
  row_number() OVER (PARTITION BY user_id, event_id // 64 ORDER BY event_id) - 1 AS seq,
  event_id AS id, event_type AS level, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS BIGINT) AS whole
FROM events WHERE user_id % 4 >= 2 {drop}
UNION ALL
SELECT user_id, CAST(event_id // 64 AS BIGINT), 0, NULL, NULL,
  CASE WHEN user_id % 4 = 1 THEN 'text ' || min(event_id) END, CASE WHEN user_id % 4 = 0 THEN min(event_id) END
FROM events WHERE user_id % 4 < 2 GROUP BY user_id, event_id // 64
"""


@query(NESTED_SQL.format(drop=""))
def unnest(t: Tables) -> DataFrame:
    return nested_fields(transforms.unnest(nested_records(t)))


@query(NESTED_SQL.format(drop="AND event_type <> 'view'"))
def unnest_filter(t: Tables) -> DataFrame:
    def is_view(item: Column) -> Column:
        return F.try_variant_get(item, "$.level", "string") == "view"

    return nested_fields(transforms.unnest(nested_records(t), drop=is_view))


@query(NESTED_SQL.format(drop=""))
def transform_unnest(t: Tables) -> DataFrame:
    # The same as "unnest", as a user's Python function.
    def fn(event):
        if "logs" in event and isinstance(event["logs"], list):
            return event["logs"]
        return [event]

    return nested_fields(transforms.transform_records(nested_records(t), fn))


def event_json(t: Tables) -> DataFrame:
    log = F.to_json(F.struct("event_id", F.col("event_type").alias("level"), F.col("props").alias("message")))
    log = F.when(F.col("event_id") % 9 == 0, F.concat_ws(" ", "event_type", "props")).otherwise(log)
    return t("events").select("event_id", "event_type", "props", log.alias("log"))


TRANSFORM_SQL = """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN event_type || ' ' || props END AS text,
  CASE WHEN event_id % 9 <> 0 THEN event_type END AS level,
  CASE WHEN event_id % 9 = 0 OR event_type IN ('error', 'signup') THEN NULL ELSE 'true' END AS processed,
  CASE WHEN event_id % 9 = 0 THEN 'TypeError' WHEN event_type = 'error' THEN 'KeyError'
       WHEN event_type = 'signup' THEN 'TypeError' END AS failure, n
FROM events, (SELECT 0 AS n UNION ALL SELECT 1)
WHERE (n = 0 AND NOT (event_type = 'view' AND event_id % 9 <> 0)) OR
      (n = 1 AND event_type = 'purchase' AND event_id % 9 <> 0)
"""


def reshape(event):
    """Drops views, doubles purchases, fails on errors and on text, returns no list for signups."""
    level = event["level"]
    if level == "error":
        return [event["missing"]]
    if level == "signup":
        return event
    event["processed"] = True
    return [] if level == "view" else [event] * (2 if level == "purchase" else 1)


def reshaped(df: DataFrame) -> DataFrame:
    plain = F.col("event_id") % 9 == 0
    return df.select(
        "event_id", F.when(plain, F.col("log")).alias("text"),
        F.get_json_object("log", "$.level").alias("level"), F.get_json_object("log", "$.processed").alias("processed"),
        F.substring_index("transform_error", ":", 1).alias("failure"), F.col("transform_seq").alias("n"),
    )


@query(TRANSFORM_SQL)
def transform_records(t: Tables) -> DataFrame:
    return reshaped(transforms.transform_records(event_json(t), reshape))


@query("""
SELECT event_id, CASE event_id % 6
    WHEN 0 THEN 'NaN' WHEN 1 THEN CAST(9007199254740993 + event_id AS VARCHAR) WHEN 2 THEN event_id || '.0'
    WHEN 3 THEN '{"v":NaN}' WHEN 4 THEN '[' || event_id || ',null,true]' ELSE '{"a":1}' END AS log,
  CASE event_id % 6 WHEN 4 THEN 'ValueError' WHEN 5 THEN 'TypeError' END AS failure
FROM events
""")
def transform_values(t: Tables) -> DataFrame:
    # Whole numbers of any size and fractions stay as they are; text that is no strict JSON stays
    # text; results that are not finite, or objects with keys that are no text, are errors.
    def fn(event):
        if isinstance(event, list):
            return [float("inf")]
        return [{1: 2}] if isinstance(event, dict) else [event]

    case, number = F.col("event_id") % 6, F.col("event_id").cast("string")
    log = (
        F.when(case == 0, "NaN").when(case == 1, (F.col("event_id") + 9007199254740993).cast("string"))
        .when(case == 2, F.concat(number, F.lit(".0"))).when(case == 3, '{"v":NaN}')
        .when(case == 4, F.concat(F.lit("["), number, F.lit(",null,true]"))).otherwise('{"a":1}'))
    df = transforms.transform_records(t("events").select("event_id", log.alias("log")), fn)
    return df.select("event_id", "log", F.substring_index("transform_error", ":", 1).alias("failure"))


@query("SELECT event_id, props AS log, 'fn is not callable' AS failure FROM events")
def transform_unusable(t: Tables) -> DataFrame:
    # What is no function leaves every record as it is, and says so.
    df = transforms.transform_records(t("events").select("event_id", F.col("props").alias("log")), {"no": "function"})
    return df.select("event_id", "log", F.col("transform_error").alias("failure"))


@query(TRANSFORM_SQL)
def transform_sql(t: Tables) -> DataFrame:
    # The same function, called from SQL with a table.
    register_transforms(t.spark, "transform_logs", reshape=reshape)
    df = t.spark.sql("SELECT * FROM transform_logs(TABLE({events}), fn => 'reshape')", events=event_json(t))
    return reshaped(df)


@query("SELECT event_id, event_type FROM events WHERE event_id % 9 = 0 OR event_type <> 'view'")
def drop_where(t: Tables) -> DataFrame:
    return transforms.drop_where(event_json(t), ".level", "view").select("event_id", "event_type")


@query("""
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN event_type END AS level,
  CASE WHEN event_id % 9 <> 0 THEN 'true' END AS processed, CASE WHEN event_id % 9 <> 0 THEN 'forge' END AS source,
  CASE WHEN event_id % 9 <> 0 AND event_type IN ('error', 'signup') THEN 'true' END AS flagged,
  CASE WHEN event_id % 9 = 0 THEN event_type || ' ' || props END AS text
FROM events
""")
def add_fields(t: Tables) -> DataFrame:
    df = transforms.add_fields(event_json(t), {"processed": True, "source": "forge"})
    level = json_at(F.col("_json"), ".level").cast("string")
    df = transforms.add_fields(df, {"flagged": True}, where=level.isin("error", "signup"))
    fields = [F.get_json_object("log", f"$.{c}").alias(c) for c in ("level", "processed", "source", "flagged")]
    return df.select("event_id", *fields, F.when(F.col("event_id") % 9 == 0, F.col("log")).alias("text"))


@query(LINES_SQL + rf"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, regexp_replace(line, 'token = "([0-9a-f]{{4}})[0-9a-f]*"', 'token = "\1***$"', 'g') AS line
FROM lines WHERE {NOT_BLANK_SQL}
""")
def redact(t: Tables) -> DataFrame:
    rows = drop_blank(framing.explode_records(framing.frame_lines(documents(t)).drop("text")))
    rows = transforms.redact(rows, 'token = "([0-9a-f]{4})[0-9a-f]*"', 'token = "$1***$$"')
    return rows.withColumnRenamed("log", "line")


@query("""
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN regexp_replace(props, '[0-9]+', '#', 'g') END AS message,
  CASE WHEN event_id % 9 = 0 THEN event_type || ' ' || props END AS text FROM events
""")
def redact_field(t: Tables) -> DataFrame:
    df = transforms.redact(event_json(t), "[0-9]+", "#", field="message")
    return df.select(
        "event_id", F.get_json_object("log", "$.message").alias("message"),
        F.when(F.col("event_id") % 9 == 0, F.col("log")).alias("text"),
    )


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'json' ELSE 'text' END AS kind FROM events
""")
def strict_json(t: Tables) -> DataFrame:
    # JSON; JSON with a tail; a text whose own bracket closes the test bracket.
    case = F.col("event_id") % 3
    log = F.when(case == 0, F.col("props")).when(case == 1, F.concat("props", F.lit(" x"))).otherwise(F.concat("props", F.lit("] [1")))
    df = with_json(t("events").select("event_id", log.alias("log")))
    return df.select("event_id", F.when(F.col("_json").isNotNull(), "json").otherwise("text").alias("kind"))


# Group tags: orders are the records, customers the groups, nations give the tags.


@query("""
SELECT o_orderkey, CASE WHEN c_custkey % 4 <> 0 THEN n_name END AS nation,
  CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def join_group_tags(t: Tables) -> DataFrame:
    # Two snapshots per group, the later one counts; every fourth group has no tags.
    nations = t("nation").select("n_nationkey", "n_name")
    groups = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    some = F.create_map(F.lit("nation"), F.col("n_name"), F.lit("segment"), F.col("c_mktsegment"))
    none = F.create_map().cast("map<string,string>")
    groups = groups.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    tags = groups.select(
        F.col("c_custkey").alias("log_group"),
        F.when(F.col("c_custkey") % 4 == 0, none).when(F.col("version") == 2, some)
        .otherwise(F.create_map(F.lit("nation"), F.lit("old"))).alias("tags"),
        F.timestamp_micros(F.col("version").cast("bigint")).alias("fetched_at"),
    )
    logs = t("orders").select(
        "o_orderkey", F.col("o_custkey").alias("log_group"), F.lit(None).cast("map<string,string>").alias("meta")
    )
    return _order_tags(join_tags(logs, tags))


def _order_tags(df: DataFrame) -> DataFrame:
    tags = F.try_element_at("meta", F.lit("cw.tags"))
    return df.select(
        "o_orderkey", F.get_json_object(tags, "$.nation").alias("nation"), F.get_json_object(tags, "$.segment").alias("segment")
    )


@query("""
WITH snaps AS (SELECT o_custkey AS g, o_orderdate AS at, max(o_orderkey) AS v FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL)
SELECT o.o_orderkey, CASE WHEN epoch(o.o_orderdate) + o.o_orderkey % 1000 - epoch(s.at) < 100 * 86400 THEN CAST(s.v AS VARCHAR) END AS nation,
  CASE WHEN epoch(o.o_orderdate) + o.o_orderkey % 1000 - epoch(s.at) < 100 * 86400 THEN 's' END AS segment
FROM orders o ASOF LEFT JOIN snaps s ON o.o_custkey = s.g AND o.o_orderdate >= s.at
""")
def join_group_tags_asof(t: Tables) -> DataFrame:
    # A third of the orders are tag snapshots of their customer, valid for 100 days.
    snaps = t("orders").filter("o_orderkey % 3 = 0").groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderkey").alias("v"))
    tags = snaps.select(
        F.col("o_custkey").alias("log_group"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
        F.create_map(F.lit("nation"), F.col("v").cast("string"), F.lit("segment"), F.lit("s")).alias("tags"),
    )
    ts = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 1000 * 1_000_000)
    logs = t("orders").select(
        "o_orderkey", F.col("o_custkey").alias("log_group"), ts.alias("ts"),
        F.lit(None).cast("map<string,string>").alias("meta"),
    )
    return _order_tags(join_tags(logs, tags, ttl_seconds=100 * 86400))
