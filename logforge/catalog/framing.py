"""Queries: objects, framing, filters, sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.catalog.registry import Tables, query
from logforge.functions.text import gzip, key_level, not_blank
from logforge.operators import framing
from logforge.operators.filters import block_pattern as block_rows
from logforge.operators.filters import drop_blank, stride_sample as stride_rows
from logforge.operators.lines import delimited_lines, multiline_records
from logforge.operators.ordering import ordered_position
from logforge.plans.config import LogConfig
from logforge.plans.ship import frame_source
from logforge.session import work_dir
from logforge.sources.events import read_scan_events
from logforge.sources.objects import (
    decode_objects,
    notifications_to_paths,
    read_lines as lines_of,
    read_objects as objects_of,
    select_keys,
)
from logforge.sources.paths import object_address, read_paths

LINES_SQL = r"""
WITH pieces AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
kept AS (SELECT doc_id, CASE WHEN len(a) > 1 AND a[1] = '' THEN a[2:] ELSE a END AS a FROM pieces),
lines AS (SELECT doc_id, i - 1 AS pos, a[i] AS line FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM kept))
"""
NOT_BLANK_SQL = r"regexp_matches(line, '[^\s\p{Z}]')"


#: Documents that are written to one object.
OBJECT_DOCUMENTS = 1000


def documents(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", "text")


@query(LINES_SQL + f"SELECT doc_id, CAST(pos AS BIGINT) AS pos, line FROM lines WHERE {NOT_BLANK_SQL}")
def frame_lines(t: Tables) -> DataFrame:
    rows = drop_blank(framing.explode_records(framing.frame_lines(documents(t)).drop("text")))
    return rows.withColumnRenamed("log", "line")


@query(r"""
WITH pieces AS (SELECT doc_id, string_split_regex(text, '[.!?]\n+') AS a FROM documents),
kept AS (SELECT doc_id, CASE WHEN len(a) > 1 AND a[1] = '' THEN a[2:] ELSE a END AS a FROM pieces)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, a[i] AS record
FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM kept)
""")
def frame_multiline(t: Tables) -> DataFrame:
    df = framing.frame_lines(documents(t), r"[.!?]\n+").drop("text")
    return framing.explode_records(df).withColumnRenamed("log", "record")


def blocks_of_lines(texts: DataFrame, lines: int) -> DataFrame:
    """``unit``, ``text`` → lines in blocks, as a file's lines come from its splits."""
    rows = texts.select("unit", F.posexplode(F.split("text", "\n", -1)).alias("seq", "log"))
    return rows.select("unit", F.floor(F.col("seq") / lines).alias("block"), F.col("seq").cast("bigint"), "log")


@query(r"""
WITH pieces AS (SELECT doc_id, string_split_regex(text, '[.!?]\n+') AS a FROM documents),
kept AS (SELECT doc_id, CASE WHEN len(a) > 1 AND a[1] = '' THEN a[2:] ELSE a END AS a FROM pieces)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, a[i] AS record
FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM kept)
""")
def frame_multiline_lines(t: Tables) -> DataFrame:
    # Blocks of five lines: nearly every record meets an edge, many span blocks.
    lines = blocks_of_lines(documents(t).select(F.col("doc_id").alias("unit"), "text"), 5)
    rows = multiline_records(lines, r"[.!?]\n+", reach=64)
    return rows.select(F.col("unit").alias("doc_id"), F.col("seq").alias("pos"), F.col("log").alias("record"))


@query(LINES_SQL + f"""
, open AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, line
           FROM lines WHERE NOT regexp_matches(line, 'token = |[0-9]{{6}}'))
SELECT doc_id, pos, line FROM open WHERE {NOT_BLANK_SQL}
""")
def block_pattern(t: Tables) -> DataFrame:
    df = framing.frame_lines(documents(t)).drop("text")
    rows = framing.explode_records(df, block="token = |[0-9]{6}")
    return drop_blank(rows).withColumnRenamed("log", "line")


@query(LINES_SQL + f"""
SELECT doc_id, line FROM lines
WHERE NOT regexp_matches(line, '(?i)license') AND {NOT_BLANK_SQL}
""")
def block_rows_drop_blank(t: Tables) -> DataFrame:
    rows = framing.explode_records(framing.frame_lines(documents(t)).drop("text"))
    return drop_blank(block_rows(rows, "(?i)license")).select("doc_id", F.col("log").alias("line"))


@query(LINES_SQL + f"""
, open AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n, line
           FROM lines WHERE NOT regexp_matches(line, 'token = '))
SELECT doc_id, n // 10 AS pos, line FROM open WHERE n % 10 = 0 AND {NOT_BLANK_SQL}
""")
def stride_sample(t: Tables) -> DataFrame:
    df = framing.frame_lines(documents(t)).drop("text")
    rows = framing.explode_records(df, block="token = ", sample=10)
    return drop_blank(rows).withColumnRenamed("log", "line")


@query("""
SELECT user_id, event_id FROM
  (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events)
WHERE n % 7 = 0
""")
def stride_sample_rows(t: Tables) -> DataFrame:
    events = t("events").select("user_id", "event_id")
    return stride_rows(events, 7, ["user_id"], ["event_id"])


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events) WHERE n % 9 = 0")
def stride_sample_hot_unit(t: Tables) -> DataFrame:
    # One unit holds every row; it is still handled in small chunks.
    events = t("events").select(F.lit("all").alias("unit"), "event_id")
    return stride_rows(events, 9, ["unit"], ["event_id"], span=512).select("event_id")


@query("""
SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS n FROM events)
WHERE n % 7 = 0
""")
def stride_sample_by_time(t: Tables) -> DataFrame:
    # Ordered by time: chunks are cut where the rows lie.
    events = t("events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return stride_rows(events, 7, ["event_type"], ["ts", "event_id"], span=512).select("event_id")


@query("""
SELECT unit, event_id FROM
  (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE event_type END AS unit,
     row_number() OVER (PARTITION BY CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE event_type END
       ORDER BY CASE WHEN user_id % 3 = 0 THEN event_id // 50 ELSE epoch_us(ts) END, event_id) - 1 AS n
   FROM events)
WHERE n % 11 = 0
""")
def stride_sample_skewed(t: Tables) -> DataFrame:
    # A third of all rows is one unit, within a narrow time and with many equal times.
    hot = F.col("user_id") % 3 == 0
    unit = F.when(hot, "hot").otherwise(F.col("event_type")).alias("unit")
    at = F.when(hot, F.floor(F.col("event_id") / 50)).otherwise(F.unix_micros(F.col("ts").cast("timestamp")))
    events = t("events").select(unit, at.alias("at"), "event_id")
    return stride_rows(events, 11, ["unit"], ["at", "event_id"], span=128).select("unit", "event_id")


@query(LINES_SQL + f"SELECT line, count(*) AS n FROM lines WHERE {NOT_BLANK_SQL} GROUP BY line")
def read_objects(t: Tables) -> DataFrame:
    # An object is one cell from reading to framing, so those of a task are cut, whatever rows the task has.
    path = work_dir(t.spark, "objects")
    t("documents").select("text").write.option("maxRecordsPerFile", OBJECT_DOCUMENTS).option("compression", "gzip").text(path)
    objects = objects_of(t.spark, path, suffix=".txt.gz")
    text = decode_objects(objects, "auto_ext")
    lines = drop_blank(framing.explode_records(framing.frame_lines(text).select("unit", "records")))
    return lines.groupBy(F.col("log").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(LINES_SQL + f"SELECT line, count(*) AS n FROM lines WHERE {NOT_BLANK_SQL} GROUP BY line")
def read_lines(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "plain")
    t("documents").select("text").write.text(path)
    lines = drop_blank(lines_of(t.spark, path))
    return lines.groupBy(F.col("log").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(LINES_SQL + f"""
SELECT CASE WHEN doc_id % 10 = 7 THEN 'missing' END AS error,
  CASE WHEN doc_id % 10 = 7 THEN NULL ELSE md5(line) END AS digest, count(*) AS n
FROM (SELECT doc_id, line, pos FROM lines WHERE doc_id % 10 <> 7 AND {NOT_BLANK_SQL}
      UNION ALL SELECT doc_id, NULL, 0 FROM documents WHERE doc_id % 10 = 7)
GROUP BY ALL
""")
def read_notified(t: Tables) -> DataFrame:
    # Objects written by their ids, every third one compressed, every tenth one named but missing;
    # notifications name them, and tasks read them by path.
    root = work_dir(t.spark, "notified")
    number, shard = F.col("doc_id").cast("string"), (F.col("doc_id") % 16).cast("string")
    name = F.concat(shard, F.lit("/o "), number, F.when(F.col("doc_id") % 3 == 0, ".gz").otherwise(".log"))
    raw = F.encode("text", "UTF-8")
    zipped = F.col("doc_id") % 3 == 0
    content = F.coalesce(gzip(F.when(zipped, raw)), raw)
    objects = t("documents").select("doc_id", name.alias("key"), content.alias("content"))
    write_objects(objects.filter("doc_id % 10 <> 7"), root)
    record = F.struct(F.struct(
        F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(F.url_encode("key").alias("key")).alias("object")).alias("s3"))
    event = F.to_json(F.struct(F.array(record).alias("Records"))).alias("event")
    paths = notifications_to_paths(objects.select("doc_id", event))
    paths = paths.withColumn("path", object_address(F.col("bucket"), F.col("key"), root + "/{bucket}/{key}"))
    rows = read_paths(paths, compression=LogConfig("S3").compression)
    rows = rows.filter(F.col("error").isNotNull() | not_blank(F.col("log")))
    error = F.when(F.contains("error", F.lit("FileNotFound")), "missing").otherwise(F.col("error"))
    return rows.groupBy(error.alias("error"), F.md5("log").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


def write_objects(objects: DataFrame, root: str) -> None:
    """One object per row of ``key``, ``content``, under a bucket ``b``."""
    folder = root.removeprefix("file://")

    def write(rows) -> None:
        import os

        for row in rows:
            path = f"{folder}/b/{row['key']}"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "wb") as file:
                file.write(row["content"])

    objects.foreachPartition(write)


@query("SELECT doc_id, octet_length(encode(text)) AS bytes, md5(text) AS digest FROM documents")
def gunzip_documents(t: Tables) -> DataFrame:
    # Every second object is compressed; the reader finds out by looking.
    raw = F.encode("text", "UTF-8")
    packed = gzip(F.when(F.col("doc_id") % 2 == 0, raw))
    df = t("documents").select("doc_id", F.lit("u").alias("unit"), F.coalesce(packed, raw).alias("content"))
    text = decode_objects(df, "sniff")
    return text.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"), F.md5("text").alias("digest"))


@query("SELECT doc_id, octet_length(encode(text)) AS bytes, md5(text) AS digest FROM documents")
def gunzip_corrupt(t: Tables) -> DataFrame:
    # The checksum at the end is broken: all that came before it is kept.
    whole = gzip(F.encode("text", "UTF-8"))
    df = t("documents").select("doc_id", F.lit("u.gz").alias("unit"), whole.alias("content"))
    broken = F.concat(F.substr("content", F.lit(1), F.octet_length("content") - 8), F.unhex(F.lit("0102030405060708")))
    text = decode_objects(df.withColumn("content", broken), "gzip")
    return text.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"), F.md5("text").alias("digest"))


@query("""
SELECT doc_id % 5 AS kind, CASE WHEN doc_id % 5 IN (0, 1) AND doc_id % 2 = 0 THEN 'nothing could be decompressed' END AS error,
  CASE WHEN NOT (doc_id % 5 IN (0, 1) AND doc_id % 2 = 0) THEN md5(text) END AS digest, count(*) AS n
FROM documents WHERE text <> '' GROUP BY ALL
""")
def decode_by_integration(t: Tables) -> DataFrame:
    # Flow logs and trails are always compressed, whatever their names; other objects if named so.
    raw, kind = F.encode("text", "UTF-8"), F.col("doc_id") % 5
    even = F.col("doc_id") % 2 == 0
    packed = gzip(F.when(~even, raw))
    objects = t("documents").filter("text <> ''").select(
        kind.alias("kind"), F.concat(F.lit("o"), F.when(even, ".log").when(kind.isin(0, 1), ".log").otherwise(".gz")).alias("unit"),
        F.coalesce(packed, raw).alias("content"))
    parts = [
        decode_objects(objects.filter(F.col("kind") == i), LogConfig(name).compression)
        for i, name in enumerate(["VpcFlow", "CloudTrail", "S3", "S3Csv", "CloudFront"])]
    df = reduce(DataFrame.unionByName, parts)
    return df.groupBy("kind", "error", F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT doc_id, lang AS level FROM documents WHERE source LIKE 'src1%' AND doc_id % 10 = 7
""")
def select_object_keys(t: Tables) -> DataFrame:
    key = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    df = t("documents").select("doc_id", key.alias("key"))
    return select_keys(df, "src1", "7").select("doc_id", key_level(F.col("key"), 2).alias("level"))


# Delimited text is rebuilt from orders: an object holds the orders of 500 keys.

ORDERS_OBJECT_SQL = "o_orderkey // 500"


def order_objects(t: Tables, head: str, cut: str, cells: list) -> DataFrame:
    row = F.concat_ws(cut, *cells)
    # A blank row after every eleventh key; every seventh row lacks its last cell.
    row = F.when(F.col("o_orderkey") % 7 == 0, F.substring_index(row, cut, len(cells) - 1)).otherwise(row)
    row = F.when(F.col("o_orderkey") % 11 == 0, F.concat(row, F.lit("\n  "))).otherwise(row)
    rows = F.sort_array(F.collect_list(F.struct("o_orderkey", row.alias("row"))))
    df = t("orders").groupBy(F.floor(F.col("o_orderkey") / 500).alias("object")).agg(rows.alias("rows"))
    text = F.concat(F.lit(head), F.array_join(F.transform("rows", lambda r: r["row"]), "\n"))
    return df.select("object", text.alias("text"))


def order_cells() -> list:
    return [
        F.col("o_orderkey").cast("string"),
        F.col("o_orderstatus"),
        (F.col("o_orderkey") * 1_000_000).cast("string"),
        F.concat(F.lit(" "), (F.col("o_orderkey") % 100).cast("string")),
        F.col("o_orderpriority"),
    ]


ORDER_ROWS_SQL = f"""
SELECT CAST({ORDERS_OBJECT_SQL} AS BIGINT) AS object,
  row_number() OVER (PARTITION BY {ORDERS_OBJECT_SQL} ORDER BY o_orderkey) - 1 AS pos,
  CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
  CASE WHEN o_orderkey * 1000000 <= 2147483647 THEN CAST(o_orderkey * 1000000 AS VARCHAR)
       ELSE '"' || (o_orderkey * 1000000) || '"' END AS big,
  '" ' || (o_orderkey % 100) || '"' AS padded,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS priority
FROM orders
"""


def order_fields(df: DataFrame, names: list[str]) -> DataFrame:
    def cell(name: str):
        return F.get_json_object("log", f"$['{name}']")

    def raw(name: str):
        return F.regexp_extract("log", rf'"{name}":("[^"]*"|[^,}}]*)', 1)

    return df.select(
        "object", "pos", cell(names[0]).alias("id"), cell(names[1]).alias("status"),
        raw(names[2]).alias("big"), raw(names[3]).alias("padded"), cell(names[4]).alias("priority"),
    )


@query(ORDER_ROWS_SQL)
def frame_delimited(t: Tables) -> DataFrame:
    # The name "status" occurs twice: the later cell counts.
    cells = order_cells()
    cells.insert(1, F.lit("other"))
    df = order_objects(t, "id;status;status;big;padded;priority\n", ";", cells)
    rows = framing.explode_records(framing.frame_delimited(df, ";").drop("text"))
    return order_fields(rows, ["id", "status", "big", "padded", "priority"])


@query(ORDER_ROWS_SQL)
def frame_delimited_lines(t: Tables) -> DataFrame:
    # The objects of frame_delimited, read line by line in blocks of seven lines.
    cells = order_cells()
    cells.insert(1, F.lit("other"))
    df = order_objects(t, "id;status;status;big;padded;priority\n", ";", cells)
    lines = blocks_of_lines(df.select(F.col("object").alias("unit"), "text"), 7)
    rows = ordered_position(delimited_lines(lines, ";"), ["unit"], ["seq"], chunk="block", out="pos")
    rows = rows.select(F.col("unit").alias("object"), "pos", "log")
    return order_fields(rows, ["id", "status", "big", "padded", "priority"])


@query(ORDER_ROWS_SQL)
def frame_custom_header(t: Tables) -> DataFrame:
    df = order_objects(t, "a,b,c,d,e\n", ",", order_cells())
    rows = framing.explode_records(framing.frame_delimited(df, ",", header="n,s,m,p,q").drop("text"))
    return order_fields(rows, ["n", "s", "m", "p", "q"])


@query(ORDER_ROWS_SQL)
def frame_tab_spelled(t: Tables) -> DataFrame:
    # The delimiter is given as a backslash and a t.
    df = order_objects(t, "id\tstatus\tbig\tpadded\tpriority\n", "\t", order_cells())
    cfg = LogConfig("S3Csv", delimiter="\\t")
    rows = frame_source(df.select("*", F.col("object").alias("unit")), cfg).drop("unit")
    return order_fields(rows, ["id", "status", "big", "padded", "priority"])


@query(ORDER_ROWS_SQL)
def frame_cloudfront(t: Tables) -> DataFrame:
    head = "#Version: 1.0\n#Fields: date cs-method cs-bytes pad x(Host)\n"
    df = order_objects(t, head, "\t", order_cells())
    rows = framing.explode_records(framing.frame_cloudfront(df).drop("text"))
    return order_fields(rows, ["date", "cs-method", "cs-bytes", "pad", r"x(Host)"])


@query("""
SELECT CAST(l_orderkey // 100 AS BIGINT) AS object, CAST(l_partkey AS VARCHAR) AS srcport,
  CAST(l_suppkey AS VARCHAR) AS dstport, l_returnflag AS action,
  CASE WHEN l_partkey * 1000000 <= 2147483647 THEN 'number' ELSE 'string' END AS account_kind, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def frame_vpc_flow(t: Tables) -> DataFrame:
    # An object holds at most 512 rows of one task.
    block = F.floor(F.monotonically_increasing_id() / 512).alias("block")
    start = F.floor(F.col("l_orderkey") / 100)
    row = F.concat_ws(" ", F.col("l_partkey") * 1_000_000, "l_partkey", "l_suppkey", "l_returnflag", start)
    df = t("lineitem").select(block, row.alias("row")).groupBy("block").agg(F.collect_list("row").alias("rows"))
    text = F.concat(F.lit("account-id  srcport dstport\taction start\n"), F.array_join("rows", "\n"))
    rows = framing.explode_records(framing.frame_vpc_flow(df.select(text.alias("text"))).drop("text"))
    kind = F.when(F.contains("log", F.lit('"account-id":"')), "string").otherwise("number")
    names = ["srcport", "dstport", "action"]
    rows = rows.select(kind.alias("account_kind"), F.json_tuple("log", *names, "start").alias(*names, "start"))
    rows = rows.select(F.col("start").cast("bigint").alias("object"), *names, "account_kind")
    return rows.groupBy("object", "srcport", "dstport", "action", "account_kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_custkey AS custkey, CAST(o_orderkey // 1000 AS BIGINT) AS block, o_orderkey AS orderkey,
  o_orderstatus AS status,
  row_number() OVER (PARTITION BY o_custkey, o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS pos
FROM orders WHERE o_custkey % 5 <> 0
""")
def frame_json_array(t: Tables) -> DataFrame:
    # One object per customer and key block; every fifth customer sends no array.
    record = F.struct("o_orderkey", F.col("o_orderstatus").alias("status"))
    df = t("orders").groupBy("o_custkey", F.floor(F.col("o_orderkey") / 1000).alias("block")).agg(
        F.sort_array(F.collect_list(record)).alias("Records")
    )
    good = F.to_json(F.struct("Records"))
    bad = F.concat(F.lit('{"Records":'), F.col("o_custkey").cast("string"), F.lit("}"))
    df = df.select("o_custkey", "block", F.when(F.col("o_custkey") % 5 == 0, bad).otherwise(good).alias("text"))
    rows = framing.explode_records(framing.frame_json_array(df).drop("text"))
    return rows.select(
        F.col("o_custkey").alias("custkey"), "block", "pos",
        F.get_json_object("log", "$.o_orderkey").cast("bigint").alias("orderkey"),
        F.get_json_object("log", "$.status").alias("status"),
    )


SEVERITIES = ["CRITICAL", "HIGH", "LOW"]


@query("""
WITH f AS (SELECT p_brand, p_partkey // 500 AS block, p_partkey, p_name,
    CASE p_size % 3 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' ELSE 'LOW' END AS severity, p_size, p_type
  FROM part)
SELECT p_brand AS repository, CAST(block AS BIGINT) AS block, 'finding' AS kind, p_name AS name, severity,
  (CASE WHEN p_size % 4 = 0 THEN 'NO_PACKAGE' ELSE p_type END) || ':' ||
  (CASE WHEN p_size % 5 = 0 THEN 'NO_VERSION' ELSE CAST(p_size AS VARCHAR) END) AS package, count(*) AS n
FROM f WHERE p_size % 7 <> 0 GROUP BY ALL
UNION ALL
SELECT p_brand, CAST(block AS BIGINT), 'summary', NULL, NULL,
  string_agg(label || ': ' || c, ',' ORDER BY label), 1
FROM (SELECT p_brand, block, upper(severity[1]) || lower(severity[2:]) AS label, count(*) AS c FROM f GROUP BY ALL)
GROUP BY p_brand, block
""")
def frame_scan_findings(t: Tables) -> DataFrame:
    scans = scan_results(t)
    rows = framing.explode_records(framing.frame_scan_findings(scans.withColumn("repo", F.col("repository"))))
    labels = F.array_sort(F.from_json(F.get_json_object("log", "$.ecr_scan_summary.finding_severity_counts"), "array<string>"))
    package = F.get_json_object("log", "$.findings.package.package")
    rows = rows.select(
        F.col("repo").alias("repository"), "block",
        F.when(package.isNotNull(), "finding").otherwise("summary").alias("kind"),
        F.get_json_object("log", "$.findings.details.name").alias("name"),
        F.get_json_object("log", "$.findings.details.severity").alias("severity"),
        F.coalesce(package, F.array_join(labels, ",")).alias("package"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def scan_results(t: Tables) -> DataFrame:
    # A scan per brand and key block; every part is a finding.
    size = F.col("p_size")
    attributes = F.array(
        F.struct(F.lit("other").alias("key"), F.lit(None).cast("string").alias("value")),
        F.struct(F.lit("package_name").alias("key"), F.when(size % 4 != 0, F.col("p_type")).alias("value")),
        F.struct(F.lit("package_version").alias("key"), F.when(size % 5 != 0, size.cast("string")).alias("value")),
        F.struct(F.lit("package_version").alias("key"), F.when(size % 5 != 0, F.lit("later")).alias("value")),
    )
    severity = F.get(F.array(*[F.lit(s) for s in SEVERITIES]), size % 3)
    finding = F.struct(
        F.col("p_name").alias("name"), F.lit(None).cast("string").alias("uri"), severity.alias("severity"),
        F.when(size % 7 != 0, attributes).alias("attributes"),
    )
    counts = F.filter(
        F.array(*[F.struct(F.lit(s).alias("key"), F.count_if(severity == s).alias("value")) for s in SEVERITIES]),
        lambda e: e["value"] > 0,
    )
    scans = t("part").groupBy(
        F.col("p_brand").alias("repository"), F.floor(F.col("p_partkey") / 500).alias("block")
    ).agg(F.collect_list(finding).alias("findings"), F.map_from_entries(counts).alias("severity_counts"))
    digest = F.concat(F.lit("sha256:"), F.md5(F.concat_ws("/", "repository", F.col("block").cast("string"))))
    return scans.select("*", digest.alias("image_digest"), F.array(F.lit("latest")).alias("image_tags"))


@query("""
SELECT p_brand AS repository, 'scan-' || p_brand || '-' || (p_partkey // 500) AS id,
  count(*) FILTER (p_size % 7 <> 0) + 1 AS records
FROM part WHERE p_partkey // 500 % 2 = 0 GROUP BY ALL
""")
def scan_events(t: Tables) -> DataFrame:
    # An event per scan; the results of every second block are missing.
    scans = scan_results(t)
    name = F.concat_ws("-", F.lit("scan"), "repository", F.col("block").cast("string"))
    detail = F.struct(
        F.col("repository").alias("repository-name"), F.col("image_digest").alias("image-digest"), F.col("image_tags").alias("image-tags")
    )
    events = scans.select(F.to_json(F.struct(name.alias("id"), F.lit("aws.ecr").alias("source"), detail.alias("detail"))).alias("event"))
    events = events.withColumn("unit", F.md5("event"))
    findings = scans.filter("block % 2 = 0").select("repository", "image_digest", "findings", "severity_counts")
    rows = frame_source(read_scan_events(events, findings), LogConfig("EcrScan"))
    scan = F.try_element_at("meta", F.lit("ecr.scan.id")).alias("id")
    return rows.groupBy(F.get_json_object("log", "$.metadata.repository").alias("repository"), scan).agg(
        F.count(F.lit(1)).alias("records")
    )
