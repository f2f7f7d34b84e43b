"""Streams, failure routing, sinks, events."""

import base64
import gzip
import json

from pyspark.sql import functions as F

from logforge.operators import failures, framing
from logforge.plans.config import LogConfig
from logforge.plans.deliver import deliver, file_sink
from logforge.plans.ship import frame_source, ship_logs
from logforge.sources import events
from logforge.sources.objects import decode_objects, notifications_to_paths, read_objects
from logforge.streaming.stream import read_object_stream, ship_stream


def write_objects(folder):
    for i in range(5):
        text = "\n".join(f"{i} line {j} {'error' if j % 3 else ''}" for j in range(20))
        (folder / f"a{i}.log.gz").write_bytes(gzip.compress(text.encode()))
    (folder / "plain.log").write_text("plain\n\nend\n")
    (folder / "empty.log").write_text("")


def shipped(df):
    cfg = LogConfig("S3", application="app", subsystem="sub", sample=2, batch_target=1500)
    meta = F.create_map(F.lit("s3.bucket"), F.lit("b"))
    return ship_logs(decode_objects(df).drop("length").withColumn("meta", meta), cfg)


def rows_of(df):
    return sorted((r.unit, r.pos, r.batch_id, r.severity, r.body) for r in df.collect())


def test_object_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_objects(source)
    batch = rows_of(shipped(read_objects(spark, str(source)).drop("meta")))
    assert len(batch) == 52
    stream = read_object_stream(spark, str(source), per_trigger=2)
    out = str(tmp_path / "out")
    ship_stream(stream, shipped, out, str(tmp_path / "checkpoint")).awaitTermination()
    written = spark.read.parquet(out)
    assert rows_of(written) == batch
    assert written.select("epoch").distinct().count() > 1
    # Nothing new: nothing is written again.
    ship_stream(read_object_stream(spark, str(source)), shipped, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(out).count() == len(batch)


def test_undecodable_objects_go_to_quarantine(spark):
    df = spark.createDataFrame(
        [("a.gz", bytearray(b"raw")), ("b.log", bytearray(b"\xff")), ("c.gz", bytearray(gzip.compress(b"fine")))],
        "unit string, content binary",
    )
    found = {r.unit: (r.text, r.error) for r in decode_objects(df).collect()}
    assert found == {
        "a.gz": (None, "nothing could be decompressed"), "b.log": (None, "not UTF-8"), "c.gz": ("fine", None)}


def test_retry_until_dead(spark):
    df = spark.createDataFrame([("u", False, None, "boom", 0)], "unit string, from_retry boolean, retry string, error string, s bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    seen = []
    for _ in range(5):
        row = failures.route_failures(df, limit=3, delay_seconds=10).first()
        seen.append((row.route, row.retry))
        df = spark.createDataFrame([("u", True, str(row.retry), "boom", row.ts)], "unit string, from_retry boolean, retry string, error string, ts timestamp")
    assert seen == [("retry", 0), ("retry", 1), ("retry", 2), ("retry", 3), ("dead", 3)]


def test_retry_counter_that_is_no_number(spark):
    row = spark.createDataFrame([(True, "x", "e", 0)], "from_retry boolean, retry string, error string, s bigint")
    row = failures.route_failures(row.withColumn("ts", F.timestamp_seconds("s"))).first()
    assert (row.route, row.retry) == ("retry", 1)


def test_dead_names(spark):
    payload = {"owner": "1", "logGroup": "/g", "logStream": "s", "messageType": "D", "subscriptionFilters": [], "logEvents": []}
    data = base64.b64encode(gzip.compress(json.dumps(payload).encode())).decode()
    subscription = json.dumps({"awslogs": {"data": data}})
    notice = json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "in/a+b"}}}]})
    df = spark.createDataFrame(
        [(1, subscription, None), (2, notice, bytearray(b"object")), (3, notice, None)], "id int, event string, content binary"
    ).withColumn("ts", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    found = {r.id: (r.object_path, bytes(r.data)) for r in failures.dead_objects(df, "dead/").collect()}
    folder = "dead/failed-events/2024/05/06/07"
    assert found[1][0].startswith(f"{folder}//g/s/") and found[1][0].endswith(".json")
    assert found[2] == (f"{folder}/b/in/a+b", b"object")
    assert found[3][0].startswith(folder) and found[3][1].decode() == notice


def test_sink(spark, tmp_path):
    requests = spark.createDataFrame([("u", 0, "x"), ("u", 1, "y")], "unit string, batch_id int, payload string")
    row = deliver(requests, file_sink(str(tmp_path / "sent"), ["unit", "batch_id"], 1), ["unit"]).first()
    assert (row.unit, row.delivered, row.batches) == ("u", True, 2)

    def refusing(requests):
        return requests.select(
            "unit", "batch_id", F.lit(1).alias("attempt"), F.lit("ok").alias("status"),
            F.when(F.col("batch_id") == 1, 2).otherwise(0).alias("rejected"), F.lit(True).alias("message_present"))

    row = deliver(requests, refusing, ["unit"]).first()
    assert (row.delivered, row.failed_batches, row.warnings) == (False, 1, 1)


def kinesis(*datas):
    records = [
        {"eventID": f"e{i}", "eventName": "n", "eventSource": "s", "eventSourceARN": f"arn{i}", "kinesis": {"data": base64.b64encode(d).decode()}}
        for i, d in enumerate(datas)
    ]
    return json.dumps({"Records": records})


def test_stream_records(spark):
    payload = {
        "owner": "1", "logGroup": "/g", "logStream": "keep", "messageType": "D", "subscriptionFilters": ["f"],
        "logEvents": [{"id": str(i), "timestamp": i, "message": m} for i, m in enumerate(["a", "block me", "b", "c"])],
    }
    other = dict(payload, logStream="drop")
    datas = [gzip.compress(json.dumps(payload).encode()), json.dumps(other).encode(), b"raw", b"", b"\xff\xfe", b'{"logGroup":"x"}']
    df = spark.createDataFrame([("u", kinesis(*datas))], "unit string, event string")
    cfg = LogConfig("Kinesis", block="block", sample=2, stream_filter="^keep$")
    rows = frame_source(events.read_kinesis_records(df), cfg).orderBy("record", "pos").collect()
    found = [(r.record, r.log, r.meta["kinesis.event.source_arn"], r.meta.get("cw.log.group")) for r in rows]
    assert found == [(0, "a", "arn0", "/g"), (0, "c", "arn0", "/g"), (2, "raw", "arn2", None), (5, '{"logGroup":"x"}', "arn5", None)]


def test_kafka_records(spark):
    values = [base64.b64encode("héllo".encode()).decode(), "plain text", None, base64.b64encode(b"\xff\xfe\xfd").decode()]
    records = {"t-0": [{"topic": "t", "partition": 0, "offset": i, "value": v} for i, v in enumerate(values)]}
    df = spark.createDataFrame([(json.dumps({"eventSource": "aws:kafka", "records": records}),)], "event string")
    rows = events.read_kafka_records(df).orderBy("pos").collect()
    assert [(r.pos, r.log, r.error) for r in rows] == [(0, "héllo", None), (1, "plain text", None), (3, None, "not UTF-8")]


def test_event_kinds(spark):
    cases = {
        '{"Records":[]}': "S3", '{"records":{}}': "unsupported", "[]": "unsupported", "text": "unsupported",
        '{"Records":[{"body":"x"}]}': "Sqs", '{"records":{"t-0":[]}}': "Kafka", '{"records":[]}': "Firehose",
    }
    df = spark.createDataFrame([(c,) for c in cases], "event string")
    assert {r.event: r.event_kind for r in events.classify_events(df).collect()} == cases


def test_notifications(spark):
    records = [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in ("a+b/c%20d.log", "%E2%82%AC")]
    df = spark.createDataFrame([(json.dumps({"Records": records}),)], "event string")
    assert [(r.bucket, r.key) for r in notifications_to_paths(df).collect()] == [("b", "a b/c d.log"), ("b", "€")]


def test_scan_findings(spark):
    findings = [
        {"name": "CVE-1", "uri": None, "severity": "HIGH", "attributes": [
            {"key": "package_version", "value": "1.0"}, {"key": "package_name", "value": None}, {"key": "package_name", "value": "ssl"}]},
        {"name": "CVE-2", "uri": "u", "severity": None, "attributes": None},
    ]
    schema = """unit string, repository string, image_digest string, image_tags array<string>,
        findings array<struct<name string, uri string, severity string, attributes array<struct<key string, value string>>>>,
        severity_counts map<string,int>"""
    df = spark.createDataFrame([("u", "repo", "sha", ["v1"], findings, {"HIGH": 1})], schema)
    rows = [json.loads(r.log) for r in framing.explode_records(framing.frame_scan_findings(df)).orderBy("pos").collect()]
    assert len(rows) == 2
    assert rows[0]["findings"]["package"] == {"package": "ssl:1.0", "name": "ssl", "version": "1.0"}
    assert rows[0]["findings"]["details"]["attributes"][1] == {"key": "package_name", "value": ""}
    assert rows[1]["ecr_scan_summary"] == {"finding_severity_counts": ["High: 1"]}
