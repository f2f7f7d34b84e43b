"""Mixed events: one pass, every kind, nothing lost."""

import base64
import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from logforge.plans.config import LogConfig
from logforge.plans.route import route_events, ship_events
from logforge.plans.ship import ship_logs
from logforge.sources.events import read_cloudwatch


def notice(*keys):
    return json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in keys]})


def queue(*bodies):
    return json.dumps({"Records": [{"messageId": f"m{i}", "body": b, "eventSource": "aws:sqs"} for i, b in enumerate(bodies)]})


def topic(text):
    return json.dumps({"Records": [{"EventSource": "aws:sns", "Sns": {"Message": text}}]})


def subscription(*messages, stream="s"):
    payload = {"owner": "1", "logGroup": "g", "logStream": stream, "messageType": "DATA_MESSAGE", "subscriptionFilters": [],
               "logEvents": [{"id": str(i), "timestamp": 0, "message": m} for i, m in enumerate(messages)]}
    return json.dumps({"awslogs": {"data": base64.b64encode(gzip.compress(json.dumps(payload).encode())).decode()}})


def events(spark, *texts):
    """Rows with columns that the router makes itself."""
    return spark.createDataFrame(
        [(f"u{i}", t, "clash", "clash") for i, t in enumerate(texts)], "unit string, event string, log string, error string")


def test_every_item_of_an_event(spark):
    df = events(
        spark, notice("a+b", "c"), queue(topic("x"), notice("d")), subscription("k0", "drop", "k1", "k2"), None, "",
        queue(), queue(None), '{"awslogs":{"data":"!"}}', '{"awslogs":{"data":"aGk="}}',
        '{"Records":[{"kinesis":{"data":"/w=="}},{"kinesis":{"data":"aGk="}},{"kinesis":{"data":""}}]}',
        '{"detail":{"repository-name":"r"}}')
    rows = route_events(df, LogConfig("S3", block="drop", sample=2)).collect()
    got = sorted((r["unit"], r["event_kind"], r["record"], r["pos"], r["log"], r["key"], r["error"]) for r in rows)
    assert [g for g in got if g[0] == "u0"] == [("u0", "S3", 0, 0, None, "a b", None), ("u0", "S3", 1, 0, None, "c", None)]
    assert [(g[1], g[4], g[5]) for g in got if g[0] == "u1"] == [("S3", None, "d"), ("Sns", "x", None)]
    assert [g[4] for g in got if g[0] == "u2"] == ["k0", "k2"]
    assert {g[0]: g[6] for g in got if g[6]} == {
        "u3": "unsupported event", "u4": "unsupported event", "u7": "not base64", "u8": "no subscription payload",
        "u9": "not UTF-8", "u10": "no scan findings"}
    assert [g[4] for g in got if g[0] == "u9" and not g[6]] == ["hi"]


def test_queue_texts_are_logs_where_configured(spark):
    df = events(spark, queue("one", None, "two"), topic("three"))
    rows = route_events(df, LogConfig("Sqs")).collect()
    assert sorted((r["log"], (r["meta"] or {}).get("sqs.event.id")) for r in rows) == [
        ("one", "m0"), ("three", None), ("two", "m2")]
    shipped = ship_events(df, LogConfig("Sqs", "app", "sub")).collect()
    assert {r["batch_id"] for r in shipped} == {0} and len(shipped) == 3


def test_deep_envelopes_are_kept_in_quarantine(spark):
    text = notice("k")
    for _ in range(6):
        text = queue(text)
    rows = route_events(events(spark, text), LogConfig("S3")).collect()
    assert [(r["error"], r["log"]) for r in rows] == [("nested too deep", None)]


def test_one_scan_and_no_shuffle(spark, tmp_path):
    events(spark, notice("a"), topic("t"), subscription("m")).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    plan = route_events(df, LogConfig("S3"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("kind", ["S3", "CloudTrail", "S3Csv", "Kafka"])
def test_objects_of_notifications(spark, tmp_path, kind):
    (tmp_path / "b").mkdir()
    content = {"S3": "one\n\ntwo\n", "CloudTrail": json.dumps({"Records": [{"a": 1}, {"a": 2}]}), "S3Csv": "x,y\n1,2\n3,4"}.get(kind, "z")
    raw = gzip.compress(content.encode()) if kind == "CloudTrail" else content.encode()
    (tmp_path / "b" / "o 1").write_bytes(raw)
    df = events(spark, notice("o+1", "gone"), notice("o%201"), topic("text"))
    cfg = LogConfig(kind, labels={"env": "t"})
    rows = ship_events(df, cfg, address=f"file://{tmp_path}/{{bucket}}/{{key}}").collect()
    logs = sorted(r["log"] for r in rows if r["event_kind"] == "S3" and r["error"] is None)
    want = {"S3": ["one", "two"], "CloudTrail": ['{"a":1}', '{"a":2}'], "S3Csv": ['{"x":1,"y":2}', '{"x":3,"y":4}'], "Kafka": []}[kind]
    assert logs == sorted(want * 2)
    errors = [r["error"] for r in rows if r["error"]]
    if kind == "Kafka":
        assert errors == ["objects do not match integration Kafka"] * 3
    else:
        assert len(errors) == 1 and "FileNotFound" in errors[0]
        assert {r["application"] for r in rows if r["event_kind"] == "S3" and not r["error"]} == {"b"}
    assert [(r["log"], r["subsystem"]) for r in rows if r["event_kind"] == "Sns"] == [("text", "NO SUBSYSTEM NAME")]


def test_empty_table(spark):
    df = events(spark, "x").filter(F.lit(False))
    assert route_events(df, LogConfig("S3")).count() == 0
    assert ship_events(df, LogConfig("S3")).count() == 0


def test_events_are_packed_in_place(spark):
    """Batches of each event as the record-by-record packing gives them, over many Arrow batches."""
    rng = random.Random(2)
    texts = [[("x" * rng.choice([1, 30, 90, 400])) for _ in range(rng.choice([1, 7, 40]))] for _ in range(60)]
    df = events(spark, *[subscription(*t) for t in texts])
    cfg = LogConfig("CloudWatch", "a", batch_target=500, record_overhead=10)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
        rows = ship_events(df, cfg).collect()
        whole = ship_logs(read_cloudwatch(df.drop("log", "error")), cfg).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    want = {}
    for i, messages in enumerate(texts):
        held, batch = None, 0
        for pos, m in enumerate(messages):
            size = len(m) + 10
            if held is not None and held + size > 500:
                held, batch = size, batch + 1
            else:
                held = size + (held or 0)
            want[f"u{i}", pos] = batch
    assert {(r["unit"], r["pos"]): r["batch_id"] for r in rows} == want
    assert {(r["unit"], r["pos"]): r["batch_id"] for r in whole} == want


def test_transforms_and_findings(spark):
    findings = spark.createDataFrame(
        [("r", "d", [("CVE", "u", "HIGH", [("package_name", "p")])], None)],
        "repository string, image_digest string, findings array<struct<name string, uri string, severity string,"
        " attributes array<struct<key string, value string>>>>, severity_counts map<string,bigint>")
    scan = '{"id":"i","detail":{"repository-name":"%s","image-digest":"d"}}'
    df = events(spark, scan % "r", scan % "other", topic("one"), topic("drop"))
    cfg = LogConfig("Sns", "a", "b", transform=lambda e: [] if e == "drop" else [e, {"again": 1}])
    rows = ship_events(df, cfg, findings).collect()
    assert [(r["unit"], r["error"]) for r in rows if r["error"]] == [("u1", "no scan findings")]
    logs = sorted((r["unit"], r["transform_seq"], r["batch_id"]) for r in rows if not r["error"])
    assert logs == [("u0", 0, 0), ("u0", 1, 0), ("u2", 0, 0), ("u2", 1, 0)]
