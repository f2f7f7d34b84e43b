import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logforge.functions import otlp
from logforge.operators import association, metrics
from logforge.plans.config import MetricConfig
from logforge.plans.ship import ship_metrics


def pair(key, text):
    return {"key": key, "value": {"stringValue": text}}


def message(kind="summary", dims=(("InstanceId", "i-1"),), rest=b""):
    attributes = [
        pair("MetricName", "CPU"), pair("Namespace", "AWS/EC2"),
        {"key": "Dimensions", "value": {"kvlistValue": {"values": [pair(*d) for d in dims]}}},
        {"key": "n", "value": {"intValue": -5}}, {"key": "d", "value": {"doubleValue": 2.0}},
        {"key": "b", "value": {"boolValue": True}}, {"key": "l", "value": {"arrayValue": {"values": [{"stringValue": "x"}]}}},
    ]
    point = {"attributes": attributes, "rest": rest}
    metric = {"name": "m", "unit": "Count", "kind": kind, "data_points": [point], "data_rest": b"", "rest": b""}
    request = [{"scope_metrics": [{"metrics": [metric], "rest": b""}], "rest": b"\x1a\x01u"}]
    return otlp._encode(pa.array([request], otlp.RESOURCES))[0].as_py()


def records(spark, datas):
    return spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(datas)], "record_id bigint, data binary")


def delimited(*messages):
    return b"".join(otlp.varint(len(m)) + m for m in messages)


def decoded(spark, *datas):
    return metrics.explode_points(metrics.decode_metrics(metrics.split_messages(records(spark, datas))))


def test_split_errors(spark):
    good = message()
    rows = metrics.decode_metrics(metrics.split_messages(records(spark, [
        delimited(good, good), b"\xff", b"\x05ab", delimited(b"\xff\xff"), b""])))
    found = sorted((r.record_id, r.msg_idx, r.error) for r in rows.collect())
    assert found == [
        (0, 0, None), (0, 1, None), (1, 0, "bad length-delimited data"), (2, 0, "bad length-delimited data"),
        (3, 0, "bad metrics message"),
    ]


def test_decode_keeps_all_fields(spark):
    import struct

    rest = b"\x19" + struct.pack("<Q", 7) + b"\x21" + struct.pack("<Q", 3) + b"\x29" + struct.pack("<d", 1.5)
    row = decoded(spark, delimited(message(rest=rest))).first()
    assert (row["name"], row.kind, row["count"], row["sum"]) == ("m", "summary", 3, 1.5)
    assert bytes(row.rm_rest) == b"\x1a\x01u" and bytes(row.dp_rest) == rest
    assert [a.key for a in row.attributes] == ["MetricName", "Namespace", "Dimensions", "n", "d", "b", "l"]


def test_round_trip_bytes(spark):
    data = delimited(message(), message("gauge"), message("histogram"), message("exponential_histogram"), message("sum"))
    points = decoded(spark, data)
    again = metrics.encode_metrics(metrics.rebuild_payload(points, ["record_id", "msg_idx"]))
    joined = metrics.join_messages(again, ["record_id"])
    assert bytes(joined.first().data) == data


def test_identity_text_values(spark):
    row = metrics.metric_identity(metrics.flatten_points(decoded(spark, delimited(message())))).first()
    assert (row.namespace, row.metric_name) == ("AWS/EC2", "CPU")
    assert [(d.key, d.value) for d in row.dims] == [("n", "-5"), ("d", "2"), ("b", "true"), ("l", ""), ("InstanceId", "i-1")]


def inventory(spark, rows):
    data = [(arn, kind, [("Team", team)], i) for i, (arn, kind, team) in enumerate(rows)]
    return spark.createDataFrame(data, "arn string, resource_type string, tags array<struct<key string, value string>>, pos bigint")


def associated(spark, registry, rows, namespace, dims):
    loaded = association.load_registry(spark, registry)
    index = association.build_associations(inventory(spark, rows), loaded)
    points = spark.createDataFrame([(namespace, dims)], "namespace string, dims array<struct<key string, value string>>")
    row = association.associate_tags(points, index, loaded).first()
    return row.tags[0].value if row.tags else None


def test_association(spark):
    ec2 = [("arn:aws:ec2:eu:1:instance/i-1", "ec2:instance", "old"), ("arn:aws:ec2:eu:1:instance/i-1", "ec2:instance", "alpha")]
    assert associated(spark, None, ec2, "AWS/EC2", [("InstanceId", "i-1"), ("Other", "x")]) == "alpha"
    assert associated(spark, None, ec2, "AWS/EC2", [("InstanceId", "i-2")]) is None
    assert associated(spark, None, ec2, "AWS/EC2", []) is None
    assert associated(spark, None, ec2, "Nowhere", [("InstanceId", "i-1")]) is None
    broker = [("arn:aws:mq:us:1:broker:mybroker:abc-179", "mq:broker", "42")]
    assert associated(spark, None, broker, "AWS/AmazonMQ", [("Broker", "mybroker-1")]) == "42"


def test_larger_pattern_first_but_only_if_it_hits(spark):
    registry = [{"namespace": "N", "resource_types": ["s"], "arn_patterns": [r":a/(?P<A>\w+)$", r":ab/(?P<A>\w+)/(?P<B_C>\w+)$"]}]
    rows = [("arn:aws:s:r:1:a/x", "s:a", "one"), ("arn:aws:s:r:1:ab/x/y", "s:ab", "two")]
    assert associated(spark, registry, rows, "N", [("A", "x"), ("B C", "y")]) == "two"
    assert associated(spark, registry, rows, "N", [("A", "x"), ("B C", "z")]) == "one"
    # Swapped values are another resource.
    assert associated(spark, registry, [("arn:aws:s:r:1:ab/x/y", "s:ab", "two")], "N", [("A", "y"), ("B C", "x")]) is None


@pytest.mark.parametrize("batching, requests", [(True, 1), (False, 2)])
def test_ship_metrics(spark, batching, requests):
    registry = association.load_registry(spark)
    index = association.build_associations(inventory(spark, [("arn:aws:ec2:eu:1:instance/i-1", "ec2:instance", "alpha")]), registry)
    cfg = MetricConfig("app", "sub", {"env": "prod"}, batching=batching)
    df = records(spark, [delimited(message(), message("gauge"))]).withColumn("unit", F.lit("u"))
    out = ship_metrics(df, cfg, index, registry, ["unit"])
    assert out.count() == requests
    points = metrics.explode_points(metrics.decode_metrics(out.select("batch_id", "message"))).collect()
    keys = {r.kind: [a.key for a in r.attributes] for r in points}
    assert keys["summary"] == [
        "MetricName", "Namespace", "n", "d", "b", "l", "InstanceId", "Team", "env", "cx.application.name", "cx.subsystem.name"]
    assert keys["gauge"] == ["MetricName", "Namespace", "Dimensions", "n", "d", "b", "l"]
    assert {r.metric_unit for r in points} == {""}


def test_missing_inventory_policy(spark):
    registry = association.load_registry(spark)
    index = association.build_associations(inventory(spark, [("arn:aws:sqs:eu:1:q", "sqs", "x")]), registry)
    points = spark.createDataFrame([("AWS/EC2", [("InstanceId", "i")])], "namespace string, dims array<struct<key string, value string>>")
    assert association.require_inventory(points, index, registry, "skip").count() == 1
    with pytest.raises(Exception, match="no inventory"):
        association.require_inventory(points, index, registry, "fail").collect()
