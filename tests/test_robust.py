"""Odd records: none is lost without a trace, and none ends a job."""

import gzip as gz
import random

import pytest
from pyspark.sql import functions as F

from logforge.functions import otlp
from logforge.functions.naming import resolve_name
from logforge.functions.text import _gunzip, strict_object, with_json
from logforge.operators.batching import pack_batches
from logforge.operators.body import build_body
from logforge.operators.filters import stride_sample
from logforge.operators.lookup import join_group_tags
from logforge.operators.metrics import _value, value_text
from logforge.operators.ordering import chunked
from logforge.operators.transform import transform_records
from logforge.plans.config import LogConfig
from logforge.plans.deliver import deliver, file_sink
from logforge.plans.ship import failed_rows, ship_logs
from logforge.session import work_dir
from logforge.sources.events import read_cloudwatch, unwrap_envelopes, with_retry_context
from logforge.sources.objects import decode_objects, read_objects
from logforge.streaming.stream import kafka_rows


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return rows.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, good", [
    ('{"a":1}', True), ('{"a":"\\ud83d\\ude00"}', True), ('{"a":"\\\\ud800"}', True), ('{"n":"1e999"}', True), ("1e300", True),
    ('{"a":"\\ud800"}', False), ('{"a":"\\udc00x"}', False), ('{"a":1e999}', False), ("[1.9e308]", False), ("9" * 400, False),
])
def test_strict_json(spark, text, good):
    df = with_json(spark.createDataFrame([(text,)], "log string"))
    assert (df.first()["_json"] is not None) == good


def test_whole_objects_only(spark):
    for text, good in [(' {"a":1} ', True), ('{"a":1} x', False), ("[1]", False), ('{"a":1},{"b":2}', False), ("", False)]:
        assert one(spark, strict_object(F.col("t")), t=text) == good


def test_gunzip_keeps_the_sound_part():
    text = bytes(random.Random(1).choices(b"abcdef \n", k=50_000))
    packed = gz.compress(text)
    assert _gunzip(packed[:-8] + b"\0" * 8) == text
    broken = bytearray(packed)
    broken[len(packed) // 2] ^= 0xFF
    kept = _gunzip(bytes(broken))
    assert len(kept) > 10_000 and kept[:10_000] == text[:10_000]
    assert _gunzip(packed + gz.compress(b"tail")) == text + b"tail"
    assert _gunzip(b"\x1f\x8bnothing") is None


def test_kafka_bytes_are_checked_before_they_are_text(spark):
    rows = spark.createDataFrame(
        [("t", 0, 1, None, bytearray(b"\xff\xfe")), ("t", 0, 2, None, bytearray("é".encode())), ("t", 0, 3, None, bytearray(b"YWJj"))],
        "topic string, partition int, offset long, timestamp timestamp, value binary")
    found = {r["pos"]: (r["log"], r["error"]) for r in kafka_rows(rows).collect()}
    assert found == {1: (None, "not UTF-8"), 2: ("é", None), 3: ("abc", None)}


def test_transform_survives_odd_records(spark):
    deep = "[" * 100_000 + "]" * 100_000
    df = spark.createDataFrame([('{"a":"\\ud800"}',), ("1e999",), (deep,), ('{"a":1}',)], "log string")
    rows = transform_records(df, lambda event: [event]).collect()
    assert [r["log"] for r in rows] == ['{"a":"\\ud800"}', "1e999", deep, '{"a":1}']
    rows = transform_records(df.limit(1), lambda event: ["\ud800"]).collect()
    assert rows[0]["log"] == '{"a":"\\ud800"}' and "UnicodeEncodeError" in rows[0]["transform_error"]


def test_typed_values_of_odd_records(spark):
    for text in ['{"a":"\\ud800"}', "1e999", "[" * 5000 + "]" * 5000]:
        assert one(spark, otlp.to_any_value(F.col("t")), t=text).startswith('{"stringValue":')


def test_bad_base64_payload(spark):
    df = spark.createDataFrame([('{"awslogs":{"data":"%%%"}}',)], "event string")
    row = read_cloudwatch(df).first()
    assert row["payload"] is None and row["error"] == "not base64"


def test_envelopes_of_any_depth_and_their_context(spark):
    import json

    event = '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"k"}}}]}'
    for level in range(6):
        event = json.dumps({"Records": [{
            "messageId": str(level), "body": event, "eventSourceARN": f"arn:{level}",
            "messageAttributes": {"retry": {"stringValue": "2", "dataType": "Number"}}}]})
    df = with_retry_context(spark.createDataFrame([(event,), ("text",)], "event string"), "arn:5")
    rows = {r["event_kind"]: r for r in unwrap_envelopes(df).collect()}
    assert set(rows) == {"S3", "unsupported"}
    assert (rows["S3"]["message_id"], rows["S3"]["retry"], rows["S3"]["from_retry"]) == ("5", "2", True)
    assert rows["unsupported"]["from_retry"] is False


def test_failures_and_mismatches_are_told(spark):
    objects = spark.createDataFrame(
        [("a.gz", bytearray(b"\x1f\x8bxx")), ("b", bytearray(b"\xff")), ("c", bytearray(b"fine"))], "unit string, content binary")
    decoded = decode_objects(objects)
    assert {(r["unit"], r["error"]) for r in failed_rows(decoded).collect()} == {
        ("a.gz", "nothing could be decompressed"), ("b", "not UTF-8")}
    decoded = decoded.withColumn("meta", F.lit(None).cast("map<string,string>"))
    assert ship_logs(decoded, LogConfig("S3")).count() == 1
    assert failed_rows(objects, LogConfig("Kinesis")).count() == 3


def test_suffix_is_pushed_into_the_listing(spark, tmp_path):
    for name in ("a.log", "b.txt", "x[1].log"):
        (tmp_path / name).write_text("x")
    df = read_objects(spark, str(tmp_path), suffix=".log")
    assert {r["unit"].rsplit("/", 1)[-1] for r in df.select("unit").collect()} == {"a.log", "x[1].log"}
    assert len(df.inputFiles()) == 2


def test_sending_again_replaces(spark, tmp_path):
    requests = spark.createDataFrame([("u", 1), ("u", 2)], "unit string, batch_id int")
    sink = file_sink(str(tmp_path / "sent"), ["unit", "batch_id"], parallelism=2)
    first, second = deliver(requests, sink, ["unit"]).collect(), deliver(requests, sink, ["unit"]).collect()
    assert first == second
    assert spark.read.parquet(str(tmp_path / "sent")).count() == 2
    deliver(requests.filter("batch_id = 1"), sink, ["unit"]).collect()
    assert spark.read.parquet(str(tmp_path / "sent")).select("run").distinct().count() == 2


def test_scratch_folder_must_be_shared_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session(), "x")


def test_small_faults(spark):
    none = F.lit(None).cast("map<string,string>")
    name = resolve_name("it's \"x\"", "?", F.lit("{}"), F.lit(None).cast("array<variant>"), none)
    assert spark.range(1).select(name.alias("v")).first()["v"] == "it's \"x\""
    for number, text in [(1e20, "100000000000000000000"), (1.25e-5, "0.0000125"), (-3e-7, "-0.0000003"), (1.5e7, "15000000"), (0.5, "0.5")]:
        value = _value({"doubleValue": F.lit(number)})
        assert spark.range(1).select(value_text(value).alias("v")).first()["v"] == text
    logs = spark.createDataFrame(
        [('{"cw.tags":{"old":"1"},"a":2}', {"cw.tags": '{"new":"1"}'})], "log string, meta map<string,string>")
    assert build_body(logs).first()["body"].count("cw.tags") == 1
    tags = spark.createDataFrame([("g", {"a": "b"}, 5)], "log_group string, tags map<string,string>, at long")
    tags = tags.select("log_group", "tags", F.timestamp_seconds("at").alias("fetched_at"))
    rows = spark.createDataFrame([("g", None, 1)], "log_group string, meta map<string,string>, at long")
    rows = rows.withColumn("ts", F.timestamp_seconds("at"))
    assert join_group_tags(rows, tags, ttl_seconds=0).first()["meta"] == {"cw.tags": '{"a":"b"}'}


@pytest.mark.parametrize("shape", ["spread", "few"])
def test_chunks_follow_the_data(spark, shape):
    rng = random.Random(3)
    rows = [("u", rng.randint(0, 10**12) if shape == "spread" else rng.choice([7, 7, 9]), i, rng.randint(1, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "unit string, at long, id long, size long")
    df = df.withColumn("ts", F.timestamp_micros("at"))
    sizes = chunked(df, ["unit"], ["ts", "id"], None, 100).groupBy("_chunk").count().collect()
    assert 20 <= len(sizes) <= 130 and max(r["count"] for r in sizes) <= 400
    ordered = sorted((r[1], r[2], r[3]) for r in rows)
    batch, held, wanted = 0, None, {}
    for _, key, size in ordered:
        if held is not None and held + size > 200:
            batch, held = batch + 1, size
        else:
            held = size + (held or 0)
        wanted[key] = batch
    packed = pack_batches(df, ["unit"], ["ts", "id"], "size", target=200, overhead=0, span=100)
    assert {r["id"]: r["batch_id"] for r in packed.collect()} == wanted
    sampled = stride_sample(df, 7, ["unit"], ["ts", "id"], span=100)
    assert {r["id"] for r in sampled.collect()} == {key for i, (_, key, _) in enumerate(ordered) if i % 7 == 0}
