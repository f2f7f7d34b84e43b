import json
import random

import pytest
from pyspark.sql import functions as F

from logforge.operators import batching, body, export, filters, framing, ordering, transform
from logforge.plans.config import LogConfig
from logforge.plans.ship import frame_source, ship_logs


def framed(spark, text, frame, **options):
    df = spark.createDataFrame([("u", text)], "unit string, text string")
    rows = framing.explode_records(frame(df).drop("text"), **options)
    return [r.log for r in rows.orderBy("pos").collect()]


def test_lines(spark):
    assert framed(spark, "\na\n\nb\n", framing.frame_lines) == ["a", "", "b", ""]
    assert framed(spark, "", framing.frame_lines) == [""]


def test_multiline_separator_and_block(spark):
    text = "first\nentry<|>second\nentry"
    frame = lambda df: framing.frame_lines(df, r"<\|>")
    assert framed(spark, text, frame) == ["first\nentry", "second\nentry"]
    assert framed(spark, text, frame, block="second") == ["first\nentry"]


def test_look_ahead(spark):
    text = "2024-01 a\n more\n2024-02 b"
    assert framed(spark, text, lambda df: framing.frame_lines(df, r"\n(?=\d{4}-)")) == ["2024-01 a\n more", "2024-02 b"]


def test_sampling_counts_blanks(spark):
    text = "\n".join(["0", "", "2", "block", "3", "", "5"])
    assert framed(spark, text, framing.frame_lines, block="block", sample=2) == ["0", "2", ""]


def test_delimited(spark):
    text = "timestamp,id,severity,message\n t, 5,+7,a\"b\r\n\nx,2147483648,007,p,surplus\ny"
    found = [json.loads(r) for r in framed(spark, text, framing.frame_delimited)]
    assert found == [
        {"timestamp": " t", "id": " 5", "severity": 7, "message": 'a"b\r'},
        {"timestamp": "x", "id": "2147483648", "severity": 7, "message": "p"},
        {"timestamp": "y", "id": "", "severity": "", "message": ""},
    ]


def test_delimited_custom_header_and_tab(spark):
    frame = lambda df: framing.frame_delimited(df, "\\t", header="time\tclient")
    assert [json.loads(r) for r in framed(spark, "a\tb\n1\tx", frame)] == [{"time": 1, "client": "x"}]


def test_extended_format(spark):
    text = "#Version: 1.0\n#Fields: date x(Host) n\n2024\thost\t5\n"
    assert [json.loads(r) for r in framed(spark, text, framing.frame_cloudfront)] == [{"date": 2024, "x(Host)": "host", "n": 5}]
    assert framed(spark, "#Version: 1.0", framing.frame_cloudfront) == []


def test_vpc_flow(spark):
    text = "version  account-id\taction\n2 123456789010 ACCEPT\n"
    assert [json.loads(r) for r in framed(spark, text, framing.frame_vpc_flow)] == [
        {"version": 2, "account-id": "123456789010", "action": "ACCEPT"}
    ]


def test_json_array(spark):
    text = '{"Records":[{"b":1,"a":[1.0,"x"]},"s",null]}'
    assert [json.loads(r) for r in framed(spark, text, framing.frame_json_array)] == [{"b": 1, "a": [1.0, "x"]}, "s", None]
    for other in ('{"Records":5}', "{}", "text", '{"Records":[1]} x'):
        assert framed(spark, other, framing.frame_json_array) == []


def reference_batches(sizes, target, overhead):
    ids, held, batch = [], None, 0
    for size in sizes:
        size += overhead
        if held is not None and held + size > target:
            held, batch = size, batch + 1
        else:
            held = size + (held or 0)
        ids.append(batch)
    return ids


@pytest.mark.parametrize("seed, span", [(1, 3), (2, 7), (3, 64), (4, 100_000)])
def test_pack_batches(spark, seed, span):
    pick = random.Random(seed)
    rows, wanted = [], {}
    for unit in [None, "a", "b", "c"]:
        sizes = [pick.choice([0, 1, 10, 100, 500, 3000]) for _ in range(pick.choice([1, 40, 300]))]
        for pos, (size, batch) in enumerate(zip(sizes, reference_batches(sizes, 1000, 20))):
            rows.append((unit, pos, size))
            wanted[unit, pos] = batch
    df = spark.createDataFrame(rows, "unit string, pos bigint, size int")
    packed = batching.pack_batches(df, ["unit"], ["pos"], "size", 1000, 20, span=span)
    assert {(r.unit, r.pos): r.batch_id for r in packed.collect()} == wanted
    numbered = ordering.ordered_position(df, ["unit"], ["pos"], span=span)
    assert all(r.position == r.pos for r in numbered.collect())
    kept = filters.stride_sample(df, 7, ["unit"], ["pos"], span=span)
    assert {(r.unit, r.pos) for r in kept.collect()} == {k for k in wanted if k[1] % 7 == 0}


def test_split_by_size(spark):
    rows = [("fits", i, 10, "g") for i in range(3)] + [("halved", i, 60, f"g{i % 2}") for i in range(5)] + [
        ("bad", 0, 10, "g"), ("bad", 1, 900, "g")]
    df = spark.createDataFrame(rows, "batch string, pos bigint, size int, name string")
    split = batching.split_by_size(df, ["batch"], ["pos"], 250, "size", ["name"], 20, 50)
    found = {(r.batch, r.pos): r.request_id for r in split.collect()}
    assert [found["fits", i] for i in range(3)] == [0, 0, 0]
    # 5 records: 420 bytes; halves of 2 (240) and 3 (300), the latter once more.
    assert [found["halved", i] for i in range(5)] == [0, 0, 1, 2, 2]
    assert found["bad", 0] is None and found["bad", 1] is None


def run_transform(spark, logs, fn, **options):
    df = spark.createDataFrame([(i, log, {"k": str(i)}) for i, log in enumerate(logs)], "id int, log string, meta map<string,string>")
    rows = transform.transform_records(df, fn, **options).orderBy("id", "transform_seq").collect()
    assert all(r.meta == {"k": str(r.id)} for r in rows)
    return rows


@pytest.mark.parametrize("result", [None, "text", {"a": 1}, 42, True])
def test_transform_wants_a_list(spark, result):
    rows = run_transform(spark, ['{"a":1}'], lambda event: result)
    assert [r.log for r in rows] == ['{"a":1}'] and "expected a list" in rows[0].transform_error


def test_transform_values(spark):
    def fn(event):
        return [event["big"], event["f"], "kept as is", [1, None], {"é": True}]

    rows = run_transform(spark, ['{"big": 18446744073709551615, "f": 1e-7}'], fn)
    assert [json.loads(r.log) if r.log[0] != "k" else r.log for r in rows] == [
        18446744073709551615, 1e-7, "kept as is", [1, None], {"é": True}]


def test_transform_bad_values_pass_through(spark):
    logs = ["1", "2", "3", "NaN"]
    results = {1: [float("nan")], 2: [{1: "x"}], 3: [1 / 3], "NaN": ["was text"]}
    rows = run_transform(spark, logs, lambda event: results[event])
    assert [r.log for r in rows][:2] == ["1", "2"] and rows[3].log == "was text"
    assert [r.transform_error is None for r in rows] == [False, False, True, True]


def test_transform_unusable_function(spark):
    df = spark.createDataFrame([("a",)], "log string")
    assert transform.transform_records(df, {}).first().log == "a"
    with pytest.raises(TypeError):
        transform.transform_records(df, {}, on_error="fail")


def test_native_forms(spark):
    df = spark.createDataFrame(
        [(0, '{"logs":[{"a":1},"s",null]}'), (1, '{"logs":{"a":1}}'), (2, '{"logs":[]}'), (3, "text")], "id int, log string")
    found = [(r.id, r.log) for r in transform.unnest(df).orderBy("id", "transform_seq").collect()]
    assert found == [(0, '{"a":1}'), (0, "s"), (0, "null"), (1, '{"logs":{"a":1}}'), (3, "text")]
    df = spark.createDataFrame([('{"message":"pass=1 $x","n":1.0}',), ('{"message":5}',)], "log string")
    found = [json.loads(r.log) for r in transform.redact(df, r"pass=(\d)", "p$$$1", field="message").collect()]
    assert found == [{"message": "p$1 $x", "n": 1}, {"message": 5}]


BODIES = [
    ('{"a":1.0}', {}, [], {}, {"a": 1.0}),
    ("text", {}, [], {}, "text"),
    ("text", {"s3.bucket": "b"}, ["s3.bucket", "nope"], {}, {"message": "text", "s3.bucket": "b"}),
    ("text", {}, ["s3.bucket"], {}, "text"),
    ('{"a":1}', {"s3.bucket": "b"}, ["bucket_name"], {"env": "p"}, {"message": {"a": 1}, "bucket_name": "b", "env": "p"}),
    ("text", {"s3.bucket": "b"}, ["s3.bucket"], {"s3.bucket": "mine"}, {"message": "text", "s3.bucket": "mine"}),
    ("text", {"cw.tags": '{"t":"1"}'}, [], {}, {"text": "text", "cw.tags": {"t": "1"}}),
    ('{"a":1}', {"cw.tags": '{"t":"1"}'}, [], {}, {"a": 1, "cw.tags": {"t": "1"}}),
    (" { } ", {"cw.tags": '{"t":"1"}'}, [], {}, {"cw.tags": {"t": "1"}}),
    ("[1]", {"cw.tags": '{"t":"1"}'}, [], {}, {"message": [1], "cw.tags": {"t": "1"}}),
    ('"q"', {"cw.tags": '{"t":"1"}'}, [], {}, {"text": "q", "cw.tags": {"t": "1"}}),
    ("text", {"cw.tags": '{"t":"1"}'}, [], {"env": "p"}, {"message": "text", "env": "p", "cw.tags": {"t": "1"}}),
    ("text", {"cw.tags": "broken"}, [], {}, "text"),
]


@pytest.mark.parametrize("log, meta, keys, labels, wanted", BODIES)
def test_body(spark, log, meta, keys, labels, wanted):
    df = spark.createDataFrame([(log, meta)], "log string, meta map<string,string>")
    assert json.loads(body.build_body(df, keys, labels).first().body) == wanted


def test_group_resources_orders(spark):
    rows = [(0, 2, "b", "x", '"2"'), (0, 1, "b", "x", "1"), (0, 3, "a", "x", '{"k":[true,null]}')]
    df = spark.createDataFrame(rows, "batch int, pos int, application string, subsystem string, body string")
    df = df.withColumns({"severity": F.lit("Error"), "ts": F.timestamp_micros(F.lit(1_000_000))})
    out = export.to_resource_logs(df, ["batch"], ["pos"]).first()
    payload = json.loads(out.payload)["resourceLogs"]
    names = [g["resource"]["attributes"][0]["value"]["stringValue"] for g in payload]
    bodies = [[r["body"] for r in g["scopeLogs"][0]["logRecords"]] for g in payload]
    assert names == ["a", "b"] and out.resources == 2 and out.records == 3
    assert bodies[1] == [{"intValue": "1"}, {"stringValue": "2"}]
    assert bodies[0][0]["kvlistValue"]["values"][0]["value"]["arrayValue"]["values"] == [{"boolValue": True}, {"stringValue": "null"}]
    record = payload[1]["scopeLogs"][0]["logRecords"][0]
    assert record["timeUnixNano"] == "1000000000" and record["severityNumber"] == 17


def test_integrations(spark):
    assert LogConfig("MSK").integration == "Kafka"
    with pytest.raises(ValueError):
        LogConfig("Carrier pigeon")
    other = spark.createDataFrame([("u", "log")], "unit string, log string")
    assert frame_source(other, LogConfig("S3")).count() == 0


def test_ship_defaults(spark):
    df = spark.createDataFrame([("u", "a\n\nerror b", {"s3.bucket": "bkt"})], "unit string, text string, meta map<string,string>")
    rows = ship_logs(df, LogConfig("S3")).orderBy("pos").collect()
    assert [(r.application, r.subsystem, r.severity, r.body, r.batch_id) for r in rows] == [
        ("bkt", "bkt", "Info", '"a"', 0), ("bkt", "bkt", "Error", '"error b"', 0)]
