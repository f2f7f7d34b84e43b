"""Plans and steps whose cost must not outgrow their input."""

import json
import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logforge.catalog import metrics as metric_queries
from logforge.catalog.registry import Tables
from logforge.functions import otlp
from logforge.functions.text import gzip
from logforge.llm import hashed, quality
from logforge.operators import association, export, framing
from logforge.operators.batching import pack_batches, pack_objects
from logforge.plans.config import LogConfig
from logforge.plans.ship import ship_logs
from logforge.sources import events
from logforge.sources.events import read_cloudwatch
from logforge.sources.paths import read_paths


def test_nested_wire_fields_stay_small(spark):
    # Each level held its value twice: eight levels were 256 copies of the innermost column.
    df = spark.range(1).select(F.lit("ab").cast("binary").alias("value"), F.rand().alias("r"))
    for _ in range(8):
        df = metric_queries._wired(df, "0A")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("octet_length") <= 8
    wire = b"ab"
    for _ in range(8):
        wire = b"\x0a" + bytes([len(wire)]) + wire
    assert bytes(df.first().value) == wire


def test_requests_are_encoded_without_python(spark):
    # Nested rows were sent to Python one by one, at 0.1 ms of Arrow bookkeeping each.
    def value(**held):
        return {"stringValue": None, "boolValue": None, "intValue": None, "doubleValue": None, "arrayValue": None,
                "kvlistValue": None, "raw": None, **held}

    def scalar(**held):
        return {"stringValue": None, "boolValue": None, "intValue": None, "doubleValue": None, **held}

    values = [
        value(stringValue="x" * n) for n in (0, 1, 126, 127, 128, 129, 16383, 16384, 40000)] + [
        value(stringValue="é一😀"), value(boolValue=True), value(boolValue=False), value(doubleValue=-0.0), value(doubleValue=1.5e-300),
        value(doubleValue=float("inf")), value(raw=b"\x3a\x02\xff\x00"), value(), None,
        *[value(intValue=n) for n in (0, 1, 127, 128, -1, -(1 << 63), (1 << 63) - 1, 300, 1 << 35)],
        value(arrayValue={"values": []}), value(arrayValue={"values": None}), value(kvlistValue={"values": []}),
        value(arrayValue={"values": [scalar(stringValue="a" * 200), scalar(intValue=-5), scalar()]}),
        value(kvlistValue={"values": [{"key": "k" * 130, "value": {**scalar(doubleValue=2.5), "raw": None}},
                                      {"key": "", "value": {**scalar(stringValue="both"), "raw": b"\x0a\x01z"}}, {"key": "n", "value": None}]}),
    ]
    attributes = [{"key": f"k{i}", "value": held} for i, held in enumerate(values)]
    point = {"attributes": attributes, "count": 3, "sum": 1.0, "rest": b"\x19abcdefgh"}
    bare = {"attributes": None, "count": None, "sum": None, "rest": None}
    metrics = [
        {"name": "m", "unit": unit, "kind": kind, "data_points": points, "data_rest": b"\x10\x02", "rest": b"\x12\x01d"}
        for unit in (None, "", "Count") for kind in (None, *otlp.KINDS) for points in ([point, bare], [], None)]
    metrics.append({"name": None, "unit": None, "kind": "gauge", "data_points": [bare], "data_rest": None, "rest": None})
    scope = {"metrics": metrics, "rest": b"\x1a\x01s"}
    requests = [
        [{"scope_metrics": [scope, {"metrics": [], "rest": None}, {"metrics": None, "rest": b"\x1a\x00"}], "rest": b"\x1a\x01u"}],
        [{"scope_metrics": None, "rest": None}], [], None]
    table = pa.table({"n": pa.array(range(len(requests))), "r": pa.array(requests, otlp.RESOURCES)})
    wanted = otlp._encode(table["r"].combine_chunks()).to_pylist()
    df = spark.createDataFrame(table).select("n", otlp.encode_request(F.col("r")).alias("m"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert [None if r.m is None else bytes(r.m) for r in df.orderBy("n").collect()] == wanted
    joined = df.filter("m IS NOT NULL").groupBy().agg(F.sort_array(F.collect_list("m")).alias("m")).select(otlp.join_delimited(F.col("m")).alias("d"))
    assert bytes(joined.first().d) == b"".join(otlp.varint(len(m)) + m for m in sorted(m for m in wanted if m is not None))


def test_messages_of_a_batch_are_decoded_together(spark, monkeypatch):
    # One message after the other took 0.1 ms each. Only odd ones may still go that way.
    def pair(key, value):
        return otlp._block(1, key) + otlp._block(2, value)

    def message(*values, kind=11, field=7):
        point = b"\x19abcdefgh" + b"".join(otlp._block(field, pair(b"k", v)) for v in values) + b"\x21\x02\0\0\0\0\0\0\0"
        metric = otlp._block(1, b"m") + otlp._block(kind, otlp._block(1, point) + b"\x10\x02") + otlp._block(3, b"u")
        return otlp._block(1, b"\x1a\x01u" + otlp._block(2, otlp._block(2, metric) + otlp._block(3, b"x")))

    text, number = otlp._block(1, "é".encode()), b"\x18" + otlp.varint((1 << 64) - 5)
    listed = otlp._block(5, otlp._block(1, text) + otlp._block(1, b""))
    nested = otlp._block(6, otlp._block(1, pair(b"in", listed)) + otlp._block(1, pair(b"n", number)))
    plain = [message(text, number, b"", b"\x10\x01", b"\x21abcdefgh", listed, nested, otlp._block(7, b"raw"), otlp._block(5, listed))]
    plain += [message(text, kind=kind, field=field) for kind, field in otlp.KINDS.values()] + [b"", message()]
    odd = [None, b"\xff", message(otlp._block(1, b"\xff")), message(text + number), message(b"\x08\x01"), plain[0][:-3], b"\x0a\x05ab"]
    single = otlp._decode_singly
    mixed = pa.array(plain + odd[:2] + odd[3:] + plain, pa.binary())
    assert otlp._decode(mixed).equals(single(mixed)) and otlp._decode(mixed[3:]).equals(single(mixed[3:]))
    broken = pa.array(plain + odd, pa.binary())
    assert otlp._decode(broken).equals(single(broken))
    monkeypatch.setattr(otlp, "_decode_singly", lambda messages: 1 / 0)
    clean = pa.array(plain * 3, pa.binary())
    assert otlp._decode(clean).equals(single(clean))


def test_subscriptions_are_inflated_once(spark):
    # Every use of the payload inflated and parsed it anew: 85 calls for each row.
    payload = """{"owner":"o","logGroup":"g","logStream":"s","messageType":"m","subscriptionFilters":[],
        "logEvents":[{"id":"1","timestamp":1,"message":"aaaa"},{"id":"2","timestamp":1,"message":" "},{"id":"3","timestamp":1,"message":"bb"}]}"""
    data = F.base64(gzip(F.lit(payload).cast("binary")))
    event = F.to_json(F.struct(F.struct(data.alias("data")).alias("awslogs")))
    df = read_cloudwatch(spark.range(1).select(F.lit("u").alias("unit"), event.alias("event")))
    df = ship_logs(df, LogConfig("CloudWatch", batch_target=205))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("gunzip(") == 1
    assert [(r.pos, r.batch_id, r.body) for r in df.collect()] == [(0, 0, '"aaaa"'), (2, 1, '"bb"')]


def test_objects_are_packed_without_python(spark):
    sizes = [[], [5], [11], [4, 4, 4, 4], [20, 1, 9, 1, 20, 20, 2], [10, 10], [3, 7, 1, 0, 9, 10, 0]]
    rows = [(i, ["x" * n + "y" for n in row]) for i, row in enumerate(sizes)] + [(99, None), (98, [" ", "xy", None, "z"])]
    df = pack_objects(spark.createDataFrame(rows, "id int, records array<string>"), target=11, overhead=0)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.id, r.pos, r.batch_id) for r in df.collect())
    want = []
    for i, records in rows:
        held, batch, some = 0, 0, False
        for pos, record in enumerate(records or []):
            if record and record.strip():
                if some and held + len(record) > 11:
                    held, batch = 0, batch + 1
                held, some = held + len(record), True
                want.append((i, pos, batch))
    assert got == sorted(want)


def _sorts_and_hashed_lists(spark, query):
    text = query(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    return sum("- Sort [" in line for line in text.splitlines()), text.count("ObjectHashAggregate")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables are not here")
def test_messages_are_regrouped_without_sorting_them(spark):
    # Lists were hashed, then sorted as nested rows at every level and for the join: 4.6 GB spilled of 6,000,000 lines.
    assert _sorts_and_hashed_lists(spark, metric_queries.metric_batch_totals) == (1, 0)
    assert _sorts_and_hashed_lists(spark, metric_queries.rebuild_payload) == (3, 0)


def test_texts_are_scored_in_small_groups():
    # 256 texts at once were ten arrays of as many characters as they have, whatever their length.
    texts = ["a b " * n for n in (0, 1, 5000, 40_000, 10, 0, 32_000, 1, 70_000)] + ["x"] * 300
    bounds = list(hashed.groups(texts))
    assert [i for a, b in bounds for i in range(a, b)] == list(range(len(texts)))
    assert all(b == a + 1 or sum(map(len, texts[a:b])) <= hashed.GROUP for a, b in bounds) and list(hashed.groups([])) == []
    kept = np.ones(hashed.LEXICAL, bool)
    model = quality.OrdinalModel(np.linspace(-1, 1, quality.WIDTH), np.array([0.1, 0.4]), kept)
    parts = [model.tails(texts[a:b]) for a, b in bounds]
    assert np.allclose(np.concatenate(parts), model.tails(texts), rtol=0, atol=1e-12)


def test_packed_rows_do_not_lie_where_the_input_did(spark, tmp_path):
    # Few batch starts were broadcast and the rows read back where they were mapped: a file of one row group,
    # such as a micro-batch, was then shipped by one task whatever its size.
    rows = spark.range(5000).select((F.col("id") % 50).alias("unit"), F.col("id").alias("pos"), F.lit(10).alias("size"))
    rows.coalesce(1).write.parquet(str(tmp_path / "rows"))
    df = pack_batches(spark.read.parquet(str(tmp_path / "rows")), ["unit"], ["pos"], "size", 2100, 200)
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "AQEShuffleRead local" not in plan
    assert sorted((r.unit, r.pos, r.batch_id) for r in found) == sorted(
        (i % 50, i, i // 50 // 10) for i in range(5000))


def test_cells_beyond_an_integer_cost_no_exception(spark):
    # A failing cast was tried for each of them, at ten times the cost of a cell that fits.
    cells = {
        "2147483647": "2147483647", "2147483648": '"2147483648"', "-2147483648": "-2147483648", "-2147483649": '"-2147483649"',
        "+0005": "5", "-0": "0", "000000000000000000000007": "7", "00002147483647": "2147483647", "9999999999": '"9999999999"',
        "99999999999999999999": '"99999999999999999999"', "": '""', "+": '"+"', " 1": '" 1"', "1.0": '"1.0"'}
    df = spark.createDataFrame([(c,) for c in cells], "c string").select("c", framing.typed_cell(F.col("c")).alias("json"))
    assert {r.c: r.json for r in df.collect()} == cells

    def seconds(first):
        numbers = F.array((F.col("id") + first).cast("string"))
        df = spark.range(0, 200_000, 1, 1).select(F.array_join(F.transform(numbers, framing.typed_cell), ",").alias("c"))
        took = []
        for _ in range(4):
            begin = time.perf_counter()
            df.agg(F.max("c")).collect()
            took.append(time.perf_counter() - begin)
        return min(took)

    assert seconds(10**11) < 4 * seconds(10**6)


def test_only_what_comes_out_of_an_envelope_is_classified_again(spark):
    # Each level of unwrapping parsed every event anew, whatever it was.
    notice = '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"k"}}}]}'
    queued = json.dumps({"Records": [{"messageId": "m", "body": notice}, {"messageId": "n", "body": "{x"}]})
    rows = [("plain", notice), ("once", queued), ("twice", json.dumps({"Records": [{"messageId": "o", "body": queued}]})), ("none", None)]
    df = events._unwrap_levels(spark.createDataFrame(rows, "unit string, event string"), "event", 3)
    assert sorted((r.unit, r.event_kind, r.event) for r in df.collect() if r.event) == [
        ("once", "S3", notice), ("once", "unsupported", "{x"), ("plain", "S3", notice),
        ("twice", "S3", notice), ("twice", "unsupported", "{x")]
    assert [r.event_kind for r in df.collect() if r.event is None] == ["unsupported"]
    plan = df.select("event_kind")._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json(CASE WHEN isnull(_kind") == 3


def test_short_objects_share_batches(spark, tmp_path):
    # An Arrow batch for each of them took four times as long as reading it.
    for i in range(50):
        (tmp_path / f"{i}.log").write_bytes(b"a\nb" if i % 5 else b"\xff\nc")
    (tmp_path / "7.log").write_text("\n".join(map(str, range(20_000))))
    names = [(str(tmp_path / f"{i}.log"), i) for i in range(51)]
    rows = read_paths(spark.createDataFrame(names, "path string, n int"), tasks=1).collect()
    found = {}
    for r in rows:
        found.setdefault(r.n, []).append((r.seq, r.log, (r.error or "")[:14]))
    assert found.pop(7) == [(i, str(i), "") for i in range(20_000)]
    assert found.pop(50) == [(None, None, "cannot be read")]
    for i, lines in found.items():
        assert lines == ([(0, "a", ""), (1, "b", "")] if i % 5 else [(0, None, "not UTF-8"), (1, "c", "")])


def test_points_are_worked_out_once_for_their_tags(spark):
    # Sets and points were both worked out from the source.
    registry = association.load_registry(spark, [{"namespace": "N/S", "resource_types": ["x"], "arn_patterns": ["r/(?P<Id>[0-9]+)$"]}])
    tags = F.array(F.struct(F.lit("Team").alias("key"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("value")))
    inventory = spark.range(5).select(
        F.concat(F.lit("arn:aws:x:eu:1:r/"), F.col("id").cast("string")).alias("arn"), F.lit("x").alias("resource_type"),
        tags.alias("tags"), F.col("id").alias("pos"))
    dims = F.array(F.struct(F.lit("Id").alias("key"), (F.col("id") % 7).cast("string").alias("value")))
    points = spark.range(70).select("id", F.upper(F.concat(F.lit("n/"), F.when(F.col("id") >= 0, "s"))).alias("namespace"),
                                    F.when(F.col("id") != 69, dims).alias("dims"))
    df = association.associate_tags(points, association.build_associations(inventory, registry), registry)
    assert "upper(" not in df._jdf.queryExecution().optimizedPlan().toString()
    found = {r.id: r.tags and r.tags[0].value for r in df.collect()}
    assert found == {i: f"t{i % 7}" if i % 7 < 5 and i != 69 else None for i in range(70)}
