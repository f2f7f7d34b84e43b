import base64
import gzip
import json
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logforge.functions import labels, naming, text


def rows(spark, values, schema):
    return spark.createDataFrame([(v,) for v in values], schema)


def is_json(value):
    try:
        json.loads(value)
        return True
    except ValueError:
        return False


CASES = [
    '{"a":1}', '{"a":1} x', "12 abc", "12", '"x"', "null", "", "  ", "[1,2]", "1, 2", "1] [2", '{"a":1}] x [',
    "tru", "true", "1.0", '{"a":1,"a":2}', "nan", "-", "{'a':1}", "[1]]", '{"e":1}}', "hello", ' {"a": 1}\n',
]


def test_strict_json(spark):
    df = text.with_json(rows(spark, CASES, "log string"))
    found = {r.log: r.ok for r in df.select("log", F.col("_json").isNotNull().alias("ok")).collect()}
    assert found == {c: is_json(c) for c in CASES}


def test_json_quote_round_trip(spark):
    values = ["plain", 'say "hi"', "tab\tline\n", "back\\slash", "é ü", "\x01", ""]
    df = rows(spark, values, "log string").select("log", text.json_quote(F.col("log")).alias("q"))
    assert all(json.loads(r.q) == r.log for r in df.collect())


def test_gunzip(spark):
    two = gzip.compress(b"hello ") + gzip.compress(b"world" * 50_000)
    values = [two, two[:-20], b"", b"raw", None, two + b"junk"]
    found = [r[0] for r in rows(spark, values, "d binary").select(text.gunzip("d")).collect()]
    whole = b"hello " + b"world" * 50_000
    assert found[0] == whole and found[5] == whole
    assert whole.startswith(bytes(found[1])) and len(found[1]) > 6
    assert found[2] == b"" and found[3] is None and found[4] is None


def test_base64_or_raw(spark):
    values = [base64.b64encode(b"hello world").decode(), "aGk", "aG k=", "plain text", ""]
    df = rows(spark, values, "v string").select(text.utf8_or_null(text.base64_or_raw(F.col("v"))).alias("t"))
    assert [r.t for r in df.collect()] == ["hello world", "aGk", "aG k=", "plain text", ""]


def test_object_key(spark):
    df = rows(spark, ["a+b%2Bc/d%C3%A9.log", "bad%zz+x"], "k string").select(text.object_key(F.col("k")).alias("k"))
    assert [r.k for r in df.collect()] == ["a b+c/dé.log", "bad%zz x"]


@pytest.mark.parametrize("log, path, name", [
    ('{"a":{"b":"x"}}', "a.b", "x"),
    ('{"a":{"b":1.0}}', "a.b", "1.0"),
    ('{"a":{"b":1.50}}', "a.b", "1.5"),
    ('{"a":{"b":18446744073709551615}}', "a.b", "18446744073709551615"),
    ('{"a":{"b":false}}', "a.b", "false"),
    ('{"a":{"b":null}}', "a.b", None),
    ('{"a":{"b":[1]}}', "a.b", None),
    ('{"a":[{"b":1}]}', "a.b", None),
    ('{"a":1,"a":2}', "a", "2"),
    ('{"a":{"b":"x"}} tail', "a.b", None),
])
def test_json_name(spark, log, path, name):
    df = text.with_json(rows(spark, [log], "log string"))
    assert df.select(naming.json_name(F.col("log"), F.col("_json"), path)).first()[0] == name


@pytest.mark.parametrize("template, log, name", [
    ("app", '{"app":"mine"}', "mine"),
    ("app", "text", "app"),
    ("{{ $.app }}", '{"app":"mine"}', "mine"),
    ("{{ $.app }}", "{}", "unknown"),
    ("{{ k }}", "text", "prod/api/v1"),
    ("{{ none }}", "text", "unknown"),
    ("{{ k | r'^([a-z]+)/' }}", "text", "prod"),
    ("{{ k | r'(zzz)|/([a-z]+)/' }}", "text", "api"),
    ("{{ k | r'(?P<my_name>v[0-9])' }}", "text", "v1"),
    ("{{ k | r'^(none)$' }}", "text", "prod/api/v1"),
    ("{{ k | r'(x*)prod' }}", "text", "prod/api/v1"),
    ("before {{ k }}", "text", "prod/api/v1"),
    ("{{ k", "text", "{{ k"),
    ("{{ BAD }}", "text", "unknown"),
])
def test_resolve_name(spark, template, log, name):
    df = spark.createDataFrame([(log, {"k": "prod/api/v1", "gone": None})], "log string, meta map<string,string>")
    df = text.with_json(df)
    column = naming.resolve_name(template, "unknown", F.col("log"), F.col("_json"), F.col("meta"))
    assert df.select(column).first()[0] == name


def test_group_count():
    assert naming.group_count(r"(a)(?:b)[(]\((?P<x>y)(?=z)") == 2


@pytest.mark.parametrize("log, name", [
    ("nothing", "Info"), ("a DEBUG line", "Debug"), ("trace debug", "Verbose"), ("info debug", "Info"),
    ("WARNING info", "Warn"), ("warn Error", "Error"), ("error but fatal", "Critical"), ("kernel PANIC", "Critical"),
])
def test_severity(spark, log, name):
    assert rows(spark, [log], "log string").select(naming.severity(F.col("log"))).first()[0] == name


def test_labels(spark):
    value = "a=1, b = x=y ,=z,q,c=,a=2"
    wanted = {"a": "2", "b": "x=y", "c": ""}
    assert labels.labels_from_text(value) == wanted
    assert rows(spark, [value], "t string").select(labels.parse_labels(F.col("t"))).first()[0] == wanted


@settings(max_examples=20, deadline=None)
@given(st.lists(st.binary(max_size=200), max_size=5))
def test_length_prefix_round_trip(messages):
    from logforge.functions.otlp import read_varint, varint

    record = b"".join(varint(len(m)) + m for m in messages)
    found, at = [], 0
    while at < len(record):
        size, at = read_varint(record, at)
        found.append(record[at : at + size])
        at += size
    assert found == messages


def test_objects_are_inflated_in_small_steps(monkeypatch):
    # A step of 64 KB inflated to 67 MB at once, and a broken one was done again byte by byte.
    steps, make = [], zlib.decompressobj

    class Member:
        def __init__(self, held):
            self.held = held

        def decompress(self, data):
            steps.append(self.held.decompress(data))
            return steps[-1]

        def copy(self):
            return Member(self.held.copy())

        eof = property(lambda self: self.held.eof)
        unused_data = property(lambda self: self.held.unused_data)

    monkeypatch.setattr(text.zlib, "decompressobj", lambda wbits: Member(make(wbits=wbits)))
    deflate = zlib.compressobj(wbits=31)
    packed = deflate.compress(bytes(100 << 20)) + deflate.flush()
    got = text.gunzip.func(pa.array([b"", None, b"no", packed, packed[:-8] + bytes(8)], pa.binary()))
    assert got[:3].to_pylist() == [b"", None, None] and [len(got[i].as_buffer()) for i in (3, 4)] == [100 << 20] * 2
    assert max(map(len, steps)) <= 9 << 20
