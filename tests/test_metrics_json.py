"""Metric messages in their JSON form."""

import json

from pyspark.sql import functions as F

from logforge.functions.text import strict_object
from logforge.operators.metrics import explode_points, finish_points, flatten_points, rebuild_payload
from logforge.operators.metrics_json import decode_metrics_json, encode_metrics_json

VALUES = [
    {"stringValue": 'a"b\n'}, {"boolValue": False}, {"intValue": "-7"}, {"doubleValue": 1.5}, {"doubleValue": "NaN"},
    {"bytesValue": "AAE="}, {"arrayValue": {"values": [{"stringValue": "x"}, {"intValue": "1"}]}}, {"arrayValue": {"values": []}},
    {"arrayValue": {"values": [{"arrayValue": {"values": [{"boolValue": True}]}}]}},
    {"kvlistValue": {"values": [{"key": "k", "value": {"stringValue": "v"}},
                                {"key": "deep", "value": {"kvlistValue": {"values": [{"key": "z", "value": {"intValue": "3"}}]}}}]}}]
POINT = {"attributes": [{"key": f"k{i}", "value": v} for i, v in enumerate(VALUES)], "count": "3", "sum": 4.25,
         "startTimeUnixNano": "1", "timeUnixNano": "2", "quantileValues": [{"quantile": 0.5, "value": 7.0}]}
MESSAGE = {"resourceMetrics": [
    {"resource": {"attributes": [{"key": "r", "value": {"stringValue": "s"}}]}, "scopeMetrics": [
        {"scope": {"name": "n"}, "schemaUrl": "u", "metrics": [
            {"name": "m1", "unit": "Count", "description": "d", "summary": {"dataPoints": [POINT, {"attributes": []}]}},
            {"name": "m2", "sum": {"dataPoints": [{"attributes": [], "asInt": "5"}], "isMonotonic": True, "aggregationTemporality": 2}},
            {"name": "m3", "unit": "1", "exponentialHistogram": {"dataPoints": []}}, {"name": "none"}]},
        {"metrics": []}]},
    {"scopeMetrics": []}]}


def messages(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "record_id long, message string")


def test_nothing_is_lost(spark):
    df = decode_metrics_json(messages(spark, json.dumps(MESSAGE)))
    back = json.loads(encode_metrics_json(df).first()["message"])
    assert back == MESSAGE
    points = explode_points(df)
    again = encode_metrics_json(rebuild_payload(points.drop("error"), ["record_id"])).first()["message"]
    assert json.loads(again) == MESSAGE


def test_points_are_as_the_binary_form_gives_them(spark):
    points = explode_points(decode_metrics_json(messages(spark, json.dumps(MESSAGE)))).collect()
    assert sorted((r["name"] or "", r["kind"] or "", r["dp_idx"]) for r in points if r["m_idx"] is not None) == [
        ("m1", "summary", 0), ("m1", "summary", 1), ("m2", "sum", 0), ("m3", "exponential_histogram", None), ("none", "", None)]
    first = next(r for r in points if r["name"] == "m1" and r["dp_idx"] == 0)
    assert (first["count"], first["sum"], first["metric_unit"]) == (3, 4.25, "Count")
    values = [a["value"] for a in first["attributes"]]
    assert values[0]["stringValue"] == 'a"b\n' and values[2]["intValue"] == -7 and values[1]["boolValue"] is False
    assert [v["stringValue"] or v["intValue"] for v in values[6]["arrayValue"]["values"]] == ["x", 1]
    assert values[8]["raw"] is not None and values[9]["kvlistValue"]["values"][1]["value"]["raw"] is not None


def test_operators_work_on_them(spark):
    dims = {"kvlistValue": {"values": [{"key": "InstanceId", "value": {"stringValue": "i-1"}}]}}
    point = {"attributes": [{"key": "Dimensions", "value": dims}], "count": 2, "timeUnixNano": "9"}
    text = json.dumps({"resourceMetrics": [{"scopeMetrics": [{"metrics": [{"name": "m", "unit": "x", "summary": {"dataPoints": [point]}}]}]}]})
    points = explode_points(decode_metrics_json(messages(spark, text))).drop("error")
    done = finish_points(flatten_points(points), "app", "sub", {"env": "p"})
    out = json.loads(encode_metrics_json(rebuild_payload(done, ["record_id"])).first()["message"])
    metric = out["resourceMetrics"][0]["scopeMetrics"][0]["metrics"][0]
    assert metric["unit"] == "" and metric["summary"]["dataPoints"][0]["timeUnixNano"] == "9"
    assert [a["key"] for a in metric["summary"]["dataPoints"][0]["attributes"]] == [
        "InstanceId", "env", "cx.application.name", "cx.subsystem.name"]


def test_bad_messages(spark):
    df = decode_metrics_json(messages(spark, "{}", "[]", "no json", None, '{"resourceMetrics":[]} x', '{"resourceMetrics":5}'))
    got = {r["record_id"]: (r["error"], r["resource_metrics"]) for r in df.collect()}
    assert got[0] == (None, []) and got[3] == (None, None) and got[5] == (None, [])
    assert {got[i][0] for i in (1, 2, 4)} == {"bad metrics message"}


def test_no_python_in_the_plan(spark):
    df = encode_metrics_json(decode_metrics_json(messages(spark, "{}").filter(F.col("record_id") >= 0)))
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()


def test_json_messages_are_tested_without_their_schema(spark):
    # The schema of each whole message was worked out to see that it is an object.
    texts = [' {"resourceMetrics":[]}', "[{}]", '"{"', "{} x", '{"a":[1]}', '{"a":1e999}', '{"a":1E+0400}', '{"a":"1e999"}', "{" , "null", None,
             '{"a":' + "9" * 400 + "}", '{"a":"' + "9" * 400 + '"}', '{"a":0.' + "0" * 400 + "1}", '{"a":"\\ud800"}', "{}] [{}", "\u000b{}", "1,{}", "{},1"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "n int, message string")
    got = decode_metrics_json(df)
    assert "schemaOfVariant" not in got._jdf.queryExecution().executedPlan().toString()
    good = {r.n for r in got.collect() if r.resource_metrics is not None}
    assert good == {0, 4, 7, 12, 13}
    strict = df.select("n", strict_object(F.col("message")).alias("ok"))
    assert {r.n for r in strict.collect() if r.ok} == good


def test_texts_are_read_through_as_strictly_as_parsed(spark):
    from logforge.functions.text import whole_object

    texts = [
        "{}", ' {"a":[1,{"b":null}]}\n', '{"a":1}}', '{"a":1}],[', '{"a":1},{"b":2}', '{"a":1},0', '{"a":1},"f":2', "[1]", "", "{",
        '{"a":1,}', '{"a":01}', '{"a":NaN}', '{"a":"\\q"}', '{"a":"\\ud800"}', '{"a":1e400}', '{"a":' + "9" * 400 + "}", '{"a":"x\ty"}',
        "{'a':1}", '{"a":"it\'s"}', '{"a":1} x', '{"a":1}//x', '{"a":' * 1100 + "1" + "}" * 1100, '{"a":"]"}', '{"a":1,"a":2}', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", whole_object(F.col("t")).alias("a"), strict_object(F.col("t")).alias("b")).collect()
    assert [r.t for r in rows if r.a != r.b] == [] and sum(r.a for r in rows) == 5
