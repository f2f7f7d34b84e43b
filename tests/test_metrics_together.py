"""Messages regrouped and encoded by Arrow batches give what columns give, and are written out once."""

import glob

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_metrics import delimited, inventory, message, records

from logforge.functions import otlp
from logforge.operators import association, metrics
from logforge.plans.config import MetricConfig
from logforge.plans.ship import ship_metrics


def scalar(**held):
    return dict.fromkeys(["stringValue", "boolValue", "intValue", "doubleValue"]) | held


VALUES = [
    scalar(stringValue=""), scalar(stringValue="é" * 100), scalar(boolValue=False), scalar(intValue=-1), scalar(intValue=300),
    scalar(doubleValue=-0.0), scalar(), scalar(stringValue="x", raw=b"\x3a\x01x"),
    scalar(arrayValue={"values": [scalar(intValue=0), scalar()]}), scalar(arrayValue={"values": []}),
    scalar(kvlistValue={"values": [{"key": "k" * 150, "value": scalar(raw=b"\x3a\x01y")}, {"key": None, "value": scalar()}]}),
]


def requests():
    points = [{"attributes": [{"key": "k", "value": v}], "count": 1, "sum": None, "rest": r} for v, r in zip(VALUES, [None, b"", b"\x10\x01"] * 4)]
    made = [
        {"name": n, "unit": u, "kind": k, "data_points": p, "data_rest": d, "rest": b"\x12\x01d"}
        for n, u, k, p, d in zip(["n", "", None] * 3, ["u", None, ""] * 3, [None, *otlp.KINDS], [[], points, points[:1]] * 2, [b"", b"\x10\x01"] * 3)]
    whole = [{"scope_metrics": [{"metrics": made, "rest": b""}, {"metrics": [], "rest": b"\x1a\x01s"}], "rest": b"\x1a\x01u"}]
    return [whole, None, [], [{"scope_metrics": [], "rest": None}], whole + whole]


def test_encoded_as_by_columns(spark):
    table = pa.table({"resource_metrics": pa.array(requests(), otlp.RESOURCES)})
    df = spark.createDataFrame(table)
    rows = df.select(otlp.encode_request(F.col("resource_metrics")).alias("a"), otlp.encode_together(F.col("resource_metrics")).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and sum(r.a is None for r in rows) == 1
    with pytest.raises(Exception, match="unknown kind"):
        otlp._encode(pa.array([[{"scope_metrics": [{"metrics": [{"kind": "other"}]}]}]], otlp.RESOURCES))


def test_regrouped_as_by_columns(spark):
    ids = pa.array(range(5), pa.int64())
    df = spark.createDataFrame(pa.table({"record_id": ids, "resource_metrics": pa.array(requests(), otlp.RESOURCES)}))
    points = metrics.explode_points(df)
    for rows in (points, points.union(points)):
        wanted, found = (
            {r.record_id: r.message for r in metrics.encode_metrics(metrics.rebuild_payload(rows, ["record_id"], together), together=together).collect()}
            for together in (False, True))
        assert wanted == found and len(found) == 5


def test_ship_metrics_writes_points_once(spark):
    registry = association.load_registry(spark)
    index = association.build_associations(inventory(spark, [("arn:aws:ec2:eu:1:instance/i-1", "ec2:instance", "alpha")]), registry)
    df = records(spark, [delimited(message(), message("gauge")), delimited(message())]).withColumn("unit", F.lit("u"))
    root, bound = spark.conf.get("spark.checkpoint.dir"), "spark.sql.execution.arrow.maxBytesPerBatch"
    held, before = spark.conf.get(bound), {*glob.glob(f"{root}/*")}
    out = ship_metrics(df, MetricConfig("app", "sub"), index, registry, ["unit"])
    assert spark.conf.get(bound) == held
    written = sorted({*glob.glob(f"{root}/*")} - before)
    assert sum("/points-" in name for name in written) == 1
    # Requests are packed as bytes alone; their resources are those bytes decoded.
    messages = [name for name in written if "/messages-" in name]
    assert spark.read.parquet(*messages).columns == ["unit", "record_id", "msg_idx", "message", "bytes"]
    row = metrics.encode_metrics(out, "again").first()
    assert len(row.resource_metrics) == 3 and row.again == row.message
    with pytest.raises(Exception, match="bad metrics record"):
        ship_metrics(records(spark, [delimited(message()), b"\x05ab"]).withColumn("unit", F.lit("u")), MetricConfig("a", "s"), unit=["unit"])
