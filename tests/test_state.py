"""Streams with state: retries and tags, across restarts."""

import datetime

import pytest
from pyspark.sql import functions as F

from logforge.operators.lookup import join_group_tags
from logforge.streaming.state import retry_stream, tag_stream

START = datetime.datetime(2026, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


OUTCOME = "message_id string, event string, error string, ts timestamp"


@pytest.mark.parametrize("restart", [False, True])
def test_three_tries_then_dead(spark, tmp_path, restart):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    # a fails for good; b gets through at its second try; c fails late and waits to the end. The clock
    # rows move event time on.
    steps = [
        [("a", "ea", "e0", at(0)), ("b", "eb", "e0", at(0))],
        [("clock", "", None, at(16))],
        [("a", "ea", "e1", at(17)), ("b", "eb", None, at(17))],
        [("clock", "", None, at(40))],
        [("a", "ea", "e2", at(41)), ("c", "ec", "late", at(41))],
        [("clock", "", None, at(50))],
        [("clock", "", None, at(51))]]

    def run():
        stream = spark.readStream.schema(OUTCOME).option("maxFilesPerTrigger", 1).parquet(str(source))
        query = retry_stream(stream, limit=1, delay_seconds=900).writeStream.format("parquet").option("path", out)
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    for i, step in enumerate(steps):
        write(spark, source, step, OUTCOME)
        if restart:
            # A new query from the same checkpoint for every step.
            run()
    if not restart:
        import os
        import time

        # Files in the order of their steps.
        files = sorted(source.glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
        for i, f in enumerate(files):
            os.utime(f, (time.time() - 100 + i,) * 2)
        run()
    rows = sorted((r["at"], r["message_id"], r["event"], r["route"], r["retry"], r["last_error"]) for r in spark.read.parquet(out).collect())
    assert rows == [
        (at(15), "a", "ea", "retry", 0, "e0"), (at(15), "b", "eb", "retry", 0, "e0"),
        (at(32), "a", "ea", "retry", 1, "e1"), (at(41), "a", "ea", "dead", 1, "e2")]


def test_tags_expire(spark, tmp_path):
    records, snapshots = tmp_path / "records", tmp_path / "snapshots"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    record, snapshot = "log_group string, n int, ts timestamp", "log_group string, tags map<string,string>, fetched_at timestamp"
    all_records, all_snapshots = [], []
    for step in range(3):
        base = 60 * step
        some = [("g", step * 10 + i, at(base + 7 * i)) for i in range(8)] + [("other", step, at(base)), (None, step, at(base))]
        tags = [("g", {"v": str(base)}, at(base + 2)), ("g", {"v": str(base + 20)}, at(base + 20))] if step < 2 else []
        all_records += some
        all_snapshots += tags
        write(spark, records, some, record)
        write(spark, snapshots, tags, snapshot)
        left = spark.readStream.schema(record).parquet(str(records))
        right = spark.readStream.schema(snapshot).parquet(str(snapshots))
        query = tag_stream(left, right, ttl_seconds=1500).writeStream.format("parquet").option("path", out)
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    got = {(r["log_group"], r["n"]): r["tags"] for r in spark.read.parquet(out).withColumn(
        "n", F.get_json_object("row", "$.n").cast("int")).collect()}
    batch = spark.createDataFrame(all_records, record).withColumn("meta", F.lit(None).cast("map<string,string>"))
    want = join_group_tags(batch, spark.createDataFrame(all_snapshots, snapshot), ttl_seconds=1500)
    assert got == {(r["log_group"], r["n"]): (r["meta"] or {}).get("cw.tags") for r in want.collect()}
    assert len({v for v in got.values() if v}) == 4 and None in got.values()
