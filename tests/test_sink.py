"""The sink: outcomes of every attempt, runs that count or leave nothing, one copy of each request."""

import os
import sys
import types

import pytest
from pyspark.sql import functions as F

from logforge.operators.export import delivery_outcome
from logforge.plans.sink import RequestWriter, read_delivered, send_requests

KEYS = ["unit", "batch_id"]


def requests(spark, n, text="p"):
    return spark.range(n).select(
        F.concat(F.lit("u"), (F.col("id") % 7).cast("string")).alias("unit"), F.col("id").alias("batch_id"),
        F.concat(F.lit(text), F.col("id").cast("string")).alias("payload")).repartition(4)


@pytest.mark.parametrize("again", ["batch_id % 3 = 0", "unit = 'u2'", "true", "false"])
def test_resending_any_part_leaves_one_copy(spark, tmp_path, again):
    path, df = f"file://{tmp_path}/sink", requests(spark, 60)
    first = send_requests(df, path, KEYS)
    assert first.count() == 60 and first.filter("status = 'ok'").count() == 60
    second = send_requests(requests(spark, 60, "q").filter(again), path, KEYS)
    expected = {r["batch_id"] for r in df.filter(again).collect()}
    assert {r["batch_id"] for r in second.collect()} == expected
    got = read_delivered(spark, path, df, KEYS).collect()
    assert len(got) == 60
    assert all(r["payload"] == ("q" if r["batch_id"] in expected else "p") + str(r["batch_id"]) for r in got)


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    path, df = str(tmp_path / "sink"), requests(spark, 40)
    bad = df.withColumn("payload", F.when(F.col("batch_id") == 17, F.raise_error(F.lit("boom"))).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="boom"):
        send_requests(bad, path, KEYS)
    assert not any(files for _, _, files in os.walk(tmp_path))
    assert read_delivered(spark, path, df, KEYS).count() == 0
    send_requests(df.limit(0), path, KEYS)
    assert read_delivered(spark, path, df, KEYS).count() == 0
    send_requests(df, path, KEYS)
    assert read_delivered(spark, path, df, KEYS).count() == 40


def test_uncommitted_files_do_not_count(spark, tmp_path):
    path, df = str(tmp_path / "sink"), requests(spark, 5)
    send_requests(df, path, KEYS)
    for folder in ("payload", "outcomes"):
        source = next((tmp_path / "sink" / folder).glob("run=*"))
        os.makedirs(tmp_path / "sink" / folder / "run=lost")
        for i, file in enumerate(source.glob("*.parquet")):
            (tmp_path / "sink" / folder / "run=lost" / f"x{i}.parquet").write_bytes(file.read_bytes())
    assert read_delivered(spark, path, df, KEYS).count() == 5


def test_attempts_of_a_sender(monkeypatch, tmp_path):
    import threading

    import pyarrow as pa
    import pyarrow.parquet as pq

    module, calls, lock, now, most = types.ModuleType("sender_under_test"), {}, threading.Lock(), [0], [0]

    def post(request):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            n = calls[request["batch_id"]] = calls.get(request["batch_id"], 0) + 1
        threading.Event().wait(0.01)
        with lock:
            now[0] -= 1
        kind = request["batch_id"] % 4
        if kind == 1 and n == 1:
            raise ConnectionError("reset")
        return {"status": "unavailable" if kind == 2 else "ok", "rejected": 1 if kind == 3 else 0, "message": "m" if kind == 0 else None}

    module.post = post
    monkeypatch.setitem(sys.modules, "sender_under_test", module)
    writer = RequestWriter({"path": str(tmp_path), "run": "r", "keys": '["unit","batch_id"]', "sender": "sender_under_test:post",
                            "concurrency": "3", "attempts": "2"})
    batch = pa.RecordBatch.from_pydict({"unit": ["u"] * 8, "batch_id": list(range(8)), "payload": ["x"] * 8})
    message = writer.write(iter([batch]))
    writer.commit([message, None])
    assert (message.requests, message.delivered) == (8, 4) and most[0] <= 3
    rows = pq.read_table(message.files[0]).to_pylist()
    by_batch = {b: [(r["attempt"], r["status"]) for r in rows if r["batch_id"] == b] for b in range(4)}
    assert by_batch == {0: [(1, "ok")], 1: [(1, "ConnectionError: reset"), (2, "ok")], 2: [(1, "unavailable"), (2, "unavailable")], 3: [(1, "ok")]}
    assert not (tmp_path / "payload").exists() and (tmp_path / "commits" / "00000001.json").exists()
    writer.commit([])
    assert (tmp_path / "commits" / "00000002.json").exists()


def test_outcomes_judge_units(spark, tmp_path):
    outcome = delivery_outcome(send_requests(requests(spark, 21), str(tmp_path), KEYS), ["unit"])
    assert {(r["delivered"], r["batches"]) for r in outcome.collect()} == {(True, 3)}
