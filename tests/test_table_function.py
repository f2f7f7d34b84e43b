"""User transforms from SQL."""

import time
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from logforge.operators.table_function import Analyzed, register_transforms, transform_function
from logforge.operators.transform import transform_records


def doubler():
    """A function that travels with its table function, as one of a notebook does."""

    def double(event):
        if event == "bad":
            raise KeyError("k")
        return [event, {"again": event}]

    return double


LOGS = [(1, "x", 1.5, [1]), (2, None, None, None), (3, "bad", 2.0, []), (4, '{"a":1.0}', 3.0, [2, 3])]


def test_as_the_operator(spark):
    df = spark.createDataFrame(LOGS, "id long, text string, n double, list array<int>")
    register_transforms(spark, double=doubler(), take=lambda e: [])
    got = spark.sql(
        "SELECT * FROM transform_logs(TABLE({df}), fn => 'double', log => 'text')", df=df)
    want = transform_records(df, doubler(), log="text")
    assert got.schema.names == want.schema.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    none = spark.sql("SELECT * FROM transform_logs(TABLE({df}), fn => 'take', log => 'text')", df=df)
    assert [r["id"] for r in none.collect()] == [2]
    joined = spark.sql("""SELECT t.id, count(*) AS n FROM transform_logs(TABLE(SELECT id, text FROM {df} WHERE id <> 2),
        fn => 'double', log => 'text') t GROUP BY t.id""", df=df)
    assert {r["id"]: r["n"] for r in joined.collect()} == {1: 2, 3: 1, 4: 2}


def test_functions_of_modules_and_failing(spark):
    df = spark.createDataFrame([("[1,2]",)], "log string")
    register_transforms(spark)
    rows = spark.sql("SELECT * FROM transform_logs(TABLE({df}), fn => 'builtins:list')", df=df).collect()
    assert [(r["log"], r["transform_seq"], r["transform_error"]) for r in rows] == [("1", 0, None), ("2", 1, None)]
    register_transforms(spark, double=doubler())
    bad = spark.createDataFrame([("bad",)], "log string")
    with pytest.raises(Exception, match="KeyError"):
        spark.sql("SELECT * FROM transform_logs(TABLE({df}), fn => 'double', on_error => 'fail')", df=bad).collect()


@pytest.mark.parametrize("call, wrong", [
    ("fn => 'double', log => 'n'", "no text column"), ("fn => 'nothing'", "names no function"),
    ("fn => 'double', other => 1", "unknown argument"), ("fn => 3", "names no function")])
def test_wrong_calls_fail_when_analysed(spark, call, wrong):
    df = spark.createDataFrame([("a", 1)], "log string, n int")
    register_transforms(spark, double=doubler())
    with pytest.raises(Exception, match=wrong):
        spark.sql(f"SELECT * FROM transform_logs(TABLE({{df}}), {call})", df=df)


def test_rows_go_in_batches_and_keep_their_values(spark):
    # With Arrow the results of each row were a table of their own, at 0.2 ms.
    register_transforms(spark, double=doubler())
    df = spark.sql("""SELECT id, CAST(id AS STRING) AS log, CAST(id + 0.5 AS DECIMAL(9, 3)) AS d, encode('é', 'UTF-8') AS b, DATE '2024-02-29' AS day,
        TIMESTAMP '2024-01-01 00:00:00.123456' AS at, TIMESTAMP_NTZ '2024-01-01 00:00:00.5' AS plain, map('k', TIMESTAMP '1969-12-31 23:59:59.5') AS m,
        named_struct('a', array(TIMESTAMP '2024-06-01 01:00:00', NULL), 'b', 'x') AS s, CAST('NaN' AS DOUBLE) AS n, CAST(NULL AS TIMESTAMP) AS none FROM range(3)""")
    got = spark.sql("SELECT * FROM transform_logs(TABLE({df}), fn => 'double')", df=df)
    assert "ArrowEvalPythonUDTF" not in got._jdf.queryExecution().executedPlan().toString()
    want = transform_records(df, doubler())
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_repeated_hour_is_told_apart(monkeypatch):
    kinds = [T.StringType(), T.TimestampType(), T.ArrayType(T.TimestampType()), T.TimestampNTZType()]
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        instants = [1730610000_000000, 1730613600_000000]
        local = [datetime.fromtimestamp(i // 1_000_000) for i in instants]
        run = transform_function({"id": lambda event: [event]})(Analyzed(T.StructType(), kinds=kinds))
        for instant, at in zip(instants, local):
            [row] = run.eval(Row("log", "at", "list", "plain")("x", at, [at, None], local[0]), "id")
            assert kinds[1].toInternal(row[1]) == instant and kinds[2].toInternal(row[2]) == [instant, None]
            assert row[0] == "x" and row[3] is local[0] and row[4:] == (0, None)
    finally:
        monkeypatch.undo()
        time.tzset()
