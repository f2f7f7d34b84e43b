"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    result = duck.execute(oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in places) for row in result.fetchall()), key=repr)
    assert found == wanted


def test_hot_unit_against_brute_force(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").orderBy("event_id").collect()
    wanted, held, batch = {}, None, 0
    for row in events:
        size = 200 + (3000 if row.event_id % 37 == 0 else len(row.props) + len(row.event_type))
        if held is not None and held + size > 20_000:
            held, batch = size, batch + 1
        else:
            held = size + (held or 0)
        wanted[row.event_id] = batch
    df = queries()["pack_batches_hot_unit"](spark, FOLDER)
    assert {r.event_id: r.batch_id for r in df.collect()} == wanted
