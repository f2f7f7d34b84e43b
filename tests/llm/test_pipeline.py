"""The pipeline: every stage against plain Python on what the stage before kept."""

import corpus_pipeline
import duckdb
import pytest

from __spark_entry__ import queries
from logforge.llm import packing, secret_scan, simhash

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return [df.toPandas() for df in out]


def test_columns(stages):
    for df in stages[:-1]:
        assert list(df.columns) == COLUMNS


def test_quality_keeps_clean_documents(stages):
    labels = duckdb.sql(f"SELECT doc_id FROM '{FOLDER}/labels.parquet' WHERE quality = 1 AND toxic = 0").df()
    clean = set(labels.doc_id)
    kept = set(stages[1].doc_id)
    assert len(clean & kept) / len(clean) > 0.97 and len(kept) < len(stages[0])


def test_one_of_each_group_stays(stages):
    before, after = stages[1], stages[2]
    prints = {i: simhash.fingerprint_of(t) % 2**64 for i, t in zip(before.doc_id, before.text)}
    root = {p: p for p in prints.values()}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p in root:
        for q in root:
            if bin(p ^ q).count("1") <= 2:
                root[find(p)] = find(q)
    least = {}
    for i, p in prints.items():
        least[find(p)] = min(i, least.get(find(p), i))
    assert sorted(after.doc_id) == sorted(least.values())


def test_secrets_go(stages):
    before, after = stages[2].set_index("doc_id"), stages[3].set_index("doc_id")
    assert set(before.index) == set(after.index)
    for i, row in after.iterrows():
        assert not secret_scan.scan(row.text)[0] and row.n_chars == len(row.text)
        if row.text != before.text[i]:
            assert secret_scan.scan(before.text[i])[0]


def test_mixing_keeps_half_the_tokens(stages):
    before, after = stages[3], stages[4]
    share = after.text.str.split().str.len().sum() / before.text.str.split().str.len().sum()
    assert 0.3 < share < 0.7 and set(after.doc_id) < set(before.doc_id)


def test_all_tokens_are_packed(stages):
    tokens = stages[5].groupby("doc_id").length.sum()
    assert dict(tokens) == {i: packing.count_tokens(t) for i, t in zip(stages[4].doc_id, stages[4].text)}


def test_run_is_registered(spark, stages):
    assert queries()["pipeline"](spark, FOLDER).count() == len(stages[5])
