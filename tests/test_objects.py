"""Objects that the catalog writes are bounded, whatever rows a task has."""

import glob
from collections import Counter

from __spark_entry__ import queries


def test_read_objects_bounds_its_objects(spark, tmp_path):
    texts = [f"line {i % 7}\n\nof {i}" for i in range(2500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    root = spark.conf.get("spark.checkpoint.dir")
    before = {*glob.glob(f"{root}/objects-*")}
    found = {r.line: r.n for r in queries()["read_objects"](spark, str(tmp_path)).collect()}
    assert found == Counter(line for text in texts for line in text.split("\n") if line)
    (written,) = {*glob.glob(f"{root}/objects-*")} - before
    assert len(glob.glob(f"{written}/*.txt.gz")) == 3
