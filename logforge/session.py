"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # JSON objects may repeat a key; the last one wins, as in most JSON parsers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Objects and payloads are large cells: bound Arrow batches by bytes, not only rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.session.timeZone": "UTC",
    # Rows that lie in order are grouped as they come. Hashed, many groups of lists are sorted after
    # all, as whole nested rows, and spilled.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # The codec of metric messages is functions inside functions, resolved one level at a time.
    "spark.sql.analyzer.maxIterations": "400",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings above to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, a folder that driver and executors share. Only
    a local session (one process, one disk) may leave that unset and gets a temporary
    folder; on a cluster a folder of one machine would lose rows, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="logforge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where costly rows (a Python transform, decoded messages) feed several branches of
    one plan: they are computed once, and a lost executor does not bring them all back.

    With ``rows``, Arrow batches on the way there are bounded by so many rows and not by bytes, for rows whose
    size is known: to bound a batch by bytes, every nested row makes Spark size each of its vectors anew,
    which takes ten times as long as to hand it to Python.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    bounds = {} if rows is None else {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str((1 << 31) - 1)}
    before = {key: spark.conf.get(key) for key in bounds}
    try:
        for key, value in bounds.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.parquet(path)
