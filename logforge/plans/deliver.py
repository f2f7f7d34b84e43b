"""Sinks: where requests go, and what came of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.operators.export import delivery_outcome

# A sink takes requests (one row each, with their keys) and returns one row per attempt:
# the keys, ``attempt``, ``status``, ``rejected``, ``message_present``.
Sink = Callable[[DataFrame], DataFrame]


def file_sink(path: str, keys: list[str], parallelism: int | None = None, run: str | None = None) -> Sink:
    """Write requests as a table under ``path``; what can be read back was delivered.

    Each run has a folder of its own, named ``run`` or, by default, after the set of keys sent:
    sending the same requests again replaces them, and a run reports only its own. Readers
    of the whole table find the folder as the column ``run``. ``parallelism`` bounds the
    concurrent writers only: the work before them keeps its own tasks.
    """

    def send(requests: DataFrame) -> DataFrame:
        rows, name = requests, run
        if name is None:
            sent = requests.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*keys)), F.sum(F.crc32(F.to_json(F.struct(*keys)).cast("binary")))).first()
            name = "-".join(str(x or 0) for x in sent)
        if parallelism:
            rows = rows.repartition(parallelism)
        folder = f"{path.rstrip('/')}/run={name}"
        rows.write.mode("overwrite").parquet(folder)
        stored = requests.sparkSession.read.parquet(folder)
        return stored.select(
            *keys,
            F.lit(1).alias("attempt"),
            F.lit("ok").alias("status"),
            F.lit(0).alias("rejected"),
            F.lit(False).alias("message_present"),
        )

    return send


def deliver(requests: DataFrame, sink: Sink, unit: list[str], batch: str = "batch_id") -> DataFrame:
    """Send requests and judge each unit: all of its batches must get through."""
    return delivery_outcome(sink(requests), unit, batch)
