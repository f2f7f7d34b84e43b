"""A sink as a data source: tasks send requests and report what came of each.

    runs of a table at ``path``
    payload/run=…/part-….parquet    requests that got through, if they are stored
    outcomes/run=…/part-….parquet   one row per attempt
    commits/00000001.json           the runs that count, in order

A run counts once its commit file exists, and that is made in one step; a run that fails
is undone. Of a request (its keys) the latest run that delivered it counts, so any part of what
was sent may be sent again: there is one copy of each.
"""

from __future__ import annotations

import importlib
import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Concurrent sends of one task, and attempts for each request.
CONCURRENCY = 10
ATTEMPTS = 3
OUTCOME = [
    ("attempt", pa.int32()), ("status", pa.string()), ("rejected", pa.int64()), ("message_present", pa.bool_())]


def _store(path: str):
    """The file system of an address, and the folder there."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if path.startswith("/") or scheme == "file":
        return fs.LocalFileSystem(), path if path.startswith("/") else "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


@dataclass
class Sent(WriterCommitMessage):
    """What a task reports: its files and counts, however many requests it sent."""

    files: list[str]
    requests: int
    delivered: int


class RequestWriter(DataSourceArrowWriter):
    """Sends each row once per attempt, a bounded number at a time, and writes down every outcome."""

    def __init__(self, options: dict[str, str]):
        self.path, self.run = options["path"], options["run"]
        self.keys = json.loads(options["keys"])
        self.sender = options.get("sender")
        self.concurrency = int(options.get("concurrency", CONCURRENCY))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        store, root = _store(self.path)
        part = f"part-{uuid.uuid4().hex}.parquet"
        files, writers = [], {}

        def put(folder: str, rows: pa.RecordBatch) -> None:
            if folder not in writers:
                name = f"{root.rstrip('/')}/{folder}/run={self.run}"
                store.create_dir(name, recursive=True)
                files.append(f"{name}/{part}")
                writers[folder] = pq.ParquetWriter(files[-1], rows.schema, filesystem=store)
            writers[folder].write_batch(rows)

        send = self._sender()
        requests = delivered = 0
        try:
            with ThreadPoolExecutor(max_workers=self.concurrency) as pool:
                for batch in iterator:
                    if not batch.num_rows:
                        continue
                    tries = list(pool.map(send, batch.to_pylist())) if send else [
                        [(1, "ok", 0, False)]] * batch.num_rows
                    place = pa.array([i for i, t in enumerate(tries) for _ in t], pa.int64())
                    columns = zip(*[x for t in tries for x in t])
                    put("outcomes", pa.RecordBatch.from_arrays(
                        [*[batch.column(k).take(place) for k in self.keys],
                         *[pa.array(list(c), kind) for c, (_, kind) in zip(columns, OUTCOME)]],
                        [*self.keys, *[name for name, _ in OUTCOME]]))
                    good = [t[-1][1] == "ok" and not t[-1][2] for t in tries]
                    requests, delivered = requests + len(good), delivered + sum(good)
                    if not self.sender:
                        put("payload", batch)
        finally:
            for writer in writers.values():
                writer.close()
        return Sent(files, requests, delivered)

    def _sender(self):
        """The function of one request that gives all its attempts; none for plain storing."""
        if not self.sender:
            return None
        module, _, name = self.sender.partition(":")
        call = getattr(importlib.import_module(module), name)

        def send(request: dict) -> list[tuple]:
            tries = []
            while len(tries) < self.attempts and (not tries or tries[-1][1] != "ok"):
                try:
                    answer = call(request) or {}
                    tries.append((
                        len(tries) + 1, str(answer.get("status", "ok")), int(answer.get("rejected") or 0),
                        bool(answer.get("message"))))
                except Exception as fault:  # noqa: BLE001 - a send that fails is an outcome
                    tries.append((len(tries) + 1, f"{type(fault).__name__}: {fault}"[:500], 0, False))
            return tries

        return send

    def commit(self, messages: list[Sent | None]) -> None:
        store, root = _store(self.path)
        folder = f"{root.rstrip('/')}/commits"
        store.create_dir(folder, recursive=True)
        known = [m for m in messages if m is not None]
        entry = {"run": self.run, "at": time.time(), "files": [f for m in known for f in m.files],
                 "requests": sum(m.requests for m in known), "delivered": sum(m.delivered for m in known)}
        number = len(_commit_files(self.path)) + 1
        while not _claim(store, f"{folder}/{number:08d}.json", json.dumps(entry | {"seq": number})):
            number += 1

    def abort(self, messages: list[Sent | None]) -> None:
        store, root = _store(self.path)
        for folder in ("payload", "outcomes"):
            name = f"{root.rstrip('/')}/{folder}/run={self.run}"
            if store.get_file_info(name).type.name == "Directory":
                store.delete_dir(name)


def _commit_files(path: str) -> list[str]:
    from pyarrow import fs

    store, root = _store(path)
    found = store.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/commits", allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".json"))


def _claim(store, name: str, text: str) -> bool:
    """Make a file unless it is there. One writer at a time is assumed in stores without exclusive
    creation."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        try:
            with open(name, "x") as file:
                file.write(text)
            return True
        except FileExistsError:
            return False
    if store.get_file_info(name).type.name != "NotFound":
        return False
    with store.open_output_stream(name) as file:
        file.write(text.encode())
    return True


class RequestSource(DataSource):
    """The data source ``logforge_requests``, for writing; see ``deliver_source``."""

    @classmethod
    def name(cls) -> str:
        return "logforge_requests"

    def writer(self, schema, overwrite: bool) -> RequestWriter:
        return RequestWriter(dict(self.options))


def send_requests(
    requests: DataFrame,
    path: str,
    keys: list[str],
    sender: str | None = None,
    concurrency: int = CONCURRENCY,
    attempts: int = ATTEMPTS,
) -> DataFrame:
    """Send requests (a row each, by ``keys``) and return this run's attempts: ``keys, attempt, status,
    rejected, message_present``, for ``delivery_outcome``.

    ``sender`` names a function (``module:function``) of a request as a dict, which may return
    ``status``, ``rejected`` and ``message``; what it raises is that attempt's status. It is
    called ``attempts`` times at most, by ``concurrency`` threads of each task. Without one,
    requests are stored under ``path``. All outcomes are; the driver gets names of files only.
    """
    spark, run = requests.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(RequestSource)
    options = {"path": path, "run": run, "keys": json.dumps(keys), "concurrency": str(concurrency), "attempts": str(attempts)}
    if sender:
        options["sender"] = sender
    requests.write.format("logforge_requests").mode("append").options(**options).save()
    return read_runs(spark, path, "outcomes", requests, keys).filter(F.col("run") == run).drop("run", "seq")


def read_runs(spark: SparkSession, path: str, folder: str, like: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of all runs that count, with ``run`` and its place ``seq``."""
    commits = _commit_files(path)
    names = keys if folder == "outcomes" else like.columns
    columns = ", ".join([f"`{c}` {like.schema[c].dataType.simpleString()}" for c in names] + (
        ["attempt int", "status string", "rejected bigint", "message_present boolean"] if folder == "outcomes" else []))
    kind = f"{columns}, run string"
    store, root = _store(path)
    if not commits or store.get_file_info(f"{root.rstrip('/')}/{folder}").type.name != "Directory":
        return spark.createDataFrame([], f"{kind}, seq bigint")
    runs = spark.read.schema("run string, seq bigint").json(f"{path.rstrip('/')}/commits")
    rows = spark.read.schema(kind).parquet(f"{path.rstrip('/')}/{folder}")
    return rows.join(runs, "run")


def read_delivered(spark: SparkSession, path: str, like: DataFrame, keys: list[str]) -> DataFrame:
    """The stored requests, one copy of each: the latest of the runs that count. ``like`` has their columns."""
    rows = read_runs(spark, path, "payload", like, keys)
    rest = [c for c in like.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "seq").alias("_last")) if rest else rows.select(*keys).distinct()
    return latest.select(*keys, "_last.*").select(*like.columns) if rest else latest
