"""Operators with state on streams: retries that come back when due, tags that expire."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logforge.operators.failures import RETRY_DELAY, RETRY_LIMIT

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETRIED = "message_id string, event string, route string, retry int, last_error string, at timestamp"
TAGGED = "log_group string, ts timestamp, row string, tags string"


def use_state_store(spark: SparkSession) -> None:
    """State of these operators is kept in RocksDB, on the executors' disks and in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


class Retries(StatefulProcessor):
    """Per message: how often it was tried, and its event until the next try is due."""

    def __init__(self, limit: int, delay_ms: int):
        self.limit, self.delay_ms = limit, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "retry int, event string, error string, due bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        out = []
        every = pd.concat(list(rows)).sort_values("ts", kind="stable")
        for event, error, ts in zip(every["event"], every["error"], every["ts"]):
            known = self.held.get() if self.held.exists() else None
            if known is not None and known[3] >= 0:
                self.handle.deleteTimer(known[3])
                if known[3] <= ts.value // 1_000_000:
                    # Its delay was over before this outcome, though no timer has told yet.
                    out.append((key[0], known[1], "retry", known[0], known[2], pd.Timestamp(known[3], unit="ms")))
            if error is None or pd.isna(error):
                # It got through: nothing is remembered.
                self.held.clear()
                continue
            retry = 0 if known is None else known[0] + 1
            if known is not None and known[0] >= self.limit:
                self.held.clear()
                out.append((key[0], event, "dead", known[0], error, ts))
                continue
            due = int(ts.value // 1_000_000) + self.delay_ms
            self.held.update((retry, event, error, due))
            self.handle.registerTimer(due)
        yield _frame(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        known = self.held.get() if self.held.exists() else None
        out = []
        if known is not None and known[3] == due:
            # The counter stays; the event leaves for its next try.
            self.held.update((known[0], None, known[2], -1))
            out.append((key[0], known[1], "retry", known[0], known[2], pd.Timestamp(due, unit="ms")))
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in RETRIED.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"retry": "int32", "at": "datetime64[ns]"}) if len(frame) else frame.astype(
        {"retry": "int32", "at": "datetime64[ns]", **dict.fromkeys(("message_id", "event", "route", "last_error"), "object")})


def retry_stream(
    outcomes: DataFrame, limit: int = RETRY_LIMIT, delay_seconds: int = RETRY_DELAY, late: str = "0 seconds"
) -> DataFrame:
    """Outcomes of tries as a stream (``message_id, event, error, ts``; no error: it got through) →
    events to be tried again, when their delay is over, and dead ones.

    The counters of ``route_failures``, kept as state: the first failure waits with ``retry``
    0, each further one with one more, and the failure of a message whose counter has
    reached ``limit`` is ``dead``. A waiting event comes out with ``route`` retry once event time
    (the latest ``ts`` less ``late``) has passed its delay. Feed its outcome back in. A
    message that got through, or died, leaves no state.
    """
    use_state_store(outcomes.sparkSession)
    rows = outcomes.select("message_id", "event", F.col("error").cast("string").alias("error"), "ts")
    return rows.withWatermark("ts", late).groupBy("message_id").transformWithStateInPandas(
        Retries(limit, delay_seconds * 1000), RETRIED, "Append", "EventTime")


class Tags(StatefulProcessor):
    """Per log group: its tag snapshots that have not expired."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.snapshots = handle.getValueState("snapshots", "known string")

    def _known(self) -> list[list]:
        return json.loads(self.snapshots.get()[0]) if self.snapshots.exists() else []

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows))
        every["ms"] = every["ts"].astype("datetime64[ms]").astype("int64")
        known = self._known()
        fresh = every[every["tags"].notna()]
        for ms, tags in zip(fresh["ms"], fresh["tags"]):
            known = sorted([k for k in known if k[0] != ms] + [[int(ms), tags]])
            self.handle.registerTimer(int(ms) + self.ttl_ms)
        if len(fresh):
            self.snapshots.update((json.dumps(known),))
        records = every[every["row"].notna()]
        out = []
        for ts, ms, row in zip(records["ts"], records["ms"], records["row"]):
            # The latest snapshot not after the record, if it is young enough.
            held = [k for k in known if k[0] <= ms < k[0] + self.ttl_ms]
            out.append((key[0], ts, row, held[-1][1] if held else None))
        yield pd.DataFrame(out, columns=["log_group", "ts", "row", "tags"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        known = [k for k in self._known() if k[0] + self.ttl_ms > now]
        if known:
            self.snapshots.update((json.dumps(known),))
        else:
            self.snapshots.clear()
        yield pd.DataFrame([], columns=["log_group", "ts", "row", "tags"])

    def close(self) -> None:
        pass


def tag_stream(
    records: DataFrame, snapshots: DataFrame, ttl_seconds: int, group: str = "log_group", late: str = "1 hour"
) -> DataFrame:
    """Records of a stream with the tags of their log group as they were known at their ``ts``.

    ``snapshots(log_group, tags, fetched_at)`` is a stream, too. A snapshot is state of its group for
    ``ttl_seconds`` of event time, then a timer drops it. A record sees the snapshots that came
    with or before its micro-batch. Columns: log_group, ts, row (the record as JSON), tags (JSON).
    """
    use_state_store(records.sparkSession)
    rows = records.select(
        F.col(group).alias("log_group"), F.col("ts"), F.to_json(F.struct(*records.columns)).alias("row"),
        F.lit(None).cast("string").alias("tags"))
    known = snapshots.select(
        "log_group", F.col("fetched_at").alias("ts"), F.lit(None).cast("string").alias("row"), F.to_json("tags").alias("tags"))
    both = rows.unionByName(known).withWatermark("ts", late)
    return both.groupBy("log_group").transformWithStateInPandas(Tags(ttl_seconds * 1000), TAGGED, "Append", "EventTime")
