"""The section a running test is filling, and the first section at a target, as a continuing query.

State is kept per test: the sums of its open sections and what its last section has come to. After every
batch a test's last section is given out as far as it is filled. A section is closed by a timer when the watermark has passed
its end; sections close in order, so the first closed one at the target is the first there is, and it is
reported once. Rows that come after their section was closed are dropped.

Records are summed by test and section within each task before they move to their test's state, so a test with
very many records sends one row per section and batch of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corvane.operators.throughput import TARGET
from corvane.session import session_like

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the state store that keyed state with timers needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SUMMED = "test_id string, section timestamp, rps double, ts timestamp"
REPORT = "test_id string, kind string, section timestamp, total_rps double, version bigint"
LATEST, FIRST = "latest", "first"


def keyed_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose streams may hold keyed state; ``spark`` itself stays as it is."""
    return session_like(spark, {STATE_STORE: ROCKSDB})


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by(["test_id", "section"]).aggregate([("rps", "sum"), ("ts", "max")])
        sums = sums.select(["test_id", "section", "rps_sum", "ts_max"]).rename_columns(["test_id", "section", "rps", "ts"])
        yield from sums.combine_chunks().to_batches()


class _Sections(StatefulProcessor):
    """One test's sections; times are milliseconds since the epoch."""

    def __init__(self, length: int, target: float) -> None:
        self.length, self.target = length, target

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "section bigint", "total double")
        self.latest = handle.getValueState("latest", "section bigint, total double, version bigint")
        self.first = handle.getValueState("first", "section bigint")

    def _row(self, key: tuple, kind: str, section: int, total: float, version: int) -> pd.DataFrame:
        start = pd.to_datetime([section], unit="ms", utc=True)
        return pd.DataFrame({"test_id": [key[0]], "kind": [kind], "section": start, "total_rps": [total], "version": [version]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        sums: dict[int, float] = {}
        for batch in rows:
            starts = (batch["section"] - pd.Timestamp(0, tz=batch["section"].dt.tz)) // pd.Timedelta(milliseconds=1)
            for section, rps in zip(starts, batch["rps"].fillna(0.0), strict=True):
                sums[int(section)] = sums.get(int(section), 0.0) + float(rps)
        last, total, version = self.latest.get() if self.latest.exists() else (None, 0.0, 0)
        changed = False
        for section, rps in sums.items():
            if section + self.length <= timerValues.getCurrentWatermarkInMs():
                continue
            if self.open.containsKey((section,)):
                rps += self.open.getValue((section,))[0]
            else:
                self.handle.registerTimer(section + self.length)
            self.open.updateValue((section,), (rps,))
            if last is None or section >= last:
                last, total, changed = section, rps, True
        if changed:
            self.latest.update((last, total, version + 1))
            yield self._row(key, LATEST, last, total, version + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        section = expiredTimerInfo.getExpiryTimeInMs() - self.length
        total = self.open.getValue((section,))[0]
        self.open.removeKey((section,))
        if total >= self.target and not self.first.exists():
            self.first.update((section,))
            yield self._row(key, FIRST, section, total, 0)


def watched_sections(stream: DataFrame, target: float = TARGET, length: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """``(test_id, kind, section, total_rps, version)`` from a stream ``(test_id, ts, node, rps)`` of a ``keyed_session``.

    Rows of kind ``latest`` give the last section of a test as far as it is filled, the highest ``version`` being the newest;
    a row of kind ``first`` gives the first section at the target. Records without a test or a time are dropped; a value that is null adds nothing.
    """
    if stream.sparkSession.conf.get(STATE_STORE) != ROCKSDB:
        raise ValueError("read the stream in a session from keyed_session")
    rows = stream.where("test_id is not null and ts is not null").select(
        "test_id", F.window("ts", length)["start"].alias("section"), F.col("rps").cast("double").alias("rps"), "ts"
    )
    millis = int(pd.Timedelta(length) / pd.Timedelta(milliseconds=1))
    return (
        rows.mapInArrow(_summed, SUMMED)
        .withWatermark("ts", lateness)
        .groupBy("test_id")
        .transformWithStateInPandas(_Sections(millis, target), REPORT, "Append", "EventTime")
    )


def write_sections(reports: DataFrame, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the reports to parquet files; with ``checkpoint`` on shared storage a restarted query goes on where it stopped."""
    writer = reports.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_sections(reports: DataFrame) -> DataFrame:
    """``(test_id, section, total_rps)``: the newest report of each test's last section."""
    newest = reports.where(F.col("kind") == LATEST).groupBy("test_id").agg(F.max_by(F.struct("section", "total_rps"), "version").alias("r"))
    return newest.select("test_id", "r.section", "r.total_rps")


def first_sections(reports: DataFrame) -> DataFrame:
    """``(test_id, section, total_rps)``: the first section at the target, of tests that have one."""
    return reports.where(F.col("kind") == FIRST).select("test_id", "section", "total_rps")
