"""Requests per second of running tests, from a stream ``(test_id, ts, node, rps)``.

One-minute windows stand for the log's minute sections. A window is final, and
written once, when the watermark has passed its end; rows that come later than
that are dropped. State holds one sum per test and open window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_totals(stream: DataFrame, window: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """``(test_id, window_start, total_rps)``."""
    totals = (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window).alias("window"), "test_id")
        .agg(F.sum("rps").alias("total_rps"))
    )
    return totals.select("test_id", F.col("window.start").alias("window_start"), "total_rps")


def write_final_windows(totals: DataFrame, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append windows to parquet files as they become final.

    ``checkpoint`` must be on shared storage: with it a restarted query goes on
    where it stopped. With ``once`` the query ends when it has read all that is there.
    """
    writer = totals.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
