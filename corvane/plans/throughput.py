"""The measuring job: from a folder of test logs to throughput against a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import logs as L
from corvane.operators import throughput as T
from corvane.sources.logs import read_log_lines, read_log_names
from corvane.sources.rejects import LineCount


def throughput_report(
    spark: SparkSession, logs_path: str, target: float = T.TARGET, count: LineCount | None = None
) -> DataFrame:
    """``(test_id, total_rps, first_minute)`` per log: the latest throughput, and the
    first minute at the target or null. ``count`` takes as rejected the lines that are neither header nor value."""
    lines = read_log_lines(spark, logs_path)
    if count is not None:
        lines = count.watch(lines, ~(L.is_header(F.col("line")) | L.is_value(F.col("line"))))
    return T.rps_report(lines, read_log_names(spark, logs_path), target)
