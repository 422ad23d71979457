"""Results as tab-separated text."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvane.functions.logs import log_name


def _lines(rows: DataFrame) -> DataFrame:
    """Plain tab-separated lines: nothing is quoted or escaped."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
    return rows.select(F.concat_ws("\t", *fields).alias("value"))


def write_tsv(rows: DataFrame, folder: str) -> None:
    """All rows, as many files as the result has partitions; an older result is replaced."""
    _lines(rows).write.mode("overwrite").text(folder)


def write_ranked_tsv(best: DataFrame, folder: str) -> None:
    """A short ranked list as one file in rank order.

    Meant for the few rows of a ``top_k``, which already sit in one partition.
    """
    _lines(best).coalesce(1).write.mode("overwrite").text(folder)


def write_logs(lines: DataFrame, folder: str) -> None:
    """Lines ``(test_id, block, seq, line)`` as logs, each a folder ``log=test.<id>.log`` of parts in order.

    Lines are dealt out by ranges of their order, so a long log is written by several tasks.
    """
    order = ["log", "block", "seq"]
    named = lines.select(log_name(F.col("test_id")).alias("log"), "block", "seq", F.col("line").alias("value"))
    sorted_lines = named.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_lines.select("log", "value").write.mode("overwrite").partitionBy("log").text(folder)


# What a published folder says of each version: where it is and how many rows it has.
MANIFEST = "version int, name string, rows bigint"


def versions(spark: SparkSession, folder: str) -> list:
    """The manifest of a published folder, oldest version first; empty where nothing has been published."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("version", "name").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def publish(rows: DataFrame, folder: str, *partition_by: str) -> int:
    """Write a result beside the older ones of ``folder`` and make it the current one; the number of its rows.

    Rows are counted by the pass that writes them. Only then one row of the manifest names the new version,
    so a write that breaks off leaves the old result as it was. One writer at a time.
    """
    spark = rows.sparkSession
    metrics, name = Observation(), f"data-{uuid.uuid4().hex}"
    counted = rows.observe(metrics, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(*partition_by).parquet(f"{folder}/{name}")
    have = versions(spark, folder)
    entry = (have[-1].version + 1 if have else 1, name, metrics.get["rows"])
    spark.createDataFrame([entry], MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return entry[2]
