"""Load-test logs as lines that know their place.

A log is a file ``test.<id>.log``, or a folder of that name with its parts, which follow one another in
the order of their names. It is read in splits like any large text file, so its size has no limit. Each
line carries its split (``block``) and its position there (``seq``): together
they give the order of lines that sections depend on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.logs import test_id

RPS_RECORD = "test_id string, ts timestamp, node string, rps double"


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(test_id, block, seq, line)`` of the logs below a folder; other files are not read."""
    files = spark.read.text(path, recursiveFileLookup=True).where(test_id(F.col("_metadata.file_path")).isNotNull())
    return files.select(
        test_id(F.col("_metadata.file_path")).alias("test_id"),
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
        ).alias("block"),
        # Rows of a split stay in file order, and the id grows within a task.
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def read_log_names(spark: SparkSession, path: str) -> DataFrame:
    """``test_id`` of every log, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(test_id(F.col("path")).alias("test_id")).where("test_id is not null").distinct()


def read_rps_stream(spark: SparkSession, folder: str) -> DataFrame:
    """``(test_id, ts, node, rps)`` as a stream over a growing folder of parquet files."""
    return spark.readStream.schema(RPS_RECORD).parquet(folder)
