"""What several operators share in moving packed blocks of keys between tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import scratch_path

# Characters of text that are handled together, and that share what they have in common before a shuffle.
BUCKET_CHARS = 2 << 20
# Bytes of text whose hashes one range gets: some ten megabytes packed, ten times that in a task's memory.
RANGE_BYTES = 16 << 20


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table written to the folder that the cluster shares: cuts lineage and outlives executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or with as many underscores after it as no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash() -> Column:
    """What stands for a row where a verdict depends on its text alone: equal for equal texts, and the same at every read."""
    return F.xxhash64(F.col("text").cast("string"))


def text_bytes(documents: DataFrame) -> int:
    return documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0


def ranges_for(spark: SparkSession, total: int) -> int:
    """How many ranges the hashes of so many bytes of text are dealt out to: more where there is more, so that none grows."""
    return max(shuffle_partitions(spark), -(-total // RANGE_BYTES))


def bucketed(documents: DataFrame, total: int, chars: int = BUCKET_CHARS) -> DataFrame:
    """``(bucket, doc_id, text)``, dealt by a hash of id and text into buckets of about ``chars`` of the ``total`` bytes.

    The number of buckets follows the text, so a bucket stays small at any size. Only rows that
    are equal in both share a bucket for sure, so many texts of one id, or of none, are dealt out.
    """
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    count = max(1, -(-total // chars))
    bucket = f"cast(pmod(xxhash64(doc_id, text), {count}L) as int)"
    return rows.selectExpr(f"{bucket} as bucket", "doc_id", "text").repartition(
        max(count, shuffle_partitions(documents.sparkSession)), "bucket"
    )
