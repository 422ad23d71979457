"""The best rows by score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(scored: DataFrame, score: str, *ties: str, k: int = 100) -> DataFrame:
    """The ``k`` rows of highest score, equal scores in order of the ``ties`` columns.

    Each task keeps its own best ``k`` rows and only those are merged.
    """
    return scored.orderBy(F.desc(score), *ties).limit(k)


def top_k_per_group(scored: DataFrame, group: str, score: str, *ties: str, k: int = 100) -> DataFrame:
    """The ``k`` rows of highest score of each ``group``, equal scores in order of the ``ties`` columns, with their ``rank`` from 1.

    Each task keeps its own best ``k`` rows of a group before they move, so of a group that all rows belong to one task gets
    ``k`` rows of every other, whatever the data. (Spark sees this in the limit on the rank, for up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` rows, 1000 if not set.)
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), *ties))
    return scored.withColumn("rank", place).where(F.col("rank") <= k)
