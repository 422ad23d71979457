"""Results that were published with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.sinks import versions


def read_published(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The current version of a published folder, or an older one.

    The files must hold as many rows as the manifest says, which is counted from their footers.
    """
    entries = [x for x in versions(spark, folder) if version in (None, x.version)]
    if not entries:
        raise FileNotFoundError(f"nothing has been published in {folder}" + ("" if version is None else f" as version {version}"))
    rows = spark.read.parquet(f"{folder}/{entries[-1].name}")
    if (found := rows.count()) != entries[-1].rows:
        raise ValueError(f"{folder}: {found} rows where {entries[-1].rows} were written")
    return rows
