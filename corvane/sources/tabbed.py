"""Tab-separated text files with positional fields: corpus, arcs, node mapping.

Empty fields at the end of a line are no fields. A line is rejected if it lacks a field that is
read, or if a title or id in it is empty, as nothing could be found by that. Rejected lines are
dropped and can be counted (``LineCount``), or stop the job if ``strict``. Paths may use any scheme the
cluster has a file system for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources.rejects import LineCount, checked

# Field positions, counted from 0, and the fields a line must have.
CORPUS_TITLE, CORPUS_TEXT, CORPUS_FIELDS = 1, 3, 4
ARC_SRC, ARC_DST, ARC_FIELDS = 0, 1, 2
NODE_ID, NODE_TITLE, NODE_FIELDS = 0, 1, 1


def _field(place: int) -> Column:
    return F.get("fields", F.lit(place))


def _empty(place: int) -> Column:
    return F.coalesce(_field(place), F.lit("")) == ""


def _too_few(needed: int) -> Column:
    """Whether no field from the last needed one on holds anything; a field before one that does may be empty."""
    rest = F.slice("fields", F.lit(needed), F.greatest(F.size("fields") - needed + 1, F.lit(0)))
    return _empty(needed - 1) & ~F.exists(rest, lambda x: x != "")


def _fields(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.split("value", "\t").alias("fields"))


def _kept(spark: SparkSession, path: str, needed: int, keys: tuple[int, ...], strict: bool, count: LineCount | None) -> DataFrame:
    rejected = reduce(lambda a, b: a | b, map(_empty, keys), _too_few(needed))
    why = f"fewer than {needed} fields or an empty title or id"
    return checked(_fields(spark, path), rejected, F.col("value"), why, strict, count)


def short_rows(spark: SparkSession, path: str, needed: int) -> DataFrame:
    """``rejected``, the number of lines with too few fields, by a scan of its own."""
    return _fields(spark, path).agg(F.count_if(_too_few(needed)).alias("rejected"))


def read_corpus(spark: SparkSession, path: str, strict: bool = False, count: LineCount | None = None) -> DataFrame:
    """``(title, text)`` of a text dump."""
    rows = _kept(spark, path, CORPUS_FIELDS, (CORPUS_TITLE,), strict, count)
    return rows.select(_field(CORPUS_TITLE).alias("title"), _field(CORPUS_TEXT).alias("text"))


def read_arcs(spark: SparkSession, path: str, strict: bool = False, count: LineCount | None = None) -> DataFrame:
    """``(src, dst)``, one row per arc, repeats included."""
    rows = _kept(spark, path, ARC_FIELDS, (ARC_SRC, ARC_DST), strict, count)
    return rows.select(_field(ARC_SRC).alias("src"), _field(ARC_DST).alias("dst"))


def read_nodes(spark: SparkSession, path: str, strict: bool = False, count: LineCount | None = None) -> DataFrame:
    """``(id, title)`` of a node mapping; the title is null where the line has none."""
    rows = _kept(spark, path, NODE_FIELDS, (NODE_ID,), strict, count)
    return rows.select(_field(NODE_ID).alias("id"), F.nullif(_field(NODE_TITLE), F.lit("")).alias("title"))
