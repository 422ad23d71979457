"""Requests per second from the lines of load-test logs.

Lines are ``(test_id, block, seq, line)``: a log is cut into blocks of limited
size, ``block`` orders them and ``seq`` orders the lines within one. A line's
section is that of the last header before it, which may stand in an earlier block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import logs as L

# Fixed value: the throughput a test has to reach, in requests per second.
TARGET = 4000.0


def section_lines(lines: DataFrame) -> DataFrame:
    """``(test_id, section, line)`` for the header and value lines within minute sections.

    ``section`` is ``(block, seq, minute)`` of the section's header, so sections
    order as in the log. Lines are shuffled once, by block; what one block hands
    on to the next is one row per block.
    """
    line = F.col("line")
    whole = lines.where("test_id is not null and block is not null")
    by_block = whole.where(L.is_header(line) | L.is_value(line)).repartition("test_id", "block")
    header_seq = F.when(L.is_header(line), F.col("seq"))

    opened = F.when(L.is_header(line), F.struct("block", "seq", L.header_minute(line).alias("minute")))
    so_far = Window.partitionBy("test_id", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    in_block = by_block.select(
        "test_id", "block", "line", F.last(opened, ignorenulls=True).over(so_far).alias("own")
    )

    block_ends = by_block.groupBy("test_id", "block").agg(
        F.max(header_seq).alias("seq"), F.max_by(L.header_minute(line), header_seq).alias("minute")
    )
    left_open = F.when(F.col("seq").isNotNull(), F.struct("block", "seq", "minute"))
    earlier = Window.partitionBy("test_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = block_ends.select(
        "test_id", "block", F.last(left_open, ignorenulls=True).over(earlier).alias("carried")
    )

    placed = in_block.join(carried, ["test_id", "block"])
    section = F.coalesce("own", "carried")
    return placed.select("test_id", section.alias("section"), "line").where("section.minute is not null")


def rps_records(lines: DataFrame) -> DataFrame:
    """``(test_id, section, is_value, node, rps)``; a header gives a row that is no value,
    so a section that has only begun is there with nothing in it."""
    line = F.col("line")
    return section_lines(lines).select(
        "test_id",
        "section",
        L.is_value(line).alias("is_value"),
        F.when(L.is_value(line), L.value_node(line)).alias("node"),
        F.when(L.is_value(line), L.value_rps(line)).alias("rps"),
    )


def rps_rows(lines: DataFrame) -> DataFrame:
    """``(test_id, minute, node, rps)``, one row per value line."""
    return rps_records(lines).where("is_value").select("test_id", F.col("section.minute").alias("minute"), "node", "rps")


def _total() -> Column:
    return F.coalesce(F.sum("rps"), F.lit(0.0)).alias("total_rps")


def rps_per_minute(lines: DataFrame) -> DataFrame:
    """``(test_id, minute, total_rps)``."""
    return rps_records(lines).groupBy("test_id", F.col("section.minute").alias("minute")).agg(_total())


def rps_latest(lines: DataFrame, tests: DataFrame) -> DataFrame:
    """``(test_id, total_rps)`` of each test's last section, 0 for a log without section."""
    by_section = rps_records(lines).groupBy("test_id", "section").agg(_total())
    latest = by_section.groupBy("test_id").agg(F.max_by("total_rps", "section").alias("total_rps"))
    return tests.join(latest, "test_id", "left").select(
        "test_id", F.coalesce("total_rps", F.lit(0.0)).alias("total_rps")
    )


def rps_report(lines: DataFrame, tests: DataFrame, target: float = TARGET) -> DataFrame:
    """``(test_id, total_rps, first_minute)`` per test: ``rps_latest`` and, or null, ``rps_target``, both from one aggregation by section."""
    by_section = rps_records(lines).groupBy("test_id", "section").agg(_total())
    by_minute = by_section.groupBy("test_id", F.col("section.minute").alias("minute")).agg(
        F.sum("total_rps").alias("total"), F.max("section").alias("last"), F.max_by("total_rps", "section").alias("last_rps")
    )
    by_test = by_minute.groupBy("test_id").agg(
        F.max_by("last_rps", "last").alias("total_rps"), F.min(F.when(F.col("total") >= target, F.col("minute"))).alias("first_minute")
    )
    return tests.join(by_test, "test_id", "left").select("test_id", F.coalesce("total_rps", F.lit(0.0)).alias("total_rps"), "first_minute")


def reached(totals: DataFrame, target: float = TARGET) -> DataFrame:
    """The totals that are at least the target."""
    return totals.where(F.col("total_rps") >= target)


def rps_target(per_minute: DataFrame, target: float = TARGET) -> DataFrame:
    """``(test_id, first_minute)`` for the tests that reached the target."""
    return reached(per_minute, target).groupBy("test_id").agg(F.min("minute").alias("first_minute"))
