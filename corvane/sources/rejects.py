"""How many lines an input has and how many of them were rejected, counted by the pass that does the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvane.session import session_like

# A plan that reads an input in several branches reads it for one of them only; where that one is found to be empty
# and is cut off after all, its counts go with it. So branches stay.
KEEPS_BRANCHES = {"spark.sql.adaptive.optimizer.excludedRules": "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"}


def counting_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` in which any plan gives its counts; ``spark`` itself stays as it is."""
    return session_like(spark, KEEPS_BRANCHES)


class LineCount:
    """The lines of one input, known as soon as a job has read it to its end.

    The counts are observed metrics: each task adds them up beside its work, so they cost no
    second scan. The first finished action over the input sets them. Only a task that
    ran to its end adds to them, but one that is run again for a lost executor adds twice. Inputs of plans
    with several branches are to be read in a ``counting_session``.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self._observation = Observation(name)
        self._watched = False

    def watch(self, rows: DataFrame, rejected: Column) -> DataFrame:
        self._watched = True
        return rows.observe(self._observation, F.count(F.lit(1)).alias("lines"), F.count_if(rejected).alias("rejected"))

    @property
    def lines(self) -> int:
        return self._observation.get["lines"]

    @property
    def rejected(self) -> int:
        return self._observation.get["rejected"]

    def __str__(self) -> str:
        return f"{self.name}: {self.lines} lines, {self.rejected} rejected" if self._watched else f"{self.name}: not read"


def checked(rows: DataFrame, rejected: Column, line: Column, why: str, strict: bool, count: LineCount | None) -> DataFrame:
    """``rows`` without the rejected ones; these are counted, or stop the job if ``strict``."""
    if count is not None:
        rows = count.watch(rows, rejected)
    if strict:
        message = F.concat(F.lit(f"{why}: "), F.left(line, F.lit(200)))
        rejected = F.when(rejected, F.raise_error(message).cast("boolean")).otherwise(False)
    return rows.where(~rejected)
