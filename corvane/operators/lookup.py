"""An inner join with per-key facts that no frequent key can unbalance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many keys are broadcast; no other key holds more than total / MAX_HOT rows.
MAX_HOT = 100_000
# A key with fewer rows than this never needs special care.
MIN_HOT_ROWS = 200_000


def hot_threshold(total: Column, max_hot: int, min_rows: int) -> Column:
    """Keys with more rows than this are hot; fewer than ``max_hot`` keys can be."""
    return F.greatest(total / F.lit(max_hot), F.lit(float(min_rows)))


def attach(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    weight: str,
    max_hot: int = MAX_HOT,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``rows`` joined with the one row of ``facts`` for their ``key``.

    ``weight`` is a column of ``facts`` that tells how many of ``rows`` carry the
    key, so the frequent keys are known before anything is shuffled. Their facts
    are broadcast - fewer than ``max_hot`` rows whatever the data, since their
    weights share one total - and their rows stay where they are. Only the rows
    of the other keys meet by a shuffle.
    """
    limit = facts.agg(hot_threshold(F.sum(weight), max_hot, min_hot_rows)).scalar()
    hot = facts.where(F.col(weight) > limit)
    cold = facts.where(F.col(weight) <= limit)
    # An outer join, as Spark would push an anti join below the aggregation that
    # made the rows, and so compute them twice.
    looked_up = rows.join(F.broadcast(hot), key, "left")
    in_place = looked_up.where(F.col(weight).isNotNull())
    shuffled = looked_up.where(F.col(weight).isNull()).select(rows.columns).join(cold, key)
    return in_place.unionByName(shuffled)
