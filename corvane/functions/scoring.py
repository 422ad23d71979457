"""The two scoring formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The share of rank every node keeps, and the share that travels.
BASE_RANK = 0.15
DAMPING = 0.85
FIRST_RANK = 1.0


def inverse_document_frequency(n: Column, df: Column) -> Column:
    """``ln(n / df)`` without smoothing: a word of every document scores zero.

    Null for a word of no document.
    """
    return F.log(F.try_divide(n, df))


def damped(
    contribution: Column, redistributed: Column, damping: float = DAMPING, base: float = BASE_RANK
) -> Column:
    """A node's new rank."""
    return F.lit(base) + F.lit(damping) * (contribution + redistributed)
