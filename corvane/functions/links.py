"""Column expressions for hyperlinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a link target is written in a page.
HREF = r'(?<![\w-])href="([^"]*)"'


def link_targets(html: Column) -> Column:
    """All link targets of a page in order, repeats included."""
    return F.regexp_extract_all(html, F.lit(HREF), F.lit(1))
