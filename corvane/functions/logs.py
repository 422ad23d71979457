"""Column expressions for the lines of a load-test log.

A value line is ``node=value``. Values may have a sign and an exponent and may be not finite, and
``\\N`` stands for a node or a value that is null, so any record can be written and read back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log's name (of a file or of a folder of its parts), its section headers and its value lines.
LOG_PATH = r"(?:^|[/=])test\.([0-9]+)\.log(?:/[^/]*)?$"
HEADER = "["
MINUTE_HEADER = r"^\[Minute ([0-9]+)"
VALUE_LINE = r"^([^=]+)=([+-]?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|[+-]?Infinity|NaN|\\N)\s*$"
NULL = "\\N"
# What a node must not hold or be, as the line would then be read as something else.
NO_NODE = r"[=\r\n]|^\[|^\\N$|^$"


def test_id(path: Column) -> Column:
    """The number in ``test.<number>.log``, null if there is none."""
    return F.nullif(F.regexp_extract(path, LOG_PATH, 1), F.lit(""))


def is_header(line: Column) -> Column:
    return F.startswith(line, F.lit(HEADER))


def header_minute(line: Column) -> Column:
    """The n of ``[Minute n]``; null for any other line and for a number beyond any minute."""
    return F.regexp_extract(line, MINUTE_HEADER, 1).try_cast("int")


def is_value(line: Column) -> Column:
    return ~is_header(line) & F.rlike(line, F.lit(VALUE_LINE))


def value_node(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, VALUE_LINE, 1), F.lit(NULL))


def value_rps(line: Column) -> Column:
    return F.regexp_extract(line, VALUE_LINE, 2).try_cast("double")


def value_line(node: Column, rps: Column) -> Column:
    """The line of a record; a node that no line can hold stops the job."""
    bad = F.raise_error(F.concat(F.lit("not a node of a log: "), node)).cast("string")
    written = F.when(node.rlike(NO_NODE), bad).otherwise(node)
    return F.concat(F.coalesce(written, F.lit(NULL)), F.lit("="), F.coalesce(rps.cast("string"), F.lit(NULL)))


def header_line(minute: Column) -> Column:
    return F.concat(F.lit("[Minute "), minute.cast("string"), F.lit("]"))


def log_name(test: Column) -> Column:
    return F.concat(F.lit("test."), test, F.lit(".log"))
