"""Column expressions that turn marked-up text into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a tag, as a written-out line break and as a separator.
TAG = r"<[^>\n\r\u0085\u2028\u2029]*+>"
WRITTEN_NEWLINE = "\\n"
NON_LETTERS = r"[^\p{L}]+"
LETTERS_ONLY = r"^\p{L}+$"


def clean(text: Column) -> Column:
    """Lower-case letters, with single spaces for tags, digits and punctuation.

    A tag does not reach over a line end. The ``\\n`` that is replaced is the
    two characters backslash and n, as found in text dumps.
    """
    untagged = F.lower(F.regexp_replace(text, TAG, " "))
    joined = F.replace(untagged, F.lit(WRITTEN_NEWLINE), F.lit(" "))
    return F.trim(F.regexp_replace(joined, NON_LETTERS, " "))


def words(text: Column) -> Column:
    """All words of the text in order; a text without letters gives one empty string."""
    return F.split(clean(text), " ")


def occurrences(text: Column, term: str) -> Column:
    """How often the cleaned text holds exactly this word.

    A word cannot span what cleaning removes, so it must stand in the lower-cased
    raw text as it is: texts without it skip the cleaning.
    """
    found = F.size(F.filter(words(text), lambda word: word == F.lit(term)))
    possible = F.lit(term).rlike(LETTERS_ONLY) & F.contains(F.lower(text), F.lit(term))
    return F.when(possible, found).otherwise(0).cast("bigint")
