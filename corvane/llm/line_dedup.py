"""Line deduplication across documents, with the result as bitmaps.

A line's key is the line without white space at its ends, A-Z in lower case; a key counts from ``MIN_CHARS``
characters on. Lines of a key that several documents hold are dropped in all of them but that of the
smallest id. Hashes of the keys are dealt out by ranges and sorted by hash, document and position, so the first occurrence comes first and every later document's lines are seen after it.
Per document the lines to drop come back as one row of runs, a bitmap compressed by run
length; the texts are not moved for this. ``apply_bitmaps`` cuts them by the runs. All of it is DataFrame functions.

A line that very many documents hold is not dealt out: a frequent-items sketch over all lines finds every hash of at least
``1 / HOT_KEYS`` of them, so these are fewer than ``HOT_KEYS`` by arithmetic. Of each the smallest document is
aggregated, in the tasks first, and this small table is broadcast to the lines where they are. The sketch
only chooses the way; either way gives the same result.

Lines are equal when their 64-bit hashes are.

Nulls and edge cases: a null or empty text is one empty line. Rows of one id count as one document: none of them is
the smaller, so repeated rows keep what they share only with each other; rows of one id with different
texts each get their own bitmap. A null ``doc_id`` comes after all others and counts as one document. An empty
table gives an empty result. Other columns are not read, or passed through by ``apply_bitmaps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.exchange import written

MIN_CHARS = 10
HOT_KEYS = 20_000
# The sketch's error is at most 1 / (0.75 * SKETCH_ITEMS) of all lines, so no hash of 1 / HOT_KEYS is missed.
SKETCH_ITEMS = 1 << 16
# A key of fewer lines is never dealt with apart.
LEAST_HOT = 1_000

# White space that is stripped, and the letters that are lowered.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Lines of one character a byte are lowered by the faster function, which would change other letters, too."""
    stripped = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(stripped) == F.length(stripped), F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER))


def _rows(documents: DataFrame) -> DataFrame:
    """``(doc, copy, doc_id, text)``: the place of the id in the order of documents, and a hash that tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("copy"))


def lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(hash, doc_id, copy, at)`` of every line whose key counts; ``at`` counts a text's lines from 0."""
    split = _rows(documents).select("doc_id", "copy", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = split.select("doc_id", "copy", "at", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(F.xxhash64("key").alias("hash"), "doc_id", "copy", "at")


def hot_hashes(found: DataFrame, hot_keys: int = HOT_KEYS, least: int = LEAST_HOT) -> DataFrame:
    """``(hash)`` of at least ``1 / hot_keys`` of the lines and no fewer than ``least``: at most ``hot_keys`` rows."""
    sketch = found.agg(F.expr(f"approx_top_k(hash, {hot_keys}, {SKETCH_ITEMS})").alias("top"), F.count("*").alias("total")).first()
    share = max(least, sketch["total"] // hot_keys)
    hot = [(x["item"],) for x in sketch["top"] or () if x["count"] >= share]
    return found.sparkSession.createDataFrame(hot, "hash bigint")


def _later(doc_id: Column, first: Column) -> Column:
    """Whether a document comes after the first one that holds the key."""
    return ~doc_id.eqNullSafe(first)


def dropped_lines(found: DataFrame, hot_keys: int = HOT_KEYS, least: int = LEAST_HOT) -> DataFrame:
    """``(doc_id, copy, at)`` of the lines that an earlier document holds as well; ``found`` is a written table of ``lines``."""
    hot = F.broadcast(hot_hashes(found, hot_keys, least))
    firsts = found.join(hot, "hash", "left_semi").groupBy("hash").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("least"))
    firsts = F.broadcast(firsts.selectExpr("hash", "least.doc_id as first"))  # no more rows than hot hashes
    of_hot = found.join(firsts, "hash").where(_later(F.col("doc_id"), F.col("first")))

    order = [F.col("doc_id").asc_nulls_last(), F.col("copy"), F.col("at")]
    dealt = found.join(hot, "hash", "left_anti").repartitionByRange("hash").sortWithinPartitions("hash", *order)
    stream = Window.partitionBy("hash").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_others = dealt.withColumn("first", F.first("doc_id").over(stream)).where(_later(F.col("doc_id"), F.col("first")))
    return of_hot.select("doc_id", "copy", "at").unionByName(of_others.select("doc_id", "copy", "at"))


def _dropped_runs(dropped: DataFrame) -> DataFrame:
    """``(doc_id, copy, runs)``: each document's dropped lines as runs; a list is bounded by its text."""
    places = dropped.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_set("at")).alias("at"))
    starts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) < x - 1))
    ends = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > x + 1))
    runs = F.zip_with("starts", "ends", lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("n")))
    return places.select("doc_id", "copy", starts.alias("starts"), ends.alias("ends")).select("doc_id", "copy", runs.alias("runs"))


def line_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, hot_keys: int = HOT_KEYS, least: int = LEAST_HOT) -> DataFrame:
    """``(doc_id, copy, runs)`` of the documents that lose lines: ``runs`` are the dropped lines as ``(start, n)``, ascending; all others are kept.

    ``copy`` is a hash of the text, as several texts may have one id.
    """
    found = written(lines(documents, min_chars), "lines")
    return _dropped_runs(dropped_lines(found, hot_keys, least))


def _kept_text(text: Column, runs: Column) -> Column:
    """The lines between the dropped runs, each stretch cut out as a whole."""
    split = F.split(text, "\n")
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["n"])
    end = lambda split, i: F.coalesce(F.get(runs, i)["start"], F.size(split))
    stretches = lambda split: F.transform(F.sequence(F.lit(0), F.size(runs)), lambda i: F.slice(split, begin(i) + 1, end(split, i) - begin(i)))
    # The split text is bound to a lambda's variable, so that it is made once.
    return F.transform(F.array(split), lambda x: F.array_join(F.flatten(stretches(x)), "\n"))[0]


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)`` per row of ``documents (doc_id, text)`` after the drops of ``line_bitmaps``."""
    rows, bits = _rows(documents).alias("d"), bitmaps.alias("b")
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.copy") == F.col("b.copy"))
    text, runs = F.col("text"), F.col("runs")
    dropped = F.aggregate(runs, F.lit(0), lambda n, x: n + x["n"])
    return rows.join(bits, same, "left").select(
        F.col("d.doc_id").alias("doc_id"),
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(dropped, F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(runs.isNull(), text).otherwise(_kept_text(text, runs)).alias("kept_text"),
    )


def remove_repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, hot_keys: int = HOT_KEYS, least: int = LEAST_HOT) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)`` per row of ``documents (doc_id, text)``."""
    return apply_bitmaps(documents, line_bitmaps(documents, min_chars, hot_keys, least))
