"""A written index of words: looked up term by term, and kept up to date as documents come.

``write_index`` lays the scores of all words out by word, so that one word is read from its own files. ``add_documents``
keeps word counts as partial tables of batches that add up; older documents are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.scoring import inverse_document_frequency
from corvane.operators import terms
from corvane.operators.lookup import attach
from corvane.sinks import publish, versions
from corvane.sources.published import read_published

# Folders that words, or titles, are dealt out to by their hash.
BUCKETS = 64


def _bucket(text, buckets):
    return F.pmod(F.xxhash64(text), buckets).cast("int")


def write_index(corpus: DataFrame, folder: str, buckets: int = BUCKETS) -> int:
    """Publish ``(word, title, tf, df, idf, tfidf)`` by buckets of words, each sorted by word and title; the number of rows.

    Rows are dealt out by bucket, and Spark, which sees how large the buckets have become, cuts those with very frequent words into several
    files. Ranges of the order would do it as well, but need a sample, for which all scores are computed once more.
    """
    order = ["bucket", "word", "title"]
    scored = terms.tfidf(corpus).withColumn("buckets", F.lit(buckets)).withColumn("bucket", _bucket("word", F.lit(buckets)))
    return publish(scored.hint("rebalance", F.col("bucket")).sortWithinPartitions(*order), folder, "buckets", "bucket")


def find(spark: SparkSession, folder: str, term: str) -> DataFrame:
    """``(title, tfidf)`` of one word, from the files of its bucket; of these the blocks that cannot hold the word are skipped."""
    own = F.col("bucket") == _bucket(F.lit(term), F.col("buckets"))
    return read_published(spark, folder).where(own & (F.col("word") == term)).select("title", "tfidf")


def _batches(spark: SparkSession, folder: str, kind: str) -> DataFrame | None:
    """The rows of a kind of all batches that were finished."""
    done = versions(spark, f"{folder}/batches")
    found = None
    for entry in done:
        (batch,) = spark.read.parquet(f"{folder}/batches/{entry.name}").collect()
        rows = spark.read.parquet(f"{folder}/{batch.name}/{kind}")
        found = rows if found is None else found.unionByName(rows)
    return found


def add_documents(corpus: DataFrame, folder: str, buckets: int = BUCKETS) -> int:
    """Add the documents ``(title, text)`` to the counts in ``folder``; the number of titles that are new.

    A title that is there already is the same document going on: its words add to what it has, and a word counts for it once. For this the
    counts of such titles are read, from the buckets they lie in; of other titles nothing is. A batch that breaks off is not seen.
    """
    spark = corpus.sparkSession
    name = f"batch-{len(versions(spark, f'{folder}/batches')) + 1}"
    counts = terms.term_frequency(corpus).withColumn("bucket", _bucket("title", F.lit(buckets)))
    counts.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/{name}/tf")
    counts = spark.read.parquet(f"{folder}/{name}/tf")

    titles = corpus.select("title").distinct()
    old_titles, old_counts = _batches(spark, folder, "titles"), _batches(spark, folder, "tf")
    fresh, new_pairs = titles, counts
    if old_titles is not None:
        fresh = titles.join(old_titles, "title", "left_anti")
        again = titles.join(old_titles, "title", "left_semi").withColumn("bucket", _bucket("title", F.lit(buckets)))
        touched = [r.bucket for r in again.select("bucket").distinct().collect()]  # no more than buckets
        known = old_counts.where(F.col("bucket").isin(touched)).join(again.select("title"), "title", "left_semi")
        new_pairs = counts.join(known, ["word", "title"], "left_anti")
    fresh.write.mode("overwrite").parquet(f"{folder}/{name}/titles")
    new_pairs.groupBy("word").agg(F.count("*").alias("df")).write.mode("overwrite").parquet(f"{folder}/{name}/df")
    added = spark.read.parquet(f"{folder}/{name}/titles").count()
    publish(spark.createDataFrame([(name, added)], "name string, titles bigint").coalesce(1), f"{folder}/batches")
    return added


def kept_counts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, int]:
    """``(word, title, tf)``, ``(word, df)`` and the number of titles, of all batches together."""
    tf, df = _batches(spark, folder, "tf"), _batches(spark, folder, "df")
    if tf is None:
        raise FileNotFoundError(f"no documents have been added to {folder}")
    tf = tf.groupBy("word", "title").agg(F.sum("tf").alias("tf"))
    return tf, df.groupBy("word").agg(F.sum("df").alias("df")), _batches(spark, folder, "titles").count()


def kept_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    """``(word, title, tf, df, idf, tfidf)`` of all documents added, as ``terms.tfidf`` gives them for all at once."""
    tf, df, n = kept_counts(spark, folder)
    idf = inverse_document_frequency(F.lit(n), F.col("df"))
    return attach(tf, df, "word", "df").select("word", "title", "tf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))
