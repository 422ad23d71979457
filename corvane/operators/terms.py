"""Word counts, document counts and TF-IDF scores of a corpus.

A corpus is a DataFrame ``(title, text)`` without nulls. The title is the
document's key: rows of equal title are one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions.scoring import inverse_document_frequency
from corvane.operators.lookup import MAX_HOT, MIN_HOT_ROWS, attach

# Bytes of cleaned text whose words are counted together.
BLOCK_BYTES = 16 << 20
LISTS = "word string, titles string, tfs array<int>"


def titles(corpus: DataFrame) -> DataFrame:
    return corpus.select("title")


def corpus_size(corpus: DataFrame) -> DataFrame:
    """``n``, the number of distinct titles."""
    return titles(corpus).agg(F.count_distinct("title").alias("n"))


def tokens(corpus: DataFrame) -> DataFrame:
    """One row ``(title, word)`` per word of the cleaned text."""
    return corpus.select("title", F.explode(T.words(F.col("text"))).alias("word")).where("word <> ''")


def term_frequency(corpus: DataFrame) -> DataFrame:
    """``tf``, how often each word occurs in each document."""
    return tokens(corpus).groupBy("word", "title").agg(F.count("*").alias("tf"))


def document_frequency(corpus: DataFrame) -> DataFrame:
    """``df``, the number of documents that hold each word."""
    return tokens(corpus).distinct().groupBy("word").agg(F.count("*").alias("df"))


class _Open(NamedTuple):
    """The counts so far of a document whose next rows may follow: its title, as an array of one, its words and how often each occurs."""

    title: pa.Array
    words: pa.Array
    tfs: np.ndarray


def _block_lists(titles: pa.Array, cleaned: pa.Array, before: _Open | None) -> tuple[pa.RecordBatch, _Open]:
    """``LISTS`` of a block of rows in order of their titles, but for its last document, which is given back open.

    A row for each word: the titles that hold it, one a line, those with most occurrences first. The empty word is held by all, none times.
    """
    lists = pc.split_pattern(cleaned, " ")
    known = before or _Open(titles.slice(0, 0), lists.values.slice(0, 0), np.empty(0, np.int64))
    documents = pa.concat_arrays([known.title, titles]).dictionary_encode(null_encoding="encode")
    count = len(documents.dictionary)
    owner = documents.indices.to_numpy().astype(np.int64)
    words = pa.concat_arrays([pa.array([""], cleaned.type), known.words, lists.flatten()]).dictionary_encode()
    keys = words.indices.to_numpy()[1:] * np.int64(count)
    counted, tokens = keys[: len(known.words)], keys[len(known.words) :]  # those of the open document, the first, are different
    tokens += np.repeat(owner[len(known.title) :], pc.list_value_length(lists).to_numpy())
    found, tfs = np.unique(np.concatenate([np.arange(count), counted, tokens]), return_counts=True)
    tfs[np.searchsorted(found, counted)] += known.tfs - 1
    place, document = np.divmod(found, count)
    tfs[place == 0] = 0

    last = document == owner[-1]
    after = _Open(documents.dictionary.slice(owner[-1], 1), words.dictionary.take(pa.array(place[last])), tfs[last])
    place, document, tfs = place[~last], document[~last], tfs[~last]
    most = tfs.max(initial=0)
    order = np.argsort(place * (most + 1) + (most - tfs), kind="stable")
    first = np.flatnonzero(np.diff(place, prepend=-1))
    bounds = pa.array(np.append(first, len(place)), pa.int32())
    held_by = pc.binary_join(pa.ListArray.from_arrays(bounds, documents.dictionary.take(pa.array(document[order]))), "\n")
    counts = pa.ListArray.from_arrays(bounds, pa.array(tfs[order], pa.int32()))
    return pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(place[first])), held_by, counts], ["word", "titles", "tfs"]), after


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    document = None
    for batch in batches:
        blocks = 1 + batch["text"].nbytes // BLOCK_BYTES
        rows = max(1, -(-len(batch) // blocks))
        for begin in range(0, len(batch), rows):
            block = batch.slice(begin, rows)
            lists, document = _block_lists(block["title"], block["text"], document)
            yield lists
    if document:
        held_by = document.title.take(pa.array(np.zeros(len(document.words), np.int64)))
        counts = pa.ListArray.from_arrays(pa.array(np.arange(len(document.words) + 1), pa.int32()), pa.array(document.tfs, pa.int32()))
        yield pa.RecordBatch.from_arrays([document.words, held_by, counts], ["word", "titles", "tfs"])


def _one_line(title: Column) -> Column:
    """The title without line ends, and never null; ``_title`` gives it back."""
    return F.coalesce(F.replace(F.replace(title, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("%"))


def _title(line: Column) -> Column:
    changed = F.replace(F.replace(line, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
    return F.when(~F.contains(line, F.lit("%")), line).when(line != "%", changed)


def _marked_lists(corpus: DataFrame) -> DataFrame:
    """``LISTS`` of every word of every document, and of the empty word, which each document has zero times.

    Texts are dealt out by title, so that the rows of a document follow one another, and their words are counted by blocks. From
    then on the documents of a block that hold a word move as one list. Lists are dealt out by more than their word, so those of a frequent word
    do not meet in one task. What Spark infers from a join and from taking lists apart holds for all of them; said here, it leaves
    all readers with the same plan below the shuffle.
    """
    cleaned = corpus.select(_one_line(F.col("title")).alias("title"), T.clean(F.col("text")).alias("text")).where("text is not null")
    lists = cleaned.repartition("title").sortWithinPartitions("title").mapInArrow(_word_lists, LISTS)
    return lists.where("word is not null and titles is not null and tfs is not null").repartition("word", "titles")


def tfidf(corpus: DataFrame, max_hot: int = MAX_HOT, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """``(word, title, tf, df, idf, tfidf)`` for every word of every document.

    The corpus is read, cleaned and counted once. For that, every document gets
    the empty word on top of its own words, counted as zero occurrences: its
    document count is then the corpus size, and the largest of all. The per-word
    counts, the corpus size and the scored rows all read the same shuffled
    lists, and meet as lists: only then is there a row for each word of each document. No filter may touch a list
    before the scores exist, or Spark would push it below the shuffle for one reader only and split the plan; the
    empty word is dropped by its ``tf`` of zero.
    """
    lists = _marked_lists(corpus)
    by_word = lists.groupBy("word").agg(F.sum(F.size("tfs")).alias("df"))
    n = by_word.agg(F.max("df")).scalar()
    idf = inverse_document_frequency(n, F.col("df"))
    scored = attach(lists, by_word, "word", "df", max_hot, min_hot_rows).withColumn("idf", idf)
    placed = scored.select("word", "tfs", "df", "idf", F.posexplode(F.split("titles", "\n")).alias("place", "line"))
    counted = placed.withColumn("tf", F.col("tfs")[F.col("place")].cast("bigint")).where("tf > 0")
    return counted.select("word", _title(F.col("line")).alias("title"), "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf_of_term(corpus: DataFrame, term: str) -> DataFrame:
    """``(title, tfidf)`` of one word, for the documents that hold it.

    Equal to the rows of ``tfidf`` for this word, but words are counted where the
    text is read: one number per document is shuffled, not its words.
    """
    hits = corpus.groupBy("title").agg(F.sum(T.occurrences(F.col("text"), term)).alias("tf"))
    idf = hits.agg(inverse_document_frequency(F.count("*"), F.count_if(F.col("tf") > 0))).scalar()
    return hits.where("tf > 0").select("title", (F.col("tf") * idf).alias("tfidf"))
